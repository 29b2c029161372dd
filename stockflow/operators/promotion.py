"""Promotion windows and counters: J4, J5, A3, P19."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.functions import events as E
from stockflow.functions import vocabulary as V

# How a promotional event relates to the promotion's window.
NOT_APPLIED = "NOT_APPLIED"
ACTIVE = "ACTIVE"
OUTSIDE = "OUTSIDE"
UNKNOWN = "UNKNOWN"


def promotional_price(applied: Column, sale: Column, normal: Column) -> Column:
    """The sale price when the promotion applies, else the normal price."""
    return F.when(applied, sale).otherwise(normal)


def last_of_key(promotions: DataFrame) -> DataFrame:
    """One row per promotion key: the one configured last.

    ``config_row`` says which that is, if the rows have it; else the window that starts
    last counts, then the one that ends last, then the cheaper one.
    """
    order = F.col("config_row") if "config_row" in promotions.columns else _latest_window()
    columns = [name for name in promotions.columns if name not in V.PROMOTION_KEY]
    last = F.max_by(F.struct(*columns), order)
    rows = promotions.groupBy(*V.PROMOTION_KEY).agg(last.alias("_last"))
    return rows.select(*V.PROMOTION_KEY, "_last.*").select(*promotions.columns)


def _latest_window() -> Column:
    return F.struct("start_time", "end_time", -F.col("sale_price"), -F.col("normal_price"))


def enforce_promotion_window(events: DataFrame, promotions: DataFrame) -> DataFrame:
    """Price every event by its promotion's time window, both ends included.

    Joined on the keys alone, because an event outside the window still needs the
    promotion's normal price. An unknown promotion is cleared and the price kept. Of rows
    that repeat a key the last one counts, so no event is multiplied. Only promotional
    events take part in the join; the others pass by it. Spark broadcasts the promotions
    while they are small, and splits hot keys of a shuffled join.
    """
    windows = last_of_key(promotions).select(
        *V.PROMOTION_KEY, F.lit(True).alias("_known"), *_prices(),
        F.col("start_time").alias("_from"), F.col("end_time").alias("_to"),
    )
    inside = F.col("event_timestamp").between(F.col("_from"), F.col("_to"))
    found = events.filter(E.is_promotional()).join(windows, V.PROMOTION_KEY, "left")
    return _priced(events, found.withColumn("_inside", F.coalesce(inside, F.lit(False))))


def disjoint_windows(windows: DataFrame) -> DataFrame:
    """Pieces of time per key that do not overlap, each with the window that wins there.

    Where windows overlap, the one that starts last wins, then the one that ends last,
    then the cheaper one. Pieces end before ``_until``; rows without both ends of a window
    have no piece. Only windows of one key meet, at their common pieces.
    """
    instant = F.expr("INTERVAL 0.000001 SECOND")
    bounded = windows.filter("start_time <= end_time").withColumn("_after", F.col("end_time") + instant)
    points = bounded.select(*V.PROMOTION_KEY, F.explode(F.array("start_time", "_after")).alias("_at"))
    following = F.lead("_at").over(Window.partitionBy(*V.PROMOTION_KEY).orderBy("_at"))
    pieces = points.distinct().withColumn("_until", following).filter("_until IS NOT NULL")
    covering = pieces.join(bounded, V.PROMOTION_KEY).filter("start_time <= _at AND _after >= _until")
    winner = F.max_by(F.struct(*_prices()), _latest_window())
    found = covering.groupBy(*V.PROMOTION_KEY, "_at", "_until").agg(winner.alias("_winner"))
    return found.select(*V.PROMOTION_KEY, "_at", "_until", "_winner.*")


def enforce_promotion_windows(events: DataFrame, windows: DataFrame) -> DataFrame:
    """J5 for keys with many windows: an event takes the price of the window that wins.

    An interval join: pieces and events meet by key and day, so a key with a third of all
    events is spread over its days, and an event meets the pieces of one day only. As they
    do not overlap, it matches one at most. An event outside all windows of a known key
    has the normal price of the key's latest window.
    """
    known = last_of_key(windows).select(
        *V.PROMOTION_KEY, F.lit(True).alias("_known"),
        F.col("normal_price").cast("double").alias("_outside_price"),
    )
    day = F.expr("INTERVAL 1 DAY")
    last = F.date_trunc("day", F.col("_until") - F.expr("INTERVAL 0.000001 SECOND"))
    pieces = disjoint_windows(windows).withColumn(
        "_day", F.explode(F.sequence(F.date_trunc("day", "_at"), last, day))
    )
    sold = events.filter(E.is_promotional())
    key = [F.col(f"e.{name}") == F.col(f"p.{name}") for name in V.PROMOTION_KEY]
    key.append(F.date_trunc("day", F.col("e.event_timestamp")) == F.col("p._day"))
    key.append(F.col("e.event_timestamp") >= F.col("p._at"))
    key.append(F.col("e.event_timestamp") < F.col("p._until"))
    found = (
        sold.alias("e")
        .join(pieces.alias("p"), key, "left")
        .select("e.*", "p._sale_price", F.col("p._at").isNotNull().alias("_inside"))
        .join(known, V.PROMOTION_KEY, "left")
        .withColumn("_normal_price", F.col("_outside_price"))
    )
    return _priced(events, found)


def _prices() -> list[Column]:
    return [
        F.col(name).cast("double").alias(f"_{name}") for name in ("sale_price", "normal_price")
    ]


def _priced(events: DataFrame, looked_up: DataFrame) -> DataFrame:
    """All events with class and price; ``looked_up`` are the promotional ones."""
    others = events.filter(~F.coalesce(E.is_promotional(), F.lit(False))).withColumn(
        "promotion_class", F.lit(NOT_APPLIED)
    )
    window_class = (
        F.when(F.col("_known").isNull(), F.lit(UNKNOWN))
        .when(F.col("_inside"), F.lit(ACTIVE))
        .otherwise(F.lit(OUTSIDE))
    )
    cleared = F.col("promotion_class").isin(OUTSIDE, UNKNOWN)
    active = F.col("promotion_class") == ACTIVE
    priced = F.col("promotion_class").isin(ACTIVE, OUTSIDE)
    price = promotional_price(active, F.col("_sale_price"), F.col("_normal_price"))
    changed = looked_up.withColumn("promotion_class", window_class).withColumns(
        {
            "unit_price": F.when(priced, price).otherwise(F.col("unit_price")),
            "promotion_id": F.when(~cleared, F.col("promotion_id")),
            "promotion_applied": F.when(cleared, F.lit(False)).otherwise(
                F.col("promotion_applied")
            ),
        }
    )
    return changed.select(*events.columns, "promotion_class").unionByName(others)


def counts_for_promotion() -> Column:
    """Valid promotional events of a type that has a counter."""
    return (
        F.col("is_valid_event")
        & E.is_promotional()
        & F.col("event_type").isin(V.PROMOTION_CONSUMES + V.PROMOTION_CANCELS)
    )


def promotion_counters(events: DataFrame) -> DataFrame:
    """A3: consumed and cancelled quantity per promotion key, map-side combined."""
    quantity = F.col("quantity").cast("bigint")

    def total(kinds: list[str]) -> Column:
        return F.sum(
            F.when(F.col("event_type").isin(kinds), quantity).otherwise(F.lit(0))
        )

    return events.filter(counts_for_promotion()).groupBy(*V.PROMOTION_KEY).agg(
        total(V.PROMOTION_CONSUMES).alias("_consumed"),
        total(V.PROMOTION_CANCELS).alias("_cancelled"),
    )


def apply_promotion_counters(metrics: DataFrame, events: DataFrame) -> DataFrame:
    """A3: metric rows touched by these events, with the counters added.

    The events are reduced to one row per key before they meet the metrics.
    """
    touched = metrics.join(promotion_counters(events), V.PROMOTION_KEY, "inner")
    return touched.withColumns(
        {
            "promotion_consumed_qty": F.col("promotion_consumed_qty")
            + F.col("_consumed"),
            "promotion_cancelled_qty": F.col("promotion_cancelled_qty")
            + F.col("_cancelled"),
        }
    ).drop("_consumed", "_cancelled")

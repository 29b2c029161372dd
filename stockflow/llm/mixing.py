"""Mixing sources to target weights by entropy balancing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from stockflow.llm.rows import fresh
from stockflow.llm.words import BLANK
from stockflow.storage import stored

WEIGHTS = (5, 2, 1)
MAX_RATE = 3
TOLERANCE = 1e-7
MAX_STEPS = 60
# Rounding works on whole numbers, so that running sums are exact.
UNIT = 1 << 20
# Rows of a source that one task orders.
BLOCK_ROWS = 4096
REPAIRS = 4


def words_in(text: Column) -> Column:
    """Number of words of a text; null has none."""
    parts = F.split(F.coalesce(text.cast("string"), F.lit("")), f"{BLANK}+")
    return F.size(F.array_remove(parts, "")).cast("bigint")


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, max_rate: int = MAX_RATE) -> DataFrame:
    """(source, source_size, target) from (source, source_size), one row per source.

    The level at which weights fill up to the total is found by raising it until the
    sources that stop at their limit no longer change. One row per source is ordered
    in one task; one row of sums reaches the driver per step.
    """
    order = Window.orderBy(F.col("source").isNull(), F.encode("source", "utf-8"))
    choice = F.pmod(F.row_number().over(order) - 1, F.lit(len(weights)))
    ranked = sizes.select(
        "source",
        "source_size",
        F.element_at(F.array(*map(F.lit, weights)), choice + 1).cast("double").alias("weight"),
        (max_rate * F.col("source_size")).cast("double").alias("most"),
    )
    ranked = stored(ranked, "sources")
    level, full = 0.0, -1
    while True:
        at_most = F.col("most") <= F.col("weight") * level
        sums = ranked.agg(
            F.sum("source_size").alias("total"),
            F.count_if(at_most).alias("full"),
            F.sum(F.when(at_most, F.col("most")).otherwise(0.0)).alias("fixed"),
            F.sum(F.when(at_most, 0.0).otherwise(F.col("weight"))).alias("free"),
        ).first()
        if sums["full"] == full or not sums["total"] or not sums["free"]:
            break
        full, level = sums["full"], (sums["total"] - sums["fixed"]) / sums["free"]
    return ranked.select(
        "source",
        "source_size",
        F.least("most", F.col("weight") * level).alias("target"),
    )


def rate(tilt: Column, size: Column, scale: Column) -> Column:
    """Copies wanted of a document: its odds below the limit, tilted exponentially.

    No tilt gives one copy; the rate stays between nothing and ``MAX_RATE``.
    """
    return MAX_RATE / (1 + (MAX_RATE - 1) * F.exp(-tilt * size / scale))


def tilts(sizes: DataFrame, wanted: DataFrame) -> DataFrame:
    """(source, tilt, scale): the tilts at which expected words meet the targets.

    ``sizes`` is the histogram (source, size, n) of documents. The dual is convex and
    separates by source; all sources take their Newton steps at once, each from sums
    over the histogram. A step that leaves the interval known to hold the solution is
    replaced by its middle. Every step's table is written to the shared folder. A tilt
    is null where the target is the limit or zero, which no finite tilt reaches.
    """
    base = wanted.join(
        sizes.groupBy(F.col("source").alias("of")).agg(F.sum("n").alias("docs")),
        F.col("source").eqNullSafe(F.col("of")),
    )
    inner = (F.col("target") > 0) & (
        F.col("target") < MAX_RATE * F.col("source_size") * (1 - 1e-9)
    )
    found = base.select(
        F.col("source").alias("of"),
        "target",
        (F.col("source_size") / F.col("docs")).alias("scale"),
        F.when(inner, 0.0).alias("tilt"),
        F.lit(None).cast("double").alias("low"),
        F.lit(None).cast("double").alias("high"),
        F.lit(1.0).alias("miss"),
    )
    found = stored(found, "tilts")
    for _ in range(MAX_STEPS):
        if not found.where(F.col("tilt").isNotNull() & (F.col("miss") > TOLERANCE)).limit(1).count():
            break
        joined = sizes.join(found, F.col("source").eqNullSafe(F.col("of")))
        r = rate(F.col("tilt"), F.col("size"), F.col("scale"))
        words = F.col("n") * F.col("size") * r
        slope = words * (1 - r / MAX_RATE) * F.col("size") / F.col("scale")
        keys = ["of", "target", "scale", "tilt", "low", "high"]
        sums = joined.groupBy(*keys).agg(F.sum(words).alias("words"), F.sum(slope).alias("slope"))
        over = F.col("words") - F.col("target")
        sums = sums.withColumns(
            {
                "low": F.when(over <= 0, F.col("tilt")).otherwise(F.col("low")),
                "high": F.when(over >= 0, F.col("tilt")).otherwise(F.col("high")),
                "step": F.col("tilt") - over / F.when(F.col("slope") > 0, F.col("slope")),
            }
        )
        inside = (
            F.col("step").isNotNull()
            & (F.col("low").isNull() | (F.col("step") > F.col("low")))
            & (F.col("high").isNull() | (F.col("step") < F.col("high")))
            & (F.abs(F.col("step")) <= 4 * F.abs(F.col("tilt")) + 4)
        )
        middle = (
            F.when(F.col("low").isNull(), 2 * F.col("high") - F.abs(F.col("high")) - 4)
            .when(F.col("high").isNull(), 2 * F.abs(F.col("low")) + 4)
            .otherwise((F.col("low") + F.col("high")) / 2)
        )
        middle = F.when(F.col("low").isNull(), F.col("high") - F.abs(F.col("high")) - 4).otherwise(middle)
        settled = F.abs(over) <= TOLERANCE * F.col("target")
        sums = sums.select(
            "of", "target", "scale",
            F.when(settled, F.col("tilt")).when(inside, F.col("step")).otherwise(middle).alias("tilt"),
            "low", "high",
            (F.abs(over) / F.col("target")).alias("miss"),
        )
        found = stored(sums, "tilts")
    return found.select(F.col("of").alias("source"), "tilt", "scale")


def _rounded(rows: DataFrame, count: int) -> DataFrame:
    """Whole copies of (…, source, size, rate): systematic rounding along each source.

    A source is laid out in blocks of bounded rows; running sums inside a block start
    from the sum of the blocks before it, so a hot source is no hot task.
    """
    blocks = max(1, -(-count // BLOCK_ROWS))
    rows = rows.withColumns(
        {
            "units": F.round(F.col("rate") * UNIT).cast("bigint"),
            "block": F.pmod(F.col("mark"), F.lit(blocks)).cast("int"),
        }
    )
    totals = rows.groupBy("source", "block").agg(F.sum("units").alias("units"))
    before = Window.partitionBy("source").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select(
        F.col("source").alias("of"),
        F.col("block").alias("at"),
        F.coalesce(F.sum("units").over(before), F.lit(0)).alias("start"),
    )
    inside = (
        Window.partitionBy("source", "block")
        .orderBy(F.desc("size"), "mark", "id", "row")
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    rows = rows.withColumn("upto", F.sum("units").over(inside))
    rows = rows.join(
        starts, F.col("source").eqNullSafe(F.col("of")) & (F.col("block") == F.col("at"))
    )
    upto = F.col("start") + F.col("upto") + F.lit(UNIT // 2)
    half = F.lit(UNIT).cast("bigint")
    copies = F.floor(upto / half) - F.floor((upto - F.col("units")) / half)
    return rows.select("row", "id", "mark", "source", "size", copies.cast("int").alias("copies"))


def _repaired(rows: DataFrame, wanted: DataFrame) -> DataFrame:
    """One document of each source gains or loses a copy where that lessens the miss."""
    sums = rows.groupBy(F.col("source").alias("of")).agg(
        F.sum(F.col("size") * F.col("copies")).alias("words")
    )
    short = wanted.join(sums, F.col("source").eqNullSafe(F.col("of"))).select(
        "of", (F.col("target") - F.col("words")).alias("short")
    )
    found = rows.join(short, F.col("source").eqNullSafe(F.col("of")))
    # A change of at most twice the miss makes it smaller.
    fits = (F.col("size") > 0) & (F.col("size") < 2 * F.abs("short")) & F.when(
        F.col("short") > 0, F.col("copies") < MAX_RATE
    ).otherwise(F.col("copies") > 0)
    gap = F.abs(F.abs("short") - F.col("size"))
    # Rows alike but for their key differ in copies, which come first.
    pick = found.where(fits).groupBy("of").agg(
        F.min(F.struct(gap.alias("gap"), "mark", "id", "size", "copies", "row")).alias("pick")
    )
    pick = pick.select(F.col("pick.row").alias("r"))
    out = found.join(pick, F.col("row") == F.col("r"), "left")
    change = F.when(F.col("r").isNull(), 0).otherwise(F.signum("short")).cast("int")
    return out.select("row", "id", "mark", "source", "size", (F.col("copies") + change).alias("copies"))


def mix(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
        source_column: str = "source", weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """(id, mark, source, size, source_size, target, copies) for every document.

    Rates come from entropy balancing, copies from rounding them; ``copies`` is at most
    ``MAX_RATE``. Null texts have size 0, null sources are one source, ranked last.
    Repeated rows are documents of their own, told apart by a row key that is fixed by
    being written. The same rows give the same copies in any order. Other columns are not read. An empty table gives
    no rows; without any words all targets are 0 and each document gets one copy.
    """
    row = F.monotonically_increasing_id()
    return _mix(documents, row, id_column, text_column, source_column, weights).drop("row")


def _mix(documents: DataFrame, row: Column, id_column: str, text_column: str,
         source_column: str, weights: tuple[int, ...]) -> DataFrame:
    """What ``mix`` returns, and the key of each row."""
    rows = documents.select(
        row.alias("row"),
        F.col(id_column).alias("id"),
        F.col(source_column).cast("string").alias("source"),
        words_in(F.col(text_column)).alias("size"),
        F.xxhash64(F.col(id_column).cast("string"), F.col(text_column).cast("string")).alias("mark"),
    )
    rows = stored(rows, "sizes")
    histogram = stored(rows.groupBy("source", "size").agg(F.count("*").alias("n")), "histogram")
    sizes = histogram.groupBy("source").agg(F.sum(F.col("n") * F.col("size")).alias("source_size"))
    wanted = stored(targets(sizes, weights), "targets")
    found = tilts(histogram, wanted)
    count = histogram.agg(F.sum("n")).first()[0] or 0
    known = wanted.select(F.col("source").alias("of"), "target", "source_size").join(
        found.withColumnRenamed("source", "of_"), F.col("of").eqNullSafe(F.col("of_"))
    )
    rated = rows.join(known, F.col("source").eqNullSafe(F.col("of")))
    at_edge = F.when(F.col("source_size") == 0, 1.0).when(F.col("target") > 0, float(MAX_RATE)).otherwise(0.0)
    wanted_rate = F.coalesce(rate(F.col("tilt"), F.col("size"), F.col("scale")), at_edge)
    copies = _rounded(rated.select("row", "id", "mark", "source", "size", wanted_rate.alias("rate")), count)
    copies = stored(copies, "copies")
    for _ in range(REPAIRS):
        copies = stored(_repaired(copies, wanted), "copies")
    named = wanted.select(F.col("source").alias("of"), "source_size", "target")
    return copies.join(named, F.col("source").eqNullSafe(F.col("of"))).drop("of")


def mixed(documents: DataFrame, id_column: str = "doc_id", text_column: str = "text",
          source_column: str = "source", weights: tuple[int, ...] = WEIGHTS) -> DataFrame:
    """The documents of the mix, each as often as it has copies, columns unchanged."""
    own, of, times, each = (fresh(documents, name) for name in ("own_row", "of_row", "times", "each"))
    # Rows that repeat each other have copies of their own, so each keeps its key.
    rows = stored(documents.withColumn(own, F.monotonically_increasing_id()), "documents")
    copies = _mix(rows, F.col(own), id_column, text_column, source_column, weights)
    copies = copies.where("copies > 0").select(F.col("row").alias(of), F.col("copies").alias(times))
    found = rows.join(copies, F.col(own) == F.col(of))
    repeat = F.explode(F.array_repeat(F.lit(0), F.col(times)))
    return found.select(*[rows[name] for name in documents.columns], repeat.alias(each)).drop(each)

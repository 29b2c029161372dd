"""Keys and text boundaries: P10, P12-P14."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from stockflow.functions import vocabulary as V

# Separators and the stand-in for a missing promotion.
KEY_SEPARATOR = "#"
MESSAGE_KEY_SEPARATOR = "|"
NO_PROMOTION = "NO_PROMOTION"


def joined_key(names: list[str], separator: str = KEY_SEPARATOR) -> Column:
    """Columns joined to one key; NULL when any part is NULL.

    ``concat`` keeps the NULL, where ``concat_ws`` would skip the part and make
    two different keys equal.
    """
    parts = []
    for name in names:
        parts += [F.lit(separator), F.col(name)]
    return F.concat(*parts[1:])


def inventory_key() -> Column:
    return joined_key(V.STOCK_KEY)


def promotion_key() -> Column:
    return joined_key(V.PROMOTION_KEY)


def message_key() -> Column:
    return joined_key(V.STOCK_KEY, MESSAGE_KEY_SEPARATOR)


def promotion_or_none() -> Column:
    """A NULL or empty promotion becomes the stand-in."""
    return F.coalesce(F.nullif("promotion_id", F.lit("")), F.lit(NO_PROMOTION))


def velocity_scope() -> Column:
    return F.concat(
        joined_key(V.STOCK_KEY), F.lit(KEY_SEPARATOR), promotion_or_none()
    )


def deterministic_id(*parts: Column) -> Column:
    """Stable identifier for a derived row, so that a replay repeats it."""
    return F.sha2(F.concat_ws(KEY_SEPARATOR, *parts), 256)


def iso_utc(name: str) -> Column:
    """An instant as ISO-8601 text, for text boundaries only."""
    return F.date_format(name, "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX")


def item_json(*names: str) -> Column:
    """A row as a JSON item without its NULL attributes."""
    return F.to_json(F.struct(*names))

"""Stock status and alert texts: P11, P16."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Stock statuses and alert types.
UNKNOWN = "UNKNOWN"
OVERSELL = "OVERSELL"
LOW_STOCK = "LOW_STOCK"
NORMAL = "NORMAL"
INVALID_EVENT = "INVALID_EVENT"
UNKNOWN_SKU = "UNKNOWN_SKU"
UNKNOWN_PROMOTION = "UNKNOWN_PROMOTION"

# Alert messages.
MISSING_ID_MESSAGE = (
    "Malformed Kafka message or JSON parse failed: missing event_id"
)
INVALID_MESSAGE = "Invalid event"
UNKNOWN_SKU_MESSAGE = (
    "Inventory item not found in DynamoDB current inventory table"
)
UNKNOWN_PROMOTION_MESSAGE = (
    "Promotion item not found in DynamoDB promotion metrics table"
)
OVERSELL_MESSAGE = "Oversell detected. Current sellable stock=%d"
LOW_STOCK_MESSAGE = "Low stock detected. Current sellable stock=%d"


def inventory_status(stock: Column, threshold: Column) -> Column:
    """Status of a stock level. Without a threshold there is no low stock."""
    return (
        F.when(stock.isNull(), F.lit(UNKNOWN))
        .when(stock < 0, F.lit(OVERSELL))
        .when(stock <= threshold, F.lit(LOW_STOCK))
        .otherwise(F.lit(NORMAL))
    )


def invalid_event_message(event_id: Column, reason: Column) -> Column:
    """Text of an INVALID_EVENT alert."""
    return F.when(
        F.coalesce(event_id, F.lit("")) == "", F.lit(MISSING_ID_MESSAGE)
    ).otherwise(F.coalesce(F.nullif(reason, F.lit("")), F.lit(INVALID_MESSAGE)))


def stock_message(status: Column, stock: Column) -> Column:
    """Text of a stock-level alert."""
    return F.when(
        status == OVERSELL, F.format_string(OVERSELL_MESSAGE, stock)
    ).when(status == LOW_STOCK, F.format_string(LOW_STOCK_MESSAGE, stock))

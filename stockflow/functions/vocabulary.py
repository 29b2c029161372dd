"""The domain vocabulary as plain data; the expressions are built from it."""

# Event types by the direction in which they move sellable stock.
DECREASES = ["STOCK_RESERVED", "COD_CONFIRMED"]
INCREASES = [
    "RESERVATION_EXPIRED",
    "ORDER_CANCELLED",
    "RETURN_RECEIVED",
    "STOCK_REPLENISHED",
]
NEUTRAL = ["PAYMENT_CONFIRMED"]
EVENT_TYPES = DECREASES + INCREASES + NEUTRAL

# Event types that sell stock, and promotion counter groups.
SALES = ["STOCK_RESERVED", "COD_CONFIRMED"]
PROMOTION_CONSUMES = ["STOCK_RESERVED", "COD_CONFIRMED"]
PROMOTION_CANCELS = ["ORDER_CANCELLED", "RESERVATION_EXPIRED"]

# Fixed values: (event type, allowed methods, required status, reason code), in
# the order in which the stream checks them.
PAYMENT_RULES = [
    ("STOCK_RESERVED", ["E_WALLET"], "PENDING",
     "invalid_stock_reserved_payment_logic"),
    ("PAYMENT_CONFIRMED", ["E_WALLET"], "PAID",
     "invalid_payment_confirmed_logic"),
    ("RESERVATION_EXPIRED", ["E_WALLET"], "EXPIRED",
     "invalid_reservation_expired_logic"),
    ("COD_CONFIRMED", ["COD"], "COD_CONFIRMED",
     "invalid_cod_confirmed_logic"),
    ("ORDER_CANCELLED", ["COD", "E_WALLET"], "CANCELLED",
     "invalid_order_cancelled_logic"),
]

# Types whose method and status the producer contract adds.
NOT_APPLICABLE_TYPES = ["RETURN_RECEIVED", "STOCK_REPLENISHED"]
NOT_APPLICABLE = "NOT_APPLICABLE"

# Order id by event type under the producer contract.
ORDER_ID_REQUIRED = [
    "STOCK_RESERVED",
    "COD_CONFIRMED",
    "PAYMENT_CONFIRMED",
    "RESERVATION_EXPIRED",
    "ORDER_CANCELLED",
]
ORDER_ID_FORBIDDEN = ["STOCK_REPLENISHED"]

# Gold columns and the event type each one totals.
QUANTITY_TOTALS = {
    "reserved_qty": "STOCK_RESERVED",
    "cod_sold_qty": "COD_CONFIRMED",
    "cancelled_qty": "ORDER_CANCELLED",
    "expired_qty": "RESERVATION_EXPIRED",
    "returned_qty": "RETURN_RECEIVED",
    "replenished_qty": "STOCK_REPLENISHED",
}

# Grain of all stock tables and of promotion tables.
STOCK_KEY = ["campaign_id", "sku_id", "warehouse_id"]
PROMOTION_KEY = ["campaign_id", "promotion_id", "sku_id", "warehouse_id"]

# Arrival order of events.
ARRIVAL = ["kafka_partition", "kafka_offset"]

# Fixed value: default local business day.
DEFAULT_BUSINESS_TIMEZONE = "Asia/Ho_Chi_Minh"

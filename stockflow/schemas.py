"""Table schemas as DDL text, passed to every reader so that nothing is inferred.

Explicit schemas also keep a partition value such as ``campaign_id=007`` a
string. Column names and their order are fixed values of the data contract.
"""

# The wire contract of one inventory event.
EVENT = (
    "event_id STRING, campaign_id STRING, event_time STRING, event_type STRING, "
    "order_id STRING, sku_id STRING, warehouse_id STRING, quantity INT, "
    "unit_price DOUBLE, promotion_id STRING, promotion_applied BOOLEAN, "
    "payment_method STRING, payment_status STRING, "
    "reservation_expires_at STRING, source STRING"
)

# The message envelope around an event.
ENVELOPE = (
    "key STRING, value STRING, topic STRING, partition INT, offset BIGINT, "
    "timestamp TIMESTAMP"
)

# Campaign configuration files.
INITIAL_INVENTORY = (
    "campaign_id STRING, sku_id STRING, warehouse_id STRING, product_name STRING, "
    "initial_sellable_stock INT, low_stock_threshold INT"
)
PROMOTION_CONFIG = (
    "campaign_id STRING, promotion_id STRING, sku_id STRING, warehouse_id STRING, "
    "promotion_name STRING, promotion_quota INT, sale_price DECIMAL(18,2), "
    "normal_price DECIMAL(18,2), start_time STRING, end_time STRING"
)
SNAPSHOT = (
    "snapshot_date DATE, campaign_id STRING, sku_id STRING, warehouse_id STRING, "
    "product_name STRING, opening_sellable_stock INT, low_stock_threshold INT"
)

# Lake tables.
BRONZE = (
    "kafka_key STRING, json_value STRING, kafka_topic STRING, kafka_partition INT, "
    "kafka_offset BIGINT, kafka_timestamp TIMESTAMP, bronze_ingested_at TIMESTAMP, "
    "event_date_utc DATE, event_hour_utc INT"
)
SILVER_MOVEMENTS = (
    "event_id STRING, campaign_id STRING, event_timestamp TIMESTAMP, "
    "business_timestamp TIMESTAMP, event_type STRING, order_id STRING, "
    "sku_id STRING, warehouse_id STRING, quantity INT, unit_price DOUBLE, "
    "promotion_id STRING, promotion_applied BOOLEAN, payment_method STRING, "
    "payment_status STRING, reservation_expires_at STRING, source STRING, "
    "movement_qty INT, is_valid_event BOOLEAN, invalid_reason STRING, "
    "kafka_key STRING, kafka_topic STRING, kafka_partition INT, "
    "kafka_offset BIGINT, kafka_timestamp TIMESTAMP, event_date DATE, "
    "event_hour INT, silver_processed_at TIMESTAMP, business_date DATE, "
    "business_hour INT"
)
SILVER_INVALID = (
    "event_id STRING, campaign_id STRING, event_timestamp TIMESTAMP, "
    "business_timestamp TIMESTAMP, event_type STRING, sku_id STRING, "
    "warehouse_id STRING, is_valid_event BOOLEAN, invalid_reason STRING, "
    "json_value STRING, kafka_key STRING, kafka_topic STRING, "
    "kafka_partition INT, kafka_offset BIGINT, event_date DATE, event_hour INT, "
    "alert_type STRING, alert_created_at TIMESTAMP, business_date DATE, "
    "business_hour INT"
)
VELOCITY = (
    "campaign_id STRING, sku_id STRING, warehouse_id STRING, promotion_id STRING, "
    "window_start TIMESTAMP, window_end TIMESTAMP, window_size_minutes INT, "
    "order_count BIGINT, sold_qty BIGINT, silver_processed_at TIMESTAMP, "
    "window_date DATE, window_hour INT"
)
VELOCITY_SCOPE = (
    "velocity_scope STRING, campaign_id STRING, sku_id STRING, "
    "warehouse_id STRING, promotion_id STRING, window_start TIMESTAMP, "
    "window_end TIMESTAMP, window_size_minutes BIGINT, order_count BIGINT, "
    "sold_qty BIGINT, silver_processed_at TIMESTAMP, updated_at TIMESTAMP, "
    "window_date DATE, window_hour INT"
)
STATE_HISTORY = (
    "history_id STRING, inventory_key STRING, event_id STRING, sku_id STRING, "
    "warehouse_id STRING, event_time TIMESTAMP, business_timestamp TIMESTAMP, "
    "event_type STRING, quantity INT, movement_qty INT, "
    "previous_sellable_stock BIGINT, current_sellable_stock BIGINT, "
    "status STRING, processed_at TIMESTAMP, kafka_partition INT, "
    "kafka_offset BIGINT, business_date DATE, campaign_id STRING, batch_id BIGINT"
)
ALERTS = (
    "alert_id STRING, campaign_id STRING, alert_type STRING, sku_id STRING, "
    "warehouse_id STRING, current_sellable_stock BIGINT, event_id STRING, "
    "message STRING, kafka_partition INT, kafka_offset BIGINT, "
    "created_at TIMESTAMP, batch_id BIGINT"
)
ACCEPTED = (
    "event_id STRING, campaign_id STRING, event_timestamp TIMESTAMP, "
    "business_timestamp TIMESTAMP, business_date DATE, event_type STRING, "
    "sku_id STRING, warehouse_id STRING, quantity INT, promotion_id STRING, "
    "promotion_applied BOOLEAN, movement_qty INT, is_valid_event BOOLEAN, "
    "invalid_reason STRING, kafka_topic STRING, kafka_partition INT, "
    "kafka_offset BIGINT, kafka_timestamp TIMESTAMP, processed_at TIMESTAMP"
)

# Keyed state tables.
CURRENT_INVENTORY = (
    "inventory_key STRING, campaign_id STRING, sku_id STRING, warehouse_id STRING, "
    "product_name STRING, initial_sellable_stock BIGINT, "
    "current_sellable_stock BIGINT, low_stock_threshold BIGINT, status STRING, "
    "last_event_id STRING, last_event_time TIMESTAMP, created_at TIMESTAMP, "
    "updated_at TIMESTAMP"
)
PROMOTION_METRICS = (
    "promotion_key STRING, campaign_id STRING, promotion_id STRING, sku_id STRING, "
    "warehouse_id STRING, promotion_name STRING, promotion_quota BIGINT, "
    "promotion_consumed_qty BIGINT, promotion_cancelled_qty BIGINT, "
    "sale_price DECIMAL(18,2), normal_price DECIMAL(18,2), start_time TIMESTAMP, "
    "end_time TIMESTAMP, created_at TIMESTAMP, updated_at TIMESTAMP"
)

# Gold and mart tables (sums are BIGINT, see README).
GOLD_RECONCILIATION = (
    "sku_id STRING, warehouse_id STRING, opening_sellable_stock BIGINT, "
    "net_movement_qty BIGINT, batch_recomputed_sellable_stock BIGINT, "
    "streaming_sellable_stock BIGINT, diff_qty BIGINT, status STRING, "
    "created_at TIMESTAMP, recon_date DATE, campaign_id STRING"
)
GOLD_DAILY_SUMMARY = (
    "sku_id STRING, warehouse_id STRING, product_name STRING, "
    "opening_sellable_stock BIGINT, total_reserved_qty BIGINT, "
    "total_cod_sold_qty BIGINT, total_cancelled_qty BIGINT, "
    "total_expired_qty BIGINT, total_returned_qty BIGINT, "
    "total_replenished_qty BIGINT, sales_movement_qty BIGINT, "
    "net_movement_qty BIGINT, closing_sellable_stock BIGINT, event_count BIGINT, "
    "created_at TIMESTAMP, summary_date DATE, campaign_id STRING"
)
FACT_RECONCILIATION = GOLD_RECONCILIATION + ", loaded_at TIMESTAMP"
FACT_DAILY_SUMMARY = GOLD_DAILY_SUMMARY + ", loaded_at TIMESTAMP"
MONTHLY_VIEW = (
    "sku_id STRING, warehouse_id STRING, product_name STRING, "
    "total_reserved_qty BIGINT, total_cod_sold_qty BIGINT, "
    "total_cancelled_qty BIGINT, total_expired_qty BIGINT, "
    "total_returned_qty BIGINT, total_replenished_qty BIGINT, "
    "total_sales_movement_qty BIGINT, total_net_movement_qty BIGINT, "
    "total_event_count BIGINT, first_opening_sellable_stock BIGINT, "
    "latest_closing_sellable_stock BIGINT, month_date DATE, campaign_id STRING"
)
RECONCILIATION_VIEW = (
    "status STRING, sku_warehouse_count BIGINT, total_abs_diff_qty BIGINT, "
    "latest_loaded_at TIMESTAMP, recon_date DATE, campaign_id STRING"
)
LOAD_LOG = (
    "load_id STRING, pipeline_name STRING, source_path STRING, "
    "target_staging_table STRING, target_mart_table STRING, business_date DATE, "
    "campaign_id STRING, load_started_at TIMESTAMP, load_finished_at TIMESTAMP, "
    "rows_loaded BIGINT, status STRING, error_message STRING, "
    "created_at TIMESTAMP"
)


def column_names(ddl: str) -> list[str]:
    """Column names of one of the flat schemas above."""
    fields = ddl.replace("DECIMAL(18,2)", "DECIMAL").split(",")
    return [field.split()[0] for field in fields]

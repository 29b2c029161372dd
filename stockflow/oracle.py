"""SQL twins of the registered queries, for an independent engine.

Each is one statement over the driver's tables: the adapter rules and the stages a
query needs, as common table expressions, and a final SELECT. The SQL is written
from the operator definitions and shares no code with the Spark expressions.
"""

from __future__ import annotations

INSTANT = "%Y-%m-%d %H:%M:%S.%f"


def _text(name: str) -> str:
    return f"strftime({name}, '{INSTANT}') AS {name}"


# Stages in dependency order: name -> (stages it reads, SQL).
STAGES: dict[str, tuple[list[str], str]] = {
    "base": ([], """
        SELECT event_id AS n, user_id AS u, ts, value,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS k,
               CASE WHEN event_id % 193 = 0 THEN 'BOGUS'
                    WHEN event_type = 'signup' AND event_id % 10 < 3 THEN 'STOCK_REPLENISHED'
                    WHEN event_type = 'signup' THEN 'RETURN_RECEIVED'
                    WHEN event_type = 'view' THEN 'STOCK_RESERVED'
                    WHEN event_type = 'purchase' AND event_id % 3 = 0 THEN 'PAYMENT_CONFIRMED'
                    WHEN event_type = 'purchase' THEN 'COD_CONFIRMED'
                    WHEN event_type = 'click' THEN 'ORDER_CANCELLED'
                    ELSE 'RESERVATION_EXPIRED' END AS kind
        FROM events"""),
    "sent": (["base"], """
        SELECT *, n AS pos FROM base
        UNION ALL
        SELECT *, n + 1000000000 AS pos FROM base WHERE n % 50 = 0"""),
    "raw": (["sent"], """
        SELECT CASE WHEN n % 211 <> 0 THEN 'evt_' || n END AS event_id,
               'CAMP_' || (n % 2) AS campaign_id,
               CASE WHEN n % 197 = 0 THEN 'not-a-time'
                    ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%fZ') END AS event_time,
               kind AS event_type,
               'ORD_' || u AS order_id,
               'SKU_' || (u % 10) AS sku_id,
               'WH_' || (u % 3) AS warehouse_id,
               CASE WHEN k <= 97 THEN k % 7 END AS quantity,
               value AS unit_price,
               CASE WHEN n % 4 = 0 THEN 'PROMO_' || (u % 10) END AS promotion_id,
               n % 4 = 0 AS promotion_applied,
               CASE WHEN n % 101 = 0 THEN 'COD'
                    WHEN n % 103 = 0 THEN NULL
                    WHEN kind IN ('STOCK_RESERVED', 'PAYMENT_CONFIRMED', 'RESERVATION_EXPIRED')
                        THEN 'E_WALLET'
                    WHEN kind = 'COD_CONFIRMED' THEN 'COD'
                    WHEN kind = 'ORDER_CANCELLED' AND n % 2 = 0 THEN 'COD'
                    WHEN kind = 'ORDER_CANCELLED' THEN 'E_WALLET'
                    ELSE 'NOT_APPLICABLE' END AS payment_method,
               CASE WHEN n % 107 = 0 THEN 'PENDING'
                    WHEN kind = 'STOCK_RESERVED' THEN 'PENDING'
                    WHEN kind = 'PAYMENT_CONFIRMED' THEN 'PAID'
                    WHEN kind = 'RESERVATION_EXPIRED' THEN 'EXPIRED'
                    WHEN kind = 'COD_CONFIRMED' THEN 'COD_CONFIRMED'
                    WHEN kind = 'ORDER_CANCELLED' THEN 'CANCELLED'
                    ELSE 'NOT_APPLICABLE' END AS payment_status,
               CASE WHEN (kind = 'STOCK_RESERVED' AND n % 109 <> 0)
                      OR (kind <> 'STOCK_RESERVED' AND n % 113 = 0)
                    THEN strftime(ts + INTERVAL 24 HOURS, '%Y-%m-%dT%H:%M:%S.%fZ')
               END AS reservation_expires_at,
               'mock_order_service' AS source,
               'inventory-events' AS kafka_topic,
               u % 3 AS kafka_partition,
               pos AS kafka_offset,
               ts AS kafka_timestamp
        FROM sent"""),
    "timed": (["raw"], """
        SELECT *, try_strptime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') AS event_timestamp,
               try_strptime(event_time, '%Y-%m-%dT%H:%M:%S.%fZ') + INTERVAL 7 HOURS
                   AS business_timestamp
        FROM raw"""),
    "typed": (["timed"], """
        SELECT *,
               CAST(event_timestamp AS DATE) AS event_date,
               hour(event_timestamp) AS event_hour,
               CAST(business_timestamp AS DATE) AS business_date,
               hour(business_timestamp) AS business_hour,
               CASE event_type
                    WHEN 'STOCK_RESERVED' THEN -quantity
                    WHEN 'COD_CONFIRMED' THEN -quantity
                    WHEN 'PAYMENT_CONFIRMED' THEN 0
                    WHEN 'BOGUS' THEN NULL
                    ELSE quantity END AS movement_qty,
               CASE WHEN event_id IS NULL THEN 'missing_event_id'
                    WHEN event_timestamp IS NULL THEN 'invalid_event_time'
                    WHEN quantity IS NULL THEN 'missing_quantity'
                    WHEN quantity <= 0 THEN 'invalid_quantity'
                    WHEN event_type = 'BOGUS' THEN 'invalid_event_type'
                    WHEN event_type = 'STOCK_RESERVED'
                         AND NOT (payment_method = 'E_WALLET' AND payment_status = 'PENDING')
                        THEN 'invalid_stock_reserved_payment_logic'
                    WHEN event_type = 'PAYMENT_CONFIRMED'
                         AND NOT (payment_method = 'E_WALLET' AND payment_status = 'PAID')
                        THEN 'invalid_payment_confirmed_logic'
                    WHEN event_type = 'RESERVATION_EXPIRED'
                         AND NOT (payment_method = 'E_WALLET' AND payment_status = 'EXPIRED')
                        THEN 'invalid_reservation_expired_logic'
                    WHEN event_type = 'COD_CONFIRMED'
                         AND NOT (payment_method = 'COD' AND payment_status = 'COD_CONFIRMED')
                        THEN 'invalid_cod_confirmed_logic'
                    WHEN event_type = 'ORDER_CANCELLED'
                         AND NOT (payment_method IN ('COD', 'E_WALLET')
                                  AND payment_status = 'CANCELLED')
                        THEN 'invalid_order_cancelled_logic'
               END AS invalid_reason
        FROM timed"""),
    "valid": (["typed"], "SELECT * FROM typed WHERE invalid_reason IS NULL"),
    # Gold: valid first, then the first arrival per day, campaign and id.
    "moves": (["valid"], """
        SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY business_date, campaign_id, event_id
                ORDER BY kafka_partition, kafka_offset) AS copy
            FROM valid) WHERE copy = 1"""),
    "net": (["moves"], """
        SELECT business_date, campaign_id, sku_id, warehouse_id,
               CAST(sum(movement_qty) AS BIGINT) AS net_movement_qty,
               count(*) AS event_count,
               CAST(sum(CASE WHEN event_type = 'STOCK_RESERVED' THEN quantity ELSE 0 END) AS BIGINT) AS reserved_qty,
               CAST(sum(CASE WHEN event_type = 'COD_CONFIRMED' THEN quantity ELSE 0 END) AS BIGINT) AS cod_sold_qty,
               CAST(sum(CASE WHEN event_type = 'ORDER_CANCELLED' THEN quantity ELSE 0 END) AS BIGINT) AS cancelled_qty,
               CAST(sum(CASE WHEN event_type = 'RESERVATION_EXPIRED' THEN quantity ELSE 0 END) AS BIGINT) AS expired_qty,
               CAST(sum(CASE WHEN event_type = 'RETURN_RECEIVED' THEN quantity ELSE 0 END) AS BIGINT) AS returned_qty,
               CAST(sum(CASE WHEN event_type = 'STOCK_REPLENISHED' THEN quantity ELSE 0 END) AS BIGINT) AS replenished_qty,
               CAST(sum(CASE WHEN event_type <> 'STOCK_REPLENISHED' THEN movement_qty ELSE 0 END) AS BIGINT) AS sales_movement_qty
        FROM moves GROUP BY ALL"""),
    # Stream: the first arrival consumes the id, valid or not.
    "firsts": (["typed"], """
        SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY event_id ORDER BY kafka_partition, kafka_offset) AS copy
            FROM typed WHERE event_id IS NOT NULL) WHERE copy = 1"""),
    "stock_keys": ([], """
        SELECT DISTINCT 'CAMP_' || (event_id % 2) AS campaign_id,
               'SKU_' || (user_id % 10) AS sku_id,
               'WH_' || (user_id % 3) AS warehouse_id,
               user_id % 10 AS s
        FROM events"""),
    "inventory": (["stock_keys"], """
        SELECT campaign_id || '#' || sku_id || '#' || warehouse_id AS inventory_key,
               campaign_id, sku_id, warehouse_id, 'Product ' || s AS product_name,
               20 + 7 * s AS stock, CAST(15 AS BIGINT) AS threshold
        FROM stock_keys WHERE s <> 9"""),
    "promotions": (["stock_keys"], """
        SELECT campaign_id || '#PROMO_' || s || '#' || sku_id || '#' || warehouse_id
                   AS promotion_key,
               campaign_id, 'PROMO_' || s AS promotion_id, sku_id, warehouse_id,
               'Promotion ' || s AS promotion_name, CAST(100 AS BIGINT) AS promotion_quota,
               CAST(10 AS DOUBLE) AS sale_price, CAST(15 AS DOUBLE) AS normal_price,
               TIMESTAMP '2024-01-05 00:00:00' AS start_time,
               TIMESTAMP '2024-01-20 00:00:00' AS end_time
        FROM stock_keys WHERE s <> 8"""),
    "classed": (["typed", "promotions"], """
        SELECT e.*, p.sale_price, p.normal_price,
               CASE WHEN NOT (e.promotion_applied AND e.promotion_id IS NOT NULL)
                        THEN 'NOT_APPLIED'
                    WHEN p.promotion_key IS NULL THEN 'UNKNOWN'
                    WHEN e.event_timestamp BETWEEN p.start_time AND p.end_time THEN 'ACTIVE'
                    ELSE 'OUTSIDE' END AS promotion_class
        FROM typed e LEFT JOIN promotions p
          ON p.campaign_id = e.campaign_id AND p.promotion_id = e.promotion_id
         AND p.sku_id = e.sku_id AND p.warehouse_id = e.warehouse_id"""),
    "priced": (["classed"], """
        SELECT * REPLACE (
            CASE WHEN promotion_class IN ('NOT_APPLIED', 'ACTIVE') THEN promotion_id END
                AS promotion_id,
            CASE WHEN promotion_class IN ('OUTSIDE', 'UNKNOWN') THEN false
                 ELSE promotion_applied END AS promotion_applied,
            CASE promotion_class WHEN 'ACTIVE' THEN sale_price
                                 WHEN 'OUTSIDE' THEN normal_price
                                 ELSE unit_price END AS unit_price)
        FROM classed"""),
    "ledger": (["firsts", "inventory"], """
        SELECT e.*, i.inventory_key, i.threshold,
               i.stock + sum(e.movement_qty) OVER (
                   PARTITION BY e.campaign_id, e.sku_id, e.warehouse_id
                   ORDER BY e.kafka_partition, e.kafka_offset
                   ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS level
        FROM firsts e LEFT JOIN inventory i USING (campaign_id, sku_id, warehouse_id)
        WHERE e.invalid_reason IS NULL"""),
    "history": (["ledger"], """
        SELECT inventory_key, event_id, campaign_id, sku_id, warehouse_id,
               event_timestamp AS event_time, business_timestamp, business_date,
               event_type, quantity, movement_qty,
               level - movement_qty AS previous_sellable_stock,
               level AS current_sellable_stock,
               CASE WHEN level < 0 THEN 'OVERSELL' WHEN level <= threshold THEN 'LOW_STOCK'
                    ELSE 'NORMAL' END AS status,
               kafka_partition, kafka_offset
        FROM ledger WHERE inventory_key IS NOT NULL"""),
    "latest": (["history"], """
        SELECT * FROM (
            SELECT *, row_number() OVER (
                PARTITION BY business_date, campaign_id, sku_id, warehouse_id
                ORDER BY kafka_partition DESC, kafka_offset DESC) AS back
            FROM history) WHERE back = 1"""),
    "velocity": (["valid"], """
        SELECT campaign_id, sku_id, warehouse_id, promotion_id,
               time_bucket(INTERVAL 5 MINUTES, business_timestamp) AS window_start,
               count(order_id) AS order_count,
               CAST(sum(quantity) AS BIGINT) AS sold_qty
        FROM valid WHERE event_type IN ('STOCK_RESERVED', 'COD_CONFIRMED')
        GROUP BY ALL"""),
    "snapshots": (["typed"], """
        SELECT DISTINCT business_date, campaign_id, sku_id, warehouse_id,
               'Product ' || substr(sku_id, 5) AS product_name,
               20 + 7 * CAST(substr(sku_id, 5) AS BIGINT) AS opening_sellable_stock
        FROM typed WHERE business_date IS NOT NULL"""),
    "summary": (["snapshots", "net"], """
        SELECT s.business_date AS summary_date, s.campaign_id, s.sku_id, s.warehouse_id,
               s.product_name, s.opening_sellable_stock,
               coalesce(reserved_qty, 0) AS total_reserved_qty,
               coalesce(cod_sold_qty, 0) AS total_cod_sold_qty,
               coalesce(cancelled_qty, 0) AS total_cancelled_qty,
               coalesce(expired_qty, 0) AS total_expired_qty,
               coalesce(returned_qty, 0) AS total_returned_qty,
               coalesce(replenished_qty, 0) AS total_replenished_qty,
               coalesce(sales_movement_qty, 0) AS sales_movement_qty,
               coalesce(net_movement_qty, 0) AS net_movement_qty,
               s.opening_sellable_stock + coalesce(replenished_qty, 0)
                   + coalesce(sales_movement_qty, 0) AS closing_sellable_stock,
               coalesce(event_count, 0) AS event_count
        FROM snapshots s LEFT JOIN net m
          ON m.business_date = s.business_date AND m.campaign_id = s.campaign_id
         AND m.sku_id = s.sku_id AND m.warehouse_id = s.warehouse_id"""),
    "recon": (["snapshots", "net", "latest"], """
        SELECT s.business_date AS recon_date, s.campaign_id, s.sku_id, s.warehouse_id,
               s.opening_sellable_stock,
               coalesce(m.net_movement_qty, 0) AS net_movement_qty,
               s.opening_sellable_stock + coalesce(m.net_movement_qty, 0)
                   AS batch_recomputed_sellable_stock,
               CAST(coalesce(l.current_sellable_stock, s.opening_sellable_stock) AS BIGINT)
                   AS streaming_sellable_stock,
               CAST(s.opening_sellable_stock + coalesce(m.net_movement_qty, 0)
                   - coalesce(l.current_sellable_stock, s.opening_sellable_stock) AS BIGINT)
                   AS diff_qty,
               CASE WHEN coalesce(m.event_count, 0) > 0 AND l.event_id IS NULL
                        THEN 'NO_STREAMING_STATE'
                    WHEN s.opening_sellable_stock + coalesce(m.net_movement_qty, 0)
                       = coalesce(l.current_sellable_stock, s.opening_sellable_stock)
                        THEN 'MATCH'
                    ELSE 'MISMATCH' END AS status
        FROM snapshots s
        LEFT JOIN net m
          ON m.business_date = s.business_date AND m.campaign_id = s.campaign_id
         AND m.sku_id = s.sku_id AND m.warehouse_id = s.warehouse_id
        LEFT JOIN latest l
          ON l.business_date = s.business_date AND l.campaign_id = s.campaign_id
         AND l.sku_id = s.sku_id AND l.warehouse_id = s.warehouse_id"""),
}


def _with(stage_names: list[str], select: str) -> str:
    """A statement with the given stages and all they read."""
    needed: set[str] = set()

    def need(name: str) -> None:
        if name not in needed:
            for parent in STAGES[name][0]:
                need(parent)
            needed.add(name)

    for name in stage_names:
        need(name)
    if not needed:
        return select
    stages = ", ".join(
        f"{name} AS ({sql})" for name, (_, sql) in STAGES.items() if name in needed
    )
    return f"WITH {stages} {select}"


_EVENT = """event_id, campaign_id, event_time, event_type, order_id, sku_id,
    warehouse_id, quantity, unit_price, promotion_id, promotion_applied, payment_method,
    payment_status, reservation_expires_at, source"""

_KEY = "campaign_id || '|' || sku_id || '|' || warehouse_id"

_BRONZE = f"""
    SELECT {_KEY} AS kafka_key, event_type AS json_event_type, kafka_topic, kafka_partition,
           kafka_offset, {_text('kafka_timestamp')},
           CAST(event_date AS VARCHAR) AS event_date_utc, event_hour AS event_hour_utc
    FROM typed"""

_SILVER = f"""
    SELECT event_id, campaign_id, {_text('event_timestamp')}, {_text('business_timestamp')},
           event_type, order_id, sku_id, warehouse_id, quantity, unit_price, promotion_id,
           promotion_applied, payment_method, payment_status, reservation_expires_at, source,
           movement_qty, invalid_reason IS NULL AS is_valid_event, invalid_reason,
           {_KEY} AS kafka_key, kafka_topic, kafka_partition, kafka_offset,
           {_text('kafka_timestamp')}, CAST(event_date AS VARCHAR) AS event_date, event_hour,
           CAST(business_date AS VARCHAR) AS business_date, business_hour
    FROM typed"""

_INVALID = f"""
    SELECT event_id, campaign_id, {_text('event_timestamp')}, {_text('business_timestamp')},
           event_type, sku_id, warehouse_id, false AS is_valid_event, invalid_reason,
           {_KEY} AS kafka_key, kafka_topic, kafka_partition, kafka_offset,
           CAST(event_date AS VARCHAR) AS event_date, event_hour,
           'INVALID_EVENT' AS alert_type,
           CAST(business_date AS VARCHAR) AS business_date, business_hour
    FROM typed WHERE invalid_reason IS NOT NULL"""

_VELOCITY = f"""
    SELECT campaign_id, sku_id, warehouse_id, promotion_id, {_text('window_start')},
           strftime(window_start + INTERVAL 5 MINUTES, '{INSTANT}') AS window_end,
           CAST(5 AS BIGINT) AS window_size_minutes, order_count, sold_qty,
           CAST(CAST(window_start AS DATE) AS VARCHAR) AS window_date,
           hour(window_start) AS window_hour
    FROM velocity"""

_SCOPES = f"""
    SELECT campaign_id || '#' || sku_id || '#' || warehouse_id || '#'
               || coalesce(promotion_id, 'NO_PROMOTION') AS velocity_scope,
           campaign_id, sku_id, warehouse_id,
           coalesce(promotion_id, 'NO_PROMOTION') AS promotion_id, {_text('window_start')},
           strftime(window_start + INTERVAL 5 MINUTES, '{INSTANT}') AS window_end,
           CAST(5 AS BIGINT) AS window_size_minutes, order_count, sold_qty,
           CAST(CAST(window_start AS DATE) AS VARCHAR) AS window_date,
           hour(window_start) AS window_hour
    FROM velocity"""

_HISTORY = f"""
    SELECT inventory_key, event_id, campaign_id, sku_id, warehouse_id, {_text('event_time')},
           {_text('business_timestamp')}, CAST(business_date AS VARCHAR) AS business_date,
           event_type, quantity, movement_qty,
           CAST(previous_sellable_stock AS BIGINT) AS previous_sellable_stock,
           CAST(current_sellable_stock AS BIGINT) AS current_sellable_stock, status,
           kafka_partition, kafka_offset
    FROM history"""

_CURRENT = f"""
    SELECT i.inventory_key, i.campaign_id, i.sku_id, i.warehouse_id, i.product_name,
           i.stock AS initial_sellable_stock,
           CAST(coalesce(h.current_sellable_stock, i.stock) AS BIGINT) AS current_sellable_stock,
           i.threshold AS low_stock_threshold,
           coalesce(h.status, CASE WHEN i.stock < 0 THEN 'OVERSELL'
                                   WHEN i.stock <= i.threshold THEN 'LOW_STOCK'
                                   ELSE 'NORMAL' END) AS status,
           h.event_id AS last_event_id,
           strftime(h.event_time, '{INSTANT}') AS last_event_time
    FROM inventory i LEFT JOIN (
        SELECT *, row_number() OVER (
            PARTITION BY inventory_key ORDER BY kafka_partition DESC, kafka_offset DESC) AS back
        FROM history) h ON h.inventory_key = i.inventory_key AND h.back = 1"""

_ALERTS = """
    SELECT campaign_id, 'INVALID_EVENT' AS alert_type, sku_id, warehouse_id,
           CAST(NULL AS BIGINT) AS current_sellable_stock, event_id,
           'Malformed Kafka message or JSON parse failed: missing event_id' AS message,
           kafka_partition, kafka_offset
    FROM typed WHERE event_id IS NULL
    UNION ALL
    SELECT campaign_id, 'INVALID_EVENT', sku_id, warehouse_id, NULL, event_id, invalid_reason,
           kafka_partition, kafka_offset
    FROM firsts WHERE invalid_reason IS NOT NULL
    UNION ALL
    SELECT campaign_id, 'UNKNOWN_SKU', sku_id, warehouse_id, NULL, event_id,
           'Inventory item not found in DynamoDB current inventory table',
           kafka_partition, kafka_offset
    FROM ledger WHERE inventory_key IS NULL
    UNION ALL
    SELECT campaign_id, status, sku_id, warehouse_id, CAST(current_sellable_stock AS BIGINT),
           event_id,
           CASE status WHEN 'OVERSELL' THEN 'Oversell' ELSE 'Low stock' END
               || ' detected. Current sellable stock='
               || CAST(current_sellable_stock AS BIGINT),
           kafka_partition, kafka_offset
    FROM history WHERE status <> 'NORMAL'
    UNION ALL
    SELECT e.campaign_id, 'UNKNOWN_PROMOTION', e.sku_id, e.warehouse_id, NULL, e.event_id,
           'Promotion item not found in DynamoDB promotion metrics table',
           e.kafka_partition, e.kafka_offset
    FROM firsts e
    WHERE e.invalid_reason IS NULL AND e.promotion_applied AND e.promotion_id IS NOT NULL
      AND e.event_type IN ('STOCK_RESERVED', 'COD_CONFIRMED', 'ORDER_CANCELLED',
                           'RESERVATION_EXPIRED')
      AND NOT EXISTS (SELECT 1 FROM promotions p
                      WHERE p.campaign_id = e.campaign_id AND p.promotion_id = e.promotion_id
                        AND p.sku_id = e.sku_id AND p.warehouse_id = e.warehouse_id)"""

_PROMOTIONS = f"""
    SELECT p.promotion_key, p.campaign_id, p.promotion_id, p.sku_id, p.warehouse_id,
           p.promotion_name, p.promotion_quota,
           CAST(coalesce(sum(e.quantity) FILTER (
               e.event_type IN ('STOCK_RESERVED', 'COD_CONFIRMED')), 0) AS BIGINT)
               AS promotion_consumed_qty,
           CAST(coalesce(sum(e.quantity) FILTER (
               e.event_type IN ('ORDER_CANCELLED', 'RESERVATION_EXPIRED')), 0) AS BIGINT)
               AS promotion_cancelled_qty,
           p.sale_price, p.normal_price,
           strftime(p.start_time, '{INSTANT}') AS start_time,
           strftime(p.end_time, '{INSTANT}') AS end_time
    FROM promotions p LEFT JOIN firsts e
      ON e.campaign_id = p.campaign_id AND e.promotion_id = p.promotion_id
     AND e.sku_id = p.sku_id AND e.warehouse_id = p.warehouse_id
     AND e.invalid_reason IS NULL AND e.promotion_applied
    GROUP BY ALL"""

_SUMMARY = """
    SELECT * REPLACE (CAST(summary_date AS VARCHAR) AS summary_date) FROM summary"""

_SLICE = " WHERE summary_date = DATE '2024-01-15' AND campaign_id = 'CAMP_1'"

_MONTHLY = """
        , ranked AS (
            SELECT *, CAST(date_trunc('month', summary_date) AS DATE) AS month_date,
                   row_number() OVER (
                       PARTITION BY date_trunc('month', summary_date), campaign_id, sku_id,
                                    warehouse_id ORDER BY summary_date) AS first_row,
                   row_number() OVER (
                       PARTITION BY date_trunc('month', summary_date), campaign_id, sku_id,
                                    warehouse_id ORDER BY summary_date DESC) AS last_row
            FROM {facts})
        SELECT CAST(month_date AS VARCHAR) AS month_date, campaign_id, sku_id, warehouse_id,
               max(product_name) FILTER (last_row = 1) AS product_name,
               CAST(sum(total_reserved_qty) AS BIGINT) AS total_reserved_qty,
               CAST(sum(total_cod_sold_qty) AS BIGINT) AS total_cod_sold_qty,
               CAST(sum(total_cancelled_qty) AS BIGINT) AS total_cancelled_qty,
               CAST(sum(total_expired_qty) AS BIGINT) AS total_expired_qty,
               CAST(sum(total_returned_qty) AS BIGINT) AS total_returned_qty,
               CAST(sum(total_replenished_qty) AS BIGINT) AS total_replenished_qty,
               CAST(sum(sales_movement_qty) AS BIGINT) AS total_sales_movement_qty,
               CAST(sum(net_movement_qty) AS BIGINT) AS total_net_movement_qty,
               CAST(sum(event_count) AS BIGINT) AS total_event_count,
               max(opening_sellable_stock) FILTER (first_row = 1)
                   AS first_opening_sellable_stock,
               max(closing_sellable_stock) FILTER (last_row = 1)
                   AS latest_closing_sellable_stock
        FROM ranked GROUP BY ALL"""

# The latest window is the one to 25 January: it starts last and, of two, ends last.
_WINDOWS = """
        , windows(nth, sale, start_time, end_time) AS (VALUES
            (1, 10, TIMESTAMP '2024-01-05 00:00:00', TIMESTAMP '2024-01-20 00:00:00'),
            (2, 8, TIMESTAMP '2024-01-10 00:00:00', TIMESTAMP '2024-01-12 00:00:00'),
            (3, 7, TIMESTAMP '2024-01-18 12:00:00', TIMESTAMP '2024-01-22 00:00:00'),
            (4, 9, TIMESTAMP '2024-01-18 12:00:00', TIMESTAMP '2024-01-25 00:00:00')),
        looked_up AS (
            SELECT e.*, coalesce(e.promotion_applied AND e.promotion_id IS NOT NULL, false) AS promotional,
                   p.promotion_key IS NOT NULL AS known,
                   (SELECT max_by(w.sale, w.nth) FROM windows w
                    WHERE p.promotion_key IS NOT NULL
                      AND e.event_timestamp BETWEEN w.start_time AND w.end_time) AS sale,
                   coalesce(e.event_timestamp BETWEEN TIMESTAMP '2024-01-18 12:00:00'
                                AND TIMESTAMP '2024-01-25 00:00:00', false) AS in_last
            FROM typed e LEFT JOIN promotions p
              ON p.campaign_id = e.campaign_id AND p.promotion_id = e.promotion_id
             AND p.sku_id = e.sku_id AND p.warehouse_id = e.warehouse_id)"""

_RECON = "SELECT * REPLACE (CAST(recon_date AS VARCHAR) AS recon_date) FROM recon"

ORACLE: dict[str, str] = {
    "parse_events": _with(["raw"], f"""
        SELECT {_KEY} AS kafka_key, {_EVENT}, kafka_partition, kafka_offset FROM raw"""),
    "event_times": _with(["typed"], f"""
        SELECT kafka_partition, kafka_offset, {_text('event_timestamp')},
               CAST(event_date AS VARCHAR) AS event_date, event_hour,
               {_text('business_timestamp')},
               CAST(business_date AS VARCHAR) AS business_date, business_hour
        FROM typed"""),
    "movement_qty": _with(["typed"], """
        SELECT kafka_partition, kafka_offset, event_type, quantity, movement_qty FROM typed"""),
    "validation": _with(["typed"], """
        SELECT kafka_partition, kafka_offset, event_id,
               invalid_reason IS NULL AS is_valid_event, invalid_reason FROM typed"""),
    "invalid_reason_counts": _with(["typed"], """
        SELECT coalesce(invalid_reason, 'VALID') AS reason, count(*) AS events
        FROM typed GROUP BY 1"""),
    "bronze_rows": _with(["typed"], _BRONZE),
    "silver_movements": _with(["typed"], _SILVER),
    "silver_invalid": _with(["typed"], _INVALID),
    "payment_rule_violations": _with(["raw"], """
        SELECT kafka_partition, kafka_offset, event_type, payment_method, payment_status,
               CASE WHEN event_type = 'BOGUS' THEN 'unknown_event_type'
                    ELSE 'payment_mismatch' END AS violation
        FROM raw
        WHERE NOT coalesce(CASE event_type
            WHEN 'STOCK_RESERVED' THEN payment_method = 'E_WALLET' AND payment_status = 'PENDING'
            WHEN 'PAYMENT_CONFIRMED' THEN payment_method = 'E_WALLET' AND payment_status = 'PAID'
            WHEN 'RESERVATION_EXPIRED'
                THEN payment_method = 'E_WALLET' AND payment_status = 'EXPIRED'
            WHEN 'COD_CONFIRMED'
                THEN payment_method = 'COD' AND payment_status = 'COD_CONFIRMED'
            WHEN 'ORDER_CANCELLED'
                THEN payment_method IN ('COD', 'E_WALLET') AND payment_status = 'CANCELLED'
            WHEN 'BOGUS' THEN false
            ELSE payment_method = 'NOT_APPLICABLE' AND payment_status = 'NOT_APPLICABLE'
            END, false)"""),
    "contract_audit": _with(["typed"], """
        , broken AS (
            SELECT event_type = 'BOGUS' AS unknown_event_type,
                   event_type NOT IN ('BOGUS', 'RETURN_RECEIVED', 'STOCK_REPLENISHED')
                       AND order_id IS NULL AS order_id_required,
                   event_type = 'STOCK_REPLENISHED' AND order_id IS NOT NULL
                       AS order_id_forbidden,
                   event_type <> 'BOGUS' AND NOT coalesce(CASE
                       WHEN event_type = 'STOCK_RESERVED'
                           THEN payment_method = 'E_WALLET' AND payment_status = 'PENDING'
                       WHEN event_type = 'PAYMENT_CONFIRMED'
                           THEN payment_method = 'E_WALLET' AND payment_status = 'PAID'
                       WHEN event_type = 'RESERVATION_EXPIRED'
                           THEN payment_method = 'E_WALLET' AND payment_status = 'EXPIRED'
                       WHEN event_type = 'COD_CONFIRMED'
                           THEN payment_method = 'COD' AND payment_status = 'COD_CONFIRMED'
                       WHEN event_type = 'ORDER_CANCELLED'
                           THEN payment_method IN ('COD', 'E_WALLET')
                                AND payment_status = 'CANCELLED'
                       ELSE payment_method = 'NOT_APPLICABLE'
                            AND payment_status = 'NOT_APPLICABLE' END, false)
                       AS payment_mismatch,
                   quantity IS NULL OR quantity <= 0 AS quantity_not_positive,
                   CASE WHEN event_type = 'STOCK_RESERVED'
                        THEN event_timestamp + INTERVAL 24 HOURS END
                       IS DISTINCT FROM
                       try_strptime(reservation_expires_at, '%Y-%m-%dT%H:%M:%S.%fZ')
                       AS reservation_expiry
            FROM typed)
        SELECT 'unknown_event_type' AS rule, count(*) FILTER (unknown_event_type) AS violations
        FROM broken
        UNION ALL SELECT 'order_id_required', count(*) FILTER (order_id_required) FROM broken
        UNION ALL SELECT 'order_id_forbidden', count(*) FILTER (order_id_forbidden) FROM broken
        UNION ALL SELECT 'payment_mismatch', count(*) FILTER (payment_mismatch) FROM broken
        UNION ALL SELECT 'quantity_not_positive', count(*) FILTER (quantity_not_positive)
        FROM broken
        UNION ALL SELECT 'reservation_expiry', count(*) FILTER (reservation_expiry)
        FROM broken"""),
    "kafka_record_encode": _with(["raw"], f"""
        SELECT {_KEY} AS key, count(*) AS records, count(DISTINCT event_type) AS event_types
        FROM raw GROUP BY 1"""),
    "dead_letter": _with(["raw"], """
        SELECT 'Failed to produce event: missing sku_id' AS error_message, event_time,
               event_type, warehouse_id, order_id
        FROM raw WHERE event_id IS NULL"""),
    "dedup_valid_movements": _with(["moves"], """
        SELECT event_id, CAST(business_date AS VARCHAR) AS business_date, campaign_id, sku_id,
               warehouse_id, kafka_partition, kafka_offset, event_type, quantity, movement_qty
        FROM moves"""),
    "processed_events": _with(["firsts"], f"""
        SELECT event_id, campaign_id, strftime(event_timestamp, '{INSTANT}') AS event_time,
               event_type, sku_id, warehouse_id, kafka_topic, kafka_partition, kafka_offset
        FROM firsts"""),
    "net_movement_by_day": _with(["net"], """
        SELECT * REPLACE (CAST(business_date AS VARCHAR) AS business_date) FROM net"""),
    "sales_velocity_5m": _with(["velocity"], _VELOCITY),
    "velocity_scope_rows": _with(["velocity"], _SCOPES),
    "state_history": _with(["history"], _HISTORY),
    "history_ids": _with(["history"], """
        SELECT event_id, sha256('history#' || event_id) AS history_id FROM history"""),
    "current_inventory": _with(["history", "inventory"], _CURRENT),
    "alerts": _with(["history", "ledger", "promotions"], _ALERTS),
    "promotion_metrics": _with(["promotions", "firsts"], _PROMOTIONS),
    "promotion_window": _with(["priced"], """
        SELECT kafka_partition, kafka_offset, event_id, promotion_class, promotion_id,
               promotion_applied, unit_price
        FROM priced"""),
    "register_items": _with(["firsts"], """
        SELECT kafka_partition, kafka_offset,
               '{' || concat_ws(',',
                   '"event_id":"' || event_id || '"', '"campaign_id":"' || campaign_id || '"',
                   '"event_type":"' || event_type || '"', '"quantity":' || quantity,
                   '"promotion_id":"' || promotion_id || '"',
                   strftime(event_timestamp, '"event_time":"%Y-%m-%dT%H:%M:%S.%fZ"')) || '}' AS item
        FROM firsts"""),
    "promotion_windows_overlapping": _with(["typed", "promotions"], _WINDOWS + """
        SELECT kafka_partition, kafka_offset, event_id,
               CASE WHEN NOT promotional THEN 'NOT_APPLIED' WHEN NOT known THEN 'UNKNOWN'
                    WHEN sale IS NOT NULL THEN 'ACTIVE' ELSE 'OUTSIDE' END AS promotion_class,
               CASE WHEN NOT promotional OR sale IS NOT NULL THEN promotion_id END AS promotion_id,
               promotion_applied AND (NOT promotional OR sale IS NOT NULL) AS promotion_applied,
               CASE WHEN NOT promotional OR NOT known THEN unit_price
                    WHEN sale IS NOT NULL THEN sale ELSE 14 END AS unit_price
        FROM looked_up"""),
    "promotion_window_repeated_keys": _with(["typed", "promotions"], _WINDOWS + """
        SELECT kafka_partition, kafka_offset,
               CASE WHEN NOT promotional THEN 'NOT_APPLIED' WHEN NOT known THEN 'UNKNOWN'
                    WHEN in_last THEN 'ACTIVE' ELSE 'OUTSIDE' END AS promotion_class,
               CASE WHEN NOT promotional OR (known AND in_last) THEN promotion_id END AS promotion_id,
               CASE WHEN NOT promotional OR NOT known THEN unit_price
                    WHEN in_last THEN 9 ELSE 14 END AS unit_price
        FROM looked_up"""),
    "outgoing_records": _with(["priced"], f"""
        SELECT {_KEY} AS key, event_id, event_time, event_type, order_id, promotion_id,
               promotion_applied, unit_price
        FROM priced"""),
    "latest_state_by_day": _with(["latest"], f"""
        SELECT CAST(business_date AS VARCHAR) AS business_date, campaign_id, sku_id,
               warehouse_id,
               CAST(current_sellable_stock AS BIGINT) AS streaming_sellable_stock,
               status AS streaming_status, event_id AS last_event_id,
               strftime(event_time, '{INSTANT}') AS last_event_time
        FROM latest"""),
    "reconciliation": _with(["recon"], _RECON),
    "daily_summary": _with(["summary"], _SUMMARY),
    "duplicate_keys": _with(["valid"], """
        SELECT CAST(business_date AS VARCHAR) AS business_date, campaign_id, event_id,
               count(*) AS duplicate_count
        FROM valid GROUP BY ALL HAVING count(*) > 1"""),
    "merge_daily_summary": _with(["summary"], """
        , older AS (
            SELECT * REPLACE (CAST(0 AS BIGINT) AS closing_sellable_stock,
                              CAST(0 AS BIGINT) AS event_count)
            FROM summary WHERE sku_id <> 'SKU_3'),
        newer AS (SELECT * FROM summary WHERE sku_id <> 'SKU_5'),
        merged AS (
            SELECT * FROM newer
            UNION ALL
            SELECT o.* FROM older o ANTI JOIN newer n
                USING (summary_date, campaign_id, sku_id, warehouse_id))
        SELECT * REPLACE (CAST(summary_date AS VARCHAR) AS summary_date) FROM merged"""),
    "merge_reconciliation": _with(["recon"], """
        , older AS (
            SELECT * REPLACE (CAST(0 AS BIGINT) AS streaming_sellable_stock,
                              CAST(0 AS BIGINT) AS diff_qty)
            FROM recon WHERE sku_id <> 'SKU_3'),
        newer AS (SELECT * FROM recon WHERE sku_id <> 'SKU_5'),
        merged AS (
            SELECT * FROM newer
            UNION ALL
            SELECT o.* FROM older o ANTI JOIN newer n
                USING (recon_date, campaign_id, sku_id, warehouse_id))
        SELECT * REPLACE (CAST(recon_date AS VARCHAR) AS recon_date) FROM merged"""),
    "gold_job": _with(["recon"], _RECON),
    "mart_job": _with(["summary"], _SUMMARY),
    "gold_job_slice": _with(["summary"], _SUMMARY + _SLICE),
    "mart_job_slice": _with(["summary"], _SUMMARY + _SLICE),
    "mart_job_reload": _with(["summary"], """
        , days AS (
            SELECT CAST(summary_date AS VARCHAR) AS business_date, campaign_id,
                   count(*) AS rows,
                   summary_date = DATE '2024-01-15' AND campaign_id = 'CAMP_1' AS lost
            FROM summary GROUP BY ALL)
        SELECT business_date, campaign_id, rows AS n, 'mart' AS what FROM days
        UNION ALL
        SELECT business_date, campaign_id, rows, 'staged' FROM days WHERE NOT lost
        UNION ALL
        SELECT business_date, campaign_id, CASE WHEN lost THEN rows ELSE 2 * rows END,
               'logged' FROM days"""),
    "load_failure_audit": _with(["summary"], """
        SELECT 'redshift_gold_load_all_all_daily_inventory_summary' AS load_id,
               'redshift_gold_load' AS pipeline_name,
               'staging.daily_inventory_summary_stg' AS target_staging_table,
               'mart.fact_daily_inventory_summary' AS target_mart_table,
               CAST(NULL AS VARCHAR) AS business_date, CAST(NULL AS VARCHAR) AS campaign_id,
               CAST(0 AS BIGINT) AS rows_loaded, 'FAILED' AS status,
               'Duplicate keys in daily_inventory_summary_stg, date=None, campaign_id=None: '
                   || 'duplicate_key_count=' || count(*) AS error_message
        FROM summary"""),
    "load_audit": _with(["snapshots"], """
        SELECT 'redshift_gold_load_all_all_' || d.name AS load_id,
               'redshift_gold_load' AS pipeline_name,
               'staging.' || d.staging AS target_staging_table,
               'mart.' || d.fact AS target_mart_table,
               CAST(s.business_date AS VARCHAR) AS business_date, s.campaign_id,
               count(*) AS rows_loaded, 'SUCCESS' AS status,
               CAST(NULL AS VARCHAR) AS error_message
        FROM snapshots s, (VALUES
            ('daily_inventory_summary', 'daily_inventory_summary_stg',
             'fact_daily_inventory_summary'),
            ('inventory_reconciliation', 'reconciliation_result_stg',
             'fact_reconciliation_result')) AS d(name, staging, fact)
        GROUP BY ALL"""),
    "inventory_dashboard": _with(["summary"], _SUMMARY),
    "reconciliation_dashboard": _with(["recon"], _RECON),
    "reconciliation_summary": _with(["recon"], """
        SELECT CAST(recon_date AS VARCHAR) AS recon_date, campaign_id, status,
               count(*) AS sku_warehouse_count,
               CAST(sum(abs(coalesce(diff_qty, 0))) AS BIGINT) AS total_abs_diff_qty
        FROM recon GROUP BY ALL"""),
    "monthly_summary": _with(["summary"], _MONTHLY.format(facts="summary")),
    "monthly_view_incremental": _with(["summary"], """
        , older AS (
            SELECT * REPLACE (CAST(0 AS BIGINT) AS event_count) FROM summary WHERE sku_id <> 'SKU_3'),
        newer AS (
            SELECT * FROM summary WHERE sku_id <> 'SKU_5' AND summary_date >= DATE '2024-01-20'),
        merged AS (
            SELECT * FROM newer
            UNION ALL
            SELECT o.* FROM older o ANTI JOIN newer n
                USING (summary_date, campaign_id, sku_id, warehouse_id))"""
        + _MONTHLY.format(facts="merged")),
    "reconciliation_view_incremental": _with(["recon"], """
        , older AS (
            SELECT * REPLACE (CAST(0 AS BIGINT) AS diff_qty) FROM recon WHERE sku_id <> 'SKU_3'),
        newer AS (
            SELECT * FROM recon WHERE sku_id <> 'SKU_5' AND recon_date >= DATE '2024-01-20'),
        merged AS (
            SELECT * FROM newer
            UNION ALL
            SELECT o.* FROM older o ANTI JOIN newer n
                USING (recon_date, campaign_id, sku_id, warehouse_id))
        SELECT CAST(recon_date AS VARCHAR) AS recon_date, campaign_id, status,
               count(*) AS sku_warehouse_count,
               CAST(sum(abs(coalesce(diff_qty, 0))) AS BIGINT) AS total_abs_diff_qty
        FROM merged GROUP BY ALL"""),
    "seed_inventory": _with(["inventory"], """
        SELECT inventory_key, campaign_id, sku_id, warehouse_id, product_name,
               stock AS initial_sellable_stock, stock AS current_sellable_stock,
               threshold AS low_stock_threshold,
               CASE WHEN stock < 0 THEN 'OVERSELL' WHEN stock <= threshold THEN 'LOW_STOCK'
                    ELSE 'NORMAL' END AS status,
               CAST(NULL AS VARCHAR) AS last_event_id, CAST(NULL AS VARCHAR) AS last_event_time
        FROM inventory"""),
    "seed_promotions": _with(["promotions"], f"""
        SELECT promotion_key, campaign_id, promotion_id, sku_id, warehouse_id, promotion_name,
               promotion_quota, CAST(0 AS BIGINT) AS promotion_consumed_qty,
               CAST(0 AS BIGINT) AS promotion_cancelled_qty, sale_price, normal_price,
               {_text('start_time')}, {_text('end_time')}
        FROM promotions"""),
    "opening_snapshot": _with(["inventory"], """
        SELECT '2024-01-01' AS snapshot_date, campaign_id, sku_id, warehouse_id, product_name,
               stock AS opening_sellable_stock, threshold AS low_stock_threshold
        FROM inventory"""),
    "stream_bronze": _with(["typed"], _BRONZE),
    "stream_silver": _with(["typed"], _SILVER),
    "stream_invalid": _with(["typed"], _INVALID),
    "stream_velocity": _with(["velocity"], _VELOCITY + """
        WHERE window_start + INTERVAL 5 MINUTES <= (
            SELECT max(business_timestamp) - INTERVAL 7 MINUTES FROM valid
            WHERE event_type IN ('STOCK_RESERVED', 'COD_CONFIRMED'))"""),
    "stream_velocity_upsert": _with(["velocity"], _SCOPES),
    "stream_velocity_compacted": _with(["velocity"], _SCOPES),
    "stream_late_sales": _with(["valid"], f"""
        , sales AS (
            SELECT *, CASE WHEN kafka_offset >= 1000000000 THEN 2
                           WHEN kafka_offset <= (SELECT (min(event_id) + max(event_id)) // 2 FROM events)
                               THEN 0 ELSE 1 END AS delivery
            FROM valid WHERE event_type IN ('STOCK_RESERVED', 'COD_CONFIRMED')),
        marked AS (
            SELECT *, (SELECT max(e.business_timestamp) FROM sales e WHERE e.delivery < s.delivery)
                          AS watermark
            FROM sales s)
        SELECT kafka_partition, kafka_offset, event_id, {_text('business_timestamp')},
               {_text('watermark')}
        FROM marked
        WHERE time_bucket(INTERVAL 5 MINUTES, business_timestamp) + INTERVAL 5 MINUTES
              <= watermark - INTERVAL 7 MINUTES"""),
    "stream_bounded_dedupe": _with(["typed"], """
        SELECT kafka_partition, kafka_offset, event_id, event_type FROM typed
        WHERE kafka_offset < 1000000000 OR event_id IS NULL
           OR kafka_timestamp < (SELECT max(kafka_timestamp) FROM typed
                                 WHERE kafka_offset < 1000000000) - INTERVAL 10 DAYS"""),
    "stream_history_packed": _with(["history"], _HISTORY),
    "stream_state": _with(["history", "inventory"], _CURRENT),
    "stream_history": _with(["history"], _HISTORY),
    "stream_alerts": _with(["history", "ledger", "promotions"], _ALERTS),
    "stream_history_one_batch": _with(["history"], _HISTORY),
    "stream_alerts_one_batch": _with(["history", "ledger", "promotions"], _ALERTS),
    "stream_promotions": _with(["promotions", "firsts"], _PROMOTIONS),
}
ORACLE["seed_inventory_csv"] = ORACLE["seed_inventory"]
ORACLE["seed_promotions_csv"] = ORACLE["seed_promotions"]

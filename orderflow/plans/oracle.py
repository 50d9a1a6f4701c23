"""The SQL each query is checked against."""

from __future__ import annotations

from orderflow.plans.queries import OLD, WAVE, WAVES
from orderflow.plans.views import EVENT_ORDERS, SHOP_ORDERS, view_sql
from orderflow.schema import ORDER_COLS

SRC = f"src AS ({view_sql('events', EVENT_ORDERS)})"
SHOP = f"shop AS ({view_sql('orders', SHOP_ORDERS)})"
WIRE = """wire AS (
  SELECT order_id, customer_name, restaurant_name, item, amount, order_status,
    strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at,
    date_trunc('second', created_at) AS created_at_timestamp,
    CAST(created_at AS DATE) AS date
  FROM src)"""
OK = "ok AS (SELECT * FROM wire WHERE order_id IS NOT NULL AND amount > 0)"
POLLED = "polled AS (SELECT * FROM ok WHERE created_at IS NOT NULL)"

EVENT_COLS = ", ".join(ORDER_COLS)
NO_EVENT = ", ".join(["NULL"] * 7)
REASON = (
    "CASE WHEN order_id IS NULL THEN 'null_order_id' WHEN amount IS NULL THEN 'null_amount' "
    "ELSE 'non_positive_amount' END"
)
READBACK_COLS = "order_id, customer_name, amount, order_status, date"


def _with(*parts: str) -> str:
    return f"WITH {', '.join(parts)} "


def registered() -> dict[str, str]:
    src, shop = _with(SRC), _with(SHOP)
    wire, ok, polled = _with(SRC, WIRE), _with(SRC, WIRE, OK), _with(SRC, WIRE, OK, POLLED)
    per_date = (
        ok + "SELECT date, count(*) AS n, "
        "CAST(sum(TRY_CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS amt, "
        "count(*) FILTER (TRY_CAST(amount AS DECIMAL(18,2)) IS NULL) AS n_left_out "
        "FROM ok GROUP BY date"
    )
    position = (
        "SELECT *, row_number() OVER (ORDER BY created_at, order_id NULLS FIRST) AS pos "
        "FROM {0} WHERE created_at IS NOT NULL"
    )
    newest = (
        "FROM {0} WHERE created_at IS NOT NULL "
        "ORDER BY created_at DESC, order_id NULLS FIRST LIMIT {1}"
    )
    wave = WAVE.replace("created_at", "created_at_timestamp")
    return {
        "incremental_scan": src
        + "SELECT * FROM src WHERE created_at > TIMESTAMP '2024-01-15 00:00:00'",
        "incremental_scan_epoch": src
        + "SELECT * FROM src WHERE created_at > TIMESTAMP '1970-01-01 00:00:00'",
        "incremental_scan_ties": shop
        + "SELECT * FROM shop WHERE created_at > TIMESTAMP '1995-06-17 00:00:00'",
        "high_watermark": src
        + "SELECT max(created_at) AS hi, count(*) AS n FROM src "
        "WHERE created_at > TIMESTAMP '1970-01-01 00:00:00'",
        "increment_ordered": src + position.format("src"),
        "increment_ordered_ties": shop + position.format("shop"),
        "increment_file_order": _with(SRC, SHOP)
        + " UNION ALL ".join(
            f"SELECT '{name}' AS source, n, first_at, first_id, last_at, last_id, "
            "CAST(0 AS BIGINT) AS rows_out_of_order, CAST(0 AS BIGINT) AS files_that_overlap FROM ("
            "SELECT count(*) AS n, first(created_at ORDER BY created_at, order_id NULLS FIRST) AS first_at, "
            "first(order_id ORDER BY created_at, order_id NULLS FIRST) AS first_id, "
            "last(created_at ORDER BY created_at, order_id NULLS FIRST) AS last_at, "
            "last(order_id ORDER BY created_at, order_id NULLS FIRST) AS last_id "
            f"FROM {view} WHERE created_at IS NOT NULL)"
            for name, view in (("events", "src"), ("orders", "shop"))
        ),
        "incremental_scan_cursor": shop
        + ", placed AS (SELECT *, row_number() OVER (ORDER BY created_at, order_id NULLS FIRST) - 1 AS place, "
        "CAST(ceil(count(*) OVER () / 7) AS BIGINT) AS size FROM shop WHERE created_at IS NOT NULL) "
        "SELECT order_id, customer_name, restaurant_name, item, CAST(amount AS DOUBLE) AS amount, order_status, "
        "strftime(created_at, '%Y-%m-%dT%H:%M:%SZ') AS created_at, place // size AS poll FROM placed",
        "empty_increment": src
        + "SELECT count(*) AS n FROM src "
        "WHERE created_at > (SELECT max(created_at) FROM src)",
        "watermark_state": src + "SELECT max(created_at) AS hi, count(created_at) AS n FROM src",
        "wire_encode": wire + f"SELECT {EVENT_COLS} FROM wire",
        "wire_decode": wire + f"SELECT {EVENT_COLS} FROM wire",
        "parse_created_at": wire + "SELECT * FROM wire",
        "clean_orders": ok + "SELECT * FROM ok",
        "clean_count": ok + "SELECT count(*) AS n FROM ok",
        "rejects_by_reason": src
        + f"SELECT {REASON} AS reason, count(*) AS n FROM src "
        "WHERE order_id IS NULL OR amount IS NULL OR amount <= 0 GROUP BY 1",
        "lake_append_by_date": ok + "SELECT * FROM ok",
        "lake_readback": ok + f"SELECT {READBACK_COLS} FROM ok",
        "lake_count": ok + "SELECT count(*) AS n FROM ok",
        "lake_partition_prune": ok + "SELECT * FROM ok WHERE date = DATE '2024-01-20'",
        "point_lookup": ok + f"SELECT {READBACK_COLS} FROM ok WHERE order_id IN (102, 103)",
        "lake_file_count": ok
        + "SELECT date, count(*) AS n, count(DISTINCT order_id % 3) AS n_files FROM ok GROUP BY date",
        "lake_compacted": ok + "SELECT *, CAST(1 AS BIGINT) AS n_files FROM ok",
        "reconcile_source_lake": ok
        + "SELECT date, count(*) FILTER (item <> 'purchase') AS n_source, "
        "count(*) FILTER (item <> 'signup') + count(*) FILTER (item = 'click') AS n_lake, "
        "count(*) FILTER (item = 'signup') AS missing, "
        "count(*) FILTER (item = 'purchase') AS unexpected, "
        "count(*) FILTER (item = 'click') AS repeated FROM ok GROUP BY date",
        "lake_stream_append": ok + "SELECT * FROM ok",
        "lake_incremental_two_waves": polled + "SELECT * FROM polled",
        "stream_rate_limited": ok + f"SELECT *, {wave} AS batch FROM ok",
        "stream_gathered": ok.replace("WITH ", "WITH RECURSIVE ", 1)
        + f", sized AS (SELECT wave, n, ceil(sum(n) OVER () * 2 / 5) AS least FROM (SELECT w.i AS wave, "
        f"count(date_or_id) AS n FROM range({WAVES}) w(i) LEFT JOIN "
        f"(SELECT {wave} AS wave, 1 AS date_or_id FROM ok) o ON o.wave = w.i GROUP BY w.i)), "
        "steps AS (SELECT CAST(-1 AS BIGINT) AS wave, CAST(0 AS DOUBLE) AS held, CAST(0 AS BIGINT) AS number "
        "UNION ALL SELECT s.wave, CASE WHEN held + n >= least THEN 0 ELSE held + n END, "
        "CASE WHEN held + n >= least THEN number + 1 ELSE number END "
        "FROM steps JOIN sized s ON s.wave = steps.wave + 1), "
        # A wave belongs to the batch that begins after the last one handed on before it.
        "handed AS (SELECT s.wave, coalesce((SELECT max(number) FROM steps b WHERE b.wave = s.wave - 1), 0) AS number "
        "FROM steps s WHERE s.wave >= 0), "
        "named AS (SELECT number, max(wave) AS batch FROM handed JOIN sized USING (wave) WHERE n > 0 GROUP BY number) "
        f"SELECT o.*, batch FROM ok o JOIN handed ON handed.wave = {wave} JOIN named USING (number)",
        "topic_gap": ok
        + f"SELECT CAST(1 AS BIGINT) AS n_lost, count(*) AS n_stored FROM ok WHERE {wave} < {WAVES - 1}",
        "unique_replay_batch": ok
        + f"SELECT *, CAST(CASE WHEN {wave} < 2 THEN 0 ELSE 1 END AS BIGINT) AS batch FROM ok",
        "quarantined_batch": ok
        + f"SELECT {EVENT_COLS.replace('created_at', f"CASE WHEN {OLD} THEN '0900-01-01T00:00:00Z' ELSE created_at END AS created_at")}, "
        f"{OLD} AS refused FROM ok",
        "late_commits": polled + "SELECT * FROM polled",
        "reject_table": wire
        + f"SELECT {EVENT_COLS}, {REASON} AS reason, CAST(order_id AS VARCHAR) AS text_id, amount AS text_amount, "
        "created_at AS text_created_at, customer_name AS text_customer, CAST(NULL AS VARCHAR) AS value FROM wire "
        "WHERE order_id IS NULL OR amount IS NULL OR amount <= 0 "
        f"UNION ALL SELECT {NO_EVENT}, 'null_order_id', NULL, NULL, NULL, NULL, props FROM events "
        f"UNION ALL SELECT {NO_EVENT}, 'null_order_id', NULL, NULL, NULL, NULL, event_type FROM events",
        "insert_defaults": shop
        + "SELECT order_id, customer_name, restaurant_name, item, CAST(amount AS DOUBLE) AS amount, order_status, "
        "CASE WHEN order_id % 7 <> 0 THEN CAST(created_at AS TIMESTAMP) END AS created_at, "
        "order_id % 7 = 0 AS defaulted FROM shop",
        "dedup_replay": polled + "SELECT * FROM polled",
        "orders_per_date": per_date,
        "revenue_per_date": per_date,
        "distinct_dates": ok + "SELECT DISTINCT date FROM ok",
        "total_orders": src + "SELECT count(*) AS total_orders FROM src",
        "order_gate": src
        + "SELECT CAST(limits.n AS BIGINT) AS at_least, count(*) AS total_orders, count(*) >= limits.n AS passed "
        "FROM src, (VALUES (10), (1000000000)) limits(n) GROUP BY limits.n",
        "latest_orders_topk": src + "SELECT * " + newest.format("src", 5),
        "latest_orders_top3": src
        + "SELECT order_id, customer_name, restaurant_name, item, amount, order_status "
        + newest.format("src", 3),
        "latest_orders_ties": shop + "SELECT * " + newest.format("shop", 5),
        "status_violations": src
        + "SELECT order_status, count(*) AS n FROM src WHERE order_status NOT IN "
        "('PLACED', 'PREPARING', 'DELIVERED', 'CANCELLED') GROUP BY order_status",
        "null_violations": src
        + "SELECT count(*) FILTER (customer_name IS NULL) AS customer_name, "
        "count(*) FILTER (restaurant_name IS NULL) AS restaurant_name, "
        "count(*) FILTER (item IS NULL) AS item, count(*) FILTER (amount IS NULL) AS amount, "
        "count(*) FILTER (order_status IS NULL) AS order_status FROM src",
        "never_polled": src
        + "SELECT count(*) FILTER (created_at IS NULL) AS never_polled FROM src",
    }

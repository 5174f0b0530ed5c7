"""DuckDB oracle SQL for the streaming jobs: the batch result each stream
must reach once all input is processed."""

from __future__ import annotations

from emporium.oracle.adapter_sql import AS_OF_SQL
from emporium.oracle.batch_sql import _P01
from emporium.oracle.changes_sql import SQL as T

SQL: dict[str, str] = {}

SQL["st_order_velocity"] = """
SELECT user_id AS customer_id, ws AS window_start, ws + INTERVAL 24 HOUR AS window_end,
       CAST(count(*) AS BIGINT) AS order_count
FROM (SELECT user_id, TIMESTAMP '1970-01-01 00:00:00' + to_seconds(CAST(floor(epoch(ts) / 86400) * 86400 AS BIGINT)) AS ws
      FROM events WHERE event_type = 'purchase') x
GROUP BY user_id, ws HAVING count(*) >= 2"""

SQL["st_price_log"] = T["chg_price_log"]
SQL["st_status_log"] = T["chg_order_status_log"]
SQL["st_customer_audit"] = T["chg_customer_audit"]

SQL["st_low_stock"] = _P01 + f""",
mv AS (
    SELECT id_producto AS product_id, {AS_OF_SQL} - INTERVAL 1 DAY AS ts, CAST(0 AS BIGINT) AS seq,
           CAST(stock AS BIGINT) AS delta, 'open' AS kind FROM productos
    UNION ALL
    SELECT r.id_producto, r.ts, r.request_id, -CAST(r.cantidad AS BIGINT), 'sale'
    FROM order_requests r JOIN acc a ON a.request_id = r.request_id),
run AS (SELECT mv.*, sum(delta) OVER (PARTITION BY product_id ORDER BY ts, seq) AS after FROM mv)
SELECT product_id, ts, CAST(after AS BIGINT) AS stock_after FROM run
WHERE kind = 'sale' AND after - delta > 15 AND after <= 15"""

SQL["st_daily_sales"] = """
SELECT CAST(fecha_venta AS DATE) AS day, CAST(sum(total) AS DECIMAL(14,2)) AS total_sold,
       CAST(count(*) AS BIGINT) AS order_count
FROM ventas WHERE estado <> 'Cancelado' GROUP BY 1"""

# ST2: gap sessions per user (an event more than 3 days after the previous
# one opens a new session; exactly 3 days still merges, as Spark's
# session_window does); a session is emitted once the final watermark
# (latest click - 1 hour) has reached its end (last click + 3 days).
SQL["st_cart_abandonment"] = """
WITH ev AS (SELECT user_id, ts FROM events WHERE event_type = 'click'),
marked AS (
    SELECT user_id, ts,
           CASE WHEN lag(ts) OVER (PARTITION BY user_id ORDER BY ts) IS NULL
                  OR ts > lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 3 DAY THEN 1 ELSE 0 END AS opens
    FROM ev),
numbered AS (
    SELECT user_id, ts, sum(opens) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid
    FROM marked),
sessions AS (
    SELECT user_id AS customer_id, min(ts) AS session_start, max(ts) + INTERVAL 3 DAY AS session_end,
           CAST(count(*) AS BIGINT) AS clicks, max(ts) AS last_click
    FROM numbered GROUP BY user_id, sid)
SELECT * FROM sessions
WHERE session_end <= (SELECT max(ts) - INTERVAL 1 HOUR FROM ev)"""

# ST2 with conversions: the closed sessions (the final watermark is the lesser
# of both event kinds') without a purchase from the last click to the end.
SQL["st_open_carts"] = SQL["st_cart_abandonment"].replace(
    "(SELECT max(ts) - INTERVAL 1 HOUR FROM ev)",
    "(SELECT least(max(ts) FILTER (event_type = 'click'), max(ts) FILTER (event_type = 'purchase')) - INTERVAL 1 HOUR FROM events)") + """
  AND NOT EXISTS (SELECT 1 FROM events p WHERE p.event_type = 'purchase' AND p.user_id = sessions.customer_id
                  AND p.ts BETWEEN sessions.last_click AND sessions.session_end)"""

# ST1 sliding: every purchase lies in four windows of an hour that begin every
# quarter of an hour, five minutes past; the event clock runs 96 times as fast.
SQL["st_order_velocity_sliding"] = """
WITH p AS (SELECT user_id, epoch_us(ts) // 96 AS made FROM events WHERE event_type = 'purchase'),
w AS (SELECT user_id, ((made - 300000000) // 900000000 - k) * 900000000 + 300000000 AS ws
      FROM p, (SELECT unnest([0, 1, 2, 3]) AS k) s)
SELECT user_id AS customer_id, make_timestamp(ws) AS window_start, make_timestamp(ws) + INTERVAL 1 HOUR AS window_end,
       CAST(count(*) AS BIGINT) AS order_count
FROM w GROUP BY user_id, ws HAVING count(*) >= 5"""

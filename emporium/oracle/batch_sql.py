"""DuckDB oracle SQL for the request-batch jobs (P write).  The per-key
sequential decisions are recursive CTEs that walk the requests one by one,
which is the reference's row-at-a-time semantics."""

from __future__ import annotations

from emporium.oracle.sqlkit import EMAIL_RE, TIER, fold
from emporium.plans import batch as B

SQL: dict[str, str] = {}


def q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_P01 = f"""
WITH RECURSIVE req AS (
    SELECT r.*, c.activo AS cact,
           CASE WHEN r.cantidad <= 0 THEN {q(B.MSG_QTY)} WHEN c.activo IS NULL THEN {q(B.MSG_NO_CUSTOMER)}
                WHEN c.activo = 0 THEN {q(B.MSG_INACTIVE)} END AS why
    FROM order_requests r LEFT JOIN clientes c ON c.id_cliente = r.id_cliente),
pass AS (
    SELECT req.*, row_number() OVER (PARTITION BY id_producto ORDER BY ts, request_id) AS rn
    FROM req WHERE why IS NULL AND id_producto IN (SELECT id_producto FROM productos WHERE activo = 1)),
fold(id_producto, rn, remaining, request_id, accepted) AS (
    SELECT p.id_producto, CAST(0 AS BIGINT), CAST(p.stock AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BOOLEAN)
    FROM productos p WHERE p.activo = 1 AND p.id_producto IN (SELECT id_producto FROM pass)
    UNION ALL
    SELECT f.id_producto, s.rn,
           CASE WHEN s.cantidad <= f.remaining THEN f.remaining - s.cantidad ELSE f.remaining END,
           s.request_id, s.cantidad <= f.remaining
    FROM fold f JOIN pass s ON s.id_producto = f.id_producto AND s.rn = f.rn + 1),
dec AS (
    SELECT request_id, false AS accepted, why AS reason FROM req WHERE why IS NOT NULL
    UNION ALL
    SELECT request_id, accepted, CASE WHEN accepted THEN NULL ELSE {q(B.MSG_NO_STOCK)} END FROM fold WHERE rn > 0
    UNION ALL
    SELECT request_id, false, {q(B.MSG_NO_STOCK)} FROM req
    WHERE why IS NULL AND id_producto NOT IN (SELECT id_producto FROM productos WHERE activo = 1)),
acc AS (
    SELECT r.request_id, r.id_producto, r.cantidad, p.precio,
           (SELECT max(id_venta) FROM ventas) + r.request_id + 1 AS id_venta
    FROM order_requests r JOIN dec d ON d.request_id = r.request_id AND d.accepted
    JOIN productos p ON p.id_producto = r.id_producto)"""

SQL["bat_orders"] = _P01 + """
SELECT d.request_id, d.accepted, d.reason, a.id_venta AS order_id,
       CAST(a.cantidad * a.precio AS DECIMAL(12,2)) AS order_total
FROM dec d LEFT JOIN acc a ON a.request_id = d.request_id"""

SQL["bat_orders_stock"] = _P01 + """
SELECT p.id_producto AS product_id, CAST(p.stock - COALESCE(s.q, 0) AS BIGINT) AS stock,
       CAST(p.total_vendido + COALESCE(s.q, 0) AS BIGINT) AS total_sold
FROM productos p LEFT JOIN (SELECT id_producto, sum(cantidad) AS q FROM acc GROUP BY 1) s ON s.id_producto = p.id_producto"""

SQL["bat_new_products"] = f"""
WITH checked AS (
    SELECT r.*, COALESCE(r.id_categoria, 1) AS cat,
           CASE WHEN r.precio <= 0 THEN {q(B.MSG_PRICE)} WHEN r.costo < 0 OR r.stock < 0 THEN {q(B.MSG_COST_STOCK)}
                WHEN r.nombre IS NULL OR r.precio IS NULL OR r.costo IS NULL OR r.stock IS NULL THEN {q(B.MSG_NULL)}
                WHEN COALESCE(r.id_categoria, 1) NOT IN (SELECT id_categoria FROM categorias)
                  OR r.id_proveedor NOT IN (SELECT id_proveedor FROM proveedores) THEN {q(B.MSG_FOREIGN_KEY)}
                WHEN {fold('r.nombre')} IN (SELECT {fold('nombre')} FROM productos) THEN {q(B.MSG_DUPLICATE_NAME)} END AS wrong
    FROM product_requests r),
ruled AS (
    SELECT *, CASE WHEN wrong IS NULL AND row_number() OVER (PARTITION BY {fold('nombre')}, wrong IS NULL
                                                             ORDER BY ts, request_id) > 1
                   THEN {q(B.MSG_DUPLICATE_NAME)} ELSE wrong END AS why,
           (SELECT max(id_producto) FROM productos) + request_id + 1 AS new_id
    FROM checked)
SELECT request_id, why IS NULL AS accepted, why AS reason, CASE WHEN why IS NULL THEN new_id END AS product_id,
       CASE WHEN why IS NULL THEN cat END AS id_categoria,
       CASE WHEN why IS NULL THEN 'SKU-' || CASE WHEN kind IS NULL OR strlen(upper(left(kind, 3))) < 3
            THEN 'GEN' ELSE upper(left(kind, 3)) END || '-' || lpad(CAST(new_id AS VARCHAR), 4, '0') END AS sku
FROM ruled LEFT JOIN (SELECT id_categoria AS cat, nombre AS kind FROM categorias) AS kinds USING (cat)"""

SQL["bat_address_updates"] = f"""
SELECT r.request_id, c.id_cliente IS NOT NULL AS accepted,
       CASE WHEN c.id_cliente IS NULL THEN {q(B.MSG_NO_CUSTOMER)} END AS reason
FROM address_requests r LEFT JOIN clientes c ON c.id_cliente = r.id_cliente"""

SQL["bat_address_state"] = """
SELECT id_cliente AS customer_id, direccion_envio, ciudad, pais FROM (
    SELECT r.*, row_number() OVER (PARTITION BY r.id_cliente ORDER BY r.ts DESC, r.request_id DESC) AS k
    FROM address_requests r WHERE r.id_cliente IN (SELECT id_cliente FROM clientes)) x WHERE k = 1"""

SQL["bat_address_audit"] = """
SELECT customer_id, 'direccion_envio' AS field, old_value, new_value, modified_at FROM (
    SELECT r.id_cliente AS customer_id,
           COALESCE(lag(r.direccion_envio) OVER (PARTITION BY r.id_cliente ORDER BY r.ts, r.request_id),
                    c.direccion_envio) AS old_value,
           r.direccion_envio AS new_value, r.ts AS modified_at
    FROM address_requests r JOIN clientes c ON c.id_cliente = r.id_cliente) x
WHERE old_value IS DISTINCT FROM new_value"""

_P04 = f"""
WITH RECURSIVE req AS (
    SELECT r.*, v.estado, v.total AS vtotal, v.id_cliente, d.cantidad AS bought, COALESCE(dv.done, 0) AS done,
           CASE WHEN r.cantidad IS NULL OR r.cantidad <= 0 THEN {q(B.MSG_RETURN_QTY)}
                WHEN v.estado IS NULL THEN {q(B.MSG_NO_ORDER_RETURN)}
                WHEN v.estado <> 'Entregado' THEN {q(B.MSG_NOT_DELIVERED)}
                WHEN d.cantidad IS NULL THEN {q(B.MSG_NOT_IN_ORDER)} END AS why
    FROM return_requests r LEFT JOIN ventas v ON v.id_venta = r.id_venta
    LEFT JOIN detalle_ventas d ON d.id_venta = r.id_venta AND d.id_producto = r.id_producto
    LEFT JOIN (SELECT id_venta, id_producto, sum(cantidad) AS done FROM devoluciones GROUP BY 1, 2) dv
           ON dv.id_venta = r.id_venta AND dv.id_producto = r.id_producto),
pass AS (SELECT req.*, row_number() OVER (PARTITION BY id_venta, id_producto ORDER BY ts, request_id) AS rn
         FROM req WHERE why IS NULL),
fold(id_venta, id_producto, rn, remaining, request_id, accepted) AS (
    SELECT DISTINCT id_venta, id_producto, CAST(0 AS BIGINT), CAST(bought - done AS BIGINT), CAST(NULL AS BIGINT),
           CAST(NULL AS BOOLEAN) FROM pass
    UNION ALL
    SELECT f.id_venta, f.id_producto, p.rn,
           CASE WHEN p.cantidad <= f.remaining THEN f.remaining - p.cantidad ELSE f.remaining END,
           p.request_id, p.cantidad <= f.remaining
    FROM fold f JOIN pass p ON p.id_venta = f.id_venta AND p.id_producto = f.id_producto AND p.rn = f.rn + 1),
acc AS (SELECT p.* FROM pass p JOIN fold f ON f.request_id = p.request_id AND f.accepted),
run AS (SELECT a.*, COALESCE((SELECT sum(cantidad) FROM devoluciones d WHERE d.id_venta = a.id_venta), 0)
                    + sum(a.cantidad) OVER (PARTITION BY a.id_venta ORDER BY a.ts, a.request_id) AS ret,
               (SELECT sum(cantidad) FROM detalle_ventas d WHERE d.id_venta = a.id_venta) AS tb
        FROM acc a),
closing AS (SELECT id_venta, min((ts, request_id)) AS cl FROM run WHERE ret >= tb GROUP BY id_venta),
dec AS (
    SELECT request_id, false AS accepted, why AS reason FROM req WHERE why IS NOT NULL
    UNION ALL
    SELECT p.request_id,
           CASE WHEN c.cl IS NOT NULL AND (p.ts, p.request_id) > c.cl THEN false ELSE f.accepted END,
           CASE WHEN c.cl IS NOT NULL AND (p.ts, p.request_id) > c.cl THEN {q(B.MSG_NOT_DELIVERED)}
                WHEN NOT f.accepted THEN {q(B.MSG_RETURN_EXCEEDS)} END
    FROM pass p JOIN fold f ON f.request_id = p.request_id LEFT JOIN closing c ON c.id_venta = p.id_venta)"""

SQL["bat_returns"] = _P04 + "\nSELECT * FROM dec"
SQL["bat_returns_cancelled"] = _P04 + """
SELECT c.id_venta AS order_id, v.id_cliente, v.total FROM closing c JOIN ventas v ON v.id_venta = c.id_venta"""
SQL["bat_returns_stock"] = _P04 + """
SELECT p.id_producto AS product_id, CAST(p.stock + s.q AS BIGINT) AS stock,
       CAST(greatest(0, p.total_vendido - s.q) AS BIGINT) AS total_sold
FROM productos p JOIN (SELECT r.id_producto, sum(r.cantidad) AS q FROM return_requests r
                       JOIN dec d ON d.request_id = r.request_id AND d.accepted GROUP BY 1) s
     ON s.id_producto = p.id_producto"""

_P06 = f"""
WITH RECURSIVE req AS (
    SELECT r.*, CASE WHEN r.ajuste IS NULL OR r.ajuste = 0 THEN {q(B.MSG_ADJ_ZERO)}
                     WHEN p.id_producto IS NULL THEN {q(B.MSG_ADJ_NO_PRODUCT)} END AS why
    FROM stock_adjust_requests r LEFT JOIN productos p ON p.id_producto = r.id_producto),
pass AS (SELECT req.*, row_number() OVER (PARTITION BY id_producto ORDER BY ts, request_id) AS rn
         FROM req WHERE why IS NULL),
fold(id_producto, rn, bal, request_id, accepted) AS (
    SELECT p.id_producto, CAST(0 AS BIGINT), CAST(p.stock AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS BOOLEAN)
    FROM productos p WHERE p.id_producto IN (SELECT id_producto FROM pass)
    UNION ALL
    SELECT f.id_producto, s.rn, CASE WHEN f.bal + s.ajuste >= 0 THEN f.bal + s.ajuste ELSE f.bal END,
           s.request_id, f.bal + s.ajuste >= 0
    FROM fold f JOIN pass s ON s.id_producto = f.id_producto AND s.rn = f.rn + 1),
dec AS (
    SELECT request_id, false AS accepted, why AS reason FROM req WHERE why IS NOT NULL
    UNION ALL
    SELECT request_id, accepted, CASE WHEN accepted THEN NULL ELSE {q(B.MSG_ADJ_NEGATIVE)} END FROM fold WHERE rn > 0)"""

SQL["bat_stock_adjust"] = _P06 + "\nSELECT * FROM dec"
SQL["bat_stock_adjust_stock"] = _P06 + """
SELECT p.id_producto AS product_id, CAST(p.stock + s.d AS BIGINT) AS stock
FROM productos p JOIN (SELECT r.id_producto, sum(r.ajuste) AS d FROM stock_adjust_requests r
                       JOIN dec ON dec.request_id = r.request_id AND dec.accepted GROUP BY 1) s
     ON s.id_producto = p.id_producto"""
SQL["bat_stock_adjust_log"] = _P06 + f"""
SELECT r.request_id, {q(B.ADJUST_TEXT)} || CAST(r.id_producto AS VARCHAR) || ': ' || CAST(r.ajuste AS VARCHAR)
           || ' unidades. Motivo: ' || r.motivo AS action, r.ts AS logged_at
FROM stock_adjust_requests r JOIN dec ON dec.request_id = r.request_id AND dec.accepted"""

SQL["bat_customer_erasure"] = f"""
SELECT r.request_id, r.id_cliente AS customer_id, c.id_cliente IS NOT NULL AS accepted,
       CASE WHEN c.id_cliente IS NULL THEN {q(B.MSG_NO_CUSTOMER)} END AS reason,
       CASE WHEN c.id_cliente IS NULL THEN NULL WHEN h.id_cliente IS NOT NULL THEN 'anonymised' ELSE 'deleted' END
           AS action,
       CASE WHEN c.id_cliente IS NOT NULL AND h.id_cliente IS NOT NULL
            THEN {q(B.ANON_EMAIL_PREFIX)} || CAST(r.id_cliente AS VARCHAR) || {q(B.ANON_EMAIL_DOMAIN)} END AS new_email,
       CASE WHEN c.id_cliente IS NULL THEN NULL
            ELSE 'Cliente id ' || CAST(r.id_cliente AS VARCHAR) ||
                 CASE WHEN h.id_cliente IS NOT NULL THEN {q(B.ERASE_ANON_TEXT)} ELSE {q(B.ERASE_DELETE_TEXT)} END
       END AS log_text
FROM erasure_requests r LEFT JOIN clientes c ON c.id_cliente = r.id_cliente
LEFT JOIN (SELECT DISTINCT id_cliente FROM ventas) h ON h.id_cliente = r.id_cliente"""

SQL["bat_category_promos"] = f"""
SELECT request_id, why IS NULL AS accepted, why AS reason, id_categoria AS category_id,
       CASE WHEN why IS NULL THEN {q(B.PROMO_NAME)} || CAST(id_categoria AS VARCHAR) END AS promotion_name,
       CASE WHEN why IS NULL THEN CAST(pct AS DECIMAL(5,2)) END AS discount_pct
FROM (SELECT r.*, CASE WHEN r.pct <= 0 OR r.pct > 100 THEN {q(B.MSG_PCT)}
                       WHEN r.fin <= r.inicio THEN {q(B.MSG_DATES)}
                       WHEN c.id_categoria IS NULL THEN {q(B.MSG_NO_CATEGORY)} END AS why
      FROM category_promo_requests r LEFT JOIN categorias c ON c.id_categoria = r.id_categoria) x"""

_P10 = f"""
WITH RECURSIVE req AS (
    SELECT r.*, v.estado AS st0,
           CASE WHEN r.nuevo_estado IS NULL OR r.nuevo_estado NOT IN
                     ('Pendiente de Pago', 'Procesando', 'Enviado', 'Entregado', 'Cancelado') THEN {q(B.MSG_BAD_STATE)}
                WHEN v.estado IS NULL THEN {q(B.MSG_NO_ORDER)} END AS why
    FROM transition_requests r LEFT JOIN ventas v ON v.id_venta = r.id_venta),
pass AS (SELECT req.*, row_number() OVER (PARTITION BY id_venta ORDER BY ts, request_id) AS rn FROM req WHERE why IS NULL),
fold(id_venta, rn, cur, request_id, nxt, accepted) AS (
    SELECT DISTINCT id_venta, CAST(0 AS BIGINT), st0, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR), CAST(NULL AS BOOLEAN)
    FROM pass
    UNION ALL
    SELECT f.id_venta, p.rn,
           CASE WHEN (f.cur = 'Pendiente de Pago' AND p.nuevo_estado IN ('Procesando', 'Cancelado'))
                  OR (f.cur = 'Procesando' AND p.nuevo_estado IN ('Enviado', 'Cancelado'))
                  OR (f.cur = 'Enviado' AND p.nuevo_estado IN ('Entregado', 'Cancelado'))
                THEN p.nuevo_estado ELSE f.cur END,
           p.request_id, p.nuevo_estado,
           (f.cur = 'Pendiente de Pago' AND p.nuevo_estado IN ('Procesando', 'Cancelado'))
             OR (f.cur = 'Procesando' AND p.nuevo_estado IN ('Enviado', 'Cancelado'))
             OR (f.cur = 'Enviado' AND p.nuevo_estado IN ('Entregado', 'Cancelado'))
    FROM fold f JOIN pass p ON p.id_venta = f.id_venta AND p.rn = f.rn + 1),
dec AS (
    SELECT request_id, false AS accepted, why AS reason FROM req WHERE why IS NOT NULL
    UNION ALL
    SELECT request_id, accepted, CASE WHEN accepted THEN NULL ELSE {q(B.MSG_TRANSITION)} END FROM fold WHERE rn > 0)"""

SQL["bat_order_transitions"] = _P10 + "\nSELECT * FROM dec"
SQL["bat_order_transitions_stock"] = _P10 + """
SELECT p.id_producto AS product_id, CAST(p.stock + s.q AS BIGINT) AS stock,
       CAST(greatest(0, p.total_vendido - s.q) AS BIGINT) AS total_sold
FROM productos p JOIN (SELECT d.id_producto, sum(d.cantidad) AS q FROM detalle_ventas d
                       WHERE d.id_venta IN (SELECT id_venta FROM fold WHERE accepted AND nxt = 'Cancelado')
                       GROUP BY 1) s ON s.id_producto = p.id_producto"""

SQL["bat_register_customers"] = f"""
SELECT request_id, why IS NULL AS accepted, why AS reason,
       CASE WHEN why IS NULL THEN upper(left(trim(nombre), 1)) || lower(substr(trim(nombre), 2)) END AS nombre,
       CASE WHEN why IS NULL THEN upper(left(trim(apellido), 1)) || lower(substr(trim(apellido), 2)) END AS apellido,
       email
FROM (SELECT r.*, CASE WHEN NOT (COALESCE(trim(r.email), '') <> '' AND regexp_matches(r.email, '{EMAIL_RE}'))
                       THEN {q(B.MSG_EMAIL)}
                       WHEN {fold('r.email')} IN (SELECT {fold('email')} FROM clientes)
                         OR row_number() OVER (PARTITION BY {fold('r.email')},
                                               (COALESCE(trim(r.email), '') <> '' AND regexp_matches(r.email, '{EMAIL_RE}'))
                                               ORDER BY r.ts, r.request_id) > 1
                       THEN {q(B.MSG_DUPLICATE_EMAIL)} END AS why
      FROM registration_requests r) x"""

_P13 = f"""
WITH checked AS (
    SELECT r.*, CASE WHEN r.primario = r.secundario THEN {q(B.MSG_SELF_MERGE)}
                     WHEN r.primario NOT IN (SELECT id_cliente FROM clientes) THEN {q(B.MSG_NO_PRIMARY)}
                     WHEN r.secundario NOT IN (SELECT id_cliente FROM clientes) THEN {q(B.MSG_NO_SECONDARY)} END AS wrong
    FROM merge_requests r),
fair AS (SELECT primario, secundario FROM checked WHERE wrong IS NULL),
dec AS (
    SELECT c.request_id, c.primario, c.secundario, c.ts,
           CASE WHEN c.wrong IS NOT NULL THEN c.wrong
                WHEN c.secundario IN (SELECT secundario FROM fair GROUP BY secundario HAVING count(*) > 1)
                  OR c.secundario IN (SELECT primario FROM fair) OR c.primario IN (SELECT secundario FROM fair)
                THEN {q(B.MSG_MERGE_CONFLICT)} END AS reason
    FROM checked c),
m AS (SELECT secundario AS sec, primario AS pri, ts, request_id FROM dec WHERE reason IS NULL)"""

SQL["bat_merge_accounts"] = _P13 + "\nSELECT request_id, reason IS NULL AS accepted, reason FROM dec"
SQL["bat_merge_customers"] = _P13 + f"""
SELECT c.* REPLACE (
         CAST(c.total_gastado + COALESCE(a.add, 0) AS DECIMAL(12,2)) AS total_gastado,
         CASE WHEN a.add IS NULL THEN c.nivel_lealtad
              ELSE {TIER.format(t='CAST(c.total_gastado + a.add AS DECIMAL(12,2))')} END AS nivel_lealtad,
         CAST(CASE WHEN mr.pri IS NOT NULL AND mr.pri = c.id_cliente THEN NULL
                   ELSE COALESCE(mr.pri, c.referido_por) END AS BIGINT) AS referido_por)
FROM clientes c
LEFT JOIN (SELECT m.pri, sum(s.total_gastado) AS add FROM m JOIN clientes s ON s.id_cliente = m.sec GROUP BY m.pri) a
       ON a.pri = c.id_cliente
LEFT JOIN m mr ON mr.sec = c.referido_por
WHERE c.id_cliente NOT IN (SELECT sec FROM m)"""
SQL["bat_merge_reviews"] = _P13 + """
SELECT id_resena, id_producto, holder AS id_cliente, calificacion, comentario, fecha_resena
FROM (SELECT r.*, COALESCE(m.pri, r.id_cliente) AS holder,
             row_number() OVER (PARTITION BY COALESCE(m.pri, r.id_cliente), r.id_producto
                                ORDER BY m.pri IS NOT NULL, m.ts, m.request_id) AS nth
      FROM resenas_productos r LEFT JOIN m ON m.sec = r.id_cliente) AS held
WHERE nth = 1"""
for _key, _table in (("orders", "ventas"), ("views", "vistas_productos"), ("carts", "carritos")):
    SQL[f"bat_merge_{_key}"] = _P13 + f"""
SELECT x.* REPLACE (COALESCE(m.pri, x.id_cliente) AS id_cliente) FROM {_table} x LEFT JOIN m ON m.sec = x.id_cliente"""

SQL["bat_assign_supplier"] = f"""
SELECT r.request_id, p.id_producto IS NOT NULL AND s.id_proveedor IS NOT NULL AS accepted,
       CASE WHEN p.id_producto IS NULL OR s.id_proveedor IS NULL THEN {q(B.MSG_NO_PRODUCT_SUPPLIER)} END AS reason,
       r.id_producto AS product_id, r.id_proveedor AS supplier_id
FROM supplier_requests r LEFT JOIN productos p ON p.id_producto = r.id_producto
LEFT JOIN proveedores s ON s.id_proveedor = r.id_proveedor"""

SQL["bat_payments"] = f"""
WITH RECURSIVE req AS (
    SELECT r.*, v.estado, v.total,
           row_number() OVER (PARTITION BY r.id_venta ORDER BY r.ts, r.request_id) AS rn
    FROM payment_requests r LEFT JOIN ventas v ON v.id_venta = r.id_venta),
fold(id_venta, rn, st, request_id, why) AS (
    SELECT DISTINCT id_venta, CAST(0 AS BIGINT), estado, CAST(NULL AS BIGINT), CAST(NULL AS VARCHAR) FROM req
    UNION ALL
    SELECT f.id_venta, r.rn,
           CASE WHEN f.st = 'Pendiente de Pago' AND NOT COALESCE(r.monto < r.total, false) THEN 'Procesando' ELSE f.st END,
           r.request_id,
           CASE WHEN f.st IS NULL THEN {q(B.MSG_NO_ORDER)} WHEN f.st <> 'Pendiente de Pago' THEN {q(B.MSG_NOT_PENDING)}
                WHEN r.monto < r.total THEN {q(B.MSG_UNDERPAID)} END
    FROM fold f JOIN req r ON r.id_venta = f.id_venta AND r.rn = f.rn + 1)
SELECT request_id, id_venta AS order_id, why IS NULL AS accepted, why AS reason FROM fold WHERE rn > 0"""

SQL["bat_review_upsert"] = f"""
SELECT COALESCE(o.id_resena, x.request_id) AS review_id, x.id_producto AS product_id, x.id_cliente AS customer_id,
       x.calificacion AS rating, x.comentario AS comment, x.ts AS reviewed_at, o.id_resena IS NULL AS inserted
FROM (SELECT r.*, row_number() OVER (PARTITION BY r.id_cliente, r.id_producto ORDER BY r.ts DESC, r.request_id DESC) AS k
      FROM review_requests r WHERE r.calificacion BETWEEN 1 AND 5
        AND r.id_producto IN (SELECT id_producto FROM productos) AND r.id_cliente IN (SELECT id_cliente FROM clientes)) x
LEFT JOIN resenas_productos o ON o.id_cliente = x.id_cliente AND o.id_producto = x.id_producto
WHERE x.k = 1"""

SQL["bat_review_decisions"] = f"""
SELECT request_id, why IS NULL AS accepted, why AS reason
FROM (SELECT request_id, CASE WHEN calificacion IS NULL OR calificacion NOT BETWEEN 1 AND 5 THEN {q(B.MSG_RATING)}
                              WHEN id_producto NOT IN (SELECT id_producto FROM productos)
                                OR id_cliente NOT IN (SELECT id_cliente FROM clientes) THEN {q(B.MSG_FOREIGN_KEY)} END AS why
      FROM review_requests) AS checked"""

_P20 = """
WITH RECURSIVE ok AS (
    SELECT r.*, row_number() OVER (ORDER BY r.ts, r.request_id) AS rn FROM category_move_requests r
    WHERE r.origen IN (SELECT id_categoria FROM categorias) AND r.destino IN (SELECT id_categoria FROM categorias)),
walk(rn, start_cat, cur, changed) AS (
    SELECT CAST(0 AS BIGINT), id_categoria, id_categoria, false FROM categorias
    UNION ALL
    SELECT m.rn, w.start_cat, CASE WHEN w.cur = m.origen THEN m.destino ELSE w.cur END,
           w.changed OR (w.cur = m.origen AND m.destino <> w.cur)
    FROM walk w JOIN ok m ON m.rn = w.rn + 1),
final AS (SELECT start_cat, cur, changed FROM walk WHERE rn = (SELECT COALESCE(max(rn), 0) FROM ok)),
moved AS (SELECT p.id_producto, COALESCE(f.cur, p.id_categoria) AS id_categoria, COALESCE(f.changed, false) AS stamped
          FROM productos p LEFT JOIN final f ON f.start_cat = p.id_categoria),
touched AS (SELECT origen AS id_categoria FROM ok UNION SELECT destino FROM ok)"""
SQL["bat_move_category"] = _P20 + """
SELECT c.id_categoria AS category_id,
       CAST(CASE WHEN c.id_categoria IN (SELECT id_categoria FROM touched)
                 THEN (SELECT count(*) FROM moved m WHERE m.id_categoria = c.id_categoria)
                 ELSE c.total_productos END AS BIGINT) AS total_products
FROM categorias c"""
SQL["bat_move_category_products"] = _P20 + """
SELECT id_producto, id_categoria, stamped FROM moved"""

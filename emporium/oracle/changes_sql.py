"""DuckDB oracle SQL for the change-feed jobs (T): written directly against
the before/after snapshots; the sequential folds use recursive CTEs."""

from __future__ import annotations

from emporium.operators.admission import REJECT_CAPACITY
from emporium.oracle.adapter_sql import AS_OF_SQL
from emporium.oracle.sqlkit import EMAIL_RE, TIER, fold

NOW = AS_OF_SQL
ACTOR = "'app@localhost'"
SQL: dict[str, str] = {}

SQL["chg_price_log"] = f"""
SELECT a.id_producto AS product_id, b.precio AS old_price, a.precio AS new_price, {NOW} AS changed_at,
       {ACTOR} AS db_user
FROM productos b JOIN productos_after a ON a.id_producto = b.id_producto WHERE b.precio <> a.precio"""

_ADMISSION = f"""
WITH RECURSIVE req AS (
    SELECT request_id, id_producto, cantidad,
           row_number() OVER (PARTITION BY id_producto ORDER BY ts, request_id) AS rn
    FROM order_requests WHERE id_producto IN (SELECT id_producto FROM productos)),
fold(id_producto, rn, remaining, request_id, cantidad, accepted) AS (
    SELECT p.id_producto, CAST(0 AS BIGINT), CAST(p.stock AS BIGINT), CAST(NULL AS BIGINT), CAST(NULL AS INTEGER),
           CAST(NULL AS BOOLEAN)
    FROM productos p WHERE p.id_producto IN (SELECT id_producto FROM req)
    UNION ALL
    SELECT f.id_producto, r.rn,
           CASE WHEN r.cantidad <= f.remaining THEN f.remaining - r.cantidad ELSE f.remaining END,
           r.request_id, r.cantidad, r.cantidad <= f.remaining
    FROM fold f JOIN req r ON r.id_producto = f.id_producto AND r.rn = f.rn + 1),
admission AS (
    SELECT request_id, id_producto AS product_id, cantidad AS quantity, accepted,
           CASE WHEN accepted THEN NULL ELSE '{REJECT_CAPACITY}' END AS reason
    FROM fold WHERE rn > 0
    UNION ALL
    SELECT request_id, id_producto, cantidad, false, '{REJECT_CAPACITY}' FROM order_requests
    WHERE id_producto NOT IN (SELECT id_producto FROM productos))"""

SQL["chg_stock_admission"] = _ADMISSION + "\nSELECT * FROM admission"

SQL["chg_stock_ledger"] = _ADMISSION + """
SELECT p.id_producto AS product_id, CAST(p.stock - COALESCE(a.q, 0) AS BIGINT) AS stock,
       CAST(p.total_vendido + COALESCE(a.q, 0) AS BIGINT) AS total_sold
FROM productos p LEFT JOIN (SELECT product_id, sum(quantity) AS q FROM admission WHERE accepted GROUP BY product_id) a
       ON a.product_id = p.id_producto"""

SQL["chg_category_delete_guard"] = """
SELECT c.id_categoria AS category_id,
       NOT EXISTS (SELECT 1 FROM productos p WHERE p.id_categoria = c.id_categoria) AS accepted,
       CASE WHEN EXISTS (SELECT 1 FROM productos p WHERE p.id_categoria = c.id_categoria)
            THEN 'No se puede eliminar una categoria con productos asociados' END AS reason
FROM categorias c"""

SQL["chg_new_customer_log"] = f"""
SELECT id_cliente AS customer_id, {ACTOR} AS db_user,
       'Nuevo cliente registrado: id ' || CAST(id_cliente AS VARCHAR) || ' email ' || email AS action,
       {NOW} AS logged_at
FROM clientes"""

SQL["chg_customer_spend"] = f"""
WITH RECURSIVE ev AS (
    SELECT a.id_cliente, a.id_venta, a.estado = 'Entregado' AS delivered, a.total AS new_total, b.total AS old_total,
           CASE WHEN a.estado = 'Entregado' THEN a.fecha_venta END AS bought,
           row_number() OVER (PARTITION BY a.id_cliente ORDER BY a.id_venta) AS rn
    FROM ventas b JOIN ventas_after a ON a.id_venta = b.id_venta
    WHERE (a.estado = 'Entregado' AND b.estado <> 'Entregado') OR (b.estado = 'Entregado' AND a.estado = 'Cancelado')),
fold(id_cliente, rn, spent) AS (
    SELECT c.id_cliente, CAST(0 AS BIGINT), CAST(c.total_gastado AS DECIMAL(14,2))
    FROM clientes c WHERE c.id_cliente IN (SELECT id_cliente FROM ev)
    UNION ALL
    SELECT f.id_cliente, e.rn,
           CAST(CASE WHEN e.delivered THEN f.spent + e.new_total ELSE greatest(0, f.spent - e.old_total) END
                AS DECIMAL(14,2))
    FROM fold f JOIN ev e ON e.id_cliente = f.id_cliente AND e.rn = f.rn + 1),
final AS (SELECT id_cliente, arg_max(spent, rn) AS spent FROM fold GROUP BY id_cliente)
SELECT f.id_cliente AS customer_id, CAST(f.spent AS DECIMAL(12,2)) AS total_spent,
       greatest(c.fecha_ultima_compra, (SELECT max(bought) FROM ev WHERE ev.id_cliente = f.id_cliente)) AS last_purchase,
       {TIER.format(t='CAST(f.spent AS DECIMAL(12,2))')} AS tier
FROM final f JOIN clientes c ON c.id_cliente = f.id_cliente"""

_CAT_SAME = " AND ".join(
    (f"{fold('b.' + c)} IS NOT DISTINCT FROM {fold('a.' + c)}" if c in ("nombre", "descripcion", "sku")
     else f"b.{c} IS NOT DISTINCT FROM a.{c}")
    for c in ("nombre", "descripcion", "precio", "costo", "sku", "activo", "id_categoria", "id_proveedor"))

SQL["chg_catalog_stamp"] = f"""
SELECT a.id_producto AS product_id, {NOW} AS modified_at
FROM productos b JOIN productos_after a ON a.id_producto = b.id_producto WHERE NOT ({_CAT_SAME})"""

SQL["chg_negative_stock"] = """
SELECT a.id_producto AS product_id, a.stock, 'El stock no puede ser negativo' AS reason
FROM productos b JOIN productos_after a ON a.id_producto = b.id_producto WHERE a.stock < 0 AND a.stock <> b.stock"""


def _cap(x):
    return (f"CASE WHEN {x} IS NULL OR strlen(trim({x})) = 0 THEN {x} "
            f"ELSE upper(left(trim({x}), 1)) || lower(substr(trim({x}), 2)) END")


SQL["chg_name_normalise"] = f"""
SELECT id_cliente AS customer_id, {_cap('nombre')} AS nombre, {_cap('apellido')} AS apellido FROM clientes"""

SQL["chg_order_total"] = """
WITH touched AS (SELECT DISTINCT id_venta FROM detalle_ventas
                 WHERE id_detalle NOT IN (SELECT id_detalle FROM detalle_ventas_after))
SELECT v.id_venta AS order_id, v.total AS old_total,
       CAST(COALESCE((SELECT sum(cantidad * precio_unitario_congelado) FROM detalle_ventas_after d
                      WHERE d.id_venta = v.id_venta), 0) AS DECIMAL(12,2)) AS new_total
FROM ventas v WHERE v.id_venta IN (SELECT id_venta FROM touched)"""

SQL["chg_order_status_log"] = f"""
SELECT a.id_venta AS order_id, {ACTOR} AS db_user,
       'Venta ' || CAST(a.id_venta AS VARCHAR) || ' cambio de estado de ' || b.estado || ' a ' || a.estado AS action,
       {NOW} AS logged_at
FROM ventas b JOIN ventas_after a ON a.id_venta = b.id_venta WHERE b.estado <> a.estado"""

SQL["chg_price_positive"] = """
SELECT id_producto AS product_id, precio AS price, 'El precio del producto debe ser mayor a cero' AS reason
FROM productos_base WHERE precio <= 0"""

SQL["chg_low_stock_alert"] = f"""
SELECT a.id_producto AS product_id, 'SISTEMA' AS db_user,
       'ALERTA stock bajo para producto id ' || CAST(a.id_producto AS VARCHAR) || ' (' || a.nombre
           || '). Stock actual: ' || CAST(a.stock AS VARCHAR) AS action,
       {NOW} AS logged_at
FROM productos b JOIN productos_after a ON a.id_producto = b.id_producto WHERE a.stock <= 15 AND b.stock > 15"""

SQL["chg_archive_orders"] = f"""
SELECT id_venta, id_cliente, fecha_venta, estado, total, {NOW} AS fecha_archivado
FROM ventas WHERE id_venta NOT IN (SELECT id_venta FROM ventas_after)"""

SQL["chg_email_valid"] = f"""
SELECT id_cliente AS customer_id, email, 'El formato del correo electronico no es valido' AS reason
FROM clientes WHERE email IS NULL OR trim(email) = '' OR NOT regexp_matches(email, '{EMAIL_RE}')"""

SQL["chg_last_order_date"] = """
SELECT c.id_cliente AS customer_id, greatest(COALESCE(c.fecha_ultima_compra, m.m), m.m) AS last_purchase
FROM (SELECT id_cliente, max(ts) AS m FROM order_requests GROUP BY id_cliente) m
JOIN clientes c ON c.id_cliente = m.id_cliente"""

SQL["chg_self_referral"] = """
SELECT a.id_cliente AS customer_id, 'Un cliente no puede referirse a si mismo' AS reason
FROM clientes b JOIN clientes_after a ON a.id_cliente = b.id_cliente
WHERE a.referido_por IS NOT NULL AND a.referido_por = a.id_cliente"""

SQL["chg_default_category"] = """
SELECT id_producto AS product_id, COALESCE(id_categoria, 1) AS id_categoria FROM productos_base"""

SQL["chg_category_count"] = f"""
WITH purged AS (SELECT id_producto, id_categoria FROM productos
                WHERE activo = 0 AND COALESCE(fecha_modificacion, fecha_creacion) < {NOW} - INTERVAL 6 MONTH
                  AND NOT EXISTS (SELECT 1 FROM detalle_ventas dv WHERE dv.id_producto = productos.id_producto)),
ins AS (SELECT COALESCE(id_categoria, 1) AS id_categoria, count(*) AS n FROM productos_base GROUP BY 1),
del AS (SELECT id_categoria, count(*) AS n FROM purged WHERE id_categoria IS NOT NULL GROUP BY 1)
SELECT c.id_categoria AS category_id,
       CAST(CASE WHEN ins.n IS NULL AND del.n IS NULL THEN 0
                 ELSE greatest(0, COALESCE(ins.n, 0) - COALESCE(del.n, 0)) END AS BIGINT) AS total_products
FROM categorias c LEFT JOIN ins ON ins.id_categoria = c.id_categoria LEFT JOIN del ON del.id_categoria = c.id_categoria"""

SQL["chg_customer_audit"] = f"""
SELECT a.id_cliente AS customer_id, 'email' AS field, b.email AS old_value, a.email AS new_value, {NOW} AS modified_at
FROM clientes b JOIN clientes_after a ON a.id_cliente = b.id_cliente WHERE b.email IS DISTINCT FROM a.email
UNION ALL
SELECT a.id_cliente, 'direccion_envio', b.direccion_envio, a.direccion_envio, {NOW}
FROM clientes b JOIN clientes_after a ON a.id_cliente = b.id_cliente
WHERE b.direccion_envio IS DISTINCT FROM a.direccion_envio"""

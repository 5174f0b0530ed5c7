"""DuckDB twin of :mod:`emporium.sources.testdata` (FIXTURES.md §2).

Each entry is one CTE over the driver's pre-registered views.  ``with_adapter``
prefixes a query with all of them; DuckDB drops the ones it does not use.
"""

from __future__ import annotations

from emporium.sources.testdata import AS_OF, AS_OF_EVENTS, BRANCHES, CATEGORY_NAMES, LINE_KEY, PROMOTIONS


def _sql_lit(v) -> str:
    if v is None:
        return "NULL"
    if isinstance(v, str):
        return "'" + v.replace("'", "''") + "'"
    return str(v)


_CATS = ", ".join(f"({i + 1}, '{n}', 'Categoria {n}')" for i, n in enumerate(CATEGORY_NAMES))
_BRANCHES = ", ".join("(" + ", ".join(_sql_lit(x) for x in r) + ")" for r in BRANCHES)
AS_OF_SQL_ = f"TIMESTAMP '{AS_OF}'"
_PROMOS = ", ".join("(" + ", ".join(_sql_lit(x) for x in r) + ")" for r in PROMOTIONS)

SKU_SQL = ("'SKU-' || CASE WHEN {cat} IS NULL OR strlen(upper(left({cat}, 3))) < 3 "
           "THEN 'GEN' ELSE upper(left({cat}, 3)) END || '-' || lpad(CAST({pid} AS VARCHAR), 4, '0')")

TIER_SQL = ("CASE WHEN {t} IS NULL OR {t} < 0 THEN 'Bronce' WHEN {t} >= 1000000.00 THEN 'Platino' "
            "WHEN {t} >= 500000.00 THEN 'Oro' WHEN {t} >= 100000.00 THEN 'Plata' ELSE 'Bronce' END")

ADAPTER: list[tuple[str, str]] = [
    ("categorias_base", f"SELECT * FROM (VALUES {_CATS}) AS t(id_categoria, nombre, descripcion)"),
    ("proveedores", """
        SELECT s_suppkey AS id_proveedor, s_name AS nombre,
               'proveedor' || CAST(s_suppkey AS VARCHAR) || '@example.com' AS email_contacto,
               '+57 300 ' || CAST(s_suppkey AS VARCHAR) AS telefono_contacto
        FROM supplier"""),
    ("sucursales", f"SELECT * FROM (VALUES {_BRANCHES}) AS t(id_sucursal, nombre, ciudad, activa)"),
    ("productos_base", f"""
        SELECT p.p_partkey AS id_producto,
               CASE WHEN p.p_partkey % 97 = 0 THEN NULL ELSE cb.id_categoria END AS id_categoria,
               CASE WHEN p.p_partkey % 89 = 0 THEN NULL ELSE p.p_partkey % (SELECT count(*) FROM supplier) END AS id_proveedor,
               p.p_name || ' ' || CAST(p.p_partkey AS VARCHAR) AS nombre,
               p.p_brand || ' ' || p.p_type AS descripcion,
               CAST(p.p_retailprice AS DECIMAL(10,2)) AS precio,
               CAST(CAST(p.p_retailprice AS DECIMAL(10,2)) - p.p_size * 10 AS DECIMAL(10,2)) AS costo,
               CAST((p.p_partkey * 7) % 61 AS INTEGER) AS stock,
               {SKU_SQL.format(cat="(CASE WHEN p.p_partkey % 97 = 0 THEN NULL ELSE cb.nombre END)", pid="p.p_partkey")} AS sku,
               TIMESTAMP '1999-01-01 00:00:00' + to_days(CAST(p.p_partkey % 900 AS INTEGER)) AS fecha_creacion,
               CAST(NULL AS TIMESTAMP) AS fecha_modificacion,
               CASE WHEN p.p_partkey % 20 = 3 THEN 0 ELSE 1 END AS activo
        FROM (SELECT * FROM part UNION ALL
              SELECT * REPLACE (p_partkey + (SELECT count(*) FROM part) AS p_partkey) FROM part WHERE p_partkey % 53 = 0) p
        LEFT JOIN categorias_base cb ON cb.nombre = p.p_type"""),
    ("detalle_ventas", f"""
        SELECT l.l_orderkey * {LINE_KEY} + l.l_partkey AS id_detalle, l.l_orderkey AS id_venta,
               l.l_partkey AS id_producto, l.cantidad,
               CAST(pb.precio - (l.l_orderkey % 10) AS DECIMAL(10,2)) AS precio_unitario_congelado
        FROM (SELECT l_orderkey, l_partkey, CAST(sum(l_quantity) AS INTEGER) AS cantidad
              FROM lineitem GROUP BY l_orderkey, l_partkey) l
        JOIN productos_base pb ON pb.id_producto = l.l_partkey"""),
    ("ventas", """
        SELECT o.o_orderkey AS id_venta, o.o_custkey AS id_cliente,
               CAST(o.o_orderkey % 3 + 1 AS INTEGER) AS id_sucursal,
               o.o_orderdate + to_seconds(CAST((o.o_orderkey * 7919) % 86400 AS BIGINT)) AS fecha_venta,
               CASE o.o_orderstatus WHEN 'F' THEN 'Entregado'
                    WHEN 'O' THEN CASE WHEN o.o_orderkey % 2 = 0 THEN 'Procesando' ELSE 'Enviado' END
                    WHEN 'P' THEN CASE WHEN o.o_orderkey % 2 = 0 THEN 'Pendiente de Pago' ELSE 'Cancelado' END
               END AS estado,
               CAST(CASE WHEN o.o_orderkey % 25 = 0 THEN CAST(o.o_totalprice AS DECIMAL(12,2))
                         ELSE COALESCE(l.s, 0) END AS DECIMAL(12,2)) AS total
        FROM orders o
        LEFT JOIN (SELECT id_venta, sum(cantidad * precio_unitario_congelado) AS s
                   FROM detalle_ventas GROUP BY id_venta) l ON l.id_venta = o.o_orderkey"""),
    ("vistas_productos", """
        SELECT event_id AS id_vista, event_id % (SELECT count(*) FROM part) AS id_producto,
               user_id AS id_cliente, ts AS fecha_vista
        FROM events WHERE event_type = 'view'"""),
    ("productos", """
        SELECT pb.*, COALESCE(s.sold, 0) AS total_vendido, COALESCE(v.views, 0) AS total_vistas
        FROM productos_base pb
        LEFT JOIN (SELECT id_producto, CAST(sum(cantidad) AS INTEGER) AS sold FROM detalle_ventas GROUP BY id_producto) s
               ON s.id_producto = pb.id_producto
        LEFT JOIN (SELECT id_producto, CAST(count(*) AS INTEGER) AS views FROM vistas_productos GROUP BY id_producto) v
               ON v.id_producto = pb.id_producto"""),
    ("categorias", """
        SELECT cb.id_categoria, cb.nombre, cb.descripcion, CAST(COALESCE(n.n, 0) AS INTEGER) AS total_productos
        FROM categorias_base cb
        LEFT JOIN (SELECT id_categoria, count(*) AS n FROM productos_base WHERE id_categoria IS NOT NULL
                   GROUP BY id_categoria) n ON n.id_categoria = cb.id_categoria"""),
    ("clientes_base", """
        SELECT c.c_custkey AS id_cliente, 'Customer' AS nombre,
               regexp_replace(c.c_name, '[^0-9]', '', 'g') AS apellido,
               'c' || CAST(c.c_custkey AS VARCHAR) || '@example.com' AS email,
               'hash_' || CAST(c.c_custkey AS VARCHAR) AS contrasena_hash,
               CASE WHEN c.c_custkey % 8 = 0 THEN NULL ELSE 'Calle ' || CAST(c.c_custkey AS VARCHAR) END AS direccion_envio,
               CASE WHEN c.c_custkey % 50 = 0 THEN NULL ELSE g.n_name END AS ciudad,
               g.r_name AS pais,
               DATE '1950-01-01' + CAST((c.c_custkey * 37) % 20000 AS INTEGER) AS fecha_nacimiento,
               TIMESTAMP '1993-01-01 00:00:00' + to_days(CAST((c.c_custkey * 13) % 720 AS INTEGER)) AS fecha_registro,
               CASE WHEN c.c_custkey >= 10 THEN c.c_custkey // 10 END AS referido_por,
               CASE WHEN c.c_custkey % 40 = 7 THEN 0 ELSE 1 END AS activo
        FROM customer c
        LEFT JOIN (SELECT n.n_nationkey, n.n_name, r.r_name FROM nation n JOIN region r ON n.n_regionkey = r.r_regionkey) g
               ON c.c_nationkey = g.n_nationkey"""),
    ("clientes", f"""
        SELECT cb.id_cliente, cb.nombre, cb.apellido, cb.email, cb.contrasena_hash, cb.direccion_envio,
               cb.ciudad, cb.pais, cb.fecha_nacimiento, cb.fecha_registro, a.last AS fecha_ultima_compra,
               CAST(COALESCE(a.spent, 0) AS DECIMAL(12,2)) AS total_gastado,
               {TIER_SQL.format(t="CAST(COALESCE(a.spent, 0) AS DECIMAL(12,2))")} AS nivel_lealtad,
               cb.referido_por, cb.activo
        FROM clientes_base cb
        LEFT JOIN (SELECT id_cliente, sum(CASE WHEN estado = 'Entregado' THEN total END) AS spent,
                          max(fecha_venta) AS last FROM ventas GROUP BY id_cliente) a
               ON a.id_cliente = cb.id_cliente"""),
    ("devoluciones", f"""
        SELECT l_orderkey * {LINE_KEY} + l_partkey AS id_devolucion, l_orderkey AS id_venta,
               l_partkey AS id_producto, CAST(sum(l_quantity) AS INTEGER) AS cantidad,
               max(l_shipdate) AS fecha_devolucion
        FROM lineitem WHERE l_returnflag = 'R'
        GROUP BY l_orderkey, l_partkey"""),
    ("clicks", """
        SELECT user_id * 100 + dayofmonth(ts) AS id_carrito, user_id, ts, event_id,
               event_id % (SELECT count(*) FROM part) AS id_producto
        FROM events WHERE event_type = 'click'"""),
    ("carritos", """
        SELECT id_carrito, user_id AS id_cliente, min(ts) AS fecha_creacion, max(ts) AS fecha_actualizacion,
               CASE WHEN id_carrito % 3 = 0 THEN 'Activo' WHEN id_carrito % 3 = 1 THEN 'Abandonado'
                    ELSE 'Convertido' END AS estado
        FROM clicks GROUP BY id_carrito, user_id"""),
    ("carrito_items", """
        SELECT min(event_id) AS id_item, id_carrito, id_producto,
               CAST(sum(event_id % 5 + 1) AS INTEGER) AS cantidad
        FROM clicks GROUP BY id_carrito, id_producto"""),
    ("resenas_productos", f"""
        SELECT id_cliente * {LINE_KEY} + id_producto AS id_resena, id_producto, id_cliente,
               CAST((id_producto + id_cliente) % 5 + 1 AS INTEGER) AS calificacion,
               CASE WHEN (id_producto + id_cliente) % 5 + 1 >= 3 THEN 'Buen producto' END AS comentario,
               max(fecha_venta) AS fecha_resena
        FROM (SELECT v.id_cliente, d.id_producto, v.fecha_venta FROM ventas v
              JOIN detalle_ventas d ON d.id_venta = v.id_venta WHERE v.id_venta % 3 = 0) x
        GROUP BY id_cliente, id_producto"""),
    ("promociones", f"""
        SELECT t.id_promocion, t.id_categoria, t.id_producto, t.nombre,
               CAST(t.pct AS DECIMAL(5,2)) AS porcentaje_descuento,
               COALESCE(CAST(t.ini AS TIMESTAMP), a.anchor - INTERVAL 30 DAY) AS fecha_inicio,
               COALESCE(CAST(t.fin AS TIMESTAMP), a.anchor) AS fecha_fin, t.activa
        FROM (SELECT * FROM (VALUES {_PROMOS}) AS v(id_promocion, id_categoria, id_producto, nombre, pct, ini, fin, activa)) t
        LEFT JOIN (SELECT fecha_venta AS anchor FROM ventas WHERE id_venta = 1) a ON TRUE"""),
    ("logins_fallidos", """
        SELECT event_id AS id_log, 'user' || CAST(user_id AS VARCHAR) AS usuario_bd,
               '10.0.0.' || CAST(user_id % 250 AS VARCHAR) AS host_origen, ts AS fecha_intento
        FROM events WHERE event_type = 'error'"""),
    ("log_permisos", """
        SELECT event_id AS id_log, 'user' || CAST(user_id AS VARCHAR) AS usuario_bd,
               'Alta de cuenta ' || CAST(user_id AS VARCHAR) AS accion, ts AS fecha_accion
        FROM events WHERE event_type = 'signup'"""),
    ("productos_after", """
        SELECT * REPLACE (
            CASE WHEN id_producto % 7 = 0 THEN CAST(precio * CAST(1.10 AS DECIMAL(3,2)) AS DECIMAL(10,2)) ELSE precio END AS precio,
            CASE WHEN id_producto % 5 = 0 THEN greatest(stock - 20, 0) ELSE stock END AS stock,
            CASE WHEN id_producto % 11 = 0 THEN upper(nombre) ELSE nombre END AS nombre)
        FROM productos"""),
    ("clientes_after", """
        SELECT * REPLACE (
            CASE WHEN id_cliente % 9 = 0 THEN upper(email) ELSE email END AS email,
            CASE WHEN id_cliente % 4 = 0 THEN 'Carrera ' || CAST(id_cliente AS VARCHAR) ELSE direccion_envio END
                AS direccion_envio)
        FROM clientes"""),
    ("ventas_after", """
        SELECT * REPLACE (CASE WHEN id_venta % 7 = 0 THEN
            CASE WHEN estado = 'Pendiente de Pago' THEN 'Procesando' WHEN estado = 'Procesando' THEN 'Enviado'
                 WHEN estado = 'Enviado' THEN 'Entregado'
                 WHEN estado = 'Entregado' AND id_venta % 14 = 0 THEN 'Cancelado' ELSE estado END
            ELSE estado END AS estado)
        FROM ventas WHERE id_venta % 101 <> 0"""),
    ("detalle_ventas_after", """
        SELECT * FROM detalle_ventas WHERE NOT (id_venta % 13 = 0 AND id_producto % 2 = 0)"""),
    ("order_requests", """
        SELECT event_id AS request_id, ts, user_id AS id_cliente, CAST(event_id % 3 + 1 AS INTEGER) AS id_sucursal,
               event_id % (SELECT count(*) FROM part) AS id_producto, CAST(event_id % 9 + 1 AS INTEGER) AS cantidad
        FROM events WHERE event_type = 'purchase'"""),
    ("product_requests", f"""
        SELECT p_partkey AS request_id, {AS_OF_SQL_} AS ts,
               CAST(CASE WHEN p_partkey % 40 = 0 THEN NULL ELSE (p_partkey // 10) % 6 + 1 END AS INTEGER) AS id_categoria,
               p_partkey % (SELECT count(*) FROM supplier) AS id_proveedor,
               'Nuevo ' || p_name || ' ' || CAST(p_partkey AS VARCHAR) AS nombre, p_brand AS descripcion,
               CASE WHEN p_partkey % 30 = 0 THEN CAST(0 AS DECIMAL(10,2)) ELSE CAST(p_retailprice AS DECIMAL(10,2)) END
                   AS precio,
               CASE WHEN p_partkey % 70 = 0 THEN CAST(-1 AS DECIMAL(10,2))
                    ELSE CAST(CAST(p_retailprice AS DECIMAL(10,2)) / 2 AS DECIMAL(10,2)) END AS costo,
               p_size AS stock
        FROM part"""),
    ("address_requests", """
        SELECT event_id AS request_id, ts,
               user_id + CASE WHEN event_id % 50 = 0 THEN 1000000 ELSE 0 END AS id_cliente,
               'Avenida ' || CAST(event_id AS VARCHAR) AS direccion_envio,
               CASE WHEN event_id % 5 = 0 THEN NULL ELSE 'Ciudad ' || CAST(event_id % 7 AS VARCHAR) END AS ciudad,
               'PAIS' AS pais
        FROM events WHERE event_type = 'signup'"""),
    ("return_requests", """
        SELECT d.id_detalle AS request_id, v.fecha_venta + INTERVAL 30 DAY AS ts, d.id_venta, d.id_producto,
               CAST(d.cantidad - COALESCE(r.r, 0) + CASE WHEN d.id_venta % 34 = 0 THEN 1 ELSE 0 END AS INTEGER) AS cantidad
        FROM detalle_ventas d JOIN ventas v ON v.id_venta = d.id_venta
        LEFT JOIN (SELECT id_venta, id_producto, sum(cantidad) AS r FROM devoluciones GROUP BY 1, 2) r
               ON r.id_venta = d.id_venta AND r.id_producto = d.id_producto"""),
    ("stock_adjust_requests", """
        SELECT event_id AS request_id, ts, event_id % (SELECT count(*) FROM part) AS id_producto,
               CAST(event_id % 21 - 10 AS INTEGER) AS ajuste, 'Conteo ' || CAST(event_id AS VARCHAR) AS motivo
        FROM events WHERE event_type = 'view'"""),
    ("erasure_requests", f"""
        SELECT c_custkey AS request_id, {AS_OF_SQL_} AS ts,
               c_custkey + CASE WHEN c_custkey % 100 = 0 THEN 1000000 ELSE 0 END AS id_cliente
        FROM customer"""),
    ("transition_requests", f"""
        SELECT id_venta * 10 + 1 AS request_id, {AS_OF_SQL_} AS ts, id_venta,
               CASE WHEN id_venta % 13 = 0 THEN 'Perdido' WHEN id_venta % 14 = 0 THEN 'Cancelado'
                    WHEN estado = 'Pendiente de Pago' THEN 'Procesando' WHEN estado = 'Procesando' THEN 'Enviado'
                    ELSE 'Entregado' END AS nuevo_estado
        FROM ventas
        UNION ALL
        SELECT id_venta * 10 + 2, {AS_OF_SQL_} + INTERVAL 1 HOUR, id_venta, 'Entregado'
        FROM ventas"""),
    ("registration_requests", """
        SELECT event_id AS request_id, ts, '  nuevo ' AS nombre, 'CLIENTE ' || CAST(event_id AS VARCHAR) AS apellido,
               CASE WHEN event_id % 10 = 0 THEN 'correo-invalido'
                    WHEN event_id % 10 = 1 THEN 'C' || CAST(user_id AS VARCHAR) || '@EXAMPLE.com'
                    ELSE 'n' || CAST(event_id % 500 AS VARCHAR) || '@example.com' END AS email
        FROM events WHERE event_type = 'signup'"""),
    ("merge_requests", f"""
        SELECT c_custkey * 10 AS request_id,
               CASE WHEN c_custkey % 40 = 20 OR c_custkey % 4 = 0 THEN c_custkey
                    WHEN c_custkey % 8 = 2 THEN c_custkey - 1 ELSE c_custkey - c_custkey % 4 END AS primario,
               CASE WHEN c_custkey % 4 = 0 AND c_custkey % 40 <> 20 THEN c_custkey + 1000000000 ELSE c_custkey END AS secundario,
               {AS_OF_SQL_} AS ts
        FROM customer"""),
    ("supplier_requests", f"""
        SELECT id_producto AS request_id, {AS_OF_SQL_} AS ts, id_producto,
               (id_producto // 10) % ((SELECT count(*) FROM supplier) + 1) AS id_proveedor
        FROM productos_base"""),
    ("payment_requests", f"""
        SELECT id_venta * 10 + 1 AS request_id, {AS_OF_SQL_} AS ts, id_venta,
               CAST(CASE WHEN id_venta % 12 = 0 THEN NULL WHEN id_venta % 8 = 0 THEN total - 1 ELSE total END
                    AS DECIMAL(12,2)) AS monto
        FROM ventas
        UNION ALL
        SELECT id_venta * 10 + 2, {AS_OF_SQL_} + INTERVAL 5 MINUTE, id_venta, CAST(total + 5 AS DECIMAL(12,2))
        FROM ventas"""),
    ("review_requests", """
        SELECT event_id AS request_id, ts, event_id % (SELECT count(*) FROM part) AS id_producto,
               user_id AS id_cliente, CAST(event_id % 6 AS INTEGER) AS calificacion,
               'Vista ' || CAST(event_id AS VARCHAR) AS comentario
        FROM events WHERE event_type = 'view'"""),
    ("category_promo_requests", f"""
        SELECT id_categoria AS request_id, {AS_OF_SQL_} AS ts,
               CASE WHEN id_categoria = 6 THEN 99 ELSE id_categoria END AS id_categoria,
               CAST((id_categoria * 25) % 120 AS DECIMAL(5,2)) AS pct, {AS_OF_SQL_} AS inicio,
               CASE WHEN id_categoria = 5 THEN {AS_OF_SQL_} ELSE {AS_OF_SQL_} + INTERVAL 30 DAY END AS fin
        FROM categorias_base"""),
    ("category_move_requests", f"""
        SELECT id_categoria AS request_id, {AS_OF_SQL_} AS ts, id_categoria AS origen,
               CASE WHEN id_categoria = 6 THEN 5 ELSE 99 END AS destino
        FROM categorias_base WHERE id_categoria IN (1, 6)"""),
]

AS_OF_SQL = f"TIMESTAMP '{AS_OF}'"
AS_OF_EVENTS_SQL = f"TIMESTAMP '{AS_OF_EVENTS}'"


def with_adapter(body: str) -> str:
    """Prefix ``body`` with the adapter CTEs; a leading WITH in ``body`` is merged."""
    ctes = ",\n".join(f"{name} AS ({sql.strip()})" for name, sql in ADAPTER)
    b = body.strip()
    if b[:14].upper() == "WITH RECURSIVE":
        return f"WITH RECURSIVE {ctes},\n{b[14:].lstrip()}"
    if b[:4].upper() == "WITH":
        return f"WITH {ctes},\n{b[4:].lstrip()}"
    return f"WITH {ctes}\n{b}"

"""Constraints re-aimed as data-quality reports.

Output of every report: ``(rule, table_name, row_key, value)`` as strings;
zero rows means clean.  Rules are plain SQL predicates so they run inside
Spark's codegen; all rules of one table are evaluated in a single scan
(an array of possibly-violated rules, exploded), not one scan per rule.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# --- fixed values: CHECK constraints and ENUM sets of the retail schema ---
# (rule, table, key column, condition that must not be FALSE, reported column)
CHECKS = (
    ("chk_categoria_total_productos", "categorias", "id_categoria", "total_productos >= 0", "total_productos"),
    ("chk_precio_positivo", "productos", "id_producto", "precio > 0", "precio"),
    ("chk_costo_no_negativo", "productos", "id_producto", "costo >= 0", "costo"),
    ("chk_stock_no_negativo", "productos", "id_producto", "stock >= 0", "stock"),
    ("chk_total_vendido_no_negativo", "productos", "id_producto", "total_vendido >= 0", "total_vendido"),
    ("chk_total_vistas_no_negativo", "productos", "id_producto", "total_vistas >= 0", "total_vistas"),
    ("chk_cliente_total_gastado", "clientes", "id_cliente", "total_gastado >= 0", "total_gastado"),
    ("chk_cliente_nivel_lealtad", "clientes", "id_cliente",
     "nivel_lealtad IN ('Bronce', 'Plata', 'Oro', 'Platino')", "nivel_lealtad"),
    ("chk_venta_total", "ventas", "id_venta", "total >= 0", "total"),
    ("enum_venta_estado", "ventas", "id_venta",
     "estado IN ('Pendiente de Pago', 'Procesando', 'Enviado', 'Entregado', 'Cancelado')", "estado"),
    ("chk_cantidad_positiva", "detalle_ventas", "id_detalle", "cantidad > 0", "cantidad"),
    ("chk_precio_unitario_positivo", "detalle_ventas", "id_detalle", "precio_unitario_congelado >= 0",
     "precio_unitario_congelado"),
    ("chk_devolucion_cantidad_positiva", "devoluciones", "id_devolucion", "cantidad > 0", "cantidad"),
    ("chk_porcentaje_descuento", "promociones", "id_promocion",
     "porcentaje_descuento > 0 AND porcentaje_descuento <= 100", "porcentaje_descuento"),
    ("chk_fechas_promocion", "promociones", "id_promocion", "fecha_fin >= fecha_inicio", "fecha_fin"),
    ("chk_calificacion_rango", "resenas_productos", "id_resena", "calificacion BETWEEN 1 AND 5", "calificacion"),
    ("enum_carrito_estado", "carritos", "id_carrito", "estado IN ('Activo', 'Abandonado', 'Convertido')", "estado"),
    ("chk_item_cantidad_positiva", "carrito_items", "id_item", "cantidad > 0", "cantidad"),
)
# (rule, table, key columns, compared under the case-insensitive collation)
UNIQUES = (
    ("pk_categorias", "categorias", ("id_categoria",), False),
    ("uq_categoria_nombre", "categorias", ("nombre",), True),
    ("pk_proveedores", "proveedores", ("id_proveedor",), False),
    ("uq_proveedor_email", "proveedores", ("email_contacto",), True),
    ("pk_productos", "productos", ("id_producto",), False),
    ("uq_producto_nombre", "productos", ("nombre",), True),
    ("uq_producto_sku", "productos", ("sku",), True),
    ("pk_clientes", "clientes", ("id_cliente",), False),
    ("uq_cliente_email", "clientes", ("email",), True),
    ("pk_ventas", "ventas", ("id_venta",), False),
    ("uq_detalle_venta_producto", "detalle_ventas", ("id_venta", "id_producto"), False),
    ("uq_cliente_producto_resena", "resenas_productos", ("id_cliente", "id_producto"), False),
    ("uq_carrito_producto", "carrito_items", ("id_carrito", "id_producto"), False),
)
# (rule, child table, child key, FK column, parent table, parent key)
FOREIGN_KEYS = (
    ("fk_producto_categoria", "productos", "id_producto", "id_categoria", "categorias", "id_categoria"),
    ("fk_producto_proveedor", "productos", "id_producto", "id_proveedor", "proveedores", "id_proveedor"),
    ("fk_cliente_referido", "clientes", "id_cliente", "referido_por", "clientes", "id_cliente"),
    ("fk_venta_cliente", "ventas", "id_venta", "id_cliente", "clientes", "id_cliente"),
    ("fk_venta_sucursal", "ventas", "id_venta", "id_sucursal", "sucursales", "id_sucursal"),
    ("fk_detalle_venta", "detalle_ventas", "id_detalle", "id_venta", "ventas", "id_venta"),
    ("fk_detalle_producto", "detalle_ventas", "id_detalle", "id_producto", "productos", "id_producto"),
    ("fk_devolucion_venta", "devoluciones", "id_devolucion", "id_venta", "ventas", "id_venta"),
    ("fk_devolucion_producto", "devoluciones", "id_devolucion", "id_producto", "productos", "id_producto"),
    ("fk_promocion_categoria", "promociones", "id_promocion", "id_categoria", "categorias", "id_categoria"),
    ("fk_promocion_producto", "promociones", "id_promocion", "id_producto", "productos", "id_producto"),
    ("fk_resena_producto", "resenas_productos", "id_resena", "id_producto", "productos", "id_producto"),
    ("fk_resena_cliente", "resenas_productos", "id_resena", "id_cliente", "clientes", "id_cliente"),
    ("fk_vista_producto", "vistas_productos", "id_vista", "id_producto", "productos", "id_producto"),
    ("fk_vista_cliente", "vistas_productos", "id_vista", "id_cliente", "clientes", "id_cliente"),
    ("fk_carrito_cliente", "carritos", "id_carrito", "id_cliente", "clientes", "id_cliente"),
    ("fk_item_carrito", "carrito_items", "id_item", "id_carrito", "carritos", "id_carrito"),
    ("fk_item_producto", "carrito_items", "id_item", "id_producto", "productos", "id_producto"),
)
# (table, key column, NOT NULL columns)
NOT_NULLS = (
    ("categorias", "id_categoria", ("nombre", "total_productos")),
    ("proveedores", "id_proveedor", ("nombre", "email_contacto")),
    ("productos", "id_producto", ("nombre", "precio", "costo", "stock", "sku", "fecha_creacion", "activo",
                                  "total_vendido", "total_vistas")),
    ("clientes", "id_cliente", ("nombre", "apellido", "email", "contrasena_hash", "fecha_registro",
                                "total_gastado", "nivel_lealtad", "activo")),
    ("ventas", "id_venta", ("id_cliente", "fecha_venta", "estado", "total")),
    ("detalle_ventas", "id_detalle", ("id_venta", "id_producto", "cantidad", "precio_unitario_congelado")),
    ("devoluciones", "id_devolucion", ("id_venta", "id_producto", "cantidad", "fecha_devolucion")),
    ("promociones", "id_promocion", ("nombre", "porcentaje_descuento", "fecha_inicio", "fecha_fin", "activa")),
    ("resenas_productos", "id_resena", ("id_producto", "id_cliente", "calificacion", "fecha_resena")),
    ("vistas_productos", "id_vista", ("id_producto", "fecha_vista")),
    ("carritos", "id_carrito", ("id_cliente", "fecha_creacion", "fecha_actualizacion", "estado")),
    ("carrito_items", "id_item", ("id_carrito", "id_producto", "cantidad")),
)
# ---------------------------------------------------------------------------

_OUT = ("rule", "table_name", "row_key", "value")


def _explode_violations(df: DataFrame, table: str, key: str, items: list[tuple[str, str, str]]) -> DataFrame:
    """One pass over ``df``: for each (rule, violation predicate, value column)
    keep a struct when violated, then explode the non-null structs."""
    structs = [F.when(F.expr(pred), F.struct(F.lit(rule).alias("rule"), F.col(val).cast("string").alias("value")))
               for rule, pred, val in items]
    arr = F.filter(F.array(*structs), lambda x: x.isNotNull())
    flagged = df.select(F.col(key).cast("string").alias("row_key"), arr.alias("_v")).where(F.size("_v") > 0)
    return flagged.select(F.explode("_v").alias("_x"), "row_key").select(
        F.col("_x.rule").alias("rule"), F.lit(table).alias("table_name"), "row_key", F.col("_x.value").alias("value"))


def _union(parts: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), parts)


def dq_checks(t) -> DataFrame:
    by_table: dict[tuple[str, str], list] = {}
    for rule, table, key, cond, val in CHECKS:
        by_table.setdefault((table, key), []).append((rule, f"NOT COALESCE(({cond}), TRUE)", val))
    return _union([_explode_violations(t.table(tb), tb, k, items) for (tb, k), items in by_table.items()])


def dq_not_null(t) -> DataFrame:
    parts = []
    for table, key, cols in NOT_NULLS:
        items = [(f"not_null:{c}", f"{c} IS NULL", key) for c in cols]
        parts.append(_explode_violations(t.table(table), table, key, items))
    return _union(parts)


def dq_unique(t) -> DataFrame:
    """Duplicate keys: one row per duplicated key with its multiplicity.
    String keys compare under the collation; the label is the smallest spelling."""
    from emporium.functions.semantics import collated
    parts = []
    for rule, table, cols, ci in UNIQUES:
        df = t.table(table)
        keys = [collated(c).alias(f"_k{i}") if ci else F.col(c).alias(f"_k{i}") for i, c in enumerate(cols)]
        g = (df.groupBy(*keys).agg(*[F.min(c).alias(f"_l{i}") for i, c in enumerate(cols)],
                                   F.count(F.lit(1)).alias("_n"))
             .where(F.col("_n") > 1))
        label = F.concat_ws("|", *[F.col(f"_l{i}").cast("string") for i in range(len(cols))])
        parts.append(g.select(F.lit(rule).alias("rule"), F.lit(table).alias("table_name"),
                              label.alias("row_key"), F.col("_n").cast("string").alias("value")))
    return _union(parts)


def dq_orphans(t) -> DataFrame:
    """Child rows whose non-NULL foreign key has no parent (anti join per FK)."""
    parts = []
    for rule, child, ckey, fk, parent, pkey in FOREIGN_KEYS:
        c = t.table(child).where(F.col(fk).isNotNull()).select(F.col(ckey).alias("_ck"), F.col(fk).alias("_fk"))
        p = t.table(parent).select(F.col(pkey).alias("_fk"))
        miss = c.join(p, "_fk", "left_anti")
        parts.append(miss.select(F.lit(rule).alias("rule"), F.lit(child).alias("table_name"),
                                 F.col("_ck").cast("string").alias("row_key"),
                                 F.col("_fk").cast("string").alias("value")))
    return _union(parts)

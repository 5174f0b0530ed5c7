"""Read procedures re-aimed table-wide."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions import semantics as S
from emporium.operators.rank import spread, top_k_per_key
from emporium.operators.scalars import attach_scalars

MONEY = "decimal(18,2)"
RELATED_ROWS = 250_000  # rows that one ranking task sorts


def rpt_purchase_history(t, customer_id: int | None = None) -> DataFrame:
    """P05 for every customer (or one): order lines with subtotal, all states."""
    o = t.ventas if customer_id is None else t.ventas.where(F.col("id_cliente") == customer_id)
    j = (o.join(t.detalle_ventas, "id_venta")
         .join(t.productos.select("id_producto", F.col("nombre").alias("product_name")), "id_producto"))
    return j.select(F.col("id_cliente").alias("customer_id"), F.col("id_venta").alias("order_id"),
                    F.col("fecha_venta").alias("order_ts"), F.col("estado").alias("state"),
                    F.col("total").alias("order_total"), F.col("id_producto").alias("product_id"),
                    "product_name", F.col("cantidad").alias("quantity"),
                    F.col("precio_unitario_congelado").alias("unit_price"),
                    (F.col("cantidad") * F.col("precio_unitario_congelado")).cast(MONEY).alias("subtotal"))


def rpt_monthly_sales(t, year: int, month: int) -> DataFrame:
    """One row for (year, month).  The month is a half-open range on the
    raw timestamp, so the predicate reaches the scan (YEAR()=... would not)."""
    start = f"{year:04d}-{month:02d}-01 00:00:00"
    ny, nm = (year + 1, 1) if month == 12 else (year, month + 1)
    end = f"{ny:04d}-{nm:02d}-01 00:00:00"
    o = t.ventas.where((F.col("fecha_venta") >= F.lit(start).cast("timestamp_ntz"))
                       & (F.col("fecha_venta") < F.lit(end).cast("timestamp_ntz")) & S.not_cancelled())
    g = o.agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("s"))
    return g.select(F.lit(year).alias("year"), F.lit(month).alias("month"),
                    F.col("n").cast("bigint").alias("order_count"),
                    F.coalesce("s", F.lit(0)).cast(MONEY).alias("total_sold"),
                    F.coalesce(S.div_round(F.col("s") * 100, F.col("n") * 100, 6, 2),
                               F.lit(0).cast(MONEY)).cast(MONEY).alias("avg_ticket"))


def rpt_product_360(t) -> DataFrame:
    """P12 for every product: catalogue, category, supplier, rating (1 dp, 0 if none)."""
    rev = (t.resenas_productos.groupBy("id_producto")
           .agg(F.sum("calificacion").alias("_sum"), F.count(F.lit(1)).alias("_n")))
    cat = t.categorias.select("id_categoria", F.col("nombre").alias("category_name"))
    sup = t.proveedores.select("id_proveedor", F.col("nombre").alias("supplier_name"))
    j = t.productos.join(cat, "id_categoria", "left").join(sup, "id_proveedor", "left").join(rev, "id_producto", "left")
    rating = F.coalesce(S.div_round(F.col("_sum"), F.col("_n"), 4, 1, 4), F.lit(0).cast("decimal(4,1)"))
    return j.select(F.col("id_producto").alias("product_id"), "sku", F.col("nombre").alias("product_name"),
                    F.col("descripcion").alias("description"), F.col("precio").alias("price"),
                    F.col("costo").alias("cost"), "stock", F.col("activo").alias("active"),
                    F.col("total_vendido").alias("total_sold"), F.col("total_vistas").alias("total_views"),
                    "category_name", "supplier_name", rating.cast("decimal(4,1)").alias("avg_rating"),
                    F.coalesce("_n", F.lit(0)).cast("bigint").alias("review_count"))


def rpt_search_products(t, term: str | None) -> DataFrame:
    """Active products whose name or description contains the trimmed
    term, case- and accent-insensitively; '' matches all, NULL matches none.
    The term is searched literally (no LIKE wildcards)."""
    cat = t.categorias.select("id_categoria", F.col("nombre").alias("category_name"))
    p = t.productos.where(F.col("activo") == 1)
    if term is None:
        p = p.where(F.lit(False))
    else:
        needle = F.lit(term.strip(" "))
        p = p.where(F.contains(S.collated("nombre"), needle) | F.contains(S.collated("descripcion"), needle))
    return p.join(cat, "id_categoria", "left").select(
        F.col("id_producto").alias("product_id"), "sku", F.col("nombre").alias("product_name"),
        "category_name", F.col("descripcion").alias("description"), F.col("precio").alias("price"), "stock")


def rpt_dashboard(t) -> DataFrame:
    """One row; each table is scanned once with conditional aggregates."""
    c = t.clientes.agg(F.count_if(F.col("activo") == 1).alias("active_customers"))
    p = t.productos.agg(F.count_if(F.col("activo") == 1).alias("active_products"),
                        F.count_if((F.col("stock") <= S.LOW_STOCK) & (F.col("activo") == 1)).alias("low_stock_products"))
    v = t.ventas.agg(F.sum(F.when(S.not_cancelled(), F.col("total"))).alias("_rev"),
                     F.count_if(F.col("estado") == S.PENDING).alias("pending_orders"))
    row = attach_scalars(attach_scalars(c, p), v)
    return row.select(F.col("active_customers").cast("bigint").alias("active_customers"),
                      F.col("active_products").cast("bigint").alias("active_products"),
                      F.coalesce("_rev", F.lit(0)).cast(MONEY).alias("total_revenue"),
                      F.col("pending_orders").cast("bigint").alias("pending_orders"),
                      F.col("low_stock_products").cast("bigint").alias("low_stock_products"))


def rpt_related_products(t, k: int = 5) -> DataFrame:
    """P19 for every product: up to k active products of the same category,
    best sellers first (ties by id), never the product itself.

    Candidates are ranked once per category and cut to k+1 (one may be the
    product itself); Spark applies that cut per task before the shuffle
    (WindowGroupLimit), so a huge category ships only k+1 rows per task.
    Each product then joins at most k+1 candidates; these rows, nearly alike and
    so small in the shuffle, are dealt out by count."""
    cand = (t.productos.where((F.col("activo") == 1) & F.col("id_categoria").isNotNull())
            .select("id_categoria", F.col("id_producto").alias("related_id"), F.col("sku").alias("related_sku"),
                    F.col("nombre").alias("related_name"), F.col("precio").alias("related_price"),
                    F.col("stock").alias("related_stock"), F.col("total_vendido").alias("_sold")))
    top = top_k_per_key(cand, ["id_categoria"], [F.col("_sold").desc(), F.col("related_id").asc()], k + 1, "_r")
    base = t.productos.where(F.col("id_categoria").isNotNull()).select("id_producto", "id_categoria")
    j = base.join(top, "id_categoria").where(F.col("related_id") != F.col("id_producto"))
    j = spread(j, t.productos.count() * (k + 1), RELATED_ROWS, "id_producto")
    ranked = top_k_per_key(j, ["id_producto"], [F.col("_r").asc()], k, "rank")
    return ranked.select(F.col("id_producto").alias("product_id"), F.col("rank").cast("int").alias("rank"),
                         "related_id", "related_sku", "related_name", "related_price", "related_stock")

"""Stored functions F01-F19 re-aimed as table-wide enrichment jobs.

A per-row function that looked up other tables becomes a pre-aggregate
plus a left join; a pure function becomes a column expression.  One job
per grain: orders, customers, products.
"""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions import semantics as S
from emporium.operators.scope import scoped_products

MONEY = "decimal(18,2)"


def enr_orders(t, as_of: str, fx_rate: str = "0.0250") -> DataFrame:
    """One row per order: F01 computed total, F07 shipping, F16 VAT,
    F18 delivery date, F19 converted total."""
    lines = (t.detalle_ventas.groupBy("id_venta")
             .agg(F.sum(F.col("cantidad") * F.col("precio_unitario_congelado")).alias("_lines")))
    o = (t.ventas.join(lines, "id_venta", "left")
         .join(t.clientes.select("id_cliente", "ciudad"), "id_cliente", "left"))
    return o.select(
        F.col("id_venta").alias("order_id"), F.col("id_cliente").alias("customer_id"),
        F.col("fecha_venta").alias("order_ts"), F.col("estado").alias("state"),
        F.col("total").cast(MONEY).alias("stored_total"),
        F.coalesce("_lines", F.lit(0)).cast("decimal(12,2)").alias("computed_total"),
        S.shipping_cost(F.col("total"), F.col("ciudad")).alias("shipping_cost"),
        S.vat(F.col("total")).alias("vat"),
        S.delivery_date(F.col("fecha_venta"), F.col("ciudad"), as_of).alias("delivery_date"),
        S.convert_currency(F.col("total"), F.lit(Decimal(fx_rate))).alias("converted_total"))


def enr_customers(t, as_of: str) -> DataFrame:
    """One row per customer: F04 age, F05 name, F06 new flag, F09 last
    purchase, F10 email check, F12 order count, F13 idle days, F14 tier."""
    live = (t.ventas.where(S.not_cancelled()).groupBy("id_cliente")
            .agg(F.max("fecha_venta").alias("_last"), F.count(F.lit(1)).alias("_n")))
    c = t.clientes.join(live, "id_cliente", "left")
    today = F.to_date(F.lit(as_of))
    return c.select(
        F.col("id_cliente").alias("customer_id"),
        S.full_name("nombre", "apellido").alias("full_name"),
        S.whole_years(F.col("fecha_nacimiento"), as_of).cast("int").alias("age"),
        F.when(F.col("fecha_registro").isNull(), 0)
         .when(F.datediff(today, F.col("fecha_registro")) <= 30, 1).otherwise(0).alias("is_new"),
        S.email_ok("email").alias("email_ok"),
        F.col("_last").alias("last_purchase"),
        F.coalesce("_n", F.lit(0)).cast("bigint").alias("order_count"),
        F.datediff(today, F.col("_last")).cast("int").alias("days_since_last"),
        S.loyalty_tier(F.col("total_gastado")).alias("tier"))


def enr_products(t) -> DataFrame:
    """One row per product: F03 list price, F11 category name, F15 SKU."""
    cat = t.categorias.select("id_categoria", F.col("nombre").alias("_cat"))
    p = t.productos.join(cat, "id_categoria", "left")
    return p.select(
        F.col("id_producto").alias("product_id"),
        F.coalesce(F.col("precio"), F.lit(0).cast("decimal(10,2)")).cast("decimal(10,2)").alias("list_price"),
        F.coalesce(F.col("_cat"), F.lit(S.NO_CATEGORY)).alias("category_name"),
        S.sku(F.col("_cat"), F.col("id_producto")).alias("generated_sku"))


def enr_availability(t, requests: DataFrame | None = None) -> DataFrame:
    """F02 over a table of (product, quantity) requests."""
    r = requests if requests is not None else t.order_requests
    stock = t.productos.where(F.col("activo") == 1).select("id_producto", F.col("stock").alias("_stock"))
    j = r.join(stock, "id_producto", "left")
    q = F.col("cantidad")
    ok = (F.when(q <= 0, 0)
          .when(F.col("_stock").isNull() | (F.col("_stock") < q), 0)
          .otherwise(1))
    return j.select(F.col("request_id"), F.col("id_producto").alias("product_id"),
                    q.alias("quantity"), ok.alias("available"))


def enr_promo_prices(t, as_of: str | None = None, active_only: bool = False) -> DataFrame:
    """F08 for every (promotion, product in scope): the discounted price.

    With ``as_of`` only promotions whose interval holds that instant count;
    ``active_only`` also requires ``activa = 1``.
    """
    promos = t.promociones
    if as_of is not None:
        ts = F.lit(as_of).cast("timestamp_ntz")
        promos = promos.where((F.col("fecha_inicio") <= ts) & (F.col("fecha_fin") >= ts))
    if active_only:
        promos = promos.where(F.col("activa") == 1)
    pairs = scoped_products(promos.select("id_promocion", "id_producto", "id_categoria", "porcentaje_descuento"),
                            t.productos.select("id_producto", "id_categoria"))
    j = pairs.join(t.productos.select("id_producto", "precio"), "id_producto")
    return j.select(F.col("id_promocion").alias("promotion_id"), F.col("id_producto").alias("product_id"),
                    F.col("precio").alias("price"), F.col("porcentaje_descuento").alias("discount_pct"),
                    S.apply_discount(F.col("precio"), F.col("porcentaje_descuento")).alias("final_price"))


def enr_category_stock(t) -> DataFrame:
    """stock of active products per category (0 when none)."""
    s = (t.productos.where(F.col("activo") == 1).groupBy("id_categoria")
         .agg(F.sum("stock").alias("_s")))
    return (t.categorias.select("id_categoria").join(s, "id_categoria", "left")
            .select(F.col("id_categoria").alias("category_id"),
                    F.coalesce("_s", F.lit(0)).cast("bigint").alias("active_stock")))

"""Analytical queries Q01-Q20.

Each function takes a catalog of reference-shaped tables (``t.ventas``,
``t.detalle_ventas`` ...) and returns one DataFrame.  Facts are filtered
and pre-aggregated before they meet dimensions, so every join after the
first aggregate sees one row per key; dimension joins are left to AQE's
size-checked broadcast choice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions import semantics as S
from emporium.operators.rank import global_row_number, spread, top_k
from emporium.operators.scalars import attach_scalars
from emporium.operators.scope import scoped_products

MONEY = "decimal(18,2)"
PAIR_LINES = 500_000  # lines that one task of the pair join holds


def _live_orders(t) -> DataFrame:
    return t.ventas.where(S.not_cancelled())


def _live_lines(t) -> DataFrame:
    """Order lines of non-cancelled orders (semi join: lines keep their grain)."""
    return t.detalle_ventas.join(_live_orders(t).select("id_venta"), "id_venta", "left_semi")


def _units_by_product(t) -> DataFrame:
    return (_live_lines(t).groupBy("id_producto")
            .agg(F.sum("cantidad").cast("bigint").alias("units")))


def _customer_name():
    return F.concat(F.col("nombre"), F.lit(" "), F.col("apellido"))


def q01_top_revenue_products(t, k: int = 10) -> DataFrame:
    per_product = (_live_lines(t).groupBy("id_producto")
                   .agg(F.sum(F.col("cantidad") * F.col("precio_unitario_congelado")).alias("revenue"),
                        F.sum("cantidad").alias("units_sold")))
    j = per_product.join(t.productos.select("id_producto", "nombre"), "id_producto")
    out = j.select(F.col("id_producto").alias("product_id"), F.col("nombre").alias("product_name"),
                   F.coalesce("revenue", F.lit(0)).cast(MONEY).alias("revenue"),
                   F.coalesce("units_sold", F.lit(0)).cast("bigint").alias("units_sold"))
    return top_k(out, k, [F.col("revenue").desc(), F.col("product_id").asc()])


def q02_slowest_10pct(t) -> DataFrame:
    active = t.productos.where(F.col("activo") == 1).select("id_producto", "nombre")
    ranked_in = (active.join(_units_by_product(t), "id_producto", "left")
                 .withColumn("units", F.coalesce("units", F.lit(0)).cast("bigint")))
    ranked = global_row_number(ranked_in, [F.col("units").asc(), F.col("id_producto").asc()], "position")
    total = active.agg(F.count(F.lit(1)).alias("total_products"))  # one row -> scalar subquery
    # k = GREATEST(1, CEIL(n * 0.10)) in integer arithmetic
    k = F.greatest(F.lit(1), F.floor((F.col("total_products") + 9) / 10).cast("bigint"))
    return (attach_scalars(ranked, total).where(F.col("position") <= k)
            .select(F.col("id_producto").alias("product_id"), F.col("nombre").alias("product_name"),
                    F.col("units").alias("units_sold"), F.col("position").cast("bigint").alias("position"),
                    F.col("total_products").cast("bigint").alias("total_products")))


def q03_customer_ltv(t, k: int = 10) -> DataFrame:
    per_c = (_live_orders(t).groupBy("id_cliente")
             .agg(F.sum("total").alias("ltv"), F.count("id_venta").alias("n")))
    j = per_c.join(t.clientes, "id_cliente")
    out = j.select(F.col("id_cliente").alias("customer_id"), _customer_name().alias("customer_name"),
                   F.col("email"), F.col("nivel_lealtad").alias("loyalty_tier"),
                   F.coalesce("ltv", F.lit(0)).cast(MONEY).alias("lifetime_value"),
                   F.col("n").cast("bigint").alias("order_count"))
    return top_k(out, k, [F.col("lifetime_value").desc(), F.col("customer_id").asc()])


def _avg_money(sum_col: str, cnt_col: str):
    """ROUND(COALESCE(AVG(decimal(12,2)), 0), 2): AVG keeps 6 places in MySQL."""
    return F.coalesce(S.div_round(F.col(sum_col) * 100, F.col(cnt_col) * 100, 6, 2),
                      F.lit(0).cast(MONEY)).cast(MONEY)


def q04_monthly_trend(t) -> DataFrame:
    g = (_live_orders(t).groupBy(F.date_format("fecha_venta", "yyyy-MM").alias("month"))
         .agg(F.count(F.lit(1)).alias("order_count"), F.sum("total").alias("s")))
    return g.select("month", F.col("order_count").cast("bigint").alias("order_count"),
                    F.coalesce("s", F.lit(0)).cast(MONEY).alias("total_sales"),
                    _avg_money("s", "order_count").alias("avg_ticket"))


def q05_new_customers_quarter(t) -> DataFrame:
    g = (t.clientes.groupBy(F.year("fecha_registro").alias("y"), F.quarter("fecha_registro").alias("q"))
         .agg(F.count(F.lit(1)).alias("n")))
    return g.select(F.concat(F.col("y").cast("string"), F.lit("-Q"), F.col("q").cast("string")).alias("quarter"),
                    F.col("n").cast("bigint").alias("new_customers"))


def q06_repeat_rate(t) -> DataFrame:
    per_c = _live_orders(t).groupBy("id_cliente").agg(F.count(F.lit(1)).alias("n"))
    g = per_c.agg(F.count(F.lit(1)).alias("buyers"),
                  F.sum(F.when(F.col("n") > 1, 1).otherwise(0)).alias("repeat_buyers"))
    return g.select(F.col("buyers").cast("bigint").alias("buyers"),
                    F.coalesce("repeat_buyers", F.lit(0)).cast("bigint").alias("repeat_buyers"),
                    S.div_round(F.col("repeat_buyers") * 100, F.col("buyers"), 5, 2).alias("repeat_rate_pct"))


def q07_basket_pairs(t, k: int = 10) -> DataFrame:
    """Co-purchase pairs.  The self join is on the order key, so its cost is
    Σ lines(order)²; an order has a product once, so its lines are bounded by
    the catalogue.  Both sides read one exchange whose tasks hold about
    ``PAIR_LINES`` lines: a task's sorts and its map of nearly all-distinct pairs
    stay the same size, however many lines there are.  The pair count is
    pre-aggregated per (a, b) before the product names are attached."""
    lines = spread(_live_lines(t).select("id_venta", "id_producto"), t.detalle_ventas.count(), PAIR_LINES, "id_venta")
    a = lines.select("id_venta", F.col("id_producto").alias("a"))
    b = lines.select("id_venta", F.col("id_producto").alias("b"))
    pairs = (a.join(b, "id_venta").where(F.col("a") < F.col("b"))
             .groupBy("a", "b").agg(F.count(F.lit(1)).alias("times_together")))
    top = top_k(pairs, k, [F.col("times_together").desc(), F.col("a").asc(), F.col("b").asc()])
    names = t.productos.select("id_producto", "nombre")
    na = names.select(F.col("id_producto").alias("a"), F.col("nombre").alias("product_a_name"))
    nb = names.select(F.col("id_producto").alias("b"), F.col("nombre").alias("product_b_name"))
    return (top.join(na, "a").join(nb, "b")
            .select(F.col("a").alias("product_a_id"), "product_a_name", F.col("b").alias("product_b_id"),
                    "product_b_name", F.col("times_together").cast("bigint").alias("times_together")))


def q08_category_turnover(t) -> DataFrame:
    stock = t.productos.groupBy("id_categoria").agg(F.sum("stock").alias("stock"))
    units = (_units_by_product(t).join(t.productos.select("id_producto", "id_categoria"), "id_producto")
             .groupBy("id_categoria").agg(F.sum("units").alias("units")))
    j = t.categorias.select("id_categoria", "nombre").join(stock, "id_categoria", "left").join(units, "id_categoria", "left")
    u = F.coalesce("units", F.lit(0)).cast("bigint")
    s = F.coalesce("stock", F.lit(0)).cast("bigint")
    return j.select(F.col("id_categoria").alias("category_id"), F.col("nombre").alias("category_name"),
                    u.alias("units_sold"), s.alias("current_stock"),
                    S.div_round(u, s, 4, 2).alias("turnover_index"))


def q09_critical_stock(t, threshold: int = S.LOW_STOCK) -> DataFrame:
    p = t.productos.where((F.col("stock") <= threshold) & (F.col("activo") == 1))
    cat = t.categorias.select("id_categoria", F.col("nombre").alias("category_name"))
    return p.join(cat, "id_categoria", "left").select(
        F.col("id_producto").alias("product_id"), "sku", F.col("nombre").alias("product_name"),
        "category_name", "stock", F.col("precio").alias("price"))


def q10_abandoned_carts(t, as_of: str, idle_days: int = 3) -> DataFrame:
    cutoff = F.timestamp_add("DAY", F.lit(-idle_days), F.lit(as_of).cast("timestamp_ntz"))
    carts = t.carritos.where(F.col("estado").isin("Activo", "Abandonado") & (F.col("fecha_actualizacion") < cutoff))
    items = (t.carrito_items.join(t.productos.select("id_producto", "precio"), "id_producto")
             .join(carts.select("id_carrito"), "id_carrito", "left_semi")
             .groupBy("id_carrito")
             .agg(F.count("id_item").alias("item_count"),
                  F.sum(F.col("cantidad") * F.col("precio")).alias("value")))
    j = carts.join(items, "id_carrito").join(t.clientes.select("id_cliente", "nombre", "apellido", "email"),
                                             "id_cliente")
    return j.select(F.col("id_carrito").alias("cart_id"), F.col("id_cliente").alias("customer_id"),
                    _customer_name().alias("customer_name"), "email",
                    F.col("fecha_actualizacion").alias("last_update"),
                    F.col("item_count").cast("bigint").alias("item_count"),
                    F.coalesce("value", F.lit(0)).cast(MONEY).alias("estimated_value"))


def q11_supplier_revenue(t) -> DataFrame:
    rev = (_live_lines(t).groupBy("id_producto")
           .agg(F.sum(F.col("cantidad") * F.col("precio_unitario_congelado")).alias("rev")))
    per_sup = (t.productos.where(F.col("id_proveedor").isNotNull()).select("id_producto", "id_proveedor")
               .join(rev, "id_producto", "left")
               .groupBy("id_proveedor")
               .agg(F.count(F.lit(1)).alias("n"), F.sum("rev").alias("rev")))
    j = t.proveedores.join(per_sup, "id_proveedor", "left")
    return j.select(F.col("id_proveedor").alias("supplier_id"), F.col("nombre").alias("supplier_name"),
                    F.col("email_contacto").alias("contact_email"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("products_supplied"),
                    F.coalesce("rev", F.lit(0)).cast(MONEY).alias("revenue"))


def q12_geo_sales(t) -> DataFrame:
    """Groups fold under the case/accent-insensitive collation (rule N4);
    the label is the smallest raw spelling, NULL city stays its own group."""
    o = _live_orders(t).select("id_venta", "id_cliente", "total")
    c = t.clientes.select("id_cliente", "ciudad", "pais")
    j = o.join(c, "id_cliente")
    g = (j.groupBy(S.collated("ciudad").alias("_ck"), S.collated("pais").alias("_pk"))
         .agg(F.min("ciudad").alias("ciudad"), F.min("pais").alias("pais"),
              F.count(F.lit(1)).alias("n"), F.sum("total").alias("s"),
              F.count("total").alias("cnt")))
    return g.select(F.coalesce("ciudad", F.lit("No especificada")).alias("city"),
                    F.coalesce("pais", F.lit("No especificado")).alias("country"),
                    F.col("n").cast("bigint").alias("order_count"),
                    F.coalesce("s", F.lit(0)).cast(MONEY).alias("total_sold"),
                    _avg_money("s", "cnt").alias("avg_per_order"))


def q13_hourly(t) -> DataFrame:
    g = (_live_orders(t).groupBy(F.hour("fecha_venta").alias("hour_of_day"))
         .agg(F.count(F.lit(1)).alias("n"), F.sum("total").alias("s")))
    return g.select(F.col("hour_of_day").cast("int").alias("hour_of_day"),
                    F.col("n").cast("bigint").alias("order_count"),
                    F.coalesce("s", F.lit(0)).cast(MONEY).alias("total_sold"))


def q14_promo_effect(t) -> DataFrame:
    """Promotion scope is ``product = p OR (p IS NULL AND category = c)``; the
    OR would force a nested-loop join, so it is split into two equi joins
    (disjoint by construction) and unioned."""
    promos = t.promociones
    in_scope = scoped_products(promos, t.productos.select("id_producto", "id_categoria"))
    lines = (_live_lines(t).join(_live_orders(t).select("id_venta", "fecha_venta"), "id_venta")
             .select("id_venta", "id_producto", "fecha_venta",
                     (F.col("cantidad") * F.col("precio_unitario_congelado")).alias("amount")))
    hits = (in_scope.join(lines, "id_producto")
            .where(F.col("fecha_venta").between(F.col("fecha_inicio"), F.col("fecha_fin")))
            .groupBy("id_promocion")
            .agg(F.count_distinct("id_venta").alias("n"), F.sum("amount").alias("rev")))
    j = promos.join(hits, "id_promocion", "left")
    return j.select(F.col("id_promocion").alias("promotion_id"), F.col("nombre").alias("promotion_name"),
                    F.col("porcentaje_descuento").alias("discount_pct"),
                    F.col("fecha_inicio").alias("start_ts"), F.col("fecha_fin").alias("end_ts"),
                    F.coalesce("n", F.lit(0)).cast("bigint").alias("orders_during"),
                    F.coalesce("rev", F.lit(0)).cast(MONEY).alias("revenue_during"))


def q15_cohorts(t) -> DataFrame:
    o = _live_orders(t).select("id_cliente", "fecha_venta", "total")
    c = t.clientes.select("id_cliente", "fecha_registro")
    g = (o.join(c, "id_cliente")
         .groupBy(F.date_format("fecha_registro", "yyyy-MM").alias("cohort_month"),
                  F.date_format("fecha_venta", "yyyy-MM").alias("activity_month"))
         .agg(F.count_distinct("id_cliente").alias("n"), F.sum("total").alias("s")))
    return g.select("cohort_month", "activity_month", F.col("n").cast("bigint").alias("active_customers"),
                    F.coalesce("s", F.lit(0)).cast(MONEY).alias("cohort_revenue"))


def q16_gross_margin(t) -> DataFrame:
    p = t.productos.where(F.col("activo") == 1)
    margin = (F.col("precio") - F.col("costo"))
    # ROUND((m / p) * 100, 2) with m/p kept to 6 places == ROUND(100 m / p) at 4 then 2
    pct = S.div_round(margin * 10000, F.col("precio") * 100, 4, 2)
    return p.select(F.col("id_producto").alias("product_id"), F.col("nombre").alias("product_name"),
                    F.col("costo").alias("cost"), F.col("precio").alias("price"),
                    margin.cast("decimal(11,2)").alias("gross_margin"), pct.alias("margin_pct"))


def q17_days_between(t) -> DataFrame:
    """Average calendar days between consecutive non-cancelled orders.

    The gaps telescope: Σ DATEDIFF(d_i, d_{i-1}) over a customer's ordered
    orders equals DATEDIFF(last, first), and there are n - 1 gaps.  So the
    reference's LAG window becomes a plain min/max/count aggregate — partial
    aggregation runs map-side and a customer with a third of all orders is
    still spread over every task."""
    g = (_live_orders(t).groupBy("id_cliente")
         .agg(F.min("fecha_venta").alias("_first"), F.max("fecha_venta").alias("_last"),
              F.count(F.lit(1)).alias("_n"))
         .where(F.col("_n") > 1))
    gaps = F.datediff(F.col("_last"), F.col("_first"))
    j = g.join(t.clientes.select("id_cliente", "nombre", "apellido"), "id_cliente")
    return j.select(F.col("id_cliente").alias("customer_id"), _customer_name().alias("customer_name"),
                    S.div_round(gaps, F.col("_n") - 1, 4, 1).alias("avg_days_between"),
                    F.col("_n").cast("bigint").alias("orders_evaluated"))


def q18_view_conversion(t) -> DataFrame:
    views = t.vistas_productos.groupBy("id_producto").agg(F.count(F.lit(1)).alias("v"))
    p = (t.productos.where(F.col("activo") == 1).select("id_producto", "nombre")
         .join(views, "id_producto", "left").join(_units_by_product(t), "id_producto", "left"))
    v = F.coalesce("v", F.lit(0)).cast("bigint")
    u = F.coalesce("units", F.lit(0)).cast("bigint")
    return p.select(F.col("id_producto").alias("product_id"), F.col("nombre").alias("product_name"),
                    v.alias("total_views"), u.alias("total_bought"),
                    S.div_round(u, v, 4, 4).alias("conversion_rate"))


def q19_rfm(t, as_of: str) -> DataFrame:
    g = (_live_orders(t).groupBy("id_cliente")
         .agg(F.max("fecha_venta").alias("last"), F.count("id_venta").alias("n"), F.sum("total").alias("s")))
    j = g.join(t.clientes.select("id_cliente", "nombre", "apellido", "nivel_lealtad"), "id_cliente")
    return j.select(F.col("id_cliente").alias("customer_id"), _customer_name().alias("customer_name"),
                    F.col("nivel_lealtad").alias("loyalty_tier"),
                    F.datediff(F.to_date(F.lit(as_of)), F.col("last")).cast("int").alias("recency_days"),
                    F.col("n").cast("bigint").alias("frequency"),
                    F.coalesce("s", F.lit(0)).cast(MONEY).alias("monetary"))


def q20_run_rate(t, as_of: str) -> DataFrame:
    per_p = (_live_lines(t).join(_live_orders(t).select("id_venta", "fecha_venta"), "id_venta")
             .groupBy("id_producto")
             .agg(F.sum("cantidad").alias("units"), F.min("fecha_venta").alias("first_sale")))
    p = t.productos.where(F.col("activo") == 1).select("id_producto", "nombre", "stock").join(per_p, "id_producto", "left")
    months = S.whole_months(F.col("first_sale"), F.to_date(F.lit(as_of)).cast("timestamp_ntz"))
    u = F.coalesce("units", F.lit(0)).cast("bigint")
    return p.select(F.col("id_producto").alias("product_id"), F.col("nombre").alias("product_name"),
                    F.col("stock").alias("current_stock"), u.alias("units_sold_hist"),
                    S.div_round(u, S.guarded_greatest(1, months), 4, 2).alias("monthly_demand"))

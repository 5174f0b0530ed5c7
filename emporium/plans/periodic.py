"""Scheduled events E01-E20 and seed rollups S1-S2 as batch jobs.

Each job takes an explicit ``as_of`` instead of reading the clock and
returns the rows it would write (a report) or the new state of the table it
would mutate; the overlay operators turn the reference's upsert / REPLACE /
INSERT IGNORE into new table versions.  Month filters are half-open ranges
on the raw timestamp so they reach the Parquet scan.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions import semantics as S
from emporium.operators import overlay
from emporium.operators.scalars import attach_scalars
from emporium.operators.spine import day_spine

# --- fixed values: log texts written by the reference's events -----------
BIRTHDAY_TEXT = "Saludo de cumpleanos programado para cliente id "
SYSTEM_USER = "SISTEMA"
VELOCITY_TEXT_PREFIX = "Alerta: "
VELOCITY_TEXT_HOUR = " ordenes generadas en la ultima hora"
# ---------------------------------------------------------------------------

REPORT_MONEY = "decimal(14,2)"


def _ts(as_of: str):
    return F.lit(as_of).cast("timestamp_ntz")


def _minus(as_of: str, unit: str, n: int):
    return F.timestamp_add(unit, F.lit(-n), _ts(as_of))


def _prev_month_range(as_of: str):
    start = F.add_months(F.trunc(F.to_date(_ts(as_of)), "MM"), -1)
    end = F.trunc(F.to_date(_ts(as_of)), "MM")
    return start.cast("timestamp_ntz"), end.cast("timestamp_ntz"), F.date_format(start, "yyyy-MM")


def job_weekly_sales(t, as_of: str) -> DataFrame:
    """Trailing 7x24 h (no upper bound), non-cancelled, always one row."""
    o = t.ventas.where((F.col("fecha_venta") >= _minus(as_of, "DAY", 7)) & S.not_cancelled())
    g = o.agg(F.sum("total").alias("s"), F.count(F.lit(1)).alias("n"))
    return g.select(F.to_date(_minus(as_of, "DAY", 7)).alias("week_start"), F.to_date(_ts(as_of)).alias("week_end"),
                    F.coalesce("s", F.lit(0)).cast(REPORT_MONEY).alias("total_sales"),
                    F.col("n").cast("bigint").alias("order_count"))


def job_converted_cart_cleanup(t) -> DataFrame:
    """Cart items without those of converted carts (new state)."""
    doomed = t.carritos.where(F.col("estado") == "Convertido").select("id_carrito")
    return overlay.delete_keys(t.carrito_items, doomed, ["id_carrito"])


def job_log_retention(t, as_of: str, months: int = 12) -> dict[str, DataFrame]:
    """Both logs without rows older than ``months`` (new states)."""
    cut = _minus(as_of, "MONTH", months)
    return {"log_permisos": overlay.delete_where(t.log_permisos, F.col("fecha_accion") < cut),
            "logins_fallidos": overlay.delete_where(t.logins_fallidos, F.col("fecha_intento") < cut)}


def job_expire_promos(t, as_of: str) -> DataFrame:
    """activa = 0 for active promotions whose end has passed (new state)."""
    return overlay.update_where(t.promociones, (F.col("fecha_fin") < _ts(as_of)) & (F.col("activa") == 1),
                                {"activa": F.lit(0)})


def job_loyalty_tiers(t) -> DataFrame:
    """Every customer's tier recomputed from the spend (new state)."""
    return t.clientes.withColumn("nivel_lealtad", S.loyalty_tier("total_gastado"))


def job_reorder_list(t, as_of: str, threshold: int = S.LOW_STOCK) -> DataFrame:
    """Reorder suggestions appended for this run."""
    p = t.productos.where((F.col("stock") <= threshold) & (F.col("activo") == 1))
    return p.select(F.col("id_producto").alias("product_id"), F.col("stock").alias("current_stock"),
                    F.greatest(F.lit(50) - F.col("stock"), F.lit(10)).cast("int").alias("suggested_qty"),
                    _ts(as_of).alias("generated_at"))


def job_suspend_inactive(t, as_of: str) -> DataFrame:
    """Customers with no purchase (or none) in 12 months and registered
    over 12 months ago are deactivated (new state)."""
    cut = _minus(as_of, "MONTH", 12)
    pred = ((F.col("fecha_ultima_compra").isNull() | (F.col("fecha_ultima_compra") < cut))
            & (F.col("fecha_registro") < cut) & (F.col("activo") == 1))
    return overlay.update_where(t.clientes, pred, {"activo": F.lit(0)})


def daily_sales(t, start_day, end_day, bounds: DataFrame | None = None) -> DataFrame:
    """Σ and count of non-cancelled orders for every day of [start, end];
    a day without orders gets a zero row (calendar spine)."""
    spine = day_spine(t.spark, start_day, end_day, "day", bounds)
    o = t.ventas.where(S.not_cancelled())
    if bounds is None:  # literal range: push it to the scan
        lo, hi = start_day.cast("timestamp_ntz"), F.date_add(end_day, 1).cast("timestamp_ntz")
        o = o.where((F.col("fecha_venta") >= lo) & (F.col("fecha_venta") < hi))
    o = (o.groupBy(F.to_date("fecha_venta").alias("day"))
         .agg(F.sum("total").alias("s"), F.count(F.lit(1)).alias("n")))
    return spine.join(o, "day", "left").select(
        "day", F.coalesce("s", F.lit(0)).cast(REPORT_MONEY).alias("total_sold"),
        F.coalesce("n", F.lit(0)).cast("bigint").alias("order_count"))


def job_daily_sales(t, as_of: str, target: DataFrame | None = None, backfill_from: str | None = None) -> DataFrame:
    """yesterday's totals upserted by day into the daily table.

    ``backfill_from`` widens the run to every day from that date to
    yesterday (same upsert), which is how a missed schedule is repaired.
    """
    yesterday = F.date_sub(F.to_date(_ts(as_of)), 1)
    if backfill_from == "first_order":
        bounds = t.ventas.agg(F.min(F.to_date("fecha_venta")).alias("_first"))  # one row
        new = daily_sales(t, F.col("_first"), yesterday, bounds)
    else:
        start = F.to_date(F.lit(backfill_from)) if backfill_from else yesterday
        new = daily_sales(t, start, yesterday)
    if target is None:
        return new
    return overlay.upsert(target, new, ["day"], ["total_sold", "order_count"])


def job_order_total_audit(t) -> DataFrame:
    """Orders whose stored total differs from Σ lines (F01); old and new."""
    lines = (t.detalle_ventas.groupBy("id_venta")
             .agg(F.sum(F.col("cantidad") * F.col("precio_unitario_congelado")).alias("_s")))
    j = t.ventas.select("id_venta", "total").join(lines, "id_venta", "left")
    new = F.coalesce("_s", F.lit(0)).cast("decimal(12,2)")
    return j.where(F.col("total") != new).select(F.col("id_venta").alias("order_id"),
                                                 F.col("total").alias("old_total"), new.alias("new_total"))


def job_birthdays(t, as_of: str) -> DataFrame:
    """Greeting log rows for active customers born on as_of's month/day."""
    d = F.to_date(_ts(as_of))
    c = t.clientes.where((F.month("fecha_nacimiento") == F.month(d)) & (F.dayofmonth("fecha_nacimiento") == F.dayofmonth(d))
                         & (F.col("activo") == 1))
    text = F.concat(F.lit(BIRTHDAY_TEXT), F.col("id_cliente").cast("string"), F.lit(" ("),
                    F.col("nombre"), F.lit(" "), F.col("apellido"), F.lit(")"))
    return c.select(F.col("id_cliente").alias("customer_id"), F.lit(SYSTEM_USER).alias("db_user"),
                    text.alias("action"), _ts(as_of).alias("logged_at"))


def job_product_ranking(t, as_of: str, target: DataFrame | None = None) -> DataFrame:
    """REPLACE (product, total sold, as_of) for every product."""
    new = t.productos.select(F.col("id_producto").alias("product_id"), F.col("total_vendido").alias("total_sold"),
                             _ts(as_of).alias("updated_at"))
    return new if target is None else overlay.replace_rows(target, new, ["product_id"])


def job_catalog_snapshot(t, as_of: str, target: DataFrame | None = None) -> DataFrame:
    """Catalogue snapshot keyed by (product, as_of), duplicates ignored."""
    new = t.productos.select(F.col("id_producto").alias("product_id"), F.col("nombre").alias("product_name"),
                             F.col("precio").alias("price"), "stock", _ts(as_of).alias("snapshot_at"))
    return new if target is None else overlay.insert_ignore(target, new, ["product_id", "snapshot_at"])


def job_mark_abandoned(t, as_of: str, idle_days: int = 3) -> DataFrame:
    """Activo carts idle over 3 days become Abandonado (new state)."""
    pred = (F.col("estado") == "Activo") & (F.col("fecha_actualizacion") < _minus(as_of, "DAY", idle_days))
    return overlay.update_where(t.carritos, pred, {"estado": F.lit("Abandonado")})


def job_monthly_kpis(t, as_of: str) -> DataFrame:
    """Previous month's sales, new customers and average ticket; one row."""
    lo, hi, label = _prev_month_range(as_of)
    o = (t.ventas.where((F.col("fecha_venta") >= lo) & (F.col("fecha_venta") < hi) & S.not_cancelled())
         .agg(F.sum("total").alias("s"), F.count(F.lit(1)).alias("n")))
    c = (t.clientes.where((F.col("fecha_registro") >= lo) & (F.col("fecha_registro") < hi))
         .agg(F.count(F.lit(1)).alias("new_customers")))
    row = attach_scalars(o, c)  # two one-row aggregates
    return row.select(label.alias("month"), F.coalesce("s", F.lit(0)).cast(REPORT_MONEY).alias("total_sales"),
                      F.col("new_customers").cast("bigint").alias("new_customers"),
                      F.coalesce(S.div_round(F.col("s") * 100, F.col("n") * 100, 6, 2), F.lit(0))
                      .cast("decimal(12,2)").alias("avg_ticket"))


def job_refresh_counters(t) -> DataFrame:
    """E16 (products): net units Σ(qty − returned) over non-cancelled orders
    and view counts; zeros where none.  The reference's doubly nested
    subquery becomes two pre-aggregates joined on (order, product)."""
    live = t.detalle_ventas.join(t.ventas.where(S.not_cancelled()).select("id_venta"), "id_venta", "left_semi")
    ret = t.devoluciones.groupBy("id_venta", "id_producto").agg(F.sum("cantidad").alias("_ret"))
    net = (live.join(ret, ["id_venta", "id_producto"], "left")
           .groupBy("id_producto")
           .agg(F.sum(F.col("cantidad") - F.coalesce("_ret", F.lit(0))).alias("_net")))
    views = t.vistas_productos.groupBy("id_producto").agg(F.count(F.lit(1)).alias("_v"))
    p = t.productos.select("id_producto").join(net, "id_producto", "left").join(views, "id_producto", "left")
    return p.select(F.col("id_producto").alias("product_id"),
                    F.coalesce("_net", F.lit(0)).cast("bigint").alias("total_sold"),
                    F.coalesce("_v", F.lit(0)).cast("bigint").alias("total_views"))


def job_order_velocity(orders: DataFrame, as_of: str, window_hours: int = 1, min_orders: int = 5) -> DataFrame:
    """Customers with ≥ min_orders orders (any state) in the trailing window."""
    o = orders.where(F.col("fecha_venta") >= _minus(as_of, "HOUR", window_hours))
    g = o.groupBy("id_cliente").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_orders)
    tail = VELOCITY_TEXT_HOUR if window_hours == 1 else f" ordenes generadas en las ultimas {window_hours} horas"
    return g.select(F.col("id_cliente").alias("customer_id"), F.col("n").cast("bigint").alias("order_count"),
                    F.concat(F.lit(VELOCITY_TEXT_PREFIX), F.col("n").cast("string"), F.lit(tail)).alias("reason"),
                    _ts(as_of).alias("detected_at"))


def job_supplier_month(t, as_of: str) -> DataFrame:
    """Previous month's revenue per supplier; suppliers without sales get 0."""
    lo, hi, label = _prev_month_range(as_of)
    live = t.ventas.where(S.not_cancelled() & (F.col("fecha_venta") >= lo) & (F.col("fecha_venta") < hi)).select("id_venta")
    rev = (t.detalle_ventas.join(live, "id_venta", "left_semi").groupBy("id_producto")
           .agg(F.sum(F.col("cantidad") * F.col("precio_unitario_congelado")).alias("_r")))
    per = (t.productos.where(F.col("id_proveedor").isNotNull()).select("id_producto", "id_proveedor")
           .join(rev, "id_producto").groupBy("id_proveedor").agg(F.sum("_r").alias("_r")))
    j = t.proveedores.select("id_proveedor").join(per, "id_proveedor", "left")
    return j.select(F.col("id_proveedor").alias("supplier_id"), label.alias("month"),
                    F.coalesce("_r", F.lit(0)).cast(REPORT_MONEY).alias("revenue"))


def job_purge_products(t, as_of: str) -> DataFrame:
    """Inactive products untouched for 6 months and never sold (the rows
    to delete; ``overlay.delete_keys`` gives the new catalogue)."""
    cut = _minus(as_of, "MONTH", 6)
    cand = t.productos.where((F.col("activo") == 0)
                             & (F.coalesce("fecha_modificacion", "fecha_creacion") < cut))
    gone = cand.join(t.detalle_ventas.select("id_producto"), "id_producto", "left_anti")
    return gone.select(F.col("id_producto").alias("product_id"), F.col("nombre").alias("product_name"))


def job_seed_category_count(t) -> DataFrame:
    """S1 (= first half of E16): products per category, 0 when none."""
    n = t.productos.groupBy("id_categoria").agg(F.count(F.lit(1)).alias("_n"))
    return (t.categorias.select("id_categoria").join(n, "id_categoria", "left")
            .select(F.col("id_categoria").alias("category_id"),
                    F.coalesce("_n", F.lit(0)).cast("bigint").alias("total_products")))


def job_seed_product_counters(t) -> DataFrame:
    """Gross units over all order states, and views."""
    sold = t.detalle_ventas.groupBy("id_producto").agg(F.sum("cantidad").alias("_s"))
    views = t.vistas_productos.groupBy("id_producto").agg(F.count(F.lit(1)).alias("_v"))
    p = t.productos.select("id_producto").join(sold, "id_producto", "left").join(views, "id_producto", "left")
    return p.select(F.col("id_producto").alias("product_id"),
                    F.coalesce("_s", F.lit(0)).cast("bigint").alias("total_sold"),
                    F.coalesce("_v", F.lit(0)).cast("bigint").alias("total_views"))

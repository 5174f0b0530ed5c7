"""Row triggers T01-T22 re-aimed as change-feed jobs.

Input feeds have the shape ``(key, op, before, after, ts, actor)`` built by
:func:`emporium.operators.changes.diff_snapshots` (or delivered by a CDC
stream); every job is a set operation over the whole feed.  Checks that
raised an error in the reference return *rejected* rows with a reason.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.functions import semantics as S
from emporium.operators.admission import greedy_admission
from emporium.operators.changes import as_inserts, changed, diff_snapshots
from emporium.operators.ledger import floored_totals

# --- fixed values: texts and messages written by the reference's triggers --
NEW_CUSTOMER_TEXT = "Nuevo cliente registrado: id "
STATUS_TEXT = "Venta "
STATUS_FROM = " cambio de estado de "
STATUS_TO = " a "
LOW_STOCK_TEXT = "ALERTA stock bajo para producto id "
LOW_STOCK_NOW = "). Stock actual: "
MSG_CATEGORY_HAS_PRODUCTS = "No se puede eliminar una categoria con productos asociados"
MSG_NEGATIVE_STOCK = "El stock no puede ser negativo"
MSG_PRICE = "El precio del producto debe ser mayor a cero"
MSG_EMAIL = "El formato del correo electronico no es valido"
MSG_SELF_REFERRAL = "Un cliente no puede referirse a si mismo"
DEFAULT_CATEGORY = 1
CATALOG_FIELDS = ("nombre", "descripcion", "precio", "costo", "sku", "activo", "id_categoria", "id_proveedor")
CATALOG_TEXT_FIELDS = ("nombre", "descripcion", "sku")
AUDITED_FIELDS = ("email", "direccion_envio")
# ---------------------------------------------------------------------------

ACTOR = "app@localhost"


# -- feeds over the test catalog ---------------------------------------------
def product_feed(t, ts: str) -> DataFrame:
    return diff_snapshots(t.productos, t.productos_after, ["id_producto"], ts, ACTOR)


def customer_feed(t, ts: str) -> DataFrame:
    return diff_snapshots(t.clientes, t.clientes_after, ["id_cliente"], ts, ACTOR)


def order_feed(t, ts: str) -> DataFrame:
    return diff_snapshots(t.ventas, t.ventas_after, ["id_venta"], ts, ACTOR)


def line_feed(t, ts: str) -> DataFrame:
    return diff_snapshots(t.detalle_ventas, t.detalle_ventas_after, ["id_detalle"], ts, ACTOR)


# -- jobs ----------------------------------------------------------------------
def chg_price_log(feed: DataFrame) -> DataFrame:
    """Price changed -> (product, old, new, when, who)."""
    f = feed.where((F.col("op") == "U") & (F.col("before.precio") != F.col("after.precio")))
    return f.select(F.col("id_producto").alias("product_id"), F.col("before.precio").alias("old_price"),
                    F.col("after.precio").alias("new_price"), F.col("ts").alias("changed_at"),
                    F.col("actor").alias("db_user"))


def chg_stock_admission(lines: DataFrame, products: DataFrame) -> DataFrame:
    """T02 (+T03's decrement, which decides later checks): each new line is
    admitted when the product exists and its stock left covers the quantity.
    ``lines(request_id, ts, id_producto, cantidad)``."""
    cap = products.select("id_producto", F.col("stock").alias("cap"))
    dec = greedy_admission(lines.withColumnRenamed("cantidad", "qty"), cap, "id_producto", "qty")
    return (lines.join(dec, "request_id")
            .select("request_id", F.col("id_producto").alias("product_id"), F.col("cantidad").alias("quantity"),
                    "accepted", "reason"))


def chg_stock_ledger(admitted: DataFrame, products: DataFrame) -> DataFrame:
    """Stock - Σ accepted, total sold + Σ accepted, per product (no
    inverse on line delete, as in the reference)."""
    d = (admitted.where(F.col("accepted")).groupBy(F.col("product_id").alias("id_producto"))
         .agg(F.sum("quantity").alias("_q")))
    p = products.select("id_producto", "stock", "total_vendido").join(d, "id_producto", "left")
    q = F.coalesce("_q", F.lit(0))
    return p.select(F.col("id_producto").alias("product_id"), (F.col("stock") - q).cast("bigint").alias("stock"),
                    (F.col("total_vendido") + q).cast("bigint").alias("total_sold"))


def chg_category_delete_guard(deletes: DataFrame, products: DataFrame) -> DataFrame:
    """A category that still has products cannot be deleted."""
    used = products.where(F.col("id_categoria").isNotNull()).select("id_categoria")
    blocked = deletes.join(used, "id_categoria", "left_semi").select("id_categoria")
    j = deletes.join(blocked.withColumn("_b", F.lit(True)), "id_categoria", "left")
    return j.select(F.col("id_categoria").alias("category_id"), F.col("_b").isNull().alias("accepted"),
                    F.when(F.col("_b"), F.lit(MSG_CATEGORY_HAS_PRODUCTS)).alias("reason"))


def chg_new_customer_log(feed: DataFrame) -> DataFrame:
    """One log line per inserted customer (it contains the email)."""
    f = feed.where(F.col("op") == "I")
    return f.select(F.col("id_cliente").alias("customer_id"), F.col("actor").alias("db_user"),
                    F.concat(F.lit(NEW_CUSTOMER_TEXT), F.col("id_cliente").cast("string"), F.lit(" email "),
                             F.col("after.email")).alias("action"), F.col("ts").alias("logged_at"))


def chg_customer_spend(feed: DataFrame, customers: DataFrame) -> DataFrame:
    """->Entregado adds the new total and moves the last purchase;
    Entregado->Cancelado subtracts the old total with a floor at 0; tier
    follows.  Floored fold per customer in (ts, order) order."""
    upd = feed.where(F.col("op") == "U")
    to_del = (F.col("after.estado") == S.DELIVERED) & (F.col("before.estado") != S.DELIVERED)
    del_cancel = (F.col("before.estado") == S.DELIVERED) & (F.col("after.estado") == S.CANCELLED)
    ev = upd.where(to_del | del_cancel).select(
        F.col("after.id_cliente").alias("id_cliente"), "ts", "id_venta",
        F.when(to_del, F.col("after.total")).otherwise(-F.col("before.total")).cast("decimal(14,2)").alias("d"),
        F.when(to_del, F.col("after.fecha_venta")).alias("_bought"))
    start = customers.select("id_cliente", F.col("total_gastado").cast("decimal(14,2)").alias("start"))
    fin = floored_totals(ev, start, "id_cliente", "d", ["ts", "id_venta"])
    last = ev.groupBy("id_cliente").agg(F.max("_bought").alias("_b"))
    j = fin.join(last, "id_cliente").join(customers.select("id_cliente", "fecha_ultima_compra"), "id_cliente", "left")
    spent = F.col("final").cast("decimal(12,2)")
    return j.select(F.col("id_cliente").alias("customer_id"), spent.alias("total_spent"),
                    F.greatest(F.col("fecha_ultima_compra"), F.col("_b")).alias("last_purchase"),
                    S.loyalty_tier(spent).alias("tier"))


def chg_catalog_stamp(feed: DataFrame) -> DataFrame:
    """Modification time is stamped only when a catalogue field changed
    under the case/accent-insensitive collation (stock/sold/views do not count)."""
    cond = None
    for f in CATALOG_FIELDS:
        c = changed(f, S.CI_COLLATION if f in CATALOG_TEXT_FIELDS else None)
        cond = c if cond is None else (cond | c)
    f = feed.where((F.col("op") == "U") & cond)
    return f.select(F.col("id_producto").alias("product_id"), F.col("ts").alias("modified_at"))


def chg_negative_stock(feed: DataFrame) -> DataFrame:
    """Updates that would leave stock below zero are rejected."""
    f = feed.where((F.col("op") == "U") & (F.col("after.stock") < 0))
    return f.select(F.col("id_producto").alias("product_id"), F.col("after.stock").alias("stock"),
                    F.lit(MSG_NEGATIVE_STOCK).alias("reason"))


def chg_name_normalise(feed: DataFrame) -> DataFrame:
    """Inserted customers' names capitalised; blank parts untouched."""
    f = feed.where(F.col("op") == "I")
    return f.select(F.col("id_cliente").alias("customer_id"),
                    S.normalise_part(F.col("after.nombre")).alias("nombre"),
                    S.normalise_part(F.col("after.apellido")).alias("apellido"))


def chg_order_total(lines: DataFrame, orders: DataFrame, lines_after: DataFrame) -> DataFrame:
    """Orders touched by a line insert or delete get their total
    recomputed (F01) from the lines after the change."""
    touched = lines.select(F.coalesce(F.col("after.id_venta"), F.col("before.id_venta")).alias("id_venta"))
    o = orders.select("id_venta", "total").join(touched, "id_venta", "left_semi")
    s = (lines_after.join(touched, "id_venta", "left_semi").groupBy("id_venta")
         .agg(F.sum(F.col("cantidad") * F.col("precio_unitario_congelado")).alias("_s")))
    j = o.join(s, "id_venta", "left")
    return j.select(F.col("id_venta").alias("order_id"), F.col("total").alias("old_total"),
                    F.coalesce("_s", F.lit(0)).cast("decimal(12,2)").alias("new_total"))


def chg_order_status_log(feed: DataFrame) -> DataFrame:
    """State changed -> log text from/to."""
    f = feed.where((F.col("op") == "U") & (F.col("before.estado") != F.col("after.estado")))
    text = F.concat(F.lit(STATUS_TEXT), F.col("id_venta").cast("string"), F.lit(STATUS_FROM),
                    F.col("before.estado"), F.lit(STATUS_TO), F.col("after.estado"))
    return f.select(F.col("id_venta").alias("order_id"), F.col("actor").alias("db_user"), text.alias("action"),
                    F.col("ts").alias("logged_at"))


def chg_price_positive(feed: DataFrame) -> DataFrame:
    """Inserted products with price <= 0 are rejected."""
    f = feed.where((F.col("op") == "I") & (F.col("after.precio") <= 0))
    return f.select(F.col("id_producto").alias("product_id"), F.col("after.precio").alias("price"),
                    F.lit(MSG_PRICE).alias("reason"))


def chg_low_stock_alert(feed: DataFrame) -> DataFrame:
    """Alert only when stock crosses from above 15 to 15 or below."""
    f = feed.where((F.col("op") == "U") & (F.col("after.stock") <= S.LOW_STOCK) & (F.col("before.stock") > S.LOW_STOCK))
    text = F.concat(F.lit(LOW_STOCK_TEXT), F.col("id_producto").cast("string"), F.lit(" ("), F.col("after.nombre"),
                    F.lit(LOW_STOCK_NOW), F.col("after.stock").cast("string"))
    return f.select(F.col("id_producto").alias("product_id"), F.lit("SISTEMA").alias("db_user"),
                    text.alias("action"), F.col("ts").alias("logged_at"))


def chg_archive_orders(feed: DataFrame) -> DataFrame:
    """Deleted orders copied to the archive."""
    f = feed.where(F.col("op") == "D")
    return f.select("id_venta", F.col("before.id_cliente").alias("id_cliente"),
                    F.col("before.fecha_venta").alias("fecha_venta"), F.col("before.estado").alias("estado"),
                    F.col("before.total").alias("total"), F.col("ts").alias("fecha_archivado"))


def chg_email_valid(feed: DataFrame) -> DataFrame:
    """Inserted customers with an invalid email are rejected (inserts only)."""
    f = feed.where((F.col("op") == "I") & (S.email_ok(F.col("after.email")) == 0))
    return f.select(F.col("id_cliente").alias("customer_id"), F.col("after.email").alias("email"),
                    F.lit(MSG_EMAIL).alias("reason"))


def chg_last_order_date(new_orders: DataFrame, customers: DataFrame) -> DataFrame:
    """New orders (any state) move the customer's last purchase forward.
    ``new_orders(id_cliente, fecha_venta)``."""
    m = new_orders.groupBy("id_cliente").agg(F.max("fecha_venta").alias("_m"))
    j = m.join(customers.select("id_cliente", "fecha_ultima_compra"), "id_cliente")
    return j.select(F.col("id_cliente").alias("customer_id"),
                    F.greatest(F.coalesce("fecha_ultima_compra", "_m"), F.col("_m")).alias("last_purchase"))


def chg_self_referral(feed: DataFrame) -> DataFrame:
    """Updates making a customer their own referrer are rejected."""
    f = feed.where((F.col("op") == "U") & F.col("after.referido_por").isNotNull()
                   & (F.col("after.referido_por") == F.col("id_cliente")))
    return f.select(F.col("id_cliente").alias("customer_id"), F.lit(MSG_SELF_REFERRAL).alias("reason"))


def chg_default_category(feed: DataFrame) -> DataFrame:
    """Inserted products without category get category 1."""
    f = feed.where(F.col("op") == "I")
    return f.select(F.col("id_producto").alias("product_id"),
                    F.coalesce(F.col("after.id_categoria"), F.lit(DEFAULT_CATEGORY)).alias("id_categoria"))


def chg_category_count(inserts: DataFrame, deletes: DataFrame, categories: DataFrame) -> DataFrame:
    """+1 per inserted product (after T19), -1 per deleted product
    with a floor at 0; a category change is not handled (drift repaired by
    the nightly recount)."""
    ins = chg_default_category(inserts).select("id_categoria", F.lit(1).alias("d"), F.lit(0).alias("_phase"),
                                               F.col("product_id"))
    dels = deletes.where(F.col("op") == "D").select(F.col("before.id_categoria").alias("id_categoria"),
                                                    F.lit(-1).alias("d"), F.lit(1).alias("_phase"),
                                                    F.col("id_producto").alias("product_id"))
    ev = ins.unionByName(dels).where(F.col("id_categoria").isNotNull())
    start = categories.select("id_categoria", F.col("total_productos").alias("start"))
    fin = floored_totals(ev, start, "id_categoria", "d", ["_phase", "product_id"])
    j = categories.select("id_categoria", "total_productos").join(fin, "id_categoria", "left")
    return j.select(F.col("id_categoria").alias("category_id"),
                    F.coalesce("final", "total_productos").cast("bigint").alias("total_products"))


def chg_customer_audit(feed: DataFrame) -> DataFrame:
    """One audit row per changed field (email, address), compared
    byte-wise and NULL-safe; a row with both changed gives two."""
    f = feed.where(F.col("op") == "U")
    items = F.array(*[F.when(changed(c), F.struct(F.lit(c).alias("field"),
                                                  F.col(f"before.{c}").alias("old_value"),
                                                  F.col(f"after.{c}").alias("new_value")))
                      for c in AUDITED_FIELDS])
    x = f.select("id_cliente", "ts", F.explode(F.filter(items, lambda s: s.isNotNull())).alias("_a"))
    return x.select(F.col("id_cliente").alias("customer_id"), F.col("_a.field").alias("field"),
                    F.col("_a.old_value").alias("old_value"), F.col("_a.new_value").alias("new_value"),
                    F.col("ts").alias("modified_at"))


__all__ = [n for n in dir() if n.startswith("chg_")] + ["product_feed", "customer_feed", "order_feed",
                                                          "line_feed", "as_inserts"]

"""Trigger and procedure edge rows (FIXTURES §4) on small literal inputs."""

from decimal import Decimal

from emporium.operators.changes import diff_snapshots
from emporium.plans import changes as C


def test_catalog_stamp_ignores_case_only_rename(spark):
    cols = "id_producto long, nombre string, descripcion string, precio decimal(10,2), costo decimal(10,2), " \
           "sku string, activo int, id_categoria int, id_proveedor long, stock int"
    old = spark.createDataFrame([(1, "Café", "d", Decimal("1.00"), Decimal("0.50"), "S", 1, 1, 1, 20),
                                 (2, "Té", "d", Decimal("1.00"), Decimal("0.50"), "S", 1, 1, 1, 20),
                                 (3, "Pan", "d", Decimal("1.00"), Decimal("0.50"), "S", 1, 1, 1, 16)], cols)
    new = spark.createDataFrame([(1, "CAFE", "d", Decimal("1.00"), Decimal("0.50"), "S", 1, 1, 1, 20),
                                 (2, "Té", "d", Decimal("2.00"), Decimal("0.50"), "S", 1, 1, 1, 20),
                                 (3, "Pan", "d", Decimal("1.00"), Decimal("0.50"), "S", 1, 1, 1, 15)], cols)
    feed = diff_snapshots(old, new, ["id_producto"], "2026-09-01 00:00:00")
    assert [r.product_id for r in C.chg_catalog_stamp(feed).collect()] == [2]
    assert [r.product_id for r in C.chg_low_stock_alert(feed).collect()] == [3]
    assert [(r.product_id, r.old_price, r.new_price) for r in C.chg_price_log(feed).collect()] == [
        (2, Decimal("1.00"), Decimal("2.00"))]


def test_customer_audit_is_binary_and_null_safe(spark):
    cols = "id_cliente long, email string, direccion_envio string"
    old = spark.createDataFrame([(1, "a@x.co", None), (2, "b@x.co", "Calle 1"), (3, "c@x.co", "Calle 3")], cols)
    new = spark.createDataFrame([(1, "A@x.co", "Calle 9"), (2, "b@x.co", None), (3, "c@x.co", "Calle 3")], cols)
    feed = diff_snapshots(old, new, ["id_cliente"], "2026-09-01 00:00:00")
    got = sorted((r.customer_id, r.field, r.old_value, r.new_value) for r in C.chg_customer_audit(feed).collect())
    assert got == [(1, "direccion_envio", None, "Calle 9"), (1, "email", "a@x.co", "A@x.co"),
                   (2, "direccion_envio", "Calle 1", None)]


def test_spend_floor_at_zero(spark):
    cols = "id_venta long, id_cliente long, estado string, total decimal(12,2), fecha_venta timestamp_ntz"
    import datetime as dt
    d = dt.datetime(2026, 8, 1)
    old = spark.createDataFrame([(1, 7, "Entregado", Decimal("500.00"), d), (2, 7, "Enviado", Decimal("50.00"), d)], cols)
    new = spark.createDataFrame([(1, 7, "Cancelado", Decimal("500.00"), d), (2, 7, "Entregado", Decimal("50.00"), d)], cols)
    feed = diff_snapshots(old, new, ["id_venta"], "2026-09-01 00:00:00")
    cust = spark.createDataFrame([(7, Decimal("120.00"), None)],
                                 "id_cliente long, total_gastado decimal(12,2), fecha_ultima_compra timestamp_ntz")
    r = C.chg_customer_spend(feed, cust).collect()[0]
    # order 1 first: max(0, 120 - 500) = 0, then + 50
    assert (r.total_spent, r.tier, r.last_purchase) == (Decimal("50.00"), "Bronce", d)

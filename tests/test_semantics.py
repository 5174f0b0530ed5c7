"""Edge rows of FIXTURES §4 for the column expressions (rules N2-N13)."""

from decimal import Decimal

from pyspark.sql import functions as F

from emporium.functions import semantics as S


def one(spark, col, rows, schema):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(col).collect()]


def test_loyalty_tier_edges(spark):
    rows = [(Decimal("99999.99"),), (Decimal("100000.00"),), (Decimal("500000.00"),), (Decimal("1000000.00"),),
            (None,), (Decimal("-1.00"),)]
    assert one(spark, S.loyalty_tier("x"), rows, "x decimal(12,2)") == [
        "Bronce", "Plata", "Oro", "Platino", "Bronce", "Bronce"]


def test_div_round_is_mysql_double_rounding(spark):
    # 99 / 20000 = 0.00495: kept to 4 places -> 0.0050, then ROUND 2 -> 0.01
    rows = [(99, 20000), (1, 3), (2, 3), (5, 0), (0, 7)]
    got = one(spark, S.div_round("n", "d", 4, 2), rows, "n long, d long")
    assert got == [Decimal("0.01"), Decimal("0.33"), Decimal("0.67"), None, Decimal("0.00")]


def test_guarded_greatest_keeps_null(spark):
    assert one(spark, S.guarded_greatest(1, F.col("x")), [(None,), (0,), (5,)], "x int") == [None, 1, 5]


def test_sku_truncates_and_falls_back(spark):
    rows = [("Electronica", 7), ("Electronica", 9999), ("Electronica", 10000), ("Electronica", 12345),
            ("TV", 7), (None, 7), ("Ñu", 7)]
    got = one(spark, S.sku("c", "i"), rows, "c string, i long")
    assert got == ["SKU-ELE-0007", "SKU-ELE-9999", "SKU-ELE-1000", "SKU-ELE-1234", "SKU-GEN-0007",
                   "SKU-GEN-0007", "SKU-ÑU-0007"]


def test_shipping_collation_and_threshold(spark):
    rows = [(Decimal("199999.99"), "Medellín  "), (Decimal("200000.00"), "medellin"), (None, "MEDELLIN"),
            (Decimal("10.00"), "Bogotá"), (Decimal("-5.00"), None)]
    got = one(spark, S.shipping_cost("t", "c"), rows, "t decimal(12,2), c string")
    assert got == [Decimal("8000.00"), Decimal("0.00"), Decimal("8000.00"), Decimal("15000.00"), Decimal("15000.00")]


def test_discount_edges(spark):
    rows = [(Decimal("100.00"), None), (Decimal("100.00"), Decimal("0")), (Decimal("100.00"), Decimal("100")),
            (Decimal("100.00"), Decimal("100.01")), (Decimal("99.99"), Decimal("12.5")), (None, Decimal("10"))]
    got = one(spark, S.apply_discount("p", "r"), rows, "p decimal(10,2), r decimal(6,2)")
    assert got == [Decimal("100.00"), Decimal("100.00"), Decimal("0.00"), Decimal("0.00"), Decimal("87.49"),
                   Decimal("0.00")]


def test_vat_and_currency(spark):
    rows = [(Decimal("100.05"), Decimal("0.0250")), (None, Decimal("1")), (Decimal("10.00"), Decimal("-1"))]
    df = spark.createDataFrame(rows, "a decimal(12,2), r decimal(10,4)")
    got = df.select(S.vat("a"), S.convert_currency("a", "r")).collect()
    assert [tuple(r) for r in got] == [(Decimal("19.01"), Decimal("2.50")), (Decimal("0.00"), Decimal("0.00")),
                                       (Decimal("1.90"), Decimal("0.00"))]


def test_names_and_email(spark):
    rows = [("  ana ", "PÉREZ"), (None, None), ("", "x"), (None, "gómez")]
    assert one(spark, S.full_name("a", "b"), rows, "a string, b string") == ["Ana Pérez", "", "X", "Gómez"]
    emails = [("a@b.co",), ("a@b.c",), (None,), ("  ",), ("x.y+z@dominio.com.co",)]
    assert one(spark, S.email_ok("e"), emails, "e string") == [1, 0, 0, 0, 1]


def test_whole_months_clamp(spark):
    rows = [("2026-01-31 00:00:00", "2026-02-28 00:00:00"), ("2026-01-15 10:00:00", "2026-02-15 00:00:00"),
            ("2026-01-31 00:00:00", "2026-03-31 00:00:00")]
    df = spark.createDataFrame(rows, "a string, b string").select(
        S.whole_months(F.col("a").cast("timestamp_ntz"), F.col("b").cast("timestamp_ntz")))
    assert [r[0] for r in df.collect()] == [0, 0, 2]

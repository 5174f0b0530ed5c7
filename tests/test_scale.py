"""Work that has to grow no faster than the rows: plans and task sizes."""

from types import SimpleNamespace

from pyspark.sql import functions as F


def joins(df) -> int:
    return df._jdf.queryExecution().optimizedPlan().toString().count("Join ")


def brute_returns(orders, lines, done, reqs):
    """The rules of P04, one request after the other."""
    from emporium.plans import batch as B
    got = {}
    left = {k: q - sum(d for *l, d in done if tuple(l) == k) for k, q in lines.items()}
    back = {v: sum(d for o, _, d in done if o == v) for v in orders}
    state = dict(orders)
    for rid, ts, v, p, q in sorted(reqs, key=lambda r: (r[1], r[0])):
        why = (B.MSG_RETURN_QTY if q is None or q <= 0 else B.MSG_NO_ORDER_RETURN if v not in state else
               B.MSG_NOT_DELIVERED if orders[v] != B.S.DELIVERED else B.MSG_NOT_IN_ORDER if (v, p) not in lines else
               B.MSG_NOT_DELIVERED if state[v] != B.S.DELIVERED else B.MSG_RETURN_EXCEEDS if q > left[v, p] else None)
        if why is None:
            left[v, p] -= q
            back[v] += q
            if back[v] >= sum(n for (o, _), n in lines.items() if o == v):
                state[v] = B.S.CANCELLED
        got[rid] = why
    return got, {v for v in state if state[v] != orders[v]}


def test_returns_read_their_tables_once(spark, monkeypatch):
    import random

    from emporium.plans import batch as B
    rng = random.Random(4)
    orders = {v: B.S.DELIVERED if v % 4 else "Enviado" for v in range(60)}
    lines = {(v, p): rng.randrange(1, 6) for v in orders for p in rng.sample(range(9), 3)}
    done = [(v, p, 1) for (v, p), q in lines.items() if q > 2 and v % 3 == 0]
    reqs = [(i, rng.randrange(40), rng.randrange(64), rng.randrange(9), rng.choice([None, 0, 1, 1, 2, 3, 5])) for i in range(1500)]
    reqs += [(5000 + i, 90, v, p, q) for i, ((v, p), q) in enumerate(lines.items())]
    t = SimpleNamespace(
        ventas=spark.createDataFrame([(v, v, s, 10) for v, s in orders.items()], "id_venta long, id_cliente long, estado string, total int"),
        detalle_ventas=spark.createDataFrame([(*k, q) for k, q in lines.items()], "id_venta long, id_producto long, cantidad int"),
        devoluciones=spark.createDataFrame(done, "id_venta long, id_producto long, cantidad int"),
        productos=spark.createDataFrame([(p, 5, 3) for p in range(9)], "id_producto long, stock int, total_vendido int"))
    req = spark.createDataFrame(reqs, "request_id long, ts long, id_venta long, id_producto long, cantidad int")
    want, closed = brute_returns(orders, lines, done, reqs)
    by_id = {r[0]: r for r in reqs}
    for rows in (1_000_000, 20):  # one window an order; chunks for the larger ones
        monkeypatch.setattr(B, "ORDER_ROWS", rows, raising=False)
        out = B.bat_returns(t, req)
        assert {r.request_id: r.reason for r in out["decisions"].collect()} == want
        assert all(r.accepted == (r.reason is None) for r in out["decisions"].collect())
        assert sorted(r.order_id for r in out["cancelled"].collect()) == sorted(closed) != []
        moved = {p: sum(by_id[i][4] for i, why in want.items() if why is None and by_id[i][3] == p) for p in range(9)}
        assert {r.product_id: r.stock - 5 for r in out["stock"].collect()} == {p: q for p, q in moved.items() if q}
    monkeypatch.setattr(B, "ORDER_ROWS", 1_000_000, raising=False)
    # no hard line: requests, lines and balances are joined before the plan below, once
    assert joins(B.bat_returns(t, req.where("request_id >= 5000").where(F.col("id_venta") % 3 != 0))["decisions"]) <= 4


def test_table_sums_stay_within_long_arithmetic(spark, cat):
    """Amounts per line and order are summed as long cents, exactly."""
    from decimal import Decimal

    from emporium.functions import semantics as S
    from emporium.sources.testdata import TestdataCatalog
    amounts = ["0.01", "-0.01", "9999999999.99", "123.45"]
    df = spark.createDataFrame([(Decimal(a),) for a in amounts], "a decimal(12,2)")
    assert df.select(S.from_cents(F.sum(S.cents("a")))).first()[0] == sum(map(Decimal, amounts))
    lazy = TestdataCatalog(spark, cat.sf_dir, materialize=False)
    plan = lazy.ventas._jdf.queryExecution().optimizedPlan().toString()
    assert "sum(" in plan
    assert not any(f"decimal({n}" in plan for n in range(22, 39))


def test_tasks_hold_a_bounded_number_of_rows(spark, cat, monkeypatch):
    """The pair join and the ranking of related products take more tasks for
    more rows, though they compress to almost nothing."""
    from emporium.plans import analytics as Q
    from emporium.plans import reports as P
    monkeypatch.setattr(Q, "PAIR_LINES", 100, raising=False)
    monkeypatch.setattr(P, "RELATED_ROWS", 50, raising=False)
    for df, per_task, rows in ((Q.q07_basket_pairs(cat), 100, cat.detalle_ventas.count()),
                               (P.rpt_related_products(cat), 50, 6 * cat.productos.count())):
        plan = df._jdf.queryExecution().optimizedPlan().toString()
        assert f", {-(-rows // per_task)}" in "".join(x for x in plan.splitlines() if "RepartitionByExpression" in x)


def test_merged_carts_derive_no_other_output(spark):
    from emporium.plans import batch as B

    class Tables:
        clientes = spark.createDataFrame([(1,), (2,)], "id_cliente long")
        carritos = spark.createDataFrame([(7, 2)], "id_carrito long, id_cliente long")

        def __getattr__(self, name):
            raise AssertionError(f"{name} is not part of the carts")

    req = spark.createDataFrame([(1, 1, 2, 1)], "request_id long, primario long, secundario long, ts long")
    assert [tuple(r) for r in B.bat_merge_accounts(Tables(), req)["carts"].collect()] == [(7, 1)]


def test_new_names_meet_in_one_hash_join(spark):
    """Names that differ in case, accent, end spaces or ignorable characters are
    one name; they are neither sorted nor aggregated under the collation."""
    from emporium.plans import batch as B
    t = SimpleNamespace(
        categorias=spark.createDataFrame([(1, "SMALL")], "id_categoria int, nombre string"),
        proveedores=spark.createDataFrame([(1,)], "id_proveedor long"),
        productos=spark.createDataFrame([(7, "Café"), (8, "CAFE"), (9, "Mesa"), (10, None)], "id_producto long, nombre string"))
    rows = [(1, 5, "cafe ", 1), (2, 5, "Straße", 1), (3, 4, "STRASSE", 1), (4, 3, "strasse", 0), (5, 5, "Silla", 1), (6, 5, "silla  ", 1),
            (7, 5, "sílla", 1), (8, 1, None, 1), (9, 5, "me\u0001sa", 1), (10, 5, "mesas", 1), (11, 6, "Silla", 1)]
    req = spark.createDataFrame(rows, "request_id long, ts long, nombre string, precio int").selectExpr(
        "*", "1 AS costo", "1 AS stock", "CAST(NULL AS INT) AS id_categoria", "1L AS id_proveedor")
    out = B.bat_new_products(t, req)
    dup = B.MSG_DUPLICATE_NAME
    assert {r.request_id: r.reason for r in out.collect()} == {
        1: dup, 2: dup, 3: None, 4: B.MSG_PRICE, 5: None, 6: dup, 7: dup, 8: B.MSG_NULL, 9: dup, 10: None, 11: dup}
    assert {r.request_id: r.product_id for r in out.where("accepted").collect()} == {3: 14, 5: 16, 10: 21}
    plan = out._jdf.queryExecution().sparkPlan().toString()
    assert "ShuffledHashJoin [collationkey" in plan and "SortMergeJoin [collationkey" not in plan
    assert not any("Aggregate" in x and "collate(" in x.split("functions=")[0] for x in plan.splitlines())
    assert "Aggregate(key=[_k" not in plan


def test_refused_returns_are_stored_for_the_decisions_only(spark, monkeypatch):
    from emporium.plans import batch as B
    t = SimpleNamespace(
        ventas=spark.createDataFrame([(v, v, B.S.DELIVERED if v < 2 else "Enviado", 10) for v in range(20)],
                                     "id_venta long, id_cliente long, estado string, total int"),
        detalle_ventas=spark.createDataFrame([(v, 1, 3) for v in range(20)], "id_venta long, id_producto long, cantidad int"),
        devoluciones=spark.createDataFrame([], "id_venta long, id_producto long, cantidad int"),
        productos=spark.createDataFrame([(1, 5, 30)], "id_producto long, stock int, total_vendido int"))
    req = spark.createDataFrame([(v, 1, v, 1, 3) for v in range(22)], "request_id long, ts long, id_venta long, id_producto long, cantidad int")
    stored, call = [], B.kept
    monkeypatch.setattr(B, "kept", lambda df, name: stored.append(df.count()) or call(df, name))
    assert [tuple(r) for r in B.bat_returns(t, req)["stock"].collect()] == [(1, 11, 24)]
    assert sorted(r.order_id for r in B.bat_returns(t, req)["cancelled"].collect()) == [0, 1]
    assert stored == [2, 2]
    assert B.bat_returns(t, req)["decisions"].groupBy("accepted").count().orderBy("accepted").collect()[0][1] == 20
    assert stored == [2, 2, 22]

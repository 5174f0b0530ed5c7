"""Operators against brute-force Python on small fixtures."""

import random

import pytest

from pyspark.sql import functions as F

from emporium.operators import overlay
from emporium.operators.admission import greedy_admission, sequential_balance
from emporium.operators.changes import diff_snapshots
from emporium.operators.ledger import floored_totals
from emporium.operators.rank import global_row_number


@pytest.fixture
def small_chunks(monkeypatch):
    """Chunks of a few rows, so that a hot key takes many turns."""
    monkeypatch.setattr("emporium.operators.admission.CHUNK_ROWS", 40)


def brute_admission(reqs, caps):
    left = dict(caps)
    out = {}
    for rid, key, qty, ts in sorted(reqs, key=lambda r: (r[3], r[0])):
        if key not in left:
            out[rid] = False
        elif qty <= left[key]:
            left[key] -= qty
            out[rid] = True
        else:
            out[rid] = False
    return out


def test_admission_doc_example(spark):
    reqs = spark.createDataFrame([(1, 7, 6, 1), (2, 7, 5, 2), (3, 7, 4, 3), (4, 8, 1, 1), (5, 9, 1, 1)],
                                 "request_id long, k long, qty long, ts long")
    caps = spark.createDataFrame([(7, 10), (8, 5)], "k long, cap long")
    got = {r.request_id: r.accepted for r in greedy_admission(reqs, caps, "k", "qty").collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: False}


def test_admission_hot_key_in_many_chunks(spark, small_chunks):
    rng = random.Random(29)
    reqs = [(i, 0 if rng.random() < 0.8 else 1, rng.randrange(1, 9), rng.randrange(60)) for i in range(300)]
    caps = [(0, 150), (1, 20)]
    df = spark.createDataFrame(reqs, "request_id long, k long, qty long, ts long")
    cdf = spark.createDataFrame(caps, "k long, cap long")
    got = {r.request_id: r.accepted for r in greedy_admission(df, cdf, "k", "qty").collect()}
    assert got == brute_admission(reqs, caps)


def test_admission_matches_brute_force(spark):
    rng = random.Random(7)
    reqs = [(i, rng.randrange(4), rng.randrange(1, 9), rng.randrange(50)) for i in range(400)]
    caps = [(k, rng.randrange(0, 60)) for k in range(3)]  # key 3 unknown
    df = spark.createDataFrame(reqs, "request_id long, k long, qty long, ts long")
    cdf = spark.createDataFrame(caps, "k long, cap long")
    got = {r.request_id: r.accepted for r in greedy_admission(df, cdf, "k", "qty").collect()}
    assert got == brute_admission(reqs, caps)


def test_sequential_balance_matches_brute_force(spark):
    rng = random.Random(11)
    reqs = [(i, rng.randrange(3), rng.randrange(-12, 9) or 1, rng.randrange(30)) for i in range(300)]
    start = [(k, rng.randrange(0, 20)) for k in range(3)]
    bal = dict(start)
    want = {}
    for rid, k, d, ts in sorted(reqs, key=lambda r: (r[3], r[0])):
        if bal[k] + d >= 0:
            bal[k] += d
            want[rid] = True
        else:
            want[rid] = False
    df = spark.createDataFrame(reqs, "request_id long, k long, delta long, ts long")
    sdf = spark.createDataFrame(start, "k long, bal long")
    got = {r.request_id: r.accepted for r in sequential_balance(df, sdf, "k", "delta").collect()}
    assert got == want


def test_floored_totals_matches_fold(spark):
    rng = random.Random(3)
    ev = [(rng.randrange(4), rng.randrange(-30, 30), i) for i in range(200)]
    start = [(k, rng.randrange(0, 25)) for k in range(4)]
    cur = dict(start)
    for k, d, _ in ev:
        cur[k] = max(0, cur[k] + d)
    df = spark.createDataFrame(ev, "k long, d long, o long")
    sdf = spark.createDataFrame(start, "k long, start long")
    got = {r.k: r.final for r in floored_totals(df, sdf, "k", "d", ["o"]).collect()}
    assert got == cur


def test_global_row_number(spark):
    rng = random.Random(5)
    rows = [(i, rng.randrange(10)) for i in range(500)]
    df = spark.createDataFrame(rows, "id long, u long")
    got = {r.id: r.rn for r in global_row_number(df, [F.col("u"), F.col("id")], "rn").collect()}
    want = {rid: i + 1 for i, (rid, _) in enumerate(sorted(rows, key=lambda r: (r[1], r[0])))}
    assert got == want


def test_overlays(spark):
    target = spark.createDataFrame([(1, "a", 10), (2, "b", 20)], "k long, v string, w long")
    new = spark.createDataFrame([(2, "B"), (3, "C")], "k long, v string")
    up = sorted(tuple(r) for r in overlay.upsert(target, new, ["k"], ["v"]).collect())
    assert up == [(1, "a", 10), (2, "B", 20), (3, "C", None)]
    # running the same upsert twice is idempotent
    up2 = overlay.upsert(overlay.upsert(target, new, ["k"], ["v"]), new, ["k"], ["v"])
    assert sorted(tuple(r) for r in up2.collect()) == up
    full_new = spark.createDataFrame([(2, "B", 0), (3, "C", 1)], "k long, v string, w long")
    assert sorted(tuple(r) for r in overlay.replace_rows(target, full_new, ["k"]).collect()) == [
        (1, "a", 10), (2, "B", 0), (3, "C", 1)]
    assert sorted(tuple(r) for r in overlay.insert_ignore(target, full_new, ["k"]).collect()) == [
        (1, "a", 10), (2, "b", 20), (3, "C", 1)]
    assert sorted(tuple(r) for r in overlay.delete_where(target, F.col("w") > 15).collect()) == [(1, "a", 10)]


def test_diff_snapshots_ops(spark):
    old = spark.createDataFrame([(1, "x"), (2, "y"), (3, None)], "k long, v string")
    new = spark.createDataFrame([(2, "Y"), (3, None), (4, "z")], "k long, v string")
    got = sorted((r.k, r.op) for r in diff_snapshots(old, new, ["k"], "2026-01-01 00:00:00").collect())
    assert got == [(1, "D"), (2, "U"), (4, "I")]


def test_keyed_running_matches_brute_force_with_hot_key(spark):
    from emporium.operators.scan import keyed_running
    rng = random.Random(17)
    # key 0 holds ~60 % of the rows, key None is a real key too
    rows = []
    for i in range(1500):
        k = 0 if rng.random() < 0.6 else rng.choice([1, 2, 3, None])
        rows.append((i, k, rng.randrange(40), rng.randrange(-5, 9)))
    df = spark.createDataFrame(rows, "rid long, k long, ts long, d long")
    got = keyed_running(df, ["k"], ["ts", "rid"], sums={"run": "d"}, rank="rn",
                        lags={"prev": "rid"}, partitions=12)
    got = {r.rid: (r.run, r.rn, r.prev) for r in got.collect()}
    want, state = {}, {}
    for rid, k, ts, d in sorted(rows, key=lambda r: (r[2], r[0])):
        run, rn, prev = state.get(k, (0, 0, None))
        state[k] = (run + d, rn + 1, rid)
        want[rid] = (run + d, rn + 1, prev)
    assert got == want


def test_keyed_running_splits_a_hot_key(spark):
    """The hot key's rows land in many chunks (not in one task)."""
    from emporium.operators import scan
    df = spark.range(4000).select(F.lit(1).alias("k"), F.col("id").alias("ts"), F.lit(1).alias("d"))
    out = scan.keyed_running(df, ["k"], ["ts"], sums={"run": "d"}, partitions=8)
    assert sorted(r.run for r in out.collect()) == list(range(1, 4001))
    chunks = (df.repartitionByRange(8, "k", "ts").select(F.spark_partition_id().alias("p"))
              .distinct().count())
    assert chunks == 8


def test_sequential_balance_hot_key_and_hopeless_runs(spark, small_chunks):
    """One key with most requests, long runs of withdrawals that cannot pass
    interleaved with deposits, on the range-chunk path: still equal to the
    sequential fold."""
    rng = random.Random(23)
    reqs = []
    for i in range(300):
        k = 0 if rng.random() < 0.7 else rng.randrange(1, 4)
        d = rng.choice([-15, -9, -4, -1, 2, 3, 5]) if i % 50 else 40
        reqs.append((i, k, d, rng.randrange(200)))
    start = [(0, 0), (1, 3), (2, 10), (3, 0)]
    bal, want = dict(start), {}
    for rid, k, d, ts in sorted(reqs, key=lambda r: (r[3], r[0])):
        want[rid] = bal[k] + d >= 0
        if want[rid]:
            bal[k] += d
    df = spark.createDataFrame(reqs, "request_id long, k long, delta long, ts long")
    sdf = spark.createDataFrame(start, "k long, bal long")
    got = {r.request_id: r.accepted for r in sequential_balance(df, sdf, "k", "delta").collect()}
    assert got == want


def test_order_transitions_hot_order_matches_sequential(spark):
    """P10 on one order holding most requests: whitelist rounds = fold."""
    from types import SimpleNamespace

    from emporium.functions import semantics as S
    from emporium.plans.batch import bat_order_transitions
    rng = random.Random(31)
    states = list(S.ORDER_STATES)
    start = {1: "Pendiente de Pago", 2: "Procesando", 3: "Enviado", 4: "Entregado", 5: "Pendiente de Pago"}
    reqs = [(i, 1 if rng.random() < 0.7 else rng.randrange(2, 6), rng.choice(states), rng.randrange(100))
            for i in range(250)]
    allowed = set(S.TRANSITIONS)
    cur, want = dict(start), {}
    for rid, o, new, ts in sorted(reqs, key=lambda r: (r[3], r[0])):
        want[rid] = (cur[o], new) in allowed
        if want[rid]:
            cur[o] = new
    t = SimpleNamespace(
        spark=spark,
        ventas=spark.createDataFrame([(k, v) for k, v in start.items()], "id_venta long, estado string"),
        detalle_ventas=spark.createDataFrame([(1, 7, 2)], "id_venta long, id_producto long, cantidad int"),
        productos=spark.createDataFrame([(7, 10, 5)], "id_producto long, stock int, total_vendido int"))
    df = spark.createDataFrame([(rid, o, new, ts) for rid, o, new, ts in reqs],
                               "request_id long, id_venta long, nuevo_estado string, ts long")
    out = bat_order_transitions(t, df)
    got = {r.request_id: r.accepted for r in out["decisions"].collect()}
    assert got == want
    assert {r.order_id: r.state for r in out["orders"].collect()} == cur


def test_move_category_chains_match_sequential(spark):
    """P20 with chains (A->B then B->C), repeated origins, a cycle and a
    missing category: equal to applying the moves one by one."""
    from types import SimpleNamespace

    from emporium.plans.batch import bat_move_category
    rng = random.Random(37)
    cats = {1: 9, 2: 0, 3: 4, 4: 1, 5: 2}  # stored counters, deliberately stale
    prods = [(i, rng.choice([1, 2, 3, 4, 5, None])) for i in range(60)]
    reqs = [(i, rng.randrange(12), rng.choice([1, 2, 3, 4, 5, 99]), rng.choice([1, 2, 3, 4, 5])) for i in range(14)]
    cur = {pid: c for pid, c in prods}
    stamped = {pid: False for pid, _ in prods}
    touched = set()
    for rid, ts, o, d in sorted(reqs, key=lambda r: (r[1], r[0])):
        if o not in cats or d not in cats:
            continue
        touched |= {o, d}
        for pid in cur:
            if cur[pid] == o:
                stamped[pid] |= d != o
                cur[pid] = d
    want_counts = {c: (sum(1 for v in cur.values() if v == c) if c in touched else n) for c, n in cats.items()}
    t = SimpleNamespace(
        spark=spark,
        categorias=spark.createDataFrame(list(cats.items()), "id_categoria int, total_productos int"),
        productos=spark.createDataFrame(prods, "id_producto long, id_categoria int"))
    df = spark.createDataFrame(reqs, "request_id long, ts long, origen int, destino int")
    out = bat_move_category(t, df)
    assert {r.id_producto: (r.id_categoria, r.stamped) for r in out["products"].collect()} == {
        pid: (cur[pid], stamped[pid]) for pid in cur}
    assert {r.category_id: r.total_products for r in out["categories"].collect()} == want_counts


def test_admission_null_quantity_is_refused(spark):
    reqs = spark.createDataFrame([(1, 7, None, 1), (2, 7, 5, 2), (3, None, 1, 3)], "request_id long, k long, qty long, ts long")
    caps = spark.createDataFrame([(7, 5), (8, None)], "k long, cap long")
    got = {r.request_id: (r.accepted, r.reason) for r in greedy_admission(reqs, caps, "k", "qty").collect()}
    assert {k: v[0] for k, v in got.items()} == {1: False, 2: True, 3: False}
    assert got[1][1] and got[3][1] and got[2][1] is None


def test_sequential_balance_alternating_key_needs_one_turn_per_chunk(spark, small_chunks, monkeypatch):
    from emporium.operators import admission
    turns = []
    fold = admission._fold
    monkeypatch.setattr(admission, "_fold", lambda *a: turns.append(1) or fold(*a))
    reqs = [(i, 1, 5 if i % 2 == 0 else -6, i) for i in range(160)]
    bal, want = 0, {}
    for rid, _, d, _ in reqs:
        want[rid] = bal + d >= 0
        bal += d if want[rid] else 0
    df = spark.createDataFrame(reqs, "request_id long, k long, delta long, ts long")
    got = {r.request_id: r.accepted for r in sequential_balance(
        df, spark.createDataFrame([(1, 0)], "k long, bal long"), "k", "delta").collect()}
    assert got == want and 1 < len(turns) <= 4


def test_keyed_running_with_nulls_in_the_sum(spark):
    from emporium.operators.scan import keyed_running
    rows = [(i, None if i % 10 < 4 or i < 9 else i) for i in range(60)]
    df = spark.createDataFrame([(1, i, d) for i, d in rows], "k long, ts long, d long")
    got = {r.ts: r.run for r in keyed_running(df, ["k"], ["ts"], sums={"run": "d"}, partitions=9).collect()}
    run, want = None, {}
    for i, d in rows:
        run = run if d is None else (run or 0) + d
        want[i] = run
    assert got == want


def test_merges_reviews_and_products_follow_the_rules(spark):
    from types import SimpleNamespace

    from emporium.plans import batch as B
    t = SimpleNamespace(
        clientes=spark.createDataFrame([(i, 10, None, None) for i in range(8)],
                                       "id_cliente long, total_gastado int, nivel_lealtad string, referido_por long"),
        ventas=spark.createDataFrame([(1, 2)], "id_venta long, id_cliente long"),
        vistas_productos=spark.createDataFrame([(1, 2)], "id_vista long, id_cliente long"),
        carritos=spark.createDataFrame([(1, 2)], "id_carrito long, id_cliente long"),
        resenas_productos=spark.createDataFrame([(1, 2, 9), (2, 3, 9), (3, 1, 8), (4, 2, 8), (5, 7, 9)],
                                                "id_resena long, id_cliente long, id_producto long"),
        productos=spark.createDataFrame([(9, "Caf\u00e9")], "id_producto long, nombre string"),
        proveedores=spark.createDataFrame([(5,)], "id_proveedor long"),
        categorias=spark.createDataFrame([(1, "books")], "id_categoria int, nombre string"))
    req = spark.createDataFrame([(1, 1, 2, 1), (2, 1, 3, 2), (3, 4, 99, 3), (4, 4, 5, 4), (5, 6, 7, 5), (6, 7, 0, 6)],
                                "request_id long, primario long, secundario long, ts long")
    out = B.bat_merge_accounts(t, req)
    assert {r.request_id: r.accepted for r in out["decisions"].collect()} == {
        1: True, 2: True, 3: False, 4: True, 5: False, 6: False}
    assert sorted(tuple(r) for r in out["reviews"].collect()) == [(1, 1, 9), (3, 1, 8), (5, 7, 9)]
    assert [r.id_cliente for r in out["orders"].collect()] == [1]
    rev = spark.createDataFrame([(1, 9, 1, None, "a", 1), (2, 77, 1, 5, "b", 2), (3, 9, 1, 5, "c", 3), (4, 9, 66, 5, "d", 4)],
                                "request_id long, id_producto long, id_cliente long, calificacion int, comentario string, ts long")
    out = B.bat_review_upsert(t, rev)
    assert {r.request_id: r.accepted for r in out["decisions"].collect()} == {1: False, 2: False, 3: True, 4: False}
    assert [r.comment for r in out["state"].collect()] == ["c"]
    new = spark.createDataFrame([(1, None, 5, "CAFE", 1, 0, 0, 1), (2, 77, 5, "x", 1, 0, 0, 2), (3, 1, 6, "x", 1, 0, 0, 3),
                                 (4, 1, None, "x", 1, 0, 0, 4), (5, 1, 5, "X ", 1, 0, 0, 5), (6, 1, 5, None, 1, 0, 0, 6)],
                                "request_id long, id_categoria int, id_proveedor long, nombre string, precio int, costo int, "
                                "stock int, ts long")
    assert {r.request_id: r.accepted for r in B.bat_new_products(t, new).collect()} == {
        1: False, 2: False, 3: False, 4: True, 5: False, 6: False}


def test_admission_halves_in_logarithmic_rounds(spark, small_chunks, monkeypatch):
    """One key holds a third of all requests; rounds follow the stock, not the
    rows; no row passes through Python."""
    from emporium.operators import admission
    monkeypatch.setattr(admission, "CHUNK_ROWS", 2500)
    monkeypatch.setattr(admission, "_fold", None)
    rng, rounds = random.Random(41), []
    sizes = [0, 1, 2, 3, 9, 60, 500, 3000, 5000]
    reqs = [(i, 0 if i % 3 == 0 else rng.randrange(1, 60), rng.choice(sizes) + rng.randrange(3), rng.randrange(9000)) for i in range(30_000)]
    caps = [(k, rng.choice([0, 1, 7, 100, 4096])) for k in range(58)] + [(0, 5000)]
    caps = list(dict(caps).items())
    window = admission.Window.partitionBy
    monkeypatch.setattr(admission.Window, "partitionBy", lambda *c: rounds.append(1) or window(*c))  # twice a round
    df = spark.createDataFrame(reqs, "request_id long, k long, qty long, ts long")
    got = {r.request_id: r.accepted for r in greedy_admission(df, spark.createDataFrame(caps, "k long, cap long"), "k", "qty").collect()}
    assert got == brute_admission(reqs, caps)
    assert 4 < len(rounds) / 2 <= 2 + 13

"""Near-duplicate documents by a MinHash signature-coordinate join.

1. Every text becomes its set of 5-word shingles (ASCII lower case); equal
   sets are one class, so copies are never expanded into pairs.
2. A class has a signature of ``K`` minima.  Each (coordinate, value) is a
   posting list of classes.  Lists are ordered by length; a pair that agrees
   in at least ``T`` coordinates meets in one of its ``K - T + 1`` shortest
   lists, so only those (the prefix) are joined, lists of one class are
   dropped, and the ``T - 1`` longest are skipped and only probed.
3. Rounds: every list names a hub; each class not yet joined with the hub's
   group proposes the hub that it meets in most lists, the pair is confirmed on
   the full shingle sets (``100 * common >= 75 * union``), and confirmed groups
   are contracted.  A large group of near copies needs about one pair per
   member and round, and its lists drop out once they hold one group only.
   Rounds go on while they confirm a tenth of what they propose.
4. What is left are pairs of classes of *different* groups in a common list.
   Classes of lists of more than ``CELL`` members take an anchor, one class
   that most of their circle share, and those with an equal anchor are compared
   by their differences from it only (:func:`_anchored_links`): exactly, in
   blocks, without a row per pair or difference.
5. Other pairs are joined whole within their lists, but members of one anchor
   or of one large group never meet there: each list's sides pair up first
   (groups of up to ``CELL`` members count as one).  A pair comes from its first
   common list only.  Sizes and a one-bit sketch of ``BITS`` more minima must
   allow the similarity; survivors are confirmed on full sets.

No pair is lost for want of candidates but for the chance of the sketches: a
pair at similarity 0.75 exactly fails them with a probability of about 1e-4,
at 0.8 below 1e-6.

Defined results: null or word-less texts have an empty set, are linked with
nothing and are kept; a text of fewer than five words is one shingle;
repeated rows of one id go together; a null id takes the component of its
group (null if none has an id), links documents like any other and is kept
only if that is null; an empty table gives an empty table; columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import components, cut, keys, mix, shingle_set, tasks

K, T, N = 64, 34, 5
ROUNDS = 3
BITS, DIFFER = 2048, 316  # at 0.75 one bit in eight differs: 256 on average, deviation 15
CELL = 32
BLOCK, BLOCK_DIFFS = 512, 1_000_000  # classes and differences of a block, see _anchored_links
LOOSE = 0.3  # classes less similar than this to their anchor have none
_rng = np.random.default_rng(75)
_MULT = _rng.integers(0, 2 ** 63, K, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _signature(s: np.ndarray) -> np.ndarray:
    best = np.full(K, np.iinfo(np.uint64).max, dtype=np.uint64)
    for a in range(0, len(s), 4096):  # bounded memory for very long texts
        x = np.multiply.outer(_MULT, s[a:a + 4096])
        x ^= x >> np.uint64(32)
        np.minimum(best, (x * np.uint64(0x9E3779B97F4A7C15)).min(axis=1), out=best)
    return best.view(np.int64)


_SKETCH = _rng.integers(0, 2 ** 31, BITS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)


def _sketch(s: np.ndarray) -> np.ndarray:
    """``BITS`` one-bit minima, packed into longs."""
    s, best = (s >> np.uint64(32)).astype(np.uint32), np.full(BITS, 2 ** 32 - 1, dtype=np.uint32)
    for a in range(0, len(s), 256):
        np.minimum(best, np.multiply.outer(_SKETCH, s[a:a + 256]).min(axis=1), out=best)
    best = mix(best.astype(np.uint64) * np.uint64(BITS) + np.arange(BITS, dtype=np.uint64))
    return np.packbits((best & np.uint64(1)).astype(np.uint8)).view(np.int64)


def _fingerprint(s: np.ndarray) -> int:
    """64-bit fingerprint of a set (order-free sums of mixed members)."""
    x = np.uint64(len(s)) + mix(s ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)
    return int(mix(np.array([x], dtype=np.uint64)).view(np.int64)[0])


def shingled(docs: DataFrame) -> DataFrame:
    """``(doc_id, key, cls, n_shingles, sig)``; ``cls`` fingerprints the set,
    null for an empty one, ``key`` hashes the text."""

    def run(batches):
        for batch in batches:
            for n in range(0, batch.num_rows, 512):
                part = batch.slice(n, 512)
                cls, size, sig = [], [], []
                for t in part.column(2).to_pylist():
                    s = shingle_set(t, N)
                    size.append(len(s))
                    cls.append(_fingerprint(s) if len(s) else None)
                    sig.append(_signature(s) if len(s) else None)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(cls, pa.int64()), pa.array(size, pa.int64()),
                     pa.array(sig, pa.list_(pa.int64()))], names=["doc_id", "key", "cls", "n_shingles", "sig"])

    return docs.select("doc_id", "key", "text").mapInArrow(
        run, "doc_id long, key long, cls long, n_shingles long, sig array<long>")


def _sketched(texts: DataFrame) -> DataFrame:
    """``texts(cls, text)`` with the sketch; texts of other classes (under an
    id that is used twice) go."""

    def run(batches):
        for batch in batches:
            for n in range(0, batch.num_rows, 256):
                part = batch.slice(n, 256)
                sets = [shingle_set(t, N) for t in part.column(1).to_pylist()]
                own = [len(s) and _fingerprint(s) == c for s, c in zip(sets, part.column(0).to_pylist())]
                part = part.filter(pa.array([bool(x) for x in own], pa.bool_()))
                sketch = [_sketch(s) for s, x in zip(sets, own) if x]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(sketch, pa.list_(pa.int64()))],
                                                 names=["cls", "text", "sketch"])

    return texts.mapInArrow(run, "cls long, text string, sketch array<long>").dropDuplicates(["cls"])


def _confirm(pairs: DataFrame, texts: DataFrame, similarity: int) -> DataFrame:
    """``pairs(a, b)`` whose full shingle sets reach the similarity."""
    left = texts.select(F.col("cls").alias("a"), F.col("text").alias("ta"))
    right = texts.select(F.col("cls").alias("b"), F.col("text").alias("tb"))

    def run(batches):
        seen: dict[int, np.ndarray] = {}

        def of(c, t):
            if c not in seen:
                if len(seen) > 64:
                    seen.clear()
                seen[c] = shingle_set(t, N)
            return seen[c]

        for batch in batches:
            out = []
            a, b, ta, tb = batch.columns
            for i in range(batch.num_rows):
                x, y = a[i].as_py(), b[i].as_py()
                s, t = of(x, ta[i].as_py()), shingle_set(tb[i].as_py(), N)
                both = len(np.intersect1d(s, t, assume_unique=True))
                if 100 * both >= similarity * (len(s) + len(t) - both):
                    out.append((x, y))
            yield pa.RecordBatch.from_arrays([pa.array([p[0] for p in out], pa.int64()),
                                              pa.array([p[1] for p in out], pa.int64())], names=["a", "b"])

    return pairs.join(right, "b").join(left, "a").select("a", "b", "ta", "tb").mapInArrow(run, "a long, b long")


def _fits(x: str, y: str, similarity: int):
    """Sizes alone allow the similarity (no pair is lost by this)."""
    return (F.least(x, y) * 100 >= F.greatest(x, y) * similarity)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    similarity: int = 75) -> DataFrame:
    """``(doc_id, n_shingles, component_id, kept)`` for every row."""
    return _grouped(docs, id_col, text_col, similarity).drop("key", "root")


def _grouped(docs: DataFrame, id_col: str, text_col: str, similarity: int = 75) -> DataFrame:
    """:func:`near_duplicates` with the text's ``key`` and the group's ``root``."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("key", F.xxhash64("text"))
    rows = cut(shingled(docs))
    # One row stands for a class: the smallest id, a row without an id only where none has one.
    classes = cut(rows.where("cls is not null").groupBy("cls").agg(
        F.min("doc_id").alias("carrier"), F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).getField("key").alias("key"),
        F.first("n_shingles").alias("n"), F.first("sig").alias("sig")))

    lists = classes.select("cls", "n", F.posexplode("sig").alias("k", "v")) \
        .select("cls", "n", F.xxhash64("k", "v").alias("token"))
    common = lists.groupBy("token").agg(F.count("*").alias("len")).where("len > 1")
    prefix = (lists.join(common, "token").groupBy("cls", "n")
              .agg(F.sort_array(F.collect_list(F.struct("len", "token"))).alias("l"))  # at most K entries
              .where(F.size("l") >= T)
              .select("cls", "n", F.explode(F.slice("l", F.lit(1), F.size("l") - (T - 1))).alias("l"))
              .select("cls", "n", F.col("l.token").alias("token")))
    post = cut(prefix.withColumn("grp", F.col("cls")))
    # Texts of the classes that can have a partner, one document each.
    carriers = keys(post.select("cls").distinct().join(classes.select("cls", "carrier", F.col("key").alias("text_key")), "cls"))
    texts = cut(_sketched(docs.join(carriers, docs.doc_id.eqNullSafe(carriers.carrier) & (docs.key == carriers.text_key))
                          .select("cls", "text")))
    edges, few = None, tasks(post.count())  # no table of ids below has more rows than post
    for turn in range(ROUNDS):
        mixed = post.groupBy("token").agg(
            F.min("grp").alias("g1"), F.max("grp").alias("g2"),
            F.min_by(F.struct("cls", "grp", "n"), F.xxhash64("cls", F.lit(turn))).alias("hub")).where("g1 <> g2")
        meets = (post.join(mixed.select("token", F.col("hub.cls").alias("hub"), F.col("hub.grp").alias("hgrp"),
                                        F.col("hub.n").alias("hn")), "token")
                 .where("grp <> hgrp").where(_fits("n", "hn", similarity))
                 .groupBy("cls", "hub").count())
        pick = cut(meets.groupBy("cls").agg(F.max_by("hub", F.struct("count", "hub")).alias("hub"))
                   .select(F.least("cls", "hub").alias("a"), F.greatest("cls", "hub").alias("b")).distinct().coalesce(few))
        proposed = pick.count()
        if not proposed:
            break
        found = cut(_confirm(pick, texts, similarity))
        confirmed = found.count()
        if confirmed:
            edges = found if edges is None else edges.union(found)
            post = _regroup(post, components(edges), few)
        if confirmed * 10 < proposed:
            break
    rest = _left_over(post, few)
    if not rest.isEmpty():
        diffs = cut(_differences(_anchors(rest), texts))
        sure = cut(_anchored_links(diffs, rest, similarity))
        if not sure.isEmpty():
            edges = sure if edges is None else edges.union(sure)
            rest = _left_over(_regroup(rest, components(edges), few), few)
        pairs = cut(_cross_pairs(rest, diffs, texts.select("cls", "sketch"), similarity))
        if not pairs.isEmpty():
            found = cut(_confirm(pairs, texts, similarity))
            edges = found if edges is None else edges.union(found)
    groups = classes.select("cls", "carrier")
    if edges is not None:
        roots = components(edges)
        first = (groups.join(roots, groups.cls == roots.id).groupBy("root").agg(F.min("carrier").alias("first")))
        groups = (groups.join(roots.join(first, "root").select(F.col("id").alias("cls"), "root", "first"), "cls", "left")
                  .select("cls", F.coalesce("first", "carrier").alias("component"), F.coalesce("root", "cls").alias("root")))
    else:
        groups = groups.select("cls", F.col("carrier").alias("component"), F.col("cls").alias("root"))
    out = rows.select("doc_id", "key", "cls", "n_shingles").join(groups, "cls", "left")
    comp = F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select("doc_id", "key", "root", "n_shingles", comp.alias("component_id"),
                      F.col("doc_id").eqNullSafe(comp).alias("kept"))


def _regroup(post: DataFrame, roots: DataFrame, few: int) -> DataFrame:
    return cut(post.drop("grp").join(roots.select(F.col("id").alias("cls"), "root"), "cls", "left")
               .select("cls", "n", "token", F.coalesce("root", "cls").alias("grp")).coalesce(few))


def _left_over(post: DataFrame, few: int) -> DataFrame:
    """Entries of lists that still hold more than one group."""
    mixed = post.groupBy("token").agg(F.min("grp").alias("g1"), F.max("grp").alias("g2")).where("g1 <> g2")
    return cut(post.join(mixed.select("token"), "token").coalesce(few))


def _anchors(rest: DataFrame) -> DataFrame:
    """``(cls, anchor)`` for classes of lists of more than ``CELL`` members:
    the class of the least hash in any of these lists."""
    low = F.struct(F.xxhash64("cls", F.lit("anchor")).alias("h"), "cls")
    long = rest.groupBy("token").agg(F.count("*").alias("len"), F.min(low).alias("low")).where(F.col("len") > CELL)
    return (rest.select("token", "cls").join(long, "token").groupBy("cls")
            .agg(F.min("low").getField("cls").alias("anchor")))


def _differences(anchors: DataFrame, texts: DataFrame) -> DataFrame:
    """``(cls, anchor, diff)``: the shingles that only one of class and anchor
    has; classes unlike their anchor (below ``LOOSE``) go."""
    own = texts.select("cls", F.col("text").alias("t"))
    base = texts.select(F.col("cls").alias("anchor"), F.col("text").alias("ta"))

    def run(batches):
        last = (None, None)
        for batch in batches:
            cls, anchor, diff = [], [], []
            for c, a, t, ta in zip(*(col.to_pylist() for col in batch.columns)):
                if last[0] != a:
                    last = (a, shingle_set(ta, N))
                s = shingle_set(t, N)
                d = np.setxor1d(s, last[1], assume_unique=True)
                union = (len(s) + len(last[1]) + len(d)) // 2
                if union - len(d) >= LOOSE * union:
                    cls.append(c), anchor.append(a), diff.append(d.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(cls, pa.int64()), pa.array(anchor, pa.int64()),
                                              pa.array(diff, pa.list_(pa.int64()))], names=["cls", "anchor", "diff"])

    return (anchors.join(own, "cls").join(base, "anchor").select("cls", "anchor", "t", "ta")
            .mapInArrow(run, "cls long, anchor long, diff array<long>"))


def _anchored_links(diffs: DataFrame, rest: DataFrame, similarity: int) -> DataFrame:
    """``(a, b)`` of classes with one anchor that links connect, from ``diffs``.

    Sets of ``n_a`` and ``n_b`` members with the differences ``D`` from one anchor differ in
    ``|D_a| + |D_b| - 2 |D_a & D_b|``, so with ``x = more |D| - less n`` they are
    linked if and only if ``2 more |D_a & D_b| >= x_a + x_b``: an exact test on full sets.

    The classes of an anchor are dealt into blocks of about ``BLOCK`` classes and at
    most some ``BLOCK_DIFFS`` differences; a cell compares two blocks in memory of
    that size and returns who is connected there, one row per class at most, never
    the pairs.  Anchors whose classes are in one group already have no cells."""
    more, less = 100 + similarity, 100 - similarity
    base = cut(diffs.join(rest.select("cls", "grp", "n").distinct(), "cls")
               .select("cls", "anchor", "grp", "diff", (F.size("diff") * more - F.col("n") * less).alias("x")))
    sizes = (base.groupBy("anchor").agg(F.count("*").alias("c"), F.sum(F.size("diff")).alias("d"),
                                        F.min("grp").alias("g1"), F.max("grp").alias("g2")).where("g1 <> g2")
             .select("anchor", F.ceil(F.greatest(F.col("c") / BLOCK, F.col("d") / BLOCK_DIFFS)).alias("blocks")))
    mine = F.pmod(F.xxhash64("cls", F.lit("block")), F.col("blocks"))
    cells = (base.join(sizes, "anchor").withColumn("mine", mine)
             .withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
             .select("anchor", F.least("mine", "other").alias("lo"), F.greatest("mine", "other").alias("hi"),
                     "mine", "cls", "grp", "x", "diff"))

    def run(cell: pa.Table) -> pa.Table:
        cls, grp, x, side = (cell.column(c).to_numpy() for c in ("cls", "grp", "x", "mine"))
        diff = cell.column("diff").combine_chunks()
        row = np.repeat(np.arange(len(cls)), np.diff(diff.offsets.to_numpy()))
        linked = 2 * more * _common(row, diff.flatten().to_numpy(), len(cls)) >= x[:, None] + x[None, :]
        if side.min() != side.max():  # pairs within a block meet in its own cell
            linked &= side[:, None] != side[None, :]
        linked |= grp[:, None] == grp[None, :]
        label, before = np.arange(len(cls)), None
        while before is None or (label != before).any():
            before = label
            label = np.where(linked, label[None, :], len(cls)).min(axis=1)
            label = label[label]
        far = grp != grp[label]
        return pa.table({"a": cls[label][far], "b": cls[far]})

    return cells.groupBy("anchor", "lo", "hi").applyInArrow(run, "a long, b long")


def _common(row: np.ndarray, value: np.ndarray, n: int) -> np.ndarray:
    """``n x n`` numbers of common values of the rows (a value is once in a row).
    Values of up to 32 rows are counted by their pairs, others by products of
    incidence matrices of bounded width."""
    _, col, freq = np.unique(value, return_inverse=True, return_counts=True)
    out = np.zeros(n * n, dtype=np.int64)
    few = freq[col] <= CELL
    r, c = row[few], col[few]
    order = np.argsort(c, kind="stable")
    r, c = r[order], c[order]
    for d in range(1, CELL):
        same = c[d:] == c[:-d]
        if not same.any():
            break
        out += np.bincount(r[:-d][same] * n + r[d:][same], minlength=n * n)
    out = out.reshape(n, n)
    out += out.T
    place = np.cumsum(freq > CELL) - 1
    r, c = row[~few], place[col[~few]]
    for at in range(0, (c.max() + 1) if len(c) else 0, 4096):
        here = (c >= at) & (c < at + 4096)
        m = np.zeros((n, 4096), dtype=np.float32)
        m[r[here], c[here] - at] = 1
        out += (m @ m.T).astype(np.int64)
    np.fill_diagonal(out, np.bincount(row, minlength=n))
    return out


def _differ() -> str:
    return " + ".join(f"bit_count(get(sketch_a, {i}) ^ get(sketch_b, {i}))" for i in range(BITS // 64))


def _cross_pairs(rest: DataFrame, anchored: DataFrame, sketch: DataFrame, similarity: int) -> DataFrame:
    """Pairs of classes of different groups and anchors that share a list of
    ``rest`` and that sizes and sketches allow, each from its first common list.
    ``side`` is a member's anchor, without one its group in the list, 0 for
    all groups of up to ``CELL``."""
    alone = rest.groupBy("token", "grp").agg(F.count("*").alias("c"))
    side = F.when(F.col("anchor").isNull(), F.when(F.col("c") > CELL, F.col("grp")).otherwise(F.lit(0))).otherwise(
        F.xxhash64("anchor", F.lit("side")))
    sides = (rest.join(alone, ["token", "grp"]).join(anchored.select("cls", "anchor"), "cls", "left")
             .select("token", "grp", "cls", "n", side.alias("side")))
    mixed = (sides.groupBy("token").agg(F.min("side").alias("s1"), F.max("side").alias("s2"))
             .where("s1 <> s2 OR s1 = 0").select("token"))
    sides = cut(sides.join(mixed, "token"))
    order = (sides.groupBy("cls").agg(F.array_sort(F.collect_list("token")).alias("all"))  # at most K entries
             .join(sketch, "cls"))
    wide = cut(sides.join(order, "cls").select("token", "side", "grp", "cls", "n", "sketch", F.expr(
        "filter(all, t -> t < token)").alias("before")))
    one = sides.select("token", "side").distinct()
    cells = (one.join(one.select("token", F.col("side").alias("other")), "token")
             .where("side < other OR (side = 0 AND other = 0)"))
    a = cells.join(wide, ["token", "side"]).select("token", "side", "other", *[F.col(c).alias(f"{c}_a") for c in (
        "grp", "cls", "n", "sketch", "before")])
    b = wide.select(F.col("token").alias("token_b"), F.col("side").alias("side_b"), *[F.col(c).alias(f"{c}_b") for c in (
        "grp", "cls", "n", "sketch", "before")])
    near = F.expr(f"""token = token_b AND other = side_b AND grp_a <> grp_b AND (side <> other OR cls_a < cls_b)
        AND least(n_a, n_b) * 100 >= greatest(n_a, n_b) * {similarity}
        AND {_differ()} <= {DIFFER} AND NOT arrays_overlap(before_a, before_b)""")
    return (a.join(b, near)
            .select(F.least("cls_a", "cls_b").alias("a"), F.greatest("cls_a", "cls_b").alias("b")).distinct())


def drop_near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with one document of each group: the smallest id, of several
    texts under it the one of the smallest hash (a group without any id keeps
    one text).  Documents go by id and text, so another text under the same id
    stays; equal rows count as one document, of which one row stays; word-less
    documents stay."""
    named = docs.columns
    own = docs.withColumn("__dedup_key", F.xxhash64(F.col(text_col).cast("string"))).withColumn("__dedup_id", F.col(id_col).cast("long"))
    found = cut(_grouped(docs, id_col, text_col).where("root is not null").select("doc_id", "key", "root"))
    first = found.groupBy("root").agg(F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "key")).alias("one"))
    each = found.groupBy("root", "doc_id", "key").agg(F.count("*").alias("n"))
    me = F.struct(F.col("doc_id").isNull(), "doc_id", "key")
    marked = cut(each.join(first, "root").select(F.col("doc_id").alias("__dedup_d"), F.col("key").alias("__dedup_k"),
                                                 (me == F.col("one")).alias("stays"), "n").where("NOT stays OR n > 1"))
    same = F.col("__dedup_id").eqNullSafe(F.col("__dedup_d")) & (F.col("__dedup_key") == F.col("__dedup_k"))
    out = own.join(keys(marked.select("__dedup_d", "__dedup_k")), same, "left_anti").select(named)
    again = keys(marked.where("stays").select("__dedup_d", "__dedup_k"))
    return out.unionByName(own.join(again, same, "left_semi").dropDuplicates(["__dedup_id", "__dedup_key"]).select(named))

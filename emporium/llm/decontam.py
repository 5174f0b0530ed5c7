"""Benchmark decontamination by spaced-seed hashing (DataFrame functions only).

Texts become lower-case words.  A seed mask names the word offsets that are
hashed and those that are ignored, so a substituted word at an ignored offset
does not disturb the hash.  The masked hashes of all training windows are
joined with those of the benchmark; a hit fixes the alignment (diagonal) of
document and item, and the alignment around the hits is verified: some
``SPAN`` consecutive words (all words of a shorter item) must agree in at
least ``AGREE`` percent of their places.  The masks are chosen by enumeration:
wherever the places that may differ lie, some mask misses them all.  Items
shorter than ``LEAST`` words have masks of their own for each length that the
benchmark holds; an item of up to four words must be found word for word.

The benchmark's hashes are broadcast only after they are counted: up to
``BROADCAST_ROWS`` rows (16 bytes each); beyond that both sides are shuffled
on the hash.  Hits carry ids only; texts of documents with hits are joined
back once per document.

Defined results: null, empty or word-less texts on either side match nothing;
very short items are searched like all others; very long texts are searched
whole; repeated benchmark rows count once per id; repeated rows of a
document with equal text give one result row each in :func:`contaminated` and
share their matches; null ids are kept apart by the text's hash; empty tables
give empty results; columns other than id and text are not read.
"""

from __future__ import annotations

from itertools import combinations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import cut, keys

#: Offsets that are hashed, of three masks: they hit any two substitutions in 12, 13 or 14 words.
MASKS = ((0, 1, 2, 3, 4, 5), (0, 1, 2, 5, 7, 8), (0, 1, 3, 5, 9, 10))
SPAN, AGREE = 14, 80
#: Items from this length on are searched by ``MASKS``.
LEAST = 12
BROADCAST_ROWS = 2_000_000
SEPARATOR = r"[^\p{L}\p{N}]+"


def _words(text: str):
    t = F.btrim(F.regexp_replace(F.lower(F.coalesce(F.col(text), F.lit(""))), SEPARATOR, " "))
    return F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, " "))


def missed(masks, size: int, wrong: int) -> set[tuple[int, ...]]:
    """Places of ``wrong`` substitutions in ``size`` words that disturb every mask at every start."""
    hashed = [{t + o for o in m} for m in masks for t in range(size - max(m))]
    return {p for p in combinations(range(size), wrong) if all(h & set(p) for h in hashed)}


#: Items of fewer words are reported, but no reason to drop a document.
LEAST_DROP = 5


def short_masks(size: int, agree: int = AGREE) -> list[tuple[int, ...]]:
    """Masks of up to six offsets that miss no allowed substitutions in ``size`` words."""
    wrong = size * (100 - agree) // 100
    out: list[tuple[int, ...]] = []
    pool = [(0, *x) for x in combinations(range(1, size), min(6, size - wrong) - 1)]
    while not out or missed(out, size, wrong):
        out.append(min(pool, key=lambda m: (len(missed([*out, m], size, wrong)), m)))
    return out


def _seeds(hashes: str, masks, items: bool) -> F.Column:
    """All masked hashes, mask after mask, as one array of structs; each mask
    comes with the least and the largest size of the items it is for."""
    parts = []
    for m, (offsets, low, high) in enumerate(masks):
        span = max(offsets) + 1
        gets = ", ".join(f"get({hashes}, i + {o})" for o in offsets)
        unfit = f"size({hashes}) < {span}" + (f" OR size({hashes}) NOT BETWEEN {low} AND {high}" if items else "")
        parts.append(f"CASE WHEN {unfit} THEN array() ELSE "
                     f"transform(sequence(0, size({hashes}) - {span}), i -> struct(i AS i, xxhash64({m}, {gets}) AS h)) END")
    return F.expr(f"concat({', '.join(parts)})")


def _seed_rows(df: DataFrame, keys: list[str], masks, items: bool = False) -> DataFrame:
    h = df.select(*keys, F.expr("transform(words, w -> xxhash64(w))").alias("_h"))
    return (h.select(*keys, F.explode(_seeds("_h", masks, items)).alias("_s"))
            .select(*keys, F.col("_s.i").alias("i"), F.col("_s.h").alias("h")))


def matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
            item_col: str = "item_id", item_text: str = "text", masks=MASKS, span: int = SPAN,
            agree: int = AGREE) -> DataFrame:
    """``(doc_id, _row, item_id, doc_start, item_start, n_words, n_equal)``:
    verified overlaps, one row per document, item and diagonal (the window
    with most agreement); ``_row`` is the hash of the text."""
    d = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    src = d.select("doc_id", "text", F.xxhash64("text").alias("_row"))
    d = src.select("doc_id", "_row", _words("text").alias("words"))
    b = (benchmark.select(F.col(item_col).cast("long").alias("item_id"), _words(item_text).alias("words"))
         .where(F.size("words") > 0).dropDuplicates(["item_id", "words"])
         .select("item_id", F.xxhash64("words").alias("item_row"), "words"))
    short = b.select(F.size("words").alias("n")).where(F.col("n") < LEAST).distinct().collect()  # fewer than LEAST rows
    masks = [(m, LEAST, 1 << 30) for m in masks] + [(m, r.n, r.n) for r in sorted(short) for m in short_masks(r.n, agree)]
    test = _seed_rows(b, ["item_id", "item_row"], masks, items=True).withColumnRenamed("i", "j")
    small = test.limit(BROADCAST_ROWS + 1).count() <= BROADCAST_ROWS
    hits = cut(_seed_rows(d, ["doc_id", "_row"], masks).join(F.broadcast(test) if small else test, "h")
            .groupBy("doc_id", "_row", "item_id", "item_row", (F.col("i") - F.col("j")).alias("diag"))
            .agg(F.sort_array(F.collect_set("j")).alias("at")))  # at most one entry per word of the item
    texts = keys(hits.select(F.col("doc_id").alias("_d"), F.col("_row").alias("_r")).distinct())
    found = src.join(texts, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_row") == F.col("_r")), "left_semi") \
        .dropDuplicates(["doc_id", "_row"]).select(F.col("doc_id").alias("_d"), F.col("_row").alias("_r"), _words("text").alias("words"))
    items = b.select(F.col("item_id").alias("_i"), F.col("item_row").alias("_ir"), F.col("words").alias("item"))
    pairs = (hits.join(found, F.col("doc_id").eqNullSafe(F.col("_d")) & (F.col("_row") == F.col("_r")))
             .join(items, F.col("item_id").eqNullSafe(F.col("_i")) & (F.col("item_row") == F.col("_ir"))))
    n = f"least({span}, size(item))"
    # Equal places along the diagonal as an array of 0 and 1, then prefix sums.
    pairs = pairs.select("doc_id", "_row", "item_id", "diag", F.size("item").alias("m"), F.expr(n).alias("n"), F.expr(
        "transform(item, (w, j) -> if(j + diag >= 0 AND get(words, j + diag) <=> w, 1, 0))").alias("eq"),
        F.array_min("at").alias("lo"), F.array_max("at").alias("hi"))
    # Windows around the hits: those that start within `span` words before the first or up to the last one.
    pairs = pairs.select("doc_id", "_row", "item_id", "diag", "n", F.expr("""
        array_max(transform(sequence(greatest(0, least(lo, m - n) - n), least(hi, m - n)), s ->
            struct(aggregate(slice(eq, s + 1, n), 0, (a, e) -> a + e) AS equal, -s AS s)))""").alias("best"))
    return pairs.where(F.col("best.equal") * 100 >= F.col("n") * agree).select(
        "doc_id", "_row", "item_id", (F.col("diag") - F.col("best.s")).cast("long").alias("doc_start"),
        (-F.col("best.s")).cast("long").alias("item_start"), F.col("n").cast("long").alias("n_words"),
        F.col("best.equal").cast("long").alias("n_equal"))


def contaminated(docs: DataFrame, benchmark: DataFrame, **kw) -> DataFrame:
    """``(doc_id, n_items, items)`` per document with a verified overlap;
    items is a sorted comma-joined list."""
    m = matches(docs, benchmark, **kw)
    return (m.groupBy("doc_id", "_row").agg(F.sort_array(F.collect_set("item_id")).alias("_items"))
            .select("doc_id", "_row", F.size("_items").cast("long").alias("n_items"),
                    F.array_join(F.transform("_items", lambda x: x.cast("string")), ",").alias("items")))


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                      item_text: str = "text", least: int = LEAST_DROP) -> DataFrame:
    """``docs`` without the documents that overlap a benchmark item of
    ``least`` words or more (plain prose holds most shorter items)."""
    benchmark = benchmark.where(F.size(_words(item_text)) >= least)
    bad = keys(contaminated(docs, benchmark, id_col=id_col, text_col=text_col, item_text=item_text)
               .select(F.col("doc_id").alias("_d"), F.col("_row").alias("_r")))
    cond = docs[id_col].cast("long").eqNullSafe(F.col("_d")) & (F.xxhash64(docs[text_col].cast("string")) == F.col("_r"))
    return docs.join(bad, cond, "left_anti")

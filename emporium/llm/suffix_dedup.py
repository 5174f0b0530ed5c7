"""Repeated passages by a sparse suffix array.

Only suffixes at content-selected positions are kept: a word position whose
``KGRAM``-word hash is the smallest of ``WINDOW`` neighbours (its minimiser).
Any passage of ``LENGTH`` words holds such a position within its first
``WINDOW`` words, so at least ``LENGTH - WINDOW + 1`` words of the passage
follow it.  The kept suffixes are sorted by the hash of those words (range
partitions on (key, document, place): a passage that a third of the corpus
shares is split over many tasks) and neighbours are compared; equal ones, and
those at the border of a partition, are extended to the left and right: each
gives the ``LENGTH``-word windows that start up to ``WINDOW - 1`` words before
it, and a window found in two documents is a repeated passage.  Overlapping
windows of a document join into maximal spans.  The result equals a search
over all windows; no pair of documents is formed.

Rule: a passage repeats if the same ``LENGTH`` words (ASCII lower case) stand
in two documents with different ids.  A window is *kept* in the document with
the smallest id that holds it and *cut* from the others.

Defined results: null, empty or shorter texts have no span; repeated rows of
one id are one document; a null id is not searched and gives a row without
spans; an empty table gives an empty table; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import keys, ngram_hashes, table, word_hashes

LENGTH, KGRAM, WINDOW = 50, 10, 24


def minimisers(h: np.ndarray, kgram: int, window: int) -> np.ndarray:
    """Sorted distinct minimiser positions (leftmost of equals)."""
    g = ngram_hashes(h, kgram)
    if len(g) < window:
        return np.empty(0, dtype=np.int64)
    v = np.lib.stride_tricks.sliding_window_view(g, window)
    out = [np.arange(a, a + len(v[a:a + 65536])) + v[a:a + 65536].argmin(axis=1) for a in range(0, len(v), 65536)]
    return np.unique(np.concatenate(out))


def _suffixes(docs: DataFrame, length: int, kgram: int, window: int) -> DataFrame:
    def run(batches):
        for batch in batches:
            for n in range(0, batch.num_rows, 512):
                part = batch.slice(n, 512)
                keys, ids, places = [], [], []
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    h = word_hashes(t)
                    if len(h) < length:
                        continue
                    head = ngram_hashes(h, length - window + 1)
                    at = minimisers(h, kgram, window)
                    at = at[at < len(head)]
                    keys.append(head[at].view(np.int64))
                    ids.append(np.full(len(at), d, dtype=np.int64))
                    places.append(at.astype(np.int32))
                cat = lambda x, t: np.concatenate(x) if x else np.empty(0, t)
                yield pa.RecordBatch.from_arrays([pa.array(cat(keys, np.int64)), pa.array(cat(ids, np.int64)),
                                                  pa.array(cat(places, np.int32))], names=["key", "doc_id", "place"])

    return docs.where("doc_id is not null").mapInArrow(run, "key long, doc_id long, place int")


def _neighbours(suffixes: DataFrame) -> DataFrame:
    """Suffixes whose key equals that of a neighbour in sorted order, and both
    ends of each partition (their neighbour is elsewhere)."""
    n = int(suffixes.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = suffixes.repartitionByRange(n, "key", "doc_id", "place").sortWithinPartitions("key", "doc_id", "place")

    def run(batches):
        last_key, held, kept_held = None, None, True
        for batch in batches:
            if not batch.num_rows:
                continue
            key = batch.column(0).to_numpy(zero_copy_only=False)
            same = np.flatnonzero(key[1:] == key[:-1])
            keep = np.zeros(len(key), dtype=bool)
            keep[same] = keep[same + 1] = True
            if last_key is None:
                keep[0] = True
            elif last_key == key[0]:
                keep[0], kept_held = True, True
            if held is not None and kept_held:
                yield held
            yield batch.slice(0, len(key) - 1).filter(pa.array(keep[:-1]))
            last_key, held, kept_held = key[-1], batch.slice(len(key) - 1), bool(keep[-1])
        if held is not None:
            yield held

    return order.mapInArrow(run, suffixes.schema).select("doc_id", "place").distinct()


def _windows(docs: DataFrame, anchors: DataFrame, length: int, window: int) -> DataFrame:
    """``(win, doc_id, start)``: windows that extend an anchor."""
    places = anchors.groupBy("doc_id").agg(F.collect_list("place").alias("places"))
    some = docs.join(keys(anchors.select("doc_id").distinct()), "doc_id", "left_semi")
    src = some.join(places, "doc_id").select("doc_id", "text", "places")

    def run(batches):
        for batch in batches:
            ids, texts, at = batch.columns
            for i in range(batch.num_rows):
                h = ngram_hashes(word_hashes(texts[i].as_py()), length)
                mark = np.zeros(len(h) + 1, dtype=np.int32)
                p = np.asarray(at[i].values.to_numpy(zero_copy_only=False))
                p = p[p < len(h) + window]
                np.add.at(mark, np.minimum(np.maximum(p - window + 1, 0), len(h)), 1)
                np.add.at(mark, np.minimum(p + 1, len(h)), -1)
                s = np.flatnonzero(np.cumsum(mark[:-1]) > 0)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h[s].view(np.int64)), pa.array(np.full(len(s), ids[i].as_py(), dtype=np.int64)),
                     pa.array(s.astype(np.int32))], names=["win", "doc_id", "start"])

    return src.mapInArrow(run, "win long, doc_id long, start int")


def _spans(starts: str, length: int) -> str:
    """SQL: maximal spans (start, end) that windows at ``starts`` cover."""
    first = f"filter({starts}, (x, i) -> i = 0 OR x > get({starts}, i - 1) + {length})"
    final = (f"transform(filter({starts}, (x, i) -> i = size({starts}) - 1 OR get({starts}, i + 1) > x + {length}), "
             f"x -> x + {length})")
    return (f"transform(arrays_zip({first}, {final}), "
            f"z -> named_struct('start', cast(z['0'] as long), 'end', cast(z['1'] as long)))")


def repeated_passages(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH,
                      kgram: int = KGRAM, window: int = WINDOW) -> DataFrame:
    """``(doc_id, repeated, cut)`` per document with a repeated passage: arrays
    of word spans (start, end), all repeated ones and those to cut."""
    if kgram + window - 1 > length:
        raise ValueError("kgram + window - 1 must not exceed length")
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    anchors = table(_neighbours(table(_suffixes(docs, length, kgram, window))))
    wins = table(_windows(docs, anchors, length, window))
    shared = (wins.groupBy("win").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"))
              .where("first <> last").select("win", "first"))
    per = (wins.join(shared, "win").groupBy("doc_id").agg(
        F.array_sort(F.collect_set("start")).alias("all"),
        F.array_sort(F.collect_set(F.when(F.col("first") != F.col("doc_id"), F.col("start")))).alias("drop")))
    return per.select("doc_id", F.expr(_spans("all", length)).alias("repeated"), F.expr(_spans("drop", length)).alias("cut"))

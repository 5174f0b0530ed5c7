"""Stupid-backoff language-model scores over the whole corpus.

Model: with c the counts of words and word pairs over all documents and N the
number of words, ``S(w | v) = c(vw) / c(v)`` if the pair occurs at least
``MIN_COUNT`` times, else ``ALPHA * c(w) / N``; the first word of a document
scores ``c(w) / N``.  A document's score is the sum of ``ln S`` over its words.

Plan: documents are read in blocks (bounded by words); a block sends each of
its distinct n-grams once, as sorted 64-bit hashes with the block's counts,
to the count table's partition for that hash range.  There the blocks' counts
are added up and joined back to each block's n-grams; the answers return to
the block, whose word sequence (dictionary coded) gives the sum per document.
A word that fills a third of the corpus is one entry per block, so no
partition is hot; the hash ranges are sized so that one holds ``RANGE_NGRAMS``
entries.  Everything gathered grows with the corpus; nothing is sampled.

Defined results: null, empty or word-less texts have no words and score null;
repeated rows are scored (and counted) each; a null id stays null; an empty
table gives an empty table; columns other than id and text are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import ngram_hashes, word_hashes

ALPHA, MIN_COUNT = 0.4, 2
BLOCK_WORDS = 2_000_000
RANGE_NGRAMS = 2_000_000


def _pack(x: np.ndarray) -> bytes:
    return len(x).to_bytes(8, "little") + pa.compress(np.ascontiguousarray(x).tobytes(), codec="zstd", asbytes=True)


def _unpack(b: bytes, dtype: str) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    return np.frombuffer(pa.decompress(b[8:], n * np.dtype(dtype).itemsize, codec="zstd", asbytes=True), dtype)


def _pack_sorted(x: np.ndarray) -> bytes:
    """Sorted hashes as differences in byte planes: the high bytes are small."""
    d = np.diff(x, prepend=np.uint64(0)).astype("<u8")
    planes = np.ascontiguousarray(d.view(np.uint8).reshape(-1, 8).T)
    return len(x).to_bytes(8, "little") + pa.compress(planes.tobytes(), codec="zstd", asbytes=True)


def _unpack_sorted(b: bytes) -> np.ndarray:
    n = int.from_bytes(b[:8], "little")
    planes = np.frombuffer(pa.decompress(b[8:], 8 * n, codec="zstd", asbytes=True), np.uint8).reshape(8, n)
    return np.cumsum(np.ascontiguousarray(planes.T).view("<u8").ravel(), dtype=np.uint64)


def _pairs_of(words: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Positions whose word has a predecessor in the same document."""
    first = np.zeros(len(words), dtype=bool)
    first[(np.cumsum(sizes) - sizes)[sizes > 0]] = True
    return np.flatnonzero(~first)


def _grams(uniq: np.ndarray, code: np.ndarray, sizes: np.ndarray):
    """Pair positions, the sorted distinct n-gram hashes of a block (0, which
    counts all words, then words and pairs) and the pair's hash per position."""
    words = uniq[code]
    at = _pairs_of(words, sizes)
    both = ngram_hashes(words, 2)[at - 1] if len(at) else np.empty(0, np.uint64)
    return at, np.unique(np.concatenate([np.zeros(1, np.uint64), uniq, both])), both


def _requests(docs: DataFrame, ranges: int, block_words: int) -> DataFrame:
    """Per block one index row (``part`` negative and its own: ids, words per
    document, dictionary, word sequence) and one row per hash range (n-grams,
    the block's counts)."""

    def emit(block, ids, hashes):
        sizes = np.array([len(h) for h in hashes], dtype="<i8")
        uniq, code, count = np.unique(np.concatenate(hashes), return_inverse=True, return_counts=True)
        order = np.argsort(-count, kind="stable")  # frequent words get small codes, which pack well
        new = np.empty(len(uniq), dtype="<u4")
        new[order] = np.arange(len(uniq), dtype="<u4")
        uniq, code = uniq[order], new[code]
        _, grams, both = _grams(uniq, code, sizes)
        own = np.zeros(len(grams), dtype="<i8")
        own[np.searchsorted(grams, uniq)] = count[order]
        place, times = np.unique(np.searchsorted(grams, both), return_counts=True)
        own[place] = times
        own[0] = len(code)
        rows = [(block, -1 - block, ids, _pack(sizes), _pack(uniq), _pack(code))]
        part = (grams // np.uint64((2 ** 64 - 1) // ranges + 1)).astype(np.int64) if ranges > 1 else np.zeros(len(grams), np.int64)
        edge = np.searchsorted(part, np.arange(ranges + 1))
        rows += [(block, int(k), None, _pack_sorted(grams[edge[k]:edge[k + 1]]), _pack(own[edge[k]:edge[k + 1]]), None)
                 for k in np.unique(part)]
        for n in range(0, len(rows), 64):
            cols = list(zip(*rows[n:n + 64]))
            types = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.binary(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)],
                                             names=["block", "part", "ids", "x", "y", "z"])

    def run(batches):
        from pyspark import TaskContext
        block = TaskContext.get().partitionId() << 32
        ids, hashes, size = [], [], 0
        for batch in batches:
            for n in range(0, batch.num_rows, 256):
                part = batch.slice(n, 256)
                for d, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist()):
                    ids.append(d)
                    hashes.append(word_hashes(t))
                    size += len(hashes[-1])
                    if size >= block_words or len(ids) >= block_words:
                        yield from emit(block, ids, hashes)
                        block, ids, hashes, size = block + 1, [], [], 0
        if ids:
            yield from emit(block, ids, hashes)

    return docs.mapInArrow(run, _ROW)


_ROW = "block long, part long, ids array<long>, x binary, y binary, z binary"


def _answer(table: pa.Table) -> pa.Table:
    """One hash range: adds up the blocks' counts and answers every block.  An
    index row is a group of its own and passes through to its block."""
    if table["part"][0].as_py() < 0:
        return table
    grams = [_unpack_sorted(b) for b in table["x"].to_pylist()]
    own = np.concatenate([_unpack(b, "<i8") for b in table["y"].to_pylist()])
    _, inverse = np.unique(np.concatenate(grams), return_inverse=True)
    total = np.zeros(int(inverse.max()) + 1, dtype="<i8")
    np.add.at(total, inverse, own)
    ends = np.cumsum([len(g) for g in grams])
    out = [_pack(total[inverse[e - len(g):e]]) for g, e in zip(grams, ends)]
    none = pa.nulls(table.num_rows, pa.binary())
    return pa.table({"block": table["block"], "part": table["part"], "ids": pa.nulls(table.num_rows, pa.list_(pa.int64())),
                     "x": pa.array(out, pa.binary()), "y": none, "z": none})


def score(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", alpha: float = ALPHA,
          min_count: int = MIN_COUNT, block_words: int = BLOCK_WORDS, range_ngrams: int = RANGE_NGRAMS) -> DataFrame:
    """``(doc_id, n_words, n_backoff, log_score)`` for every row."""
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    chars = docs.agg(F.sum(F.length("text"))).first()[0] or 0
    ranges = max(1, round(chars / 5 / range_ngrams))
    merged = _requests(docs, ranges, block_words).groupBy("part").applyInArrow(_answer, _ROW)

    def total(table: pa.Table) -> pa.Table:
        rows = sorted(zip(table["part"].to_pylist(), range(table.num_rows)))
        at = rows[0][1]
        ids, sizes = table["ids"][at].as_py(), _unpack(table["x"][at].as_py(), "<i8")
        uniq, code = _unpack(table["y"][at].as_py(), "<u8"), _unpack(table["z"][at].as_py(), "<u4")
        count = np.concatenate([_unpack(table["x"][i].as_py(), "<i8") for _, i in rows[1:]])
        at, grams, both = _grams(uniq, code, sizes)
        words = count[np.searchsorted(grams, uniq)][code].astype(float)
        pair = count[np.searchsorted(grams, both)].astype(float)
        ln = np.log(words / max(1, count[0]))
        back = pair < min_count
        ln[at] = np.where(back, np.log(alpha) + ln[at], np.log(np.maximum(pair, 1) / words[at - 1]))
        doc = np.repeat(np.arange(len(sizes)), sizes)
        sums = np.bincount(doc, weights=ln, minlength=len(sizes))
        backs = np.bincount(doc[at], weights=back, minlength=len(sizes)).astype(np.int64)
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "n_words": pa.array(sizes, pa.int64()),
                         "n_backoff": pa.array(backs, pa.int64()),
                         "log_score": pa.array(sums, pa.float64(), mask=sizes == 0)})

    return merged.groupBy("block").applyInArrow(
        total, "doc_id long, n_words long, n_backoff long, log_score double")

"""Alignment of two tokenizers over the same bytes, with corpus-wide counts.

Tokens of A (a byte-level BPE file) and of B (a sentencepiece model) cover the
same bytes, a blank and the text.  Offsets at which tokens of both end cut them
into groups; a link is a pair of token occurrences whose byte ranges overlap.
The count of an id pair is the number of documents that hold it linked.

1. Documents are encoded once into a table of packed ids.  First pass: every
   block of documents is aligned and sums, per id pair, the documents that hold
   it.  Pairs are dealt into ``SHARDS`` by their A id.
2. The distinct pairs of a shard are united over a tree of blocks
   (``FAN`` to one) and get a minimal perfect hash: per level a bit array in
   which the pairs that hash alone have a bit; the others go on to the next
   level; the rank of a pair's bit is its slot (:func:`perfect_hash`).
3. Block counts become dense vectors indexed by that hash and are summed over
   the same tree.  The vectors of a shard are bounded by the two vocabularies,
   not by the corpus.
4. The root of a shard holds pairs by slot (looked-up pairs are verified
   against them), counts, and whether a count is the highest of its A id.
5. Second pass: documents are aligned again and look their pairs up.  Up to
   ``BROADCAST_PAIRS`` pairs the tables are broadcast; beyond, the documents'
   pairs go to their shards and sums come back.

Texts are aligned in segments that begin at a blank after a character that is
no white space: A's pattern never matches across such a place and no piece of B
continues over a blank (checked when B is loaded), so tokens, groups and links
of segments are those of the whole text.  A worker remembers encoded segments.

Defined results: null and empty texts, and texts whose joined token bytes
differ from blank and text, have no tokens (zeros, empty groups) and count
nowhere; very long texts are aligned whole; repeated rows are documents of
their own; a null id stays null; an empty table gives an empty table; other
columns are not read.
"""

from __future__ import annotations

import hashlib
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import halve, mix, table, worker_state
from emporium.llm.token_counts import SEGMENT

SHARDS, FAN = 64, 16
BROADCAST_PAIRS = 2_000_000  # 17 bytes each
BLOCK_CHARS = 1_000_000
FLUSH = 400_000
MEMO = 300_000


# --- minimal perfect hash ----------------------------------------------------

def _spread(keys: np.ndarray, level: int) -> np.ndarray:
    return mix(keys.astype(np.uint64) + np.uint64((level * 0x9E3779B97F4A7C15) % 2 ** 64))


def perfect_hash(keys: np.ndarray) -> tuple[list[int], np.ndarray]:
    """``(bits per level, words of all levels)`` for distinct ``keys``."""
    sizes, words, rest = [], [], keys
    while len(rest):
        size = 64 * max(1, -(-2 * len(rest) // 64))
        at = (_spread(rest, len(sizes)) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        words.append(np.packbits(alone, bitorder="little").view("<u8"))
        rest = rest[~alone[at]]
    return sizes, np.concatenate(words) if words else np.empty(0, dtype="<u8")


def slots(keys: np.ndarray, sizes: list[int], words: np.ndarray) -> np.ndarray:
    """Slot of every key; -1 for keys that no level holds."""
    ones = np.bitwise_count(words).astype(np.int64)
    rank = np.concatenate(([0], np.cumsum(ones)))
    out, left, base = np.full(len(keys), -1, dtype=np.int64), np.arange(len(keys)), 0
    for level, size in enumerate(sizes):
        at = (_spread(keys[left], level) % np.uint64(size)).astype(np.int64)
        word, bit = base + (at >> 6), (at & 63).astype(np.uint64)
        has = (words[word] >> bit) & np.uint64(1) > 0
        low = words[word] & ((np.uint64(1) << bit) - np.uint64(1))
        out[left[has]] = (rank[word] + np.bitwise_count(low))[has]
        left, base = left[~has], base + size // 64
    return out


class Shard:
    """Counts of one shard's pairs; lookups are verified against the pairs."""

    def __init__(self, sizes, words, pairs, counts, best):
        self.sizes, self.words, self.pairs, self.counts, self.best = list(sizes), words, pairs, counts, best

    def look_up(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = slots(keys, self.sizes, self.words)
        if (at < 0).any() or (self.pairs[at] != keys).any():
            raise ValueError("a pair of the second pass was not in the first")
        return self.counts[at], self.best[at]


def shard_of(keys: np.ndarray) -> np.ndarray:
    return (mix((keys >> 32).astype(np.uint64)) % np.uint64(SHARDS)).astype(np.int64)


# --- encoding ----------------------------------------------------------------

def _byte_of_char() -> dict[str, int]:
    """The byte-level alphabet: printable bytes stand for themselves, the
    others for the characters from 256 on, in order."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(other)}


class Tokenizers:
    """Both tokenizers, the bytes of their tokens and the segments encoded so far."""

    def __init__(self, a_text: str, b_model: bytes):
        import os
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark's tasks are the parallelism
        import sentencepiece
        from tokenizers import Tokenizer
        self.a = Tokenizer.from_str(a_text)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_proto=b_model)
        byte, vocab = _byte_of_char(), self.a.get_vocab(with_added_tokens=True)
        self.a_bytes = [b""] * (max(vocab.values()) + 1)
        for t, i in vocab.items():
            self.a_bytes[i] = bytes(byte[c] for c in t) if all(c in byte for c in t) else t.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.b_bytes = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("▁", " ").encode()
                        for i, p in enumerate(pieces)]
        if any(x != "▁" and y == "▁" for p in pieces for x, y in zip(p, p[1:])):
            raise ValueError("a piece continues over a blank")
        self.code = "H" if max(len(self.a_bytes), len(pieces)) <= 2 ** 16 else "I"
        self.kind = np.dtype(self.code)
        self.a_memo: dict[str, bytes] = {}
        self.b_memo: dict[str, bytes | None] = {}  # None: other bytes than the text's
        self.quick = self._ranked(a_text)

    def _ranked(self, a_text: str):
        """A's merges replayed by rank, for texts of Latin letters only (whose
        classes no library sees otherwise); None unless A's ids are its ranks."""
        import json

        import public_tokenizers
        import tiktoken
        spec = json.loads(a_text)
        merges = [m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"]]
        vocab = spec["model"]["vocab"]
        first = len(_byte_of_char())
        if spec["normalizer"] or (spec["pre_tokenizer"] or {}).get("type") != "ByteLevel" or any(
                vocab["".join(m)] != first + n for n, m in enumerate(merges)):
            return None
        ranks = {self.a_bytes[i]: i for i in range(first + len(merges))}
        return tiktoken.Encoding("ranked", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})

    def _encode_a(self, texts: list[str]) -> list[list[int]]:
        out: list = [None] * len(texts)
        rest = range(len(texts))
        if self.quick is not None:
            for n, t in enumerate(texts):
                if t.isascii() or max(t) < "\u0250":
                    out[n] = self.quick.encode_ordinary(t)
            rest = [n for n in rest if out[n] is None]
        for n, e in zip(rest, self.a.encode_batch_fast([texts[n] for n in rest], add_special_tokens=False)):
            out[n] = e.ids
        return out

    def _encode_b(self, texts: list[str]) -> list[list[int]]:
        """Texts begin with a blank, which the model adds by itself."""
        return self.b.encode([t[1:] for t in texts], num_threads=1)

    def _pack(self, ids) -> bytes:
        return array(self.code, ids).tobytes()

    def encode(self, texts: list[str]) -> tuple[list[bytes], list[bytes]]:
        """Packed ids of A and B for blank and text; both empty without tokens."""
        found = [SEGMENT.findall(" " + t) if t else [] for t in texts]
        for memo in (self.a_memo, self.b_memo):  # filled alike, so halved alike
            halve(memo, MEMO)
        new = list(set().union(*found) - self.b_memo.keys())
        for n in range(0, len(new), 4096):
            part = new[n: n + 4096]
            self.a_memo.update(zip(part, map(self._pack, self._encode_a(part))))
            for t, ids in zip(part, self._encode_b(part)):
                same = b"".join(map(self.b_bytes.__getitem__, ids)) == t.encode("utf-8", "surrogatepass")
                self.b_memo[t] = self._pack(ids) if same else None
        a, b = [], []
        for t, f in zip(texts, found):
            parts = list(map(self.b_memo.__getitem__, f))
            if None in parts:  # decided on the whole text
                x, y = self._encode_a([" " + t])[0], self._encode_b([" " + t])[0]
                want = (" " + t).encode("utf-8", "surrogatepass")
                same = all(b"".join(map(of.__getitem__, ids)) == want for of, ids in ((self.a_bytes, x), (self.b_bytes, y)))
                a.append(self._pack(x if same else []))
                b.append(self._pack(y if same else []))
            else:
                a.append(b"".join(map(self.a_memo.__getitem__, f)))
                b.append(b"".join(parts))
        return a, b


# --- alignment ---------------------------------------------------------------

class Vocabulary:
    """Lengths of tokens and their decimal ids before each separator."""

    def __init__(self, a_bytes: list[int], b_bytes: list[int], kind: str):
        self.kind = np.dtype(kind)
        self.size = [np.array(x, dtype=np.int64) for x in (a_bytes, b_bytes)]
        self.text = [[np.array([f"{i}{end}" for i in range(len(x))], dtype=object) for end in ends]
                     for x, ends in ((a_bytes, ",|"), (b_bytes, ",;"))]


class Aligned:
    """A block of documents, aligned: between two neighbouring token ends (of
    A or of B) lies one link; ends of both close a group."""

    def __init__(self, vocabulary: Vocabulary, a: list[bytes], b: list[bytes]):
        self.vocabulary = vocabulary
        self.n = [np.array([len(x) for x in side], dtype=np.int64) // vocabulary.kind.itemsize for side in (a, b)]
        self.ids = [np.frombuffer(b"".join(side), dtype=vocabulary.kind).astype(np.int64) for side in (a, b)]
        self.ends = [np.cumsum(size[i]) for size, i in zip(vocabulary.size, self.ids)]
        total = int(self.ends[0][-1]) if len(self.ends[0]) else 0
        marks = []
        for e in self.ends:
            marks.append(np.zeros(total + 1, dtype=np.int64))
            marks[-1][e] = 1
        at = np.flatnonzero(marks[0] | marks[1])
        left, right = (i[(np.cumsum(m) - m)[at]] for i, m in zip(self.ids, marks))
        self.pairs = left << 32 | right
        both = marks[0] & marks[1]
        before = np.cumsum(both) - both
        self.group = [before[e] for e in self.ends]
        self.full = np.flatnonzero(self.n[0])  # documents with tokens
        last = self.ends[0][np.cumsum(self.n[0])[self.full] - 1]
        self.doc = self.full[np.searchsorted(last, at)]  # of every link
        self.n_links = np.bincount(self.doc, minlength=len(a))
        self.n_groups = np.bincount(self.full[np.searchsorted(last, np.flatnonzero(both))], minlength=len(a))

    def sums(self, of_link: np.ndarray) -> np.ndarray:
        out = np.zeros(len(self.n_links), dtype=np.int64)
        np.add.at(out, self.doc, of_link)
        return out

    def doc_pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """``(keys, document, number of key, times)``: every pair once per document."""
        keys, number = np.unique(self.pairs, return_inverse=True)
        both, times = np.unique(self.doc * max(1, len(keys)) + number, return_counts=True)
        return keys, both // max(1, len(keys)), both % max(1, len(keys)), times

    def texts(self) -> list[str]:
        parts = []
        for ids, group, (more, end) in zip(self.ids, self.group, self.vocabulary.text):
            close = np.append(group[1:] != group[:-1], [True] * min(1, len(group)))
            parts.append(np.where(close, end[ids], more[ids]))
        order = np.argsort(np.concatenate([self.group[0] * 2, self.group[1] * 2 + 1]), kind="stable")
        parts = np.concatenate(parts)[order].tolist()
        stop = np.cumsum(self.n[0] + self.n[1]).tolist()
        return ["".join(parts[x:y])[:-1] for x, y in zip([0, *stop], stop)]


def _blocks(batches, most: int, size_of):
    """Parts of batches of about ``most`` units of ``size_of(part row)``."""
    for batch in batches:
        at = 0
        while at < batch.num_rows:
            size, end = 0, at
            while end < batch.num_rows and (end == at or size < most):
                size += size_of(batch, end)
                end += 1
            yield batch.slice(at, end - at)
            at = end


# --- Spark jobs --------------------------------------------------------------

def _lists(values: list[np.ndarray], kind) -> pa.Array:
    offsets = np.concatenate(([0], np.cumsum([len(v) for v in values]))).astype(np.int32)
    return pa.ListArray.from_arrays(offsets, pa.array(np.concatenate([*values, np.empty(0, dtype=np.int64)]).astype(np.int64), kind))


def _np(column, i: int) -> np.ndarray:
    return column[i].values.to_numpy(zero_copy_only=False).astype(np.int64)


def _rows(names, *columns) -> pa.Table:
    return pa.table(dict(zip(names, columns)))


def encode(docs: DataFrame, shared, version: str) -> DataFrame:
    """``(doc_id, a, b)``: packed ids of both tokenizers."""

    def run(batches):
        both = worker_state(f"tokenizers-{version}", lambda: Tokenizers(*shared.value))
        for part in _blocks(batches, BLOCK_CHARS, lambda x, i: len(x.column(1)[i].as_py() or "")):
            a, b = both.encode([t or "" for t in part.column(1).to_pylist()])
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(a, pa.binary()), pa.array(b, pa.binary())],
                                             names=["doc_id", "a", "b"])

    return docs.mapInArrow(run, "doc_id long, a binary, b binary")


def _aligned(batches, vocabulary):
    """``(part, Aligned)`` of blocks of encoded documents."""
    for part in _blocks(batches, BLOCK_CHARS, lambda x, i: len(x.column(1)[i].as_py())):
        yield part, Aligned(vocabulary, part.column(1).to_pylist(), part.column(2).to_pylist())


def block_counts(ids: DataFrame, held) -> DataFrame:
    """First pass: ``(shard, node, pairs, counts)``; a node is a task's block."""

    def run(batches):
        from pyspark import TaskContext
        node, held_counts = TaskContext.get().partitionId(), []

        def flush():
            k, back = np.unique(np.concatenate([x[0] for x in held_counts]), return_inverse=True)
            c = np.bincount(back, weights=np.concatenate([x[1] for x in held_counts]), minlength=len(k)).astype(np.int64)
            held_counts[:] = [(k, c)]

        def out():
            flush()
            k, c = held_counts.pop()
            s = shard_of(k)
            order = np.argsort(s, kind="stable")
            here, begin = np.unique(s[order], return_index=True)
            cut = [order[a:b] for a, b in zip(begin, [*begin[1:], len(order)])]
            return pa.RecordBatch.from_arrays(
                [pa.array(here, pa.int32()), pa.array([node] * len(here), pa.int64()), _lists([k[x] for x in cut], pa.int64()),
                 _lists([c[x] for x in cut], pa.int64())], names=["shard", "node", "pairs", "counts"])

        for _, block in _aligned(batches, held.value):
            k, _, number, _ = block.doc_pairs()
            held_counts.append((k, np.bincount(number, minlength=len(k))))
            if sum(len(x[0]) for x in held_counts) > FLUSH:
                flush()
                if len(held_counts[0][0]) > FLUSH:
                    yield out()
        if held_counts:
            yield out()

    return ids.mapInArrow(run, "shard int, node long, pairs array<long>, counts array<long>")


def _tree(df: DataFrame, top: int, value: str, join) -> DataFrame:
    """Rows ``(shard, node, value)`` joined ``FAN`` nodes to one, until node 0."""
    def merge(key, rows):
        c = rows.column(value).combine_chunks()
        return _rows(("shard", "node", value), pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()),
                     _lists([join([_np(c, i) for i in range(len(c))])], pa.int64()))

    while True:
        df = df.withColumn("node", F.floor(F.col("node") / FAN).cast("long"))
        df = table(df.groupBy("shard", "node").applyInArrow(merge, f"shard int, node long, {value} array<long>"))
        top //= FAN
        if top == 0:
            return df


def pair_table(partial: DataFrame) -> DataFrame:
    """``(shard, sizes, words, pairs, counts, best)`` by slot, one row a shard."""
    top = partial.agg(F.max("node")).first()[0]
    if top is None:
        return partial.sparkSession.createDataFrame(
            [], "shard int, sizes array<long>, words array<long>, pairs array<long>, counts array<long>, best array<long>")
    known = _tree(partial.select("shard", "node", "pairs"), top, "pairs", lambda xs: np.unique(np.concatenate(xs)))

    def hashed(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                k = _np(batch.column(1), i)
                sizes, words = perfect_hash(k)
                by_slot = np.empty(len(k), dtype=np.int64)
                by_slot[slots(k, sizes, words)] = k
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(i, 1), _lists([np.array(sizes)], pa.int64()), _lists([words.view("<i8")], pa.int64()),
                     _lists([by_slot], pa.int64())], names=["shard", "sizes", "words", "pairs"])

    names = "shard int, sizes array<long>, words array<long>, pairs array<long>"
    hashes = table(known.select("shard", "pairs").mapInArrow(hashed, names))
    # Dense vectors of FAN blocks each; a shard's hash goes to each of its groups of blocks.
    groups = partial.select("shard", "pairs", "counts", F.floor(F.col("node") / FAN).cast("long").alias("node"))
    to = table(groups.select("shard", "node").distinct().join(hashes.select("shard", "sizes", "words"), "shard"))

    def dense(key, left, right):
        sizes, words = _np(right.column("sizes").combine_chunks(), 0), _np(right.column("words").combine_chunks(), 0).view("<u8")
        out = np.zeros(int(np.bitwise_count(words).sum()), dtype=np.int64)
        pairs, counts = left.column("pairs").combine_chunks(), left.column("counts").combine_chunks()
        for i in range(len(pairs)):
            out[slots(_np(pairs, i), sizes.tolist(), words)] += _np(counts, i)
        return _rows(("shard", "node", "counts"), pa.array([key[0].as_py()], pa.int32()), pa.array([key[1].as_py()], pa.int64()),
                     _lists([out], pa.int64()))

    vectors = table(groups.groupBy("shard", "node").cogroup(to.groupBy("shard", "node")).applyInArrow(
        dense, "shard int, node long, counts array<long>"))
    total = _tree(vectors, top // FAN, "counts", lambda xs: np.sum(xs, axis=0))

    def best(batches):
        for batch in batches:
            marks = []
            for i in range(batch.num_rows):
                a, c = _np(batch.column(3), i) >> 32, _np(batch.column(4), i)
                _, back = np.unique(a, return_inverse=True)
                top = np.zeros(int(back.max()) + 1, dtype=np.int64)
                np.maximum.at(top, back, c)
                marks.append((c == top[back]).astype(np.int64))
            yield pa.RecordBatch.from_arrays([*batch.columns, _lists(marks, pa.int64())],
                                             names=["shard", "sizes", "words", "pairs", "counts", "best"])

    return table(hashes.join(total.select("shard", "counts"), "shard").mapInArrow(
        best, f"{names}, counts array<long>, best array<long>"))


def _shards(rows) -> dict[int, Shard]:
    """Shards by number from a table or batch of :func:`pair_table`."""
    c = {k: rows.column(k) for k in rows.schema.names}
    c = {k: v.combine_chunks() if isinstance(v, pa.ChunkedArray) else v for k, v in c.items()}
    return {s: Shard(_np(c["sizes"], i).tolist(), _np(c["words"], i).view("<u8"), _np(c["pairs"], i), _np(c["counts"], i),
                     _np(c["best"], i).astype(np.int8)) for i, s in enumerate(c["shard"].to_pylist())}


_OUT = ("doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups")
_STATS = "doc_id long, n_a long, n_b long, n_groups long, n_links long"


def _stat_columns(part, block: Aligned):
    return [part.column(0), *[pa.array(x, pa.int64()) for x in (*block.n, block.n_groups, block.n_links)]]


def _scored(ids: DataFrame, held, tables: dict[int, Shard]) -> DataFrame:
    """Second pass with the tables in every worker."""
    shards = ids.sparkSession.sparkContext.broadcast(tables)

    def run(batches):
        for part, block in _aligned(batches, held.value):
            keys, number = np.unique(block.pairs, return_inverse=True)
            count, best = np.zeros(len(keys), dtype=np.int64), np.zeros(len(keys), dtype=np.int64)
            s = shard_of(keys)
            order = np.argsort(s, kind="stable")
            here, begin = np.unique(s[order], return_index=True)
            for k, a, b in zip(here.tolist(), begin, [*begin[1:], len(order)]):
                x = order[a:b]
                count[x], best[x] = shards.value[k].look_up(keys[x])
            yield pa.RecordBatch.from_arrays(
                [*_stat_columns(part, block), pa.array(block.sums(best[number]), pa.int64()),
                 pa.array(block.sums(count[number]), pa.int64()), pa.array(block.texts(), pa.string())], names=list(_OUT))

    return ids.mapInArrow(run, f"{_STATS}, n_best long, count_sum long, groups string")


def _scored_by_shard(ids: DataFrame, held, pairs: DataFrame) -> DataFrame:
    """Second pass where documents' pairs go to their shards: one table of the
    documents (shard -1) and of their pairs per block and shard."""
    names = ["shard", "row", "doc_id", "n_a", "n_b", "n_groups", "n_links", "groups", "rows", "asked", "times"]

    def run(batches):
        from pyspark import TaskContext
        row = TaskContext.get().partitionId() << 40
        for part, block in _aligned(batches, held.value):
            n = part.num_rows
            empty = _lists([np.empty(0, dtype=np.int64)] * n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array([-1] * n, pa.int32()), pa.array(np.arange(row, row + n), pa.int64()), *_stat_columns(part, block),
                 pa.array(block.texts(), pa.string()), empty, empty, empty], names=names)
            keys, doc, number, times = block.doc_pairs()
            s = shard_of(keys)[number]
            here = np.unique(s)
            cut = [np.flatnonzero(s == k) for k in here]
            none = [pa.nulls(len(here), pa.int64())] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(here, pa.int32()), *none, pa.nulls(len(here), pa.string()), *[_lists([v[x] for x in cut], pa.int64())
                 for v in (row + doc, keys[number], times)]], names=names)
            row += n

    both = table(ids.mapInArrow(run, f"shard int, row long, {_STATS}, groups string, rows array<long>, "
                                     "asked array<long>, times array<long>"))
    # The blocks' rows of one shard are many: the join splits them (skew join) or has the few rows of ``pairs`` everywhere.
    asked = both.where("shard >= 0").select(F.col("shard").alias("to"), "rows", "asked", "times")

    def look(batches):
        for batch in batches:
            for i in range(batch.num_rows):
                c, b = next(iter(_shards(batch.slice(i, 1)).values())).look_up(_np(batch.column("asked"), i))
                times = _np(batch.column("times"), i)
                row, back = np.unique(_np(batch.column("rows"), i), return_inverse=True)
                sums = [np.zeros(len(row), dtype=np.int64) for _ in "cb"]
                np.add.at(sums[0], back, c * times)
                np.add.at(sums[1], back, b * times)
                yield pa.RecordBatch.from_arrays([pa.array(v, pa.int64()) for v in (row, sums[1], sums[0])],
                                                 names=["row", "n_best", "count_sum"])

    sums = (asked.join(pairs, F.col("to") == F.col("shard")).drop("to")
            .mapInArrow(look, "row long, n_best long, count_sum long").groupBy("row")
            .agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum")))
    none = F.lit(0).cast("long")
    return both.where("shard = -1").select("row", *_OUT[:5], "groups").join(sums, "row", "left").select(
        *_OUT[:5], F.coalesce("n_best", none).alias("n_best"), F.coalesce("count_sum", none).alias("count_sum"), "groups")


def align(docs: DataFrame, a_path: str, b_path: str, id_col: str = "doc_id", text_col: str = "text",
          broadcast_pairs: int = BROADCAST_PAIRS) -> DataFrame:
    """``(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups)`` of
    every row; ``groups`` reads ``a1,a2|b1;a3|b2,b3`` in order."""
    sc = docs.sparkSession.sparkContext
    with open(a_path, encoding="utf-8") as f, open(b_path, "rb") as g:
        files = f.read(), g.read()
    version = hashlib.sha256(files[0].encode() + files[1]).hexdigest()
    both = Tokenizers(*files)
    held = sc.broadcast(Vocabulary([len(x) for x in both.a_bytes], [len(x) for x in both.b_bytes], both.kind.str))
    docs = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    ids = table(encode(docs, sc.broadcast(files), version), compression="zstd")
    pairs = pair_table(table(block_counts(ids, held)))
    total = pairs.agg(F.coalesce(F.sum(F.size("pairs")), F.lit(0))).first()[0]
    return _scored_by_shard(ids, held, pairs) if total > broadcast_pairs else _scored(ids, held, _shards(pairs.toArrow()))

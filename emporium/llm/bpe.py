"""Byte-level BPE encoding and decoding by merge replay.

Texts are split by the tokenizer's pattern; the distinct pieces of a block of
documents that the worker has not met yet form a small corpus on which all
merges are replayed: an inverted index maps the rank of a token pair to the
places where that pair stands, ranks are taken in ascending order, every place
is merged, and only the two touched neighbours enter the index anew.  The
first ranks, with many places each, are merged as arrays.  A piece that is itself a token is
that token.  Blocks are bounded by characters; pieces already encoded are
remembered per worker process, over its tasks, and the older half is forgotten
above ``MEMO`` entries, so memory is bounded and no row is shuffled.  Encoding
and decoding (always from the packed ids) share one worker and its vocabulary.

Defined results: null text counts as empty and has no ids; very long texts
are encoded whole (a block then holds that one text); repeated rows give equal
rows; a null id stays null; an empty table gives an empty table; columns other
than id and text are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from array import array

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import halve, worker_state

#: Fixed value: the pattern that splits text before the merges.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
BLOCK_CHARS = 1_000_000
MEMO = 300_000
#: Ranks whose merges are made at all places at once (arrays); later ones have few places each.
BULK = 3_000
#: Pieces replayed at once after that: lists and heap of so many stay in the processor's cache.
REPLAY = 2_000


def load_ranks(path: str) -> list[bytes]:
    """Token bytes by rank from a rank file (base64 token, rank per line)."""
    with open(path, "rb") as f:
        ranks = {int(b): base64.b64decode(a) for a, b in (line.split() for line in f if line.strip())}
    return [ranks[i] for i in range(len(ranks))]


class Merger:
    """Replays the merges of one vocabulary on sets of pieces."""

    def __init__(self, tokens: list[bytes]):
        self.tokens = tokens
        self.rank = {t: i for i, t in enumerate(tokens)}
        self.byte = np.array([self.rank[bytes([i])] for i in range(256)], dtype=np.int64)
        self.pairs: dict[int, int] = {}  # key: left << 20 | right
        for r, t in enumerate(tokens):
            for k in range(1, len(t)):
                a, b = self.rank.get(t[:k]), self.rank.get(t[k:])
                if a is not None and b is not None:
                    self.pairs[(a << 20) + b] = r
        self._keys = np.array(sorted(self.pairs), dtype=np.int64)
        self._ranks = np.array([self.pairs[k] for k in self._keys.tolist()], dtype=np.int64)

    def encode_pieces(self, pieces: list[bytes]) -> list[list[int]]:
        out: list[list[int] | None] = [None if (whole := self.rank.get(p)) is None else [whole] for p in pieces]
        rest = [n for n, ids in enumerate(out) if ids is None]
        if not rest:
            return out
        size = np.array([len(pieces[n]) for n in rest], dtype=np.int64)
        # Pieces one after another with a separator before, between and after them.
        begin = np.cumsum(size + 1) - size
        tok = np.full(int(size.sum()) + len(rest) + 1, -1, dtype=np.int64)
        tok[np.arange(int(size.sum())) + np.repeat(np.arange(1, len(rest) + 1), size)] = self.byte[
            np.frombuffer(b"".join(pieces[n] for n in rest), dtype=np.uint8)]
        nxt, prv = np.arange(1, len(tok) + 1), np.arange(-1, len(tok) - 1)
        nxt[-1] = len(tok) - 1
        due, again = self._bulk(tok, nxt, prv, min(BULK, len(rest) // 10))
        for x in range(0, len(rest), REPLAY):
            y = min(x + REPLAY, len(rest))
            s, e = int(begin[x]) - 1, int(begin[y - 1] + size[y - 1]) + 1
            t, after = tok[s:e].tolist(), (nxt[s:e] - s).tolist()
            self._replay(t, after, (prv[s:e] - s).tolist(), _index(due[s:e]))
            for n, i in zip(rest[x:y], (begin[x:y] - s).tolist()):
                ids = []
                while t[i] >= 0:
                    ids.append(t[i])
                    i = after[i]
                out[n] = ids
        for x in np.unique(np.searchsorted(begin, again, side="right") - 1).tolist():
            out[rest[x]] = self._alone(pieces[rest[x]])
        return out

    def _alone(self, piece: bytes) -> list[int]:
        tok = [-1, *self.byte[np.frombuffer(piece, dtype=np.uint8)].tolist(), -1]
        due = np.append(self._rank_of(np.array(tok[:-1]), np.array(tok[1:])), -1)
        self._replay(tok, list(range(1, len(tok) + 1)), list(range(-1, len(tok) - 1)), _index(due))
        return [t for t in tok if t >= 0]

    def _rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Rank of every pair, -1 for those that do not merge."""
        key = (left << 20) + right
        at = np.minimum(np.searchsorted(self._keys, key), len(self._keys) - 1)
        return np.where((self._keys[at] == key) & (left >= 0) & (right >= 0), self._ranks[at], -1)

    def _bulk(self, tok: np.ndarray, nxt: np.ndarray, prv: np.ndarray, upto: int) -> tuple[np.ndarray, np.ndarray]:
        """The merges of the first ``upto`` ranks, each at all its places at
        once.  Returns the rank that is due at every place after them (-1:
        none), and places where a merge of a lower rank came up late: their
        pieces are to be replayed alone, place by place."""
        late = [np.empty(0, dtype=np.int64)]
        due = np.append(self._rank_of(tok[:-1], tok[1:]), -1)
        index = {r: [x] for r, x in _groups(np.flatnonzero(due >= 0), due[due >= 0]) if r < upto}
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            at = index.pop(r)
            i = np.unique(np.concatenate(at)) if len(at) > 1 else at[0]
            i = i[due[i] == r]
            if not len(i):
                continue
            j = nxt[i]
            if (due[j] == r).any():  # places that share a token: the left one merges
                kept, taken = [], -1
                for x, y in zip(i.tolist(), j.tolist()):
                    if x != taken:
                        kept.append(x)
                        taken = y
                i = np.array(kept)
                j = nxt[i]
            k = nxt[j]
            tok[i], tok[j], due[j] = r, -2, -1
            nxt[i], prv[k] = k, i
            touched = np.concatenate([prv[i], i])
            q = due[touched] = self._rank_of(tok[touched], tok[nxt[touched]])
            late.append(touched[(q >= 0) & (q < r)])
            new = (q >= 0) & (q < upto)
            for rank, x in _groups(touched[new], q[new]):
                if rank in index:
                    index[rank].append(x)
                else:
                    index[rank] = [x]
                    heapq.heappush(heap, rank)
        return due, np.concatenate(late)

    def _replay(self, tok: list[int], nxt: list[int], prv: list[int], index: dict[int, list[int]]) -> None:
        pair = self.pairs.get
        heap = list(index)
        heapq.heapify(heap)
        while heap:
            r = heapq.heappop(heap)
            places = index.pop(r, None)
            if not places:
                continue
            places.sort()
            for n, i in enumerate(places):
                j = nxt[i]
                if tok[i] < 0 or pair((tok[i] << 20) + tok[j]) != r:
                    continue  # one of the two was merged meanwhile
                k, h = nxt[j], prv[i]
                tok[i], tok[j] = r, -2
                nxt[i], prv[k] = k, i
                lower = False
                for at, key in ((h, (tok[h] << 20) + r), (i, (r << 20) + tok[k])):
                    q = pair(key)
                    if q is not None:
                        if q in index:
                            index[q].append(at)
                        else:
                            index[q] = [at]
                            heapq.heappush(heap, q)
                        lower = lower or q < r
                if lower and n + 1 < len(places):  # the new pair comes first, the rest of this rank after it
                    index[r] = places[n + 1:]
                    heapq.heappush(heap, r)
                    break


def _groups(places: np.ndarray, ranks: np.ndarray):
    """``(rank, places ascending)`` of every rank."""
    order = np.lexsort((places, ranks))
    ranks, places = ranks[order], places[order]
    edge = np.flatnonzero(np.diff(ranks)) + 1
    return zip(ranks[np.concatenate(([0], edge))].tolist() if len(ranks) else [], np.split(places, edge))


def _index(due: np.ndarray) -> dict[int, list[int]]:
    at = np.flatnonzero(due >= 0)
    return {r: x.tolist() for r, x in _groups(at, due[at])}


class _Vocabulary:
    """A broadcast vocabulary; one merger and memo of pieces per worker."""

    def __init__(self, spark, ranks_path: str):
        tokens = load_ranks(ranks_path)
        self._b = spark.sparkContext.broadcast(tokens)
        self.id = hashlib.sha256(b"".join(len(t).to_bytes(4, "little") + t for t in tokens)).hexdigest()

    def merger(self) -> Merger:
        return worker_state(f"bpe-{self.id}", lambda: Merger(self._b.value))

    def memo(self, pattern: str) -> dict[str, bytes]:
        return worker_state(f"bpe-{self.id}-{pattern}", dict)


def _encoder(vocabulary: _Vocabulary, pattern: str):
    """Function from texts to their packed ids."""
    import regex
    find, merger, memo = regex.compile(pattern).findall, vocabulary.merger(), vocabulary.memo(pattern)

    def pack(texts: list) -> list[bytes]:
        found = [find(t) if t else [] for t in texts]
        halve(memo, MEMO)
        new = list(set().union(*found) - memo.keys())
        for p, x in zip(new, merger.encode_pieces([p.encode("utf-8", "surrogatepass") for p in new])):
            memo[p] = array("I", x).tobytes()
        return [b"".join(map(memo.__getitem__, f)) for f in found]

    return pack


def _decoder(vocabulary: _Vocabulary):
    """Function from packed ids to the bytes that they stand for."""
    token = vocabulary.merger().tokens.__getitem__
    return lambda packed: b"".join(map(token, np.frombuffer(packed, "<u4").tolist()))


def blocks(texts: pa.Array, limit: int = BLOCK_CHARS):
    """Ranges of rows whose texts have about ``limit`` characters together."""
    at, size = 0, 0
    for n, t in enumerate(texts):
        size += len(t.as_py() or "") if t.is_valid else 0
        if size >= limit:
            yield at, n + 1
            at, size = n + 1, 0
    if at < len(texts):
        yield at, len(texts)


def _source(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def encode(docs: DataFrame, ranks_path: str, pattern: str = PATTERN, id_col: str = "doc_id",
           text_col: str = "text") -> DataFrame:
    """``(doc_id, token_ids)``: ids of the whole text as little-endian unsigned
    32-bit integers in one binary value (:func:`unpack` gives an array)."""
    shared = _Vocabulary(docs.sparkSession, ranks_path)

    def run(batches):
        pack = _encoder(shared, pattern)
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                part = batch.slice(a, b - a)
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(pack(part.column(1).to_pylist()), pa.binary())],
                                                 names=["doc_id", "token_ids"])

    return _source(docs, id_col, text_col).mapInArrow(run, "doc_id long, token_ids binary")


def decode(encoded: DataFrame, ranks_path: str) -> DataFrame:
    """``(doc_id, token_ids, decoded)``: the bytes that ``token_ids`` stand for."""
    shared = _Vocabulary(encoded.sparkSession, ranks_path)

    def run(batches):
        text = _decoder(shared)
        for batch in batches:
            for n in range(0, batch.num_rows, 256):
                part = batch.slice(n, 256)
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(list(map(text, part.column(1).to_pylist())), pa.binary())],
                    names=["doc_id", "token_ids", "decoded"])

    return encoded.select("doc_id", "token_ids").mapInArrow(run, "doc_id long, token_ids binary, decoded binary")


def encode_and_decode(docs: DataFrame, ranks_path: str, pattern: str = PATTERN, id_col: str = "doc_id",
                      text_col: str = "text") -> DataFrame:
    """:func:`decode` of :func:`encode` in one worker: ``(doc_id, token_ids, decoded)``."""
    shared = _Vocabulary(docs.sparkSession, ranks_path)

    def run(batches):
        pack, text = _encoder(shared, pattern), _decoder(shared)
        for batch in batches:
            for a, b in blocks(batch.column(1)):
                part = batch.slice(a, b - a)
                packed = pack(part.column(1).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(packed, pa.binary()), pa.array(list(map(text, packed)), pa.binary())],
                    names=["doc_id", "token_ids", "decoded"])

    return _source(docs, id_col, text_col).mapInArrow(run, "doc_id long, token_ids binary, decoded binary")


def unpack(token_ids: str):
    """Array of ids from the packed column (for models that want an array)."""
    return F.expr(f"""transform(sequence(0, cast(length({token_ids}) / 4 as int) - 1),
        i -> cast(conv(hex(reverse(substring({token_ids}, i * 4 + 1, 4))), 16, 10) as bigint))""")

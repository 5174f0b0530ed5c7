"""Periodic runs of words: a suffix automaton with link-cut access.

A run is a longest stretch of words with smallest period ``q`` (words ``q``
apart are identical) and a length of ``max(24, 3 * q)`` words or more.

1. Every window of eight words of a run stands again one period further or
   earlier inside that run, so positions without a near enough equal window
   are left out first, by sorted window hashes (:func:`stretches`).  Runs lie
   whole in the stretches that stay; no run is lost.
2. For a stretch the suffix automaton is built.  Its suffix links form a tree;
   the states of a prefix's suffixes are the path to the root.  Words are
   appended in turn, and *access* recolours that path with the new end: the
   tree is held as paths of one last occurrence each, every path a splay tree
   (:class:`Paths`).  A path segment with last end ``e`` and lengths in
   ``(low, high]`` met at the new end ``r`` says that these suffixes stand at
   ``e`` and ``r``; if ``d = r - e`` is in ``(low, high]`` the last ``2 * d``
   words are a square with smallest period ``d``.
3. A square not inside the latest run of its period is extended both ways.

Documents are independent, so nothing is shuffled; each text is read whole.

Defined results: null, empty and word-less texts have no words and no runs;
very long texts are processed whole (memory in proportion to that text);
repeated rows give equal rows; a null id stays null; an empty table gives an
empty table; other columns are not read, so clashing names do no harm.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from emporium.llm.common import mix

LEAST, TIMES = 24, 3
#: Shortest overlap of a run with itself one period further, less one period:
#: max(24, 3q) - 2q is 8 or more for every q.
WINDOW = 8
BLOCK_ROWS = 256


def stretches(ids: np.ndarray) -> list[tuple[int, int]]:
    """Disjoint ranges of positions that hold all runs."""
    n = len(ids)
    if n < LEAST:
        return []
    h = np.zeros(n - WINDOW + 1, dtype=np.uint64)
    for j in range(WINDOW):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[j: j + len(h)].astype(np.uint64)
    h = mix(h)
    order = np.argsort(h, kind="stable")
    same = h[order[1:]] == h[order[:-1]]
    if not same.any():
        return []
    near = np.full(len(h), n, dtype=np.int64)  # distance to the nearest equal window
    gap = np.where(same, order[1:] - order[:-1], n)
    near[order[:-1]] = gap
    near[order[1:]] = np.minimum(near[order[1:]], gap)
    alive = near < n
    while True:
        mark = np.zeros(n + 1, dtype=np.int64)
        at = np.flatnonzero(alive)
        np.add.at(mark, at, 1)
        np.add.at(mark, at + WINDOW, -1)
        edge = np.flatnonzero(np.diff(np.concatenate(([0], (np.cumsum(mark[:n]) > 0).view(np.int8), [0]))))
        begin, end = edge[0::2], edge[1::2]
        if not len(begin):
            return []
        size = end - begin
        most = np.where(size >= LEAST, size // TIMES, 0)  # a run in a stretch has at most this period
        stay = alive.copy()
        stay[at] = near[at] <= most[np.searchsorted(begin, at, side="right") - 1]
        if (stay == alive).all():
            return list(zip(begin.tolist(), end.tolist()))
        alive = stay


def automaton(words: list[int]) -> tuple[list[int], list[int], list[int]]:
    """``(length, link, state of every prefix)`` of the suffix automaton."""
    length, link, step, ends = [0], [-1], [{}], []
    last = 0
    for c in words:
        cur = len(length)
        length.append(length[last] + 1)
        link.append(0)
        step.append({})
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            if length[q] == length[p] + 1:
                link[cur] = q
            else:
                copy = len(length)
                length.append(length[p] + 1)
                link.append(link[q])
                step.append(dict(step[q]))
                while p >= 0 and step[p].get(c) == q:
                    step[p][c] = copy
                    p = link[p]
                link[q] = link[cur] = copy
        last = cur
        ends.append(cur)
    return length, link, ends


class Paths:
    """The link tree as paths of one colour; each path is a splay tree ordered
    by depth whose root carries the colour (the last end position)."""

    def __init__(self, length: list[int], link: list[int]):
        self.length = length
        self.up = [p if p > 0 else -1 for p in link]  # parent in the splay tree or in the tree above
        self.left = [-1] * len(link)
        self.right = [-1] * len(link)
        self.colour = [-1] * len(link)

    def _splay(self, x: int) -> None:
        up, left, right, colour = self.up, self.left, self.right, self.colour
        while True:
            p = up[x]
            if p < 0 or (left[p] != x and right[p] != x):
                return
            g = up[p]
            top = g < 0 or (left[g] != p and right[g] != p)
            if top:
                colour[x] = colour[p]
                turn = (x,)
            else:
                if (left[g] == p) == (left[p] == x):
                    turn = (p, x)
                else:
                    turn = (x, x)
                above = up[g]
                if above < 0 or (left[above] != g and right[above] != g):
                    colour[x] = colour[g]
            for y in turn:
                p = up[y]
                g = up[p]
                if left[p] == y:
                    b = left[p] = right[y]
                    right[y] = p
                else:
                    b = right[p] = left[y]
                    left[y] = p
                if b >= 0:
                    up[b] = p
                up[p] = y
                up[y] = g
                if g >= 0:
                    if left[g] == p:
                        left[g] = y
                    elif right[g] == p:
                        right[g] = y

    def access(self, v: int, end: int) -> list[int]:
        """Recolours the path from ``v`` to the root with ``end``; the
        distances to earlier ends that make squares."""
        found, below, x = [], -1, v
        while x >= 0:
            self._splay(x)
            was = self.colour[x]
            above = self.up[x]
            if was >= 0:
                d = end - was
                if (self.length[above] if above >= 0 else 0) < d <= self.length[x]:
                    found.append(d)
            deeper = self.right[x]
            if deeper >= 0:
                self.colour[deeper] = was
            self.right[x] = below
            below, x = x, above
        self.colour[below] = end
        return found


def runs_of(words: list[int]) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of all runs of one stretch."""
    length, link, ends = automaton(words)
    paths = Paths(length, link)
    n, upto, out = len(words), {}, []
    for r, state in enumerate(ends):
        for d in paths.access(state, r):
            if upto.get(d, -1) >= r:
                continue
            i = r - d
            while i >= d and words[i] == words[i - d]:
                i -= 1
            j = r + 1
            while j < n and words[j] == words[j - d]:
                j += 1
            upto[d] = j - 1
            start = i - d + 1
            if j - start >= max(LEAST, TIMES * d):
                out.append((start, j - start, d))
    return out


def find_runs(words: list) -> list[tuple[int, int, int]]:
    """``(start, length, period)`` of every run, by start, then period."""
    number: dict = {}
    ids = np.fromiter((number.setdefault(w, len(number)) for w in words), dtype=np.int64, count=len(words))
    out = []
    for a, b in stretches(ids):
        out += [(a + s, size, q) for s, size, q in runs_of(ids[a:b].tolist())]
    return sorted(out, key=lambda x: (x[0], x[2]))


def collapse(words: list[bytes], runs: list[tuple[int, int, int]]) -> list[bytes]:
    """Words but for those that a run holds after its first period."""
    if not runs:
        return words
    gone = bytearray(len(words))
    for start, size, q in runs:
        gone[start + q: start + size] = b"\1" * (size - q)
    return [w for w, x in zip(words, gone) if not x]


_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])


def periodic_runs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``(doc_id, n_words, runs, best, collapsed)``: ``runs`` by start, then
    period; ``best`` has the greatest length / period (ties: smallest start,
    then period; null without a run); ``collapsed`` is the text without the
    repeats, words joined by one space."""

    def run(batches):
        for batch in batches:
            for n in range(0, batch.num_rows, BLOCK_ROWS):
                part = batch.slice(n, BLOCK_ROWS)
                size, found, best, left = [], [], [], []
                for text in part.column(1).to_pylist():
                    words = (text or b"").split()  # bytes: space and \t \n \v \f \r alone separate
                    runs = find_runs(words)
                    top = None
                    for x in runs:
                        if top is None or x[1] * top[2] > top[1] * x[2]:
                            top = x
                    size.append(len(words))
                    found.append([dict(zip(("start", "length", "period"), x)) for x in runs])
                    best.append(top and dict(zip(("start", "length", "period"), top)))
                    left.append(b" ".join(collapse(words, runs)))
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(size, pa.int64()), pa.array(found, pa.list_(_RUN)), pa.array(best, _RUN),
                     pa.array(left, pa.binary())], names=["doc_id", "n_words", "runs", "best", "collapsed"])

    kind = "struct<start: bigint, length: bigint, period: bigint>"
    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.encode(F.col(text_col).cast("string"), "UTF-8").alias("text"))
    out = src.mapInArrow(run, f"doc_id long, n_words long, runs array<{kind}>, best {kind}, collapsed binary")
    return out.withColumn("collapsed", F.decode("collapsed", "UTF-8"))


def with_tails(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` where the words of one text in ten repeat periodically from
    some word on (a fixed function of the id): with ``h`` the CRC-32 of the
    decimal id and ``g = h div 10``, if ``h % 10 = 0`` word ``i >= a`` becomes
    word ``a + (i - a) % p``, ``a = g % n``, ``p = 1 + (n - a) div (3 + g % 8)``.
    Texts under a null id stay as they are."""
    words = F.regexp_extract_all("text", F.lit(r"[^\x20\x09-\x0D]+"), F.lit(0))
    out = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")) \
        .withColumn("_h", F.crc32(F.col("doc_id").cast("string").cast("binary"))) \
        .withColumn("_w", F.when(F.col("_h") % 10 == 0, words)) \
        .withColumn("_n", F.coalesce(F.size("_w"), F.lit(0)).cast("long")) \
        .withColumn("_a", F.expr("if(_n > 0, _h div 10 % _n, 0L)")) \
        .withColumn("_p", F.expr("1L + (_n - _a) div (3L + _h div 10 % 8L)"))
    return out.select("doc_id", F.expr("""CASE WHEN _n > 0 THEN array_join(transform(_w, (w, i) ->
        IF(i >= _a, element_at(_w, CAST(_a + (i - _a) % _p + 1 AS INT)), w)), ' ') ELSE text END""").alias("text"))

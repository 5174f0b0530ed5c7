"""Helpers shared by the text operators: words, hashes, lineage cuts, groups.

Word rule of the operators on shingles and passages: ASCII A-Z lower-cased,
words are runs of ``[^\\x20\\x09-\\x0D]``.  Word and n-gram hashes are 64 bits:
a polynomial over random byte values (modulo 2**64) with a mixing finish, so
equal words hash alike on every executor and in every run.
"""

from __future__ import annotations

import os
import sys
import tempfile
import types
import uuid

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- hashing (numpy, runs inside tasks) ------------------------------------

_M = 0x9E3779B97F4A7C15 | 1
_M_INV = pow(_M, -1, 2 ** 64)
_POW: dict[str, np.ndarray] = {}


def _tables():
    """Byte values, separators and powers, made once per Python process."""
    if "byte" not in _POW:
        rng = np.random.default_rng(20240607)
        vals = rng.integers(0, 2 ** 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        vals[65:91] = vals[97:123]
        sep = np.zeros(256, dtype=bool)
        sep[[9, 10, 11, 12, 13, 32]] = True
        _POW["byte"], _POW["sep"] = vals, sep
    return _POW["byte"], _POW["sep"]


def _powers(n: int):
    have = _POW.get("pow")
    if have is None or len(have) < n:
        m = 1 << max(14, int(n).bit_length())
        for key, base in (("pow", _M), ("inv", _M_INV)):
            p = np.full(m, np.uint64(base), dtype=np.uint64)
            p[0] = 1
            _POW[key] = np.cumprod(p, dtype=np.uint64)
    return _POW["pow"], _POW["inv"]


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finish (every output bit depends on every input bit)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _segments(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    pw, inv = _powers(len(values) + 1)
    acc = np.empty(len(values) + 1, dtype=np.uint64)
    acc[0] = 0
    np.cumsum(values * pw[: len(values)], out=acc[1:])
    return (acc[ends] - acc[starts]) * inv[starts]


def word_spans(data: bytes) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte array of a text and the start and end offsets of its words."""
    _, sep = _tables()
    b = np.frombuffer(data, dtype=np.uint8)
    edge = np.flatnonzero(np.diff(np.concatenate(([True], sep[b], [True])).view(np.int8)))
    return b, edge[0::2], edge[1::2]


def word_hashes(text: str | None) -> np.ndarray:
    """One 64-bit hash per word of ``text`` (none for null or empty)."""
    if not text:
        return np.empty(0, dtype=np.uint64)
    b, s, e = word_spans(text.encode("utf-8", "surrogatepass"))
    if not len(s):
        return np.empty(0, dtype=np.uint64)
    vals, _ = _tables()
    return mix(_segments(vals[b], s, e) + (e - s).astype(np.uint64))


def ngram_hashes(h: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of ``n`` words (empty when there are fewer)."""
    if len(h) < n:
        return np.empty(0, dtype=np.uint64)
    i = np.arange(len(h) - n + 1)
    return mix(_segments(h, i, i + n) + np.uint64(n))


def shingle_set(text: str | None, n: int = 5) -> np.ndarray:
    """Sorted distinct ``n``-word shingle hashes; with fewer words the whole
    sequence is the one shingle; without words none."""
    h = word_hashes(text)
    if not len(h):
        return h
    return np.unique(ngram_hashes(h, min(n, len(h))))


# --- state of a Python worker ----------------------------------------------

def worker_state(name: str, make):
    """``make()`` once per worker process and ``name``, kept from task to task
    (functions shipped by value get fresh globals with every task)."""
    own = sys.modules.setdefault("_emporium_worker", types.ModuleType("_emporium_worker"))
    if name not in own.__dict__:
        own.__dict__[name] = make()
    return own.__dict__[name]


def halve(memo: dict, most: int) -> None:
    """Forgets the older half of a memo that has more than ``most`` entries."""
    if len(memo) > most:
        for key in list(memo)[: len(memo) // 2]:
            del memo[key]


# --- Spark helpers ---------------------------------------------------------

def shared_dir(spark: SparkSession) -> str:
    """The cluster's checkpoint folder (read from the session).

    Only a local session (tests) without one gets a scratch folder.
    """
    cur = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not cur:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
        cur = tempfile.mkdtemp(prefix="llm-ckpt-")
        spark.conf.set("spark.checkpoint.dir", cur)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(cur)
    return cur


def cut(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and drop its lineage."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def table(df: DataFrame, **options) -> DataFrame:
    """Like :func:`cut`, but as a Parquet table in the shared folder, which
    packs many narrow rows better; it goes when the driver ends."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm-table-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(at)
    return spark.read.schema(df.schema).parquet(path)


#: Rows of ids (tens of bytes each) that a join may broadcast; more are shuffled.
BROADCAST_ROWS = 1_000_000


def keys(df: DataFrame) -> DataFrame:
    """A narrow table of keys, materialised and counted: broadcast up to
    ``BROADCAST_ROWS`` rows, else left to a shuffled join."""
    out = cut(df)
    return F.broadcast(out) if out.count() <= BROADCAST_ROWS else out


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


#: Rows of a few longs that one task takes where a table's rows are counted.
TASK_ROWS = 200_000


def tasks(rows: int) -> int:
    """Tasks for a counted table of narrow rows (``coalesce`` keeps fewer as they are)."""
    return 1 + rows // TASK_ROWS


def components(edges: DataFrame) -> DataFrame:
    """``edges(a, b)`` of longs -> ``(id, root)``: the smallest id that each
    id reaches.  Rounds of contraction: every id points to its neighbour (or
    itself) of the least hash (aggregated map-side, so a hub is never
    gathered), pointers are doubled twice, edges are rewritten to the targets
    and loops dropped, until no edge is left.  The order by hash leaves about
    a third of a long chain in a round, so rounds grow with its logarithm.
    Steps are tables: checkpoints would hand on the optimiser's constraints,
    which double with every join of the pointers with themselves.  No step has
    more rows than the given edges have ends: these are counted (``edges`` is
    read twice, so give a stored table), set the number of tasks, and pointers
    are broadcast up to ``BROADCAST_ROWS``."""
    e = edges.where("a <> b").select("a", "b")
    left = ends = 2 * e.count()
    if not ends:
        return e.select(F.col("a").alias("id"), F.col("b").alias("root"))
    step = lambda df: table(df.coalesce(tasks(ends)))
    hand = F.broadcast if ends <= BROADCAST_ROWS else lambda df: df
    e, m = step(e), None
    while left:
        best = lambda c: F.struct(F.xxhash64(c).alias("h"), F.col(c).alias("p"))
        p = step(e.union(e.select("b", "a")).groupBy("a").agg(F.min(best("b")).alias("n"))
                 .select(F.col("a").alias("v"), F.least("n", best("a")).getField("p").alias("p")))
        for _ in range(2):
            to = hand(p.select(F.col("v").alias("w"), F.col("p").alias("q")))
            p = step(p.join(to, F.col("p") == F.col("w")).select("v", F.col("q").alias("p")))
        m = step(p.select(F.col("v").alias("id"), F.col("p").alias("label")) if m is None else
                 m.join(hand(p), m.label == p.v, "left").select("id", F.coalesce("p", "label").alias("label")))
        pa = hand(p.select(F.col("v").alias("a"), F.col("p").alias("na")))
        pb = hand(p.select(F.col("v").alias("b"), F.col("p").alias("nb")))
        e = step(e.join(pa, "a").join(pb, "b").where("na <> nb")
                 .select(F.least("na", "nb").alias("a"), F.greatest("na", "nb").alias("b")).distinct())
        left = e.count()
    first = hand(m.groupBy("label").agg(F.min("id").alias("root")))
    return step(m.join(first, "label").select("id", "root"))


def tokenizer_path(name: str) -> str:
    """File of a public tokenizer (read on the driver only)."""
    import public_tokenizers
    return public_tokenizers.path(name)

"""Ordered admission of requests against a balance per key (stock).

Requests of a key are taken in (ts, request_id) order; one is accepted when
what it needs is at most what is left, and a refused one consumes nothing, so
a running sum is wrong after the first refusal.  Distributed form:

* every request meets its key's balance and total needs once (stored); keys
  whose needs together fit accept everything: no ordering (the common case);
* the rows of the other keys are range-partitioned once on (key, ts,
  request_id) into chunks of about ``CHUNK_ROWS`` rows and stored, so a hot key
  spans many chunks;
* keys whose requests only take are settled by *halving* (:func:`_halve`), set
  operations only, in at most 2 + log2(balance) rounds whatever their rows;
* keys that also give back (signed balances) are decided chunk by chunk: turn n
  takes the n-th chunk of every key at once, its rows pass in order through one
  task that carries only the balance left, and what the accepted ones used
  gives the next turn's balance.

Halving, with ``f`` left for a key after some row: requests over ``f`` are
refused for good; those up to ``f / 2`` are small, the others big.  Take the
running sum of the small ones.  The next *event* is the first small request
that no longer fits, or the first big one that fits beside the small ones
before it.  Up to the event all small requests are accepted and all big ones
refused, and either event leaves at most ``f / 2``: the next round starts there.
Without an event the same holds for all rows that are left.

Every request gets one decision: a missing quantity is refused.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import BooleanType, StructField, StructType

from emporium.operators.kept import kept

#: The trigger's message (fixed value); it is raised for an unknown product too.
REJECT_CAPACITY = "Stock insuficiente para completar la venta"
REJECT_MISSING = "quantity is missing"
REJECT_NEGATIVE = "negative balance"
CHUNK_ROWS = 1_000_000


def _refused(df: DataFrame, request_id: str, reason: str, keep: list[str] = ()) -> DataFrame:
    return df.select(F.col(request_id).alias("request_id"), F.lit(False).alias("accepted"), F.lit(reason).alias("reason"), *keep)


def _fold(rows: DataFrame, key: str, order: list[str], request_id: str) -> DataFrame:
    """One chunk per key, decided in order with the balance ``_free``."""

    def run(batches):
        at, free = None, 0
        for b in batches:
            ok = []
            for k, need, start in zip(b.column(0).to_pylist(), b.column(2).to_pylist(), b.column(3).to_pylist()):
                if k != at:
                    at, free = k, start
                ok.append(need <= free)
                if ok[-1]:
                    free -= need
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(ok, pa.bool_())],
                                             names=[key, request_id, "_need", "accepted"])

    ordered = rows.repartition(key).sortWithinPartitions(key, *order).select(key, request_id, "_need", "_free")
    schema = StructType([*ordered.schema.fields[:3], StructField("accepted", BooleanType())])
    return ordered.mapInArrow(run, schema)


def _chunked(hard: DataFrame, key: str, order: list[str]) -> DataFrame:
    """``hard`` range-partitioned once, ``_chunk`` naming the partition (stored,
    so that all uses see the same chunks)."""
    return (hard.repartitionByRange(-(-max(1, hard.count()) // CHUNK_ROWS), key, *order)
            .withColumn("_chunk", F.spark_partition_id()).checkpoint(eager=True))


def _halve(chunks: DataFrame, key: str, order: list[str], request_id: str) -> DataFrame:
    """Decisions for keys whose requests only take, by rounds of halving.  A
    round keeps one row per key: the balance, where it starts and its event;
    the rows are decided by them at the end, in one pass."""
    me, cell = F.struct(*order), [key, "_chunk"]
    cells = chunks.select(*cell).distinct().checkpoint(eager=True)  # one row per key and partition
    rows = chunks.select(request_id, key, "_chunk", "_need", *[c for c in order if c != request_id])
    none = F.lit(None).cast(rows.select(me).schema[0].dataType)
    state = chunks.groupBy(key).agg(F.first("_free").alias("_free")).select(key, "_free", none.alias("_pos"))
    small, upto = 2 * F.col("_need") <= F.col("_free"), Window.unboundedPreceding
    rounds = None
    while True:
        live = (rows.join(cells.join(state, key), cell)
                .where((F.col("_pos").isNull() | (me > F.col("_pos"))) & (F.col("_need") <= F.col("_free")))
                .withColumn("_small", F.when(small, F.col("_need")).otherwise(0)))
        before = (live.groupBy(*cell).agg(F.sum("_small").alias("_t")).withColumn(
            "_before", F.sum("_t").over(Window.partitionBy(key).orderBy("_chunk").rowsBetween(upto, -1))).drop("_t"))
        run = (live.withColumn("_run", F.sum("_small").over(Window.partitionBy(*cell).orderBy(*order).rowsBetween(upto, 0)))
               .join(before, cell).withColumn("_sum", F.col("_run") + F.coalesce("_before", F.lit(0))))
        event = F.when(small, F.col("_sum") > F.col("_free")).otherwise(F.col("_need") <= F.col("_free") - F.col("_sum"))
        first = run.where(event).groupBy(key).agg(F.min(F.struct(me.alias("at"), "_need", "_small", "_sum")).alias("_e"))
        left = F.col("_free") - (F.col("_e._sum") - F.col("_e._small")) - F.when(F.col("_e._small") == 0, F.col("_e._need")).otherwise(0)
        step = state.join(first, key, "left").select(key, "_free", "_pos", F.col("_e.at").alias("_event"),
                                                     left.alias("_left")).checkpoint(eager=True)
        rounds = step if rounds is None else rounds.unionByName(step)
        state = step.where(F.col("_event").isNotNull()).select(key, F.col("_left").alias("_free"), F.col("_event").alias("_pos"))
        if state.isEmpty():
            break
    mine = ((F.col("_pos").isNull() | (me > F.col("_pos"))) & (F.col("_event").isNull() | (me <= F.col("_event"))))
    at_event = F.coalesce(me == F.col("_event"), F.lit(False))
    return (rows.join(cells.join(rounds, key), cell).where(mine)
            .select(request_id, F.when(at_event, ~small).otherwise(small).alias("accepted"),
                    (F.col("_need") <= F.col("_free")).alias("_fits"))
            .select(request_id, (F.col("accepted") & F.col("_fits")).alias("accepted")))


def _admit(requests: DataFrame, start: DataFrame, key: list[str], order: list[str], request_id: str, keep: list[str]) -> DataFrame:
    """``requests(request_id, key..., _need, order..., keep...)`` x
    ``start(key..., _free)`` -> ``(request_id, accepted, keep...)``; no decision
    (NULL) for keys that are not in ``start``.  Every request meets its balance
    and its key's needs once, and that is stored: all later steps filter it."""
    wanted = requests.groupBy(*key).agg(F.sum(F.greatest("_need", F.lit(0))).alias("_wanted"),
                                        (F.min("_need") < 0).alias("_gives"))
    known = kept(requests.join(start, key, "left").join(wanted, key, "left"), "admission")
    tight = F.coalesce(F.col("_wanted") > F.col("_free"), F.lit(False))
    out = [request_id, "accepted", *keep]
    decided = known.where(~tight).withColumn("accepted", F.when(F.col("_free").isNotNull(), F.lit(True))).select(*out)
    hard = known.where(tight).withColumn("_key", F.struct(*key) if len(key) > 1 else F.col(key[0]))
    rows = hard.select(request_id, "_key", "_need", *[c for c in order if c != request_id], "_free", "_gives")
    takes, gives = rows.where(~F.col("_gives")).drop("_gives"), rows.where("_gives").drop("_gives")
    parts = []
    if not takes.isEmpty():
        parts.append(takes.where(F.col("_free") < 0).select(request_id, F.lit(False).alias("accepted")))
        parts.append(_halve(_chunked(takes.where(F.col("_free") >= 0), "_key", order), "_key", order, request_id))
    if not gives.isEmpty():
        parts.append(_in_turns(gives, "_key", order, request_id))
    for part in parts:
        if keep:
            part = part.join(hard.select(request_id, *keep), request_id)
        decided = decided.unionByName(part.select(*out))
    return decided


def _in_turns(hard: DataFrame, key: str, order: list[str], request_id: str) -> DataFrame:
    """Decisions chunk by chunk, for keys whose requests also give back."""
    chunks = _chunked(hard, key, order)
    turns = (chunks.select(key, "_chunk").distinct()  # one row per key and partition
             .withColumn("_turn", F.row_number().over(Window.partitionBy(key).orderBy("_chunk"))).checkpoint(eager=True))
    rows = chunks.drop("_free").join(turns, [key, "_chunk"])
    free = hard.groupBy(key).agg(F.first("_free").alias("_free"))
    last = turns.agg(F.max("_turn")).first()[0]
    decided = None
    for turn in range(1, last + 1):
        out = _fold(rows.where(F.col("_turn") == turn).join(free, key), key, order, request_id).checkpoint(eager=True)
        done = out.select(request_id, "accepted")
        decided = done if decided is None else decided.unionByName(done)
        if turn < last:
            used = out.where("accepted").groupBy(key).agg(F.sum("_need").alias("_used"))
            free = (free.join(turns.where(F.col("_turn") == turn + 1).select(key), key, "left_semi")
                    .join(used, key, "left").select(key, (F.col("_free") - F.coalesce("_used", F.lit(0))).alias("_free"))
                    .checkpoint(eager=True))
    return decided


def _needs(requests: DataFrame, key: list[str], need, order: list[str], request_id: str, keep: list[str]) -> DataFrame:
    cols = dict.fromkeys([request_id, *key, *order, *keep])
    return requests.select(*cols, need.cast("bigint").alias("_need"))


def greedy_admission(requests: DataFrame, capacity: DataFrame, key: str | list[str], qty: str = "qty",
                     order: tuple[str, ...] = ("ts", "request_id"), request_id: str = "request_id",
                     unknown: str = REJECT_CAPACITY, keep: tuple[str, ...] = ()) -> DataFrame:
    """``requests(request_id, key, qty, order...)`` x ``capacity(key, cap)`` ->
    ``(request_id, accepted, reason)``, one row per request, and its columns
    ``keep``.  ``key`` may be several columns; ``unknown`` is the reason for a key
    without a capacity."""
    keys, keep = [key] if isinstance(key, str) else list(key), list(keep)
    req = _needs(requests.where(F.col(qty).isNotNull()), keys, F.col(qty), list(order), request_id, keep)
    free = capacity.where("cap IS NOT NULL").select(*keys, F.col("cap").cast("bigint").alias("_free"))
    ok = F.col("accepted")
    dec = _admit(req, free, keys, list(order), request_id, keep).select(
        F.col(request_id).alias("request_id"), F.coalesce(ok, F.lit(False)).alias("accepted"),
        F.when(ok.isNull(), F.lit(unknown)).when(~ok, F.lit(REJECT_CAPACITY)).alias("reason"), *keep)
    missing = requests.where(F.col(qty).isNull())
    return dec.unionByName(_refused(missing, request_id, REJECT_MISSING, keep))


def sequential_balance(requests: DataFrame, start: DataFrame, key: str, delta: str = "delta",
                       order: tuple[str, ...] = ("ts", "request_id"), request_id: str = "request_id") -> DataFrame:
    """Signed requests applied in order; one that would take the balance below
    zero is refused and changes nothing (it needs ``-delta``).  ``start(key,
    bal)``; keys without a start row are not handled here (callers refuse them
    first); a missing delta is refused."""
    req = _needs(requests.where(F.col(delta).isNotNull()), [key], -F.col(delta).cast("bigint"), list(order), request_id, [])
    free = start.select(key, F.coalesce("bal", F.lit(0)).cast("bigint").alias("_free"))
    dec = _admit(req, free, [key], list(order), request_id, []).where(F.col("accepted").isNotNull()).select(
        F.col(request_id).alias("request_id"), "accepted",
        F.when(~F.col("accepted"), F.lit(REJECT_NEGATIVE)).alias("reason"))
    return dec.unionByName(_refused(requests.where(F.col(delta).isNull()), request_id, REJECT_MISSING))

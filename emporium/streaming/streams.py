"""Structured Streaming jobs ST1-ST5.

Sources are Parquet folders read with ``readStream``: the driver's events
file directly, or tables Spark derives from the test data and stages as
Parquet in the shared checkpoint folder (orders, change feeds, stock
movements).  Sinks are files in that folder too — never the driver's
memory — and every query runs with ``trigger(availableNow=True)`` so a run
processes what is there and stops; the same code runs continuously with a
processing-time trigger.  Checkpoints live next to the sinks, so a
restarted query resumes exactly where it stopped.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from emporium.functions import semantics as S
from emporium.operators import bucketed
from emporium.plans import changes as C
from emporium.session import ensure_checkpoint_dir


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> str:
    """Write a derived table as a Parquet stream source; returns its folder."""
    path = _scratch(df.sparkSession, f"src-{name}")
    df.write.mode("overwrite").parquet(path)
    return path


def in_turns(df: DataFrame, name: str, arrives, turns: int, run: Callable[[Callable[[], DataFrame]], DataFrame]) -> DataFrame:
    """Lets the rows of ``df`` arrive in ``turns`` equal ranges of the time
    ``arrives``, the earliest first.  After each turn ``run`` gets a source over
    all that has arrived; with a fixed sink folder it continues from its
    checkpoint, so every turn is a micro-batch of its own and a restart.
    Returns the last result."""
    spark, path = df.sparkSession, _scratch(df.sparkSession, f"src-{name}")
    micros = F.unix_micros(arrives.cast("timestamp"))
    lo, hi = df.agg(F.min(micros), F.max(micros)).first()
    turn = F.lit(0) if lo is None else F.floor((micros - lo) / F.lit((hi - lo) // turns + 1))
    for n in range(turns):
        df.where(turn == n).write.mode("append").parquet(path)
        out = run(lambda: file_stream(spark, path, df.schema))
    return out


def file_stream(spark: SparkSession, path: str, schema, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    r = spark.readStream.schema(schema)
    if glob:
        r = r.option("pathGlobFilter", glob)
    if max_files:
        r = r.option("maxFilesPerTrigger", max_files)
    return r.parquet(path)


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``events.parquet`` as a stream, a folder of part files or one file."""
    path = f"{sf_dir}/events.parquet"
    schema = spark.read.parquet(path).schema
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    s = (file_stream(spark, path, schema) if fs.getFileStatus(p).isDirectory()
         else file_stream(spark, sf_dir, schema, glob="events.parquet"))
    # watermarks need TimestampType; the session clock is UTC
    return s.withColumn("ets", F.col("ts").cast("timestamp"))


def run_append(stream: DataFrame, name: str, out: str | None = None) -> DataFrame:
    """Append-mode query into a Parquet file sink; returns the sink as a table.
    With the sink folder ``out`` of an earlier run it continues that run."""
    spark = stream.sparkSession
    out = out or _scratch(spark, name)
    q = (stream.writeStream.format("parquet").option("path", f"{out}/data")
         .option("checkpointLocation", f"{out}/_checkpoint").outputMode("append")
         .trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.read.schema(stream.schema).parquet(f"{out}/data")


def run_update_upsert(stream: DataFrame, name: str, keys: list[str], out: str | None = None) -> DataFrame:
    """Update-mode query whose micro-batches are upserted by ``keys`` into a
    bucketed table (:mod:`emporium.operators.bucketed`): a batch rewrites only
    the buckets of its keys.  Returns the current rows.

    Earlier versions are found in the sink folder, not in driver memory, so a
    query restarted from its checkpoint continues from the last published
    version, and a micro-batch that is re-run after a failure rebuilds the same
    version (idempotent)."""
    spark = stream.sparkSession
    out = out or _scratch(spark, name)

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        bucketed.upsert(out, batch, keys, version=batch_id)

    q = (stream.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", f"{out}/_checkpoint")
         .outputMode("update").trigger(availableNow=True).start())
    q.awaitTermination()
    return bucketed.read(spark, out, stream.schema)


# -- ST1 -----------------------------------------------------------------------
def st_order_velocity(spark: SparkSession, sf_dir: str, window: str = "24 hours", min_orders: int = 2,
                      lateness: str = "1 hour") -> DataFrame:
    """E18 as a stream: purchases per customer in tumbling event-time windows,
    flagged when at least ``min_orders``."""
    ev = events_stream(spark, sf_dir).where(F.col("event_type") == "purchase")
    counts = (ev.withWatermark("ets", lateness)
              .groupBy(F.window("ets", window).alias("w"), F.col("user_id").alias("customer_id"))
              .agg(F.count(F.lit(1)).alias("order_count"))
              .select("customer_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                      "order_count"))
    cur = run_update_upsert(counts, "st1-velocity", ["customer_id", "window_start"])
    return (cur.where(F.col("order_count") >= min_orders)
            .select("customer_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"),
                    F.col("order_count").cast("bigint").alias("order_count")))


def velocity_counts(purchases: DataFrame, window: str, slide: str, start: str | None = None) -> DataFrame:
    """Purchases ``(user_id, ets)`` per customer and sliding window; windows
    begin ``start`` after the hour.  Streams and tables alike."""
    return (purchases.groupBy(F.window("ets", window, slide, start).alias("w"), F.col("user_id").alias("customer_id"))
            .agg(F.count(F.lit(1)).alias("order_count"))
            .select("customer_id", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "order_count"))


def run_late(stream: DataFrame, name: str, lateness: str, out: str | None = None) -> DataFrame:
    """Side path of late rows: those more than ``lateness`` behind the latest
    ``ets`` of the micro-batches before, a superset of what a watermark of that
    lateness drops.  Returns the late rows so far.  Each batch's latest time is
    kept as one row in the folder, so restarts and re-run batches agree."""
    spark = stream.sparkSession
    out = out or _scratch(spark, name)

    def side(batch: DataFrame, batch_id: int) -> None:
        own = batch.sparkSession
        prior = [x for x in bucketed.listed(own, f"{out}/marks") if x.startswith("batch=") and int(x[6:]) < batch_id]
        late = batch.where("false")
        if prior:
            marks = own.read.schema("latest timestamp").parquet(*[f"{out}/marks/{x}" for x in prior])
            late = batch.where(F.col("ets") < marks.select(F.max("latest")).scalar() - F.expr(f"INTERVAL {lateness}"))
        late.write.mode("overwrite").parquet(f"{out}/late/batch={batch_id}")
        batch.agg(F.max("ets").alias("latest")).write.mode("overwrite").parquet(f"{out}/marks/batch={batch_id}")

    (stream.writeStream.foreachBatch(side).option("checkpointLocation", f"{out}/_checkpoint")
     .trigger(availableNow=True).start().awaitTermination())
    batches = [x for x in bucketed.listed(spark, f"{out}/late") if x.startswith("batch=")]
    return (spark.read.schema(stream.schema).parquet(*[f"{out}/late/{x}" for x in batches]) if batches
            else spark.createDataFrame([], stream.schema))


def cover_late(out: str, late: DataFrame, landed: DataFrame, window: str, slide: str, start: str | None = None) -> None:
    """Batch job after the stream: the windows that ``late`` rows touch are
    counted again over all ``landed`` purchases and upserted into the stream's
    table ``out``.  Only customers with late rows are read again, and doing it
    twice changes nothing."""
    touched = velocity_counts(late, window, slide, start).select("customer_id", "window_start")
    again = velocity_counts(landed.join(late.select("user_id").distinct(), "user_id", "left_semi"), window, slide, start)
    bucketed.upsert(out, again.join(touched, ["customer_id", "window_start"], "left_semi"), ["customer_id", "window_start"])


def st_order_velocity_sliding(spark: SparkSession, sf_dir: str, window: str = "1 hour", slide: str = "15 minutes",
                              start: str = "5 minutes", min_orders: int = 5, lateness: str = "10 minutes",
                              clock: int = 96, turns: int = 4) -> DataFrame:
    """ST1 at the setting of E18 with sliding windows and late rows.  The event
    clock runs ``clock`` times as fast; one purchase in seven arrives with the last
    turn, however early it was made.  Stream and re-covered late rows together
    equal the batch result."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").where(F.col("event_type") == "purchase").select(
        "event_id", "user_id", F.timestamp_micros(F.expr(f"unix_micros(cast(ts AS timestamp)) div {clock}")).alias("ets"))
    held = F.when(F.col("event_id") % 7 == 0, F.lit(ev.select(F.max("ets")).scalar())).otherwise(F.col("ets"))
    out, side = _scratch(spark, "st1-sliding"), _scratch(spark, "st1-late")

    def run(src: Callable[[], DataFrame]) -> DataFrame:
        run_update_upsert(velocity_counts(src().withWatermark("ets", lateness), window, slide, start), "st1-sliding",
                          ["customer_id", "window_start"], out)
        return run_late(src().drop("arrives"), "st1-late", lateness, side)

    late = in_turns(ev.withColumn("arrives", held), "st1-events", F.col("arrives"), turns, run)
    cover_late(out, late, ev, window, slide, start)
    cur = bucketed.read(spark, out, velocity_counts(ev, window, slide, start).schema)
    return (cur.where(F.col("order_count") >= min_orders)
            .select("customer_id", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                    F.col("window_end").cast("timestamp_ntz").alias("window_end"), "order_count"))


# -- ST2 -----------------------------------------------------------------------
def st_cart_abandonment(spark: SparkSession, sf_dir: str, gap: str = "3 days", lateness: str = "1 hour") -> DataFrame:
    """Q10/E14 as a stream: a customer's click activity forms a session that
    closes after ``gap`` of silence; a closed session is an abandoned cart.
    Append mode emits a session once the watermark passes its end."""
    return _as_carts(run_append(_click_sessions(events_stream(spark, sf_dir), gap, lateness).drop("closed"), "st2-carts"))


def _click_sessions(events: DataFrame, gap: str, lateness: str) -> DataFrame:
    return (events.where(F.col("event_type") == "click").withWatermark("ets", lateness)
            .groupBy(F.session_window("ets", gap).alias("s"), F.col("user_id").alias("customer_id"))
            .agg(F.count(F.lit(1)).alias("clicks"), F.max("ets").alias("last_click"))
            .select("customer_id", F.col("s.start").alias("session_start"), F.col("s.end").alias("session_end"),
                    "clicks", "last_click", F.window_time("s").alias("closed")))


def _as_carts(out: DataFrame) -> DataFrame:
    return out.select("customer_id", F.col("session_start").cast("timestamp_ntz").alias("session_start"),
                      F.col("session_end").cast("timestamp_ntz").alias("session_end"),
                      F.col("clicks").cast("bigint").alias("clicks"),
                      F.col("last_click").cast("timestamp_ntz").alias("last_click"))


def open_carts(events: DataFrame, purchases: DataFrame, gap: str = "3 days", lateness: str = "1 hour") -> DataFrame:
    """Closed click sessions that no purchase of the customer took out: one
    between the last click and the session's end, ``gap`` later (both ends
    included).  ``events`` and ``purchases`` are two event streams with their own
    watermarks: a left outer join in event time of closed sessions and
    purchases, which keeps purchases for about ``gap`` and sends a session without
    one when no more purchase in time can come.  Matched
    sessions are dropped, so each cart appears once."""
    carts = _click_sessions(events, gap, lateness)  # `closed` is the end less one microsecond and carries the watermark
    bought = (purchases.where(F.col("event_type") == "purchase").withWatermark("ets", lateness)
              .select(F.col("user_id").alias("buyer"), F.col("ets").alias("bought")))
    in_time = F.expr(f"buyer = customer_id AND bought > closed - INTERVAL {gap} "
                     "AND bought <= closed + INTERVAL 1 MICROSECOND")
    return carts.join(bought, in_time, "left_outer").where("buyer IS NULL").drop("buyer", "bought")


def st_open_carts(spark: SparkSession, sf_dir: str, turns: int = 4) -> DataFrame:
    """ST2 with conversions: abandoned carts less those bought in time.  The
    events arrive in ``turns``, so sessions and conversions cross micro-batches."""
    ev = spark.read.parquet(f"{sf_dir}/events.parquet").withColumn("ets", F.col("ts").cast("timestamp"))
    out = _scratch(spark, "st2-open-carts")
    return _as_carts(in_turns(ev, "st2-events", F.col("ets"), turns,
                              lambda src: run_append(open_carts(src(), src()), "st2-open-carts", out)))


# -- ST3 -----------------------------------------------------------------------
def _feed_stream(feed: DataFrame, name: str) -> DataFrame:
    """A staged table as a file stream.  Its files are not in event-time
    order, so it is read as one micro-batch (no ``maxFilesPerTrigger``):
    splitting it would make earlier events arrive after the watermark and
    after later stock movements.  Live feeds, which arrive in time order,
    bound their micro-batches with ``file_stream(max_files=...)``."""
    path = stage(feed, name)
    return file_stream(feed.sparkSession, path, feed.schema)


def st_price_log(t, ts: str) -> DataFrame:
    """T01 on a streamed product change feed (stateless)."""
    return run_append(C.chg_price_log(_feed_stream(C.product_feed(t, ts), "product-feed")), "st3-price")


def st_status_log(t, ts: str) -> DataFrame:
    """T12 on a streamed order change feed."""
    return run_append(C.chg_order_status_log(_feed_stream(C.order_feed(t, ts), "order-feed")), "st3-status")


def st_customer_audit(t, ts: str) -> DataFrame:
    """T22 on a streamed customer change feed."""
    return run_append(C.chg_customer_audit(_feed_stream(C.customer_feed(t, ts), "customer-feed")), "st3-audit")


# -- ST4 -----------------------------------------------------------------------
ALERT_SCHEMA = "product_id long, ts timestamp, stock_after long"
STATE_SCHEMA = "stock long"


def _low_stock(key: tuple, batches: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
    """Running stock of one product; emit when it crosses from above the
    threshold to at or below it (T14).  The state starts from the opening
    stock carried by the product's first movement (stream-static lookup).
    Vectorised: one sort and one cumulative sum per product and micro-batch, on
    plain arrays, as most products have a few rows and a frame operation costs
    more than those; a product's rows in one call are those of one micro-batch,
    which a live source bounds with ``maxFilesPerTrigger``."""
    parts = [[b[c].to_numpy() for c in ("ts", "seq", "delta", "opening")] for b in batches]
    ts, seq, delta, opening = parts[0] if len(parts) == 1 else (np.concatenate(c) for c in zip(*parts))
    start = state.get[0] if state.exists else int(opening[0])  # the same on every row
    if len(ts) > 1:
        order = np.lexsort((seq, ts))
        ts, delta = ts[order], delta[order]
    after = start + delta.cumsum()
    hit = (after - delta > S.LOW_STOCK) & (after <= S.LOW_STOCK)
    state.update((int(after[-1]),))
    if hit.any():
        yield pd.DataFrame({"product_id": key[0], "ts": ts[hit], "stock_after": after[hit]})


def sales_movements(t) -> DataFrame:
    """Lines admitted by the order batch (P01) as stock movements."""
    from emporium.plans.batch import bat_orders
    return bat_orders(t, t.order_requests)["orders"].select(
        F.col("id_producto").alias("product_id"), F.col("fecha_venta").alias("ts"),
        F.col("request_id").cast("long").alias("seq"), (-F.col("cantidad")).cast("long").alias("delta"))


def stock_movements(t, as_of: str) -> DataFrame:
    """Batch twin input: opening stock of every product plus the sales."""
    opening = t.productos.select(F.col("id_producto").alias("product_id"),
                                 F.timestamp_add("DAY", F.lit(-1), F.lit(as_of).cast("timestamp_ntz")).alias("ts"),
                                 F.lit(0).cast("long").alias("seq"), F.col("stock").cast("long").alias("delta"),
                                 F.lit("open").alias("kind"))
    return opening.unionByName(sales_movements(t).withColumn("kind", F.lit("sale")))


def st_low_stock(t, as_of: str) -> DataFrame:
    """T03+T14 as a keyed stateful stream (``applyInPandasWithState``).

    Sales arrive as a stream; the opening stock comes from the product table
    by a stream-static join, so only products that move get state."""
    s = _feed_stream(sales_movements(t), "movements").withColumn("ts", F.col("ts").cast("timestamp"))
    opening = t.productos.select(F.col("id_producto").alias("product_id"), F.col("stock").cast("long").alias("opening"))
    alerts = s.join(opening, "product_id").groupBy("product_id").applyInPandasWithState(
        _low_stock, ALERT_SCHEMA, STATE_SCHEMA, "append", GroupStateTimeout.NoTimeout)
    out = run_append(alerts, "st4-low-stock")
    return out.select("product_id", F.col("ts").cast("timestamp_ntz").alias("ts"), "stock_after")


# -- ST5 -----------------------------------------------------------------------
def st_daily_sales(t, lateness: str = "1 day") -> DataFrame:
    """E09 as a stream: daily windows of non-cancelled orders in update mode,
    each micro-batch upserted by day into the daily table."""
    orders = t.ventas.where(S.not_cancelled()).select("id_venta", "fecha_venta", "total")
    s = _feed_stream(orders, "orders").withColumn("ets", F.col("fecha_venta").cast("timestamp"))
    daily = (s.withWatermark("ets", lateness).groupBy(F.window("ets", "1 day").alias("w"))
             .agg(F.sum("total").alias("total_sold"), F.count(F.lit(1)).alias("order_count"))
             .select(F.to_date(F.col("w.start")).alias("day"), "total_sold", "order_count"))
    cur = run_update_upsert(daily, "st5-daily", ["day"])
    return cur.select("day", F.col("total_sold").cast("decimal(14,2)").alias("total_sold"),
                      F.col("order_count").cast("bigint").alias("order_count"))

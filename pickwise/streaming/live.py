"""Structured Streaming over the events stream.

``ts`` is timestamp_ntz, which ``withWatermark`` refuses; ``event_time`` turns
it into the same instant as a timestamp read as UTC, independent of the
session time zone, and ``wall_clock`` turns window bounds back.
"""

from __future__ import annotations

import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from pickwise.session import checkpoint_dir
from pickwise.sources.tables import TABLE_SCHEMAS

EPOCH_NTZ = "TIMESTAMP_NTZ'1970-01-01 00:00:00'"


def event_time(col: str = "ts"):
    """timestamp_ntz wall clock -> timestamp instant, taking the wall clock as UTC."""
    return F.timestamp_micros(F.expr(f"timestampdiff(MICROSECOND, {EPOCH_NTZ}, {col})"))


def ntz_of(ref: str):
    """Instant column (SQL reference such as ``w.start``) -> timestamp_ntz UTC
    wall clock, exact to the microsecond and independent of the session zone."""
    return F.expr(f"timestampadd(MICROSECOND, unix_micros({ref}), {EPOCH_NTZ})")


def event_schema() -> StructType:
    from pyspark.sql.types import DoubleType, TimestampNTZType
    types = {"bigint": LongType(), "string": StringType(), "double": DoubleType(),
             "timestamp_ntz": TimestampNTZType()}
    return StructType([StructField(c, types[t], True) for c, t in TABLE_SCHEMAS["events"].items()])


def _is_folder(spark: SparkSession, path: str) -> bool:
    """Whether ``path`` is a folder in whatever store it names."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return fs.exists(p) and fs.getFileStatus(p).isDirectory()


def event_stream(spark: SparkSession, sf_dir: str, files_per_trigger: int | None = None,
                 pattern: str = "events.parquet") -> DataFrame:
    """The events table as a stream, with ``et`` (event-time instant) and ``item_id``.

    The table is a folder of part files, whose files all belong to the stream, or one
    file, or (``pattern`` with a ``*``) several files beside each other.
    """
    reader = spark.readStream.schema(event_schema())
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    table = f"{sf_dir.rstrip('/')}/{pattern}"
    if "*" not in pattern and _is_folder(spark, table):
        s = reader.parquet(table)
    else:  # the file source reads a folder; the glob keeps it to the table's files
        s = reader.option("pathGlobFilter", pattern).parquet(sf_dir.rstrip("/"))
    return s.select("*", event_time("ts").alias("et"),
                    F.get_json_object("props", "$.k").cast("bigint").alias("item_id"))


def stream_counts(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Events per hour and type; data later than ``late`` is dropped."""
    return (stream.withWatermark("et", late)
            .groupBy(F.window("et", "1 hour").alias("w"), "event_type")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(ntz_of("w.start").alias("window_start"),
                    "event_type", "n"))


def stream_trending(stream: DataFrame, late: str = "10 minutes") -> DataFrame:
    """Events per item on 6-hour windows sliding by 1 hour."""
    return (stream.where(F.col("item_id").isNotNull()).withWatermark("et", late)
            .groupBy(F.window("et", "6 hours", "1 hour").alias("w"), "item_id")
            .agg(F.count(F.lit(1)).alias("n"))
            .select(ntz_of("w.start").alias("window_start"), "item_id", "n"))


def stream_sessions(stream: DataFrame, gap: str = "30 minutes", late: str = "10 minutes") -> DataFrame:
    """Sessions per user (session windows), for append mode: a session comes out once
    the watermark has passed its end, so none is ever replaced and state stays bounded."""
    return (stream.withWatermark("et", late)
            .groupBy(F.session_window("et", gap).alias("s"), "user_id")
            .agg(F.count(F.lit(1)).alias("events"))
            .select("user_id",
                    ntz_of("s.start").alias("session_start"),
                    ntz_of("s.end").alias("session_end"), "events"))


def stream_dedup(stream: DataFrame, keys=("user_id", "event_type", "item_id"),
                 within: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """Events whose key did not occur in the hour before, by event time.

    A run of one key without a pause of ``within`` is a session window; its first event
    (by time, then id) is the one that stays, whatever batch it came in.  Append mode:
    it comes out, and its state goes, once the watermark has passed the run's end.
    """
    first = F.min(F.struct("et", "event_id", "ts")).alias("f")
    return (stream.withWatermark("et", late)
            .groupBy(F.session_window("et", within).alias("s"), *keys).agg(first)
            .select(F.col("f.event_id").alias("event_id"), *keys, F.col("f.ts").alias("ts")))


def stream_view_to_purchase(views: DataFrame, purchases: DataFrame, within: str = "1 hour",
                            late: str = "2 hours") -> DataFrame:
    """Each view followed by a purchase of the same user within ``within``
    (stream-stream interval join; both sides carry watermarks so state ends)."""
    v = (views.where(F.col("event_type") == "view").withWatermark("et", late)
         .select(F.col("user_id").alias("v_user"), F.col("event_id").alias("view_id"), F.col("et").alias("v_et")))
    p = (purchases.where(F.col("event_type") == "purchase").withWatermark("et", late)
         .select(F.col("user_id").alias("p_user"), F.col("event_id").alias("purchase_id"),
                 F.col("et").alias("p_et")))
    cond = ((F.col("v_user") == F.col("p_user")) & (F.col("p_et") >= F.col("v_et"))
            & (F.col("p_et") <= F.col("v_et") + F.expr(f"INTERVAL {within}")))
    return v.join(p, cond, "inner").select(F.col("v_user").alias("user_id"), "view_id", "purchase_id")


PROFILE_SCHEMA = "user_id bigint, events bigint, purchases bigint, value_cents bigint, last_ts timestamp"
PROFILE_STATE = "events bigint, purchases bigint, value_cents bigint, last_ts timestamp"


def stream_profile(stream: DataFrame, idle_days: int = 90, late: str = "1 day") -> DataFrame:
    """Running profile per user kept in streaming state
    (``applyInPandasWithState``): events, purchases, value in whole cents (so the order
    of the batches cannot show) and last event time, emitted on every update.

    A user's state is dropped once the watermark is ``idle_days`` past the user's last event, so it
    follows the active users and not all there ever were; a user who comes back starts anew.
    Events more than ``late`` behind the watermark's time are dropped.
    """
    import pandas as pd

    idle = idle_days * 86_400_000

    def update(key, batches, state):
        if state.hasTimedOut:
            state.remove()
            return
        if state.exists:
            ev, pu, vs, last = state.get
        else:
            ev, pu, vs, last = 0, 0, 0, None
        for pdf in batches:
            ev += len(pdf)
            pu += int((pdf["event_type"] == "purchase").sum())
            vs += int(pdf["cents"].sum())
            m = pdf["et"].max()
            last = m if last is None or m > last else last
        state.update((ev, pu, vs, last))
        state.setTimeoutTimestamp(max(int(last.timestamp() * 1000) + idle, state.getCurrentWatermarkMs() + 1))
        yield pd.DataFrame({"user_id": [key[0]], "events": [ev], "purchases": [pu],
                            "value_cents": [vs], "last_ts": [last]})

    cents = F.coalesce(F.round(F.col("value") * 100).cast("bigint"), F.lit(0)).alias("cents")
    return (stream.select("user_id", "event_type", cents, "et").withWatermark("et", late)
            .groupBy("user_id")
            .applyInPandasWithState(update, PROFILE_SCHEMA, PROFILE_STATE, "update", "EventTimeTimeout"))


# ---------------------------------------------------------------- running

_STARTING = threading.Lock()


def _start(writer, spark: SparkSession, state_partitions: int | None):
    """Start a query with ``state_partitions`` state-store partitions (default:
    the cluster's parallelism).  A stream fixes this number in its checkpoint
    at first start from ``spark.sql.shuffle.partitions``, so it is set only
    around ``start``."""
    n = state_partitions or spark.sparkContext.defaultParallelism
    key = "spark.sql.shuffle.partitions"
    with _STARTING:  # the setting is the session's: one start at a time
        prev = spark.conf.get(key)
        spark.conf.set(key, str(n))
        try:
            return writer.start()
        finally:
            spark.conf.set(key, prev)


def _scratch(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/streams/{name}-{uuid.uuid4().hex[:12]}"


def run_append(df: DataFrame, name: str,
               state_partitions: int | None = None) -> DataFrame:
    """Run an append-mode stream to the end of its input (availableNow) into
    Parquet under the shared checkpoint folder; return the output as a batch
    DataFrame."""
    spark = df.sparkSession
    base = _scratch(spark, name)
    q = _start(df.writeStream.format("parquet").outputMode("append")
               .option("checkpointLocation", f"{base}/ckpt").option("path", f"{base}/out")
               .trigger(availableNow=True), spark, state_partitions)
    q.awaitTermination()  # to the end of the input; a failed stream raises
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def run_upserts(df: DataFrame, name: str, keys: list[str],
                state_partitions: int | None = None) -> DataFrame:
    """Run an update-mode stream to the end of its input; every micro-batch's rows are appended (with the batch id) to a change log
    by ``foreachBatch``, and the final state is the newest row per key (a
    partial aggregate)."""
    spark = df.sparkSession
    base = _scratch(spark, name)
    log = f"{base}/log"

    def sink(batch: DataFrame, batch_id: int) -> None:
        batch.withColumn("_batch", F.lit(batch_id)).write.mode("append").parquet(log)

    q = _start(df.writeStream.outputMode("update").foreachBatch(sink)
               .option("checkpointLocation", f"{base}/ckpt").trigger(availableNow=True),
               spark, state_partitions)
    q.awaitTermination()  # to the end of the input; a failed stream raises
    out = spark.read.parquet(log)
    vals = [c for c in df.columns if c not in keys]
    last = F.max_by(F.struct(*vals), F.col("_batch")).alias("_v")
    return out.groupBy(*keys).agg(last).select(*keys, *[F.col(f"_v.{c}").alias(c) for c in vals])

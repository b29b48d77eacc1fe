"""Distributed global ranking.

``row_number() OVER (ORDER BY ...)`` without a partition runs in a single task.
``global_rank`` instead range-partitions and sorts the data, counts rows per
partition (one row per partition, a proven small table), turns the counts into
offsets and adds each row's position inside its partition.  The sorted and
numbered data is checkpointed first, so both uses see the same partitioning.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pickwise.session import checkpoint_dir

#: rows of a range bucket that ``running`` and ``neighbor_rows`` scan in one task
BUCKET_ROWS = 1_000_000


def global_rank(df: DataFrame, order: list[Column], name: str = "grank",
                keep_bucket: bool = False) -> DataFrame:
    """Append ``name`` = 1-based position of each row in the total order ``order``.

    ``order`` must be a total order (end it with a unique key) for ranks to be
    repeatable.  ``keep_bucket`` also keeps ``_bucket``, the range partition the
    row fell in (buckets are contiguous, ordered runs of ranks).
    """
    spark = df.sparkSession
    checkpoint_dir(spark)
    cols = df.columns
    # buckets grow in number with the table, not in size
    buckets = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // BUCKET_ROWS))
    numbered = (df.repartitionByRange(buckets, *order).sortWithinPartitions(*order)
                .withColumn("_pid", F.spark_partition_id())
                .withColumn("_mid", F.monotonically_increasing_id())
                .checkpoint(eager=True))
    offsets = (numbered.groupBy("_pid").agg(F.count(F.lit(1)).alias("_cnt"))
               .select("_pid", (F.sum("_cnt").over(Window.orderBy("_pid")) - F.col("_cnt"))
                       .alias("_off")))
    local = F.col("_mid") - F.shiftleft(F.col("_pid").cast("bigint"), 33)
    return (numbered.join(F.broadcast(offsets), "_pid")
            .select(*cols, (F.col("_off") + local + F.lit(1)).cast("bigint").alias(name),
                    *([F.col("_pid").alias("_bucket")] if keep_bucket else [])))


def neighbor_rows(ranked: DataFrame, key: str, cols: list[str], rank: str = "g",
                  step: int = -1, prefix: str = "prev_") -> DataFrame:
    """Values of the row ``step`` places away in the global order, when it has
    the same ``key`` (lag for step -1, lead for +1); null otherwise.

    ``ranked`` keeps its ``_bucket``.  The neighbor is found inside the bucket; where it
    lies in another one, it is among the |step| rows at that bucket's edge: so many rows
    per bucket are sent to every task and met on the rank.
    """
    n = abs(step)
    near = F.struct(F.col(key).alias("_nk"), *[F.col(c).alias(prefix + c) for c in cols])
    bucket = Window.partitionBy("_bucket")
    inside = (F.lag if step < 0 else F.lead)(near, n).over(bucket.orderBy(F.col(rank).asc()))
    from_edge = F.row_number().over(bucket.orderBy(F.col(rank).desc() if step < 0 else F.col(rank).asc()))
    edge = (ranked.withColumn("_e", from_edge).where(F.col("_e") <= F.lit(n))
            .select((F.col(rank) - F.lit(step)).alias(rank), near.alias("_edge")))
    j = ranked.withColumn("_in", inside).join(F.broadcast(edge), rank, "left")
    found = F.coalesce(F.col("_in"), F.col("_edge"))
    same = found["_nk"] == F.col(key)
    return j.select(*ranked.columns,
                    *[F.when(same, found[prefix + c]).alias(prefix + c) for c in cols])


def running(ranked: DataFrame, value: Column, name: str, how: str = "sum",
            rank: str = "g") -> DataFrame:
    """Running ``sum`` or ``max`` of ``value`` over the whole global order.

    Each range bucket is scanned on its own (a window over one bucket of about
    ``BUCKET_ROWS`` rows at most); the totals of earlier buckets, one row
    per bucket, are carried in through a broadcast.
    """
    agg = {"sum": F.sum, "max": F.max}[how]
    upto = Window.partitionBy("_bucket").orderBy(rank).rowsBetween(Window.unboundedPreceding, 0)
    local = ranked.withColumn("_v", value).withColumn("_loc", agg("_v").over(upto))
    before = Window.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    carry = (local.groupBy("_bucket").agg(agg("_v").alias("_bt"))
             .select("_bucket", agg("_bt").over(before).alias("_carry")))
    j = local.join(F.broadcast(carry), "_bucket")
    if how == "sum":
        out = F.coalesce(F.col("_carry"), F.lit(0)) + F.coalesce(F.col("_loc"), F.lit(0))
    else:
        out = F.greatest(F.col("_carry"), F.col("_loc"))
    return j.select(*ranked.columns, out.alias(name))

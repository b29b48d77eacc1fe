"""Work dealt over the cluster: joins that adaptive execution can split, and small tables.

Adaptive execution cuts a skewed join partition in pieces only where both join inputs
are plain shuffles.  An aggregate on the join key already has the right partitioning, is
joined without a shuffle of its own, and so pins the fact's hot key to one task.
``loose`` deals the (small, one row per key) aggregate out again first: the join then
shuffles both sides itself and may split the fact's side of a hot key, sending the one
matching row to each piece.
"""

from __future__ import annotations

from pyspark.sql import DataFrame


def loose(agg: DataFrame) -> DataFrame:
    """``agg`` without the partitioning of its aggregate."""
    return agg.hint("rebalance")


#: bytes of a table's files to a shuffle partition, before adaptive execution joins small ones
ROOM = 2 << 20
#: bytes of a shuffle to a task at most, before adaptive execution takes the next partition to another
SHARE = 4 * ROOM


def _bytes(df: DataFrame) -> int:
    """The optimizer's size of ``df``."""
    return int(str(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))


def _size(df: DataFrame, name: str) -> int:
    """A setting of the session that is a number of bytes."""
    return df.sparkSession._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(df.sparkSession.conf.get(name))


def roomy(table: DataFrame) -> DataFrame:
    """``table``, with shuffles that grow in number of partitions with it: adaptive execution joins small
    partitions but cuts no large ones of an aggregate or a sort, so a fixed number of them makes
    tasks grow with the input.  Nor does it join them to more than ``SHARE``: Spark's own 64 MB of packed rows
    are gigabytes in an aggregate's map once grouping sets have multiplied them.  The session's number of
    partitions is only ever raised, the size of joined ones only ever lowered."""
    share = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    if _size(table, share) > SHARE:
        table.sparkSession.conf.set(share, str(SHARE))
    conf, name = table.sparkSession.conf, "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    now = int(conf.get(name, None) or conf.get("spark.sql.shuffle.partitions"))
    if _bytes(table) // ROOM > now:
        conf.set(name, str(_bytes(table) // ROOM))
    return table


def dealt(df: DataFrame) -> DataFrame:
    """``df`` over all cores where its input is smaller than a scan partition to each: such a table
    is often one file with one row group, read (and its texts cut) in a single task.  The
    size is the optimizer's, so a large table, which has splits enough, is left as it is."""
    spark = df.sparkSession
    cores = spark.sparkContext.defaultParallelism
    split = spark._jsparkSession.sessionState().conf().filesMaxPartitionBytes()
    return df.repartition(cores) if _bytes(df) < cores * split else df

"""What several operators of this subpackage share: words, written tables, hashed blocks."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.session import checkpoint_dir

#: a word: a run of anything but space, tab, line feed, vertical tab, form feed, carriage return;
#: ``bytes.split()`` cuts at exactly these six bytes
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame) -> DataFrame:
    """``df`` written once to the shared folder and read back: cuts lineage, survives lost executors."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out.written_path = path
    return out


def forget(*tables: DataFrame) -> None:
    """Delete written tables that no later plan reads."""
    for table in tables:
        spark = table.sparkSession
        path = spark._jvm.org.apache.hadoop.fs.Path(table.written_path)
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def block_count(rows: int, rows_per_block: int) -> int:
    """Blocks that hold about ``rows_per_block`` rows each; grows with the table."""
    return max(1, -(-rows // rows_per_block))


#: bytes of text that stand for a row where blocks are counted
ROW_BYTES = 5000


def in_blocks(docs: DataFrame, rows_per_block: int) -> DataFrame:
    """(block, doc_id, text) with null texts as empty; a block is a hash group of documents, of
    ``rows_per_block`` rows or ``ROW_BYTES`` for each of them, whichever is reached first.

    The hash takes id and text, so rows that share an id (or have none) spread too.
    """
    rows, size = docs.agg(F.count(F.lit(1)), F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()
    n = max(block_count(rows, rows_per_block), block_count(size, rows_per_block * ROW_BYTES))
    d, t = F.col("doc_id").cast("long"), F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.pmod(F.xxhash64(d, t), F.lit(n)).cast("int").alias("block"),
                       d.alias("doc_id"), t.alias("text"))


def spread(df: DataFrame, *by) -> DataFrame:
    """Hash ``df`` over the session's shuffle partitions by the given columns."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *by)


def slices(batches, rows: int = 256):
    """The batches in shorter ones, to hold less beside them."""
    for batch in batches:
        for k in range(0, batch.num_rows, rows):
            yield batch.slice(k, rows)

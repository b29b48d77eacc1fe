"""Mixing sources to target weights: hash order, distributed prefix sums, exact cuts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pickwise.llm.common import WORD, written


def targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3) -> DataFrame:
    """Target words per source from (source, source_size): one row per source.

    Sources in code-point order (null last) take ``weights`` in turn.  All words are
    shared by weight; no target passes ``limit`` times its source, and what is over is
    shared again by weight.  That has a closed form: with sources in order of
    limit/weight, the first k are full and the rest get weight times one level; k is
    the least for which the next one is not full.
    """
    by_name = Window.orderBy(F.col("source").isNull(), "source")  # one row per source, not per document
    cycle = F.array(*[F.lit(w) for w in weights])
    ranked = (sizes.withColumn("w", F.get(cycle, (F.row_number().over(by_name) - 1) % len(weights)))
              .withColumn("most", limit * F.col("source_size")))
    order = Window.orderBy(F.col("most") / F.col("w"), F.col("source").isNull(), "source")
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    leveled = (ranked.withColumn("level", (F.sum("source_size").over(every)
                                           - F.coalesce(F.sum("most").over(before), F.lit(0)))
                                 / F.sum("w").over(rest))
               .withColumn("open", F.col("level") * F.col("w") <= F.col("most")))
    # the first open source in the order sets the level of all after it
    level = F.max(F.when(F.col("open"), F.struct(-F.col("most") / F.col("w"), F.col("level")))).over(every)["level"]
    return leveled.withColumn("at", level).select(
        "source", "source_size",
        F.when(F.col("at").isNull() | (F.col("w") * F.col("at") > F.col("most")), F.col("most").cast("double"))
        .otherwise(F.col("w") * F.col("at")).alias("target"))


def mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3, carry: tuple[str, ...] = ()) -> DataFrame:
    """For every row: doc_id, size, source_size, target, taken, copies, part, and ``carry`` columns.

    Size is the number of words (null text: 0).  A source gives whole epochs of all its
    documents (``copies``) and, of one more, the documents in md5(doc_id) order until its
    rounded target is met; the one at the cut gives its first ``part`` words.  So the
    words taken from a source equal its rounded target, and reruns agree.
    Rows without id order by the empty key; rows that share an id order by size, and
    equal ones are interchangeable.  An empty table gives an empty result; a source of
    empty texts has target 0.  Other columns are ignored.
    """
    sized = docs.select(F.col("doc_id").cast("long"), "source",
                        F.when(F.col("text").isNull(), 0).otherwise(F.regexp_count("text", F.lit(WORD)))
                        .cast("long").alias("size"),
                        F.coalesce(F.md5(F.col("doc_id").cast("string")), F.lit("")).alias("key"),
                        F.monotonically_increasing_id().alias("seq"), *carry)
    order = [F.col("source"), F.col("key"), F.col("doc_id"), F.col("size"), F.col("seq")]
    n = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # the range partitions become a written table with their number, so that the passes
    # over it agree; a hot source is cut into many ranges
    sized = written(sized)
    ranged = written(sized.repartitionByRange(n, *order).withColumn("pid", F.spark_partition_id()))
    sums = ranged.groupBy("source", "pid").agg(F.sum("size").alias("words"))
    sums = written(sums)
    goal = targets(sums.groupBy("source").agg(F.sum("words").alias("source_size")), weights, limit)
    before = F.coalesce(F.sum("words").over(Window.partitionBy("source").orderBy("pid")
                                            .rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    starts = (sums.withColumn("start", before)
              .join(goal.withColumnRenamed("source", "s"), F.col("source").eqNullSafe(F.col("s")))
              .select(F.col("source").alias("s"), F.col("pid").alias("p"), "start", "source_size", "target"))
    inner = (Window.partitionBy("source", "pid").orderBy("key", "doc_id", "size", "seq")
             .rowsBetween(Window.unboundedPreceding, -1))
    placed = (ranged.withColumn("ahead", F.coalesce(F.sum("size").over(inner), F.lit(0)))
              .join(starts, F.col("source").eqNullSafe(F.col("s")) & (F.col("pid") == F.col("p"))))
    budget = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.expr("cast(round(target) as bigint) div source_size")).otherwise(0)
    left = budget - epochs * F.col("source_size") - F.col("start") - F.col("ahead")
    part = F.greatest(F.lit(0), F.least(F.col("size"), left))
    return (placed.withColumn("copies", epochs.cast("long")).withColumn("part", part.cast("long"))
            .select("doc_id", "size", "source_size", "target",
                    (F.col("copies") * F.col("size") + F.col("part")).alias("taken"), "copies", "part", *carry))


def apply_mix(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), limit: int = 3) -> DataFrame:
    """The mix itself, with the columns of ``docs``: each document once per copy, and the
    one at a source's cut shortened to the words that are taken (joined by one space)."""
    rows = written(docs.withColumn("__row", F.monotonically_increasing_id()))
    plan = (mix(rows, weights, limit, carry=("__row",)).filter("taken > 0")
            .select("__row", F.col("copies").alias("__copies"), F.col("part").alias("__part"), F.col("size").alias("__size")))
    cut = (F.col("__part") > 0) & (F.col("__part") < F.col("__size"))
    times = F.col("__copies") + F.when(F.col("__part") > 0, 1).otherwise(0)
    taken = (rows.join(plan, "__row")
             .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), times)))
             .withColumn("__cut", cut & (F.col("__copy") > F.col("__copies"))))
    short = F.array_join(F.slice(F.regexp_extract_all("text", F.lit(WORD), F.lit(0)), 1, F.col("__part").cast("int")), " ")
    taken = taken.withColumn("text", F.when(F.col("__cut"), short).otherwise(F.col("text")))
    if "n_chars" in docs.columns:
        taken = taken.withColumn("n_chars", F.when(F.col("__cut"), F.length("text").cast("long")).otherwise(F.col("n_chars")))
    return taken.select(*docs.columns)

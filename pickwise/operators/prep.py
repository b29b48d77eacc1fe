"""Preparation of interaction tables and train/test splits."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.operators.skew import loose


def min_support(inter: DataFrame, ku: int = 2, ki: int = 2, rounds: int = 2) -> DataFrame:
    """``rounds`` passes, each keeping users with >= ku items, then items
    with >= ki users (counts are partial aggregates; filters are semi joins)."""
    out = inter
    for _ in range(rounds):
        users = (out.groupBy("user_id").agg(F.count(F.lit(1)).alias("c"))
                 .where(F.col("c") >= F.lit(ku)).select("user_id"))
        out = out.join(loose(users), "user_id", "left_semi")
        items = (out.groupBy("item_id").agg(F.count(F.lit(1)).alias("c"))
                 .where(F.col("c") >= F.lit(ki)).select("item_id"))
        out = out.join(loose(items), "item_id", "left_semi")
    return out.select(*inter.columns)


def mark_last(ratings: DataFrame, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """P2 core: add ``split`` = 'test' for the newest row per user by (ts, tie),
    'train' otherwise; a user with one row stays in train.

    The newest row and the row count per user are partial aggregates joined
    back, so a user with a huge history is never sorted in one task.
    """
    last = (ratings.groupBy("user_id")
            .agg(F.max(F.struct(F.col(ts).alias("t"), F.col(tie).alias("e"))).alias("_last"),
                 F.count(F.lit(1)).alias("_cnt")))
    is_test = ((F.col("_cnt") > 1) & (F.col(ts) == F.col("_last.t"))
               & (F.col(tie) == F.col("_last.e")))
    return (ratings.join(loose(last), "user_id")
            .select(*ratings.columns,
                    F.when(is_test, F.lit("test")).otherwise(F.lit("train")).alias("split")))


def split_last(ratings: DataFrame, ts: str = "ts", tie: str = "event_id"):
    """Leave-last-out split -> (train, test)."""
    marked = mark_last(ratings, ts, tie)
    cols = ratings.columns
    return (marked.where(F.col("split") == "train").select(*cols),
            marked.where(F.col("split") == "test").select(*cols))


def split_time(df: DataFrame, cut, ts: str = "ts"):
    """Rows before ``cut`` train, the rest test."""
    c = F.lit(cut).cast(df.schema[ts].dataType)
    return df.where(F.col(ts) < c), df.where(F.col(ts) >= c)


def hash_bucket(user: str = "user_id", item: str = "item_id") -> "F.Column":
    """Repeatable bucket 0..9 from the ids alone (no seed, no engine hash)."""
    return F.pmod(F.col(user) * F.lit(31) + F.col(item) * F.lit(17), F.lit(10))


def split_hash(df: DataFrame, k: int = 8):
    """Bucket < k train, else test."""
    b = hash_bucket()
    return df.where(b < F.lit(k)), df.where(b >= F.lit(k))


def decay(inter: DataFrame, ref, lam: float = 0.01, ts: str = "last_ts") -> DataFrame:
    """P5: add ``dw = w * exp(-lam * days(ref - ts))`` (whole days)."""
    days = F.datediff(F.lit(ref).cast("date"), F.col(ts).cast("date"))
    return inter.withColumn("dw", F.col("w") * F.exp(F.lit(-lam) * days))

"""Scans of the input tables and the shapes every operator consumes.

Shapes (column order is part of the contract):

* Interactions: user_id bigint, item_id bigint, n bigint, w double, last_ts timestamp_ntz
* Ratings:      user_id bigint, item_id bigint, rating int, ts timestamp_ntz, event_id bigint
* Items:        item_id bigint, tags array<string>, text string, lang string
* Neighbors:    id bigint, other bigint, support bigint, score bigint (millionths)
* Recs:         user_id bigint, item_id bigint, score bigint, rank bigint, source string
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.operators.skew import roomy

# Fixed input schemas (column -> Spark simple type), as the driver writes them.
TABLE_SCHEMAS: dict[str, dict[str, str]] = {
    "region": {"r_regionkey": "int", "r_name": "string"},
    "nation": {"n_nationkey": "int", "n_name": "string", "n_regionkey": "int"},
    "customer": {"c_custkey": "bigint", "c_name": "string", "c_nationkey": "int",
                 "c_acctbal": "double", "c_mktsegment": "string"},
    "supplier": {"s_suppkey": "bigint", "s_name": "string", "s_nationkey": "int",
                 "s_acctbal": "double"},
    "part": {"p_partkey": "bigint", "p_name": "string", "p_brand": "string",
             "p_type": "string", "p_size": "int", "p_retailprice": "double"},
    "orders": {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string",
               "o_totalprice": "double", "o_orderdate": "timestamp_ntz",
               "o_orderpriority": "string"},
    "lineitem": {"l_orderkey": "bigint", "l_partkey": "bigint", "l_suppkey": "bigint",
                 "l_linenumber": "int", "l_quantity": "double", "l_extendedprice": "double",
                 "l_discount": "double", "l_tax": "double", "l_returnflag": "string",
                 "l_linestatus": "string", "l_shipdate": "timestamp_ntz"},
    "events": {"event_id": "bigint", "ts": "timestamp_ntz", "user_id": "bigint",
               "event_type": "string", "value": "double", "props": "string"},
    "documents": {"doc_id": "bigint", "text": "string", "lang": "string",
                  "source": "string", "n_chars": "bigint"},
    "embeddings": {"vec_id": "bigint", "embedding": "array<float>", "label": "int"},
    "pages": {"page_id": "bigint", "url": "string", "html": "string"},
    "benchmark": {"item_id": "bigint", "text": "string"},
    "labels": {"doc_id": "bigint", "quality": "int", "toxic": "int"},
    "conversations": {"conv_id": "bigint", "turn": "bigint", "role": "string", "text": "string"},
}

# Fixed event weights for implicit feedback (S5); other event types are dropped.
DEFAULT_EVENT_WEIGHTS = {"view": 1.0, "click": 2.0, "purchase": 5.0}


def check_schema(df: DataFrame, expected: dict[str, str], what: str = "input") -> DataFrame:
    """Fail fast when a column is missing or has another type."""
    actual = {f.name: f.dataType.simpleString() for f in df.schema.fields}
    bad = [f"{c}: want {t}, got {actual.get(c, 'missing')}"
           for c, t in expected.items() if actual.get(c) != t]
    if bad:
        raise ValueError(f"{what} schema mismatch: " + "; ".join(bad))
    return df


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one Parquet table and check its schema.  Projection and filters
    applied later are pushed into this scan by Catalyst."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return check_schema(df, TABLE_SCHEMAS[name], name)


def interactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Implicit user-item interactions from order lines.

    One row per (customer, part): line count, total quantity, latest order date.
    """
    li = roomy(load(spark, sf_dir, "lineitem")).select("l_orderkey", "l_partkey", "l_quantity")
    od = load(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return (li.join(od, li.l_orderkey == od.o_orderkey, "inner")
            .groupBy(F.col("o_custkey").alias("user_id"), F.col("l_partkey").alias("item_id"))
            .agg(F.count(F.lit(1)).alias("n"),
                 F.sum("l_quantity").alias("w"),
                 F.max("o_orderdate").alias("last_ts")))


def rating_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event mapped to (user, item, rating, ts, event_id, event_type)."""
    ev = load(spark, sf_dir, "events")
    return ev.select(
        "user_id",
        F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
        F.least(F.lit(5), F.lit(1) + F.floor(F.col("value") / F.lit(40.0))).cast("int").alias("rating"),
        "ts", "event_id", "event_type")


def ratings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S3: explicit ratings, the latest event per (user, item) by (ts, event_id).

    "Latest" is a max over a struct, so it is a partial (map-side) aggregate and a
    hot (user, item) pair never lands whole in one task the way a window would.
    """
    ev = rating_events(spark, sf_dir).where(F.col("item_id").isNotNull())
    last = F.max(F.struct("ts", "event_id", "rating")).alias("last")
    return (ev.groupBy("user_id", "item_id").agg(last)
            .select("user_id", "item_id", F.col("last.rating").alias("rating"),
                    F.col("last.ts").alias("ts"), F.col("last.event_id").alias("event_id")))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as article items."""
    d = load(spark, sf_dir, "documents")
    return d.select(F.col("doc_id").alias("item_id"),
                    F.lit(None).cast("array<string>").alias("tags"), "text", "lang")


def catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts as catalog items tagged with brand and type."""
    p = roomy(load(spark, sf_dir, "part"))
    return p.select(F.col("p_partkey").alias("item_id"),
                    F.array("p_brand", "p_type").alias("tags"),
                    F.lit(None).cast("string").alias("text"),
                    F.lit(None).cast("string").alias("lang"))


def event_weights(events: DataFrame, weights: dict[str, float] | None = None) -> DataFrame:
    """Weighted implicit feedback from raw events.

    The weight table is a fixed handful of entries, so it is inlined as a CASE
    expression instead of joined: no shuffle, no broadcast.
    """
    weights = weights or DEFAULT_EVENT_WEIGHTS
    wexpr = None
    for etype, wt in weights.items():
        cond = F.col("event_type") == F.lit(etype)
        wexpr = F.when(cond, F.lit(float(wt))) if wexpr is None else wexpr.when(cond, F.lit(float(wt)))
    scored = (events.where(F.col("event_type").isin(list(weights)))
              .select("user_id",
                      F.get_json_object("props", "$.k").cast("bigint").alias("item_id"),
                      wexpr.alias("wt"), "ts")
              .where(F.col("item_id").isNotNull()))
    return (scored.groupBy("user_id", "item_id")
            .agg(F.count(F.lit(1)).alias("n"), F.sum("wt").alias("w"), F.max("ts").alias("last_ts")))


def published(recs: DataFrame) -> DataFrame:
    """S6 frame: one row per user with the ranked list as array<struct>.

    A list holds at most N entries (top-N input), so the per-user collect is bounded.
    """
    return (recs.groupBy("user_id")
            .agg(F.array_sort(F.collect_list(F.struct(
                F.col("rank").cast("bigint").alias("rank"), "item_id", "score"))).alias("items")))


def publish(recs: DataFrame, path: str) -> None:
    """Write the served lists to Parquet (overwrite)."""
    published(recs).write.mode("overwrite").parquet(path)

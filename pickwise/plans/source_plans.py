"""S1-S6 as registered queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pickwise.plans.registry import register
from pickwise.plans.sqlparts import INTER, RATINGS
from pickwise.sources import tables as src


@register("s2_interactions", f"WITH {INTER} SELECT * FROM inter")
def s2_interactions(spark, sf_dir):
    return src.interactions(spark, sf_dir)


@register("s3_ratings", f"WITH {RATINGS} SELECT * FROM ratings")
def s3_ratings(spark, sf_dir):
    return src.ratings(spark, sf_dir)


@register("s4_articles", "SELECT doc_id AS item_id, text, lang FROM documents")
def s4_articles(spark, sf_dir):
    return src.articles(spark, sf_dir).select("item_id", "text", "lang")


@register("s4_catalog", "SELECT p_partkey AS item_id, [p_brand, p_type] AS tags FROM part")
def s4_catalog(spark, sf_dir):
    return src.catalog(spark, sf_dir).select("item_id", "tags")


@register("s5_event_weights", """
SELECT user_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, count(*) AS n,
       sum(CASE event_type WHEN 'view' THEN 1.0 WHEN 'click' THEN 2.0 ELSE 5.0 END)::DOUBLE AS w,
       max(ts) AS last_ts
FROM events WHERE event_type IN ('view', 'click', 'purchase')
GROUP BY 1, 2""")
def s5_event_weights(spark, sf_dir):
    return src.event_weights(src.load(spark, sf_dir, "events"))


@register("s1_orders_scan", """
SELECT o_orderkey, o_custkey, o_totalprice FROM orders
WHERE o_orderdate >= TIMESTAMP '1998-01-01' AND o_orderstatus = 'F'""")
def s1_orders_scan(spark, sf_dir):
    """A scan with projection and filters pushed into Parquet."""
    od = src.load(spark, sf_dir, "orders")
    return (od.where((F.col("o_orderdate") >= F.lit("1998-01-01").cast("timestamp_ntz"))
                     & (F.col("o_orderstatus") == "F"))
            .select("o_orderkey", "o_custkey", "o_totalprice"))

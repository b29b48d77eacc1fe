"""Popularity (A-rows) and preparation (P-rows) queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pickwise.operators import popularity as pop
from pickwise.operators import prep
from pickwise.plans import sqlparts as q
from pickwise.plans.registry import register
from pickwise.sources import tables as src

EVENTS_REF = "2024-01-31"
ORDERS_REF = "2001-08-02"


@register("a1_popular", f"""WITH {q.INTER}
SELECT * FROM (SELECT item_id, count(*) AS users,
  CAST(row_number() OVER (ORDER BY count(*) DESC, item_id) AS BIGINT) AS rank
  FROM inter GROUP BY item_id) WHERE rank <= 10""")
def a1_popular(spark, sf_dir):
    return pop.popular(src.interactions(spark, sf_dir), 10)


@register("a2_top_rated", f"""WITH {q.RATINGS},
mu AS (SELECT avg(rating) AS mu FROM ratings),
per AS (SELECT item_id, count(*) AS n, {q.r6('(sum(rating) + 10.0 * (SELECT mu FROM mu)) / (count(*) + 10.0)')} AS score
        FROM ratings GROUP BY item_id)
SELECT * FROM (SELECT *, CAST(row_number() OVER (ORDER BY score DESC, item_id) AS BIGINT) AS rank FROM per)
WHERE rank <= 20""")
def a2_top_rated(spark, sf_dir):
    return pop.top_rated(src.ratings(spark, sf_dir), 10.0, 20)


@register("a3_popular_by_segment", f"""WITH {q.INTER},
per AS (SELECT c_mktsegment, item_id, count(DISTINCT user_id) AS users
        FROM inter JOIN customer ON c_custkey = user_id GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY c_mktsegment ORDER BY users DESC, item_id) AS BIGINT) AS rank
               FROM per) WHERE rank <= 3""")
def a3_popular_by_segment(spark, sf_dir):
    cust = src.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    return pop.popular_by(src.interactions(spark, sf_dir), cust, "c_mktsegment", 3)


@register("a3_popular_by_brand", f"""WITH {q.INTER},
per AS (SELECT p_brand, item_id, count(DISTINCT user_id) AS users
        FROM inter JOIN part ON p_partkey = item_id GROUP BY 1, 2)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY p_brand ORDER BY users DESC, item_id) AS BIGINT) AS rank
               FROM per) WHERE rank <= 3""")
def a3_popular_by_brand(spark, sf_dir):
    part = src.load(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), "p_brand")
    return pop.popular_by(src.interactions(spark, sf_dir), part, "p_brand", 3, on="item_id")


def _summary_sql(grouping: str) -> str:
    return f"""WITH {q.INTER}
SELECT c_mktsegment, p_type, CAST(GROUPING(c_mktsegment, p_type) AS BIGINT) AS lvl,
       count(*) AS pairs, sum(w) AS qty, count(DISTINCT user_id) AS users
FROM inter JOIN customer ON c_custkey = user_id JOIN part ON p_partkey = item_id
GROUP BY {grouping}"""


def _summary(spark, sf_dir, mode):
    cust = src.load(spark, sf_dir, "customer").select(F.col("c_custkey").alias("user_id"), "c_mktsegment")
    part = src.load(spark, sf_dir, "part").select(F.col("p_partkey").alias("item_id"), "p_type")
    return pop.summary(src.interactions(spark, sf_dir), cust, part, "c_mktsegment", "p_type", mode)


@register("a4_summary_rollup", _summary_sql("ROLLUP (c_mktsegment, p_type)"))
def a4_summary_rollup(spark, sf_dir):
    return _summary(spark, sf_dir, "rollup")


@register("a4_summary_cube", _summary_sql("CUBE (c_mktsegment, p_type)"))
def a4_summary_cube(spark, sf_dir):
    return _summary(spark, sf_dir, "cube")


@register("a4_summary_sets", _summary_sql("GROUPING SETS ((c_mktsegment), (p_type), ())"))
def a4_summary_sets(spark, sf_dir):
    return _summary(spark, sf_dir, "sets")


@register("a5_rating_profile", f"""WITH {q.RATINGS}
SELECT item_id, count(*) AS n,
  count_if(rating = 1) AS r1, count_if(rating = 2) AS r2, count_if(rating = 3) AS r3,
  count_if(rating = 4) AS r4, count_if(rating = 5) AS r5,
  {q.r6('sum(rating) / count(*)')} AS mean,
  {q.r6('(count(*) * sum(rating * rating) - sum(rating) * sum(rating)) / (count(*) * count(*))')} AS var
FROM ratings GROUP BY item_id""")
def a5_rating_profile(spark, sf_dir):
    return pop.rating_profile(src.ratings(spark, sf_dir))


@register("a6_trending", f"""WITH e AS (
  SELECT DISTINCT CAST(json_extract_string(props, '$.k') AS BIGINT) AS item_id, user_id,
         CAST(ts >= TIMESTAMP '{EVENTS_REF}' - INTERVAL 7 DAY AS INTEGER) AS recent
  FROM events WHERE ts >= TIMESTAMP '{EVENTS_REF}' - INTERVAL 14 DAY AND ts < TIMESTAMP '{EVENTS_REF}'),
per AS (SELECT item_id, CAST(sum(recent) AS BIGINT) AS recent, CAST(sum(1 - recent) AS BIGINT) AS before
        FROM e WHERE item_id IS NOT NULL GROUP BY item_id)
SELECT * FROM (SELECT *, recent - before AS delta,
  CAST(row_number() OVER (ORDER BY recent - before DESC, item_id) AS BIGINT) AS rank FROM per) WHERE rank <= 10""")
def a6_trending(spark, sf_dir):
    return pop.trending(src.load(spark, sf_dir, "events"), EVENTS_REF, 7, 10)


DECAY_SQL = f"w * exp(-0.01 * date_diff('day', CAST(last_ts AS DATE), DATE '{ORDERS_REF}'))"


@register("a7_decayed_popular", f"""WITH {q.INTER},
per AS (SELECT item_id, sum({q.m6(DECAY_SQL)}) AS score, count(*) AS users FROM inter GROUP BY item_id)
SELECT item_id, CAST(score AS BIGINT) AS score, users, rank FROM (
  SELECT *, CAST(row_number() OVER (ORDER BY score DESC, item_id) AS BIGINT) AS rank FROM per) WHERE rank <= 20""")
def a7_decayed_popular(spark, sf_dir):
    return pop.decayed_popular(src.interactions(spark, sf_dir), ORDERS_REF, 0.01, 20)


@register("a8_approx_users")
def a8_approx_users(spark, sf_dir):
    return pop.approx_stats(src.load(spark, sf_dir, "events"))


@register("a8_heavy_hitters")
def a8_heavy_hitters(spark, sf_dir):
    return pop.heavy_hitters(src.load(spark, sf_dir, "events"), 10)


@register("a8_merged_sketches", """SELECT count(*) AS events, count(DISTINCT user_id) AS users, TRUE AS within,
  (SELECT count(*) FROM (SELECT CAST(json_extract_string(props, '$.k') AS BIGINT) FROM events GROUP BY 1)) AS items, TRUE AS top_within
FROM events""")
def a8_merged_sketches(spark, sf_dir):
    """Exact counts over all days, and whether the days' merged sketches are within 3 % of the users and,
    for every item that they list, within 1 % of the events."""
    events = src.load(spark, sf_dir, "events")
    item = F.get_json_object("props", "$.k").cast("bigint")
    days = pop.daily_sketches(events).checkpoint(eager=True)
    exact = events.agg(F.count(F.lit(1)).alias("events"), F.count_distinct("user_id").alias("users"))
    per_item = events.groupBy(item.alias("item_id")).agg(F.count(F.lit(1)).alias("n"))
    gap = (pop.merged_top(days, 100).join(per_item, "item_id", "left")
           .agg(F.max(F.abs(F.col("approx_count") - F.coalesce("n", F.lit(0))))).scalar())
    approx = pop.merged_stats(days).select(F.col("events").alias("n"), "approx_users")
    both = exact.join(approx, F.col("events") == F.col("n"))
    return both.select("events", "users", (F.abs(F.col("approx_users") - F.col("users")) <= F.lit(0.03) * F.col("users")).alias("within"),
                       per_item.agg(F.count(F.lit(1))).scalar().alias("items"), (gap <= F.lit(0.01) * F.col("events")).alias("top_within"))


@register("p1_min_support", f"""WITH {q.INTER},
u1 AS (SELECT * FROM inter WHERE user_id IN (SELECT user_id FROM inter GROUP BY 1 HAVING count(*) >= 30)),
i1 AS (SELECT * FROM u1 WHERE item_id IN (SELECT item_id FROM u1 GROUP BY 1 HAVING count(*) >= 20)),
u2 AS (SELECT * FROM i1 WHERE user_id IN (SELECT user_id FROM i1 GROUP BY 1 HAVING count(*) >= 30)),
i2 AS (SELECT * FROM u2 WHERE item_id IN (SELECT item_id FROM u2 GROUP BY 1 HAVING count(*) >= 20))
SELECT * FROM i2""")
def p1_min_support(spark, sf_dir):
    return prep.min_support(src.interactions(spark, sf_dir), ku=30, ki=20, rounds=2)


SPLIT_LAST_SQL = q.SPLIT_LAST
@register("p2_split_last", f"WITH {q.RATINGS}, {SPLIT_LAST_SQL} SELECT * FROM marked")
def p2_split_last(spark, sf_dir):
    return prep.mark_last(src.ratings(spark, sf_dir))


@register("p3_split_time", f"""WITH {q.RATINGS}
SELECT *, CASE WHEN ts < TIMESTAMP '2024-01-21' THEN 'train' ELSE 'test' END AS split FROM ratings""")
def p3_split_time(spark, sf_dir):
    r = src.ratings(spark, sf_dir)
    train, test = prep.split_time(r, "2024-01-21")
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


@register("p4_split_hash", f"""WITH {q.INTER}
SELECT *, CASE WHEN ((user_id * 31 + item_id * 17) % 10 + 10) % 10 < 8 THEN 'train' ELSE 'test' END AS split
FROM inter""")
def p4_split_hash(spark, sf_dir):
    i = src.interactions(spark, sf_dir)
    train, test = prep.split_hash(i, 8)
    return (train.withColumn("split", F.lit("train"))
            .unionByName(test.withColumn("split", F.lit("test"))))


@register("p5_decay", f"WITH {q.INTER} SELECT user_id, item_id, {q.r6(DECAY_SQL)} AS dw FROM inter")
def p5_decay(spark, sf_dir):
    from pickwise.functions.scores import r6
    d = prep.decay(src.interactions(spark, sf_dir), ORDERS_REF, 0.01)
    return d.select("user_id", "item_id", r6("dw").alias("dw"))

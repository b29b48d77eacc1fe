"""Model, graph and vector queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from pickwise.functions.scores import m6
from pickwise.operators import collaborative as cf
from pickwise.operators import models as md
from pickwise.operators import prep
from pickwise.operators import vectors as vs
from pickwise.operators.skew import roomy
from pickwise.plans import sqlparts as q
from pickwise.plans.registry import register
from pickwise.sources import tables as src


@register("c10_als_rmse")
def c10_als_rmse(spark, sf_dir):
    """Explicit ALS (rank 8) on the leave-last-out train split; RMSE on test."""
    from pickwise.operators.evaluate import rating_error
    train, test = prep.split_last(src.ratings(spark, sf_dir))
    model = md.als(train, rank=8, reg=0.1, iters=10)
    return rating_error(md.als_predict(model, test), test)


@register("c10_als_recs")
def c10_als_recs(spark, sf_dir):
    r = src.ratings(spark, sf_dir)
    return md.als_recommend(md.als(r, rank=8, reg=0.1, iters=10), r, 10)


@register("c11_als_implicit_recs")
def c11_als_implicit_recs(spark, sf_dir):
    # the fit, the histories and what is excluded read them: joined and added up once
    inter = src.interactions(spark, sf_dir).select("user_id", "item_id", "w").checkpoint(eager=True)
    model = md.als(inter, rating_col="w", implicit=True, rank=10, reg=0.1, iters=10, alpha=1.0)
    return md.als_recommend(model, inter, 10, "als_implicit")


@register("c12_als_similar")
def c12_als_similar(spark, sf_dir):
    inter = src.interactions(spark, sf_dir)
    model = md.als(inter, rating_col="w", implicit=True, rank=10, reg=0.1, iters=10)
    return md.als_similar(model, 10)


@register("c13_pair_rules", """WITH b AS (SELECT DISTINCT l_orderkey AS basket, l_partkey AS item_id FROM lineitem),
nn AS (SELECT count(DISTINCT basket) AS n FROM b),
c AS (SELECT item_id, count(*) AS c FROM b GROUP BY 1),
p AS (SELECT x.item_id AS a, y.item_id AS b, count(*) AS n FROM b x JOIN b y
      ON x.basket = y.basket AND x.item_id < y.item_id GROUP BY 1, 2 HAVING count(*) >= 2),
d AS (SELECT a AS ante, b AS cons, n FROM p UNION ALL SELECT b, a, n FROM p)
SELECT ante, cons, n, """ + q.r6("n / (SELECT n FROM nn)") + """ AS support,
       """ + q.r6("n / ca.c") + """ AS confidence,
       """ + q.r6("n * (SELECT n FROM nn) / (ca.c * cb.c)") + """ AS lift
FROM d JOIN c ca ON ca.item_id = ante JOIN c cb ON cb.item_id = cons""")
def c13_pair_rules(spark, sf_dir):
    return cf.pair_rules(roomy(src.load(spark, sf_dir, "lineitem")), 2)


@register("c14_frequent_sets", """WITH b AS (SELECT DISTINCT l_orderkey AS o, l_partkey AS i FROM lineitem),
least AS (SELECT ceil(0.0001::DOUBLE * count(DISTINCT o)) AS m FROM b),
one AS (SELECT [i] AS items, count(*) AS n FROM b GROUP BY i),
two AS (SELECT [x.i, y.i] AS items, count(*) AS n FROM b x JOIN b y ON x.o = y.o AND x.i < y.i GROUP BY x.i, y.i),
three AS (SELECT [x.i, y.i, z.i] AS items, count(*) AS n FROM b x JOIN b y ON x.o = y.o AND x.i < y.i
          JOIN b z ON z.o = x.o AND y.i < z.i GROUP BY x.i, y.i, z.i),
every AS (SELECT * FROM one UNION ALL SELECT * FROM two UNION ALL SELECT * FROM three)
SELECT items, n, len(items) AS size FROM every WHERE n >= (SELECT m FROM least)""")
def c14_frequent_sets(spark, sf_dir):
    """Sets of up to three parts in at least one order in 10,000."""
    sets, _ = md.frequent_sets(src.load(spark, sf_dir, "lineitem"), min_support=0.0001, max_size=3)
    return sets


WALK_STEP = """m{t} AS (SELECT k, id, sum(m) AS m FROM (
  SELECT e.dk AS k, e.did AS id, 0.85::DOUBLE * m{p}.m / deg.d AS m
  FROM m{p} JOIN edges e ON e.k = m{p}.k AND e.id = m{p}.id JOIN deg ON deg.k = m{p}.k AND deg.id = m{p}.id
  UNION ALL SELECT k, id, 0.15::DOUBLE * m FROM m0) GROUP BY 1, 2)"""


@register("c15_graph_walk", f"""WITH {q.INTER},
edges AS (SELECT 'u' AS k, user_id AS id, 'i' AS dk, item_id AS did FROM inter
          UNION ALL SELECT 'i', item_id, 'u', user_id FROM inter),
deg AS (SELECT k, id, count(*) AS d FROM edges GROUP BY 1, 2),
m0 AS (SELECT 'u' AS k, user_id AS id, CAST(1 AS DOUBLE) / (SELECT count(DISTINCT user_id) FROM inter) AS m
       FROM (SELECT DISTINCT user_id FROM inter)),
{WALK_STEP.format(t=1, p=0)}, {WALK_STEP.format(t=2, p=1)}, {WALK_STEP.format(t=3, p=2)}
SELECT id AS item_id, {q.m6('m * 1e6')} AS score FROM m3 WHERE k = 'i'""")
def c15_graph_walk(spark, sf_dir):
    walk = cf.graph_walk(src.interactions(spark, sf_dir), steps=3)
    return walk.where(F.col("kind") == "i").select(F.col("node").alias("item_id"),
                                                   m6(F.col("mass") * F.lit(1e6)).alias("score"))


PUSH_STEP = """s{t} AS (SELECT seed, k, id, sum(m) AS m, sum(r) AS r FROM (
  SELECT s.seed, s.k, s.id, CASE WHEN r >= 0.001 * d THEN m + 0.15::DOUBLE * r ELSE m END AS m,
         CASE WHEN r >= 0.001 * d THEN 0.0 ELSE r END AS r FROM s{p} s JOIN deg ON deg.k = s.k AND deg.id = s.id
  UNION ALL SELECT s.seed, e.dk, e.did, 0.0, 0.85::DOUBLE * s.r / d FROM s{p} s
  JOIN deg ON deg.k = s.k AND deg.id = s.id JOIN edges e ON e.k = s.k AND e.id = s.id WHERE r >= 0.001 * d) GROUP BY 1, 2, 3)"""


@register("c15_seed_walks", f"""WITH {q.INTER},
edges AS (SELECT 'u' AS k, user_id AS id, 'i' AS dk, item_id AS did FROM inter
          UNION ALL SELECT 'i', item_id, 'u', user_id FROM inter),
deg AS (SELECT k, id, count(*) AS d FROM edges GROUP BY 1, 2),
s0 AS (SELECT user_id AS seed, 'u' AS k, user_id AS id, 0.0::DOUBLE AS m, 1.0::DOUBLE AS r
       FROM (SELECT DISTINCT user_id FROM inter ORDER BY user_id LIMIT 10)),
{PUSH_STEP.format(t=1, p=0)}, {PUSH_STEP.format(t=2, p=1)}, {PUSH_STEP.format(t=3, p=2)}, {PUSH_STEP.format(t=4, p=3)}
SELECT seed, k AS kind, id AS node, {q.m6('m')} AS score, {q.m6('r')} AS open FROM s4""")
def c15_seed_walks(spark, sf_dir):
    """Four rounds of pushing from each of the ten users with the smallest ids."""
    inter = src.interactions(spark, sf_dir)
    seeds = inter.select("user_id").distinct().orderBy("user_id").limit(10)
    return cf.graph_push(inter, seeds, rounds=4, eps=1e-3).select(
        "seed", "kind", "node", m6("mass").alias("score"), m6("residual").alias("open"))


@register("c16_ranker")
def c16_ranker(spark, sf_dir):
    _, scored = md.fit_ranker(src.load(spark, sf_dir, "events"))
    return scored


EXACT_NEAREST = f"""WITH v AS (SELECT vec_id AS id, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
n AS (SELECT id, v, sqrt(list_dot_product(v, v)) AS nrm FROM v),
sc AS (SELECT a.id, b.id AS other, {q.m6('list_dot_product(a.v, b.v) / (a.nrm * b.nrm)')} AS score
       FROM n a JOIN n b ON a.id <> b.id)
SELECT * FROM (SELECT *, CAST(row_number() OVER (PARTITION BY id ORDER BY score DESC, other) AS BIGINT) AS rank
               FROM sc) WHERE rank <= 5"""


@register("t8_nearest", EXACT_NEAREST)
def t8_nearest(spark, sf_dir):
    return vs.nearest(src.load(spark, sf_dir, "embeddings"), 5)


@register("t9_nearest_lsh")
def t9_nearest_lsh(spark, sf_dir):
    """T9's approximate neighbours, by the inverted file (the name is that of its former method)."""
    return vs.nearest_ivf(src.load(spark, sf_dir, "embeddings"), 5)


def recall_ok(found, exact, least: float):
    """``exact`` with the column recall_ok: whether ``found`` has at least ``least`` of its (id, other)."""
    both = exact.select("id", "other").intersect(found.select("id", "other")).agg(F.count(F.lit(1))).scalar()
    every = exact.agg(F.count(F.lit(1))).scalar()
    return exact.withColumn("recall_ok", both >= every * F.lit(least))


@register("t9_ivf_recall", f"SELECT *, TRUE AS recall_ok FROM ({EXACT_NEAREST})")
def t9_ivf_recall(spark, sf_dir):
    """The exact neighbours, and whether T9 finds 0.9 of them."""
    emb = src.load(spark, sf_dir, "embeddings")
    return recall_ok(vs.nearest_ivf(emb, 5).checkpoint(eager=True), vs.nearest(emb, 5).checkpoint(eager=True), 0.9)


@register("c12_als_recall", "SELECT TRUE AS recall_ok")
def c12_als_recall(spark, sf_dir):
    """Whether the approximate neighbours of the ALS item factors hold 0.9 of the exact ones."""
    inter = src.interactions(spark, sf_dir)
    f = md.als(inter, rating_col="w", implicit=True, rank=10, reg=0.1, iters=10).item_factors
    exact = vs.nearest(f, 10, "item_id", "v").checkpoint(eager=True)
    return recall_ok(vs.nearest_ivf(f, 10, "item_id", "v").checkpoint(eager=True), exact, 0.9).select("recall_ok").distinct()


@register("t10_topics")
def t10_topics(spark, sf_dir):
    return md.topics(src.articles(spark, sf_dir), k=10, iters=10).drop("mix")


@register("t11_item_vectors")
def t11_item_vectors(spark, sf_dir):
    return md.item_vectors(src.load(spark, sf_dir, "events"))

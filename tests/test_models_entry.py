import datetime as dt
import math
import random

from pyspark.sql import functions as F

from conftest import SF001
from fixtures import planted_rank2
from pickwise.operators import models as md
from pickwise.operators import prep


def test_als_beats_global_mean(spark):
    r = planted_rank2(spark)
    train, test = prep.split_hash(r, 8)
    model = md.als(train, rank=2, reg=0.01, iters=15)
    from pickwise.operators.evaluate import rating_error
    err = rating_error(md.als_predict(model, test), test).first()
    mu = train.agg(F.avg("rating")).first()[0]
    base = math.sqrt(test.agg(F.avg((F.col("rating") - F.lit(mu)) ** 2)).first()[0])
    assert err.n > 0 and err.rmse < 0.5 * base


def test_als_takes_any_ids(spark):
    """Ids beyond the int range are numbered; the model is that of their numbers."""
    r = planted_rank2(spark)
    big = r.select((F.col("user_id") * 10**12 - 5 * 10**12).alias("user_id"), (F.col("item_id") + 2**40).alias("item_id"), "rating")
    model = md.als(big, rank=2, reg=0.01, iters=10)
    users, items = ({x[0] for x in big.select(c).distinct().collect()} for c in ("user_id", "item_id"))
    recs = md.als_recommend(model, big, n=3).collect()
    assert recs and {x.user_id for x in recs} <= users and {x.item_id for x in recs} <= items
    pred = {(x.user_id, x.item_id): x.pred for x in md.als_predict(model, big).collect()}
    err = [abs(pred[x.user_id, x.item_id] - x.rating) for x in big.collect()]
    assert len(pred) == big.count() and sum(err) / len(err) < 0.5
    assert {x.id for x in md.als_similar(model, 2).collect()} <= items


def test_als_lists_are_those_of_spark(spark, monkeypatch):
    """The lists of recommendForUserSubset without what was seen, in few and in many blocks of items."""
    from pickwise.operators import serving
    r = planted_rank2(spark)
    train, _ = prep.split_hash(r, 3)
    factors = md.als(train, rank=4, reg=0.05, iters=5)
    n_items = factors.item_factors.count()
    seen = {(x.user_id, x.item_id) for x in train.collect()}
    want = {}
    for x in factors.model.recommendForUserSubset(factors.model.userFactors.select(F.col("id").alias("user")), n_items).collect():
        want[x.user] = [(i, s) for i, s in x.recommendations if (x.user, i) not in seen][:5]
    for block in (4096, 7):
        monkeypatch.setattr(serving, "ITEMS", block)
        got = {}
        for x in md.als_recommend(factors, train, n=5).orderBy("user_id", "rank").collect():
            got.setdefault(x.user_id, []).append((x.item_id, x.score / 1e6))
        assert got.keys() == {u for u, l in want.items() if l}
        for u, l in got.items():
            assert len(l) == len(want[u])
            assert all(abs(a[1] - b[1]) < 1e-5 for a, b in zip(l, want[u]))
            assert [a for a, _ in l] == [b for b, _ in want[u]] or len({round(s, 5) for _, s in want[u]}) < len(want[u])


def test_serving_stops_at_the_norm_bound():
    """Blocks by falling norm: once a user's list is over the product of norms, no more is multiplied."""
    import numpy as np
    from pickwise.operators.serving import Users
    rnd = np.random.default_rng(2)
    items = rnd.standard_normal((4000, 6)) * np.exp(-np.arange(4000) / 300)[:, None]
    items = items[np.argsort(-np.linalg.norm(items, axis=1))]
    users = Users(np.arange(50), np.full(50, 10), rnd.standard_normal((50, 6)))
    for lo in range(0, 4000, 100):
        users.meet(np.arange(lo, lo + 100), items[lo:lo + 100], float(np.linalg.norm(items[lo])))
    for u, (score, ids) in enumerate(users.best):
        assert ids.tolist() == np.argsort(-(items @ users.vectors[u]), kind="stable")[:10].tolist()
    assert users.products < 0.5 * 50 * 4000


def test_implicit_als_ranks_own_group_first(spark):
    """C11: two groups of users and items; a user's own group's unseen item comes first."""
    rows = [(u, i, 5.0) for u in range(20) for i in range(10) if u % 2 == i % 2 and (u, i) not in {(0, 4), (1, 5)}]
    df = spark.createDataFrame(rows, "user_id bigint, item_id bigint, rating double")
    model = md.als(df, implicit=True, rank=2, iters=10)
    top = {r.user_id: r.item_id for r in md.als_recommend(model, df, n=1).collect()}
    assert top[0] == 4 and top[1] == 5
    near = {}  # C12: an item's nearest are of its own group
    for r in md.als_similar(model, 4).collect():
        near.setdefault(r.id, []).append(r.other)
    assert near and all(o % 2 == i % 2 for i, os in near.items() for o in os[:2])


def _events(spark, rows):
    return spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, "
                                       "value double, props string")


def test_ranker_scores_only_later_events(spark):
    """Users who buy keep buying; the last fifth of time is scored, and well."""
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=i), i % 10, "purchase" if i % 10 < 4 else "view", 1.0, f'{{"k": {i % 7}}}')
            for i in range(1000)]
    _, scored = md.fit_ranker(_events(spark, rows))
    got = scored.collect()
    assert {r.event_id for r in got} == set(range(799, 1000)) or {r.event_id for r in got} == set(range(800, 1000))
    hit = [r.p_purchase for r in got if r.label == 1.0]
    miss = [r.p_purchase for r in got if r.label == 0.0]
    assert min(hit) > max(miss)


def test_topics_tell_two_vocabularies_apart(spark):
    """Texts of two vocabularies get two main topics; empty texts still get a row."""
    rows = [(i, " ".join(f"{'ab'[i % 2]}{j}" for j in range(20))) for i in range(400)] + [(999, ""), (998, None)]
    mix = md.topics(spark.createDataFrame(rows, "item_id long, text string"), k=2, iters=60, buckets=256)
    got = {r.item_id: r.topic for r in mix.collect()}
    assert len(got) == 402
    assert len({got[i] for i in range(0, 400, 2)}) == 1 and len({got[i] for i in range(1, 400, 2)}) == 1
    assert got[0] != got[1]


def test_item_vectors_cover_every_item(spark):
    """A vector for each item; items of one habit lie nearer than those of another."""
    start = dt.datetime(2024, 1, 1)
    pick = random.Random(0)
    rows = [(n, start + dt.timedelta(minutes=n), u, "view", 1.0, f'{{"k": {pick.randrange(5) + 5 * (u % 2)}}}')
            for n, u in enumerate(list(range(200)) * 150)]
    vecs = {r.item_id: r.vector for r in md.item_vectors(_events(spark, rows), dim=8, partitions=2).collect()}
    assert set(vecs) == set(range(10)) and all(len(v) == 8 for v in vecs.values())
    cos = lambda a, b: sum(x * y for x, y in zip(a, b)) / math.sqrt(sum(x * x for x in a) * sum(y * y for y in b))
    same = [cos(vecs[a], vecs[b]) for a in range(5) for b in range(5) if a < b]
    other = [cos(vecs[a], vecs[b]) for a in range(5) for b in range(5, 10)]
    assert sum(same) / len(same) > sum(other) / len(other)


def test_sketches_stay_within_their_error(spark):
    """Distinct users within three times the stated error; the heaviest items found."""
    from pickwise.operators import popularity as pop
    start = dt.datetime(2024, 1, 1)
    rows = [(n, start, n % 3000, "view", 1.0, f'{{"k": {0 if n % 3 else n % 200}}}') for n in range(12000)]
    ev = _events(spark, rows)
    users = pop.approx_stats(ev, rsd=0.02).collect()
    exact = {}
    for n, _, u, _, _, props in rows:
        exact.setdefault(props, set()).add(u)
    assert sum(r.events for r in users) == 12000
    got = {r[0]: r.approx_users for r in users}
    for props, us in exact.items():
        k = int(props.split()[1].rstrip("}"))
        assert abs(got[k] - len(us)) <= max(2, 0.06 * len(us))
    assert pop.heavy_hitters(ev, 3).filter("rank = 1").first().item_id == 0


def test_entry_and_queries_smoke(spark):
    import __spark_entry__ as E
    df = E.entry(spark)
    assert df.columns == ["user_id", "item_id", "score", "rank", "source"]
    assert df.count() > 0
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs) and len(qs) >= 60
    for name in ("s2_interactions", "c1_item_cosine", "q1_sessions"):
        assert qs[name](spark, SF001).count() > 0


def test_als_similar_recall_on_sf01_factors(spark):
    """C12 goes through T9: it finds 0.9 of T8's neighbours of the sf0.1 item factors."""
    import numpy as np
    from pickwise.sources import tables as src
    inter = src.interactions(spark, "/root/testdata/sf0.1")
    model = md.als(inter, rating_col="w", implicit=True, rank=10, reg=0.1, iters=10)
    rows = sorted((r.item_id, r.v) for r in model.item_factors.collect())
    m = np.array([v for _, v in rows], np.float64)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    ids = np.array([i for i, _ in rows])
    got = {}
    for r in md.als_similar(model, 10).collect():
        got.setdefault(r.id, set()).add(r.other)
    some = np.arange(0, len(ids), 20)
    cos = m[some] @ m.T
    cos[np.arange(len(some)), some] = -2.0
    near = ids[np.argsort(-np.floor(cos * 1e6 + 0.5), axis=1, kind="stable")[:, :10]]
    assert sum(len(got.get(int(ids[i]), set()) & set(n.tolist())) for i, n in zip(some, near)) >= 0.9 * near.size


def test_items_are_sent_to_few_blocks_of_users(spark):
    """80,000 users were 20 blocks; the items are sent once to each (F2)."""
    from pyspark.sql import functions as F
    from pickwise.operators.serving import best_products
    users = spark.range(80_000).select(F.col("id").alias("user_id"), F.array(F.lit(1.0).cast("float")).alias("v"), F.lit(1).alias("want"))
    items = spark.range(3).select(F.col("id").alias("item_id"), F.array(F.col("id").cast("float")).alias("v"))
    found = best_products(users, items)
    blocks = 2 * spark.sparkContext.defaultParallelism
    assert blocks < 20 and f", {4 * blocks}" in found._jdf.queryExecution().optimizedPlan().toString()
    assert found.agg(F.count(F.lit(1)), F.min("item_id")).first()[:] == (80_000, 2)

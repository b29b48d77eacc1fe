import math

from pyspark.sql import functions as F

from fixtures import tiny_inter
from pickwise.operators import collaborative as cf
from pickwise.operators import evaluate as ev
from pickwise.operators import popularity as pop
from pickwise.operators import rerank as rr
from pickwise.operators.ordering import global_rank

RECS = "user_id bigint, item_id bigint, score bigint, rank bigint, source string"


def recs_df(spark, rows):
    return spark.createDataFrame([(u, i, s, r, "x") for u, i, s, r in rows], RECS)


def test_global_rank_is_row_number(spark):
    df = spark.range(0, 5000).select((F.col("id") * 7919 % 5000).alias("k"), (F.col("id") % 13).alias("g"))
    got = global_rank(df.repartition(7), [F.col("g").asc(), F.col("k").asc()], "r").collect()
    want = sorted(((r.g, r.k) for r in df.collect()))
    assert sorted((r.r, r.g, r.k) for r in got) == [(i + 1, g, k) for i, (g, k) in enumerate(want)]


def test_rrf_by_hand(spark):
    a = recs_df(spark, [(1, 10, 5, 1), (1, 11, 4, 2)])
    b = recs_df(spark, [(1, 11, 9, 1), (1, 12, 8, 2)])
    got = [(r.item_id, r.score) for r in sorted(rr.merge_rrf([a, b], n=3).collect(), key=lambda r: r.rank)]
    m = lambda x: math.floor(x * 1e6 + 0.5)
    assert got == [(11, m(1 / 62) + m(1 / 61)), (10, m(1 / 61)), (12, m(1 / 62))]


def test_fill_popular_gives_every_user_n(spark):
    inter = tiny_inter(spark)
    recs = cf.recommend_items(inter, cf.item_cf(inter, k=20), n=10)
    users = spark.createDataFrame([(u,) for u in (1, 2, 3, 4, 9)], "user_id bigint")   # 9: no history
    ranked = global_rank(pop.item_users(inter), [F.col("users").desc(), F.col("item_id").asc()])
    out = rr.fill_popular(recs, users, inter, ranked, n=3).collect()
    plan = rr.fill_popular(recs, users, inter, ranked, n=3)._jdf.queryExecution().toString()
    assert "WindowGroupLimit" in plan  # a map task sends at most n rows of a user
    by = {}
    for r in out:
        by.setdefault(r.user_id, []).append(r)
    seen = {(r.user_id, r.item_id) for r in inter.collect()}
    for u, rows in by.items():
        ranks = sorted(r.rank for r in rows)
        assert ranks == list(range(1, len(rows) + 1))
        assert not [r for r in rows if (u, r.item_id) in seen]
    # user 9 gets the three most popular items: 2 (3 users), then 1 and 3 (2 users each)
    assert [r.item_id for r in sorted(by[9], key=lambda r: r.rank)] == [2, 1, 3]
    assert len(by[4]) == 3   # u4 has seen 5 only; no CF recs, so all popular
    # u1 has seen the three most popular items and is recommended 4: the fill
    # must reach past them to item 5, the only one left
    assert [(r.item_id, r.source) for r in sorted(by[1], key=lambda r: r.rank)] == [(4, "x"), (5, "popular")] \
        or [(r.item_id, r.source) for r in sorted(by[1], key=lambda r: r.rank)] == [(4, "item_cf"), (5, "popular")]


def test_cap_per_group(spark):
    recs = recs_df(spark, [(1, i, 100 - i, i) for i in range(1, 7)])
    items = spark.createDataFrame([(i, "b1" if i < 5 else "b2") for i in range(1, 7)], "item_id bigint, brand string")
    got = [r.item_id for r in sorted(rr.cap_per_group(recs, items, "brand", m=2, n=4).collect(), key=lambda r: r.rank)]
    assert got == [1, 2, 5, 6]


def test_mmr_lambda_one_is_top_n(spark):
    inter = tiny_inter(spark)
    nb = cf.item_cf(inter, k=20)
    cand = cf.recommend_items(inter, nb, n=10)
    a = sorted((r.user_id, r.item_id, r.rank) for r in rr.mmr(cand, nb, lam=1.0, n=2).collect())
    b = sorted((r.user_id, r.item_id, r.rank) for r in rr.top_n(cand, 2).collect())
    assert a == b


def test_rank_metrics_by_hand(spark):
    recs = recs_df(spark, [(1, 10, 9, 1), (1, 11, 8, 2), (1, 12, 7, 3), (2, 20, 9, 1), (2, 21, 8, 2)])
    test = spark.createDataFrame([(1, 12), (2, 99), (3, 30)], "user_id bigint, item_id bigint")
    m = ev.rank_metrics(recs, test, k=3).first()
    assert m.users == 3
    assert m.hit_rate == round(1 / 3, 6) and m.precision == round(1 / 9, 6)
    assert m.mrr == round(1 / 9, 6) and m.ndcg == round(0.5 / 3, 6)
    assert ev.map_at_k(recs, test, 3).first().map == round((1 / 3) / 3, 6)


def test_auc_ties_at_half(spark):
    scored = spark.createDataFrame([(1, 1, 5), (1, 2, 3), (1, 3, 3), (1, 4, 1)],
                                   "user_id bigint, item_id bigint, score bigint")
    test = spark.createDataFrame([(1, 2)], "user_id bigint, item_id bigint")
    r = ev.auc(scored, test).first()
    # positive 2 beats item 4, ties item 3, loses to item 1: (1 + 0.5) / 3
    assert (r.n_pos, r.n_neg, r.auc) == (1, 3, 0.5)


def test_gini_and_coverage(spark):
    items = spark.createDataFrame([(i,) for i in range(1, 5)], "item_id bigint")
    recs = recs_df(spark, [(1, 1, 1, 1), (2, 1, 1, 1), (3, 1, 1, 1), (3, 2, 1, 2)])
    g = ev.gini(recs, items).first()
    # x ascending = 0, 0, 1, 3 -> sum (2i-n-1) x = 1*1 + 3*3 = 10 -> 10 / (4*4)
    assert g.gini == round(10 / 16, 6)
    c = ev.coverage(recs, items).first()
    assert (c.recommended, c.catalog, c.coverage) == (2, 4, 0.5)


def test_diversity_uses_missing_pairs_as_zero(spark):
    recs = recs_df(spark, [(1, 1, 9, 1), (1, 2, 8, 2), (1, 3, 7, 3)])
    nb = spark.createDataFrame([(1, 2, 1, 600000), (2, 1, 1, 600000)], "id bigint, other bigint, support bigint, score bigint")
    d = ev.diversity(recs, nb).first()
    assert d.diversity == round(1 - 1.2 / 6, 6)


def test_merged_sketches_are_the_whole(spark):
    """The days' sketches together say what one over all events would, within the bounds, and
    days may be merged in any grouping."""
    import datetime as dt

    from pickwise.operators import popularity as pop
    start = dt.datetime(2024, 1, 1)
    rows = [(i, start + dt.timedelta(minutes=7 * i), i % 1700, "view", 1.0, f'{{"k": {min(i % 97, i % 13)}}}') for i in range(6000)]
    events = spark.createDataFrame(rows, "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, props string")
    days = pop.daily_sketches(events).checkpoint()
    assert days.count() == len({(start + dt.timedelta(minutes=7 * i)).date() for i in range(6000)})
    whole = pop.merged_stats(days).first()
    assert whole.events == 6000 and abs(whole.approx_users - 1700) <= 0.03 * 1700
    part = pop.merged_stats(days.where("day < '2024-01-10'")).first()
    assert part.events == sum(1 for r in rows if r[1] < dt.datetime(2024, 1, 10))
    true = {}
    for r in rows:
        k = int(r[5][6:-1])
        true[k] = true.get(k, 0) + 1
    top = [(r.item_id, r.approx_count) for r in pop.merged_top(days, 10).orderBy("rank").collect()]
    assert len(top) == 10 and all(abs(n - true[k]) <= 60 for k, n in top)
    assert [n for _, n in top] == sorted((n for _, n in top), reverse=True)
    assert {k for k, _ in top[:3]} <= {k for k, _ in sorted(true.items(), key=lambda x: -x[1])[:6]}

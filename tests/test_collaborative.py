import math
import random

import pytest
from pyspark.sql import functions as F

from fixtures import tiny_inter, tiny_ratings
from pickwise.operators import collaborative as cf
from pickwise.operators import prep


def m6(x):
    return math.floor(x * 1e6 + 0.5)


def test_item_cosine_by_hand(spark):
    nb = {(r.id, r.other): (r.support, r.score, r.rank)
          for r in cf.item_cf(tiny_inter(spark), k=10).collect()}
    assert nb[(1, 2)] == (2, m6(2 / math.sqrt(6)), 1)
    assert nb[(1, 3)][:2] == (1, 500000)
    assert nb[(3, 4)][:2] == (1, m6(1 / math.sqrt(2)))
    # item 2: items 1 and 3 tie at 2/sqrt(6); the smaller id ranks first
    assert nb[(2, 1)][2] == 1 and nb[(2, 3)][2] == 2 and nb[(2, 4)] == (1, m6(1 / math.sqrt(3)), 3)
    assert not any(5 in k for k in nb)           # item 5 shares no user
    assert all(nb[(b, a)][:2] == v[:2] for (a, b), v in nb.items())   # symmetric


def test_item_cosine_salted_equals_plain(spark):
    inter = tiny_inter(spark)
    a = sorted(tuple(r) for r in cf.item_cf(inter, k=3, chunk=1).collect())
    b = sorted(tuple(r) for r in cf.item_cf(inter, k=3).collect())
    assert a == b


def test_iuf_weights(spark):
    nb = {(r.id, r.other): r.score for r in cf.item_cf(tiny_inter(spark), k=10, iuf=True).collect()}
    # items 1,2 share u1 (3 items) and u2 (2 items)
    assert nb[(1, 2)] == m6((1 / math.log(4) + 1 / math.log(3)) / math.sqrt(6))


def test_recommend_items_by_hand(spark):
    inter = tiny_inter(spark)
    recs = cf.recommend_items(inter, cf.item_cf(inter, k=20), n=10).collect()
    u2 = [(r.item_id, r.score, r.rank) for r in sorted(recs, key=lambda r: r.rank) if r.user_id == 2]
    assert u2 == [(3, 500000 + m6(2 / math.sqrt(6)), 1), (4, m6(1 / math.sqrt(3)), 2)]
    assert not [r for r in recs if r.user_id == 4]
    seen = {(r.user_id, r.item_id) for r in inter.collect()}
    assert not [r for r in recs if (r.user_id, r.item_id) in seen]


def test_user_cosine_and_jaccard(spark):
    d = {(r.id, r.other): (r.score, r.alt) for r in cf.user_cf(tiny_inter(spark), k=10).collect()}
    assert d[(1, 2)] == (m6(2 / math.sqrt(6)), m6(2 / 3))
    assert d[(1, 3)] == (m6(2 / 3), 500000)
    assert d[(2, 3)] == (m6(1 / math.sqrt(6)), 250000)


def test_pearson_drops_flat_raters(spark):
    rows = cf.user_pearson(tiny_ratings(spark), min_overlap=3).collect()
    assert [(r.id, r.other, r.support, r.score) for r in rows] == [(1, 2, 3, 1000000)]


def test_slope_one_by_hand(spark):
    r = tiny_ratings(spark)
    dev = {(x.i, x.j): (x.n, x.d) for x in cf.slope_one_devs(r).collect()}
    assert dev[(1, 2)] == (3, 4) and dev[(2, 1)] == (3, -4)
    pred = {(x.user_id, x.item_id): x.pred for x in cf.slope_one(r).collect()}
    assert pred[(5, 2)] == round(8 / 3, 6) and pred[(5, 3)] == round(10 / 3, 6)
    assert (4, 1) not in pred                 # no co-rater links item 4 to the others


def test_bias_baseline_by_hand(spark):
    r = tiny_ratings(spark)
    ys = [5, 3, 4, 4, 2, 3, 3, 3, 3, 2, 4]
    mu = sum(ys) / len(ys)
    _, bi, bu = cf.bias_baseline(r, 10.0)
    b = {x.item_id: x.b_i for x in bi.collect()}
    assert abs(b[1] - ((5 + 4 + 3 + 4) - 4 * mu) / 14) < 1e-12
    u = {x.user_id: x.b_u for x in bu.collect()}
    assert abs(u[4] - (2 - mu - b[4]) / 11) < 1e-12


def test_user_cf_prediction_uses_positive_neighbors(spark):
    r = tiny_ratings(spark)
    pred = cf.predict_user_cf(r, cf.user_pearson(r, min_overlap=3)).collect()
    assert pred == []  # u1 and u2 rated the same items: nothing unseen to predict


def test_split_last_single_rating_stays_in_train(spark):
    train, test = prep.split_last(tiny_ratings(spark))
    t = {(x.user_id, x.item_id) for x in test.collect()}
    assert t == {(1, 3), (2, 3), (3, 3)}
    assert train.count() + test.count() == 11


def test_pair_rules_and_fpgrowth_agree(spark):
    from pickwise.operators.models import frequent_sets
    li = spark.createDataFrame([(o, p) for o, ps in {1: [1, 2, 3], 2: [1, 2], 3: [2, 3], 4: [1, 2, 3]}.items()
                                for p in ps], "l_orderkey bigint, l_partkey bigint")
    rules = {(x.ante, x.cons): (x.n, x.confidence, x.lift) for x in cf.pair_rules(li, 2).collect()}
    assert rules[(1, 2)] == (3, 1.0, 1.0) and rules[(3, 2)] == (3, 1.0, 1.0)
    assert rules[(1, 3)] == (2, round(2 / 3, 6), round(2 * 4 / 9, 6))
    sets, _ = frequent_sets(li, min_support=0.5)  # two of four orders
    two = {tuple(x["items"]): x.n for x in sets.where(F.col("size") == 2).collect()}
    assert two == {(a, b): n for (a, b), (n, _, _) in rules.items() if a < b}


def test_graph_walk_conserves_mass(spark):
    walk = cf.graph_walk(tiny_inter(spark), steps=7, checkpoint_every=3)
    total = walk.agg(F.sum("mass")).first()[0]
    assert abs(total - 1.0) < 1e-12


@pytest.mark.parametrize("users, entries, most", [(2000, 1 << 20, 1 << 20), (3, 1 << 20, 1 << 20), (2000, 17, 7)])
def test_user_cf_by_blocks(spark, users, entries, most):
    """Ratings that come twice or lack item, user or value; users without neighbors; blocks of a few users."""
    rnd = random.Random(11)
    data = [(u, i, rnd.randint(1, 5)) for u in range(14) for i in range(12) if rnd.random() < 0.6]
    data += data[:5] + [(3, None, 2), (None, 4, 5), (5, 11, None), (99, 1, 3)]
    pearson = [(u, v, rnd.randint(-500_000, 1_000_000)) for u in range(14) for v in range(u + 1, 14) if rnd.random() < 0.7]
    pearson += [(0, 77, 900_000), (None, 2, 500_000)]
    ratings = spark.createDataFrame(data, "user_id bigint, item_id bigint, rating int")
    found = cf.predict_user_cf(ratings, spark.createDataFrame(pearson, "id bigint, other bigint, score bigint"),
                               users=users, entries=entries, most=most)
    assert "FlatMapCoGroupsInArrow" in found._jdf.queryExecution().toString()  # no row to a neighbor's rating
    mean, sums = {}, {}
    for u in {u for u, _, _ in data}:
        own = [y for w, _, y in data if w == u]
        mean[u] = sum(y or 0 for y in own) / len(own)
    for u, v, c in [p for a, b, c in pearson if c > 0 for p in ((a, b, c), (b, a, c))]:
        for w, i, y in data:
            if w == v and w is not None and u in mean and u is not None:
                num, den = sums.get((u, i), (0.0, 0))
                sums[u, i] = num + (0.0 if y is None else c * (y - mean[v])), den + c
    seen = {(u, i) for u, i, _ in data if i is not None}
    expected = {key: mean[key[0]] + num / den for key, (num, den) in sums.items() if key not in seen}
    got = {(r.user_id, r.item_id): r.pred for r in found.collect()}
    assert got.keys() == expected.keys() and len(got) > 40
    assert all(abs(got[key] - expected[key]) < 2e-6 for key in got)


@pytest.mark.parametrize("k", [None, 2])
def test_user_pairs_go_packed(spark, monkeypatch, k):
    """A pair is sent in a packed tile, once for both users, with the same sums as a row to a pair."""
    monkeypatch.setattr(cf, "PAIRS_HELD", 5)
    rnd = random.Random(4)
    data = [(u * (1 << 33), i, rnd.randint(1, 5)) for u in range(9) for i in range(8) if rnd.random() < 0.5]
    pearson = [(u << 33, v << 33, rnd.randint(1, 1_000_000)) for u in range(9) for v in range(u + 1, 9) if rnd.random() < 0.8]
    ratings = spark.createDataFrame(data, "user_id bigint, item_id bigint, rating int")
    found = cf.predict_user_cf(ratings, spark.createDataFrame(pearson, "id bigint, other bigint, score bigint").coalesce(1), k, users=2)
    assert "users#" in found._jdf.queryExecution().executedPlan().toString()
    near = {u << 33: sorted((-c, b) for x, y, c in pearson for a, b in ((x, y), (y, x)) if a == u << 33)[:k] for u in range(9)}
    mean = {u: sum(y for w, _, y in data if w == u) / max(1, sum(w == u for w, _, _ in data)) for u in near}
    want = {}
    for u in {w for w, _, _ in data}:
        for i in set(range(8)) - {i for w, i, _ in data if w == u}:
            some = [(-c, y - mean[v]) for c, v in near[u] for w, j, y in data if (w, j) == (v, i)]
            if some:
                want[u, i] = mean[u] + sum(c * d for c, d in some) / sum(c for c, _ in some)
    got = {(r.user_id, r.item_id): r.pred for r in found.collect()}
    assert got.keys() == want.keys() and len(got) > 10 and all(abs(got[x] - want[x]) < 2e-6 for x in got)


def test_ratings_added_as_matrices_or_one_by_one(monkeypatch):
    import numpy as np
    rnd = np.random.default_rng(2)
    other, item = (x.ravel() for x in np.meshgrid(np.arange(40) * 3, np.arange(9)))
    keep = rnd.random(360) < 0.7
    other, item, dev = other[keep], item[keep], rnd.normal(size=keep.sum())
    user, v, c = rnd.integers(0, 600, 900), rnd.integers(-5, 130, 900), rnd.integers(1, 10**6, 900)
    found = []
    for dense in (16, 10**6, 0):
        monkeypatch.setattr(cf, "DENSE", dense)
        out = [np.concatenate(x) for x in zip(*cf._added(user, v, c, other, item, dev))]
        found.append({(u, i): (round(n, 4), d) for u, i, n, d in zip(*(x.tolist() for x in out))})
    assert len(found[0]) > 500 and found[0].keys() == found[1].keys() == found[2].keys()
    assert all(abs(f[x][0] - found[2][x][0]) < 1e-3 and f[x][1] == found[2][x][1] for f in found[:2] for x in f)

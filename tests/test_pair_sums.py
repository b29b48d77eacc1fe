"""C5 and C8 in packed blocks, C14 by levels, C15 per seed, against brute force."""

import random
from collections import defaultdict
from itertools import combinations

import pytest

from pyspark.sql import functions as F

from pickwise.operators import collaborative as cf
from pickwise.operators import models as md
from pickwise.operators import pair_sums as ps
from pickwise.operators import related as rl


def ratings(seed=1, users=40, items=30):
    rnd = random.Random(seed)
    rows = {(u, i): rnd.randint(1, 5) for u in range(users) for i in rnd.sample(range(items), rnd.randint(1, 14))}
    rows |= {(u, 999): 3 for u in range(users)}          # an item that everyone has
    return rows | {(777, i): 1 + i % 5 for i in range(items)}  # a user who has every item


def brute(rows, least):
    by = defaultdict(dict)
    for (u, i), y in rows.items():
        by[u][i] = y
    out = set()
    for a, b in combinations(sorted(by), 2):
        both = sorted(by[a].keys() & by[b].keys())
        x, y = [by[a][i] for i in both], [by[b][i] for i in both]
        if len(both) >= least:
            out.add((a, b, len(both), sum(x), sum(y), sum(v * v for v in x), sum(v * v for v in y), sum(p * q for p, q in zip(x, y))))
    return out


@pytest.mark.parametrize("least", [1, 2, 5, 9])
@pytest.mark.parametrize("entries, most", [(1 << 20, 1 << 20), (60, 1 << 20), (60, 12)])
def test_sums_of_every_pair(spark, monkeypatch, least, entries, most):
    monkeypatch.setattr(rl, "BLOCK_ENTRIES", entries)
    rows = ratings()
    df = spark.createDataFrame([(u, i, y) for (u, i), y in rows.items()] + [(None, 1, 1), (1, None, 1), (2, 500, None)],
                               "user_id long, item_id long, rating int")
    got = {tuple(int(v) for v in r) for r in ps.pair_sums(df, "user_id", "item_id", F.col("rating"), least, most).collect()}
    assert got == brute(rows, least)
    assert ps.pair_sums(df.limit(0), "user_id", "item_id").collect() == []


def test_common_items_make_no_pairs():
    """With five shared items asked for, the items that everyone has are not read for pairs."""
    import numpy as np
    n, own = 400, 6
    terms = np.concatenate([np.r_[0, 1, 2, 3, 10 + (i // 4) * own + np.arange(own)] for i in range(n)])
    block = rl.Block.of(np.arange(n), np.full(n, own + 4), terms, np.ones(len(terms)))
    visited, found = {}, {}
    for least in (1, 5):
        pairs = ps.Pairs(block, least)
        out = pairs.meet(block, True)
        visited[least], found[least] = pairs.visited, len(out[0])
    assert found == {1: n * (n - 1) // 2, 5: n // 4 * 6}
    assert visited[5] < 0.1 * visited[1]


def test_frequent_sets_against_all_sets(spark):
    rnd = random.Random(3)
    baskets = {o: set(rnd.sample(range(12), rnd.randint(1, 6))) for o in range(-70, 90)}
    rows = [(o, i) for o, b in baskets.items() for i in b for _ in range(rnd.randint(1, 2))] + [(None, 1), (500, None)]
    df = spark.createDataFrame(rows, "l_orderkey long, l_partkey long")
    for max_size, chunk in ((3, 4096), (None, 1)):
        sets, rules = md.frequent_sets(df, 0.05, max_size, min_confidence=0.3, chunk=chunk)
        want = {}
        for k in range(1, 7 if max_size is None else max_size + 1):
            for c in combinations(range(12), k):
                n = sum(b >= set(c) for b in baskets.values())
                if n >= 0.05 * len(baskets):
                    want[c] = n
        assert {tuple(r["items"]): r["n"] for r in sets.collect()} == want
        assert all(r["size"] == len(r["items"]) for r in sets.collect())
        got = {(tuple(r.antecedent), r.consequent[0]): (r.confidence, r.lift, r.support) for r in rules.collect()}
        conf = {(tuple(x for x in s if x != c), c): n / want[tuple(x for x in s if x != c)] for s, n in want.items() if len(s) > 1 for c in s}
        assert got.keys() == {r for r, x in conf.items() if x >= 0.3}
        for (a, c), (confidence, lift, support) in got.items():
            assert abs(confidence - conf[a, c]) < 1e-12 and abs(lift - conf[a, c] * len(baskets) / want[c,]) < 1e-9
            assert abs(support - want[tuple(sorted((*a, c)))] / len(baskets)) < 1e-12


def test_frequent_sets_stop_at_max_size(spark):
    """Two equal baskets of 60 parts: 2 ** 60 sets, of which those of up to three are formed."""
    df = spark.createDataFrame([(o, i) for o in (1, 2) for i in range(60)], "l_orderkey long, l_partkey long")
    sets, _ = md.frequent_sets(df, 0.5, 3)
    assert sets.groupBy("size").count().orderBy("size").collect() == [(1, 60), (2, 1770), (3, 34220)]


def brute_push(edges, seed, rounds, damping, eps):
    out = defaultdict(list)
    for u, i in edges:
        out["u", u].append(("i", i))
        out["i", i].append(("u", u))
    mass, left = defaultdict(float), {("u", seed): 1.0}
    for _ in range(rounds):
        push = {v: r for v, r in left.items() if r >= eps * len(out[v])}
        if not push:
            break
        left = {v: r for v, r in left.items() if v not in push}
        for v, r in push.items():
            mass[v] += (1 - damping) * r
            for w in out[v]:
                left[w] = left.get(w, 0.0) + damping * r / len(out[v])
    return mass, left, out


def test_seed_walks(spark):
    rnd = random.Random(5)
    edges = {(rnd.randrange(25), rnd.randrange(30)) for _ in range(160)}
    inter = spark.createDataFrame(sorted(edges), "user_id long, item_id long")
    seeds = spark.createDataFrame([(3,), (7,), (3,), (999,), (None,)], "user_id long")
    for rounds, eps in ((2, 1e-3), (60, 1e-3), (60, 1e-6)):
        got = defaultdict(dict)
        for r in cf.graph_push(inter, seeds, rounds=rounds, eps=eps).collect():
            got[r.seed][r.kind, r.node] = (r.mass, r.residual)
        assert set(got) == {3, 7}
        for seed, rows in got.items():
            mass, left, out = brute_push(edges, seed, rounds, 0.85, eps)
            assert rows.keys() == mass.keys() | left.keys()
            assert all(abs(rows[v][0] - mass.get(v, 0.0)) < 1e-12 and abs(rows[v][1] - left.get(v, 0.0)) < 1e-12 for v in rows)
            assert abs(sum(m + r for m, r in rows.values()) - 1.0) < 1e-9
            if rounds == 60:
                assert all(r < eps * len(out[v]) for v, (_, r) in rows.items())


def test_pairs_leave_a_task_in_parts(monkeypatch):
    """Two blocks in which everyone shares something: the pairs are sent on in parts, not held together."""
    import numpy as np
    monkeypatch.setattr(ps, "PAIRS", 1000)
    n = 300
    block = rl.Block.of(np.arange(n), np.full(n, 2), np.column_stack((np.zeros(n), 1 + np.arange(n))).astype(np.int64).ravel(), np.ones(2 * n))
    parts = list(ps.Pairs(block).parts(block, True))
    assert max(len(p[0]) for p in parts) < 1000 + n and len(parts) > 40
    whole = ps.Pairs(block).meet(block, True)
    assert [x.tolist() for x in whole] == [np.concatenate(c).tolist() for c in zip(*parts)]
    assert len(whole[0]) == n * (n - 1) // 2

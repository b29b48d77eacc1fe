"""C1, C2, C4 and C6 from packed lists against brute force: large ids, many lists, folded sums, rows apart."""

import math
import random
import time
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from pickwise.operators import collaborative as cf
from pickwise.operators import lists as ls
from pickwise.session import kept


def purchases(seed=5):
    """(user, item): an item of most users, a user of most items, ids beyond an int, equal users."""
    rnd = random.Random(seed)
    rows = {(u, rnd.randrange(30)) for u in range(50) for _ in range(rnd.randint(1, 9))} | {(u, 7) for u in range(40)}
    rows |= {(77, i) for i in range(25)} | {(1 << 40, i) for i in (1, 2, 1 << 41)} | {(u, i) for u in (60, 61, 62) for i in (3, 4)}
    return sorted(rows)


def item_lists(rows, k, iuf):
    items, of = defaultdict(set), defaultdict(set)
    for u, i in rows:
        items[i].add(u)
        of[u].add(i)
    out = {}
    for a, x in items.items():
        near = []
        for b, y in items.items():
            if a != b and x & y:
                c = sum(1 / math.log(1 + len(of[u])) for u in sorted(x & y)) if iuf else len(x & y)
                near.append((-math.floor(c / math.sqrt(len(x) * len(y)) * 1e6 + 0.5), b, len(x & y)))
        out.update({(a, b): (s, -score, r + 1) for r, (score, b, s) in enumerate(sorted(near)[:k])})
    return out


@pytest.mark.parametrize("iuf", [False, True])
@pytest.mark.parametrize("most, fold, chunk", [(1 << 20, 1 << 22, 4096), (1 << 20, 20, 3), (12, 1 << 22, 4096)])
def test_item_lists(spark, monkeypatch, iuf, most, fold, chunk):
    monkeypatch.setattr(ls, "FOLD", fold)
    rows = purchases()
    inter = spark.createDataFrame(rows, "user_id long, item_id long").repartition(5)
    got = {(r.id, r.other): (r.support, r.score, r.rank) for r in cf.item_cf(inter, 6, iuf=iuf, most=most, chunk=chunk).collect()}
    want = item_lists(rows, 6, iuf)
    if not iuf:
        assert got == want
    else:  # sums of doubles in another order
        assert len(got) == len(want) and all(abs(v[1] - want[p][1]) <= 1 for p, v in got.items() if p in want)


def test_no_row_to_a_pair(spark):
    """Neither pairs nor candidates are rows that are dealt out and added up."""
    inter = spark.createDataFrame(purchases(), "user_id long, item_id long")
    nb = cf.item_cf(inter, 6)
    for df in (nb, cf.user_cf(inter, 6, metric="jaccard"), cf.recommend_items(inter, nb, 5)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert "a_n" not in plan and "sum(s#" not in plan and "sum(score" not in plan


@pytest.mark.parametrize("most, fold, chunk", [(1 << 20, 1 << 22, 512), (1 << 20, 10, 2), (5, 1 << 22, 512)])
def test_neighbor_sums(spark, monkeypatch, most, fold, chunk):
    monkeypatch.setattr(ls, "FOLD", fold)
    monkeypatch.setattr(ls, "LIST", chunk)
    rows = purchases()
    inter = spark.createDataFrame([*rows, (None, 3), (5, None)], "user_id long, item_id long")
    nb = [(i, o, s) for (i, o), (_, s, _) in item_lists(rows, 4, False).items()]
    nb += [(3, 1 << 42, 1 << 35)]
    want, seen = defaultdict(int), defaultdict(set)
    for u, i in [*rows, (None, 3)]:
        seen[u].add(i)
        for a, b, s in nb:
            if a == i:
                want[u, b] += s
    want = {(u, i): s for (u, i), s in want.items() if u is None or i not in seen[u]}
    neighbors = spark.createDataFrame(nb, "id long, other long, score long")
    assert {(r.user_id, r.item_id): r.score for r in ls.neighbor_sums(inter, neighbors, most=most).collect()} == want
    best = defaultdict(list)
    for (u, i), s in want.items():
        best[u].append((-s, i))
    got = defaultdict(list)
    for r in cf.recommend_items(inter, neighbors, 3).orderBy("user_id", "rank").collect():
        got[r.user_id].append((-r.score, r.item_id))
    assert got == {u: sorted(v)[:3] for u, v in best.items()}


def test_nothing_in_common(spark):
    inter = spark.createDataFrame([(1, 1), (2, 2), (None, 1)], "user_id long, item_id long")
    nb = cf.item_cf(inter, 3)
    assert nb.collect() == [] and cf.recommend_items(inter, nb, 3).collect() == []
    empty = inter.where("user_id > 5")
    assert cf.item_cf(empty, 3).collect() == [] and cf.user_cf(empty, 3, "jaccard").collect() == []


def test_packed_lists_compress(spark):
    """The shuffle's compression takes out what sorted ids have in common; all entries come back (F8-F16)."""
    import numpy as np
    import pyarrow as pa
    from pyspark.sql import functions as F
    from pickwise.operators import lists
    rows = spark.range(8000).select((F.col("id") % 100).alias("t"), F.pmod(F.xxhash64("id"), F.lit(1_200_000)).alias("o"), (F.col("id") % 50).alias("x"))
    kinds = ("int32", "int16")
    table = lists.packed(rows, "t", "o", "x", kinds, 512).toArrow()
    raw = b"".join(table.column("ids").to_pylist())
    assert len(pa.compress(raw, "lz4_raw" if pa.Codec.is_available("lz4_raw") else "lz4", asbytes=True)) < 0.8 * len(raw)
    back = {(k, int(o), int(x)) for k, ids, vals, _, _ in lists.runs(table.to_batches(), kinds) for o, x in zip(ids, vals)}
    assert back == {tuple(r) for r in rows.collect()}
    assert np.dtype(kinds[0]).itemsize == 4


@pytest.mark.parametrize("held", [1 << 30, 1500])
def test_lists_go_once_to_a_block(spark, monkeypatch, held):
    """A list is sent to the blocks of its members, not to each member (F9-F15), with the same rows from any number of blocks."""
    monkeypatch.setattr(ls, "HELD", held)
    rows = purchases(8) + [(-5, -7), (-5, 3), (-6, -7), (-6, 1 << 41)]
    inter = spark.createDataFrame(rows, "user_id long, item_id long").repartition(3)
    nb = cf.item_cf(inter, 6, chunk=4)
    assert "explode(blocks" in nb._jdf.queryExecution().executedPlan().toString()
    assert {(r.id, r.other): (r.support, r.score, r.rank) for r in nb.collect()} == item_lists(rows, 6, False)
    want, seen = defaultdict(int), defaultdict(set)
    for u, i in rows:
        seen[u].add(i)
    for (i, o), (_, score, _) in item_lists(rows, 6, False).items():
        for u in seen:
            if i in seen[u] and o not in seen[u]:
                want[u, o] += score
    assert {(r.user_id, r.item_id): r.score for r in ls.neighbor_sums(inter, nb).collect()} == want


def test_blocks_hold_their_share(spark):
    """More blocks where a block's lists would not fit; a list's numbers are dealt alike in Spark and in a task."""
    import numpy as np
    from pyspark.sql import functions as F
    groups = spark.createDataFrame([(40, 40)] * 1000, "m long, e long")
    least = spark.sparkContext.defaultParallelism
    assert ls.blocks_for(groups, "m", "e", 6) == least
    assert ls.blocks_for(groups.select((F.col("m") * 10**6).alias("m"), (F.col("e") * 10**5).alias("e")), "m", "e", 6) > least
    ids = [0, 1, 2, 12, 24, -1, -(1 << 62), (1 << 31) - 1, 1 << 41, (1 << 63) - 1]
    got = spark.createDataFrame([(i,) for i in ids], "id long").select("id", ls.block_of(F.col("id"), 13).alias("b")).collect()
    assert {r.id: r.b for r in got} == dict(zip(ids, ls.block_of(np.array(ids), 13).tolist()))
    assert set(ls.block_of(np.arange(0, 1 << 16, 12), 12).tolist()) == set(range(12))


@pytest.mark.parametrize("most", [1 << 20, 12])
def test_blocks_take_turns(spark, monkeypatch, most):
    """Lists that would be sent many times over go in rounds; the files of a round's shuffle are gone before the next."""
    for name, value in (("HELD", 300), ("SENT", 1), ("TIMES", 2)):
        monkeypatch.setattr(ls, name, value)
    rounds, plain = [], ls.by_rounds  # F9-F22
    monkeypatch.setattr(ls, "by_rounds", lambda n, found: rounds.append(n) or plain(n, found))
    rows = purchases()
    inter = spark.createDataFrame(rows, "user_id long, item_id long")
    got = {(r.id, r.other): (r.support, r.score, r.rank) for r in cf.item_cf(inter, 6, most=most).collect()}
    assert got == item_lists(rows, 6, False) and rounds.pop() > 1
    nb = spark.createDataFrame([(i, o, s) for (i, o), (_, s, _) in got.items()], "id long, other long, score long")
    best = {(r.user_id, r.item_id): r.score for r in ls.neighbor_sums(inter, nb, 5, most=most).collect()}
    assert rounds.pop() > 1
    every = {(r.user_id, r.item_id): r.score for r in ls.neighbor_sums(inter, nb, most=most).collect()}
    want = defaultdict(list)
    for (u, i), s in every.items():
        want[u].append((-s, i))
    if most > 25:
        assert best == {(u, i): -s for u, x in want.items() for s, i in sorted(x)[:5]}
    else:  # users of more items have all their sums
        assert all(best[u, i] == -s for u, x in want.items() for s, i in sorted(x)[:5])


def test_kept_gives_its_shuffles_back(spark):
    before = spark._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()
    df = kept(spark.range(1000).repartition(3).groupBy((F.col("id") % 7).alias("g")).count())
    for _ in range(100):
        if (now := spark._jsc.sc().env().mapOutputTracker().shuffleStatuses().size()) <= before:
            break
        time.sleep(0.1)
    assert now <= before and df.count() == 7
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None

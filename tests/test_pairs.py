"""co_pairs: exact pair set, also when groups are split into chunks."""

from itertools import combinations

from pyspark.sql import functions as F

from pickwise.operators.pairs import both_ways, co_pairs


def _groups():
    # one hot group of 40 keys, a few light ones, one singleton
    rows = [(1, k) for k in range(40)] + [(2, 3), (2, 7), (2, 9), (3, 5), (4, 1), (4, 2)]
    return rows


def _expected(rows):
    by = {}
    for g, k in rows:
        by.setdefault(g, []).append(k)
    out = set()
    for g, ks in by.items():
        for a, b in combinations(sorted(ks), 2):
            out.add((g, a, b))
    return out


def test_pairs_exact_for_any_chunk(spark):
    rows = _groups()
    df = spark.createDataFrame(rows, "g long, k long")
    want = _expected(rows)
    for chunk in (1, 3, 7, 4096):
        got = co_pairs(df, "g", "k", chunk=chunk).select("g", "a", "b").collect()
        assert len(got) == len(want), chunk
        assert {tuple(r) for r in got} == want, chunk


def test_pairs_carry_follow_orientation(spark):
    df = spark.createDataFrame([(1, 5, 50.0), (1, 2, 20.0), (1, 9, 90.0)], "g long, k long, v double")
    got = co_pairs(df, "g", "k", carry=["v"], chunk=1).collect()
    for r in got:
        assert r.a < r.b and r.a_v == r.a * 10 and r.b_v == r.b * 10
    d = both_ways(co_pairs(df, "g", "k", carry=["v"]), mirrored=[("a_v", "b_v")]).collect()
    assert len(d) == 6 and all(r.a_v == r.id * 10 and r.b_v == r.other * 10 for r in d)


def test_group_size_reported(spark):
    df = spark.createDataFrame(_groups(), "g long, k long")
    sizes = {r.g: r.group_size for r in co_pairs(df, "g", "k", chunk=5)
             .select("g", "group_size").distinct().collect()}
    assert sizes == {1: 40, 2: 3, 4: 2}
    assert co_pairs(df, "g", "k").where(F.col("g") == 3).count() == 0

"""T8 and T9 against numpy over all pairs."""

import math

import numpy as np
import pytest

from conftest import SF001
from pickwise.operators import vectors as vs
from pickwise.sources import tables as src

SCHEMA = "vec_id long, embedding array<double>"


def table(spark, ids, m):
    return spark.createDataFrame([(int(i), [float(x) for x in v]) for i, v in zip(ids, m)], SCHEMA)


def brute(ids, m, k, some=None):
    """{(id, other)}: the k nearest of each row (or of the first ``some``), ties to the smaller id."""
    ids, m = np.asarray(ids), np.asarray(m, np.float64)
    order = np.argsort(ids)
    ids, m = ids[order], m[order] / np.linalg.norm(m[order], axis=1, keepdims=True)
    out = set()
    for lo in range(0, some or len(m), 500):
        cos = np.floor(m[lo:lo + 500] @ m.T * 1e6 + 0.5)
        cos[np.arange(len(cos)), lo + np.arange(len(cos))] = -np.inf
        for i, row in zip(ids[lo:lo + 500], ids[np.argsort(-cos, axis=1, kind="stable")[:, :k]]):
            out |= {(int(i), int(j)) for j in row if j != i}
    return out


def found(df):
    return {(r.id, r.other) for r in df.collect()}


def test_nearest_is_exact_however_tiled(spark):
    emb = src.load(spark, SF001, "embeddings")
    one = sorted(map(tuple, vs.nearest(emb, 5).collect()))
    for block in (64, 120):
        assert sorted(map(tuple, vs.nearest(emb, 5, block=block).collect())) == one
    vecs = {r.vec_id: r.embedding for r in emb.collect()}
    assert {(i, j) for i, j, _, _ in one} == brute(list(vecs), list(vecs.values()), 5)
    for i, j, score, _ in one[:200]:
        a, b = (np.array(vecs[x], np.float64) for x in (i, j))
        assert score == math.floor(a @ b / (np.linalg.norm(a) * np.linalg.norm(b)) * 1e6 + 0.5)


ODD = [(1, [1.0, 0.0]), (2, [2.0, 0.0]), (3, [0.0, 1.0]), (4, [1.0, 1.0]), (5, [0.0, 0.0]), (6, [1.0, 2.0, 3.0]), (7, [1.0, 2.0, 2.0]),
       (8, None), (None, [1.0, 0.0]), (9, [1.0, None]), (10, [math.nan, 1.0]), (11, []), (12, [3.0, 3.0, 3.0, 3.0])]


def test_odd_vectors(spark):
    """Lengths are kept apart; zero, null and broken vectors and rows without id take no part; copies tie by id."""
    df = spark.createDataFrame(ODD, SCHEMA)
    want = {(1, 2, 1000000, 1), (1, 4, 707107, 2), (1, 3, 0, 3), (2, 1, 1000000, 1), (2, 4, 707107, 2), (2, 3, 0, 3),
            (3, 4, 707107, 1), (3, 1, 0, 2), (3, 2, 0, 3), (4, 1, 707107, 1), (4, 2, 707107, 2), (4, 3, 707107, 3),
            (6, 7, 979958 if False else math.floor(11 / math.sqrt(14 * 9) * 1e6 + 0.5), 1), (7, 6, math.floor(11 / math.sqrt(14 * 9) * 1e6 + 0.5), 1)}
    for result in (vs.nearest(df, 3), vs.nearest(df, 3, block=2), vs.nearest_ivf(df, 3), vs.nearest_ivf(df, 3, cells=2, probes=2)):
        assert {tuple(r) for r in result.collect()} == want
    empty = spark.createDataFrame([], SCHEMA)
    assert vs.nearest(empty, 3).collect() == [] and vs.nearest_ivf(empty, 3).collect() == []


def test_ivf_recall_at_sf01(spark):
    emb = src.load(spark, "/root/testdata/sf0.1", "embeddings")
    truth, got = found(vs.nearest(emb, 5)), found(vs.nearest_ivf(emb, 5))
    assert vs.cell_count(emb.count()) > 1 and len(got & truth) / len(truth) >= 0.9


def test_ivf_recall_without_structure(spark):
    """50,000 vectors in no groups at all: the probed cells grow until the sample's neighbours are found."""
    rng = np.random.default_rng(3)
    m = rng.standard_normal((50_000, 16)).astype(np.float32)
    got = found(vs.nearest_ivf(table(spark, range(len(m)), m), 5))
    truth = brute(range(len(m)), m, 5, some=1500)
    assert len(got & truth) / len(truth) >= 0.9


def test_ivf_probes_few_cells_of_grouped_vectors(spark):
    rng = np.random.default_rng(4)
    centres = rng.standard_normal((40, 24))
    m = centres[np.arange(8000) % 40] + 0.3 * rng.standard_normal((8000, 24))
    df = table(spark, range(8000), m)
    rows = vs._valid(df, "vec_id", "embedding").select("id", "v")
    _, sample = vs._sampled(rows, 2000)
    fitted = vs.fit_centroids(sample, 40)
    assert vs.probes_for(rows, fitted, 5, 0.95) <= 8
    got, truth = found(vs.nearest_ivf(df, 5, cells=40)), brute(range(8000), m, 5)
    assert len(got & truth) / len(truth) >= 0.9


def test_ivf_with_a_vector_that_fills_a_third(spark):
    """A vector's copies are searched for once and find each other, least ids first."""
    rng = np.random.default_rng(5)
    m = rng.standard_normal((600, 8))
    m[:200] = m[0]
    ids = rng.permutation(600)
    got = found(vs.nearest_ivf(table(spark, ids, m), 4, cells=4, probes=4))
    assert got == brute(ids, m, 4)


def test_ivf_probing_every_cell_is_exact(spark):
    rng = np.random.default_rng(6)
    m = rng.standard_normal((700, 6))
    for cells in (1, 5, 700):
        assert found(vs.nearest_ivf(table(spark, range(700), m), 5, cells=cells, probes=cells)) == brute(range(700), m, 5)


def test_nearest_sends_vectors_to_blocks_of_queries_only(spark):
    """No tile carries both its sides: the vectors go once to a block of queries, however small the tiles."""
    emb = src.load(spark, SF001, "embeddings")
    plan = vs.nearest(emb, 5, block=16)._jdf.queryExecution().optimizedPlan().toString()
    assert "Join" not in plan and "RepartitionByExpression" in plan


def test_running_lists_keep_ties_and_copies():
    """In any order of blocks the k best, ties to the smaller id, without the query's own id."""
    rnd = np.random.default_rng(3)
    ids, m = rnd.permutation(300) - 50, rnd.integers(-2, 3, (300, 4)).astype(float) + 0.5
    now = vs.Closest(ids, m, 7)
    for lo in (250, 0, 248, 3, 100):
        hi = {250: 300, 0: 3, 248: 250, 3: 100, 100: 248}[lo]
        now.meet(ids[lo:hi], m[lo:hi])
    assert set(zip(*(c.tolist() for c in now.columns()[:2]))) == brute(ids, m, 7)


@pytest.mark.parametrize("scored", [1 << 22, 40])
def test_only_what_reaches_is_scored_in_doubles(monkeypatch, scored):
    """Floats decide what is scored, doubles the score: cosines of neighbours and copies, vectors far from unit length."""
    monkeypatch.setattr(vs, "SCORED", scored)
    rnd = np.random.default_rng(5)
    near = rnd.normal(size=8) + rnd.normal(size=(400, 8)) * 1e-2
    m = np.concatenate((near, np.repeat(near[:3], 40, axis=0), rnd.normal(size=(300, 8)))) * 10.0 ** rnd.integers(-30, 30, (820, 1))
    ids = rnd.permutation(820) - 100
    now = vs.Closest(ids[:500], m[:500], 6)
    calls, einsum = [], np.einsum
    monkeypatch.setattr(np, "einsum", lambda *x: calls.append(len(x[1])) or einsum(*x))
    for lo in range(0, 820, 90):
        now.meet(ids[lo:lo + 90], m[lo:lo + 90])
    asked = set(ids[:500].tolist())
    assert set(zip(*(c.tolist() for c in now.columns()[:2]))) == {p for p in brute(ids, m, 6) if p[0] in asked}
    assert 0 < sum(calls) < 500 * 820 and max(calls) <= max(1, scored // 8)

"""T3 and C4 in packed blocks against brute force."""

import math
import random
from collections import defaultdict

import numpy as np
import pytest

from conftest import SF001
from pickwise.operators import collaborative as cf
from pickwise.operators import content as ct
from pickwise.operators import related as rl
from pickwise.sources import tables as src


def cosines(spark):
    """{id: {other: (shared terms, cosine in millionths)}} of all pairs that share weight, term by term."""
    x = {}
    for r in ct.tfidf(src.articles(spark, SF001)).collect():
        x.setdefault(r.item_id, {})[r.term] = r.x
    norm = {i: math.sqrt(sum(v * v for v in d.values())) for i, d in x.items()}
    out = {}
    for i, a in x.items():
        out[i] = {}
        for j, b in x.items():
            shared = a.keys() & b.keys()
            dot = sum(a[t] * b[t] for t in shared)
            if i != j and dot > 0:
                out[i][j] = (len(shared), 1e6 * dot / (norm[i] * norm[j]))
    return out


@pytest.fixture(scope="module")
def every(spark):
    return cosines(spark)


@pytest.mark.parametrize("least", [0.05, 0.3, 0.9])
def test_related_from_a_least_score(spark, every, least):
    want = {(i, j): c for i, row in every.items() for j, c in row.items() if math.floor(c[1] + 0.5) >= least * 1e6}
    got = {(r.id, r.other): (r.support, r.score) for r in rl.related(src.articles(spark, SF001), k=1000, min_score=least).collect()}
    assert got.keys() == want.keys() and got
    assert all(got[p][0] == want[p][0] and abs(got[p][1] - want[p][1]) < 1 for p in got)


@pytest.mark.parametrize("k,entries", [(5, 1 << 20), (20, 2000)])
def test_related_lists_are_whole(spark, monkeypatch, every, k, entries):
    """Top k of every positive cosine, in few blocks and in many."""
    monkeypatch.setattr(rl, "BLOCK_ENTRIES", entries)
    got = defaultdict(list)
    for r in rl.related(src.articles(spark, SF001), k=k).collect():
        got[r.id].append((r.rank, r.other, r.support, r.score))
    for i, cos in every.items():
        mine = sorted(got.get(i, []))
        assert [m[0] for m in mine] == list(range(1, min(k, len(cos)) + 1))
        assert all(m[2] == cos[m[1]][0] and abs(m[3] - cos[m[1]][1]) < 1 for m in mine)
        best = sorted((c for _, c in cos.values()), reverse=True)[:k]
        assert all(abs(m[3] - c) < 1 for m, c in zip(mine, best))


def test_related_odd_texts(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, "a b"), (3, None), (4, ""), (5, "..."), (6, "z"), (None, "a b")], "item_id long, text string")
    assert sorted((r.id, r.other, r.support, r.rank) for r in rl.related(docs, 3).collect()) == [(1, 2, 2, 1), (2, 1, 2, 1)]
    assert rl.related(docs.where("item_id = 3"), 3).collect() == []


def topic_blocks(topics, per=120, size=24):
    """Blocks of unit vectors; every topic has words of its own, all share a few."""
    rnd = random.Random(topics)
    ids, sizes, hashes, w = [], [], [], []
    for i in range(topics * per):
        own = {1000 * (1 + i // per) + rnd.randrange(60) for _ in range(size)} | {rnd.randrange(5) for _ in range(3)}
        weights = np.array([0.2 if t < 5 else rnd.uniform(1, 2) for t in sorted(own)])
        ids.append(i)
        sizes.append(len(own))
        hashes += sorted(own)
        w += (weights / np.sqrt((weights ** 2).sum())).tolist()
    cut = np.concatenate(([0], np.cumsum(sizes)))
    hashes, w = np.array(hashes), np.array(w)
    return [rl.Block.of(np.array(ids[a:a + per]), np.array(sizes[a:a + per]), hashes[cut[a]:cut[a + per]], w[cut[a]:cut[a + per]])
            for a in range(0, topics * per, per)]


def test_work_per_article_does_not_grow_with_the_table():
    """Six times as many topics: an article reads hardly more postings, as the blocks of other topics stay under
    its threshold."""
    visited = {}
    for topics in (2, 12):
        blocks = topic_blocks(topics)
        search = rl.Search(blocks[0], 5)
        for block in blocks:
            search.meet(block)
        visited[topics] = search.visited / len(blocks[0].ids)
        assert all(len(b[0]) == 5 for b in search.best)
    assert visited[12] <= 1.05 * visited[2]


def brute_sets(rows, k):
    sets = defaultdict(set)
    for of, t in rows:
        sets[of].add(t)
    out = {}
    for a, x in sets.items():
        near = [(-math.floor(len(x & y) / math.sqrt(float(len(x)) * len(y)) * 1e6 + 0.5), b, len(x & y), len(x), len(y))
                for b, y in sets.items() if a != b and x & y]
        out[a] = [(b, n, -s, na, nb) for s, b, n, na, nb in sorted(near)[:k]]
    return {a: v for a, v in out.items() if v}


@pytest.mark.parametrize("entries, most", [(1 << 20, 1 << 20), (100, 1 << 20), (100, 12)])
def test_set_cosines(spark, monkeypatch, entries, most):
    """Blocks, many blocks, and large sets that meet the others term by term, with ties and a set of a third of all rows."""
    monkeypatch.setattr(rl, "BLOCK_ENTRIES", entries)
    rnd = random.Random(9)
    rows = {(u, rnd.randrange(40)) for u in range(60) for _ in range(rnd.randint(1, 15))} | {(99, t) for t in range(400)}
    rows |= {(200 + i, t) for i in range(5) for t in (1, 2, 3, 4)}
    df = spark.createDataFrame(sorted(rows) + [(None, 1), (1, None)], "u long, i long")
    got = defaultdict(list)
    for r in rl.set_cosines(df, "u", "i", 6, most=most).orderBy("id", "rank").collect():
        got[r.id].append((r.other, r.support, r.score, r.n, r.other_n))
    assert dict(got) == brute_sets(rows, 6)


def test_top_k_by_blocks_is_the_top_k_by_pairs(spark):
    """Blocks give what pairs give, for C1 and C4."""
    inter = src.interactions(spark, SF001)
    by_blocks = rl.set_cosines(inter, "item_id", "user_id", 10).select("id", "other", "support", "score", "rank")
    assert {tuple(r) for r in cf.item_cf(inter, 10).collect()} == {tuple(r) for r in by_blocks.collect()}
    pairs = defaultdict(list)
    for r in cf.user_cf(inter, None).collect():
        pairs[r.id].append((-r.score, r.other, r.support, r.alt))
    want = {(i, o, n, -s, alt, rank + 1) for i, rows in pairs.items() for rank, (s, o, n, alt) in enumerate(sorted(rows)[:10])}
    assert {tuple(r) for r in cf.user_cf(inter, 10).collect()} == want


def test_blocks_ask_in_turns(spark, monkeypatch):
    """What all blocks read is sent in rounds, without the postings, and gives the same lists (F1, F2)."""
    from pickwise.operators import lists
    block = topic_blocks(2)[1]
    back = rl.Block.unpacked(block.packed())
    assert all(np.array_equal(getattr(block, c), getattr(back, c)) for c in rl.Block.FIELDS)
    assert sum(map(len, block.packed().values())) < 0.7 * sum(getattr(block, c).nbytes for c in rl.Block.FIELDS)
    rounds, plain = [], lists.by_rounds
    monkeypatch.setattr(lists, "by_rounds", lambda n, found: rounds.append(n) or plain(n, found))
    monkeypatch.setattr(rl, "BLOCK_ENTRIES", 1500)
    docs = src.articles(spark, SF001)
    want = {tuple(r) for r in rl.related(docs, 5).collect()}
    monkeypatch.setattr(lists, "SENT", 1)
    assert {tuple(r) for r in rl.related(docs, 5).collect()} == want and len(want) > 500
    assert rounds[0] == 1 and rounds[1] > 1

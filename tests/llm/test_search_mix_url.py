"""Operators 5, 6 and 10 against brute force."""

import datetime as dt
import math
import random
from collections import defaultdict

from pickwise.llm import maxscore, mixing, url_filter
from tests.llm.tables import SCHEMA, documents, odd_documents, rows


def brute_top(vectors, k, every):
    out = []
    for q, v in vectors.items():
        if q % every == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), c) for c, w in vectors.items() if c != q)[:k]
            out += [(q, i + 1, c, -s) for i, (s, c) in enumerate(scored)]
    return sorted(out, key=repr)


def test_maxscore_top_k(spark):
    rnd = random.Random(2)
    vectors = {i: [rnd.choice([0.0, rnd.gauss(0, 1), 0.5]) for _ in range(12)] for i in range(300)}
    for i in range(200, 260):
        vectors[i] = vectors[10]  # ties, settled by id
    bad = [(900, None), (901, [1.0, None]), (902, [math.nan, 1.0]), (903, [math.inf]), (None, [1.0] * 12)]
    table = spark.createDataFrame([*vectors.items(), *bad, (5, vectors[5])], "vec_id long, embedding array<double>")
    want = brute_top({i: [math.floor(1024 * x) for x in v] for i, v in vectors.items()}, 10, 20)
    got = maxscore.quantised(table)
    for shard, block in ((8192, 1024), (40, 4)):
        assert rows(maxscore.top_k(got, got.filter("vec_id % 20 = 0"), 10, shard, block)) == want


def test_maxscore_few_empty_and_uneven(spark):
    table = spark.createDataFrame([(0, [1.0, 2.0]), (100, [3.0]), (7, []), (200, None)], "vec_id long, embedding array<float>")
    want = brute_top({0: [1024, 2048], 100: [3072, 0], 7: [0, 0]}, 10, 100)
    assert rows(maxscore.search(table)) == want
    assert maxscore.search(table.filter("vec_id = 1")).collect() == []


def water(sizes, weights, limit):
    """Targets by the plain rounds: share what is left by weight, stop the full ones, again."""
    target = {s: 0.0 for s in sizes}
    open_, left = set(sizes), float(sum(sizes.values()))
    while open_ and left > 1e-9:
        w = sum(weights[s] for s in open_)
        level, left = left / w, 0.0
        for s in list(open_):
            target[s] += level * weights[s]
            if target[s] >= limit * sizes[s]:
                left += target[s] - limit * sizes[s]
                target[s] = float(limit * sizes[s])
                open_.discard(s)
    return target


def test_mixing(spark):
    df, data = odd_documents(spark, clash=True)
    df = df.union(documents(spark, ["a b c"] * 4, [500, 501, 502, 503], lambda i: None, clash=True))
    df = df.union(documents(spark, ["", None], [600, 601], lambda i: "empty", clash=True))
    source = {r["doc_id"]: r["source"] for r in df.collect()}
    got = mixing.mix(df).collect()
    sizes, taken, targets = defaultdict(int), defaultdict(int), {}
    by_size = {}
    for r, s in zip(df.collect(), [None] * 10_000):
        sizes[r["source"]] += len((r["text"] or "").encode().split())
    order = sorted((s for s in sizes if s is not None)) + ([None] if None in sizes else [])
    want = water(sizes, {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}, 3)
    for r in got:
        assert 0 <= r["taken"] <= 3 * r["size"] and r["taken"] == r["copies"] * r["size"] + r["part"]
        by_size[r["source_size"]] = r["target"]
    for s in sizes:
        assert abs(by_size[sizes[s]] - want[s]) < 1e-6
    assert len(got) == df.count()
    total = sum(r["taken"] for r in got)
    assert abs(total - sum(sizes.values())) <= len(sizes)
    mixed = mixing.apply_mix(df)
    assert mixed.columns == df.columns
    words = sum(len((r["text"] or "").encode().split()) for r in mixed.collect())
    assert words == total
    assert rows(mixing.mix(df)) == rows(mixing.mix(df.repartition(5)))  # reruns agree
    assert source and targets == {} and taken == {}


def test_mixing_of_nothing(spark):
    assert mixing.mix(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mixing.apply_mix(documents(spark, [None, "", " "])).collect() == []


def brute_verdict(url, at, entries):
    import re
    m = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", url or "")
    if not m or at is None:
        return 0, None
    host = m.group(1).lower()
    path = re.match(r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)", url).group(1).rstrip("/")
    state, on = {}, []
    for kind, pattern, action, when in sorted((e for e in entries if None not in e), key=lambda e: (e[3], e[2])):
        if when <= at and action in ("add", "remove"):
            state[kind, pattern] = action
    for (kind, pattern), action in state.items():
        fits = {"domain": host == pattern or host.endswith("." + pattern), "host": host == pattern,
                "url": host + path == pattern}.get(kind, False)
        if fits and action == "add":
            on.append(pattern)
    return len(on), max(on, key=lambda p: (len(p), p)) if on else None


def test_url_filter(spark):
    rnd = random.Random(3)
    day = lambda n: dt.datetime(2024, 1, 1) + dt.timedelta(days=n)
    hosts = ["a.example.org", "example.org", "x.a.example.org", "b.test", "EXAMPLE.org"]
    urls = [f"{rnd.choice(['http', 'HTTPS'])}://{rnd.choice(['', 'u:p@'])}{rnd.choice(hosts)}{rnd.choice(['', ':8080'])}"
            f"{rnd.choice(['', '/', '/p', '/p/', '/p?q=/r', '#x'])}" for _ in range(150)]
    urls += [None, "", "nohost", "http://", "//b.test/p", "http://b.test"]
    captures = [(i, u, day(rnd.randint(0, 60)) if i % 17 else None) for i, u in enumerate(urls)]
    captures += [captures[3], (None, *captures[4][1:])]
    entries = [(rnd.choice(["domain", "host", "url"]), rnd.choice(["example.org", "a.example.org", "b.test", "b.test/p", "org"]),
                rnd.choice(["add", "remove"]), day(rnd.randint(0, 60))) for _ in range(120)]
    entries += [("domain", None, "add", day(0)), ("domain", "b.test", None, day(0)), ("domain", "b.test", "gone", day(1)),
                ("host", "b.test", "add", None), ("odd", "b.test", "add", day(0))]
    df = spark.createDataFrame(captures, "page_id long, url string, fetched_at timestamp").selectExpr("*", "1 as seq", "'s' as salt")
    log = spark.createDataFrame(entries, "kind string, pattern string, action string, at timestamp")
    got = url_filter.evaluate(df, log)
    want = [(p, u, a, *brute_verdict(u, a, entries)) for p, u, a in captures]
    assert rows(got, "page_id", "url", "fetched_at", "n_active", "first_match") == sorted(want, key=repr)
    assert url_filter.evaluate(df, log.limit(0)).filter("blocked").count() == 0
    assert url_filter.evaluate(df.limit(0), log).collect() == []
    plan = got._jdf.queryExecution().toString()
    assert not [x for x in ("Python", "Arrow", "CartesianProduct", "BroadcastExchange") if x in plan]


def test_maxscore_keeps_every_row_of_an_id(spark):
    """Rows that share an id compete apart, as in the query's SQL."""
    table = spark.createDataFrame([(100, [1.0, 1.0]), (1, [2.0, 0.0]), (1, [0.0, 3.0]), (1, [0.0, 3.0]), (2, [1.0, 0.0])],
                                  "vec_id long, embedding array<double>")
    got = [(r.rank, r.vec_id, r.score) for r in maxscore.search(table, k=4).orderBy("rank").collect()]
    assert got == [(1, 1, 3 << 20), (2, 1, 3 << 20), (3, 1, 2 << 20), (4, 2, 1 << 20)]

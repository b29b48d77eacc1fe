"""Operators 2, 3, 4 and 7 against brute force over small odd tables."""

import hashlib
import random
from collections import defaultdict

import pytest
import xxhash

from pickwise.llm import exact_dedup, passages, simhash, substring_dedup, suffix_dedup
from pickwise.llm.components import components
from pickwise.llm.exact_dedup import RadixTrie
from tests.llm.tables import SCHEMA, documents, odd_documents, rows


def sha(b):
    return hashlib.sha256(b).hexdigest()


def test_radix_trie_holds_every_string_once():
    rnd = random.Random(1)
    words = [bytes(rnd.choice(b"ab") for _ in range(rnd.randint(1, 9))) for _ in range(400)]
    trie = RadixTrie()
    for w in words:
        node = trie.terminal(w)
        node.terminal = (node.terminal or 0) + 1
    first = dict(trie.pop(ord("a")))  # a subtree leaves alone
    rest = dict(trie.pop())
    assert all(k[:1] == b"a" for k in first) and all(k[:1] == b"b" for k in rest)
    assert first | rest == {w: words.count(w) for w in words}
    assert trie.size == 0


@pytest.mark.parametrize("keep,trie_bytes,clash", [("largest", 1 << 20, True), ("smallest", 200, False)])
def test_exact_dedup(spark, keep, trie_bytes, clash):
    df, data = odd_documents(spark, clash)
    got = rows(exact_dedup.exact_dedup(df, keep, trie_bytes), "doc_id", "keep_id", "group_size", "text_sha256")
    groups = defaultdict(list)
    for d, t in data:
        groups[t or ""].append(d)
    pick = max if keep == "largest" else min
    want = []
    for d, t in data:
        ids = [x for x in groups[t or ""] if x is not None]
        want.append((d, pick(ids) if ids else None, len(groups[t or ""]), sha((t or "").encode())))
    assert got == sorted(want, key=repr)
    kept = exact_dedup.exact_dedup(df, keep, trie_bytes).filter("kept").collect()
    assert len(kept) == len(groups) and len({r["text_sha256"] for r in kept}) == len(groups)


def test_exact_dedup_of_nothing(spark):
    assert exact_dedup.exact_dedup(spark.createDataFrame([], SCHEMA)).collect() == []


def brute_words(data, n):
    first = {}
    rank = lambda d: passages.LAST if d is None else d
    split = [(d, (t or "").encode().split()) for d, t in data]
    for d, ws in split:
        for i in range(len(ws) - n + 1):
            k = tuple(ws[i:i + n])
            first[k] = min(first.get(k, passages.LAST), rank(d))
    out = []
    for d, ws in split:
        gone = set()
        for i in range(len(ws) - n + 1):
            if first[tuple(ws[i:i + n])] < rank(d):
                gone.update(range(i, i + n))
        out.append((d, len(ws), len(gone), sha(b" ".join(w for i, w in enumerate(ws) if i not in gone))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,hot,clash", [(13, 4096, True), (13, 2, False), (6, 1, False)])
def test_substring_dedup(spark, window, hot, clash):
    df, data = odd_documents(spark, clash)
    got = substring_dedup.substring_dedup(df, window, block_rows=20, hot_rows=hot)
    assert rows(got) == brute_words(data, window)


def brute_bytes(data, n):
    texts = [(d, (t or "").encode()) for d, t in data]
    count = defaultdict(int)
    for _, b in texts:
        for i in range(len(b) - n + 1):
            count[b[i:i + n]] += 1
    out = []
    for d, b in texts:
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if count[b[i:i + n]] > 1:
                gone[i:i + n] = b"\1" * n
        spans = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out.append((d, len(b), sum(gone), spans, sha(bytes(x for x, g in zip(b, gone) if not g))))
    return sorted(out, key=repr)


@pytest.mark.parametrize("window,hot,clash", [(200, 4096, True), (60, 2, False)])
def test_suffix_dedup(spark, window, hot, clash):
    df, data = odd_documents(spark, clash)
    got = suffix_dedup.suffix_dedup(df, window, block_rows=20, hot_rows=hot)
    assert rows(got) == brute_bytes(data, window)


def test_passages_longer_than_a_chunk(spark, monkeypatch):
    """A text is cut into overlapping pieces beyond the chunk size."""
    monkeypatch.setattr(passages, "CHUNK", 64)
    text = " ".join(f"v{i * i % 97}" for i in range(500)).encode()
    kind = substring_dedup.kind_of(13)
    units, off, _ = kind.read([b"", text, text])
    first, last, _, _ = passages.runs(kind, units, off)
    windows = [w for a, b in zip(first, last) for w in range(a, b + 1)]
    assert sorted(windows) == [*range(488), *range(500, 988)]


@pytest.mark.parametrize("op", [substring_dedup.substring_dedup, suffix_dedup.suffix_dedup])
def test_passages_of_nothing(spark, op):
    assert op(spark.createDataFrame([], SCHEMA)).collect() == []
    assert len(op(documents(spark, [None, ""])).collect()) == 2


def test_fm_index_counts_every_window():
    import numpy as np
    rnd = np.random.default_rng(3)
    text = np.concatenate(([0], rnd.integers(1, 6, 400), [0], rnd.integers(1, 6, 300), [0]))
    index = substring_dedup.FMIndex(text, 6, 5)
    ends = np.array([e for e in range(5, len(text)) if 0 not in text[e - 5:e]])
    matched, low, high = index.search(text, ends, 5)
    for e, m, a, b in zip(ends, matched, low, high):
        here = [i for i in range(len(text) - 4) if list(text[i:i + 5]) == list(text[e - 5:e])]
        assert (sorted(index.order[a:b]) == here) if len(here) > 1 else a == b
        assert m == 5 or len(here) == 1


def brute_fingerprint(text, k=3):
    ws = (text or "").encode().lower().split()
    if not ws:
        return 0
    grams = [b" ".join(ws[i:i + k]) for i in range(max(1, len(ws) - k + 1))]
    hs = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def brute_components(nodes, linked):
    root = {n: n for n in nodes}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x
    for a in nodes:
        for b in nodes:
            if a < b and linked(a, b):
                root[max(find(a), find(b))] = min(find(a), find(b))
    return {n: find(n) for n in nodes}


@pytest.mark.parametrize("clash", [True, False])
def test_simhash(spark, clash):
    df, data = odd_documents(spark, clash)
    fps = {t: brute_fingerprint(t) for _, t in data}
    roots = brute_components(sorted(set(fps.values())), lambda a, b: (a ^ b).bit_count() <= 2)
    least = {}
    for d, t in data:
        if d is not None:
            r = roots[fps[t]]
            least[r] = min(least.get(r, d), d)
    want = sorted([(d, f"{fps[t]:016x}", least.get(roots[fps[t]])) for d, t in data], key=repr)
    got = simhash.simhash_groups(df)
    assert rows(got, "doc_id", "fingerprint", "component_id") == want
    assert got.filter("stays").select("component_id").distinct().count() == len(set(roots.values()))
    assert simhash.simhash_groups(spark.createDataFrame([], SCHEMA)).collect() == []


def test_ball_links_join_exactly_what_is_near(spark):
    rnd = random.Random(4)
    fps = {rnd.getrandbits(64) for _ in range(40)}
    for f in list(fps):
        for _ in range(4):  # chains of small steps, some over the radius
            f ^= sum(1 << rnd.randrange(64) for _ in range(rnd.randint(1, 3)))
            fps.add(f)
    as_long = lambda x: x - (1 << 64) if x >> 63 else x
    fps = sorted({as_long(f & (1 << 64) - 1) for f in fps})
    links = simhash.near_links(spark.createDataFrame([(f,) for f in fps], "fp long"), 2)
    got = {r["node"]: r["root"] for r in components(links).collect()}
    want = brute_components(fps, lambda a, b: ((a ^ b) & (1 << 64) - 1).bit_count() <= 2)
    assert {f: got.get(f, f) for f in fps} == want


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(900, 901), (5, 5)], "a long, b long")
    got = {r["node"]: r["root"] for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(301)}, 900: 900, 901: 900}


def test_suffix_sample_is_bounded_without_ids(spark):
    """Documents without id are sampled by their text, not all taken."""
    df = documents(spark, [f"text {i}" for i in range(1000)], [None] * 1000)
    assert 10 <= suffix_dedup.sampled(df, 1000, 50).count() <= 150


def test_multikey_order_is_the_order_of_the_bytes():
    import numpy as np
    rnd = random.Random(1)
    for _ in range(150):
        raw = bytes(rnd.choice(b"ab\x00\xff") for _ in range(rnd.randint(1, 120))) * rnd.randint(1, 3)
        for window in (1, 3, 7, 8, 9, 16, 20):
            if len(raw) >= window:
                begin = np.array(rnd.sample(range(len(raw) - window + 1), rnd.randint(1, len(raw) - window + 1)))
                order, same = suffix_dedup.multikey_order(suffix_dedup.leading_words(np.frombuffer(raw, np.uint8)), begin, window)
                strings = [raw[begin[i]:begin[i] + window] for i in order]
                assert strings == sorted(strings)
                assert same.tolist() == [False, *(a == b for a, b in zip(strings, strings[1:]))]


def test_equal_windows_never_lie_on_two_sides_of_a_splitter(spark):
    """Records with one anchor and one window go to one range, whatever the splitters: nothing is tied across a boundary."""
    rnd = random.Random(2)
    texts = [" ".join(rnd.choice(["aa", "ab", "ba", "bb"]) for _ in range(120)) for _ in range(40)]
    docs = documents(spark, texts)
    kind = suffix_dedup.kind_of(40)
    deal = suffix_dedup.sampled_splitters(docs, kind, len(texts))(7)
    raws = [t.encode() for t in texts]
    units, off, raw = kind.read(raws + raws[:20])
    from pickwise.llm.passages import runs
    shard_of, shards = {}, set()
    for first, last, at, h in zip(*(x.tolist() for x in runs(kind, units, off))):
        content, place = kind.content(raw, first, last, at)
        shard = deal(h, True, content, place)
        shards.add(shard)
        for w in range(first, last + 1):
            assert shard_of.setdefault(raw[w:w + 40], shard) == shard
    assert len(shards) > 1

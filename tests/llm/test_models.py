"""Operators 1, 8 and 9: held-out accuracy, exact round trips, brute force."""

import math
import random
import zlib
from collections import Counter

import pytest

from pickwise.llm import lattice_lm, toxicity
from pickwise.llm import sentencepiece_codec as codec
from pickwise.llm.queries import PIECES
from tests.llm.tables import SCHEMA, documents, odd_documents, rows


@pytest.fixture(scope="module")
def vocabulary():
    return codec.read_vocabulary(PIECES)


def odd_strings(n=300):
    rnd = random.Random(1)
    parts = ["the ", "  ", "▁", "a", "é", "\n", "😀", "ation", " wor", "ñ", "\x00", "ing", "zz", "q", " ", "and"]
    return ["", " ", "▁", "\n", "  a", "a  ", "abc" * 2000, *(
        "".join(rnd.choice(parts if k % 3 else parts[2:]) for _ in range(rnd.randint(0, 60))) for k in range(n))]


def brute_path(stream, v):
    best = [(0.0, 0, [])]
    for e in range(1, len(stream) + 1):
        top = None
        for s in range(max(0, e - v.longest), e):
            piece = v.pieces.get(stream[s:e])
            if piece and (top is None or best[s][0] + piece[1] > top[0]):
                top = (best[s][0] + piece[1], s, [piece[0]])
        if stream[e - 1] not in v.pieces and (top is None or best[e - 1][0] + v.byte_score > top[0]):
            top = (best[e - 1][0] + v.byte_score, e - 1, codec.byte_fallback(stream[e - 1], v))
        best.append(top)
    out, e = [], len(stream)
    while e:
        out, e = best[e][2] + out, best[e][1]
    return out


def test_streaming_viterbi_is_the_best_path(vocabulary):
    import numpy as np
    encoder = codec.Encoder(vocabulary)
    for text in odd_strings():
        want = brute_path(codec.marked(text), vocabulary) if text else []
        assert np.frombuffer(encoder.encode(text), "<i4").tolist() == want
        for stream in (codec.marked(text), [codec.marked(text)]):  # by characters, or as one
            assert not text or [i for run in codec.viterbi(stream, vocabulary) for i in run] == want
        assert codec.decode(want, vocabulary) == text


def test_viterbi_commits_in_a_bounded_window(vocabulary):
    runs = list(codec.viterbi(iter("abcdefgh " * 400), vocabulary))
    assert len(runs) > 50 and max(map(len, runs)) < 4 * vocabulary.longest


def test_pieces_over_blanks_are_one_stream():
    pieces = {"▁": (0, -1.0), "a": (1, -1.0), "b": (2, -1.0), "a▁b": (3, -0.5)}
    v = codec.Vocabulary(pieces, list(range(10, 266)), [b" ", b"a", b"b", b"a b", *[b""] * 6, *[bytes([i]) for i in range(256)]], -20.0)
    import numpy as np
    assert v.crossing and np.frombuffer(codec.encode("a b a", v), "<i4").tolist() == [0, 3, 0, 1]
    assert codec.decode([0, 3, 0, 1], v) == "a b a"


@pytest.mark.parametrize("clash", [True, False])
def test_codec_round_trip(spark, clash):
    df, data = odd_documents(spark, clash)
    back = codec.decode_ids(codec.encode_texts(df, PIECES), PIECES)
    assert rows(back, "doc_id", "decoded") == sorted([(d, t or "") for d, t in data], key=repr)
    assert rows(codec.encode_texts(df, PIECES, decoded=True)) == rows(back)
    assert codec.encode_texts(spark.createDataFrame([], SCHEMA), PIECES).collect() == []


def lattice():
    names = ["▁", "a", "b", "ab", "▁a", "ba", "bab"]
    return lattice_lm.Lattice({n: math.log(0.1) for n in names}, [math.log(0.001)] * 256, math.log(0.044))


def brute_marginal(stream, lat):
    def ways(i):
        if i == len(stream):
            return 1.0
        total = math.exp(lattice_lm.written_in_bytes(stream[i], lat)) * ways(i + 1)
        return total + sum(math.exp(lat.log_p[stream[i:e]]) * ways(e)
                           for e in range(i + 1, len(stream) + 1) if stream[i:e] in lat.log_p)
    return math.log(ways(0))


def test_marginals_sum_all_segmentations():
    lat = lattice()
    rnd = random.Random(2)
    words = ["", "é", "▁", "😀b", *("".join(rnd.choice("abc▁") for _ in range(rnd.randint(1, 10))) for _ in range(60))]
    together = lattice_lm.Edges(lat).log_marginals([*words, "ab" * 100])
    for w, x in zip(words, together):
        want = brute_marginal(lattice_lm.stream_of(w), lat)
        assert abs(lattice_lm.log_marginal(w, lat) - want) < 1e-9 and abs(x - want) < 1e-9
    assert together[-1] == lattice_lm.log_marginal("ab" * 100, lat)


def test_expected_pieces_cover_every_character():
    import numpy as np
    edges = lattice_lm.Edges(lattice())
    words, pieces, chars = ["abba", "ba", "c", "é▁", "ab" * 100], np.zeros(7), {}
    edges.expected(words, np.array([1.0, 2.0, 3.0, 1.0, 1.0]), pieces, chars)
    held = sum(len(n) * c for n, c in zip(edges.names, pieces)) + sum(chars.values())
    assert abs(held - (5 + 2 * 3 + 3 * 2 + 3 + 201)) < 1e-6  # one blank to a word, however long


def brute_expected(stream, lat):
    """{piece or code point: expected number} over every segmentation."""
    found, total = Counter(), 0.0

    def walk(i, p, used):
        nonlocal total
        if i == len(stream):
            total += p
            for u in used:
                found[u] += p
            return
        walk(i + 1, p * math.exp(lattice_lm.written_in_bytes(stream[i], lat)), [*used, ord(stream[i])])
        for e in range(i + 1, len(stream) + 1):
            if stream[i:e] in lat.log_p:
                walk(e, p * math.exp(lat.log_p[stream[i:e]]), [*used, stream[i:e]])
    walk(0, 1.0, [])
    return {u: x / total for u, x in found.items()}


@pytest.mark.parametrize("long, window", [(64, 1 << 16), (0, 1 << 16), (0, 1), (0, 3), (4, 2)])
def test_expected_pieces_are_those_of_all_segmentations(monkeypatch, long, window):
    """Forward and backward sums, many words at once and one long word by windows, against enumeration."""
    import numpy as np
    monkeypatch.setattr(lattice_lm, "LONG", long)
    whole = lattice_lm.Edges.expected_in
    monkeypatch.setattr(lattice_lm.Edges, "expected_in", lambda self, *a: whole(self, *a, window=window))
    lat = lattice()
    rnd = random.Random(8)
    words = ["", "é", "▁", "abab", *("".join(rnd.choice("abc▁") for _ in range(rnd.randint(1, 9))) for _ in range(30))]
    weights = np.array([rnd.randint(1, 4) for _ in words])
    edges, chars = lattice_lm.Edges(lat), {}
    pieces = np.zeros(len(edges.names))
    edges.expected(words, weights, pieces, chars)
    want = Counter()
    for w, c in zip(words, weights.tolist()):
        for u, x in brute_expected(lattice_lm.stream_of(w), lat).items():
            want[u] += c * x
    got = {**{n: x for n, x in zip(edges.names, pieces.tolist()) if x}, **chars}
    assert all(abs(got.get(u, 0.0) - want.get(u, 0.0)) < 1e-9 for u in got.keys() | want.keys())


def test_a_word_longer_than_windows_is_learned_whole():
    """160 letters and 114 without blanks: one blank each, the same sums for any window."""
    import numpy as np
    for word in ("ab" * 80, "中文" * 57):
        found = []
        for window in (1 << 16, 50, 7):
            edges, chars = lattice_lm.Edges(lattice()), {}
            pieces = np.zeros(len(edges.names))
            edges.expected_in(lattice_lm.stream_of(word), 1.0, pieces, chars, window=window)
            blanks = sum(n.count("▁") * c for n, c in zip(edges.names, pieces)) + chars.get(ord("▁"), 0.0)
            assert abs(blanks - 1.0) < 1e-9
            found.append((pieces, chars))
        for pieces, chars in found[1:]:
            assert np.allclose(pieces, found[0][0]) and chars.keys() == found[0][1].keys()


def test_lm_scores(spark):
    df, data = odd_documents(spark, clash=True)
    split = [(d, (t or "").encode().lower().split()) for d, t in data]
    out = lambda d: d is not None and zlib.crc32(str(d).encode()) % 5 == 1
    counts, ends = Counter(), 0
    for d, ws in split:
        if not out(d):
            counts.update(ws)
            ends += 1
    n, v = sum(counts.values()) + ends, len(counts) + 1
    logp = lambda c: math.log10((c + 0.5) / (n + 0.5 * (v + 1)))
    want = {}
    for d, ws in split:
        want.setdefault(d, []).append((out(d), len(ws) + 1, sum(w in counts for w in ws) + 1, n,
                                       round(sum(logp(counts[w]) for w in ws) + logp(ends), 6)))
    got = {}
    scores = lattice_lm.lm_scores(df, PIECES, block_rows=20).collect()
    for r in scores:
        assert math.isfinite(r["score"]) and r["score"] < 0
        got.setdefault(r["doc_id"], []).append((*r[1:5], round(r["base_score"], 6)))
    assert {d: sorted(x) for d, x in got.items()} == {d: sorted(x) for d, x in want.items()}
    # the score of a text is its words' and the end's, whatever the blocks
    again = {tuple(r[:4]): r["score"] for r in lattice_lm.lm_scores(df, PIECES, block_rows=1000).collect()}
    assert all(abs(again[tuple(r[:4])] - r["score"]) < 1e-6 for r in scores if r["doc_id"] not in (None, 2, 7))


def test_learning_raises_the_likelihood(spark):
    text = "zxqv wvyk " * 40
    learn = [i for i in range(60) if zlib.crc32(str(i).encode()) % 5 != 1]
    held = next(i for i in range(60, 99) if zlib.crc32(str(i).encode()) % 5 == 1)
    known = lattice_lm.lm_scores(documents(spark, [text] * len(learn) + [text], [*learn, held]), PIECES)
    blank = lattice_lm.lm_scores(documents(spark, ["la le"] * len(learn) + [text], [*learn, held]), PIECES)
    score = lambda df: df.filter(f"doc_id = {held}").first()["score"]
    assert score(known) > score(blank) + 10
    assert lattice_lm.lm_scores(spark.createDataFrame([], SCHEMA), PIECES).collect() == []
    only = lattice_lm.lm_scores(documents(spark, ["a b"], [held]), PIECES).first()
    assert only["train_tokens"] == 0 and only["n_known"] == 0


def labelled(spark, n=600, seed=3, marked=0.7):
    """``marked`` of the toxic texts carry marker words; one group is named mostly in toxic ones."""
    rnd = random.Random(seed)
    common = [f"word{i}" for i in range(60)]
    texts, toxic = [], []
    for _ in range(n):
        bad = rnd.random() < 0.3
        ws = [rnd.choice(common) for _ in range(rnd.randint(10, 40))]
        if bad:
            ws += [rnd.choice(["vileword", "slurterm"]) for _ in range(2)] if rnd.random() < marked else []
        if rnd.random() < (0.8 if bad else 0.1):
            ws.insert(rnd.randrange(len(ws)), "muslim")
        texts.append(" ".join(ws))
        toxic.append(int(bad))
    docs = documents(spark, texts, clash=True)
    return docs, spark.createDataFrame(list(enumerate(toxic)) + [(None, 1), (3, None)], "doc_id long, toxic int"), toxic


def test_counterfactual_penalty_spares_mentions(spark):
    docs, labels, _ = labelled(spark)
    probe = documents(spark, ["word1 word2 muslim word3", "word1 word2 word3", "word1 vileword word3", None, ""])
    fair = {r[0]: r[1] for r in toxicity.fit(docs, labels, fairness=50.0).score(probe).collect()}
    plain = {r[0]: r[1] for r in toxicity.fit(docs, labels, fairness=0.0).score(probe).collect()}
    odds = lambda s: math.log(s / (1 - s))
    raised = odds(plain[0]) - odds(plain[1])
    assert raised > 2 and odds(fair[0]) - odds(fair[1]) < 0.4 * raised
    assert fair[2] > 0.7 and 0 <= fair[3] == fair[4] <= 1


def test_toxicity_held_out(spark):
    docs, labels, toxic = labelled(spark, marked=1.0)
    got = toxicity.toxicity(docs, labels).collect()
    assert len(got) == len(toxic)
    for r in got:
        assert r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1)
        assert r["predicted"] == int(r["score"] >= 0.7) and 0 <= r["score"] <= 1
    held = [(r["score"], toxic[r["doc_id"]]) for r in got if r["held_out"]]
    pairs = [(a > b) + 0.5 * (a == b) for a, x in held if x for b, y in held if not y]
    assert sum(pairs) / len(pairs) > 0.9


def test_toxicity_without_labels(spark):
    docs, labels, _ = labelled(spark, 20)
    assert {r["score"] for r in toxicity.toxicity(docs, labels.limit(0)).collect()} == {0.5}
    assert toxicity.toxicity(docs.limit(0), labels).collect() == []


def test_minimise_finds_the_least_value():
    import numpy as np
    a = np.array([3.0, -1.0, 2.0])
    found = toxicity.minimise(lambda w: (float(np.sum((w - a) ** 4 + (w - a) ** 2)), 4 * (w - a) ** 3 + 2 * (w - a)), np.zeros(3), 50, tol=1e-8)
    assert np.allclose(found, a, atol=1e-3)

"""Operators 11 to 13 against brute force."""

import io
import json
import math
import os
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from conftest import SF001
from pickwise.llm import hard_negatives, periodic, queries, token_blocks
from pickwise.session import checkpoint_dir
from tests.llm.tables import SCHEMA, documents, odd_documents, rows

BPE = public_tokenizers.path("byte_bpe_50k.json")


# ---------------------------------------------------------------- 11

@pytest.mark.parametrize("n", [1, 7, 1024, 65536])
@pytest.mark.parametrize("most", [1, 2, 50_000, 2**32])
def test_blocks_round_trip(n, most):
    ids = np.random.default_rng(n + most).integers(0, most, n, dtype=np.uint64).astype(np.uint32)
    for percentile in (0.001, 50, 98, 100):
        assert (token_blocks.unpack(token_blocks.pack(ids, percentile)) == ids).all()
    ids[n // 2] = 2**32 - 1  # one id far off is an exception
    assert (token_blocks.unpack(token_blocks.pack(ids)) == ids).all()
    if n == 1024 and most == 2:
        assert len(token_blocks.pack(ids)) < n // 8 + 32


def test_file_gives_any_stretch():
    rnd = np.random.default_rng(3)
    out, docs = io.BytesIO(), [rnd.integers(0, 50_257, n).astype(np.uint32) for n in (0, 5, 70, 1, 0, 200, 64)]
    file = token_blocks.FileWriter(out, block=64)
    file.add([3, None, 5], np.array([0, 5, 70]), np.concatenate(docs[:3]))
    file.add([8, 9, 9, 12], np.array([1, 0, 200, 64]), np.concatenate(docs[3:]))
    every = np.concatenate(docs)
    assert file.close() == (7, len(every))
    reader = token_blocks.FileReader(out, out.tell())
    for a in range(0, len(every), 13):
        for b in range(a, len(every) + 1, 17):
            assert (reader.ids(a, b) == every[a:b]).all()
    with pytest.raises(IndexError):
        reader.ids(0, len(every) + 1)
    names, missing, sizes = reader.documents()
    assert names[~missing].tolist() == [3, 5, 8, 9, 9, 12] and missing.tolist() == [False, True] + [False] * 5
    assert sizes.tolist() == [0, 5, 70, 1, 0, 200, 64]


def test_encoder_is_the_library():
    library = Tokenizer.from_file(BPE)
    library.encode_special_tokens = True
    rnd = random.Random(7)
    bits = [" ", "  ", "\n", "\n\n", "\t", "\xa0", " ", "\x1c", "the", "The", "été", "don't", "'s", "!!", "...", "a.", "42", "٣", "中文",
            "🙂", "<|endoftext|>", "_", "\r\n", "x" * 50, "é,", "Wort;", "\x00"]
    texts = ["", " ", "\n", " \n ", "a", "a ", " a", "a\n"] + ["".join(rnd.choice(bits) for _ in range(rnd.randint(1, 30))) for _ in range(800)]
    own = token_blocks.Encoder(BPE, keep=50)  # generations change all the time
    for step in (1, 9, len(texts)):
        for k in range(0, len(texts), step):
            for text, ids in zip(texts[k:k + step], own.encode(texts[k:k + step])):
                assert np.frombuffer(ids, "<u4").tolist() == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_encoder_gives_a_new_word_to_the_model_alone(monkeypatch):
    """A result of the whole library costs several times what the model takes for a word."""
    text = "Der Wort, été,\nWort été!! a1. Wort,\nÉté; x-\nDer"
    library = Tokenizer.from_file(BPE)
    own, calls = token_blocks.Encoder(BPE), []
    whole = own.whole
    monkeypatch.setattr(own, "whole", lambda texts: calls.extend(texts) or whole(texts))
    (ids,) = own.encode([text])
    assert np.frombuffer(ids, "<u4").tolist() == library.encode(text).ids
    assert not hasattr(own, "ids") and set(calls) == {" a1", "\n"}  # what is no word of letters only


def expected_tokens(data):
    library = Tokenizer.from_file(BPE)
    library.encode_special_tokens = True
    out, start = [], 0
    for d, ids in sorted(((d, library.encode(t or "", add_special_tokens=False).ids + [0]) for d, t in data),
                         key=lambda r: (r[0] is None, r[0] or 0)):
        out.append((d, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
    return out


@pytest.mark.parametrize("clash", [False, True])
def test_token_files(spark, clash):
    df, data = odd_documents(spark, clash=clash)
    got = sorted((tuple(r) for r in token_blocks.token_file_digests(df, BPE).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == [d for d, _, _ in expected_tokens(data)]  # ids ascend, rows without come last
    assert sorted(((d, n, c) for d, _, n, c in got), key=repr) == sorted(expected_tokens(data), key=repr)
    assert [r[1] for r in got] == np.concatenate(([0], np.cumsum([r[2] for r in got])[:-1])).tolist()


def test_token_files_are_one_stream_whatever_the_files(spark, monkeypatch):
    texts = [f"w{i} and some words" for i in range(60)] + ["same"] * 60
    df = documents(spark, texts, list(range(59, -1, -1)) + [None] * 60)
    streams = []
    for least in (1 << 30, 64):
        monkeypatch.setattr(token_blocks, "LEAST_BYTES", least)
        path = f"{checkpoint_dir(spark)}/stream-{least}-{clash_free()}"
        token_blocks.write_tokens(df, path, BPE, block=16)
        files = token_blocks.manifest(path)
        streams.append((len(files), token_blocks.read_ids(path, 0, 1 << 20).tolist()))
        assert token_blocks.read_ids(path, 33, 50).tolist() == streams[-1][1][33:83]
        assert max(f["docs"] for f in files) < 120 or len(files) == 1
        with pytest.raises(Exception):  # a folder that holds files is not written over
            token_blocks.write_tokens(df, path, BPE)
    assert streams[0][0] == 1 and streams[1][0] > 4 and streams[0][1] == streams[1][1]


def clash_free():
    import uuid
    return uuid.uuid4().hex


def test_token_files_ignore_what_no_commit_names(spark):
    path = f"{checkpoint_dir(spark)}/orphan-{clash_free()}"
    token_blocks.write_tokens(documents(spark, ["a b", "c"]), path, BPE)
    local = path.removeprefix("file:")
    open(f"{local}/part-000000-lost.ids", "wb").write(b"half a file")  # of an attempt that did not finish
    assert token_blocks.read_tokens(spark, path).count() == 2
    assert set(json.load(open(f"{local}/{token_blocks.MANIFEST}"))) == {"format", "files"}
    assert len(os.listdir(local)) > len(token_blocks.manifest(path)) + 1


def test_token_files_empty(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert token_blocks.token_file_digests(empty, BPE).collect() == []
    only = token_blocks.token_file_digests(documents(spark, [None, ""]), BPE)
    assert [(r.doc_id, r.start, r.n_tokens) for r in only.orderBy("start").collect()] == [(0, 0, 1), (1, 1, 1)]


# ---------------------------------------------------------------- 12

def brute_runs(words, least):
    """Every stretch with period q that no neighbour extends; of equal stretches the least q."""
    found = {}
    for q in range(1, len(words) // 2 + 1):
        i = 0
        while i + q < len(words):
            if words[i] != words[i + q]:
                i += 1
                continue
            j = i
            while j + q < len(words) and words[j] == words[j + q]:
                j += 1
            if j - i + q >= max(least, 2 * q):
                found.setdefault((i, j - i + q), q)
            i = j
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


def brute_collapsed(words, runs):
    gone = {i for s, n, q in runs for i in range(s + q, s + n)}
    return " ".join(w for i, w in enumerate(words) if i not in gone)


def test_runs_of_random_words():
    rnd = random.Random(4)
    for _ in range(400):
        texts = []
        for _ in range(rnd.randint(1, 5)):
            k, words = rnd.randint(1, 4), []
            for _ in range(rnd.randint(0, 6)):
                unit = [b"%d" % rnd.randint(0, k) for _ in range(rnd.randint(1, 9))]
                words += (unit * rnd.randint(1, 6))[:rnd.randint(1, 40)]
            texts.append(words)
        for least in (2, 3, 7, 12):
            assert periodic.runs_of(texts, least) == [brute_runs(t, least) for t in texts]


def test_runs_of_long_texts_in_reasonable_time():
    n = 60_000
    assert periodic.runs_of([[b"x"] * n], 12) == [[(0, n, 1)]]
    assert periodic.runs_of([[b"a", b"b", b"c"] * (n // 3)], 12) == [[(0, n, 3)]]
    lines = [w for i in range(n // 8) for w in [b"%d" % i] + [b"l%d" % k for k in range(7)]]
    assert periodic.runs_of([lines], 12) == [[]]  # the same line again and again, but nothing periodic
    assert len(list(periodic.groups([[b"x"] * n] * 3, most=n))) == 3


@pytest.mark.parametrize("clash", [False, True])
def test_periodic_runs_rows(spark, clash):
    df, data = odd_documents(spark, clash=clash)
    extra = ["a b c " * 9, "z " + "p q " * 6 + "p p p p p p p p p p p p p"]
    df = df.union(documents(spark, extra, [900, 901], clash=clash))
    got = [(r.doc_id, r.n_words, tuple(tuple(x) for x in r.runs), r.collapsed) for r in periodic.periodic_runs(df).collect()]
    want = []
    for d, t in data + list(zip([900, 901], extra)):
        words = [w.decode() for w in (t or "").encode().split()]
        runs = brute_runs(words, 12)
        want.append((d, len(words), tuple(runs), brute_collapsed(words, runs)))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    assert periodic.periodic_runs(spark.createDataFrame([], SCHEMA)).collect() == []


def test_planted_runs_are_as_stated(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet").union(documents(spark, [" \t", "one", None], [10**6 + 2, 10**6 + 5, None]))
    got = {r.doc_id: r.text for r in queries.with_planted_runs(docs).collect()}
    changed = 0
    for r in docs.collect():
        words = (r.text or "").encode().split()
        n, h = len(words), zlib.crc32(str(r.doc_id).encode())
        if r.doc_id is not None and h % 10 == 0 and n:
            a = (h // 10) % n
            p = 1 + (n - a) // (3 + (h // 10) % 8)
            words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
            changed += 1
        assert (got[r.doc_id] or "").encode().split() == words
    assert changed > 10 and len(got) == docs.count()


# ---------------------------------------------------------------- 13

def brute_mine(vectors, k=5, m=10, every=100):
    """``vectors``: (id, label, components) that take part."""
    rows = [(i, (lab + 1) % 10 if i % 7 == 0 else lab, [math.floor(256 * x) for x in v]) for i, lab, v in vectors]
    out = []
    for a, label, v in rows:
        if a % every:
            continue
        scored = sorted((-sum(x * y for x, y in zip(v, w)), i, lab) for i, lab, w in rows if i != a)
        for s, p, _ in [r for r in scored if r[2] == label][:k]:
            hard = [(i, -t) for t, i, lab in scored if lab != label and 30 * -s <= 100 * -t <= 90 * -s][:m]
            out += [(a, p, rank + 1, i, -s, t) for rank, (i, t) in enumerate(hard)]
    return sorted(out)


VECTORS = "vec_id long, embedding array<double>, label int, row long, l int, x string, cb int, ids string"


def table(spark, vectors):
    return spark.createDataFrame([(i, v, lab, 1, 2, "x", 3, "y") for i, lab, v in vectors], VECTORS)


@pytest.mark.parametrize("block, anchors", [(8192, 256), (16, 3)])
def test_hard_negatives(spark, block, anchors):
    rnd = random.Random(block)
    vectors = [(i, i % 3 if i % 2 else 4, [rnd.choice([0.0, rnd.gauss(0.2, 1), 0.5]) for _ in range(11)]) for i in range(-40, 260)]
    vectors += [(i, 4, vectors[50][2]) for i in range(300, 340)]  # ties, and a label with half of all rows
    vectors += [(400, 7, [0.0] * 11), (500, 0, [1.0, 2.0]), (600, 1, []), (700, 9, [0.25] * 20), (701, 3, [0.5])]
    bad = [(800, 1, None), (900, None, [1.0] * 11), (1000, 1, [1.0, None]), (1100, 2, [math.nan]), (1200, 2, [math.inf, 1.0]), (None, 1, [1.0])]
    got = hard_negatives.hard_negatives(table(spark, vectors + bad), block=block, anchor_block=anchors)
    want = brute_mine(vectors)
    assert rows(got.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")) == sorted(want, key=repr)
    assert len(want) > 100


def test_hard_negatives_few_and_far(spark):
    assert hard_negatives.hard_negatives(table(spark, [])).collect() == []
    assert hard_negatives.hard_negatives(table(spark, [(100, 1, [1.0])])).collect() == []
    twice = [(100, 1, [1.0]), (5, 1, [1.0]), (5, 1, [1.0]), (6, 2, [0.5]), (6, 2, [0.5])]
    got = rows(hard_negatives.hard_negatives(table(spark, twice)))
    assert got == sorted([(100, 5, r, 6, 65536, 32768) for r in (1, 2)] * 2, key=repr)  # rows that share an id are rows of their own
    with pytest.raises(ValueError):
        hard_negatives.hard_negatives(table(spark, [(100, 1, [1e17, 1.0]), (5, 1, [1e17, 2.0])]))
    big = [(100, 1, [5e6, -5e6]), (5, 1, [5e6, -4e6]), (6, 2, [3e6, -2e6])]
    assert rows(hard_negatives.hard_negatives(table(spark, big))) == sorted(brute_mine(big), key=repr)


def test_hard_negatives_do_not_pass_through_the_driver(spark, monkeypatch):
    """No join is a broadcast, and groups of blocks share a copy of the anchors."""
    monkeypatch.setattr(hard_negatives, "TOGETHER", 2)
    rnd = random.Random(2)
    vectors = [(i, i % 3, [rnd.gauss(0.2, 1) for _ in range(5)]) for i in range(400)]
    got = hard_negatives.hard_negatives(table(spark, vectors), block=1, anchor_block=2)
    assert rows(got) == sorted(brute_mine(vectors), key=repr)
    assert "Broadcast" not in got._jdf.queryExecution().executedPlan().toString()


def test_scores_are_products():
    rnd = np.random.default_rng(5)
    for low, high in ((0, 0), (0, 1), (-1, 0), (-300, 255), (-2**30, 2**30)):
        c, a = rnd.integers(low, high + 1, (40, 24)), rnd.integers(low, high + 1, (9, 16))
        planes = hard_negatives.planes_needed(low, high)
        got = hard_negatives.scores(hard_negatives.bit_planes(c, planes), hard_negatives.subset_sums(a))
        assert (got == c[:, :16] @ a.T).all()


def test_registered_queries_give_the_stated_columns(spark):
    names = {"op11_token_blocks": ["doc_id", "start", "n_tokens", "ids_crc32"],
             "op12_periodic_runs": ["doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"],
             "op13_hard_negatives": ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]}
    for name, columns in names.items():
        df = queries.QUERIES[name](spark, SF001)
        assert df.columns == columns
        if name != "op13_hard_negatives":
            assert df.count() == spark.read.parquet(f"{SF001}/documents.parquet").count()
            assert df.where(F.col("doc_id").isNull()).count() == 0

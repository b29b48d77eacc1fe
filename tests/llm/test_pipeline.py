"""The pipeline's stages, one by one and together."""

import random

import pytest

import corpus_pipeline as pipe
from pickwise.llm import mixing, simhash, toxicity
from tests.llm.tables import SCHEMA, documents, odd_documents, rows

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def sf_dir(spark, tmp_path_factory):
    """A corpus with toxic texts, copies and near copies, as a folder of tables."""
    rnd = random.Random(9)
    common = [f"word{i}" for i in range(400)]
    texts, toxic = [], []
    for i in range(300):
        ws = [rnd.choice(common) for _ in range(rnd.randint(100, 300))]
        bad = i % 4 == 0
        texts.append(" ".join(ws + ["vileword", "slurterm"] * bad))
        toxic.append(int(bad))
    texts += [texts[i] for i in (1, 2, 2, 3)] + [texts[5][:-1]]
    toxic += [0] * 5
    path = str(tmp_path_factory.mktemp("tables"))
    documents(spark, texts).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, t) for i, t in enumerate(toxic)], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_names_and_order():
    assert [name for name, _ in pipe.STAGES] == ["toxicity", "exact dedup", "SimHash near-dedup", "mixing", "SentencePiece"]


def test_toxic_documents_go(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    left = pipe.drop_toxic(spark, docs, sf_dir)
    assert left.columns == COLUMNS
    texts = [r["text"] for r in left.collect()]
    assert not any("vileword" in t for t in texts) and len(texts) > 220
    model = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    assert len(texts) == model.score(docs).filter("score < 0.7").count()


@pytest.mark.parametrize("clash", [True, False])
def test_copies_go(spark, sf_dir, clash):
    df, data = odd_documents(spark, clash)
    left = pipe.drop_copies(spark, df, sf_dir)
    assert left.columns == df.columns
    largest = {}
    for d, t in data:
        old = largest.get(t or "", None)
        largest[t or ""] = max([x for x in (old, d) if x is not None], default=None)
    assert sorted((r["doc_id"], r["text"] or "") for r in left.collect()) == sorted((d, t) for t, d in largest.items())


@pytest.mark.parametrize("clash", [True, False])
def test_near_copies_go(spark, sf_dir, clash):
    df, _ = odd_documents(spark, clash)
    left = pipe.drop_near_copies(spark, df, sf_dir)
    groups = simhash.simhash_groups(df)
    assert left.columns == df.columns
    assert left.count() == groups.select("component_id").distinct().count()
    assert {r[0] for r in left.select("doc_id").collect()} == {r[0] for r in groups.select("component_id").distinct().collect()}


def test_mixed_rows_are_the_mix(spark, sf_dir):
    df, _ = odd_documents(spark, True)
    left = pipe.mix_sources(spark, df, sf_dir)
    assert left.columns == df.columns
    words = sum(len((r["text"] or "").encode().split()) for r in left.collect())
    assert words == sum(r["taken"] for r in mixing.mix(df).collect())


@pytest.mark.parametrize("name,stage", pipe.STAGES)
def test_stages_on_nothing(spark, sf_dir, name, stage):
    assert stage(spark, spark.createDataFrame([], SCHEMA), sf_dir).collect() == []


def test_whole_pipeline(spark, sf_dir):
    out = pipe.run(spark, sf_dir).collect()
    assert out and all(r["exact"] and r["n_ids"] == len(r["ids"]) for r in out)
    ids = {r["doc_id"] for r in out}
    assert not ids & {1, 2, 3, 301} and len(ids & {5, 304}) <= 1  # the copies with smaller ids, one of near copies
    assert not ids & {i for i in range(300) if i % 4 == 0}

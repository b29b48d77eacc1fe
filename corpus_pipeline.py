"""The corpus pipeline: documents without the toxic ones, without exact and near copies,
mixed to target weights, as token ids.  Each stage calls one operator of pickwise.llm.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pickwise.llm import exact_dedup as exact
from pickwise.llm import mixing, sentencepiece_codec, simhash, toxicity
from pickwise.llm.common import written
from pickwise.sources import load

#: the public vocabulary of the last stage; never copied
PIECES = "/opt/tokenizers/piece_bpe_32k.model"


def rows_of(docs: DataFrame, chosen: DataFrame, text_key: Column) -> DataFrame:
    """The rows of ``docs`` whose id and text key are in ``chosen`` (id, key), one row for each:
    of rows that repeat both, the least by all columns."""
    keyed = docs.select(F.struct(*[F.col(c) for c in docs.columns]).alias("__row"),
                        F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("__id"), text_key.alias("__key"))
    chosen = chosen.toDF("__id", "__key").withColumn("__id", F.coalesce(F.col("__id").cast("string"), F.lit("-")))
    return (keyed.join(chosen, ["__id", "__key"], "left_semi").groupBy("__id", "__key")
            .agg(F.min("__row").alias("__row")).select("__row.*"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity classifier scores under 0.7."""
    model = toxicity.fit(docs, load(spark, sf_dir, "labels"))
    scored = model.score(docs.withColumnRenamed("score", "__score") if "score" in docs.columns else docs,
                         keep=[F.col(c if c != "score" else "__score") for c in docs.columns])
    return scored.filter("score < 0.7").drop("score").toDF(*docs.columns)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    kept = exact.exact_dedup(docs, keep="largest").filter("kept").select("doc_id", "text_sha256")
    return rows_of(docs, kept, F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of fingerprints within two bits: the smallest doc_id."""
    kept = simhash.simhash_groups(docs, shingle_words=3, max_bits=2).filter("stays").select("doc_id", "text_hash")
    return rows_of(docs, kept, F.xxhash64(F.coalesce(F.col("text"), F.lit(""))))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at weights 5, 2, 1 in turn; a document may stand up to three times, one per source is cut."""
    return mixing.apply_mix(docs, weights=(5, 2, 1), limit=3)


def to_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every text, and whether they decode to it."""
    marked = docs.withColumn("__sha", F.sha2(F.coalesce(F.col("text"), F.lit("")), 256))
    return (sentencepiece_codec.encode_texts(marked, PIECES, keep=("doc_id", "lang", "source", "__sha"), decoded=True)
            .select("doc_id", "lang", "source", "ids", F.size("ids").cast("long").alias("n_ids"),
                    (F.sha2("decoded", 256) == F.col("__sha")).alias("exact")))


STAGES = [("toxicity", drop_toxic), ("exact dedup", drop_copies), ("SimHash near-dedup", drop_near_copies),
          ("mixing", mix_sources), ("SentencePiece", to_ids)]

#: a classifier and a 64-bit hash of shingles aren't SQL: the stages are tested against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each one's result written before the next reads it."""
    docs = load(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = written(docs)
    return docs

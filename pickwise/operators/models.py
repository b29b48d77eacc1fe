"""Model-based operators on pyspark.ml: ALS (C10-C12), frequent sets (C14), a
click/purchase ranker (C16), topics (T10) and item vectors (T11).

Models are fitted on DataFrames and return DataFrames; fits are eager (they
run Spark jobs), results are lazy.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions.scores import m6, r6
from pickwise.operators.ordering import global_rank
from pickwise.operators.pairs import DEFAULT_CHUNK, co_pairs
from pickwise.operators.rerank import exclude_seen, top_n
from pickwise.operators.serving import best_products
from pickwise.operators.skew import loose
from pickwise.operators.vectors import nearest_ivf
from pickwise.session import checkpoint_dir

INT_MAX = 2**31 - 1


@dataclass(frozen=True)
class Factors:
    """A fitted ALS model with the ids it was fitted on: ``users`` and ``items`` map the model's own
    whole numbers (``dense``) to ids; None where the ids themselves are the model's numbers."""

    model: object
    users: DataFrame | None
    items: DataFrame | None

    def _named(self, factors: DataFrame, names: DataFrame | None, id_col: str) -> DataFrame:
        f = factors.select(F.col("id").alias("dense"), F.col("features").alias("v"))
        if names is None:
            return f.select(F.col("dense").cast("bigint").alias(id_col), "v")
        return f.join(loose(names), "dense").select(F.col("id").alias(id_col), "v")

    @property
    def user_factors(self) -> DataFrame:
        """(user_id, v)"""
        return self._named(self.model.userFactors, self.users, "user_id")

    @property
    def item_factors(self) -> DataFrame:
        """(item_id, v)"""
        return self._named(self.model.itemFactors, self.items, "item_id")


def _dense(df: DataFrame, col: str) -> DataFrame | None:
    """(id, dense): the ids of a column numbered from 0 in their order where some are no whole number
    that ALS takes (0..2^31-1); None where all are."""
    lo, hi = df.agg(F.min(col), F.max(col)).first()
    if lo is None or (lo >= 0 and hi <= INT_MAX):
        return None
    ids = df.select(F.col(col).alias("id")).where(F.col("id").isNotNull()).distinct()
    out = global_rank(ids, [F.col("id").asc()], "r").select("id", (F.col("r") - 1).alias("dense")).checkpoint(eager=True)
    if out.agg(F.max("dense")).first()[0] > INT_MAX:
        raise ValueError(f"more than 2^31 different {col}: ALS numbers them with an int")
    return out.withColumn("dense", F.col("dense").cast("int"))


def _numbered(df: DataFrame, col: str, names: DataFrame | None, name: str) -> DataFrame:
    if names is None:
        return df.withColumn(name, F.col(col).cast("int"))
    return df.join(loose(names.select(F.col("id").alias(col), F.col("dense").alias(name))), col)


def als(df: DataFrame, rating_col: str = "rating", implicit: bool = False, rank: int = 10,
        reg: float = 0.1, iters: int = 10, alpha: float = 1.0, seed: int = 42) -> Factors:
    """Fit ALS on (user_id, item_id, rating_col).

    Explicit ratings by default; ``implicit=True`` treats the column as a
    confidence weight (Hu, Koren and Volinsky 2008).  Ids beyond the int range are numbered
    first.  Unknown ids are dropped at prediction time, so cold users need R4.
    """
    from pyspark.ml.recommendation import ALS
    checkpoint_dir(df.sparkSession)
    users, items = _dense(df, "user_id"), _dense(df, "item_id")
    data = _numbered(_numbered(df.select("user_id", "item_id", F.col(rating_col).cast("float").alias("r")),
                               "user_id", users, "user"), "item_id", items, "item").select("user", "item", "r")
    est = ALS(userCol="user", itemCol="item", ratingCol="r", rank=rank, regParam=reg, maxIter=iters,
              implicitPrefs=implicit, alpha=alpha, seed=seed, coldStartStrategy="drop",
              nonnegative=False, checkpointInterval=5)
    return Factors(est.fit(data), users, items)


def als_predict(factors: Factors, pairs: DataFrame) -> DataFrame:
    """Predicted rating for (user_id, item_id) pairs the model knows."""
    p = _numbered(_numbered(pairs.select("user_id", "item_id"), "user_id", factors.users, "user"),
                  "item_id", factors.items, "item")
    return factors.model.transform(p).select("user_id", "item_id", r6(F.col("prediction").cast("double")).alias("pred"))


def als_recommend(factors: Factors, seen: DataFrame, n: int = 10, source: str = "als") -> DataFrame:
    """Top n unseen items per user from an ALS model.

    A user with h seen items needs the model's best ``n + h`` to keep n unseen ones, so the
    lists asked for are linear in users and total history.  They are the exact greatest inner
    products (``best_products``: items by falling norm, stopped by the product of norms).
    """
    hist = seen.groupBy("user_id").agg(F.count(F.lit(1)).alias("h"))
    users = (factors.user_factors.join(loose(hist), "user_id", "left")
             .select("user_id", "v", (F.coalesce("h", F.lit(0)) + F.lit(n)).alias("want")))
    found = best_products(users, factors.item_factors)
    return top_n(exclude_seen(found.select("user_id", "item_id", m6("product").alias("score")), seen), n, source)


def als_similar(factors: Factors, k: int = 10) -> DataFrame:
    """Items most similar by cosine of their ALS factors (approximate, by T9's inverted file;
    T8 on the factors is exact and quadratic)."""
    return nearest_ivf(factors.item_factors, k, id_col="item_id", vec_col="v")


#: baskets to a bitmap, the bits of a bigint: 2 ** 6
BITS = 64


def frequent_sets(lineitem: DataFrame, min_support: float = 0.0001, max_size: int | None = 3,
                  min_confidence: float = 0.0, chunk: int = DEFAULT_CHUNK):
    """C14: frequent item sets over order baskets: sets in at least ``min_support`` of all
    orders (a share, so it means the same at every size), of up to ``max_size`` items (None: as
    large as they come).  Returns (item sets with ``n``, association rules).  A basket is the
    distinct parts of one order.

    Level by level: a set is held as bitmaps of the baskets that have it, a bigint to 64
    baskets, and a set of k + 1 items is two frequent sets of k with the same first k - 1 items,
    its bitmaps their common bits.  Sets beyond ``max_size`` are never formed, and no basket is
    gathered into a row: pairs come from ``co_pairs``, which splits large baskets.
    """
    spark = lineitem.sparkSession
    checkpoint_dir(spark)
    o, i = F.col("l_orderkey").cast("bigint"), F.col("l_partkey").cast("bigint")
    baskets = (lineitem.select(o.alias("o"), i.alias("i")).where(F.col("o").isNotNull() & F.col("i").isNotNull())
               .distinct().checkpoint(eager=True))
    n_baskets = baskets.select("o").distinct().count()
    least = F.lit(math.ceil(min_support * n_baskets))
    one = baskets.groupBy("i").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= least)
    levels = [one.select(F.array("i").alias("items"), "n").checkpoint(eager=True)]
    bit = F.expr(f"shiftleft(1L, cast(pmod(o, {BITS}) as int))")
    size = 1
    while max_size is None or size < max_size:
        if size == 1:
            common = baskets.join(loose(one.select("i")), "i", "left_semi")
            rows = (co_pairs(common, "o", "i", chunk=chunk)
                    .groupBy(F.array("a", "b").alias("items"), F.shiftright("o", 6).alias("block"))
                    .agg(F.bit_or(bit).alias("bits")))
        else:
            last = F.col("items")[size - 1]
            side = maps.select(F.slice("items", 1, size - 1).alias("prefix"), "block", last.alias("x"), "bits")
            both = (side.alias("p").join(side.alias("q"), ["prefix", "block"]).where(F.col("p.x") < F.col("q.x"))
                    .select(F.concat("prefix", F.array("p.x", "q.x")).alias("items"), "block",
                            F.col("p.bits").bitwiseAND(F.col("q.bits")).alias("bits")))
            rows = both.where(F.col("bits") != 0)
        rows = rows.checkpoint(eager=True)
        found = (rows.groupBy("items").agg(F.sum(F.bit_count("bits")).cast("bigint").alias("n"))
                 .where(F.col("n") >= least).checkpoint(eager=True))
        if found.isEmpty():
            break
        levels.append(found)
        maps = rows.join(loose(found.select("items")), "items", "left_semi")
        size += 1
    sets = levels[0]
    for level in levels[1:]:
        sets = sets.unionByName(level)
    return sets.withColumn("size", F.size("items").cast("bigint")), _rules(sets, n_baskets, min_confidence)


def _rules(sets: DataFrame, n_baskets: int, min_confidence: float) -> DataFrame:
    """(antecedent, consequent, confidence, lift, support): every frequent set with one item after the others."""
    from_set = (sets.where(F.size("items") > 1).select("items", "n", F.explode("items").alias("c"))
                .select(F.filter("items", lambda x: x != F.col("c")).alias("antecedent"), F.array("c").alias("consequent"), "n"))
    count = lambda name, n: loose(sets.select(F.col("items").alias(name), F.col("n").alias(n)))
    j = from_set.join(count("antecedent", "na"), "antecedent").join(count("consequent", "nc"), "consequent")
    confidence = F.col("n") / F.col("na")
    return (j.where(confidence >= F.lit(min_confidence))
            .select("antecedent", "consequent", confidence.alias("confidence"),
                    (confidence * F.lit(n_baskets) / F.col("nc")).alias("lift"), (F.col("n") / F.lit(n_baskets)).alias("support")))


def fit_ranker(events: DataFrame, buckets: int = 1 << 18, iters: int = 20, seed: int = 42,
               train_share: float = 0.8):
    """Purchase-vs-other classifier on user, item and time features
    (feature hashing and logistic regression).

    Fitted on the events before the ``train_share`` quantile of time and scored on the
    later ones only.  Returns (model, later events with ``label`` and ``p_purchase``)."""
    from pyspark.ml import Pipeline
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.feature import FeatureHasher
    from pyspark.ml.functions import vector_to_array

    micros = F.expr("timestampdiff(MICROSECOND, TIMESTAMP_NTZ'1970-01-01 00:00:00', ts)")
    cut = events.agg(F.percentile_approx(micros, train_share, 100_000)).first()[0]
    feats = events.select(
        "event_id", micros.alias("at"),
        F.col("user_id").cast("string").alias("user"),
        F.get_json_object("props", "$.k").alias("item"),
        F.hour("ts").cast("string").alias("hour"),
        F.dayofweek("ts").cast("string").alias("dow"),
        (F.col("event_type") == "purchase").cast("double").alias("label"))
    pipe = Pipeline(stages=[
        FeatureHasher(inputCols=["user", "item", "hour", "dow"], outputCol="features", numFeatures=buckets),
        LogisticRegression(maxIter=iters, regParam=0.01, featuresCol="features", labelCol="label")])
    model = pipe.fit(feats.where(F.col("at") < F.lit(cut)))
    scored = model.transform(feats.where(F.col("at") >= F.lit(cut))).select(
        "event_id", "label", r6(vector_to_array("probability")[1]).alias("p_purchase"))
    return model, scored


def topics(articles: DataFrame, k: int = 10, iters: int = 10, seed: int = 42,
           buckets: int = 1 << 18) -> DataFrame:
    """Topic mix per article (hashed term counts and online LDA); returns
    (item_id, topic, weight) for the article's main topic and the full mix.

    Every token of every text counts: terms fall into ``buckets`` hash buckets, so no
    vocabulary is cut or gathered; terms that share a bucket count as one."""
    from pyspark.ml.clustering import LDA
    from pyspark.ml.feature import HashingTF
    from pyspark.ml.functions import vector_to_array
    from pickwise.functions.text import tokens

    docs = articles.select("item_id", F.coalesce(tokens("text"), F.array().cast("array<string>")).alias("toks"))
    vec = HashingTF(inputCol="toks", outputCol="features", numFeatures=buckets).transform(docs)
    lda = LDA(k=k, maxIter=iters, seed=seed, optimizer="online").fit(vec)
    mix = lda.transform(vec).select("item_id", vector_to_array("topicDistribution").alias("mix"))
    top = F.array_max(F.col("mix"))
    return mix.select("item_id", F.array_position("mix", top).cast("bigint").alias("topic"),
                      r6(top).alias("weight"), "mix")


def item_vectors(events: DataFrame, dim: int = 16, window: int = 5, sentence: int = 1000,
                 seed: int = 42, partitions: int | None = None) -> DataFrame:
    """Item vectors from ordered user histories (Word2Vec).

    Histories are cut into sentences of ``sentence`` events (the length at which the model
    itself cuts) using the global order of the sequence module, so no user's history is
    collected into one row.  The fit runs on ``partitions`` tasks (default: the cluster's
    parallelism); each round averages their vectors.
    """
    from pyspark.ml.feature import Word2Vec
    from pyspark.ml.functions import vector_to_array
    from pickwise.operators.sequence import item_events

    ev = item_events(events).where(F.col("item_id").isNotNull()).select("user_id", "ts", "event_id", "item_id")
    g = global_rank(ev, [F.col("user_id").asc(), F.col("ts").asc(), F.col("event_id").asc()], "g")
    first = g.groupBy("user_id").agg(F.min("g").alias("g0"))
    pos = g.join(loose(first), "user_id").withColumn("pos", F.col("g") - F.col("g0"))
    sent = (pos.groupBy("user_id", F.floor(F.col("pos") / F.lit(sentence)).alias("chunk"))
            .agg(F.array_sort(F.collect_list(F.struct("pos", F.col("item_id").cast("string").alias("it"))))
                 .alias("s"))
            .select(F.transform("s", lambda x: x["it"]).alias("words")))
    n = partitions or events.sparkSession.sparkContext.defaultParallelism
    w2v = Word2Vec(vectorSize=dim, windowSize=window, minCount=1, seed=seed, inputCol="words", outputCol="vec",
                   maxSentenceLength=sentence, numPartitions=n).fit(sent)
    return w2v.getVectors().select(F.col("word").cast("bigint").alias("item_id"),
                                   vector_to_array("vector").alias("vector"))

"""Selection, filtering, merging and re-ranking of candidate lists."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pickwise.functions.scores import rank_order
from pickwise.operators.skew import loose


def top_k(df: DataFrame, part: str, k: int, score: str = "score", key: str = "item_id",
          rank_col: str = "rank") -> DataFrame:
    """Keep the k best rows per ``part`` by (score desc, key asc), numbered 1..k.

    ``row_number() <= k`` lets Catalyst insert a partial WindowGroupLimit before
    the shuffle, so a hot ``part`` sends at most k rows per map task.
    """
    w = Window.partitionBy(part).orderBy(*rank_order(score, key))
    return (df.withColumn(rank_col, F.row_number().over(w).cast("bigint"))
            .where(F.col(rank_col) <= F.lit(k)))


def top_n(scored: DataFrame, n: int, source: str | None = None) -> DataFrame:
    """Recs with the n best items per user."""
    ranked = top_k(scored, "user_id", n)
    src = F.lit(source) if source is not None else (
        F.col("source") if "source" in scored.columns else F.lit(None).cast("string"))
    return ranked.select("user_id", "item_id", F.col("score").cast("bigint").alias("score"),
                         "rank", src.alias("source"))


def exclude_seen(scored: DataFrame, seen: DataFrame) -> DataFrame:
    """R2: drop (user, item) pairs the user already has (left anti join)."""
    return scored.join(seen.select("user_id", "item_id"), ["user_id", "item_id"], "left_anti")


def merge_rrf(recs: Sequence[DataFrame], weights: Sequence[float] | None = None,
              n: int = 10, k0: int = 60) -> DataFrame:
    """Reciprocal-rank fusion, ``sum(weight / (k0 + rank))`` per (user, item).

    Each term is taken in millionths before summing, so the fused score is exact.
    """
    from pickwise.functions.scores import m6
    weights = list(weights or [1.0] * len(recs))
    if len(weights) != len(recs):
        raise ValueError("one weight per list")
    parts = [r.select("user_id", "item_id",
                      m6(F.lit(float(wt)) / (F.lit(k0) + F.col("rank"))).alias("s"))
             for r, wt in zip(recs, weights)]
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    fused = u.groupBy("user_id", "item_id").agg(F.sum("s").alias("score"))
    return top_n(fused, n, "rrf")


def fill_popular(recs: DataFrame, users: DataFrame, seen: DataFrame, pop_ranked: DataFrame,
                 n: int = 10) -> DataFrame:
    """Give every user in ``users`` a list of n: their own recs first, then the
    most popular items they have neither seen nor been recommended.

    ``pop_ranked`` is (item_id, users, grank) with grank the global popularity
    rank.  A user who needs k more items and has x excluded (seen or already
    listed) items finds them among the top k + x popular items, so users send
    as many slots as they have exclusions and open places, joined to the
    ranking on grank.  ``row_number() <= n`` comes first, a literal, so each map
    task sends at most n rows of a user however long the history; the user's own
    need cuts the rest.  Nothing is capped and no product of tables is formed.
    """
    from pickwise.session import checkpoint_dir

    # the input lists (users x n rows) are read for the counts, the exclusions
    # and the final union: materialise them once
    checkpoint_dir(recs.sparkSession)
    own = recs.select("user_id", "item_id", "score", "rank", "source").checkpoint(eager=True)
    have = own.groupBy("user_id").agg(F.count(F.lit(1)).alias("_have"))
    excl = own.select("user_id", "item_id").unionByName(seen.select("user_id", "item_id")).distinct()
    n_excl = excl.groupBy("user_id").agg(F.count(F.lit(1)).alias("_x"))
    need = (users.select("user_id").distinct().join(have, "user_id", "left").join(n_excl, "user_id", "left")
            .select("user_id", F.coalesce("_have", F.lit(0)).alias("_have"),
                    (F.lit(n) - F.coalesce("_have", F.lit(0))).alias("_need"),
                    F.coalesce("_x", F.lit(0)).alias("_x"))
            .where(F.col("_need") > 0))
    depth = need.select("user_id", "_have", "_need", (F.col("_need") + F.col("_x")).cast("bigint").alias("_d"))
    # slots 1.._d, generated block by block so no single array holds them all
    blk = F.lit(4096).cast("bigint")
    blocks = depth.select("user_id", "_have", "_need", "_d",
                          F.explode(F.sequence(F.lit(0).cast("bigint"),
                                               F.floor((F.col("_d") - 1) / blk))).alias("_b"))
    slots = blocks.select("user_id", "_have", "_need", F.explode(F.sequence(
        F.col("_b") * blk + 1, F.least(F.col("_d"), (F.col("_b") + 1) * blk))).alias("grank"))
    cand = (slots.join(loose(pop_ranked.select("item_id", "users", "grank")), "grank")
            .join(excl, ["user_id", "item_id"], "left_anti"))
    w = Window.partitionBy("user_id").orderBy(F.col("grank").asc())
    fill = (cand.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= F.lit(n))
            .where(F.col("_r") <= F.col("_need"))
            .select("user_id", "item_id", F.col("users").cast("bigint").alias("score"),
                    (F.col("_have") + F.col("_r")).cast("bigint").alias("rank"),
                    F.lit("popular").alias("source")))
    return own.unionByName(fill)


def cap_per_group(recs: DataFrame, items: DataFrame, key: str, m: int = 2,
                  n: int = 10) -> DataFrame:
    """At most m items per ``key`` value (e.g. brand) in a list, then top n."""
    j = recs.select("user_id", "item_id", "score", "source").join(
        items.select("item_id", key), "item_id")
    w = Window.partitionBy("user_id", key).orderBy(*rank_order())
    capped = j.withColumn("_g", F.row_number().over(w)).where(F.col("_g") <= F.lit(m))
    return top_n(capped.drop("_g", key), n)


def mmr(recs: DataFrame, neighbors: DataFrame, lam: float = 0.7, n: int = 10) -> DataFrame:
    """Greedy maximal marginal relevance over each user's candidate list.

    Picks, n times, the candidate maximising ``lam*score - (1-lam)*max sim to
    the items already picked`` (ties to the smaller item id); similarities come
    from ``neighbors`` (missing pair = 0), both in millionths.  Candidate lists
    are top-k outputs, so one user's group is bounded; the greedy loop is the
    one Python function on the data path (Arrow-batched, per user).
    """
    import numpy as np
    import pandas as pd

    cand = recs.select("user_id", "item_id", F.col("score").cast("double").alias("score"))
    mine = recs.select(F.col("user_id").alias("u"), F.col("item_id").alias("i"))
    theirs = recs.select(F.col("user_id").alias("u2"), F.col("item_id").alias("o"))
    nb = neighbors.select(F.col("id").alias("nb_i"), F.col("other").alias("nb_o"),
                          F.col("score").cast("double").alias("sim"))
    sims = (mine.join(nb, F.col("i") == F.col("nb_i"))
            .join(theirs, (F.col("u2") == F.col("u")) & (F.col("o") == F.col("nb_o")))
            .select(F.col("u").alias("user_id"), F.col("i").alias("item_id"),
                    F.col("o").alias("other"), "sim"))

    def pick(key, cdf: pd.DataFrame, sdf: pd.DataFrame) -> pd.DataFrame:
        cdf = cdf.sort_values("item_id", kind="stable")
        ids = cdf["item_id"].to_numpy()
        rel = cdf["score"].to_numpy(dtype=float)
        pos = {v: i for i, v in enumerate(ids)}
        sim = np.zeros((len(ids), len(ids)))
        for a, b, s in zip(sdf["item_id"], sdf["other"], sdf["sim"]):
            ia, ib = pos[a], pos[b]
            sim[ia, ib] = max(sim[ia, ib], s)
            sim[ib, ia] = max(sim[ib, ia], s)
        chosen, maxsim = [], np.zeros(len(ids))
        free = np.ones(len(ids), dtype=bool)
        for _ in range(min(n, len(ids))):
            val = np.where(free, lam * rel - (1.0 - lam) * maxsim, -np.inf)
            i = int(np.argmax(val))  # first max = smallest id (ids sorted)
            chosen.append(i)
            free[i] = False
            maxsim = np.maximum(maxsim, sim[i])
        return pd.DataFrame({"user_id": np.full(len(chosen), key[0], dtype="int64"),
                             "item_id": ids[chosen].astype("int64"),
                             "score": rel[chosen].astype("int64"),
                             "rank": np.arange(1, len(chosen) + 1, dtype="int64"),
                             "source": "mmr"})

    return (cand.groupBy("user_id").cogroup(sims.groupBy("user_id"))
            .applyInPandas(pick, "user_id bigint, item_id bigint, score bigint, rank bigint, "
                                 "source string"))

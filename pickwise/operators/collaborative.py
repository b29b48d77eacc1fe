"""Collaborative filtering.

Similarity operators return Neighbors: ``id, other, support, score, rank`` with
``score`` in millionths (bigint) and ``rank`` 1..k per id.  Pairs come from the
skew-safe ``co_pairs`` self-join; symmetric scores are computed once per
unordered pair and mirrored afterwards.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions.scores import m6
from pickwise.operators.lists import block_of, neighbor_sums, shared_top_k
from pickwise.operators.near import packed, unpacked
from pickwise.operators.pairs import DEFAULT_CHUNK, both_ways, co_pairs
from pickwise.operators.pair_sums import SUMS, pair_sums
from pickwise.operators.related import MOST_TERMS, set_cosines, spans
from pickwise.operators.rerank import exclude_seen, top_k, top_n
from pickwise.operators.skew import loose

TILE_USERS, TILE_ENTRIES = 2000, 1 << 20  # users, and ratings, to a block of ``predict_user_cf``
PAIRS_HELD = 1 << 21  # pairs of users that a task sorts into tiles at a time
DENSE = 16            # a matrix with a number to so many places is multiplied as it is


def _neighbors(directed: DataFrame, k: int | None) -> DataFrame:
    ranked = top_k(directed, "id", k, key="other") if k else directed
    cols = ["id", "other", "support", "score"] + (["rank"] if k else [])
    return ranked.select(*cols)


def item_cf(inter: DataFrame, k: int = 10, iuf: bool = False, min_support: int = 1,
            chunk: int = DEFAULT_CHUNK, most: int = MOST_TERMS) -> DataFrame:
    """Item-item cosine on binary interactions, top k per item.

    C1: ``c(i,j) / sqrt(n(i) n(j))`` with ``c`` the number of shared users.
    C2 (``iuf=True``): each shared user counts ``1 / ln(1 + n(u))`` instead of 1.
    The top k comes from packed lists (``shared_top_k``), which send no row to a pair;
    all pairs (``k`` None) from the self-join.
    """
    base = inter.select("user_id", "item_id")
    n_item = base.groupBy("item_id").agg(F.count(F.lit(1)).alias("n"))
    if k:
        rows = base.select(F.col("item_id").cast("bigint").alias("id"), F.col("user_id").cast("bigint").alias("t"))
        return shared_top_k(rows, n_item.withColumnRenamed("item_id", "id"), k, iuf=iuf, min_support=min_support,
                            most=most, chunk=chunk).select("id", "other", "support", "score", "rank")
    # per-item counts ride along with the pairs instead of being joined to
    # the (much larger) pair aggregate twice afterwards
    pairs = co_pairs(base.join(loose(n_item), "item_id"), "user_id", "item_id", carry=["n"], chunk=chunk)
    weight = (F.lit(1.0) / F.log(F.lit(1.0) + F.col("group_size"))) if iuf else F.lit(1)
    agg = (pairs.groupBy("a", "b", "a_n", "b_n")
           .agg(F.count(F.lit(1)).alias("support"), F.sum(weight).alias("num"))
           .where(F.col("support") >= F.lit(min_support)))
    scored = agg.select("a", "b", "support",
                        m6(F.col("num") / F.sqrt(F.col("a_n") * F.col("b_n"))).alias("score"))
    return _neighbors(both_ways(scored, keep=["support", "score"]), k)


def user_cf(inter: DataFrame, k: int = 10, metric: str = "cosine",
            chunk: int = DEFAULT_CHUNK, most: int = MOST_TERMS) -> DataFrame:
    """C4: user-user similarity on binary interactions, top k per user.

    ``metric='cosine'``: ``c / sqrt(n(u) n(v))``; ``'jaccard'``: ``c / (n(u) + n(v) - c)``.
    The other value is returned as ``alt`` (millionths) so both are at hand.  The top k comes
    from packed lists (``shared_top_k``), which send no row to a pair.
    """
    base = inter.select("user_id", "item_id")
    if k and metric == "cosine":
        union = F.col("n") + F.col("other_n") - F.col("support")
        return set_cosines(base, "user_id", "item_id", k, most).select(
            "id", "other", "support", "score", m6(F.col("support") / union).alias("alt"), "rank")
    n_user = base.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    if k and metric == "jaccard":
        rows = base.select(F.col("user_id").cast("bigint").alias("id"), F.col("item_id").cast("bigint").alias("t"))
        found = shared_top_k(rows, n_user.withColumnRenamed("user_id", "id"), k, "jaccard", most=most, chunk=chunk)
        return found.select("id", "other", "support", "score",
                            m6(F.col("support") / F.sqrt(F.col("n") * F.col("other_n"))).alias("alt"), "rank")
    pairs = co_pairs(base.join(loose(n_user), "user_id"), "item_id", "user_id", carry=["n"], chunk=chunk)
    agg = pairs.groupBy("a", "b", "a_n", "b_n").agg(F.count(F.lit(1)).alias("support"))
    cos = m6(F.col("support") / F.sqrt(F.col("a_n") * F.col("b_n")))
    jac = m6(F.col("support") / (F.col("a_n") + F.col("b_n") - F.col("support")))
    if metric not in ("cosine", "jaccard"):
        raise ValueError("metric must be 'cosine' or 'jaccard'")
    score, alt = (cos, jac) if metric == "cosine" else (jac, cos)
    scored = agg.select("a", "b", "support", score.alias("score"), alt.alias("alt"))
    directed = both_ways(scored, keep=["support", "score", "alt"])
    ranked = top_k(directed, "id", k, key="other") if k else directed
    return ranked.select("id", "other", "support", "score", "alt", *(["rank"] if k else []))


def recommend_items(inter: DataFrame, neighbors: DataFrame, n: int = 10,
                    source: str = "item_cf") -> DataFrame:
    """Score each unseen item by the summed neighbor scores of the user's
    items, then keep the top n (Recs).  An item's neighbors go to its users as packed
    lists (``neighbor_sums``), without a row to a candidate."""
    return top_n(neighbor_sums(inter, neighbors, n), n, source)


def adjusted_cosine(ratings: DataFrame, k: int | None = 10, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Item-item adjusted cosine.  Ratings are centred on the user mean; the
    dot product runs over co-raters and is divided by the two full item norms;
    pairs with a zero norm are dropped."""
    um = ratings.groupBy("user_id").agg((F.sum("rating") / F.count(F.lit(1))).alias("mu"))
    c = ratings.join(loose(um), "user_id").select("user_id", "item_id",
                                           (F.col("rating") - F.col("mu")).alias("d"))
    norms = c.groupBy("item_id").agg(F.sqrt(F.sum(F.col("d") * F.col("d"))).alias("nrm"))
    pairs = co_pairs(c.join(loose(norms), "item_id").where(F.col("nrm") > 0), "user_id", "item_id",
                     carry=["d", "nrm"], chunk=chunk)
    agg = pairs.groupBy("a", "b", "a_nrm", "b_nrm").agg(
        F.count(F.lit(1)).alias("support"), F.sum(F.col("a_d") * F.col("b_d")).alias("dot"))
    scored = agg.select("a", "b", "support",
                        m6(F.col("dot") / (F.col("a_nrm") * F.col("b_nrm"))).alias("score"))
    return _neighbors(both_ways(scored, keep=["support", "score"]), k)


def user_pearson(ratings: DataFrame, min_overlap: int = 5, most: int = MOST_TERMS) -> DataFrame:
    """User-user Pearson correlation over co-rated items from exact integer
    sums; pairs with fewer than ``min_overlap`` common items or zero variance
    are dropped.  Returns unordered pairs (id < other).

    Pairs come from packed blocks (``pair_sums``): a user's ``min_overlap - 1`` most rated
    items make no pairs, as whoever shares that many with the user shares another too."""
    p = pair_sums(ratings, "user_id", "item_id", F.col("rating"), max(1, min_overlap), most)
    n, sx, sy, sxx, syy, sxy = (F.col(c).cast("bigint") for c in SUMS)
    vx, vy, cov = n * sxx - sx * sx, n * syy - sy * sy, n * sxy - sx * sy
    return (p.where((vx > 0) & (vy > 0))
            .select(F.col("a").alias("id"), F.col("b").alias("other"), n.alias("support"),
                    m6(cov / F.sqrt(vx.cast("double") * vy.cast("double"))).alias("score")))


def predict_user_cf(ratings: DataFrame, pearson: DataFrame, k: int | None = None, users: int = TILE_USERS,
                    entries: int = TILE_ENTRIES, most: int = MOST_TERMS) -> DataFrame:
    """``mean(u) + sum(c (y_v - mean(v))) / sum |c|`` over neighbors v with
    c > 0 that rated the item, for items u has not rated.  ``k`` keeps the k
    most similar neighbors per user (None: all with c > 0).

    Users are dealt to blocks of about ``users`` and ``entries`` ratings.  A task adds up, for the users
    of a block, the ratings of their neighbors in another one: a rating of a neighbor is an addition in
    memory, not a row.  A pair of users goes packed, and without ``k`` once for both of them.  Ratings
    without item or value, and those of a neighbor of over ``most``, are joined."""
    from pickwise.functions.scores import r6
    close = pearson.where(F.col("score") > 0)
    if k:
        close = top_k(both_ways(close.select(F.col("id").alias("a"), F.col("other").alias("b"), "score"), keep=["score"]), "id", k, key="other")
    um = ratings.groupBy("user_id").agg(F.sum("rating").alias("s"), F.count(F.lit(1)).alias("n"))
    dv = (ratings.join(loose(um), "user_id")
          .select(F.col("user_id").alias("other"), "item_id",
                  (F.col("rating") - F.col("s") / F.col("n")).alias("dev"), "n"))
    sends = close.select(F.col("id").cast("bigint").alias("user_id"), F.col("other").cast("bigint").alias("other"),
                         F.col("score").cast("bigint").alias("c"))
    plain = F.col("item_id").isNull() | F.col("dev").isNull() | (F.col("n") > F.lit(most))
    known, rows, largest = um.agg(F.count(F.lit(1)), F.sum("n"), F.max("n")).first()
    blocks = max(4, -(-known // users), -(-(rows or 0) // entries))

    def pack(batches):
        held, waiting = [], 0
        for batch in batches:
            held.append([batch.column(i).to_numpy() for i in range(3)])
            waiting += batch.num_rows
            if waiting >= PAIRS_HELD:
                yield from _packed_pairs(held, blocks, not k)
                held, waiting = [], 0
        if waiting:
            yield from _packed_pairs(held, blocks, not k)

    pairs = (sends.where(F.col("user_id").isNotNull() & F.col("other").isNotNull())
             .mapInArrow(pack, "ub int, vb int, users binary, others binary, cs binary"))
    # a block's ratings go to each tile that has it on one side
    side, b = block_of(F.col("other"), blocks).cast("int"), F.explode(F.sequence(F.lit(0), F.lit(blocks - 1)))
    lists = (dv.where(~plain & F.col("other").isNotNull())
             .select(side.alias("own"), F.col("other").cast("bigint").alias("other"), F.col("item_id").cast("bigint").alias("item_id"), "dev")
             .groupBy("own").applyInArrow(_packed_ratings, "own int, others binary, items binary, devs binary")
             .withColumn("b", b))
    at = (F.least("own", "b"), F.greatest("own", "b")) if not k else (F.col("b"), F.col("own"))
    lists = lists.select(at[0].alias("ub"), at[1].alias("vb"), "others", "items", "devs")
    sums = (pairs.groupBy("ub", "vb").cogroup(lists.groupBy("ub", "vb"))
            .applyInArrow(lambda x, y: _neighbor_ratings(x, y, not k), "user_id bigint, item_id bigint, num double, den bigint"))
    if (largest or 0) > most or not ratings.where(F.col("item_id").isNull() | F.col("rating").isNull()).isEmpty():
        if not k:
            sends = both_ways(sends.select(F.col("user_id").alias("a"), F.col("other").alias("b"), "c"), keep=["c"]).withColumnRenamed("id", "user_id")
        rest = sends.where(F.col("user_id").isNotNull()).join(loose(dv.where(plain)), "other")
        sums = sums.unionByName(rest.select("user_id", "item_id", (F.col("c") * F.col("dev")).alias("num"), F.abs("c").alias("den")))
    # summed first: what is excluded is then one row per (user, item), not one per neighbor
    agg = exclude_seen(sums.groupBy("user_id", "item_id").agg(F.sum("num").alias("num"), F.sum("den").alias("den")), ratings)
    return (agg.join(loose(um), "user_id")
            .select("user_id", "item_id",
                    r6(F.col("s") / F.col("n") + F.col("num") / F.col("den")).alias("pred")))


def _packed_pairs(held: list, blocks: int, both: bool):
    """Batches with a row to a tile of two blocks of users; with ``both`` the lesser block stands first."""
    user, other, c = (np.concatenate(x).astype(np.int64) for x in zip(*held))
    ub, vb = block_of(user, blocks), block_of(other, blocks)
    if both:
        swap = ub > vb
        user, other = np.where(swap, other, user), np.where(swap, user, other)
        ub, vb = np.minimum(ub, vb), np.maximum(ub, vb)
    tile = ub * blocks + vb
    order = np.lexsort((other, user, tile))
    user, other, c, tile = user[order], other[order], c[order], tile[order]
    edges = np.flatnonzero(np.concatenate(([True], tile[1:] != tile[:-1], [True]))).tolist()
    for i in range(0, len(edges) - 1, 1024):
        some = list(zip(edges[i:i + 1025], edges[i + 1:i + 1025]))
        first = tile[[x for x, _ in some]]
        yield pa.RecordBatch.from_arrays(
            [pa.array((first // blocks).astype(np.int32)), pa.array((first % blocks).astype(np.int32)),
             *[pa.array([packed(v[x:y], v is not c) for x, y in some], pa.binary()) for v in (user, other, c)]], names=["ub", "vb", "users", "others", "cs"])


def _packed_ratings(key, table):
    other, item, dev = (table.column(c).to_numpy() for c in ("other", "item_id", "dev"))
    order = np.lexsort((item, other))
    return pa.table({"own": pa.array([key[0].as_py()], pa.int32()), "others": [packed(other[order])], "items": [packed(item[order])],
                     "devs": [dev[order].tobytes()]})


def _neighbor_ratings(pairs: pa.Table, lists: pa.Table, both: bool) -> pa.Table:
    """(user_id, item_id, num, den) of the users of a block: what their neighbors in another block add to each item;
    with ``both`` also of those neighbors, what the users add."""
    out = []
    if pairs.num_rows and lists.num_rows:
        join = lambda t, c: np.concatenate([unpacked(x, "int64", c != "cs") for x in t.column(c).to_pylist()])
        rated = join(lists, "others"), join(lists, "items"), np.concatenate([np.frombuffer(x, np.float64) for x in lists.column("devs").to_pylist()])
        user, other, c = (join(pairs, x) for x in ("users", "others", "cs"))
        out = _added(user, other, c, *rated)
        if both:
            out += _added(other, user, c, *rated)
    kinds = np.int64, np.int64, np.float64, np.int64
    return pa.table([pa.array(np.concatenate(x).astype(t)) for x, t in zip(zip(*out), kinds)] if out else [pa.array([], pa.from_numpy_dtype(t)) for t in kinds],
                    names=["user_id", "item_id", "num", "den"])


def _added(user: np.ndarray, v: np.ndarray, c: np.ndarray, other: np.ndarray, item: np.ndarray, dev: np.ndarray) -> list:
    """(user, item, num, den) arrays of the pairs (user, v, c) and the ratings (other, item, dev)."""
    known = np.isin(other, v)
    order = np.argsort(other[known], kind="stable")
    other, item, dev = (x[known][order] for x in (other, item, dev))
    ids, first, n = np.unique(other, return_index=True, return_counts=True)
    if not len(ids):
        return []
    items, item = np.unique(item, return_inverse=True)
    at = np.minimum(np.searchsorted(ids, v), len(ids) - 1)
    met = np.flatnonzero(ids[at] == v)
    met = met[np.argsort(user[met], kind="stable")]
    user, at, c = user[met], at[met], c[met]
    out = []
    edges = np.flatnonzero(np.concatenate(([True], user[1:] != user[:-1], [True]))).tolist() if len(user) else [0]
    dense = len(ids) * len(items) <= DENSE * len(item) and len(user) * DENSE >= (len(edges) - 1) * len(ids)
    if dense:  # most know most: a product of matrices adds up faster than index by index
        rows = np.repeat(np.arange(len(ids)), n)
        devs, there = np.zeros((len(ids), len(items))), np.zeros((len(ids), len(items)))
        np.add.at(devs, (rows, item), dev)
        np.add.at(there, (rows, item), 1.0)
        for i in range(0, len(edges) - 1, 256):
            cuts = edges[i:i + 257]
            weight = np.zeros((len(cuts) - 1, len(ids)))
            np.add.at(weight, (np.repeat(np.arange(len(cuts) - 1), np.diff(cuts)), at[cuts[0]:cuts[-1]]), c[cuts[0]:cuts[-1]])
            den = weight @ there
            who, found = np.nonzero(den)  # every c is over zero
            out.append((user[cuts[:-1]][who], items[found], (weight @ devs)[who, found], den[who, found]))
        return out
    for lo, hi in zip(edges, edges[1:]):
        near = at[lo:hi]
        entry, weight = spans(first[near], n[near]), np.repeat(c[lo:hi], n[near])
        den = np.bincount(item[entry], weight, len(items))
        found = np.flatnonzero(den)
        num = np.bincount(item[entry], weight * dev[entry], len(items))
        out.append((np.full(len(found), user[lo]), items[found], num[found], den[found]))
    return out


def slope_one_devs(ratings: DataFrame, most: int = MOST_TERMS) -> DataFrame:
    """C8 deviations: for each ordered item pair, co-rater count ``n`` and the
    integer ``d = sum(y_i - y_j)``; ``dev = d / n``.  The pairs' sums are added up in packed
    blocks of items, without a row to a pair of ratings (``pair_sums``)."""
    p = pair_sums(ratings, "item_id", "user_id", F.col("rating"), 1, most)
    d = (F.col("sx") - F.col("sy")).cast("bigint")
    both = F.explode(F.array(F.struct(F.col("a").alias("i"), F.col("b").alias("j"), "n", d.alias("d")),
                             F.struct(F.col("b").alias("i"), F.col("a").alias("j"), "n", (-d).alias("d"))))
    return p.select(both.alias("p")).select("p.i", "p.j", "p.n", "p.d")


def slope_one(ratings: DataFrame, devs: DataFrame | None = None) -> DataFrame:
    """Weighted Slope One predictions for unrated items,
    ``sum(n_ji dev_ji + n_ji y_ui) / sum n_ji`` = ``sum(d_ji + n_ji y_ui) / sum n_ji``
    (exact integer sums)."""
    from pickwise.functions.scores import r6
    devs = devs if devs is not None else slope_one_devs(ratings)
    contrib = (ratings.select("user_id", F.col("item_id").alias("j_rated"), F.col("rating"))
               .join(devs.select(F.col("j").alias("j_rated"), F.col("i").alias("item_id"), "n", "d"),
                     "j_rated")
               .select("user_id", "item_id", "n", (F.col("d") + F.col("n") * F.col("rating")).alias("num")))
    agg = exclude_seen(contrib.groupBy("user_id", "item_id").agg(
        F.sum("num").alias("num"), F.sum("n").alias("den")), ratings)
    return agg.select("user_id", "item_id", r6(F.col("num") / F.col("den")).alias("pred"))


def bias_baseline(ratings: DataFrame, damp: float = 10.0):
    """``mu + b_i + b_u`` with ``b_i = sum(y - mu) / (n_i + damp)`` and then
    ``b_u = sum(y - mu - b_i) / (n_u + damp)``.  Returns (mu column, item biases,
    user biases); ``mu`` is a scalar subquery."""
    mu = ratings.agg(F.avg("rating")).scalar()
    bi = ratings.groupBy("item_id").agg(
        F.count(F.lit(1)).alias("n"),
        ((F.sum("rating") - F.count(F.lit(1)) * mu) / (F.count(F.lit(1)) + F.lit(damp))).alias("b_i"))
    bu = (ratings.join(loose(bi.select("item_id", "b_i")), "item_id")
          .groupBy("user_id").agg(
              F.count(F.lit(1)).alias("n"),
              ((F.sum("rating") - F.count(F.lit(1)) * mu - F.sum("b_i"))
               / (F.count(F.lit(1)) + F.lit(damp))).alias("b_u")))
    return mu, bi, bu


def predict_bias(pairs: DataFrame, mu, bi: DataFrame, bu: DataFrame) -> DataFrame:
    """C9 prediction for given (user, item) pairs; unknown biases count as 0."""
    from pickwise.functions.scores import r6
    return (pairs.select("user_id", "item_id")
            .join(loose(bi.select("item_id", "b_i")), "item_id", "left")
            .join(loose(bu.select("user_id", "b_u")), "user_id", "left")
            .select("user_id", "item_id",
                    r6(mu + F.coalesce("b_i", F.lit(0.0)) + F.coalesce("b_u", F.lit(0.0))).alias("pred")))


def pair_rules(lineitem: DataFrame, min_count: int = 2, chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """Directed pair rules over order baskets (distinct parts per order):
    count, support = count / orders, confidence = count / count(ante),
    lift = count * orders / (count(ante) count(cons))."""
    from pickwise.functions.scores import r6
    baskets = lineitem.select(F.col("l_orderkey").alias("basket"), F.col("l_partkey").alias("item_id")).distinct()
    n_orders = baskets.select("basket").distinct().agg(F.count(F.lit(1))).scalar()
    cnt = baskets.groupBy("item_id").agg(F.count(F.lit(1)).alias("c"))
    pc = (co_pairs(baskets, "basket", "item_id", chunk=chunk).groupBy("a", "b")
          .agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= F.lit(min_count)))
    d = both_ways(pc, keep=["n"])
    j = (d.join(loose(cnt.select(F.col("item_id").alias("id"), F.col("c").alias("ca"))), "id")
         .join(loose(cnt.select(F.col("item_id").alias("other"), F.col("c").alias("cb"))), "other"))
    return j.select(F.col("id").alias("ante"), F.col("other").alias("cons"), "n",
                    r6(F.col("n") / n_orders).alias("support"),
                    r6(F.col("n") / F.col("ca")).alias("confidence"),
                    # products of counts pass the bigint range on large tables: doubles
                    r6(F.col("n").cast("double") * n_orders / (F.col("ca").cast("double") * F.col("cb"))).alias("lift"))


def graph_walk(inter: DataFrame, steps: int = 10, damping: float = 0.85,
               seeds: DataFrame | None = None, checkpoint_every: int = 5) -> DataFrame:
    """Random walk with restart on the bipartite user-item graph.

    The restart set is ``seeds`` (user_id column; default every user), with
    mass 1 spread evenly over it.  Each step sends ``damping * m / degree``
    along every edge and returns ``1 - damping`` of the seed mass to the seeds;
    ``steps`` is fixed (no convergence test), so results repeat.  State is one
    row per node; every ``checkpoint_every`` steps it is checkpointed to the
    shared folder, cutting the lineage.  Returns (kind, node, mass).
    """
    from pickwise.session import checkpoint_dir
    checkpoint_dir(inter.sparkSession)
    e = inter.select("user_id", "item_id")
    edges = (e.select(F.lit("u").alias("k"), F.col("user_id").alias("id"),
                      F.lit("i").alias("dk"), F.col("item_id").alias("did"))
             .unionByName(e.select(F.lit("i").alias("k"), F.col("item_id").alias("id"),
                                   F.lit("u").alias("dk"), F.col("user_id").alias("did"))))
    deg = edges.groupBy("k", "id").agg(F.count(F.lit(1)).alias("d"))
    seed_ids = (seeds if seeds is not None else e).select(F.col("user_id").alias("id")).distinct()
    n_seeds = seed_ids.agg(F.count(F.lit(1))).scalar()
    restart = seed_ids.select(F.lit("u").alias("k"), "id", (F.lit(1.0) / n_seeds).alias("m"))
    mass = restart
    # written once: every step reads the edges with their degrees instead of joining them anew
    out_edges = edges.join(loose(deg), ["k", "id"]).checkpoint(eager=True)
    for t in range(steps):
        spread = (out_edges.join(loose(mass), ["k", "id"])
                  .select(F.col("dk").alias("k"), F.col("did").alias("id"),
                          (F.lit(damping) * F.col("m") / F.col("d")).alias("m")))
        back = restart.select("k", "id", (F.lit(round(1.0 - damping, 12)) * F.col("m")).alias("m"))
        mass = spread.unionByName(back).groupBy("k", "id").agg(F.sum("m").alias("m"))
        if (t + 1) % checkpoint_every == 0 and t + 1 < steps:
            mass = mass.checkpoint(eager=True)
    return mass.select(F.col("k").alias("kind"), F.col("id").alias("node"), F.col("m").alias("mass"))


def graph_push(inter: DataFrame, seeds: DataFrame, rounds: int = 20, damping: float = 0.85,
               eps: float = 1e-4, checkpoint_every: int = 4) -> DataFrame:
    """C15 per seed: (seed, kind, node, mass, residual), the random walk with restart from each
    of ``seeds`` (user_id) on its own, by forward push.

    All of a seed's mass starts as residual on the seed.  A round takes every node whose residual
    is at least ``eps`` times its degree, keeps ``1 - damping`` of it as mass and sends the rest
    evenly along its edges; smaller residuals wait.  It ends when none is left to push, or after
    ``rounds``.  The mass differs from the exact walk by no more than the residuals left: in all
    by their sum, and once pushing has ended every node's residual is under ``eps`` x degree.  A
    seed touches some ``1 / (eps (1 - damping))`` edges at most, however large the graph.
    """
    from pickwise.session import checkpoint_dir
    checkpoint_dir(inter.sparkSession)
    e = inter.select("user_id", "item_id")
    edges = (e.select(F.lit("u").alias("kind"), F.col("user_id").alias("node"), F.lit("i").alias("dk"), F.col("item_id").alias("dn"))
             .unionByName(e.select(F.lit("i").alias("kind"), F.col("item_id").alias("node"), F.lit("u").alias("dk"), F.col("user_id").alias("dn"))))
    degree = edges.groupBy("kind", "node").agg(F.count(F.lit(1)).alias("d")).checkpoint(eager=True)
    start = seeds.select(F.col("user_id").alias("seed")).distinct()
    state = (start.select("seed", F.lit("u").alias("kind"), F.col("seed").alias("node"), F.lit(0.0).alias("mass"), F.lit(1.0).alias("residual"))
             .join(loose(degree), ["kind", "node"]))  # a seed without edges has no walk
    for t in range(rounds):
        large = F.col("residual") >= F.lit(eps) * F.col("d")
        moving = state.where(large)
        if t % checkpoint_every == 0:  # a look whether there is anything to push, where the state has been written anyway
            state = state.checkpoint(eager=True)
            moving = state.where(large)
            if moving.isEmpty():
                break
        sent = (moving.select("seed", "kind", "node", (F.lit(damping) * F.col("residual") / F.col("d")).alias("r"))
                .join(loose(edges), ["kind", "node"])
                .groupBy("seed", F.col("dk").alias("kind"), F.col("dn").alias("node")).agg(F.sum("r").alias("got")))
        kept = state.select("seed", "kind", "node",
                            F.when(large, F.col("mass") + F.lit(round(1.0 - damping, 12)) * F.col("residual")).otherwise(F.col("mass")).alias("mass"),
                            F.when(large, F.lit(0.0)).otherwise(F.col("residual")).alias("residual"))
        every = kept.unionByName(sent.select("seed", "kind", "node", F.lit(0.0).alias("mass"), F.col("got").alias("residual")))
        state = (every.groupBy("seed", "kind", "node").agg(F.sum("mass").alias("mass"), F.sum("residual").alias("residual"))
                 .join(loose(degree), ["kind", "node"]))
    return state.select("seed", "kind", "node", "mass", "residual")

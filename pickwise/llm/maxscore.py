"""Exact top-k by inner product with MaxScore.

A vector's dimensions are its terms, with integer weights.  A shard of candidates keeps a
posting list to each dimension, in the order of the values, so that a query reads it from
the end where its own weight adds most.  What a term can add over its least is its score
bound in the shard.

A query's threshold is the k-th best score it has found so far, in this shard and those
before.  Its terms are split by it: those of the smallest bounds, which together with the
least sums of all stay under the threshold, are not essential.  A candidate worth finding
is beyond its least in some essential term, so only the postings of those are traversed, a
block of each at a time from the greatest impact on.  Candidates that turn up are probed in
the other terms, eight at a time by falling bound, while their score and the bound on the
rest compete with the threshold.  As it rises fewer terms are essential; the shard is done
once what the terms can still add at the depth reached stays under it.

A block of queries reads the shards one after the other in one task and keeps its lists
between them; blocks of queries run apart.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pickwise.llm.common import block_count, written

SHARD, QUERY_BLOCK, LEAST_BLOCK = 8192, 1024, 64
POSTINGS, STEP = 64, 8  # postings read of a term at first (then twice as many each time), terms probed at a time


def quantised(vectors: DataFrame, factor: int = 1024) -> DataFrame:
    """(vec_id, v): v holds floor(factor * x) of each component, for every row.

    Vectors that are null or hold null or non-finite components are left out; rows that
    share an id are candidates (and queries) of their own; rows without id take no part.
    """
    x = F.transform("embedding", lambda c: c.cast("double"))
    fine = (F.col("vec_id").isNotNull() & F.col("embedding").isNotNull()
            & ~F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf"))))
    return (vectors.select(F.col("vec_id").cast("long"), "embedding", x.alias("x")).filter(fine)
            .select("vec_id", F.transform("x", lambda c: F.floor(factor * c).cast("long")).alias("v")))


def number_type(vectors: DataFrame) -> str:
    """The smallest integer type that holds all components.  Raises ValueError where a sum of
    products could pass the range of a long."""
    low, high, size = vectors.agg(F.min(F.array_min("v")), F.max(F.array_max("v")), F.max(F.size("v"))).first()
    most = max(abs(low or 0), abs(high or 0))
    if (size or 0) * most * most >= 1 << 63:
        raise ValueError("scores of these vectors pass the range of a long")
    return next(t for t, n in (("<i2", 15), ("<i4", 31), ("<i8", 63)) if most < 1 << n)


def packed(rows: DataFrame, block: str, kind: str) -> DataFrame:
    """(block, ids, dims, data): the vectors of a block as one matrix, shorter ones ended by zeros."""
    def pack(key, table):
        vs = table.column("v").combine_chunks()
        sizes = vs.value_lengths().to_numpy().astype(np.int64)
        width = int(sizes.max(initial=0))
        m = np.zeros((len(sizes), width), kind)
        at = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        m[np.repeat(np.arange(len(sizes)), sizes), at] = vs.flatten().to_numpy()
        ids = table.column("vec_id").to_numpy().astype(np.int64)
        order = np.argsort(ids, kind="stable")
        return pa.table({block: pa.array([key[0].as_py()], pa.int64()), "ids": [ids[order].tobytes()],
                         "dims": pa.array([width], pa.int32()), "data": [m[order].tobytes()]})
    return rows.groupBy(block).applyInArrow(pack, f"{block} long, ids binary, dims int, data binary")


class Shard:
    """Candidates in id order: values and posting lists by dimension."""

    def __init__(self, ids: np.ndarray, rows: np.ndarray):
        self.ids = ids
        self.columns = np.ascontiguousarray(rows.T).astype(np.int64)
        self.postings = np.argsort(self.columns, axis=1, kind="stable").astype(np.int32)  # by rising value
        self.low, self.high = self.columns.min(axis=1), self.columns.max(axis=1)


class Query:
    """A query's k best so far; ``probed`` counts the candidates that were scored at all."""

    def __init__(self, own: int, weights: np.ndarray, k: int):
        self.own, self.weights, self.k, self.probed = own, weights.astype(np.int64), k, 0
        self.scores, self.found = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.theta: int | None = None

    def meet(self, shard: Shard) -> None:
        dims = min(len(self.weights), len(shard.low))
        weights = self.weights[:dims]
        one, other = weights * shard.low[:dims], weights * shard.high[:dims]
        least, bound = np.minimum(one, other), np.abs(other - one)
        terms = np.argsort(-bound, kind="stable")
        base = int(least.sum())
        rest = np.concatenate((np.cumsum(bound[terms][::-1])[::-1], [0]))  # what the terms from i on add at most
        n = len(shard.ids)
        new = shard.ids != self.own  # candidates not met yet
        left, depth, step = int(new.sum()), 0, POSTINGS
        while left:
            essential = dims if self.theta is None else int(np.searchsorted(-(base + rest), -self.theta, "right"))
            if self.theta is not None and base + int(rest[0]) < self.theta:
                return
            essential = min(essential, dims)
            upto = min(n, depth + step)
            if upto == n or not essential:  # lists read to the end, or no threshold to split by: the rest
                some = np.flatnonzero(new)
            else:
                hit = np.zeros(n, bool)
                for t in terms[:essential].tolist():
                    posting = shard.postings[t]
                    hit[posting[n - upto:n - depth] if weights[t] > 0 else posting[depth:upto]] = True
                some = np.flatnonzero(hit & new)
            new[some] = False
            left -= len(some)
            self.probe(shard, some, weights, terms, rest, least)
            depth, step = upto, 2 * step
            if self.theta is not None and left:
                essential = min(dims, int(np.searchsorted(-(base + rest), -self.theta, "right")))
                top = terms[:essential]
                at = np.where(weights[top] > 0, n - 1 - depth, depth)
                deep = weights[top] * shard.columns[top, shard.postings[top, np.clip(at, 0, n - 1)]] - least[top]
                if base + int(deep.sum()) + int(rest[essential]) < self.theta:
                    return  # whatever was not met stays under the threshold

    def probe(self, shard: Shard, some: np.ndarray, weights, terms, rest, least) -> None:
        """Whole scores of the candidates that stay competitive; they enter the list."""
        self.probed += len(some)
        score = np.full(len(some), int(least.sum()), np.int64)
        for i in range(0, len(terms), STEP):
            if self.theta is not None:
                stays = score + rest[i] >= self.theta
                if not stays.all():
                    some, score = some[stays], score[stays]
            if not len(some):
                return
            t = terms[i:i + STEP]
            score += weights[t] @ shard.columns[np.ix_(t, some)] - int(least[t].sum())
        scores, ids = np.concatenate((self.scores, score)), np.concatenate((self.found, shard.ids[some]))
        if len(scores) > self.k:
            stays = scores >= np.partition(scores, len(scores) - self.k)[len(scores) - self.k]
            scores, ids = scores[stays], ids[stays]
        order = np.lexsort((ids, -scores))[:self.k]
        self.scores, self.found = scores[order], ids[order]
        if len(order) == self.k:
            self.theta = int(self.scores[-1])


def rows_of(row: dict, kind: str) -> tuple[np.ndarray, np.ndarray]:
    ids = np.frombuffer(row["ids"], np.int64)
    return ids, np.frombuffer(row["data"], kind).reshape(len(ids), row["dims"])


def max_score(k: int, kind: str):
    """mapInArrow function over (qb, seq, ids, dims, data): a block of queries, then the shards it reads."""
    def results(queries):
        columns = ([np.full(len(q.found), q.own, np.int64) for q in queries], [q.found for q in queries], [q.scores for q in queries])
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in columns], names=["query_id", "vec_id", "score"])

    def run(batches):
        asking, queries = None, []
        for batch in batches:
            for row in batch.to_pylist():
                if row["seq"] < 0:
                    if queries:
                        yield results(queries)
                    ids, vectors = rows_of(row, kind)
                    asking, queries = row["qb"], [Query(own, v, k) for own, v in zip(ids.tolist(), vectors)]
                elif row["qb"] == asking:  # a block without queries asks nothing
                    shard = Shard(*rows_of(row, kind))
                    for query in queries:
                        query.meet(shard)
        if queries:
            yield results(queries)
    return run


def top_k(vectors: DataFrame, queries: DataFrame, k: int = 10, shard: int = SHARD,
          query_block: int = QUERY_BLOCK) -> DataFrame:
    """(query_id, rank, vec_id, score): each query's k best candidates, ties to the smaller id.

    Both tables are ``quantised`` (vec_id, v).  A query never finds its own id; the
    rows of an id asked more than once share one list of k.  Fewer
    candidates than k give all of them; vectors of other lengths count as ended by
    zeros; empty tables give an empty result; scores that could pass the range of a long
    raise ValueError.  Every block of queries reads every shard, a packed matrix a row; no
    task holds more than one of each.
    """
    kind = number_type(vectors)
    n_shards, n_queries = block_count(vectors.count(), shard), queries.count()
    least = min(query_block, LEAST_BLOCK)
    n_blocks = max(block_count(n_queries, query_block),
                   min(block_count(n_queries, least), 2 * vectors.sparkSession.sparkContext.defaultParallelism))
    home = lambda n: F.pmod(F.xxhash64("vec_id"), F.lit(n)).cast("long")
    shards = written(packed(vectors.withColumn("seq", home(n_shards)), "seq", kind))
    blocks = packed(queries.withColumn("qb", home(n_blocks)), "qb", kind)
    asked = blocks.select("qb", F.lit(-1).cast("long").alias("seq"), "ids", "dims", "data")
    # a block starts with a shard of its own, so that not all read the same one at first
    read = shards.select(F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n_blocks - 1).cast("long"))).alias("qb"),
                         F.pmod(F.col("seq") - F.col("qb"), F.lit(n_shards)).alias("seq"), "ids", "dims", "data")
    rows = asked.union(read).repartition(2 * n_blocks, "qb").sortWithinPartitions("qb", "seq")
    found = rows.mapInArrow(max_score(k, kind), "query_id long, vec_id long, score long")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def search(vectors: DataFrame, k: int = 10, every: int = 100) -> DataFrame:
    """``top_k`` with the rows whose id is divisible by ``every`` as queries."""
    rows = written(quantised(vectors))
    return top_k(rows, rows.filter(F.col("vec_id") % every == 0), k)

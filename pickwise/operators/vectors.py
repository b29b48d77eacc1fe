"""Nearest vectors by cosine, exact in tiles and approximate by an inverted file.

Scores are cosines in millionths; floats are widened to double before multiplying.
Vectors are compared with vectors of their own length only; rows without id or vector
and zero vectors, which have no direction, take no part.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pickwise.operators.rerank import top_k
from pickwise.operators.skew import loose
from pickwise.session import checkpoint_dir

BLOCK = 2048            # vectors that are read at a time
ASKED = 64 << 20        # bytes of a block of queries with their lists
SAMPLE_ROWS = 1 << 18   # vectors that centroids are fitted on, at most
MOST_CELLS = 1 << 14    # centroids, at most; beyond it cells grow
CELL_SAMPLE = 32        # vectors to fit a centroid on
QUERIES = 256           # vectors whose true neighbours tell how many cells to probe
CHUNK = 512             # queries multiplied at a time
SCORED = 1 << 22        # numbers of vectors scored in doubles at a time
ITSELF = -(1 << 62)     # under the key of any score


def _valid(vectors: DataFrame, id_col: str, vec_col: str) -> DataFrame:
    """(id, v, size): float vectors stay float, others become double."""
    element = vectors.schema[vec_col].dataType.elementType
    kind = "array<float>" if isinstance(element, T.FloatType) else "array<double>"
    v = F.col(vec_col).cast(kind)
    return (vectors.select(F.col(id_col).cast("bigint").alias("id"), v.alias("v"), F.size(v).alias("size"))
            .where(F.col("id").isNotNull() & F.exists("v", lambda x: x != 0.0)
                   & ~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))))


def _matrix(column) -> np.ndarray:
    """The vectors of an Arrow list column, all of one length, as rows of doubles."""
    vs = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    n = len(vs)
    return vs.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(n, -1)


class Closest:
    """The running k best of some query vectors, by score, ties to the smaller id.

    Cosines are first taken in floats, of unit vectors.  Only those that reach the k-th best score
    that their query has so far, within the floats' error, are scored in doubles: most pairs
    are a product and a comparison.
    """

    def __init__(self, ids: np.ndarray, vectors: np.ndarray, k: int):
        self.ids, self.vectors, self.k = ids, vectors, k
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.unit = (vectors / self.norms[:, None]).astype(np.float32)
        self.score = np.full((len(ids), k), ITSELF)
        self.other = np.zeros((len(ids), k), np.int64)

    def meet(self, ids: np.ndarray, vectors: np.ndarray) -> None:
        norms = np.sqrt((vectors * vectors).sum(1))
        unit = (vectors / norms[:, None]).astype(np.float32)
        size = vectors.shape[1]
        off = (size + 4) * 2.0 ** -23 + 1e-9  # more than a float's cosine is off
        piece = max(1, SCORED // max(1, size))
        room = np.empty((min(CHUNK, len(self.ids)), len(ids)), np.float32)
        for lo in range(0, len(self.ids) if len(ids) else 0, CHUNK):
            own = self.ids[lo:lo + CHUNK]
            near = np.matmul(self.unit[lo:lo + CHUNK], unit.T, out=room[:len(own)])
            least = self.score[lo:lo + CHUNK, -1].astype(np.float64)
            new = np.flatnonzero(least == ITSELF)  # lists that are not full: the k best of these vectors alone
            if len(new):
                least[new] = -2e6
                if len(ids) > self.k:
                    cos = near[new]
                    cos[own[new][:, None] == ids[None, :]] = -2.0
                    cos = np.partition(cos, len(ids) - self.k, axis=1)[:, len(ids) - self.k].astype(np.float64)
                    least[new] = np.floor((cos - off) * 1e6 + 0.5)
            reach = np.nextafter(((least - 0.5) / 1e6 - off).astype(np.float32), np.float32(-4.0))
            some = np.flatnonzero(near.max(axis=1) >= reach)
            who, at = np.divmod(np.flatnonzero((near[some] >= reach[some, None]).ravel()), len(ids))
            who = some[who]
            real = ids[at] != own[who]
            who, at = who[real], at[real]
            for i in range(0, len(who), piece):
                w, a = lo + who[i:i + piece], at[i:i + piece]
                dot = np.einsum("ij,ij->i", self.vectors[w], vectors[a])
                score = np.floor(dot / (self.norms[w] * norms[a]) * 1e6 + 0.5).astype(np.int64)
                ok = score >= np.maximum(least[w - lo], self.score[w, -1])
                if ok.any():
                    self._merge(w[ok], ids[a[ok]], score[ok])

    def _merge(self, who: np.ndarray, other: np.ndarray, score: np.ndarray) -> None:
        some = np.unique(who)
        who = np.concatenate((np.repeat(some, self.k), who))
        other = np.concatenate((self.other[some].ravel(), other))
        score = np.concatenate((self.score[some].ravel(), score))
        order = np.lexsort((other, -score, who))
        who, other, score = who[order], other[order], score[order]
        start = np.flatnonzero(np.concatenate(([True], who[1:] != who[:-1])))
        rank = np.arange(len(who)) - np.repeat(start, np.diff(np.append(start, len(who))))
        keep = rank < self.k
        self.score[who[keep], rank[keep]] = score[keep]
        self.other[who[keep], rank[keep]] = other[keep]

    def columns(self) -> list[np.ndarray]:
        """(id, other, score)"""
        full = self.score != ITSELF
        return [np.repeat(self.ids, full.sum(1)), self.other[full], self.score[full]]


def _best(qid: np.ndarray, q: np.ndarray, rid: np.ndarray, r: np.ndarray, k: int):
    """(id, other, score): the k best of ``r`` for each of ``q``, ties to the smaller id."""
    now = Closest(qid, q, k)
    for i in range(0, len(rid), BLOCK):
        now.meet(rid[i:i + BLOCK], r[i:i + BLOCK])
    return now.columns()


def _packed(rows: DataFrame, block: str, kind: str) -> DataFrame:
    """One row to (size, block): the ids and the vectors as one matrix of ``kind``."""
    def pack(key, table):
        m = _matrix(table.column("v")).astype(kind)
        return pa.table({"size": pa.array([key[0].as_py()], pa.int32()), block: pa.array([key[1].as_py()], pa.int32()),
                         "ids": [table.column("id").to_numpy().astype(np.int64).tobytes()], "data": [m.tobytes()]})
    return rows.groupBy("size", block).applyInArrow(pack, f"size int, {block} int, ids binary, data binary")


def nearest(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
            block: int = BLOCK) -> DataFrame:
    """Exact k nearest vectors by cosine, (id, other, score, rank), ties to the smaller id.

    Exact all-pairs search is a product by definition.  The queries fall into hash blocks of
    ``ASKED`` bytes at most with their lists, and into enough of them to occupy the cluster; a
    task takes one and reads all vectors in packed blocks of about ``block``, holding the k best
    of each query only.  What is sent is the vectors once to a block of queries, and k rows to a query.
    """
    v = _valid(vectors, id_col, vec_col)
    kind = "float64" if "double" in v.schema["v"].dataType.simpleString() else "float32"
    spark = v.sparkSession
    checkpoint_dir(spark)
    n, numbers = v.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    nb = max(1, math.ceil(n / block))
    nq = max(1, math.ceil((8 * numbers + 24 * k * n) / ASKED), min(n, 2 * spark.sparkContext.defaultParallelism))
    place = lambda parts: F.pmod(F.xxhash64("id"), F.lit(parts)).cast("int")
    blocks = _packed(v.withColumn("seq", place(nb)), "seq", kind).checkpoint(eager=True)
    asked = _packed(v.withColumn("qb", place(nq)), "qb", kind).withColumn("seq", F.lit(-1))
    read = blocks.withColumn("qb", F.explode(F.sequence(F.lit(0), F.lit(nq - 1))))
    rows = (asked.unionByName(read).repartition(4 * nq, "size", "qb").sortWithinPartitions("size", "qb", "seq")
            .select("size", "qb", "seq", "ids", "data"))

    def search(batches):
        asking, now = None, None
        done = lambda: pa.RecordBatch.from_arrays([pa.array(c) for c in now.columns()], names=["id", "other", "score"])
        for batch in batches:
            for row in batch.to_pylist():
                ids = np.frombuffer(row["ids"], np.int64)
                data = np.frombuffer(row["data"], kind).astype(np.float64).reshape(len(ids), -1)
                if row["seq"] < 0:
                    if now is not None:
                        yield done()
                    asking, now = (row["size"], row["qb"]), Closest(ids, data, k)
                elif (row["size"], row["qb"]) == asking:  # a block without queries asks nothing
                    now.meet(ids, data)
        if now is not None:
            yield done()

    found = rows.mapInArrow(search, "id bigint, other bigint, score bigint")
    return top_k(found, "id", k, key="other").select("id", "other", "score", "rank")


# ---------------------------------------------------------------- T9

def cell_count(n: int) -> int:
    """Cells for ``n`` vectors: about sqrt(n) / 9 of them while cells are under 4,096 rows, then
    one to 4,096 rows, up to ``MOST_CELLS``."""
    rows = max(64, min(4096, int(9 * math.sqrt(max(1, n)))))
    return max(1, min(MOST_CELLS, round(n / rows)))


def fit_centroids(sample: np.ndarray, cells: int, rounds: int = 12, seed: int = 42) -> np.ndarray:
    """Spherical k-means of unit vectors: ``cells`` unit centroids (fewer if vectors are fewer)."""
    rnd = np.random.default_rng(seed)
    cells = min(cells, len(sample))
    centres = sample[rnd.choice(len(sample), cells, replace=False)].copy()
    for _ in range(rounds if cells > 1 else 0):
        home = _closest_cells(sample, centres, 1)[:, 0]
        sums = np.zeros_like(centres)
        np.add.at(sums, home, sample)
        size = np.linalg.norm(sums, axis=1)
        lost = size < 1e-12  # an empty cell starts anew at a random vector
        sums[lost] = sample[rnd.choice(len(sample), int(lost.sum()))]
        centres = sums / np.where(lost, 1.0, size)[:, None]
    return centres


def _closest_cells(rows: np.ndarray, centres: np.ndarray, probes: int) -> np.ndarray:
    """The ``probes`` closest centroids of each row, closest first."""
    out = []
    for i in range(0, len(rows), CHUNK):
        far = -(rows[i:i + CHUNK] @ centres.T)
        if probes < len(centres):
            some = np.argpartition(far, probes - 1, axis=1)[:, :probes]
            far = np.take_along_axis(far, some, 1)
            out.append(np.take_along_axis(some, np.argsort(far, axis=1, kind="stable"), 1))
        else:
            out.append(np.argsort(far, axis=1, kind="stable"))
    return np.concatenate(out) if out else np.zeros((0, probes), np.int64)


def _unit(m: np.ndarray) -> np.ndarray:
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def _sampled(rows: DataFrame, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(ids, unit vectors) of the first ``n`` rows by hash of the id, a bounded number."""
    some = rows.orderBy(F.xxhash64("id"), "id").select("id", "v").limit(n).toArrow()
    if not some.num_rows:
        return np.zeros(0, np.int64), np.zeros((0, 1))
    return some.column("id").to_numpy().astype(np.int64), _unit(_matrix(some.column("v")))


def probes_for(rows: DataFrame, centres: np.ndarray, k: int, recall: float, queries: int = QUERIES) -> int:
    """Least number of cells that hold ``recall`` of the true k nearest of a sample.

    One pass: every vector meets the sampled ones and brings its cell; the share of true
    neighbours found in the first p cells of their query is measured for every p.
    """
    own, sample = _sampled(rows, queries)

    def closest(batches):
        best, home = np.full((len(own), 0), -np.inf), np.zeros((len(own), 0), np.int64)
        for batch in batches:
            if not batch.num_rows:
                continue
            m = _unit(_matrix(batch.column(1)))
            cos = sample @ m.T
            cos[own[:, None] == batch.column(0).to_numpy()[None, :]] = -np.inf
            best = np.hstack((best, cos))
            home = np.hstack((home, np.broadcast_to(_closest_cells(m, centres, 1)[:, 0], cos.shape)))
            if best.shape[1] > k:
                at = np.argpartition(-best, k - 1, axis=1)[:, :k]
                best, home = np.take_along_axis(best, at, 1), np.take_along_axis(home, at, 1)
        q, at = np.nonzero(best > -np.inf)
        yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(best[q, at]), pa.array(home[q, at])], names=["q", "cos", "cell"])

    first = Window.partitionBy("q").orderBy(F.desc("cos"))
    found = (rows.select("id", "v").mapInArrow(closest, "q bigint, cos double, cell bigint")
             .withColumn("r", F.row_number().over(first)).where(F.col("r") <= k).select("q", "cell").toArrow())
    if not found.num_rows:
        return 1
    order = _closest_cells(sample, centres, len(centres))
    place = np.argsort(order, axis=1)[found.column("q").to_numpy(), found.column("cell").to_numpy()]
    share = np.cumsum(np.bincount(place, minlength=len(centres))) / len(place)
    return int(np.searchsorted(share, recall) + 1)


def _in_cells(rows: DataFrame, centres: np.ndarray, probes: int) -> DataFrame:
    """(cell, id, v): each row in the lists of its ``probes`` closest cells."""
    kind = rows.schema["v"].dataType.simpleString().replace("array", "list")
    element = pa.float32() if "float" in kind else pa.float64()

    def run(batches):
        for batch in batches:
            for i in range(0, batch.num_rows, 4 * CHUNK):
                some = batch.slice(i, 4 * CHUNK)
                m = _matrix(some.column(1))
                cells = _closest_cells(_unit(m), centres, probes)
                at = np.repeat(np.arange(len(m)), cells.shape[1])
                values = pa.array(m[at].ravel(), element)
                cuts = np.arange(0, len(values) + 1, m.shape[1], dtype=np.int32)
                yield pa.RecordBatch.from_arrays([pa.array(cells.ravel().astype(np.int32)), some.column(0).take(pa.array(at)),
                                                  pa.ListArray.from_arrays(cuts, values)], names=["cell", "id", "v"])
    return rows.select("id", "v").mapInArrow(run, f"cell int, id bigint, v {rows.schema['v'].dataType.simpleString()}")


def inverted_file(rows: DataFrame, k: int, recall: float = 0.95, cells: int | None = None, probes: int | None = None,
                  block: int = 4 * BLOCK, seed: int = 42) -> DataFrame:
    """(id, other, score): the best k of each row of one vector length among the rows in its cells.

    ``rows`` is (id, v), ids unique.  A cell's list goes in parts of about ``block`` rows, and so
    do the queries that probe it, so a crowded cell is many tiles.
    """
    n = rows.count()
    cells = cells or cell_count(n)
    _, sample = _sampled(rows, min(SAMPLE_ROWS, max(QUERIES, CELL_SAMPLE * cells)))
    centres = fit_centroids(sample, cells, seed=seed)
    p = min(probes or probes_for(rows, centres, k, recall), max(1, len(centres)))
    base, asked = _in_cells(rows, centres, 1), _in_cells(rows, centres, p)
    sized = lambda df, name: df.groupBy("cell").agg(
        F.ceil(F.count(F.lit(1)) / F.lit(block)).cast("int").alias(name))
    # one row to a cell: MOST_CELLS rows at most
    parts = F.broadcast(sized(base.select("cell"), "parts").join(sized(asked.select("cell"), "q_parts"), "cell"))
    side = lambda df, own, other, n_own, n_other: (
        df.join(parts, "cell").withColumn(own, F.pmod(F.xxhash64("id"), F.col(n_own)).cast("int"))
        .withColumn(other, F.explode(F.sequence(F.lit(0), F.col(n_other) - F.lit(1)))).drop("parts", "q_parts"))
    base, asked = side(base, "part", "q_part", "parts", "q_parts"), side(asked, "q_part", "part", "q_parts", "parts")

    def tile(key, queries, lists):
        if not queries.num_rows or not lists.num_rows:
            return pa.table({c: pa.array([], pa.int64()) for c in ("id", "other", "score")})
        out = _best(queries.column("id").to_numpy(), _matrix(queries.column("v")),
                    lists.column("id").to_numpy(), _matrix(lists.column("v")), k)
        return pa.table(dict(zip(("id", "other", "score"), map(pa.array, out))))
    by = ["cell", "part", "q_part"]
    found = asked.groupBy(*by).cogroup(base.groupBy(*by)).applyInArrow(tile, "id bigint, other bigint, score bigint")
    return top_k(found, "id", k, key="other").select("id", "other", "score")


def nearest_ivf(vectors: DataFrame, k: int = 5, id_col: str = "vec_id", vec_col: str = "embedding",
                recall: float = 0.95, cells: int | None = None, probes: int | None = None, seed: int = 42) -> DataFrame:
    """Approximate k nearest vectors by cosine, (id, other, score, rank), by an inverted file.

    Centroids are fitted on a sample (``SAMPLE_ROWS`` vectors at most, ``CELL_SAMPLE`` to a
    cell); every vector stands in the list of its closest centroid and asks the lists of its
    ``probes`` closest ones, where it is scored exactly.  Without ``probes`` their number is
    the least that finds ``recall`` of the true neighbours of ``QUERIES`` sampled vectors
    (0.95, so that 0.9 holds beyond the sample).  Equal vectors are searched for once: a
    representative stands for its copies, which share its list, so a vector that fills a
    third of the table costs one search and a row per copy.
    """
    v = _valid(vectors, id_col, vec_col)
    checkpoint_dir(v.sparkSession)
    reps = v.groupBy("size", "v").agg(F.min("id").alias("rep"))
    member = v.join(loose(reps), ["size", "v"]).select("size", "id", "rep").checkpoint(eager=True)
    reps = reps.select("size", F.col("rep").alias("id"), "v").checkpoint(eager=True)
    parts = []
    for size in sorted(r["size"] for r in reps.select("size").distinct().collect()):  # a search to a vector length
        rows = reps.where(F.col("size") == size).select("id", "v")
        parts.append(inverted_file(rows, k, recall, cells, probes, seed=seed))
    if not parts:
        parts = [reps.select("id", F.col("id").alias("other"), F.col("id").alias("score"))]
    found = parts[0]
    for p in parts[1:]:
        found = found.unionByName(p)
    # each representative's list of k + 1: its own copies, then those of the vectors found
    by_id = Window.partitionBy("rep").orderBy("id")
    first = member.withColumn("r", F.row_number().over(by_id)).where(F.col("r") <= k + 1)
    others = found.join(first.where(F.col("r") <= k).select(F.col("rep").alias("other"), F.col("id").alias("copy")), "other")
    lists = (others.select(F.col("id").alias("rep"), F.col("copy").alias("other"), "score")
             .unionByName(first.select("rep", F.col("id").alias("other"), F.lit(1_000_000).cast("bigint").alias("score"))))
    lists = top_k(lists, "rep", k + 1, key="other").drop("rank")
    each = member.select("id", "rep").join(loose(lists), "rep").where(F.col("other") != F.col("id"))
    return top_k(each, "id", k, key="other").select("id", "other", "score", "rank")

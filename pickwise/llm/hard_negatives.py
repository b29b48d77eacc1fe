"""Hard negatives by exact integer scores, added up from tables (Four Russians).

Dimensions go in groups of eight.  A candidate is held as bit planes: a byte for each
group and bit of its (two's complement) components.  An anchor has a table for each
group: the sum of its components over each of the 256 subsets of the eight.  A plane's
byte looks up the sum of the anchor's components whose bit is set; the sums of a plane's
groups, shifted by the plane's place and added, are the whole inner product.  The sign
plane is subtracted.

Blocks of anchors (their components; a task makes the tables) meet blocks of candidates
(their bytes) once for the positives, in which only rows of the anchor's own label are
scored, and once for the negatives, in which all others are: every pair is scored once.
A task holds one block of each.  A block of anchors is sent to groups of blocks of candidates,
whose number hardly grows, and no join is a broadcast: nothing passes through the driver.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pickwise.llm.common import block_count, written

BLOCK, ANCHORS = 8192, 256  # candidates and anchors to a tile
GROUP = 8
TOGETHER = 64  # blocks of candidates that share a copy of the anchors, at most


def rows_to_mine(vectors: DataFrame, factor: int, shift_every: int, classes: int) -> DataFrame:
    """(row, vec_id, label, v): the rows that take part, numbered; every ``shift_every``-th id's label moves on."""
    moved = F.when(F.col("vec_id") % shift_every == 0, (F.col("label") + 1) % classes).otherwise(F.col("label"))
    unfit = F.exists("x", lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    kept = (vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"),
                           F.col("embedding").cast("array<double>").alias("x"))
            .filter(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("x").isNotNull()).filter(~unfit))
    return kept.select(F.monotonically_increasing_id().alias("row"), "vec_id", moved.alias("label"),
                       F.transform("x", lambda c: F.floor(factor * c).cast("long")).alias("v"))


def planes_needed(low: int, high: int) -> int:
    """Bits of two's complement that hold every component from ``low`` to ``high``."""
    return max((high if high >= 0 else ~high).bit_length(), (low if low >= 0 else ~low).bit_length()) + 1


def matrix(values: pa.ChunkedArray) -> np.ndarray:
    """The vectors as rows, shorter ones ended by zeros to a multiple of eight dimensions."""
    vs = values.combine_chunks()
    sizes = vs.value_lengths().to_numpy().astype(np.int64)
    width = max(GROUP, -(-int(sizes.max(initial=0)) // GROUP) * GROUP)
    m = np.zeros((len(sizes), width), np.int64)
    at = np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)
    m[np.repeat(np.arange(len(sizes)), sizes), at] = vs.flatten().to_numpy()
    return m


def bit_planes(m: np.ndarray, planes: int) -> np.ndarray:
    """(plane, group, row) bytes; bit i of a byte belongs to dimension i of the group."""
    return np.stack([np.packbits(((m >> p) & 1).astype(np.uint8), axis=1, bitorder="little").T for p in range(planes)])


def subset_sums(anchors: np.ndarray) -> np.ndarray:
    """(group, subset, anchor): sums of the anchors' components over the subsets of each group."""
    n, width = anchors.shape
    table = np.zeros((width // GROUP, 1 << GROUP, n), np.int64)
    for i in range(GROUP):  # the subsets with dimension i are those before it, and i
        table[:, 1 << i:2 << i] = table[:, :1 << i] + anchors[:, i::GROUP].T[:, None, :]
    return table


def scores(planes: np.ndarray, tables: np.ndarray) -> np.ndarray:
    """(row, anchor): inner products by look-ups; groups that one side lacks add nothing."""
    groups = min(planes.shape[1], tables.shape[0])
    total = np.zeros((planes.shape[2], tables.shape[2]), np.int64)
    for p in range(len(planes)):
        part = np.zeros_like(total)
        for g in range(groups):
            part += tables[g][planes[p, g]]
        if p == len(planes) - 1:
            total -= part << p
        else:
            total += part << p
    return total


def candidate_blocks(rows: DataFrame, block: int, planes: int) -> DataFrame:
    """(cb, ids, labels, planes): candidates of a block in the order of label, then id."""
    n = block_count(rows.count(), block)

    def pack(key, table):
        ids, labels, at = (table.column(c).to_numpy() for c in ("vec_id", "label", "row"))
        order = np.lexsort((at, ids, labels))
        bits = bit_planes(matrix(table.column("v"))[order], planes)
        return pa.table({"cb": pa.array([key[0].as_py()], pa.int64()), "ids": [ids[order].tobytes()],
                         "labels": [labels[order].tobytes()], "planes": [bits.tobytes()]})
    return (rows.withColumn("cb", F.pmod(F.xxhash64("row"), F.lit(n)).cast("long")).groupBy("cb")
            .applyInArrow(pack, "cb long, ids binary, labels binary, planes binary"))


def anchor_blocks(anchors: DataFrame, block: int, kind: str, columns: tuple = ()) -> DataFrame:
    """(ab, rows, ids, labels, width, data, columns...): anchors of a block as one matrix of ``kind``;
    list columns are kept as they are, in the anchors' order."""
    n = block_count(anchors.count(), block)

    def pack(key, table):
        m = matrix(table.column("v"))
        out = {"ab": pa.array([key[0].as_py()], pa.int64()), "width": pa.array([m.shape[1]], pa.int64()), "a_data": [m.astype(kind).tobytes()]}
        for name, column in (("a_rows", "row"), ("a_ids", "vec_id"), ("a_labels", "label")):
            out[name] = [table.column(column).to_numpy().tobytes()]
        for c in columns:
            out[c] = pa.array([table.column(c).to_pylist()], pa.list_(pa.list_(pa.int64())))
        return pa.table(out).select(["ab", "a_rows", "a_ids", "a_labels", "width", "a_data", *columns])
    extra = "".join(f", {c} array<array<long>>" for c in columns)
    return (anchors.withColumn("ab", F.pmod(F.xxhash64("row"), F.lit(n)).cast("long")).groupBy("ab")
            .applyInArrow(pack, "ab long, a_rows binary, a_ids binary, a_labels binary, width long, a_data binary" + extra))


def tiles(candidates: DataFrame, anchors: DataFrame, candidate_blocks_: int, planes: int, kind: str, found, schema: str) -> DataFrame:
    """``found(ids, labels, label scores, anchors...)`` of every block of candidates with every block of anchors.

    The blocks of anchors are sent to every group of blocks of candidates by a sort-merge join on
    the group: 16 groups to a core, or more where one would pass ``TOGETHER`` blocks.
    """
    names = [f.split()[0] for f in schema.split(", ")]

    def run(batches):
        for batch in batches:
            for row in (batch.slice(i, 1).to_pylist()[0] for i in range(batch.num_rows)):
                labels = np.frombuffer(row["labels"], np.int64)
                ids = np.frombuffer(row["ids"], np.int64)
                bits = np.frombuffer(row["planes"], np.uint8).reshape(planes, -1, len(ids))
                own = np.frombuffer(row["a_labels"], np.int64)
                data = np.frombuffer(row["a_data"], kind).astype(np.int64).reshape(len(own), row["width"])
                out = found(row, ids, labels, bits, own, data)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(c) if c else np.zeros(0, np.int64), pa.int64()) for c in out], names=names)
    cores = candidates.sparkSession.sparkContext.defaultParallelism
    groups = max(min(candidate_blocks_, 16 * cores), -(-candidate_blocks_ // TOGETHER))
    spread = anchors.withColumn("g", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(groups - 1).cast("long"))))
    grouped = candidates.withColumn("g", F.pmod("cb", F.lit(groups)).cast("long"))
    return spread.join(grouped.hint("merge"), "g").drop("g", "cb", "ab").mapInArrow(run, schema)


def label_parts(labels: np.ndarray, own: np.ndarray):
    """(anchors of a label, first and last candidate of that label) for the labels of a block's anchors."""
    for label in np.unique(own).tolist():
        yield np.flatnonzero(own == label), int(np.searchsorted(labels, label)), int(np.searchsorted(labels, label, "right"))


def best_positives(k: int):
    def found(row, ids, labels, bits, own, data):
        rows, names = np.frombuffer(row["a_rows"], np.int64), np.frombuffer(row["a_ids"], np.int64)
        out = [[], [], []]
        for who, a, b in label_parts(labels, own):
            if a == b:
                continue
            score = scores(bits[:, :, a:b], subset_sums(data[who]))
            for j, i in enumerate(who.tolist()):
                other = np.flatnonzero(ids[a:b] != names[i])
                mine = score[other, j]
                if len(mine) > k:
                    least = np.partition(mine, len(mine) - k)[len(mine) - k]
                    stays = mine >= least
                    other, mine = other[stays], mine[stays]
                best = np.argsort(-mine, kind="stable")[:k]  # candidates of a label stand by id
                for column, values in zip(out, (np.full(len(best), rows[i]), ids[a:b][other[best]], mine[best])):
                    column.append(values)
        return out
    return found


def hard(k: int, low: int, high: int):
    """Per anchor and positive the first k other-label candidates with low% to high% of the positive's score."""
    def found(row, ids, labels, bits, own, data):
        rows = np.frombuffer(row["a_rows"], np.int64)
        out = [[], [], [], []]
        for who, a, b in label_parts(labels, own):
            tables = subset_sums(data[who])
            rest = np.concatenate((np.arange(a), np.arange(b, len(ids))))
            score = np.concatenate((scores(bits[:, :, :a], tables), scores(bits[:, :, b:], tables)))
            by_id = np.argsort(ids[rest], kind="stable")
            rest, score = rest[by_id], score[by_id]
            for j, i in enumerate(who.tolist()):
                order = np.argsort(-score[:, j], kind="stable")
                falling = -score[order, j]
                for place, positive in enumerate(row["positives"][i]):
                    # low * positive <= 100 * score <= high * positive, in whole numbers
                    first = int(np.searchsorted(falling, -((high * positive) // 100), "left"))
                    last = int(np.searchsorted(falling, (-low * positive) // 100, "right"))
                    some = order[first:min(last, first + k)]
                    for column, values in zip(out, (np.full(len(some), rows[i]), np.full(len(some), place),
                                                    ids[rest[some]], score[some, j])):
                        column.append(values)
        return out
    return found


def hard_negatives(vectors: DataFrame, factor: int = 256, every: int = 100, shift_every: int = 7, classes: int = 10,
                   positives: int = 5, negatives: int = 10, low: int = 30, high: int = 90,
                   block: int = BLOCK, anchor_block: int = ANCHORS) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score).

    Components become floor(factor * x); a row whose id is divisible by ``shift_every`` has
    its label moved on by one among ``classes``.  Anchors are the rows whose id is divisible
    by ``every``; scores are integer inner products, higher ones first, ties by smaller id.
    An anchor's positives are its best ``positives`` rows of the same label, all if fewer;
    for each, the best ``negatives`` rows of other labels whose score is ``low`` to ``high``
    per cent of the positive's.  A positive with a score under zero has none, one with zero
    those of score zero.

    Rows with a null id, label or vector, or a null or non-finite component, take no part.
    A row is never its anchor's candidate under the same id; rows that share an id are
    otherwise rows of their own, also as anchors.  Shorter vectors count as ended by zeros,
    so an empty one scores 0.  Other columns are not read; an empty table gives an empty
    result.  Raises ValueError where a score could pass the range of a long.
    """
    rows = written(rows_to_mine(vectors, factor, shift_every, classes))
    v = F.col("v")
    least, most, size = rows.agg(F.min(F.array_min(v)), F.max(F.array_max(v)), F.max(F.size(v))).first()
    least, most, size = least or 0, most or 0, size or 0
    if size * max(abs(least), abs(most)) ** 2 >= 1 << 63:
        raise ValueError("scores of these vectors pass the range of a long")
    planes = planes_needed(least, most)
    kind = next(t for t in ("int8", "int16", "int32", "int64") if planes <= np.iinfo(t).bits)
    cand = written(candidate_blocks(rows, block, planes))
    n_blocks = block_count(rows.count(), block)
    anchors = rows.filter(F.col("vec_id") % every == 0)

    near = tiles(cand, anchor_blocks(anchors, anchor_block, kind), n_blocks, planes, kind, best_positives(positives),
                 "row long, positive_id long, positive_score long")
    by_score = Window.partitionBy("row").orderBy(F.desc("positive_score"), "positive_id")
    near = written(near.withColumn("p", F.row_number().over(by_score) - 1).filter(F.col("p") < positives))
    lists = near.groupBy("row").agg(F.array_sort(F.collect_list(F.struct("p", "positive_score"))).alias("l"))
    asked = anchors.join(lists.hint("merge"), "row").withColumn("positives", F.col("l.positive_score")).drop("l")

    far = tiles(cand, anchor_blocks(asked, anchor_block, kind, ("positives",)), n_blocks, planes, kind, hard(negatives, low, high),
                "row long, p long, negative_id long, negative_score long")
    by_score = Window.partitionBy("row", "p").orderBy(F.desc("negative_score"), "negative_id")
    far = far.withColumn("rank", F.row_number().over(by_score)).filter(F.col("rank") <= negatives)
    return (far.join(near.withColumn("p", F.col("p").cast("long")).hint("merge"), ["row", "p"])
            .join(anchors.select("row", F.col("vec_id").alias("anchor_id")).hint("merge"), "row")
            .select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"))

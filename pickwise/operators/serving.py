"""Top items by inner product of factors (C10, C11), exact, without forming every product.

Items stand in blocks by falling norm.  A user's product with an item is at most the two
norms multiplied, so a user whose k-th best so far is over that bound is done with all
blocks that follow.  A task takes one block of users and reads the blocks of items in order.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.operators.ordering import global_rank
from pickwise.session import checkpoint_dir

ITEMS, LISTED = 4096, 1 << 22  # items to a block; list places of a block of users
USERS = 1 << 16                # users to a block, at most: the items are sent once to a block
FIELDS = ("ids", "wants", "data")


def _matrix(column) -> np.ndarray:
    vs = column.combine_chunks()
    return vs.flatten().to_numpy().astype(np.float64).reshape(len(vs), -1)


class Users:
    """The running best of a block of users; ``products`` counts the pairs multiplied."""

    def __init__(self, ids: np.ndarray, wants: np.ndarray, vectors: np.ndarray):
        self.ids, self.wants, self.vectors = ids, wants, vectors
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.best = [(np.zeros(0), np.zeros(0, np.int64)) for _ in ids]
        self.least = np.full(len(ids), -np.inf)  # the last of a full list
        self.products = 0

    def meet(self, items: np.ndarray, vectors: np.ndarray, norm: float) -> None:
        """Items whose norms are ``norm`` at most, as those of all blocks that follow are."""
        slack = 1e-9 * (1.0 + norm)
        open_ = np.flatnonzero(self.norms * (norm + slack) >= self.least)
        if not len(open_):
            return
        self.products += len(open_) * len(items)
        for lo in range(0, len(open_), 512):
            some = open_[lo:lo + 512]
            score = self.vectors[some] @ vectors.T
            for row, u in zip(score, some.tolist()):
                at = np.flatnonzero(row >= self.least[u])
                if not len(at):
                    continue
                k = int(self.wants[u])
                if len(at) > k:
                    at = at[row[at] >= np.partition(row[at], len(at) - k)[len(at) - k]]
                scores = np.concatenate((self.best[u][0], row[at]))
                ids = np.concatenate((self.best[u][1], items[at]))
                order = np.lexsort((ids, -scores))[:k]
                self.best[u] = scores[order], ids[order]
                if len(order) == k:
                    self.least[u] = scores[order[-1]]

    def rows(self) -> pa.RecordBatch:
        sizes = [len(s) for s, _ in self.best]
        return pa.RecordBatch.from_arrays([
            pa.array(np.repeat(self.ids, sizes)), pa.array(np.concatenate([i for _, i in self.best])),
            pa.array(np.concatenate([s for s, _ in self.best]))], names=["user_id", "item_id", "product"])


def best_products(users: DataFrame, items: DataFrame) -> DataFrame:
    """(user_id, item_id, product): for each of ``users`` (user_id, v, want) the ``want`` items of
    ``items`` (item_id, v) with the greatest inner products, ties to the smaller id."""
    spark = users.sparkSession
    checkpoint_dir(spark)
    norm = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x.cast("double") * x.cast("double")))
    placed = global_rank(items.select("item_id", "v").withColumn("norm", norm), [F.col("norm").desc(), F.col("item_id").asc()], "place")
    placed = placed.withColumn("block", F.floor((F.col("place") - 1) / F.lit(ITEMS)).cast("int"))
    wanted = users.select("user_id", "v", "want").checkpoint(eager=True)
    n_users, places = wanted.agg(F.count(F.lit(1)), F.coalesce(F.sum("want"), F.lit(0))).first()
    n = max(1, math.ceil(n_users / USERS), math.ceil(places / LISTED), min(n_users, 2 * spark.sparkContext.defaultParallelism))

    kinds = {c: "float32" if "float" in df.schema["v"].dataType.simpleString() else "float64"
             for c, df in (("user_id", users), ("item_id", items))}

    def pack(id_column, number):
        def run(key, table):
            wants = table.column(number).to_numpy().astype(np.float64)
            if id_column == "item_id":
                wants = wants.max(keepdims=True)  # the greatest norm of the block
            ids = table.column(id_column).to_numpy().astype(np.int64)
            return pa.table({"block": pa.array([key[0].as_py()], pa.int32()), "ids": [ids.tobytes()], "wants": [wants.tobytes()],
                             "data": [_matrix(table.column("v")).astype(kinds[id_column]).tobytes()]})
        return run
    schema = "block int, ids binary, wants binary, data binary"
    item_blocks = placed.groupBy("block").applyInArrow(pack("item_id", "norm"), schema).checkpoint(eager=True)
    user_blocks = (wanted.withColumn("block", F.pmod(F.xxhash64("user_id"), F.lit(n)).cast("int"))
                   .groupBy("block").applyInArrow(pack("user_id", "want"), schema))
    asked = user_blocks.select(F.col("block").alias("ub"), F.lit(-1).alias("seq"), *FIELDS)
    read = (item_blocks.withColumn("ub", F.explode(F.sequence(F.lit(0), F.lit(n - 1))))
            .select("ub", F.col("block").alias("seq"), *FIELDS))
    rows = asked.unionByName(read).repartition(4 * n, "ub").sortWithinPartitions("ub", "seq")

    def serve(batches):
        asking, now = None, None
        for batch in batches:
            for row in batch.to_pylist():
                ids, numbers = np.frombuffer(row["ids"], np.int64), np.frombuffer(row["wants"], np.float64)
                kind = kinds["user_id" if row["seq"] < 0 else "item_id"]
                data = np.frombuffer(row["data"], kind).astype(np.float64).reshape(len(ids), -1)
                if row["seq"] < 0:
                    if now is not None:
                        yield now.rows()
                    asking, now = row["ub"], Users(ids, numbers.astype(np.int64), data)
                elif row["ub"] == asking:  # a block without users asks nothing
                    now.meet(ids, data, float(numbers[0]))
        if now is not None:
            yield now.rows()

    return rows.mapInArrow(serve, "user_id bigint, item_id bigint, product double")

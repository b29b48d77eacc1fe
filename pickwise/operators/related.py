"""Exact nearest by cosine of sparse vectors.

Articles go in blocks.  A block holds its vectors and, per term, their postings with the
greatest weight first, so a term's first posting bounds what it can add to any cosine with
the block.  A task takes one block's articles as queries and reads the blocks one after the
other, the own one first; an article's k-th best cosine so far is its threshold and only
rises.  In each block its terms are split: from the most common term on, those whose bounds
together stay under the threshold can't make a candidate.  Only the postings of the others
are read; articles whose sum and rest bound reach the threshold are then scored whole.  A
block whose bounds stay under the threshold altogether is passed over.

Articles are dealt to blocks by their most frequent term, which keeps a language together:
in a block of another one the bounds are small.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.operators import lists
from pickwise.operators.content import tfidf
from pickwise.operators.lists import shared_top_k
from pickwise.operators.near import packed, unpacked
from pickwise.operators.rerank import top_k
from pickwise.session import checkpoint_dir, kept

BLOCK_ENTRIES, LEAST_ENTRIES = 1 << 19, 1 << 16  # vector entries to a block: at most, and at least where cores are free
HALF = 0.5e-6   # scores are whole millionths: this much under a score still rounds to it
SLACK = 1e-11   # more than sums of doubles of unit vectors are off


class Block:
    """Vectors of a block, entry by entry, and the postings of its terms."""

    FIELDS = {"ids": np.int64, "cut": np.int64, "term": np.int32, "w": np.float64, "terms": np.int64,
              "post_cut": np.int64, "post_doc": np.int32, "post_w": np.float64}

    SENT = ("ids", "cut", "term", "w", "terms")  # the postings are made again where a block arrives

    def __init__(self, **arrays):
        for name, kind in self.FIELDS.items():
            setattr(self, name, arrays[name].astype(kind, copy=False))

    @classmethod
    def of(cls, ids: np.ndarray, sizes: np.ndarray, hashes: np.ndarray, w: np.ndarray) -> Block:
        """From article ids, their numbers of terms, and all term hashes and weights in that order."""
        terms, term = np.unique(hashes, return_inverse=True)
        return cls._whole(ids, np.concatenate(([0], np.cumsum(sizes))), term.astype(np.int32), w, terms)

    @classmethod
    def _whole(cls, ids: np.ndarray, cut: np.ndarray, term: np.ndarray, w: np.ndarray, terms: np.ndarray) -> Block:
        doc = np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(cut))
        order = np.lexsort((-w, term))
        return cls(ids=ids, cut=cut, term=term, w=w, terms=terms,
                   post_cut=np.concatenate(([0], np.cumsum(np.bincount(term, minlength=len(terms))))),
                   post_doc=doc[order], post_w=w[order])

    def packed(self) -> dict[str, bytes]:
        return {name: getattr(self, name).tobytes() if name == "w" else packed(getattr(self, name)) for name in self.SENT}

    @classmethod
    def unpacked(cls, row: dict) -> Block:
        return cls._whole(**{name: np.frombuffer(row[name], np.float64) if name == "w" else unpacked(row[name], cls.FIELDS[name])
                             for name in cls.SENT})


def spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... n[0] of them, then those of the next."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


class Search:
    """The running k best of a block's articles; ``visited`` counts the postings read."""

    def __init__(self, queries: Block, k: int, floor: int = 1):
        self.q, self.k, self.floor, self.visited = queries, k, floor, 0
        # (score, id, shared terms, terms) of the best so far, best first
        self.best: list = [(np.zeros(0, np.int64),) * 4 for _ in queries.ids]
        self.least = np.full(len(queries.ids), floor)  # score to be reached

    def meet(self, block: Block) -> None:
        q = self.q
        at = np.minimum(np.searchsorted(block.terms, q.terms), max(0, len(block.terms) - 1))
        there = np.where(block.terms[at] == q.terms, at, -1) if len(block.terms) else np.full(len(q.terms), -1)
        local = there[q.term]
        some = np.flatnonzero(local >= 0)
        if not len(some):
            return
        doc = np.repeat(np.arange(len(q.ids)), np.diff(q.cut))[some]
        local, w = local[some], q.w[some]
        df = np.diff(block.post_cut)[local]
        order = np.lexsort((local, -df, doc))  # an article's most common terms first
        doc, local, w, df = doc[order], local[order], w[order], df[order]
        add = w * block.post_w[block.post_cut[local]]
        cuts = np.searchsorted(doc, np.arange(len(q.ids) + 1))
        weight, mark = np.zeros(len(block.terms)), np.zeros(len(block.terms), bool)

        def added(lo, hi):
            """What the postings of the terms lo..hi add to each article of the block."""
            entry = spans(block.post_cut[local[lo:hi]], df[lo:hi])
            self.visited += len(entry)
            return np.bincount(block.post_doc[entry], block.post_w[entry] * np.repeat(w[lo:hi], df[lo:hi]), len(block.ids))

        for i in np.unique(doc).tolist():
            lo, hi = cuts[i], cuts[i + 1]
            theta = self.least[i] * 1e-6 - HALF - SLACK
            # what the first terms can add: their bounds, or the norm of this part (all vectors are units)
            bound = np.minimum(np.cumsum(add[lo:hi]), np.sqrt(np.cumsum(w[lo:hi] * w[lo:hi])))
            m = int(np.searchsorted(bound, theta))
            if m == hi - lo:
                continue
            dot = added(lo + m, hi)
            rest = bound[m - 1] if m else 0.0
            found = np.flatnonzero((dot + rest >= theta) & (dot > 0.0))
            found = found[block.ids[found] != q.ids[i]]
            if not len(found):
                continue
            mark[local[lo:hi]] = True
            if m:  # whole scores: from the vectors of those found, or from the rest of the postings if these are fewer
                n = block.cut[found + 1] - block.cut[found]
                if n.sum() < df[lo:lo + m].sum():
                    weight[local[lo:hi]] = w[lo:hi]
                    entry = spans(block.cut[found], n)
                    self.visited += len(entry)
                    dot = np.add.reduceat(weight[block.term[entry]] * block.w[entry], np.cumsum(n) - n)
                    weight[local[lo:hi]] = 0.0
                else:
                    dot = (dot + added(lo, lo + m))[found]
            else:
                dot = dot[found]
            self._take(i, block, found, dot, mark)
            mark[local[lo:hi]] = False

    def _take(self, i: int, block: Block, found: np.ndarray, dot: np.ndarray, mark: np.ndarray) -> None:
        score = self.score(i, block, found, dot)
        ok = score >= self.least[i]
        found, score = found[ok], score[ok]
        if len(found) > self.k:
            ok = score >= np.partition(score, len(score) - self.k)[len(score) - self.k]
            found, score = found[ok], score[ok]
        if not len(found):
            return
        n = block.cut[found + 1] - block.cut[found]
        shared = np.add.reduceat(mark[block.term[spans(block.cut[found], n)]].astype(np.int64), np.cumsum(n) - n)
        scores, others, support, size = (np.concatenate(x) for x in zip(self.best[i], (score, block.ids[found], shared, n)))
        order = np.lexsort((others, -scores))[:self.k]
        self.best[i] = scores[order], others[order], support[order], size[order]
        if len(order) == self.k:
            self.least[i] = max(self.floor, int(scores[order][-1]))

    def score(self, i: int, block: Block, found: np.ndarray, dot: np.ndarray) -> np.ndarray:
        return np.floor(dot * 1e6 + 0.5).astype(np.int64)

    def rows(self) -> pa.RecordBatch:
        sizes = np.array([len(b[0]) for b in self.best], np.int64)
        score, other, support, n = (np.concatenate(c) for c in zip(*self.best)) if self.best else (np.zeros(0, np.int64),) * 4
        rank = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes) + 1
        return pa.RecordBatch.from_arrays([pa.array(x.astype(np.int64)) for x in (
            np.repeat(self.q.ids, sizes), other, support, score, rank, np.repeat(np.diff(self.q.cut), sizes), n)],
            names=RESULT.replace(" bigint", "").split(", "))


RESULT = "id bigint, other bigint, support bigint, score bigint, rank bigint, n bigint, other_n bigint"


def one_by_one(batches):
    """The rows of batches as dicts, each made when the one before is done with: a row may be a whole block."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def packed_blocks(vec: DataFrame) -> tuple[int, DataFrame]:
    """(number of blocks, a packed ``Block`` to a row under its number) of (item_id, lead, v), written once."""
    spark = vec.sparkSession
    checkpoint_dir(spark)
    entries = vec.agg(F.coalesce(F.sum(F.size("v").cast("bigint")), F.lit(0))).first()[0]
    n = max(1, -(-entries // BLOCK_ENTRIES), min(2 * spark.sparkContext.defaultParallelism, -(-entries // LEAST_ENTRIES)))
    fields = Block.SENT

    def pack(batches):
        ids, v = [], []
        for batch in batches:
            ids.append(batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64))
            v.append(batch.column(1))
        if sum(map(len, ids)):
            sizes = np.concatenate([x.value_lengths().to_numpy() for x in v]).astype(np.int64)
            flat = [x.flatten() for x in v]
            block = Block.of(np.concatenate(ids), sizes, np.concatenate([x.field("t").to_numpy() for x in flat]),
                             np.concatenate([x.field("w").to_numpy() for x in flat]))
            yield pa.RecordBatch.from_pydict({c: pa.array([x], pa.binary()) for c, x in block.packed().items()})

    blocks = kept(vec.repartitionByRange(n, "lead", F.xxhash64("item_id")).select("item_id", "v")
                  .mapInArrow(pack, ", ".join(f"{c} binary" for c in fields))
                  .withColumn("block", F.spark_partition_id()))
    return n, blocks


def cosine_top_k(vec: DataFrame, k: int, floor: int = 1) -> DataFrame:
    """(id, other, support, score, rank, n, other_n): the k best of each row of (item_id, lead, v), v a
    unit vector as (term, weight), terms distinct numbers; scores from ``floor`` millionths on.

    ``lead`` only says which rows share a block.  ``support`` is the number of shared terms, ``n`` and ``other_n`` those of either side.
    """
    n, blocks = packed_blocks(vec)
    # blocks ask in turns, one to a core at least, where all that they read would be many times the vectors
    size = sum(F.length(c) for c in Block.SENT)
    once = blocks.agg(F.coalesce(F.sum(size), F.lit(0))).first()[0]
    cores = vec.sparkSession.sparkContext.defaultParallelism
    rounds = max(1, min(n // cores, -(-n * once // max(lists.SENT, lists.TIMES * once))))

    def dealt(r):
        # a row to each block as queries, then the blocks that it reads, near ones first
        turn = F.sequence(F.lit(r or 0), F.lit(n - 1), F.lit(rounds)) if rounds > 1 else F.sequence(F.lit(0), F.lit(n - 1))
        asked = blocks.select(F.col("block").alias("qb"), F.lit(-1).alias("seq"), *Block.SENT)
        read = (blocks.withColumn("qb", F.explode(turn))
                .select("qb", F.abs(F.col("qb") - F.col("block")).alias("seq"), *Block.SENT))
        rows = asked.where(F.col("qb") % F.lit(rounds) == F.lit(r or 0)).unionByName(read)
        return (rows.repartitionById(max(2, -(-n // rounds)), F.floor(F.col("qb") / F.lit(rounds)).cast("int"))
                .sortWithinPartitions("qb", "seq"))

    def search(batches):
        asking, now = None, None
        for row in one_by_one(batches):
            if row["seq"] < 0:
                if now is not None:
                    yield now.rows()
                asking, now = row["qb"], Search(Block.unpacked(row), k, floor)
            elif row["qb"] == asking:  # a range without articles has no block and asks nothing
                now.meet(Block.unpacked(row))
        if now is not None:
            yield now.rows()

    return lists.by_rounds(rounds, lambda r: dealt(r).mapInArrow(search, RESULT))


def unit_vectors(articles: DataFrame) -> DataFrame:
    """(item_id, lead, v): each article's unit tf-idf vector as (term hash, weight) by hash, and its
    most frequent term; articles without weight are left out."""
    x = tfidf(articles.where(F.col("item_id").isNotNull()))
    entry = F.struct(F.xxhash64("term").alias("t"), F.col("x").alias("w"))
    vec = x.groupBy("item_id").agg(
        F.array_sort(F.collect_list(entry)).alias("v"), F.sqrt(F.sum(F.col("x") * F.col("x"))).alias("nrm"),
        F.max_by("term", F.struct("tf", "df", "term")).alias("lead")).where(F.col("nrm") > 0)
    return vec.select("item_id", "lead", F.transform("v", lambda e: F.struct(e["t"].alias("t"), (e["w"] / F.col("nrm")).alias("w"))).alias("v"))


def related(articles: DataFrame, k: int = 5, min_score: float = 0.0) -> DataFrame:
    """Related articles, per article the top k of all with a positive cosine (half a millionth
    or more), exact; ``min_score`` > 0 asks only for those from it on.  (id, other, support,
    score, rank), ties to the smaller id, ``support`` the number of shared terms."""
    if not 0.0 <= min_score <= 1.0:
        raise ValueError("min_score must be in [0, 1]")
    found = cosine_top_k(unit_vectors(articles), k, max(1, round(min_score * 1e6)))
    return top_k(found.drop("rank"), "id", k, key="other").select("id", "other", "support", "score", "rank")


#: terms of a set whose lists meet in one task; larger sets meet the others term by term
MOST_TERMS = 1 << 20


def set_cosines(members: DataFrame, of: str, term: str, k: int, most: int = MOST_TERMS) -> DataFrame:
    """``cosine_top_k`` of the sets in (of, term), unique rows of whole numbers: ``c / sqrt(n n')``.

    The members of a term are sent to each of them as packed lists (``shared_top_k``).  A set of
    over ``most`` terms (an item that a third of all users have) is joined with everyone's
    instead and counted per pair, splittable at any key.
    """
    rows = (members.select(F.col(of).cast("bigint").alias("id"), F.col(term).cast("bigint").alias("t"))
            .where(F.col("id").isNotNull() & F.col("t").isNotNull()))
    return shared_top_k(rows, rows.groupBy("id").agg(F.count(F.lit(1)).alias("n")), k, floor=1, most=most)

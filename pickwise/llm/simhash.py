"""SimHash near-dedup by meet-in-the-middle ball hashing.

Two fingerprints within ``max_bits`` share a value within half of that of both.  Every
distinct fingerprint therefore emits all values of its ball of half the radius; a
shuffle on those values brings near fingerprints together.  Fingerprints in one ball
lie within the whole radius of one another, so linking each to the least of its ball
keeps every class whole without all pairs.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pickwise.llm.common import written
from pickwise.llm.components import components

SEED = 42


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """64-bit SimHash: a bit is set if it is set in over half the shingles' XXH64."""
    words = text.lower().split()  # bytes: only A-Z change, only the six blanks cut
    if not words:
        return 0
    whole = b" ".join(words)
    k = min(shingle_words, len(words))
    ends = np.cumsum([len(w) + 1 for w in words]) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter((digest(whole[s:e], SEED) for s, e in
                          zip(starts[:len(words) - k + 1].tolist(), ends[k - 1:].tolist())),
                         dtype="<u8", count=len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 1 << 14):  # whole texts, a bounded piece at a time
        bits = np.unpackbits(hashes[at:at + (1 << 14)].view(np.uint8), bitorder="little")
        ones += bits.reshape(-1, 64).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(docs: DataFrame, shingle_words: int = 3) -> DataFrame:
    """(doc_id, h, fp) of every row: fp is the unsigned fingerprint's bits as a long, h the text's hash."""
    def run(batches):
        for batch in batches:
            fps = [fingerprint(t.as_py(), shingle_words) for t in batch.column(2)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[:2], pa.array(np.array(fps, np.uint64).view(np.int64))], names=["doc_id", "h", "fp"])
    text = F.coalesce(F.col("text"), F.lit(""))
    return (docs.select(F.col("doc_id").cast("long"), F.xxhash64(text).alias("h"), text.cast("binary").alias("text"))
            .mapInArrow(run, "doc_id long, h long, fp long"))


def ball(radius: int) -> list[int]:
    """XOR masks of at most ``radius`` bits, as signed longs."""
    masks = [sum(1 << b for b in bits) for r in range(radius + 1) for bits in combinations(range(64), r)]
    return [m - (1 << 64) if m >> 63 else m for m in masks]


def near_links(fps: DataFrame, max_bits: int = 2) -> DataFrame:
    """(a, b): links between distinct fingerprints that join all within ``max_bits``.

    ``fps`` holds distinct longs ``fp``.  ``max_bits`` must be even (half of it is the
    ball's radius).  A value's group holds at most one fingerprint per mask of the ball.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even")
    masks = F.array(*[F.lit(m).cast("long") for m in ball(max_bits // 2)])
    variants = fps.select("fp", F.explode(masks).alias("m")).select("fp", F.col("fp").bitwiseXOR(F.col("m")).alias("v"))
    least = F.min("fp").over(Window.partitionBy("v"))
    return (variants.select("fp", least.alias("b")).filter("fp != b")
            .filter(F.bit_count(F.col("fp").bitwiseXOR(F.col("b"))) <= max_bits)
            .select(F.col("fp").alias("a"), "b").distinct())


def simhash_groups(docs: DataFrame, shingle_words: int = 3, max_bits: int = 2) -> DataFrame:
    """For every row: doc_id, fingerprint (16 hex digits), component_id, stays, text_hash.

    Texts are lower-cased (A-Z) and cut into words; shingles count as often as they
    occur; a text of fewer words is one shingle; a null, empty or blank text has
    fingerprint zero and links like any other.  component_id is the smallest doc_id
    reachable over links of at most ``max_bits`` bits; rows without an id get the
    component of their fingerprint, null if none of its rows has an id.  ``stays`` marks
    the row with that id; of rows that share it, the one with the least text hash
    (repeated rows alike).  Repeated rows all return.  Other columns are ignored.
    """
    marked = written(fingerprints(docs, shingle_words))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "h")).alias("first")
    per_fp = written(marked.groupBy("fp").agg(first))
    roots = components(near_links(per_fp.select("fp"), max_bits))
    rooted = written(per_fp.join(roots, per_fp.fp == roots.node, "left")
                     .select("fp", "first", F.coalesce("root", "fp").alias("root")))
    # a component may hold a third of all fingerprints: its minimum is a map-side aggregate,
    # and both tables are written so that a hot fingerprint or root can be split in the joins
    least = written(rooted.groupBy("root").agg(F.min("first").alias("least")))
    classes = written(rooted.join(least, "root").select("fp", "least"))
    return (marked.join(classes, "fp")
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.col("least.doc_id").alias("component_id"),
                    (F.col("doc_id").eqNullSafe(F.col("least.doc_id")) & (F.col("h") == F.col("least.h"))).alias("stays"),
                    F.col("h").alias("text_hash")))

"""Skew-safe generation of co-occurring pairs.

Many operators need every pair of keys that share a group: items bought by one
user (item-item CF), users who bought one item (user-user CF), parts of one
order (pair rules).  A plain self-join on the group sends a whole group to one
task, and one user or item may hold a third of all rows.

``co_pairs`` splits every group of more than ``chunk`` rows into
``s = ceil(m / chunk)`` hash chunks and joins chunk ``ca`` with chunk ``cb``
(``ca <= cb``) on ``(group, ca, cb)``.  Each row is replicated ``s`` times, so a
light group (the common case, ``s = 1``) is not replicated at all, and no join
key carries more than about ``chunk x chunk`` pairs.  Every unordered pair of a
group comes out exactly once, oriented so that ``a < b``.  Nothing is capped or
sampled: the output is the exact pair set.  The join that tells each row its
group's size may be split at a hot group too (``loose``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.operators.skew import loose

DEFAULT_CHUNK = 4096


def co_pairs(df: DataFrame, group: str, key: str, carry: Sequence[str] = (),
             chunk: int = DEFAULT_CHUNK) -> DataFrame:
    """All unordered key pairs sharing a group, once per group.

    ``df`` must be unique on (group, key).  Returns columns
    ``group, group_size, a, b, a_<c>, b_<c>`` for every carried column ``c``,
    with ``a < b``.
    """
    if chunk < 1:
        raise ValueError("chunk must be positive")
    cols = [group, key, *carry]
    sizes = df.groupBy(group).agg(F.count(F.lit(1)).alias("group_size"))
    tagged = (df.select(*cols).join(loose(sizes), group)
              .withColumn("_s", F.ceil(F.col("group_size") / F.lit(float(chunk))).cast("int"))
              .withColumn("_c", F.pmod(F.xxhash64(F.col(key)), F.col("_s").cast("bigint")).cast("int")))
    left = tagged.select(
        group, "group_size", F.col("_c").alias("_ca"),
        F.explode(F.sequence(F.col("_c"), F.col("_s") - F.lit(1))).alias("_cb"),
        F.col(key).alias("_a"), *[F.col(c).alias(f"_a_{c}") for c in carry])
    right = tagged.select(
        group, F.explode(F.sequence(F.lit(0), F.col("_c"))).alias("_ca"),
        F.col("_c").alias("_cb"),
        F.col(key).alias("_b"), *[F.col(c).alias(f"_b_{c}") for c in carry])
    joined = (left.join(right, [group, "_ca", "_cb"])
              .where((F.col("_ca") < F.col("_cb")) | (F.col("_a") < F.col("_b"))))
    fwd = F.col("_a") < F.col("_b")
    out = [group, "group_size",
           F.least("_a", "_b").alias("a"), F.greatest("_a", "_b").alias("b")]
    for c in carry:
        out.append(F.when(fwd, F.col(f"_a_{c}")).otherwise(F.col(f"_b_{c}")).alias(f"a_{c}"))
        out.append(F.when(fwd, F.col(f"_b_{c}")).otherwise(F.col(f"_a_{c}")).alias(f"b_{c}"))
    return joined.select(*out)


def both_ways(pairs: DataFrame, a: str = "a", b: str = "b",
              mirrored: Sequence[tuple[str, str]] = (), keep: Sequence[str] = ()) -> DataFrame:
    """Turn unordered pairs (a < b) into directed rows (id, other).

    ``mirrored`` lists (x, y) column pairs that swap with the direction, e.g.
    per-side norms; ``keep`` lists symmetric columns copied as they are.  One
    pass: each row is exploded into its two directions (a union of two
    projections would evaluate the pair aggregate twice).
    """
    def side(i, o, swap):
        fields = [F.col(i).alias("id"), F.col(o).alias("other")]
        for x, y in mirrored:
            fields += [F.col(y if swap else x).alias(x), F.col(x if swap else y).alias(y)]
        return F.struct(*fields)
    d = pairs.select(F.explode(F.array(side(a, b, False), side(b, a, True))).alias("_d"), *keep)
    names = ["id", "other"] + [c for xy in mirrored for c in xy]
    return d.select(*[F.col(f"_d.{c}").alias(c) for c in names], *keep)

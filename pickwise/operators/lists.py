"""What rows share through terms, added up from packed lists: C1, C2, C4, C6.

A pair of keys that share a group costs a row of its own in a join, and the pairs of a table
are many times its rows.  Here a group goes as packed lists (``packed``) of ``LIST`` entries
at most, ids and numbers in as few bytes as the table's greatest one needs.  The members are
dealt to blocks (``block_of``), and a list goes once to each block that has members of its
group, however many these are.  A task holds the lists of a block and adds up those of one
member after the other: a pair is an addition in memory.  There are as many blocks as cores,
and more where a block's lists would pass ``HELD`` bytes (``blocks_for``): its memory does not
grow with the table, and a list is never sent more often than its group has members.

With many blocks a list goes to most of its members' blocks, so all that is sent would lie on disk many
times over.  So the blocks take turns (``rounds_for``): a round sends ``TIMES`` the bytes of all lists at
most, writes what it found and gives its shuffle back before the next one.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.functions.scores import m6
from pickwise.operators.rerank import exclude_seen, top_k
from pickwise.operators.skew import loose
from pickwise.session import checkpoint_dir, kept

LIST = 512            # entries to a packed list, at most
HELD = 192 << 20      # bytes of lists that a task holds, about
SENT, TIMES = 1 << 30, 4  # a round sends so many bytes, or so many times the bytes of all lists if that is more
FOLD = 1 << 22        # entries of a member that are held before they are added up
ROWS_OUT = 1 << 16    # rows to a batch of results


def narrow(low: int, high: int) -> str:
    """The shortest type of whole numbers that holds ``low`` to ``high``."""
    return next(t for t in ("int16", "int32", "int64") if np.iinfo(t).min <= low and high <= np.iinfo(t).max)


def packed(rows: DataFrame, key: str, other: str, value: str, kinds: tuple[str, str], chunk: int) -> DataFrame:
    """(key, size, ids, vals): the (other, value) of a key, whole numbers of ``kinds``, in lists of about
    ``chunk`` entries; a key of more has several, dealt by hash."""
    sizes = rows.groupBy(key).agg(F.ceil(F.count(F.lit(1)) / F.lit(float(chunk))).cast("bigint").alias("_s"))
    lists = (rows.join(loose(sizes), key).groupBy(key, F.pmod(F.xxhash64(other), F.col("_s")).alias("_c"))
             .agg(F.collect_list(F.struct(F.col(other).alias("o"), F.col(value).alias("x"))).alias("l")).drop("_c"))

    def binary(values: np.ndarray, cut: np.ndarray) -> pa.Array:
        return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [
            None, pa.py_buffer((cut * values.itemsize).astype(np.int32)), pa.py_buffer(_by_place(values, cut))])

    def run(batches):
        for batch in batches:
            lists = batch.column(1)
            sizes = lists.value_lengths().to_numpy()
            cut = np.concatenate(([0], np.cumsum(sizes, dtype=np.int64)))
            flat = lists.flatten()
            order = np.lexsort((flat.field("o").to_numpy(), np.repeat(np.arange(len(sizes)), sizes)))
            ids, vals = (binary(flat.field(c).to_numpy()[order].astype(kind), cut) for c, kind in zip(("o", "x"), kinds))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes, pa.int32()), ids, vals],
                                             names=[key, "size", "ids", "vals"])
    return lists.select(key, "l").mapInArrow(run, f"{key} bigint, size int, ids binary, vals binary")


def _places(cut: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Of each entry of the lists between ``cut``: where its first byte lies, and how far the next ones are apart."""
    sizes = np.diff(cut)
    return np.arange(cut[-1]) + np.repeat(cut[:-1] * (width - 1), sizes), np.repeat(sizes, sizes)


def _by_place(values: np.ndarray, cut: np.ndarray) -> np.ndarray:
    """The bytes of the lists' numbers, in each list all first ones, then all second ones...: those of
    sorted ids and small numbers hardly differ, so the shuffle's compression takes them out."""
    width = values.itemsize
    first, step = _places(cut, width)
    rows, out = np.ascontiguousarray(values).view(np.uint8).reshape(-1, width), np.empty(len(values) * width, np.uint8)
    for p in range(width):
        out[first + p * step] = rows[:, p]
    return out


def _flat(column, kind: str, cut: np.ndarray) -> np.ndarray:
    """The numbers of all lists of a column, one after the other."""
    start, end = column.offset, column.offset + len(column)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64 if pa.types.is_large_binary(column.type) else np.int32)
    if data is None or offsets[start] == offsets[end]:
        return np.zeros(0, kind)
    raw = np.frombuffer(data, np.uint8)[offsets[start]:offsets[end]]
    width = np.dtype(kind).itemsize
    first, step = _places(cut, width)
    out = np.empty((len(first), width), np.uint8)
    for p in range(width):
        out[:, p] = raw[first + p * step]
    return out.view(kind).ravel()


def lists_of(batch, kinds: tuple[str, str]):
    """(keys, sizes, ids, vals) of a batch of (key, size, ids, vals, further...), all lists one after the other."""
    sizes = batch.column(1).fill_null(0).to_numpy().astype(np.int64)
    cut = np.concatenate(([0], np.cumsum(sizes)))
    return batch.column(0).to_numpy(), sizes, _flat(batch.column(2), kinds[0], cut), _flat(batch.column(3), kinds[1], cut)


def runs(batches, kinds: tuple[str, str]):
    """(key, ids, vals, sizes, further columns) of the neighbouring rows of a key, from batches of
    (key, size, ids, vals, further...); a key whose rows lie in two batches comes in two parts."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key, sizes, ids, vals = lists_of(batch, kinds)
        cut = np.concatenate(([0], np.cumsum(sizes)))
        more = [c.to_numpy(zero_copy_only=False) for c in batch.columns[4:]]
        edges = [0, *(np.flatnonzero(key[1:] != key[:-1]) + 1).tolist(), len(key)]
        for a, b in zip(edges, edges[1:]):
            yield int(key[a]), ids[cut[a]:cut[b]], vals[cut[a]:cut[b]], sizes[a:b], [c[a:b] for c in more]


def _mix(number, of):
    """Whole numbers (a column or an array) as dealt over ``of`` blocks: strides in ids don't meet the number of blocks."""
    mod = (lambda x, m: F.pmod(x, F.lit(m))) if not isinstance(number, np.ndarray) else (lambda x, m: x % m)
    return mod(mod(mod(number, (1 << 31) - 1) * 1103515245, (1 << 31) - 1), of)


def block_of(ids, blocks: int):
    """The block of each id, in Spark and in a task."""
    return _mix(ids.astype(np.int64), blocks) if isinstance(ids, np.ndarray) else _mix(ids.cast("bigint"), blocks)


def _held(groups: DataFrame, members: str, entries: str, width: int) -> tuple[float, dict[int, float]]:
    """(bytes of all lists, bytes that a block holds by the number of blocks): ``groups`` has a row to a group, whose
    list of ``entries`` numbers goes to each block that one of its ``members`` falls in."""
    least = groups.sparkSession.sparkContext.defaultParallelism
    sizes = [least << i for i in range(11)]
    x, m = F.col(entries).cast("double"), F.col(members).cast("double")
    once, *held = groups.agg(F.sum(x * F.lit(float(width))), *[
        F.sum(x * F.lit(float(width)) * (F.lit(1.0) - F.pow(F.lit(1.0 - 1.0 / p), m)) + m * F.lit(24.0 / p)) for p in sizes]).first()
    return once or 0.0, {p: b or 0.0 for p, b in zip(sizes, held)}


def blocks_for(groups: DataFrame, members: str, entries: str, width: int) -> int:
    """The number of blocks in which a block holds ``HELD`` bytes or less."""
    return rounds_for(groups, members, entries, width)[0]


def rounds_for(groups: DataFrame, members: str, entries: str, width: int) -> tuple[int, int]:
    """The numbers of blocks and of rounds in which they take turns; a round has a block to a core at least."""
    once, held = _held(groups, members, entries, width)
    blocks = next((p for p, b in held.items() if b <= HELD), max(held))
    return blocks, max(1, min(blocks // min(held), int(-(-blocks * held[blocks] // max(SENT, TIMES * once)))))


def by_rounds(rounds: int, found: Callable[[int | None], DataFrame]) -> DataFrame:
    """What ``found`` has for the blocks of each round, those with ``block % rounds`` of its number, written
    round by round; as it is (``found(None)``) where there is but one."""
    if rounds == 1:
        return found(None)
    return reduce(DataFrame.unionByName, [kept(found(r)) for r in range(rounds)])


class Held:
    """The lists of a block by their groups, and which member asks for which of them.  ``again``: each list
    of a group has come with all its members there, so those of one count."""

    def __init__(self, again: bool = False):
        self.again = again
        self.keys, self.ids, self.vals, self.sizes, self.members, self.asked, self.rows = [], [], [], [], [], [], 0

    def add(self, keys, ids, vals, sizes, members, asked):
        """Lists of the groups ``keys``, one after the other; ``members[i]`` is one of the group in row ``asked[i]``."""
        for column, values in zip((self.keys, self.ids, self.vals, self.sizes, self.members, self.asked),
                                  (keys, ids, vals, sizes, members, asked + self.rows)):
            column.append(values)
        self.rows += len(keys)

    def _column(self, name: str) -> np.ndarray:
        parts = getattr(self, name)
        setattr(self, name, [])
        return np.concatenate(parts)

    def each(self):
        """(member, parts) of each member, in order; a part is the (ids, vals, sizes, groups, sizes of these groups'
        lists) of lists that it asked for, of about ``FOLD`` entries."""
        if not self.rows:
            return
        keys, rows, ids, vals = (self._column(c) for c in ("keys", "sizes", "ids", "vals"))
        groups, lead, group = np.unique(keys, return_index=True, return_inverse=True)
        order = np.argsort(group, kind="stable")
        if np.any(order[1:] < order[:-1]):  # the rows of a group one after the other
            at = _spans((np.cumsum(rows) - rows)[order], rows[order])
            ids, vals = ids[at], vals[at]
        sizes = np.bincount(group, rows, len(groups)).astype(np.int64)
        start = np.cumsum(sizes) - sizes
        members, asked = self._column("members"), self._column("asked")
        if self.again and len(groups) < len(keys):
            one = np.zeros(len(keys), bool)
            one[lead] = True
            members, asked = members[one[asked]], asked[one[asked]]
        asked = group[asked]
        order = np.argsort(members, kind="stable")
        members, asked = members[order], asked[order]
        edges = np.flatnonzero(np.concatenate(([True], members[1:] != members[:-1], [True]))).tolist() if len(members) else [0]

        def parts(at):
            first, n = start[at], sizes[at]
            if n.max() > FOLD:  # lists in pieces
                pieces = np.maximum(1, -(-n // FOLD))
                piece = _spans(np.zeros(len(n), np.int64), pieces)
                at, first = np.repeat(at, pieces), np.repeat(first, pieces) + piece * FOLD
                n = np.minimum(np.repeat(n, pieces) - piece * FOLD, FOLD)
            turn = np.cumsum(n) // FOLD
            cuts = [0, *(np.flatnonzero(turn[1:] != turn[:-1]) + 1).tolist(), len(n)]
            for x, y in zip(cuts, cuts[1:]):
                place = _spans(first[x:y], n[x:y])
                yield ids[place], vals[place], n[x:y], groups[at[x:y]], sizes[at[x:y]]

        for lo, hi in zip(edges, edges[1:]):
            yield int(members[lo]), parts(asked[lo:hi])


def _spans(first: np.ndarray, n: np.ndarray) -> np.ndarray:
    """first[0], first[0] + 1, ... n[0] of them, then those of the next."""
    return np.repeat(first - (np.cumsum(n) - n), n) + np.arange(n.sum())


def batches_of(found, columns: list[str]):
    """Batches of about ``ROWS_OUT`` rows from (arrays of the columns) to a member."""
    out, held = [], 0

    def batch():
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(c).astype(np.int64)) for c in zip(*out)], names=columns)

    for arrays in found:
        if len(arrays[0]):
            out.append(arrays)
            held += len(arrays[0])
        if held >= ROWS_OUT:
            yield batch()
            out, held = [], 0
    if out:
        yield batch()


class Shared:
    """A member's others so far: how often met, the weights added up, and each one's own size."""

    def __init__(self):
        self.parts, self.waiting = [], 0

    def add(self, ids, sizes, weight):
        self.parts.append((ids.astype(np.int64), sizes.astype(np.int64), None, weight))
        self.waiting += len(ids)
        if self.waiting > FOLD:
            self.parts, self.waiting = [self.folded()], 0

    def folded(self):
        ids, sizes = (np.concatenate([p[c] for p in self.parts]) for c in (0, 1))
        u, first, inverse, count = np.unique(ids, return_index=True, return_inverse=True, return_counts=True)
        if any(p[2] is not None for p in self.parts):
            met = np.concatenate([np.ones(len(p[0]), np.int64) if p[2] is None else p[2] for p in self.parts])
            count = np.bincount(inverse, met, len(u)).astype(np.int64)
        weight = None
        if self.parts[0][3] is not None:
            weight = np.bincount(inverse, np.concatenate([p[3] for p in self.parts]), len(u))
        return u, sizes[first], count, weight


def first_k(score: np.ndarray, key: np.ndarray, k: int) -> np.ndarray:
    """The places of the k greatest scores, ties to the smaller key, best first."""
    at = np.arange(len(score))
    if len(at) > k:
        at = np.flatnonzero(score >= np.partition(score, len(score) - k)[len(score) - k])
    return at[np.lexsort((key[at], -score[at]))[:k]]


def shared_top_k(rows: DataFrame, sizes: DataFrame, k: int, metric: str = "cosine", iuf: bool = False,
                 min_support: int = 1, floor: int = 0, most: int = 1 << 20, chunk: int = LIST) -> DataFrame:
    """(id, other, support, score, rank, n, other_n): the k best others of each id by the terms shared.

    ``rows`` is unique in (id, t), whole numbers; ``sizes`` is (id, n).  Cosine: ``c / sqrt(n n')``,
    jaccard: ``c / (n + n' - c)``, in millionths, from ``floor`` on; ``iuf``: a term of m ids counts
    ``1 / ln(1 + m)`` in c.  An id of over ``most`` terms meets the others in a join on the
    term, which may be split at any key, and the pairs are merged into the lists.
    """
    checkpoint_dir(rows.sparkSession)
    base = rows.where(F.col("id").isNotNull() & F.col("t").isNotNull()).join(loose(sizes), "id")
    base = kept(base.select("id", "t", F.col("n").cast("bigint").alias("n")))
    terms = base.groupBy("t").agg(F.count(F.lit(1)).alias("m"))
    low, high, largest = base.agg(F.min("id"), F.max("id"), F.max("n")).first()
    kinds = narrow(low or 0, high or 0), narrow(0, largest or 0)
    blocks, rounds = rounds_for(terms, "m", "m", sum(np.dtype(c).itemsize for c in kinds))
    some_large = (largest or 0) > most
    small = base.where(F.col("n") <= F.lit(most)) if some_large else base
    met = packed(base, "t", "id", "n", kinds, min(chunk, LIST))
    asked = small.groupBy("t").agg(F.collect_set(block_of(F.col("id"), blocks).cast("int")).alias("blocks"))
    sent = met.join(loose(asked), "t").select("t", "size", "ids", "vals", "blocks")
    if rounds > 1:  # each of them reads it
        sent = kept(sent)

    def dealt(r):
        turn = F.col("blocks") if r is None else F.filter("blocks", lambda b: b % F.lit(rounds) == F.lit(r))
        return (sent.select("t", "size", "ids", "vals", F.explode(turn).alias("block"))
                .repartitionById(-(-blocks // rounds), F.floor(F.col("block") / F.lit(rounds)).cast("int")))

    def best(key, parts):
        now = Shared()
        for ids, size, lengths, _, m in parts:
            now.add(ids, size, np.repeat(1.0 / np.log(1.0 + m), lengths) if iuf else None)
        other, size, support, weight = now.folded()
        n, c = size[np.searchsorted(other, key)], support if weight is None else weight  # a member is in its groups' lists
        cosine = metric == "cosine"
        score = np.floor(c / (np.sqrt((n * size).astype(np.float64)) if cosine else (n + size - support)) * 1e6 + 0.5).astype(np.int64)
        keep = np.flatnonzero((other != key) & (support >= min_support) & (score >= floor))
        at = keep[first_k(score[keep], other[keep], k)]
        return np.full(len(at), key), other[at], support[at], score[at], np.full(len(at), n), size[at]

    def run(batches):
        held = Held()
        for batch in batches:
            if not batch.num_rows:
                continue
            keys, sizes, ids, vals = lists_of(batch, kinds)
            mine = block_of(ids, blocks) == batch.column(4)[0].as_py()
            at = np.flatnonzero(mine & (vals <= most) if some_large else mine)
            held.add(keys, ids, vals, sizes, ids[at], np.searchsorted(np.cumsum(sizes), at, "right"))
        yield from batches_of((best(key, parts) for key, parts in held.each()), columns)

    columns = ["id", "other", "support", "score", "n", "other_n"]
    schema = ", ".join(f"{c} bigint" for c in columns)
    every = by_rounds(rounds, lambda r: dealt(r).mapInArrow(run, schema))
    if some_large:
        large = base.where(F.col("n") > F.lit(most))
        if iuf:
            large = large.join(loose(terms), "t")
        pairs = (large.select(F.col("id").alias("a"), F.col("n").alias("na"), "t", *(["m"] if iuf else []))
                 .join(base.select(F.col("id").alias("b"), F.col("n").alias("nb"), "t"), "t").where(F.col("a") != F.col("b")))
        weight = F.lit(1.0) / F.log(F.lit(1.0) + F.col("m")) if iuf else F.lit(1)
        pairs = (pairs.groupBy("a", "b", "na", "nb").agg(F.count(F.lit(1)).alias("support"), F.sum(weight).alias("c"))
                 .where(F.col("support") >= F.lit(min_support)))
        below = F.sqrt(F.col("na") * F.col("nb")) if metric == "cosine" else F.col("na") + F.col("nb") - F.col("support")
        scored = pairs.select("a", "b", "support", m6(F.col("c") / below).alias("score"), "na", "nb").where(F.col("score") >= F.lit(floor))
        # the others have met the large ones in their own lists
        every = every.unionByName(scored.toDF(*columns[:4], "n", "other_n"))
    return top_k(every, "id", k, key="other").select("id", "other", "support", "score", "rank", "n", "other_n")


def neighbor_sums(inter: DataFrame, neighbors: DataFrame, n: int | None = None, most: int = 1 << 20) -> DataFrame:
    """(user_id, item_id, score): for each user and item not among the user's the sum of ``score`` over
    the user's items that have it as a neighbor in (id, other, score); the ``n`` best of a
    user, ties to the smaller item, or all.

    A user's lists meet in one task; a user of over ``most`` items, or without id, is joined and
    added up item by item, which may be split at any key.
    """
    checkpoint_dir(inter.sparkSession)
    base = kept(inter.select("user_id", "item_id").where(F.col("item_id").isNotNull()))
    nb = kept(neighbors.select(F.col("id").alias("item_id"), "other", F.col("score").cast("bigint").alias("score")))
    low, high, least, largest, entries = nb.agg(F.min("other"), F.max("other"), F.min("score"), F.max("score"), F.count(F.lit(1))).first()
    kinds = narrow(low or 0, high or 0), narrow(least or 0, largest or 0)
    sizes = base.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    most_items, rows, unnamed = sizes.agg(F.max("n"), F.sum("n"), F.count(F.when(F.col("user_id").isNull(), 1))).first()
    plain = (most_items or 0) > most or bool(unnamed)
    met = kept(packed(nb, "item_id", "other", "score", kinds, LIST))
    some = base
    if plain:
        some = base.join(loose(sizes.where(F.col("user_id").isNotNull() & (F.col("n") <= F.lit(most))).select("user_id")), "user_id", "left_semi")
    asking = (some.groupBy("item_id").agg(F.count(F.lit(1)).alias("c"))
              .join(nb.groupBy("item_id").agg(F.count(F.lit(1)).alias("e")), "item_id"))
    blocks, rounds = rounds_for(asking, "c", "e", sum(np.dtype(c).itemsize for c in kinds))
    if n is None:
        rounds = 1  # all sums are many times what is sent, so they are not written here

    def dealt(r):
        own = some.select("item_id", "user_id", block_of(F.col("user_id"), blocks).cast("int").alias("block"))
        if r is not None:
            own = own.where(F.col("block") % F.lit(rounds) == F.lit(r))
        users = own.groupBy("item_id", "block").agg(F.collect_list("user_id").alias("users"))
        # an item without neighbors is still one that the user has
        return (users.join(met, "item_id", "left").select("item_id", "size", "ids", "vals", "users", "block")
                .repartitionById(-(-blocks // rounds), F.floor(F.col("block") / F.lit(rounds)).cast("int")))

    def folded(parts_):
        ids, vals = (np.concatenate(c) for c in zip(*parts_))
        order = np.argsort(ids, kind="stable")
        ids = ids[order]
        first = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1]))) if len(ids) else np.zeros(0, np.int64)
        return ids[first], np.add.reduceat(vals[order], first) if len(ids) else vals

    def best(key, parts):
        seen, sums, waiting = [], [], 0
        for ids, vals, _, items, _ in parts:
            seen.append(items)
            sums.append((ids.astype(np.int64), vals.astype(np.int64)))
            waiting += len(ids)
            if waiting > FOLD:
                sums, waiting = [folded(sums)], 0
        item, score = folded(sums)
        new = ~np.isin(item, np.concatenate(seen))
        item, score = item[new], score[new]
        if n is not None:
            at = first_k(score, item, n)
            item, score = item[at], score[at]
        return np.full(len(item), key), item, score

    def run(batches):
        held = Held(again=True)
        for batch in batches:
            keys, sizes, ids, vals = lists_of(batch, kinds)
            asked = batch.column(4)
            held.add(keys, ids, vals, sizes, asked.flatten().to_numpy().astype(np.int64),
                     np.repeat(np.arange(len(keys)), asked.value_lengths().to_numpy()))
        yield from batches_of((best(key, parts) for key, parts in held.each()), columns)

    columns = ["user_id", "item_id", "score"]
    out = by_rounds(rounds, lambda r: dealt(r).mapInArrow(run, ", ".join(f"{c} bigint" for c in columns)))
    if plain:
        rest = base.join(loose(sizes.where(F.col("n") > F.lit(most)).select("user_id")), "user_id", "left_semi")
        rest = rest.unionByName(base.where(F.col("user_id").isNull()))
        cand = (rest.join(loose(nb), "item_id").groupBy("user_id", F.col("other").alias("item_id")).agg(F.sum("score").alias("score")))
        out = out.unionByName(exclude_seen(cand, base))
    return out

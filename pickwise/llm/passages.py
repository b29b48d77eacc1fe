"""Bringing repeated passages together without sending every window of every text.

Each window of a text picks an anchor: the gram inside it whose hash is least, so equal
windows pick equal anchors at equal places.  A run of windows with one anchor is a
record.  Anchors are counted first, a number each; only records whose anchor occurs
again go on, to the shard of their anchor, where an index decides window by window.

Texts are handled in blocks (hash groups of documents).  A block sends equal records
once, and whole copies of a text are known before by their digest, so a text or passage
that fills a third of the table sends a row per block.  The windows of an anchor that is
very frequent go apart, each to the shard of its own hash.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window

from pickwise.llm.common import block_count, in_blocks, written

CHUNK = 1 << 20  # units handled at a time; a window's place must fit in 20 bits
LAST = (1 << 63) - 1  # stands for no id: after all ids


@dataclass(frozen=True)
class Kind:
    """What differs between passages of words and of bytes."""

    window: int                      # units in a window
    gram: int                        # units in an anchor
    read: Callable                   # texts -> (array of units, offsets of the texts in it, raw bytes to cut contents from)
    grams: Callable                  # (units, gram) -> hash of the gram at each place
    content: Callable                # (raw, first, last, anchor) -> bytes of a run of windows, and the anchor's place
    width: int                       # bytes of a unit in raw
    per_doc: bool                    # whether an anchor must occur in two documents or just twice


def mixed(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    return h ^ (h >> np.uint64(29))


def sliding_min(x: np.ndarray, span: int) -> np.ndarray:
    width = 1
    while 2 * width <= span:
        x = np.minimum(x[:-width], x[width:])
        width *= 2
    rest = span - width
    return np.minimum(x[:-rest], x[rest:]) if rest else x


def chunks(off: np.ndarray, window: int):
    """(start, end) of stretches of whole texts up to CHUNK units; longer texts in overlapping
    pieces, so that every window is in one piece."""
    i, n = 0, len(off) - 1
    while i < n:
        j = int(np.searchsorted(off, off[i] + CHUNK, "right")) - 1
        if j > i:
            yield int(off[i]), int(off[j])
            i = j
        else:
            for s in range(int(off[i]), int(off[i + 1]) - window + 1, CHUNK - window + 1):
                yield s, min(s + CHUNK, int(off[i + 1]))
            i += 1


def runs(kind: Kind, units: np.ndarray, off: np.ndarray):
    """Arrays first, last, anchor place, anchor hash: the runs of windows that share an anchor."""
    out = []
    low = np.uint64(CHUNK - 1)
    for a, b in chunks(off, kind.window):
        if b - a < kind.window:
            continue
        g = kind.grams(units[a:b], kind.gram)
        key = (g & ~low) | np.arange(len(g), dtype=np.uint64)  # ties: the place further left
        at = (sliding_min(key, kind.window - kind.gram + 1) & low).astype(np.int64)
        ok = np.ones(len(at), bool)
        for e in off[np.searchsorted(off, a, "right"):np.searchsorted(off, b, "left")].tolist():
            ok[max(0, e - a - kind.window + 1):e - a] = False  # windows never cross texts
        change = at[1:] != at[:-1]
        start, stop = ok.copy(), ok.copy()
        start[1:] &= change | ~ok[:-1]
        stop[:-1] &= change | ~ok[1:]
        first, last = np.flatnonzero(start), np.flatnonzero(stop)
        out.append((first + a, last + a, at[first] + a, g[at[first]]))
    if not out:
        return (np.zeros(0, np.int64),) * 3 + (np.zeros(0, np.uint64),)
    return tuple(np.concatenate(x) for x in zip(*out))


def copies_of(side: pa.Table) -> dict[bytes, tuple[int, int]]:
    """sha256 -> (least id, number of rows) of the texts that occur more than once."""
    return dict(zip(side.column("sha").to_pylist(),
                    zip(side.column("first_id").to_pylist(), side.column("rows").to_pylist())))


class Block:
    """A block's texts in the order of their ids, without further copies of a text."""

    def __init__(self, kind: Kind, table: pa.Table, copies: dict):
        order = sorted(zip(table.column("d").to_pylist(), table.column("text").to_pylist()))
        self.every = [(d, t, hashlib.sha256(t).digest()) for d, t in order]
        seen = set()
        self.own = []  # the texts that stand for all their copies: one in the whole table
        for d, t, sha in self.every:
            first = copies.get(sha)
            if sha not in seen and (first is None or first[0] == d):
                self.own.append((d, t))
            seen.add(sha)
        self.d = np.array([d for d, _ in self.own], np.int64)
        units, self.off, self.raw = kind.read([t for _, t in self.own])
        self.first, self.last, self.at, self.hash = runs(kind, units, self.off)
        self.doc = np.searchsorted(self.off, self.first, "right") - 1


def anchors(kind: Kind):
    """Step 1: (block, h, n): a block's anchors and in how many documents (or places) they occur."""
    def run(key, texts, copies):
        block = Block(kind, texts, copies_of(copies))
        h = block.hash
        if kind.per_doc:
            order = np.lexsort((block.doc, h))
            h, doc = h[order], block.doc[order]
            new = np.ones(len(h), bool)
            new[1:] = (h[1:] != h[:-1]) | (doc[1:] != doc[:-1])
            h = h[new]
        h, n = np.unique(h, return_counts=True)
        return pa.table({"block": pa.array(np.full(len(h), key[0].as_py(), np.int32)),
                         "h": pa.array(h.view(np.int64)), "n": pa.array(n.astype(np.int32))})
    return run


def split_side(side: pa.Table):
    """The rows beside a block's texts: known copies, and the rest."""
    copy = side.column("sha").is_valid()
    return copies_of(side.filter(copy)), side.filter(pc.invert(copy))


def candidate_runs(kind: Kind, block: Block, wanted: np.ndarray, hot: np.ndarray):
    """(key, anchor place, first, last, run) of the records a block sends: runs whose anchor is
    wanted, and for hot anchors each window alone under its own hash."""
    at = np.searchsorted(wanted, block.hash)
    at[at == len(wanted)] = 0
    found = np.flatnonzero(wanted[at] == block.hash) if len(wanted) else np.zeros(0, np.int64)
    busy = hot[at[found]] if len(wanted) else np.zeros(0, bool)
    cold = found[~busy]
    yield from zip(block.hash[cold].tolist(), block.at[cold].tolist(), block.first[cold].tolist(),
                   block.last[cold].tolist(), cold.tolist())
    for r in found[busy].tolist():
        for w in range(int(block.first[r]), int(block.last[r]) + 1):
            data = block.raw[kind.width * w:kind.width * (w + kind.window)]
            yield xxhash.xxh3_64_intdigest(data), int(block.at[r]), w, w, r


def digest(content: bytes, at: int) -> int:
    return signed(xxhash.xxh3_64_intdigest(content, at))


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def records(kind: Kind, deal: Callable):
    """Step 2: a block's distinct records with the least and greatest id that have them and how
    often, and the shard that ``deal(key, whether it is the anchor, content, place)`` names."""
    def run(key, texts, side):
        copies, side = split_side(side)
        block = Block(kind, texts, copies)
        wanted = side.column("h").to_numpy().view(np.uint64)
        order = np.argsort(wanted)
        wanted, hot = wanted[order], side.column("hot").to_numpy(zero_copy_only=False).astype(bool)[order]
        found: dict = {}
        d = block.d[block.doc] if len(block.doc) else block.doc
        for k, at, first, last, r in candidate_runs(kind, block, wanted, hot):
            content, place = kind.content(block.raw, first, last, at)
            mine = int(d[r])
            old = found.get((k, place, content))
            found[k, place, content] = (min(mine, old[0]), max(mine, old[1]), old[2] + 1, old[3]) if old else (
                mine, mine, 1, int(block.hash[r]))
        keys = list(found)
        values = list(found.values())
        return pa.table({
            "block": pa.array(np.full(len(keys), key[0].as_py(), np.int32)),
            "key": pa.array([signed(k[0]) for k in keys], pa.int64()),
            "anchor": pa.array([signed(v[3]) for v in values], pa.int64()),
            "place": pa.array([k[1] for k in keys], pa.int32()),
            "least": pa.array([v[0] for v in values], pa.int64()),
            "most": pa.array([v[1] for v in values], pa.int64()),
            "n": pa.array([v[2] for v in values], pa.int64()),
            "content": pa.array([k[2] for k in keys], pa.binary()),
            "shard": pa.array([deal(k[0], k[0] == v[3], k[2], k[1]) for k, v in zip(keys, values)], pa.int32())})
    return run


def by_hash(shards: int) -> Callable:
    return lambda key, cold, content, place: key % shards


RECORD = "block int, key long, anchor long, place int, least long, most long, n long, content binary, shard int"
FOUND = "block int, key long, c long, marks binary"


def finished(kind: Kind, finish: Callable):
    """Step 3: each text with the windows that go, by ``finish(d, text, copy, windows)``."""
    def run(key, texts, side):
        copies, side = split_side(side)
        block = Block(kind, texts, copies)
        wanted = np.unique(side.column("anchor").to_numpy().view(np.uint64))
        keys = side.column("key").to_pylist()
        marks = dict(zip(zip(keys, side.column("c").to_pylist()), side.column("marks").to_pylist()))
        # hot anchors sent each window under a key of its own
        split = set(side.column("anchor").to_numpy()[side.column("key").to_numpy() != side.column("anchor").to_numpy()].tolist())
        hot = np.array([signed(int(w)) in split for w in wanted], bool)
        windows: dict[int, list] = {}
        for k, at, first, last, r in candidate_runs(kind, block, wanted, hot):
            content, place = kind.content(block.raw, first, last, at)
            mark = marks.get((signed(k), digest(content, place)))
            if mark is not None:
                doc = int(block.doc[r])
                windows.setdefault(doc, []).append((first - int(block.off[doc]), np.frombuffer(mark, np.int64).reshape(-1, 2)))
        number = {}
        for i, (d, t) in enumerate(block.own):
            number[d, t] = i
        rows = [finish(d, t, copies.get(sha), windows.get(number.get((d, t)), ())) for d, t, sha in block.every]
        return rows
    return run


def pack_marks(values: np.ndarray) -> bytes:
    """(count, value) pairs of runs of equal values."""
    start = np.flatnonzero(np.r_[True, values[1:] != values[:-1]])
    return np.stack((np.diff(np.r_[start, len(values)]), values[start]), axis=1).astype(np.int64).tobytes()


def repeated(docs: DataFrame, kind: Kind, shard: Callable, finish: Callable, out: dict[str, pa.DataType],
             schema: str, block_rows: int = 2000, hot_rows: int = 4096, deal: Callable = by_hash) -> DataFrame:
    """Run the three steps; ``shard(table) -> found rows`` is the index over one shard's records,
    ``deal(number of shards)`` makes the rule by which records go to shards.

    ``hot_rows``: an anchor in more documents (or places) than this has its windows dealt
    apart; the result is the same for any value.
    """
    rows = docs.select("doc_id", "text")
    blocks = (in_blocks(rows, block_rows)
              .select("block", F.coalesce("doc_id", F.lit(LAST)).alias("d"), F.col("text").cast("binary").alias("text")))
    n_shards = block_count(rows.count(), block_rows)
    # whole copies: a digest once to a block, so that a text of a third of all rows is a row a block
    shas = written(blocks.select("block", "d", F.unhex(F.sha2("text", 256)).alias("sha"))
                   .groupBy("block", "sha").agg(F.min("d").alias("first_id"), F.count(F.lit(1)).alias("rows")))
    first = written(shas.groupBy("sha").agg(F.min("first_id").alias("first_id"), F.sum("rows").alias("rows")).filter("rows > 1"))
    copies = written(shas.select("block", "sha").join(first, "sha").select("block", "sha", "first_id", "rows"))

    cogroup = lambda side: blocks.groupBy("block").cogroup(side.groupBy("block"))
    counted = cogroup(copies).applyInArrow(anchors(kind), "block int, h long, n int")
    every = Window.partitionBy("h")
    again = (counted.withColumn("all", F.sum("n").over(every)).filter("all > 1")
             .select("block", "h", (F.col("all") > hot_rows).alias("hot")))
    none = lambda **k: [F.lit(None).cast(t).alias(c) for c, t in k.items()]
    side = again.select("block", "h", "hot", *none(sha="binary", first_id="long", rows="long")).union(
        copies.select("block", *none(h="long", hot="boolean"), "sha", "first_id", "rows"))
    sent = cogroup(side).applyInArrow(records(kind, deal(n_shards)), RECORD)

    found = sent.groupBy("shard").applyInArrow(lambda key, table: shard(table), FOUND + ", anchor long")
    side = found.select("block", "key", "c", "marks", "anchor", *none(sha="binary", first_id="long", rows="long")).union(
        copies.select("block", *none(key="long", c="long", marks="binary", anchor="long"), "sha", "first_id", "rows"))
    last = finished(kind, finish)

    def close(key, texts, side):
        columns = list(zip(*last(key, texts, side))) or [()] * len(out)
        return pa.table({name: pa.array(column, t) for (name, t), column in zip(out.items(), columns)})
    return cogroup(side).applyInArrow(close, schema)

"""Suffix dedup: sampled splitters, local multikey quicksort of the suffixes.

Suffixes are taken where a window starts whose anchor occurs again.  Splitters sampled
from a few documents cut the order of the suffixes at the anchors, by their leading bytes,
into ranges; a range takes all records whose anchors lie in it.  Inside it the suffixes at
every window's start are sorted by their bytes as far as a window goes, eight bytes to a
character, each group of ties by the next character.  A window is repeated if it equals
one of its neighbours in that order.  A splitter is a whole key (leading bytes and
anchor), and equal windows have equal anchors at equal places, so the last suffixes of a
range and the first of the next never hold the same window: there is no tie to compare
across a boundary (tested).
"""

from __future__ import annotations

import hashlib
from bisect import bisect_right
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.passages import LAST, Kind, digest, mixed, pack_marks, repeated, runs

GRAM = 40
#: splitters kept at most; beyond as many ranges, each is dealt on by hash
RANGES, SAMPLE_DOCS = 1 << 16, 2000


def read_bytes(texts: list[bytes]):
    off = np.concatenate(([0], np.cumsum([len(t) for t in texts], dtype=np.int64)))
    raw = b"".join(texts)
    return np.frombuffer(raw, np.uint8), off, raw


def byte_grams(units: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the ``gram`` bytes at each place, put together from powers of two."""
    power = units.astype(np.uint64) + np.uint64(1)
    factor, total, done, width = 0x9E3779B97F4A7C15, None, 0, 1
    while True:
        if gram & width:
            if total is None:
                total = power
            else:  # the ``width`` bytes after the ``done`` bytes so far
                n = min(len(total), len(power) - done)
                total = total[:n] * np.uint64(factor) + power[done:done + n]
            done += width
        if width * 2 > gram:
            break
        power = power[:-width] * np.uint64(factor) + power[width:]
        factor = (factor * 0xD6E8FEB86659FD93 | 1) & 0xFFFFFFFFFFFFFFFF
        width *= 2
    return mixed(total[:len(units) - gram + 1])


def kind_of(window: int) -> Kind:
    def content(raw, first, last, at):
        return raw[first:last + window], at - first
    return Kind(window, min(GRAM, max(1, window // 5)), read_bytes, byte_grams, content, width=1, per_doc=False)


def leading(content: bytes, at: int, key: int) -> bytes:
    """Where a suffix stands in the order: its leading bytes, then its hash."""
    return content[at:at + 16].ljust(16, b"\0") + key.to_bytes(8, "big")


def sampled(docs: DataFrame, rows: int, sample_docs: int) -> DataFrame:
    """About ``sample_docs`` of ``rows`` documents, a fraction by hash of id and text, so that
    documents without id are sampled like the others."""
    part = 1_000_000 if rows <= sample_docs else max(1, 1_000_000 * sample_docs // rows)
    return docs.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_000)) < part)


def sampled_splitters(docs: DataFrame, kind: Kind, rows: int, sample_docs: int = SAMPLE_DOCS) -> Callable:
    """Rule that deals records into ranges of suffix order, cut by splitters from about
    ``sample_docs`` documents (``sampled``), every fourth anchor of each."""
    some = sampled(docs, rows, sample_docs).select(F.coalesce("text", F.lit("")).cast("binary").alias("text"))

    def sample(batches):
        for batch in batches:
            units, off, raw = kind.read(batch.column(0).to_pylist())
            _, _, at, h = runs(kind, units, off)
            yield pa.RecordBatch.from_arrays(
                [pa.array([leading(raw[a:a + 16], 0, k) for a, k in zip(at[::4].tolist(), h[::4].tolist())],
                          pa.binary())], names=["lead"])

    leads = sorted(r["lead"] for r in some.mapInArrow(sample, "lead binary").distinct().collect())

    def deal(shards: int) -> Callable:
        ranges = min(shards, RANGES)
        further = -(-shards // ranges)
        cuts = [leads[len(leads) * i // ranges] for i in range(1, ranges)] if leads else []
        # a hot anchor's windows go by their own leading bytes
        return lambda key, cold, content, place: (
            bisect_right(cuts, leading(content, place if cold else 0, key)) * further + key % further)
    return deal


def leading_words(raw: np.ndarray) -> np.ndarray:
    """The eight bytes at each place as a number whose order is theirs; zeros follow the end."""
    w = np.concatenate((raw, np.zeros(7, np.uint8))).astype(np.uint64)
    for width in (1, 2, 4):
        w = (w[:-width] << np.uint64(8 * width)) | w[width:]
    return w


def multikey_order(words: np.ndarray, begin: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
    """(order, tied): the strings of ``window`` bytes at ``begin`` by their bytes, and whether each
    in that order equals the one before.

    Multikey quicksort, eight bytes to a character: all are sorted by their first character,
    then every group of ties by the next, until a group is one string alone or at its end.
    """
    order = np.arange(len(begin))
    same = np.ones(len(begin), bool)  # in the order so far: ties with the one before
    same[:1] = False
    steps = [*range(0, window - 8, 8), window - 8] if window >= 8 else [0]
    shorter = np.uint64(8 * max(0, 8 - window))  # bytes beyond a window of under eight don't count
    open_ = np.arange(len(begin))
    for step in steps:
        group = np.cumsum(~same[open_])
        key = words[begin[order[open_]] + step] >> shorter
        by = np.lexsort((key, group))
        order[open_] = order[open_][by]
        key, group = key[by], group[by]
        same[open_[1:]] = (key[1:] == key[:-1]) & (group[1:] == group[:-1])
        tied = same[open_]
        still = tied.copy()
        still[:-1] |= tied[1:]
        open_ = open_[still]
        if not len(open_):
            break
    return order, same


def shard_order(window: int):
    """Decide a range's records: marks are 1 for windows that occur twice or more."""
    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("block", "key", "anchor", "place", "n", "content")]
        distinct: dict = {}
        for i, (anchor, place, content) in enumerate(zip(columns[2], columns[3], columns[5])):
            distinct.setdefault((anchor, place, content), []).append(i)
        times = np.array([sum(columns[4][i] for i in rows) for rows in distinct.values()], np.int64)
        contents = [c for _, _, c in distinct]
        sizes = np.array([len(c) for c in contents], np.int64)
        starts = np.concatenate(([0], np.cumsum(sizes)))[:-1]
        windows = sizes - window + 1
        owner = np.repeat(np.arange(len(sizes)), windows)
        cut = np.concatenate(([0], np.cumsum(windows)))
        begin = starts[owner] + np.arange(len(owner)) - cut[:-1][owner]
        # equal windows are neighbours in the order of their bytes
        order, same = multikey_order(leading_words(np.frombuffer(b"".join(contents), np.uint8)), begin, window)
        again = times[owner] > 1
        again[order[same]] = True
        again[order[np.flatnonzero(same) - 1]] = True
        out = [[], [], [], [], []]
        for r, ((anchor, p, content), rows) in enumerate(distinct.items()):
            mine = again[cut[r]:cut[r + 1]]
            if mine.any():
                marks, c = pack_marks(mine.astype(np.int64)), digest(content, p)
                for i in rows:
                    for column, value in zip(out, (columns[0][i], columns[1][i], c, marks, anchor)):
                        column.append(value)
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("block", "key", "c", "marks", "anchor"), out,
                                                             (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))})
    return run


def removed_bytes(window: int):
    def finish(d: int, text: bytes, copy, windows):
        n = len(text)
        gone = np.zeros(n + 1, np.int64)
        if copy is not None and n >= window:
            gone[0], gone[n] = 1, -1  # the whole text occurs elsewhere
        for first, marks in windows:
            for count, again in marks.tolist():
                if again:
                    gone[first] += 1
                    gone[first + count - 1 + window] -= 1
                first += count
        off = np.cumsum(gone)[:-1] > 0
        spans = int(np.count_nonzero(off[1:] & ~off[:-1]) + off[:1].sum())
        left = np.frombuffer(text, np.uint8)[~off].tobytes() if spans else text
        return (None if d == LAST else d, n, n - len(left), spans, hashlib.sha256(left).hexdigest(), left)
    return finish


def suffix_dedup(docs: DataFrame, window: int = 200, with_text: bool = False, block_rows: int = 2000,
                 hot_rows: int = 4096) -> DataFrame:
    """For every row: doc_id, n_bytes, n_removed, n_spans, kept_sha256 (and kept, the bytes that stay).

    A byte goes if a string of ``window`` bytes over it also starts anywhere else, in the
    same text too; matches never cross texts and are judged on the input.  A null text is
    empty.  Rows that repeat id and text are two places.  All rows return; other columns
    are ignored.  Windows are compared by their bytes.
    """
    finish = removed_bytes(window)
    names = {"doc_id": pa.int64(), "n_bytes": pa.int64(), "n_removed": pa.int64(), "n_spans": pa.int64(), "kept_sha256": pa.string()}
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    if with_text:
        names["kept"], schema = pa.binary(), schema + ", kept binary"
    width = len(names)
    kind = kind_of(window)
    return repeated(docs, kind, shard_order(window), lambda *a: finish(*a)[:width], names, schema,
                    block_rows, hot_rows, sampled_splitters(docs, kind, docs.count()))

"""Substring dedup with a compressed FM-index per shard.

A shard's records become one string of symbols (word codes, the anchor as one symbol).
Its Burrows-Wheeler transform is held in a wavelet matrix of packed bits; the windows of
the records stream through it by backward search, which gives how far each matches, and
windows matched in whole report the smallest document that has them.
"""

from __future__ import annotations

import hashlib
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame

from pickwise.llm.passages import LAST, Kind, digest, mixed, pack_marks, repeated

GRAM = 5


class WaveletMatrix:
    """Counts any symbol before any place of a sequence, over packed bit vectors."""

    def __init__(self, symbols: np.ndarray, sigma: int):
        self.levels = max(1, int(sigma - 1).bit_length())
        self.n = len(symbols)
        self.bits, self.counts, self.zeros = [], [], []
        now = symbols
        for level in range(self.levels - 1, -1, -1):
            bit = ((now >> level) & 1).astype(bool)
            packed = np.zeros(self.n // 64 + 1, np.uint64)
            raw = np.packbits(bit, bitorder="little")
            packed.view(np.uint8)[:len(raw)] = raw
            self.bits.append(packed)
            self.counts.append(np.concatenate(([0], np.cumsum(np.bitwise_count(packed)[:-1], dtype=np.int32))).astype(np.int32))
            self.zeros.append(int(self.n - bit.sum()))
            now = np.concatenate((now[~bit], now[bit]))

    def _ones(self, i: int, at: np.ndarray) -> np.ndarray:
        word = at >> 6
        mask = (np.uint64(1) << (at & 63).astype(np.uint64)) - np.uint64(1)
        return self.counts[i][word] + np.bitwise_count(self.bits[i][word] & mask).astype(np.int64)

    def before(self, symbol: np.ndarray, low: np.ndarray, high: np.ndarray):
        """Where the occurrences of each symbol before ``low`` and before ``high`` end in the last
        level, in which a symbol's occurrences lie together."""
        for i in range(self.levels):
            one = (symbol >> (self.levels - 1 - i)) & 1 == 1
            a, b = self._ones(i, low), self._ones(i, high)
            low, high = np.where(one, self.zeros[i] + a, low - a), np.where(one, self.zeros[i] + b, high - b)
        return low, high


def suffix_order(text: np.ndarray, depth: int) -> np.ndarray:
    """Places of the text sorted by the ``depth`` symbols (or a few more) that start there."""
    n = len(text)
    rank, have = text.astype(np.int64), 1
    while have < depth:
        after = np.zeros(n, np.int64)
        after[:n - have] = rank[have:] + 1
        _, rank = np.unique(rank * (max(n, int(rank.max())) + 2) + after, return_inverse=True)
        have *= 2
    return np.argsort(rank, kind="stable")


class FMIndex:
    """Backward search over a text of symbols 1..sigma-1 with 0 as the separator."""

    def __init__(self, text: np.ndarray, sigma: int, depth: int):
        self.order = suffix_order(text, depth)
        self.wavelet = WaveletMatrix(text[self.order - 1], sigma)  # place -1 is the last separator
        self.less = np.concatenate(([0], np.cumsum(np.bincount(text, minlength=sigma))))
        # where each symbol's occurrences start in the wavelet matrix's last level
        every, none = np.arange(sigma), np.zeros(sigma, np.int64)
        self.start = self.wavelet.before(every, none, none)[0]

    def search(self, text: np.ndarray, ends: np.ndarray, length: int):
        """For windows ``text[end - length:end]``: how many symbols from the end match elsewhere
        too, and the interval of places that start with the whole window (empty if it is alone)."""
        low = self.less[text[ends - 1]].astype(np.int64)
        high = self.less[text[ends - 1] + 1].astype(np.int64)
        matched = np.ones(len(ends), np.int64)
        out_low, out_high = np.zeros(len(ends), np.int64), np.zeros(len(ends), np.int64)
        alive = np.arange(len(ends))
        for step in range(2, length + 1):
            many = high - low > 1  # a single place is the window's own
            alive, low, high = alive[many], low[many], high[many]
            if not len(alive):
                break
            symbol = text[ends[alive] - step]
            a, b = self.wavelet.before(symbol, low, high)
            move = self.less[symbol] - self.start[symbol]
            low, high = a + move, b + move
            matched[alive] = step
        keep = high - low > 1
        out_low[alive[keep]], out_high[alive[keep]] = low[keep], high[keep]
        return matched, out_low, out_high


def read_words(texts: list[bytes]):
    """Hashes of the words of all texts, where each text starts, and the words' codes as bytes."""
    split = [t.split() for t in texts]
    off = np.concatenate(([0], np.cumsum([len(w) for w in split], dtype=np.int64)))
    units = np.fromiter(map(Codes().__getitem__, chain.from_iterable(split)), np.uint64, int(off[-1]))
    return units, off, units.astype(np.uint32).tobytes()


class Codes(dict):
    def __missing__(self, word):
        code = self[word] = xxhash.xxh64_intdigest(word)
        return code


def word_grams(units: np.ndarray, gram: int) -> np.ndarray:
    n = len(units) - gram + 1
    h = units[:n].copy()
    for i in range(1, gram):
        h = h * np.uint64(0x9E3779B97F4A7C15) + units[i:n + i]
    return mixed(h)


def kind_of(window: int) -> Kind:
    gram = min(GRAM, window)

    def content(raw, first, last, at):
        """Codes of the words before and after the anchor; its own words are in its hash."""
        return raw[4 * first:4 * at] + raw[4 * (at + gram):4 * (last + window)], at - first

    return Kind(window, gram, read_words, word_grams, content, width=4, per_doc=True)


def shard_index(window: int):
    """Decide a shard's records: marks are the smallest ids that have the windows."""
    gram = min(GRAM, window)
    length = window - gram + 1  # symbols of a window: its words, the anchor's as one

    def run(table: pa.Table) -> pa.Table:
        columns = [table.column(c).to_pylist() for c in ("block", "key", "anchor", "place", "least", "most", "content")]
        distinct: dict = {}
        for i, (anchor, place, content) in enumerate(zip(columns[2], columns[3], columns[6])):
            distinct.setdefault((anchor, place, content), []).append(i)
        least = np.array([min(columns[4][i] for i in rows) for rows in distinct.values()], np.int64)
        # one string: records with a separator after each; an anchor is a symbol above all words
        pieces, sizes = [np.zeros(1, np.uint64)], []
        for anchor, place, content in distinct:
            codes = np.frombuffer(content, np.uint32).astype(np.uint64) + np.uint64(1)
            name = np.uint64((anchor & ((1 << 62) - 1)) | (1 << 62))
            pieces.append(np.concatenate((codes[:place], [name], codes[place:], [0])))
            sizes.append(len(codes) + 2)
        symbols, text = np.unique(np.concatenate(pieces), return_inverse=True)  # 0 stays 0
        text = text.astype(np.int64)
        sizes = np.array(sizes, np.int64)
        starts = np.concatenate(([1], 1 + np.cumsum(sizes)))[:-1]
        record = np.concatenate(([0], np.repeat(np.arange(len(sizes)), sizes)))
        index = FMIndex(text, len(symbols), length)
        windows = sizes - length  # of each record
        owner = np.repeat(np.arange(len(sizes)), windows)
        place = np.arange(len(owner)) - np.repeat(np.concatenate(([0], np.cumsum(windows)))[:-1], windows)
        _, low, high = index.search(text, starts[owner] + place + length, length)
        ids = least[owner]
        hit = np.flatnonzero(high > low)
        if len(hit):
            by_place = least[record[index.order]]
            interval, back = np.unique(low[hit], return_inverse=True)
            stop = np.zeros(len(interval), np.int64)
            stop[back] = high[hit]
            edges = np.stack((interval, stop), axis=1).ravel()
            smallest = np.minimum.reduceat(np.append(by_place, LAST), edges)[::2]
            ids[hit] = np.minimum(ids[hit], smallest[back])
        out = [[], [], [], [], []]
        cut = np.concatenate(([0], np.cumsum(windows)))
        for r, ((anchor, p, content), rows) in enumerate(distinct.items()):
            mine = ids[cut[r]:cut[r + 1]]
            lowest = int(mine.min())
            marks = None
            for i in rows:
                if lowest < columns[5][i]:  # some document of the block has a window of a smaller one
                    marks = marks or (pack_marks(mine), digest(content, p))
                    for column, value in zip(out, (columns[0][i], columns[1][i], marks[1], marks[0], anchor)):
                        column.append(value)
        return pa.table({n: pa.array(c, t) for n, c, t in zip(("block", "key", "c", "marks", "anchor"), out,
                                                             (pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64()))})
    return run


def removed_words(window: int):
    def finish(d: int, text: bytes, copy, windows):
        words = text.split()
        gone = np.zeros(len(words) + 1, np.int64)
        if copy is not None and copy[0] < d and len(words) >= window:
            gone[0], gone[len(words)] = 1, -1  # a smaller document has the whole text
        for first, marks in windows:
            for count, smallest in marks.tolist():
                if smallest < d:
                    gone[first] += 1
                    gone[first + count - 1 + window] -= 1
                first += count
        keep = np.cumsum(gone)[:-1] == 0
        left = words if keep.all() else [w for w, k in zip(words, keep) if k]
        return (None if d == LAST else d, len(words), len(words) - len(left), hashlib.sha256(b" ".join(left)).hexdigest(),
                b" ".join(left))
    return finish


def substring_dedup(docs: DataFrame, window: int = 13, with_text: bool = False, block_rows: int = 2000,
                    hot_rows: int = 4096) -> DataFrame:
    """For every row: doc_id, n_words, n_removed, kept_sha256 (and kept, the words that stay).

    A word goes if a window of ``window`` words over it also starts in a document with a
    smaller doc_id; windows are judged on the input.  A null text has no words; a row
    without id counts as after all ids; rows that share an id are one document's and
    don't remove each other.  Repeated rows all return; other columns are ignored.
    Words are compared by 64-bit hashes at anchors and by 32-bit codes around them.
    """
    finish = removed_words(window)
    names = {"doc_id": pa.int64(), "n_words": pa.int64(), "n_removed": pa.int64(), "kept_sha256": pa.string()}
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    if with_text:
        names["kept"], schema = pa.binary(), schema + ", kept binary"
    width = len(names)
    return repeated(docs, kind_of(window), shard_index(window), lambda *a: finish(*a)[:width], names, schema,
                    block_rows, hot_rows)

"""Periodic runs of words: stretches that repeat themselves with some period.

A run with smallest period q and length L holds its words once more q places on: the
places i and i + q share l = L - q words, and neither the words before them nor the
words after them are equal.  So runs of L >= 2 q are the maximal pairs (i, i + q, l)
with q <= l; a pair is read off the suffixes' LCP-interval tree at the node of depth l,
where its places come from different children and from different left words, and
nothing has to be extended.

The nodes are made bottom up from the sorted suffixes and their LCPs; a node's class
list holds its places in order, each with the word to its left as its class.  A smaller
list goes into a larger one, and each of its places pairs with its neighbours there if
their classes differ.  Neighbours are enough: if the common words (l >= q) stood a third
time between i and i + q, they would have a period that divides q, and q would not be
the smallest.  A pair may still have a multiple of the smallest period; it has the same
start and length then, and the least period stays.

Texts are independent: a task takes some at a time, and only those in which a gram of
half the least length occurs twice have their suffixes sorted.
"""

from __future__ import annotations

from bisect import bisect_left, insort

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import slices

WORDS_AT_ONCE = 1 << 19  # words of whole texts sorted together


def repeated_texts(codes: np.ndarray, text: np.ndarray, gram: int) -> np.ndarray:
    """Numbers of the texts in which some gram's hash occurs twice (all that have runs, and maybe others)."""
    n = len(codes) - gram + 1
    if n < 2:
        return np.zeros(0, np.int64)
    h = text[:n].astype(np.uint64) + np.uint64(1)
    for k in range(gram):
        h = (h ^ (codes[k:k + n].astype(np.uint64) + np.uint64(1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
    inside = text[:n] == text[gram - 1:]
    order = np.flatnonzero(inside)
    order = order[np.argsort(h[inside])]
    again = h[order][1:] == h[order][:-1]
    return np.unique(text[order[1:][again]])


def suffixes(codes: np.ndarray, end: np.ndarray, gram: int):
    """(places, LCPs): the suffixes of texts in one array, sorted within their text, and how many
    words each shares with the one before (0 if fewer than ``gram``, or of another text).

    ``end`` is the place after the text that a place belongs to.  Prefix doubling from ``gram``
    words on; the ranks of every round are kept and give the LCPs by halving steps.
    """
    n = len(codes)
    places = np.arange(n)
    keys = []
    for k in range(0, gram, 2):  # two words to a key; what lies beyond the text is least
        one = np.where(places + k < end, np.take(codes, places + k, mode="clip") + 1, 0)
        two = np.where(places + k + 1 < end, np.take(codes, places + k + 1, mode="clip") + 1, 0) if k + 1 < gram else 0
        keys.append((one << 32) + two)
    order = np.lexsort((*keys[::-1], end))
    new = np.ones(n, bool)
    new[1:] = end[order[1:]] != end[order[:-1]]
    for key in keys:
        new[1:] |= key[order[1:]] != key[order[:-1]]
    first = np.flatnonzero(new)
    rank = np.empty(n, np.int64)
    rank[order] = np.repeat(first, np.diff(np.append(first, n)))
    levels, step = [], gram
    while True:
        levels.append((step, rank.astype(np.int32)))
        shared = np.append(~new, False)
        open_ = np.flatnonzero(shared[:-1] | shared[1:])  # slots whose group has more than one suffix
        if not len(open_):
            break
        who = order[open_]
        far = np.where(who + step < end[who], np.take(rank, who + step, mode="clip"), -1)
        by = np.lexsort((far, rank[who]))
        who, far = who[by], far[by]
        split = np.ones(len(who), bool)
        split[1:] = (rank[who][1:] != rank[who][:-1]) | (far[1:] != far[:-1])
        order[open_] = who
        new[open_] = split
        rank[who] = open_[np.maximum.accumulate(np.where(split, np.arange(len(who)), 0))]
        step *= 2
    lcp = np.zeros(n, np.int64)
    slot = np.flatnonzero(levels[0][1][order[1:]] == levels[0][1][order[:-1]]) + 1
    a, b = order[slot - 1], order[slot]
    both = np.zeros(len(slot), np.int64)
    for step, rank in levels[::-1]:
        x, y = a + both, b + both
        ok = (x < end[a]) & (y < end[b])
        ok &= np.take(rank, x, mode="clip") == np.take(rank, y, mode="clip")
        both[ok] += step
    live = np.arange(len(slot))
    for _ in range(gram - 1):  # less than a gram is left
        x, y = a[live] + both[live], b[live] + both[live]
        ok = (x < end[a[live]]) & (y < end[b[live]])
        ok &= np.take(codes, x, mode="clip") == np.take(codes, y, mode="clip")
        live = live[ok]
        both[live] += 1
    lcp[slot] = both
    return order, lcp


def worth(places: np.ndarray, lcp: np.ndarray) -> np.ndarray:
    """Which slots lie in a chain of suffixes where two places stand no further apart than some LCP."""
    chain = np.cumsum(lcp == 0)
    by = np.lexsort((places, chain))
    gap = np.full(len(places), np.iinfo(np.int64).max)
    gap[1:] = np.where(chain[by[1:]] == chain[by[:-1]], places[by[1:]] - places[by[:-1]], gap[1:])
    first = np.flatnonzero(lcp == 0)
    least, most = np.minimum.reduceat(gap, first), np.maximum.reduceat(lcp, first)
    return (least <= most)[chain - 1]


def maximal_pairs(places: list, lcp: list, left: list, least: int):
    """(start, distance, depth) of the maximal pairs with distance <= depth and distance + depth >= ``least``."""
    found = []

    def join(one, other, depth):
        """The class list of two children of a node; pairs across them go to ``found``."""
        if len(one) < len(other):
            one, other = other, one
        for i in other:
            at = bisect_left(one, i)
            if at:
                near = one[at - 1]
                if i - near <= depth and left[near] != left[i] and i - near + depth >= least:
                    found.append((near, i - near, depth))
            if at < len(one):
                near = one[at]
                if near - i <= depth and left[near] != left[i] and near - i + depth >= least:
                    found.append((i, near - i, depth))
        if 8 * len(other) < len(one):
            for i in other:
                insort(one, i)
        else:
            one += other
            one.sort()
        return one

    stack: list = []  # (depth, class list) of the nodes whose last child is still to come
    node: list = []
    for place, depth in zip(places, lcp):
        while stack and stack[-1][0] > depth:
            d, rest = stack.pop()
            node = join(rest, node, d)
        if depth:
            if stack and stack[-1][0] == depth:
                node = join(stack.pop()[1], node, depth)
            stack.append((depth, node))
        node = [place]
    while stack:
        d, rest = stack.pop()
        node = join(rest, node, d)
    return found


def runs_of(texts: list[list[bytes]], least: int) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each text of words, by start and period."""
    out: list[list] = [[] for _ in texts]
    gram = max(1, (least + 1) // 2)  # length <= 2 * depth, so shallower nodes give none
    sizes = np.array([len(t) for t in texts], np.int64)
    words = pa.array([w for t in texts for w in t], pa.binary())
    if len(words) < 2:
        return out
    codes = words.dictionary_encode().indices.to_numpy().astype(np.int64)
    text = np.repeat(np.arange(len(texts)), sizes)
    some = repeated_texts(codes, text, gram)
    if not len(some):
        return out
    inside = np.isin(text, some)
    codes, text = codes[inside], text[inside]
    size = sizes[some]
    ends = np.cumsum(size)
    end, begin = np.repeat(ends, size), np.repeat(ends - size, size)
    places, lcp = suffixes(codes, end, gram)
    keep = worth(places, lcp)
    places, lcp = places[keep], lcp[keep]
    left = np.concatenate(([-1], codes[:-1]))
    left[ends[:-1]] = -1  # a text's first place has no word before it
    periods: dict = {}
    for start, q, depth in maximal_pairs(places.tolist(), lcp.tolist(), left.tolist(), least):
        old = periods.get((start, q + depth))
        if old is None or q < old:
            periods[start, q + depth] = q
    for (start, length), q in sorted(periods.items(), key=lambda r: (r[0][0], r[1])):
        out[text[start]].append((start - int(begin[start]), length, q))
    return out


def collapsed(words: list[bytes], runs: list[tuple[int, int, int]]) -> bytes:
    """The words without those that a run holds after its first period, joined by a space."""
    if not runs:
        return b" ".join(words)
    gone = np.zeros(len(words) + 1, np.int64)
    for start, length, q in runs:
        gone[start + q] += 1
        gone[start + length] -= 1
    keep = np.cumsum(gone[:-1]) == 0
    return b" ".join([words[i] for i in np.flatnonzero(keep).tolist()])


def groups(texts: list[list[bytes]], most: int = WORDS_AT_ONCE):
    """Stretches of texts with about ``most`` words together; a longer text stands alone."""
    i, held = 0, 0
    for j, words in enumerate(texts):
        if held and held + len(words) > most:
            yield texts[i:j]
            i, held = j, 0
        held += len(words)
    if i < len(texts):
        yield texts[i:]


def periodic_runs(docs: DataFrame, least: int = 12) -> DataFrame:
    """(doc_id, n_words, runs, collapsed): every text's runs of at least ``least`` words and two
    periods, by start then period, as (start, length, period); and the text without the words
    that a run holds after its first period, joined by single spaces.

    Words are runs of anything but space, tab, line feed, vertical tab, form feed and carriage
    return.  Null, empty and blank texts have no words, no runs and an empty collapsed text.
    Every row gives one row, also where ids repeat or are null; other columns are not read.
    """
    if least < 2:
        raise ValueError("least must be 2 or more")

    def run(batches):
        for batch in slices(batches):
            words = [(t or "").encode().split() for t in batch.column(1).to_pylist()]
            runs = [r for group in groups(words) for r in runs_of(group, least)]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([len(w) for w in words], pa.int64()),
                pa.array([[dict(zip(("start", "length", "period"), r)) for r in rs] for rs in runs],
                         pa.list_(pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())]))),
                pa.array([collapsed(w, r).decode() for w, r in zip(words, runs)], pa.string())],
                names=["doc_id", "n_words", "runs", "collapsed"])
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(
        run, "doc_id long, n_words long, runs array<struct<start: long, length: long, period: long>>, collapsed string")

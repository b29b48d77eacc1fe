"""Language-model scores from a subword lattice.

A public vocabulary's pieces are drawn one after the other, independently, until the end
piece.  The probability of a text is the sum over all its segmentations, taken by a
forward recursion in log space.  A vocabulary's scores give the pieces their prior; the
learning documents' words add the expected counts of one pass over all their
segmentations.  No piece runs from a word into the next blank, so a text's lattice is the
chain of its words' lattices, and each distinct word is summed once per block.
"""

from __future__ import annotations

import math
from collections import Counter
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import in_blocks, written
from pickwise.llm.sentencepiece_codec import BLANK, LITERAL, PieceIndex, Vocabulary, by_length, read_vocabulary

BLOCK_ROWS = 3000
#: what the vocabulary's own scores count for, in pieces
PRIOR = 10_000.0
#: words of fewer characters are summed many at a time, longer ones alone
LONG = 64
#: characters of a long word whose sums are held at once when learning
WINDOW = 1 << 16


@dataclass
class Lattice:
    """Log probabilities of pieces and bytes; the end piece closes a text."""

    log_p: dict[str, float]
    log_byte: list[float]
    log_end: float
    longest: int = field(default=0)
    reach: dict[str, float | None] = field(default_factory=dict)

    def __post_init__(self):
        self.longest = max(map(len, self.log_p), default=1)
        self.reach = {p[:k]: None for p in self.log_p for k in range(1, len(p))} | self.log_p


def log_add(a: float, b: float) -> float:
    if a < b:
        a, b = b, a
    return a + math.log1p(math.exp(b - a)) if b > -math.inf else a


def written_in_bytes(char: str, lattice: Lattice) -> float:
    return sum(lattice.log_byte[b] for b in (BLANK if char == LITERAL else char).encode())


def stream_of(word: str) -> str:
    return BLANK + word.replace(BLANK, LITERAL)


def log_marginal(word: str, lattice: Lattice) -> float:
    """Natural log of the summed probability of all segmentations of ``▁word``."""
    stream = stream_of(word)
    n, longest, reach = len(stream), lattice.longest, lattice.reach
    alpha = [0.0] + [-math.inf] * n
    for start in range(n):
        a = alpha[start]
        for end in range(start + 1, min(n, start + longest) + 1):
            p = reach.get(stream[start:end], 0)
            if p == 0:
                break
            if p is not None:
                x, y = alpha[end], a + p
                if x == -math.inf:
                    alpha[end] = y
                else:
                    d = x - y
                    alpha[end] = (x + math.log1p(math.exp(-d))) if d >= 0 else (y + math.log1p(math.exp(d)))
        alpha[start + 1] = log_add(alpha[start + 1], a + written_in_bytes(stream[start], lattice))
    return alpha[n]


class Edges:
    """The lattices of many words at once."""

    def __init__(self, lattice: Lattice):
        self.lattice = lattice
        self.index = PieceIndex(lattice.log_p, lattice.longest)
        self.names = self.index.names
        self.number = {name: i for i, name in enumerate(self.names)}
        self.log_p = np.array([lattice.log_p[n] for n in self.names])
        self.bytes: dict[int, float] = {}

    def byte_log(self, codes: np.ndarray) -> np.ndarray:
        """Log probability of each character written in bytes."""
        chars, back = np.unique(codes, return_inverse=True)
        for c in chars.tolist():
            if c not in self.bytes:
                self.bytes[c] = written_in_bytes(chr(c), self.lattice)
        return np.array([self.bytes[c] for c in chars.tolist()])[back.reshape(codes.shape)]

    def forward(self, codes: np.ndarray, found: list, in_bytes: np.ndarray) -> np.ndarray:
        """Log of the summed probability of all ways to each boundary, in one sweep from the left."""
        n = codes.shape[1]
        alpha = np.full((n + 1, len(codes)), -np.inf)
        alpha[0] = 0.0
        last = 0
        for start, end, rows, at in found:
            while last < start:  # every piece from earlier starts is in
                alpha[last + 1] = np.logaddexp(alpha[last + 1], alpha[last] + in_bytes[:, last])
                last += 1
            alpha[end, rows] = np.logaddexp(alpha[end, rows], alpha[start, rows] + self.log_p[at])
        while last < n:
            alpha[last + 1] = np.logaddexp(alpha[last + 1], alpha[last] + in_bytes[:, last])
            last += 1
        return alpha

    def log_marginals(self, words: list[str]) -> np.ndarray:
        """``log_marginal`` of every word."""
        out = np.array([log_marginal(w, self.lattice) if len(w) >= LONG else 0.0 for w in words])
        short = [i for i, w in enumerate(words) if len(w) < LONG]
        for places, codes in by_length([stream_of(words[i]) for i in short]):
            out[[short[i] for i in places]] = self.forward(codes, self.index.matches(codes), self.byte_log(codes))[-1]
        return out

    def expected(self, words: list[str], weights: np.ndarray, pieces: np.ndarray, in_bytes_of: dict[int, float]) -> None:
        """Add how often each piece, and each character in bytes, is expected in the words, all of them whole."""
        short = [i for i, w in enumerate(words) if len(w) < LONG]
        for i, w in enumerate(words):
            if len(w) >= LONG:
                self.expected_in(stream_of(w), float(weights[i]), pieces, in_bytes_of)
        weight = np.asarray(weights, float)[short]
        for rows, codes in by_length([stream_of(words[i]) for i in short]):
            n = codes.shape[1]
            in_bytes = self.byte_log(codes)
            found = list(self.index.matches(codes))
            alpha = self.forward(codes, found, in_bytes)
            beta = np.full_like(alpha, -np.inf)
            beta[n] = 0.0
            total, c = alpha[n], weight[rows]
            todo = n
            for start, end, some, at in reversed(found):
                while todo > start + 1:  # starts without pieces left
                    todo -= 1
                    self._bytes_back(codes, in_bytes, alpha, beta, todo, total, c, in_bytes_of)
                beta[start, some] = np.logaddexp(beta[start, some], self.log_p[at] + beta[end, some])
                share = np.exp(alpha[start, some] + self.log_p[at] + beta[end, some] - total[some]) * c[some]
                pieces += np.bincount(at, share, minlength=len(pieces))
                if end == start + 1:
                    todo = start
                    self._bytes_back(codes, in_bytes, alpha, beta, start, total, c, in_bytes_of)

    def expected_in(self, stream: str, weight: float, pieces: np.ndarray, in_bytes_of: dict[int, float],
                    window: int = WINDOW) -> None:
        """``expected`` of one long stream, by windows: the sums that stand open at a window's start are kept
        on the way forward, and the window is summed again from them on the way back."""
        number, longest, reach, inf = self.number, self.lattice.longest, self.lattice.reach, math.inf
        n = len(stream)
        byte = {c: written_in_bytes(c, self.lattice) for c in set(stream)}

        def edges(start):
            """(end, log probability, piece) of every step from a boundary; bytes have no piece."""
            yield start + 1, byte[stream[start]], None
            for end in range(start + 1, min(n, start + longest) + 1):
                piece = stream[start:end]
                p = reach.get(piece, 0)
                if p == 0:
                    return
                if p is not None:
                    yield end, p, piece

        def forward(lo, open_):
            alpha = open_ + [-inf] * (min(n, lo + window) - lo)
            for start in range(lo, min(n, lo + window)):
                for end, p, _ in edges(start):
                    alpha[end - lo] = log_add(alpha[end - lo], alpha[start - lo] + p)
            return alpha

        starts = range(0, n, window)
        kept, open_ = [], [0.0] + [-inf] * longest  # sums so far to a window's start and the boundaries in reach of it
        for lo in starts:
            kept.append(open_)
            alpha = forward(lo, open_)
            open_ = alpha[min(n, lo + window) - lo:][:longest + 1]
        total = open_[0]
        after = [0.0] + [-inf] * longest
        for lo, open_ in zip(reversed(starts), reversed(kept)):
            hi = min(n, lo + window)
            alpha, beta = forward(lo, open_), [-inf] * (hi - lo) + after
            for start in range(hi - 1, lo - 1, -1):
                for end, p, piece in edges(start):
                    onward = p + beta[end - lo]
                    beta[start - lo] = log_add(beta[start - lo], onward)
                    share = math.exp(alpha[start - lo] + onward - total) * weight
                    if piece is None:
                        char = ord(stream[start])
                        in_bytes_of[char] = in_bytes_of.get(char, 0.0) + share
                    else:
                        pieces[number[piece]] += share
            after = beta[:longest + 1]

    @staticmethod
    def _bytes_back(codes, in_bytes, alpha, beta, start, total, c, in_bytes_of):
        share = np.exp(alpha[start] + in_bytes[:, start] + beta[start + 1] - total) * c
        beta[start] = np.logaddexp(beta[start], in_bytes[:, start] + beta[start + 1])
        chars, back = np.unique(codes[:, start], return_inverse=True)
        for char, x in zip(chars.tolist(), np.bincount(back, share).tolist()):
            in_bytes_of[char] = in_bytes_of.get(char, 0.0) + x


def prior_of(vocabulary: Vocabulary) -> dict:
    """Prior probabilities of pieces (str) and bytes (int) from the vocabulary's scores.

    A score that counts merges is a rank and follows Zipf's law; scores that are log
    probabilities already are used as they are.  Bytes share a thousandth.  Pieces that
    run from a word into a blank can't occur in a chain of words and are left out.
    """
    usable = {p: s for p, (_, s) in vocabulary.pieces.items() if BLANK not in p[1:] and s > -1e8}
    ranks = all(s == int(s) for s in usable.values())
    mass = {p: 1 / (2.7 - s) if ranks else math.exp(s) for p, s in usable.items()}
    total = sum(mass.values())
    return {p: 0.999 * m / total for p, m in mass.items()} | {b: 0.001 / 256 for b in range(256)}


def lattice_from(prior: dict, counts: dict, ends: float) -> Lattice:
    """Pieces by expected counts on top of the prior; the end piece by the number of texts."""
    total = sum(counts.values()) + PRIOR + ends + 1
    p = {k: math.log((counts.get(k, 0.0) + PRIOR * q) / total) for k, q in prior.items()}
    return Lattice({k: v for k, v in p.items() if isinstance(k, str)}, [p[b] for b in range(256)],
                   math.log((ends + 1) / total))


def learning():
    """Rows to learn from: crc32 of the id as text leaves another remainder by 5 than 1."""
    return ~held_out()


def held_out():
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 1, F.lit(False))


def word_table(blocks: DataFrame) -> DataFrame:
    """(block, word, n): the distinct words of each block, n counts those of learning rows."""
    def run(key, table):
        every, learned = set(), Counter()
        for text, learn in zip(table.column("text").to_pylist(), table.column("learn").to_pylist()):
            words = text.lower().split()
            every.update(words)
            if learn:
                learned.update(words)
        words = list(every)
        return pa.table({"block": pa.array([key[0].as_py()] * len(words), pa.int32()), "word": pa.array(words, pa.binary()),
                         "n": pa.array([learned[w] for w in words], pa.int64())})
    return blocks.groupBy("block").applyInArrow(run, "block int, word binary, n long")


def learn(counts: DataFrame, vocabulary: Vocabulary, ends: int) -> Lattice:
    """One expectation pass over all learned words (word, c), added where the words are."""
    prior = prior_of(vocabulary)
    start = counts.sparkSession.sparkContext.broadcast(lattice_from(prior, {}, 0.0))

    def run(batches):
        edges = Edges(start.value)
        pieces, chars = np.zeros(len(edges.names)), {}
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            edges.expected(words, batch.column(1).to_numpy().astype(float), pieces, chars)
        expected = {f"p{name}": n for name, n in zip(edges.names, pieces.tolist()) if n}
        for char, n in chars.items():
            for b in (BLANK if chr(char) == LITERAL else chr(char)).encode():
                expected[f"b{b}"] = expected.get(f"b{b}", 0.0) + n
        yield pa.RecordBatch.from_arrays([pa.array(list(expected), pa.string()),
                                          pa.array(list(expected.values()), pa.float64())], names=["piece", "n"])

    rows = (counts.select("word", "c").mapInArrow(run, "piece string, n double").groupBy("piece")
            .agg(F.sum(F.round(F.col("n") * 1e6).cast("decimal(38,0)")).alias("n")).collect())  # as many as pieces
    total = {(r["piece"][1:] if r["piece"][0] == "p" else int(r["piece"][1:])): float(r["n"]) / 1e6 for r in rows}
    return lattice_from(prior, total, float(ends))


def with_marginals(counts: DataFrame, lattice) -> DataFrame:
    """(word, c, m): m is the log marginal of each distinct word, summed once in the whole table."""
    def run(batches):
        edges = Edges(lattice.value)
        for batch in batches:
            words = [w.decode("utf-8", "replace") for w in batch.column(0).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(edges.log_marginals(words))], names=["word", "c", "m"])
    return counts.select("word", "c").mapInArrow(run, "word binary, c long, m double")


def lm_scores(docs: DataFrame, model: str, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """For every row: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Words lose the case of A-Z; each text ends with one end token.  base_score is the
    smoothed word unigram of the learning rows; score is log10 of the summed probability
    of all segmentations of the words and the end.  A null or empty text is its end
    alone.  Rows without id are learned from.  Repeated rows all count and all return;
    other columns are ignored; without learning rows the prior alone scores.
    """
    spark = docs.sparkSession
    flag = docs.select("doc_id", "text")
    blocks = in_blocks(flag, block_rows).withColumns({"learn": learning(), "text": F.col("text").cast("binary")})
    words = written(word_table(blocks))
    counts = written(words.groupBy("word").agg(F.sum("n").alias("c")))
    n, v = counts.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count_if(F.col("c") > 0)).first()
    ends = flag.filter(learning()).count()
    tokens, distinct = n + ends, v + (ends > 0)
    vocabulary = read_vocabulary(model)
    lattice = spark.sparkContext.broadcast(learn(counts.filter("c > 0"), vocabulary, ends))
    # a word is asked for once per block, so a word of every text has one row a block
    known = words.select("block", "word").join(written(with_marginals(counts, lattice)), "word")
    below = tokens + 0.5 * (distinct + 1)
    base_end, log_end = math.log10((ends + 0.5) / below), lattice.value.log_end

    def score(key, texts, words):
        place = dict(zip(words.column("word").to_pylist(), range(len(words))))
        c = words.column("c").to_numpy()
        marginal, base, seen = words.column("m").to_numpy(), np.log10((c + 0.5) / below), c > 0
        rows = []
        for text in texts.column("text"):
            ws = text.as_py().lower().split()
            at = np.fromiter(map(place.__getitem__, ws), np.int64, len(ws))
            rows.append((len(ws) + 1, int(seen[at].sum()) + (ends > 0), float(base[at].sum()) + base_end,
                         (float(marginal[at].sum()) + log_end) / math.log(10)))
        columns = list(zip(*rows)) or [()] * 4
        return pa.table({"doc_id": texts.column("doc_id"), "n_tokens": pa.array(columns[0], pa.int64()),
                         "n_known": pa.array(columns[1], pa.int64()), "base_score": pa.array(columns[2], pa.float64()),
                         "score": pa.array(columns[3], pa.float64())})

    scored = (blocks.select("block", "doc_id", "text").groupBy("block").cogroup(known.groupBy("block"))
              .applyInArrow(score, "doc_id long, n_tokens long, n_known long, base_score double, score double"))
    return scored.select("doc_id", held_out().alias("held_out"), "n_tokens", "n_known",
                         F.lit(tokens).cast("long").alias("train_tokens"), "base_score", "score")

"""SentencePiece encoding and decoding by streaming Viterbi.

A text is a stream of characters with blanks as ``▁``.  The best path to every place is
kept for a window of the longest piece; once the paths to all places that a coming piece
can still start from run through one boundary, the ids up to it are committed.  No piece
of the usual vocabularies runs from a word into the next blank, so each word commits
when the next begins, and words met before come from a bounded cache.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import slices

BLANK = "▁"
#: stands for a blank sign that the text itself holds; no text in UTF-8 has it
LITERAL = "\ud800"
CACHE = 100_000


@dataclass
class Vocabulary:
    """Pieces with their ids and scores, byte pieces for what no piece covers."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: list[int]
    names: list[bytes]                      # by id: what a piece decodes to
    byte_score: float                       # of a character written in bytes
    longest: int = field(default=0)
    #: every beginning of a piece: its id and score, or (-1, 0) if it is only a beginning
    reach: dict[str, tuple[int, float]] = field(default_factory=dict)
    crossing: bool = field(default=False)   # whether a piece runs from a word into a blank

    def __post_init__(self):
        self.longest = max(map(len, self.pieces), default=1)
        self.reach = {p[:k]: (-1, 0.0) for p in self.pieces for k in range(1, len(p))} | self.pieces
        self.crossing = any(re.search(f"[^{BLANK}]{BLANK}", p) for p in self.pieces)


def read_vocabulary(model: str) -> Vocabulary:
    """Read a SentencePiece model file with byte fallback (on the driver; its size is the vocabulary's)."""
    import sentencepiece
    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    pieces, byte_ids, names = {}, [0] * 256, []
    for i in range(sp.get_piece_size()):
        name = sp.id_to_piece(i)
        if sp.is_byte(i):
            value = int(name[3:5], 16)
            byte_ids[value] = i
            names.append(bytes([value]))
        elif sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i):
            names.append(b"")
        else:
            pieces[name] = (i, sp.get_score(i))
            names.append(name.replace(BLANK, " ").encode())
    usual = [s for _, s in pieces.values() if s > -1e8]
    return Vocabulary(pieces, byte_ids, names, min(usual, default=0.0) - 10.0)


def marked(text: str) -> str:
    """The text with a blank before it, blanks as ``▁``, its own ``▁`` set apart."""
    return BLANK + text.replace(BLANK, LITERAL).replace(" ", BLANK)


def byte_fallback(char: str, vocabulary: Vocabulary) -> list[int]:
    return [vocabulary.byte_ids[b] for b in (BLANK if char == LITERAL else char).encode()]


def viterbi(parts: Iterable[str], vocabulary: Vocabulary) -> Iterator[list[int]]:
    """Ids of the best path through a stream of strings, in the runs in which they are committed.

    The path has the greatest sum of scores; on a tie the longer last piece wins.  A
    character that is no piece is written in its bytes at ``byte_score``.
    """
    reach, longest, fallback = vocabulary.reach, vocabulary.longest, vocabulary.byte_score
    held, at, asked = "", 0, 2 * longest   # characters since the last commit; the next start; when to try a commit
    best: list[float] = [0.0]              # best score to each boundary of ``held`` so far
    back: list[tuple[int, int]] = [(0, -1)]  # where that path came from, and by which piece (-1: bytes)

    def path(start: int, end: int) -> list[int]:
        runs = []
        while end > start:
            came, piece = back[end]
            runs.append([piece] if piece >= 0 else byte_fallback(held[came], vocabulary))
            end = came
        return [i for ids in reversed(runs) for i in ids]

    def relax(stop: int):
        """Follow every piece that starts before ``stop``."""
        for start in range(at, stop):
            score = best[start]
            end = start
            alone = True
            limit = len(held)
            while end < limit:
                end += 1
                piece = reach.get(held[start:end])
                if piece is None:
                    break
                if piece[0] >= 0:
                    if end == start + 1:
                        alone = False
                    total = score + piece[1]
                    if end == len(best):
                        best.append(total)
                        back.append((start, piece[0]))
                    elif total > best[end]:
                        best[end] = total
                        back[end] = (start, piece[0])
                elif end == len(best):
                    best.append(float("-inf"))
                    back.append((start, -1))
            if alone:
                total = score + fallback
                if start + 1 == len(best):
                    best.append(total)
                    back.append((start, -1))
                elif total > best[start + 1]:
                    best[start + 1] = total
                    back[start + 1] = (start, -1)

    for part in parts:
        held += part
        while len(held) - at > longest:
            stop = min(len(held) - longest, max(at + 1, asked))
            relax(stop)
            at = stop
            if at < asked:
                continue
            # the boundaries that a coming piece can start from: where do their best paths meet?
            live = {b for b in range(at, len(best)) if best[b] > float("-inf")}
            while len(live) > 1:
                last = max(live)
                live.remove(last)
                live.add(back[last][0])
            meet = live.pop()
            if meet:
                yield path(0, meet)
                held, best, at = held[meet:], best[meet:], at - meet
                back = [(0, -1)] + [(came - meet, piece) for came, piece in back[meet + 1:]]
            asked = at + longest
    relax(len(held))
    yield path(0, len(held))


def best_path(word: str, vocabulary: Vocabulary) -> bytes:
    """Ids of ``viterbi`` for a word that is shorter than a window, so nothing commits before its end."""
    reach, fallback, n = vocabulary.reach, vocabulary.byte_score, len(word)
    best = [float("-inf")] * (n + 1)
    best[0] = 0.0
    back = [(0, -1)] * (n + 1)
    for start in range(n):
        score, end = best[start], start + 1
        piece = reach.get(word[start])
        if piece is None or piece[0] < 0:
            if score + fallback > best[end]:
                best[end] = score + fallback
                back[end] = (start, -1)
        elif score + piece[1] > best[end]:
            best[end] = score + piece[1]
            back[end] = (start, piece[0])
        while piece is not None and end < n:
            end += 1
            piece = reach.get(word[start:end])
            if piece is not None and piece[0] >= 0 and score + piece[1] > best[end]:
                best[end] = score + piece[1]
                back[end] = (start, piece[0])
    ids, end = [], n
    while end:
        came, piece = back[end]
        ids += [piece] if piece >= 0 else byte_fallback(word[came], vocabulary)[::-1]
        end = came
    return np.array(ids[::-1], "<i4").tobytes()


class PieceIndex:
    """Pieces and their beginnings by hash, to find the pieces of many words at once."""

    FACTOR = 0x9E3779B97F4A7C15

    def __init__(self, pieces: Iterable[str], longest: int):
        self.names, self.longest = list(pieces), longest
        number = {name: i for i, name in enumerate(self.names)}
        beginnings = {p[:k] for p in self.names for k in range(1, len(p) + 1)}
        hashes, found = np.zeros(len(beginnings), np.uint64), np.full(len(beginnings), -1, np.int32)
        for i, name in enumerate(beginnings):
            h = 0
            for char in name:
                h = (h * self.FACTOR + ord(char) + 1) & 0xFFFFFFFFFFFFFFFF
            hashes[i], found[i] = h, number.get(name, -1)
        order = np.argsort(hashes)
        self.hashes, self.found = hashes[order], found[order]

    def matches(self, codes: np.ndarray):
        """(start, end, rows, piece numbers) of every piece in words of one length, as code points."""
        n = codes.shape[1]
        factor, one = np.uint64(self.FACTOR), np.uint64(1)
        for start in range(n):
            rows = np.arange(len(codes))
            h = np.zeros(len(codes), np.uint64)
            for end in range(start + 1, min(n, start + self.longest) + 1):
                h = h * factor + codes[rows, end - 1] + one
                at = np.searchsorted(self.hashes, h)
                at[at == len(self.hashes)] = 0
                hit = self.hashes[at] == h  # words that begin no piece here are done with this start
                rows, h, piece = rows[hit], h[hit], self.found[at[hit]]
                if not len(rows):
                    break
                whole = piece >= 0
                yield start, end, rows[whole], piece[whole]


def by_length(streams: list[str], most: int = 4096):
    """(places, code points) of streams of one length, at most ``most`` at a time."""
    groups: dict[int, list[int]] = {}
    for i, stream in enumerate(streams):
        groups.setdefault(len(stream), []).append(i)
    for n, places in groups.items():
        for k in range(0, len(places), most):
            some = places[k:k + most]
            text = "".join([streams[i] for i in some]).encode("utf-32-le", "surrogatepass")
            yield some, np.frombuffer(text, "<u4").reshape(len(some), n)


class Paths:
    """``best_path`` of many words at once: the same recursion, a column of words at a time."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.index = PieceIndex(vocabulary.pieces, vocabulary.longest)
        self.ids = np.array([vocabulary.pieces[p][0] for p in self.index.names], np.int32)
        self.scores = np.array([vocabulary.pieces[p][1] for p in self.index.names])

    def solve(self, streams: list[str]) -> list[bytes]:
        out: list[bytes] = [b""] * len(streams)
        for places, codes in by_length(streams):
            size, n = codes.shape
            best = np.full((n + 1, size), -np.inf)
            best[0] = 0.0
            came = np.zeros((n + 1, size), np.int32)
            piece = np.full((n + 1, size), -1, np.int32)
            for start, end, rows, at in self.index.matches(codes):
                score = best[start, rows] + self.scores[at]
                better = score > best[end, rows]
                rows = rows[better]
                best[end, rows], came[end, rows], piece[end, rows] = score[better], start, at[better]
            whole = np.isfinite(best).all(axis=0)  # the others need bytes somewhere
            for i in np.flatnonzero(~whole).tolist():
                out[places[i]] = best_path(streams[places[i]], self.vocabulary)
            rows = np.flatnonzero(whole)
            end = np.full(len(rows), n)
            ids = np.zeros((len(rows), n), np.int32)
            used = np.zeros((len(rows), n), bool)
            for k in range(n - 1, -1, -1):  # paths from their ends, written from the right
                on = np.flatnonzero(end > 0)
                if not len(on):
                    break
                ids[on, k], used[on, k] = self.ids[piece[end[on], rows[on]]], True
                end[on] = came[end[on], rows[on]]
            data = ids[used].astype("<i4").tobytes()
            cut = np.concatenate(([0], np.cumsum(used.sum(axis=1)))) * 4
            for i, a, b in zip(rows.tolist(), cut[:-1].tolist(), cut[1:].tolist()):
                out[places[i]] = data[a:b]
        return out


class Words:
    """Ids of words met before, the latest ``CACHE`` to twice as many."""

    def __init__(self, vocabulary: Vocabulary, blank: str):
        self.vocabulary, self.blank, self.new, self.old = vocabulary, blank, {}, {}

    def learn(self, words: set[str], paths: Paths) -> None:
        """Take in words at once, ahead of their texts."""
        words = [w for w in words if w not in self.new]
        fresh = []
        for w in words:
            ids = self.old.get(w)
            if ids is None:
                if len(w) < 2 * self.vocabulary.longest:
                    fresh.append(w)
            else:
                self.new[w] = ids
        self.new.update(zip(fresh, paths.solve([self.blank + w.replace(BLANK, LITERAL) for w in fresh])))

    def turn(self) -> None:
        if len(self.new) >= CACHE:
            self.old, self.new = self.new, {}

    def miss(self, word: str) -> bytes:
        ids = self.old.get(word)
        if ids is None:
            stream = self.blank + word.replace(BLANK, LITERAL)
            if len(stream) > 2 * self.vocabulary.longest:
                parts = (stream[k:k + 4096] for k in range(0, len(stream), 4096))
                ids = np.array([i for run in viterbi(parts, self.vocabulary) for i in run], "<i4").tobytes()
            else:
                ids = best_path(stream, self.vocabulary)
        if len(word) <= 64:
            self.new[word] = ids
        return ids


class Encoder:
    """``encode`` with the words met before."""

    def __init__(self, vocabulary: Vocabulary, paths: Paths | None = None):
        self.vocabulary, self.paths = vocabulary, paths
        self.after_blank, self.bare = Words(vocabulary, BLANK), Words(vocabulary, "")
        self.line_end = np.array(byte_fallback("\n", vocabulary), "<i4").tobytes()
        # no piece holds a line feed: every line commits before the next
        self.by_line = not any("\n" in p for p in vocabulary.pieces)

    def encode_all(self, texts: list[str]) -> list[bytes]:
        """``encode`` of several texts; their new words are solved together."""
        if self.by_line and not self.vocabulary.crossing:
            blank, bare = set(), set()
            for text in texts:
                first, *rest = text.split("\n")
                blank.update(first.split(" "))
                for line in rest:
                    start, *following = line.split(" ")
                    bare.add(start)
                    blank.update(following)
            bare.discard("")
            self.paths = self.paths or Paths(self.vocabulary)
            self.after_blank.learn(blank, self.paths)
            self.bare.learn(bare, self.paths)
        out = [self.encode(text) for text in texts]
        self.after_blank.turn()
        self.bare.turn()
        return out

    def encode(self, text: str) -> bytes:
        """The ids of a text as little-endian 32-bit numbers; an empty text has none."""
        if not text:
            return b""
        if self.vocabulary.crossing or not self.by_line or "  " in text or text[0] == " ":
            stream = marked(text)
            words = [stream] if self.vocabulary.crossing else re.findall(f"{BLANK}+[^{BLANK}]*", stream)
            out = []
            for word in words:
                parts = (word[k:k + 4096] for k in range(0, len(word), 4096))
                if word.count(BLANK) > 1 or not self.by_line:
                    out.append(np.array([i for run in viterbi(parts, self.vocabulary) for i in run], "<i4").tobytes())
                else:
                    self._lines(word[1:].replace(LITERAL, BLANK), out)
            return b"".join(out)
        out = []
        self._lines(text, out)
        return b"".join(out)

    def _lines(self, text: str, out: list) -> None:
        words, bare = self.after_blank, self.bare
        first, *rest = text.split("\n")
        seen = words.new
        out += [seen.get(w) or words.miss(w) for w in first.split(" ")]
        for line in rest:
            out.append(self.line_end)
            start, *following = line.split(" ")
            if start:
                out.append(bare.new.get(start) or bare.miss(start))
            seen = words.new
            out += [seen.get(w) or words.miss(w) for w in following]


def encode(text: str, vocabulary: Vocabulary) -> bytes:
    return Encoder(vocabulary).encode(text)


def decode(ids: Iterable[int], vocabulary: Vocabulary) -> str:
    """The text of ids: the exact inverse of ``encode``; other ids decode to what their pieces spell."""
    names = vocabulary.names
    data = b"".join(map(names.__getitem__, ids))
    return (data[1:] if data[:1] == b" " else data).decode("utf-8", "replace")


def encode_texts(docs: DataFrame, model: str, keep: tuple[str, ...] = ("doc_id", "text"),
                 decoded: bool = False) -> DataFrame:
    """``keep`` columns and ids (array of int) of every row; a null or empty text has no ids.
    With ``decoded`` also the text that the ids decode to, by the same tasks.

    Repeated rows all return; other columns are dropped.  The vocabulary is sent to
    every task; its size does not depend on the data.
    """
    kept = docs.select(*keep)
    paths = docs.sparkSession.sparkContext.broadcast(Paths(read_vocabulary(model)))

    def run(batches):
        encoder = Encoder(paths.value.vocabulary, paths.value)
        for batch in slices(batches):
            runs = encoder.encode_all([t or "" for t in batch.column(batch.num_columns - 1).to_pylist()])
            offsets = np.concatenate(([0], np.cumsum([len(r) // 4 for r in runs])))
            ids = pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.array(np.frombuffer(b"".join(runs), "<i4")))
            columns, names = [*batch.columns[:-1], ids], [*keep, "ids"]
            if decoded:
                columns.append(pa.array([decode(np.frombuffer(r, "<i4").tolist(), paths.value.vocabulary) for r in runs], pa.string()))
                names.append("decoded")
            yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.schema.fields)
    return docs.select(*keep, F.col("text").alias("__text")).mapInArrow(
        run, f"{schema}, ids array<int>" + ", decoded string" * decoded)


def decode_ids(encoded: DataFrame, model: str) -> DataFrame:
    """``encoded`` (with ids) and decoded, the text its ids spell; null ids spell an empty text."""
    vocabulary = encoded.sparkSession.sparkContext.broadcast(read_vocabulary(model))
    columns = [c for c in encoded.columns if c != "ids"]

    def run(batches):
        for batch in slices(batches):
            column = batch.column(len(columns))
            texts = [decode(column[i].values.to_numpy().tolist() if column[i].is_valid else (), vocabulary.value)
                     for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(texts, pa.string())],
                                             names=[*columns, "ids", "decoded"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in encoded.select(*columns, "ids").schema.fields)
    return encoded.select(*columns, "ids").mapInArrow(run, f"{schema}, decoded string")

"""Toxicity: a logistic classifier with counterfactual regularisation.

Each labelled text that mentions an identity term is also read with the term swapped
for the others of its set; the loss penalises the squared change of the log-odds, so
that naming a group moves no score.  Gradients are computed where the rows are; the
driver holds one weight per feature and combines one gradient per task.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pickwise.llm.common import slices, written

# Sets of identity terms that may stand for one another.
IDENTITY_SETS = [
    ["women", "men", "girls", "boys"],
    ["woman", "man", "girl", "boy"],
    ["female", "male", "transgender", "nonbinary"],
    ["gay", "lesbian", "bisexual", "straight", "queer"],
    ["muslim", "christian", "jewish", "hindu", "buddhist", "atheist", "catholic"],
    ["muslims", "christians", "jews", "hindus", "buddhists", "atheists", "catholics"],
    ["black", "white", "asian", "latino", "african", "european"],
    ["immigrant", "refugee", "foreigner", "native"],
    ["immigrants", "refugees", "foreigners", "natives"],
    ["disabled", "deaf", "blind", "autistic"],
    ["elderly", "young"],
]

PREFIXES = (4, 5, 6)


def words_of(text: str) -> set[str]:
    return set(re.findall(r"\w+", text.lower()))


def features_of(word: str) -> list[str]:
    """The word and its beginnings; ``^`` marks a beginning."""
    return [word] + ["^" + word[:k] for k in PREFIXES if len(word) >= k]


def text_features(words: set[str]) -> set[str]:
    return {f for w in words for f in features_of(w)}


def swaps_of(words: set[str]) -> list[set[str]]:
    """The word sets of the text with all terms of one identity set swapped for another term of it."""
    out = []
    for group in IDENTITY_SETS:
        named = words.intersection(group)
        if named:
            out += [(words - named) | {other} for other in group if other not in named]
    return out


class Known(dict):
    """Numbers of the features of words met before: the latest ``size`` words to twice as many."""

    def __init__(self, index: dict[str, int], size: int = 100_000):
        super().__init__()
        self.index, self.size, self.old = index, size, {}

    def __missing__(self, word: str) -> tuple[int, ...]:
        found = self.old.get(word)
        if found is None:
            found = tuple(self.index[f] for f in features_of(word) if f in self.index)
        self[word] = found
        return found

    def turn(self) -> None:
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()


@dataclass
class Model:
    """Weights by feature, the intercept, and what they were learned from."""

    weights: dict[str, float]
    intercept: float
    rows: int

    def score(self, docs: DataFrame, keep: list[Column] | None = None) -> DataFrame:
        """``keep`` columns (default doc_id) with score, the probability of toxicity in 0..1.

        Null and empty texts get the intercept's score.  Every whole text is read.
        """
        model = docs.sparkSession.sparkContext.broadcast(
            ({f: i for i, f in enumerate(self.weights)}, list(self.weights.values()), self.intercept))
        rows = docs.select(*(keep or ["doc_id"]))
        kept = rows.schema
        at = kept.names.index("text") if "text" in kept.names else len(kept)
        if at == len(kept):
            rows = docs.select(*(keep or ["doc_id"]), F.col("text"))
        names = [*kept.names, "score"]

        def run(batches):
            index, weights, intercept = model.value
            known = Known(index)
            for batch in slices(batches):
                z = np.empty(batch.num_rows)
                for i, text in enumerate(batch.column(at)):
                    found = set().union(*map(known.__getitem__, words_of(text.as_py() or "")))
                    z[i] = intercept + math.fsum(map(weights.__getitem__, found))
                    known.turn()
                score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
                yield pa.RecordBatch.from_arrays([*batch.columns[:len(names) - 1], pa.array(score)], names=names)
        schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in kept.fields)
        return rows.mapInArrow(run, f"{schema}, score double")


def learning(doc_id: str = "doc_id") -> Column:
    """Rows to learn from: crc32 of the id as text leaves another remainder by 3 than 1."""
    return ~held_out(doc_id)


def held_out(doc_id: str = "doc_id") -> Column:
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 3 == 1, F.lit(False))


def minimise(loss, w: np.ndarray, rounds: int, tol: float = 1e-4) -> np.ndarray:
    """L-BFGS with a halving line search; ``loss`` gives value and gradient."""
    f, g = loss(w)
    first, past = np.linalg.norm(g), []
    for _ in range(rounds):
        q, alphas = g.copy(), []
        for s, d in reversed(past):
            a = s @ q / (s @ d)
            alphas.append(a)
            q -= a * d
        if past:
            s, d = past[-1]
            q *= (s @ d) / (d @ d)
        else:
            q /= max(1.0, np.linalg.norm(q))
        for (s, d), a in zip(past, reversed(alphas)):
            q += s * (a - d @ q / (s @ d))
        step = 1.0
        while True:
            w2 = w - step * q
            f2, g2 = loss(w2)
            if f2 <= f - 1e-4 * step * (g @ q) or step < 1e-5:
                break
            step /= 2
        if (w2 - w) @ (g2 - g) > 1e-12:
            past = [*past[-7:], (w2 - w, g2 - g)]
        w, f, g = w2, f2, g2
        if np.linalg.norm(g) <= tol * first:
            break
    return w


def fit(docs: DataFrame, labels: DataFrame, max_rows: int = 20_000, ridge: float = 0.2,
        fairness: float = 5.0, rounds: int = 25) -> Model:
    """Learn from the labelled rows of the learning folds.

    ``labels`` (doc_id, toxic): null ids and labels are left out, an id with several
    labels counts as toxic if any is.  ``max_rows`` bounds the labelled ids learned
    from: beyond it, a fraction of them by id hash is used, about ``max_rows`` ids.
    Classes weigh the same.  A feature counts once per text and must occur in more
    than one in 2,000 rows (at least 3).  ``fairness`` weighs the squared change of the
    log-odds, averaged over a row's swaps.  Without any labelled row every score is 0.5.
    """
    spark = docs.sparkSession
    marked = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull()).filter(learning())
              .groupBy(F.col("doc_id").cast("long").alias("label_id")).agg(F.max((F.col("toxic") > 0).cast("int")).alias("y")))
    n = marked.count()
    if not n:
        return Model({}, 0.0, 0)
    if n > max_rows:
        marked = marked.filter(F.pmod(F.xxhash64("label_id"), F.lit(1_000_000)) < int(1_000_000 * max_rows / n))
    # at most about max_rows ids of two numbers each: small enough to send to every task
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = (docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
            .join(F.broadcast(marked), F.col("doc_id") == F.col("label_id")).select("y", "text"))

    def read(batches):
        for batch in batches:
            words = [words_of(t.as_py()) for t in batch.column(1)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([sorted(w) for w in words], pa.list_(pa.string()))], names=["y", "words"])

    seen = written(rows.mapInArrow(read, "y int, words array<string>"))

    def tally(batches):
        counts: dict[str, int] = {}
        for batch in batches:
            for ws in batch.column(0).to_pylist():
                for f in text_features(set(ws)):
                    counts[f] = counts.get(f, 0) + 1
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                                         names=["feature", "n"])

    classes = {r["y"]: r["n"] for r in seen.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    total = sum(classes.values())
    if not total:
        return Model({}, 0.0, 0)
    least = max(3, total // 2000)
    names = [r["feature"] for r in seen.select("words").mapInArrow(tally, "feature string, n long").groupBy("feature")
             .agg(F.sum("n").alias("n")).filter(F.col("n") >= least).orderBy("feature").collect()]
    index = {f: i for i, f in enumerate(names)}
    place = spark.sparkContext.broadcast(index)

    def numbered(batches):
        at = place.value
        for batch in batches:
            ids, swaps = [], []
            for ws in batch.column(1).to_pylist():
                ws = set(ws)
                own = {at[f] for f in text_features(ws) if f in at}
                ids.append(sorted(own))
                mine = []
                for other in swaps_of(ws):
                    new = {at[f] for f in text_features(other) if f in at}
                    mine.append([i + 1 for i in sorted(new - own)] + [-i - 1 for i in sorted(own - new)])
                swaps.append(mine)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.list_(pa.int32())), pa.array(swaps, pa.list_(pa.list_(pa.int32())))],
                names=["y", "ids", "swaps"])

    table = written(seen.mapInArrow(numbered, "y int, ids array<int>, swaps array<array<int>>"))
    weigh = {c: total / (len(classes) * k) for c, k in classes.items()}

    def loss(w):
        now = spark.sparkContext.broadcast(w)

        def part(batches):
            w = now.value
            value, grad = 0.0, np.zeros(len(w))
            for batch in batches:
                y = batch.column(0).to_numpy().astype(float)
                cost = np.array([weigh[int(c)] for c in y])
                ids = batch.column(1).flatten().to_numpy()
                row = np.repeat(np.arange(len(y)), np.diff(batch.column(1).offsets.to_numpy()))
                z = np.bincount(row, w[ids], minlength=len(y)) + w[-1]
                miss = cost * (1 / (1 + np.exp(-np.clip(z, -500, 500))) - y)
                value += float(np.sum(cost * (np.logaddexp(0, z) - y * z)))
                grad[:-1] += np.bincount(ids, miss[row], minlength=len(w) - 1)
                grad[-1] += miss.sum()
                for swaps in batch.column(2).to_pylist():
                    for signed in swaps:
                        if signed:
                            s = np.array(signed)
                            at, sign = np.abs(s) - 1, np.sign(s)
                            change = float(w[at] @ sign)
                            value += fairness / 2 * change ** 2 / len(swaps)
                            grad[at] += fairness * change * sign / len(swaps)
            yield pa.RecordBatch.from_arrays([pa.array([value]), pa.array([grad.tobytes()], pa.binary())], names=["f", "g"])

        parts = table.mapInArrow(part, "f double, g binary").collect()  # one row per task of the bounded sample
        now.destroy()
        value = sum(r["f"] for r in parts) + ridge / 2 * float(w[:-1] @ w[:-1])
        grad = np.sum([np.frombuffer(r["g"]) for r in parts], axis=0)
        grad[:-1] += ridge * w[:-1]
        return value, grad

    w = minimise(loss, np.zeros(len(names) + 1), rounds)
    return Model({f: float(x) for f, x in zip(names, w[:-1])}, float(w[-1]), total)


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, **how) -> DataFrame:
    """For every row: doc_id, held_out, score, predicted (score >= ``threshold``).

    Repeated rows all return; a row without id is not held out; other columns are ignored.
    """
    return (fit(docs, labels, **how).score(docs)
            .select("doc_id", held_out().alias("held_out"), "score",
                    (F.col("score") >= threshold).cast("int").alias("predicted")))

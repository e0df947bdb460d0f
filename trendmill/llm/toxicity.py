"""Toxicity by ordinal regression: one score per text, cut by ordered thresholds into grades of severity.

P(grade > k) = sigmoid(score - threshold[k]), with the same weights for every threshold. The score is a weighted sum over
sparse features: logarithms of how often a word, or the beginning of a word, occurs.
"""

from __future__ import annotations

import re
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trendmill.llm.common import stage

# The model is fitted on at most this many labelled documents (those with the smallest hash of the doc_id).
MAX_LABELLED = 20_000
# Features the model may use: those whose presence says most about grades above 0.
FEATURES = 2000
# Twice the log-likelihood ratio a feature needs: among a million features, chance gives about one of this size.
MIN_EVIDENCE = 24.0
# A text is called toxic if a grade above 0 is at least as likely.
TOXIC_FROM = 0.5
PREFIXES = (4, 5, 6, 7, 8)
_WORD = re.compile(r"[^\W\d_]+")
_LENGTH = 0
_REMEMBERED = 400_000


def word_features(word: str) -> list[int]:
    """The features of one lower-case word: itself and its longer beginnings, as 63-bit hashes."""
    names = [f"={word}", *(f"^{word[:k]}" for k in PREFIXES if len(word) > k)]
    return [xxhash.xxh64_intdigest(n.encode()) >> 1 for n in names]


class Features:
    """Counts features of texts; of known words only those in ``wanted`` are kept, and words are remembered."""

    def __init__(self, wanted: set[int] | None = None):
        self.wanted = wanted
        self.known: dict[str, list[int]] = {}

    def __call__(self, text: str | None) -> tuple[Counter, int]:
        """(feature counts, number of words)"""
        words = Counter(_WORD.findall((text or "").lower()))
        counts: Counter = Counter()
        known = self.known
        for word, n in words.items():
            found = known.get(word)
            if found is None:
                if len(known) >= _REMEMBERED:
                    known.clear()
                found = word_features(word)
                if self.wanted is not None:
                    found = [f for f in found if f in self.wanted]
                known[word] = found
            for f in found:
                counts[f] += n
        return counts, words.total()


@dataclass(frozen=True)
class Model:
    """Weights by feature (feature 0 is the logarithm of the number of words) and ascending thresholds."""
    weights: dict[int, float]
    thresholds: list[float]

    def score(self, counts: Counter, n_words: int) -> float:
        weights = self.weights
        score = weights.get(_LENGTH, 0.0) * float(np.log1p(n_words))
        for f in sorted(counts):
            if f in weights:
                score += weights[f] * float(np.log1p(counts[f]))
        return score

    def above(self, score: float) -> list[float]:
        """P(grade > k) for each threshold."""
        return [float(1 / (1 + np.exp(-np.clip(score - t, -500, 500)))) for t in self.thresholds]


def fit(rows: list[tuple[int, list[int], list[float]]], n_features: int, grades: int, steps: int = 800,
        ridge: float = 0.2, rate: float = 0.1) -> tuple[np.ndarray, np.ndarray]:
    """(weights, thresholds) of least regularised loss, by Adam over all rows (grade, feature places, values).

    The thresholds are the first one plus positive gaps, so they stay in order. Without rows everything is 0 but the
    thresholds, which say that nothing is severe.
    """
    if not rows:
        return np.zeros(n_features), np.full(grades - 1, 20.0) + np.arange(grades - 1)
    grade = np.array([r[0] for r in rows])
    row = np.repeat(np.arange(len(rows)), [len(r[1]) for r in rows])
    place = np.concatenate([np.array(r[1], np.int64) for r in rows])
    value = np.concatenate([np.array(r[2], float) for r in rows])
    share = [(np.sum(grade > k) + 0.5) / (len(grade) + 1) for k in range(grades - 1)]
    start = np.maximum.accumulate([-np.log(s / (1 - s)) for s in share])
    gaps = np.log(np.maximum(np.diff(start), 0.1))
    theta = np.concatenate([np.zeros(n_features), start[:1], gaps])
    first, second = np.zeros_like(theta), np.zeros_like(theta)
    bounds = np.concatenate
    for step in range(1, steps + 1):
        w, cuts = theta[:n_features], theta[n_features] + bounds(([0.0], np.cumsum(np.exp(theta[n_features + 1:]))))
        score = np.bincount(row, w[place] * value, len(rows))
        # cumulative probabilities at the edges of each row's grade
        edges = bounds(([-np.inf], cuts, [np.inf]))
        low = 1 / (1 + np.exp(np.clip(score - edges[grade], -500, 500)))
        high = 1 / (1 + np.exp(np.clip(score - edges[grade + 1], -500, 500)))
        mass = np.maximum(high - low, 1e-12)
        d_low, d_high = low * (1 - low), high * (1 - high)
        slope = (d_high - d_low) / mass / len(rows)
        g = np.zeros_like(theta)
        g[:n_features] = np.bincount(place, value * slope[row], n_features) + ridge / len(rows) * w
        to_cut = np.zeros(grades + 1)
        np.add.at(to_cut, grade + 1, -d_high / mass / len(rows))
        np.add.at(to_cut, grade, d_low / mass / len(rows))
        to_cut = to_cut[1:grades]
        g[n_features] = to_cut.sum()
        later = np.cumsum(to_cut[::-1])[::-1]
        g[n_features + 1:] = later[1:] * np.exp(theta[n_features + 1:])
        first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
        theta = theta - rate * (first / (1 - 0.9 ** step)) / (np.sqrt(second / (1 - 0.999 ** step)) + 1e-8)
    cuts = theta[n_features] + bounds(([0.0], np.cumsum(np.exp(theta[n_features + 1:]))))
    return theta[:n_features], cuts


def labelled_sample(docs: DataFrame, labels: DataFrame, grade: Column, text: str, doc_id: str,
                    most: int = MAX_LABELLED) -> DataFrame:
    """(doc_id, grade, text), staged: a document per labelled doc_id, at most ``most`` of them.

    Of a doc_id with several labels the highest grade counts, of one with several texts the smallest.
    """
    chosen = labels.select(F.col(f"`{doc_id}`").alias("doc_id"), grade.cast("int").alias("grade")) \
        .filter("doc_id is not null and grade is not null").groupBy("doc_id").agg(F.max("grade").alias("grade")) \
        .orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    # At most ``most`` rows of two numbers.
    found = texts.join(F.broadcast(chosen), "doc_id")
    return stage(found.groupBy("doc_id", "grade").agg(F.min("text").alias("text")), "labelled")


def choose_features(sample: DataFrame, n: int = FEATURES) -> list[int]:
    """The features whose presence raises the odds of a grade above 0 most surely, by the log-likelihood ratio.

    Presence is counted in the tasks; only sums by feature are shuffled, and ``n`` features come to the driver.
    """
    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, seen, severe = Features(), Counter(), Counter()

        def out():
            keys = list(seen)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys, pa.int64()), pa.array([seen[k] for k in keys], pa.int64()),
                 pa.array([severe[k] for k in keys], pa.int64())], ["feature", "n", "severe"])

        for batch in batches:
            for grade, text in zip(batch.column(0).to_pylist(), batch.column(1)):
                features = count(text.as_py())[0]
                seen.update(features.keys())
                if grade > 0:
                    severe.update(features.keys())
                if len(seen) > 500_000:
                    yield out()
                    seen, severe = Counter(), Counter()
        if seen:
            yield out()

    totals = sample.agg(F.count("*").alias("n"), F.count_if(F.col("grade") > 0).alias("severe")).first()
    all_, bad = float(totals["n"]), float(totals["severe"])
    if not bad or bad == all_:
        return []
    k, a = F.col("n").cast("double"), F.col("severe").cast("double")

    def part(seen: Column, expected: Column) -> Column:
        return F.when(seen > 0, 2 * seen * F.log(seen / expected)).otherwise(0.0)

    good = all_ - bad
    g = (part(a, k * bad / all_) + part(k - a, k * good / all_)
         + part(bad - a, (all_ - k) * bad / all_) + part(good - k + a, (all_ - k) * good / all_))
    counts = sample.select("grade", "text").mapInArrow(presence, "feature long, n long, severe long") \
        .groupBy("feature").agg(F.sum("n").alias("n"), F.sum("severe").alias("severe"))
    sure = counts.filter((k < all_) & (a * all_ > k * bad)).withColumn("g", g).filter(F.col("g") >= MIN_EVIDENCE)
    best = sure.orderBy(F.desc("g"), "feature").limit(n)
    return [r["feature"] for r in best.select("feature").collect()]


def refined(toxic: list[int], evidence: list[float], grades: int) -> list[int]:
    """Grades from labels that only say toxic or not: toxic texts are shared out evenly over the grades above 0, by the
    rank of their evidence among toxic texts. Equal evidence means the same grade."""
    held = sorted(e for t, e in zip(toxic, evidence) if t > 0)
    return [1 + bisect_left(held, e) * (grades - 1) // len(held) if t > 0 else 0 for t, e in zip(toxic, evidence)]


def unseen_evidence(toxic: list[int], half: list[int], rows: list[tuple[list[int], list[float]]],
                    chosen: list[set[int]], n_features: int) -> list[float]:
    """Of each text, how far a model that has not seen it finds it toxic (the logarithm of the odds).

    The model of a text in one half is fitted on the other half, with the features ``chosen`` there.
    """
    evidence = [0.0] * len(rows)
    for k in (0, 1):
        kept = [[(p, v) for p, v in zip(*row) if p == 0 or p in chosen[1 - k]] for row in rows]
        seen = [(min(t, 1), [p for p, _ in r], [v for _, v in r]) for t, h, r in zip(toxic, half, kept) if h != k]
        weights, cuts = fit(seen, n_features, 2)
        for i, row in enumerate(kept):
            if half[i] == k:
                evidence[i] = float(sum(weights[p] * v for p, v in row) - cuts[0])
    return evidence


def train(docs: DataFrame, labels: DataFrame, grade: Column, grades: int, refine: bool = False, text: str = "text",
          doc_id: str = "doc_id", most: int = MAX_LABELLED) -> Model:
    """A model from the labelled documents; ``grade`` is a column of ``labels`` with 0 to ``grades`` - 1.

    With ``refine`` the labels are 0 and 1 only, and toxic texts are graded by ``unseen_evidence``: the sample is halved by
    a hash of the text, so that copies fall into the same half, and each half is judged by a model of the other. What
    reaches the driver is bounded: the chosen features, and their counts in at most ``most`` documents.
    """
    sample = labelled_sample(docs, labels, grade, text, doc_id, most) \
        .withColumn("half", F.pmod(F.xxhash64("text"), F.lit(2)).cast("int"))
    chosen = choose_features(sample)
    halves = [choose_features(sample.filter(F.col("half") == k)) for k in (0, 1)] if refine else []
    place = {f: i for i, f in enumerate(dict.fromkeys([_LENGTH, *chosen, *(f for h in halves for f in h)]))}

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Features(set(place))
        for batch in batches:
            places, values = [], []
            for text_ in batch.column(2):
                counts, n_words = count(text_.as_py())
                here = sorted((place[f], float(np.log1p(n))) for f, n in counts.items())
                places.append([0, *(p for p, _ in here)])
                values.append([float(np.log1p(n_words)), *(v for _, v in here)])
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), batch.column(3), pa.array(places, pa.list_(pa.int32())),
                 pa.array(values, pa.list_(pa.float32()))], ["doc_id", "grade", "half", "places", "values"])

    kind = dict(sample.dtypes)["doc_id"]
    table = sample.select("doc_id", "grade", "text", "half").mapInArrow(
        rows, f"doc_id {kind}, grade int, half int, places array<int>, values array<float>").toArrow()
    data = sorted(zip(*(table.column(c).to_pylist() for c in ("doc_id", "grade", "half", "places", "values"))))
    graded = [min(max(g, 0), grades - 1) for _, g, _, _, _ in data]
    if refine:
        in_half = [{place[f] for f in h} for h in halves]
        graded = refined(graded, unseen_evidence(
            graded, [h for _, _, h, _, _ in data], [(p, v) for _, _, _, p, v in data], in_half, len(place)), grades)
    # Features that only a half has chosen come after all others.
    n_features = len(chosen) + 1
    kept = [[(p, v) for p, v in zip(places, values) if p < n_features] for _, _, _, places, values in data]
    weights, thresholds = fit([(g, *map(list, zip(*row))) for g, row in zip(graded, kept)], n_features, grades)
    return Model(dict(zip([_LENGTH, *chosen], weights.tolist())), thresholds.tolist())


def predict(docs: DataFrame, model: Model, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """doc_id, severity (the expected grade), p_toxic (of a grade above 0), grade (the likeliest) and toxic of every row.

    Null text counts as empty. Repeated rows are judged alike, a null doc_id is carried along, texts are read whole, and
    other columns are not read.
    """
    source = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = Features(set(model.weights))
        for batch in batches:
            above = [model.above(model.score(*count(t.as_py()))) for t in batch.column(1)]
            shares = [np.diff([0.0, *(1 - np.array(a)), 1.0]) for a in above]
            yield pa.RecordBatch.from_arrays([
                batch.column(0), pa.array([sum(a) for a in above], pa.float64()),
                pa.array([a[0] for a in above], pa.float64()),
                pa.array([int(np.argmax(s)) for s in shares], pa.int32()),
                pa.array([a[0] >= TOXIC_FROM for a in above], pa.bool_()),
            ], ["doc_id", "severity", "p_toxic", "grade", "toxic"])

    kind = dict(source.dtypes)["doc_id"]
    return source.mapInArrow(run, f"doc_id {kind}, severity double, p_toxic double, grade int, toxic boolean")

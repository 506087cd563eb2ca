"""Toxic passages by maximum-scoring segments.

1. Token log-odds: counts of the toxic and other training documents that hold
   a word (exact copies once) with an informative Dirichlet prior (the pooled
   counts, scaled to ``PRIOR`` words or, in a small sample, to ``PRIOR_SHARE`` of
   the smaller class);
   the log-odds ratio is drawn towards 0 by its own standard error, so words
   without evidence score 0.
2. Every text is a sequence of scores, each less a small ``DRIFT``.  All
   maximal scoring segments are found in one linear scan (a stack of candidate
   segments with their cumulative sums before and after).
3. Extreme-value calibration: the scale ``rate`` solves
   ``sum p(word) exp(rate * score) = 1`` over the words of non-toxic
   documents, and ``size`` is fitted so that the normalized best segment
   ``rate * S - ln(size * length)`` of non-toxic documents has the Gumbel mean.
   A segment's expected number by chance is ``exp(-normalized)``; those below
   ``E_VALUE`` are reported as passages.
4. The same with the classes exchanged: segments of words that speak for label
   0.  Without them, texts that label 1 marks by what they lack could not be
   told from the others.
5. Aggregation: a logistic curve over the normalized best segment and the sum
   of the significant ones, for label 1 and for label 0, fitted on the training
   documents, gives the score.

The classifier is fitted on at most ``TRAIN_ROWS`` labelled documents of each
class, those with the smallest hash of their id (the documented bound of the
sample); class weights restore the proportions of all labels.  Words rarer
than ``FLOOR`` in both samples, or in fewer than ``LEAST_DOCUMENTS``, are pooled
into one rare word, so the model has at most ``2 / FLOOR`` words; whole texts are
scored, and only the sample's texts of four numbers each come to the driver.

Edge cases: every text without a segment, null and empty ones too, gets the one
score of ``NO_SEGMENT``; very long texts are scanned once, in linear time; of
equally good segments the first is the best; null labels and null ids train
nothing; repeated labels of a document count once (the highest); without
labels of both classes, or if no word tells them apart, every score is 0;
repeated rows are scored each; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import Shared
from tillstar.llm.langid import letter_words

TRAIN_ROWS = 10_000
FLOOR = 1 / 200_000
LEAST_DOCUMENTS = 3
# The prior counts as so many words, but no more than this share of the smaller class's.
PRIOR, PRIOR_SHARE = 2_000.0, 0.05
# Normalized score of a text without a segment, and the least of any other.
NO_SEGMENT = -3.0
DRIFT = 0.25
E_VALUE = 0.05
FLUSH = 300_000


def maximal_segments(scores: np.ndarray) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (start, end exclusive, score).

    Only positive entries start a candidate; the cumulative sums carry the
    negative stretches between them.  ``back`` points to the nearest earlier
    candidate with a smaller sum before it, so the scan stays linear."""
    upto = np.concatenate(([0.0], np.cumsum(scores)))
    start: list[int] = []
    end: list[int] = []
    low: list[float] = []
    high: list[float] = []
    back: list[int] = []
    for i in np.flatnonzero(scores > 0).tolist():
        a, b, lo, hi = i, i + 1, float(upto[i]), float(upto[i + 1])
        while True:
            j = len(start) - 1
            while j >= 0 and low[j] >= lo:
                j = back[j]
            if j < 0 or high[j] >= hi:
                start.append(a), end.append(b), low.append(lo), high.append(hi), back.append(j)
                break
            a, lo = start[j], low[j]
            del start[j:], end[j:], low[j:], high[j:], back[j:]
    return [(a, b, hi - lo) for a, b, lo, hi in zip(start, end, low, high)]


@dataclass
class ToxicityModel:
    scores: dict          # word -> score less the drift
    other: float          # score of any other word less the drift
    rate: float = 1.0
    size: float = 1.0
    curve: tuple = (0.0, 0.0, 0.0)
    usable: bool = True
    against: ToxicityModel | None = None  # of the words that speak for label 0

    def sequence(self, text: str | None) -> np.ndarray:
        ws, get, other = letter_words(text), self.scores.get, self.other
        return np.fromiter((get(w, other) for w in ws), dtype=np.float64, count=len(ws))

    def passages(self, text: str | None) -> tuple[int, list]:
        """Number of words, and (start, end, score, normalized) by segment."""
        s = self.sequence(text)
        lift = np.log(self.size * max(len(s), 1))
        return len(s), [(a, b, v, self.rate * v - lift) for a, b, v in maximal_segments(s)]

    def features(self, text: str | None) -> tuple[float, float, list]:
        """Normalized best segment and sum of the significant ones, which does
        not depend on the length of a text without a segment."""
        found = self.passages(text)[1]
        best = max([NO_SEGMENT, *(float(x[3]) for x in found)])
        strong = [x for x in found if np.exp(-x[3]) <= E_VALUE]
        return best, float(np.log1p(sum(x[3] for x in strong))), strong

    def evidence(self, text: str | None) -> tuple[list, list]:
        """Features for label 1 and, if there is a model of it, for label 0; the
        significant segments of label 1."""
        *found, strong = self.features(text)
        return found + (list(self.against.features(text)[:2]) if self.against else []), strong

    def score(self, text: str | None) -> tuple[float, list]:
        if not self.usable:
            return 0.0, []
        found, strong = self.evidence(text)
        at = self.curve[0] + float(np.dot(self.curve[1:], found))
        return float(1 / (1 + np.exp(-np.clip(at, -30, 30)))), strong


def training_sample(labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[DataFrame, dict]:
    """(doc_id, toxic) of at most ``rows`` documents a class, and the number
    of all labelled documents by class."""
    each = (labels.filter(F.col("doc_id").isNotNull() & F.col("toxic").isNotNull())
                  .groupBy("doc_id").agg(F.max("toxic").alias("toxic")))
    totals = {r["toxic"]: r["count"] for r in each.groupBy("toxic").count().collect()}
    by_hash = [F.xxhash64("doc_id"), F.col("doc_id")]
    pick = [each.filter(F.col("toxic") == k).orderBy(*by_hash).limit(rows) for k in (0, 1)]
    return pick[0].unionByName(pick[1]), totals


def word_counts(docs: DataFrame) -> DataFrame:
    """word, n0, n1: the documents of each class that hold the word."""
    def partial(batches):
        def out(counter):
            keys = list(counter)
            return pa.RecordBatch.from_arrays(
                [pa.array([k for k, _ in keys], pa.int32()), pa.array([w for _, w in keys], pa.string()),
                 pa.array([counter[k] for k in keys], pa.int64())], ["toxic", "word", "times"])
        counter = Counter()
        for b in batches:
            for text, toxic in zip(b.column("text").to_pylist(), b.column("toxic").to_pylist()):
                for word in set(letter_words(text)):
                    counter[toxic, word] += 1
                if len(counter) > FLUSH:
                    yield out(counter)
                    counter.clear()
        yield out(counter)

    return (docs.select("text", F.col("toxic").cast("int").alias("toxic"))
                .mapInArrow(partial, "toxic int, word string, times bigint")
                .groupBy("word").agg(*[F.sum(F.when(F.col("toxic") == k, F.col("times")).otherwise(0)).alias(f"n{k}")
                                       for k in (0, 1)]))


def log_odds(n0: np.ndarray, n1: np.ndarray, t0: float, t1: float) -> np.ndarray:
    """Log-odds ratios with the pooled prior, less their standard error."""
    prior = min(PRIOR, PRIOR_SHARE * min(t0, t1))
    a = prior * (n0 + n1) / (t0 + t1)
    ratio = (np.log((n1 + a) / (t1 + prior - n1 - a)) - np.log((n0 + a) / (t0 + prior - n0 - a)))
    return np.sign(ratio) * np.maximum(np.abs(ratio) - np.sqrt(1 / (n1 + a) + 1 / (n0 + a)), 0)


def _rate(p: np.ndarray, s: np.ndarray) -> float:
    """The positive root of sum p exp(rate s) = 1, by bisection."""
    if not (s[p > 0] > 0).any():
        return 1.0
    f = lambda r: float((p * np.exp(np.clip(r * s, -50, 50))).sum()) - 1
    lo, hi = 1e-3, 1.0
    while f(hi) < 0 and hi < 1e3:
        hi *= 2
    for _ in range(80):
        mid = (lo + hi) / 2
        lo, hi = (mid, hi) if f(mid) < 0 else (lo, mid)
    return hi


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray) -> tuple:
    """Weighted logistic regression by Newton steps with a slight ridge."""
    z = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(z.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ beta, -30, 30)))
        h = (z * (w * p * (1 - p))[:, None]).T @ z + 1e-3 * np.eye(z.shape[1])
        step = np.linalg.solve(h, z.T @ (w * (y - p)) - 1e-3 * beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return tuple(beta.tolist())


def train(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS, floor: float = FLOOR) -> ToxicityModel:
    """Fit on labelled documents: ``labels`` (doc_id, toxic)."""
    spark = docs.sparkSession
    sample, totals = training_sample(labels, rows)
    if not totals.get(0) or not totals.get(1):
        return ToxicityModel({}, -DRIFT, usable=False)
    # 2 * rows ids and labels at most
    picked = F.broadcast(sample.withColumnRenamed("doc_id", "s_id"))
    texts = docs.select("doc_id", "text").join(picked, F.col("doc_id") == F.col("s_id")).select("text", "toxic")
    texts = texts.groupBy("text").agg(F.max("toxic").alias("toxic"))  # copies tell nothing new
    counts = word_counts(texts)
    sums = counts.agg(F.sum("n0").alias("t0"), F.sum("n1").alias("t1"))
    shares = counts.crossJoin(F.broadcast(sums))                      # one row
    named = ((F.col("n0") >= floor * F.col("t0")) | (F.col("n1") >= floor * F.col("t1"))) \
        & (F.col("n0") + F.col("n1") >= LEAST_DOCUMENTS)
    kept = (shares.groupBy(F.when(named, F.col("word")).alias("word"))
                  .agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1")).collect())
    n0 = np.array([r["n0"] for r in kept], dtype=float)
    n1 = np.array([r["n1"] for r in kept], dtype=float)
    t0, t1 = n0.sum(), n1.sum()
    if not t0 or not t1:
        return ToxicityModel({}, -DRIFT, usable=False)
    odds = log_odds(n0, n1, t0, t1)

    def side(s: np.ndarray, usual: np.ndarray) -> ToxicityModel:
        table = {r["word"]: float(x) for r, x in zip(kept, s) if r["word"] is not None}
        other = next((min(float(x), -DRIFT) for r, x in zip(kept, s) if r["word"] is None), -DRIFT)
        return ToxicityModel(table, other, rate=_rate(usual, s))

    model, against = side(odds - DRIFT, n0 / t0), side(-odds - DRIFT, n1 / t1)
    sides = [m for m in (model, against) if any(x > 0 for x in m.scores.values())]
    if not sides:                                                     # no word tells the classes apart
        return ToxicityModel({}, -DRIFT, usable=False)
    if against in sides:
        model.against = against

    # calibration on the sample, few numbers a document: first its best
    # segments, then, with the fitted sizes, the features of the curve
    def of_sample(features, names):
        def scan(batches):
            for b in batches:
                found = [features(t) for t in b.column("text").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("toxic").cast(pa.int32()), *(pa.array([x[k] for x in found], pa.float64()) for k in range(len(names)))],
                    ["toxic", *names])
        rows = texts.mapInArrow(scan, ", ".join(["toxic int", *(f"{c} double" for c in names)])).collect()
        return np.array([tuple(r) for r in rows], dtype=float).reshape(-1, 1 + len(names)).T

    models = [model] if model.against is None else [model, against]
    first = Shared(spark, model)

    def best_segments(text):
        out = []
        for m in [first.value] if first.value.against is None else [first.value, first.value.against]:
            n, found = m.passages(text)
            out.append(max((float(x[3]) for x in found), default=-float(np.log(max(n, 1)))))
        return out

    y, *best = of_sample(best_segments, [f"best{k}" for k in range(len(models))])
    if not (y == 0).any() or not (y == 1).any():
        return ToxicityModel({}, -DRIFT, usable=False)
    for k, m in enumerate(models):                                    # of the texts of the other label
        m.size = float(np.exp(best[k][y == k].mean() - np.euler_gamma))
    second = Shared(spark, model)
    y, *found = of_sample(lambda text: second.value.evidence(text)[0], [f"x{k}" for k in range(2 * len(models))])
    weight = np.where(y == 1, totals[1] / (y == 1).sum(), totals[0] / (y == 0).sum())
    model.curve = _logistic(np.column_stack(found), y, weight / weight.mean())
    return model


def score(docs: DataFrame, model: ToxicityModel) -> DataFrame:
    """doc_id, score and the significant passages (word positions, end
    exclusive) of the whole text of every row."""
    shared = Shared(docs.sparkSession, model)
    span = pa.struct([("start", pa.int32()), ("end", pa.int32()), ("score", pa.float64()), ("e_value", pa.float64())])

    def scan(batches):
        for b in batches:
            found = [shared.value.score(t) for t in b.column("text").to_pylist()]
            spans = [[{"start": a, "end": e, "score": v, "e_value": float(np.exp(-z))} for a, e, v, z in strong]
                     for _, strong in found]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x for x, _ in found], pa.float64()), pa.array(spans, pa.list_(span))],
                ["doc_id", "score", "passages"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(scan, f"doc_id {kind}, score double, "
                                 "passages array<struct<start:int,end:int,score:double,e_value:double>>")

"""Language identification by words first, backing off to character n-grams.

Training counts (language, word) over all training rows with Spark; the word
model keeps, per language, the words with a relative frequency of at least
``FLOOR``, and the n-gram models (n = 4..1 over padded words, weighted by the
words' counts) likewise.  Relative frequencies of a language sum to 1, so
every model has at most ``1 / FLOOR`` entries per language however large the
corpus is: that is the size bound of what is collected and broadcast.

A word known in any language scores the log frequency it has in each (the
floor's log less 1 where it is missing).  An unknown word takes the longest n
of which one n-gram is known and scores the mean over its known n-grams.  A
text scores the mean of its words; the best language wins, ties go to the
first by name.  ``score`` is the softmax over languages of that mean times
the number of words, at most ten.

Edge cases: null text and text without a letter give ``und`` with score 0;
letters that no model knows give the most frequent language with its share;
without training rows everything is ``und``; rows with null language or null
text train nothing; repeated rows count as often as they occur; other columns
are ignored, and doc_id passes through, null or not.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import Shared, scratch, shared_table

FLOOR = 1 / 50_000
LONGEST = 4
FLUSH = 300_000
# Scores of unknown words that a worker remembers.
MEMO = 3_200_000
LETTERS = re.compile(r"[^\W\d_]+")


def letter_words(text: str | None) -> list[str]:
    return LETTERS.findall(text.lower()) if text else []


def has_letter(ws: list[str]) -> bool:
    return any(any(map(str.isalpha, w)) for w in ws)


def _batch(counters: dict, names: list[str]) -> pa.RecordBatch:
    """The counters by group (language, or language and n) as one batch."""
    groups = [(g, c) for g, c in counters.items() if c]
    sizes = [len(c) for _, c in groups]
    cols = []
    for i, name in enumerate(names):
        kind = pa.int32() if name == "n" else pa.string()
        values = pa.array([g[i] for g, _ in groups], kind)
        cols.append(values.take(pa.array(np.repeat(np.arange(len(groups)), sizes))))
    cols.append(pa.array([k for _, c in groups for k in c], pa.string()))
    cols.append(pa.array([v for _, c in groups for v in c.values()], pa.int64()))
    return pa.RecordBatch.from_arrays(cols, [*names, "entry", "times"])


def count_words(docs: DataFrame) -> DataFrame:
    """lang, entry, times over the words of all rows of ``docs`` (text, lang)."""
    def partial(batches):
        counters = defaultdict(Counter)
        for b in batches:
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist()):
                counters[lang,].update(letter_words(text))
                if sum(map(len, counters.values())) > FLUSH:
                    yield _batch(counters, ["lang"])
                    counters.clear()
        yield _batch(counters, ["lang"])

    return (docs.filter(F.col("lang").isNotNull() & F.col("text").isNotNull()).select("text", "lang")
                .mapInArrow(partial, "lang string, entry string, times bigint")
                .groupBy("lang", "entry").agg(F.sum("times").alias("times")))


def count_grams(words: DataFrame, longest: int) -> DataFrame:
    """lang, n, entry, times: n-grams of the counted words."""
    def partial(batches):
        counters = defaultdict(lambda: defaultdict(int))
        for b in batches:
            for lang, word, times in zip(*(b.column(c).to_pylist() for c in ("lang", "entry", "times"))):
                padded = f" {word} "
                for n in range(1, longest + 1):
                    counter = counters[lang, n]
                    for i in range(len(padded) - n + 1):
                        counter[padded[i:i + n]] += times
            if sum(map(len, counters.values())) > FLUSH:
                yield _batch(counters, ["lang", "n"])
                counters.clear()
        yield _batch(counters, ["lang", "n"])

    return (words.mapInArrow(partial, "lang string, n int, entry string, times bigint")
                 .groupBy("lang", "n", "entry").agg(F.sum("times").alias("times")))


class _Rows(dict):
    """Word -> row of ``logs``; the rows of unknown words are made when first
    met (row 0: no model knows a piece of the word), MEMO scores at most."""

    def __init__(self, model: "LanguageModel"):
        super().__init__(model.levels[0])
        self.model, self.known, self.most = model, len(model.logs), max(MEMO // len(model.langs), 1000)
        self.logs = np.vstack([model.logs, np.zeros((self.most, len(model.langs)))])
        self.next, self.made = self.known, []

    def add(self, words: set[str]) -> None:
        """Makes the rows of the unknown ones among ``words``."""
        new = [w for w in words if w not in self]
        found = self.model.backoff(new)
        for w, v in zip(new, found):
            if v is None:
                self[w] = 0
            else:
                self.logs[self.next] = v
                self[w] = self.next
                self.next += 1
        self.made += new

    def make_room(self, words: int) -> None:
        """Forgets the unknown words if the next text could fill the memo."""
        if len(self.made) + words > self.most:
            for w in self.made:
                del self[w]
            self.next, self.made = self.known, []


@dataclass
class LanguageModel:
    langs: list[str]
    prior: list[float]
    #: level 0 holds words, level n the n-grams: entry -> row of ``logs``
    levels: list[dict]
    #: row 0 is empty
    logs: np.ndarray
    longest: int = LONGEST
    _rows: _Rows | None = field(default=None, repr=False)

    def backoff(self, words: list[str]) -> list:
        """For each word the mean over the known n-grams of the longest n that
        has any; None if no model knows a piece of it."""
        out, rest = [None] * len(words), list(range(len(words)))
        for n in range(self.longest, 0, -1):
            get, flat, held, left = self.levels[n].get, [], [], []
            for k in rest:
                padded = f" {words[k]} "
                rows = [r for i in range(len(padded) - n + 1) if (r := get(padded[i:i + n]))]
                if rows:
                    held.append((k, len(flat), len(rows)))
                    flat += rows
                else:
                    left.append(k)
            if held:
                sums = np.add.reduceat(self.logs[flat], [h[1] for h in held], axis=0)
                for (k, _, m), v in zip(held, sums):
                    out[k] = v / m
            rest = left
        return out

    def predict(self, text: str | None) -> tuple[str, float]:
        ws = letter_words(text)
        if not self.langs or not has_letter(ws):
            return "und", 0.0
        if self._rows is None:
            self._rows = _Rows(self)
        total, scored = np.zeros(len(self.langs)), 0
        step = self._rows.most // 2
        for at in range(0, len(ws), step):            # the whole text, in pieces that the memo holds
            part = ws[at:at + step]
            self._rows.make_room(len(part))
            self._rows.add(set(part))
            rows = np.fromiter(map(self._rows.__getitem__, part), np.int64, len(part))
            total += self._rows.logs[rows].sum(axis=0)
            scored += int(np.count_nonzero(rows))
        if not scored:
            best = int(np.argmax(self.prior))
            return self.langs[best], float(self.prior[best])
        mean = total / scored
        e = np.exp((mean - mean.max()) * min(scored, 10))
        best = int(np.argmax(mean))
        return self.langs[best], float(min(1.0, e[best] / e.sum()))


def train(docs: DataFrame, floor: float = FLOOR, longest: int = LONGEST) -> LanguageModel:
    """Fit on all rows of ``docs`` (text, lang)."""
    with scratch(docs.sparkSession):
        words = shared_table(count_words(docs), "langid-words")

        def frequent(counts, *group):
            # one row per language (and n)
            sums = counts.groupBy(*group).agg(F.sum("times").alias("total"))
            return counts.join(F.broadcast(sums), list(group)).withColumn("share", F.col("times") / F.col("total")) \
                         .filter(F.col("share") >= floor)

        totals = {r["lang"]: r["t"] for r in words.groupBy("lang").agg(F.sum("times").alias("t")).collect()}
        langs = sorted(totals)
        all_words = sum(totals.values()) or 1
        entries = [(0, r["entry"], r["lang"], r["share"])
                   for r in frequent(words, "lang").select("lang", "entry", "share").collect()]
        entries += [(r["n"], r["entry"], r["lang"], r["share"])
                    for r in frequent(count_grams(words, longest), "lang", "n").select("lang", "n", "entry", "share").collect()]
    levels: list[dict] = [{} for _ in range(longest + 1)]
    size = 1
    for level, key, _, _ in entries:
        if key not in levels[level]:
            levels[level][key] = size
            size += 1
    at = {lang: i for i, lang in enumerate(langs)}
    logs = np.full((size, len(langs)), np.log(floor) - 1)
    logs[0] = 0.0
    for level, key, lang, share in entries:
        logs[levels[level][key], at[lang]] = np.log(share)
    return LanguageModel(langs, [totals[x] / all_words for x in langs], levels, logs, longest)


def predict(docs: DataFrame, model: LanguageModel) -> DataFrame:
    """doc_id, lang_pred, score of the whole text of every row."""
    shared = Shared(docs.sparkSession, model)

    def score(batches):
        m = shared.value
        for b in batches:
            found = [m.predict(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array([x for x, _ in found], pa.string()),
                 pa.array([x for _, x in found], pa.float64())], ["doc_id", "lang_pred", "score"])

    rows = docs.select("doc_id", "text")
    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(score, f"doc_id {kind}, lang_pred string, score double")

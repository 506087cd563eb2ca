"""Benchmark decontamination with SimHash windows.

Texts become lower-cased words of letters and digits and sequences of hashed
5-word shingles (an item of fewer words is one shingle of that width).  For
every item, windows of the item's own size slide over a document wherever the
document holds one of the item's shingles (any other window has similarity 0).
Each window gets a 64-bit SimHash, from running sums of its shingles' votes.
A multi-index over the items' fingerprints cuts the 64 bits into
``RADIUS + 1`` blocks: two fingerprints within ``RADIUS`` bits agree in one
block at least, so looking the blocks up finds every item within the radius.
Candidates within the radius are verified by exact weighted similarity:
shingles weigh as often as they occur, ``sum of minima / sum of maxima``, 0.75
or more.  At similarity 0.75 a bit differs with probability 0.17, 11 of 64 on
average with deviation 3, so radius 20 loses fewer than 2 in 1,000 such
windows and none that repeat the item word for word.

The benchmark is a query set: it is taken in parts of about ``PART_WORDS``
words, each broadcast (that is the size bound) and run against all documents.
Documents are neither shuffled nor collected.

Edge cases: null or empty texts and items match nothing; a document shorter
than an item is one window; repeated rows are each reported; an empty
benchmark or table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import defaultdict
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import Shared, WordHasher, mix64, shingle_sequence

WIDTH = 5
RADIUS = 20
LEAST = 0.75
PART_WORDS = 1_000_000
ALNUM = re.compile(r"[^\W_]+")


def plain_words(text: str | None) -> list[bytes]:
    return [w.encode() for w in ALNUM.findall(text.lower())] if text else []


def simhashes(shingles: np.ndarray, size: int, starts: np.ndarray) -> np.ndarray:
    """SimHash of the window of ``size`` shingles at each start: bit i is set
    if more of its shingles have bit i than have not."""
    lo, hi = int(starts.min()), int(starts.max()) + size
    with np.errstate(over="ignore"):
        votes = np.unpackbits(mix64(shingles[lo:hi] + np.uint64(77)).view(np.uint8).reshape(-1, 8), axis=1).astype(np.int32)
    upto = np.concatenate((np.zeros((1, 64), np.int32), np.cumsum(2 * votes - 1, axis=0)))
    won = (upto[starts - lo + size] - upto[starts - lo]) > 0
    return np.packbits(won, axis=1).view(np.uint64).ravel()


def weighted_similarity(a: np.ndarray, b: np.ndarray) -> float:
    """Sum of minima over sum of maxima of the shingles' counts."""
    x, n = np.unique(a, return_counts=True)
    y, m = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    least = int(np.minimum(n[i], m[j]).sum())
    return least / (len(a) + len(b) - least)


def bit_blocks(radius: int) -> list[tuple[int, int]]:
    """(shift, mask) of the radius + 1 blocks of 64 bits."""
    ends = [round(64 * k / (radius + 1)) for k in range(radius + 2)]
    return [(a, (1 << (b - a)) - 1) for a, b in zip(ends, ends[1:])]


@dataclass
class BenchmarkIndex:
    radius: int = RADIUS
    items: list = field(default_factory=list)       # (item id, width, shingles)
    prints: list = field(default_factory=list)      # fingerprint of each
    blocks: dict = field(default_factory=dict)      # (width, size, block, value) -> item numbers
    holders: dict = field(default_factory=dict)     # width -> shingle -> item numbers
    known: dict = field(default_factory=dict)       # width -> sorted shingles

    def add(self, rows) -> "BenchmarkIndex":
        hasher, holders = WordHasher(), defaultdict(lambda: defaultdict(list))
        for item_id, text in rows:
            ws = plain_words(text)
            if not ws:
                continue
            width, k = min(WIDTH, len(ws)), len(self.items)
            s = shingle_sequence(hasher(ws), WIDTH)
            self.items.append((item_id, width, s))
            f = int(simhashes(s, len(s), np.zeros(1, np.int64))[0])
            self.prints.append(f)
            for b, (shift, mask) in enumerate(bit_blocks(self.radius)):
                self.blocks.setdefault((width, len(s), b, f >> shift & mask), []).append(k)
            for x in set(s.tolist()):
                holders[width][x].append(k)
        self.holders = {w: dict(h) for w, h in holders.items()}
        self.known = {w: np.array(sorted(h), dtype=np.uint64) for w, h in holders.items()}
        return self

    def leaks(self, ws: list[bytes], hasher: WordHasher) -> list[tuple]:
        """(item id, first word, words, distance, similarity): the best window
        for every item that one matches."""
        hashes, best = hasher(ws), {}
        for width, known in self.known.items():
            if len(ws) < width:
                continue
            s = shingle_sequence(hashes, width)
            spot = np.flatnonzero(known[np.minimum(np.searchsorted(known, s), len(known) - 1)] == s)
            if not len(spot):
                continue
            touched = defaultdict(list)
            for p in spot.tolist():
                for k in self.holders[width][int(s[p])]:
                    touched[len(self.items[k][2])].append(p)
            for size, places in touched.items():
                self._search(s, width, size, np.unique(places), best)
        return [(self.items[k][0], *found) for k, found in sorted(best.items())]

    def _search(self, s, width, size, places, best) -> None:
        """Windows of ``size`` shingles over ``places`` against all items of that size."""
        w = min(size, len(s))
        starts = np.unique((places[:, None] - np.arange(w)[None, :]).ravel())
        starts = starts[(starts >= 0) & (starts <= len(s) - w)]
        prints = simhashes(s, w, starts)
        near = set()
        for b, (shift, mask) in enumerate(bit_blocks(self.radius)):
            for v in np.unique(prints >> np.uint64(shift) & np.uint64(mask)).tolist():
                near.update(self.blocks.get((width, size, b, v), ()))
        for k in near:
            apart = np.bitwise_count(prints ^ np.uint64(self.prints[k]))
            close = np.flatnonzero(apart <= self.radius)
            for i in close[np.argsort(apart[close], kind="stable")].tolist():
                at = int(starts[i])
                similar = weighted_similarity(s[at:at + w], self.items[k][2])
                if similar >= LEAST and (k not in best or similar > best[k][3]):
                    best[k] = (at, w + width - 1, int(apart[i]), similar)


def benchmark_parts(benchmark: DataFrame, words: int = PART_WORDS):
    """The benchmark's index, part by part."""
    rows = benchmark.select("item_id", "text").filter(F.col("text").isNotNull())
    total = rows.agg(F.sum(F.length("text"))).first()[0] or 0
    parts = max(1, -(-total // (6 * words)))
    for k in range(parts):
        part = rows if parts == 1 else rows.filter(F.pmod(F.xxhash64("item_id", "text"), F.lit(parts)) == k)
        yield BenchmarkIndex().add((r["item_id"], r["text"]) for r in part.orderBy("item_id", "text").collect())


def find_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, start_word, n_words, distance, similarity: the best
    window of every document for every item that it repeats."""
    rows = docs.select("doc_id", "text")
    kinds = [rows.schema["doc_id"].dataType.simpleString(), benchmark.schema["item_id"].dataType.simpleString()]
    names = ["doc_id", "item_id", "start_word", "n_words", "distance", "similarity"]
    schema = f"doc_id {kinds[0]}, item_id {kinds[1]}, start_word int, n_words int, distance int, similarity double"

    def scanner(shared):
        def scan(batches):
            hasher = WordHasher()
            for b in batches:
                found = [(i, *x) for i, t in enumerate(b.column("text").to_pylist())
                         for x in shared.value.leaks(plain_words(t), hasher)]
                cols = list(zip(*found)) or [()] * 6
                types = [pa.int32(), pa.int32(), pa.int32(), pa.float64()]
                yield pa.RecordBatch.from_arrays(
                    [b.column("doc_id").take(pa.array(cols[0], pa.int64())), pa.array(cols[1])
                     if found else pa.array([], pa.int64())] + [pa.array(c, t) for c, t in zip(cols[2:], types)], names)
        return scan

    found = None
    for index in benchmark_parts(benchmark):
        part = rows.mapInArrow(scanner(Shared(docs.sparkSession, index)), schema)
        found = part if found is None else found.unionByName(part)
    return found


def without_leaks(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns, that repeat no item."""
    def keeper(shared, at):
        def keep(batches):
            hasher = WordHasher()
            for b in batches:
                yield b.filter(pa.array([not shared.value.leaks(plain_words(t), hasher)
                                         for t in b.column(at).to_pylist()], pa.bool_()))
        return keep

    at = docs.columns.index("text")
    for index in benchmark_parts(benchmark):
        docs = docs.mapInArrow(keeper(Shared(docs.sparkSession, index), at), docs.schema)
    return docs

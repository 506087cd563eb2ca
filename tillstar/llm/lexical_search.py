"""Ranked lexical search, term at a time with a limited set of accumulators.

1. Every document becomes one row: its number of terms and its postings, the
   numbers and counts of those terms that some item holds.  The rows are
   written once; all further steps read them, not the texts.
2. Documents with terms, all their terms and the document frequency of every
   query term are counted over the whole table; they fix the weights.
3. Blocks of documents (one Arrow batch each) are searched on their own.  Per
   item, terms come rarest first.  A term creates an accumulator for each new
   document that holds it, until the sum of the largest contributions of the
   remaining terms is below the k-th partial score (or below the k-th score of
   the task's blocks so far): no new document can reach the list any more.
   From there on the survivors alone are updated, with their exact scores.
4. A task keeps the k best documents per item; the lists of all tasks meet in
   one window per item, at most ``k`` rows a task, so a document block never
   travels.

The items are a stated query set: they are searched against all documents in
blocks of at most ``BLOCK_PAIRS`` (item, term) pairs, which bounds the
broadcast.

Edge cases: null texts and texts without a term hold nothing and count
nowhere; very long texts are scanned whole; repeated rows of a document are
documents of their own; equal scores are ordered by ascending id, null last;
the rows of one item id are one item, their terms united; items without terms,
or whose terms no document holds, have no rows; empty tables give no rows;
ids keep their type; other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tillstar.llm.common import Shared, scratch, shared_table

TOP = 50
BLOCK_PAIRS = 1_000_000
TERM = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
#: Bytes of a text: A-Z lowered, other ASCII characters that are not letters or
#: digits to spaces, the bytes of all further characters as they are.
TERM_BYTES = bytes(b if b >= 0x80 or chr(b).isalnum() else 0x20 for b in range(256)).lower()
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def terms(text: Column) -> Column:
    """Array of the text's terms, with repeats."""
    return F.regexp_extract_all(F.translate(F.coalesce(text, F.lit("")), UPPER, LOWER), F.lit(TERM), F.lit(0))


def weight(n_docs: int, df: int) -> int:
    return math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df + 1)))


def lengths(n: np.ndarray, n_docs: int, n_terms: int) -> np.ndarray:
    """The length norm m of documents of ``n`` terms, in whole numbers."""
    if len(n) and 50 * int(n.max()) * n_docs >= 1 << 62:
        return np.array([50 + 50 * int(x) * n_docs // n_terms for x in n], np.int64)
    return 50 + (50 * n * n_docs) // n_terms


class Postings:
    """Postings of a block of documents, by term."""

    def __init__(self, n, ends, term, tf, weights: np.ndarray, n_docs: int, n_terms: int):
        m = lengths(n, n_docs, n_terms)
        doc = np.repeat(np.arange(len(n)), np.diff(ends))
        score = weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 20 * m[doc]))
        order = np.argsort(term, kind="stable")
        self.size, self.doc, self.score = len(n), doc[order], score[order]
        held, first = np.unique(term[order], return_index=True)
        most = np.maximum.reduceat(self.score, first) if len(first) else first
        self.of = {t: (a, b, c) for t, a, b, c in zip(
            held.tolist(), first.tolist(), [*first[1:].tolist(), len(term)], most.tolist())}

    def search(self, rarest_first: list[int], k: int, floor: int) -> tuple[np.ndarray, np.ndarray]:
        """Documents that can be among the ``k`` best, with their exact scores.
        A document below ``floor`` is of no use to the caller."""
        lists = [self.of[t] for t in rarest_first if t in self.of]
        rest = sum(most for _, _, most in lists)
        acc = np.zeros(self.size, np.int64)
        alive = np.zeros(self.size, bool)
        creating = rest >= floor
        if not creating:
            return np.flatnonzero(alive), acc[:0]
        for first, end, most in lists:
            doc, score = self.doc[first:end], self.score[first:end]
            if creating:
                alive[doc] = True
                acc[doc] += score
            else:
                kept = alive[doc]
                acc[doc[kept]] += score[kept]
            rest -= most
            if creating:
                held = acc[alive]
                if len(held) >= k:
                    floor = max(floor, int(np.partition(held, len(held) - k)[len(held) - k]))
                creating = rest >= floor
        found = np.flatnonzero(alive & (acc > 0))
        return found, acc[found]


def best(ids: list, scores: np.ndarray, k: int) -> list[tuple[int, int]]:
    """(place, score) of the k highest scores, equal ones by ascending id, null last."""
    if len(scores) > k:
        bar = np.partition(scores, len(scores) - k)[len(scores) - k]
        places = np.flatnonzero(scores >= bar).tolist()
    else:
        places = range(len(scores))
    ranked = sorted(((-int(scores[i]), ids[i] is None, ids[i], i) for i in places), key=lambda x: x[:2] + x[2:3] * (not x[1]))
    return [(i, -s) for s, _, _, i in ranked[:k]]


def _postings(docs: DataFrame, vocabulary: dict[bytes, int]) -> DataFrame:
    """doc_id, n, terms, tfs of every document with a term."""
    shared = Shared(docs.sparkSession, vocabulary)

    def scan(batches):
        number = shared.value.get
        for b in batches:
            rows, n, term, tf, ends = [], [], [], [], [0]
            for i, text in enumerate(b.column("text").cast(pa.binary()).to_pylist()):
                words = text.translate(TERM_BYTES).split() if text else ()
                if words:
                    held = Counter(map(number, words))
                    held.pop(None, None)
                    rows.append(i)
                    n.append(len(words))
                    term.extend(held.keys())
                    tf.extend(held.values())
                    ends.append(len(term))
            at = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(pa.array(rows, pa.int64())), pa.array(n, pa.int64()),
                 pa.ListArray.from_arrays(at, pa.array(term, pa.int32())),
                 pa.ListArray.from_arrays(at, pa.array(tf, pa.int64()))], ["doc_id", "n", "terms", "tfs"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(scan, f"doc_id {kind}, n bigint, terms array<int>, tfs array<bigint>")


class Searcher:
    """Items of one block, and what the whole table says of their terms."""

    def __init__(self, items: list[tuple[object, list[int]]], df: dict[int, int], n_docs: int, n_terms: int, size: int, k: int):
        self.items = [(item, sorted(ts, key=lambda t: (df.get(t, 0), t))) for item, ts in items]
        self.weights = np.array([weight(n_docs, df.get(t, 0)) for t in range(size)], np.int64)
        self.n_docs, self.n_terms, self.k = n_docs, n_terms, k

    def block(self, batch, found: list[list[tuple]]) -> None:
        """Merges the best documents of one block into the lists ``found``."""
        n, at = batch.column("n").to_numpy(zero_copy_only=False), batch.column("terms")
        block = Postings(n, at.offsets.to_numpy() - at.offsets[0].as_py(), at.flatten().to_numpy(),
                         batch.column("tfs").flatten().to_numpy(), self.weights, self.n_docs, self.n_terms)
        ids = batch.column("doc_id")
        for k, (_, rarest_first) in enumerate(self.items):
            floor = found[k][-1][1] if len(found[k]) == self.k else 1
            places, scores = block.search(rarest_first, self.k, floor)
            if len(places):
                useful = scores >= floor
                places, scores = places[useful], scores[useful]
                own = ids.take(pa.array(places)).to_pylist()
                both = found[k] + [(own[i], s) for i, s in best(own, scores, self.k)]
                pick = best([x[0] for x in both], np.array([x[1] for x in both], np.int64), self.k)
                found[k] = [both[i] for i, _ in pick]


def _search(table: DataFrame, searcher: Searcher, item_type) -> DataFrame:
    """item_id, doc_id, score: the k best documents of every task."""
    shared = Shared(table.sparkSession, searcher)
    item_kind, item_arrow = item_type.simpleString(), to_arrow_type(item_type)

    def scan(batches):
        search, ids = shared.value, None
        found = [[] for _ in search.items]
        for b in batches:
            ids = b.schema.field("doc_id").type
            search.block(b, found)
        if ids is not None:
            rows = [(item, *x) for (item, _), of in zip(search.items, found) for x in of]
            yield pa.RecordBatch.from_arrays(
                [pa.array([r[c] for r in rows], t) for c, t in enumerate((item_arrow, ids, pa.int64()))],
                ["item_id", "doc_id", "score"])

    kind = table.schema["doc_id"].dataType.simpleString()
    return table.mapInArrow(scan, f"item_id {item_kind}, doc_id {kind}, score bigint")


def item_blocks(items: DataFrame, most: int = BLOCK_PAIRS):
    """Lists of (item_id, terms), block by block."""
    pairs = items.select("item_id", F.explode(terms(F.col("text"))).alias("term")).distinct()
    parts = max(1, -(-pairs.count() // most))
    for part in range(parts):
        rows = pairs if parts == 1 else pairs.filter(F.pmod(F.xxhash64("item_id"), F.lit(parts)) == part)
        of: dict = {}
        for r in rows.collect():
            of.setdefault(r["item_id"], []).append(r["term"].encode())
        yield sorted(of.items(), key=lambda x: (x[0] is None, str(x[0])))


def search(docs: DataFrame, items: DataFrame, k: int = TOP, block_pairs: int = BLOCK_PAIRS) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` best documents of every item."""
    spark = docs.sparkSession
    item_type = items.schema["item_id"].dataType
    with scratch(spark):
        found, totals = None, None
        for block in item_blocks(items, block_pairs):
            vocabulary = {t: i for i, t in enumerate(sorted({t for _, ts in block for t in ts}))}
            table = shared_table(_postings(docs, vocabulary), "postings")
            totals = totals or table.agg(F.count("*").alias("docs"), F.sum("n").alias("terms")).first()
            df = {r["term"]: r["df"] for r in table.select(F.explode("terms").alias("term")).groupBy("term").agg(
                F.count("*").alias("df")).collect()}
            searcher = Searcher([(item, [vocabulary[t] for t in ts]) for item, ts in block], df, totals["docs"],
                                totals["terms"] or 0, len(vocabulary), k)
            part = _search(table, searcher, item_type)
            found = part if found is None else found.unionByName(part)
        order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
        return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k).select(
            "item_id", "rank", "doc_id", "score").checkpoint()

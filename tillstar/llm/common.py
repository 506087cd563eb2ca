"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstar.session import ensure_checkpoint_dir

# Word separators: space and the control characters tab .. carriage return.
SEPARATORS = "[\\x20\\x09-\\x0D]+"
WORD = "[^\\x20\\x09-\\x0D]+"


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh path in the folder that the session names in spark.checkpoint.dir."""
    return f"{ensure_checkpoint_dir(spark)}/llm-{name}-{uuid.uuid4().hex[:12]}"


_SCRATCH: list[list[str]] = []


@contextmanager
def scratch(spark: SparkSession):
    """Tables that ``shared_table`` writes inside are deleted at the end, but
    for those with ``keep``.  What leaves the block must not depend on them."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        conf = spark.sparkContext._jsc.hadoopConfiguration()
        for path in _SCRATCH.pop():
            place = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
            place.getFileSystem(conf).delete(place, True)


def shared_table(df: DataFrame, name: str, compression: str = "zstd", keep: bool = False) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: later jobs start from
    the files, also after executors are lost."""
    spark = df.sparkSession
    path = shared_path(spark, name)
    if _SCRATCH and not keep:
        _SCRATCH[-1].append(path)
    schema = df.schema
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(schema).parquet(path)


def words(text: Column) -> Column:
    """Array of words (runs of non-separators); null text has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SEPARATORS), "")


def word_count(text: Column) -> Column:
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("bigint")


def random_key(seed: str, *cols: Column) -> Column:
    """60 pseudo-random bits of the columns' values, the same in every run."""
    text = F.concat_ws(":", F.lit(seed), *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return F.conv(F.substring(F.md5(text), 1, 15), 16, 10).cast("bigint")


def key_range(key: Column, ranges: Column) -> Column:
    """Number of the equal-width range that a 60-bit random key falls into.

    The keys are uniform, so equal widths give ranges of near equal counts
    without sampling, and a rerun cuts at the same places."""
    return F.least(F.floor(key / F.lit(float(1 << 60)) * ranges), ranges - 1).cast("bigint")


class Shared:
    """A broadcast object that executors need no library to read: it travels
    as bytes that carry its class, and every worker unpacks it once."""

    def __init__(self, spark: SparkSession, value):
        self._bytes = spark.sparkContext.broadcast(cloudpickle.dumps(value))
        self._value = None

    def __getstate__(self):
        return {"_bytes": self._bytes, "_value": None}

    @property
    def value(self):
        if self._value is None:
            import pickle
            self._value = pickle.loads(self._bytes.value)
        return self._value


BROADCAST_BYTES = 16 << 20


def small_side(table: DataFrame, most: int = BROADCAST_BYTES) -> DataFrame:
    """A written table of fixed-width columns as one side of a join: broadcast
    if its counted rows stay below ``most`` bytes, else shuffled."""
    return F.broadcast(table) if table.count() * 8 * len(table.columns) <= most else table


class _Memo(dict):
    def __missing__(self, word: bytes) -> int:
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


class WordHasher:
    """64-bit hashes of words, with a bounded memo per worker."""

    def __init__(self, limit: int = 400_000):
        self.memo, self.limit = _Memo(), limit

    def __call__(self, ws: list[bytes]) -> np.ndarray:
        if len(self.memo) > self.limit:
            self.memo.clear()
        return np.fromiter(map(self.memo.__getitem__, ws), np.uint64, len(ws))


def ascii_words(text: str | None) -> list[bytes]:
    """Words of the text with A-Z lowered.  ``bytes.split`` separates at
    exactly the characters of SEPARATORS."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def word_hashes(texts: pa.Array, most: int = 8 << 20):
    """Per text ``WordHasher()(ascii_words(text))``: Arrow splits the words of
    ``most`` bytes of texts at a time, and every different one is hashed once."""
    sizes = np.cumsum(pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False))
    at = 0
    while at < len(texts):
        done = sizes[at - 1] if at else 0
        rows = max(int(np.searchsorted(sizes, done + most, side="right")) - at, 1)
        ws = pc.ascii_split_whitespace(pc.ascii_lower(texts.slice(at, rows)))
        ends = np.cumsum(pc.fill_null(pc.list_value_length(ws), 0).to_numpy(zero_copy_only=False))
        codes = ws.flatten().dictionary_encode()
        words = codes.dictionary.cast(pa.large_binary()).to_numpy(zero_copy_only=False)
        hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
        codes = codes.indices.to_numpy()
        hashes = hashes[codes]
        empty = np.flatnonzero(words == b"")
        if len(empty):  # before and after outer separators
            word = codes != empty[0]
            ends = np.concatenate(([0], np.cumsum(word)))[ends]
            hashes = hashes[word]
        for i, j in zip([0, *ends[:-1].tolist()], ends.tolist()):
            yield hashes[i:j]
        at += rows


_M1, _M2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9)
_S29, _S32 = np.uint64(29), np.uint64(32)


def mix64(x: np.ndarray) -> np.ndarray:
    """Bijective mixing of 64-bit values."""
    x = (x ^ (x >> _S32)) * _M2
    x = (x ^ (x >> _S29)) * _M1
    return x ^ (x >> _S32)


def shingle_sequence(hashes: np.ndarray, width: int = 5) -> np.ndarray:
    """Hash of every run of ``width`` words; fewer words form one shingle."""
    n = len(hashes)
    if n == 0:
        return hashes
    w = min(width, n)
    with np.errstate(over="ignore"):
        out = hashes[:n - w + 1] + np.uint64(w)
        for k in range(1, w):
            out = mix64(out * _M1 + hashes[k:n - w + 1 + k])
        return mix64(out)

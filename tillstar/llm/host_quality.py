"""Quality rules at host level: rule failures are counted per host, the
failure rates are shrunk with an empirical beta prior, and the host verdicts
are joined back to the documents.

A document's own counts come from its whole text with built-in expressions
(arrays inside the row, no exploded words, no Python).  The counts table is
narrow; it is written once and read for the host sums and for the join.

Rules (integer arithmetic, so that any engine agrees):

=============  =========================================================
base           fewer than 10 words, or more than 20 % repeated words
symbols        more than 1 symbol in 10 words
lines          more than 30 % of the lines with words repeat an earlier one
word length    mean word length below 2 or above 12 characters
=============  =========================================================

``severe`` is 3 symbols or more in 10 words, or at least 60 % repeated
lines.  A host's failure count is the number of its documents that
break any rule.  With the beta prior of all hosts (method of moments), its
rate becomes ``(failures + a) / (documents + a + b)``; a host is flagged at
``HOST_RATE`` or more.  Verdict on a document: kept if it breaks no rule, or
if it breaks only the milder rules (neither base nor severe) and its host is
not flagged.  So a good host's odd page stays, a bad host's goes, and a clean
document stays wherever it comes from.

Edge cases: null or empty text has no words and fails the base rule; a null
source is a host of its own; repeated rows count as often as they occur; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import SEPARATORS, shared_table, words

HOST_RATE = 0.25
WINDOW = 5


def document_counts(docs: DataFrame, host: str = "source", keep: tuple = ()) -> DataFrame:
    """One row per document: doc_id, host, the columns named in ``keep`` and
    the counts the rules need."""
    d = docs.select(F.col("doc_id"), F.col(host).alias("host"), *keep,
                    F.coalesce(F.col("text"), F.lit("")).alias("t"))
    d = d.select("doc_id", "host", *keep, "t", words(F.col("t")).alias("w"),
                 F.filter(F.split("t", "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]")).alias("ln"))
    n = F.size("w")
    window_hash = F.transform(
        F.slice("w", 1, F.greatest(n - (WINDOW - 1), F.lit(0))),
        lambda x, i: F.xxhash64(x, *[F.get("w", i + k) for k in range(1, WINDOW)]))
    d = d.select(
        "doc_id", "host", *keep, n.cast("bigint").alias("n_words"),
        F.length(F.regexp_replace("t", SEPARATORS, "")).cast("bigint").alias("word_chars"),
        F.regexp_count("t", F.lit("[#*$%&|<>]")).cast("bigint").alias("n_symbols"),
        F.size("ln").cast("bigint").alias("n_lines"),
        (F.size("ln") - F.size(F.array_distinct("ln"))).cast("bigint").alias("n_dup_lines"),
        window_hash.alias("h"))
    # Only a text with a repeated window sorts its windows: equal ones become
    # neighbours, and their positions give the words they cover.
    none = F.array().cast("array<struct<h:bigint,p:int>>")
    counts = ["doc_id", "host", *keep, "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    d = d.select(*counts, F.when(
        F.size(F.array_distinct("h")) < F.size("h"),
        F.array_sort(F.transform("h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    ).otherwise(none).alias("s"))
    d = d.select(*counts, F.array_sort(F.transform(
        F.filter("s", lambda x, i: (x["h"] == F.get("s", i - 1)["h"]) | (x["h"] == F.get("s", i + 1)["h"])),
        lambda x: x["p"])).alias("p"))
    covered = F.transform("p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW))))
    return d.select(*counts, F.aggregate(covered, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("n_repeat_words"))


def apply_rules(counts: DataFrame) -> DataFrame:
    base = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    symbols = 10 * F.col("n_symbols") > F.col("n_words")
    lines = 100 * F.col("n_dup_lines") > 30 * F.col("n_lines")
    length = (F.col("word_chars") < 2 * F.col("n_words")) | (F.col("word_chars") > 12 * F.col("n_words"))
    severe = (10 * F.col("n_symbols") >= 3 * F.col("n_words")) | \
             ((F.col("n_dup_lines") > 0) & (100 * F.col("n_dup_lines") >= 60 * F.col("n_lines")))
    return (counts.withColumn("base_failed", base)
                  .withColumn("severe", severe)
                  .withColumn("any_failed", base | symbols | lines | length))


def host_verdicts(ruled: DataFrame, host_rate: float = HOST_RATE) -> DataFrame:
    """host, n_docs, n_failed, host_rate (shrunk), host_flagged.

    The prior is the beta distribution whose mean is the pooled rate and whose
    intra-host correlation is the weighted moment estimate; without
    detectable spread between hosts it is taken very strong."""
    hosts = ruled.groupBy("host").agg(F.count(F.lit(1)).alias("n_docs"),
                                      F.sum(F.col("any_failed").cast("bigint")).alias("n_failed"))
    n, f = F.col("n_docs").cast("double"), F.col("n_failed").cast("double")
    sums = hosts.agg(F.count(F.lit(1)).alias("k"), F.sum("n_docs").alias("nn"), F.sum("n_failed").alias("ff"),
                     F.sum(n * n).alias("n2"), F.sum(f * f / n).alias("f2n"))
    p = F.col("ff") / F.col("nn")
    between = F.col("f2n") - F.col("ff") * p                        # sum n (rate - p)^2
    noise = (F.col("k") - 1) * p * (1 - p)
    room = (F.col("nn") - F.col("n2") / F.col("nn") - (F.col("k") - 1)) * p * (1 - p)
    rho = F.when(room > 0, (between - noise) / room)
    rho = F.least(F.greatest(F.coalesce(rho, F.lit(1e-4)), F.lit(1e-4)), F.lit(0.999))
    prior = sums.select(p.alias("p"), ((1 - rho) / rho).alias("strength"))
    a, b = F.col("p") * F.col("strength"), (1 - F.col("p")) * F.col("strength")
    rate = F.round((f + a) / (n + a + b), 9)
    return (hosts.crossJoin(F.broadcast(prior))                     # one row
                 .select("host", "n_docs", "n_failed", rate.alias("host_rate"),
                         (rate >= host_rate).alias("host_flagged")))


def host_quality(docs: DataFrame, host: str = "source", host_rate: float = HOST_RATE) -> DataFrame:
    """Counts, rule results and verdict (``kept``) for every document."""
    counts = shared_table(document_counts(docs, host), "quality-counts")
    ruled = apply_rules(counts)
    hosts = host_verdicts(ruled, host_rate).withColumnRenamed("host", "h_host")
    kept = ~F.col("base_failed") & ~F.col("severe") & (~F.col("any_failed") | ~F.col("host_flagged"))
    return (ruled.join(hosts, F.col("host").eqNullSafe(F.col("h_host")))
                 .select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                         "base_failed", kept.alias("kept"), "host", "host_rate", "host_flagged"))


def kept_rows(docs: DataFrame, host: str = "source", host_rate: float = HOST_RATE) -> DataFrame:
    """The rows of ``docs``, all columns, that the verdict keeps.  Rows are
    judged as they stand: their counts are taken again as they pass, so that
    neither texts are stored nor anything is joined by id."""
    columns = docs.columns
    hosts = shared_table(host_verdicts(apply_rules(document_counts(docs, host)), host_rate)
                         .select(F.col("host").alias("h_host"), "host_flagged"), "quality-hosts")
    row = F.struct(*[docs[c] for c in columns]).alias("_quality_row")
    counts = document_counts(docs.select("doc_id", "text", docs[host], row), host, ("_quality_row",))
    # generated rows: the filter below must not move into the counting, where
    # it would repeat the counts' expressions inside each other
    each = F.explode(F.array(F.struct(*[c for c in counts.columns if c != "_quality_row"]))).alias("k")
    ruled = apply_rules(counts.select("_quality_row", each).select("_quality_row", "k.*"))
    kept = ~F.col("base_failed") & ~F.col("severe") & (~F.col("any_failed") | ~F.col("host_flagged"))
    return (ruled.join(hosts, F.col("host").eqNullSafe(F.col("h_host"))).filter(kept)
                 .select(*[F.col("_quality_row").getField(c).alias(c) for c in columns]))

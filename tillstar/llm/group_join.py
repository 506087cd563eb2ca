"""N-gram Jaccard self-join with a token-group matrix, exact at the threshold.

Documents are sets of hashed word 5-grams.  Equal sets form a class (its key
is a 64-bit hash of the set), and all further work is on classes:

1. Prefix: of two sets with Jaccard similarity t or more, the first
   ``n - ceil(t n) + 1 + e`` tokens of each, in any one order of tokens, share
   at least 1 + e tokens (e is a twelfth of the smaller set).  Prefix tokens
   held by one class only are dropped; classes left with too few are done, the
   others are active, and only their whole sets are kept.
2. Groups of similar sets: every active class is compared with the pivot (most
   copies) of the classes that share its rarest, first or last bridging token.
   Classes linked over a pivot make a group, cut into blocks of ``BLOCK`` members.
3. Token-group matrix: (token, block) for the union of the members' prefix
   tokens, with the members' size range.  A class queries the blocks of other
   groups that hold one of its prefix tokens; the number of shared tokens
   bounds what any member can have in common with it.  Only blocks that reach
   the bound are opened, and their members are compared exactly.
4. Tokens held by more than ``COMMON`` groups (a shared line or passage) are
   not paired in that round.  Among their holders all tokens are counted, the
   common ones put last in the order, and step 3 runs once more on the new
   prefixes, whose tokens few groups hold.
5. A set that consists of common tokens for so large a part that its prefix
   must hold some is saturated.  Two saturated sets that share no other token
   meet in a matrix of their own, over whole prefixes and blocks of saturated
   sets of one first common token and similar size, under the same bound.

Links are never lost: two linked sets share enough prefix tokens to meet in
step 3, or share common tokens there and so are both holders; in step 4 they
share an uncommon prefix token, or are both saturated.  Pairs within a group
need no link of their own.

A token that a large part of all classes holds (more than one in ``HOT_SHARE``,
told from a sample of the classes) is split over many tasks wherever its
holders are counted; joins on tokens are joins that Spark can split.

Edge cases: null text and text without words have the empty set and link with
nothing (component: own id); fewer than five words are one shingle; equal
texts are one class; every row has the component of its own text, so the rows
of a repeated id differ in it if their texts do; rows with a null id keep a
null component and link nothing; very long texts are sets like any other (a
task holds one block and ``SLICE_TOKENS`` tokens of queries beside the longest
set); an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tillstar.llm.common import WordHasher, ascii_words, scratch, shared_table, shingle_sequence, small_side
from tillstar.llm.graph import components, near_labels

PERCENT = 75
BLOCK = 1_000
BLOCK_TOKENS = 400_000
COMMON = 16
SEEN = 200_000
# Hot tokens: in one of so many classes of the sample, which is one in SAMPLE.
HOT_SHARE, SAMPLE, SALTS = 2_000, 64, 512
HOT = 1 << 40
# Queries that meet a block in one task, and matches counted at once there.
SLICE, SLICE_TOKENS = 2_000, 1_000_000
HITS = 4_000_000


def spare(n: int) -> int:
    """Tokens that a prefix has beyond the shortest that guarantees one."""
    return n // 12


def prefix_length(n: int, percent: int = PERCENT) -> int:
    return n - (percent * n + 99) // 100 + 1 + spare(n)


def _sets(batches, part: str, percent: int):
    """Per row: id and mark of the row, set size, class key, and the set's tokens
    in order: all of them, or the prefix (which a task gives once for a class)."""
    hasher, seen = WordHasher(), set()
    for b in batches:
        n, keys, tokens = [], [], []
        for text in b.column(1).to_pylist():
            s = np.unique(shingle_sequence(hasher(ascii_words(text))).view(np.int64))
            key = xxhash.xxh3_64_intdigest(s.tobytes()) - (1 << 63)
            n.append(len(s))
            keys.append(key if len(s) else None)
            if part == "whole":
                tokens.append(s)
            elif len(s) and key not in seen:
                seen.add(key)
                tokens.append(s[:prefix_length(len(s), percent)])
            else:
                tokens.append(s[:0])
        if len(seen) > SEEN:
            seen.clear()
        ends = np.cumsum([0] + [len(t) for t in tokens])
        flat = np.concatenate(tokens) if tokens else np.empty(0, np.int64)
        yield pa.RecordBatch.from_arrays(
            [b.column(0), b.column(2), pa.array(n, pa.int64()), pa.array(keys, pa.int64()),
             pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64()))],
            ["id", "h", "n", "c", "tokens"])


def shingle_sets(docs: DataFrame, part: str, percent: int = PERCENT) -> DataFrame:
    """id, h, n, c, tokens from rows (id, text); ``h`` is a hash of the text,
    ``part`` of the tokens is "prefix" or "whole"."""
    kind = docs.schema["id"].dataType.simpleString()
    return docs.select("id", "text", F.xxhash64("text").alias("h")).mapInArrow(
        lambda bs: _sets(bs, part, percent), f"id {kind}, h bigint, n bigint, c bigint, tokens array<bigint>")


def _linked(inter: Column, n: Column, m: Column, percent: int) -> Column:
    return 100 * inter >= percent * (n + m - inter)


def _spare(n: Column) -> Column:
    return F.floor(n / 12)


def _least_own(n: Column, percent: int) -> Column:
    """Tokens of a prefix that it shares with the prefix of any linked set."""
    return 1 + _spare(F.ceil(F.lit(percent) * n / 100))


def _least_shared(n: Column, low: Column, high: Column, percent: int) -> Column:
    """Tokens that the prefixes of linked sets share at least, one of size n
    and one of a size from low to high (one less, for the rounding between)."""
    t = F.lit(percent)

    def reach(x, y):
        return F.ceil(t * (n + y) / F.lit(100 + percent)) - F.ceil(t * x / 100) + _spare(x)
    return F.least(reach(n, low), reach(high, high))


def _verify_pairs(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) of classes that are linked; ``pairs`` is a written table."""
    left = sets.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta"))
    right = sets.select(F.col("c").alias("b"), F.col("n").alias("nb"), F.col("tokens").alias("tb"))
    right = right.join(small_side(shared_table(pairs.select("b").distinct(), "jaccard-pivots")), "b", "left_semi")
    both = left.join(small_side(pairs), "a").join(right, "b")
    return both.filter((100 * F.least("na", "nb") >= percent * F.greatest("na", "nb")) & _linked(
        F.size(F.array_intersect("ta", "tb")), F.col("na"), F.col("nb"), percent)).select("a", "b")


def _compare(block: pa.Table, asked: pa.Table, percent: int) -> pa.Table:
    """Links (a, b) between the classes that ask and the members of a block:
    the matrix of the block's tokens and their holders, against each query's
    tokens.  One link to a group is enough."""
    member, n, label = (block.column(x).to_numpy() for x in ("c", "n", "label"))
    held = block.column("tokens").combine_chunks()
    tokens, ends = held.flatten().to_numpy(), np.diff(held.offsets.to_numpy())
    order = np.argsort(tokens, kind="stable")
    holder = np.repeat(np.arange(len(member)), ends)[order]
    token, start, count = np.unique(tokens[order], return_index=True, return_counts=True)
    who, size, group = (asked.column(x).to_numpy() for x in ("a", "na", "la"))
    if not len(who) or not len(member):
        return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
    given = asked.column("ta").combine_chunks()
    values, offsets = given.flatten().to_numpy(), given.offsets.to_numpy() - given.offsets[0].as_py()
    left, right = [], []
    step = max(1, HITS // max(1, int(np.diff(offsets).max(initial=1)) * len(member)))
    for k in range(0, len(who), step):
        m = min(k + step, len(who))
        part = values[offsets[k]:offsets[m]]
        row = np.repeat(np.arange(m - k), np.diff(offsets[k:m + 1]))
        at = np.minimum(np.searchsorted(token, part), len(token) - 1)
        hit = np.flatnonzero(token[at] == part)
        at, row = at[hit], row[hit]
        times = count[at]
        spot = np.repeat(start[at] - np.concatenate(([0], np.cumsum(times)[:-1])), times) + np.arange(times.sum())
        both = np.bincount(np.repeat(row, times) * len(member) + holder[spot],
                           minlength=(m - k) * len(member)).reshape(m - k, len(member))
        union = size[k:m, None] + n[None, :] - both
        i, j = np.nonzero((100 * both >= percent * union) & (group[k:m, None] != label[None, :]))
        _, one = np.unique(np.stack([i, label[j]]), axis=1, return_index=True)
        left.append(who[k + i[one]])
        right.append(member[j[one]])
    return pa.table({"a": pa.array(np.concatenate(left), pa.int64()), "b": pa.array(np.concatenate(right), pa.int64())})


def _open_blocks(queries: DataFrame, blocks: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links between the classes of ``queries`` (a, la, na, g), a written table,
    and members of other labels in their block; ``blocks`` (g, c, label).

    A block that many ask is compared in slices of them, so a task holds one
    block and SLICE queries or SLICE_TOKENS of their tokens at most."""
    per = queries.groupBy("g").agg(F.ceil(F.greatest(
        F.count(F.lit(1)) / SLICE, F.sum("na") / SLICE_TOKENS)).alias("slices"))
    per = small_side(shared_table(per, "jaccard-asked"))
    asked = queries.join(per, "g").select("a", "la", "g", F.pmod(F.xxhash64("a"), F.col("slices")).alias("slice"))
    opened = blocks.join(per, "g").select(
        "c", "label", "g", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("slices") - 1)).alias("slice"))
    members = sets.join(small_side(shared_table(opened, "jaccard-opened")), "c")
    asking = sets.select(F.col("c").alias("a"), F.col("n").alias("na"), F.col("tokens").alias("ta")) \
        .join(small_side(shared_table(asked, "jaccard-slices")), "a")
    return members.groupBy("g", "slice").cogroup(asking.groupBy("g", "slice")).applyInArrow(
        lambda left, right: _compare(left, right, percent), "a bigint, b bigint")


def _blocks(labels: DataFrame) -> DataFrame:
    """c, n, label -> with block number g: members of a label, similar sizes
    together, about BLOCK of them and BLOCK_TOKENS tokens to a block."""
    # sizes are counted first, so that no label is numbered member by member
    per = labels.groupBy("label", "n").count()
    before = Window.partitionBy("label").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    load = F.greatest(F.lit(1 / BLOCK), F.col("n") / F.lit(float(BLOCK_TOKENS))) * F.col("count")
    per = per.withColumn("parts", F.ceil(load)).withColumn("first", F.coalesce(F.sum(load).over(before), F.lit(0.0)))
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("c"), F.col("parts"))).otherwise(-1)
    band = F.when(F.col("parts") > 1, F.col("n")).otherwise(-1 - F.floor("first"))
    return labels.join(per, ["label", "n"]).select(
        "c", "n", "label", F.xxhash64("label", band, part).alias("g"))


def _queries(posts: DataFrame, shy: DataFrame, percent: int, among: bool = False) -> DataFrame:
    """a, la, na, g: classes and the blocks whose members they may link with.

    ``posts`` (token, c, n, label, g): prefix tokens, with the label and block
    of their class; ``shy`` (c, shy): tokens of a prefix that are not posted and
    count as shared, to be safe.  A class asks blocks of higher labels; with
    ``among`` blocks hold many labels, and it asks from its own block on."""
    union = posts.groupBy("token", "g").agg(F.min("label").alias("glabel"), F.min("n").alias("lo"), F.max("n").alias("hi"))
    asked = posts.select("token", F.col("c").alias("a"), F.col("n").alias("na"), F.col("label").alias("la"),
                         F.col("g").alias("own"))
    onward = F.col("own") <= F.col("g") if among else F.col("la") < F.col("glabel")
    hits = asked.join(union, "token").filter(
        onward & (100 * F.col("hi") >= percent * F.col("na")) & (percent * F.col("lo") <= 100 * F.col("na")))
    hits = hits.groupBy("a", "la", "na", "g").agg(F.count(F.lit(1)).alias("k"), F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    low = F.greatest(F.col("lo"), F.ceil(F.lit(percent) * F.col("na") / 100))
    high = F.least(F.col("hi"), F.floor(100 * F.col("na") / percent))
    # lo and hi cover the block's holders of shared tokens, which are all that can link
    bound = _least_shared(F.col("na"), low, high, percent)
    shy = small_side(shared_table(shy, "jaccard-shy"))
    return hits.join(shy.withColumnRenamed("c", "a"), "a", "left").filter(
        F.col("k") + F.coalesce("shy", F.lit(0)) >= bound).select("a", "la", "na", "g")


def _common(posts: DataFrame) -> DataFrame:
    """token, common: tokens of more than one label, and whether too many hold it."""
    found = posts.groupBy("token").agg(F.min("label").alias("x"), F.max("label").alias("y"),
                                       F.approx_count_distinct("label", 0.2).alias("d"))
    return found.filter("x != y").select("token", (F.col("d") > COMMON).alias("common"))


def _new_prefixes(own: DataFrame, tokens: DataFrame, common: DataFrame, percent: int) -> DataFrame:
    """token, c, forced: prefixes of the sets ``own`` (c, n, tokens) in the order
    that puts the common tokens last; forced tokens are common ones that it must
    hold.  ``tokens`` (c, token) are the sets' tokens."""
    stops = tokens.join(common, "token").groupBy("c").agg(F.collect_list("token").alias("stops"))
    free = F.array_except("tokens", "stops")
    p = (F.col("n") - F.ceil(F.lit(percent) * F.col("n") / 100) + 1 + _spare(F.col("n"))).cast("int")
    rows = own.join(stops, "c").select("c", p.alias("p"), free.alias("free"), F.array_sort("stops").alias("stops"))
    rows = rows.select("c", F.slice("free", 1, F.col("p")).alias("first"),
                       F.slice("stops", 1, F.greatest(F.col("p") - F.size("free"), F.lit(0))).alias("forced"))
    return rows.select("c", F.explode(F.concat(
        F.transform("first", lambda x: F.struct(x.alias("token"), F.lit(False).alias("forced"))),
        F.transform("forced", lambda x: F.struct(x.alias("token"), F.lit(True).alias("forced"))))).alias("x")) \
        .select("x.token", "c", "x.forced")


def _matrix_links(posts: DataFrame, labels: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Steps 3 to 5 over prefix postings (token, c) and the groups ``labels``
    (c, n, label, g): links between classes of different groups."""
    def answers(queries, blocks):
        return shared_table(_open_blocks(shared_table(queries, "jaccard-queries"), blocks, sets, percent), "jaccard-links")

    members = labels.select("g", "c", "label")
    held = shared_table(posts.join(small_side(labels), "c").select("token", "c", "n", "label", "g"), "jaccard-held")
    kinds = shared_table(_common(held), "jaccard-degrees")
    held = held.join(kinds, "token")
    avoided = held.filter("common").groupBy("c").agg(F.count(F.lit(1)).alias("shy"))
    links = answers(_queries(held.filter("NOT common"), avoided, percent), members)
    common = kinds.filter("common").select("token")
    if not common.take(1):
        return links

    holders = small_side(shared_table(avoided.select("c"), "jaccard-holders"))
    own = sets.join(holders, "c", "left_semi")
    tokens = own.select("c", F.explode("tokens").alias("token"))
    again = _common(tokens.join(small_side(labels.select("c", "label")), "c")).filter("common").select("token")
    common = small_side(shared_table(again.unionByName(common).distinct(), "jaccard-common"))
    fresh = shared_table(_new_prefixes(own, tokens, common, percent), "jaccard-prefixes")
    forced = shared_table(fresh.filter("forced").groupBy("c").agg(F.count(F.lit(1)).alias("shy"), F.min("token").alias("least")),
                          "jaccard-saturated")
    free = fresh.filter("NOT forced").select("token", "c").join(small_side(labels), "c")
    links = links.unionByName(answers(_queries(free, forced.select("c", "shy"), percent), members))
    if not forced.take(1):
        return links
    many = labels.select("c", "n", F.col("label").alias("own")).join(small_side(forced.select("c", "least")), "c")
    blocks = shared_table(_blocks(many.withColumnRenamed("least", "label")).select("c", "g").join(
        many.select("c", "n", F.col("own").alias("label")), "c"), "jaccard-blocks")
    among = fresh.select("token", "c").join(small_side(blocks), "c")
    none = forced.select("c", "shy").limit(0)
    return links.unionByName(answers(_queries(among, none, percent, among=True), blocks.select("g", "c", "label")))


def class_links(docs: DataFrame, classes: DataFrame, prefixes: DataFrame, percent: int = PERCENT) -> DataFrame:
    """a, b: links that connect all classes with a chain of links between them.

    ``docs`` (id, text); ``classes`` (c, n, rep, copies) with a document of
    each; ``prefixes`` (c, tokens)."""
    posts = prefixes.select("c", F.explode("tokens").alias("token"))
    sample = prefixes.filter(F.pmod(F.xxhash64("c", F.lit("hot")), F.lit(SAMPLE)) == 0)
    least = max(8, sample.count() // HOT_SHARE)
    hot = sample.select(F.explode("tokens").alias("token")).groupBy("token").count().filter(F.col("count") >= least)
    hot = small_side(shared_table(hot.select("token", F.lit(True).alias("hot")), "jaccard-hot"))

    def of_several(posts):
        salt = F.when(F.col("hot"), F.pmod("c", F.lit(SALTS))).otherwise(-1)
        holders = Window.partitionBy("token", salt)
        marked = posts.select("c", "token", "hot", F.min("c").over(holders).alias("x"), F.max("c").over(holders).alias("y"),
                              F.count(F.lit(1)).over(holders).alias("df"))
        return marked.filter("hot OR x != y").select("c", "token", "hot", F.when(F.col("hot"), HOT).otherwise(F.col("df")).alias("df"))

    posts = posts.join(hot, "token", "left").withColumn("hot", F.coalesce("hot", F.lit(False)))
    bridge = shared_table(of_several(posts).distinct(), "jaccard-bridge")
    # copies of a class in several tasks count once from here on; with fewer
    # classes fewer tokens are shared, so a second pass drops more
    for k in range(2):
        counts = bridge.select("c", "token").distinct().groupBy("c").agg(F.count(F.lit(1)).alias("k"))
        alive = classes.join(counts, "c").filter(F.col("k") >= _least_own(F.col("n"), percent)).select("c")
        alive = small_side(shared_table(alive, "jaccard-alive"))
        bridge = shared_table(of_several(bridge.select("c", "token", "hot").distinct().join(alive, "c")), "jaccard-bridge")
    keys = bridge.groupBy("c").agg(F.min(F.struct("df", "token")).alias("rare"),
                                   F.min("token").alias("first"), F.max("token").alias("last"))
    active = shared_table(classes.join(keys, "c"), "jaccard-active")
    reps = shared_table(active.select(F.col("rep").alias("id")).distinct(), "jaccard-reps")
    sets = shared_table(shingle_sets(docs.join(small_side(reps), "id"), "whole", percent)
                        .join(small_side(shared_table(active.select("c"), "jaccard-alive")), "c", "left_semi")
                        .select("c", "n", "tokens").dropDuplicates(["c"]), "jaccard-sets")

    asked = active.select("c", "copies", F.explode(F.array_distinct(F.array("rare.token", "first", "last"))).alias("token"))
    pivots = asked.groupBy("token").agg(F.max(F.struct("copies", "c")).getField("c").alias("b"))
    pairs = asked.select(F.col("c").alias("a"), "token").join(pivots, "token").filter("a != b").select("a", "b").distinct()
    links = shared_table(_verify_pairs(shared_table(pairs, "jaccard-pairs"), sets, percent), "jaccard-links")
    known = near_labels(links).withColumnRenamed("node", "c")
    labels = sets.select("c", "n").join(known, "c", "left").withColumn("label", F.coalesce("label", "c"))
    labels = shared_table(_blocks(shared_table(labels, "jaccard-groups")), "jaccard-labels")
    return links.unionByName(_matrix_links(bridge.select("token", "c"), labels, sets, percent))


def _components(docs: DataFrame, percent: int) -> DataFrame:
    """id, h, n, label, component of every row of ``docs`` (id, text); ``label``
    names the component, null for empty sets."""
    with scratch(docs.sparkSession):
        found = shared_table(shingle_sets(docs, "prefix", percent), "jaccard-documents", compression="uncompressed")
        with_set = found.filter(F.col("c").isNotNull() & F.col("id").isNotNull())
        classes = shared_table(with_set.groupBy("c").agg(
            F.first("n").alias("n"), F.min("id").alias("rep"), F.count(F.lit(1)).alias("copies")), "jaccard-classes")
        prefixes = found.filter(F.size("tokens") > 0).select("c", "tokens")
        label = components(class_links(docs, classes, prefixes, percent)).withColumnRenamed("node", "c")
        labelled = shared_table(classes.join(label, "c", "left").select(
            "c", "rep", F.coalesce("label", "c").alias("label")), "jaccard-classes")
        least = labelled.groupBy("label").agg(F.min("rep").alias("component"))
        of_class = labelled.join(least, "label").select("c", "label", "component")
        return shared_table(found.select("id", "h", "n", "c").join(of_class, "c", "left").select(
            "id", "h", "n", "label", F.when(F.col("id").isNotNull(), F.coalesce("component", "id")).alias("component")),
            "jaccard-components", keep=True)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id for every row."""
    return _components(docs.select(F.col(id_col).alias("id"), "text"), percent).select(
        F.col("id").alias("doc_id"), F.col("n").alias("n_shingles"), F.col("component").alias("component_id"))


def first_of_group(docs: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs``, all columns, that have the smallest id of their own
    text's component; of several with that id in one component one stays.
    Rows with a null id stay."""
    found = _components(docs.select(F.col("doc_id").alias("id"), "text"), percent).filter(F.col("id").isNotNull())
    first = found.groupBy("id", "component", F.coalesce("label", "h").alias("label")).agg(
        F.min("h").alias("least"), F.max("h").alias("most"), F.count(F.lit(1)).alias("rows"))
    least = first.filter("id = component AND least != most").select("id", "component", "label", "least")
    gone = found.filter("id != component").select("id", "h")
    other = found.withColumn("label", F.coalesce("label", "h")).join(least, ["id", "component", "label"]).filter(
        "h != least").select("id", "h")
    gone = shared_table(gone.unionByName(other).distinct().select(F.col("id").alias("_id"), F.col("h").alias("_h")), "jaccard-gone")
    again = shared_table(first.filter("id = component AND rows > 1").select(F.col("id").alias("_id")).distinct(), "jaccard-again")
    text = F.xxhash64(docs["text"])
    left = docs.join(small_side(gone), (docs["doc_id"] == F.col("_id")) & (text == F.col("_h")), "left_anti")
    if not again.take(1):
        return left
    repeated = left["doc_id"] == F.col("_id")
    once = left.join(small_side(again), repeated, "left_semi").withColumn("_text", F.xxhash64("text")) \
        .dropDuplicates(["doc_id", "_text"]).drop("_text")
    return left.join(small_side(again), repeated, "left_anti").unionByName(once)

"""The operators against brute force, exact round trips and held-out accuracy,
on the small tables and on hand-made rows with nulls, empty and very long
texts, ties, repeated rows, no rows, and extra columns of clashing names."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from tillstar.llm import (compact_windows, decontaminate, group_join, host_quality, langid, licenses, mixing, sharding,
                          toxicity, warc)
from tillstar.llm.common import shared_path
from tillstar.llm.graph import components

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint, key string, c int, host string, n int"
BASE = " ".join(f"alpha{i} beta{i % 7}" for i in range(60))


def words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def odd(spark):
    """Rows of every awkward kind; the extra columns clash with internal names."""
    near = BASE.replace("alpha30", "changed")
    texts = [None, "", "  \n\t ", "one", "one two", BASE, BASE, BASE.upper(), near, "zz " * 30_000, "é" * 5,
             "line a\nline a\nline a\nline b words here to count up ten", "#### $$$ word", "x y z w v " * 9,
             BASE + " tail", "in-between words of an ordinary short text with more than ten words"]
    rows = [(i, t, None if i % 5 == 0 else "en", None if i % 4 == 0 else f"s{i % 3}", None, "k", 1, "h", 9)
            for i, t in enumerate(texts)]
    rows += [rows[5], rows[5], (None, BASE, "en", "s1", 3, "k", 1, "h", 9), (None, None, None, None, None, None, None, None, None)]
    return spark.createDataFrame(rows, SCHEMA).cache()


@pytest.fixture(scope="module")
def nothing(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet").cache()


def brute_counts(text):
    ws = words(text)
    spots = Counter(tuple(ws[i:i + 5]) for i in range(len(ws) - 4))
    held = {i + k for i in range(len(ws) - 4) if spots[tuple(ws[i:i + 5])] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in (text or "").split("\n"):
        if words(line):
            dup += line in seen
            seen.add(line)
    return (len(ws), sum(map(len, ws)), sum(ch in "#*$%&|<>" for ch in text or ""), dup, len(held))


def brute_components(rows):
    sets = []
    for _, text in rows:
        ws = (text or "").encode().lower().split()
        sets.append({tuple(ws[i:i + 5]) for i in range(len(ws) - 4)} if len(ws) > 4 else {tuple(ws)} if ws else set())
    group = list(range(len(rows)))

    def find(x):
        while group[x] != x:
            x = group[x]
        return x
    holders = defaultdict(list)
    for k, s in enumerate(sets):
        for token in s:
            holders[token].append(k)
    for k, s in enumerate(sets):
        for j, both in Counter(j for token in s for j in holders[token]).items():
            if 100 * both >= 75 * (len(s) + len(sets[j]) - both):
                group[find(k)] = find(j)
    least = {}
    for k, (i, _) in enumerate(rows):
        least[find(k)] = min(least.get(find(k), i), i)
    return {i: (len(sets[k]), least[find(k)]) for k, (i, _) in enumerate(rows)}


def test_components_on_chains_stars_and_nothing(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, k) for k in range(101, 160)] + [(7, 7), (300, 299), (300, 299)]
    got = {r.node: r.label for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    want = {i: 0 for i in range(41)} | {i: 100 for i in range(100, 160)} | {299: 299, 300: 299}
    assert got == want
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


class TestLanguage:
    def test_held_out_accuracy(self, spark):
        rows = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
        model = langid.train(rows.filter(~fold))
        got = langid.predict(rows.filter(fold), model).join(rows.select("doc_id", "lang"), "doc_id").collect()
        assert sum(r.lang == r.lang_pred for r in got) >= 0.97 * len(got)
        assert all(0 <= r.score <= 1 for r in got)
        assert len(model.logs) <= (1 + model.longest) * len(model.langs) / langid.FLOOR + 1

    def test_backoff_order(self):
        import numpy as np
        model = langid.LanguageModel(["a", "b"], [0.6, 0.4], [{"word": 1}, {"w": 2}, {"wo": 3}, {}, {}],
                                     np.log(np.array([[1, 1], [0.9, 0.1], [0.1, 0.9], [0.2, 0.8]])))
        assert model.predict("word")[0] == "a"          # the word itself decides
        assert model.predict("wox")[0] == "b"           # the longest known n-gram
        assert model.predict("qq")[0] == "a"            # nothing known: most frequent
        assert model.predict("123 ²") == ("und", 0.0)

    def test_awkward_rows(self, odd, nothing):
        model = langid.train(odd)
        got = langid.predict(odd, model).collect()
        assert len(got) == odd.count()
        assert {r.lang_pred for r in got if r.doc_id in (0, 1, 2)} == {"und"}
        assert {r.lang_pred for r in got} <= {"en", "und"}
        blank = langid.train(nothing)
        assert {r.lang_pred for r in langid.predict(odd, blank).collect()} == {"und"}
        assert langid.predict(nothing, model).count() == 0


class TestQuality:
    def test_counts_against_brute_force(self, docs, odd):
        for table in (docs, odd):
            text = {(r.doc_id, r.text) for r in table.select("doc_id", "text").collect()}
            want = Counter((i, *brute_counts(t)) for i, t in text for _ in range(1))
            got = {tuple(r) for r in host_quality.host_quality(table).select(
                "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words").collect()}
            assert got == set(want)

    def test_bad_host_is_judged_harder(self, spark):
        good = "an ordinary text of more than ten words which breaks no rule at all number"
        mild = good + " ## x"
        rows = [(i, f"{good} {i}", "good") for i in range(200)] + [(1000, mild, "good"), (1001, mild, "bad")]
        rows += [(2000 + i, "short", "bad") for i in range(150)] + [(3000, f"{good} z", "bad")]
        got = {r.doc_id: r for r in host_quality.host_quality(
            spark.createDataFrame(rows, "doc_id bigint, text string, source string")).collect()}
        assert got[1000].kept and not got[1001].kept and got[3000].kept
        assert got[1001].host_flagged and not got[1000].host_flagged

    def test_awkward_rows(self, odd, nothing):
        kept = host_quality.kept_rows(odd)
        assert kept.columns == odd.columns and 0 < kept.count() < odd.count()
        assert host_quality.host_quality(nothing).count() == 0


class TestJaccard:
    @pytest.mark.parametrize("table", ["docs", "families"])
    def test_against_brute_force(self, spark, docs, table):
        if table == "families":                 # many near copies, a passage that all share, sets of common tokens
            import random
            rnd, rows = random.Random(5), []
            origin = [f"o{k}" for k in range(90)]
            for i in range(160):
                ws = list(origin)
                for _ in range(rnd.choice([0, 1, 2, 3, 5])):
                    ws[rnd.randrange(90)] = f"e{rnd.randrange(60)}"
                rows.append((i, " ".join(ws)))
            passage = " ".join(f"p{k}" for k in range(30))
            rows += [(200 + i, " ".join(f"u{i}_{k}" for k in range(rnd.randrange(4, 90))) + " " + passage) for i in range(80)]
            rows += [(400 + i, passage + " " + f"v{i % 9} " * (i % 5)) for i in range(60)]
            docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in group_join.near_duplicates(docs).collect()}
        assert got == brute_components(rows)

    def test_boilerplate_matches_brute_force(self, spark):
        """Sets that consist of common tokens for most: subsets of two shared
        passages with few words of their own, which no pivot joins; and a
        token in a third of all texts."""
        import random
        rnd, rows = random.Random(9), []
        passages = [[f"b{p}x{k}" for k in range(60)] for p in range(2)]
        for i in range(150):
            ws = []
            for p in passages:
                lo = rnd.randrange(0, 30)
                ws += p[lo:lo + rnd.randrange(10, 31)]
            rows.append((i, " ".join(ws + [f"own{i % 40}" for _ in range(rnd.randrange(3))])))
        rows += [(300 + i, "one two three four five " + " ".join(f"f{i % 70}x{k}" for k in range(rnd.randrange(2, 9)))) for i in range(150)]
        rnd.shuffle(rows)
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(6)
        got = {r.doc_id: (r.n_shingles, r.component_id) for r in group_join.near_duplicates(docs).collect()}
        assert got == brute_components(rows)

    def test_hot_tokens_are_split(self, spark, monkeypatch):
        """The same result when every token of the sample counts as hot."""
        monkeypatch.setattr(group_join, "SAMPLE", 1)
        monkeypatch.setattr(group_join, "HOT_SHARE", 40)
        monkeypatch.setattr(group_join, "SALTS", 3)
        rows = [(i, f"a b c d e f {i % 4} " + " ".join(f"w{i % 9}x{k}" for k in range(i % 13))) for i in range(120)]
        got = group_join.near_duplicates(spark.createDataFrame(rows, "doc_id bigint, text string").repartition(4)).collect()
        assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute_components(rows)

    def test_rows_of_one_id_with_unlike_texts(self, spark):
        a, b, c = (" ".join(f"{x}{k}" for k in range(40)) for x in "abc")
        rows = [(1, a, "p"), (2, a, "q"), (2, b, "r"), (3, c, "s"), (3, c, "t"), (4, c + " tail", "u"), (5, a + " end", "v"),
                (1, a + " end", "w"), (None, a, "x"), (None, None, "y"), (6, None, "z"), (6, "", "z2"), (6, b + " x", "z3")]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string, component string")
        kept = sorted(((r.doc_id, r.text) for r in group_join.first_of_group(docs).collect()), key=str)
        assert sum(t in (a, a + " end") and i == 1 for i, t in kept) == 1
        left = [x for x in kept if x[0] != 1]
        assert left == sorted([(2, b), (3, c), (None, a), (None, None), (6, None), (6, "")], key=str)

    def test_awkward_rows(self, odd, nothing):
        got = group_join.near_duplicates(odd).collect()
        assert len(got) == odd.count()
        by = defaultdict(set)
        for r in got:
            by[r.doc_id].add((r.n_shingles, r.component_id))
        assert by[0] == {(0, 0)} and by[3] == {(1, 3)} and by[4] == {(1, 4)}
        assert {by[i].copy().pop()[1] for i in (5, 6, 7, 14)} == {5}
        assert by[None] == {(0, None), (116, 5)} or all(c is None or c == 5 for _, c in by[None])
        first = group_join.first_of_group(odd)
        ids = [r.doc_id for r in first.collect()]
        assert first.columns == odd.columns and ids.count(5) == 1 and 6 not in ids and ids.count(None) == 2
        assert group_join.near_duplicates(nothing).count() == 0 and group_join.first_of_group(nothing).count() == 0


class TestWarc:
    def test_round_trip(self, spark):
        big = "<p>" + "pâté " * 400 + "</p>"
        rows = [(1, "http://www.A.example/x", big), (2, "https://b.example:8080/y?q=1", big), (3, None, big),
                (4, "http://a.example/x", "small"), (5, "http://a.example/x", "small"), (6, "not a url\r\n", None),
                (7, "http://[bad", ""), (7, "http://[bad", ""), (None, "http://n.example", "no id"),
                (9, "http://a.example/cr", "a\r\n\r\nb\r\n\r\n" + "c" * 2000), (10, "\tta\\b\nc", "x")]
        pages = spark.createDataFrame([(*r, 0, "f") for r in rows], "page_id bigint, url string, html string, offset int, file string")
        folder = shared_path(spark, "warc-test")
        lines, directory = warc.archive(pages, folder)
        got = Counter(tuple(r) for r in warc.read_back(lines.select("key"), directory, folder).collect())
        want = Counter()
        for i, _, html in rows:
            data = (html or "").encode()
            revisit = html == big and i != 3
            want[i, len(data), hashlib.sha1(data).hexdigest(), "revisit" if revisit else "response", 3 if revisit else None] += 1
        assert got == want
        payloads = {bytes(r.payload) for r in warc.read_records(lines, folder + "/archive").collect() if r.payload is not None}
        assert payloads == {(h or "").encode() for _, _, h in rows}

    def test_blocks_and_lookup(self, spark):
        folder = shared_path(spark, "warc-test")
        lines = spark.createDataFrame([(f"com,k{i % 50:03d})/", i, "f", i, 1) for i in range(1000)],
                                      "key string, page_id bigint, file string, offset bigint, length bigint")
        directory = warc.write_index(lines, folder, block_lines=16)
        assert directory.count() >= 60
        asked = spark.createDataFrame([("com,k007)/",), ("com,k049)/",), ("com,zzz)/",), ("",)], "key string")
        got = Counter(r.key for r in warc.lookup(asked, directory, folder).collect())
        assert got == {"com,k007)/": 20, "com,k049)/": 20}

    def test_keys_and_nothing(self, spark):
        assert warc.url_key("https://www.Example.com:443/A?b=1") == "com,example)/A?b=1"
        assert warc.url_key("http://m.x.org:8080") == "org,x,m:8080)/" and warc.url_key(None) == ""
        pages = spark.createDataFrame([], "page_id bigint, url string, html string")
        folder = shared_path(spark, "warc-test")
        lines, directory = warc.archive(pages, folder)
        assert warc.read_back(lines.select("key"), directory, folder).count() == 0


    def test_directory_in_key_ranges(self, spark, monkeypatch):
        """A directory that goes to the tasks in many ranges, with a key that
        holds a third of all captures, finds every record; no range is asked
        for keys beyond it."""
        for name, value in (("ENTRIES", 4), ("READ_BYTES", 2000), ("INDEX_BYTES", 300), ("BATCH_LINES", 7)):
            monkeypatch.setattr(warc, name, value)
        monkeypatch.setattr(warc.directory_parts, "__defaults__", (4,))
        rows = [(i, None if i % 3 == 0 else f"http://h{i % 17}.example/p{i % 50}", f"page {i}") for i in range(300)]
        pages = spark.createDataFrame(rows, "page_id bigint, url string, html string").repartition(4)
        folder = shared_path(spark, "warc-test")
        lines = warc.write_archives(warc.plan_records(pages), f"{folder}/archive")
        directory = warc.write_index(lines, f"{folder}/index", block_lines=5)
        parts = list(warc.directory_parts(directory))
        assert len(parts) > 5 and all(e[1] >= lo and (hi is None or e[0] < hi) for lo, hi, part in parts for e in part)
        assert all(len(part) <= 12 for _, _, part in parts)
        got = warc.read_back(lines.select("key"), directory, folder)
        assert sorted(r.page_id for r in got.collect()) == list(range(300))
        reading = warc.read_records(warc.lookup(lines.select("key"), directory, f"{folder}/index"), f"{folder}/archive")
        assert reading.rdd.getNumPartitions() > 5


class TestPassages:
    def test_windows_cover_every_passage_once(self):
        import numpy as np
        values = np.random.default_rng(3).integers(0, 50, 120)       # with ties
        found = compact_windows.compact_windows(values, 10)
        for i in range(120 - 9):
            for j in range(i + 10, 121, 7):
                least = values[i:j].min()
                own = [w for w in found if w[0] <= i and j <= w[2] and values[w[3]] == least]
                assert len(own) == 1 and values[own[0][0]:own[0][2]].min() == least
                single = (values[own[0][0]:own[0][2]] == least).sum() == 1
                assert own[0][1] == (own[0][3] if single else -1)

    def test_long_texts_of_few_words(self):
        import time

        import numpy as np
        began = time.time()
        for words in ("word ", "a b c d e f g "):
            s = compact_windows.shingle_sequence(compact_windows.WordHasher()(compact_windows.ascii_words(words * (1_000_000 // len(words.split())))), 5)
            assert len(compact_windows.compact_windows(s, 46)) == 1
            assert compact_windows.shared_passages(s, s, 46)[0][4] == 1.0
            assert compact_windows.shared_passages(s, np.arange(60, dtype=np.uint64), 46) == []
        assert time.time() - began < 60

    def test_near_equal_passages_match_brute_force(self):
        """Whatever two sequences share: a passage of at least 46 shingles is
        found if brute force over all pairs of stretches finds one whose two
        sides are clearly similar enough, and nothing else is reported."""
        import random

        import numpy as np
        rnd, missed, wrong = random.Random(11), 0, 0
        for case in range(60):
            size, changes = rnd.choice(((60, 1), (70, 1), (100, 2), (120, 1), (150, 3), (52, 0), (60, 3), (80, 5)))
            p = [rnd.randrange(10 ** 6) for _ in range(size)]
            q = list(p)
            for c in rnd.sample(range(size), changes):
                q[c] = rnd.randrange(10 ** 6)

            def sequence(ws):
                return np.array([hash(tuple(ws[i:i + 5])) for i in range(len(ws) - 4)], np.int64).astype(np.uint64)
            s, t = (sequence([rnd.randrange(10 ** 6) for _ in range(rnd.randrange(40))] + x + [rnd.randrange(10 ** 6) for _ in range(30)])
                    for x in (p, q))
            got = compact_windows.shared_passages(s, t, 46)
            for i, j, k, m, similar in got:
                a, b = set(s[i:j].tolist()), set(t[k:m].tolist())
                wrong += j - i < 46 or m - k < 46 or abs(len(a & b) / len(a | b) - similar) > 1e-9 or similar < 0.75
            same = np.flatnonzero(np.isin(s, t))
            there = False
            for i in same:
                for j in same[same >= i + 45]:
                    part = set(s[i:j + 1].tolist())
                    k = np.flatnonzero(np.isin(t, list(part)))
                    other = set(t[k[0]:k[-1] + 1].tolist())
                    there |= k[-1] + 1 - k[0] >= 46 and len(part & other) / len(part | other) >= 0.75
            missed += there and not got
        assert not missed and not wrong

    def test_near_equal_passages_of_documents(self, spark):
        """Passages of similarity 0.75 or more that two documents share, one or
        two words changed, the pair's texts unlike otherwise."""
        import random
        rnd = random.Random(3)
        rows, want = [], set()
        for n in range(150):
            size, changes = rnd.choice(((60, 1), (80, 1), (100, 2), (120, 2), (150, 2)))
            p = [f"p{n}w{i}" for i in range(size)]
            q = list(p)
            for c in rnd.sample(range(size), changes):
                q[c] = f"other{n}"
            for k, x in enumerate((p, q)):
                before, after = ([f"d{n}{k}{side}{i}" for i in range(rnd.randrange(20, 90))] for side in "ab")
                rows.append((f"id{2 * n + k:04d}", " ".join(before + x + after)))
            want.add(frozenset((rows[-1][0], rows[-2][0])))
        docs = spark.createDataFrame(rows, "doc_id string, text string").repartition(7)
        got = compact_windows.repeated_passages(docs).collect()
        assert got[0].doc_id.startswith("id") and got[0].asDict().keys() == set(compact_windows.COLUMNS)
        pairs = {frozenset((r.doc_id, r.other_doc_id)) for r in got}
        assert pairs <= want and len(pairs) >= 0.95 * len(want)

    def test_maximal_segments(self):
        import numpy as np
        assert toxicity.maximal_segments(np.array([4, -5, 3, -3, 1, 2, -2, 2, -2, 1, 5.0])) == [(0, 1, 4.0), (2, 3, 3.0), (4, 11, 7.0)]
        assert toxicity.maximal_segments(np.array([])) == []

    def test_every_repeat_of_fifty_words_is_found(self, spark):
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        holders, texts = defaultdict(set), {}
        for r in docs.select("doc_id", "text").collect():
            ws = texts[r.doc_id] = (r.text or "").encode().lower().split()
            for i in range(len(ws) - 49):
                holders[b" ".join(ws[i:i + 50])].add(r.doc_id)
        want = set().union(*[v for v in holders.values() if len(v) > 1])
        rows = compact_windows.repeated_passages(docs).collect()
        got = {r.doc_id for r in rows} | {r.other_doc_id for r in rows}
        assert want <= got

        # near-equal passages come too: each one reported is similar by its words,
        # and those repeated word for word are all but a few
        def shingles(doc, start, end):
            ws = texts[doc][start:end]
            return {tuple(ws[i:i + 5]) for i in range(len(ws) - 4)}
        for r in rows:
            a, b = shingles(r.doc_id, r.start_word, r.end_word), shingles(r.other_doc_id, r.other_start_word, r.other_end_word)
            assert abs(len(a & b) / len(a | b) - r.similarity) < 1e-9
        exact = {i for r in rows if r.similarity == 1 for i in (r.doc_id, r.other_doc_id)}
        assert len(exact | want) <= 1.1 * len(want)
        assert all(r.end_word - r.start_word >= 50 and r.similarity >= 0.75 and r.doc_id != r.other_doc_id for r in rows)

    @pytest.mark.parametrize("length", [12, 23])
    def test_passages_of_lines_that_smaller_ids_hold(self, spark, length):
        def new(tag, n):
            return " ".join(f"{tag}w{i}" for i in range(n))
        lines = [new(f"common{k}", length) for k in range(8)]
        rows = [(i, f"{new(f'a{i}', 60)} {lines[i % 8]} {new(f'b{i}', 60)}") for i in range(240)]
        pairs = set()
        for n in range(30):
            held = " ".join(lines[(n + k * (n // 8 + 1)) % 8] for k in range(46 // length))
            passage = f"{held} {new(f'p{n}', 50 - len(held.split()))}"
            pairs.add((2 * n + 1001, 2 * n + 1000))
            rows += [(2 * n + 1000 + k, f"{new(f'c{n}x{k}', 70)} {passage} {new(f'd{n}x{k}', 70)}") for k in range(2)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5, "doc_id")
        got = compact_windows.repeated_passages(docs).collect()
        assert pairs <= {(r.doc_id, r.other_doc_id) for r in got if r.end_word - r.start_word >= 50}

    def test_anchor_that_repeats_a_shingle(self):
        import numpy as np
        import pyarrow as pa
        line = " ".join(f"same{i}" for i in range(80))
        texts = [f"{line} {' '.join(f'x{i}' for i in range(60))} {line}", line]
        batch = pa.RecordBatch.from_pydict({"doc_id": [1, 2], "text": texts})
        rows = [r for b in compact_windows._windows([batch], 4, 46) for r in b.to_pylist() if r["doc2"] is not None]
        assert rows and all(r["lo2"] < 80 and r["hi2"] > 140 for r in rows if r["lo"] == 0)
        s = np.arange(60, dtype=np.uint64)
        assert len(set(compact_windows.run_hashes(s, 46, np.arange(15)).tolist())) == 15

    @pytest.mark.parametrize("most", [1, 40, 8 << 20])
    def test_words_hashed_by_arrow(self, most):
        import numpy as np
        import pyarrow as pa

        from tillstar.llm import common
        texts = [None, "", " ", "a", "  A b\x0bC\x1cd\x85e f ", "\n\nx", "\u00c9 \u00e9 a", "a\x00b c", "z " * 90, None] * 3
        for column in (pa.array(texts), pa.array(texts).slice(3, 9), pa.array([], pa.string()), pa.array([None], pa.string())):
            want = [common.WordHasher()(common.ascii_words(t)) for t in column.to_pylist()]
            got = list(common.word_hashes(column, most))
            assert len(got) == len(want) and all(np.array_equal(g, w) for g, w in zip(got, want))

    def test_texts_of_one_id_and_length_are_told_apart(self):
        import pyarrow as pa
        line, other = (" ".join(f"{tag}{i:02d}" for i in range(60)) for tag in "xy")
        assert len(line) == len(other)
        batch = pa.RecordBatch.from_pydict({"a": [1, 1, 1], "b": [2, 2, 2], "ta": [line] * 3, "tb": [other, line, other + " z"]})
        rows = [r for b in compact_windows._verify([batch], 46) for r in b.to_pylist()]
        assert [(r["doc_id"], r["start_word"], r["end_word"], r["similarity"]) for r in rows] == [(2, 0, 60, 1.0)]

    def test_awkward_rows(self, odd, nothing):
        got = {(r.doc_id, r.other_doc_id) for r in compact_windows.repeated_passages(odd).collect()}
        assert {(6, 5), (7, 5), (14, 5)} <= got or {5, 6, 7, 14} <= {i for p in got for i in p}
        assert compact_windows.repeated_passages(nothing).count() == 0


class TestDecontamination:
    def test_against_brute_force(self, spark, docs):
        bench = spark.read.parquet(f"{SF}/benchmark.parquet")
        got = {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()}
        plain = decontaminate.plain_words
        items = [(r.item_id, plain(r.text)) for r in bench.collect()]
        shingles = lambda ws: Counter(tuple(ws[i:i + 5]) for i in range(max(1, len(ws) - 4)))
        want = set()
        for r in docs.select("doc_id", "text").collect():
            ws, seen = plain(r.text), None
            for item, iw in items:
                if seen is None:
                    seen = set(shingles(ws))
                b = shingles(iw)
                if not seen & set(b):
                    continue
                for i in range(max(1, len(ws) - len(iw) + 1)):
                    a = shingles(ws[i:i + len(iw)])
                    least = sum((a & b).values())
                    if least >= 0.75 * sum((a | b).values()):
                        want.add((r.doc_id, item))
                        break
        assert got == want and want
        left = decontaminate.without_leaks(docs, bench)
        assert {r.doc_id for r in left.collect()} == {r.doc_id for r in docs.collect()} - {i for i, _ in want}

    def test_blocks_find_all_within_radius(self):
        import random
        rnd, blocks = random.Random(1), decontaminate.bit_blocks(decontaminate.RADIUS)
        assert sum(bin(m).count("1") for _, m in blocks) == 64
        for _ in range(300):
            a = rnd.getrandbits(64)
            b = a
            for k in rnd.sample(range(64), decontaminate.RADIUS):
                b ^= 1 << k
            assert any(a >> s & m == b >> s & m for s, m in blocks)

    def test_near_copies_parts_and_awkward_rows(self, spark, odd, nothing):
        item = " ".join(f"q{i}" for i in range(60))
        bench = spark.createDataFrame([(1, item), (2, None), (3, ""), (4, "two words"), (5, item)], "item_id bigint, text string")
        docs = spark.createDataFrame([(1, "pre " * 40 + item.replace("q30", "x") + " post" * 30), (2, "the two words here"),
                                      (3, item.upper()), (4, "q1 q2 q3 q4 q5 q6"), (5, None)], "doc_id bigint, text string")
        want = {(1, 1), (1, 5), (2, 4), (3, 1), (3, 5)}
        assert {(r.doc_id, r.item_id) for r in decontaminate.find_leaks(docs, bench).collect()} == want
        parts = list(decontaminate.benchmark_parts(bench, words=10))
        assert len(parts) > 3 and sum(len(p.items) for p in parts) == 3
        assert decontaminate.find_leaks(odd, bench).count() == 0
        assert decontaminate.without_leaks(odd, bench).count() == odd.count()
        assert decontaminate.find_leaks(nothing, bench).count() == 0
        assert decontaminate.find_leaks(odd, bench.limit(0)).count() == 0


class TestMixing:
    @pytest.mark.parametrize("rows_per_range", [7, 100_000])
    def test_budgets(self, docs, rows_per_range):
        rows = mixing.with_copies(docs, rows_per_range=rows_per_range).collect()
        total, largest = Counter(), Counter()
        for r in rows:
            assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
            total[r.source] += r.taken
            largest[r.source] = max(largest[r.source], r.size)
        targets = {r.source: (r.target, r.source_size) for r in rows}
        for source, (target, size) in targets.items():
            assert abs(total[source] - target) <= largest[source] / 2 and target <= 2 * size
        # filling by hand: share by weight, cap, share the excess again
        weight = {s: (3, 1, 2)[k % 3] for k, s in enumerate(sorted(targets))}
        want, full = 1.5 * sum(s for _, s in targets.values()), set()
        while True:
            rest = want - sum(2 * targets[s][1] for s in full)
            level = rest / sum(w for s, w in weight.items() if s not in full)
            over = {s for s, w in weight.items() if s not in full and level * w > 2 * targets[s][1]}
            if not over:
                break
            full |= over
        for s, (target, size) in targets.items():
            assert target == pytest.approx(2 * size if s in full else level * weight[s])

    def test_equal_rows_are_cut_between(self, spark):
        """Null and repeated ids: each source within one document of its target."""
        schema = "doc_id bigint, text string, source string, place int, cut int"
        rows = [(None, "ten words of text here for this one long document", "a", 1, 2)] * 400
        rows += [(7, "five words in this text", "b", 1, 2)] * 301 + [(i, "some more words", "b", 1, 2) for i in range(50)]
        rows += [(9, None, "c", 1, 2)] * 20 + [(9, "one", "c", 1, 2)] * 10 + [(i, "w " * 90, None, 1, 2) for i in range(9)]
        docs = spark.createDataFrame(rows, schema).repartition(6)
        for ranges in (3, 100_000):
            got = mixing.with_copies(docs, rows_per_range=ranges).collect()
            total, targets, largest = Counter(), {}, Counter()
            for r in got:
                assert r.taken == r.copies * r.size and 0 <= r.copies <= 2
                total[r.source] += r.taken
                targets[r.source] = r.target
                largest[r.source] = max(largest[r.source], r.size)
            assert len(got) == len(rows)
            assert all(abs(total[s] - t) <= largest[s] / 2 for s, t in targets.items())
        assert mixing.mix(docs).count() == sum(r.copies for r in got)

    def test_ranges_do_not_change_the_mix(self, docs, odd, nothing):
        key = lambda d, n: Counter((r.doc_id, r.copies) for r in mixing.with_copies(d, rows_per_range=n).collect())
        assert key(docs, 5) == key(docs, 100_000) and key(odd, 2) == key(odd, 100)
        assert mixing.with_copies(nothing).count() == 0
        mixed = mixing.mix(odd)
        assert mixed.columns == odd.columns
        assert mixed.count() == sum(r.copies for r in mixing.with_copies(odd).collect())


class TestSharding:
    @pytest.mark.parametrize("rows_per_range", [6, 100_000])
    def test_law_and_mixture(self, docs, rows_per_range):
        rows = sharding.assign_shards(docs, rows_per_range=rows_per_range).collect()
        slots, mixture = defaultdict(list), defaultdict(Counter)
        texts = {r.doc_id: r.text or "" for r in docs.collect()}
        for r in rows:
            slots[r.shard].append(r.slot)
            mixture[r.shard][r.source] += 1
            assert r.size == len(texts[r.doc_id].encode()) + 8 and r.text_crc32 == zlib.crc32(texts[r.doc_id].encode())
        counts = [len(slots[s]) for s in range(24)]
        assert max(counts) - min(counts) <= 1 and sum(counts) == len(texts)
        assert all(sorted(v) == list(range(len(v))) for v in slots.values())
        per = Counter(r.source for r in rows)
        assert all(abs(c - per[s] / 24) <= 2 for m in mixture.values() for s, c in m.items())

    def test_awkward_rows(self, odd, nothing):
        few = sharding.assign_shards(odd, shards=3, rows_per_range=4).collect()
        assert sorted(Counter(r.shard for r in few).values()) in ([6, 7, 7], [6, 6, 6], [6, 6, 7])
        assert [r.size for r in few if r.doc_id == 0] == [8]
        whole = sharding.sharded_rows(odd.withColumn("shard", F.lit("mine")))
        assert whole.columns == [*odd.columns, "shard", "slot"] and whole.count() == odd.count()
        assert whole.select("shard", "slot").distinct().count() == odd.count()
        assert sharding.assign_shards(nothing).count() == 0


class TestToxicity:
    def test_held_out(self, spark):
        docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
        labels = spark.read.parquet("/root/testdata/sf0.1/labels.parquet")
        fold = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0
        model = toxicity.train(docs, labels.filter(~fold))
        got = toxicity.score(docs, model).join(labels.filter(fold), "doc_id").collect()
        hit = Counter((r.toxic, int(r.score >= 0.5)) for r in got)
        assert hit[1, 1] >= 0.8 * (hit[1, 0] + hit[1, 1]) and hit[0, 1] <= 0.03 * (hit[0, 0] + hit[0, 1])
        assert all(0 <= r.score <= 1 for r in got)

    def test_label_marked_by_what_texts_lack(self, spark):
        rows = [(i, f"report {i % 7} about the river and town number {i % 11} "
                 + ("" if i % 2 else "awful nasty horrid awful ") + f"with a remark on item {i % 5}") for i in range(400)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        labels = docs.select("doc_id", (F.col("doc_id") % 2).cast("int").alias("toxic"))
        model = toxicity.train(docs, labels.filter("doc_id < 200"))
        scores = {r.doc_id: r.score for r in toxicity.score(docs.filter("doc_id >= 200"), model).collect()}
        assert min(s for i, s in scores.items() if i % 2) > 0.5 > max(s for i, s in scores.items() if i % 2 == 0)

    def test_awkward_rows(self, spark, odd, nothing):
        rows = [(i, "a plain text with words " + ("awful awful " if i % 2 else "fine ") + "abcdefghij"[i % 10] * (1 + i // 10))
                for i in range(60)]
        docs = spark.createDataFrame(rows, "doc_id bigint, text string")
        labels = spark.createDataFrame([(i, i % 2) for i in range(60)] + [(1, 1), (None, 1), (2, None)], "doc_id bigint, toxic int")
        model = toxicity.train(docs, labels)
        got = {r.doc_id: r for r in toxicity.score(docs, model).collect()}
        assert got[1].score > 0.5 > got[2].score and got[1].passages[0].start == 5
        # length alone tells nothing
        plain = spark.createDataFrame([(i, "word " * n) for i, n in enumerate((0, 1, 7, 8, 9, 500, 40_000))], "doc_id bigint, text string")
        assert len({r.score for r in toxicity.score(plain, model).collect()}) == 1 and toxicity.score(plain, model).first().score < 0.5
        same = spark.createDataFrame([(i, "the same words " + "abcdefghij"[i % 10]) for i in range(60)], "doc_id bigint, text string")
        assert not toxicity.train(same, labels).usable
        rest = toxicity.score(odd, model).collect()
        assert len(rest) == odd.count() and all(0 <= r.score <= 1 for r in rest)
        assert {r.score for r in toxicity.score(odd, toxicity.train(docs, labels.limit(0))).collect()} == {0.0}
        assert toxicity.score(nothing, model).count() == 0


class TestLicenses:
    def test_notices(self, spark, odd, nothing):
        texts = ["Some text.\nReleased under the MIT License.\nMore.", "Licensed under CC BY 4.0.", "Licensed under CC BY-NC 4.0.",
                 "This work is licensed under the GNU General Public License, version 2.",
                 "word " * 500 + "this work is LICENSED under the GNU General Public License, version 3. " + "word " * 500,
                 "Licensed under the Apache License, Version 2.0.\nAll rights reserved.", "A driver must have a licence.", None, ""]
        got = defaultdict(set)
        for r in licenses.scan_licenses(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect():
            got[r.doc_id].add(r.license)
        assert got == {0: {"MIT"}, 1: {"CC-BY-4.0"}, 2: {"CC-BY-NC-4.0"}, 3: {"GPL-2.0"}, 4: {"GPL-3.0"},
                       5: {"Apache-2.0", "Proprietary"}, 6: {"unknown"}}
        assert licenses.scan_licenses(odd).count() == 0 and licenses.scan_licenses(nothing).count() == 0

    def test_short_names_headers_and_spdx_lines(self):
        known = licenses.Templates()
        for text, name in (
                ("This tool is available under the Apache License 2.0 and more.", "Apache-2.0"), ("Uses the GNU GPL v3 license.", "GPL-3.0"),
                ("This library is free software; you can redistribute it and/or\nmodify it under the terms of the GNU Lesser General "
                 "Public\nLicense as published by the Free Software Foundation; either\nversion 2.1 of the License, or (at your option) "
                 "any later version.", "LGPL-2.1"),
                ("This program and the accompanying materials are made\n available under the terms of the Eclipse Public License 2.0\n"
                 " which is available at https://www.eclipse.org/legal/epl-2.0/", "EPL-2.0"),
                ("This is free and unencumbered software released into the public domain.", "Unlicense"),
                ("// SPDX-License-Identifier: LGPL-2.1-or-later", "LGPL-2.1"), ("# SPDX-License-Identifier: MIT", "MIT")):
            assert [r[1] for r in known.scan(text)] == [name], text

    def test_ranking_loses_no_notice_that_all_templates_would_find(self):
        """Blocks of several notices and prose: whatever place any template
        confirms overlaps a reported notice, and planted licences are named."""
        import random
        known, rnd = licenses.Templates(), random.Random(8)
        plain = {n: [re.sub(r"[\[\]]", "", t) for t in ts] for n, ts in licenses.TEMPLATES.items()}
        prose = "the quick software terms of use are distributed with all rights and public copies under this version".split()
        for _ in range(60):
            names = rnd.sample(sorted(plain), rnd.choice((1, 2, 3)))
            parts = []
            for n in names:
                parts += [" ".join(rnd.choices(prose, k=rnd.randrange(0, 60))), rnd.choice(plain[n])]
            text = "\n".join(parts)
            own = licenses.words_of(text)
            found = known.notices(own)
            covered = {i for start, end, *_ in found for i in range(start, end)}
            for name, ws, must, _ in known.all:
                for start, end, *_ in known.find(own, ws, must):
                    assert not covered.isdisjoint(range(start, end)), (name, text)
            assert len(covered) == sum(end - start for start, end, *_ in found)
            got = Counter(n for _, _, n, *_ in found)
            assert sum(got[n] > 0 for n in names) >= len(names) - (1 if any("GPL" in n or "BSD" in n or "CC" in n for n in names) else 0), text

    def test_wrapped_notices(self):
        import textwrap
        mit = ("Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated "
               "documentation files (the \"Software\"), to deal in the Software without restriction, including")
        gpl = ("This program is free software: you can redistribute it and/or modify it under the terms of the GNU General "
               "Public License as published by the Free Software Foundation, either version 3 of the License, or")
        apache = ("Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in "
                  "compliance with the License. You may obtain a copy of the License at "
                  "http://www.apache.org/licenses/LICENSE-2.0")
        bsd = ["Redistribution and use in source and binary forms, with or without modification, are permitted provided that "
               "the following conditions are met:", "1. Redistributions of source code must retain the above copyright "
               "notice, this list of conditions and the following disclaimer.", "2. Redistributions in binary form must "
               "reproduce the above copyright notice, this list of conditions and the following disclaimer in the "
               "documentation and/or other materials provided with the distribution."]
        three = ["3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or "
                 "promote products derived from this software without specific prior written permission."]
        known, wrap = licenses.Templates(), lambda *parts: "\n\n".join(textwrap.fill(x, 60) for x in parts)
        for name, parts in (("MIT", [mit]), ("GPL-3.0", [gpl]), ("Apache-2.0", [apache]), ("BSD-2-Clause", bsd),
                            ("BSD-3-Clause", bsd + three)):
            text = "First line.\n" + wrap(*parts) + "\nLast line."
            assert [x[:2] for x in known.scan(text)] == [(1, name)]

    def test_notices_at_the_end_of_prose(self):
        prose = ("this program is a small piece of software that any person may obtain as source code or in binary form and "
                 "use with or without the documentation that we have published for it under the terms of the project so "
                 "that you may modify a copy of this file and the other files") + ". "
        known = licenses.Templates()
        for name, texts in licenses.TEMPLATES.items():
            for text in texts:
                assert {x[1] for x in known.scan(prose + re.sub(r"[\[\]]", "", text))} == {name}
        both = "Released under the MIT License. Licensed under CC BY 4.0."
        assert {x[1] for x in known.scan(prose + both)} == {"MIT", "CC-BY-4.0"}
        assert {x[1] for x in known.scan("Released under the ISC License. " + "word " * 30 + both)} == {"ISC", "MIT", "CC-BY-4.0"}

    def test_every_planted_notice(self, spark):
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        want = Counter()
        for r in docs.collect():
            for name, line in (("MIT", "Released under the MIT License."), ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
                               ("Apache-2.0", "Licensed under the Apache License, Version 2.0.")):
                want[name] += line in r.text
        got = Counter(r.license for r in licenses.scan_licenses(docs).collect())
        assert all(got[k] == v for k, v in want.items())

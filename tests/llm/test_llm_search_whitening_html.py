"""Lexical search, whitening and page text against brute force, plain linear
algebra and known layouts, with nulls, empty and very long values, ties,
repeated rows, empty tables and clashing extra columns."""

from __future__ import annotations

import html
import math
import re
from collections import Counter

import duckdb
import numpy as np
import pytest

from tillstar.llm import html_extraction, lexical_search, queries, sql, whitening
from tillstar.oracle.compare import same_result

SF = "/root/testdata/sf0.001"


def brute_search(docs, items, k):
    """Scores of all documents for all items, straight from the definition."""
    def terms(text):
        lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower)

    held = [(i, Counter(ts), len(ts)) for i, ts in ((i, terms(t)) for i, t in docs) if ts]
    n_docs, n_terms = len(held), sum(n for _, _, n in held)
    df = Counter(t for _, c, _ in held for t in c)
    of = {}
    for item, text in items:
        of.setdefault(item, set()).update(terms(text))
    rows = []
    for item, ts in of.items():
        scores = []
        for i, c, n in held:
            m = 50 + 50 * n * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10 ** 9 * c[t] // (1000 * c[t] + 20 * m))
                    for t in ts if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        rows += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scores)[:k], 1)]
    return sorted(rows, key=str)


class TestLexicalSearch:
    SCHEMA = "doc_id bigint, text string, n int, score int, rank int, item_id int, terms string"

    def run(self, spark, docs, items, k=50, schema=SCHEMA, **kw):
        rows = spark.createDataFrame([(i, t, 1, 2, 3, 4, "x") for i, t in docs], schema).repartition(5)
        asked = spark.createDataFrame(items, "item_id bigint, text string")
        return sorted(map(tuple, lexical_search.search(rows, asked, k, **kw).collect()), key=str)

    def test_matches_brute_force_in_small_blocks(self, spark):
        docs = [(r["doc_id"], r["text"]) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
        items = [(r["item_id"], r["text"]) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "17")
        try:
            for k in (1, 3, 50):
                assert self.run(spark, docs, items, k, block_pairs=200) == brute_search(docs, items, k)
        finally:
            spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")

    def test_awkward_rows(self, spark):
        docs = [(1, None), (2, ""), (3, "  ,.!"), (4, "Red RED blue"), (5, "red red blue"), (6, "red red blue"),
                (6, "red red blue"), (None, "red red blue"), (7, "\u00c9t\u00e9 \u00e9t\u00e9 x" + "\x00" + "y"),
                (8, "word " * 200_000 + "red"), (9, "caf\u00e9-au_lait 42")]
        items = [(1, "red"), (1, "blue red"), (2, None), (3, "\u00e9t\u00e9"), (4, "absent"), (None, "LAIT 42 y"), (5, "RED red Red"), (6, "")]
        for k in (1, 2, 50):
            assert self.run(spark, docs, items, k) == brute_search(docs, items, k)

    def test_accumulators_stop_and_ties_survive(self, spark):
        docs = [(i, "rare common" if i % 50 == 0 else "common filler words") for i in range(600, 0, -1)]
        for k in (1, 12, 13, 40):
            assert self.run(spark, docs, [(1, "rare common filler")], k) == brute_search(docs, [(1, "rare common filler")], k)
        block = lexical_search.Postings(np.array([2, 2, 2]), np.array([0, 2, 3, 4]), np.array([0, 1, 1, 1]),
                                        np.array([1, 1, 1, 1]), np.array([5000, 10]), 3, 6)
        found, scores = block.search([0, 1], 1, 1)
        assert found.tolist() == [0] and scores.tolist() == [int(block.score[block.doc == 0].sum())]

    def test_text_ids_and_empty_tables(self, spark):
        rows = [("b", "red"), ("a", "red")]
        got = self.run(spark, rows, [(1, "red")], schema=self.SCHEMA.replace("doc_id bigint", "doc_id string"))
        assert [r[:3] for r in got] == [(1, 1, "a"), (1, 2, "b")]
        assert self.run(spark, [], [(1, "red")]) == [] == self.run(spark, [(1, "red")], [])

    def test_matches_sql(self, spark):
        con = duckdb.connect()
        for t in ("documents", "benchmark"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
        got = queries.op11_lexical_search(spark, SF)
        res = con.execute(sql.LEXICAL_SEARCH)
        ok, why = same_result(got.columns, [tuple(r) for r in got.collect()], [d[0] for d in res.description], res.fetchall())
        assert ok, why


def plain_whitening(vectors, k=8):
    x = np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000
    n, s = len(x), x.sum(axis=0)
    deviation = [sum(int(v) ** 2 for v in row) for row in n * x - s]
    a = x - s / n
    e, v = np.linalg.eigh(a.T @ a / n)
    e, v = e[::-1], v[:, ::-1]
    return deviation, (a @ v[:, :k]) / np.sqrt(e[:k]), e[:k] / e.sum()


class TestWhitening:
    SCHEMA = "vec_id bigint, embedding array<float>, n int, component string, x double"

    def run(self, spark, rows, schema=SCHEMA, **kw):
        data = [(i, v, 1, "c", 0.5) for i, v in rows]
        return whitening.whiten(spark.createDataFrame(data, schema).repartition(3), **kw).collect()

    def check(self, got, ids, vectors, k=8, near=1e-7):
        deviation, white, explained = plain_whitening(vectors, k)
        by = {(r["vec_id"], r["component"]): r for r in got}
        assert len(got) == len(ids) * white.shape[1]
        flip = np.sign([by[ids[0], c + 1]["whitened"] * white[0, c] for c in range(white.shape[1])])
        for j, i in enumerate(ids):
            for c in range(white.shape[1]):
                r = by[i, c + 1]
                assert r["n"] == len(ids) and r["deviation"] == deviation[j]
                assert abs(r["whitened"] - flip[c] * white[j, c]) < near
                assert abs(r["explained"] / explained[c] - 1) < 1e-6 and r["identity_error"] < 1e-6

    def test_matches_plain_linear_algebra(self, spark):
        rows = [(r["vec_id"], r["embedding"]) for r in spark.read.parquet(f"{SF}/embeddings.parquet").collect()]
        rows = [(i, v) for i, v in rows if v is not None and all(c is not None and math.isfinite(c) for c in v)]
        got = queries.op12_whitening(spark, SF).collect()
        self.check(got, [i for i, _ in rows], [v for _, v in rows])
        assert all(r["deviation"] == r["deviation_exact"] for r in got)

    def test_awkward_rows(self, spark):
        draw = np.random.default_rng(1)
        good = [(i, draw.normal(size=3).astype(np.float32).tolist()) for i in range(40)]
        bad = [(100, None), (101, []), (102, [1.0, None, 2.0]), (103, [1.0, float("nan"), 2.0]), (104, [float("inf"), 0.0, 1.0]),
               (105, [1.0, 2.0]), (106, [3e38, 0.0, 0.0])]
        got = self.run(spark, good + bad)
        self.check(got, [i for i, _ in good], [v for _, v in good], 3)
        twice = self.run(spark, good + good + [(None, good[0][1])])
        assert len(twice) == 81 * 3 and {r["n"] for r in twice} == {81}

    def test_unlike_scales_and_dependent_dimensions(self, spark):
        draw = np.random.default_rng(2)
        base = draw.normal(size=(300, 4))
        wide = np.column_stack([base[:, 0] * 1e7, base[:, 1], base[:, 2] * 1e-1, base[:, 0] * 1e7 + base[:, 3]])
        rows = [(i, v) for i, v in enumerate(wide.tolist())]
        got = self.run(spark, rows, self.SCHEMA.replace("float", "double"))
        deviation, _, explained = plain_whitening(wide, 4)
        assert {r["component"] for r in got} == {1, 2, 3, 4} and max(r["identity_error"] for r in got) < 1e-4
        assert {r["vec_id"]: int(r["deviation"]) for r in got} == dict(enumerate(deviation))
        same = [(i, [float(v[0]), float(v[0]), 5.0]) for i, v in enumerate(base)]
        got = self.run(spark, same, self.SCHEMA.replace("float", "double"))
        assert {r["component"] for r in got} == {1} and abs(got[0]["explained"] - 1) < 1e-9

    def test_no_variance_and_no_rows(self, spark):
        assert self.run(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])]) == [] == self.run(spark, [(1, None)])
        assert whitening.whiten(spark.createDataFrame([], self.SCHEMA)).collect() == []

    def test_large_numbers_stay_exact(self, spark):
        rows = [(i, [float(v), 1.0]) for i, v in enumerate((2 ** 40, 2 ** 39, 3, 5))]
        got = {r["vec_id"]: int(r["deviation"]) for r in self.run(spark, rows, self.SCHEMA.replace("float", "double"))}
        x = [1024 * 2 ** 40, 1024 * 2 ** 39, 3072, 5120]
        assert got == {i: (4 * v - sum(x)) ** 2 for i, v in enumerate(x)}

    def test_solve_rows(self):
        draw = np.random.default_rng(3)
        factor = np.triu(draw.normal(size=(150, 150))) + 20 * np.eye(150)
        rows = draw.normal(size=(9, 150))
        assert np.allclose(whitening.solve_rows(rows, factor) @ factor, rows)


@pytest.fixture(scope="module")
def model(spark):
    return html_extraction.train(spark.read.parquet(f"{SF}/pages.parquet"))


def text_of(model, page):
    return html_extraction.main_text(html_extraction.PageReader(), model, page)


class TestHtmlExtraction:
    PROSE = ["The harbour was quiet in the early morning, and only a few boats went out to sea.",
             "Nobody on the quay could say when the last of them would come home again.",
             "By noon the wind had turned, and the market filled with people from the hills."]

    def test_given_pages(self, spark):
        """The article element of the given layout, cut by a plain pattern."""
        wrong = 0
        rows = spark.read.parquet(f"{SF}/pages.parquet").select("page_id", "html").collect()
        got = {r["page_id"]: r for r in queries.op13_html_extraction(spark, SF).collect()}
        for page_id, page in rows:
            body = re.search(r"<article>(.*?)(</article>|<footer|$)", page, re.S)[1]
            parts = [re.sub(r"<[^>]*>", " ", p) for p in re.split(r"</?(?:p|h1)>", body)]
            want = "\n".join(filter(None, (" ".join(html.unescape(p).split()) for p in parts)))
            wrong += got[page_id]["text"] != want
            assert got[page_id]["n_chars"] == len(got[page_id]["text"])
        assert wrong == 0

    @pytest.mark.parametrize("page", [
        "<header class=site-header><h1>Site</h1></header><nav><a href=a>One</a> <a href=b>Two</a></nav><main>{}</main>"
        "<aside><p>Read this other story that many people liked, too.</p></aside><footer>&copy; 2020</footer>",
        "<div id=menu><ul><li><a href=a>One</a><li><a href=b>Two</a></ul></div><div class='cookie-banner'><p>We use cookies "
        "to make this page better for everyone who reads it.</p></div><div class=content>{}</div>"
        "<div id=comments><div class=comment><p>I think this is a very good text, and I read it twice today.</p></div></div>",
        "<body><form action=/s><label>Search the site</label><input></form><article>{}<div class=ad>Buy the new lamp, it is "
        "cheaper than ever before.</div></article><section class=comments><article class=comment><p>What a long story this "
        "was, but I liked it.</p></article></section><div class=footer><p>All rights reserved by the owner.</p></div>"])
    def test_other_layouts(self, model, page):
        inner = "".join(f"<p>{p}</p>" for p in self.PROSE)
        assert text_of(model, page.format(inner)) == "\n".join(self.PROSE)

    def test_held_out_layouts(self, spark, model):
        rows = spark.read.parquet("/root/testdata/sf0.01/pages.parquet").orderBy("page_id").limit(120).collect()
        reader = html_extraction.LabelReader()
        pages = [html_extraction.PageReader().blocks(r["html"]) for r in rows]
        mains = [[(b.text, b.leaf == "h1") for b, y in zip(p, html_extraction.marked(p)) if y] for p in pages]
        draw = html_extraction.Layouts([t for m in mains for t, h in m if not h], [t for m in mains for t, h in m if h], seed=4711)
        wrong = total = 0
        for own in mains:
            blocks, labels = reader.labelled(draw.page(own))
            wrong += sum(a != b for a, b in zip(model.decode(blocks), labels))
            total += len(labels)
        assert total > 1500 and wrong < 0.03 * total

    def test_markup(self):
        read = html_extraction.PageReader().blocks
        page = ("<!-- <p>no</p> --><p>a&amp;b&#33; <b>bold</b><br>next\n\t line<p>open <p>again<script>var x = '<p>no</p>';</script>"
                "<ul><li>one<li>two <a href='x>y'>link</a></ul>1 < 2<style>p{}</style><div title=\"a>b\">tail</div>&nbsp;x <h2>h</h3>after")
        assert [b.text for b in read(page)] == ["a&b! bold next line", "open", "again", "one", "two link", "1 < 2", "tail", "x", "h", "after"]
        assert [b.linked for b in read(page)] == [0, 0, 0, 0, 4, 0, 0, 0, 0, 0]
        for odd in (None, "", "<", "<p", "</p></div>", "<!-- open", "<script>never closed", "<a href=\"open>text</a>", "&#xZZ; &unknown;",
                    "<p>" * 5000 + "deep" + "</div>" * 5000):
            read(odd)

    def test_long_pages_are_read_whole(self, model):
        many = [f"{p} {i}." for i in range(3000) for p in self.PROSE]
        page = "<nav><a href=x>menu</a></nav><article>" + "".join(f"<p>{p}</p>" for p in many) + "</article><footer>&copy; x</footer>"
        assert text_of(model, page) == "\n".join(many)
        one = "word " * 400_000
        assert text_of(model, f"<article><p>{one}.</p></article>") == " ".join(one.split()) + " ."

    def test_gradient_and_viterbi_match_enumeration(self):
        """Marginals and the best labelling of short chains, by all labellings."""
        draw = np.random.default_rng(5)
        node, pairs = np.zeros((7, 2)), draw.normal(size=(2, 2, 2))
        node[:, 1] = draw.normal(size=7)
        kinds, first, sizes = np.array([0, 1, 0, 0, 1, 1, 0]), np.array([0, 3]), np.array([3, 4])
        p, expected = html_extraction._marginals(node, pairs, kinds, first, sizes, np.searchsorted(sizes, np.arange(4), side="right"))
        want_p, want_e = np.zeros(7), np.zeros((2, 2, 2))
        for a, n in zip(first, sizes):
            total, chains = 0.0, []
            for bits in range(2 ** n):
                y = [bits >> t & 1 for t in range(n)]
                s = math.exp(sum(node[a + t, y[t]] for t in range(n)) + sum(pairs[kinds[a + t], y[t - 1], y[t]] for t in range(1, n)))
                chains.append((s, y))
                total += s
            for s, y in chains:
                for t in range(n):
                    want_p[a + t] += y[t] * s / total
                    if t:
                        want_e[kinds[a + t], y[t - 1], y[t]] += s / total
            field = html_extraction.Field({f"name:t{t}": node[a + t, 1] for t in range(n)}, pairs)
            blocks = [html_extraction.Block("x", (f"name:t{t}",), "p", 0, 0) for t in range(n)]
            numbers = 0
            for t in range(n):  # same container as the block before where the kind is 1
                numbers += t > 0 and not kinds[a + t]
                blocks[t].container = numbers
            assert field.decode(blocks) == [bool(v) for v in max(chains)[1]]
        assert np.allclose(p, want_p) and np.allclose(expected, want_e)

    def test_awkward_rows(self, spark):
        schema = "page_id bigint, url string, html string, text string, n_chars int"
        rows = [(1, "u", None, "t", 0), (2, None, "", "t", 0), (None, "u", "<p>Some words of a text, at last.</p>", None, None),
                (3, "u", "<script>x</script>", "t", 1), (3, "u", "<script>x</script>", "t", 1)]
        got = html_extraction.main_texts(spark.createDataFrame(rows, schema)).collect()
        assert len(got) == 5 and {(r["page_id"], r["n_chars"]) for r in got if r["page_id"] in (1, 2, 3)} == {(1, 0), (2, 0), (3, 0)}
        assert html_extraction.main_texts(spark.createDataFrame([], schema)).collect() == []

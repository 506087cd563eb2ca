"""Main text of web pages by a linear-chain conditional random field.

1. A page becomes the sequence of its leaf blocks: runs of text between block
   level tags, character references decoded, white space (``<br>`` included)
   turned into one space.  Comments, scripts, styles and other elements without
   readable text (``SILENT``) are left out.  Missing end tags close as browsers
   close them.
2. A block's features are the tags of its ancestors, the words of their class,
   id and role names (and the group of ``NAMES`` they belong to), and its text:
   length, share of links, punctuation, place in the page, neighbours.
3. The field scores every block as main text or not, and every pair of
   neighbours, apart for those of one container and others.  It is fitted by
   gradient steps on the log-likelihood (forward-backward sums) and decoded by
   Viterbi.
4. Labelled pages: those with an article or main element are labelled by their
   own markup; and every sampled page is set again in ``LAYOUTS`` page
   layouts drawn at random (fixed seed), in which menus, headers, notices,
   adverts, sidebars, forms, comments and footers stand around and inside the
   article, with and without telling tags and names.  Texts of these pages come
   from the sample: prose also for adverts, sidebars and comments.

The model is fitted on at most ``TRAIN_PAGES`` pages of at most ``TRAIN_CHARS``
characters, those with the smallest hash of their id and html (the documented
bound of the sample); it is then applied to every page and all of its html.

Edge cases: null and empty html, and pages without text, give an empty text;
very long pages are read whole, in time linear in their length; ill-formed
markup never fails; repeated rows and null ids are pages like any other; ties
between the labels count as main text; without any page to learn from every
block is main text; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import html as entities
import random
import re
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstar.llm.common import Shared

TRAIN_PAGES = 300
TRAIN_CHARS = 50_000
LAYOUTS = 5
STEPS, RATE, RIDGE = 150, 0.2, 1e-5
SEED = 13

# HTML elements by their part in the block structure.
BLOCK = frozenset("""address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset
figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre
search section summary table tbody td tfoot th thead tr ul""".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = "script|style|template|noscript|iframe|textarea|title|select|svg|math|object|canvas|audio|video|noframes"
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
# An opening tag ends these open elements, back to the given limits.
P_ENDS = frozenset("""address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form
h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre search section table ul""".split())
ENDS = {"li": (("li",), ("ul", "ol", "menu")), "dd": (("dd", "dt"), ("dl",)), "dt": (("dd", "dt"), ("dl",)),
        "td": (("td", "th"), ("tr", "table")), "th": (("td", "th"), ("tr", "table")), "tr": (("tr",), ("table",))}
# Words of class, id and role names, by what they mark.
NAMES = {
    "main": "article content entry main post story text body prose",
    "menu": "menu nav navigation navbar breadcrumb breadcrumbs toc tabs pagination pager",
    "head": "header masthead topbar banner branding logo",
    "foot": "footer bottom copyright contentinfo colophon legal",
    "side": "sidebar aside widget rail complementary related recommended popular trending more",
    "advert": "ad ads advert advertisement adslot sponsor sponsored promo promotion",
    "notice": "cookie consent notice alert gdpr popup modal overlay message disclaimer dialog",
    "share": "share sharing social follow tags meta byline",
    "form": "form search login signup subscribe newsletter contact",
    "comment": "comment comments reply replies respond discussion disqus feedback",
}

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<({SILENT})\b(?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+>.*?(?:</\1\s*>|\Z)"
    r"|<(/?)([a-z][^\s/>]*+)((?:\"[^\"]*+\"|'[^']*+'|[^'\">])*+)>"
    r"|<[a-z/!?][^>]*+>"
    r"|([^<]++|<)", re.I | re.S)
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
HIDDEN = re.compile(r"""\shidden(?=[\s=/]|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
# The part that an element's tag alone stands for.
PARTS = {"article": "main", "main": "main", "nav": "menu", "menu": "menu", "header": "head", "footer": "foot", "aside": "side",
         "form": "form", "search": "form", "button": "form", "dialog": "notice"}
SENTENCE_END = re.compile(r"[.!?…。！？][\"'»”’)\]]*$")


@dataclass
class Block:
    text: str
    features: tuple
    leaf: str
    container: int
    linked: int


def name_groups(word: str) -> list[str]:
    return [group for group, names in _GROUPS if any(
        word == n or len(n) > 3 and (word.startswith(n) or word.endswith(n)) for n in names)]


_GROUPS = [(group, names.split()) for group, names in NAMES.items()]


def attribute_features(attributes: str) -> set:
    found = set()
    for m in ATTRIBUTE.finditer(attributes):
        for word in NAME_WORD.findall(m[2] or m[3] or m[4] or ""):
            word = word.lower()
            groups = name_groups(word)
            found.update(f"group:{g}" for g in groups)
            if not groups:
                found.add(f"name:{word}")
    if HIDDEN.search(attributes):
        found.add("hidden")
    return found


class PageReader:
    """Cuts pages into blocks; keeps the features of element chains it has seen."""

    def __init__(self):
        self.seen: dict = {}

    def enter(self, above: tuple, tag: str, attributes: str) -> tuple:
        key = above, tag, attributes
        if key not in self.seen:
            if len(self.seen) > 100_000:
                self.seen.clear()
            own = attribute_features(attributes) if tag not in ("html", "body") else set()
            parts = {f"nearest:{f[6:]}" for f in own if f.startswith("group:")}
            if tag in PARTS:
                parts.add(f"nearest:{PARTS[tag]}")
            kept = [f for f in above if not f.startswith("nearest:")] if parts else above
            self.seen[key] = tuple(sorted({*kept, f"in:{tag}"} | own | parts))
        return self.seen[key]

    def blocks(self, page: str | None) -> list[Block]:
        # an open element: tag, features down to it, its number, links open around it
        found, open_, parts, count = [], [("", (), 0, 0)], [], 0
        links = linked = 0

        def close():
            nonlocal linked
            text = " ".join("".join(parts).split())
            if text:
                tag, features, number, _ = open_[-1]
                # text between the children of one element belongs to that element
                at = open_[-2][2] if tag in P_ENDS or tag in ENDS else number
                found.append(Block(text, features, tag, at, linked))
            parts.clear()
            linked = 0

        def leave(k: int):
            nonlocal links
            links = open_[k][3]
            del open_[k:]

        for m in TOKEN.finditer(page or ""):
            text = m[5]
            if text is not None:
                if "&" in text:
                    text = entities.unescape(text)
                parts.append(text)
                if links:
                    linked += len(text)
                continue
            if not m[3]:
                continue
            tag = m[3].lower()
            if tag == "a":
                links = max(0, links + (-1 if m[2] else 1)) if m[2] else 1
            elif tag == "br":
                parts.append(" ")
            elif tag in BLOCK:
                close()
                if m[2]:
                    ended = HEADINGS if tag in HEADINGS else (tag,)
                    k = next((k for k in range(len(open_) - 1, 0, -1) if open_[k][0] in ended), 0)
                    if k:
                        leave(k)
                    continue
                if tag in P_ENDS and open_[-1][0] == "p" or tag in HEADINGS and open_[-1][0] in HEADINGS:
                    leave(len(open_) - 1)
                if tag in ENDS:
                    ended, limits = ENDS[tag]
                    for k in range(len(open_) - 1, 0, -1):
                        if open_[k][0] in ended:
                            leave(k)
                            break
                        if open_[k][0] in limits:
                            break
                if tag not in VOID:
                    count += 1
                    open_.append((tag, self.enter(open_[-1][1], tag, m[4] or ""), count, links))
        close()
        return found


MAIN_MARKS = frozenset(("in:article", "in:main", "group:main"))


def bucket(n: int) -> int:
    return min(n.bit_length(), 8)


def features(blocks: list[Block]) -> list[list[str]]:
    """Feature names of every block of a page."""
    n, out, sizes = len(blocks), [], []
    for b in blocks:
        words = b.text.count(" ") + 1
        size = bucket(words)
        share = min(3, 4 * b.linked // max(1, len(b.text)))
        sizes.append((b.leaf, size))
        own = [f"leaf:{b.leaf}", f"words:{size}", f"links:{share}", f"words:{size} links:{share}",
               f"sentence:{SENTENCE_END.search(b.text) is not None}"]
        if "©" in b.text or "(c)" in b.text.lower():
            own.append("copyright")
        if "," in b.text:
            own.append("comma")
        out.append(own + list(b.features))
    body = [not MAIN_MARKS.isdisjoint(b.features) for b in blocks]
    telling = "article:none" if not any(body) else "article:outside"
    for i, own in enumerate(out):
        own.append("article:inside" if body[i] else telling)
        own.append(f"place:{4 * i // n}")
        if i == 0:
            own.append("first")
        if i == n - 1:
            own.append("last")
        own.append(f"before:{sizes[i - 1][1]}" if i else "before:none")
        own.append(f"after:{sizes[i + 1][1]}" if i + 1 < n else "after:none")
    return out


def joins(blocks: list[Block]) -> np.ndarray:
    """1 where a block and the one before it stand in one container, else 0."""
    at = np.array([b.container for b in blocks], np.int64)
    return np.concatenate(([0], at[1:] == at[:-1])).astype(np.int64) if len(at) else at


@dataclass
class Field:
    """Weights of the features for main text, and of neighbouring labels
    (container kind, label before, label)."""

    weights: dict[str, float] = field(default_factory=dict)
    pairs: np.ndarray = field(default_factory=lambda: np.zeros((2, 2, 2)))

    def decode(self, blocks: list[Block]) -> list[bool]:
        """Viterbi: the best sequence of labels, main text on a tie."""
        if not blocks:
            return []
        get = self.weights.get
        score = [sum(get(f, 0.0) for f in own) for own in features(blocks)]
        pairs, kinds = self.pairs.tolist(), joins(blocks).tolist()
        other, main, back = 0.0, score[0], []
        for s, kind in zip(score[1:], kinds[1:]):
            (oo, om), (mo, mm) = pairs[kind]
            from_main = main + mm >= other + om, main + mo >= other + oo
            back.append(from_main)
            other, main = (main + mo if from_main[1] else other + oo), (main + mm if from_main[0] else other + om) + s
        label = main >= other
        out = [label]
        for to_main, to_other in reversed(back):
            label = to_main if label else to_other
            out.append(label)
        return out[::-1]


def fit(pages: list[tuple[list[Block], list[bool]]]) -> Field:
    """Maximum likelihood with a ridge, by Adam steps over all pages at once."""
    pages = sorted((p for p in pages if p[0]), key=lambda p: len(p[0]))
    if not pages:
        return Field()
    named: dict[str, int] = {}
    columns, ends, labels, kinds = [], [0], [], []
    for blocks, y in pages:
        for own in features(blocks):
            columns.extend(named.setdefault(f, len(named)) for f in own)
            ends.append(len(columns))
        labels.extend(y)
        kinds.extend(joins(blocks).tolist())
    columns, starts, labels, kinds = np.array(columns), np.array(ends[:-1]), np.array(labels, int), np.array(kinds)
    sizes = np.array([len(b) for b, _ in pages])
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    row_of = np.repeat(np.arange(len(labels)), np.diff(ends))
    # pages are ordered by length: at step t those from alive[t] on have a block
    alive = np.searchsorted(sizes, np.arange(sizes.max()), side="right")
    n_pairs = np.zeros((2, 2, 2))
    inner = np.setdiff1d(np.arange(len(labels)), first)
    np.add.at(n_pairs, (kinds[inner], labels[inner - 1], labels[inner]), 1)
    w, pairs = np.zeros(len(named)), np.zeros((2, 2, 2))
    moments = [np.zeros_like(w), np.zeros_like(w), np.zeros_like(pairs), np.zeros_like(pairs)]
    for step in range(1, STEPS + 1):
        node = np.zeros((len(labels), 2))
        node[:, 1] = np.add.reduceat(w[columns], starts)
        p, expected = _marginals(node, pairs, kinds, first, sizes, alive)
        grad_w = np.bincount(columns, (labels - p)[row_of], len(named)) / len(labels) - RIDGE * w
        grad_p = (n_pairs - expected) / len(labels) - RIDGE * pairs
        for x, g, a, b in ((w, grad_w, moments[0], moments[1]), (pairs, grad_p, moments[2], moments[3])):
            a += 0.1 * (g - a)
            b += 0.001 * (g * g - b)
            x += RATE * (a / (1 - 0.9 ** step)) / (np.sqrt(b / (1 - 0.999 ** step)) + 1e-8)
    return Field(dict(zip(named, w.tolist())), pairs)


def _marginals(node, pairs, kinds, first, sizes, alive):
    """Probability of label 1 of every block and expected counts of label
    pairs, by scaled forward and backward sums over all pages in step."""
    potential, edge = np.exp(node - node.max(axis=1, keepdims=True)), np.exp(pairs)
    forward, backward = np.zeros_like(node), np.ones_like(node)
    for t, k in enumerate(alive):
        at = first[k:] + t
        f = potential[at]
        if t:
            f = f * np.einsum("ni,nij->nj", forward[at - 1], edge[kinds[at]])
        forward[at] = f / f.sum(axis=1, keepdims=True)
    for t in range(len(alive) - 1, 0, -1):
        at = first[alive[t]:] + t
        b = np.einsum("nij,nj->ni", edge[kinds[at]], potential[at] * backward[at])
        backward[at - 1] = b / b.sum(axis=1, keepdims=True)
    p = forward * backward
    p /= p.sum(axis=1, keepdims=True)
    expected = np.zeros((2, 2, 2))
    inner = np.setdiff1d(np.arange(len(node)), first)
    both = forward[inner - 1][:, :, None] * edge[kinds[inner]] * (potential[inner] * backward[inner])[:, None, :]
    both /= both.sum(axis=(1, 2), keepdims=True)
    np.add.at(expected, kinds[inner], both)
    return p[:, 1], expected


APART = ("in:nav", "in:aside", "in:footer", "in:form", "in:button", "in:dialog", "in:menu")


def marked(blocks: list[Block]) -> list[bool] | None:
    """Labels by a page's own markup; None if no article or main element has text."""
    inside = [("in:article" in b.features or "in:main" in b.features) and not any(a in b.features for a in APART)
              and not any(f.startswith("group:") and f != "group:main" for f in b.features) for b in blocks]
    return inside if any(inside) else None


class Layouts:
    """Page layouts drawn at random, filled with the texts of sampled pages.
    Blocks of main text carry the attribute ``data-main``."""

    def __init__(self, prose: list[str], short: list[str], seed: int = SEED):
        self.draw, self.prose, self.short = random.Random(seed), prose, short or prose

    def chance(self, p: float) -> bool:
        return self.draw.random() < p

    def wrap(self, tag: str, group: str, inner: str) -> str:
        """``inner`` in an element that tells its part by tag, by name, or by both."""
        d = self.draw
        name = d.choice(NAMES[group].split())
        name = d.choice((name, f"{name}-{d.choice('box list area wrap inner block'.split())}", f"site-{name}"))
        named = f' {d.choice(("class", "id"))}="{name}"' + " hidden" * (group != "main" and self.chance(0.05))
        kind = d.random()
        if tag == "div" or kind < 0.4:
            return f"<div{named}>{inner}</div>"
        return f"<{tag}>{inner}</{tag}>" if kind < 0.7 else f"<{tag}{named}>{inner}</{tag}>"

    def text(self, long: float) -> str:
        return entities.escape(self.draw.choice(self.prose if self.chance(long) and self.prose else self.short))

    def links(self) -> str:
        items = [f'<a href="#">{self.text(0)}</a>' for _ in range(self.draw.randint(2, 8))]
        if self.chance(0.7):
            return "<ul>" + "".join(f"<li>{x}</li>" for x in items) + "</ul>"
        return " | ".join(items) if self.chance(0.5) else "".join(f"<p>{x}</p>" for x in items)

    def paragraphs(self, long: float, most: int = 3) -> str:
        tag = self.draw.choice(("p", "div", "p"))
        return "".join(f"<{tag}>{self.text(long)}</{tag}>" for _ in range(self.draw.randint(1, most)))

    def heading(self, text: str, levels: str, mark: str = "") -> str:
        level = self.draw.choice(levels)
        return f"<h{level}{mark}>{text}</h{level}>"

    def comment(self) -> str:
        tag, said = self.draw.choice(("div", "li", "article", "section")), self.paragraphs(0.8, 2)
        return f'<{tag} class="{self.draw.choice(("comment", "reply", "comment-body"))}">{said}</{tag}>'

    def comments(self) -> str:
        head = self.heading(self.text(0), "234") if self.chance(0.5) else ""
        return self.wrap("section" if self.chance(0.5) else "div", "comment", head + "".join(
            self.comment() if self.chance(0.6) else self.paragraphs(0.8, 2) for _ in range(self.draw.randint(1, 4))))

    def form(self) -> str:
        inner = f"<label>{self.text(0.2)}</label><input name=q>" + ("<button>Go</button>" if self.chance(0.7) else "")
        return f"<form>{inner}</form>" if self.chance(0.6) else self.wrap("form", "form", inner)

    def advert(self) -> str:
        return self.wrap("div", "advert", self.text(0.4) if self.chance(0.6) else self.paragraphs(0.4, 2))

    def side(self) -> str:
        return self.wrap("aside", "side", self.links() if self.chance(0.5) else self.paragraphs(0.5))

    def notice(self) -> str:
        return self.wrap("dialog" if self.chance(0.2) else "div", "notice", self.paragraphs(0.5, 2))

    def main_block(self, text: str, heading: bool) -> str:
        text, d = entities.escape(text), self.draw
        if heading:
            return self.heading(text, "1123", " data-main")
        kind = d.random()
        if kind < 0.75:
            return f"<p data-main>{text}</p>"
        if kind < 0.82:
            return f"<ul><li data-main>{text}</li></ul>"
        if kind < 0.88:
            return f"<blockquote><p data-main>{text}</p></blockquote>"
        return f"<div data-main>{text}</div>" if kind < 0.96 else f"<table><tr><td data-main>{text}</td></tr></table>"

    def page(self, texts: list[tuple[str, bool]]) -> str:
        """A page with these main texts (text, heading or not)."""
        d, inner = self.draw, []
        clean = self.chance(0.5)
        for text, heading in texts:
            if inner and not heading and self.chance(0.06):
                inner.append(self.heading(self.text(0.1), "234", " data-main"))
            inner.append(self.main_block(text, heading))
            if not clean and self.chance(0.15):
                inner.append(d.choice((self.advert, self.side, self.form, lambda: self.wrap("nav", "menu", self.links()),
                                       lambda: self.wrap("div", "share", self.links()), self.notice))())
        body = "".join(inner)
        if self.chance(0.15):
            body += self.comments()
        kind = d.random()
        if kind < 0.3:
            body = f"<article>{body}</article>"
        elif kind < 0.45:
            body = f"<main>{body}</main>"
        elif kind < 0.75:
            body = self.wrap(d.choice(("div", "section", "article")), "main", body)
        elif kind < 0.9:
            body = f"<div>{body}</div>" if self.chance(0.5) else f"<section>{body}</section>"
        if self.chance(0.25):
            body = f"<main>{body}</main>" if self.chance(0.5) else f"<div id=page>{body}</div>"
        before, after = [], []
        if self.chance(0.5):
            before.append(self.wrap("header", "head", self.text(0) if self.chance(0.5) else
                                    self.heading(self.text(0), "12") + self.paragraphs(0.2, 1)))
        if self.chance(0.8):
            before.append(self.wrap("nav", "menu", self.links()))
        for part, p in ((self.notice, 0.35), (self.advert, 0.5), (self.side, 0.3), (self.form, 0.25)):
            if self.chance(p):
                (before if self.chance(0.6) else after).append(part())
        if self.chance(0.4):
            after.append(self.comments())
        if self.chance(0.8):
            after.append(self.wrap("footer", "foot", ("&copy; " if self.chance(0.7) else "") + self.text(0.4)
                                   if self.chance(0.6) else self.paragraphs(0.3, 2)))
        ending = "</body></html>" if self.chance(0.8) else ""
        return f"<html><body>{''.join(before)}{body}{''.join(after)}{ending}"


class LabelReader(PageReader):
    """Reads pages of ``Layouts``: an element with data-main is a feature."""

    def enter(self, above: tuple, tag: str, attributes: str) -> tuple:
        found = super().enter(above, tag, attributes)
        return (*found, "data-main") if "data-main" in attributes else found

    def labelled(self, page: str) -> tuple[list[Block], list[bool]]:
        blocks = self.blocks(page)
        labels = ["data-main" in b.features for b in blocks]
        for b in blocks:
            b.features = tuple(f for f in b.features if f != "data-main")
        return blocks, labels


def training_pages(pages: list[str], layouts: int = LAYOUTS) -> list[tuple[list[Block], list[bool]]]:
    """Sampled pages labelled by their own markup, and their texts set again."""
    reader, found, mains, prose, short = PageReader(), [], [], [], []
    for page in pages:
        blocks = reader.blocks(page)
        labels = marked(blocks)
        if labels:
            found.append((blocks, labels))
        for b in blocks:
            (prose if b.text.count(" ") >= 7 and 2 * b.linked < len(b.text) else short).append(b.text)
        own = [(b.text, b.leaf[:1] == "h" and b.leaf[1:].isdigit()) for k, b in enumerate(blocks)
               if (labels[k] if labels else b.text.count(" ") >= 7 and 2 * b.linked < len(b.text))]
        if own:
            mains.append(own)
    draw, again = Layouts(prose, short), LabelReader()
    for own in mains:
        for _ in range(layouts):
            found.append(again.labelled(draw.page(own)))
    return found


def train(pages: DataFrame, id_column: str = "page_id", most: int = TRAIN_PAGES) -> Field:
    """The field fitted on a bounded sample of the pages."""
    key = F.xxhash64(F.lit(SEED), F.col(id_column).cast("string"), F.col("html"))
    low = pages.select("html", key.alias("key")).filter(F.length("html").between(1, TRAIN_CHARS))
    # hashes below this hold about four times the sample, so tasks send few rows more
    total = pages.count()
    if total > 4 * most:
        low = low.filter(F.col("key") < (4 * most << 64) // total - (1 << 63))
    sample = low.orderBy("key", "html").limit(most)
    return fit(training_pages([r["html"] for r in sample.collect()]))


def main_text(reader: PageReader, model: Field, page: str | None) -> str:
    blocks = reader.blocks(page)
    return "\n".join(b.text for b, kept in zip(blocks, model.decode(blocks)) if kept)


def extract(html: Column, model: Field, spark) -> Column:
    """The main text of every page of a column."""
    shared = Shared(spark, model)

    def texts(batches):
        reader = PageReader()
        for pages in batches:
            yield pa.array([main_text(reader, shared.value, p) for p in pages.to_pylist()], pa.string())

    from collections.abc import Iterator

    texts.__annotations__ = {"batches": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(texts, "string")(html)


def main_texts(pages: DataFrame, id_column: str = "page_id") -> DataFrame:
    """id, url, text, n_chars of every page."""
    found = pages.select(id_column, "url", extract(F.col("html"), train(pages, id_column), pages.sparkSession).alias("text"))
    return found.withColumn("n_chars", F.length("text").cast("bigint"))

"""Main text of web pages by a tree-structured graphical model.

Every block element of the DOM is a variable: content or not.  Its evidence is
the words of its class, id and role, the length of its own text and the share
of it that is linked; siblings of one tag are alike, so together they weigh as
much as ``ALIKE`` of them for their parent, but each block's own verdict has
all of its evidence.  Parent and child are tied by a potential that
depends on their tags.  Sum-product messages go up the tree and down again, which gives each block's
exact marginal; text of blocks over one half is the page's main text.

``labelled_pages`` writes pages of many layouts with a label on every block
(``data-y``); ``fit`` counts evidence and parent-child pairs over labelled
pages with Spark and keeps a table bounded by the vocabulary of the layouts.
Extraction is row by row: no shuffle, no hot key.

Defined results: a null or empty page has an empty text; a page without any
content block gives an empty text; broken markup is read tolerantly and
unfinished tags at the end are dropped; repeated rows give equal results; long
pages are whole; extra columns are not read.
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from vigil.llm.common import batches_of, ship
from vigil.llm.dom import Page, read

SMOOTH = 0.5
ALIKE = 4
PAGES = 3000
_NAME = re.compile(r"[A-Za-z][a-z]+|[A-Z]+(?![a-z])")


def evidence(page: Page, i: int) -> list[str]:
    """Features of block i."""
    attrs, out = page.attrs[i], []
    names = " ".join(attrs[k] for k in ("class", "id", "role") if k in attrs)
    if names:
        out += {f"name:{w.lower()}" for w in _NAME.findall(names)}
    n = page.chars[i]
    if n:
        share = page.linked[i] / n
        out.append("size:" + ("s" if n < 25 else "m" if n < 80 else "l" if n < 250 else "xl"))
        out.append("links:" + ("none" if share == 0 else "few" if share < 0.4 else "many" if share < 0.8 else "all"))
    return out


@dataclass(frozen=True)
class Model:
    """``odds``: likelihood ratio of content by feature; ``edges``: P(content | parent's state) by "state tag parent's
    tag", with "state tag" and "state" behind it; ``root``: odds of the page itself."""

    odds: dict[str, float]
    edges: dict[str, float]
    root: float = 1000.0

    def edge(self, state: int, tag: str, above: str) -> float:
        e = self.edges
        for k in (f"{state} {tag} {above}", f"{state} {tag}", f"{state}"):
            if k in e:
                return e[k]
        return 0.9 if state else 0.1


def marginals(page: Page, model: Model, whole: bool = False) -> list[float]:
    """Probability of content for each block, by messages up and down the tree; all messages are ratios.  With ``whole``
    a block's own belief, and what it tells its children, has its evidence without tempering."""
    n, tag, parent = len(page.tag), page.tag, page.parent
    up, sent, hh, lh, rest_of = [1.0] * n, [1.0] * n, [0.0] * n, [0.0] * n, [1.0] * n
    alike: dict[tuple[int, str], int] = {}
    for i in range(n):
        k = (parent[i], tag[i])
        alike[k] = alike.get(k, 0) + 1
    for i in range(n):
        for f in evidence(page, i):
            up[i] *= model.odds.get(f, 1.0)
        many = alike[parent[i], tag[i]]
        if many > ALIKE:
            own = up[i]
            up[i] **= ALIKE / many
            if whole:
                rest_of[i] = own / up[i]
    for i in range(n - 1, 0, -1):  # children come after their parents
        above = tag[parent[i]]
        hh[i], lh[i] = model.edge(1, tag[i], above), model.edge(0, tag[i], above)
        o = min(max(up[i], 1e-30), 1e30)
        up[i] = o
        sent[i] = (1 - hh[i] + hh[i] * o) / (1 - lh[i] + lh[i] * o)
        up[parent[i]] *= sent[i]
    belief = [0.0] * n
    belief[0] = min(max(up[0] * model.root, 1e-30), 1e30)
    for i in range(1, n):
        rest = belief[parent[i]] / sent[i]
        down = (lh[i] + hh[i] * rest) / (1 - lh[i] + (1 - hh[i]) * rest)
        belief[i] = min(max(up[i] * down * rest_of[i], 1e-30), 1e30)
    return [b / (1 + b) for b in belief]


def main_text(html: str | None, model: Model) -> str:
    if not html:
        return ""
    page = read(html)
    p = marginals(page, model, whole=True)
    return "\n".join(t for node, t in page.runs if p[node] >= 0.5)


# -- labelled pages --------------------------------------------------------------------------

#: Class and id words of layouts (fixed values).
NAMES = {
    "content": "content post entry article story body text main page single hentry prose blog news detail".split(),
    "nav": "nav navigation menu navbar breadcrumb breadcrumbs pagination pager tabs links toc skip".split(),
    "header": "header masthead top topbar banner logo brand site".split(),
    "footer": "footer foot bottom copyright colophon legal credits".split(),
    "aside": "sidebar aside widget related recommended popular trending archive categories tags rail".split(),
    "ad": "ad ads advert advertisement sponsor sponsored promo promotion dfp adsense commercial".split(),
    "notice": "notice cookie consent gdpr alert popup modal overlay message disclaimer privacy".split(),
    "form": "form search newsletter subscribe signup login register contact".split(),
    "share": "share social sharing follow toolbar tools actions meta byline author date".split(),
    "comments": "comments comment respond reply replies discussion disqus thread feedback reader".split(),
}


def labelled_page(seed: int) -> str:
    """A page of a random layout whose blocks carry data-y: 1 content, 0 not."""
    r = random.Random(seed)
    syllables = "an be co da el fi go ha in jo ka le mi no or pa re sa ti un ve wo".split()

    def words(lo: int, hi: int) -> str:
        ws = ["".join(r.choices(syllables, k=r.randint(1, 4))) for _ in range(r.randint(lo, hi))]
        return " ".join(ws).capitalize() + r.choice([".", ".", "", "?"])

    def attr(kind: str, chance: float) -> str:
        if r.random() > chance:
            return ""
        ws = r.sample(NAMES[kind], r.choice([1, 1, 2]))
        return f' {r.choice(["class", "class", "id"])}="{r.choice(["-", " ", "_"]).join(ws)}"'

    def link(lo: int = 1, hi: int = 3) -> str:
        return f'<a href="/{r.random()}">{words(lo, hi)}</a>'

    def tag(name: str, y: int, inner: str, extra: str = "") -> str:
        return f'<{name}{extra} data-y="{y}">{inner}</{name}>'

    def items(y: int, k: int, inner) -> str:
        return tag(r.choice(["ul", "ul", "ol"]), y, "".join(tag("li", y, inner()) for _ in range(k)))

    def paragraph() -> str:
        t = words(4, r.choice([15, 40, 120]))
        if r.random() < 0.3:
            t = f"{t} {link(1, 5)} {words(3, 30)}"
        if r.random() < 0.2:
            t = f"<b>{t}</b>" if r.random() < 0.5 else f"<em>{words(1, 4)}</em> {t}<br>{words(2, 9)}"
        return tag("p", 1, t)

    def content() -> str:
        parts = [tag(r.choice(["h1", "h1", "h2"]), 1, words(2, 14))] if r.random() < 0.9 else []
        for _ in range(r.randint(1, 9)):
            x = r.random()
            if x < 0.7:
                parts.append(paragraph())
            elif x < 0.78:
                parts.append(tag(r.choice(["h2", "h3", "h4"]), 1, words(1, 8)))
            elif x < 0.85:
                parts.append(items(1, r.randint(2, 6), lambda: words(2, 20)))
            elif x < 0.89:
                parts.append(tag("blockquote", 1, paragraph()))
            elif x < 0.92:
                parts.append(tag("pre", 1, words(5, 30)))
            elif x < 0.95:
                parts.append(tag("figure", 1, '<img src="x">' + tag("figcaption", 1, words(3, 15))))
            else:
                row = lambda c: tag("tr", 1, "".join(tag(c, 1, words(1, 5)) for _ in range(3)))
                parts.append(tag("table", 1, row("th") + row("td") + row("td")))
        if r.random() < 0.15:
            parts.insert(min(1, len(parts)), tag(r.choice(["p", "p", "div", "ul"]), 0, r.choice([words(1, 6), link(1, 2)]), attr("share", 1)))
        for _ in range(r.choice([0, 0, 0, 1, 2])):  # foreign blocks inside the article
            parts.insert(r.randint(0, len(parts)), r.choice([advert, share, aside, form, notice, nav])())
        for foreign in (comments, footer, form, aside):
            if r.random() < 0.08:
                parts.append(foreign())
        if r.random() < 0.15:
            parts[0:1] = [tag("header", 1, parts[0] + (share() if r.random() < 0.5 else ""))]
        if r.random() < 0.3:
            return "".join(parts)
        return tag("div", 1, "".join(parts), attr("content", 0.6)) if r.random() < 0.3 else tag(
            "section", 1, "".join(parts), attr("content", 0.4)) if r.random() < 0.2 else "".join(parts)

    def article() -> str:
        x, inner = r.random(), content()
        if x < 0.45:
            return tag("article", 1, inner, attr("content", 0.4))
        if x < 0.6:
            return tag("main", 1, inner, attr("content", 0.4))
        if x < 0.75:
            beside = [f() for f in (nav, header, aside, advert, comments, share, form, notice, footer) if r.random() < 0.15]
            beside.insert(r.randint(0, len(beside)), tag(r.choice(["article", "article", "div", "section"]), 1, inner, attr("content", 0.5)))
            return tag("main", 1, "".join(beside), attr("content", 0.3))
        return tag("div", 1, inner, attr("content", 0.9))

    def nav() -> str:
        inner = items(0, r.randint(2, 9), link) if r.random() < 0.7 else " | ".join(link() for _ in range(r.randint(2, 7)))
        return tag("nav", 0, inner, attr("nav", 0.4)) if r.random() < 0.6 else tag("div", 0, inner, attr("nav", 0.9))

    def header() -> str:
        inner = r.choice([words(1, 5), link(1, 4), tag("h1", 0, link(1, 3)), tag("p", 0, words(2, 10))])
        inner += nav() if r.random() < 0.4 else ""
        return tag("header", 0, inner, attr("header", 0.4)) if r.random() < 0.6 else tag("div", 0, inner, attr("header", 0.95))

    def footer() -> str:
        inner = "&copy; " + words(2, 25) + (" " + link() if r.random() < 0.5 else "")
        inner = tag("p", 0, inner) if r.random() < 0.4 else inner
        inner += nav() if r.random() < 0.2 else ""
        return tag("footer", 0, inner, attr("footer", 0.4)) if r.random() < 0.65 else tag("div", 0, inner, attr("footer", 0.95))

    def aside() -> str:
        inner = (tag("h3", 0, words(1, 4)) if r.random() < 0.6 else "") + r.choice(
            [items(0, r.randint(2, 6), lambda: link(2, 9)), tag("p", 0, words(4, 40)), tag("div", 0, words(3, 30))])
        return tag("aside", 0, inner, attr("aside", 0.5)) if r.random() < 0.55 else tag("div", 0, inner, attr("aside", 0.97))

    def advert() -> str:
        inner = r.choice([words(2, 25), link(2, 10), tag("p", 0, words(3, 30))])
        return tag(r.choice(["div", "div", "section", "aside"]), 0, inner, attr("ad", 1))

    def notice() -> str:
        inner = r.choice([words(4, 40), tag("p", 0, words(4, 40)), tag("p", 0, words(4, 30)) + "<button>ok</button>"])
        return tag(r.choice(["div", "div", "section", "aside", "dialog"]), 0, inner, attr("notice", 1))

    def share() -> str:
        inner = r.choice([" ".join(link(1, 1) for _ in range(3)), items(0, 3, lambda: link(1, 1)), words(2, 8)])
        return tag("div", 0, inner, attr("share", 1))

    def form() -> str:
        inner = r.choice(["", tag("p", 0, words(2, 15))]) + f"<label>{words(1, 3)}</label><input><button>go</button>"
        f = tag("form", 0, inner, attr("form", 0.6))
        return tag("div", 0, f, attr("form", 0.8)) if r.random() < 0.4 else f

    def comments() -> str:
        one = lambda: tag(r.choice(["div", "li", "article"]), 0, (tag("p", 0, words(1, 3)) if r.random() < 0.4 else "")
                          + tag("p", 0, words(4, 70)), attr("comments", 0.8))
        inner = (tag("h3", 0, words(1, 3)) if r.random() < 0.7 else "") + "".join(one() for _ in range(r.randint(1, 6)))
        return tag(r.choice(["section", "div", "div"]), 0, inner + (form() if r.random() < 0.4 else ""), attr("comments", 1))

    before = [f() for f in (header, nav, notice, advert, aside, form) if r.random() < 0.45]
    after = [f() for f in (aside, advert, share, comments, form, notice, nav) if r.random() < 0.35] + (
        [footer()] if r.random() < 0.85 else [])
    r.shuffle(before)
    middle = article() + "".join(after[:1] if r.random() < 0.5 else [])
    rest = after[1:] if len(middle) and r.random() < 0.5 and after else after
    if r.random() < 0.35:
        middle = tag("div", 1, middle, r.choice(["", ' class="wrapper"', ' id="container"', ' class="row"']))
    inner = f'{"".join(before)}{middle}{"".join(rest)}'
    if r.random() < 0.1:  # a fragment without a frame
        return inner
    return f'<html data-y="1"><body data-y="1">{inner}</body></html>'


def labelled_pages(spark: SparkSession, n: int = PAGES) -> DataFrame:
    """n labelled pages: html."""
    ship(spark)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            yield pa.RecordBatch.from_arrays([pa.array([labelled_page(s) for s in batch.column(0).to_pylist()])], names=["html"])

    return spark.range(0, n, 1, 8).mapInArrow(run, "html string")


def observed(html: str) -> Iterator[tuple[str, int]]:
    """(what, label) of all blocks of a labelled page."""
    page = read(html)
    ys = [1] * len(page.tag)
    for i in range(1, len(ys)):
        above = page.parent[i]
        ys[i] = y = int(page.attrs[i].get("data-y", ys[above]))
        state, tag = ys[above], page.tag[i]
        for f in (*evidence(page, i), "block", f"edge {state}", f"edge {state} {tag}", f"edge {state} {tag} {page.tag[above]}"):
            yield f, y
        if page.chars[i]:
            yield "text", y


def from_counts(counts: dict[str, list[float]]) -> Model:
    """Model of {what: [blocks that are not content, blocks that are]}."""
    block, text = counts.get("block", [0.0, 0.0]), counts.get("text", [0.0, 0.0])
    odds = {}
    for f, (n0, n1) in counts.items():
        if f.startswith(("name:", "size:", "links:")):
            d0, d1 = block if f.startswith("name:") else text
            odds[f] = ((n1 + SMOOTH) / (d1 + 1)) / ((n0 + SMOOTH) / (d0 + 1))
    edges: dict[str, float] = {}
    for k in sorted((f[5:] for f in counts if f.startswith("edge ")), key=lambda k: k.count(" ")):
        n0, n1 = counts[f"edge {k}"]
        behind = edges.get(k.rpartition(" ")[0], 0.5)
        lo, hi = (0.005, 0.999) if k[0] == "1" else (0.0002, 0.2)  # no potential rules a state out
        edges[k] = min(hi, max(lo, (n1 + 2 * behind) / (n0 + n1 + 2)))
    return Model(odds, edges)


def fit(labelled: DataFrame) -> Model:
    """Model from labelled pages (``html`` with data-y on blocks)."""
    ship(labelled.sparkSession)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            pairs = [x for html in batch.column(0).to_pylist() for x in observed(html or "")]
            yield pa.RecordBatch.from_arrays([pa.array([f for f, _ in pairs], pa.string()),
                                              pa.array([y for _, y in pairs], pa.int32())], names=["f", "y"])

    counts: dict[str, list[float]] = {}
    for row in labelled.select("html").mapInArrow(run, "f string, y int").groupBy("f", "y").count().collect():
        counts.setdefault(row["f"], [0.0, 0.0])[row["y"]] = float(row["count"])
    return from_counts(counts)


def extract(pages: DataFrame, model: Model) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    spark = pages.sparkSession
    ship(spark)
    shared = spark.sparkContext.broadcast(model)

    def run(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in it:
            for part in batches_of(batch, "html"):
                texts = [main_text(h, shared.value) for h in part.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return pages.selectExpr("cast(page_id as long) page_id", "cast(url as string) url", "cast(html as string) html").mapInArrow(
        run, "page_id long, url string, text string, n_chars long")

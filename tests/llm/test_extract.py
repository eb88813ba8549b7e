import itertools
import math

import pytest

from vigil.llm.dom import read
from vigil.llm.extract import ALIKE, evidence, extract, fit, from_counts, labelled_page, labelled_pages, main_text, marginals, observed


@pytest.fixture(scope="module")
def model():
    counts = {}
    for seed in range(1500):
        for what, y in observed(labelled_page(seed)):
            counts.setdefault(what, [0.0, 0.0])[y] += 1
    return from_counts(counts)


def brute_marginals(page, m):
    """Sums over all labellings."""
    n, total, one = len(page.tag), 0.0, [0.0] * len(page.tag)
    same = {}
    for i in range(n):
        same[page.parent[i], page.tag[i]] = same.get((page.parent[i], page.tag[i]), 0) + 1
    for ys in itertools.product((0, 1), repeat=n):
        p = (m.root if ys[0] else 1.0)
        for i in range(n):
            if ys[i]:
                w = min(1.0, ALIKE / same[page.parent[i], page.tag[i]])
                p *= math.prod(m.odds.get(f, 1.0) for f in evidence(page, i)) ** w
            if i:
                e = m.edge(ys[page.parent[i]], page.tag[i], page.tag[page.parent[i]])
                p *= e if ys[i] else 1 - e
        total += p
        for i, y in enumerate(ys):
            one[i] += p * y
    return [x / total for x in one]


@pytest.mark.parametrize("html", [
    "<div class=ad>x</div><p>text of a page</p>",
    "<body><nav><a href=x>a</a></nav><article><h1>T</h1><p>a</p><p>b</p></article><footer>f</footer></body>",
    "<ul><li>1<li>2<li>3<li>4<li>5<li>6</ul>",
])
def test_sum_product_equals_enumeration(model, html):
    page = read(html)
    assert marginals(page, model) == pytest.approx(brute_marginals(page, model), rel=1e-6)


def test_held_out_layouts(model):
    right = total = 0
    for seed in range(50_000, 50_300):
        page = read(labelled_page(seed))
        ys = [1] * len(page.tag)
        for i in range(1, len(ys)):
            ys[i] = int(page.attrs[i].get("data-y", ys[page.parent[i]]))
        p = marginals(page, model)
        for node, _ in page.runs:
            total += 1
            right += (p[node] >= 0.5) == bool(ys[node])
    assert right / total > 0.98


def test_article_without_its_surroundings(model):
    html = """<!DOCTYPE html><html><head><title>t</title><script>var x="<p>no</p>";</script><style>p{}</style></head><body>
    <header class="site"><a href="/">Home</a></header><nav><ul><li><a href=1>A</a></li><li><a href=2>B</a></li></ul></nav>
    <div class="cookie-notice">We use cookies, is that fine with you?</div><!-- <p>comment</p> -->
    <article><h1>The&nbsp;title &amp; more</h1><p>First   <b>bold</b>
    text<br>after a break.</p><div class="ad">Buy this now</div><p>Second <a href=x>link</a> text &lt;ok&gt; &am</p></article>
    <section id="comments"><div class="comment"><p>A reader says a lot of things here, more than enough.</p></div></section>
    <form><p>Subscribe to our newsletter</p><input></form><aside class="sidebar"><ul><li><a href=3>Other</a></li></ul></aside>
    <footer>&copy; nobody</footer></body></html>"""
    assert main_text(html, model) == "The title & more\nFirst bold text after a break.\nSecond link text <ok> &am"


@pytest.mark.parametrize("html, runs", [
    ("<p>a<p>b", ["a", "b"]), ("x<b>y</b>z", ["xyz"]), ("<p>a</div></p>b", ["a", "b"]), ("a<br>b", ["a b"]),
    ("<p>a<b>b<p>c</p>d", ["ab", "c", "d"]), ("<table><tr><td>1<td>2<tr><td>3</table>", ["1", "2", "3"]),
    ("<div hidden>no</div>yes", ["yes"]), ("<p title='a>b'>x</p>", ["x"]), ("<script>a</b>", []), ("<p>a</p", ["a"]),
    ("a < b &lt; c", ["a < b < c"]), ("<textarea><p>no</textarea><p>yes", ["yes"]), ("", []), ("<", ["<"]),
])
def test_reader(html, runs):
    assert [t for _, t in read(html).runs] == runs


def test_pages_table(spark, sf):
    m = fit(labelled_pages(spark, 400))
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    rows = {r.page_id: r for r in extract(pages, m).collect()}
    for p in pages.collect():
        inside = read(p.html[p.html.index("<article"):p.html.index("</article>")])
        want = "\n".join(t for _, t in inside.runs)
        assert (rows[p.page_id].text, rows[p.page_id].n_chars) == (want, len(want))


def test_odd_pages(spark, model):
    long = "<article>" + "<p>Some words of a long page.</p>" * 20_000 + "</article>"
    rows = [(1, "u", None), (2, None, ""), (None, "u", "<p>text"), (4, "u", long), (4, "u", long), (5, "u", "\x00<p>\x00a")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' as text", "1 as n_chars")
    out = extract(df, model)
    assert out.columns == ["page_id", "url", "text", "n_chars"]
    got = sorted((r.page_id or 0, r.n_chars) for r in out.collect())
    assert len(got) == 6 and (1, 0) in got and (2, 0) in got and got.count((4, len("Some words of a long page.\n") * 20_000 - 1)) == 2
    assert extract(df.limit(0), model).count() == 0


@pytest.mark.parametrize("n", [3, 12, 200])
def test_verdicts_do_not_change_with_the_number_of_siblings(model, n):
    text = "Some words of a long page that are told to the reader in a sentence of their own."
    for tag in ("p", "div"):
        block = f"<{tag}>{text}</{tag}>"
        for name in ("ad", "promo", "newsletter"):
            page = f"<body><article>{block * n}<{tag} class={name}>Buy this now</{tag}>{block * n}</article></body>"
            assert main_text(page, model) == "\n".join([text] * 2 * n), (tag, name)

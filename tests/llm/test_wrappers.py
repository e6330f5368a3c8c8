"""HTML extraction: wrappers from pages with known main texts."""

from __future__ import annotations

import json
import random
import time

import pytest

from lethe.llm import wrappers
from lethe.llm.queries import QUERIES

SCHEMA = "page_id long, url string, html string"


def alone(page):
    return wrappers.extract(page, wrappers.labels_of(wrappers.wrapper_of(page)))


def expression(*pages):
    root = wrappers.wrapper_of(pages[0])
    for page in pages[1:]:
        wrappers._add(root, wrappers.wrapper_of(page))
    return root.expression()


@pytest.mark.parametrize(("pages", "found"), [
    (["<p>a</p>", "<p>a</p>"], "<p>=</>"),
    (["<p>a</p>", "<p>b</p>"], "<p>#</>"),
    (["<h1>t</h1><p>a</p>", "<p>a</p>"], "<h1>=</>? <p>=</>"),
    (["<p>a</p>", "<p>a</p><div>x</div>"], "<p>=</> <div>=</>?"),
    (["<ul><li>a<li>b</ul>", "<ul><li>c</ul>"], "<ul>(<li>#</>)+</>"),
    (["<p>a</p><div>b</div><p>c</p>", "<p>a</p>"], "(<p>#</> <div>=</>?)+"),
    (["<p>a</p><div>b</div>", "<div>b</div><p>a</p>"], "(<p>=</> <div>=</>)+"),
    (["<div class='ad n12'>x</div>", "<div class=ad>y</div>"], "<div.ad>#</>"),
])
def test_wrappers(pages, found):
    assert expression(*pages) == found


def test_order_of_pages_does_not_change_labels():
    rng = random.Random(3)
    pages = [page(rng, k)[0] for k in range(12)]
    found = set()
    for _ in range(6):
        rng.shuffle(pages)
        root = wrappers.wrapper_of(pages[0])
        for other in pages[1:]:
            wrappers._add(root, wrappers.wrapper_of(other))
        found.add(json.dumps(wrappers.labels_of(root), sort_keys=True))
    assert len(found) == 1


@pytest.mark.parametrize(("page", "text"), [
    ("", ""), ("plain &lt;b&gt; text", "plain <b> text"), ("a < b <", "a < b <"),
    ("<article><h1>T</h1><p>one<p>two <b>bold</b>&nbsp;&amp;&#233;\n\t x</article>after", "T\none\ntwo bold &é x"),
    ("<article><p>a<br>b</p><ul><li>1<li>2</ul><table><tr><td>x<td>y</table></article>", "a b\n1\n2\nx\ny"),
    ("<article><header>h</header><nav>n</nav><p>t</p><aside>s</aside><form>f</form><footer>f</footer></article>", "t"),
    ("<article><p>t</p><div class='ad'>x</div><div id=comments>c</div><section class='related-posts'>r</section></article>", "t"),
    ("<article class='post no-comments has-sidebar'><p>t</p><div role=alert>x</div></article>", "t"),
    ("<div class=cookie-notice>c</div><main><p>t</p></main><p>o</p>", "t"),
    ("<p>x</p><div class=entry-content>t<!-- c --> u</div>", "t u"),
    ("<article><p>t<script>var x='</p><p>no';</script>u<style>p{}</style></article>", "t\nu"),
    ("<article><p title='a>b'>t</p><p class=it's>u</p><p>v <a href=\"x", "t\nu\nv"),
    ("<article><p>a&amp b &am &unknown; &copy;</article><script>", "a& b &am &unknown; ©"),
    ("<ARTICLE><P>t</P></ARTICLE>", "t"), ("<article>x</article><p>y</p><article>z</article>", "x\nz"),
    ("<p>x <!-- never closed", "x"), ("</p></div>t", "t"), ("<article></article><p>x</p>", "x"),
])
def test_pages_alone(page, text):
    assert alone(page) == text


@pytest.mark.parametrize("page", [
    "<div>" * 20000 + "x", "<p>x" * 20000, "<a =\"><" * 20000, "</div>" * 20000, "<ul>" + "<li><p>" * 20000, "<!--" * 20000,
    "<li><ul>" + "<div>" * 20000 + "</li>" * 20000, "<div>" * 20000 + "</p>" * 20000, "<" * 20000, "&" * 20000, "<a " * 20000,
])
def test_broken_pages_take_linear_time(page):
    began = time.time()
    assert alone(page) is not None
    assert time.time() - began < 5


def test_deep_menus_stay_out():
    assert alone("<div>" * 300 + "<nav>no</nav>yes" + "</div>" * 300 + "end") == "yes\nend"


def page(rng, k, article=True):
    word = lambda n: " ".join(f"w{rng.randrange(1000)}" for _ in range(n))
    blocks = [word(rng.randrange(3, 40)) for _ in range(rng.randrange(1, 9))]
    body = "".join(f"<p>{b}</p>" for b in blocks)
    menu = "".join(f"<li><a href=/{k}>{word(2)}</a></li>" for _ in range(rng.randrange(2, 7)))
    ad = f"<div class='ad'>{word(9)}</div>" if rng.random() < 0.5 else ""
    main = f"<article><h1>T{k}</h1>{body}</article>" if article else f"<div class=body><h2>T{k}</h2>{body}</div>"
    more = "" if article else "<p>Read our terms before you copy</p><div class=links><a href=x>" + word(8) + "</a></div>"
    html = f"<html><head><title>{word(4)}</title></head><body><nav><ul>{menu}</ul></nav>{ad}{main}{more}<footer>{word(3)}</footer></body></html>"
    return html, "\n".join([f"T{k}", *blocks])


def test_hosts_without_article_need_the_wrapper(spark):
    """Constants and link lists of a host are left out where no tag says what is the article."""
    rng = random.Random(8)
    rows, texts = [], {}
    for k in range(40):
        html, texts[k] = page(rng, k, article=k % 2 == 0)
        rows.append((k, f"http://{'a' if k % 2 == 0 else 'B'}.example.org:80/{k}", html))
    found = wrappers.run(spark.createDataFrame(rows, SCHEMA).repartition(5))
    assert {r["page_id"]: r["text"] for r in found.collect()} == texts


def test_run_edge_cases(spark):
    html = "<article><p>t</p></article>"
    rows = [(1, "http://h/x", html), (1, "http://h/x", html), (None, "http://h/y", None), (2, None, html), (3, "no url", ""), (4, "", "<p>z</p>")]
    found = wrappers.run(spark.createDataFrame([(*r, "k", 7) for r in rows], SCHEMA + ", host string, labels int"))
    assert sorted((tuple(r) for r in found.collect()), key=str) == sorted(
        [(1, "http://h/x", "t", 1), (1, "http://h/x", "t", 1), (None, "http://h/y", "", 0), (2, None, "t", 1), (3, "no url", "", 0), (4, "", "z", 1)], key=str)
    assert wrappers.run(spark.createDataFrame([], SCHEMA)).collect() == []


def test_copies_keep_their_text(spark):
    """Pages that are all the same show no difference, and yet none of their text is taken for a constant."""
    rows = [(k, "http://h/x", "<div><p>one</p><p>two</p></div>") for k in range(9)]
    assert {r["text"] for r in wrappers.run(spark.createDataFrame(rows, SCHEMA)).collect()} == {"one\ntwo"}


def test_many_hosts_and_large_labels(spark, monkeypatch):
    monkeypatch.setattr(wrappers, "HELD_HOSTS", 3)
    monkeypatch.setattr(wrappers, "BROADCAST_BYTES", 10)
    rng = random.Random(4)
    rows, texts = [], {}
    for k in range(60):
        html, texts[k] = page(rng, k)
        rows.append((k, f"http://{'hot' if k % 3 else k}.example.org/{k}", html))
    found = wrappers.run(spark.createDataFrame(rows, SCHEMA).repartition(4))
    assert {r["page_id"]: r["text"] for r in found.collect()} == texts


def test_query(spark, tmp_path):
    spark.createDataFrame([(1, "http://h/x", "<article>a&#x20AC;😀</article>")], SCHEMA).write.parquet(f"{tmp_path}/pages.parquet")
    found = QUERIES["op12_wrappers"](spark, str(tmp_path))
    assert found.columns == ["page_id", "url", "text", "n_chars"] and found.collect()[0]["n_chars"] == 3

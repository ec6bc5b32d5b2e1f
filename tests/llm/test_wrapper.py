import itertools
import json
import random
from html import escape

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clipfeat.llm import dom, wrapper

from ..oracle import rows_of, sql_rows

SCHEMA = "page_id long, url string, html string, host string, wrapper string, _host string, text string, slots int"


def pages(spark, rows):
    return spark.createDataFrame([(*r, "h", "w", "x", "t", 1) for r in rows], SCHEMA)


def texts(spark, rows):
    df = pages(spark, rows)
    return {r["page_id"]: r["text"] for r in wrapper.extracted(df, wrapper.induced(df)).collect()}


def alone(html):
    page = dom.parse(html)
    return [page.blocks[k][1] for k in wrapper.main_blocks(page, None)]


def test_one_page():
    html = """<!DOCTYPE html><head><title>t</title><style>p{}</style><script>var a = "<p>no</p>"</script></head><body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=x>Home</a><li>B</ul></nav>
      <div class="cookie-notice">We use cookies</div><main><article id=a><header><h1>Title &amp; more &#233;</h1></header><p><b>one  <i>two</i>&nbsp;three<br>four<p>five <span class="ad">buy</span> six<div class="share">Share</div>
      <ul><li>i<li>j</ul><!-- <p>hidden</p> --><table><tr><td>a<td>b</table><form><input><p>mail</form><section class="comments"><p>nice</p></section><p hidden>no<p>&lt;p&gt; &amp;amp;</article><aside><p>rel</p></aside></main><footer>&copy; x"""
    assert alone(html) == ["Title & more é", "one two three four", "five six", "i", "j", "a", "b", "<p> &amp;"]


def test_headers_and_forms():
    assert alone('<div class="site-header">Site</div><article><div class="article-header"><h1>Title</h1></div><p>text') == ["Title", "text"]
    assert alone('<form><div class="header">Top</div><p>' + "text " * 30 + '</p><div class="menu">m</div></form><form>name <input></form>') == ["text " * 29 + "text"]
    assert alone('<article><p>text</p><form><p>sign up</p></form></article>') == ["text"]


@pytest.mark.parametrize("html", ["", "<", "<p", "hello", "<a <b", "</p></div>", "<script>x", "<!--", "&", "<p>a<table><tr>b", "<svg><p>x", "<b>" * 5000 + "x", "<div>" * 5000 + "x", "<p>" * 5000 + "x", "<a '" * 3000, "<ul><li>" * 3000 + "x"])
def test_any_markup_ends(html):
    got = alone(html)
    assert isinstance(got, list) and ("x" not in html or html == "<script>x" or got == ["x"])


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.characters(blacklist_categories=["Cs"]), min_size=1, max_size=30), min_size=1, max_size=8))
def test_texts_come_back(parts):
    want = [x for x in (" ".join(p.replace("\0", "").split()) for p in parts) if x]
    html = "<html><nav><p>menu</nav><article>" + "".join(f"<p>{escape(p.replace(chr(0), ''))}</p>" for p in parts) + "</article>"
    if not any(0x7F < ord(c) < 0xA0 for p in parts for c in p):
        assert alone(html) == want


def tree(depth, rng):
    return rng.choice("abc") + (f"({','.join(tree(depth - 1, rng) for _ in range(rng.randint(1, 3)))})" if depth and rng.random() < 0.7 else "")


def best(a, b):
    """Pairs of the largest order-keeping match, by trying all choices of children."""
    la, ca, _ = dom.read_skeleton(a)
    lb, cb, _ = dom.read_skeleton(b)

    def w(i, j):
        if la[i] != lb[j]:
            return 0
        x, y = ca[i], cb[j]
        most = 0
        for n in range(min(len(x), len(y)) + 1):
            for p in itertools.combinations(x, n):
                for q in itertools.combinations(y, n):
                    pairs = [w(i, j) for i, j in zip(p, q, strict=True)]
                    most = max(most, sum(pairs) if all(pairs) else 0)
        return 1 + most

    return w(0, 0)


def test_tree_matching():
    rng = random.Random(3)
    for _ in range(150):
        a, b = "r(" + tree(2, rng) + ")", "r(" + tree(2, rng) + ")"
        m = dom.matched(a, b)
        assert sum(k >= 0 for k in m) == best(a, b)
        hit = [k for k in m if k >= 0]
        assert hit == sorted(set(hit))
    assert dom.matched("x(a)", "y(a)") == (-1, -1)


def sentence(rng, n):
    return " ".join(rng.choice(["river", "stone", "light", "garden", "winter", "paper", "voice", "summer"]) + str(rng.randint(0, 999)) for _ in range(n))


def site(n, seed, host="site.example"):
    """Pages without any element or class that says what is what."""
    rng, rows = random.Random(seed), []
    for k in range(n):
        body = [sentence(rng, rng.randint(12, 60)) for _ in range(rng.randint(2, 9))]
        side = "".join(f'<div><a href="/{j}">{sentence(rng, 2)}</a></div>' for j in range(4))
        html = f"<html><body><div><p>All the news of our town since 1901, every day of the week</p></div><div>{side}</div><div><h2>{sentence(rng, 5)}</h2>{''.join(f'<p>{b}</p>' for b in body)}<p>Share this story with your friends</p></div><div><p>Reach us by mail at our office in the old mill, second floor, or call before noon</p></div></body></html>"
        rows.append((k, f"https://{host}/{k}", html, body))
    return rows


def test_wrapper_of_a_host(spark):
    rows = site(12, 1)
    found = texts(spark, [r[:3] for r in rows])
    for k, _, html, body in rows:
        assert found[k].split("\n")[1:] == body
        assert "Share this" in "\n".join(alone(html))  # only the other pages tell


def test_copies_are_no_template(spark):
    rows = site(3, 2, "copies.example")
    many = [r[:3] for r in rows] + [(100 + k, f"https://copies.example/{k}", rows[0][2], ) for k in range(40)]
    near = [(200 + k, f"https://copies.example/n{k}", rows[1][2].replace(rows[1][3][0].split()[0], f"changed{k}", 1)) for k in range(40)]
    found = texts(spark, many + near)
    for k in range(3):
        assert all(b in found[k].split("\n") for b in rows[k][3])
    assert len({found[100 + k] for k in range(40)} | {found[0]}) == 1
    assert all(b in found[200 + k].split("\n") for k in range(40) for b in rows[1][3][1:])


def test_edge_cases(spark):
    rows = [(1, None, "<p>a"), (2, "", None), (3, "http://x/", ""), (None, "http://x/", "<p>b"), (4, "http://x/", "<p>b"), (4, "http://x/", "<p>b"), (2**62 + 1, "HTTP://u@X:8/", "<article>" + "<p>word</p>" * 20_000)]
    df = pages(spark, rows)
    got = sorted(((r["page_id"], r["url"], r["text"]) for r in wrapper.extracted(df, wrapper.induced(df)).collect()), key=repr)
    assert got == sorted([(1, None, "a"), (2, "", ""), (3, "http://x/", ""), (None, "http://x/", "b"), (4, "http://x/", "b"), (4, "http://x/", "b"), (2**62 + 1, "HTTP://u@X:8/", "\n".join(["word"] * 20_000))], key=repr)
    none = pages(spark, [])
    assert wrapper.extracted(none, wrapper.induced(none)).count() == 0


def test_wrappers_in_a_join_or_sent_to_all(spark, monkeypatch):
    rows = [r[:3] for r in site(6, 3) + site(2, 4, "small.example")]
    want = texts(spark, rows)
    monkeypatch.setattr(wrapper, "MOST_BYTES", 0)
    assert texts(spark, rows) == want
    kept = wrapper.induced(pages(spark, rows)).collect()
    assert [r["host"] for r in kept] == ["site.example"] and json.loads(kept[0]["wrapper"])["reference"].startswith("html(")


def test_op13(spark, sf_dir):
    assert rows_of(wrapper.op13_html(spark, sf_dir).toPandas()) == sql_rows(wrapper.SQL, sf_dir)

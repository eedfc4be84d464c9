"""Operator 1 against a brute-force version on well-formed pages, and page by page on what broke before."""

import random
import xml.etree.ElementTree as ET

import numpy as np
import pytest
from pyspark.sql import functions as F

from marketlens.llm import html_main

NONE = np.zeros(0, np.int64)


def read(source, by_name=True):
    return html_main.main_text(source, "h", NONE, by_name)[0]


def test_headings_and_paragraphs_under_telling_names_stay():
    assert read('<article><div class="entry-header"><h1>Title</h1></div><p class="social-history">One</p><p class="banner-story">Two</p>'
                '<div class="share">no</div></article>') == "Title\nOne\nTwo"
    assert read('<body><div class="entry-header"><h1>Title</h1></div><p>Text</p><div class="site-footer">no</div><div class="header"><h1>Site</h1></div>') == \
        "Title\nText"
    assert read('<article class="post"><p>A</p></article><article class="related-post"><p>no</p></article>') == "A"
    assert read('<article class="related-post"><p>no</p></article><main><p>yes</p></main>') == "yes"


def test_references_are_decoded_piece_by_piece():
    assert read("<p>&<i>lt;</i> &amp;lt; &#228;<b>&eacute;</b> a&nbsp;&nbsp; b</p>") == "&lt; &lt; äé a b"


@pytest.mark.parametrize("page", ["<div>" * 100_000 + "x", "<font>" * 100_000 + "x" + "</b>" * 100_000, "<i>" * 100_000 + "<hr>" * 50_000 + "x",
                                  "<p>" + "<i>" * 100_000 + "<li>" * 50_000 + "x", "<article>" + "<b>" * 50_000 + "</p>" * 50_000 + "x",
                                  "<b>" * 50_000 + "<article>" + "<div>" * 50_000 + "</b>" * 50_000 + "x"])
def test_elements_without_end(page):
    assert read(page) == "x"
    html_main.article_identity(html_main.Page(page))


def pages_of(spark, rows):
    return spark.createDataFrame([(i, url, page, 0, "c") for i, (url, page) in enumerate(rows)], "page_id int, url string, html string, text int, host string")


def texts(df, **kw):
    return {r["page_id"]: r["text"] for r in html_main.extract_main_text(df, **kw).collect()}


def test_copies_of_an_article_keep_their_bodies(spark):
    rows = [("http://a.example/" + str(i), f"<html><body><div>menu {i}</div><article><h1>T</h1><div>the whole story</div></article></body></html>") for i in range(9)]
    rows += [("http://b.example/" + str(i), f"<html><head><title>S</title></head><body><div>menu {i}</div><h1>T</h1><div>the whole story is here</div></body></html>")
             for i in range(9)]
    got = texts(pages_of(spark, rows))
    assert all(got[i] == "T\nthe whole story" for i in range(9))
    assert all(got[9 + i] == f"menu {i}\nT\nthe whole story is here" for i in range(9))


def test_counts_decide_without_marks_or_names(spark):
    """No article, no telling name: what recurs on the host goes, and nothing else does."""
    rng = random.Random(1)
    words = lambda k: " ".join(rng.choice(["lorem", "ipsum", "dolor", "sit", "amet", "elit"]) + str(rng.randint(0, 999)) for _ in range(k))
    rows, want = [], []
    for host in ("a", "b", "c"):
        menu = f"<div class='q1'><ul><li>{host} one</li><li>two</li></ul></div>"
        foot = f"<div class='z9'><p>All rights of {host}</p></div>"
        for i in range({"a": 400, "b": 12, "c": 3}[host]):
            body = [words(rng.randint(5, 30)) for _ in range(rng.randint(1, 4))]
            rows.append((f"http://{host}.example/{i}", f"<html><body>{menu}<div class='k'>{''.join(f'<p>{b}</p>' for b in body)}</div>{foot}</body></html>"))
            want.append("\n".join(body if host != "c" else [f"{host} one", "two", *body, f"All rights of {host}"]))    # three pages show no template
    found = html_main.extract_main_text(pages_of(spark, rows).repartition(9), by_name=False).collect()
    assert {r["page_id"]: r["text"] for r in found} == dict(enumerate(want))
    assert all(r["n_named"] == 0 and (r["n_counted"] > 0) == (rows[r["page_id"]][0][7] != "c") for r in found)
    assert texts(pages_of(spark, rows)) == dict(enumerate(want))


def brute_force(rows, min_pages, min_share):
    """Subtrees as strings, counted by host and article; texts of what is left. Pages are well-formed, of div, p and h1."""
    trees = [ET.fromstring(p) for _, p in rows]
    hosts = [u.split("/")[2] for u, _ in rows]

    def shape(e):
        parts = [e.tag, " ".join((e.text or "").split())]
        for c in e:
            parts += [shape(c), " ".join((c.tail or "").split())]
        return str(parts)

    def blocks(e, gone):
        out = [] if shape(e) in gone else [(e.text or "")]
        if shape(e) not in gone:
            for c in e:
                out += blocks(c, gone) + [c.tail or ""]
        return [x for x in (" ".join(b.split()) for b in out) if x]

    def identity(t):
        every = blocks(t, ())
        return (t.findtext(".//h1") or "").strip(), tuple(b for b in every if 2 * len(b) >= max(map(len, every)))

    seen = {}
    for host, t in zip(hosts, trees):
        for e in t.iter():
            if e.tag not in ("html", "body"):
                seen.setdefault((host, shape(e)), set()).add(identity(t))
    template = {k for k, v in seen.items() if len(v) >= min_pages and len(v) >= min_share * hosts.count(k[0])}
    return ["\n".join(blocks(t, {s for h, s in template if h == host})) for host, t in zip(hosts, trees)]


@pytest.mark.parametrize("seed", range(4))
def test_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    fixed = [f"<div><p>fixed {i}</p><div>box {i}</div></div>" for i in range(6)]
    rows = []
    for i in range(120):
        parts = [rng.choice(fixed) for _ in range(rng.randint(0, 4))] + [f"<p>para {rng.randint(0, 60)} {'y' * rng.randint(0, 9)}</p>" for _ in range(rng.randint(0, 3))]
        rng.shuffle(parts)
        rows.append((f"http://h{rng.choice('aab')}.example/{i}", f"<html><body><h1>head {rng.randint(0, 40)}</h1>{''.join(parts)}</body></html>"))
    rows += rows[:3]                                                                         # repeated rows
    got = texts(pages_of(spark, rows), min_pages=3, min_share=0.05, by_name=False)
    assert [got[i] for i in range(len(rows))] == brute_force(rows, 3, 0.05)
    assert texts(pages_of(spark, rows), min_pages=3, min_share=0.05, by_name=False, broadcast_keys=0) == got


def test_long_pages_and_odd_rows(spark):
    long = "<article>" + "<p>word &amp; word</p>" * 60_000 + "</article>"
    df = pages_of(spark, [("http://a/", long), (None, "<p>x</p>"), ("http://a/", None), ("http://a/", ""), ("http://a/", "<p>cut off &am"), ("http://a/", "<p>a<b")])
    got = texts(df)
    assert got[0] == "\n".join(["word & word"] * 60_000) and [got[i] for i in range(1, 6)] == ["x", "", "", "cut off &am", "a"]
    assert html_main.extract_main_text(df.where(F.lit(False))).count() == 0

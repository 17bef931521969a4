import re
from html import unescape

import numpy as np
import pandas as pd
import pytest

from episodic.llm import pages
from llm.helpers import MID, SMALL, WORDS, clashing

SCHEMA = "page_id long, url string, html string"


def texts(df):
    return {r["page_id"]: r["text"] for r in df.collect()}


def shown(html, zones=pages.MAIN):
    return " ".join(" ".join(words) for zone, _, words in pages.blocks(html) if zone in zones)


def words(*parts):
    return [w for p in parts for w in p.split()]


# ---------------------------------------------------------------- markup

@pytest.mark.parametrize("html, want", [
    ("<main>a<p>b &amp; c&lt;d&gt;<br>e</main>", "a b & c<d> e"),
    ("<article>x<b>y</b><!-- no --><i>z</i> \t\n q&nbsp;r &#x41;&#66;</article>", "xyz q r AB"),
    ("<article><p>&amp</p><p>&am</p>&copy 1 &unknown; 1 < 2 & 3 <3</article>", "& &am © 1 &unknown; 1 < 2 & 3 <3"),
    ("<article><script>var t='</p><p>no';</script>a<style>p{}</style><STYLE>q</Style >b</article>", "ab"),
    ("<article>a<nav>menu</nav><aside>side</aside><div class='x advert'>buy</div><header><h1>T</h1></header>b<footer>f</footer></article>", "a T b"),
    ("<article>a<form>name<input value='>'><button>go</button></form><select><option>1</select>b</article>", "a b"),
    ("<article>a</article><section id=comments><article>well said</article></section>", "a"),
    ("<article>a</article><article class='comment'>me too</article>", "a"),
    ('<article class="post" data-x="a>b" title=\'c>d\'>t</article>', "t"),
    ("<article><p><b>a<br><p>b</p></div></article>c", "a b"),
    ("<article>a<!-- open", "a"),
    ("<article>a<script>open", "a"),
    ("<article>a<p title=\"open>b", "a"),
    ("<article>a<?php x ?><!DOCTYPE y>b</article>", "ab"),
    ("<html><head><title>t</title><meta x><body><main>a</main>", "a"),
    ("<form id=page><main>a</main>b</form>", "a"),
    ("", ""), (None, ""), ("<", ""), ("<article>a<", "a<"), ("<article></article>", ""),
])
def test_blocks(html, want):
    assert shown(html) == want


def test_zones_without_article():
    html = ("<body class='has-sidebar'><header>site</header><div id=cookie-notice>we use</div><div role=navigation>go</div>"
            "<div class=content><p>the text</p></div><div class='site-footer'>c</div></body>")
    assert shown(html, pages.OPEN) == "the text"


def test_long_and_broken_pages_take_linear_time():
    for html in ("<" * 300_000, "<a " * 100_000, "<a '" * 100_000, "<!--" * 100_000, "&" * 300_000, "<div>" * 50_000 + "</div>" * 50_000):
        pages.blocks(html)


# ---------------------------------------------------------------- suffix array

def test_suffix_order_is_the_order_by_run_tokens():
    rng = np.random.default_rng(0)
    tokens, lengths = rng.integers(1, 3, 300).astype(np.uint64), np.array([100, 0, 3, 150, 47])
    end = np.repeat(np.cumsum(lengths), lengths)
    order, rank = pages.suffix_order(tokens, lengths)
    keys = [tuple(tokens[i:min(i + pages.RUN, end[i])]) for i in range(300)]
    assert [keys[i] for i in order] == sorted(keys)
    assert all((keys[i] == keys[j]) == (rank[i] == rank[j]) for i in range(300) for j in range(0, 300, 7))


def open_page(paragraphs):
    return "<body>" + "".join(f"<p>{p}</p>" for p in paragraphs) + "</body>"


def plain(rows):
    """Texts of pages without marked zones: every window of every page looked up in all other pages of its host."""
    streams = {}
    for key, (_, url, html) in enumerate(rows):
        s = []
        for _, container, ws in pages.blocks(html):
            s += [("<", container)] + ws
        streams[key] = s
    def grams(s):
        return {tuple(s[i:i + pages.RUN]) for i in range(max(1, len(s) - pages.RUN + 1))} if s else set()
    out = []
    for key, (page_id, url, html) in enumerate(rows):
        seen = set()
        for k, r in enumerate(rows):
            if pages.host_of(r[1]) == pages.host_of(url) and (r[2] or "") != (html or ""):
                seen |= grams(streams[k])
        s = streams[key]
        gone = set()
        for i in range(max(1, len(s) - pages.RUN + 1)):
            if tuple(s[i:i + pages.RUN]) in seen:
                gone |= set(range(i, min(i + pages.RUN, len(s))))
        out.append((page_id, " ".join(w for i, w in enumerate(s) if i not in gone and isinstance(w, str))))
    return sorted(out, key=str)


@pytest.mark.parametrize("limit", [pages.SLICE, 2000])
def test_repeats_against_every_pair_of_pages(spark, limit):
    rng = np.random.default_rng(1)
    def sentence(n):
        return " ".join(rng.choice(WORDS, n))
    shared = [sentence(n) for n in (5, 9, 20, 60)]
    rows = []
    for i in range(150):
        host = "hot" if i % 3 == 0 else f"h{i % 7}"
        rows.append((i, f"https://{host}.example/{i}", open_page([sentence(12), *rng.choice(shared, 2), sentence(30)])))
    rows += [rows[0], (900, rows[0][1], rows[0][2]), (901, None, open_page(shared)), (902, None, open_page(shared[2:])),
             (903, "http://hot.example:80/x", "a b"), (904, "http://hot.example/y", "a b"), (905, "//HOT.example", "<p>a b</p>")]
    got = pages.main_texts(spark.createDataFrame(rows, SCHEMA), limit=limit).collect()
    assert sorted(((r["page_id"], r["text"]) for r in got), key=str) == plain(rows)


def test_only_unmarked_repeats_go_and_articles_stay(spark):
    menu = "home news sport weather travel money health science world local"
    article = "a passage of well over eight words that many pages of this host have in common with others"
    rows = [(i, f"http://h/{i}", f"<div>{menu}</div><div class=ad>ad {i}</div><article><p>{article}</p>{'own ' * i}</article><div>unique {i}</div>")
            for i in range(20)]
    got = texts(pages.extract_pages(clashing(spark.createDataFrame(rows, SCHEMA))))
    assert got == {i: " ".join(words(article, "own " * i, f"unique {i}")) for i in range(20)}


def test_odd_rows(spark):
    long = "<article>" + "word &amp; " * 400_000 + "</article>"
    rows = [(None, None, None), (1, None, ""), (2, "u", None), (3, "http://h/", long), (4, "http://h/", "<article>x</article>"),
            (4, "http://h/", "<article>x</article>"), (5, "nonsense", "no markup at all")]
    out = pages.extract_pages(clashing(spark.createDataFrame(rows, SCHEMA))).collect()
    assert sorted(((r["page_id"], r["n_chars"]) for r in out), key=str) == sorted(
        [(None, 0), (1, 0), (2, 0), (3, 400_000 * 7 - 1), (4, 1), (4, 1), (5, 16)], key=str)
    assert pages.extract_pages(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("folder", [SMALL, MID])
def test_given_pages(spark, folder):
    table = pd.read_parquet(f"{folder}/pages.parquet")
    want = {}
    for r in table.itertuples():
        inner = re.search(r"<article>(.*)</article>", r.html, re.S)[1]
        want[r.page_id] = " ".join(unescape(re.sub(r"</?(?:p|h1|br)>", " ", re.sub(r"</?b>", "", inner))).split())
    assert texts(pages.extract_pages(spark.read.parquet(f"{folder}/pages.parquet"))) == want

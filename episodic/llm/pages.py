"""Main text of web pages: a host's repeated passages found with a suffix array over its pages' token streams.

The markup of a page gives blocks of text in page order and, where it speaks, their zone: MAIN inside ``article`` or
``main``, CHROME inside menus, headers, footers, sidebars, notices, adverts, forms and reader comments that are marked as
such, else OPEN. The tokens of a page's blocks that are not MAIN, with a token for every block's container, are its stream.
The streams of the pages of a host are concatenated and their suffixes sorted; neighbours that come from distinct pages and
share ``RUN`` tokens or more are repeated, and the union of all such runs is the host's boilerplate. What it covers goes;
runs that only one page has stay. CHROME goes also where it is not repeated (a host with one page repeats nothing). MAIN
stays whatever is repeated: copies of an article on one host, or a passage shared by many articles, are no boilerplate; so
its suffixes are not sorted.

Scale: pages are read into slices of about ``SLICE`` bytes. A slice sorts its suffixes, of all its hosts at once (a token is
mixed with its host, so no run is common to two hosts), by prefix doubling to ``RUN`` tokens: a longer repeat is a union of
such windows. It then sends one row for each distinct window to be put together with those of the other slices: a window
that lies on a third of all pages is a row a slice, not a row a page, and is pre-aggregated before its shuffle. The
repeated windows return to their slices, whose packed texts are shuffled once. The pages are scanned twice and cut alike
both times (a slice's name would tell a difference); no host is ever in one task.

Edge cases: a null or empty page has an empty text; pages with the same url host (null: a host of its own) and the same
html are one page, so exact copies repeat nothing; a repeated row gives as many rows; very long pages are slices of their
own; an unclosed comment, tag, script or style takes the rest of the page; other columns are not read; an empty table gives
no rows.
"""

from __future__ import annotations

import html as _html
import json
import re
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from episodic.llm.common import mix64, slices, stored

#: Tokens of a repeated run, block marks included.
RUN = 8
SLICE = 4 << 20

MAIN, OPEN, CHROME, FORM = "m", "o", "c", "f"

# Element names of HTML with a meaning here.
RAW = {"script", "style", "textarea", "title", "iframe", "xmp", "noembed", "noframes", "noscript", "template"}
SKIPPED = {"head", "select", "option", "button", "svg", "math", "object", "audio", "video", "canvas", "map", "datalist"}
HEAD = {"base", "basefont", "bgsound", "link", "meta"}
CONTAINERS = {"article", "aside", "blockquote", "body", "center", "details", "dialog", "div", "dl", "fieldset", "figure", "footer",
              "form", "header", "hgroup", "main", "menu", "nav", "ol", "section", "table", "ul"} | SKIPPED
BLOCKS = CONTAINERS | {"address", "br", "caption", "dd", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "html",
                       "legend", "li", "optgroup", "p", "pre", "summary", "tbody", "td", "tfoot", "th", "thead", "tr"}
CHROME_ELEMENTS = {"aside", "footer", "menu", "nav", "dialog"}
CHROME_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alert", "menu", "menubar", "form"}
# Words of class and id names that mark chrome; the second list counts inside an article too.
CHROME_WORDS = {"header", "masthead", "topbar", "toolbar", "notice", "banner", "login", "search", "widget", "popular"}
CHROME_WORDS_ANYWHERE = {"ad", "ads", "adv", "advert", "advertisement", "adsense", "sponsor", "sponsored", "promo", "promotion",
                         "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "footer", "sidebar", "related",
                         "comment", "comments", "commentlist", "disqus", "reply", "replies", "respond", "cookie", "cookies",
                         "consent", "gdpr", "popup", "modal", "newsletter", "subscribe", "subscription", "social", "share", "sharing"}
COMMENT_WORDS = {"comment", "comments", "commentlist", "reply", "replies"}

_MARK = re.compile(r"<(?:(!--)|(/?)([A-Za-z][^\s/>]*)|([!?/]))")
_REST = re.compile(r"""(?:[^"'>]|"[^"]*"|'[^']*')*+>""")
_NAMES = re.compile(r"""(?<![^\s"'/])(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_PART = re.compile(r"[a-z0-9]+")


def _zone(name: str, attributes: str, zone: str) -> str:
    """Zone of a container that opens inside ``zone``."""
    if zone == CHROME or zone == FORM and name not in ("article", "main"):
        return zone
    words, role = set(), ""
    if "=" in attributes:
        for m in _NAMES.finditer(attributes):
            value = (m[2] or m[3] or m[4] or "").lower()
            if m[1].lower() == "role":
                role = value.strip()
            else:
                words.update(_PART.findall(value))
    if name in ("article", "main"):
        return CHROME if words & COMMENT_WORDS else MAIN
    if name == "form":
        return FORM                                              # some sites wrap their whole page in one
    if name in CHROME_ELEMENTS or name == "header" and zone != MAIN or role in CHROME_ROLES:
        return CHROME
    if name == "body":
        return zone
    if words & CHROME_WORDS_ANYWHERE or zone != MAIN and words & CHROME_WORDS:
        return CHROME
    return MAIN if role in ("main", "article") else zone


def blocks(page: str | None) -> list[tuple[str, str, list[str]]]:
    """(zone, container, words) of every block of text of a page, in page order."""
    out, at, text = [], 0, page or ""
    stack, parts = [("", OPEN)], []

    def flush():
        if parts:
            words = "".join(parts).split()
            if words:
                out.append((stack[-1][1], stack[-1][0], words))
            parts.clear()

    skip = 0                                                     # open containers whose text is never shown
    while True:
        m = _MARK.search(text, at)
        piece = text[at:m.start() if m else len(text)]
        if piece and not skip:
            parts.append(_html.unescape(piece) if "&" in piece else piece)
        if not m:
            break
        if m[1]:
            # a comment ends at the next --> (or at once: <!--> and <!--->)
            end = text.find("-->", m.end() - 2)
            if end < 0:
                break
            at = end + 3
            continue
        if m[4]:
            end = text.find(">", m.end() - 1)
            if end < 0:
                break
            at = end + 1
            continue
        rest = _REST.match(text, m.end())
        if not rest:
            break
        at, name, attributes = rest.end(), m[3].lower(), rest[0][:-1]
        closing, empty = bool(m[2]), attributes.endswith("/")
        if name in RAW and not closing:
            end = re.compile(rf"</{name}(?=[\s/>])", re.I).search(text, at)
            if not end:
                break
            close = text.find(">", end.end())
            if close < 0:
                break
            at = close + 1
            continue
        if stack[-1][0] == "head" and not closing and name not in HEAD:
            stack.pop()                                          # </head> may be left out
            skip -= 1
        if name not in BLOCKS:
            continue
        flush()
        if name not in CONTAINERS:
            continue
        if closing:
            depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
            if depth:
                skip -= sum(s[0] in SKIPPED for s in stack[depth:])
                del stack[depth:]
        elif not (empty and name in SKIPPED):
            stack.append((name, _zone(name, attributes, stack[-1][1])))
            skip += name in SKIPPED
    flush()
    return out


def host_of(url: str | None) -> str:
    m = re.match(r"\s*(?:[A-Za-z][A-Za-z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return m[1].lower() if m else ""


def _token(text: str) -> int:
    return int.from_bytes(blake2b(text.encode("utf-8", "surrogatepass"), digest_size=8).digest(), "little")


def stream(found, host: str) -> np.ndarray:
    """Token hashes of a page's blocks outside MAIN, mixed with the host; every block starts with its container's mark."""
    out = []
    for zone, container, words in found:
        if zone != MAIN:
            out.append(_token("<" + container + ">"))
            out += map(_token, words)
    return mix64(np.array(out, np.uint64) ^ np.uint64(_token("//" + host))) if out else np.empty(0, np.uint64)


def _windows(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Place and page of every window of RUN tokens that lies in one page; a shorter stream has one window, filled up."""
    page = np.repeat(np.arange(len(lengths)), lengths)
    start = np.repeat(np.cumsum(lengths) - lengths, lengths)
    at = np.arange(len(tokens))
    whole = (at - start + RUN <= lengths[page]) | (at == start)
    return at[whole], page[whole]


def suffix_order(tokens: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Suffixes of the concatenated streams, sorted by their first RUN tokens, and the rank of each (equal: RUN tokens shared).

    Prefix doubling: ranks of 1, 2, 4, ... tokens; a suffix ends with its page."""
    n = len(tokens)
    rank = np.unique(tokens, return_inverse=True)[1].astype(np.int64) + 1
    end = np.repeat(np.cumsum(lengths), lengths)
    width = 1
    while width < RUN:
        nxt = np.arange(n) + width
        second = np.where(nxt < end, rank[np.minimum(nxt, n - 1)], 0)
        rank = np.unique(rank * (n + 1) + second, return_inverse=True)[1].astype(np.int64) + 1
        width *= 2
    return np.argsort(rank, kind="stable"), rank


def _names(tokens: np.ndarray, lengths: np.ndarray, places: np.ndarray) -> np.ndarray:
    """128-bit names (as two columns) of the windows at ``places``."""
    end = np.repeat(np.cumsum(lengths), lengths)
    out = np.zeros((len(places), 2), np.uint64)
    with np.errstate(over="ignore"):
        for i in range(RUN):
            p = places + i
            t = np.where(p < end[places], tokens[np.minimum(p, len(tokens) - 1)], np.uint64(0))
            out[:, 0] = mix64(out[:, 0] * np.uint64(0x9E3779B97F4A7C15) + t)
            out[:, 1] = mix64(out[:, 1] * np.uint64(0xC2B2AE3D27D4EB4F) ^ mix64(t + np.uint64(0x1656_67B1)))
    return out.view(np.int64)


def _slices(batches, limit: int):
    """(name, pages, their blocks) of every slice. The name tells partition, place and content, so that two scans of one table agree."""
    partition, n = TaskContext.get().partitionId(), 0
    for batch in batches:
        for part in slices(batch, "html", limit):
            texts = part.column("html").to_pylist()
            seen = blake2b(digest_size=8)
            for text in texts:
                seen.update(f"{len(text or '')} ".encode())
            yield f"{partition}-{n}-{seen.hexdigest()}", part, [blocks(t) for t in texts]
            n += 1


def _streams(found: list, urls: list) -> tuple[np.ndarray, np.ndarray]:
    """The concatenated streams of pages and their lengths."""
    each = [stream(f, host_of(u)) for f, u in zip(found, urls)]
    return (np.concatenate(each) if each else np.empty(0, np.uint64)), np.array([len(s) for s in each], np.int64)


def _windows_of(limit: int):
    """(slice, window name, least and largest content of its pages) for every distinct window of every slice."""

    def run(batches):
        for name, part, found in _slices(batches, limit):
            urls = part.column("url").to_pylist()
            tokens, lengths = _streams(found, urls)
            if not len(tokens):
                continue
            content = np.array([_token(f"{host_of(u)}\n{page or ''}") for u, page in zip(urls, part.column("html").to_pylist())],
                               np.uint64).view(np.int64)
            order, rank = suffix_order(tokens, lengths)
            places, page = _windows(tokens, lengths)
            use = np.full(len(tokens), -1)
            use[places] = page
            order = order[use[order] >= 0]
            own = content[use[order]]
            first = np.flatnonzero(np.concatenate([[True], rank[order][1:] != rank[order][:-1]]))
            names = _names(tokens, lengths, order[first])
            yield pa.RecordBatch.from_arrays(
                [pa.array([name] * len(first)), *(pa.array(x, pa.int64()) for x in (
                    names[:, 0], names[:, 1], np.minimum.reduceat(own, first), np.maximum.reduceat(own, first)))],
                ["slice", "a", "b", "low", "high"])
    return run


def _bodies(limit: int):
    """One row a slice: its pages' ids and urls, and their blocks, packed."""

    def run(batches):
        pack = zstandard.ZstdCompressor(level=3)
        for name, part, found in _slices(batches, limit):
            body = json.dumps([[(zone, box, " ".join(words)) for zone, box, words in f] for f in found], ensure_ascii=False)
            yield pa.RecordBatch.from_arrays(
                [pa.array([name]), pa.array([part.column("id").to_pylist()], pa.list_(pa.int64())),
                 pa.array([part.column("url").to_pylist()], pa.list_(pa.string())),
                 pa.array([pack.compress(body.encode("utf-8", "surrogatepass"))], pa.binary())],
                ["slice", "ids", "urls", "bodies"])
    return run


def _covered(tokens: np.ndarray, lengths: np.ndarray, names: set) -> np.ndarray:
    """Which tokens lie in a window whose name is among ``names``."""
    hit = np.zeros(len(tokens) + RUN + 1, np.int64)
    if len(tokens) and names:
        places, _ = _windows(tokens, lengths)
        name = _names(tokens, lengths, places)
        at = places[[(a, b) in names for a, b in zip(name[:, 0].tolist(), name[:, 1].tolist())]]
        end = np.repeat(np.cumsum(lengths), lengths)
        np.add.at(hit, at, 1)
        np.add.at(hit, np.minimum(at + RUN, end[at]), -1)
    return np.cumsum(hit)[:len(tokens)] > 0


def _texts(pages: pa.Table, repeated: pa.Table) -> pa.Table:
    names = set(zip(repeated.column("a").to_pylist(), repeated.column("b").to_pylist()))
    if not pages.num_rows:
        raise RuntimeError("two scans of the pages gave different slices")
    ids, urls, texts = [], [], []
    for row in pages.to_pylist():
        body = json.loads(zstandard.ZstdDecompressor().decompress(row["bodies"]).decode("utf-8", "surrogatepass"))
        found = [[(zone, box, text.split()) for zone, box, text in f] for f in body]
        gone, at = _covered(*_streams(found, row["urls"]), names), 0
        for f in found:
            kept = []
            for zone, _, words in f:
                if zone == MAIN:
                    kept += words
                    continue
                if zone == OPEN:
                    kept += [w for w, g in zip(words, gone[at + 1:at + 1 + len(words)]) if not g]
                at += 1 + len(words)
            texts.append(" ".join(kept))
        ids += row["ids"]
        urls += row["urls"]
    return pa.table({"id": pa.array(ids, pa.int64()), "url": pa.array(urls, pa.string()), "text": pa.array(texts, pa.string())})


def main_texts(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", limit: int = SLICE) -> DataFrame:
    """(id, url, text) of every page; see the module's text. ``limit`` is the size of a slice in bytes."""
    rows = pages.select(F.col(id_col).cast("long").alias("id"), F.col(url_col).alias("url"), F.col(html_col).alias("html"))
    # windows of a slice are few beside its text; one row each, whatever number of its pages has them
    window = stored(rows.mapInArrow(_windows_of(limit), "slice string, a long, b long, low long, high long"), "pages-windows")
    repeated = window.groupBy("a", "b").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low <> high").select("a", "b")
    hits = window.select("slice", "a", "b").join(repeated, ["a", "b"])
    cut = rows.mapInArrow(_bodies(limit), "slice string, ids array<long>, urls array<string>, bodies binary")
    out = cut.groupBy("slice").cogroup(hits.groupBy("slice")).applyInArrow(_texts, "id long, url string, text string")
    return out.select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text")


def extract_pages(pages: DataFrame) -> DataFrame:
    """page_id, url, text, n_chars of every page."""
    return main_texts(pages).withColumn("n_chars", F.char_length("text").cast("long"))

"""Main text of web pages: the run of tokens with the greatest score.

A page is a sequence of tags and words. Each tag and each word has a weight: the log odds, learned from labelled pages, that a token of its class
belongs to the main text, less for tags than for words. The best run is found in one linear scan over the words and tags in page order; its
blocks are the text. What is never text (scripts, styles, forms, menus and the like inside the run) is left out of the words.
"""

from __future__ import annotations

import html
import math
import re
from collections import Counter
from collections.abc import Iterator
from itertools import accumulate

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Pages of the fit, on average (chosen by a hash of the page), and classes that get a weight of their own: the most frequent ones, by the sums of all tasks.
SAMPLE = 4_000
NAMES = 500

TOKEN = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>", re.S)
RAW = ("script", "style", "textarea", "title", "noscript", "iframe", "template", "svg", "math", "object", "canvas", "select", "button", "option")
RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img"}
# Elements and names that are page furniture wherever they stand.
FURNITURE = {"nav", "footer", "aside", "form", "menu", "dialog", "head"}
NAMED = re.compile(r"ad|ads|advert\w*|banner|sponsor\w*|promo\w*|cookies?|consent|notice|newsletter|subscribe|popup|modal|menu|nav\w*|breadcrumbs?|sidebar|footer|siteheader|masthead|topbar|comments?|disqus|respond|replies|related|share|sharing|social|widget|pagination|pager|search|login|signup|skip\w*|copyright|legal|disclaimer")
# A class of several parts is furniture by its last part (site-footer), or by its first when the last only names a container (share-buttons); never
# when the first part says that something is there or not (has-sidebar), or when it names a state (comments-open).
CONTAINERS = {"area", "bar", "block", "box", "button", "buttons", "container", "content", "form", "group", "inner", "item", "items", "link", "links", "list", "panel", "posts", "section", "slot", "top", "bottom", "unit", "wrap", "wrapper"}
STATES = {"has", "with", "no", "without", "not", "is", "hide", "show", "single"}
ATTRIBUTE = re.compile(r"\b(class|id|role|hidden|aria-hidden|style)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.I)
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "menu", "menubar", "dialog", "alert", "alertdialog", "toolbar"}
MAIN = {"article", "main"}
PARAGRAPH_ENDS = {"p", "li", "ul", "ol", "div", "article", "section", "body", "main", "td"}
CLOSES_P = {"p", "div", "article", "section", "ul", "ol", "dl", "table", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "nav", "aside", "footer", "header", "main", "form", "figure", "hr"}


def named(token: str) -> bool:
    """Whether one class (or id) names page furniture."""
    parts = [p for p in re.split("[-_]+", token) if p]
    if not parts or (len(parts) > 1 and parts[0] in STATES):
        return False
    return bool(NAMED.fullmatch("".join(parts)) or NAMED.fullmatch(parts[-1]) or (parts[-1] in CONTAINERS and NAMED.fullmatch(parts[0])))


def furniture(name: str, attributes: str, inside_main: bool) -> bool:
    if name in FURNITURE or (name == "header" and not inside_main):
        return True
    if not attributes or name in ("html", "body", "article", "main"):
        return False
    for key, a, b, c in ATTRIBUTE.findall(attributes):
        value = a or b or c
        key = key.lower()
        if key in ("class", "id") and any(named(token) for token in value.lower().split()):
            return True
        if key == "role" and value.lower() in ROLES:
            return True
        if key == "hidden" or (key == "aria-hidden" and value.lower() == "true") or (key == "style" and "display:none" in value.replace(" ", "").lower()):
            return True
    return False


def tokens(page: str) -> list[tuple[str, str, str]]:
    """(class of weight, kind, text): kind is "word" for text between tags, "break" where a block begins or ends, "tag" for other tags.

    The class is furniture for all that stands in such an element; else tags are classes of their own, and text is in a link, an item or plain.
    Unclosed elements end with what holds them. An element that is furniture by its name alone and turns out to hold the page's first article
    or main element is none. Places of open elements are kept by name, so a page of stray tags takes time in proportion to its length.
    """
    out: list[tuple[str, str, str]] = []
    open_: list[tuple[str, bool]] = []
    # Places in open_: of each name, of elements that are not inline, of those at which a paragraph ends, and of furniture.
    of_name: dict[str, list[int]] = {}
    blocks: list[int] = []
    anchors: list[int] = []
    marked: list[int] = []
    bad = links = 0
    main = 0
    seen_main = False
    at = 0

    def text(piece: str) -> None:
        if piece.strip():
            out.append(("furniture" if bad else "link" if links else "item" if open_ and open_[-1][0] in ("li", "td", "th", "option", "dt", "dd") else "words", "word", piece))
        elif piece:
            out.append(("space", "word", piece))

    def leave(depth: int) -> None:
        nonlocal bad, links, main
        while len(open_) > depth:
            name, was_bad = open_.pop()
            if name:
                of_name[name].pop()
            for places in (blocks, anchors, marked):
                if places and places[-1] == len(open_):
                    places.pop()
            bad -= was_bad
            links -= name == "a"
            main -= name in MAIN

    while True:
        found = TOKEN.search(page, at)
        if not found:
            text(page[at:])
            return out
        text(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            continue
        closing, attributes = bool(found[1]), found[3]
        kind = "tag" if name in INLINE else "break"
        is_bad = not closing and furniture(name, attributes, main > 0)
        if name in MAIN and not closing:
            if bad and not seen_main and not any(open_[k][0] in FURNITURE or open_[k][0] == "header" for k in marked):
                for k in marked:
                    open_[k] = (open_[k][0], False)
                marked.clear()
                bad = 0
            seen_main |= not bad
        out.append(("furniture" if bad or is_bad else f"</{name}>" if closing else f"<{name}>", kind, " " if name == "br" and not bad else ""))
        if closing:
            depth = of_name[name][-1] if of_name.get(name) else None
            # An inline element's end does not close the blocks around it.
            if depth is not None and not (name in INLINE and blocks and blocks[-1] > depth):
                leave(depth)
            elif depth is not None:
                links -= name == "a"
                of_name[name].pop()
                open_[depth] = ("", open_[depth][1])
            continue
        if name in RAW:
            end = RAW_END[name].search(page, at)
            at = end.end() if end else len(page)
            continue
        if name in VOID or attributes.endswith("/"):
            continue
        if name in CLOSES_P or name == "li":
            last = anchors[-1] if anchors else None
            if last is not None and (open_[last][0] == "p" or (name == "li" and open_[last][0] == "li")):
                leave(last)
        of_name.setdefault(name, []).append(len(open_))
        if name not in INLINE:
            blocks.append(len(open_))
        if name in PARAGRAPH_ENDS:
            anchors.append(len(open_))
        if is_bad:
            marked.append(len(open_))
        open_.append((name, is_bad))
        bad += is_bad
        links += name == "a"
        main += name in MAIN


def labelled(page: str) -> tuple[Counter, Counter] | None:
    """Tokens of each class in and out of the main text of a page that marks it with one article or main element; else None."""
    found = tokens(page)
    starts = [k for k, t in enumerate(found) if t[0] in ("<article>", "<main>")]
    ends = [k for k, t in enumerate(found) if t[0] in ("</article>", "</main>")]
    if len(starts) != 1 or len(ends) != 1 or ends[0] < starts[0]:
        return None
    inside, outside = Counter(), Counter()
    for k, (name, kind, piece) in enumerate(found):
        weight = len(piece.split()) if kind == "word" else 1
        main = starts[0] < k < ends[0] and name != "furniture"
        (inside if main else outside)[name] += weight
    return inside, outside


# Weights where no page is labelled.
PLAIN = {"words": 1.0, "item": 1.0, "link": -0.5, "furniture": -4.0, "space": 0.0}
TAG_WEIGHT = -0.3
# Weights of the fit are held between these: a tag is never for the text, and plain words never count against it.
BOUNDS = {"words": (0.5, 4.0), "item": (0.2, 3.0), "link": (-2.0, 2.0), "furniture": (-8.0, -2.0), "space": (0.0, 0.0)}


def weights(inside: dict[str, int], outside: dict[str, int]) -> dict[str, float]:
    """Weight of each class: its log odds for the main text against those of all words, within ``BOUNDS``; tags are negative."""
    if not inside or not outside:
        return dict(PLAIN)
    a, b = sum(inside.values()), sum(outside.values())
    out = dict(PLAIN)
    for name in {*inside, *outside}:
        odds = math.log((inside.get(name, 0) + 1) / (a + 100)) - math.log((outside.get(name, 0) + 1) / (b + 100))
        low, high = BOUNDS.get(name, (-6.0, -0.05))
        out[name] = min(max(odds, low), high)
    return out


def best_run(scores: list[float]) -> tuple[int, int]:
    """Bounds of the run with the greatest sum, the first and longest of equals; empty if no sum is above 0."""
    best, bounds, total, start = 0.0, (0, 0), 0.0, 0
    for k, x in enumerate(scores):
        if total <= 0:
            total, start = 0.0, k
        total += x
        if total > best or (total == best and bounds[0] == start and total > 0):
            best, bounds = total, (start, k + 1)
    return bounds


def main_text(page: str | None, weight: dict[str, float]) -> str:
    """Blocks of the best run, one in a line; references decoded, white space inside a block made one space. Empty if there is none."""
    if not page:
        return ""
    found = tokens(page)
    scores = [weight.get(name, TAG_WEIGHT) * (len(piece.split()) if kind == "word" else 1) for name, kind, piece in found]
    low, high = best_run(scores)
    if low == high:
        return ""
    # The run grows to the ends of the article or main element that holds most of it, so that short blocks at its edges stay; it never shrinks.
    low, high = grown(found, low, high)
    blocks, part = [], []
    for name, kind, piece in found[low:high]:
        if kind == "break" and piece != " ":
            blocks.append("".join(part))
            part = []
        elif name != "furniture":
            part.append(piece)
    blocks.append("".join(part))
    clean = (" ".join(html.unescape(b).split()) for b in blocks)
    return "\n".join(b for b in clean if b)


def grown(found: list[tuple[str, str, str]], low: int, high: int) -> tuple[int, int]:
    """The run and the smallest article or main element that holds over half of its words, as one run."""
    words = list(accumulate((0 if t[0] == "furniture" else len(t[2].split()) for t in found), initial=0))
    open_: list[tuple[str, int]] = []
    spans = []
    for k, (name, kind, _) in enumerate(found):
        if name in ("<article>", "<main>"):
            open_.append((name, k))
        elif name in ("</article>", "</main>") and any(n == f"<{name[2:]}" for n, _ in open_):
            while open_:
                n, start = open_.pop()
                spans.append((start, k))
                if n == f"<{name[2:]}":
                    break
    spans += [(start, len(found)) for _, start in open_]
    held = [(b - a, a, b) for a, b in spans if a < high and b > low and 2 * (words[min(b, high)] - words[max(a, low)]) > words[high] - words[low]]
    _, a, b = min(held) if held else (0, low, high)
    return min(low, a), max(high, b)


def learn(pages: DataFrame, sample: int = SAMPLE, html_col: str = "html") -> dict[str, float]:
    """Weights from a bounded sample of the pages that mark their main text."""
    share = min(1.0, sample / max(1, pages.count()))
    chosen = pages.where(F.pmod(F.xxhash64(html_col), F.lit(2**20)) < round(share * 2**20)).select(html_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        inside, outside = Counter(), Counter()
        for batch in batches:
            for page in batch.column(0):
                if counts := labelled(page.as_py() or ""):
                    inside += counts[0]
                    outside += counts[1]
        names = sorted({*inside, *outside})
        yield pa.RecordBatch.from_arrays([pa.array(names, pa.string()), pa.array([inside[n] for n in names], pa.int64()), pa.array([outside[n] for n in names], pa.int64())], ["name", "inside", "outside"])

    rows = chosen.mapInArrow(run, "name string, inside long, outside long").groupBy("name").agg(F.sum("inside").alias("inside"), F.sum("outside").alias("outside")).orderBy((F.col("inside") + F.col("outside")).desc(), "name").limit(NAMES).collect()
    return weights({r["name"]: r["inside"] for r in rows if r["inside"]}, {r["name"]: r["outside"] for r in rows if r["outside"]})


def extracted(pages: DataFrame, weight: dict[str, float]) -> DataFrame:
    """page_id, url, text and n_chars of every row; a null or empty page has an empty text, repeated rows give the same."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py(), weight) for p in batch.column(2)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), "html").mapInArrow(run, "page_id long, url string, text string, n_chars long")


def op2_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet")
    return extracted(pages, learn(pages))

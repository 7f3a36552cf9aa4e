"""Main text of web pages with site template removal.

Element subtrees are hashed, their pages are counted per host in Spark, and
subtrees that recur on many pages of a host are deleted together with the parts
of a page that are never its article.
"""
from __future__ import annotations

import html
import re
from bisect import bisect_left, bisect_right
from collections import defaultdict
from collections.abc import Callable
from dataclasses import dataclass
from itertools import accumulate

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from evalpress.llm.common import bounded_batches, small, staged, tidy

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[(?P<cdata>.*?)(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][^\s/>]*)(?P<attrs>(?:[^>\"']++|\"[^\"]*\"|'[^']*')*+>|[^>]*(?:>|\Z))", re.S)
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
#: elements that never belong to the article
SKIP = RAW | {"head", "nav", "footer", "aside", "form", "button", "select", "option", "dialog", "menu", "audio",
              "video", "canvas", "fieldset", "label", "input"}
BLOCK = {"address", "article", "aside", "blockquote", "body", "br", "caption", "center", "dd", "details", "div", "dl",
         "dt", "fieldset", "figcaption", "figure", "footer", "form", "h1", "h2", "h3", "h4", "h5", "h6", "head",
         "header", "hr", "html", "li", "main", "nav", "ol", "p", "pre", "section", "summary", "table", "tbody", "td",
         "tfoot", "th", "thead", "tr", "ul"}
#: subtrees that are hashed and counted
CONTAINER = {"article", "aside", "blockquote", "div", "dl", "figure", "footer", "form", "header", "main", "nav", "ol",
             "section", "table", "ul", "p", "li"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}
BOUND = {"ul", "ol", "dl", "table", "tbody", "thead", "tfoot"}
#: words of class, id and role values that name parts around an article
AROUND = {"ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "banner", "sponsor", "sponsored",
          "promo", "promotion", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert", "sidebar",
          "widget", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager",
          "comment", "comments", "disqus", "respond", "share", "sharing", "social", "related", "recommended",
          "newsletter", "subscribe", "subscription", "popup", "modal", "overlay", "footer", "masthead", "topbar",
          "toolbar", "login", "signup", "search", "skip", "contentinfo", "complementary", "adbox", "adslot"}
#: names of what readers wrote, which may be longer than the article
READERS = {"comment", "comments", "disqus", "respond", "reply", "replies", "responses", "discussion", "discussions"}
NAMED = re.compile(r"""(?:^|\s)(class|id|role|aria-label)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
HIDDEN = re.compile(r"""(?:^|\s)(?:hidden(?=[\s>=/]|$)|aria-hidden\s*=\s*["']?true|style\s*=\s*["'][^"']*display\s*:\s*none)""", re.I)
WORDS = re.compile(r"[a-z]+")
#: words that make a name tell of a state of something else: no-sidebar, has-banner, comments-open
STATE = {"no", "not", "non", "has", "have", "with", "without", "is", "hide", "show", "open", "opened", "closed", "none", "free",
         "enabled", "disabled", "active", "inactive", "on", "off"}
#: paragraphs, which go from an article only if most pages of its host have them and others remain
SOFT = {"p", "li", "blockquote"}
FENCE = {"article", "main", "td"}
#: subtree hashes are polynomials of token hashes modulo a prime
PRIME, BASE = (1 << 61) - 1, 0x1D8E4E27C47D124F
#: elements whose text tells where a page's main part is
PROSE = {"p", "pre", "blockquote"}


@dataclass
class Page:
    """``texts``: (offset, raw text, kept); ``breaks``: offsets of block
    borders; ``nodes``: (start, end, kind, hash) of the containers that may be
    template, where kind is whether it is a paragraph of an article."""

    texts: list[tuple[int, str, bool]]
    breaks: list[int]
    nodes: list[tuple[int, int, bool, int]]
    article: bool


def around(attrs: str) -> int:
    """Whether the attributes name a part around the article (1) or what
    readers wrote (2): one of their names is such a word, or begins or ends
    with one (sidebar, sidebar-left, left-sidebar) and does not begin or end
    with a word of state."""
    if "=" not in attrs:
        return 0
    found = 0
    for _, value in NAMED.findall(attrs):
        for name in value.strip("\"'").split():
            parts = WORDS.findall(re.sub(r"(?<=[a-z])(?=[A-Z])", " ", name).lower())
            ends = (parts[0], parts[-1]) if parts else ()
            if parts and STATE.isdisjoint(ends):
                found = max(found, 0 if (AROUND | READERS).isdisjoint(ends) else 1 if READERS.isdisjoint(ends) else 2)
    return found


def hidden(attrs: str) -> bool:
    return ("=" in attrs or "hidden" in attrs) and bool(HIDDEN.search(attrs))


def covered(spans: list[tuple[int, int]]) -> Callable[[int], bool]:
    """Whether an offset is in one of the spans, which are nested or apart."""
    outer: list[tuple[int, int]] = []
    for s, e in sorted(spans, key=lambda x: (x[0], -x[1])):
        if not outer or s >= outer[-1][1]:
            outer.append((s, e))
    starts = [s for s, _ in outer]

    def holds(o: int) -> bool:
        k = bisect_right(starts, o) - 1
        return k >= 0 and o < outer[k][1]

    return holds


def named_parts(named: list[tuple[int, int, bool, int]], texts: list[tuple[int, str, bool, bool, bool]]) -> list[tuple[int, int]]:
    """(start, end) of the named elements that are left out.  One stays if it
    holds most of the page's paragraph text, unless its name tells of readers
    and a paragraph is outside of all such parts, or if it holds an article and
    no paragraph of an article or main element is outside of all parts."""
    prose = [(o, len(t.strip()), inside) for o, t, skip, inside, within in texts if within and not skip]
    at = [o for o, _, _ in prose]
    before = [0, *accumulate(n for _, n, _ in prose)]
    amount = lambda s, e: before[bisect_left(at, e)] - before[bisect_left(at, s)]
    readers = [(s, e) for s, e, holds, kind in named if kind == 2 and not holds]
    written = covered(readers)
    any_inside = any(n and inside for _, n, inside in prose)
    if not any(n and (inside or not any_inside) and not written(o) for o, n, inside in prose):
        readers = []
    theirs = set(readers)
    gone = [(s, e, holds) for s, e, holds, _ in named if (s, e) in theirs or 2 * amount(s, e) <= before[-1]]
    if any(holds for _, _, holds in gone):
        out = covered([(s, e) for s, e, _ in gone])
        outside = any(n and inside and not out(o) for o, n, inside in prose)
        gone = [(s, e, holds) for s, e, holds in gone if outside or not holds]
    return [(s, e) for s, e, _ in gone]


def token_hash(text: str) -> int:
    return xxhash.xxh3_64_intdigest(" ".join(text.split()).encode("utf-8", "surrogatepass")) % PRIME


def parse(page: str) -> Page:
    """One pass over the tags with implied ends (a block closes an open
    paragraph, an item the item before), in time linear in the page: places of
    open tags are kept by name, and a subtree's hash is the difference of two
    prefix hashes of the tokens (white space, comments and what is in scripts do
    not count).  Text outside every article or main element counts only if the
    page has none.  An element named as a part around the article is left out
    with all below it (see ``named_parts``); an article so named only within
    another one or beside one that is not."""
    texts: list[tuple[int, str, bool, bool, bool]] = []  # offset, text, skipped, in an article, in a paragraph
    breaks: list[int] = []
    nodes: list[tuple[int, int, bool, int]] = []
    # tag, start, first token, skipped, in an article, in a paragraph, named
    stack: list[tuple[str, int, int, bool, bool, bool, int]] = []
    places: defaultdict[str, list[int]] = defaultdict(list)  # of open tags in the stack
    blocks: list[int] = []
    bounds: list[int] = []
    fences: list[int] = []
    prefix = [0]
    known: dict[str, int] = {}  # of short tokens
    articles: list[int] = []
    named: list[tuple[int, int, bool, int]] = []  # start, end, whether it holds an article and is in none, kind
    named_articles: list[tuple[int, int, bool, int]] = []
    at = 0
    skipped = inside = prose = False
    titles_end = True

    def note(text: str) -> None:
        value = known.get(text)
        if value is None:
            value = token_hash(text)
            if len(text) < 80:
                known[text] = value
        prefix.append((prefix[-1] * BASE + value + 1) % PRIME)

    def pop(to: int, end: int) -> None:
        nonlocal skipped, inside, prose
        while len(stack) > to:
            tag, start, first, skip, within, _, by_name = stack.pop()
            places[tag].pop()
            for group in (blocks, bounds, fences):
                if group and group[-1] == len(stack):
                    group.pop()
            if by_name:
                holds = not places["article"] and bool(articles) and articles[-1] > start
                (named_articles if tag in ("article", "main") and not within else named).append((start, end, holds, by_name))
            if tag in CONTAINER and tag not in ("article", "main"):
                soft = within and tag in SOFT
                value = (prefix[-1] - prefix[first] * pow(BASE, len(prefix) - 1 - first, PRIME)) % PRIME
                nodes.append((start, end, soft, -value - 1 if soft else value))
            if tag in BLOCK:
                breaks.append(end)
        skipped, inside, prose = (stack[-1][3], stack[-1][4] or stack[-1][0] in ("article", "main"), stack[-1][5]) if stack else (
            False, False, False)

    pos, size = 0, len(page)
    while pos < size:
        m = TOKEN.search(page, pos)
        end = m.start() if m else size
        if end > at:
            text = page[at:end]
            texts.append((at, text, skipped, inside, prose))
            if not text.isspace():
                note(text)
        if not m:
            break
        pos = at = m.end()
        tag = m["tag"]
        if tag is None:
            if m["cdata"]:
                texts.append((m.start(), html.escape(m["cdata"]), skipped, inside, prose))
                note(m["cdata"])
            continue
        tag = tag.lower()
        if m["close"]:
            note(m[0])
            if tag == "br" or tag in BLOCK:
                breaks.append(m.start())
            k = places[tag][-1] if places[tag] else -1
            # a stray inline end tag does not close the article
            if k >= 0 and (tag in BLOCK or not fences or fences[-1] <= k):
                pop(k, m.end())
            continue
        if tag in BLOCK:
            breaks.append(m.start())
            if blocks and stack[blocks[-1]][0] == "p" and tag != "br":
                pop(blocks[-1], m.start())
        if tag in CLOSES:
            k = max((places[t][-1] for t in CLOSES[tag] if places[t]), default=-1)
            if k > (bounds[-1] if bounds else -1):
                pop(k, m.start())
        attrs = m["attrs"]
        if tag in VOID or attrs.endswith("/>") and tag in RAW:
            note(m[0])
            continue
        if tag in RAW:  # its content is no markup
            note(tag)
            stop = None
            if tag != "title" or titles_end:
                stop = re.compile(f"</{re.escape(tag)}\\s*(?:>|\\Z)", re.I).search(page, pos)
            if stop is None and tag == "title":
                titles_end = False
                continue
            pos = at = stop.end() if stop else size
            continue
        article = tag in ("article", "main")
        skip = skipped or tag in SKIP or tag == "header" and not inside or tag not in ("html", "body", "main") and hidden(attrs)
        by_name = 0 if skip or tag in ("html", "body") else around(attrs)
        if article and not skip and not by_name:
            articles.append(m.start())
        place = len(stack)
        places[tag].append(place)
        for group, tags in ((blocks, BLOCK), (bounds, BOUND), (fences, FENCE)):
            if tag in tags:
                group.append(place)
        stack.append((tag, m.start(), len(prefix) - 1, skip, inside, prose or tag in PROSE, by_name))
        note(m[0])
        skipped, inside, prose = skip, inside or article, prose or tag in PROSE
    pop(0, size)
    if articles:
        named += named_articles
    else:
        articles = [s for s, _, _, _ in named_articles]
    out = covered(named_parts(named, texts) if named else [])
    has_article = any(not out(o) for o in articles)
    return Page([(o, t, not skip and (within or not has_article) and not out(o)) for o, t, skip, within, _ in texts],
                breaks, nodes, has_article)


def subtree_hashes(page: str) -> set[int]:
    """Hashes of what may be template; those of paragraphs of articles are negative."""
    return {h for _, _, _, h in parse(page).nodes}


def main_text(page: str, template: frozenset[int] | set[int]) -> str:
    """The kept blocks, white space runs as one space, joined by one space.  A
    paragraph of an article goes as template only if other text of the article remains."""
    p = parse(page)
    gone = [(s, e) for s, e, soft, h in p.nodes if not soft and h in template]
    often = [(s, e) for s, e, soft, h in p.nodes if soft and h in template]
    if often:
        out, recurs = covered(gone), covered(often)
        own = covered([(s, e) for s, e, soft, h in p.nodes if soft and h not in template])
        if any(kept and own(o) and not recurs(o) and not out(o) and not t.isspace() for o, t, kept in p.texts):
            gone += often
    dropped = covered(gone)
    borders = sorted(set(p.breaks))
    out_texts: list[str] = []
    block = -1
    for offset, text, kept in p.texts:
        if not kept or dropped(offset):
            continue
        b = bisect_right(borders, offset)
        if b != block:
            out_texts.append(" ")
            block = b
        out_texts.append(text)
    return " ".join(html.unescape("".join(out_texts)).split())


HOST = r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)"


def extract(pages: DataFrame, share: float = 0.2, least: int = 10, few: int = 3, most: float = 0.5) -> DataFrame:
    """page_id, url, text, n_chars of every page.

    A subtree is part of a host's template if at least ``least`` different pages
    of the host have it; on a host of fewer than ``least / share`` pages a
    ``share`` of its pages is enough, but at least ``few``.  Each page meets the
    counts of its own subtrees, so a host may have any number of such subtrees.
    Copies of a page (equal html on one host) count as one page, so that many of
    them do not make its own text a template.  Articles are never deleted as
    template; a paragraph or item in one is if at least a share ``most`` of the
    host's pages, and ``least`` of them, have it in an article, and others of
    its page remain.  Null or empty html gives an empty text
    and counts as no page; a null url belongs to the host ''; an empty table
    gives no rows; other columns are ignored.  Pages are made distinct and
    counted with partial results, so a host with most pages or a page with most
    copies is no hot task."""
    src = bounded_batches(pages).select("page_id", "url", "html").withColumn(
        "_host", F.coalesce(F.lower(F.regexp_extract("url", HOST, 1)), F.lit(""))).withColumn("_page", F.xxhash64("html"))

    def hashes(batches):
        for b in batches:
            found = [list(subtree_hashes(t)) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(found, pa.list_(pa.int64()))],
                                             names=["_host", "_page", "_nodes"])

    key = ["_host", "_page"]
    seen = staged(src.where("html <> ''").select(*key, "html").mapInArrow(
        tidy(hashes), "_host string, _page long, _nodes array<long>").dropDuplicates(key))
    # a null node stands for the page itself, so one count gives both numbers
    counts = (seen.select("_host", F.explode(F.concat(F.array(F.lit(None).cast("long")), "_nodes")).alias("_node"))
              .groupBy("_host", "_node").agg(F.count("*").alias("_n")).where((F.col("_n") >= few) | F.col("_node").isNull()))
    counts = staged(counts)
    hosts = counts.where(F.col("_node").isNull()).select("_host", F.col("_n").alias("_pages"))
    enough = (F.when(F.col("_node") < 0, F.greatest(F.lit(float(least)), most * F.col("_pages")))
              .otherwise(F.least(F.lit(float(least)), F.greatest(F.lit(float(few)), share * F.col("_pages")))))
    common = staged(counts.where(F.col("_node").isNotNull()).join(hosts, "_host")
                    .where(F.col("_n") >= enough).select("_host", "_node"))
    # one list per different page, of at most its own subtrees
    template = staged(seen.select(*key, F.explode("_nodes").alias("_node")).join(small(common), ["_host", "_node"])
                      .groupBy(*key).agg(F.collect_list("_node").alias("_template")))
    joined = src.join(small(template, 20_000), key, "left").select("page_id", "url", "html", "_template")

    def texts(batches):
        for b in batches:
            out = [main_text(h, set(t or ())) if h else "" for h, t in zip(b.column(2).to_pylist(), b.column(3).to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(out, pa.string()), pa.array([len(t) for t in out], pa.int64())],
                names=["page_id", "url", "text", "n_chars"])

    kind = src.schema["page_id"].dataType.simpleString()
    return joined.mapInArrow(tidy(texts), f"page_id {kind}, url string, text string, n_chars long")

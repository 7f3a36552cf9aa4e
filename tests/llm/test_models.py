"""Operators that learn or extract: held-out accuracy and fixed pages."""
from __future__ import annotations

import random
import time
import zlib

import numpy as np
from pyspark.sql import functions as F

from evalpress.llm import html_extract, lang_id, toxicity
from tests.conftest import SMALL
from tests.llm.helpers import collected, docs, words

TONGUES = {"aa": ["tha", "ing", "er", "on", "ed", "st", "wh"], "bb": ["sch", "ung", "ein", "ver", "keit", "ä"],
           "cc": ["eau", "eux", "ment", "qu", "é", "tre"]}


def prose(rng: random.Random, lang: str, n: int) -> str:
    return " ".join("".join(rng.choice(TONGUES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n)) + "."


def test_language_held_out(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, lang, rng.randrange(4, 80)), lang) for i in range(400) for lang in [rng.choice(list(TONGUES))]]
    rows += [(1000, None, "aa"), (1001, "", "aa"), (1002, "12 %% 9", "bb"), (None, prose(rng, "bb", 30), "bb"),
             (1003, prose(rng, "cc", 20000), None), (1003, prose(rng, "cc", 20), None)]
    got = collected(lang_id.identify(docs(spark, rows, clash=True), lang_id.Params(per_lang=60)))
    assert len(got) == len(rows)
    want = {r[0]: r[2] for r in rows}
    held = [r for r in got if r["held_out"]]
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in got)
    assert len(held) > 60 and np.mean([r["lang_pred"] == want[r["doc_id"]] for r in held if r["doc_id"] < 1000]) > 0.95
    by = {(r["doc_id"]): r for r in got}
    assert [by[k]["lang_pred"] for k in (1000, 1001, 1002, None, 1003)] == ["und", "und", "und", "bb", "cc"]
    assert all(0 <= r["score"] <= 1 and r["lang_pred"] in {"und", *TONGUES} for r in got)
    assert collected(lang_id.identify(docs(spark, []))) == []
    assert collected(lang_id.identify(docs(spark, [(1, "abc", None)])))[0]["lang_pred"] == "und"
    kept = collected(lang_id.keep_known(docs(spark, rows, clash=True), params=lang_id.Params(per_lang=60)))
    assert {1000, 1001, 1002}.isdisjoint(r["doc_id"] for r in kept) and len(kept) > 0.97 * (len(rows) - 3)
    assert kept[0]["_row"] == "x2" and kept[0]["label"] == "x7"


def test_presence_kernel_is_set_cosine():
    a, b = "abcab", "bcabd"
    grams = lambda t: {t[i:i + n] for n in (1, 2, 3) for i in range(len(t) - n + 1)}
    x = lang_id.presence([a, b], 3, 16)
    assert abs(float(x[0] @ x[1]) - len(grams(a) & grams(b)) / (len(grams(a)) * len(grams(b))) ** 0.5) < 1e-6


def test_toxicity_held_out(spark):
    rng = random.Random(2)
    bad = ["grobnik", "veltrasse", "morduk", "skenfar"]

    def insult() -> str:
        w = rng.choice(bad)
        k = rng.randrange(1, len(w) - 1)
        return rng.choice([w, w, w.upper(), w[:k] + "*" + w[k:], w[:k] + "x" + w[k:], ".".join(w), " ".join(w)])

    rows, labels = [], []
    for i in range(900):
        lang = rng.choice(list(TONGUES))
        t = prose(rng, lang, rng.randrange(5, 60)).split()
        toxic = rng.random() < 0.3
        for _ in range(rng.randrange(1, 4) if toxic else 0):
            t.insert(rng.randrange(len(t)), insult())
        rows.append((i, " ".join(t), lang))
        labels.append((i, 1, int(toxic)))
    rows += [(2000, None), (2001, ""), (2002, "grobnik"), (None, "some grobnik there"), (2003, "tha " * 30000), (2003, "y" * 5000)]
    lab = spark.createDataFrame(labels + [(5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int")
    got = collected(toxicity.toxicity(docs(spark, rows, clash=True), lab))
    assert len(got) == len(rows)
    assert all(r["held_out"] == (r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 1) for r in got)
    want = {i: t for i, _, t in labels}
    held = [r for r in got if r["held_out"] and r["doc_id"] in want]
    hit = [r["predicted"] for r in held if want[r["doc_id"]]]
    false = [r["predicted"] for r in held if not want[r["doc_id"]]]
    assert len(hit) > 60 and np.mean(hit) > 0.9 and np.mean(false) < 0.03
    by = {r["doc_id"]: r for r in got}
    assert by[2002]["predicted"] == 1 and by[2001]["predicted"] == 0 and by[2000]["score"] == by[2001]["score"]
    assert all(r["predicted"] == int(r["score"] >= 0.7) for r in got)
    assert collected(toxicity.toxicity(docs(spark, []), lab)) == []
    assert {r["score"] for r in collected(toxicity.toxicity(docs(spark, rows[:3]), lab.limit(0)))} == {0.0}


def test_kernel_values_match_profiles():
    p = toxicity.Params(floor=0.2)
    land = toxicity.Landmarks(["grobnik", "morduk", "aaaa"], p)
    words = ["grobnik", "groxbnik", "gr", "mordu", "banana", "aaaaaa", "nothing", "grobnikgrobnik"]
    at, v = land.values(words)
    got = np.zeros((len(words), 3))
    got[at] = v
    for i, w in enumerate(words):
        a = toxicity.profile(w, p) if len(w) > 2 else {}
        if len(set(w)) < len(w) and w not in ("grobnik", "groxbnik", "mordu", "nothing"):
            continue  # a repeated triple only raises the fast value
        for j, l in enumerate(land.words):
            b = toxicity.profile(l, p)
            k = sum(x * b.get(c, 0) for c, x in a.items())
            assert abs(got[i, j] - (k if k >= p.floor else 0)) < 1e-5, (w, l)


PAGE = """<!DOCTYPE html><html><head><title>T &amp; x</title><style>p{}</style><script>var a="</p><article>";</script></head>
<body class="has-sidebar"><header><h1>Site</h1></header><nav><ul><li><a href=/a>Menu</a></ul></nav><!-- <p>no</p> -->
<div class="cookie-notice">We use cookies</div><div id='ad-top'>Buy</div>
<article><header><h1>The  title</h1></header><p>One&nbsp;<b>bo</b>ld &lt;tag&gt; &eacute; &#233; 1 < 2<p>Two<br>three
<ul><li>item a<li>item b</ul><table><tr><td>x<td>y</table><form>Your name <input></form>
<div class="comments"><article><p>A reader says</p></article></div><p hidden>gone</p></article>
<aside>Related</aside><footer>&copy; site</footer></body></html>"""


def test_page_text():
    assert html_extract.main_text(PAGE, set()) == "The title One bold <tag> é é 1 < 2 Two three item a item b x y"
    assert html_extract.main_text("plain &amp; text", set()) == "plain & text"
    assert html_extract.main_text("<p>cut <b>off</p", set()) == "cut off"
    assert html_extract.main_text("<div>a</div>b<span>c</span>d", set()) == "a bcd"
    assert html_extract.main_text("<script>x", set()) == "" and html_extract.main_text("<", set()) == "<"


def test_names_of_wrappers_do_not_lose_the_article():
    text = lambda body: html_extract.main_text(f"<html><body>{body}</body></html>", set())
    story = "<p>The long story of this page.</p>"
    for wrapper in ("div class='page no-sidebar'", "div id=content class=has-banner", "div class=search-results", "div id='ad'",
                    "section class='widget sidebar-left'"):
        end = f"</{wrapper.split()[0]}>"
        assert text(f"<div><p>By</p></div><{wrapper}><article><h1>Head</h1>{story}</article>{end}") == "Head The long story of this page."
        assert text(f"<main><h1>Found</h1><{wrapper}><article>{story}</article>{end}</main>") == "Found The long story of this page."
        assert text(f"<{wrapper}>{story}{end}<div>end</div>") == "The long story of this page. end"
    for name in ("post comments-open", "related", "ad"):
        assert text(f"<p>around</p><article class='{name}'>{story}</article>") == "The long story of this page."
    for name in ("sidebar", "sidebar-left", "left-sidebar", "cookieNotice", "x social"):
        assert text(f"<div class='{name}'><p>away</p></div>{story}") == "The long story of this page."
        assert text(f"<article>{story}<div class='{name}'><article><p>away</p></article></div></article>") == "The long story of this page."
        assert text(f"<article>{story}</article><div class='{name}'><article><p>away</p></article></div>") == "The long story of this page."


def test_template_removal(spark):
    box = "<div><p>Our shop has been here since 1900.</p><ul><li>Phone</li></ul></div>"
    pages = [(i, f"https://a.example/{i}", f"<body>{box}<div id=x{i}><p>Story {i}</p><p>more {i}</p></div></body>") for i in range(40)]
    pages += [(100 + i, f"https://u@A.example:80/z{i}", f"<body>{box}<p>last {i}") for i in range(3)]
    pages += [(200, "https://b.example/1", f"<body>{box}<p>one page of this host</p>"), (300, None, None), (301, None, ""), (None, "::", "<p>x"),
              (200, "https://b.example/1", f"<body>{box}<p>one page of this host</p>"), (302, "https://c.example", "<p>" + "long " * 50000)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").select("*", F.lit(1).alias("_host"), F.lit(2).alias("_node"))
    got = collected(html_extract.extract(df))
    assert len(got) == len(pages) and all(r["n_chars"] == len(r["text"]) for r in got)
    by = {r["page_id"]: r["text"] for r in got}
    assert by[7] == "Story 7 more 7" and by[101] == "last 1"
    assert by[200] == "Our shop has been here since 1900. Phone one page of this host"
    assert by[300] == by[301] == "" and by[None] == "x" and len(by[302]) == 249999
    assert collected(html_extract.extract(df.limit(0))) == []


def test_paragraphs_most_articles_of_a_host_have_are_template(spark):
    rng, rows, want = random.Random(21), [], {}
    for k in range(40):
        own, half = words(rng, 30), " Shared by some." if k % 3 == 0 else ""
        rows.append((k, f"http://a.org/{k}", f"<article><p>{own}</p>{'<p>Shared by some.</p>' if half else ''}"
                                             f"<!-- {k} --><p>Subscribe to   our newsletter today</p></article>"))
        want[k] = own + half
    rows.append((50, "http://a.org/50", "<article><p>Subscribe to our newsletter today</p></article>"))  # nothing else remains
    rows += [(60 + k, "http://b.org/%d" % k, f"<article><p>{k} own</p><p>Subscribe to our newsletter today</p></article>") for k in range(5)]
    want |= {50: "Subscribe to our newsletter today"} | {60 + k: f"{k} own Subscribe to our newsletter today" for k in range(5)}
    got = collected(html_extract.extract(spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)))
    assert {r["page_id"]: r["text"] for r in got} == want


def test_reader_comments_of_any_length_and_adverts_go():
    own, many = "<article><h1>T</h1><p>one two three</p>{}</article>{}", "<p>I like this very much indeed, thank you</p>" * 9
    text = lambda inner, after="": html_extract.main_text(own.format(inner, after), set())
    for part in ("<div class='replies'>{}</div>", "<section class='discussion'>{}</section>", "<div class='adbox'>buy</div>",
                 "<div id='comments'>{}</div>", "<article class='comment'>{}</article>"):
        assert text(part.format(many)) == "T one two three", part
        assert text("", part.format(many)) == "T one two three", part
    # names alone never empty a page
    assert html_extract.main_text("<div class='comments'><p>only this</p></div>", set()) == "only this"
    assert html_extract.main_text("<article class='social'><p>only this</p></article>", set()) == "only this"


def test_subtree_hashes_equal_where_the_tokens_are():
    rng = random.Random(22)

    def tree(depth: int) -> str:
        if depth == 0 or rng.random() < 0.2:
            return rng.choice(["x", "y", "x y"])
        tag = rng.choice(["div", "section", "ul"])
        return f"<{tag}>" + "".join(tree(depth - 1) for _ in range(rng.randrange(1, 4))) + f"</{tag}>"

    kinds: dict[str, set] = {}
    for _ in range(200):
        page = tree(5)
        for start, end, soft, value in html_extract.parse(page).nodes:
            assert not soft and value >= 0
            kinds.setdefault(page[start:end], set()).add(value)
    assert all(len(v) == 1 for v in kinds.values())
    assert len({next(iter(v)) for v in kinds.values()}) == len(kinds) > 100


def test_hostile_pages_take_linear_time():
    for page in ("<span>" * 40000 + "</b>" * 40000, "<b><article>" + "<span>" * 40000 + "</b>" * 40000, "<div>" * 100000 + "x",
                 "<title>x" * 40000, "<li>" * 60000, "<p><i>" * 40000):
        start = time.process_time()
        html_extract.subtree_hashes(page)
        html_extract.main_text(page, {1})
        assert time.process_time() - start < 30  # minutes if it were quadratic


def test_copies_of_a_page_are_no_template(spark):
    """30 copies of a page among 60 pages of a host keep their text, with and
    without an article; what different pages share still goes."""
    box = "<div><p>Our shop has been here since 1900.</p></div>"
    for inner in ("<article><div><p>The copied story.</p></div></article>", "<div><p>The copied story.</p></div>"):
        copy = f"<body>{box}{inner}</body>"
        rows = [(i, "https://a.example/c", copy) for i in range(30)]
        rows += [(100 + i, f"https://a.example/{i}", f"<body>{box}<div><p>Story {i}</p></div></body>") for i in range(30)]
        df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
        by = {r["page_id"]: r["text"] for r in collected(html_extract.extract(df))}
        assert all(by[i] == "The copied story." and by[100 + i] == f"Story {i}" for i in range(30))


def test_template_of_rotating_parts_and_small_hosts(spark):
    """Six notices in turn are a template of a host however many pages it has,
    and so is a box of a host with fewer than ten pages."""
    rows = [(i, "https://big.example/", f"<body><div><p>Notice {i % 6}</p></div><div><p>Story {i}</p></div></body>") for i in range(90)]
    rows += [(100 + i, "https://big.example/s", f"<body><ul><li>Section box</ul><div><p>Tale {i}</p></div></body>") for i in range(12)]
    rows += [(200 + i, "https://small.example/", f"<body><div><p>Our box</p></div><div><p>Text {i}</p></div></body>") for i in range(4)]
    rows += [(300 + i, "https://two.example/", f"<body><div><p>Said twice</p></div><div><p>Text {i}</p></div></body>") for i in range(2)]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(4)
    by = {r["page_id"]: r["text"] for r in collected(html_extract.extract(df))}
    assert len(by) == len(rows) and all(by[i] == f"Story {i}" for i in range(90)) and all(by[100 + i] == f"Tale {i}" for i in range(12))
    assert all(by[200 + i] == f"Text {i}" for i in range(4)) and all(by[300 + i] == f"Said twice Text {i}" for i in range(2))


def test_articles_of_the_tables(spark):
    """The page writer's articles come out whole, on all pages."""
    import html
    import re

    pages = spark.read.parquet(f"{SMALL}/pages.parquet")
    want = {}
    for r in pages.collect():
        m = re.search(r"<article>(.*?)(?:</article>|$)", r["html"] or "", re.S)
        inner = re.sub(r"</?(?:p|h1|br)>", " ", m[1]) if m else ""
        want[r["page_id"]] = " ".join(html.unescape(re.sub(r"</?b>", "", inner)).split())
    got = {r["page_id"]: r["text"] for r in html_extract.extract(pages).collect()}
    assert sum(got[k] == want[k] for k in want) >= 0.99 * len(want)


def test_language_of_very_long_texts():
    rng = random.Random(7)
    texts, langs = zip(*[(prose(rng, lang, rng.randrange(20, 200)), lang) for _ in range(100) for lang in TONGUES])
    model = lang_id.fit(list(texts), list(langs), lang_id.Params(per_lang=100))
    letters = "abcdefghijklmnopqrstuvwxyzäéßøşž"

    def noisy(lang: str, size: int, share: float) -> str:
        out, length = [], 0
        while length < size:
            w = prose(rng, lang, 1) if rng.random() >= share else "".join(rng.choice(letters) for _ in range(7))
            out.append(w)
            length += len(w) + 1
        return " ".join(out)

    long = [noisy(lang, 1_000_000, share) for lang in TONGUES for share in (0.1, 0.3)]
    got = [model.langs[k] for k in model.scores(long).argmax(1)]
    assert got == [lang for lang in TONGUES for _ in (0.1, 0.3)]
    short = [texts[0], texts[1][:500]]
    plain = lang_id.presence(short, 3, 13) @ model.landmarks @ model.weights[:-1] + model.weights[-1]
    assert np.allclose(model.scores(short), plain, atol=1e-4)


def test_toxicity_bounds_are_exact():
    """Words settled by a bound alone have no kernel value of the floor or more."""
    rng = random.Random(9)
    p = toxicity.Params()
    bad = ["grobnik", "veltrasse", "morduk", "skenfar", "vela", "moruk", "aaaa", "abab"] + ["w" + "".join(rng.choice("abcd") for _ in range(6)) for _ in range(20)]
    words = ["".join(rng.choice("abcdgromnk") for _ in range(rng.randrange(0, 12))) for _ in range(3000)] + bad
    words += [w[:3] + "x" + w[3:] for w in bad]
    land = toxicity.Landmarks(bad, p)
    hit, values = land.values(words)
    got = {int(k): v for k, v in zip(hit, values)}
    profiles = [toxicity.profile(b, p) for b in bad]
    for i, w in enumerate(words):
        own, whole = {}, 0.0
        for a, b, x in toxicity.offsets(p):  # a repeated triple counts one by one in a word's length
            for at in range(len(w) - b):
                k = ord(w[at]) << 42 | ord(w[at + a]) << 21 | ord(w[at + b])
                own[k], whole = own.get(k, 0) + x, whole + x * x
        want = np.array([min(1, sum(own.get(k, 0) * v for k, v in q.items()) / max(whole, 1e-9) ** 0.5) for q in profiles])
        want[want < p.floor] = 0
        near = np.abs(want - p.floor) < 1e-4
        assert np.allclose(got.get(i, np.zeros(len(bad)))[~near], want[~near], atol=1e-3), w


def test_words_are_forgotten_by_halves():
    p = toxicity.Params()
    texts = [" ".join(f"w{k}x{j}" for j in range(40)) + " grobnik" for k in range(50)]
    whole = toxicity.Landmarks(["grobnik", "morduk"], p).features(texts, piece=300)
    few = toxicity.Landmarks(["grobnik", "morduk"], p, known=100)
    assert np.array_equal(few.features(texts, piece=300), whole) and len(few.before) + len(few.settled) <= 200


def test_spaced_words():
    assert "moronx" in toxicity.units("you  m o r o n x", 32)
    for t in ("a b c", "x a b", "a b", "", "a  b  c", "it is a b c", "a\tb\nc", "é è ê"):
        want = {"".join(m.split()) for m in toxicity.SPACED.findall(t)} | set(t.split())
        assert toxicity.units(t, 32) == want, t

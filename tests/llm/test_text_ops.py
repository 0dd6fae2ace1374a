"""Operators on single texts: brute force, exact round trips, and the awkward inputs."""

import base64
import collections
import hashlib
import html.parser
import itertools
import math
import random
import re
import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from crossview.llm import decontaminate, html_extract, license_scan, packing, quality_rules, warc
from crossview.llm import textbytes as tb

UP = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
ALNUM = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
AWKWARD = [None, "", " ", "\n\n", "a", "É", "A b\tc\nd", "x " * 5000, "<|endoftext|> hi", "ÇÉ!! ÊELLE!! OURÉ!!", "Σίσυφος ὈΔΥΣΣΕΎΣ x", "\x1c\x1d a b", "word. word, word.\nWord!. x.", "日本語 テキスト 🙂"]


def docs_of(spark, texts, extra=False):
    rows = [(i, t) for i, t in enumerate(texts)]
    d = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})
    return d.withColumns({"score": F.lit("clash"), "n_words": F.lit(-1), "hit_items": F.lit("clash"), "key": F.lit(1)}) if extra else d


@settings(max_examples=50, deadline=None)
@given(st.lists(st.text(alphabet="ab Z9\n.é|\t🙂", max_size=40), max_size=6), st.integers(1, 60))
def test_words_and_hashes(texts, size):
    seen = {}
    for t in tb.blocks(pa.array(texts, pa.string()), size):
        for lut, pattern in ((tb.ALNUM, ALNUM), (tb.SPACED, SPACED)):
            w = tb.words(t, lut)
            h = tb.word_hashes(t, w)
            raw = tb.LOWER[t.data].tobytes()
            for i in range(t.n):
                own = [raw[a:b] for a, b in zip(w.start[w.woff[i] : w.woff[i + 1]], w.end[w.woff[i] : w.woff[i + 1]], strict=True)]
                assert own == [x.encode() for x in pattern.findall(texts[t.first + i].translate(UP))]
            for a, b, x in zip(w.start, w.end, h, strict=True):
                assert seen.setdefault(raw[a:b], x) == x
    assert len(set(seen.values())) == len(seen)


def test_hash_set():
    rng = np.random.default_rng(2)
    for n, near in ((0, False), (1, False), (5000, False), (3000, True)):
        values = rng.integers(0, 2**64, n, dtype=np.uint64)
        if near:  # many members with the same first bits
            values = (values & np.uint64(0xFFFF)) | (rng.integers(0, 4, n, dtype=np.uint64) << np.uint64(62))
        known = tb.HashSet(values)
        asked = np.r_[values[: n // 2], rng.integers(0, 2**64, 500, dtype=np.uint64), values[:3]]
        at, which = known.find(asked)
        members = set(values.tolist())
        assert at.tolist() == [i for i, x in enumerate(asked.tolist()) if x in members]
        assert (known.values[which] == asked[at]).all()


def brute_hits(docs, items, n=13):
    wins = [(i, tuple(w[k : k + min(n, len(w))])) for i, t in items for w in [ALNUM.findall((t or "").translate(UP))] if w for k in range(len(w) - min(n, len(w)) + 1)]
    out = {}
    for d, t in docs:
        w = ALNUM.findall((t or "").translate(UP))
        hit, found = set(), set()
        for i, g in wins:
            for k in range(len(w) - len(g) + 1):
                if tuple(w[k : k + len(g)]) == g:
                    hit.update(range(k, k + len(g)))
                    found.add(str(i))
        out[d] = (len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(w))
    return out


@pytest.mark.parametrize("max_windows", [1_000_000, 1])
def test_decontaminate(spark, max_windows):
    rng = random.Random(3)
    words = [f"w{i}" for i in range(40)]
    items = [(i, " ".join(rng.choices(words, k=rng.choice([1, 2, 5, 13, 20])))) for i in range(2, 14)] + [(20, None), (21, " .. ")]
    texts = AWKWARD + [" ".join(rng.choices(words, k=60)) for _ in range(15)] + [f"x y {t.upper()} z, {t}" for _, t in items[:8]] + ["p q " * 300 + items[3][1]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    docs = docs_of(spark, texts, extra=True)
    hits = decontaminate.find_hits(docs, bench, max_windows=max_windows)
    got = {r.doc_id: (r.n_words, r.n_hit, r.n_items, r.items_sha256, r.contaminated) for r in decontaminate.digest(hits).collect()}
    want = brute_hits(list(enumerate(texts)), items)
    assert got == want
    spans = {r.doc_id: [tuple(s) for s in r.hit_spans] for r in hits.collect()}
    assert all(sum(b - a + 1 for a, b in s) == want[d][1] and all(x[1] + 1 < y[0] for x, y in zip(s, s[1:])) for d, s in spans.items())
    assert hits.columns == ["doc_id", "text", "lang", "source", "n_chars", "score", "docs_n_words", "docs_hit_items", "key", "n_words", "hit_spans", "hit_items"]
    kept = {r.doc_id for r in decontaminate.decontaminate(docs, bench, max_windows=max_windows).collect()}
    assert kept == {d for d, v in want.items() if not v[4]}
    cut = decontaminate.decontaminate(docs_of(spark, [f"keep, {items[4][1]} this", "b"]), spark.createDataFrame([items[4]], "item_id long, text string"), remove="spans", max_windows=max_windows).orderBy("doc_id").collect()
    assert cut[0].text == "keep, this" and cut[1].text == "b"
    assert decontaminate.digest(decontaminate.find_hits(docs.limit(0), bench)).count() == 0
    assert decontaminate.digest(decontaminate.find_hits(docs, bench.limit(0))).where("n_hit > 0").count() == 0
    # Items that share an id, and repeated rows; the same passage in half of all documents.
    same = spark.createDataFrame([(1, items[4][1]), (1, items[5][1]), (2, items[4][1])], "item_id long, text string")
    twice = docs.select("doc_id", "text").unionByName(docs.select("doc_id", "text"))
    rows = decontaminate.digest(decontaminate.find_hits(twice, same, max_windows=max_windows)).collect()
    brute = brute_hits(list(enumerate(texts)), [(1, items[4][1]), (1, items[5][1]), (2, items[4][1])])
    assert len(rows) == 2 * len(texts) and all(r.n_hit == brute[r.doc_id][1] and r.n_items == brute[r.doc_id][2] for r in rows)


@pytest.mark.parametrize("max_windows", [1000, 1])
def test_decontaminate_items_without_id(spark, max_windows):
    words = [f"w{i}" for i in range(20)]
    docs = docs_of(spark, ["a " + " ".join(words) + " b", "c " + " ".join(words[:13])]).select("doc_id", "text")
    benchmark = spark.createDataFrame([(None, " ".join(words)), (7, " ".join(words[5:18]))], "item_id long, text string")
    rows = {r.doc_id: r for r in decontaminate.digest(decontaminate.find_hits(docs, benchmark, max_windows=max_windows)).collect()}
    assert [(rows[i].n_hit, rows[i].n_items, rows[i].contaminated) for i in (0, 1)] == [(20, 1, True), (13, 0, True)]
    assert rows[1].items_sha256 == hashlib.sha256(b"").hexdigest()
    assert decontaminate.decontaminate(docs, benchmark, max_windows=max_windows).count() == 0


def test_packing_round_trip(spark):
    from tokenizers import Tokenizer

    rng = random.Random(1)
    texts = AWKWARD + [" ".join("".join(rng.choices("abcdeé", k=rng.randint(1, 9))) + rng.choice(["", "", ".", ",", "!.", "'s"]) for _ in range(rng.randint(1, 900))) for _ in range(60)] + ["same text"] * 3
    tok = Tokenizer.from_file(packing.tokenizer_path())
    ids = {i: [*tok.encode(t or "", add_special_tokens=False).ids, 1] for i, t in enumerate(texts)}
    rows = packing.pack(docs_of(spark, texts, extra=True).coalesce(2)).collect()
    by, seqs = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        by[r.doc_id].append(r)
        seqs[r.sequence_id].append(r)
        assert r.length > 0 and np.frombuffer(bytes(r.ids), "<u4").tolist() == ids[r.doc_id][r.start : r.start + r.length] and r.doc_tokens == len(ids[r.doc_id])
    for d, own in by.items():
        assert sorted((r.start, r.start + r.length) for r in own)[0][0] == 0 and sum(r.length for r in own) == len(ids[d])
    assert set(by) == set(ids)
    pad = total = 0
    for own in seqs.values():
        own.sort(key=lambda r: r.offset)
        at = 0
        for r in own:
            assert r.offset == at
            at += r.length
        assert at <= packing.CAPACITY
        total += at
        pad += 0 if at & (at - 1) == 0 else packing.CAPACITY - at
    assert pad <= 0.05 * total
    assert packing.pack(docs_of(spark, []).limit(0)).count() == 0


@settings(max_examples=80, deadline=None)
@given(st.lists(st.integers(1, 100), max_size=30), st.integers(1, 7))
def test_differencing(sizes, windows):
    sums, members = packing.differencing(sizes, windows)
    assert sorted(i for m in members for i in m) == list(range(len(sizes)))
    assert [sum(sizes[i] for i in m) for m in members] == sums.tolist() and sums.sum() == sum(sizes)
    assert sums.max() - sums.min() <= max(sizes, default=0)


def test_quality_rules_counts(spark):
    rng = random.Random(5)
    texts = AWKWARD + ["\n".join(" ".join(rng.choices(["the", "of", "#x", "|", "Ab", "a", "&&", "é!"], k=rng.randint(0, 12))) for _ in range(rng.randint(1, 12))) for _ in range(40)] + ["dup line\n" * 4, "one two three four five six seven eight " * 3]
    got = {r.doc_id: r for r in quality_rules.measured(docs_of(spark, texts)).collect()}
    for i, t in enumerate(texts):
        t = t or ""
        w = SPACED.findall(t)
        grams = collections.Counter(tuple(w[k : k + 8]) for k in range(len(w) - 7))
        cover = {p for k in range(len(w) - 7) if grams[tuple(w[k : k + 8])] > 1 for p in range(k, k + 8)}
        seen, dup = set(), 0
        for line in t.split("\n"):
            if SPACED.search(line):
                dup += line in seen
                seen.add(line)
        want = (len(w), sum(map(len, w)), sum(t.count(c) for c in "#*$%&|<>"), dup, len(cover))
        assert tuple(getattr(got[i], c) for c in quality_rules._BASE) == want, t


def test_binomial_and_cutoffs(spark):
    assert quality_rules.binomial_tail(1, 3, 0.5) == pytest.approx(0.5)
    assert quality_rules.binomial_tail(0, 100, 0.02) == pytest.approx(0.98**100)
    assert quality_rules.certified([0, 0, 5, 0], 1000, 0.01, 0.01) == 2
    assert quality_rules.certified([0], 10, 0.01, 0.01) == 0
    good, bad = "plain words of a clean text are here and so on for long enough to be kept by the base rule really", "x### y$$$ z%%% w&&& v*** u### t$$$ s%%% r&&& q*** p### o$$$ n%%% m&&& l*** k### j$$$ i%%% h&&& g***"
    texts = [good] * 900 + [bad] * 50
    labels = spark.createDataFrame([(i, int(i < 900)) for i in range(950)] + [(None, 1), (3, None)], "doc_id long, quality int")
    rows = quality_rules.filter_quality(docs_of(spark, texts), labels).collect()
    assert {r.kept for r in rows if r.doc_id < 900} == {True} and {r.kept for r in rows if r.doc_id >= 900} == {False}
    none = quality_rules.filter_quality(docs_of(spark, texts[895:905]), labels.limit(0)).collect()
    assert all(r.kept for r in none)


def test_quality_verdicts_by_brute_force(spark):
    """Cutoffs by plain counting over the labelled rows of each stratum, nulls as a stratum, rows that occur twice."""
    rng = random.Random(15)
    texts, langs, y = [], [], []
    for _ in range(2600):
        bad = rng.random() < 0.2
        words = rng.choices(["word", "Word,", "is", "A", "ok!", "#x" if bad else "x", "$$" if bad else "y", "same" if bad else "z"], k=rng.randint(22, 60))
        texts.append(" ".join(words))
        langs.append(rng.choice(["en", "en", "de", None]))
        y.append(int(not bad) if rng.random() < 0.97 else int(bad))
    texts[:5], langs[:5] = ["", None, "x " * 30, "short text", "a"], ["en", None, "xx", "xx", None]
    docs = spark.createDataFrame([(i, t, k, -1.0) for i, (t, k) in enumerate(zip(texts, langs))], "doc_id long, text string, lang string, symbols double")
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(y) if i % 10], "doc_id long, quality int")
    values = {r.doc_id: r for r in quality_rules.measured(docs).collect()}
    held = [i for i in values if i % 10]
    strata = {langs[i] for i in held}
    limit = {}
    for lang in strata:
        for rule in quality_rules.RULES:
            good = [getattr(values[i], rule) for i in held if langs[i] == lang and y[i] == 1]
            bad = [getattr(values[i], rule) for i in held if langs[i] == lang and y[i] == 0]
            best = None
            for cut in quality_rules.GRID:
                above = lambda v: sum(math.ceil(x * 50) > round(cut * 50) for x in v)  # noqa: E731, B023
                a, n, p = above(good), len(good), quality_rules.ALPHA / 6
                tail = sum(math.comb(n, k) * p**k * (1 - p) ** (n - k) for k in range(a + 1))
                if not n or tail > quality_rules.DELTA / (6 * len(strata)):
                    break
                gain = above(bad) - quality_rules.GOOD_WEIGHT * a
                if best is None or gain > best[0]:
                    best = (gain, cut)
            limit[lang, rule] = best[1] if best else 1.0
    twice = docs.unionByName(docs.where("doc_id < 50"))
    rows = quality_rules.filter_quality(twice, labels).collect()
    assert len(rows) == len(texts) + 50 and any(v < 1 for v in limit.values())
    for r in rows:
        v = values[r.doc_id]
        out = [x for x in quality_rules.RULES if math.ceil(getattr(v, x) * 50) > round(limit.get((langs[r.doc_id], x), 1.0) * 50)]
        failed = v.n_words < 20 or 100 * v.n_repeat_words > 30 * v.n_words
        assert (r.rejected_by, r.base_failed, r.kept) == (out, failed, not failed and not out)
    assert sum(not r.kept and not r.base_failed for r in rows) > 100
    assert quality_rules.filter_quality(docs.limit(0), labels).count() == 0


def test_license_scan(spark):
    notice = license_scan.TEMPLATES[5][1]
    mit = license_scan.TEMPLATES[0][1].split()
    texts = AWKWARD + [f"Foo. {notice}, version 3.", "Released UNDER the MIT License; cc by-nc 4.0", "apache license, version 2.0 and again Apache License Version 2", " ".join(mit[:30] + ["inserted", "words"] + mit[30:]), "permission is hereby granted to nobody"]
    rows = {r.doc_id: r for r in license_scan.scan(docs_of(spark, texts, extra=True).select("doc_id", "text")).collect()}
    n = len(AWKWARD)
    assert rows[n].labels == ["gpl"] and rows[n].base_labels == [] and rows[n].score >= 0.99
    assert rows[n + 1].base_labels == ["cc-by-nc", "mit"] and rows[n + 1].n_base == 2 and rows[n + 1].first_word == 1
    assert rows[n + 2].n_base == 2 and rows[n + 2].labels == ["apache-2"] and rows[n + 2].last_word == 7
    assert rows[n + 3].labels == ["mit"] and 0.9 < rows[n + 3].score <= 1
    assert rows[n + 4].labels == [] and rows[n + 4].score == 0
    assert all(rows[i].n_words == len(ALNUM.findall((t or "").translate(UP))) for i, t in enumerate(texts))
    assert license_scan.scan(docs_of(spark, []).limit(0)).count() == 0


def test_license_scan_of_awkward_rows(spark):
    """Against its SQL on a fixture: families, repeated rows, ids that are null or shared, clashing columns."""
    import duckdb

    from crossview.llm import oracles

    own = [t for _, t in license_scan.TEMPLATES]
    texts = [own[0], own[8], own[8].replace("Lesser ", ""), own[11] + ". " + own[13], own[13], "x " + own[2][:150], "under the MIT license " * 3, None, "", own[5]]
    rows = [(k // 2 if k != 9 else None, t) for k, t in enumerate(texts)] * 2 + [(3, own[0]), (3, own[3])]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"labels": F.lit("clash"), "n_words": F.lit(-1), "key": F.lit(7)})
    got = license_scan.scan(docs).select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("b"), F.array_join("labels", ",").alias("l"), F.round("score", 9).alias("s")).collect()
    con = duckdb.connect()
    documents = docs.select("doc_id", "text").toPandas()  # noqa: F841
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    want = con.execute(f"select doc_id, n_words, n_base, first_word, last_word, base_labels, labels, round(score, 9) from ({oracles.LICENSE_SCAN})").fetchall()
    assert sorted(map(str, (tuple(r) for r in got))) == sorted(map(str, want))


def test_license_families(spark):
    own = license_scan.TEMPLATES
    work = "This work is licensed under"
    others = [
        (f"{work} the GNU Free Documentation License", []),
        (f"{work} a Creative Commons Attribution NonCommercial ShareAlike 4.0 International License", []),
        ("Licensed under the Educational Community License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at", []),
        (own[8][1].replace("Lesser ", ""), ["gpl"]),
        (own[6][1].replace("GNU General", "GNU Lesser General"), ["lgpl"]),
        (f"{own[13][1]}. {own[11][1]}.", ["cc-by", "cc-by-nc"]),
    ]
    texts = [(text, [label]) for label, text in own] + others
    rows = {r.doc_id: r.labels for r in license_scan.scan(docs_of(spark, [t for t, _ in texts]).select("doc_id", "text")).collect()}
    assert [rows[i] for i in range(len(texts))] == [x for _, x in texts]
    assert license_scan._named([1, 2, 3, 4, 5, 6], [2, 3, 4, 5, 6], 4) == [1, 2] and license_scan._named([1, 2, 3, 4, 5], [4, 5], 4) == [1] and license_scan._named([1, 2], [3], 4) == []


def test_html(spark):
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p><p>no";</script></head><body class="has-sidebar"><header><h2>Site</h2></header><nav><ul><li><a href=x>Home</a></nav>
    <div id="cookie-notice"><p>We use cookies, ok, yes, fine, really, truly.</p></div><main><article><h1>Title &amp; more</h1><div class="post-body"><p>First, a paragraph, of &lt;some&gt; length,
    with   white space.<p>Second <b>bold</b> one<br>line, and more text, to read.</div></article></main><aside><p>Buy, buy, buy, buy, buy, buy, buy.</p></aside><section id="comments"><p>nice, very nice, so nice</p></section><form><p>name</p></form><footer>end</footer>"""
    want = "Title & more\nFirst, a paragraph, of <some> length, with white space.\nSecond bold one line, and more text, to read."
    assert html_extract.main_text(page) == want
    assert html_extract.main_text(None) == "" and html_extract.main_text("plain &lt; text") == "plain < text"
    for odd in ("<", "<b", "<<>>", "</p>", "<p", "<!--", "<script>x", "<a href='", "<table><tr><td>a<td>b", "<div>" * 3000 + "deep"):
        assert isinstance(html_extract.main_text(odd), str)
    d = spark.createDataFrame([(1, "u", page, "clash"), (1, "u", page, "clash"), (2, None, None, "clash")], "page_id long, url string, html string, text string")
    rows = html_extract.extract(d).collect()
    assert [r.n_chars for r in rows] == [len(want), len(want), 0] and html_extract.extract(d.limit(0)).count() == 0


def test_html_keeps_what_belongs_to_the_article():
    kept = ['<h1 class="article-header">A long headline</h1>', '<p class="related-work">Related work, by others, is this one.</p>', '<div class="notice-of-research"><p>A notice, of research, here.</p></div>',
            '<blockquote class="share">A quote, to share, with all.</blockquote>', "<ul><li><a href=1>First ref</a></li><li><a href=2>Second ref</a></li><li><a href=3>Third ref</a></li></ul>"]
    body = "<p>" + "Some words, of a text, that is long enough. " * 6 + "</p>"
    gone = ['<div class="ad">Buy this, now, for less, today only, as long as we have it.</div>', '<div id="comments"><p>Great, really great, thank you, very much.</p></div>', '<div class="share-buttons"><a href=x>Tweet</a></div>', '<p class="advert">An advert, in a paragraph.</p>', "<aside><p>Aside, of it all.</p></aside>", '<section class="related-articles"><p>Another one, to read, of ours.</p></section>', '<div class="cookie-notice">We use cookies, ok, yes.</div>', '<form><p>Your name, please</p></form>', '<div role="navigation"><p>Here, there, and back</p></div>', "<div hidden><p>not, to be, seen</p></div>"]
    text = lambda x: " ".join(re.sub("<[^>]*>", " ", x).split())
    for wrap in ("<article>{}</article>", "<main><div class=post>{}</div></main>", "<div class='post-body'>{}</div>"):
        parts = [body, *(x for pair in itertools.zip_longest(kept[:4], gone, fillvalue="") for x in pair), body]
        page = f"<html><body><header><p>Site, of ours</p></header>{wrap.format(''.join(parts))}<div class=sidebar><p>{'Side, text, and more. ' * 9}</p></div><footer>end</footer></body></html>"
        want = [text(x) for x in parts if x and x not in gone]
        assert html_extract.main_text(page).split("\n") == want, wrap
    listed = f"<article>{body}{kept[4]}{body}</article>"
    assert html_extract.main_text(listed).split("\n")[1:4] == ["First ref", "Second ref", "Third ref"]
    assert html_extract.main_text(f"<body><ul><li><a href=1>Home</a><li><a href=2>News</a><li><a href=3>About</a></ul>{body}{body}</body>").split("\n") == [text(body)] * 2
    # A box with a suspect name that holds the article itself.
    assert html_extract.main_text(f"<body><div class='notice'>{body * 3}</div><p>x</p></body>").split("\n")[:3] == [text(body)] * 3


def test_html_takes_time_in_proportion():
    import time

    for make in (lambda n: "<div>text, of it " * n, lambda n: "<b>" * n + "x" + "<li>y" * n, lambda n: "<a " * n, lambda n: "<p><i>" * n, lambda n: "<!" * n, lambda n: "<ul><li>a" * n + "</ul>" * n):
        t = time.perf_counter()
        out = html_extract.main_text(make(40_000))
        assert time.perf_counter() - t < 3 and isinstance(out, str)
    deep = html_extract.main_text("<div>" * 50 + "<p>one, two, three</p>" * 3 + "</div>" * 50)
    assert deep == "one, two, three\n" * 2 + "one, two, three"


class _Second(html.parser.HTMLParser):
    """A second, plain reading of the test pages: the blocks of their article element."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.inside, self.blocks = False, [""]

    def handle_starttag(self, tag, attrs):
        self.inside = self.inside or tag == "article"
        if tag in ("p", "h1", "h2", "article", "li", "ul"):
            self.blocks.append("")
        elif tag == "br" and self.inside:
            self.blocks[-1] += " "

    def handle_endtag(self, tag):
        if tag in ("p", "h1", "h2", "article", "li", "ul"):
            self.blocks.append("")
        self.inside = self.inside and tag != "article"

    def handle_data(self, data):
        if self.inside:
            self.blocks[-1] += data


def test_html_against_a_second_reading(spark):
    pages = spark.read.parquet("/root/testdata/sf0.01/pages.parquet")
    want = {}
    for r in pages.collect():
        second = _Second()
        second.feed(r.html)
        second.close()
        want[r.page_id] = "\n".join(x for b in second.blocks if (x := " ".join(b.split())))
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(pages).collect()}
    assert got == {k: (v, len(v)) for k, v in want.items()}


def test_warc_round_trip(spark, tmp_path):
    rows = [(i, f"http://h{i % 3}.example.com/p?q={i}", f"<p>{i % 7}</p>" if i % 2 else f"unique é {i}") for i in range(60)]
    rows += [(100, None, None), (101, "", ""), (102, "http://x/a b\r\n", "<p>1</p>"), (5, "http://again", "<p>5</p>"), (5, rows[5][1], rows[5][2]), (None, "http://n", "lonely")]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string")
    archive = warc.write(pages.repartition(3), f"file://{tmp_path}/w", block_lines=5)
    got = warc.lookup(archive, pages).collect()
    assert len(got) == len(rows)
    top = {}
    for i, _, h in rows:
        if i is not None:
            top[h or ""] = max(i, top.get(h or "", i))
    want = collections.Counter()
    for i, _, h in rows:
        raw = (h or "").encode()
        own = top.get(h or "")
        revisit = own is not None and i != own
        want[(i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), "revisit" if revisit else "response", own if revisit else None)] += 1
    assert collections.Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(bytes(r.payload).decode() in {h or "" for _, _, h in rows} for r in got if r.record_type == "response")
    one = warc.lookup(archive, pages.where("page_id = 7")).collect()
    assert [r.page_id for r in one] == [7]
    assert warc.lookup(archive, spark.createDataFrame([("http://nowhere", 1)], "url string, page_id long")).count() == 0
    empty = warc.write(pages.limit(0), f"file://{tmp_path}/e")
    assert empty.shards == [] and warc.lookup(empty, pages).count() == 0
    big = warc.lookup(warc.write(pages, f"file://{tmp_path}/b", min_bytes=10**6), pages).collect()
    assert {r.record_type for r in big} == {"response"}
    assert warc.url_key("https://WWW.Example.com:443/a?b=1") == "com,example,www)/a?b=1"
    import glob
    import gzip

    raw = gzip.open(glob.glob(f"{tmp_path}/w/archive/*.warc.gz")[0]).read()
    assert raw.startswith(b"WARC/1.1\r\nWARC-Type: ") and zlib.crc32(raw)

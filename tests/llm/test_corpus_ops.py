"""Operators that learn from or compare whole corpora: brute force, held-out accuracy, awkward inputs."""

import collections
import itertools
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from crossview.llm import common, components, jaccard_join, lm_scoring, quality_classifier, toxicity
from tests.llm.test_text_ops import ALNUM, AWKWARD, UP, docs_of

DATA = "/root/testdata/sf0.01"
WORDS = [f"word{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choices(WORDS, k=n))


def shingle_set(t):
    w = ALNUM.findall((t or "").translate(UP))
    return frozenset(tuple(w[k : k + 5]) for k in range(len(w) - 4)) if len(w) >= 5 else frozenset([tuple(w)] if w else [])


def brute_groups(docs):
    sets = {i: shingle_set(t) for i, t in docs}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    texts, linked = collections.defaultdict(set), collections.Counter()
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and both >= 0.8 * (len(sets[a]) + len(sets[b]) - both):
            linked[a] += 1
            linked[b] += 1
            if sets[a] != sets[b]:
                texts[a].add(sets[b])
                texts[b].add(sets[a])
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (find(i), len(texts[i]), linked[i]) for i in sets}


@pytest.mark.parametrize("block", [2048, 7])
def test_jaccard_join(spark, block):
    rng = random.Random(11)
    base = [prose(rng, n) for n in (3, 5, 12, 60, 150)]
    texts = AWKWARD + base + base
    for t in base[2:]:  # many near copies of one text, each with words of its own changed
        for _ in range(20):
            w = t.split()
            for _ in range(rng.randint(0, 3)):
                w[rng.randrange(len(w))] = rng.choice(WORDS)
            texts.append(" ".join(w))
    texts += [prose(rng, 50) for _ in range(20)] + ["ONLY. case, differs here now", "only case differs here now"]
    docs = list(enumerate(texts))
    got = {r.doc_id: (r.class_id, r.n_links, r.n_linked_docs) for r in jaccard_join.near_duplicates(docs_of(spark, texts, extra=True), block=block).collect()}
    assert got == brute_groups(docs)


def test_jaccard_filter(spark):
    rng = random.Random(2)
    t = prose(rng, 80)
    d = docs_of(spark, [t, t, t + " tail", prose(rng, 80), None, ""])
    twice = d.unionByName(d.where("doc_id = 3"))
    assert sorted(r.doc_id for r in jaccard_join.drop_near_duplicates(twice).collect()) == [0, 3, 4, 5]
    assert jaccard_join.drop_near_duplicates(d).columns == d.columns
    assert jaccard_join.near_duplicates(d.limit(0)).count() == 0


def test_jaccard_texts_that_share_an_id(spark):
    rng = random.Random(8)
    a, b = prose(rng, 60), prose(rng, 60)
    rows = [(1, a), (1, b), (2, b + " word"), (3, a + " word"), (1, a), (None, a), (4, prose(rng, 60))]
    d = spark.createDataFrame([(i, t, k) for k, (i, t) in enumerate(rows)], "doc_id long, text string, row int")
    got = sorted(((r.doc_id, r.class_id, r.n_copies, r.n_links, r.n_linked_docs) for r in jaccard_join.near_duplicates(d).collect()), key=str)
    assert got == sorted([(1, 1, 2, 1, 2), (1, 1, 2, 1, 2), (1, 1, 1, 1, 1), (2, 1, 1, 1, 1), (3, 1, 1, 1, 2), (None, 1, 2, 1, 2), (4, 4, 1, 0, 0)], key=str)
    kept = jaccard_join.drop_near_duplicates(d).collect()
    assert sorted((r.doc_id or 0, r.text) for r in kept) == sorted([(1, a), (1, b), (0, a), (4, rows[6][1])])


def test_pruning_keeps_likely_pairs():
    from crossview.llm.jaccard_join import least_matches, surviving

    assert least_matches(0.8, 1e-5, 16) < 0.8 * 16
    # The posterior of a uniform prior by numeric integration.
    x = np.linspace(0, 1, 200_001)
    for n, m in ((16, 5), (32, 16), (96, 60)):
        density = x**m * (1 - x) ** (n - m)
        tail = density[x >= 0.8].sum() / density.sum()
        assert (m < least_matches(0.8, 1e-5, n)) == (tail < 1e-5)
    rng = np.random.default_rng(0)
    a = rng.integers(0, 2**32, (3, 96), dtype=np.uint64).astype(np.uint32)
    b = a.copy()
    b[0, :10] += 1
    b[1] = rng.integers(0, 2**32, 96, dtype=np.uint64).astype(np.uint32)
    assert np.diag(surviving(a, b, 0.8, 1e-5, 16)).tolist() == [True, False, True]


def test_overlaps_by_brute_force():
    rng = np.random.default_rng(3)
    core = rng.integers(0, 2**48, 50, dtype=np.uint64)
    sets = [np.unique(np.r_[core[rng.random(50) < 0.9], rng.integers(0, 2**48, 5, dtype=np.uint64)]) for _ in range(60)]
    left, right = np.arange(0, 30), np.arange(20, 60)
    got = jaccard_join.overlaps(sets, left, right)
    assert all(got[i, j] == len(np.intersect1d(sets[a], sets[b])) for i, a in enumerate(left) for j, b in enumerate(right))


def test_components(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(70)] + [(200, 201), (200, 202)], "a long, b long")
    got = {r.node: r.label for r in components.connected_components(edges).collect()}
    assert {got[i] for i in range(71)} == {0} and {got[i] for i in (200, 201, 202)} == {200}
    assert components.connected_components(edges.limit(0)).count() == 0


SPACED = re.compile(r"[^\x20\x09-\x0D]+")


@pytest.mark.parametrize(("order", "chunk"), [(1, 1 << 20), (2, 3000), (3, 1 << 20)])
def test_language_model(spark, order, chunk):
    rng = random.Random(4)
    texts = AWKWARD + [" ".join(rng.choices(WORDS[: rng.choice([5, 50, 400])], k=rng.randint(1, 60))) for _ in range(120)]
    tokens = {i: [*SPACED.findall((t or "").translate(UP)), "\0"] for i, t in enumerate(texts)}
    fold = {i: zlib.crc32(str(i).encode()) % 7 for i in tokens}
    count, history = [collections.Counter() for _ in range(order)], [collections.Counter() for _ in range(order)]
    dev, dev_history = [collections.Counter() for _ in range(order)], [collections.Counter() for _ in range(order)]

    def grams(w):
        full = ["^"] * (order - 1) + w
        for i in range(order - 1, len(full)):
            yield [tuple(full[i - k : i + 1]) for k in range(order)]

    for i, w in tokens.items():
        if fold[i] != 2:
            for g in grams(w):
                for k in range(order):
                    count[k][g[k]] += 1
                    history[k][g[k][:-1]] += 1
                    if fold[i] == 5:
                        dev[k][g[k]] += 1
                        dev_history[k][g[k][:-1]] += 1
    n, v, held = sum(count[0].values()), len(count[0]), sum(dev[0].values())
    bucket = lambda c: 0 if c <= 0 else 1 + int(math.log2(c))

    def estimates(g, less):
        out = [1 / (v + 1), (count[0][g[0]] - less * dev[0][g[0]]) / (n - less * held)]
        for k in range(1, order):
            h = history[k][g[k][:-1]] - less * dev_history[k][g[k][:-1]]
            out.append((count[k][g[k]] - less * dev[k][g[k]]) / h if h else 0.0)
        return np.array(out)

    by = collections.defaultdict(list)
    for i, w in tokens.items():
        if fold[i] == 5:
            for g in grams(w):
                by[bucket(history[-1][g[-1][:-1]] - dev_history[-1][g[-1][:-1]]) if order > 1 else 0].append(estimates(g, 1))
    weights = {}
    for b, rows in by.items():
        p, w = np.array(rows), np.full(order + 1, 1 / (order + 1))
        for _ in range(lm_scoring.ROUNDS):
            share = p * w
            w = (share / share.sum(1, keepdims=True)).sum(0) + 0.5
            w /= w.sum()
        weights[b] = w
    if order > 1 and 0 in weights:
        weights[0][-1] = 0
        weights[0] /= weights[0].sum()
    rows = {r.doc_id: r for r in lm_scoring.score(docs_of(spark, texts, extra=True), order=order, chunk_bytes=chunk).collect()}
    assert set(rows) == set(tokens)
    for i, w in tokens.items():
        r, total = rows[i], 0.0
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (fold[i] == 2, len(w), sum(count[0][(x,)] > 0 for x in w), n)
        assert r.base_score == pytest.approx(sum(math.log10((count[0][(x,)] + 1) / (n + v + 1)) for x in w), rel=1e-9)
        for g in grams(w):
            b = bucket(history[-1][g[-1][:-1]]) if order > 1 else 0
            own = weights[b] if b in weights else weights[min(weights, key=lambda x: (abs(x - b), x))]
            if b == 0 and order > 1 and 0 not in weights:
                own = own.copy()
                own[-1] = 0
                own /= own.sum()
            total += math.log10(own @ estimates(g, 0))
        assert r.score == pytest.approx(total, rel=2e-2)  # the weights come from rounded cells
    assert lm_scoring.score(docs_of(spark, texts).limit(0)).count() == 0
    # Repeated rows, very long ones among them, count as often as they occur and score alike.
    twice = docs_of(spark, [*texts[:40], prose(rng, 20_000)])
    twice = common.stash(twice.unionByName(twice), "twice")
    scores = collections.defaultdict(set)
    for r in lm_scoring.score(twice, order=order, chunk_bytes=chunk).collect():
        scores[r.doc_id].add((round(r.score, 9), r.n_tokens, r.n_known, r.train_tokens))
    held = sum(2 * (len(SPACED.findall((t or "").translate(UP))) + 1) for i, t in enumerate([*texts[:40]]) if fold[i] != 2)
    assert all(len(v) == 1 for v in scores.values()) and len(scores) == 41
    assert next(iter(scores[0]))[3] == held + (2 * 20_001 if zlib.crc32(b"40") % 7 != 2 else 0)


def labels_of(spark, rows, name):
    return spark.createDataFrame([(i, y) for i, y in rows] + [(None, 1), (0, None)], f"doc_id long, {name} int")


def test_toxicity_heldout_accuracy(spark):
    rng = random.Random(6)
    texts, y = list(AWKWARD), [0] * len(AWKWARD)
    for _ in range(600):
        bad = rng.random() < 0.3
        w = prose(rng, rng.randint(5, 60)).split()
        if bad:
            w.insert(rng.randrange(len(w)), rng.choice(["blorgish", "blorgan", "vexpat"]))
        texts.append(" ".join(w))
        y.append(int(bad))
    docs = docs_of(spark, texts, extra=True)
    labels = labels_of(spark, [(i, k) for i, k in enumerate(y)] + [(20, y[20])], "toxic")
    model = toxicity.fit(docs, labels, "toxic", common.fold("doc_id", 4) != 2)
    rows = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(len(texts)) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert np.mean([(rows[i] >= 0.3) == bool(y[i]) for i in held]) > 0.97 and all(0 <= s <= 1 for s in rows.values())
    kept = {r.doc_id for r in toxicity.drop_toxic(docs, labels).collect()}
    assert kept == {i for i, s in rows.items() if s < 0.3}
    alone = toxicity.fit(docs, labels.limit(0), "toxic", F.lit(True))
    assert {round(r.score, 6) for r in toxicity.score(docs, alone).collect()} == {0.0001}
    assert toxicity.drop_toxic(docs, labels.limit(0)).count() == len(texts)
    assert toxicity.score(docs.limit(0), model).count() == 0


def test_toxicity_by_brute_force(spark):
    """Features, weights and scores of a plain version: character n-grams as strings, a dense matrix."""
    rng = random.Random(16)
    words = ["naïve", "日本", "été", *WORDS[:30]]
    texts, y = [], []
    for k in range(240):
        w = rng.choices(words, k=rng.randint(3, 40 if k else 4000))
        y.append(int(rng.random() < 0.4))
        texts.append(" ".join(w + (["Ürgß\tvex 悪い"] if y[-1] and rng.random() < 0.8 else [])))
    texts += ["", None]
    y += [0, 1]
    docs = docs_of(spark, texts, extra=True)
    docs = docs.unionByName(docs.where("doc_id < 5"))
    labels = labels_of(spark, list(enumerate(y)), "toxic").where("toxic is not null")
    sizes = (2, 3, 5)
    model = toxicity.fit(docs, labels, "toxic", F.lit(True), sizes=sizes)
    blank = {ord(c): " " for c in "\t\n\x0b\x0c\r"} | UP
    have = []
    for t in texts:
        c = f" {(t or '').translate(blank)} "
        have.append({c[i : i + n] for n in sizes for i in range(len(c) - n + 1)})
    lab = np.array(y)
    n1, n0 = lab.sum(), len(lab) - lab.sum()
    counts = collections.Counter(g for h in have for g in h)
    ones = collections.Counter(g for h, k in zip(have, y) for g in h if k)
    ratio = {}
    for g, n in counts.items():
        one, zero = ones[g], n - ones[g]
        r, z = toxicity._z(np.array([one]), np.array([zero]), n1, n0, 1.0)
        if abs(z[0]) >= toxicity.MIN_Z:
            ratio[g] = r[0]
    assert len(ratio) == len(model.keys) > 20
    grams = sorted(ratio)
    x = np.array([[ratio[g] * (g in h) for g in grams] for h in have])
    w, b = np.zeros(len(grams)), 0.0
    for _ in range(60):  # Newton steps
        p = 1 / (1 + np.exp(-(x @ w + b)))
        xb = np.c_[x, np.ones(len(x))]
        ridge = np.diag([toxicity.RIDGE] * len(grams) + [0])
        step = np.linalg.solve(xb.T @ (xb * (p * (1 - p))[:, None]) / len(x) + ridge + 1e-9 * np.eye(len(grams) + 1), xb.T @ (p - lab) / len(x) + ridge @ np.r_[w, b])
        w, b = w - step[:-1], b - step[-1]
    share = labels.groupBy().agg(F.avg("toxic")).first()[0]
    b += np.log(share / (1 - share)) - np.log(n1 / n0)
    want = 1 / (1 + np.exp(-(x @ w + b)))
    rows = collections.defaultdict(set)
    for r in toxicity.score(docs, model).collect():
        rows[r.doc_id].add(r.score)
    assert all(len(v) == 1 for v in rows.values())
    got = np.array([rows[i].pop() for i in range(len(texts))])
    assert np.abs(got - want).max() < 0.02


def test_quality_on_held_out_rows(spark):
    docs, labels = (spark.read.parquet(f"{DATA}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality_classifier.score(docs, labels).join(labels, "doc_id").where(common.fold("doc_id", 5) == 0).collect()
    assert np.mean([(r.score >= 0.3) == bool(r.quality) for r in rows]) > 0.9
    odd = docs_of(spark, AWKWARD, extra=True)
    assert all(0 <= r.score <= 1 for r in quality_classifier.score(odd, labels).collect())
    assert {r.score for r in quality_classifier.score(odd, labels.limit(0)).collect()} == {0.5}
    assert quality_classifier.drop_low_quality(odd, labels.limit(0)).columns == odd.columns
    assert quality_classifier.score(odd.limit(0), labels).count() == 0


def _in_memory(basis, x, known, unlabelled):
    cells = basis.cells(x)

    def passes(w, curves):
        total = quality_classifier.Sums.none(len(w))
        for kind, use in enumerate((known, unlabelled)):
            total.add(cells[use], w, kind, curves[kind])
        return total

    return cells, passes


@pytest.mark.parametrize(("prior", "ridge"), [(0.4, 1e-2), (0.95, 1e-3)])
def test_quality_risk_has_its_minimum(prior, ridge):
    """No step in any direction lowers the convex risk; with a prior far too large its second part ends at zero."""
    rng = np.random.default_rng(9)
    good = rng.random(900) < 0.4
    x = np.abs(rng.normal(size=(900, len(quality_classifier.FEATURES))) + good[:, None] * 0.8).astype(np.float32)
    x[:, 3] *= rng.random(900) < 0.2
    counts = np.stack([np.bincount(v, minlength=1 << 16) for v in quality_classifier.levels(x).T])
    basis, known, every = quality_classifier.Basis.of(counts), good & (rng.random(900) < 0.5), np.ones(900, bool)
    cells, passes = _in_memory(basis, x, known, every)
    w = quality_classifier.fit_nnpu(passes, basis.size, (known.sum(), 900), prior, ridge)

    def parts(w):
        z = w[cells].sum(1)
        return prior * np.logaddexp(0, -z[known]).mean() + ridge / 2 * (w[:-1] @ w[:-1]), np.logaddexp(0, z).mean() - prior * np.logaddexp(0, z[known]).mean()

    risk = lambda w: (p := parts(w))[0] + max(0.0, p[1])
    assert (abs(parts(w)[1]) <= 2 * quality_classifier.SLACK) if prior > 0.9 else parts(w)[1] > 0
    least = min(risk(w + size * d / np.linalg.norm(d)) for size in (0.003, 0.03, 0.3, 1) for d in rng.normal(size=(300, len(w))))
    assert risk(w) <= least + 1e-3
    known_w = quality_classifier.fit_known(passes, basis.size, (known.sum(), 900), ridge)
    z = known_w[cells].sum(1)
    slope = np.bincount(cells[known].ravel(), np.repeat((1 / (1 + np.exp(-z[known])) - 1) / known.sum(), cells.shape[1]), basis.size)
    slope += np.bincount(cells.ravel(), np.repeat(1 / (1 + np.exp(-z)) / 900, cells.shape[1]), basis.size)
    slope[:-1] += ridge * known_w[:-1]
    assert np.abs(slope).max() < 2e-3


def test_quality_counts_every_row(spark):
    """Scores equal those of the same fit on all rows in memory, repeated rows and rows of a hundred kB included."""
    rng = random.Random(12)
    texts = list(AWKWARD) + [prose(rng, 30_000)] + [prose(rng, rng.randint(1, 80)) + ("!!! # | " * rng.randint(0, 9)) for _ in range(400)]
    docs = docs_of(spark, texts, extra=True)
    docs = docs.unionByName(docs.where("doc_id % 5 = 1"))
    quality = {i: int("#" not in (t or "")) for i, t in enumerate(texts) if i % 2}
    labels = labels_of(spark, list(quality.items()), "quality")
    keep = lambda i: zlib.crc32(str(i).encode()) % 5 != 0
    rows = quality_classifier.featurised(docs).collect()
    x = np.array([r.x for r in rows], np.float32)
    unl = np.array([keep(r.doc_id) for r in rows])
    known = np.array([quality.get(r.doc_id) == 1 and keep(r.doc_id) for r in rows])
    counts = np.stack([np.bincount(v, minlength=1 << 16) for v in quality_classifier.levels(x[unl]).T])
    basis, n = quality_classifier.Basis.of(counts), (known.sum(), unl.sum())
    for c, e in zip(x[unl].T, basis.edges, strict=True):  # edges are quantiles, to 1 part in 256
        assert all(abs(np.sort(c)[int(np.ceil((c < v).mean() * len(c))) - 1] - v) <= max(v, 1e-3) for v in e)
    _, passes = _in_memory(basis, x, known, unl)
    ridge = max(quality_classifier.RIDGE, quality_classifier.RIDGE_ROWS / n[0])
    first = quality_classifier.Linear(basis, quality_classifier.fit_known(passes, basis.size, n, ridge)).score(x)
    cell = np.minimum((first * quality_classifier.HISTOGRAM).astype(int), quality_classifier.HISTOGRAM - 1)
    tally = np.stack([np.bincount(cell[m], minlength=quality_classifier.HISTOGRAM) for m in (~known, known)])
    prior = quality_classifier.class_prior(tally[1], tally.sum(0))
    want = quality_classifier.Linear(basis, quality_classifier.fit_nnpu(passes, basis.size, n, prior, ridge)).score(x)
    got = {r.doc_id: r.score for r in quality_classifier.score(docs, labels).collect()}
    assert max(abs(got[r.doc_id] - s) for r, s in zip(rows, want, strict=True)) < 1e-6


def test_class_prior():
    pos, unl = np.zeros(100), np.zeros(100)
    pos[60:] = 500
    unl[60:] = 350
    unl[:40] = 150
    assert quality_classifier.class_prior(pos, unl) == pytest.approx(0.7, abs=0.03)
    assert quality_classifier.class_prior(np.zeros(5), np.ones(5)) == 0.5


def test_pipeline_against_brute_force(spark):
    """Every stage on what its predecessor kept, held against its score, brute force or a round trip of ids."""
    from tokenizers import Tokenizer

    import corpus_pipeline as P
    from crossview.llm import packing
    from tests.llm.test_text_ops import brute_hits

    docs = common.table(spark, DATA, "documents")
    want = {r.doc_id for r in docs.collect()}
    texts = {r.doc_id: r.text for r in docs.collect()}
    labels = common.table(spark, DATA, "labels")
    items = [(r.item_id, ALNUM.findall((r.text or "").translate(UP))) for r in common.table(spark, DATA, "benchmark").collect()]
    for name, stage in P.STAGES:
        before, docs = docs, common.stash(stage(spark, docs, DATA), "stage")
        if name == "packing":
            rows = docs.collect()
            tokens = {r.doc_id: r.doc_tokens for r in rows}
            assert set(tokens) == want and sum(r.length for r in rows) == sum(tokens.values())
            tok = Tokenizer.from_file(packing.tokenizer_path())
            assert all(len(tok.encode(texts[i] or "", add_special_tokens=False).ids) + 1 == tokens[i] for i in want)
            break
        got = {r.doc_id for r in docs.collect()}
        assert docs.columns == ["doc_id", "text", "lang", "source", "n_chars"] and got <= want
        if name == "toxicity":
            model = toxicity.fit(before, labels, "toxic", common.fold("doc_id", 4) != 2)
            assert got == {r.doc_id for r in toxicity.score(before, model).collect() if r.score < 0.3}
        if name == "quality classifier":
            assert got == {r.doc_id for r in quality_classifier.score(before, labels).collect() if r.score >= 0.3}
        if name == "near-duplicate join":
            groups = brute_groups([(i, texts[i]) for i in sorted(want)])
            assert got == {g[0] for g in groups.values()}
        if name == "benchmark decontamination":
            grams = {tuple(w[k : k + 13]) for _, w in items if w for k in range(max(1, len(w) - 12))}
            sizes = {len(g) for g in grams}
            clean = set()
            for i in want:
                w = ALNUM.findall((texts[i] or "").translate(UP))
                hit = {p for n in sizes for k in range(len(w) - n + 1) if tuple(w[k : k + n]) in grams for p in range(k, k + n)}
                if not hit or 20 * len(hit) < len(w):
                    clean.add(i)
            assert got == clean and len(clean) < len(want)
            few = brute_hits([(i, texts[i]) for i in sorted(want)[:40]], [(i, " ".join(w)) for i, w in items])
            assert all(few[i][4] == (i not in clean) for i in few)
        want = got


def test_pipeline_stages_on_awkward_documents(spark, tmp_path):
    """Nulls in every column, empty and very long texts, repeated rows, clashing columns, empty tables; and the same with no side rows."""
    import corpus_pipeline as P

    for name in ("labels", "benchmark"):
        side = spark.read.parquet(f"{DATA}/{name}.parquet")
        side.write.parquet(f"{tmp_path}/full/{name}.parquet")
        side.limit(0).write.parquet(f"{tmp_path}/none/{name}.parquet")
    rng = random.Random(21)
    texts = list(AWKWARD) + [prose(rng, 40_000), prose(rng, 50)]
    rows = [(i, t, "en" if i % 2 else None, None, None, "x", -1.0, 5, None) for i, t in enumerate(texts)]
    rows += [rows[-1], rows[2], (None, texts[-1], None, None, 3, "y", 0.0, 1, "z")]
    schema = "doc_id long, text string, lang string, source string, n_chars long, key1 string, score double, n_words int, hit_spans string"
    docs = spark.createDataFrame(rows, schema)
    for side in ("full", "none"):
        for name, stage in P.STAGES[:4]:
            kept = stage(spark, docs, f"{tmp_path}/{side}")
            assert kept.columns == docs.columns and stage(spark, docs.limit(0), f"{tmp_path}/{side}").count() == 0
            out = [tuple(r) for r in kept.collect()]
            assert set(out) <= {tuple(r) for r in rows}
            if side == "none" and name != "near-duplicate join":
                assert sorted(map(str, out)) == sorted(str(tuple(r)) for r in rows)
            if name == "near-duplicate join":  # ids 4 and 5 ... are single; the repeated rows stay once
                assert sorted(map(str, out)) == sorted({str(tuple(r)) for r in rows})
        packed = P.STAGES[4][1](spark, docs, f"{tmp_path}/{side}").collect()
        assert {r.doc_id for r in packed} == {r[0] for r in rows}
        assert P.STAGES[4][1](spark, docs.limit(0), f"{tmp_path}/{side}").count() == 0

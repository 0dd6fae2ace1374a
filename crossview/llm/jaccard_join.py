"""N-gram Jaccard self-join with Bayesian candidate pruning.

A document is the set of its shingles of ``size`` words (lower-cased A-Z,
``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``; a shorter text is one shingle of all its
words). Two documents are linked if their sets' Jaccard similarity is at least
``threshold``.

1. Documents with equal sets form a class, known by its set's hash; the document
   with the smallest id represents it. Everything up to the last step is about
   representatives, so copies are never compared.
2. Representatives that share a band of ``rows`` MinHash values are candidates.
   Each bucket is a star around one member, never all its pairs; the components
   of these stars are the groups inside which links can lie. Two texts at the
   threshold miss each other in all ``bands`` bands with a probability of
   (1 - threshold ** rows) ** bands: 3e-6.
3. Work is cut into units of at most ``2 * block`` representatives. A group of up
   to ``block`` is one unit. In a larger one, which may be a chain of texts that
   are not alike, only members of the same bucket meet: a bucket's members are
   salted into blocks, each pair of blocks is a unit, and a pair of texts is
   judged in the first band that it shares, so once. Either way the pairs judged
   are those that share a band.
4. In a unit MinHash values are compared step by step; a pair whose posterior
   probability of reaching the threshold (from a uniform prior) falls below
   ``tolerance`` is dropped. This needs signatures only. Shingle sets are then
   fetched for the texts that still have a partner, and their pairs are verified
   exactly.
5. A unit returns, for each representative that has links there, how many, and
   the smallest representative that it is connected with; no pair is returned,
   so results grow with the texts and not with the square of a group. The
   components of these are the duplicate groups.

Representatives are known by 64-bit hashes of their sets, and MinHash values are
kept in 16 bits: a chance match of a value only makes pruning more lenient.
Shingles are 48-bit hashes in the exact step: a chance match of two texts with a
thousand shingles each has a probability of 4e-9.

Defined results: texts without words are linked to nothing and are groups of
their own; rows with the same doc_id and text count as copies; rows with the
same doc_id and different texts are separate classes with links of their own (a
class_id is the smallest doc_id of a group, so two groups may then have the same);
an empty table gives no rows; rows without a doc_id have no class; other columns
are ignored by the join and kept by the filter.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .common import drop_path, fresh_path, stash, table
from .components import connected_components, release

SIZE, THRESHOLD = 5, 0.8
BANDS, ROWS = 24, 4
TOLERANCE, STEP = 1e-5, 16
BLOCK, BLOCK_SHINGLES = 2048, 2_000_000

#: A bucket's lowest bits are its band's number.
_BAND_BITS = 127
_RNG = np.random.default_rng(411)
_A = (_RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64) | np.uint64(1)).astype(np.uint32)
_B = _RNG.integers(0, 2**32, BANDS * ROWS, dtype=np.uint64).astype(np.uint32)


def shingles(t: tb.Texts, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Shingle hashes of a block, with repeats, and the text of each, in order of the texts."""
    w = tb.words(t, tb.ALNUM)
    h, doc, counts = tb.word_hashes(t, w), w.doc, w.counts
    x, at = tb.windows(h, w, size)
    own = [doc[at]]
    parts = [x]
    for n in range(1, size):
        short = np.flatnonzero(counts == n)
        if len(short):
            sx, sat = tb.windows(h, w, n)
            keep = counts[doc[sat]] == n
            parts.append(sx[keep] + np.uint64(n))
            own.append(doc[sat][keep])
    x, own = np.concatenate(parts), np.concatenate(own)
    if len(parts) > 1:
        order = np.argsort(own, kind="stable")
        x, own = x[order], own[order]
    return x, own


def _distinct(x: np.ndarray, own: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct shingles in ascending order."""
    order = np.lexsort((x, own))
    x, own = x[order], own[order]
    first = np.r_[True, (x[1:] != x[:-1]) | (own[1:] != own[:-1])] if len(x) else np.empty(0, bool)
    return x[first], own[first]


def signatures(x: np.ndarray, starts: np.ndarray, hashes: int) -> np.ndarray:
    """MinHash values (their 16 low bits), a row for each text; ``starts``: where each text's shingles begin."""
    low = (x >> np.uint64(32)).astype(np.uint32)
    out = np.empty((len(starts), hashes), np.uint16)
    for k in range(hashes):
        v = low * _A[k]
        v ^= v >> np.uint32(15)
        v += _B[k]
        v *= _A[-1 - k] | np.uint32(2)
        v ^= v >> np.uint32(13)
        out[:, k] = np.minimum.reduceat(v, starts).astype(np.uint16)
    return out


def _sign(size: int, hashes: int):
    """doc_id, th, the set's two keys, its size and its signature; keys are null without words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tb.blocks(b.column(2)):
                x, own = _distinct(*shingles(t, size))
                n = np.bincount(own, minlength=t.n)
                some = np.flatnonzero(n)
                starts = np.searchsorted(own, some)
                none = pa.array(n == 0)
                key1, key2, sig = np.zeros(t.n, np.int64), np.zeros(t.n, np.int64), [None] * t.n
                if len(some):
                    key1[some] = np.add.reduceat(tb.mix(x), starts).view(np.int64)
                    key2[some] = np.bitwise_xor.reduceat(tb.mix(x + np.uint64(0x1234567)), starts).view(np.int64)
                    for i, row in zip(some, signatures(x, starts, hashes), strict=True):
                        sig[i] = row.tobytes()
                hide = lambda a: pa.array(a, mask=np.asarray(none))
                own_columns = [b.column(k).slice(t.first, t.n) for k in (0, 1)]
                yield pa.RecordBatch.from_arrays([*own_columns, hide(key1), hide(key2), pa.array(n, pa.int32()), pa.array(sig, pa.binary())], ["doc_id", "th", "key1", "key2", "n", "sig"])

    return run


def _bands(sig: np.ndarray, rows: int) -> np.ndarray:
    """A key of 64 bits for each band of each signature."""
    bands = sig.reshape(len(sig), -1, rows).astype(np.uint64)
    out = np.zeros(bands.shape[:2], np.uint64)
    for k in range(rows):
        out = (out ^ (out >> np.uint64(29))) * np.uint64(0x9E3779B97F4A7C15) + bands[:, :, k]
    return out


def _buckets(rows: int):
    """A row for each representative and band; the low bits of a bucket tell its band."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keys = _bands(_stack(b.column(2).to_pylist()), rows)
            salt = np.arange(1, keys.shape[1] + 1, dtype=np.uint64) * np.uint64(0xA0761D6478BD642F)
            for band in range(keys.shape[1]):
                bucket = tb.mix(keys[:, band] + salt[band]) & ~np.uint64(_BAND_BITS) | np.uint64(band)
                yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(bucket.view(np.int64))], ["node", "n", "bucket"])

    return run


def _stack(signatures: list[bytes]) -> np.ndarray:
    return np.frombuffer(b"".join(signatures), np.uint16).reshape(len(signatures), -1)


def least_matches(threshold: float, tolerance: float, n: int) -> int:
    """The fewest matches of n at which the similarity still reaches the threshold with the tolerated probability.

    With a uniform prior the posterior is a beta distribution, whose upper tail
    at the threshold is P(X <= matches) for a binomial X of n + 1 trials.
    """
    total = 0.0
    for m in range(n + 1):
        total += math.comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        if total >= tolerance:
            return m
    return n


def meeting(a: np.ndarray, b: np.ndarray, band: int) -> np.ndarray:
    """Which pairs of band keys (a row for each text) are judged: those whose first common band is ``band``, or with -1 those with any."""
    out = np.zeros((len(a), len(b)), bool) if band < 0 else a[:, band][:, None] == b[:, band][None, :]
    for k in range(a.shape[1] if band < 0 else band):
        same = a[:, k][:, None] == b[:, k][None, :]
        out = out | same if band < 0 else out & ~same
    return out


def surviving(a: np.ndarray, b: np.ndarray, threshold: float, tolerance: float, step: int, alive: np.ndarray | None = None) -> np.ndarray:
    """Which pairs of signature rows (of those that are ``alive``) outlast the step-by-step comparison."""
    alive = np.ones((len(a), len(b)), bool) if alive is None else alive.copy()
    same = np.zeros((len(a), len(b)), np.uint16)
    hashes = a.shape[1]
    for at in range(0, hashes, step):
        if not alive.any():
            break
        end = min(at + step, hashes)
        if alive.sum() * 8 < alive.size:  # few left: only those
            i, j = np.nonzero(alive)
            same[i, j] += (a[i, at:end] == b[j, at:end]).sum(1).astype(np.uint16)
        else:
            for k in range(at, end):
                same += a[:, k, None] == b[None, :, k]
        alive &= same >= least_matches(threshold, tolerance, end)
    return alive


def overlaps(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Exact sizes of the intersections of each left set with each right set (indices into ``sets``)."""
    rows = np.unique(np.r_[left, right])
    x = np.concatenate([sets[i] for i in rows]) if len(rows) else np.empty(0, np.uint64)
    own = np.repeat(np.arange(len(rows)), [len(sets[i]) for i in rows])
    order = np.argsort(x, kind="stable")
    x, own = x[order], own[order]
    start = np.flatnonzero(np.r_[True, x[1:] != x[:-1]])
    df = np.diff(np.r_[start, len(x)])
    at_left, at_right = np.searchsorted(rows, left), np.searchsorted(rows, right)
    result = np.zeros((len(left), len(right)), np.float32)
    # Shingles of many texts by matrix products, those of a few by counting their pairs.
    common = np.flatnonzero(df >= 24)
    slab = max(64, (16 << 20) // max(len(rows), 1))
    for k in range(0, len(common), slab):
        own_cols = common[k : k + slab]
        m = np.zeros((len(rows), len(own_cols)), np.float32)
        take = np.concatenate([np.arange(start[c], start[c] + df[c]) for c in own_cols])
        m[own[take], np.repeat(np.arange(len(own_cols)), df[own_cols])] = 1
        result += m[at_left] @ m[at_right].T
    pairs = np.zeros(len(rows) * len(rows), np.int32) if len(rows) else np.empty(0, np.int32)
    for d in range(1, 24):
        cols = start[df == d]
        if len(cols):
            members = own[cols[:, None] + np.arange(d)]
            for i in range(d):
                for j in range(d):
                    np.add.at(pairs, members[:, i] * len(rows) + members[:, j], 1)
    return result.astype(np.int64) + pairs.reshape(len(rows), len(rows))[np.ix_(at_left, at_right)]


def _roots(link: np.ndarray, left: np.ndarray, right: np.ndarray, node: np.ndarray) -> np.ndarray:
    """The smallest node that each node is connected with through ``link`` (left by right)."""
    label = node.copy()
    while True:
        old = label.copy()
        big = np.iinfo(np.int64).max
        np.minimum.at(label, left, np.where(link, label[right][None, :], big).min(1))
        np.minimum.at(label, right, np.where(link, label[left][:, None], big).min(0))
        if (label == old).all():
            return label


@dataclass(frozen=True)
class Rule:
    """When two texts are linked, and when a pair is given up."""

    threshold: float
    tolerance: float
    step: int
    rows: int

    def pairs(self, where: tuple[int, int, int], node: np.ndarray, block: np.ndarray, sig: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of a unit (band, p, q) the representatives on both sides that still have partners, and their live pairs."""
        band, p, q = where
        left, right = np.flatnonzero(block == p), np.flatnonzero(block == q)
        keys = _bands(sig, self.rows)
        alive = meeting(keys[left], keys[right], band)
        if p == q:
            np.fill_diagonal(alive, False)
        alive = surviving(sig[left], sig[right], self.threshold, self.tolerance, self.step, alive)
        keep_l, keep_r = alive.any(1), alive.any(0)
        return left[keep_l], right[keep_r], alive[np.ix_(keep_l, keep_r)]

    def links(self, where: tuple[int, int, int], node: np.ndarray, block: np.ndarray, sig: np.ndarray, sets: list[np.ndarray], copies: np.ndarray) -> list[np.ndarray]:
        """(node, root, links, linked documents) of the representatives that have links in a unit."""
        left, right, alive = self.pairs(where, node, block, sig)
        if not len(left):
            return [np.empty(0, np.int64)] * 4
        both = overlaps(sets, left, right)
        n = np.array([len(s) for s in sets])
        union = n[left][:, None] + n[right][None, :] - both
        link = alive & (both >= self.threshold * union - 1e-9)
        root = _roots(link, left, right, node)
        links, docs = np.zeros(len(node), np.int64), np.zeros(len(node), np.int64)
        links[left] += link.sum(1)
        docs[left] += link @ copies[right]
        if where[1] != where[2]:
            links[right] += link.sum(0)
            docs[right] += link.T @ copies[left]
        use = links > 0
        return [node[use], root[use], links[use], docs[use]]


_UNIT = ("unit", "band", "p", "q")


def _units(columns: list[str], work):
    """Apply ``work`` (where, columns by name) to every unit of partitions sorted by :data:`_UNIT`; repeated rows of a node count once."""

    def whole(rows: list[tuple]) -> pa.RecordBatch | None:
        seen, own = set(), []
        for r in rows:
            if r[4] not in seen:
                seen.add(r[4])
                own.append(r)
        return work(rows[0][:4], dict(zip(columns, zip(*(r[4:] for r in own), strict=True), strict=True)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        for b in batches:
            for i in range(0, len(b), 256):
                for r in zip(*(c.to_pylist() for c in b.slice(i, 256).columns), strict=True):
                    if rows and rows[-1][:4] != r[:4]:
                        out, rows = whole(rows), []
                        if out is not None:
                            yield out
                    rows.append(r)
        if rows and (out := whole(rows)) is not None:
            yield out

    return run


def _whole(values) -> np.ndarray:
    return np.array(values, np.int64)


def _prune(rule: Rule):
    """(unit, band, p, q, node, block) of the members that still have a partner."""

    def work(at: tuple, own: dict) -> pa.RecordBatch | None:
        if len(own["node"]) < 2:
            return None
        node, block = _whole(own["node"]), _whole(own["block"])
        left, right, _ = rule.pairs(at[1:], node, block, _stack(own["sig"]))
        use = np.union1d(left, right)
        fixed = [pa.array([x] * len(use), kind) for x, kind in zip(at, (pa.int64(), pa.int32(), pa.int32(), pa.int32()), strict=True)]
        return pa.RecordBatch.from_arrays([*fixed, pa.array(node[use]), pa.array(block[use], pa.int32())], [*_UNIT, "node", "block"]) if len(use) else None

    return _units(["node", "block", "sig"], work)


def _verify(rule: Rule):
    def work(at: tuple, own: dict) -> pa.RecordBatch | None:
        sets = []
        for raw in own["shingles"]:
            wide = np.zeros((len(raw) // 6, 8), np.uint8)
            wide[:, :6] = np.frombuffer(raw, np.uint8).reshape(-1, 6)
            sets.append(wide.view(np.uint64).ravel())
        found = rule.links(at[1:], _whole(own["node"]), _whole(own["block"]), _stack(own["sig"]), sets, _whole(own["copies"]))
        return pa.RecordBatch.from_arrays([pa.array(x) for x in found], ["node", "root", "links", "docs"]) if len(found[0]) else None

    return _units(["node", "block", "copies", "sig", "shingles"], work)


def _shingled(size: int):
    """Members (node, copies, sig, at, text) with their shingles (48 bits each) in place of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            names = b.schema.names
            for t in tb.blocks(b.column(names.index("text"))):
                x, doc = _distinct(*shingles(t, size))
                ends = np.searchsorted(doc, np.arange(t.n + 1))
                raw = (x >> np.uint64(16)).view(np.uint8).reshape(-1, 8)[:, :6].tobytes()
                sets = pa.array([raw[6 * a : 6 * e] for a, e in zip(ends[:-1], ends[1:], strict=True)], pa.binary())
                columns = [b.column(names.index(c)).slice(t.first, t.n) for c in ("node", "copies", "sig", "at")]
                yield pa.RecordBatch.from_arrays([*columns, sets], ["node", "copies", "sig", "at", "shingles"])

    return run


def _classes(docs: DataFrame, size: int, threshold: float, bands: int, rows: int, tolerance: float, block: int) -> tuple[DataFrame, DataFrame, list[str]]:
    """Signed rows (doc_id, th, key1, key2), and representatives (key1, key2, rep_id, th, copies, group, class_id, n_links, linked).

    ``th`` is a hash of a row's text. The list names the folders that the frames read.
    """
    spark, rule = docs.sparkSession, Rule(threshold, tolerance, STEP, rows)
    if bands * rows > len(_A) or bands > _BAND_BITS or not 0 < threshold <= 1:
        raise ValueError(f"at most {len(_A)} MinHash values, and a threshold in (0, 1]")
    paths = {k: fresh_path(spark, k) for k in ("signed", "representatives", "groups", "pruned", "links")}
    keep = lambda df, k: stash(df, k, paths[k])
    text = F.coalesce("text", F.lit(""))
    own = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"), text.alias("text"))
    signed = keep(own.mapInArrow(_sign(size, bands * rows), "doc_id long, th long, key1 long, key2 long, n int, sig binary"), "signed")
    first = F.min(F.struct("doc_id", "th")).alias("r")
    reps = signed.where("key1 is not null and doc_id is not null").groupBy("key1", "key2").agg(first, F.count("*").alias("copies"), F.first("n").alias("n"), F.first("sig").alias("sig"))
    reps = keep(reps.select("key1", "key2", F.col("key1").alias("node"), F.col("r.doc_id").alias("rep_id"), F.col("r.th").alias("th"), "copies", "n", "sig"), "representatives")
    release(spark)

    at = reps.select("node", "n", "sig").mapInArrow(_buckets(rows), "node long, n int, bucket long")
    full = at.groupBy("bucket").agg(F.min("node").alias("pivot"), F.count("*").alias("members"), F.sum("n").alias("size")).where("members > 1")
    stars = at.join(full.select("bucket", "pivot"), "bucket").where("node <> pivot").select("node", "pivot").distinct()
    # All pivots of a representative (at most one a band) are one group: it and they point to the smallest of them,
    # so that a large group has about an edge for each member and not one for each band.
    stars = stars.withColumn("b", F.min("pivot").over(Window.partitionBy("node")))
    stars = stars.select(F.explode(F.array("node", "pivot")).alias("a"), "b").where("a <> b").distinct()
    first_labels: list[str] = []
    labels = connected_components(stars, kept=first_labels).select("node", F.col("label").alias("group")).join(reps.select("node", "n"), "node")
    sizes = labels.groupBy("group").agg(((F.count("*") > block) | (F.sum("n") > BLOCK_SHINGLES)).alias("large"))
    groups = keep(labels.join(sizes, "group").select("node", "n", "group", "large"), "groups")
    drop_path(spark, first_labels[0])
    release(spark)

    whole = F.lit(0).alias
    small = groups.where("not large").select(F.col("group").alias("unit"), F.lit(-1).alias("band"), whole("p"), whole("q"), "node", whole("block"))
    blocks = F.greatest(F.ceil(F.col("members") / block), F.ceil(F.col("size") / BLOCK_SHINGLES)).cast("int")
    large = at.join(groups.where("large").select("node"), "node").join(full, "bucket").withColumn("blocks", blocks)
    large = large.withColumn("block", F.pmod(F.xxhash64("node", "bucket"), F.col("blocks")).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    large = large.select(F.col("bucket").alias("unit"), F.col("bucket").bitwiseAND(F.lit(_BAND_BITS)).cast("int").alias("band"), F.least("block", "other").alias("p"), F.greatest("block", "other").alias("q"), "node", "block")
    dealt = lambda df: df.repartition(*_UNIT).sortWithinPartitions(*_UNIT)
    units = small.unionByName(large).join(reps.select("node", "sig"), "node").select(*_UNIT, "node", "block", "sig")
    pruned = keep(dealt(units).mapInArrow(_prune(rule), "unit long, band int, p int, q int, node long, block int"), "pruned")
    release(spark)

    member = pruned.groupBy("node").agg(F.collect_list(F.struct(*_UNIT, "block")).alias("at")).join(reps.select("node", "rep_id", "th", "copies", "sig"), "node")
    # Ids meet texts by shuffle at every size: plans that change with the data's size would hide what a large run costs.
    texts = own.join(member.withColumnRenamed("rep_id", "doc_id").hint("shuffle_hash"), ["doc_id", "th"]).select("node", "copies", "sig", "at", "text")
    place = ", ".join(f"{c}: {k}" for c, k in zip((*_UNIT, "block"), ("bigint", "int", "int", "int", "int"), strict=True))
    sets = texts.mapInArrow(_shingled(size), f"node long, copies long, sig binary, at array<struct<{place}>>, shingles binary")
    units = sets.select(F.explode("at").alias("u"), "node", "copies", "sig", "shingles").select("u.*", "node", "copies", "sig", "shingles").select(*_UNIT, "node", "block", "copies", "sig", "shingles")
    found = keep(dealt(units).mapInArrow(_verify(rule), "node long, root long, links long, docs long"), "links")
    release(spark)

    last_labels: list[str] = []
    joined = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")), kept=last_labels)
    links = found.groupBy("node").agg(F.sum("links").alias("n_links"), F.sum("docs").alias("linked"))
    linked = reps.join(joined, "node").select("node", F.col("label").alias("group"), "rep_id")
    linked = linked.join(linked.groupBy("group").agg(F.min("rep_id").alias("class_id")), "group").select("node", "group", "class_id").join(links, "node")
    out = reps.select("key1", "key2", "node", "rep_id", "th", "copies").join(linked, "node", "left")
    out = out.select("key1", "key2", "rep_id", "th", "copies", F.coalesce("group", "node").alias("group"), F.coalesce("class_id", "rep_id").alias("class_id"), "n_links", "linked")
    for k in ("groups", "pruned"):
        drop_path(spark, paths[k])
    return signed.select("doc_id", "th", "key1", "key2"), out, [*(paths[k] for k in ("signed", "representatives", "links")), *last_labels]


def near_duplicates(docs: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """A row for each document.

    class_id: the smallest doc_id of its group of links and copies; rep_id: the
    smallest doc_id with the same shingles; n_copies: the documents with the
    same shingles, itself included; n_links: the different texts that it is
    linked to; n_linked_docs: the other documents that it is linked to, its own
    copies included.
    """
    signed, found, _ = _classes(docs, size, threshold, bands, rows, tolerance, block)
    return signed.select("doc_id", "key1", "key2").join(found, ["key1", "key2"], "left").select(
        "doc_id",
        F.coalesce("class_id", "doc_id").alias("class_id"),
        F.coalesce("rep_id", "doc_id").alias("rep_id"),
        F.coalesce("copies", F.lit(1)).alias("n_copies"),
        F.coalesce("n_links", F.lit(0)).alias("n_links"),
        (F.coalesce("linked", F.lit(0)) + F.coalesce("copies", F.lit(1)) - 1).alias("n_linked_docs"),
    )


def drop_near_duplicates(docs: DataFrame, size: int = SIZE, threshold: float = THRESHOLD, bands: int = BANDS, rows: int = ROWS, tolerance: float = TOLERANCE, block: int = BLOCK) -> DataFrame:
    """One document of each group: that with the smallest id, once; rows without a doc_id all stay.

    Of several texts under that id the one with the smallest hash stays, and of
    rows with the same id and text the one whose other columns have the smallest
    hash, so that a task that runs twice keeps the same row.
    """
    spark = docs.sparkSession
    signed, found, paths = _classes(docs, size, threshold, bands, rows, tolerance, block)
    best = found.groupBy("group").agg(F.min(F.struct("rep_id", "th")).alias("r")).select(F.col("r.rep_id").alias("doc_id"), F.col("r.th").alias("th"))
    chosen_path = fresh_path(spark, "chosen")
    wordless = signed.where("key1 is null and doc_id is not null").select("doc_id", "th")
    rows_of = signed.join(best.hint("shuffle_hash"), ["doc_id", "th"], "left_semi").select("doc_id", "th").unionByName(wordless)
    chosen = stash(rows_of.groupBy("doc_id", "th").agg(F.count("*").alias("n")), "chosen", chosen_path)
    for path in paths:
        drop_path(spark, path)
    release(spark)
    th = F.xxhash64(F.coalesce("text", F.lit("")))
    out = docs.withColumn("_th", th).withColumn("_id", F.col("doc_id").cast("long"))
    out = out.join(chosen.select(F.col("doc_id").alias("_id"), F.col("th").alias("_th")).hint("shuffle_hash"), ["_id", "_th"], "left_semi")
    if chosen.where("n > 1").limit(1).count():
        plain = [c for c in docs.columns if not isinstance(docs.schema[c].dataType, T.MapType)]
        out = out.groupBy("_id", "_th").agg(F.min_by(F.struct(*docs.columns), F.xxhash64(*plain)).alias("row")).select("row.*")
    return out.select(*docs.columns).unionByName(docs.where("doc_id is null"))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))

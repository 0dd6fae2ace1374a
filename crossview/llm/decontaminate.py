"""Benchmark decontamination: a broadcast hash set of benchmark n-grams against every token window.

Words are runs of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]`` after lower-casing A-Z. A
window is ``n`` consecutive words of a benchmark item; an item with fewer words
(but at least one) is one window. Documents are scanned once, without a
shuffle: all their windows are hashed, hits in the hash set are verified word by
word, and a document's words inside any verified hit count as hit.

The hash set is broadcast only if the benchmark has at most ``max_windows``
windows and ``max_bytes`` of words, which is counted first: 24 bytes a window in
a worker, and each item's words once. A larger benchmark stays a table of
windows. The documents are then written once with a row number; their windows
that pass a bit table of the benchmark's hashes (8 MB at every size) are joined
to it by two 64-bit hashes, the second of the words themselves and salted by row
against windows that very many documents share; only rows with hits are put
together again by number. Both ways give the same rows.

Defined results: a null or word-free text has no words and no hits; null or
word-free items have no window; windows of items without an id hit, but count as
no item; repeated rows are judged one by one; items that share an id count as
one item; an empty benchmark hits nothing; an empty table gives no rows; other
columns of the documents are kept, those named like a new column (n_words,
hit_spans, hit_items) as ``docs_<name>``; other columns of the benchmark are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .common import stash, table, text_verdict

WINDOW = 13
#: Windows, and bytes of words, in a broadcast hash set.
MAX_WINDOWS, MAX_BYTES = 1_000_000, 64 << 20
#: A document is contaminated if hit words are at least 1 / CONTAMINATED of its words.
CONTAMINATED = 20
#: Beyond the bound: bits of a hash that index the bit table, and copies of each window for hot ones.
TABLE_BITS, SALT = 26, 16

_ADDED = ("n_words", "hit_spans", "hit_items")
_SPANS = T.ArrayType(T.StructType([T.StructField("first", T.LongType()), T.StructField("last", T.LongType())]))
_HITS = [T.StructField("n_words", T.LongType()), T.StructField("hit_spans", _SPANS), T.StructField("hit_items", T.ArrayType(T.StringType()))]


def _normal(t: tb.Texts, w: tb.Words) -> list[bytes]:
    """Each text's lower-cased words, joined by blanks."""
    raw = tb.LOWER[t.data].tobytes()
    spelled = [raw[s:e] for s, e in zip(w.start, w.end, strict=True)]
    return [b" ".join(spelled[a:b]) for a, b in zip(w.woff[:-1], w.woff[1:], strict=True)]


def _items(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Items (item, text) with words: item, words, n."""
    for b in batches:
        for t in tb.blocks(b.column(1)):
            w = tb.words(t, tb.ALNUM)
            some = np.flatnonzero(w.counts)
            words = _normal(t, w)
            yield pa.RecordBatch.from_arrays([b.column(0).slice(t.first, t.n).take(pa.array(some)), pa.array([words[i] for i in some], pa.binary()), pa.array(w.counts[some], pa.int64())], ["item", "words", "n"])


def _item_windows(words: list[bytes], n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """By length of window: the window's hash, its item's index, and where its words begin and end in all items' bytes put together."""
    raw = b"".join(words)
    offs = np.r_[0, np.cumsum([len(x) for x in words])].astype(np.int64)
    t = tb.Texts(np.frombuffer(raw, np.uint8), offs, 0)
    w = tb.words(t, tb.ALNUM)
    h, doc = tb.word_hashes(t, w), w.doc
    for size in sorted({n, *(int(c) for c in np.unique(w.counts) if 0 < c < n)}):
        wh, at = tb.windows(h, w, size)
        if size < n:
            short = w.counts[doc[at]] == size
            wh, at = wh[short], at[short]
        if len(at):
            yield size, wh, doc[at], w.start[at], w.end[at + size - 1]


@dataclass
class Index:
    """The windows of all items: by length a hash set, and for each hash the places in ``raw`` where its windows stand."""

    ids: list[str | None]
    raw: bytes
    by_length: dict[int, tuple[tb.HashSet, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]

    @classmethod
    def of(cls, rows: list[tuple[str | None, bytes]], n: int) -> Index:
        by_length = {}
        for size, h, item, start, end in _item_windows([w for _, w in rows], n):
            order = np.argsort(h, kind="stable")
            known = tb.HashSet(h)
            first = np.searchsorted(h[order], known.values).astype(np.int32)
            by_length[size] = (known, np.r_[first, np.int32(len(h))], item[order].astype(np.int32), start[order].astype(np.int32), end[order].astype(np.int32))
        return cls([i for i, _ in rows], b"".join(w for _, w in rows), by_length)

    def hits(self, t: tb.Texts) -> tuple[np.ndarray, list[list[tuple[int, int]]], list[set[str]]]:
        """Words of each text, its hit words as merged spans (first and last word), and its items."""
        w = tb.words(t, tb.ALNUM)
        h, low, doc = tb.word_hashes(t, w), tb.LOWER[t.data].tobytes(), w.doc
        edge, items = np.zeros(len(h) + 1, np.int32), [set() for _ in range(t.n)]
        for size, (known, first, item, start, end) in self.by_length.items():
            wh, at = tb.windows(h, w, size)
            where, which = known.find(wh)
            for i, k in zip(at[where], which, strict=True):
                own = b" ".join([low[s:e] for s, e in zip(w.start[i : i + size], w.end[i : i + size], strict=True)])
                found = [item[j] for j in range(first[k], first[k + 1]) if self.raw[start[j] : end[j]] == own]
                if found:
                    edge[i] += 1
                    edge[i + size] -= 1
                    items[doc[i]].update(self.ids[j] for j in found if self.ids[j] is not None)
        return w.counts, _merged(edge, w), items


def _merged(edge: np.ndarray, w: tb.Words) -> list[list[tuple[int, int]]]:
    """The spans (first and last word) of each text at which the running sum of ``edge`` is above zero."""
    covered, doc = np.flatnonzero(np.cumsum(edge[:-1]) > 0), w.doc
    spans: list[list[tuple[int, int]]] = [[] for _ in range(len(w.woff) - 1)]
    if len(covered):
        new = np.flatnonzero(np.r_[True, (np.diff(covered) > 1) | (doc[covered[1:]] != doc[covered[:-1]])])
        for a, b in zip(covered[new], covered[np.r_[new[1:], len(covered)] - 1], strict=True):
            spans[doc[a]].append((int(a - w.woff[doc[a]]), int(b - w.woff[doc[a]])))
    return spans


def _added(n_words: list[np.ndarray], spans: list[list[tuple[int, int]]], items: list[list[str]]) -> list[pa.Array]:
    ends = np.r_[0, np.cumsum([len(s) for s in spans])]
    span = pa.StructArray.from_arrays([pa.array([s[k] for own in spans for s in own], pa.int64()) for k in (0, 1)], ["first", "last"])
    return [pa.array(np.concatenate(n_words) if n_words else [], pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), span), pa.array(items, pa.list_(pa.string()))]


def _scan(index: Index, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            n_words, spans, items = [], [], []
            for t in tb.blocks(b.column(text_at)):
                counts, own, found = index.hits(t)
                n_words.append(counts)
                spans += own
                items += [sorted(x) for x in found]
            yield pa.RecordBatch.from_arrays([*b.columns, *_added(n_words, spans, items)], [*b.schema.names, *_ADDED])

    return run


def _benchmark(benchmark: DataFrame, n: int, max_windows: int, max_bytes: int) -> tuple[DataFrame, Index | None]:
    """The items' words, and the hash set of their windows if these are within the bounds."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item"), "text").mapInArrow(_items, "item string, words binary, n long")
    size = items.agg(F.sum(F.greatest(F.lit(1), F.col("n") - (n - 1))).alias("windows"), F.sum(F.length("words")).alias("bytes")).first()
    if (size.windows or 0) > max_windows or (size.bytes or 0) > max_bytes:
        return items, None
    return items, Index.of(sorted(((r.item, bytes(r.words)) for r in items.select("item", "words").collect()), key=lambda r: (r[0] is None, r)), n)


# Beyond the bounds.
_WINDOWS = "length int, hash long, check long, item string"


def _check(words: bytes) -> int:
    return int.from_bytes(blake2b(words, digest_size=8).digest(), "big", signed=True)


def _window_rows(n: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, words = b.column(0).to_pylist(), b.column(1).to_pylist()
            raw = b"".join(words)
            for size, h, item, start, end in _item_windows(words, n):
                columns = [pa.array(np.full(len(h), size), pa.int32()), pa.array(h.view(np.int64)), pa.array([_check(raw[s:e]) for s, e in zip(start, end, strict=True)], pa.int64()), pa.array([ids[i] for i in item], pa.string())]
                yield pa.RecordBatch.from_arrays(columns, ["length", "hash", "check", "item"])

    return run


def _bits(table: pa.Table) -> pa.Table:
    """The bits of a part of the bit table."""
    bits = np.zeros(1 << 16, np.uint8)
    bits[np.asarray(table.column("low"))] = 1
    return pa.Table.from_arrays([table.column("part").slice(0, 1), pa.array([np.packbits(bits).tobytes()], pa.binary())], ["part", "bits"])


def _candidates(bits: bytes, sizes: list[int], row_at: int, text_at: int):
    """Windows (row, at, length, hash, check) whose hash is in the bit table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lut = np.frombuffer(bits, np.uint8)
        for b in batches:
            rows = np.asarray(b.column(row_at))
            for t in tb.blocks(b.column(text_at)):
                w = tb.words(t, tb.ALNUM)
                h, low, doc = tb.word_hashes(t, w), tb.LOWER[t.data].tobytes(), w.doc
                for size in sizes:
                    wh, at = tb.windows(h, w, size)
                    cell = wh >> tb.U64(64 - TABLE_BITS)
                    use = np.flatnonzero((lut[cell >> tb.U64(3)] >> (7 - (cell & tb.U64(7))).astype(np.uint8)) & 1)
                    if len(use):
                        where = at[use]
                        check = [_check(b" ".join([low[s:e] for s, e in zip(w.start[i : i + size], w.end[i : i + size], strict=True)])) for i in where]
                        columns = [pa.array(rows[t.first + doc[where]]), pa.array(where - w.woff[doc[where]]), pa.array(np.full(len(use), size), pa.int32()), pa.array(wh[use].view(np.int64)), pa.array(check, pa.int64())]
                        yield pa.RecordBatch.from_arrays(columns, ["row", "at", "length", "hash", "check"])

    return run


def _joined(text_at: int):
    """Rows with their hits (lists at, length, items; null if none) in place of these the columns of :data:`_HITS`."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            keep = b.num_columns - 2
            places, found = b.column(keep).to_pylist(), b.column(keep + 1).to_pylist()
            n_words, spans, items = [], [], [sorted(x or []) for x in found]
            for t in tb.blocks(b.column(text_at)):
                w = tb.words(t, tb.ALNUM)
                edge = np.zeros(len(w.start) + 1, np.int32)
                for k in range(t.n):
                    for p in places[t.first + k] or ():
                        edge[w.woff[k] + p["at"]] += 1
                        edge[w.woff[k] + p["at"] + p["length"]] -= 1
                n_words.append(w.counts)
                spans += _merged(edge, w)
            yield pa.RecordBatch.from_arrays([*b.columns[:keep], *_added(n_words, spans, items)], [*b.schema.names[:keep], *_ADDED])

    return run


def _by_join(docs: DataFrame, items: DataFrame, n: int) -> DataFrame:
    """``docs`` with the columns of :data:`_HITS`, by a join of windows."""
    windows = stash(items.select("item", "words").mapInArrow(_window_rows(n), _WINDOWS).distinct(), "windows")
    docs = stash(docs.withColumn("_row", F.monotonically_increasing_id()), "numbered")  # stored: a row keeps its number
    top = F.shiftrightunsigned("hash", 64 - TABLE_BITS)
    cells = windows.select(F.shiftrightunsigned(top, 16).alias("part"), top.bitwiseAND(F.lit(0xFFFF)).alias("low")).distinct()
    parts = {r.part: bytes(r.bits) for r in cells.groupBy("part").applyInArrow(_bits, "part long, bits binary").collect()}
    bits = b"".join(parts.get(k, bytes(1 << 13)) for k in range(1 << (TABLE_BITS - 16)))
    sizes = sorted(r.length for r in windows.select("length").distinct().collect())
    names = docs.columns
    asked = docs.select("_row", "text").mapInArrow(_candidates(bits, sizes, 0, 1), "row long, at long, length int, hash long, check long")
    salted = windows.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALT - 1))))
    found = asked.withColumn("salt", F.pmod(F.col("row"), F.lit(SALT)).cast("int")).join(salted, ["hash", "check", "length", "salt"]).select("row", "at", "length", "item")
    found = stash(found, "hits")
    places = found.groupBy("row").agg(F.collect_set(F.struct("at", "length")).alias("_places"))
    named = found.where("item is not null").select("row", "item").distinct().groupBy("row").agg(F.collect_list("item").alias("_items"))
    hits = places.join(named, "row", "left").withColumnRenamed("row", "_row")
    kept = [c for c in names if c != "_row"]
    out = docs.join(hits, "_row", "left").select(*kept, "_places", "_items")
    schema = T.StructType([*(docs.schema[c] for c in kept), *_HITS])
    return out.mapInArrow(_joined(kept.index("text")), schema)


def find_hits(docs: DataFrame, benchmark: DataFrame, n: int = WINDOW, max_windows: int = MAX_WINDOWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """``docs`` with n_words, hit_spans (first and last hit word, merged) and hit_items (sorted ids)."""
    if n < 1:
        raise ValueError("n must be positive")
    items, index = _benchmark(benchmark, n, max_windows, max_bytes)
    docs = docs.withColumnsRenamed({c: f"docs_{c}" for c in _ADDED if c in docs.columns})
    if index is None:
        return _by_join(docs, items, n)
    return docs.mapInArrow(_scan(index, docs.columns.index("text")), T.StructType([*docs.schema.fields, *_HITS]))


_N_HIT = "aggregate(hit_spans, 0L, (a, s) -> a + s.last - s.first + 1)"


def digest(hits: DataFrame) -> DataFrame:
    """The query's columns from :func:`find_hits`."""
    n_hit = F.expr(_N_HIT)
    return hits.select(
        "doc_id",
        "n_words",
        n_hit.alias("n_hit"),
        F.size("hit_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("hit_items"), ","), 256).alias("items_sha256"),
        ((n_hit > 0) & (F.lit(CONTAMINATED) * n_hit >= F.col("n_words"))).alias("contaminated"),
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, remove: str = "documents", n: int = WINDOW, max_windows: int = MAX_WINDOWS, max_bytes: int = MAX_BYTES) -> DataFrame:
    """Drop contaminated documents, or (``remove="spans"``) cut the hit words out of every text.

    Without hit words a text stays as it is. Spans are cut from the first byte
    of the first hit word to the first byte of the next word that is not hit.
    """
    if remove not in ("documents", "spans"):
        raise ValueError("remove is 'documents' or 'spans'")
    if n < 1:
        raise ValueError("n must be positive")
    items, index = _benchmark(benchmark, n, max_windows, max_bytes)
    if remove == "documents" and index is not None:

        def clean(text: pa.Array) -> pa.Array:
            out = [np.empty(0, bool)]
            for t in tb.blocks(text):
                counts, spans, _ = index.hits(t)
                n_hit = np.array([sum(b - a + 1 for a, b in s) for s in spans])
                out.append((n_hit == 0) | (CONTAMINATED * n_hit < counts))
            return pa.array(np.concatenate(out))

        return docs.where(text_verdict(docs, clean))
    own = docs.select(F.struct(*docs.columns).alias("row"), "text")
    schema = T.StructType([*own.schema.fields, *_HITS])
    hits = _by_join(own, items, n) if index is None else own.mapInArrow(_scan(index, 1), schema)
    if remove == "documents":
        n_hit = F.expr(_N_HIT)
        return hits.where(~((n_hit > 0) & (F.lit(CONTAMINATED) * n_hit >= F.col("n_words")))).select("row.*")
    return hits.select("row.*", "hit_spans").mapInArrow(_cut(docs.columns.index("text")), T.StructType(docs.schema.fields))


def _cut(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            spans, texts = b.column(b.num_columns - 1).to_pylist(), b.column(text_at).to_pylist()
            for i, own in enumerate(spans):
                if own:
                    raw = texts[i].encode()
                    t = tb.Texts(tb.LOWER[np.frombuffer(raw, np.uint8)], np.array([0, len(raw)]), 0)
                    w, out, at = tb.words(t, tb.ALNUM), [], 0
                    for s in sorted(own, key=lambda s: s["first"]):
                        out.append(raw[at : w.start[s["first"]]])
                        at = w.start[s["last"] + 1] if s["last"] + 1 < len(w.start) else len(raw)
                    texts[i] = b"".join([*out, raw[at:]]).decode(errors="ignore")
            columns = list(b.columns[:-1])
            columns[text_at] = pa.array(texts, columns[text_at].type)
            yield pa.RecordBatch.from_arrays(columns, b.schema.names[:-1])

    return run


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return digest(find_hits(docs, table(spark, sf_dir, "benchmark")))


#: The same result in DuckDB: all 13-word windows of both tables, joined on their words.
ORACLE = r"""
with d as (
  select row_number() over () as r, doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from documents
), b as (
  select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark
), bl as (select item_id, w, least(13, len(w)) as n from b where len(w) > 0
), bw as (select distinct item_id, n, array_to_string(list_slice(w, i, i + n - 1), ' ') as g from (select item_id, w, n, unnest(range(1, len(w) - n + 2)) as i from bl)
), sizes as (select distinct n from bw
), dw as (select r, n, i, array_to_string(list_slice(w, i, i + n - 1), ' ') as g from (select r, w, n, unnest(range(1, len(w) - n + 2)) as i from d, sizes where len(w) >= n)
), hit as (select r, dw.n, i, item_id from dw join bw using (n, g)
), places as (select r, count(distinct p) as n_hit from (select r, unnest(range(i, i + n)) as p from (select distinct r, i, n from hit)) group by r
), found as (select r, count(distinct item_id) as n_items, string_agg(distinct cast(item_id as varchar), ',' order by cast(item_id as varchar)) as ids from hit group by r)
select doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(n_hit, 0) as bigint) as n_hit, cast(coalesce(n_items, 0) as bigint) as n_items,
  sha256(coalesce(ids, '')) as items_sha256, coalesce(n_hit, 0) > 0 and 20 * coalesce(n_hit, 0) >= len(w) as contaminated
from d left join places using (r) left join found using (r)
"""

"""Language-model scoring by deleted interpolation.

The model is a word n-gram model. A word's probability mixes its
maximum-likelihood estimates after ever longer histories, its share of all
training tokens and a uniform share; the weights depend on how often the
longest history was seen, by powers of two, and are learnt by
expectation-maximisation on held-out counts: one fold of the training texts
is deleted from all counts, and its tokens are predicted from the rest. The
final counts take that fold in again.

Nothing of the model is held in one place. Texts are worked on in chunks, parts
of a scan's partition with at most ``CHUNK_BYTES`` of text:

1. A chunk hashes its n-grams and sends each *distinct* one once, with its
   training and deleted-fold counts, to the part that owns its range of hashes.
   A word that is everywhere is one entry from each chunk, so no part is hot.
2. A part adds up and answers each chunk with the totals, in the order asked;
   the answers are written to the shared folder, a folder for each of the scan's
   partitions with about a file for each chunk. The sums of all tokens and types
   stand apart, so the driver lists one folder whatever the number of partitions.
3. The scan is repeated. A chunk reads its answers, knows all counts of all its
   tokens, and gives first the held-out statistics (numbers of tokens in cells
   of rounded estimates, a bounded table), then, once the weights are known,
   its texts' scores.

Chunks are told by partition and place, which a scan of files repeats; a check
sum over each chunk's hashes stops the job if the rows came in another order.
Pass other inputs through ``common.stash`` first.

Defined results: a null text is empty and has the end token only; repeated rows
score alike; an empty table gives no rows; without training texts every token
has the uniform probability; other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import sharedfs
from . import textbytes as tb
from .common import fresh_path, path_exists, table

ORDER, CHUNK_BYTES, MAX_PARTS = 2, 4 << 20, 1 << 16
#: Of crc32(doc_id) mod FOLDS, the fold that is scored only, and the training fold deleted to learn the weights.
FOLDS, HELD_OUT, DELETED = 7, 2, 5
ROUNDS, BUCKETS, STEPS = 200, 40, 4

_END, _BEGIN = np.uint64(0x5E0D5E0D5E0D5E0D), np.uint64(0xBE61BE61BE61BE61)


def fold_of(doc_id: int | None, folds: int) -> int:
    return 0 if doc_id is None else zlib.crc32(str(doc_id).encode()) % folds


@dataclass
class Chunk:
    """Some whole texts as tokens: ``grams[k]`` are the hashes of the (k + 1)-grams that end at each token."""

    name: tuple[int, int]
    """The partition, and the chunk's number in it."""
    ids: list
    first: np.ndarray
    """The index of each text's first token, and the number of tokens at the end."""
    grams: list[np.ndarray]

    @property
    def doc(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.ids)), np.diff(self.first))

    def folds(self, folds: int) -> np.ndarray:
        return np.array([fold_of(i, folds) for i in self.ids], np.int64)


def _tokens(t: tb.Texts) -> tuple[np.ndarray, np.ndarray]:
    """Token hashes of a block's texts, each with its end token, and the tokens of each text."""
    w = tb.words(t, tb.SPACED)
    out = np.empty(len(w.start) + t.n, np.uint64)
    out[np.arange(len(w.start)) + w.doc] = tb.word_hashes(t, w)
    out[w.woff[1:] + np.arange(t.n)] = _END
    return out, w.counts + 1


def _chunk(name: tuple[int, int], ids: list, tokens: list[np.ndarray], counts: list[np.ndarray], order: int) -> Chunk:
    grams = [np.concatenate(tokens)]
    first = np.r_[0, np.cumsum(np.concatenate(counts))]
    for _ in range(1, order):
        last = grams[-1]
        history = np.empty_like(last)
        history[1:] = last[:-1]
        history[first[:-1]] = _BEGIN
        grams.append(tb.mix((history ^ (history >> np.uint64(31))) * np.uint64(0xC2B2AE3D27D4EB4F) + grams[0]))
    return Chunk(name, ids, first, grams)


def chunks(batches: Iterator[pa.RecordBatch], order: int, chunk_bytes: int) -> Iterator[Chunk]:
    """Cut a partition (doc_id, text) into chunks."""
    where, n, size = TaskContext.get().partitionId(), 0, 0
    ids, tokens, counts = [], [], []
    for b in batches:
        own = b.column(0).to_pylist()
        for t in tb.blocks(b.column(1)):
            if size and size + len(t.data) > chunk_bytes:
                yield _chunk((where, n), ids, tokens, counts, order)
                ids, tokens, counts, size, n = [], [], [], 0, n + 1
            h, c = _tokens(t)
            ids += own[t.first : t.first + t.n]
            tokens.append(h)
            counts.append(c)
            size += len(t.data) + 1
    if ids:
        yield _chunk((where, n), ids, tokens, counts, order)


def _part(keys: np.ndarray, parts: int) -> np.ndarray:
    """The part that owns each hash; parts own ranges in ascending order."""
    return ((keys >> np.uint64(32)) * np.uint64(parts)) >> np.uint64(32)


def _distinct(chunk: Chunk, level: int) -> np.ndarray:
    keys = np.sort(np.r_[chunk.grams[level], np.full(int(level == 0), _BEGIN)])
    return keys[np.r_[True, keys[1:] != keys[:-1]]]


def _occurrences(keys: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    out = np.zeros(len(keys), np.uint32)
    if len(tokens):
        own = np.sort(tokens)
        start = np.flatnonzero(np.r_[True, own[1:] != own[:-1]])
        out[np.searchsorted(keys, own[start])] = np.diff(np.r_[start, len(own)])
    return out


def _ask(order: int, chunk_bytes: int, parts: int, folds: tuple[int, int, int]):
    """A row for each chunk, level and part: the distinct hashes, and their training and deleted counts."""
    total, held, deleted = folds

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for c in chunks(batches, order, chunk_bytes):
            fold = c.folds(total)
            for level in range(order):
                keys, by = _distinct(c, level), fold[c.doc]
                train, dev = (_occurrences(keys, c.grams[level][m]) for m in (by != held, by == deleted))
                if level == 0:  # how many texts begin
                    k = np.searchsorted(keys, _BEGIN)
                    train[k], dev[k] = (fold != held).sum(), (fold == deleted).sum()
                cut = np.searchsorted(_part(keys, parts), np.arange(parts + 1, dtype=np.uint64))
                rows = [(p, *c.name, level, tb.keys_out(keys[a:b]), tb.planes(train[a:b]), tb.planes(dev[a:b])) for p, (a, b) in enumerate(zip(cut[:-1], cut[1:], strict=True)) if a < b]
                kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(zip(*rows, strict=True), kinds, strict=True)], ["part", "place", "chunk", "level", "keys", "train", "dev"])

    return run


_SUMS = -1
_ANSWER = "part long, place int, chunk int, level int, n long, check long, train binary, dev binary, tokens long, types long, dev_tokens long"


def _answer(asked: pa.Table) -> pa.Table:
    """Totals for one part: a row for each chunk and level, and one (place -1) with the part's token and type counts."""
    part, out = asked.column("part")[0].as_py(), []
    levels = np.asarray(asked.column("level"))
    for level in np.unique(levels):
        own = asked.filter(pa.array(levels == level))
        names = list(zip(own.column("place").to_pylist(), own.column("chunk").to_pylist(), strict=True))
        keys = [tb.keys_in(x.as_py()) for x in own.column("keys")]
        every, where = np.unique(np.concatenate(keys), return_inverse=True)
        train, dev = (np.bincount(where, np.concatenate([tb.unplanes(x.as_py(), np.uint32) for x in own.column(c)]), len(every)).astype(np.int64) for c in ("train", "dev"))
        if level == 0:
            word = every != _BEGIN
            out.append((part, _SUMS, 0, 0, 0, 0, b"", b"", int(train[word].sum()), int((train[word] > 0).sum()), int(dev[word].sum())))
        at = 0
        for name, k in zip(names, keys, strict=True):
            mine = where[at : at + len(k)]
            at += len(k)
            out.append((part, *name, int(level), len(k), int(np.bitwise_xor.reduce(k).view(np.int64)), tb.planes(train[mine]), tb.planes(dev[mine]), 0, 0, 0))
    kinds = [pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
    names = ["part", "place", "chunk", "level", "n", "check", "train", "dev", "tokens", "types", "dev_tokens"]
    return pa.Table.from_arrays([pa.array(x, k) for x, k in zip(zip(*out, strict=True), kinds, strict=True)], names)


class Answers:
    """The answers of one partition's chunks: which row groups of which files hold each chunk, and their rows."""

    def __init__(self, folder: str):
        self.folder, self.place, self.held = folder, None, {}

    def _open(self, place: int) -> None:
        self.store, path = sharedfs.resolve(f"{self.folder}/place={place}")
        self.place, self.held = place, {}
        for info in self.store.get_file_info(fs.FileSelector(path)):
            if info.path.endswith(".parquet"):
                with self.store.open_input_file(info.path) as f:
                    about = pq.ParquetFile(f, pre_buffer=False).metadata
                at = next(i for i in range(about.num_columns) if about.schema.column(i).path == "chunk")
                for g in range(about.num_row_groups):
                    s = about.row_group(g).column(at).statistics
                    for chunk in range(s.min, s.max + 1):
                        self.held.setdefault(chunk, []).append((info.path, g))

    def rows(self, name: tuple[int, int], columns: list[str]) -> Iterator[dict]:
        if self.place != name[0]:
            self._open(name[0])
        for path, g in self.held.get(name[1], []):
            with self.store.open_input_file(path) as f:
                group = pq.ParquetFile(f, pre_buffer=False).read_row_group(g, columns=["chunk", *columns], use_threads=False)
            yield from group.filter(pc.equal(group.column("chunk"), name[1])).select(columns).to_pylist()


def _totals(c: Chunk, answers: Answers, kinds: tuple[str, ...], use: np.ndarray | slice = slice(None)) -> list[tuple[list[np.ndarray], list[np.ndarray]]]:
    """For each kind (train, dev) the counts of a chunk's tokens, and of their histories, level by level, at the tokens ``use``."""
    out, last, begun = [([], []) for _ in kinds], {}, {}
    by_level: dict[int, list[dict]] = {}
    for r in answers.rows(c.name, ["part", "level", "n", "check", *kinds]):
        by_level.setdefault(r["level"], []).append(r)
    for level, grams in enumerate(c.grams):
        own = sorted(by_level.pop(level, []), key=lambda r: r["part"])
        keys, where = np.unique(np.r_[grams, np.full(int(level == 0), _BEGIN)], return_inverse=True)
        at = 0
        for r in own:
            mine = keys[at : at + r["n"]]
            at += r["n"]
            if len(mine) != r["n"] or int(np.bitwise_xor.reduce(mine).view(np.int64)) != r["check"]:
                raise RuntimeError("the rows came in another order than before; stash the input first")
        if at != len(keys):
            raise RuntimeError("the rows came in another order than before; stash the input first")
        for kind, (totals, histories) in zip(kinds, out, strict=True):
            total = np.concatenate([tb.unplanes(r[kind], np.int64) for r in own])[where]
            if level == 0:
                begun[kind], total = total[-1], total[:-1]
                histories.append(np.empty(0, np.int64))
            else:
                before = np.empty_like(last[kind])
                before[1:] = last[kind][:-1]
                before[c.first[:-1]] = begun[kind]
                histories.append(before[use])
            totals.append(total[use])
            last[kind] = total
    return out


def bucket(history: np.ndarray) -> np.ndarray:
    """0 for a history never seen, else one more than the logarithm of its count, rounded down."""
    return np.where(history > 0, 1 + np.floor(np.log2(np.maximum(history, 1))).astype(np.int64), 0).clip(0, BUCKETS - 1)


def _estimates(train: list[np.ndarray], history: list[np.ndarray], tokens: int) -> list[np.ndarray]:
    """Maximum-likelihood estimates of each level at every token."""
    out = [train[0] / max(tokens, 1)]
    for k in range(1, len(train)):
        out.append(np.divide(train[k], history[k], out=np.zeros(len(train[k])), where=history[k] > 0))
    return out


def _cells(order: int, chunk_bytes: int, folder: str, folds: tuple[int, int, int], tokens: int):
    """Held-out tokens by bucket and rounded estimates: their number and their estimates' sums."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(folder)
        for c in chunks(batches, order, chunk_bytes):
            use = np.flatnonzero((c.folds(folds[0]) == folds[2])[c.doc])
            if not len(use):
                continue
            (train, history), (dev, dev_history) = _totals(c, answers, ("train", "dev"), use)
            less = lambda a, b: [x - y for x, y in zip(a, b, strict=True)]
            history = less(history, dev_history)
            p = _estimates(less(train, dev), history, tokens)
            code = bucket(history[-1]) if order > 1 else np.zeros(len(use), np.int64)
            for x in p:
                code = code * 1024 + np.where(x > 0, np.floor(np.log2(np.maximum(x, 1e-60)) * STEPS).astype(np.int64) + 1000, 0).clip(0, 1023)
            cell, where = np.unique(code, return_inverse=True)
            sums = [np.bincount(where, x) for x in p]
            yield pa.RecordBatch.from_arrays([pa.array(cell), pa.array(np.bincount(where).astype(np.int64)), pa.array(list(np.stack(sums, 1)), pa.list_(pa.float64()))], ["cell", "n", "sums"])

    return run


def learn_weights(cells: list[tuple[int, int, list[float]]], order: int, uniform: float, rounds: int = ROUNDS) -> np.ndarray:
    """By bucket the weights of uniform share, unigram, ..., n-gram; by expectation-maximisation over the cells."""
    out = np.full((BUCKETS, order + 1), np.nan)
    by: dict[int, list] = {}
    for cell, n, sums in cells:
        by.setdefault(cell >> (10 * order), []).append((n, *(x / n for x in sums)))
    for b, rows in by.items():
        a = np.array(rows)
        n, p = a[:, 0], np.c_[np.full(len(a), uniform), a[:, 1:]]
        w = np.full(order + 1, 1 / (order + 1))
        for _ in range(rounds):
            share = p * w
            # Half a token each keeps every component alive, so that no text has probability zero.
            new = (n[:, None] * share / np.maximum(share.sum(1, keepdims=True), 1e-300)).sum(0) + 0.5
            new /= new.sum()
            done = np.abs(new - w).max() < 1e-9
            w = new
            if done:
                break
        out[b] = w
    known = [b for b in range(BUCKETS) if b in by]
    for b in range(BUCKETS):
        if b not in by:  # as the nearest bucket that has tokens
            out[b] = out[min(known, key=lambda x: (abs(x - b), x))] if known else np.r_[1.0, np.zeros(order)]
    if order > 1:  # an unseen history has no estimate to weigh
        out[0, -1] = 0
        out[0] /= out[0].sum()
    return out


def _score(order: int, chunk_bytes: int, folder: str, folds: tuple[int, int, int], tokens: int, types: int, weights: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        answers = Answers(folder)
        for c in chunks(batches, order, chunk_bytes):
            (train, history), doc = _totals(c, answers, ("train",))[0], c.doc
            own = bucket(history[-1]) if order > 1 else np.zeros(len(doc), np.int64)
            total = weights[own, 0] / (types + 1)
            for k, x in enumerate(_estimates(train, history, tokens)):
                total += weights[own, k + 1] * x
            per_text = lambda x: np.bincount(doc, x, len(c.ids))
            columns = [
                pa.array(c.ids, pa.int64()),
                pa.array(c.folds(folds[0]) == folds[1]),
                pa.array(np.diff(c.first)),
                pa.array(per_text(train[0] > 0).astype(np.int64)),
                pa.array(np.full(len(c.ids), tokens, np.int64)),
                pa.array(per_text(np.log10((train[0] + 1) / (tokens + types + 1)))),
                pa.array(per_text(np.log10(total))),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])

    return run


def score(docs: DataFrame, order: int = ORDER, chunk_bytes: int = CHUNK_BYTES, folds: tuple[int, int, int] = (FOLDS, HELD_OUT, DELETED), folder: str | None = None) -> DataFrame:
    """Scores of every text; ``folds``: their number, the one that is not learnt from, the one deleted for the weights."""
    if order < 1:
        raise ValueError("order must be positive")
    spark = docs.sparkSession
    folder = folder or fresh_path(spark, "lm")
    docs = docs.select(F.col("doc_id").cast("long"), "text")
    parts = max(1, min(MAX_PARTS, 4 * docs.rdd.getNumPartitions()))
    asked = docs.mapInArrow(_ask(order, chunk_bytes, parts, folds), "part long, place int, chunk int, level int, keys binary, train binary, dev binary")
    answers = asked.groupBy("part").applyInArrow(_answer, _ANSWER)
    # A folder for each partition of the scan, and in it about a file for each chunk; these tell by their statistics whose they are.
    answers = answers.repartition("place", "chunk").sortWithinPartitions("place", "chunk")
    answers.write.mode("overwrite").option("compression", "zstd").option("parquet.block.size", 8 << 20).partitionBy("place").parquet(folder)
    tokens = types = dev = 0
    if path_exists(spark, f"{folder}/place={_SUMS}"):
        sums = spark.read.schema(answers.schema).parquet(f"{folder}/place={_SUMS}").agg(*(F.sum(c) for c in ("tokens", "types", "dev_tokens"))).first()
        tokens, types, dev = (int(x or 0) for x in sums)
    cells = docs.mapInArrow(_cells(order, chunk_bytes, folder, folds, tokens - dev), "cell long, n long, sums array<double>")
    added = cells.groupBy("cell").agg(F.sum("n").alias("n"), *(F.sum(F.col("sums")[k]).alias(f"s{k}") for k in range(order))).collect()
    weights = learn_weights(sorted((r.cell, r.n, [r[f"s{k}"] for k in range(order)]) for r in added), order, 1 / (types + 1))
    return docs.mapInArrow(_score(order, chunk_bytes, folder, folds, tokens, types, weights), "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double")


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score(table(spark, sf_dir, "documents"))

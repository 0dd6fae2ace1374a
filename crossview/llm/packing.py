"""Packing into fixed windows by Karmarkar-Karp multiway differencing.

Every document becomes its token ids and an end id. A document's whole windows
are sequences of their own; what is left of it is cut into pieces of at most
``max_piece`` ids, which gather in a pool. A full pool is spread over windows by
differencing: each piece starts as a partition of one filled and otherwise
empty windows, and the two partitions with the largest spread are merged, the
fullest window of one with the emptiest of the other, until one partition is
left. If its fullest window exceeds the capacity, the window count rises by one
and the pool is spread anew. A pool's total is set a little below a multiple of
the capacity by cutting the last piece, so that near-equal windows are
near-full. What is left at a partition's end goes, besides whole windows, into
sequences whose lengths are powers of two, which need no padding.

Packing runs within the scan's partitions: no shuffle, one pool in memory, and
results that depend on the partition's rows only, so that a lost task packs the
same rows again the same way. ``sequence_id`` is the partition's number times
2^40 plus a counter.

Defined results: a null or empty text is the end id alone; repeated rows are
packed one by one; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import heapq
import os
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import textbytes as tb
from .common import table

CAPACITY = 2048
END_ID = 1
#: The rest of a document is cut into pieces of at most so many ids.
MAX_PIECE = 512
#: Windows of one pool, and how far below their capacity the pool's total is set.
POOL_WINDOWS, SLACK = 128, 0.006
#: Words whose ids a worker keeps.
CACHE = 1_000_000

_SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"
#: New words that are encoded at a time.
_WORDS = 8192
_PLAIN = np.array([chr(i).isalnum() and i < 128 for i in range(256)])
_tokenizers: dict[str, Tokenised] = {}


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class Tokenised:
    """Ids of whole texts by way of a table of white-space words.

    The tokenizer drops white space before it looks at anything else, so a
    text's ids are those of its words one after the other. Words are found and
    hashed for many texts at once (64 bits; A-Z lower-cased, as the tokenizer
    does; a full stop or comma after an ASCII letter or digit counts as a word of its own), and
    the table gives the ids of those that this worker has met before. New words
    of letters below U+0250 go through the tokenizer in one call, whose result
    is cut where a word end stands; other new words are encoded singly. Texts
    that may hold special tokens are encoded as a whole.
    """

    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # a task is one thread; others only hold memory
        from tokenizers import Tokenizer

        self.encoder = Tokenizer.from_file(path)
        self.bare = Tokenizer.from_file(path)  # for words that are in normal form already
        self.bare.normalizer = None
        vocab = self.encoder.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        for token, k in vocab.items():
            self.ends[k] = token.endswith("</w>")
        letters = "".join(re.escape(c) for c in map(chr, range(0x41, 0x250)) if unicodedata.category(c)[0] == "L" and c != "\u0130")
        self.letters = re.compile(f"[{letters}]+")
        self._clear()

    def _clear(self) -> None:
        self.keys, self.rows = np.empty(0, np.uint64), np.empty(0, np.int64)
        self.starts, self.sizes = np.zeros(2, np.int64), np.zeros(2, np.int64)
        self.ids, self.used, self.known = np.empty(1024, "<u4"), 0, 0
        self.marks = [self._add(self._alone([m])) for m in (".", ",")]

    def _alone(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, "<u4") for e in self.encoder.encode_batch_fast(texts, add_special_tokens=False)]

    def _add(self, ids: list[np.ndarray]) -> int:
        """Append words to the table; the first one's row."""
        flat, sizes = np.concatenate(ids), np.array([len(x) for x in ids])
        while self.used + len(flat) > len(self.ids):
            self.ids = np.r_[self.ids, self.ids]
        self.ids[self.used : self.used + len(flat)] = flat
        while self.known + len(ids) > len(self.starts):
            self.starts, self.sizes = np.r_[self.starts, self.starts], np.r_[self.sizes, self.sizes]
        rows = slice(self.known, self.known + len(ids))
        self.starts[rows] = self.used + np.cumsum(sizes) - sizes
        self.sizes[rows] = sizes
        self.used, self.known = self.used + len(flat), self.known + len(ids)
        return rows.start

    def _encode_words(self, new: list[str]) -> list[np.ndarray]:
        plain = [i for i, u in enumerate(new) if (u.isascii() and u.isalpha()) or self.letters.fullmatch(u)]
        out: list[np.ndarray | None] = [None] * len(new)
        parts = [np.empty(0, "<u4")]
        for k in range(0, len(plain), _WORDS):  # an encoding takes much more memory than its ids
            joined = " ".join([new[i].lower() for i in plain[k : k + _WORDS]])
            parts.append(np.array(self.bare.encode_batch_fast([joined], add_special_tokens=False)[0].ids, "<u4"))
        ids = np.concatenate(parts)
        stops = np.flatnonzero(self.ends[ids]) + 1
        if len(stops) == len(plain):
            for i, a, b in zip(plain, [0, *stops[:-1].tolist()], stops.tolist(), strict=True):
                out[i] = ids[a:b]
        rest = [i for i, x in enumerate(out) if x is None]  # all of them for a tokenizer without word ends
        for i, x in zip(rest, self._alone([new[i] for i in rest]), strict=True):
            out[i] = x
        return out

    def encode(self, t: tb.Texts) -> list[bytes]:
        """The ids of each text of a block, as little-endian unsigned 32-bit bytes."""
        if self.known > CACHE:
            self._clear()
        low, w = tb.LOWER[t.data], tb.words(t, tb.SPACED)
        end, last = w.end.copy(), low[w.end - 1] if len(w.end) else low[:0]
        cut = ((last == 46) | (last == 44)) & (end - w.start > 1) & _PLAIN[low[np.maximum(end - 2, 0)]] if len(end) else np.zeros(0, bool)
        end[cut] -= 1
        every, first, where = np.unique(tb.span_hash(tb.prefix(low), w.start, end), return_index=True, return_inverse=True)
        at = np.searchsorted(self.keys, every)
        fresh = np.ones(len(every), bool)
        inside = at < len(self.keys)
        fresh[inside] = self.keys[at[inside]] != every[inside]
        if fresh.any():
            raw = low.tobytes()
            new = [raw[a:b].decode() for a, b in zip(w.start[first[fresh]].tolist(), end[first[fresh]].tolist(), strict=True)]
            row = self._add(self._encode_words(new))
            self.keys = np.insert(self.keys, at[fresh], every[fresh])
            self.rows = np.insert(self.rows, at[fresh], np.arange(row, row + len(new)))
            at = np.searchsorted(self.keys, every)
        rows = np.repeat(self.rows[at][where], 1 + cut)
        marks = np.cumsum(1 + cut)[cut] - 1
        rows[marks] = np.where(last[cut] == 46, *self.marks)
        sizes = self.sizes[rows]
        total = np.r_[0, np.cumsum(sizes)]
        ids = self.ids[np.arange(total[-1]) + np.repeat(self.starts[rows] - total[:-1], sizes)]
        cuts = total[np.r_[0, np.cumsum(1 + cut)][w.woff]]
        out = [ids[a:b].tobytes() for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]
        for i in self._odd(t):
            out[i] = self._alone([t.data[t.offs[i] : t.offs[i + 1]].tobytes().decode()])[0].tobytes()
        return out

    def _odd(self, t: tb.Texts) -> list[int]:
        hit = np.flatnonzero((t.data[:-1] == 0x3C) & (t.data[1:] == 0x7C))
        return np.unique(np.searchsorted(t.offs, hit, "right") - 1).tolist()


def differencing(sizes: list[int], windows: int) -> tuple[np.ndarray, list[list[int]]]:
    """Spread items over ``windows`` windows: the windows' sums, and the items of each."""
    if not sizes:
        return np.zeros(windows, np.int64), [[] for _ in range(windows)]
    sums, tree, heap = {}, [], []
    for i, size in enumerate(sizes):
        sums[i] = np.zeros(windows, np.int64)
        sums[i][-1] = size
        heap.append((-size, i))
    heapq.heapify(heap)
    fresh = len(sizes)
    while len(heap) > 1:
        (_, x), (_, y) = heapq.heappop(heap), heapq.heappop(heap)
        both = sums.pop(x) + sums.pop(y)[::-1]
        order = np.argsort(both, kind="stable")
        sums[fresh] = both[order]
        tree.append((x, y, order))
        heapq.heappush(heap, (-int(both[order[-1]] - both[order[0]]), fresh))
        fresh += 1
    # Down the tree again: which window of the last partition each window of its parts became.
    goes, where = {fresh - 1: np.arange(windows)}, np.empty(len(sizes), np.int64)
    for k in range(len(tree) - 1, -1, -1):
        x, y, order = tree[k]
        up = np.empty(windows, np.int64)
        up[order] = goes.pop(len(sizes) + k)
        for part, own in ((x, up), (y, up[::-1])):
            if part < len(sizes):
                where[part] = own[-1]
            else:
                goes[part] = own
    if not tree:
        where[0] = windows - 1
    members: list[list[int]] = [[] for _ in range(windows)]
    for i, w in enumerate(where):
        members[w].append(i)
    return sums[fresh - 1], members


class Packer:
    """Packs one partition's documents. Pieces are (row, start, bytes of the ids)."""

    def __init__(self, capacity: int, max_piece: int, pool_windows: int, slack: float, first_id: int):
        self.capacity, self.max_piece, self.next_id = capacity, min(max_piece, capacity), first_id
        self.limit = int(pool_windows * capacity * (1 - slack))
        self.slack = slack
        self.pool: list[tuple[int, int, bytes]] = []
        self.held = 0
        self.out: list[tuple[int, int, bytes, int, int]] = []

    def _emit(self, pieces: list[tuple[int, int, bytes]]) -> None:
        at = 0
        for row, start, raw in pieces:
            self.out.append((row, start, raw, self.next_id, at))
            at += len(raw) // 4
        self.next_id += 1

    def add(self, row: int, raw: bytes) -> None:
        n, start = len(raw) // 4, 0
        while n - start >= self.capacity:
            self._emit([(row, start, raw[4 * start : 4 * (start + self.capacity)])])
            start += self.capacity
        while start < n:
            size = min(n - start, self.max_piece, self.limit - self.held)
            self.pool.append((row, start, raw[4 * start : 4 * (start + size)]))
            self.held += size
            start += size
            if self.held == self.limit:
                self._spread(self.pool)
                self.pool, self.held = [], 0

    def _spread(self, pieces: list[tuple[int, int, bytes]]) -> None:
        sizes = [len(p[2]) // 4 for p in pieces]
        windows = max(1, -(-sum(sizes) // self.capacity))
        while True:
            sums, members = differencing(sizes, windows)
            if sums[-1] <= self.capacity:
                break
            windows += 1
        for own in members:
            if own:
                self._emit([pieces[i] for i in own])

    def close(self) -> None:
        """Spread what makes whole windows; the rest goes into sequences with powers of two as lengths."""
        whole = int(self.held // self.capacity * self.capacity * (1 - self.slack))
        first, rest, at = [], [], 0
        for row, start, raw in self.pool:
            take = max(0, min(len(raw) // 4, whole - at))
            at += take
            if take:
                first.append((row, start, raw[: 4 * take]))
            if 4 * take < len(raw):
                rest.append((row, start + take, raw[4 * take :]))
        if first:
            self._spread(first)
        left = sum(len(p[2]) // 4 for p in rest)
        while left:
            room, own = min(1 << (left.bit_length() - 1), self.capacity), []
            left -= room
            while room:
                row, start, raw = rest.pop(0)
                take = min(room, len(raw) // 4)
                own.append((row, start, raw[: 4 * take]))
                room -= take
                if 4 * take < len(raw):
                    rest.insert(0, (row, start + take, raw[4 * take :]))
            self._emit(own)
        self.pool, self.held = [], 0


def _pack(path: str, capacity: int, max_piece: int, pool_windows: int, slack: float):
    end = np.array([END_ID], "<u4").tobytes()

    def batch(packer: Packer, ids: dict[int, object], tokens: dict[int, int]) -> pa.RecordBatch:
        done, packer.out = packer.out, []
        cols = [[ids[r] for r, *_ in done], [s for _, s, *_ in done], [len(x) // 4 for _, _, x, *_ in done], [x for _, _, x, *_ in done], [tokens[r] for r, *_ in done], [q for *_, q, _ in done], [o for *_, o in done]]
        held = {r for r, *_ in packer.pool}
        for known in (ids, tokens):
            for r in [r for r in known if r not in held]:
                del known[r]
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64()]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(cols, kinds, strict=True)], ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        if path not in _tokenizers:
            _tokenizers[path] = Tokenised(path)
        encoder, row = _tokenizers[path], 0
        packer = Packer(capacity, max_piece, pool_windows, slack, TaskContext.get().partitionId() << 40)
        ids: dict[int, object] = {}
        tokens: dict[int, int] = {}
        for b in batches:
            text = b.column(1)
            for t in tb.blocks(text):
                own = b.slice(t.first, t.n)
                for doc, raw in zip(own.column(0).to_pylist(), encoder.encode(t), strict=True):
                    ids[row], tokens[row] = doc, len(raw) // 4 + 1
                    packer.add(row, raw + end)
                    row += 1
                if packer.out:
                    yield batch(packer, ids, tokens)
        packer.close()
        if packer.out:
            yield batch(packer, ids, tokens)

    return run


def pack(docs: DataFrame, path: str | None = None, capacity: int = CAPACITY, max_piece: int = MAX_PIECE, pool_windows: int = POOL_WINDOWS, slack: float = SLACK) -> DataFrame:
    """Pieces with their ids (little-endian unsigned 32-bit), their sequence and their place in it."""
    if capacity < 1 or max_piece < 1 or pool_windows < 1 or not 0 <= slack < 0.5:
        raise ValueError("capacity, max_piece and pool_windows are positive, slack lies in [0, 0.5)")
    return docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(_pack(path or tokenizer_path(), capacity, max_piece, pool_windows, slack), _SCHEMA)


def query(spark: SparkSession, sf_dir: str, docs: DataFrame | None = None) -> DataFrame:
    docs = table(spark, sf_dir, "documents") if docs is None else docs
    return pack(docs).select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")

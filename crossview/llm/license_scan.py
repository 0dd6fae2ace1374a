"""License scan by diagonal voting.

Texts are lower-cased (A-Z) and cut into words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
Two scans, neither with a shuffle of texts:

* Base phrases are found by their exact words.
* All rolling hashes of ``k`` words of all texts are joined to the positions
  of the templates' hashes. A match votes for its diagonal, the distance between
  its place in the text and its place in the template. Votes are counted for
  each text, template and diagonal; neighbouring diagonals (at most ``max_gap``
  apart: words put in or left out) are merged; and each merged span is verified:
  the template's words that its matches cover must make ``min_cover`` of the
  template, and the text's words that they cover ``min_dense`` of the span.
  Where a template holds the name of its licence (``NAMES``), the name's words
  must be there as well, in a row: notices of a family differ in it alone.

The template side is broadcast up to ``MAX_BROADCAST`` positions; a larger
set of templates is joined without that hint. Only matches are shuffled, and
those of one text and template come together.

Defined results: a null text has no words; texts shorter than ``k`` words match
no template; repeated rows get the same result, as matches are kept by doc_id
and a hash of the text; no label gives an empty string and a score of 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from . import textbytes as tb
from .common import table

K, MAX_GAP, MIN_COVER, MIN_DENSE, MAX_BROADCAST = 4, 3, 0.7, 0.6, 200_000

# Phrases and their labels.
PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Usual notices of public licences, with labels.
TEMPLATES = [
    ("mit", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so"),
    ("apache-2", "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at"),
    ("apache-2", "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an AS IS BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied"),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met"),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies"),
    ("gpl", "This work is licensed under the GNU General Public License"),
    ("gpl", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation"),
    ("lgpl", "This work is licensed under the GNU Lesser General Public License"),
    ("lgpl", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation"),
    ("agpl", "This work is licensed under the GNU Affero General Public License"),
    ("mpl-2", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0"),
    ("cc-by", "This work is licensed under a Creative Commons Attribution 4.0 International License"),
    ("cc-by-sa", "This work is licensed under a Creative Commons Attribution ShareAlike 4.0 International License"),
    ("cc-by-nc", "This work is licensed under a Creative Commons Attribution NonCommercial 4.0 International License"),
    ("unlicense", "This is free and unencumbered software released into the public domain. Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software"),
]

# The words that tell a licence from others of its family, by label.
NAMES = {
    "apache-2": "the Apache License, Version 2",
    "gpl": "GNU General Public License",
    "lgpl": "GNU Lesser General Public License",
    "agpl": "GNU Affero General Public License",
    "mpl-2": "the Mozilla Public License",
    "cc-by": "Creative Commons Attribution 4.0",
    "cc-by-sa": "Creative Commons Attribution ShareAlike 4.0",
    "cc-by-nc": "Creative Commons Attribution NonCommercial 4.0",
}

_BASE = T.StructType().add("n_words", "long").add("n_base", "long").add("first_word", "long").add("last_word", "long").add("base_labels", T.ArrayType(T.StringType()))


def _one(text: str) -> tuple[tb.Texts, tb.Words, np.ndarray]:
    raw = np.frombuffer(text.encode(), np.uint8)
    t = tb.Texts(raw, np.array([0, len(raw)]), 0)
    w = tb.words(t, tb.ALNUM)
    return t, w, tb.word_hashes(t, w)


def _phrase_sets(phrases: dict[str, str]) -> dict[int, tuple[tb.HashSet, dict[bytes, str], list[bytes]]]:
    by_size: dict[int, dict[int, bytes]] = {}
    for p in phrases:
        _, w, h = _one(p)
        n = int(w.counts[0])
        by_size.setdefault(n, {})[int(tb.windows(h, w, n)[0][0])] = p.lower().encode()
    out = {}
    for n, own in by_size.items():
        known = tb.HashSet(np.array(list(own), np.uint64))
        out[n] = (known, {p.lower().encode(): label for p, label in phrases.items()}, [own[int(x)] for x in known.values])
    return out


def _base(phrases: dict[str, str], text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = _phrase_sets(phrases)
        for b in batches:
            n_words, n_base, first, last, labels = [], [], [], [], []
            for t in tb.blocks(b.column(text_at)):
                w = tb.words(t, tb.ALNUM)
                h, doc, low = tb.word_hashes(t, w), w.doc, tb.LOWER[t.data].tobytes()
                places, found = [[] for _ in range(t.n)], [set() for _ in range(t.n)]
                for n, (known, label, spelled) in sets.items():
                    wh, at = tb.windows(h, w, n)
                    where, which = known.find(wh)
                    for i, k in zip(at[where], which, strict=True):
                        if b" ".join([low[s:e] for s, e in zip(w.start[i : i + n], w.end[i : i + n], strict=True)]) == spelled[k]:
                            places[doc[i]].append(int(i - w.woff[doc[i]]))
                            found[doc[i]].add(label[spelled[k]])
                n_words += w.counts.tolist()
                n_base += [len(p) for p in places]
                first += [min(p) if p else None for p in places]
                last += [max(p) if p else None for p in places]
                labels += [sorted(x) for x in found]
            keep = [i for i in range(b.num_columns) if i != text_at]
            more = [pa.array(x, pa.int64()) for x in (n_words, n_base, first, last)] + [pa.array(labels, pa.list_(pa.string()))]
            yield pa.RecordBatch.from_arrays([*(b.column(i) for i in keep), *more], [*(b.schema.names[i] for i in keep), *_BASE.names])

    return run


def _rolling(k: int, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for t in tb.blocks(b.column(text_at)):
                own, w = b.slice(t.first, t.n), tb.words(t, tb.ALNUM)
                grams, _ = tb.windows(tb.word_hashes(t, w), w, k)
                ends = np.r_[0, np.cumsum(np.maximum(w.counts - k + 1, 0))].astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(grams.view(np.int64)))
                keep = [i for i in range(own.num_columns) if i != text_at]
                yield pa.RecordBatch.from_arrays([*(own.column(i) for i in keep), lists], [*(own.schema.names[i] for i in keep), "grams"])

    return run


def _named(words: list[int], name: list[int], k: int) -> list[int]:
    """The positions of the k-grams that make up the first place of a name, or hold it if it is shorter; none without it."""
    at = next((i for i in range(len(words) - len(name) + 1) if name and words[i : i + len(name)] == name), None)
    if at is None:
        return []
    first = at if len(name) >= k else min(at, len(words) - k)
    return list(range(max(first, 0), max(at + len(name) - k, first, 0) + 1))


def template_grams(spark: SparkSession, templates: list[tuple[str, str]], k: int, names: dict[str, str] = NAMES) -> DataFrame:
    """Template number, its words and label, the positions of its name's k-grams, and the hash and position of each of its k-grams."""
    rows = []
    for i, (label, text) in enumerate(templates):
        _, w, h = _one(text)
        named = _named(h.tolist(), _one(names.get(label, ""))[2].tolist(), k)
        rows += [(i, label, int(w.counts[0]), named, int(x), at) for at, x in enumerate(tb.windows(h, w, k)[0].view(np.int64))]
    return spark.createDataFrame(rows, "template int, label string, template_words int, named array<int>, hash long, t_at int")


def matches(docs: DataFrame, templates: list[tuple[str, str]] = TEMPLATES, k: int = K, max_gap: int = MAX_GAP, min_cover: float = MIN_COVER, min_dense: float = MIN_DENSE, names: dict[str, str] = NAMES) -> DataFrame:
    """Verified spans: doc_id, key (of the text), label, first and last word, cover (of the template's words)."""
    own = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    grams = own.mapInArrow(_rolling(k, 2), own.schema.__class__(own.schema.fields[:2]).add("grams", T.ArrayType(T.LongType())))
    grams = grams.select("doc_id", "key", F.posexplode("grams").alias("at", "hash"))
    known = template_grams(docs.sparkSession, templates, k, names)
    if sum(len(t.split()) for _, t in templates) <= MAX_BROADCAST:
        known = F.broadcast(known)
    votes = (
        grams.join(known, "hash")
        .groupBy("doc_id", "key", "template", "label", "template_words", "named", (F.col("at") - F.col("t_at")).alias("diagonal"))
        .agg(F.collect_set("at").alias("ats"), F.collect_set("t_at").alias("t_ats"))
    )
    by = Window.partitionBy("doc_id", "key", "template").orderBy("diagonal")
    apart = F.coalesce(F.col("diagonal") - F.lag("diagonal").over(by) > max_gap, F.lit(True))
    spans = (
        votes.withColumn("new", apart.cast("int"))
        .withColumn("span", F.sum("new").over(by))
        .groupBy("doc_id", "key", "template", "label", "template_words", "named", "span")
        .agg(F.flatten(F.collect_list("ats")).alias("ats"), F.flatten(F.collect_list("t_ats")).alias("t_ats"))
    )
    covered = lambda c: F.array_distinct(F.flatten(F.transform(F.array_distinct(c), lambda x: F.sequence(x, x + (k - 1)))))
    return (
        spans.withColumn("words", covered(F.col("ats")))
        .withColumn("first", F.array_min("words"))
        .withColumn("last", F.array_max("words"))
        .withColumn("cover", F.size(covered(F.col("t_ats"))) / F.col("template_words"))
        .where(F.size(F.array_except("named", "t_ats")) == 0)
        .where((F.col("cover") >= min_cover) & (F.size("words") >= min_dense * (F.col("last") - F.col("first") + 1)))
        .select("doc_id", "key", "label", "first", "last", "cover")
    )


def scan(docs: DataFrame, phrases: dict[str, str] = PHRASES, templates: list[tuple[str, str]] = TEMPLATES, **options) -> DataFrame:
    """A row for each document: base counts, labels (arrays), spans of verified templates, and a score."""
    own = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    base = own.mapInArrow(_base(phrases, 2), T.StructType([*own.schema.fields[:2], *_BASE.fields]))
    found = matches(docs, templates, **options).groupBy("doc_id", "key").agg(F.array_sort(F.collect_list(F.struct("first", "last", "label", "cover"))).alias("spans"))
    # A null doc_id joins its own matches as well.
    out = base.join(found.withColumnsRenamed({"doc_id": "_id", "key": "_key"}), (F.col("doc_id").eqNullSafe(F.col("_id"))) & (F.col("key") == F.col("_key")), "left").drop("_id", "_key", "key")
    more = F.coalesce(F.transform("spans", lambda s: s["label"]), F.array().cast("array<string>"))
    best = F.coalesce(F.array_max(F.transform("spans", lambda s: s["cover"])), F.lit(0.0))
    return out.withColumn("labels", F.array_sort(F.array_union("base_labels", more))).withColumn("score", F.when(F.col("n_base") > 0, F.lit(1.0)).otherwise(F.least(best, F.lit(1.0))))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scan(table(spark, sf_dir, "documents")).select("doc_id", "n_words", "n_base", "first_word", "last_word", F.array_join("base_labels", ",").alias("base_labels"), F.array_join("labels", ",").alias("labels"), "score")

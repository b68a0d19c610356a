"""License scan by diagonal voting.

1. The rolling ``K``-word hashes of every text are joined to the templates'
   hashes; a hit of document word i and template word j votes for the diagonal i - j.
2. Votes are counted per (document, template, diagonal): a diagonal with all of
   a template's votes is a word-for-word occurrence.
3. The hits of a text that meets enough different places of a template are chained: text and
   template places both increase, and the diagonal moves up to ``DRIFT`` words a step
   (words put in or left out), so the hits of a chain lie close.
4. The longest chains that don't overlap are the matches: the share of the template's hashes that
   one has in order is its score; templates at their threshold give their label.

Words are lower-cased runs of letters and digits, so quotes, comment signs
and line breaks don't matter.  The template hashes are broadcast up to a checked
number; the hits stay rows.
"""

from __future__ import annotations

from bisect import bisect
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm.hashing import WORD_CHARS, combine, hash_text, kgrams, word_blocks

K = 2
DRIFT = 3
MAX_BROADCAST_GRAMS = 100_000  # rows of template hashes (24 bytes each); a longer list is joined by a shuffle


@dataclass(frozen=True)
class Template:
    label: str
    text: str
    threshold: float = 0.7
    base: bool = False


# The base phrases, and sentences of well-known notices.
TEMPLATES = [
    Template("mit", "mit license", 1.0, True),
    Template("apache", "apache license", 1.0, True),
    Template("gpl", "general public license", 1.0, True),
    Template("mit-notice", "Released under the MIT License"),
    Template("mit-notice", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software "
             "and associated documentation files"),
    Template("apache-2.0-notice", "Licensed under the Apache License, Version 2.0"),
    Template("apache-2.0-notice", "you may not use this file except in compliance with the License"),
    Template("gpl-3.0-notice", "This work is licensed under the GNU General Public License, version 3"),
    Template("gpl-notice", "This program is free software: you can redistribute it and/or modify it under the terms of the "
             "GNU General Public License as published by the Free Software Foundation"),
    Template("lgpl-notice", "under the terms of the GNU Lesser General Public License"),
    Template("mpl-2.0-notice", "This Source Code Form is subject to the terms of the Mozilla Public License"),
    Template("bsd-notice", "Redistribution and use in source and binary forms, with or without modification, are permitted "
             "provided that the following conditions are met"),
    Template("cc-by-nc-4.0-notice", "Licensed under CC BY-NC 4.0"),
    Template("cc-by-4.0-notice", "Licensed under CC BY 4.0", 0.9),
    Template("cc-notice", "licensed under a Creative Commons Attribution license"),
]


def template_grams(spark: SparkSession, templates: list[Template]) -> DataFrame:
    """``gram, template, at, grams``: every K-word hash of every template and its place."""
    rows = []
    for t, template in enumerate(templates):
        h = hash_text(template.text, WORD_CHARS)
        if len(h) < K:
            raise ValueError(f"a template needs {K} words: {template.text!r}")
        grams = combine([h[i:len(h) - K + 1 + i] for i in range(K)]).view(np.int64).tolist()
        rows += [(g, t, at, len(grams)) for at, g in enumerate(grams)]
    df = spark.createDataFrame(rows, "gram long, template int, at int, grams int")
    return F.broadcast(df) if len(rows) <= MAX_BROADCAST_GRAMS else df


def _rolling(docs: DataFrame) -> DataFrame:
    """``row, doc_id, pos, gram``: every rolling hash; and once per row pos -1 with the number of words in ``gram``."""

    def run(batches):
        for batch in batches:
            rows, ids = batch.column(0), batch.column(1)
            for block in word_blocks(batch.column(2), WORD_CHARS):
                h, at = kgrams(block, K)
                row = np.searchsorted(block.offsets, at, "right") - 1
                row = np.concatenate([np.arange(block.n_rows), row])
                take = pa.array(row + block.first_row)
                yield pa.RecordBatch.from_arrays(
                    [rows.take(take), ids.take(take),
                     pa.array(np.concatenate([np.full(block.n_rows, -1), at - block.offsets[row[block.n_rows:]]])),
                     pa.array(np.concatenate([block.counts, h.view(np.int64)]))], ["row", "doc_id", "pos", "gram"])

    return docs.mapInArrow(run, "row long, doc_id long, pos long, gram long")


def votes(docs: DataFrame, templates: list[Template], id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``row, doc_id, n_words, template, diagonal, votes, ats, grams`` per diagonal (``ats``: the template places met); one row with a NULL
    template per document (its number of words)."""
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                      F.col(text_col).alias("text"))
    t = template_grams(docs.sparkSession, templates)
    rolling = _rolling(src)
    key = F.when(F.col("pos") >= 0, F.col("gram"))  # the counting rows match nothing
    hits = (rolling.withColumn("_key", key).join(t.withColumnRenamed("gram", "_gram"), F.col("_key") == F.col("_gram"), "left")
            .where("pos < 0 OR template IS NOT NULL"))
    return hits.groupBy("row", "doc_id", "template", (F.col("pos") - F.col("at")).alias("diagonal")).agg(
        F.max(F.when(F.col("pos") < 0, F.col("gram"))).alias("n_words"), F.count("at").alias("votes"),
        F.collect_list("at").alias("ats"), F.max("grams").alias("grams"))


def chains(hits: list[tuple[int, int]], grams: int) -> list[tuple[int, int, int, int]]:
    """``(start, end, hits, drift)`` of the longest chains of (text place, template place) that don't overlap."""
    hits = sorted(hits)
    best: list[tuple[int, int, int]] = []  # (hits, -drift, -start) of the best chain that ends at each hit
    lo = 0
    for i, (pos, at) in enumerate(hits):
        while hits[lo][0] < pos - grams - DRIFT:
            lo += 1
        own = (1, 0, -pos)
        for j in range(lo, i):
            step = abs((pos - at) - (hits[j][0] - hits[j][1]))
            if hits[j][0] < pos and hits[j][1] < at and step <= DRIFT:
                n, drift, start = best[j]
                own = max(own, (n + 1, drift - step, start))
        best.append(own)
    taken: list[tuple[int, int, int, int]] = []
    starts: list[int] = []
    for i in sorted(range(len(hits)), key=lambda i: (-best[i][0], -best[i][1], hits[i][0])):
        n, drift, start = best[i][0], -best[i][1], -best[i][2]
        end = hits[i][0] + K
        at = bisect(starts, start)
        if (at == 0 or taken[at - 1][1] <= start) and (at == len(taken) or end <= taken[at][0]):
            starts.insert(at, start)
            taken.insert(at, (start, end, n, drift))
    return taken


def matches(diagonals: DataFrame, need: Column) -> DataFrame:
    """``row, doc_id, template, start, end, score, exact``: the verified chains (word places in the text) of the
    templates of which a text has the share ``need`` at least, in any order.

    ``exact``: 1 for a whole word-for-word occurrence, else 0.
    """

    def run(batches):
        for batch in batches:
            out = []
            for row, doc, template, grams, d in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hits = [(x["diagonal"] + at, at) for x in d for at in x["ats"]]
                out += [(row, doc, template, a, b, n / grams, int(n == grams and not drift)) for a, b, n, drift in chains(hits, grams)]
            cols = list(zip(*out, strict=True)) or [()] * 7
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.float64(), pa.int64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types, strict=True)],
                                             ["row", "doc_id", "template", "start", "end", "score", "exact"])

    grouped = diagonals.where("template IS NOT NULL").groupBy("row", "doc_id", "template").agg(
        F.max("grams").alias("grams"), F.collect_list(F.struct("diagonal", "ats")).alias("d"))
    met = F.size(F.array_distinct(F.flatten("d.ats")))
    return grouped.where(met / F.col("grams") >= need).mapInArrow(
        run, "row long, doc_id long, template int, start long, end long, score double, exact long")


def scan(docs: DataFrame, templates: list[Template] = TEMPLATES, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row of ``docs``: ``doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans``.

    ``n_base``: all places where a base phrase stands word for word (``first_word``,
    ``last_word``: smallest and largest start); ``labels``: base labels and
    those of templates found at their threshold; ``score``: the best verified
    share of any template that counts (else 0); ``spans``: (label, start, end, score).

    NULL and empty texts: no words, no labels.  Repeated rows and NULL ids each
    give their own row.  Other columns are ignored.  An empty table: an empty result.
    """
    from marquee.llm.common import written

    diagonals = written(votes(docs, templates, id_col, text_col), "license-votes")
    base = F.col("template").isin([i for i, t in enumerate(templates) if t.base])
    whole = base & (F.col("votes") == F.col("grams"))
    per_row = diagonals.groupBy("row").agg(
        F.max("doc_id").alias("doc_id"), F.max("n_words").alias("n_words"),
        F.sum(F.when(whole, 1).otherwise(0)).cast("long").alias("n_base"),
        F.min(F.when(whole, F.col("diagonal"))).alias("first_word"), F.max(F.when(whole, F.col("diagonal"))).alias("last_word"))
    label = F.element_at(F.array(*[F.lit(t.label) for t in templates]), F.col("template") + 1)
    need = F.element_at(F.array(*[F.lit(t.threshold) for t in templates]), F.col("template") + 1)
    found = matches(diagonals, F.when(base, 1.0).otherwise(need)).where((base & (F.col("exact") > 0)) | (~base & (F.col("score") >= need))).withColumn("label", label)
    found = found.groupBy("row").agg(
        F.array_sort(F.collect_set(F.when(base, F.col("label")))).alias("_base"), F.array_sort(F.collect_set("label")).alias("_all"),
        F.max("score").alias("score"), F.array_sort(F.collect_list(F.struct("start", "end", "label", "score"))).alias("spans"))
    none = F.array().cast("array<string>")
    return per_row.join(found, "row", "left").select(
        "doc_id", "n_words", "n_base", "first_word", "last_word",
        F.array_join(F.coalesce("_base", none), ",").alias("base_labels"),
        F.array_join(F.coalesce("_all", none), ",").alias("labels"),
        F.coalesce("score", F.lit(0.0)).alias("score"), "spans")

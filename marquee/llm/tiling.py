"""Benchmark decontamination by greedy string tiling.

1. Seeds: the hashes of every ``MIN_MATCH`` consecutive words of the
   benchmark items.  A bitmap of at most ``MAX_BITS`` bits over them drops
   document positions that can't be seeds while the texts are read; the
   survivors are joined to the items' seeds by Spark.
2. A (document, item) pair goes on if its distinct shared seeds could cover
   enough of the item.
3. Greedy string tiling with running Karp-Rabin hashes on each pair's whole
   texts: the longest common runs of unmarked words are marked as
   tiles, then shorter ones, down to ``MIN_MATCH`` words.  Tiles don't overlap and
   may stand in any order, so reordered passages are caught.
4. Coverage: the share of the item's words under tiles; 0.8 or more is a leak.

Words are runs of letters and digits (A-Z lower-cased, everything beyond
ASCII counts as a letter), so case, punctuation and line breaks don't matter.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import marked, marks_of, written
from marquee.llm.hashing import WORD_CHARS, combine, hash_text, kgrams, word_blocks

MIN_MATCH = 5
COVERAGE = 0.8
MAX_BITS = 1 << 28
BITS_PER_SEED = 32
_KR_BASE = 1_000_003
_KR_MOD = (1 << 61) - 1


def _seed_rows(texts: DataFrame, sizes: list[int], bitmap) -> DataFrame:
    """``row_id, n_words, seed, pos``: every window of ``sizes`` words (those in the bitmap, if there is one)."""

    def run(batches):
        bits = None if bitmap is None else np.frombuffer(bitmap.value, np.uint8)
        for batch in batches:
            ids = batch.column(0)
            for block in word_blocks(batch.column(1), WORD_CHARS):
                for k in sizes:
                    h, at = kgrams(block, k)
                    if bits is not None:
                        slot = (h % np.uint64(len(bits) * 8)).astype(np.int64)
                        keep = np.flatnonzero((bits[slot >> 3] >> (slot & 7).astype(np.uint8)) & 1)
                        h, at = h[keep], at[keep]
                    row = np.searchsorted(block.offsets, at, "right") - 1
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(block.first_row + row)), pa.array(block.counts[row]),
                         pa.array(h.view(np.int64)), pa.array(at - block.offsets[row])],
                        ["row_id", "n_words", "seed", "pos"])

    return texts.mapInArrow(run, "row_id long, n_words long, seed long, pos long")


def _short_items(items: DataFrame) -> DataFrame:
    """Seeds of the items: windows of MIN_MATCH words, or all words of a shorter item."""

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for block in word_blocks(batch.column(1), WORD_CHARS):
                n = block.counts
                for k in range(1, MIN_MATCH + 1):
                    h, at = kgrams(block, k)
                    row = np.searchsorted(block.offsets, at, "right") - 1
                    keep = (n[row] == k) if k < MIN_MATCH else np.ones(len(row), bool)
                    h, at, row = h[keep], at[keep], row[keep]
                    yield pa.RecordBatch.from_arrays(
                        [ids.take(pa.array(block.first_row + row)), pa.array(n[row]), pa.array(h.view(np.int64)),
                         pa.array(at - block.offsets[row]), pa.array(np.full(len(row), k))],
                        ["item_id", "item_words", "seed", "item_pos", "size"])

    return items.mapInArrow(run, "item_id long, item_words long, seed long, item_pos long, size long")


def _bitmap(seeds: DataFrame, n: int) -> bytes:
    """Bit ``seed mod size`` is set for every seed; at most MAX_BITS bits, so bounded on the driver and in the workers."""
    bits = min(MAX_BITS, max(1 << 16, 1 << (n * BITS_PER_SEED - 1).bit_length()))
    out = np.zeros(bits // 8, np.uint8)
    # bits is a power of two: the low bits of the signed value are those of the unsigned one
    slot = F.col("seed").bitwiseAND(F.lit(bits - 1))
    rows = seeds.select(slot.alias("s")).groupBy(F.shiftright("s", 3).alias("byte")).agg(
        F.bit_or(F.expr("shiftleft(1, CAST(s & 7 AS INT))")).alias("v"))
    t = rows.toArrow()
    out[t.column("byte").to_numpy()] = t.column("v").to_numpy().astype(np.uint8)
    return out.tobytes()


def tiles(a: np.ndarray, b: np.ndarray, min_match: int) -> list[tuple[int, int, int]]:
    """Greedy string tiling of two sequences of word hashes: ``(position in a, position in b, length)``.

    Each pass finds the maximal common runs of unmarked words and marks the
    longest ones; it ends when none of ``min_match`` words is left.  Of
    equally long runs the one earliest in ``a``, then in ``b``, is marked.
    """
    out: list[tuple[int, int, int]] = []
    free_a, free_b = np.ones(len(a), bool), np.ones(len(b), bool)
    av, bv = a.tolist(), b.tolist()
    while found := _matches(av, bv, free_a, free_b, min_match):
        longest = max(n for _, _, n in found)
        for i, j, n in sorted(found):
            if n == longest and free_a[i:i + n].all() and free_b[j:j + n].all():
                free_a[i:i + n] = free_b[j:j + n] = False
                out.append((i, j, n))
    return sorted(out)


def _windows(v: list[int], free: np.ndarray, length: int):
    """Running Karp-Rabin hash of every window of unmarked words."""
    top = pow(_KR_BASE, length, _KR_MOD)
    h = run = 0
    for i, x in enumerate(v):
        if not free[i]:
            h = run = 0
            continue
        h = (h * _KR_BASE + x) % _KR_MOD
        run += 1
        if run > length:
            h = (h - v[i - length] * top) % _KR_MOD
        if run >= length:
            yield i - length + 1, h


def _matches(av, bv, free_a, free_b, length) -> list[tuple[int, int, int]]:
    """Maximal common runs of unmarked words of at least ``length``."""
    at = defaultdict(list)
    for j, h in _windows(bv, free_b, length):
        at[h].append(j)
    out = []
    for i, h in _windows(av, free_a, length):
        for j in at.get(h, ()):
            if i and j and free_a[i - 1] and free_b[j - 1] and av[i - 1] == bv[j - 1]:
                continue  # not the start of its run
            n = 0
            while i + n < len(av) and j + n < len(bv) and free_a[i + n] and free_b[j + n] and av[i + n] == bv[j + n]:
                n += 1
            if n >= length:
                out.append((i, j, n))
    return out


def _near_seeds(doc: np.ndarray, item: np.ndarray, k: int) -> np.ndarray:
    """The words of ``doc`` under windows it shares with ``item``; one unmatched word keeps the gaps apart."""
    if len(doc) < k or len(item) < k:
        return doc[:0]
    d = combine([doc[t:len(doc) - k + 1 + t] for t in range(k)])
    hit = np.flatnonzero(np.isin(d, combine([item[t:len(item) - k + 1 + t] for t in range(k)])))
    under = np.zeros(len(doc) + 1, bool)
    for t in range(k):
        under[hit + t] = True
    under = under[:-1]
    gap = ~under
    gap[1:] &= under[:-1]  # the first word after each covered stretch
    part = doc.copy()
    part[gap] = 0  # no word's hash matches it
    return part[under | gap]


def contaminated(docs: DataFrame, benchmark: DataFrame, min_match: int = MIN_MATCH, coverage: float = COVERAGE,
                 id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id",
                 item_text_col: str = "text") -> DataFrame:
    """``doc_id, item_id, item_words, covered_words, coverage, n_tiles`` of every leaked (document, item) pair.

    NULL ids and texts of either side give no rows (nor do items without words).
    Items of fewer than ``min_match`` words count as one tile each.  Rows
    repeated on either side give their pair once per distinct text: rows that
    share an id and both leak the same item give one row, with the largest
    coverage.  Other columns are ignored; an empty side gives an empty result.
    """
    d = docs.select(F.col(id_col).cast("long").alias("row_id"), F.col(text_col).alias("text")).where(
        "row_id IS NOT NULL AND text IS NOT NULL")
    i = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).alias("text")).where(
        "item_id IS NOT NULL AND text IS NOT NULL")
    seeds = written(_short_items(i), "tiling-items")
    stats = seeds.agg(F.count("*").alias("n"), F.collect_set("size").alias("sizes")).first()
    sizes = sorted(stats["sizes"])  # at most MIN_MATCH values
    sent = docs.sparkSession.sparkContext.broadcast(_bitmap(seeds, max(1, stats["n"])))
    shared = _seed_rows(d, sizes, sent).join(seeds, "seed")
    enough = F.least(F.col("_seeds") * F.col("size"), F.col("item_words")) >= F.ceil(
        F.col("item_words") * F.lit(coverage) - F.lit(1e-9))
    pairs = written(
        shared.select("row_id", "item_id", "item_words", "size", "item_pos").distinct()
        .groupBy("row_id", "item_id", "item_words", "size").agg(F.count("*").alias("_seeds"))
        .where(enough).select("row_id", "item_id").distinct(), "tiling-pairs")

    def run(batches):
        for batch in batches:
            out = []
            for doc_id, item_id, text, item in zip(*[batch.column(c) for c in range(4)], strict=True):
                b = hash_text(item.as_py(), WORD_CHARS)
                k = min(min_match, len(b))
                if k == 0:
                    continue
                a = _near_seeds(hash_text(text.as_py(), WORD_CHARS), b, k)
                found = tiles(a, b, k)
                covered = sum(n for _, _, n in found)
                if covered >= coverage * len(b) - 1e-9:
                    out.append((doc_id.as_py(), item_id.as_py(), len(b), covered, covered / len(b), len(found)))
            cols = list(zip(*out, strict=True)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int64()] * 4 + [pa.float64(), pa.int64()], strict=True)],
                ["doc_id", "item_id", "item_words", "covered_words", "coverage", "n_tiles"])

    # only the texts that the marks let through are shuffled
    near, _ = marked(d, "row_id", written(marks_of(pairs.select("row_id").distinct()), "marks"))
    texts = (pairs.join(i.select("item_id", F.col("text").alias("_item")), "item_id")
             .join(near.hint("merge"), "row_id").select("row_id", "item_id", "text", "_item"))
    found = texts.mapInArrow(
        run, "doc_id long, item_id long, item_words long, covered_words long, coverage double, n_tiles long")
    return found.groupBy("doc_id", "item_id").agg(
        *[F.max_by(c, F.struct("coverage", "item_words", -F.col("n_tiles"))).alias(c)
          for c in ("item_words", "covered_words", "coverage", "n_tiles")])

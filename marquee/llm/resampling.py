"""Target-distribution importance resampling over hashed word features, with a broadcast head vocabulary.

A text's features are its words (A-Z lower-cased) and all pairs of neighbouring words, joined by one blank; a
feature's bucket is the CRC-32 of its bytes modulo ``BUCKETS``.  Documents are drawn in proportion to how much likelier
their features are among the target's texts than among the documents, by Gumbel noise that hangs on the id alone.

1. *Head vocabulary* (``fit_head``): every task counts all its words and pairs in bounded tables and hands on
   its most frequent ones; the sums choose at most ``HEAD_WORDS`` words and ``HEAD_PAIRS`` pairs.  Broadcast are the
   words' exact CRC states, which a pair goes on from after the blank, and the pairs' buckets: at most about 12 MB.
2. *Features* (``buckets_of``): head words and head pairs are looked up; anything else takes its CRC directly, from the
   first word's state.  Both ways give the same number, so the head decides speed and never a result.
3. *Exact totals* (``bucket_totals``): a count per bucket and task, summed; ``gains`` follow for all buckets.
4. *Weights* (``weigh``) per document, and ``draw``: the ranks of the highest scores.

Ranks don't sort the corpus in one task: scores are whole numbers in a bounded range (``SCORES``), so counts per score
give each score its first rank, and only the documents of one score are ordered among themselves.

Defined results: NULL and empty texts have no features and weight 0; a row with a NULL id has no score and isn't
counted or drawn; rows that repeat an id are documents of their own; those of one score and id rank by
words, features and weight.  Empty tables give empty results.  Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from marquee.llm.common import most_frequent, written
from marquee.llm.hashing import WORD_CHARS, row_blocks, text_buffers
from marquee.operators.positions import repeat_rows

BUCKETS = 10_000
HEAD_WORDS = 32_768
HEAD_PAIRS = 65_536
#: Longer words are never head words, so the broadcast is bounded in bytes too.
HEAD_WORD_BYTES = 64
#: Words and pairs that a task holds while it counts, before it hands on its most frequent ones.
TASK_WORDS = 400_000
TASK_PAIRS = 1_500_000
BLOCK_BYTES = 1 << 20
#: No score lies beyond: a gain is under 1000 * ln(2^63) and the noise under 1000 * ln(2^34).
SCORES = 70_000

_byte = np.arange(256)
_TABLE = bytes(np.where(WORD_CHARS, np.where((_byte >= 65) & (_byte <= 90), _byte + 32, _byte), 32).astype(np.uint8))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


def word_blocks(texts: pa.Array) -> Iterator[tuple[list[bytes], np.ndarray]]:
    """Blocks of rows: (all words, offsets of the rows in them)."""
    offsets, data = text_buffers(texts)
    for lo, hi in row_blocks(offsets, BLOCK_BYTES):
        rows = [words_of(data[offsets[i]:offsets[i + 1]].tobytes()) for i in range(lo, hi)]
        yield list(chain.from_iterable(rows)), np.concatenate([[0], np.cumsum([len(r) for r in rows])]).astype(np.int64)


def _pairs(offsets: np.ndarray) -> np.ndarray:
    """Indices of the words that have a next word in their row."""
    n = int(offsets[-1])
    inner = np.ones(n, bool)
    ends = offsets[1:][np.diff(offsets) > 0]
    inner[ends - 1] = False
    return np.flatnonzero(inner)


# The head --------------------------------------------------------------------

class _Counts:
    """Words and pairs of one task, with their counts, in bounded tables."""

    def __init__(self):
        self.ids: dict[bytes, int] = defaultdict()
        self.ids.default_factory = self.ids.__len__
        self.words = np.zeros(0, np.int64)
        self.keys, self.counts = [], []
        self.held = 0

    def add(self, words: list[bytes], offsets: np.ndarray) -> None:
        ids = self.ids
        at = np.array([ids[w] if len(w) <= HEAD_WORD_BYTES else ids[b""] for w in words], np.int64)
        got = np.bincount(at, minlength=len(ids))
        got[:len(self.words)] += self.words
        self.words = got
        left = _pairs(offsets)
        key, n = np.unique((at[left] << 32) | at[left + 1], return_counts=True)
        self.keys.append(key)
        self.counts.append(n)
        self.held += len(key)
        if self.held > 2 * TASK_PAIRS:
            self._fold(TASK_PAIRS)

    def _fold(self, most: int) -> None:
        if not self.keys:
            return
        key, back = np.unique(np.concatenate(self.keys), return_inverse=True)
        n = np.bincount(back, np.concatenate(self.counts), len(key)).astype(np.int64)
        if len(key) > most:
            top = np.sort(np.argpartition(n, len(n) - most)[-most:])
            key, n = key[top], n[top]
        self.keys, self.counts, self.held = [key], [n], len(key)

    def rows(self) -> pa.RecordBatch:
        """The most frequent words and pairs that came more than once."""
        names = list(self.ids)
        self._fold(HEAD_PAIRS)
        top = np.argsort(-self.words, kind="stable")[:HEAD_WORDS]
        top = [int(i) for i in top if self.words[i] > 1 and names[i]]
        first, second, n = [names[i] for i in top], [None] * len(top), [int(self.words[i]) for i in top]
        for k, c in zip(self.keys[0].tolist() if self.keys else [], self.counts[0].tolist() if self.counts else [], strict=True):
            a, b = names[k >> 32], names[k & 0xFFFFFFFF]
            if c > 1 and a and b:
                first.append(a)
                second.append(b)
                n.append(c)
        return pa.RecordBatch.from_arrays([pa.array(first, pa.binary()), pa.array(second, pa.binary()), pa.array(n, pa.int64())],
                                          names=["a", "b", "n"])


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts = _Counts()
    for batch in batches:
        for words, offsets in word_blocks(batch.column(0)):
            if words:
                counts.add(words, offsets)
            if len(counts.ids) > TASK_WORDS:
                yield counts.rows()
                counts = _Counts()
    yield counts.rows()


@dataclass
class Head:
    """Frequent words with their CRC states, frequent pairs with their buckets."""

    words: list[bytes]
    states: np.ndarray
    pair_keys: np.ndarray  # sorted: first word's number * len(words) + second word's
    pair_buckets: np.ndarray

    @classmethod
    def of(cls, words: list[bytes], pairs: list[tuple[bytes, bytes]]) -> Head:
        number = {w: i for i, w in enumerate(words)}
        known = [(number[a] * len(words) + number[b], zlib.crc32(a + b" " + b) % BUCKETS) for a, b in pairs if a in number and b in number]
        known.sort()
        return cls(words, np.array([zlib.crc32(w) for w in words], np.uint32),
                   np.array([k for k, _ in known], np.int64), np.array([b for _, b in known], np.int32))


def fit_head(docs: DataFrame, text: str = "text", head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> Head:
    """The frequent words and pairs of all documents."""
    tasks = docs.select(F.col(text).cast("string")).mapInArrow(_count_task, "a binary, b binary, n long")
    counted = written(tasks.groupBy("a", "b").agg(F.sum("n").alias("n")), "resampling-head")
    words = most_frequent(counted.where("b IS NULL"), head_words).select("a").collect()
    pairs = most_frequent(counted.where("b IS NOT NULL"), head_pairs).select("a", "b").collect()
    return Head.of(sorted(bytes(r["a"]) for r in words), [(bytes(r["a"]), bytes(r["b"])) for r in pairs])


# Features --------------------------------------------------------------------

class Features:
    """Buckets of a block's words and pairs, through the head or directly."""

    def __init__(self, head: Head):
        self.head = head
        self.number = {w: i for i, w in enumerate(head.words)}
        self.after_blank = np.array([zlib.crc32(b" ", int(s)) for s in head.states], np.uint32)

    def buckets_of(self, words: list[bytes], offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(buckets of the words, buckets of the pairs, index of each pair's first word)."""
        number, crc32 = self.number.get, zlib.crc32
        at = np.array([number(w, -1) for w in words], np.int64)
        state = np.empty(len(words), np.uint32)
        blank = np.empty(len(words), np.uint32)
        in_head = at >= 0
        state[in_head] = self.head.states[at[in_head]]
        blank[in_head] = self.after_blank[at[in_head]]
        tail = np.flatnonzero(~in_head)
        state[tail] = [crc32(words[i]) for i in tail.tolist()]
        blank[tail] = [crc32(b" ", s) for s in state[tail].tolist()]

        left = _pairs(offsets)
        bucket = np.full(len(left), -1, np.int64)
        keys = self.head.pair_keys
        if len(keys):
            both = np.flatnonzero(in_head[left] & in_head[left + 1])
            key = at[left[both]] * len(self.head.words) + at[left[both] + 1]
            slot = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
            hit = keys[slot] == key
            bucket[both[hit]] = self.head.pair_buckets[slot[hit]]
        rest = np.flatnonzero(bucket < 0)
        second = (left[rest] + 1).tolist()
        states = blank[left[rest]].tolist()
        bucket[rest] = [crc32(words[i], s) % BUCKETS for i, s in zip(second, states, strict=True)]
        return (state % np.uint32(BUCKETS)).astype(np.int64), bucket, left


def bucket_totals(texts: DataFrame, head: Head, text: str = "text") -> np.ndarray:
    """Features per bucket over all rows, exact."""
    shared = texts.sparkSession.sparkContext.broadcast(head)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, total = Features(shared.value), np.zeros(BUCKETS, np.int64)
        for batch in batches:
            for words, offsets in word_blocks(batch.column(0)):
                one, two, _ = features.buckets_of(words, offsets)
                total += np.bincount(one, minlength=BUCKETS) + np.bincount(two, minlength=BUCKETS)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some.astype(np.int32)), pa.array(total[some])], names=["bucket", "n"])

    out = np.zeros(BUCKETS, np.int64)
    tasks = texts.select(F.col(text).cast("string")).mapInArrow(count, "bucket int, n long")
    for r in tasks.groupBy("bucket").agg(F.sum("n").alias("n")).collect():  # at most BUCKETS rows
        out[r["bucket"]] = r["n"]
    return out


def gains(source: np.ndarray, target: np.ndarray) -> np.ndarray:
    """Per bucket: floor(1000 * ln of the smoothed ratio of its shares in the target and in the documents)."""
    s, t = source.astype(np.float64), target.astype(np.float64)
    return np.floor(1000 * np.log((t + 1) * (s.sum() + BUCKETS) / ((s + 1) * (t.sum() + BUCKETS)))).astype(np.int64)


def weigh(docs: DataFrame, head: Head, gain: np.ndarray, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """``doc_id, n_words, n_features, weight``: the floored mean of the gains over all features."""
    shared = docs.sparkSession.sparkContext.broadcast((head, gain))

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, gain = Features(shared.value[0]), shared.value[1]
        for batch in batches:
            done = 0
            for words, offsets in word_blocks(batch.column(1)):
                one, two, left = features.buckets_of(words, offsets)
                per_word = gain[one]
                per_word[left] += gain[two]
                total = np.concatenate([[0], np.cumsum(per_word)])
                weight = total[offsets[1:]] - total[offsets[:-1]]
                n = np.diff(offsets)
                n_features = n + np.maximum(n - 1, 0)
                weight = np.where(n > 0, weight // np.maximum(n_features, 1), 0)
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(done, len(n)), pa.array(n), pa.array(n_features), pa.array(weight)],
                    names=["doc_id", "n_words", "n_features", "weight"])
                done += len(n)

    kind = docs.schema[doc_id].dataType.simpleString()
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(
        sums, f"doc_id {kind}, n_words long, n_features long, weight long")


# The draw --------------------------------------------------------------------

def scores(weighed: DataFrame, seed: str = "7") -> DataFrame:
    """``weighed`` with ``score``: the weight and Gumbel noise from the id's hash."""
    h = F.conv(F.substring(F.sha2(F.concat(F.lit(f"{seed}:"), F.col("doc_id").cast("string")), 256), 1, 8), 16, 10).cast("long")
    noise = F.floor(-1000 * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0))))
    return weighed.withColumn("score", (F.col("weight") + noise).cast("long"))


def draw(scored: DataFrame, percent: int = 25, least_words: int = 20) -> DataFrame:
    """``scored`` with ``rank``: 1, 2, … for the ``percent`` highest scores of the documents with ``least_words`` words, else NULL."""
    fit = (F.col("n_words") >= least_words) & F.col("score").isNotNull()
    per_score = sorted(((r["score"], r["count"]) for r in scored.where(fit).groupBy("score").count().collect()), reverse=True)
    wanted = percent * sum(n for _, n in per_score) // 100
    first, seen = [], 0
    for score, n in per_score:  # at most 2 * SCORES values
        if seen >= wanted:
            break
        first.append((score, seen))
        seen += n
    nothing = F.lit(None).cast("long").alias("rank")
    if not first:
        return scored.select("*", nothing)
    cut = fit & (F.col("score") >= first[-1][0])
    columns = ["score", "doc_id", "n_words", "n_features", "weight"]
    before = scored.sparkSession.createDataFrame(first, "score long, _before long")
    equal = scored.where(cut).groupBy(*columns).agg(F.count(F.lit(1)).alias("_n"))
    ordered = Window.partitionBy("score").orderBy("doc_id", "n_words", "n_features", "weight")
    ranked = (
        equal.withColumn("_upto", F.sum("_n").over(ordered.rowsBetween(Window.unboundedPreceding, 0)))
        .join(F.broadcast(before), "score"))
    place = F.col("_before") + F.col("_upto") - F.col("_copies") + F.col("_copy") + 1
    ranked = repeat_rows(ranked.withColumn("_copies", F.col("_n")), "_n", "_copy").withColumn("rank", place).select(
        *scored.columns, F.when(F.col("rank") <= wanted, F.col("rank")).alias("rank"))
    return scored.where(F.coalesce(~cut, F.lit(True))).select(*scored.columns, nothing).unionByName(ranked)


def resample(docs: DataFrame, target: DataFrame, percent: int = 25, least_words: int = 20, seed: str = "7",
             doc_id: str = "doc_id", text: str = "text", target_text: str = "text",
             head_words: int = HEAD_WORDS, head_pairs: int = HEAD_PAIRS) -> DataFrame:
    """Every document's ``doc_id, n_words, n_features, weight, score, rank`` (NULL if it isn't drawn)."""
    head = fit_head(docs, text, head_words, head_pairs)
    gain = gains(bucket_totals(docs, head, text), bucket_totals(target, head, target_text))
    scored = written(scores(weigh(docs, head, gain, doc_id, text), seed), "resampling-scores")
    return draw(scored, percent, least_words)


def drawn(docs: DataFrame, ranked: DataFrame, doc_id: str = "doc_id") -> DataFrame:
    """The documents drawn, with all their columns and ``rank`` (the smallest, where an id is repeated)."""
    ranks = ranked.where("rank IS NOT NULL").groupBy(F.col("doc_id").alias("_id")).agg(F.min("rank").alias("rank"))
    return docs.drop("rank").join(ranks, F.col(doc_id) == F.col("_id")).drop("_id")

"""Language-model scoring from a log-frequency Bloom filter.

* Training tokens: the words of every training text, lower-cased, and one end
  token per text.  Unigram and bigram counts are summed per block of texts, then
  per shard of the filter; the number of shards grows with the corpus, so none holds more than about
  ``SHARD_NGRAMS`` n-grams.
* An n-gram with count c is put into its shard with each of the levels
  1 … 1 + floor(log2 c).  A count is read back by probing level after level until one is
  missing; the last level's middle count is the estimate (never too
  small a level; a false positive may add one).
* Each shard has ``BITS`` bits for every level put into it, at any size of the corpus, so an
  unseen n-gram is taken for a seen one with a chance of about (1 - exp(-PROBES / BITS))^PROBES = 1.7 %.
* P(w | v) = (c(v w) + MU · P(w)) / (c(v) + MU),  P(w) = (c(w) + 1) / (N + V + 1),
  every count read from the filter.
* A filter of at most ``BROADCAST_BYTES`` is broadcast.  A larger one stays a table of shards: the distinct n-grams of
  each chunk of texts are sent to groups of neighbouring shards, one row a group, which answer with levels, and the
  chunk is scored with the answers.  A group probes the rows of a batch together, so the work grows with the n-grams
  asked for, not with chunks times shards.  The chunk's texts travel along, compressed.  Both forms read the same
  filter and give the same scores.

The base score needs exact counts: those of at most ``HEAD`` frequent words
are broadcast (a bounded table), all other tokens are joined to the
count table by a shuffle.  Words are told apart by 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import most_frequent, scope, written
from marquee.llm.hashing import NOT_SPACE, mix, word_blocks

HEAD = 1 << 18
BITS = 10
PROBES = 3
SHARD_NGRAMS = 1 << 19
LEAST_SHARD_BITS = 12
BROADCAST_BYTES = 192 << 20
#: Distinct n-grams that a task holds before it hands them on.
TASK_NGRAMS = 1 << 20
CHUNK_BYTES = 8 << 20
#: Shards are asked by groups: at least 2^LEAST_GROUP_BITS groups, of at most 2^GROUP_SHARD_BITS shards beyond that.
LEAST_GROUP_BITS, GROUP_SHARD_BITS = 10, 3
#: Names probed at once: their arrays stay in the cache.
PROBED = 1 << 15
MU = 4.0
TOP_LEVEL = 48
END = np.uint64(0x5851F42D4C957F2D)
_UNIGRAM, _BIGRAM = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_LOW = np.uint64(0xFFFFFFFF)
_DROP = np.uint64(20)  # bits of a key that no name or shard keeps


def token_blocks(texts: pa.Array):
    """(first row, token hashes, row bounds, tokens before them): every row's words and its end token."""
    for block in word_blocks(texts, NOT_SPACE):
        n = block.counts
        bounds = np.r_[0, np.cumsum(n + 1)]
        tokens = np.empty(bounds[-1], np.uint64)
        last = bounds[1:] - 1
        inner = np.ones(len(tokens), bool)
        inner[last] = False
        tokens[inner] = block.hash
        tokens[last] = END
        before = np.empty_like(tokens)
        before[1:] = tokens[:-1]
        before[bounds[:-1]] = END
        yield block.first_row, tokens, bounds, before


def unigram_key(w: np.ndarray) -> np.ndarray:
    return mix(w ^ _UNIGRAM)


def bigram_key(v: np.ndarray, w: np.ndarray) -> np.ndarray:
    return mix(v * _BIGRAM + w)


def _split(key: np.ndarray, shard_bits: int) -> tuple[np.ndarray, np.ndarray]:
    """(shard, 32-bit name within it); the order of ``key >> 20`` is the order of both."""
    return (key >> np.uint64(64 - shard_bits)).astype(np.int64), (key >> _DROP) & _LOW


def _place(hash_of: np.ndarray, i: int, size: np.ndarray | np.uint64) -> np.ndarray:
    """The ``i``-th bit of names with that hash at their level, within shards of ``size`` bits."""
    a, b = hash_of & _LOW, (hash_of >> np.uint64(32)) | np.uint64(1)
    return ((a + np.uint64(i) * b) % size).astype(np.int64)


def _levels(counts: np.ndarray) -> np.ndarray:
    return 1 + np.floor(np.log2(counts)).astype(np.int64)


def shard_filter(names: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bytes of one shard, sized by the levels put into it."""
    levels = _levels(counts)
    size = 8 * max(1, -(-int(levels.sum()) * BITS // 8))
    bits = np.zeros(size, np.uint8)
    for level in range(1, int(levels.max(initial=0)) + 1):
        hash_of = mix(names[levels >= level] | np.uint64(level << 32))
        for i in range(PROBES):
            bits[_place(hash_of, i, np.uint64(size))] = 1
    return np.packbits(bits, bitorder="little")


def probe(data: np.ndarray, name: np.ndarray, offset: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Levels of the names; ``offset`` and ``size`` (bytes and bits of its shard) for each."""
    level = np.zeros(len(name), np.int64)
    for lo in range(0, len(name), PROBED):
        _probe(data, *(x[lo:lo + PROBED] for x in (name, offset, size, level)))
    return level


def _probe(data: np.ndarray, name: np.ndarray, offset: np.ndarray, size: np.ndarray, level: np.ndarray) -> None:
    live = np.flatnonzero(size)
    for step in range(1, TOP_LEVEL + 1):
        hash_of, start, bits = mix(name[live] | np.uint64(step << 32)), offset[live], size[live].astype(np.uint64)
        for i in range(PROBES):
            at = _place(hash_of, i, bits)
            hit = np.flatnonzero((data[start + (at >> 3)] >> (at & 7).astype(np.uint8)) & 1)
            live, hash_of, start, bits = live[hit], hash_of[hit], start[hit], bits[hit]
        if not len(live):
            break
        level[live] = step


def estimate(level: np.ndarray) -> np.ndarray:
    """The middle count of a level."""
    return np.where(level < 2, level, 1.5 * np.exp2(np.maximum(level - 1, 0)) - 0.5)


class CountFilter:
    """A whole filter: reads quantised counts."""

    def __init__(self, shards: list[tuple[int, bytes]], shard_bits: int):
        self.shard_bits = shard_bits
        sizes = np.zeros(1 << shard_bits, np.int64)
        for shard, data in shards:
            sizes[shard] = len(data)
        self.offset = np.cumsum(sizes) - sizes
        self.size = sizes * 8
        self.bytes = np.zeros(int(sizes.sum()), np.uint8)
        for shard, data in shards:
            self.bytes[self.offset[shard]:self.offset[shard] + sizes[shard]] = np.frombuffer(data, np.uint8)

    def counts(self, key: np.ndarray) -> np.ndarray:
        shard, name = _split(key, self.shard_bits)
        return estimate(probe(self.bytes, name, self.offset[shard], self.size[shard]))


class Answers:
    """The levels of a chunk's n-grams, as the shards answered; ``short``: their keys in order, without the low bits."""

    def __init__(self, short: np.ndarray, level: np.ndarray):
        self.short, self.level = short, level
        bits = len(short).bit_length()  # keys are hashes: about one in each bucket of their top bits
        self.down = np.uint64(64 - int(_DROP) - bits)
        self.first = np.cumsum(np.bincount((short >> self.down).astype(np.int64), minlength=1 << bits), dtype=np.int32)
        self.first = np.concatenate([np.zeros(1, np.int32), self.first[:-1]])

    def counts(self, key: np.ndarray) -> np.ndarray:
        short = key >> _DROP
        at = self.first[(short >> self.down).astype(np.int64)].astype(np.int64)
        live = np.flatnonzero(self.short[at] != short)
        while len(live):
            at[live] += 1
            live = live[self.short[at[live]] != short[live]]
        return estimate(self.level[at].astype(np.int64))


def _summed(blocks: Iterator[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Distinct values and their counts, handed on whenever about ``TASK_NGRAMS`` are held."""
    held: list[tuple[np.ndarray, np.ndarray]] = []
    size = 0

    def fold() -> tuple[np.ndarray, np.ndarray]:
        value, back = np.unique(np.concatenate([v for v, _ in held]), return_inverse=True)
        return value, np.bincount(back, np.concatenate([c for _, c in held])).astype(np.int64)

    for block in blocks:
        held.append(np.unique(block, return_counts=True))
        size += len(held[-1][0])
        if size > 2 * TASK_NGRAMS:
            held[:] = [fold()]
            size = len(held[0][0])
            if size > TASK_NGRAMS:
                yield held[0]
                held.clear()
                size = 0
    if held:
        yield fold()


def _ngrams(t: np.ndarray, v: np.ndarray) -> np.ndarray:
    return np.concatenate([unigram_key(t), bigram_key(v, t)])


def word_counts(texts: DataFrame) -> DataFrame:
    """``word, c`` of the tokens of ``text`` (the only column)."""

    def run(batches):
        for w, c in _summed(t for batch in batches for _, t, _, _ in token_blocks(batch.column(0))):
            yield pa.RecordBatch.from_arrays([pa.array(w.view(np.int64)), pa.array(c)], ["word", "c"])

    return texts.mapInArrow(run, "word long, c long").groupBy("word").agg(F.sum("c").alias("c"))


def shard_bits_for(n_tokens: int) -> int:
    """Shards that hold about ``SHARD_NGRAMS`` n-grams each: two a token at most."""
    return max(LEAST_SHARD_BITS, (2 * n_tokens // SHARD_NGRAMS).bit_length())


def _cut(key: np.ndarray, shard_bits: int) -> Iterator[tuple[int, int, int]]:
    """(shard, from, to) of sorted keys."""
    shard = (key >> np.uint64(64 - shard_bits)).astype(np.int64)
    edges = np.flatnonzero(np.diff(shard, prepend=-1))
    yield from zip(shard[edges].tolist(), edges.tolist(), [*edges.tolist(), len(key)][1:], strict=True)


def filter_shards(texts: DataFrame, shard_bits: int) -> DataFrame:
    """``shard, bits``: the filter over all unigrams and bigrams of ``text``."""

    def count(batches):
        for key, n in _summed(_ngrams(t, v) for batch in batches for _, t, _, v in token_blocks(batch.column(0))):
            _, name = _split(key, shard_bits)
            rows = []
            for s, lo, hi in _cut(key, shard_bits):
                own, c = name[lo:hi].astype("<u4"), n[lo:hi]
                more = c > 1
                rows.append((s, own[~more].tobytes(), own[more].tobytes(), c[more].astype("<u8").tobytes()))
            cols = list(zip(*rows, strict=True))
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.int32()] + [pa.binary()] * 3, strict=True)],
                ["shard", "once", "names", "counts"])

    def build(table: pa.Table) -> pa.Table:
        once = np.frombuffer(b"".join(table.column("once").to_pylist()), "<u4")
        names = np.concatenate([once, np.frombuffer(b"".join(table.column("names").to_pylist()), "<u4")]).astype(np.uint64)
        n = np.concatenate([np.ones(len(once)), np.frombuffer(b"".join(table.column("counts").to_pylist()), "<u8")])
        names, at = np.unique(names, return_inverse=True)
        data = shard_filter(names, np.bincount(at, weights=n))
        return pa.table({"shard": table.column("shard").slice(0, 1), "bits": pa.array([data.tobytes()], pa.binary())})

    return (texts.mapInArrow(count, "shard int, once binary, names binary, counts binary")
            .groupBy("shard").applyInArrow(build, "shard int, bits binary"))


def text_scores(block, words, at, counts: CountFilter | Answers, n: int, v: int) -> np.ndarray:
    """log10 probability of each row of one block, whose tokens are ``words[at]``."""
    _, tokens, bounds, before = block
    c1 = counts.counts(unigram_key(words))
    c_end = counts.counts(unigram_key(np.array([END])))[0]
    p1 = ((c1 + 1) / (n + v + 1))[at]
    own = c1[at]
    c_before = np.empty(len(tokens))
    c_before[1:] = own[:-1]
    c_before[bounds[:-1]] = c_end
    pairs, at = np.unique(bigram_key(before, tokens), return_inverse=True)
    c2 = np.minimum(counts.counts(pairs)[at], np.minimum(own, c_before))
    logs = np.log10((c2 + MU * p1) / (c_before + MU))
    return np.add.reduceat(logs, bounds[:-1])


SCORED = "row long, doc_id long, held_out boolean, word long, n long, known long, logs double, score double"


def _block_rows(head, block, columns, score_of: Callable) -> pa.RecordBatch:
    """A block's rows: one per text (``word`` NULL), and one per distinct word of a text that isn't in the head."""
    hw, hc, log_head = head
    lo, tokens, bounds, _ = block
    m = len(bounds) - 1
    row = np.repeat(np.arange(m), np.diff(bounds))
    signed = tokens.view(np.int64)
    words, word_at = np.unique(tokens, return_inverse=True)
    at = np.minimum(np.searchsorted(hw, words.view(np.int64)), max(0, len(hw) - 1))
    known = (hw[at] == words.view(np.int64) if len(hw) else np.zeros(len(words), bool))[word_at]
    at = at[word_at]
    logs = np.bincount(row[known], weights=log_head[at[known]], minlength=m)
    pair = np.stack([row[~known], signed[~known]])
    by = np.lexsort(pair[::-1])
    pair = pair[:, by]
    new = np.flatnonzero(np.r_[True, (pair[:, 1:] != pair[:, :-1]).any(0)]) if pair.shape[1] else np.zeros(0, int)
    tail, tf = pair[:, new], np.diff(np.r_[new, pair.shape[1]])
    k = len(new)
    take = pa.array(np.r_[np.arange(m), tail[0]] + lo)
    is_tail = np.r_[np.zeros(m, bool), np.ones(k, bool)]
    return pa.RecordBatch.from_arrays([
        *(c.take(take) for c in columns),
        pa.array(np.r_[np.zeros(m, np.int64), tail[1]], mask=~is_tail),
        pa.array(np.r_[np.diff(bounds), tf]),
        pa.array(np.r_[np.bincount(row[known], minlength=m), np.zeros(k, np.int64)]),
        pa.array(np.r_[logs, np.zeros(k)]),
        pa.array(np.r_[score_of(block, words, word_at), np.zeros(k)])],
        ["row", "doc_id", "held_out", "word", "n", "known", "logs", "score"])


def _with_broadcast(src: DataFrame, shards: DataFrame, shard_bits: int, sent_head, n: int, v: int) -> DataFrame:
    table = shards.toArrow()  # at most BROADCAST_BYTES
    sent = src.sparkSession.sparkContext.broadcast(
        (list(zip(table.column("shard").to_pylist(), table.column("bits").to_pylist(), strict=True)), shard_bits))
    del table

    def run(batches):
        hw, hc = sent_head.value
        counts, head = CountFilter(*sent.value), (hw, hc, np.log10(hc + 1.0))
        for batch in batches:
            for block in token_blocks(batch.column(3)):
                yield _block_rows(head, block, batch.columns[:3], lambda b, w, at: text_scores(b, w, at, counts, n, v))

    return src.mapInArrow(run, SCORED)


def _group_bits(shard_bits: int) -> int:
    return min(shard_bits, max(LEAST_GROUP_BITS, shard_bits - GROUP_SHARD_BITS))


def _sorted_once(x: np.ndarray) -> np.ndarray:
    """The distinct values in order; ``x`` itself is sorted."""
    x.sort()
    return x[np.r_[True, x[1:] != x[:-1]]] if len(x) else x


def wanted(blocks) -> np.ndarray:
    """The distinct n-grams of token blocks, in order, without the bits that no name or shard keeps."""
    keys = [_sorted_once(_ngrams(t, v) >> _DROP) for _, t, _, v in blocks]
    return _sorted_once(np.concatenate([*keys, unigram_key(np.array([END])) >> _DROP]))


def _binaries(data: np.ndarray, edges: np.ndarray) -> pa.Array:
    """Binary values that hold ``data[edges[i]:edges[i + 1]]`` each."""
    offsets = edges * data.itemsize
    if len(offsets) and offsets[-1] >= 1 << 31:
        raise ValueError("a text is too long for one chunk")
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(offsets.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])


def _values(column: pa.Array, dtype: str) -> tuple[np.ndarray, np.ndarray]:
    """(all values of a binary column without NULLs, how many of them each row has)."""
    column = column.cast(pa.binary())
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int32)[column.offset:column.offset + len(column) + 1]
    width = np.dtype(dtype).itemsize
    values = np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]].view(dtype) if data is not None else np.zeros(0, dtype)
    return values, np.diff(offsets) // width


def chunks_of(batches, most: int | None = None) -> Iterator[pa.Table]:
    """The rows in order, in tables of about ``most`` bytes of the column ``text``; at least one row each."""
    most = most or CHUNK_BYTES
    held, size = [], 0
    for batch in batches:
        length = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        ends, lo = np.cumsum(length), 0
        while lo < batch.num_rows:
            before = int(ends[lo - 1]) if lo else 0
            hi = min(batch.num_rows, int(np.searchsorted(ends, before + most - size, "right")))
            if hi == lo and not held:
                hi = lo + 1
            if hi > lo:
                held.append(batch.slice(lo, hi - lo))
                size += int(ends[hi - 1]) - before
                lo = hi
            if lo < batch.num_rows:
                yield pa.Table.from_batches(held)
                held, size = [], 0
    if held:
        yield pa.Table.from_batches(held)


ASKED = "part long, chunk long, shard int, sizes binary, names binary, bits binary, text binary"


def questions(chunk: int, table: pa.Table, shard_bits: int) -> Iterator[pa.RecordBatch]:
    """A row with the chunk's rows, compressed (``part`` below 0), and one for each group of shards that has n-grams of it."""
    names = [x.split()[0] for x in ASKED.split(", ")]

    def rows(m: int, **own) -> pa.RecordBatch:
        none = {"part": pa.int64(), "chunk": pa.int64(), "shard": pa.int32()}
        return pa.RecordBatch.from_arrays([own.get(c, pa.nulls(m, none.get(c, pa.binary()))) for c in names], names)

    out = pa.BufferOutputStream()
    with pa.ipc.new_stream(out, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as to:
        to.write_table(table)
    yield rows(1, part=pa.array([-1 - chunk], pa.int64()), chunk=pa.array([chunk], pa.int64()), text=pa.array([out.getvalue().to_pybytes()], pa.binary()))
    short = wanted(token_blocks(table.column("text").combine_chunks()))
    shards, groups = 1 << shard_bits, 1 << _group_bits(shard_bits)
    edges = np.searchsorted(short, np.arange(shards, dtype=np.uint64) << np.uint64(64 - int(_DROP) - shard_bits))
    edges = np.r_[edges, len(short)]
    ends = edges[::shards // groups]
    some = pa.array(np.flatnonzero(np.diff(ends)))
    yield rows(len(some), part=some, chunk=pa.array(np.full(len(some), chunk)),
               sizes=_binaries(np.diff(edges).astype("<u4"), np.arange(groups + 1) * (shards // groups)).take(some),
               names=_binaries((short & _LOW).astype("<u4"), ends).take(some))


ANSWERED = "chunk long, part long, levels binary, text binary"


def answers(batches, shard_bits: int) -> Iterator[pa.RecordBatch]:
    """The levels of the names of each question, in their order; a group's shards stand before its questions, texts pass."""
    each = 1 << (shard_bits - _group_bits(shard_bits))
    now, shards = None, {}
    data, offset, size = (np.zeros(0, t) for t in (np.uint8, np.int64, np.int64))
    for batch in batches:
        part = batch.column("part").to_numpy()
        edges = np.flatnonzero(np.diff(part, prepend=part[:1] - 1)).tolist()
        for lo, hi in zip(edges, [*edges, len(part)][1:], strict=True):
            run = batch.slice(lo, hi - lo)
            if part[lo] < 0:
                yield pa.RecordBatch.from_arrays([run.column("chunk"), run.column("part"), pa.nulls(run.num_rows, pa.binary()), run.column("text")],
                                                 ["chunk", "part", "levels", "text"])
                continue
            if part[lo] != now:
                now, shards, data = part[lo], {}, None
            own = run.filter(pc.is_null(run.column("chunk")))
            shards.update(zip(own.column("shard").to_pylist(), own.column("bits").to_pylist(), strict=True))
            asked = run.slice(own.num_rows)
            if not asked.num_rows:
                continue
            if data is None:
                parts = [shards.get(int(now) * each + i, b"") for i in range(each)]
                size = np.array([len(x) for x in parts])
                offset, size, data = np.cumsum(size) - size, size * 8, np.frombuffer(b"".join(parts), np.uint8)
                shards = {}
            name, n = _values(asked.column("names"), "<u4")
            at = np.repeat(np.tile(np.arange(each), asked.num_rows), _values(asked.column("sizes"), "<u4")[0])
            level = probe(data, name.astype(np.uint64), offset[at], size[at]).astype(np.uint8)
            yield pa.RecordBatch.from_arrays([asked.column("chunk"), asked.column("part"), _binaries(level, np.r_[0, np.cumsum(n)]),
                                              pa.nulls(asked.num_rows, pa.binary())], ["chunk", "part", "levels", "text"])


def _answered(batches) -> Iterator[tuple[list[pa.Array], list, Answers]]:
    """(columns, token blocks, levels) of each chunk; its text stands first, then the groups in order."""
    now, text, levels = None, None, []

    def whole() -> tuple[list[pa.Array], list, Answers]:
        with pa.ipc.open_stream(text) as read:
            *columns, texts = (c.combine_chunks() for c in read.read_all().columns)
        blocks, level = list(token_blocks(texts)), np.frombuffer(b"".join(levels), np.uint8)
        short = wanted(blocks)
        if len(short) != len(level):
            raise ValueError(f"{len(level)} answers to {len(short)} questions")
        return columns, blocks, Answers(short, level)

    for batch in batches:
        for chunk, own, level in zip(batch.column("chunk").to_pylist(), batch.column("text"), batch.column("levels"), strict=True):
            if chunk != now:
                if now is not None:
                    yield whole()
                now, text, levels = chunk, None, []
            if own.is_valid:
                text = own.as_buffer()
            else:
                levels.append(level.as_py())
    if now is not None:
        yield whole()


def _with_shards(src: DataFrame, shards: DataFrame, shard_bits: int, sent_head, n: int, v: int) -> DataFrame:
    """Texts in chunks; a chunk's distinct n-grams go to their shards and come back as levels."""

    def ask(batches):
        base = TaskContext.get().partitionId() << 32
        for i, table in enumerate(chunks_of(batches)):
            yield from questions(base + i, table, shard_bits)

    def answer(batches):
        yield from answers(batches, shard_bits)

    def scored(batches):
        hw, hc = sent_head.value
        head = (hw, hc, np.log10(hc + 1.0))
        for columns, blocks, counts in _answered(batches):
            for block in blocks:
                yield _block_rows(head, block, columns, lambda b, w, at: text_scores(b, w, at, counts, n, v))

    group = F.shiftright("shard", shard_bits - _group_bits(shard_bits)).cast("long")
    bits = shards.select(group.alias("part"), "shard", "bits")
    asked = src.mapInArrow(ask, ASKED).unionByName(bits, allowMissingColumns=True).repartition("part")
    told = asked.sortWithinPartitions("part", F.col("chunk").asc_nulls_first()).mapInArrow(answer, ANSWERED)
    return told.repartition("chunk").sortWithinPartitions("chunk", "part").mapInArrow(scored, SCORED)


def score(docs: DataFrame, held_out, id_col: str = "doc_id", text_col: str = "text",
          broadcast_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """Per row: ``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score``.

    ``held_out``: a boolean Column; rows where it is true don't train (NULL:
    they do).  NULL and empty texts hold the end token only.  Repeated rows
    count and score each.  NULL ids stay.  With no training text every count is 0.
    Other columns are ignored; an empty table gives an empty result.
    """
    spark = docs.sparkSession
    src = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).cast("long").alias("doc_id"),
                      F.coalesce(held_out, F.lit(False)).alias("held_out"), F.col(text_col).alias("text"))
    train = src.where("NOT held_out").select("text")
    with scope(spark):  # its end drops the shuffle files
        words = written(word_counts(train), "lm-words", outer=True)
    total = words.agg(F.sum("c").alias("n"), F.count("*").alias("v")).first()
    n, v = int(total["n"] or 0), int(total["v"])
    head = most_frequent(words, HEAD, "c").toArrow()
    order = np.argsort(hw := head.column("word").to_numpy())
    sent = spark.sparkContext.broadcast((hw[order], head.column("c").to_numpy()[order]))
    shard_bits = shard_bits_for(n)
    with scope(spark):
        shards = written(filter_shards(train, shard_bits), "lm-shards", outer=True)
    size = shards.agg(F.sum(F.octet_length("bits"))).first()[0] or 0
    form = _with_broadcast if size <= broadcast_bytes else _with_shards
    with scope(spark):
        scored = written(form(src, shards, shard_bits, sent, n, v), "lm-scored", outer=True)
    rare = scored.where("word IS NOT NULL").select("row", "word", "n").join(words, "word").groupBy("row").agg(
        F.sum("n").alias("_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1.0)).alias("_logs"))
    out = scored.where("word IS NULL").join(rare, "row", "left")
    base = (F.col("logs") + F.coalesce("_logs", F.lit(0.0))) - F.col("n") * F.log10(F.lit(float(n + v + 1)))
    return out.select("doc_id", "held_out", F.col("n").alias("n_tokens"),
                      (F.col("known") + F.coalesce("_known", F.lit(0))).alias("n_known"),
                      F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def crc_held_out(id_col: str = "doc_id"):
    """crc32 of the id as text leaves 2 when divided by 7."""
    return F.crc32(F.col(id_col).cast("string")) % 7 == 2

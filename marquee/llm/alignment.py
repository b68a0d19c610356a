"""Alignment of two tokenizers over a corpus, by inverted bitmaps of id pairs.

Both tokenizers cut the same bytes (a blank and the text).  Two tokens are *linked* if their byte ranges overlap;
offsets where tokens of both end cut a document into *groups*.  A pair's score is the number of its links
in the whole corpus; it is the best of its B id if no pair of that id has more.

1. *Tokens and postings* (``postings``, one pass over the texts): the links of a block of documents are found on byte
   offsets, for all its documents at once.  Documents are numbered within chunks (at most 2^16 of them); per pair a chunk
   has a compressed bitmap of the documents that link it, the blocks' bitmaps OR-merged, and multiplicity planes: plane
   ``k`` is the bitmap of the documents whose number of links, less one, has bit ``k`` set.  A bitmap is a list of
   16-bit places, or plain bits where those are shorter.
2. *Counts* (``pair_counts``): the popcounts of all chunks' bitmaps add up to a pair's documents, those of the planes, times
   2^k, to its links.  Pairs are dealt into buckets of a scrambled pair number, so a frequent pair is one entry a chunk.
3. *Scores back* (``align``): the buckets answer each chunk's pairs with their counts; the postings then give each
   document, place by place, the sum over its links.

Memory is bounded by a chunk (``CHUNK_BYTES`` of text, or one document longer than that) and by a bucket (``2^LOCAL_BITS`` pair
numbers); no row, group or broadcast grows with the corpus.  What the driver gets is one number per B id.

Defined results: NULL and empty texts, and texts whose tokens of either side don't give back their bytes, have no tokens:
zeros and an empty digest.  Every input row gives one row, repeated ids and NULL ids too; other columns are
ignored.
"""

from __future__ import annotations

import hashlib
import json
import os
import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.bpe import byte_letters
from marquee.llm.common import written
from marquee.llm.hashing import row_blocks, text_buffers

BLOCK_BYTES = 1 << 19
CHUNK_BYTES = 8 << 20
CHUNK_DOCS = 1 << 16
LOCAL_BITS = 20
LEAST_BUCKET_BITS = 11
_ODD = 0x9E3779B1  # an odd multiplier: a bijection of the pair numbers
_MORE = np.dtype([("plane", "u1"), ("at", "<u4"), ("size", "<u2")])

DOC_COLUMNS = ["n_a", "n_b", "n_groups", "n_links"]


# The split pattern of byte-level vocabularies.
SPLIT = (r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")

#: Texts whose characters have the same classes in every Unicode version.
_STABLE = re.compile("[\x00-\u024f]*")


# The two tokenizers ----------------------------------------------------------

class Tokenizers:
    """A: a byte-level BPE file of the tokenizers library; B: a sentencepiece model.  Read once in each worker.

    Where A's ids are its merge ranks and it splits by the usual pattern, texts below U+0250 are encoded by tiktoken over
    the same file's vocabulary: the same ids (tested), in a fifth of the time.  All others go through the tokenizers library.
    """

    def __init__(self, path_a: str, path_b: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(path_a)
        self.a.encode_special_tokens = True
        self.a.no_truncation()
        self.a.no_padding()
        self.b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        value = {c: i for i, c in enumerate(byte_letters())}
        vocab = self.a.get_vocab(with_added_tokens=True)
        self.bytes_a = [b""] * (max(vocab.values()) + 1)
        for piece, i in vocab.items():
            self.bytes_a[i] = bytes(value[c] for c in piece) if all(c in value for c in piece) else piece.encode()
        pieces = [self.b.id_to_piece(i) for i in range(self.b.get_piece_size())]
        self.bytes_b = [bytes([int(p[3:5], 16)]) if self.b.is_byte(i) else p.replace("\u2581", " ").encode() for i, p in enumerate(pieces)]
        self.len_a = np.array([len(x) for x in self.bytes_a], np.int64)
        self.len_b = np.array([len(x) for x in self.bytes_b], np.int64)
        ends = (b",", b"|", b";", b"")
        self.shown = [b"%d%s" % (i, e) for i in range(max(len(self.bytes_a), len(self.bytes_b))) for e in ends]
        d = json.loads(self.a.to_str())
        pre, model = d["pre_tokenizer"] or {}, d["model"]
        own = model["vocab"]
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        ranked = (pre.get("type") == "ByteLevel" and not pre.get("add_prefix_space") and pre.get("use_regex") and d["normalizer"] is None
                  and not model.get("end_of_word_suffix") and not model.get("continuing_subword_prefix") and not model.get("ignore_merges")
                  and [own[x + y] for x, y in merges] == list(range(256, 256 + len(merges))))
        self.fast_a = tiktoken.Encoding("a", pat_str=SPLIT, mergeable_ranks={self.bytes_a[i]: i for p, i in own.items() if i < 256 + len(merges)},
                                        special_tokens={}) if ranked else None

    def _encode_a(self, spaced: list[str]) -> list[np.ndarray]:
        out: list[np.ndarray | None] = [None] * len(spaced)
        rest = []
        for i, t in enumerate(spaced):
            if self.fast_a is not None and _STABLE.fullmatch(t):
                out[i] = self.fast_a.encode_to_numpy(t, disallowed_special=())
            else:
                rest.append(i)
        for i, e in zip(rest, self.a.encode_batch_fast([spaced[i] for i in rest], add_special_tokens=False), strict=True):
            out[i] = np.array(e.ids, np.int64)
        return out

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(A's ids, A's ids per text, B's ids, B's ids per text); none where they don't give back the text's bytes."""
        spaced = [" " + t if t else "" for t in texts]
        found_a, found_b = self._encode_a(spaced), self.b.encode(texts, num_threads=1)
        none: list[int] = []
        for i, (text, a, b) in enumerate(zip(spaced, found_a, found_b, strict=True)):
            raw = text.encode()
            if not raw or b"".join(map(self.bytes_b.__getitem__, b)) != raw or b"".join(map(self.bytes_a.__getitem__, a.tolist())) != raw:
                found_a[i], found_b[i] = found_a[i][:0], none
        n_a, n_b = (np.array(list(map(len, x)), np.int64) for x in (found_a, found_b))
        b = np.fromiter(chain.from_iterable(found_b), np.int64, int(n_b.sum()))
        return np.concatenate([np.zeros(0, np.int64), *found_a]).astype(np.int64), n_a, b, n_b


@lru_cache(maxsize=1)
def tokenizers(path_a: str, path_b: str) -> Tokenizers:
    return Tokenizers(path_a, path_b)


@dataclass(frozen=True)
class PairNumbers:
    """Numbers of id pairs, scrambled so that equal shares of them make a bucket."""

    size_a: int
    size_b: int

    @property
    def bits(self) -> int:
        return max(LOCAL_BITS + LEAST_BUCKET_BITS, (self.size_a * self.size_b - 1).bit_length())

    def of(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return ((a * self.size_b + b) * _ODD) & ((1 << self.bits) - 1)

    def ids(self, number: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inverse = pow(_ODD, -1, 1 << self.bits)
        with np.errstate(over="ignore"):
            pair = (number * np.int64(inverse if inverse < 1 << 63 else inverse - (1 << 64))) & ((1 << self.bits) - 1)
        return pair // self.size_b, pair % self.size_b


# Links of a block ------------------------------------------------------------

@dataclass
class Links:
    """Links of some documents: per link its document and the two ids; per document the counts and digest."""

    doc: np.ndarray
    a: np.ndarray
    b: np.ndarray
    n_a: np.ndarray
    n_b: np.ndarray
    n_groups: np.ndarray
    n_links: np.ndarray
    digest: list[str]


def link(both: Tokenizers, texts: list[str]) -> Links:
    """All links of the texts, from the end offsets of both sides' tokens laid one document after the other."""
    a, n_a, b, n_b = both.encode(texts)
    n = len(texts)
    if not len(a):
        zero = np.zeros(0, np.int64)
        return Links(zero, zero, zero, n_a, n_b, np.zeros(n, np.int64), np.zeros(n, np.int64), [""] * n)
    end_a, end_b = np.cumsum(both.len_a[a]), np.cumsum(both.len_b[b])
    mark = np.zeros(int(end_a[-1]) + 1, np.uint8)
    mark[end_a] = 1
    mark[end_b] |= 2
    piece = np.flatnonzero(mark)  # every piece between neighbouring ends is one link
    kind = mark[piece]
    is_a, is_b, cut = (kind & 1).astype(np.int64), (kind >> 1).astype(np.int64), kind == 3
    at_a, at_b = np.cumsum(is_a) - is_a, np.cumsum(is_b) - is_b
    doc_a = np.repeat(np.arange(n), n_a)
    doc = doc_a[at_a]
    n_groups = np.bincount(doc[cut], minlength=n)

    # tokens of a group: its A tokens, then its B tokens, each with what stands behind it
    last_a, last_b = at_a[cut], at_b[cut]  # last token of each group, on both sides
    group_a = np.repeat(np.arange(len(last_a)), np.diff(last_a, prepend=-1))
    group_b = np.repeat(np.arange(len(last_b)), np.diff(last_b, prepend=-1))
    behind_a, behind_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
    behind_a[last_a] = 1
    behind_b[last_b] = 2
    behind_b[np.cumsum(n_b)[n_b > 0] - 1] = 3
    before_b = np.concatenate([[0], last_b + 1])
    code = np.empty(len(a) + len(b), np.int64)
    code[np.arange(len(a)) + before_b[group_a]] = a * 4 + behind_a
    code[np.arange(len(b)) + last_a[group_b] + 1] = b * 4 + behind_b
    stops = np.cumsum(n_a + n_b)
    shown, parts = both.shown.__getitem__, code.tolist()
    digest = [hashlib.sha256(b"".join(map(shown, parts[hi - k:hi]))).hexdigest() if k else ""
              for hi, k in zip(stops.tolist(), (n_a + n_b).tolist(), strict=True)]
    return Links(doc, a[at_a], b[at_b], n_a, n_b, n_groups, np.bincount(doc, minlength=n), digest)


# Bitmaps ---------------------------------------------------------------------

def pack(sizes: np.ndarray, places: np.ndarray, bitmap_bytes: int) -> bytes:
    """Bitmaps one after the other: ``sizes`` places each; as 16-bit lists, then those that are shorter as bits."""
    as_bits = sizes * 2 > bitmap_bytes
    if not as_bits.any():
        return places.astype("<u2").tobytes()
    owner = np.repeat(as_bits, sizes)
    row = np.repeat(np.cumsum(as_bits) - 1, sizes)[owner]
    bits = np.zeros((int(as_bits.sum()), bitmap_bytes * 8), np.uint8)
    bits[row, places[owner]] = 1
    return places[~owner].astype("<u2").tobytes() + np.packbits(bits, axis=1, bitorder="little").tobytes()


def unpack(sizes: np.ndarray, data: bytes, bitmap_bytes: int) -> tuple[np.ndarray, np.ndarray]:
    """(index of the bitmap, place) of every bit set."""
    as_bits = sizes * 2 > bitmap_bytes
    listed = np.flatnonzero(~as_bits)
    n = int(sizes[listed].sum())
    owner = np.repeat(listed, sizes[listed])
    places = np.frombuffer(data, "<u2", n).astype(np.int64)
    if as_bits.any():
        bits = np.frombuffer(data, np.uint8, offset=2 * n).reshape(-1, bitmap_bytes)
        row, more = np.nonzero(np.unpackbits(bits, axis=1, bitorder="little"))
        owner = np.concatenate([owner, np.flatnonzero(as_bits)[row]])
        places = np.concatenate([places, more])
    return owner, places


def _gaps(numbers: np.ndarray) -> bytes:
    return np.diff(numbers, prepend=0).astype("<u4").tobytes()


def _numbers(gaps: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(gaps, "<u4").astype(np.int64))


def _total(sizes: np.ndarray, more: np.ndarray) -> np.ndarray:
    """Links per pair: popcount of the document bitmap, and of each plane times 2^plane."""
    total = sizes.copy()
    np.add.at(total, more["at"].astype(np.int64), more["size"].astype(np.int64) << more["plane"].astype(np.int64))
    return total


class _Chunk:
    """The documents of a chunk and the bitmaps of its pairs, block by block."""

    def __init__(self, number: int, pairs: PairNumbers):
        self.number, self.pairs = number, pairs
        self.docs = self.bytes = 0
        self.entries, self.times = [], []

    def add(self, links: Links, n_bytes: int) -> None:
        entry = (self.pairs.of(links.a, links.b) << 16) | (links.doc + self.docs)
        entry, times = np.unique(entry, return_counts=True)
        self.entries.append(entry)
        self.times.append(times)
        self.docs += len(links.n_a)
        self.bytes += n_bytes

    def rows(self) -> Iterator[tuple]:
        """``bucket, bitmap_bytes, keys, sizes, places, more, more_places`` of every bucket that has pairs."""
        entry = np.concatenate(self.entries) if self.entries else np.zeros(0, np.int64)
        order = np.argsort(entry, kind="stable")  # the blocks' bitmaps of a pair, OR-merged: they hold different documents
        entry = entry[order]
        times = np.concatenate(self.times)[order] - 1 if self.times else entry
        self.entries, self.times = [], []
        pair, place = entry >> 16, entry & 0xFFFF
        starts = np.flatnonzero(np.diff(pair, prepend=-1))
        number, size = pair[starts], np.diff(starts, append=len(pair))
        owner = np.repeat(np.arange(len(starts)), size)
        planes = [np.flatnonzero(times >> k & 1) for k in range(int(times.max(initial=0)).bit_length())]
        width = (self.docs + 7) // 8
        bucket = number >> LOCAL_BITS
        edges = np.flatnonzero(np.diff(bucket, prepend=-1))
        for lo, hi in zip(edges.tolist(), [*edges.tolist(), len(number)][1:], strict=True):
            first, end = int(starts[lo]), int(starts[hi]) if hi < len(starts) else len(pair)
            more, more_places = [], []
            for k, of in enumerate(planes):
                of = of[np.searchsorted(of, first):np.searchsorted(of, end)]
                if len(of):
                    at, n = np.unique(owner[of] - lo, return_counts=True)
                    index = np.zeros(len(at), _MORE)
                    index["plane"], index["at"], index["size"] = k, at, n
                    more.append(index.tobytes())
                    more_places.append(pack(n, place[of], width))
            yield (int(bucket[lo]), width, _gaps(number[lo:hi] & ((1 << LOCAL_BITS) - 1)), (size[lo:hi] - 1).astype("<u2").tobytes(),
                   pack(size[lo:hi], place[first:end], width), b"".join(more), more_places)


def _sizes(data: bytes) -> np.ndarray:
    """Sizes are stored less one: a chunk may have 2^16 documents."""
    return np.frombuffer(data, "<u2").astype(np.int64) + 1


_POSTING = [("bitmap_bytes", pa.int32()), ("keys", pa.binary()), ("sizes", pa.binary()), ("places", pa.binary()),
            ("more", pa.binary()), ("more_places", pa.list_(pa.binary()))]


def postings(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """One table of two kinds of rows: documents (``bucket`` = -1, ``place`` in their chunk) and postings (chunk, bucket)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both = tokenizers(path_a, path_b)
        pairs = PairNumbers(len(both.bytes_a), len(both.bytes_b))
        base, n_chunks = TaskContext.get().partitionId() << 32, 0
        chunk = _Chunk(base, pairs)

        def closed() -> Iterator[pa.RecordBatch]:
            rows: list[tuple] = []
            size = 0
            for row in chunk.rows():
                rows.append(row)
                size += len(row[2]) + len(row[4])
                if size > 4 << 20:
                    yield posting_batch(rows)
                    rows, size = [], 0
            if rows:
                yield posting_batch(rows)

        def posting_batch(rows: list[tuple]) -> pa.RecordBatch:
            bucket, *rest = zip(*rows)
            n = len(rows)
            return pa.RecordBatch.from_arrays(
                [pa.array([chunk.number] * n, pa.int64()), pa.array(bucket, pa.int32()), pa.nulls(n, pa.int32()), pa.nulls(n, id_type),
                 *(pa.nulls(n, pa.int64()) for _ in DOC_COLUMNS), pa.nulls(n, pa.string()),
                 *(pa.array(c, k) for c, (_, k) in zip(rest, _POSTING, strict=True))], names=names)

        names = ["chunk", "bucket", "place", "id", *DOC_COLUMNS, "groups_sha256", *(c for c, _ in _POSTING)]
        id_type = None
        for batch in batches:
            ids, texts = batch.column(0), pc.fill_null(batch.column(1), "")
            id_type = ids.type
            offsets, _ = text_buffers(texts)
            for lo, hi in row_blocks(offsets, BLOCK_BYTES):
                if chunk.docs and (chunk.docs + hi - lo > CHUNK_DOCS or chunk.bytes + offsets[hi] - offsets[lo] > CHUNK_BYTES):
                    yield from closed()
                    n_chunks += 1
                    chunk = _Chunk(base + n_chunks, pairs)
                links = link(both, texts.slice(lo, hi - lo).to_pylist())
                n = hi - lo
                place = pa.array(np.arange(chunk.docs, chunk.docs + n).astype(np.int32))
                chunk.add(links, int(offsets[hi] - offsets[lo]))
                yield pa.RecordBatch.from_arrays(
                    [pa.array([chunk.number] * n, pa.int64()), pa.array([-1] * n, pa.int32()), place, ids.slice(lo, n),
                     *(pa.array(getattr(links, c)) for c in DOC_COLUMNS), pa.array(links.digest, pa.string()),
                     *(pa.nulls(n, k) for _, k in _POSTING)], names=names)
        if id_type is not None:
            yield from closed()

    kind = docs.schema[doc_id].dataType.simpleString()
    schema = (f"chunk long, bucket int, place int, id {kind}, " + ", ".join(f"{c} long" for c in DOC_COLUMNS)
              + ", groups_sha256 string, bitmap_bytes int, keys binary, sizes binary, places binary, more binary, more_places array<binary>")
    return docs.select(doc_id, F.col(text).cast("string")).mapInArrow(run, schema)


# Counts ----------------------------------------------------------------------

def _by_bucket(rows: DataFrame, *order: str) -> DataFrame:
    return rows.repartition("bucket").sortWithinPartitions("bucket", *order)


def _bucket_counts(table: DataFrame, pairs: PairNumbers) -> DataFrame:
    """Per bucket one row ``bucket, keys, documents, links`` (packed), and rows ``b, most``: the most links that a task saw of a B id."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        documents, links = np.zeros(1 << LOCAL_BITS, np.int64), np.zeros(1 << LOCAL_BITS, np.int64)
        most = np.zeros(pairs.size_b, np.int64)
        now = -1

        def row() -> pa.RecordBatch:
            at = np.flatnonzero(documents)
            _, b = pairs.ids((now << LOCAL_BITS) + at)
            np.maximum.at(most, b, links[at])
            out = pa.RecordBatch.from_arrays(
                [pa.array([now], pa.int32()), pa.array([_gaps(at)], pa.binary()), pa.array([documents[at].tobytes()], pa.binary()),
                 pa.array([links[at].tobytes()], pa.binary()), pa.nulls(1, pa.int32()), pa.nulls(1, pa.int64())], names=names)
            documents[at] = 0
            links[at] = 0
            return out

        names = ["bucket", "keys", "documents", "links", "b", "most"]
        for batch in batches:
            for bucket, keys, sizes, more in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if bucket != now:
                    if now >= 0:
                        yield row()
                    now = bucket
                at, size = _numbers(keys), _sizes(sizes)
                documents[at] += size
                links[at] += _total(size, np.frombuffer(more, _MORE))
        if now >= 0:
            yield row()
        b = np.flatnonzero(most)
        n = len(b)
        yield pa.RecordBatch.from_arrays(
            [pa.nulls(n, pa.int32()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()), pa.nulls(n, pa.binary()),
             pa.array(b.astype(np.int32)), pa.array(most[b])], names=names)

    rows = table.where("bucket >= 0").select("bucket", "keys", "sizes", "more")
    return written(_by_bucket(rows).mapInArrow(
        run, "bucket int, keys binary, documents binary, links binary, b int, most long"), "alignment-counts")


def _most(counts: DataFrame, pairs: PairNumbers) -> np.ndarray:
    """Per B id the most links of a pair of it (one number a vocabulary entry)."""
    out = np.zeros(pairs.size_b, np.int64)
    for r in counts.where("b IS NOT NULL").groupBy("b").agg(F.max("most").alias("most")).collect():
        out[r["b"]] = r["most"]
    return out


def pair_scores(counts: DataFrame, pairs: PairNumbers, most: np.ndarray) -> DataFrame:
    """The pair table: ``a, b, documents, links, best``."""
    shared = counts.sparkSession.sparkContext.broadcast(most)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for bucket, keys, documents, links in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                a, b = pairs.ids((bucket << LOCAL_BITS) + _numbers(keys))
                n = np.frombuffer(links, np.int64)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(a.astype(np.int32)), pa.array(b.astype(np.int32)), pa.array(np.frombuffer(documents, np.int64)), pa.array(n),
                     pa.array(n == shared.value[b])], names=["a", "b", "documents", "links", "best"])

    return counts.where("bucket IS NOT NULL").select("bucket", "keys", "documents", "links").mapInArrow(
        run, "a int, b int, documents long, links long, best boolean")


# Scores back to the documents ------------------------------------------------

def _answers(table: DataFrame, counts: DataFrame) -> DataFrame:
    """``chunk, bucket, counts``: the links of each pair that the chunk has in the bucket, in the order of its keys."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = np.zeros(1 << LOCAL_BITS, np.int64)
        for batch in batches:
            out: list[tuple] = []
            for bucket, chunk, keys, found in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                at = _numbers(keys)
                if chunk is None:  # the bucket's counts come first
                    links[at] = np.frombuffer(found, np.int64)
                else:
                    n = links[at]
                    out.append((chunk, bucket, (n.astype("<u4") if n.max(initial=0) < 1 << 32 else n).tobytes()))
            if out:
                chunks, buckets, answers = zip(*out)
                yield pa.RecordBatch.from_arrays([pa.array(chunks, pa.int64()), pa.array(buckets, pa.int32()), pa.array(answers, pa.binary())],
                                                 names=["chunk", "bucket", "counts"])

    asked = table.where("bucket >= 0").select("bucket", "chunk", "keys", F.lit(None).cast("binary").alias("links"))
    known = counts.where("bucket IS NOT NULL").select("bucket", F.lit(None).cast("long").alias("chunk"), "keys", "links")
    return _by_bucket(asked.unionByName(known), "chunk").mapInArrow(run, "chunk long, bucket int, counts binary")


def _sums(table: DataFrame, answers: DataFrame, pairs: PairNumbers, most: np.ndarray) -> DataFrame:
    """Documents with ``n_best`` and ``count_sum``, from the postings and answers of their chunk."""
    shared = table.sparkSession.sparkContext.broadcast(most)
    fields = ["id", *DOC_COLUMNS, "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, docs, n, counted = None, [], 0, b""
        best = total = np.zeros(0, np.int64)

        def chunk() -> pa.RecordBatch:
            whole = pa.Table.from_batches(docs)
            at = whole.column("place").to_numpy()
            columns = [whole.column(f).combine_chunks() for f in fields]
            return pa.RecordBatch.from_arrays([*columns, pa.array(best[at]), pa.array(total[at])], names=[*fields, "n_best", "count_sum"])

        for batch in batches:
            chunks, buckets = batch.column("chunk").to_numpy(), batch.column("bucket").to_numpy()
            edges = np.flatnonzero(np.diff(chunks, prepend=chunks[0] - 1 if len(chunks) else 0)).tolist()
            for lo, hi in zip(edges, [*edges, len(chunks)][1:], strict=True):
                if chunks[lo] != now:
                    if docs:
                        yield chunk()
                    now, docs = chunks[lo], []
                    best = total = np.zeros(0, np.int64)
                first = lo + int(np.searchsorted(buckets[lo:hi], 0))  # documents stand before the buckets
                if first > lo:
                    docs.append(batch.slice(lo, first - lo))
                    n = 1 + max(int(pc.max(d.column("place")).as_py()) for d in docs)
                    best, total = np.zeros(n, np.int64), np.zeros(n, np.int64)
                part = batch.slice(first, hi - first)
                for bucket, width, keys, sizes, places, more, more_places, counts in zip(
                        *(part.column(c).to_pylist() for c in ["bucket", *(c for c, _ in _POSTING), "counts"]), strict=True):
                    if counts is not None:  # the answer stands before its posting
                        counted = counts
                        continue
                    number, size = _numbers(keys), _sizes(sizes)
                    count = np.frombuffer(counted, "<u4" if len(counted) == 4 * len(number) else np.int64).astype(np.int64)
                    is_best = (count == shared.value[pairs.ids((bucket << LOCAL_BITS) + number)[1]]).astype(np.int64)
                    owner, place = unpack(size, places, width)
                    np.add.at(total, place, count[owner])
                    np.add.at(best, place, is_best[owner])
                    index = np.frombuffer(more, _MORE)
                    begin = np.flatnonzero(np.diff(index["plane"].astype(np.int64), prepend=-1)).tolist()
                    for x, y, data in zip(begin, [*begin, len(index)][1:], more_places, strict=True):
                        owner, place = unpack(index["size"][x:y].astype(np.int64), data, width)
                        owner = index["at"][x:y].astype(np.int64)[owner]
                        times = 1 << int(index["plane"][x])
                        np.add.at(total, place, times * count[owner])
                        np.add.at(best, place, times * is_best[owner])
        if docs:
            yield chunk()

    posted = [c for c, _ in _POSTING]
    rows = table.withColumn("counts", F.lit(None).cast("binary")).unionByName(
        answers.select("chunk", "bucket", "counts"), allowMissingColumns=True)
    rows = rows.select("chunk", "bucket", "place", *fields, *posted, "counts")
    rows = rows.repartition("chunk").sortWithinPartitions("chunk", "bucket", F.col("counts").isNull())
    kind = table.schema["id"].dataType.simpleString()
    schema = f"id {kind}, " + ", ".join(f"{c} long" for c in DOC_COLUMNS) + ", groups_sha256 string, n_best long, count_sum long"
    return rows.mapInArrow(run, schema)


def align(docs: DataFrame, path_a: str, path_b: str, doc_id: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame]:
    """(documents, pairs).

    Documents: ``doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256``, one row per input row.  Pairs: ``a, b,
    documents, links, best``, one row per id pair that is linked anywhere.
    """
    both = tokenizers(path_a, path_b)
    pairs = PairNumbers(len(both.bytes_a), len(both.bytes_b))
    table = written(postings(docs, path_a, path_b, doc_id, text), "alignment-postings")
    counts = _bucket_counts(table, pairs)
    most = _most(counts, pairs)
    documents = _sums(table, _answers(table, counts), pairs, most).select(
        F.col("id").alias("doc_id"), "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256")
    return documents, pair_scores(counts, pairs, most)

"""BPE encoding and decoding with forced boundaries.

A pair of neighbouring bytes that occurs inside no vocabulary token can never
be merged over, so it is a certain cut: the fragments between such cuts are
encoded independently and their ids concatenated — exactly the whole word's
ids.  The last byte of a word is a symbol of its own (it carries the
end-of-word mark), so cuts before it are found as well.

Fragments are merged many at a time: a matrix of symbols per length, one
merge (lowest rank, leftmost) per row and step.  Words met before come from
a bounded cache; long fragments use a heap instead of the matrix.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.hashing import row_blocks, text_buffers

CACHE_RUNS = 300_000
MATRIX_LENGTH = 40
BLOCK_BYTES = 2 << 20
_NONE = np.iinfo(np.int32).max
_SPACE = regex.compile(r"\p{White_Space}+")
_SEPARATORS = re.compile("[\x1c-\x1f]")


def byte_letters() -> list[str]:
    """The printable stand-in of each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    out = {b: chr(b) for b in shown}
    hidden = [b for b in range(256) if b not in out]
    out |= {b: chr(256 + i) for i, b in enumerate(hidden)}
    return [out[b] for b in range(256)]


class _PairTable:
    """(left id, right id) -> (rank, merged id) by open addressing, looked up for whole arrays."""

    def __init__(self, pairs: dict[tuple[int, int], tuple[int, int]]):
        self.bits = max(10, int(len(pairs) * 4).bit_length())
        size = 1 << self.bits
        self.key = np.full(size, -1, np.int64)
        self.rank = np.full(size, _NONE, np.int32)
        self.into = np.zeros(size, np.int32)
        for (a, b), (rank, into) in pairs.items():
            k = (a << 32) | b
            at = ((k * 0x9E3779B97F4A7C15) & (2**64 - 1)) >> (64 - self.bits)
            while self.key[at] >= 0:
                at = (at + 1) & (size - 1)
            self.key[at], self.rank[at], self.into[at] = k, rank, into

    def find(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Slots of the pairs; the slot of an absent pair is empty (rank none)."""
        k = (a.astype(np.int64) << 32) | b
        at = ((k.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)
        here = self.key[at]
        off = np.flatnonzero((here != k) & (here >= 0))
        while len(off):
            at[off] = (at[off] + 1) & (len(self.key) - 1)
            here = self.key[at[off]]
            off = off[(here != k[off]) & (here >= 0)]
        return at


class ForcedBoundaryBpe:
    """A tokenizer read from the JSON text of a byte-level BPE with an end-of-word suffix.

    Read from the file: vocabulary, merges, split pattern, suffix and special
    tokens (whose strings in a text are matched first).  The normalisation
    is the file's: NFC, white space to one blank, lower case.
    """

    def __init__(self, definition: str):
        d = json.loads(definition)
        model = d["model"]
        kinds = [n["type"] for n in d["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or d.get("decoder"):
            raise ValueError("this reader expects BPE, NFC/white space/lower case and no decoder")
        self.suffix = model["end_of_word_suffix"] or ""
        vocab = model["vocab"]
        split = d["pre_tokenizer"]["pretokenizers"][0]["pattern"]["Regex"]
        self.pieces = regex.compile(split.replace(r"\s", r"\p{White_Space}") + "| ")
        special = {t["content"]: t["id"] for t in d["added_tokens"]}
        self.special = special
        self.cut_special = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(special, key=len, reverse=True)) + ")")
        letters = byte_letters()
        self.first = np.array([vocab[c] for c in letters], np.int32)
        self.last = np.array([vocab[c + self.suffix] for c in letters], np.int32)
        pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m if isinstance(m, list) else m.split(" ")
            pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.pairs, self.table = pairs, _PairTable(pairs)
        self.token = [""] * (max([*vocab.values(), *special.values()]) + 1)
        for t, i in [*vocab.items(), *special.items()]:
            self.token[i] = t
        self.never = self._cuts(vocab, letters)
        self.cache: dict[str, bytes] = {}

    def _cuts(self, vocab: dict[str, int], letters: list[str]) -> np.ndarray:
        """``never[x, y]``: symbols x, y (256 + byte: the last of a word) stand together in no token."""
        value = {c: b for b, c in enumerate(letters)}
        never = np.ones((256, 512), bool)
        for t in vocab:
            ends = bool(self.suffix) and t.endswith(self.suffix)
            try:
                s = [value[c] for c in (t[:-len(self.suffix)] if ends else t)]
            except KeyError:
                continue  # a special token, never made by merges
            if ends and s:
                s[-1] += 256
            for x, y in zip(s, s[1:]):
                never[x, y] = False
        return never

    def encode_runs(self, runs: list[str]) -> list[bytes]:
        """Little-endian 32-bit ids of each run (non-empty, normalised, without white space)."""
        joined = " ".join(runs)
        pieces = self.pieces.findall(joined)  # words and the blanks between the runs: every character, in order
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))
        raw = np.frombuffer(joined.encode(), np.uint8)
        char = np.r_[np.flatnonzero((raw & 0xC0) != 0x80), len(raw)]
        stop = char[np.cumsum(size)]
        begin = np.r_[0, stop[:-1]]
        blank = raw[begin] == 32
        word = np.flatnonzero(~blank)
        length = (stop - begin)[word]
        end = np.cumsum(length)  # of the words, without the blanks
        sym = raw[raw != 32].astype(np.int64)
        sym[end - 1] += 256
        run_end = np.r_[np.searchsorted(word, np.flatnonzero(blank)), len(word)] - 1  # last word of each run
        cut = np.zeros(len(sym), bool)
        cut[1:] = self.never[sym[:-1] & 255, sym[1:]]
        cut[end[:-1]] = True
        cut[0] = True
        start = np.flatnonzero(cut)
        length = np.diff(np.r_[start, len(sym)])
        ids = np.where(sym >= 256, self.last[sym & 255], self.first[sym & 255]).astype(np.int32)
        kept = np.ones(len(ids), bool)
        for n in np.unique(length[length > 1]):
            rows = start[length == n]
            if n > MATRIX_LENGTH:
                for s in rows:
                    got = self._heap(ids[s:s + n].tolist())
                    ids[s:s + len(got)] = got
                    kept[s + len(got):s + n] = False
                continue
            for part in np.array_split(rows, max(1, len(rows) * int(n) // 400_000)):
                at = part[:, None] + np.arange(n)
                m, left = self._matrix(ids[at])
                ids[at] = m
                kept[at] = np.arange(n) < left[:, None]
        out = ids[kept].astype("<u4").tobytes()
        bounds = np.r_[0, np.cumsum(kept)[end[run_end] - 1]] * 4
        return [out[a:b] for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]

    def _matrix(self, m: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Merge every row; (symbols, how many are left)."""
        rows, n = m.shape
        left = np.full(rows, n)
        slot = self.table.find(m[:, :-1].ravel(), m[:, 1:].ravel()).reshape(rows, n - 1)
        live = np.arange(rows)
        out = m.copy()
        cols = np.arange(n)
        while True:
            rank = self.table.rank[slot]
            at = rank.argmin(1)
            some = rank[np.arange(len(at)), at] < _NONE
            if not some.all():
                done = live[~some]
                out[done] = m[~some]
                live, m, slot, at = live[some], m[some], slot[some], at[some]
            if not len(live):
                return out, left
            r = np.arange(len(live))
            into = self.table.into[slot[r, at]]
            src = np.minimum(cols + (cols > at[:, None]), n - 1)
            m = np.take_along_axis(m, src, 1)
            m[r, at] = into
            left[live] -= 1
            if n > 2:
                src = np.minimum(cols[:-1] + (cols[:-1] >= at[:, None]), n - 2)
                slot = np.take_along_axis(slot, src, 1)
            now = left[live]
            empty = self._empty()
            # pairs before and after the merged symbol are new; pairs past the end don't exist
            has = np.flatnonzero(at > 0)
            slot[has, at[has] - 1] = self.table.find(m[has, at[has] - 1], m[has, at[has]])
            has = np.flatnonzero(at < now - 1)
            slot[has, at[has]] = self.table.find(m[has, at[has]], m[has, at[has] + 1])
            slot[np.arange(n - 1) >= (now - 1)[:, None]] = empty

    def _empty(self) -> int:
        if not hasattr(self, "_free"):
            self._free = int(np.flatnonzero(self.table.key < 0)[0])
        return self._free

    def _heap(self, s: list[int]) -> list[int]:
        n = len(s)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(p[0], i, s[i], s[i + 1]) for i in range(n - 1) if (p := self.pairs.get((s[i], s[i + 1])))]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if s[i] == a else n
            if j >= n or s[j] != b:
                continue
            s[i], s[j] = self.pairs[a, b][1], -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                if x >= 0 and after[x] < n and (p := self.pairs.get((s[x], s[after[x]]))):
                    heapq.heappush(heap, (p[0], x, s[x], s[after[x]]))
        return [x for x in s if x >= 0]

    def _pieces(self, text: str) -> list[str]:
        """A text's runs without white space; special tokens stand as themselves, marked by a blank (no run holds one)."""
        if "<|" not in text or not self.cut_special.search(text):
            return self._runs(self._normal(text))
        out: list[str] = []
        for part in self.cut_special.split(text):
            if part in self.special:
                out.append(" " + part)
            elif part:
                out += self._runs(self._normal(part))
        return out

    @staticmethod
    def _runs(text: str) -> list[str]:
        # str.split() also cuts at U+001C to U+001F, which aren't white space here
        return [r for r in _SPACE.split(text) if r] if _SEPARATORS.search(text) else text.split()

    @staticmethod
    def _normal(text: str) -> str:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            text = text.replace("Σ", "σ")  # one letter at a time: no final sigma
        return text.lower()

    def encode(self, texts: list[str | None]) -> list[bytes]:
        """Little-endian 32-bit ids of each whole text (None: empty)."""
        pieces = [self._pieces(t) if t else [] for t in texts]
        need = set().union(*pieces) if pieces else set()
        missing = [w for w in need if w not in self.cache]
        if len(self.cache) + len(missing) > CACHE_RUNS:
            self.cache = {w: self.cache[w] for w in need if w in self.cache}
        for w in [w for w in missing if w[0] == " "]:
            self.cache[w] = np.array([self.special[w[1:]]], "<u4").tobytes()
        missing = [w for w in missing if w[0] != " "]
        if missing:
            self.cache.update(zip(missing, self.encode_runs(missing)))
        get = self.cache.__getitem__
        return [b"".join(map(get, p)) for p in pieces]

    def decode(self, ids: bytes) -> str:
        """Text of little-endian 32-bit ids, special tokens kept: the tokens joined by blanks (the file has no decoder)."""
        return " ".join(map(self.token.__getitem__, np.frombuffer(ids, "<u4").tolist()))


_loaded: dict[str, ForcedBoundaryBpe] = {}


def _tokenizer(definition: str) -> ForcedBoundaryBpe:
    """One per Python worker, with its cache."""
    key = hashlib.sha1(definition.encode()).hexdigest()
    if key not in _loaded:
        _loaded.clear()
        _loaded[key] = ForcedBoundaryBpe(definition)
    return _loaded[key]


def _definition(df: DataFrame, path: str):
    with open(path, encoding="utf-8") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def _encoded(texts: pa.Array, tok: ForcedBoundaryBpe) -> Iterator[tuple[int, int, list[bytes]]]:
    """(first row, rows, ids) by blocks of bounded text."""
    offsets, _ = text_buffers(texts)
    for lo, hi in row_blocks(offsets, BLOCK_BYTES):
        yield lo, hi - lo, tok.encode(texts.slice(lo, hi - lo).to_pylist())


def encode(df: DataFrame, path: str, text_col: str = "text", out: str = "ids") -> DataFrame:
    """``df`` with ``out``: the token ids (array<long>) of each whole text.

    ``path``: the tokenizer's file, read on the driver and sent to the workers
    (a fixed file of a few MB).  NULL and empty texts give no ids.
    The column ``out`` must not exist yet; all others stay as they are.
    """
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    sent = _definition(df, path)

    @F.arrow_udf("array<long>")
    def run(texts: pa.Array) -> pa.Array:
        tok = _tokenizer(sent.value)
        ids = [np.frombuffer(b, "<u4") for _, _, part in _encoded(texts, tok) for b in part]
        ends = np.cumsum([0] + [len(x) for x in ids], dtype=np.int32)
        return pa.ListArray.from_arrays(pa.array(ends), pa.array(np.concatenate(ids).astype(np.int64) if ids else [], pa.int64()))

    return df.withColumn(out, run(F.col(text_col)))


def decode(df: DataFrame, path: str, ids_col: str = "ids", out: str = "decoded") -> DataFrame:
    """``df`` with ``out``: the text of each row's ids, special tokens kept.  NULL ids stay NULL, none give ''."""
    if out in df.columns:
        raise ValueError(f"column {out} exists")
    sent = _definition(df, path)

    @F.arrow_udf("string")
    def run(ids: pa.Array) -> pa.Array:
        tok = _tokenizer(sent.value)
        return pa.array([None if x is None else tok.decode(np.asarray(x, "<u4").tobytes()) for x in ids.to_pylist()],
                        pa.string())

    return df.withColumn(out, run(F.col(ids_col)))


def digests(docs: DataFrame, path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256``: every whole text encoded, its ids decoded again.

    One row per row of ``docs``, whatever its id (NULL and repeated ids too).
    """
    sent = _definition(docs, path)

    def run(batches):
        tok = _tokenizer(sent.value)
        for batch in batches:
            for lo, n, ids in _encoded(batch.column(1), tok):
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(lo, n),
                    pa.array([len(b) // 4 for b in ids], pa.int64()),
                    pa.array([hashlib.sha256(b).hexdigest() for b in ids], pa.string()),
                    pa.array([hashlib.sha256(tok.decode(b).encode()).hexdigest() for b in ids], pa.string())],
                    ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    src = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

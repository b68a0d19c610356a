"""Near-duplicate documents: MinHash signatures, banding, verification, connected components.

1. One pass over the whole texts makes, per document, the set of its word
   shingles (as 64-bit hashes), and keeps its size, its digest and ``HASHES`` universal hash minima.
2. Documents with equal sets become one class, represented by its smallest id.
3. ``BANDS`` bands of ``ROWS`` minima are the candidate keys.  A pair at
   similarity 0.8 shares no band with a chance of (1 - 0.8^4)^32 < 1e-7.
4. Within a key each member's partner is the key's smallest member (a star, never all
   pairs); each document is confirmed on full sets against the one partner
   it shares most keys with.  Sets are made again, from the texts of documents that have a candidate only.
5. Keys whose members then lie in several components are compared member
   by member across components: in blocks of bounded size spread over tasks, screened by
   signature, each pair only under the first key it shares, and confirmed on
   full sets within the block, which gives back a spanning forest of its
   links.  So no link between different texts is lost to the star, and no pairs are listed.
6. Components by alternating large-star and small-star.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import marked, marks_of, written
from marquee.llm.components import connected_components
from marquee.llm.hashing import NOT_SPACE, combine, kgrams, mix, word_blocks

BANDS, ROWS = 32, 4
HASHES = BANDS * ROWS
BLOCK = 256  # members of a key that are compared in one block
HUB = 1 << 30  # numbers of the blocks of a key's largest component start here

_rng = np.random.default_rng(7)
_A = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _rng.integers(0, 2**63, HASHES, dtype=np.uint64) * np.uint64(2)
_LOW = np.uint64(0xFFFFFFFF)


def _sets(block, k: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each row; fewer than k words: all of them as one shingle."""
    grams, at = kgrams(block, k)
    cuts = np.searchsorted(at, block.offsets)
    out = []
    for i in range(block.n_rows):
        g = grams[cuts[i]:cuts[i + 1]]
        words = block.hash[block.offsets[i]:block.offsets[i + 1]]
        if len(g) == 0 and len(words):
            g = combine([words[j:j + 1] for j in range(len(words))])
        out.append(np.unique(g))
    return out


def minima(sets: list[np.ndarray]) -> np.ndarray:
    """``(rows, HASHES)`` minima of the universal hashes a·x + b (16 bits of each); empty sets give all ones."""
    out = np.full((len(sets), HASHES), _LOW, np.uint64)
    full = [i for i, s in enumerate(sets) if len(s)]
    if not full:
        return out.astype(np.uint16)
    x = np.concatenate([sets[i] for i in full]) >> np.uint64(24)  # the minima only screen
    x = (x ^ (x >> np.uint64(20))) & _LOW | (x << np.uint64(32))
    starts = np.cumsum([0] + [len(sets[i]) for i in full[:-1]])
    got = np.empty((HASHES, len(full)), np.uint64)
    buf = np.empty_like(x)
    for j in range(HASHES):
        np.multiply(x, _A[j], out=buf)
        buf += _B[j]
        np.minimum.reduceat(buf, starts, out=got[j])
    out[full] = mix(got).T  # a minimum is small: its bits are spread before some are kept
    return out.astype(np.uint16)


def _pack(s: np.ndarray) -> bytes:
    return s.astype("<u8").tobytes()


def _unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, "<u8")


def _digest(packed: bytes) -> bytes:
    return hashlib.blake2b(packed, digest_size=16).digest()


def sketches(docs: DataFrame, k: int, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, digest, sig`` of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(0)
            for block in word_blocks(batch.column(1), NOT_SPACE):
                sets = _sets(block, k)
                sig = minima(sets)
                yield pa.RecordBatch.from_arrays([
                    ids.slice(block.first_row, block.n_rows),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([_digest(_pack(s)) for s in sets], pa.binary()),
                    pa.array([r.tobytes() for r in sig], pa.binary())], ["doc_id", "n_shingles", "digest", "sig"])

    return _texts(docs, id_col, text_col).mapInArrow(run, "doc_id long, n_shingles long, digest binary, sig binary")


def _texts(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))


def band_keys(reps: DataFrame) -> DataFrame:
    """``(key, band, node)``: one row per band of each representative."""

    def run(batches):
        for batch in batches:
            n = batch.num_rows
            if not n:
                continue
            sig = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint16).reshape(n, BANDS, ROWS)
            band = np.tile(np.arange(BANDS), n)
            keys = combine([sig[:, :, r].astype(np.uint64).ravel() for r in range(ROWS)] + [band.astype(np.uint64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array(keys.view(np.int64)), pa.array(band.astype(np.int32)),
                 pa.array(np.repeat(batch.column(0).to_numpy(), BANDS))], ["key", "band", "node"])

    return reps.select("node", "sig").mapInArrow(run, "key long, band int, node long")


def screen_floor(similarity: float) -> float:
    """Lowest share of equal minima that a pair at ``similarity`` shows: five standard errors below it."""
    return similarity - 5 * (similarity * (1 - similarity) / HASHES) ** 0.5


def alike(x: bytes, y: bytes, percent: int) -> bool:
    """100·|A∩B| >= percent·|A∪B| of two stored sets."""
    p, q = _unpack(x), _unpack(y)
    if 100 * min(len(p), len(q)) < percent * max(len(p), len(q)):
        return False
    both = len(np.intersect1d(p, q, assume_unique=True))
    return 100 * both >= percent * (len(p) + len(q) - both)


def _sets_of(nodes: DataFrame, texts: DataFrame, k: int) -> DataFrame:
    """``node, shingles`` of the nodes, made again from the texts that the nodes' marks let through.

    One shuffle of those sets, by the same merge join at every size (the nodes grow with the corpus, so they aren't broadcast).
    """

    def run(batches):
        for batch in batches:
            ids = batch.column(0)
            for block in word_blocks(batch.column(1), NOT_SPACE):
                packed = [_pack(s) for s in _sets(block, k)]
                yield pa.RecordBatch.from_arrays(
                    [ids.slice(block.first_row, block.n_rows), pa.array([_digest(p) for p in packed], pa.binary()),
                     pa.array(packed, pa.binary())], ["node", "digest", "shingles"])

    nodes = nodes.select("node").distinct()
    near, _ = marked(texts, "doc_id", written(marks_of(nodes), "marks"))
    sets = near.mapInArrow(run, "node long, digest binary, shingles binary").where(F.octet_length("shingles") > 0)
    return sets.join(nodes.hint("merge"), "node").dropDuplicates(["node", "digest"]).select("node", "shingles")


def _confirmed(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``(a, b)`` that hold on the full sets, as ``(u, v)``."""

    def run(batches):
        for batch in batches:
            keep = [i for i, (x, y) in enumerate(zip(batch.column(2), batch.column(3), strict=True))
                    if alike(x.as_py(), y.as_py(), percent)]
            take = pa.array(keep, pa.int64())
            yield pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take)], ["u", "v"])

    joined = (pairs.join(sets.select(F.col("node").alias("a"), F.col("shingles").alias("sa")), "a")
              .join(sets.select(F.col("node").alias("b"), F.col("shingles").alias("sb")), "b")
              .select("a", "b", "sa", "sb"))
    return written(joined.mapInArrow(run, "u long, v long"), "minhash-links")


_GROUP = ("key", "i", "j")


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Whole (key, i, j) groups of a stream sorted by them, many small ones at a time."""
    held: pa.Table | None = None
    for batch in batches:
        t = pa.Table.from_batches([batch])
        held = t if held is None else pa.concat_tables([held, t])
        n = held.num_rows
        if n == 0:
            held = None
            continue
        same = np.ones(n, bool)
        for c in _GROUP:
            v = held.column(c).to_numpy()
            same &= v == v[-1]
        if not same.all():
            done = n - int(same[::-1].argmin())
            yield held.slice(0, done)
            held = held.slice(done)
    if held is not None and held.num_rows:
        yield held


def _screened(t: pa.Table, floor: float, step: int = 1 << 15) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(row, row, share of equal minima) of the pairs of each group that lie in different components, share no
    earlier band and look alike enough."""
    key, i, j, comp, block, band = (t.column(c).to_numpy() for c in (*_GROUP, "component", "block", "band"))
    sig = np.frombuffer(b"".join(t.column("sig").to_pylist()), np.uint16).reshape(len(key), BANDS, ROWS)  # as the keys
    new = np.flatnonzero(np.r_[True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])])
    end = np.repeat(np.r_[new[1:], len(key)], np.diff(np.r_[new, len(key)]))
    left = end - np.arange(len(key)) - 1  # partners after each member
    ends = np.cumsum(left)
    lo = 0
    while lo < len(key):
        before = ends[lo - 1] if lo else 0
        hi = max(lo + 1, int(np.searchsorted(ends, before + step, "right")))
        a = np.repeat(np.arange(lo, hi), left[lo:hi])
        b = a + 1 + np.arange(len(a)) - np.repeat(ends[lo:hi] - left[lo:hi] - before, left[lo:hi])
        ok = (comp[a] != comp[b]) & ((i[a] == j[a]) | (block[a] != block[b]))
        a, b = a[ok], b[ok]
        same = sig[a] == sig[b]
        est = same.mean((1, 2))
        ok = (est >= floor) & (same.all(2).argmax(1) >= band[a])
        yield a[ok], b[ok], est[ok]
        lo = hi


def _across(keys: DataFrame, labels: DataFrame, reps: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links ``(u, v)`` between the components that meet under a key (those that connect them, not all)."""
    floor = screen_floor(percent / 100)
    by = Window.partitionBy("key")
    members = keys.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    mixed = (members.withColumn("_lo", F.min("component").over(by)).withColumn("_hi", F.max("component").over(by))
             .where("_lo <> _hi").drop("_lo", "_hi"))
    mixed = written(mixed, "minhash-mixed")
    sizes = mixed.groupBy("key", "component").agg(F.count("*").alias("n"))
    hubs = sizes.groupBy("key").agg(F.max_by("component", F.struct("n", "component")).alias("_hub"),
                                    F.max("n").alias("_big"), F.sum("n").alias("_all"))
    hubs = hubs.select("key", "_hub", F.ceil(F.col("_big") / BLOCK).cast("int").alias("_hubs"),
                       F.ceil((F.col("_all") - F.col("_big")) / BLOCK).cast("int").alias("_rest"))
    in_hub = F.col("component") == F.col("_hub")
    rest = F.sequence(F.lit(0), F.col("_rest") - 1)
    other = F.when(in_hub, rest).otherwise(
        F.concat(rest, F.transform(F.sequence(F.lit(0), F.col("_hubs") - 1), lambda x: x + HUB)))
    spread = (
        mixed.join(hubs, "key").join(reps.select("node", "sig"), "node")
        .withColumn("block", F.when(in_hub, F.pmod(F.xxhash64("node"), F.col("_hubs")) + HUB)
                    .otherwise(F.pmod(F.xxhash64("node"), F.col("_rest"))).cast("int"))
        .withColumn("_other", F.explode(other))
        .select("key", F.least("block", "_other").alias("i"), F.greatest("block", "_other").alias("j"),
                "band", "node", "component", "block", "sig"))

    def screen(batches):
        """The members that have a pair to confirm."""
        for t in _groups(batches):
            rows = [np.concatenate([a, b]) for a, b, _ in _screened(t, floor)]
            keep = np.unique(np.concatenate(rows)) if rows else np.zeros(0, np.int64)
            yield from t.take(pa.array(keep, pa.int64())).combine_chunks().to_batches()

    def confirm(batches):
        for t in _groups(batches):
            node, sets = t.column("node").to_numpy(), t.column("shingles")
            comp = t.column("component").to_numpy()
            above: dict[int, int] = {}

            def find(x):
                while above.get(x, x) != x:
                    above[x] = above.get(above[x], above[x])
                    x = above[x]
                return x

            links = []
            for a, b, est in _screened(t, floor):
                for k in np.argsort(-est, kind="stable"):
                    p, q = find(comp[a[k]]), find(comp[b[k]])
                    if p != q and alike(sets[int(a[k])].as_py(), sets[int(b[k])].as_py(), percent):
                        above[max(p, q)] = min(p, q)
                        links.append((node[a[k]], node[b[k]]))
            yield pa.RecordBatch.from_arrays(
                [pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["u", "v"])

    shape = "key long, i int, j int, band int, node long, component long, block int, sig binary"
    some = written(spread.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(screen, shape), "minhash-open")
    whole = some.join(sets.select("node", "shingles"), "node").select(*some.columns, "shingles")
    return written(whole.repartition(*_GROUP).sortWithinPartitions(*_GROUP).mapInArrow(confirm, "u long, v long"),
                   "minhash-links")


def near_duplicates(docs: DataFrame, shingle_words: int = 5, percent: int = 80,
                    id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, n_shingles, component_id, kept`` per row of ``docs``.

    Words: runs without ASCII white space, A-Z lower-cased.  A document's set is
    its distinct ``shingle_words``-word shingles (fewer words: all of them as
    one); documents with ``100·|A∩B| >= percent·|A∪B|`` are linked.
    ``component_id`` is the smallest id reachable, ``kept`` marks that row.

    NULL and empty texts (or only white space): an empty set, linked with
    nothing.  Rows that share an id are one document to the links: they meet
    in one component, each with its own set size.  A NULL id links with nothing:
    its ``component_id`` is NULL, ``kept`` true.  Further columns are ignored.
    An empty table gives an empty result.
    """
    sk = written(sketches(docs, shingle_words, id_col, text_col), "minhash-sketches")
    full = sk.where("n_shingles > 0 AND doc_id IS NOT NULL")
    classes = written(full.groupBy("digest").agg(F.min("doc_id").alias("node")), "minhash-classes")
    reps = full.select("digest", "doc_id", "sig").join(
        classes.select("digest", F.col("node").alias("doc_id")), ["digest", "doc_id"]).select(
        F.col("doc_id").alias("node"), "sig").dropDuplicates(["node", "sig"])
    reps = written(reps, "minhash-reps")
    keys = written(band_keys(reps), "minhash-keys")
    star = keys.withColumn("a", F.min("node").over(Window.partitionBy("key"))).where("node <> a")
    star = written(star.groupBy("a", F.col("node").alias("b")).agg(F.count("*").alias("n")), "minhash-star")
    best = star.groupBy("b").agg(F.max_by("a", F.struct("n", -F.col("a"))).alias("a")).select("a", "b")
    # every member of a key with several, so the sets are shuffled once for both comparisons
    wanted = star.select(F.explode(F.array("a", "b")).alias("node"))
    sets = written(_sets_of(wanted, _texts(docs, id_col, text_col), shingle_words), "minhash-sets")
    links = _confirmed(best, sets, percent)
    labels = written(connected_components(links), "minhash-labels")
    more = _across(keys, labels, reps, sets, percent)
    links = links.union(more)
    if not more.isEmpty():
        labels = written(connected_components(links), "minhash-labels")

    # An id may have several sets: what its classes are linked with belongs to it too.
    repeated = full.groupBy("doc_id").agg(F.min("digest").alias("_a"), F.max("digest").alias("_b")).where("_a <> _b")
    if not repeated.isEmpty():
        own = full.join(repeated.select("doc_id"), "doc_id", "left_semi").select("doc_id", "digest").distinct()
        links = links.union(own.join(classes, "digest").select("doc_id", "node"))
        labels = written(connected_components(links), "minhash-labels")
    named = classes.join(labels, "node", "left").select(
        "digest", F.coalesce("component", "node").alias("_component"))
    if not repeated.isEmpty():
        ids = labels.select(F.col("node").alias("doc_id"), F.col("component").alias("_own"))
    else:
        ids = None
    out = (sk.select("doc_id", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("digest")).alias("digest"))
           .join(named, "digest", "left"))
    if ids is not None:
        out = out.join(ids, "doc_id", "left").withColumn("_component", F.coalesce("_own", "_component"))
    component = F.when(F.col("doc_id").isNull(), F.lit(None)).otherwise(F.coalesce("_component", "doc_id"))
    return out.select("doc_id", "n_shingles", component.cast("long").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))

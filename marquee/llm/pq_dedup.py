"""Near-duplicate vectors by product quantisation.

1. Equal vectors of one label become one class with its size.
2. On a sample of at most ``SAMPLE`` classes (those with the smallest hashes) k-means gives the coarse cells and, on the
   residuals, ``SUBSPACES`` codebooks of up to 256 words.  All vectors are indexed:
   cell, codes of the residual and the length of what the codes leave out.
3. A query probes every cell that can hold a vector within the radius of the
   threshold: if y lies in cell c and |x - y| <= r then
   |x - c|² - |x - c'|² <= 2 r |c - c'| for every other centre c'.
4. In a probed list the asymmetric distance to the codes is read from tables;
   a code whose distance exceeds r plus its own remainder can't be a link.
5. What is left is ranked by its exact cosine in double precision.

Both bounds are exact, so the recall is 1 whatever the sample.  Lists and their queries are
split into blocks; a block gives link counts and a spanning forest of its
links, never the pairs.  Vectors of a length other than the commonest are
compared without codes, in the same blocks.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written
from marquee.llm.components import connected_components

SAMPLE = 20_000
MAX_CELLS = 1024
SUBSPACES = 8
ROUNDS = 12
BLOCK = 2048
NEAREST = 12  # centres whose bounds are tried against each cell


def _kmeans(x: np.ndarray, k: int, seed: int) -> np.ndarray:
    rng = np.random.default_rng(seed)
    centres = x[rng.choice(len(x), k, replace=False)].copy()
    for _ in range(ROUNDS):
        near = _distances(x, centres).argmin(1)
        n = np.bincount(near, minlength=k)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, x)
        full = n > 0
        centres[full] = sums[full] / n[full, None]
    return centres


def _distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Squared distances."""
    return np.maximum((x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1), 0)


class Index:
    """Coarse centres and codebooks of unit vectors of one length."""

    def __init__(self, sample: np.ndarray, cells: int, seed: int = 5):
        self.dim = sample.shape[1]
        self.width = -(-self.dim // SUBSPACES)
        self.centres = _kmeans(sample, max(1, min(cells, len(sample))), seed)
        rest = self._cut(sample - self.centres[_distances(sample, self.centres).argmin(1)])
        self.books = [_kmeans(rest[:, m], min(256, len(sample)), seed + m) for m in range(SUBSPACES)]
        self.gaps = np.sqrt(_distances(self.centres, self.centres))

    def _cut(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), SUBSPACES * self.width))
        out[:, :self.dim] = x
        return out.reshape(len(x), SUBSPACES, self.width)

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(cell, codes, distance between each vector and what its codes say)."""
        cell = _distances(x, self.centres).argmin(1)
        rest = self._cut(x - self.centres[cell])
        codes = np.stack([_distances(rest[:, m], self.books[m]).argmin(1) for m in range(SUBSPACES)], 1)
        left = rest - np.stack([self.books[m][codes[:, m]] for m in range(SUBSPACES)], 1)
        return cell, codes.astype(np.uint8), np.sqrt((left * left).sum((1, 2)))

    def probes(self, x: np.ndarray, radius: float) -> tuple[np.ndarray, np.ndarray]:
        """(row, cell) of every cell that can hold a vector within the radius of a row."""
        d = _distances(x, self.centres)
        near = np.argsort(d, 1)[:, :NEAREST]
        ok = np.ones(d.shape, bool)
        for j in range(near.shape[1]):
            c = near[:, j]
            ok &= d <= d[np.arange(len(x)), c][:, None] + 2 * radius * self.gaps[c] + 1e-9
        return np.nonzero(ok)

    def tables(self, x: np.ndarray, cell: int) -> list[np.ndarray]:
        """Per subspace: squared distance of each row's residual to every code word."""
        rest = self._cut(x - self.centres[cell])
        return [_distances(rest[:, m], self.books[m]) for m in range(SUBSPACES)]


def _unit(col: pa.Array) -> tuple[list[int], list[np.ndarray]]:
    """Rows with a usable vector, and those vectors at length 1 (double precision)."""
    rows, out = [], []
    for i, v in enumerate(col.to_pylist()):
        if v and None not in v:
            x = np.array(v, np.float64)
            top = np.abs(x).max()
            if np.isfinite(top) and top > 0:
                x = x / top  # neither overflow nor underflow in the norm
                rows.append(i)
                out.append(x / np.sqrt(x @ x))
    return rows, out


def _forest(links: np.ndarray, rows: np.ndarray, cols: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges that connect what a block's links connect: every node to the smallest it reaches."""
    a, b = rows.copy(), cols.copy()
    big = np.iinfo(np.int64).max
    while True:
        nb = np.minimum(b, np.where(links, a[:, None], big).min(0))
        na = np.minimum(a, np.where(links, nb[None, :], big).min(1))
        if (na == a).all() and (nb == b).all():
            break
        a, b = na, nb
    u, v = np.r_[rows, cols], np.r_[a, b]
    keep = u != v
    return u[keep], v[keep]


def near_duplicates(df: DataFrame, threshold: float = 0.98, id_col: str = "vec_id", vector_col: str = "embedding",
                    label_col: str = "label") -> DataFrame:
    """Per row: ``vec_id, n_links, component_id, kept``.

    Vectors of one label with a cosine of at least ``threshold`` are linked.  NULL or
    empty vectors, zero vectors, vectors with NULL or non-finite parts, and rows
    with a NULL label link with nothing (``component_id``: their own id).  A NULL id links with
    nothing: its ``component_id`` is NULL, ``kept`` true.  Repeated rows each
    count as a vector; rows that share an id are one node of the components.  Other columns are ignored;
    an empty table gives an empty result.
    """
    spark = df.sparkSession
    radius = float(np.sqrt(2 - 2 * threshold))
    src = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(label_col).cast("string").alias("label"),
                    F.col(vector_col).cast("array<double>").alias("v"))
    usable = src.where("vec_id IS NOT NULL AND label IS NOT NULL AND size(v) > 0")
    classes = written(usable.groupBy("label", "v").agg(F.min("vec_id").alias("node"), F.count("*").alias("size")), "pq-classes")
    total = classes.agg(F.count("*").alias("n"), F.countDistinct("label").alias("k")).first()
    sample = classes.select("v", F.xxhash64("label", "node").alias("h")).orderBy("h").limit(SAMPLE).toArrow()
    found = _unit(sample.column("v").combine_chunks())[1] if sample.num_rows else []
    dim = Counter(map(len, found)).most_common(1)[0][0] if found else 0
    cells = min(MAX_CELLS, max(1, round(total["n"] ** 0.5 / 2)))
    index = Index(np.stack([x for x in found if len(x) == dim]), cells) if found else None
    sent = spark.sparkContext.broadcast(index)

    def place(batches):
        """A list row for each vector and a query row for each of its probes."""
        index = sent.value
        for batch in batches:
            rows, xs = _unit(batch.column(1))
            if not rows:
                continue
            rows, dims = np.array(rows), np.array([len(x) for x in xs])
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                x = np.stack([xs[i] for i in own])
                if d == index.dim:
                    cell, codes, left = index.encode(x)
                    q, qc = index.probes(x, radius)
                else:
                    cell = np.zeros(len(x), np.int64)
                    codes, left, q, qc = np.zeros((len(x), SUBSPACES), np.uint8), np.full(len(x), np.inf), np.arange(len(x)), cell
                at = np.r_[np.arange(len(x)), q]
                n = len(at)
                take = pa.array(rows[own][at])
                is_list = np.arange(n) < len(x)
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).take(take), pa.array(np.full(n, d)), pa.array(np.r_[cell, qc]), pa.array(is_list),
                    batch.column(2).take(take), batch.column(3).take(take),
                    pa.array([x[i].tobytes() for i in at], pa.binary()),
                    pa.array([codes[i].tobytes() for i in at], pa.binary()), pa.array(left[at])],
                    ["label", "dim", "cell", "is_list", "node", "size", "x", "code", "rest"])

    placed = written(classes.select("label", "v", "node", "size").mapInArrow(
        place, "label string, dim long, cell long, is_list boolean, node long, size long, x binary, code binary, rest double"),
        "pq-lists")
    key = ["label", "dim", "cell"]
    blocks = placed.groupBy(*key).agg(
        F.ceil(F.sum(F.col("is_list").cast("int")) / BLOCK).cast("int").alias("_lists"),
        F.ceil(F.sum((~F.col("is_list")).cast("int")) / BLOCK).cast("int").alias("_queries")).where("_lists > 0 AND _queries > 0")
    h = F.xxhash64("node")
    grid = (placed.join(blocks, key)
            .withColumn("l", F.explode(F.when(F.col("is_list"), F.array(F.pmod(h, F.col("_lists")).cast("int")))
                                       .otherwise(F.sequence(F.lit(0), F.col("_lists") - 1))))
            .withColumn("q", F.explode(F.when(F.col("is_list"), F.sequence(F.lit(0), F.col("_queries") - 1))
                                       .otherwise(F.array(F.pmod(h, F.col("_queries")).cast("int")))))
            .drop("_lists", "_queries"))

    def compare(t: pa.Table) -> pa.Table:
        index = sent.value
        is_list = t.column("is_list").to_numpy()
        node, size = t.column("node").to_numpy(), t.column("size").to_numpy()
        dim, cell = t.column("dim")[0].as_py(), t.column("cell")[0].as_py()
        x = np.frombuffer(b"".join(t.column("x").to_pylist()), np.float64).reshape(len(node), dim)
        lists, queries = np.flatnonzero(is_list), np.flatnonzero(~is_list)
        out = []
        if len(lists) and len(queries):
            y, qx = x[lists], x[queries]
            if dim == index.dim:
                code = np.frombuffer(b"".join(t.column("code").take(pa.array(lists)).to_pylist()), np.uint8).reshape(-1, SUBSPACES)
                far = np.zeros((len(queries), len(lists)))
                for m, table in enumerate(index.tables(qx, cell)):
                    far += table[:, code[:, m]]
                maybe = np.sqrt(far) <= radius + t.column("rest").to_numpy()[lists] + 1e-9
            else:
                maybe = np.ones((len(queries), len(lists)), bool)
            links = np.zeros(maybe.shape, bool)
            a, b = np.nonzero(maybe)
            for lo in range(0, len(a), 1 << 16):
                i, j = a[lo:lo + (1 << 16)], b[lo:lo + (1 << 16)]
                links[i, j] = np.einsum("ij,ij->i", qx[i], y[j]) >= threshold
            links[node[queries][:, None] == node[lists][None, :]] = False
            u, v = _forest(links, node[queries], node[lists])
            n = links @ size[lists]
            some = np.flatnonzero(n)
            out = [(node[queries][some], node[queries][some], n[some]), (u, v, np.zeros(len(u), np.int64))]
        cols = [np.concatenate(c) for c in zip(*out, strict=True)] if out else [np.zeros(0, np.int64)] * 3
        return pa.table({"u": pa.array(cols[0], pa.int64()), "v": pa.array(cols[1], pa.int64()), "n": pa.array(cols[2], pa.int64())})

    links = written(grid.groupBy(*key, "l", "q").applyInArrow(compare, "u long, v long, n long"), "pq-links")
    counts = links.where("u = v").groupBy(F.col("u").alias("node")).agg(F.sum("n").alias("_n"))
    good = F.col("_good")
    sizes = classes.select("label", "v", "node", "size", _usable(F.col("v")).alias("_good"))
    same_id = sizes.where(good)
    labels = connected_components(links.where("u <> v").select("u", "v"))
    per_class = (same_id.join(counts, "node", "left").join(labels.select("node", "component"), "node", "left")
                 .select("label", "v", (F.col("size") - 1 + F.coalesce("_n", F.lit(0))).alias("n_links"),
                         F.coalesce("component", "node").alias("component_id")))
    joined = src.alias("s").join(per_class.alias("c"), ["label", "v"], "left").where(F.lit(True))
    none = F.col("vec_id").isNull()
    return joined.select(
        "vec_id", F.when(none, 0).otherwise(F.coalesce("n_links", F.lit(0))).cast("long").alias("n_links"),
        F.when(~none, F.coalesce("component_id", "vec_id")).cast("long").alias("component_id")).withColumn(
        "kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))


def _usable(v):
    """A vector that can be linked: parts all finite, not all zero."""
    finite = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False)))
    return finite & F.exists(v, lambda x: F.coalesce(x != 0.0, F.lit(False)))

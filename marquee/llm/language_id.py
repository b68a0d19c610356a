"""Language identification by Bayesian evidence fusion.

    posterior(l) ~ P(text | l)^TEXT_WEIGHT · P(declared | l) · P(l | host)

* Text: hashed byte trigrams of the letters, one smoothed multinomial per
  language, fitted on at most ``SAMPLE_PER_LANGUAGE`` labelled rows of each
  language (the rows with the smallest id hashes).  A class ``und`` with even
  probabilities stands for text in none of them.
* Declared markup language: how often rows whose text reads as l declare each
  value, by one grouped aggregation, smoothed.
* Host prior: text readings counted per host, shrunk towards the address
  suffix's, and those towards all rows' (``PRIOR_STRENGTH`` pseudo-rows each).

Texts are scored whole.  Host and suffix tables are joined, never gathered.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import written
from marquee.llm.hashing import row_blocks, text_buffers

SAMPLE_PER_LANGUAGE = 1000
MAX_LANGUAGES = 200
BUCKETS = 1 << 15
SMOOTHING = 0.5
TEXT_WEIGHT = 0.25
PRIOR_STRENGTH = 20.0
MIN_POSTERIOR = 0.5
UNKNOWN = "und"

_byte = np.arange(256)
_letter = ((_byte >= 65) & (_byte <= 90)) | ((_byte >= 97) & (_byte <= 122)) | (_byte >= 128)
_FOLD = np.where(_letter, np.where(_byte < 128, _byte | 32, _byte), 32).astype(np.uint32)


def _trigrams(buf: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(bucket of each trigram, row bounds into them, letters per row) of one block of rows."""
    b = _FOLD[buf]
    n = len(b)
    letters = np.r_[0, np.cumsum(b != 32)]
    if n < 3:
        return np.zeros(0, np.int64), np.zeros(len(at), np.int64), np.diff(letters[at])
    code = (b[:-2] << np.uint32(16)) | (b[1:-1] << np.uint32(8)) | b[2:]
    own = np.ones(n - 2, bool)  # within one row, and not blanks only
    for edge in at[1:-1]:
        own[max(0, edge - 2):edge] = False
    own &= code != 0x202020
    where = np.flatnonzero(own)
    bucket = ((code[where] * np.uint32(2654435761)) >> np.uint32(17)).astype(np.int64)
    return bucket, np.searchsorted(where, at), np.diff(letters[at])


@dataclass
class TextModel:
    """Log-probabilities ``(languages and und, BUCKETS)``."""

    languages: list[str]
    table: np.ndarray

    @classmethod
    def fit(cls, labelled: DataFrame, text_col: str = "text", lang_col: str = "lang",
            id_col: str = "doc_id") -> "TextModel":
        """From rows whose language is known; rows with a NULL text or language are passed over."""
        rows = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()).select(
            F.col(lang_col).alias("lang"), F.col(text_col).alias("text"), F.xxhash64(id_col).alias("h"))
        # the N smallest hashes of each language, from two columns; then only those rows' texts
        bound = rows.groupBy("lang").agg(F.count("*").alias("n")).limit(MAX_LANGUAGES + 1).collect()
        if len(bound) > MAX_LANGUAGES:
            raise ValueError(f"more than {MAX_LANGUAGES} languages are declared")
        share = {r["lang"]: min(1.0, SAMPLE_PER_LANGUAGE / r["n"]) for r in bound}
        langs = sorted(share)
        if not langs:
            return cls([UNKNOWN], np.full((1, BUCKETS), -np.log(BUCKETS), np.float32))
        limit = F.lit(None).cast("long")
        for lang, part in share.items():
            limit = F.when(F.col("lang") == lang, F.lit(int(-2**63 + part * (2**64 - 1)) if part < 1 else 2**63 - 1)
                           ).otherwise(limit)
        sample = rows.where(F.col("h") <= limit).select("lang", "text")

        def count(batches):
            sums: dict[str, np.ndarray] = {}
            for batch in batches:
                offsets, data = text_buffers(batch.column(1))
                names = np.array(batch.column(0).to_pylist(), object)
                for lo, hi in row_blocks(offsets):
                    bucket, cut, _ = _trigrams(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
                    for i in range(hi - lo):
                        s = sums.setdefault(names[lo + i], np.zeros(BUCKETS, np.int64))
                        s += np.bincount(bucket[cut[i]:cut[i + 1]], minlength=BUCKETS)
            for name, s in sums.items():
                at = np.flatnonzero(s)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * len(at), pa.string()), pa.array(at), pa.array(s[at])], ["lang", "bucket", "n"])

        counts = sample.mapInArrow(count, "lang string, bucket long, n long").groupBy("lang", "bucket").agg(
            F.sum("n").alias("n")).toArrow()  # at most MAX_LANGUAGES * BUCKETS rows
        t = np.full((len(langs), BUCKETS), SMOOTHING)
        row = np.searchsorted(langs, counts.column("lang").to_pylist()) if counts.num_rows else np.zeros(0, int)
        t[row, counts.column("bucket").to_numpy()] += counts.column("n").to_numpy()
        t = np.log(t / t.sum(1, keepdims=True))
        return cls(langs + [UNKNOWN], np.vstack([t, np.full((1, BUCKETS), -np.log(BUCKETS))]).astype(np.float32))

    def score(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(log-likelihood per row and language, letters per row) of whole texts."""
        offsets, data = text_buffers(texts)
        out = np.zeros((len(offsets) - 1, len(self.languages)))
        letters = np.zeros(len(offsets) - 1, np.int64)
        for lo, hi in row_blocks(offsets):
            bucket, cut, n = _trigrams(data[offsets[lo]:offsets[hi]], offsets[lo:hi + 1] - offsets[lo])
            letters[lo:hi] = n
            if len(bucket):
                for k in range(len(self.languages)):
                    sums = np.r_[0.0, np.cumsum(self.table[k][bucket], dtype=np.float64)]
                    out[lo:hi, k] = sums[cut[1:]] - sums[cut[:-1]]
        return out, letters


def identify(df: DataFrame, model: TextModel, keep: list[str], text: str = "text", declared: str | None = "lang",
             host: str | None = "source", suffix: str | None = None) -> DataFrame:
    """``keep`` columns, ``language, posterior, n_letters, accepted`` per row of ``df``.

    ``text``, ``declared``, ``host`` and ``suffix`` name string columns of ``df``
    (None: no such evidence; suffix None: one level less).  NULL evidence counts
    as none.  A NULL or empty text, or one without letters, gives ``und``; equal
    posteriors go to the first language in order.  ``accepted``: a
    language other than ``und`` with a posterior of at least MIN_POSTERIOR.
    Repeated rows each give a row.  An empty table gives an empty result.
    """
    langs = model.languages
    sent = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf("ll array<double>, n_letters long")
    def score(texts: pa.Array) -> pa.Array:
        ll, n = sent.value.score(texts)
        lists = pa.ListArray.from_arrays(pa.array(np.arange(len(ll) + 1, dtype=np.int32) * ll.shape[1]), pa.array(ll.ravel()))
        return pa.StructArray.from_arrays([lists, pa.array(n)], ["ll", "n_letters"])

    def column(name):
        return F.lit(None).cast("string") if name is None else F.col(name).cast("string")

    best = F.array_position("ll", F.array_max("ll")).cast("int") - 1
    rows = written(
        df.select(F.struct(*keep).alias("_keep"), column(declared).alias("declared"), column(host).alias("host"),
                  column(suffix).alias("suffix"), score(F.col(text)).alias("_s"))
        .select("_keep", "declared", "host", "suffix", F.col("_s.ll").alias("ll"), F.col("_s.n_letters").alias("n_letters"))
        .withColumn("best", best), "language-evidence")

    read = rows.where("n_letters > 0")
    counts = [F.sum(F.when(F.col("best") == i, 1).otherwise(0)).cast("double").alias(f"n{i}") for i in range(len(langs))]
    n = F.array(*[f"n{i}" for i in range(len(langs))])
    total = read.agg(*counts).first()
    world = [(total[i] or 0.0) + 1.0 for i in range(len(langs))]
    world = [x / sum(world) for x in world]

    def shrunk(level: DataFrame, parent):
        """(n_l + strength · parent_l) / (n + strength)"""
        level = level.withColumn("_n", n)
        sums = F.aggregate("_n", F.lit(0.0), lambda a, x: a + x)
        return F.transform(F.col("_n"), lambda x, i: (x + F.lit(PRIOR_STRENGTH) * parent[i]) / (sums + F.lit(PRIOR_STRENGTH))), level

    even = F.array(*[F.lit(x) for x in world])
    p, lvl = shrunk(read.where("suffix IS NOT NULL").groupBy("suffix").agg(*counts), even)
    by_suffix = lvl.select("suffix", p.alias("suffix_prior"))
    p, lvl = shrunk(read.where("host IS NOT NULL").groupBy("host", "suffix").agg(*counts).join(by_suffix, "suffix", "left")
                    .withColumn("_up", F.coalesce("suffix_prior", even)), F.col("_up"))
    by_host = lvl.select("host", F.col("suffix").alias("_suffix"), p.alias("host_prior"))
    said = read.where("declared IS NOT NULL").groupBy("declared").agg(*counts)
    sums = said.agg(F.count("*").alias("k"), *[F.sum(f"n{i}").alias(f"n{i}") for i in range(len(langs))]).first()
    kinds = (sums["k"] or 0) + 1
    of = F.array(*[F.lit((sums[f"n{i}"] or 0.0) + kinds) for i in range(len(langs))])
    by_said = said.select("declared", F.transform(n, lambda x, i: F.log((x + 1.0) / of[i])).alias("said"))

    fused = (rows.join(by_said, "declared", "left").join(by_suffix, "suffix", "left")
             .join(by_host, (rows["host"] == by_host["host"]) & rows["suffix"].eqNullSafe(by_host["_suffix"]), "left"))
    prior = F.coalesce("host_prior", "suffix_prior", even)
    none = F.array(*[F.lit(0.0)] * len(langs))
    fused = fused.select(
        "_keep", "n_letters",
        F.transform(F.col("ll"), lambda x, i: x * TEXT_WEIGHT + F.coalesce(F.col("said"), none)[i] + F.log(prior[i]))
        .alias("lp"))
    top = F.array_max("lp")
    fused = fused.select("_keep", "n_letters",
                         F.element_at(F.array(*[F.lit(x) for x in langs]), F.array_position("lp", top).cast("int")).alias("l"),
                         (1.0 / F.aggregate("lp", F.lit(0.0), lambda a, x: a + F.exp(x - top))).alias("p"))
    blank = F.col("n_letters") == 0
    return fused.select("_keep.*", F.when(blank, F.lit(UNKNOWN)).otherwise(F.col("l")).alias("language"),
                        F.when(blank, F.lit(0.0)).otherwise(F.col("p")).alias("posterior"), "n_letters").withColumn(
        "accepted", (F.col("language") != UNKNOWN) & (F.col("posterior") >= MIN_POSTERIOR))


def page_evidence(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``pages`` with ``declared`` (the html element's lang, first subtag), ``host``, ``suffix`` and ``visible`` text.

    Clashing column names are refused; NULL or odd addresses give NULL evidence.
    """
    clash = {"declared", "host", "suffix", "visible"} & set(pages.columns)
    if clash:
        raise ValueError(f"columns {sorted(clash)} exist")
    host = F.lower(F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/@?#]*@)?([^/:?#]+)", 1))
    text = F.regexp_replace(F.col(html), r"(?is)<(script|style)\b.*?</\1\s*>|<!--.*?-->|<[^>]*>|&#?\w+;?", " ")
    said = F.lower(F.regexp_extract(html, r"(?i)<html\b[^>]*?\blang\s*=\s*[\"']?([A-Za-z]{2,8})", 1))
    return pages.select("*", F.nullif(said, F.lit("")).alias("declared"), F.nullif(host, F.lit("")).alias("host"),
                        F.nullif(F.regexp_extract(host, r"\.([a-z]{2,})$", 1), F.lit("")).alias("suffix"),
                        text.alias("visible"))

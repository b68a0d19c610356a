"""People who share a title: pair rows, per-person counts, per-person sets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.operators.positions import positions, range_numbered
from marquee.sinks.files import scratch_table

# Signatures whose unions of bitmaps one task finds for a chunk (a block of their numbers), as a power of two.
BLOCK_BITS = 14
# Members or pairs of one task, about: the number of tasks follows them, not the session's setting.
TASK_ROWS = 2_000_000


def _tasks(rows: int | None) -> int:
    return max(1, -(-(rows or 0) // TASK_ROWS))


def _pair_tasks(members: DataFrame, title: str) -> tuple[int, int]:
    """Tasks for the members and for all pairs of people of a title."""
    sizes = members.groupBy(title).agg(F.count(F.lit(1)).alias("_size"))
    here = sizes.agg(F.sum("_size").alias("rows"), F.sum(F.col("_size") * (F.col("_size") - 1)).alias("pairs")).first()
    return _tasks(here["rows"]), _tasks(here["pairs"])


def _filtered(credits: DataFrame, where: Column | None) -> DataFrame:
    return credits if where is None else credits.where(where)


def _members(credits: DataFrame, title: str, person: str, where: Column | None, unique: bool = False) -> DataFrame:
    """Distinct ``(title, person)`` of the (filtered) credits; ``unique``: they are distinct already."""
    rows = _filtered(credits, where).select(title, person).where(F.col(title).isNotNull() & F.col(person).isNotNull())
    return rows if unique else rows.repartition(_tasks(rows.count()), title, person).distinct()


def _heavy_titles(credits: DataFrame, title: str, heavy_size: int) -> DataFrame:
    """Titles with more than ``heavy_size`` credits, with that count as ``_size``.

    Counted on the credits as read (a partial aggregate straight off the
    scan, in parallel with the de-duplication), so ``_size`` bounds the
    number of distinct people from above; treating a title as heavy is
    always exact, only slower.  There are at most (credits / heavy_size)
    such titles, usually none, so the joins against this table are
    broadcast by the planner (or dropped when it is empty).
    """
    return (
        credits.where(F.col(title).isNotNull())
        .groupBy(title).agg(F.count(F.lit(1)).alias("_size"))
        .where(F.col("_size") > F.lit(heavy_size))
    )



def collaborator_pairs(credits: DataFrame, title: str = "tconst", person: str = "nconst",
                       where: Column | None = None, other: str = "other",
                       heavy_size: int = 1000) -> DataFrame:
    """Distinct ``person, other`` with ``person <> other`` credited on a common title.

    The pair relation is the result itself, so its size is the output size.
    ``(title, person)`` is de-duplicated (map-side) before pairing.  Titles
    with at most ``heavy_size`` people are paired by a plain equi-join on
    title.  A heavier title is split: its people are hashed into
    ``ceil(size / heavy_size)`` buckets and each bucket is joined with the
    title's full member list, so the title's pairs are produced by many
    tasks, none holding more than ``heavy_size`` people on its left side.
    The final distinct is a partial aggregation (pairs repeated over many
    shared titles shrink map-side).
    """
    m = _members(credits, title, person, where)
    heavy = _heavy_titles(_filtered(credits, where), title, heavy_size)
    light = m.join(heavy.select(title), title, "left_anti")
    row_tasks, pair_tasks = _pair_tasks(light, title)
    dealt = light.repartition(row_tasks, title)
    light_pairs = dealt.join(dealt.select(F.col(title), F.col(person).alias(other)), title)

    tagged = m.join(heavy, title, "inner").withColumn(
        "_buckets", F.ceil(F.col("_size") / F.lit(heavy_size)).cast("int"))
    left = tagged.select(title, person, F.pmod(F.xxhash64(F.col(person)), F.col("_buckets")).cast("int").alias("_b"))
    right = tagged.select(F.col(title), F.col(person).alias(other),
                          F.explode(F.sequence(F.lit(0), F.col("_buckets") - F.lit(1))).alias("_b"))
    heavy_pairs = left.join(right, [title, "_b"]).drop("_b")

    distinct = lambda pairs: pairs.where(F.col(person) != F.col(other)).select(person, other)
    light_pairs = distinct(light_pairs).repartition(pair_tasks, person, other).distinct()
    if heavy.isEmpty():
        return light_pairs
    return light_pairs.unionByName(distinct(heavy_pairs)).distinct()


def collaborator_counts(credits: DataFrame, title: str = "tconst", person: str = "nconst",
                        where: Column | None = None, heavy_size: int = 1000, unique: bool = False) -> DataFrame:
    """``person, collaborators``: number of distinct co-workers; 0 when alone.

    Every person with a (filtered) credit appears; ``unique`` says that no (title, person) is repeated.  Exact, and no title
    with more than ``heavy_size`` people is ever expanded into pairs:

    * *light* titles (at most ``heavy_size`` people) give pair rows, at most
      ``heavy_size`` per credit;
    * for *heavy* titles each person gets a signature, the sorted set of
      heavy titles they are on.  Everyone on those titles is a co-worker;
      their number is the size of the union of the titles' member bitmaps,
      found once per *distinct* signature (``_reach``);
    * a light pair counts only if the two signatures do not overlap (else
      that co-worker is already counted through a heavy title).

    Without heavy titles the plan is the plain self-join + grouped distinct count.
    """
    m = _members(credits, title, person, where, unique)
    heavy_titles = _heavy_titles(_filtered(credits, where), title, heavy_size).select(title)
    if heavy_titles.isEmpty():
        return _pair_counts(m, m, title, person)
    heavy_titles = scratch_table(heavy_titles, "heavy-titles")
    m = scratch_table(m, "members")
    light = m.join(heavy_titles, title, "left_anti")
    sig = scratch_table(m.join(heavy_titles, title, "left_semi")
                        .groupBy(person).agg(F.array_sort(F.collect_set(F.col(title))).alias("_sig")), "signatures")
    via_heavy = sig.join(_reach(sig), "_sig").select(person, (F.col("_reach") - F.lit(1)).alias("_n"))
    return _pair_counts(m, light, title, person, sig, via_heavy)


def _reach(people: DataFrame) -> DataFrame:
    """``_sig, _reach``: how many people are on any title of the signature (``people``: one row each, with ``_sig``).

    Only the distinct signatures are numbered, in their order, which keeps a title's together; a signature stands for as many
    people as have it.  Every heavy title is a set of bitmaps over these numbers, one per chunk of 32,768 that it has signatures
    in; a signature unites its titles' bitmaps chunk by chunk and adds up the people of the bits.  Work in proportion to distinct
    signatures × their titles × chunks of distinct signatures, however many people share them; never signature × signature.
    A signature of one title is counted without bitmaps.
    """
    signatures = range_numbered(people.groupBy("_sig").agg(F.count(F.lit(1)).alias("_weight")), "_sig", name="signature-numbers")
    chunk, bit = F.shiftright("_n", 15).alias("_chunk"), F.col("_n").bitwiseAND((1 << 15) - 1).alias("_bit")
    place = signatures.select(F.explode("_sig").alias("_t"), chunk, bit, "_weight")
    bitmaps = scratch_table(place.groupBy("_t", "_chunk").agg(F.bitmap_construct_agg("_bit").alias("_people")), "member-bitmaps")
    # the weights as bitmaps too: slice k has the signatures whose weight has the bit k
    slices = signatures.select(chunk, bit, F.posexplode(F.split(F.reverse(F.bin("_weight")), "")).alias("_slice", "_on"))
    weights = slices.where("_on = '1'").groupBy("_chunk", "_slice").agg(F.bitmap_construct_agg("_bit").alias("_people"))
    wanted = signatures.where(F.size("_sig") > 1).select(F.col("_n").alias("_id"), "_sig")
    united = _unions(wanted, bitmaps, weights).groupBy("_id").agg(F.sum("_count").alias("_reach"))
    alone = place.groupBy("_t").agg(F.sum("_weight").alias("_reach"))
    several = wanted.join(united, "_id").select("_sig", "_reach")
    return several.unionByName(alone.select(F.array("_t").alias("_sig"), "_reach"))


def _unions(wanted: DataFrame, bitmaps: DataFrame, weights: DataFrame) -> DataFrame:
    """``_id, _count``: the weight of the union of the bitmaps of each signature's titles (``_id, _sig``), per chunk.

    Signatures go in blocks of neighbouring numbers; a block meets a chunk only where one of its titles has signatures.  A task
    holds a chunk's bitmaps of the block's titles (4 KiB each) and weights (4 KiB for each bit of the largest), and streams the
    block's signatures past them.
    """
    block = F.shiftright("_id", BLOCK_BITS).alias("_block")
    titles = wanted.select(F.explode("_sig").alias("_t"), "_id", block)
    here = bitmaps.groupBy("_t").agg(F.collect_list("_chunk").alias("_chunks"))
    listed = scratch_table(titles.join(here, "_t").groupBy("_id", "_block").agg(
        F.collect_list("_t").alias("_titles"), F.array_distinct(F.flatten(F.collect_list("_chunks"))).alias("_chunks")), "signature-chunks")
    asks = listed.select(F.explode("_chunks").alias("_chunk"), "_block", "_id", "_titles")
    held = titles.select("_t", "_block").distinct().join(bitmaps, "_t")
    met = asks.select("_chunk", "_block").distinct().join(weights, "_chunk")
    none = lambda kind, name: F.lit(None).cast(kind).alias(name)
    kind = T.ArrayType(bitmaps.schema["_t"].dataType)
    rows = (held.select("_chunk", "_block", none("long", "_id"), F.array("_t").cast(kind).alias("_titles"), none("int", "_slice"), "_people")
            .unionByName(met.select("_chunk", "_block", none("long", "_id"), none(kind, "_titles"), "_slice", "_people"))
            .unionByName(asks.select("_chunk", "_block", "_id", F.col("_titles").cast(kind), none("int", "_slice"), none("binary", "_people"))))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, maps, bits, powers, matrix = None, {}, [], [], None
        for batch in batches:
            ids, counts = [], []
            for chunk, block, one, titles, slice_, people in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if (chunk, block) != now:
                    now, maps, bits, powers, matrix = (chunk, block), {}, [], [], None
                if people is not None:
                    words = np.frombuffer(people, np.uint64)
                    if slice_ is None:
                        maps[titles[0]] = words
                    else:
                        bits.append(words)
                        powers.append(1 << slice_)
                    continue
                if matrix is None:
                    matrix, scale = np.stack(bits), np.array(powers, np.int64)
                union = None
                for t in titles:
                    if (words := maps.get(t)) is not None:
                        union = words if union is None else union | words
                ids.append(one)
                counts.append(int(np.bitwise_count(matrix & union).sum(axis=1, dtype=np.int64) @ scale))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(counts, pa.int64())], names=["_id", "_count"])

    dealt = rows.repartition("_chunk", "_block").sortWithinPartitions("_chunk", "_block", F.col("_people").isNull())
    return dealt.mapInArrow(run, "_id long, _count long")


def _pair_counts(members: DataFrame, light: DataFrame, title: str, person: str, sig: DataFrame | None = None,
                 via_heavy: DataFrame | None = None) -> DataFrame:
    """Co-workers met on light titles, unless two signatures share a title, plus those met through heavy ones."""
    row_tasks, pair_tasks = _pair_tasks(light, title)
    dealt = light.repartition(row_tasks, title)
    right = dealt.select(F.col(title), F.col(person).alias("_other"))
    pairs = (dealt.join(right, title, "inner").where(F.col(person) != F.col("_other"))
             .select(person, "_other").repartition(pair_tasks, person, "_other").distinct())
    if sig is not None:
        other_sig = sig.select(F.col(person).alias("_other"), F.col("_sig").alias("_osig"))
        pairs = (pairs.join(sig, person, "left").join(other_sig, "_other", "left")
                 .where(F.col("_sig").isNull() | F.col("_osig").isNull() | ~F.arrays_overlap("_sig", "_osig")))
    counted = pairs.groupBy(person).agg(F.count(F.lit(1)).alias("_n"))
    everyone = members.select(person, F.lit(0).cast("long").alias("_n"))
    every = everyone.unionByName(counted) if via_heavy is None else everyone.unionByName(counted).unionByName(via_heavy)
    return every.groupBy(person).agg(F.sum("_n").cast("long").alias("collaborators"))


def collaborator_sets(credits: DataFrame, title: str = "tconst", person: str = "nconst",
                      where: Column | None = None, other: str = "other", heavy_size: int = 1000,
                      heavy_set: int = 100_000) -> DataFrame:
    """``person, pos, other, n_items``: every co-worker of a person with its place in the sorted set.

    One row per pair at every size; a person without co-workers has one row with ``n_items`` 0 (see ``positions``, whose
    ``heavy_size`` is ``heavy_set`` here).  ``set_text`` makes texts of them.
    """
    pairs = collaborator_pairs(credits, title, person, where, other=other, heavy_size=heavy_size)
    people = _members(credits, title, person, where).select(
        F.col(person), F.lit(None).cast(pairs.schema[other].dataType).alias(other))
    # a person has at most as many co-workers as the titles' other credits: known without the pairs, which are then made once
    rows = _filtered(credits, where).select(title, person).where(F.col(title).isNotNull() & F.col(person).isNotNull())
    sizes = rows.groupBy(title).agg((F.count(F.lit(1)) - 1).alias("_others"))
    bounds = rows.distinct().join(sizes, title).groupBy(person).agg(F.sum("_others").alias("_most"))
    return positions(pairs.unionByName(people), person, other, heavy_size=heavy_set, most=bounds)

"""Chat formatting from reply trees.

1. Messages with parent pointers; iterative self-joins of the pointer table give
   every message its ancestor 1, 2, 4, 8 … steps up.
2. From each leaf the jumps are expanded, longest first, to all its
   ancestors: one row per (leaf, ancestor) of each root-to-leaf path, after a
   number of joins that grows with the logarithm of the depth.
3. Branches of a tree are ranked by their total score (ties: longer, then the
   smaller leaf) and the best ``top`` are kept.
4. Each chosen path becomes one conversation in the template.

Template: ``### Role: text </turn>`` and a line break per turn.  Inside roles and
texts a backslash, and each character that a control string begins or ends
with, is written as backslash and a letter, so no control string can occur there and
the escapes can be undone.
"""

from __future__ import annotations

import hashlib
import re

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marquee.llm.common import marked, marks_of, written

# The template.
OPEN, AFTER_ROLE, CLOSE = "### ", ": ", " </turn>\n"
_ESCAPES = {"\\": "\\\\", "#": "\\h", "<": "\\l", ":": "\\c", "\n": "\\n", "\r": "\\r"}
_IN_TEXT = str.maketrans({k: v for k, v in _ESCAPES.items() if k in "\\#<"})
_IN_ROLE = str.maketrans(_ESCAPES)
_BACK = {v[1]: k for k, v in _ESCAPES.items()}
_ESCAPED = re.compile(r"\\(.)", re.S)
TRAINED_ROLE = "assistant"


def escape(text: str, role: bool = False) -> str:
    return text.translate(_IN_ROLE if role else _IN_TEXT)


def unescape(text: str) -> str:
    return _ESCAPED.sub(lambda m: _BACK[m[1]], text) if "\\" in text else text


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[tuple[int, int]]]:
    """(formatted conversation, spans of the loss mask: the trained role's texts)."""
    out, spans, at = [], [], 0
    for role, text in turns:
        head, body = f"{OPEN}{escape(role, True)}{AFTER_ROLE}", escape(text)
        if role == TRAINED_ROLE:
            spans.append((at + len(head), at + len(head) + len(body)))
        out += [head, body, CLOSE]
        at += len(head) + len(body) + len(CLOSE)
    return "".join(out), spans


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """The turns of a formatted conversation."""
    turns = []
    for part in formatted.split(CLOSE)[:-1]:
        role, _, text = part.removeprefix(OPEN).partition(AFTER_ROLE)
        turns.append((unescape(role), unescape(text)))
    return turns


def one_row_each(messages: DataFrame) -> DataFrame:
    """``messages`` without NULL ids, and of several rows of one id the smallest by parent, conversation, role, text and score.

    Only rows of ids that may be repeated are shuffled.
    """
    named = messages.where("node IS NOT NULL")
    repeated = written(named.groupBy("node").count().where("count > 1").select("node"), "chat-repeated")
    if repeated.isEmpty():
        return named
    near, far = marked(named, "node", written(marks_of(repeated), "marks"))
    order = [c for c in ("parent", "conv_id", "role", "text", "score") if c in messages.columns]
    one = near.groupBy("node").agg(F.min(F.struct(*order)).alias("_m")).select("node", *[F.col(f"_m.{c}").alias(c) for c in order])
    return far.select("node", *order).unionByName(one)


def root_paths(messages: DataFrame) -> DataFrame:
    """``leaf, node, dist`` for every leaf and each message on its path to the root (dist 0: the leaf).

    ``messages``: ``node, parent`` (longs; NULL parent: a root).  A parent that isn't
    there makes its child a root.  Messages on a cycle have no root and give no rows.
    """
    here = messages.select(F.col("node").alias("parent")).distinct().withColumn("_known", F.lit(True))
    links = messages.groupBy("node").agg(F.min("parent").alias("parent"))
    # only messages that name a parent are joined: the roots' NULL would be one key
    asked = links.where("parent IS NOT NULL").join(here, "parent", "left").select(
        "node", F.when(F.col("_known"), F.col("parent")).alias("up"))
    parents = written(asked.union(links.where("parent IS NULL").select("node", F.col("parent").alias("up"))), "chat-parents")
    total = parents.count()
    jumps = parents.where("up IS NOT NULL")
    steps = []
    # beyond the number of messages only cycles are left
    while (1 << len(steps)) <= total and not jumps.isEmpty():
        steps.append(jumps)
        # messages that are less deep than the next jump drop out here
        jumps = written(jumps.join(jumps.select(F.col("node").alias("up"), F.col("up").alias("_up2")), "up")
                        .select("node", F.col("_up2").alias("up")), "chat-jumps")
    inner = parents.where("up IS NOT NULL").select(F.col("up").alias("node")).distinct()
    paths = parents.select("node").join(inner, "node", "left_anti").select(
        F.col("node").alias("leaf"), "node", F.lit(0).cast("long").alias("dist"))
    for k in reversed(range(len(steps))):
        further = paths.join(steps[k], "node").select("leaf", F.col("up").alias("node"), (F.col("dist") + (1 << k)).alias("dist"))
        paths = written(paths.union(further), "chat-paths")
    return paths


def best_branches(paths: DataFrame, messages: DataFrame, top: int | None = 1) -> DataFrame:
    """``leaf, root, rank``: each tree's branches by total score, then length, then leaf; ``top`` None keeps all."""
    branch = paths.join(messages.select("node", "score"), "node").groupBy("leaf").agg(
        F.sum(F.coalesce("score", F.lit(0.0))).alias("_score"), F.count("*").alias("_n"),
        F.max_by("node", "dist").alias("root"))
    order = Window.partitionBy("root").orderBy(F.desc("_score"), F.desc("_n"), "leaf")
    ranked = branch.withColumn("rank", F.row_number().over(order))
    if top is not None:
        ranked = ranked.where(F.col("rank") <= top)
    return ranked.select("leaf", "root", "rank")


def conversations(messages: DataFrame, top: int | None = 1) -> DataFrame:
    """``conv_id, rank, formatted, spans`` of each chosen branch of each tree.

    ``messages``: ``node, parent, conv_id, role, text, score``; NULL roles and texts
    count as empty, NULL scores as 0.  A tree's ``conv_id`` is its root's.  ``spans``: start and
    end (code points) of the loss mask within ``formatted``.  One path is one
    row, as long as its texts are.  Of several rows of one id the smallest by parent, conversation, role, text and score
    stands; rows with a NULL id are left out.  An empty table gives an empty result.
    """
    messages = one_row_each(messages)
    paths = root_paths(messages)
    chosen = best_branches(paths, messages, top)
    turns = paths.join(chosen, "leaf").join(messages.select("node", "role", "text"), "node")
    per_path = turns.groupBy("leaf", "root", "rank").agg(F.transform(
        F.reverse(F.array_sort(F.collect_list(F.struct(
            "dist", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))),
        lambda x: F.struct(x["role"].alias("role"), x["text"].alias("text"))).alias("turns"))
    roots = messages.select(F.col("node").alias("root"), "conv_id")

    @F.arrow_udf("formatted string, spans array<struct<start: long, end: long>>")
    def render(turns: pa.Array) -> pa.Array:
        made = [format_turns([(t["role"], t["text"]) for t in row]) for row in turns.to_pylist()]
        spans = pa.array([[{"start": a, "end": b} for a, b in s] for _, s in made],
                         pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return pa.StructArray.from_arrays([pa.array([f for f, _ in made], pa.string()), spans], ["formatted", "spans"])

    return per_path.join(roots, "root").withColumn("_f", render("turns")).select(
        "conv_id", "rank", "_f.formatted", "_f.spans")


def chains(rows: DataFrame) -> DataFrame:
    """Messages of plain conversations (``conv_id, turn, role, text``): each turn answers the one before it.

    Repeated turns follow one another (by role, then text).  Rows with a NULL ``conv_id`` form one conversation.
    """
    order = ["turn", "role", "text"]
    w = Window.partitionBy("conv_id").orderBy(*[F.asc_nulls_first(c) for c in order])
    numbered = written(rows.select("conv_id", *order).withColumn("node", F.monotonically_increasing_id()), "chat-rows")
    return numbered.select("node", F.lag("node").over(w).alias("parent"), "conv_id", "role", "text",
                           F.lit(0.0).alias("score"))


def digests(formatted: DataFrame) -> DataFrame:
    """``conv_id, n_turns, turns_sha256, loss_chars, loss_sha256, formatted_chars``, all read back from ``formatted``."""

    @F.arrow_udf("n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string")
    def read(texts: pa.Array, spans: pa.Array) -> pa.Array:
        out = []
        for text, mask in zip(texts.to_pylist(), spans.to_pylist(), strict=True):
            turns = read_turns(text)
            whole = "".join(f"{role}\n{said}\n" for role, said in turns)
            loss = "".join(unescape(text[s["start"]:s["end"]]) for s in mask)
            out.append((len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
        cols = list(zip(*out, strict=True)) if out else [[]] * 4
        return pa.StructArray.from_arrays(
            [pa.array(c, t) for c, t in zip(cols, [pa.int64(), pa.string(), pa.int64(), pa.string()], strict=True)],
            ["n_turns", "turns_sha256", "loss_chars", "loss_sha256"])

    return formatted.withColumn("_d", read("formatted", "spans")).select(
        "conv_id", "_d.*", F.length("formatted").cast("long").alias("formatted_chars"))

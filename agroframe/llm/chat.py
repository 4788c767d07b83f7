"""Chat formatting of reply trees.

A tree is rows (tree, node, parent, score).  Iterative self-joins follow every
root-to-leaf path: step k joins what is known about 2^k replies to itself, so a
tree of depth d takes about log2(d) joins.  Branches are ranked by the score
summed along them, and each chosen path is written out as one conversation.

The template marks turns as ``<|im_start|>role\\ntext<|im_end|>\\n``.  Inside
texts every ``<``, backslashes, ``|`` gets one more backslash, so no control
string can appear there, and taking one away restores the text.
"""

from __future__ import annotations

import functools
import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from agroframe.session import materialize

START, END = "<|im_start|>", "<|im_end|>\n"
LEARNED_ROLE = "assistant"


def climb(nodes: DataFrame) -> tuple[list[DataFrame], DataFrame]:
    """What repeated self-joins learn about (tree, node, parent, score) without writing any path out.

    Round k joins the nodes with themselves at the node that each has reached, 2^k replies further up, and carries the
    summed score and the number of replies along.  Returns the rounds' jumps (tree, node, far: the node
    2^k replies up) and the ``tops``: (tree, node, up, score) of every node that has a root above it or is one,
    with the replies and the score from there down to the node.  A node leaves the rounds once it has met its root,
    so round k handles the nodes at least 2^k replies deep.  The join's hot keys (many replies to one node) have one row on the other side; AQE splits them.

    ``node`` is unique in its tree.  A node whose parent is null or not in the tree is a root.  Rows without tree or node
    take no part.  A chain that runs into a cycle has no root.  A null score counts 0.
    """
    nodes = nodes.where("tree is not null and node is not null")
    known = nodes.select("tree", F.col("node").alias("parent"), F.col("node").alias("far"))
    sizes = nodes.groupBy("tree").agg(F.count("*").alias("size"))
    at = nodes.select("tree", "node", "parent", F.coalesce(F.col("score").cast("double"), F.lit(0.0)).alias("score")) \
        .join(known, ["tree", "parent"], "left").join(sizes, "tree") \
        .select("tree", "node", "far", F.when(F.col("far").isNotNull(), 1).otherwise(0).cast("long").alias("up"), "score", "size")
    rounds, tops = [], []
    while True:
        at = materialize(at, "climb")
        tops.append(at.where("far is null"))
        # a path has fewer replies than its tree has nodes; only a cycle would go on
        open_ = at.where("far is not null and up < size")
        if open_.isEmpty():
            return rounds, _union(tops).select("tree", "node", "up", "score")
        rounds.append(open_.select("tree", "node", "far"))
        above = _union([*tops, open_]).select("tree", F.col("node").alias("far"), F.col("far").alias("next"),
                                              F.col("up").alias("more"), F.col("score").alias("gain"))
        at = open_.join(above, ["tree", "far"]).select(
            "tree", "node", F.col("next").alias("far"), (F.col("up") + F.col("more")).alias("up"),
            (F.col("score") + F.col("gain")).alias("score"), "size")


def _union(parts: list[DataFrame]) -> DataFrame:
    return functools.reduce(DataFrame.unionByName, parts)


def _leaves(nodes: DataFrame, tops: DataFrame) -> DataFrame:
    """The tops that nobody replies to, as (tree, leaf, score)."""
    replied = nodes.where("tree is not null and node is not null").select("tree", F.col("parent").alias("node")).distinct()
    return tops.join(replied, ["tree", "node"], "left_anti").select("tree", F.col("node").alias("leaf"), "score")


def _written_out(leaves: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """The paths of (tree, leaf): rows (tree, leaf, up, node), doubled from the leaf up; as many rows as the paths have nodes."""
    found = materialize(leaves.select("tree", "leaf", F.lit(0).cast("long").alias("up"), F.col("leaf").alias("node")), "paths")
    for k, jump in enumerate(rounds):
        found = found.unionByName(materialize(
            found.join(jump, ["tree", "node"])
            .select("tree", "leaf", (F.col("up") + 2 ** k).alias("up"), F.col("far").alias("node")), "paths"))
    return found


def reply_paths(nodes: DataFrame) -> DataFrame:
    """All root-to-leaf paths of (tree, node, parent), written out: rows (tree, leaf, up, node), ``up`` 0 at the leaf.

    Its size is leaves x depth; ``best_paths`` writes only chosen ones.  Odd rows: see ``climb``.
    """
    nodes = nodes.select("tree", "node", "parent", F.lit(0.0).alias("score"))
    rounds, tops = climb(nodes)
    return _written_out(_leaves(nodes, tops), rounds)


def best_paths(nodes: DataFrame, best: int = 1) -> DataFrame:
    """The *best* root-to-leaf paths of each tree of (tree, node, parent, score) by summed score (ties: smaller leaf).

    Rows (tree, leaf, up, node, score, branch); ``score`` is the path's, ``branch`` counts from 1.  Branches are ranked
    on one row per leaf, each task first keeping its own best ones; only then the chosen paths are written out.
    """
    rounds, tops = climb(nodes)
    order = Window.partitionBy("tree").orderBy(F.desc("score"), "leaf")
    chosen = materialize(_leaves(nodes, tops).withColumn("branch", F.row_number().over(order)).where(F.col("branch") <= best), "chosen")
    return _written_out(chosen, rounds).join(chosen, ["tree", "leaf"])


def escape(text: str) -> str:
    return re.sub(r"<(\\*)\|", r"<\\\1|", text)


def unescape(text: str) -> str:
    return re.sub(r"<\\(\\*)\|", r"<\1|", text)


def _escape_role(role: str) -> str:
    return escape(role.replace("\\", "\\\\").replace("\n", "\\n"))


def _unescape_role(role: str) -> str:
    return re.sub(r"\\(\\|n)", lambda m: "\n" if m[1] == "n" else "\\", unescape(role))


def format_turns(turns: list[tuple[str, str]]) -> tuple[str, list[int], list[int]]:
    """The conversation's string and the code-point spans under the loss mask (every assistant text)."""
    parts, begins, ends, at = [], [], [], 0
    for role, text in turns:
        head, body = f"{START}{_escape_role(role)}\n", escape(text)
        if role == LEARNED_ROLE:
            begins.append(at + len(head))
            ends.append(at + len(head) + len(body))
        at += len(head) + len(body) + len(END)
        parts += (head, body, END)
    return "".join(parts), begins, ends


def read_turns(formatted: str) -> list[tuple[str, str]]:
    """Inverse of ``format_turns``."""
    out = []
    for turn in formatted.split(END)[:-1]:
        role, text = turn.removeprefix(START).split("\n", 1)
        out.append((_unescape_role(role), unescape(text)))
    return out


def format_paths(chosen: DataFrame, texts: DataFrame) -> DataFrame:
    """One row per chosen path: tree, leaf, branch, score, formatted, loss_begins, loss_ends.

    *texts* has (tree, node, role, text); null roles and texts are empty.  A
    conversation is one output row, so it is put together in one task.
    """
    turn = F.struct((-F.col("up")).alias("at"), F.coalesce("role", F.lit("")).alias("role"),
                    F.coalesce("text", F.lit("")).alias("text"))
    rows = (chosen.join(texts.select("tree", "node", "role", "text"), ["tree", "node"])
            .groupBy("tree", "leaf", "branch", "score").agg(F.sort_array(F.collect_list(turn)).alias("turns")))

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                got = [format_turns([(t["role"], t["text"]) for t in turns]) for turns in part.column("turns").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(c) for c in ("tree", "leaf", "branch", "score")),
                     pa.array([g[0] for g in got], pa.string()), pa.array([g[1] for g in got], pa.list_(pa.int64())),
                     pa.array([g[2] for g in got], pa.list_(pa.int64()))],
                    names=["tree", "leaf", "branch", "score", "formatted", "loss_begins", "loss_ends"])

    return rows.select("tree", "leaf", "branch", "score", "turns").mapInArrow(
        write, "tree long, leaf long, branch int, score double, formatted string, "
               "loss_begins array<long>, loss_ends array<long>")


def read_back(formatted: DataFrame) -> DataFrame:
    """Digests read from the formatted strings and their loss spans alone."""
    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for tree, text, begins, ends in zip(*(batch.column(c).to_pylist() for c in
                                                  ("tree", "formatted", "loss_begins", "loss_ends"))):
                turns = read_turns(text)
                whole = "".join(f"{role}\n{body}\n" for role, body in turns)
                loss = "".join(unescape(text[b:e]) for b, e in zip(begins, ends))
                rows.append((tree, len(turns), hashlib.sha256(whole.encode()).hexdigest(), len(loss),
                             hashlib.sha256(loss.encode()).hexdigest(), len(text)))
            kinds = [pa.int64(), pa.int64(), pa.string(), pa.int64(), pa.string(), pa.int64()]
            columns = list(zip(*rows)) or [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(c), k) for c, k in zip(columns, kinds)],
                names=["conv_id", "n_turns", "turns_sha256", "loss_chars", "loss_sha256", "formatted_chars"])

    return formatted.select("tree", "formatted", "loss_begins", "loss_ends").mapInArrow(
        read, "conv_id long, n_turns long, turns_sha256 string, loss_chars long, loss_sha256 string, formatted_chars long")


def conversation_nodes(turns: DataFrame, score: Column | None = None) -> DataFrame:
    """Linear conversations (conv_id, turn, role, text) as trees in which each row replies to the row before.

    Rows are ordered by turn, then role and text (nulls first), so repeated turns
    follow each other.  Rows without conv_id take no part.  The score of a row is
    the length of its text unless given.
    """
    order = Window.partitionBy("tree").orderBy("turn", "role", "text")
    rows = turns.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("tree"), F.col("turn").cast("long").alias("turn"),
        F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text"))
    rows = rows.withColumn("node", F.row_number().over(order).cast("long"))
    value = F.coalesce(F.length("text"), F.lit(0)).cast("double") if score is None else score
    return rows.select("tree", "node", F.when(F.col("node") > 1, F.col("node") - 1).alias("parent"), "role", "text",
                       value.alias("score"))


def format_conversations(turns: DataFrame) -> DataFrame:
    """Every conversation of a table of turns, each by its best path."""
    nodes = materialize(conversation_nodes(turns), "nodes")
    return format_paths(best_paths(nodes), nodes)

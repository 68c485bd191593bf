"""Merkle manifest of a dataset: one hash tree per partition of it, and one over these.

Leaves are hashed from the columns of a row and numbered within their tree. FAN**LEVELS
consecutive nodes make a superblock. On the way up every superblock is reduced to one
node, and these nodes are dealt into superblocks again until each tree has one left. On
the way down the nodes of a superblock are cogrouped with the outer nodes that its
members need, the siblings on the way from the superblock to the root; one task finishes
the reduction within the superblock, joins the two parts of each proof and folds leaves
through them. No task holds more than a superblock and its outer nodes.
"""

from __future__ import annotations

from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketide.llm.ordering import positions
from marketide.llm.tables import kept

#: Children of a node, and levels that are reduced within a superblock.
FAN, LEVELS = 8, 4
#: Characters of a digest.
HEX = 64

LEAF_COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
#: A tree as its leaves are hashed: null is told from the empty string.
WHOLE = "whole"

ROW = "tree string, position long, name string, doc_id long, node string, folded_root string, root string"
PROOF = f"{ROW}, subroot string, proof string, places array<int>, widths array<int>"


def field(value: Column) -> Column:
    """``-`` for a null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.when(text.isNull(), "-").otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf_hash(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def digest(text: str) -> str:
    return sha256(text.encode()).hexdigest()


def levels_of(nodes: list[str], size: int, levels: int = LEVELS) -> list[list[str]]:
    """The nodes of a superblock and what they are reduced to, level by level.

    ``size`` is how many nodes the tree has on this level: while it has more than one, a
    superblock with a single node hashes that one too.
    """
    out = [nodes]
    while size > 1 and len(out) <= levels:
        last = out[-1]
        out.append([digest("".join(last[i:i + FAN])) for i in range(0, len(last), FAN)])
        size = -(-size // FAN)
    return out


def fold(node: str, proof: str, places: list[int], widths: list[int]) -> str:
    """The root that ``node`` leads to by its proof.

    On each level the run of nodes is ``widths`` long, the node's own place in it is given
    by ``places``, and the proof goes on with the digests of the others.
    """
    at = 0
    for place, width in zip(places, widths):
        own, end = at + HEX * place, at + HEX * (width - 1)
        node = digest(f"{proof[at:own]}{node}{proof[own:end]}")
        at = end
    return node


def paths(levels: list[list[str]]) -> list[tuple[str, list[int], list[int]]]:
    """Of every node of the lowest level: siblings up to the last level, places and widths."""
    found: list[tuple[str, list[int], list[int]]] = [("", [], [])] * len(levels[-1])
    for nodes in levels[-2::-1]:
        above, found = found, []
        for i in range(len(nodes)):
            run = nodes[i - i % FAN:i - i % FAN + FAN]
            proof, places, widths = above[i // FAN]
            others = "".join(run[:i % FAN] + run[i % FAN + 1:])
            found.append((others + proof, [i % FAN, *places], [len(run), *widths]))
    return found


def climb(nodes: DataFrame, levels: int) -> list[DataFrame]:
    """Nodes (tree, position, size, node) of superblocks of superblocks, up to one per tree."""

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("position")
        first, size = part.iloc[0], int(part["size"].iloc[0])
        top = levels_of(part["node"].tolist(), size, levels)[-1]
        return pd.DataFrame(
            {"tree": [first["tree"]], "position": [first["position"] // FAN**levels], "size": [-(-size // FAN**levels)], "node": top}
        )

    out = [nodes]
    while (out[-1].agg(F.max("size")).first()[0] or 0) > 1:
        rows = out[-1].select("tree", "position", "size", "node", block(levels).alias("block"))
        up = rows.groupBy("tree", "block").applyInPandas(run, "tree string, position long, size long, node string")
        out.append(kept(up))
    return out


def block(levels: int) -> Column:
    return F.floor(F.col("position") / FAN**levels).cast("long")


def descend(nodes: DataFrame, outer: DataFrame, levels: int, leaves: bool) -> DataFrame:
    """Proofs of ``nodes`` from the proofs of their superblocks' nodes (``outer``).

    ``nodes`` also have name, doc_id and told; a told node is folded in the place of the node.
    Only ``leaves`` are folded.
    """

    def run(key: tuple, part: pd.DataFrame, above: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("position")
        size, own = int(part["size"].iloc[0]), part["node"].tolist()
        rest = above.iloc[0]
        outer_places, outer_widths = list(rest["places"]), list(rest["widths"])
        proofs, places, widths, folded = [], [], [], []
        for node, told, (proof, place, width) in zip(own, part["told"], paths(levels_of(own, size, levels))):
            proofs.append(proof + rest["proof"])
            places.append([*place, *outer_places])
            widths.append([*width, *outer_widths])
            start = node if told is None or told is pd.NA or told != told else told
            folded.append(fold(start, proofs[-1], places[-1], widths[-1]) if leaves else None)
        out = part[["tree", "position", "name", "doc_id", "node"]].copy()
        return out.assign(
            folded_root=folded, root=rest["root"], subroot=rest["subroot"], proof=proofs, places=places, widths=widths,
        )

    rows = nodes.select("tree", "position", "size", "name", "doc_id", "node", "told", block(levels).alias("block"))
    there = outer.select("tree", F.col("position").alias("block"), "root", "subroot", "proof", "places", "widths")
    return rows.groupBy("tree", "block").cogroup(there.groupBy("tree", "block")).applyInPandas(run, PROOF)


def proofs(stages: list[DataFrame], tops: DataFrame, levels: int, leaves: bool = False) -> DataFrame:
    """Proofs of the lowest nodes of ``climb``, from those of the trees' last nodes (position 0)."""
    out = tops
    for i in range(len(stages) - 1, -1, -1):
        nodes = stages[i]
        for column, kind in (("name", "string"), ("doc_id", "long"), ("told", "string")):
            if column not in nodes.columns:
                nodes = nodes.withColumn(column, F.lit(None).cast(kind))
        out = descend(nodes, out if i == len(stages) - 1 else kept(out), levels, leaves and i == 0)
    return out


def manifest(docs: DataFrame, presented: Column | None = None, levels: int = LEVELS) -> DataFrame:
    """A leaf, its roots and its proof for every row of ``docs``.

    doc_id; leaf; subroot (of the rows with the same lang); root; proof (the digests of all
    siblings on the way up, left to right, level by level, one string); places and widths
    (for each level, where the node stands in its run and how long that is); folded_root,
    the root that the leaf leads to by its proof, where the leaf is hashed with
    ``presented`` in the place of text (null: with text); verified.

    Leaves of a lang ascend by doc_id (null first), rows that repeat one by their leaf. A
    null lang is a tree of its own and comes before the empty one. Only LEAF_COLUMNS of
    ``docs`` count; each may be null. Without rows there is no manifest.
    """
    values = {c: F.col(c) for c in LEAF_COLUMNS}
    told = leaf_hash(*[values[c] if c != "text" else presented for c in LEAF_COLUMNS]) if presented is not None else None
    lang = F.col("lang").cast("string")
    rows = kept(docs.select(
        F.when(lang.isNull(), "").otherwise(F.concat(F.lit("="), lang)).alias("tree"),
        F.col("doc_id").cast("long").alias("doc_id"), leaf_hash(*values.values()).alias("node"),
        (F.lit(None).cast("string") if told is None else F.when(presented.isNotNull(), told)).alias("told"),
    ))
    nodes = kept(positions(rows, "tree", "doc_id", "node"))
    stages = climb(nodes, levels)
    subroots = stages[-1].select(F.lit(WHOLE).alias("tree"), F.col("tree").alias("name"), "node")
    trees = kept(positions(subroots, "tree", "name"))
    upper = climb(trees, levels)
    empty = F.array().cast("array<int>")
    apex = upper[-1].select(
        "tree", "position", F.col("node").alias("root"), F.lit("").alias("subroot"), F.lit("").alias("proof"),
        empty.alias("places"), empty.alias("widths"),
    )
    tops = kept(proofs(upper, apex, levels).select(
        F.col("name").alias("tree"), F.lit(0).cast("long").alias("position"), "root", F.col("node").alias("subroot"),
        "proof", "places", "widths",
    ))
    found = proofs(stages, tops, levels, True)
    return found.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", "root", "proof", "places", "widths", "folded_root",
        (F.col("folded_root") == F.col("root")).alias("verified"),
    )

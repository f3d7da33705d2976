"""A Merkle manifest of a dataset: one tree of hashes per group of rows, a tree over the groups, proofs and their check."""

from __future__ import annotations

from collections.abc import Callable
from hashlib import sha256

import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from odsflow.llm.common import named, ranked, written

#: Nodes in a run, and levels of runs that one superblock of RUN ** LEVELS nodes climbs in one task.
RUN, LEVELS = 8, 4
SUPERBLOCK = RUN ** LEVELS

NODE = "tree string, rank long, size long, node string"
OUTER = "tree string, rank long, lefts array<string>, rights array<string>, top string"


def field(value: Column) -> Column:
    """A value as it goes into a leaf: its UTF-8 byte count, a colon and itself; NULL is one hyphen."""
    text = value.cast("string")
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text))


def leaf(*values: Column) -> Column:
    """The SHA-256 of the values' fields in a row, as lowercase hex digits."""
    return F.sha2(F.concat(*[field(v) for v in values]).cast("binary"), 256)


def tree_name(value: Column) -> Column:
    """A name without NULLs that sorts as the values do: NULL first, then by UTF-8 bytes."""
    return F.when(value.isNull(), F.lit("-")).otherwise(F.concat(F.lit("="), value.cast("string")))


# --- one superblock ----------------------------------------------------------------------------

def digest(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def reduced(nodes: list[str], size: int) -> list[list[str]]:
    """The superblock's nodes level by level, from the given ones up; the last has one node.

    `size` is the node count of the whole tree: a tree's only node stays as it is, while the last node of a
    larger tree is hashed alone.
    """
    levels = [nodes]
    while size > 1 and len(levels) <= LEVELS:
        below = levels[-1]
        levels.append([digest(*below[i:i + RUN]) for i in range(0, len(below), RUN)])
        size = -(-size // RUN)
    return levels


def siblings(levels: list[list[str]]) -> list[list[tuple[str, str]]]:
    """Of each node of each level but the last: the digests left and right of it in its run, in a row."""
    return [
        [("".join(nodes[i - i % RUN:i]), "".join(nodes[i + 1:i - i % RUN + RUN])) for i in range(len(nodes))]
        for nodes in levels[:-1]
    ]


def _block_root(block: pd.DataFrame) -> pd.DataFrame:
    block = block.sort_values("rank")
    first = block.iloc[0]
    top = reduced(block["node"].tolist(), int(first["size"]))[-1][0]
    return pd.DataFrame({"tree": [first["tree"]], "rank": [first["rank"] // SUPERBLOCK], "size": [-(-first["size"] // SUPERBLOCK)], "node": [top]})


def _paths(block: pd.DataFrame, outer: pd.DataFrame) -> tuple[pd.DataFrame, list, list]:
    """The sorted block and, of each of its nodes, the digests left and right at every level up to the top."""
    block = block.sort_values("rank")
    beside = siblings(reduced(block["node"].tolist(), int(block["size"].iloc[0])))
    above = list(zip(outer["lefts"].iloc[0], outer["rights"].iloc[0]))
    paths = [[*[level[i // RUN ** n] for n, level in enumerate(beside)], *above] for i in range(len(block))]
    return block, [[left for left, _ in p] for p in paths], [[right for _, right in p] for p in paths]


def _descend(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    if block.empty or outer.empty:
        return pd.DataFrame(columns=["tree", "rank", "lefts", "rights", "top"])
    block, lefts, rights = _paths(block, outer)
    return pd.DataFrame({"tree": block["tree"], "rank": block["rank"], "lefts": lefts, "rights": rights, "top": outer["top"].iloc[0]})


def _prove(block: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
    """Proof digests and folded roots of a superblock's leaves."""
    names = ["doc_id", "node", "subroot", "top", "proof_sha256", "folded_root"]
    if block.empty or outer.empty:
        return pd.DataFrame(columns=names)
    block, lefts, rights = _paths(block, outer)
    proofs, folded = [], []
    for claimed, left, right in zip(block["claimed"], lefts, rights):
        proofs.append(digest(*[side for pair in zip(left, right) for side in pair]))
        for before, behind in zip(left, right):
            claimed = digest(before, claimed, behind)
        folded.append(claimed)
    found = pd.DataFrame({"doc_id": block["doc_id"], "node": block["node"], "proof_sha256": proofs, "folded_root": folded})
    return found.assign(subroot=outer["subroot"].iloc[0], top=outer["top"].iloc[0])[names]


# --- whole trees -------------------------------------------------------------------------------

def _by_block(nodes: DataFrame):
    return nodes.withColumn("block", F.expr(f"rank div {SUPERBLOCK}")).groupBy("tree", "block")


def climb(nodes: DataFrame) -> list[DataFrame]:
    """The superblock nodes of each height, from `nodes` up to the one that has a single node per tree."""
    heights = [nodes]
    while (heights[-1].agg(F.max("size")).first()[0] or 0) > 1:
        up = _by_block(heights[-1].select("tree", "rank", "size", "node")).applyInPandas(_block_root, NODE)
        heights.append(written(up, "superblocks"))
    return heights


def exchange(nodes: DataFrame, outer: DataFrame, finish: Callable, schema: str) -> DataFrame:
    """Nodes and the required outer nodes of their superblock (one row each) meet in one task."""
    return _by_block(nodes).cogroup(outer.withColumnRenamed("rank", "block").groupBy("tree", "block")).applyInPandas(finish, schema)


def descend(heights: list[DataFrame], outer: DataFrame) -> DataFrame:
    """The outer nodes of every node of the lowest height given, from those of the highest."""
    for nodes in reversed(heights[:-1]):
        outer = written(exchange(nodes.select("tree", "rank", "size", "node"), outer, _descend, OUTER), "outer")
    return outer


def proofs(leaves: DataFrame) -> DataFrame:
    """Per leaf `doc_id`, `node`, `subroot`, `top` (the root), `proof_sha256`, `folded_root`.

    `leaves` has `tree` (a name without NULLs), `doc_id`, `node` (the leaf's digest) and `claimed`, the digest that
    is to be checked against the root. A tree's leaves ascend by doc_id (NULL first, equal ids by digest); while
    several nodes remain, each RUN consecutive ones become their SHA-256 (the last run may be shorter, even one node). The trees'
    roots, by name, form the upper tree likewise. A proof is the SHA-256 of the siblings, level by level, left to right; the folded
    root comes from `claimed` and those siblings.

    Nodes are ranked by one range sort, reduced by superblock, height by height (each 4,096 times smaller), and
    the outer nodes go back down the same way; so no task ever holds more than one superblock and its path,
    whichever tree is largest. An empty table gives no rows.
    """
    own = ranked(leaves, [F.col("doc_id"), F.col("node"), F.col("claimed")], "tree")
    heights = climb(written(own, "leaves"))
    roots = heights[-1].select(F.col("tree").alias("name"), "node")
    upper = climb(written(ranked(roots, [F.col("name")]).withColumn("tree", F.lit("")), "subroots"))
    none = F.array().cast("array<string>")
    outer = descend(upper, upper[-1].select("tree", "rank", none.alias("lefts"), none.alias("rights"), F.col("node").alias("top")))
    named_roots = upper[0].select("name", F.col("rank").alias("place"), F.col("node").alias("subroot"))
    outer = outer.withColumnRenamed("rank", "place").drop("tree").join(named_roots, "place")
    outer = written(outer.select(F.col("name").alias("tree"), F.lit(0).cast("long").alias("rank"), "lefts", "rights", "top", "subroot"), "paths")
    subroots = outer.select("tree", "subroot")
    if len(heights) > 1:
        outer = descend(heights[1:], outer.drop("subroot"))
    else:
        outer = outer.drop("subroot")
    outer = outer.join(subroots, "tree")
    return exchange(
        heights[0], outer, _prove, "doc_id long, node string, subroot string, top string, proof_sha256 string, folded_root string"
    )


def manifest(
    docs: DataFrame, fields: tuple[str, ...], tree_col: str = "lang", id_col: str = "doc_id",
    claimed: dict[str, Column] | None = None,
) -> DataFrame:
    """Per row `doc_id`, `leaf`, `subroot`, `root`, `proof_sha256`, `folded_root`, `verified`.

    A leaf is the digest of the row's `fields` (NULLs are marked, so a NULL and an empty text differ). `claimed` gives other
    values of some fields: what a holder of the row claims; `folded_root` is the root that follows from them, `verified` whether it is
    the dataset's. Trees are the values of `tree_col`, NULL is one of them. Repeated rows are leaves of their own. Columns
    outside `fields` do not count, whatever their names; an empty table gives no rows.
    """
    claims = [(claimed or {}).get(f, named(f)) for f in fields]
    leaves = docs.select(
        tree_name(named(tree_col)).alias("tree"), named(id_col).cast("long").alias("doc_id"),
        leaf(*[named(f) for f in fields]).alias("node"), leaf(*claims).alias("claimed"),
    )
    found = proofs(leaves)
    return found.select(
        "doc_id", F.col("node").alias("leaf"), "subroot", F.col("top").alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == F.col("top")).alias("verified"),
    )

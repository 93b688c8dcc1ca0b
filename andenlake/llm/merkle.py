"""A Merkle manifest of a dataset: digests of rows, sources and the whole, and proofs.

Every source is a tree over its rows' digests with 16 children to a node, and the roots
of the sources are the leaves of one more such tree. A tree is cut into aligned blocks
of four levels (4,096 leaves). A block keeps its nodes in van Emde Boas order: the
levels are divided in half, the upper half is laid out first and then each of the lower
subtrees, every one of them in the same order again. Where a node lies follows from
depth and index by arithmetic alone (``address``); building a block and fetching the
siblings on a path both go by it, and the nodes of one path lie close together at any
size of cache line, page or row group.

The roots of blocks are the leaves of the next blocks up, until one block is left, so no
task holds more than one block whatever the size of a source. Paths are handed down the
same way: a block passes to each block below it the siblings above that block.

Inputs: nulls are part of the digest in any column. Rows of a source go by ``doc_id``,
rows without one first, equal ids by their digest; equal rows are equal leaves, so their
order does not matter. Rows without a source are a source of their own, the first. A
single row is its own root; its proof is empty. An empty table gives no rows. Only
``doc_id``, ``source``, ``lang``, ``n_chars`` and ``text`` are read.
"""

from __future__ import annotations

import string
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from andenlake.llm.shared import stored, to_arrow
from andenlake.operators.numbering import dense_numbers

FAN = 16
#: Levels of a block, its leaves included, and the number of these.
LEVELS = 4
BLOCK = FAN ** (LEVELS - 1)
_DIGEST = "S64"

BLOCKS = ("tree long, block long, size long, levels int, nodes binary, root string, "
          "doc_id array<long>, shown array<string>")
#: Siblings above a block, ``above`` of which are above the root of its tree.
PATHS = "tree long, block long, left array<binary>, right array<binary>, above int"
PROOFS = ("doc_id long, leaf string, subroot string, root string, proof_sha256 string, "
          "folded_root string, verified boolean")


# ---- layout --------------------------------------------------------------------

def nodes_in(levels: int, fan: int = FAN) -> int:
    return (fan ** levels - 1) // (fan - 1)


def address(levels: int, depth: int, index, fan: int = FAN):
    """Where node ``index`` of ``depth`` (the root's is 0) lies in a tree of so many levels."""
    if levels == 1:
        return index * 0
    top = levels // 2
    if depth < top:
        return address(top, depth, index, fan)
    low, wide = levels - top, fan ** (depth - top)
    return (nodes_in(top, fan) + index // wide * nodes_in(low, fan)
            + address(low, depth - top, index % wide, fan))


def levels_for(size: int, fan: int = FAN, most: int = LEVELS) -> int:
    """Levels of a block in a tree of ``size`` leaves: all of them if it has several blocks."""
    levels = 1
    while levels < most and fan ** (levels - 1) < size:
        levels += 1
    return levels


def build(digests: np.ndarray, levels: int, fan: int = FAN) -> np.ndarray:
    """The block over these leaves; places behind the last leaf's are left out."""
    count = len(digests)
    nodes = np.zeros(int(address(levels, levels - 1, count - 1, fan)) + 1, _DIGEST)
    below = address(levels, levels - 1, np.arange(count), fan)
    nodes[below] = digests
    for depth in range(levels - 2, -1, -1):
        count = -(-count // fan)
        here = address(levels, depth, np.arange(count), fan)
        nodes[here] = [sha256(nodes[below[fan * k:fan * (k + 1)]].tobytes()).hexdigest()
                       for k in range(count)]
        below = here
    return nodes


def siblings(nodes: np.ndarray, levels: int, count: int, fan: int = FAN
             ) -> list[list[tuple[bytes, bytes]]]:
    """For every leaf, from its run up to the root's children: what stands left and right."""
    found: list[list[tuple[bytes, bytes]]] = [[] for _ in range(count)]
    wide = 1
    for depth in range(levels - 1, 0, -1):
        n = -(-count // wide)
        at = address(levels, depth, np.arange(n), fan)
        for first in range(0, n, fan):
            run = nodes[at[first:first + fan]].tobytes()
            for k in range(first, min(first + fan, n)):
                own = 64 * (k - first)
                pair = run[:own], run[own + 64:]
                for path in found[k * wide:(k + 1) * wide]:
                    path.append(pair)
        wide *= fan
    return found


def fold(leaf: bytes, path: list[tuple[bytes, bytes]]) -> bytes:
    """The root that a leaf and the siblings on its path give."""
    for left, right in path:
        leaf = sha256(left + leaf + right).hexdigest().encode()
    return leaf


# ---- leaves --------------------------------------------------------------------

def digest(**replaced: Column) -> Column:
    """Hex digest of a row: each field's byte count and value, ``-`` for a null."""
    fields = []
    for name in ("doc_id", "source", "lang", "n_chars", "text"):
        value = replaced.get(name, F.col(name)).cast("string")
        fields.append(F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"),
                                          value), F.lit("-")))
    return F.sha2(F.concat(*fields), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """source, doc_id, leaf, shown: the digest of a row, and of the row as it is checked, which
    for a fifth of the ids (by CRC-32) has its text lower-cased. ``tie`` tells equal rows apart."""
    altered = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    lower = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    return docs.select(
        F.col("source").cast("string").alias("source"),
        F.col("doc_id").cast("long").alias("doc_id"), digest().alias("leaf"),
        F.when(altered, digest(text=lower)).alias("altered"),
        F.monotonically_increasing_id().alias("tie"))


# ---- blocks --------------------------------------------------------------------

def grow(nodes: DataFrame, largest: int) -> list[DataFrame]:
    """Blocks of every level, the leaves' first. ``nodes``: tree, pos, size (leaves of the tree),
    digest, doc_id, shown. ``largest`` is the largest tree's size."""
    schema = to_arrow(nodes.sparkSession, BLOCKS)

    def work(key, rows):
        rows = rows.sort_by("pos")
        size = rows["size"][0].as_py()
        levels = levels_for(size)
        block = build(np.array(rows["digest"].to_pylist(), _DIGEST), levels)
        return pa.Table.from_pylist([{
            "tree": key[0].as_py(), "block": key[1].as_py(), "size": size, "levels": levels,
            "nodes": block.tobytes(), "root": block[0].decode(),
            "doc_id": rows["doc_id"].to_pylist(), "shown": rows["shown"].to_pylist(),
        }], schema=schema)

    found = []
    while True:
        block = F.floor(F.col("pos") / BLOCK).alias("block")
        found.append(stored(nodes.groupBy("tree", block).applyInArrow(work, BLOCKS), "blocks"))
        if largest <= BLOCK:
            return found
        largest = -(-largest // BLOCK)
        nodes = found[-1].filter(F.col("size") > BLOCK).select(
            "tree", F.col("block").alias("pos"), F.ceil(F.col("size") / BLOCK).alias("size"),
            F.col("root").alias("digest"), F.lit(None).cast("long").alias("doc_id"),
            F.lit(None).cast("string").alias("shown"))


def roots(levels: list[DataFrame]) -> DataFrame:
    """tree, root: of the one block that each tree ends in."""
    ends = [level.filter(F.col("size") <= BLOCK).select("tree", "root") for level in levels]
    top = ends[0]
    for more in ends[1:]:
        top = top.unionByName(more)
    return top


def _block(row: dict) -> tuple[list[bytes], list[list[tuple[bytes, bytes]]]]:
    """Leaves of a block, and the siblings of each up to the root of its tree."""
    nodes = np.frombuffer(row["nodes"], _DIGEST)
    levels, count = row["levels"], len(row["doc_id"])
    above = list(zip(row["left"], row["right"]))
    own = nodes[address(levels, levels - 1, np.arange(count))].tolist()
    return own, [path + above for path in siblings(nodes, levels, count)]


def _paths(found: list[tuple[int, int, list, int]], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_pylist([
        {"tree": tree, "block": block, "left": [p[0] for p in path],
         "right": [p[1] for p in path], "above": above}
        for tree, block, path, above in found], schema=schema)


def _rows(batches):
    for batch in batches:
        for k in range(batch.num_rows):
            yield batch.slice(k, 1).to_pylist()[0]


def descend(levels: list[DataFrame], tops: DataFrame) -> DataFrame:
    """Blocks of the lowest level with the siblings above them. ``tops``: as ``PATHS`` without
    ``block``, the siblings above the root of a tree."""
    schema = to_arrow(tops.sparkSession, PATHS)

    def children(batches):
        for row in _rows(batches):
            yield _paths([(row["tree"], row["block"] * BLOCK + k, path, row["above"])
                          for k, path in enumerate(_block(row)[1])], schema)

    below = None
    for level in reversed(levels):
        ends = level.filter(F.col("size") <= BLOCK).join(tops, "tree")
        if below is not None:
            ends = ends.unionByName(
                level.filter(F.col("size") > BLOCK).join(below, ["tree", "block"]))
        below = ends.mapInArrow(children, PATHS)
    return ends


def proofs(docs: DataFrame) -> DataFrame:
    """One row for each of ``docs``: its digest, roots, the digest of its proof, and the root
    that the row as checked folds to."""
    spark = docs.sparkSession
    numbered = dense_numbers(stored(leaves(docs), "leaves"), "number",
                             ["source", "doc_id", "leaf", "tie"])
    sources = dense_numbers(numbered.groupBy(F.col("source").alias("of")).agg(
        F.min("number").alias("first"), F.count("*").alias("size")), "tree", ["of"])
    count, largest = sources.agg(F.count("*"), F.max("size")).first()
    if not count:
        return spark.createDataFrame([], PROOFS)
    trees = grow(numbered.join(sources, F.col("source").eqNullSafe(F.col("of"))).select(
        "tree", (F.col("number") - F.col("first")).alias("pos"), "size",
        F.col("leaf").alias("digest"), "doc_id",
        F.coalesce("altered", "leaf").alias("shown")), largest)

    top = grow(roots(trees).select(
        F.lit(0).cast("long").alias("tree"), (F.col("tree") - 1).alias("pos"),
        F.lit(count).cast("long").alias("size"), F.col("root").alias("digest"),
        F.col("tree").alias("doc_id"), F.lit(None).cast("string").alias("shown")), count)
    root = top[-1].filter(F.col("size") <= BLOCK).first()["root"]
    start = spark.createDataFrame([(0, 0, [], [], 0)], PATHS).drop("block")
    paths_schema, schema = to_arrow(spark, PATHS), to_arrow(spark, PROOFS)

    def by_source(batches):
        for row in _rows(batches):
            yield _paths([(tree, 0, path, len(path)) for tree, path
                          in zip(row["doc_id"], _block(row)[1])], paths_schema)

    def by_row(batches):
        for row in _rows(batches):
            own, paths = _block(row)
            # The source's root: where the path within its tree ends.
            inside = len(paths[0]) - row["above"]
            out = {name: [] for name in schema.names}
            for doc, leaf, shown, path in zip(row["doc_id"], own, row["shown"], paths):
                told = sha256()
                for left, right in path:
                    told.update(left)
                    told.update(right)
                folded = fold(shown.encode(), path).decode()
                values = (doc, leaf.decode(), None, root, told.hexdigest(), folded, folded == root)
                for name, value in zip(schema.names, values):
                    out[name].append(value)
            subroot = fold(own[0], paths[0][:inside]).decode()
            yield pa.RecordBatch.from_pydict({**out, "subroot": [subroot] * len(own)},
                                             schema=schema)

    tops = stored(descend(top, start).mapInArrow(by_source, PATHS).drop("block"), "source-paths")
    return descend(trees, tops).mapInArrow(by_row, PROOFS)

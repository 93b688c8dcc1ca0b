"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most ``2 h`` bits apart share a word that lies within ``h``
bits of both, so every fingerprint stands for all its variants within ``h`` bits
and equal variants are links. A fingerprint of 64 bits has 2,081 variants for
``h = 2``; shipping each would be a hundred times the table. They are emitted in
two steps instead: before the shuffle a fingerprint emits only the *leading
bits* of its variants (with what is left of the flips), the shuffle is on those
bits, and the trailing flips are expanded in the task that holds the bucket.

Inputs: null text counts as empty, a text without words has fingerprint zero and
links like any other; a repeated row links to its copy; a null ``doc_id`` keeps
its fingerprint, takes no part in the smallest id, and its component is the
smallest id it reaches (null if none). Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from andenlake.llm.components import components
from andenlake.llm.shared import map_batches, stored, texts

SHINGLE_WORDS = 4
RADIUS = 4
SEED = 42
#: Distinct fingerprints a bucket should hold about; the number of leading bits follows from it.
BUCKET = 2048
#: Variants expanded at once inside a task.
EXPAND = 2_000_000
#: Parts of a bucket whose forests are kept before they are made one.
PARTS = 64


def fingerprint(utf8: bytes, words: int = SHINGLE_WORDS) -> int:
    """Majority bits of the XXH64 values (seed 42) of all word shingles."""
    import xxhash
    parts = utf8.lower().split()  # bytes: lower-cases A-Z, splits at ASCII white space
    if not parts:
        return 0
    n, h = max(1, len(parts) - words + 1), xxhash.xxh64_intdigest
    joined, size = b" ".join(parts), min(words, len(parts))
    at = np.cumsum([0] + [len(p) + 1 for p in parts]).tolist()
    values = np.array([h(joined[a:b - 1], SEED) for a, b in zip(at[:n], at[size:])], "<u8")
    ones = np.zeros(64, "i8")
    for i in range(0, n, 4096):
        bits = np.unpackbits(values[i:i + 4096].view("u1").reshape(-1, 8), axis=1,
                             bitorder="little")
        ones += bits.sum(0, dtype="i8")
    return int((np.uint64(1) << np.flatnonzero(2 * ones > n).astype("u8")).sum(dtype="u8"))


def fingerprints(docs: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, key (hash of the text), fp (the 64 bits as a signed long)."""
    def work(rows):
        values = np.array([fingerprint(t, words) for t in rows["utf8"]], "u8")
        return {"doc_id": rows["doc_id"], "key": rows["key"], "fp": pa.array(values.view("i8"))}

    return map_batches(texts(docs, text_key(F.col("text")).alias("key")), work,
                       "doc_id long, key long, fp long")


def text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text.cast("binary"), F.lit(b"")))


def leading_bits(fps: DataFrame, bits: int, flips: int) -> DataFrame:
    """Each fingerprint with the leading bits of its variants and the flips left."""
    masks = [(0, 0)]
    for i in range(bits):
        masks += [(m | 1 << i, n + 1) for m, n in masks if n < flips]
    table = F.array(*[F.struct(F.lit(m).cast("long").alias("m"), F.lit(flips - n).alias("left"))
                      for m, n in masks])
    head = F.shiftrightunsigned("fp", 64 - bits) if bits else F.lit(0).cast("long")
    return (fps.select("fp", F.explode(table).alias("x"))
            .select(head.bitwiseXOR(F.col("x.m")).alias("bucket"), "fp", "x.left"))


def bucket_links(fp: np.ndarray, left: np.ndarray, bit: int, radius: int, out: list) -> None:
    """Adds to ``out`` what connects fingerprints whose variants agree above ``bit``.

    ``fp`` holds the original words, ``left`` their remaining flips at bits below
    ``bit``. Large sets are first divided by the value of the next bit: keeping it
    is free, flipping it takes one of the flips left. Each part is verified and reduced to
    its forest at once, and so are many parts together, so a dense ball of fingerprints
    never has its pairs in memory."""
    if len(fp) < 2:
        return
    per = 1 + bit + bit * (bit - 1) // 2
    if bit and len(fp) * per > EXPAND and len(fp) > 64:
        one = (fp >> np.uint64(bit - 1)) & np.uint64(1) == 1
        for side in (one, ~one):
            take = side | (left > 0)
            bucket_links(fp[take], left[take] - ~side[take], bit - 1, radius, out)
        return
    low = np.uint64((1 << bit) - 1)
    owners, variants = [], []
    index = np.arange(len(fp))
    for flips in range(int(left.max()) + 1):
        masks = _masks(bit, flips)
        who = index[left >= flips]
        variants.append((fp[who, None] & low ^ masks[None]).ravel())
        owners.append(np.repeat(who, len(masks)))
    variant, owner = np.concatenate(variants), np.concatenate(owners)
    order = np.argsort(variant, kind="stable")
    variant, owner = variant[order], owner[order]
    same = np.flatnonzero(variant[1:] == variant[:-1])
    pairs = fp[np.unique(np.stack([owner[same], owner[same + 1]], 1), axis=0)]
    apart = np.unpackbits((pairs[:, 0] ^ pairs[:, 1]).view("u1").reshape(-1, 8), axis=1).sum(1)
    out.append(forest(pairs[apart <= radius]))
    if len(out) == PARTS:
        out[:] = [forest(np.concatenate(out))]


def _masks(bits: int, flips: int) -> np.ndarray:
    one = np.uint64(1) << np.arange(bits, dtype="u8")
    if flips == 0:
        return np.zeros(1, "u8")
    if flips == 1:
        return one
    i, j = np.triu_indices(bits, 1)
    return one[i] | one[j]


def forest(pairs: np.ndarray) -> np.ndarray:
    """A spanning forest of the pairs: each word with the smallest it is connected to."""
    nodes, flat = np.unique(pairs, return_inverse=True)
    a, b = flat.reshape(-1, 2).T
    root = np.arange(len(nodes))
    while True:
        low = root.copy()
        np.minimum.at(low, a, root[b])
        np.minimum.at(low, b, root[a])
        np.minimum.at(low, root, low[np.arange(len(root))].copy())
        low = low[low]
        if (low == root).all():
            break
        root = low
    moved = root != np.arange(len(nodes))
    return np.stack([nodes[moved], nodes[root[moved]]], 1)


def links(fps: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """a, b: links between distinct fingerprints, at most one per fingerprint and bucket.

    Two words that share a variant are within ``radius`` bits; each pair is still
    verified. Words of one bucket that are connected there are linked to the
    smallest of them, so no group is expanded into all its pairs. Connectivity is
    that of all pairs within the radius."""
    if radius % 2 or radius > 4:
        raise ValueError("radius must be 0, 2 or 4")
    half = radius // 2
    bits = min(24, max(0, -(-fps.count() // bucket) - 1).bit_length())

    def expand(frames):
        for frame in frames:
            found: list = []
            fp = frame["fp"].to_numpy().view("u8")
            bucket_links(fp, frame["left"].to_numpy().astype("i8"), 64 - bits, radius, found)
            tree = forest(np.concatenate(found) if found else np.empty((0, 2), "u8"))
            yield frame.iloc[:0].assign(a=[], b=[])[["a", "b"]] if not len(tree) else _frame(tree)

    def per_bucket(frame):
        return next(expand([frame]))

    return (leading_bits(fps, bits, half).groupBy("bucket")
            .applyInPandas(per_bucket, "a long, b long"))


def _frame(tree: np.ndarray):
    import pandas as pd
    return pd.DataFrame({"a": tree[:, 0].view("i8"), "b": tree[:, 1].view("i8")})


def grouped(marked: DataFrame, radius: int = RADIUS) -> DataFrame:
    """fp, root (the same for all fingerprints of a group), first (smallest doc_id)."""
    classes = stored(marked.groupBy("fp").agg(F.min("doc_id").alias("first")), "classes")
    groups = components(links(classes.select("fp"), radius), "a", "b")
    return classes.join(groups, classes.fp == groups.node, "left").select(
        "fp", F.coalesce("root", "fp").alias("root"), "first")


def near_duplicates(docs: DataFrame, radius: int = RADIUS,
                    words: int = SHINGLE_WORDS) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id: smallest doc_id reachable over
    links of ``radius`` or fewer differing bits, itself included."""
    marked = stored(fingerprints(docs, words), "fingerprints")
    placed = grouped(marked, radius)
    smallest = placed.groupBy("root").agg(F.min("first").alias("component_id"))
    member = stored(placed.join(smallest, "root").select("fp", "component_id"), "members")
    return marked.join(member, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def first_of_groups(docs: DataFrame, radius: int = RADIUS,
                    words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of ``docs`` for each group: the smallest id, rows without id last, then the
    smallest text hash. Of rows equal in id and text one stays. Columns of any name pass on."""
    marked = stored(fingerprints(docs, words), "fingerprints")
    placed = stored(grouped(marked, radius).select("fp", "root"), "members")
    order = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "key")
    chosen = stored(marked.join(placed, "fp").groupBy("root").agg(F.min(order).alias("at"))
                    .select(F.col("at.doc_id").alias("first"), F.col("at.key").alias("of")),
                    "chosen")
    row = F.col("row")
    rows = docs.select(F.struct("*").alias("row"), F.col("doc_id").cast("long").alias("id"),
                       text_key(F.col("text")).alias("key"))
    kept = rows.join(chosen, (F.col("key") == F.col("of"))
                     & F.col("id").eqNullSafe(F.col("first")), "left_semi")
    return kept.dropDuplicates(["id", "key"]).select(row).select("row.*")

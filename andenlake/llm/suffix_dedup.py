"""Removal of long repeated byte strings, with a logarithmic family of suffix arrays.

A string of ``LENGTH`` bytes is found again by one suffix inside it: the one whose
first ``HEAD`` bytes have the smallest hash (equal strings choose the same). Each
batch of documents gets a sparse suffix array of those suffixes, ordered by the
hash of the head. It is merge-scanned against the arrays of the existing levels;
heads that occur in both, or twice in the batch, may lie in long matches. Levels
of equal size are then merged, so there are logarithmically many.

For those heads alone the text around the suffix is fetched. Texts around the same
head are aligned there, and the suffix array of every column is derived from that of
the column to its right by one stable sort, with the common prefix of neighbours.
A window that shares ``LENGTH`` bytes with a neighbour occurs elsewhere. Bytes
are compared throughout; hashes only bring texts together.

Copies of the same surroundings are one entry with a count. Heads with more than
``GROUP`` different surroundings are cut into narrower runs of windows, which are
told apart by the bytes that all windows of a run share, down to single windows.

Inputs: null text counts as empty; texts shorter than ``LENGTH`` bytes lose
nothing; matches never cross texts. Every row is a document of its own, repeated
rows and null ids included. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from andenlake.llm.shared import map_batches, stored, texts

LENGTH = 400
HEAD = 64
#: Batches that a table is indexed in.
BATCHES = 4
#: Different surroundings of a head that are aligned at once, and rows aligned together.
GROUP = 20_000
ALIGN = 4000
_BASE = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_PLACE = np.uint64((1 << 31) - 1)


class Heads:
    """Hashes of all substrings of a fixed length; powers are kept for the longest text seen."""

    def __init__(self):
        self.letters = np.random.default_rng(5).integers(1, 2**64, 256, dtype="u8")
        self.power = self.inverse = np.ones(1, "u8")

    def __call__(self, raw: bytes, length: int) -> np.ndarray:
        n = len(raw)
        if len(self.power) < n:
            size = max(n, 1 << 16)
            self.power, self.inverse = (np.cumprod(np.full(size, b, "u8"), dtype="u8") * by
                                        for b, by in ((_BASE, _INVERSE), (_INVERSE, _BASE)))
        total = np.zeros(n + 1, "u8")
        np.cumsum(self.letters[np.frombuffer(raw, "u1")] * self.power[:n], out=total[1:])
        value = (total[length:] - total[:n - length + 1]) * self.inverse[:n - length + 1]
        value ^= value >> np.uint64(32)
        value *= np.uint64(0xD6E8FEB86659FD93)
        return value ^ value >> np.uint64(32)


def window_minimum(value: np.ndarray, width: int) -> np.ndarray:
    """Minimum of each ``width`` neighbours: of a block's end and the next one's beginning."""
    n = len(value)
    full = np.full(-(-n // width) * width, np.iinfo("u8").max, "u8")
    full[:n] = value
    grid = full.reshape(-1, width)
    begin = np.minimum.accumulate(grid, 1).ravel()
    end = np.minimum.accumulate(grid[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(end[:n - width + 1], begin[width - 1:n])


def suffixes(raw: bytes, heads: Heads, length: int = LENGTH, head: int = HEAD):
    """The chosen suffixes of a text and the windows each stands for.

    Returns (key, at, low, n), arrays: key is the hash of the head at ``at``; the
    windows that chose it begin at ``at - low`` and the ``n - 1`` places after; and
    spans known to repeat. In a stretch with a short period each period would choose
    anew; windows equal to those one period before are spans, and only the first
    period is indexed."""
    if len(raw) < length:
        return None, []
    hashed = heads(raw, head)
    placed = (hashed & ~_PLACE) | np.arange(len(hashed), dtype="u8")
    chosen = (window_minimum(placed, length - head + 1) & _PLACE).astype("i8")
    first = np.flatnonzero(np.diff(chosen, prepend=-1))
    at, n = chosen[first], np.diff(first, append=len(chosen))
    key = hashed[at]
    keep, spans = np.ones(len(at), bool), []
    for k in np.flatnonzero(key[1:] == key[:-1]) + 1:
        lag, a, b = int(at[k] - at[k - 1]), int(first[k]), int(first[k] + n[k] - 1 + length)
        if a >= lag and raw[a:b] == raw[a - lag:b - lag]:
            keep[k] = False
            spans.append((a - lag, b))
    return (key[keep].view("i8"), at[keep], (at - first)[keep], n[keep]), spans


def suffix_array(docs: DataFrame, length: int = LENGTH, head: int = HEAD) -> DataFrame:
    """key, doc_id, body, at, low, n: the chosen suffixes of all texts. Rows without key are
    spans of ``n`` bytes from ``at`` that repeat inside their text. ``body`` is a hash of
    the text, which tells documents with the same id apart."""
    def work(rows, heads):
        out: dict[str, list] = {k: [] for k in ("key", "doc", "at", "low", "n")}
        for k, raw in enumerate(rows["utf8"]):
            found, spans = suffixes(raw, heads, length, head)
            if found:
                for name, column in zip(("key", "at", "low", "n"), found):
                    out[name] += column.tolist()
                out["doc"] += [k] * len(found[0])
            for a, b in spans:
                for name, value in zip(out, (None, k, a, 0, b - a)):
                    out[name].append(value)
        doc = out.pop("doc")
        return {**out, "doc_id": [rows["doc_id"][k] for k in doc],
                "body": [rows["body"][k] for k in doc]}

    return map_batches(texts(docs, F.xxhash64("text").alias("body")), work,
                       "key long, at long, low long, n long, doc_id long, body long", Heads)


class Family:
    """Suffix arrays of the batches added so far, as levels whose sizes are powers of two.

    Levels hold key and number of suffixes; ``add`` returns the keys for which the new
    batch brings a second suffix."""

    def __init__(self):
        self.levels: list[tuple[int, DataFrame]] = []

    def add(self, batch: DataFrame) -> DataFrame:
        new = stored(batch.groupBy("key").agg(F.count("*").alias("n"))
                     .sortWithinPartitions("key"), "level")
        again = new.filter("n > 1").select("key")
        for _, level in self.levels:
            again = again.union(new.join(level, "key").select("key"))
        again = stored(again.distinct(), "again")
        size = 1
        while self.levels and self.levels[-1][0] == size:
            _, last = self.levels.pop()
            new = stored(new.union(last).groupBy("key").agg(F.sum("n").alias("n"))
                         .sortWithinPartitions("key"), "level")
            size *= 2
        self.levels.append((size, new))
        return again


def surroundings(docs: DataFrame, chosen: DataFrame, length: int = LENGTH) -> DataFrame:
    """key, low, region and the place of the region's first byte, for chosen suffixes.
    The region holds all windows of the suffix. Rows equal in id and text have the same
    suffixes: those are gathered once, and each row brings its own regions."""
    marks = chosen.groupBy("doc_id", "body").agg(
        F.collect_set(F.struct("key", "at", "low", "n")).alias("marks"))
    held = _joined(docs, marks)

    def cut(rows):
        import zstandard
        raw = zstandard.ZstdDecompressor().decompress
        out: dict[str, list] = {k: [] for k in ("key", "low", "region", "start", "doc")}
        for k, (packed, marks) in enumerate(zip(rows["packed"], rows["marks"])):
            text = raw(packed)
            for m in marks:
                start = m["at"] - m["low"]
                for name, value in zip(out, (m["key"], m["low"],
                                             text[start:start + m["n"] - 1 + length], start, k)):
                    out[name].append(value)
        doc = out.pop("doc")
        return {**out, "doc_id": [rows["doc_id"][k] for k in doc],
                "body": [rows["body"][k] for k in doc]}

    return map_batches(held, cut, "key long, low long, region binary, start long,"
                       " doc_id long, body long")


def _joined(docs: DataFrame, other: DataFrame, how: str = "inner") -> DataFrame:
    """Documents (text compressed before it is shuffled) with what ``other`` has for them."""
    def squeeze(rows):
        import zstandard
        pack = zstandard.ZstdCompressor(3).compress
        return {"id": rows["doc_id"], "hash": rows["body"],
                "packed": [pack(t) for t in rows["utf8"]]}

    packed = map_batches(texts(docs, F.xxhash64("text").alias("body")), squeeze,
                         "id long, hash long, packed binary")
    same = packed["id"].eqNullSafe(other["doc_id"]) & (packed["hash"] == other["body"])
    return packed.join(other, same, how).drop("doc_id", "body").withColumnsRenamed(
        {"id": "doc_id", "hash": "body"})


def aligned(regions: list[bytes], low: np.ndarray, group: np.ndarray, count: np.ndarray,
            length: int = LENGTH) -> np.ndarray:
    """Which windows of each region occur in another region of its group, at the same place
    relative to the head (or in a copy of the region, if its count says so).

    Row r, column c: the window that begins at byte c of region r. Goes from right to
    left; ``order`` is the suffix array of the column, groups apart, and ``common`` the
    common prefix of each suffix with the one before it."""
    rows, size = len(regions), np.array([len(r) for r in regions])
    begin = low.max() - low
    width = int((begin + size).max())
    grid = np.full((width, rows), -1, "i2")
    for r, region in enumerate(regions):
        grid[begin[r]:begin[r] + size[r], r] = np.frombuffer(region, "u1")
    order = np.argsort(group, kind="stable")
    common = np.zeros(rows + 1, "i4")
    found = np.zeros((width, rows), bool)
    rank = np.unique(group, return_inverse=True)[1].astype("i4") * 512
    for c in range(width - 1, -1, -1):
        byte = grid[c][order]
        sort = np.argsort(rank[order] + byte, kind="stable")
        order = order[sort]
        byte = byte[sort]
        same = (rank[order[1:]] == rank[order[:-1]]) & (byte[1:] == byte[:-1]) & (byte[1:] >= 0)
        a, b = sort[:-1] + 1, sort[1:] + 1
        shared = common[b - 1]
        far = np.flatnonzero(same & (b - a > 1))
        if len(far):
            pairs = np.stack([a[far], b[far]], 1).ravel()
            shared[far] = np.minimum.reduceat(common, pairs)[::2]
        common = np.zeros(rows + 1, "i4")
        common[1:-1] = np.where(same, shared + 1, 0)
        long = common >= length
        found[c, order] = long[:-1] | long[1:]
    out = np.zeros((rows, width), bool)
    for r in range(rows):
        n = size[r] - length + 1
        out[r, :n] = True if count[r] > 1 else found[begin[r]:begin[r] + n, r]
    return out


def repeated(regions: DataFrame, length: int = LENGTH, group: int = GROUP) -> DataFrame:
    """start, n, doc_id, body: spans of the texts that occur elsewhere."""
    spans, width = None, None
    while True:
        rows = stored(regions.withColumn("copy", F.md5("region")), "regions")
        classes = rows.groupBy("key", "low", "copy").agg(
            F.first("region").alias("region"), F.count("*").alias("n"))
        classes = stored(classes, "classes")
        sizes = classes.groupBy("key").agg(F.count("*").alias("many"))
        large = stored(sizes.filter(F.col("many") > group).select("key"), "large")
        small = classes.join(large, "key", "left_anti")
        found = stored(_windows(small, length), "windows")
        part = rows.join(found, ["key", "low", "copy"]).select(
            (F.col("start") + F.col("from")).alias("start"), "n", "doc_id", "body")
        spans = part if spans is None else spans.union(part)
        if large.isEmpty():
            return spans
        width = max(1, width // 4) if width else 64
        regions = narrower(rows.join(large, "key").drop("copy"), width, length)


def narrower(rows: DataFrame, width: int, length: int = LENGTH) -> DataFrame:
    """Regions cut into runs of at most ``width`` windows (places counted from the head), with
    a key of their own made of the bytes that all windows of such a run share."""
    def work(batch):
        import xxhash
        out: dict[str, list] = {k: [] for k in batch}
        for row in zip(*batch.values()):
            row = dict(zip(batch, row))
            low, region = row["low"], row["region"]
            n = len(region) - length + 1
            for block in range(-low // width, (n - 1 - low) // width + 1):
                a, b = max(block * width + low, 0), min((block + 1) * width + low, n)
                core = region[(block + 1) * width + low - 1:block * width + low + length]
                key = xxhash.xxh64_intdigest(core, (row["key"] ^ block) & (1 << 64) - 1)
                piece = {**row, "key": key - (key >> 63 << 64), "low": low - a,
                         "region": region[a:b - 1 + length], "start": row["start"] + a}
                for name, value in piece.items():
                    out[name].append(value)
        return out

    return map_batches(rows, work, "key long, low long, region binary, start long,"
                       " doc_id long, body long")


def _windows(classes: DataFrame, length: int) -> DataFrame:
    """key, low, copy, from, n: repeated spans of each class, relative to its region."""
    schema = pa.schema([("key", pa.int64()), ("low", pa.int64()), ("copy", pa.string()),
                        ("from", pa.int64()), ("n", pa.int64())])

    def spans(rows: pd.DataFrame) -> pa.RecordBatch:
        hit = aligned(rows["region"].tolist(), rows["low"].to_numpy(), rows["key"].to_numpy(),
                      rows["n"].to_numpy(), length)
        edge = np.diff(hit.astype("i1"), axis=1, prepend=0, append=0)
        row, a = np.nonzero(edge == 1)
        b = np.nonzero(edge == -1)[1]
        return pa.RecordBatch.from_arrays(
            [pa.array(rows[k].to_numpy()[row]) for k in ("key", "low")]
            + [pa.array(rows["copy"].to_numpy()[row], pa.string()), pa.array(a),
               pa.array(b - a - 1 + length)], schema=schema)

    def run(batches):
        """Whole keys, about ALIGN rows at a time; a key's rows are next to each other."""
        rest = None
        for batch in batches:
            rows = batch.to_pandas()
            rows = rows if rest is None else pd.concat([rest, rows], ignore_index=True)
            last = int(np.searchsorted(rows["key"].to_numpy(), rows["key"].iloc[-1])) \
                if len(rows) else 0
            if last < ALIGN:
                rest = rows
                continue
            rest = rows.iloc[last:]
            yield from cut(rows.iloc[:last])
        if rest is not None and len(rest):
            yield from cut(rest)

    def cut(rows):
        keys = rows["key"].to_numpy()
        at = 0
        while at < len(rows):
            end = at + ALIGN
            end = len(rows) if end >= len(rows) else int(np.searchsorted(keys, keys[end]))
            if end <= at:
                end = int(np.searchsorted(keys, keys[at], "right"))
            yield spans(rows.iloc[at:end])
            at = end

    return classes.repartition("key").sortWithinPartitions("key").mapInArrow(
        run, "key long, low long, copy string, from long, n long")


def spans(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """doc_id, body, start, n: repeated spans of all texts (they may overlap)."""
    every = stored(suffix_array(docs, length, min(HEAD, length)).withColumn(
        "batch", F.pmod(F.xxhash64("doc_id", "body"), F.lit(batches)).cast("int")), "suffixes")
    family, again = Family(), None
    for k in range(batches):
        keys = family.add(every.filter((F.col("batch") == k) & F.col("key").isNotNull()))
        again = keys if again is None else again.union(keys)
    chosen = every.join(again.distinct(), "key", "left_semi")
    direct = every.filter("key is null").select(F.col("at").alias("start"), "n", "doc_id", "body")
    return repeated(surroundings(docs, chosen, length), length).unionByName(direct)


def remove(docs: DataFrame, length: int = LENGTH, batches: int = BATCHES) -> DataFrame:
    """doc_id, kept (bytes), n_bytes, n_removed, n_spans for each row of ``docs``."""
    def keep(rows):
        import zstandard
        raw = zstandard.ZstdDecompressor().decompress
        out: dict[str, list] = {k: [] for k in ("kept", "n_bytes", "n_removed", "n_spans")}
        for packed, found in zip(rows["packed"], rows["spans"]):
            text = raw(packed)
            kept, runs = without(text, [(s["start"], s["n"]) for s in found or []])
            for name, value in zip(out, (kept, len(text), len(text) - len(kept), runs)):
                out[name].append(value)
        return {"doc_id": rows["doc_id"], **out}

    found = spans(docs, length, batches).groupBy("doc_id", "body").agg(
        F.collect_set(F.struct("start", "n")).alias("spans"))
    return map_batches(_joined(docs, found, "left"), keep, "doc_id long, kept binary,"
                       " n_bytes long, n_removed long, n_spans long")


def without(text: bytes, spans: list[tuple[int, int]]) -> tuple[bytes, int]:
    """``text`` without the union of the spans, and the number of maximal runs removed."""
    out, at, runs, end = [], 0, 0, -1
    for start, n in sorted(spans):
        if start > end:
            runs += 1
        if start > at:
            out.append(text[at:start])
        at = end = max(end, start + n)
    return b"".join(out) + text[max(at, 0):], runs


def digests(kept: DataFrame) -> DataFrame:
    return kept.select("doc_id", "n_bytes", "n_removed", "n_spans",
                       F.sha2("kept", 256).alias("kept_sha256"))

"""Packing tokenised documents into sequences by a configuration linear program.

A configuration is a multiset of lengths that fits one sequence. The program
"fewest sequences such that every length is covered as often as it occurs" is
over the length histogram, which has at most ``capacity`` entries whatever the
size of the corpus. It is solved by multiplicative weights: lengths that are
still under-covered gain weight, a knapsack dynamic program finds the heaviest
configuration, and the average of those found is the fractional solution. It is
rounded down; what is left over is filled best-fit. Only the histogram reaches
the driver. Pieces find their place by their rank among pieces of equal length.

Inputs: null and empty texts are one piece (the end id alone). Repeated rows are
packed each. A null ``doc_id`` is carried along. An empty table gives no rows.
Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from andenlake.llm.bpe_words import chunk_table
from andenlake.llm.shared import map_batches, stored, texts, tokenizer_path

CAPACITY = 4096
END_ID = 1
#: Rounds of multiplicative weights.
ROUNDS = 400
#: Tokens in a step of the knapsack program, and how sharply weights follow the lag.
UNIT = 16
EAGER = 4.0

PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def pieces(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
           end_id: int = END_ID) -> DataFrame:
    """Token ids of each document plus ``end_id``, cut only where longer than ``capacity``."""
    path = tokenizer or tokenizer_path()
    end = np.array([end_id], "<u4").tobytes()

    def work(rows, table):
        out = {k: [] for k in ("doc_id", "piece", "start", "length", "ids_crc32")}
        for doc, utf8 in zip(rows["doc_id"], rows["utf8"]):
            ids = table.encode(utf8.decode()) + end
            for k, at in enumerate(range(0, len(ids), 4 * capacity)):
                part = ids[at:at + 4 * capacity]
                for name, value in zip(out, (doc, k, at // 4, len(part) // 4, zlib.crc32(part))):
                    out[name].append(value)
        return {**out, "piece": pa.array(out["piece"], pa.int32())}

    return map_batches(texts(docs), work, PIECES, lambda: chunk_table(path))


def best_configuration(value: np.ndarray, most: np.ndarray, unit: int = UNIT) -> np.ndarray:
    """The knapsack program: sizes of a configuration of (nearly) largest total value.

    ``value[i]`` is the worth of length ``i + 1`` and ``most[i]`` how often it may be
    used. The dynamic program runs over the capacity in steps of ``unit`` tokens with
    lengths rounded up to it, so what it finds fits; of the lengths of one step it
    takes the one worth most. The room that rounding left is then filled exactly, by
    the longest lengths that still fit."""
    capacity = len(value)
    steps = -(-capacity // unit)
    padded = np.zeros(steps * unit)
    padded[:capacity] = np.where(most > 0, value, 0)
    grid = padded.reshape(steps, unit)
    pick = grid.argmax(1)
    worth = grid[np.arange(steps), pick]
    kinds = np.flatnonzero(worth > 0)
    sizes, worth = kinds * unit + pick[kinds] + 1, worth[kinds]
    best, choice = np.zeros(steps + 1), np.zeros(steps + 1, "i8")
    ends = np.searchsorted(kinds + 1, np.arange(steps + 1), "right")
    for c in range(1, steps + 1):
        best[c], choice[c] = best[c - 1], -1
        if ends[c]:
            got = best[c - 1 - kinds[:ends[c]]] + worth[:ends[c]]
            k = int(got.argmax())
            if got[k] > best[c]:
                best[c], choice[c] = got[k], k
    use = np.zeros(capacity, "i8")
    c, room = steps, capacity
    while c > 0:
        k = choice[c]
        if k < 0:
            c -= 1
            continue
        size = int(sizes[k])
        c -= int(kinds[k]) + 1
        if use[size - 1] < most[size - 1] and size <= room:
            use[size - 1] += 1
            room -= size
    live = np.flatnonzero(most > 0) + 1
    at = len(live)
    while True:
        at = min(at, int(np.searchsorted(live, room, "right"))) - 1
        if at < 0:
            return use
        size = int(live[at])
        n = min(int(most[size - 1] - use[size - 1]), room // size)
        use[size - 1] += n
        room -= n * size


def fractional(counts: np.ndarray, rounds: int = ROUNDS) -> tuple[list[np.ndarray], np.ndarray]:
    """Configurations and how often each is used, covering every count.

    A length is worth its share of the capacity (the dual solution where packing is
    tight) times a weight that grows while it is covered less than its turn and falls
    while it is covered more. Each round uses the best configuration for at most
    ``1 / rounds`` of all sequences, or until one of its lengths is used up; so there
    are at most ``rounds`` plus the number of lengths of them."""
    capacity = len(counts)
    need = counts.astype("f8")
    share = np.arange(1, capacity + 1) / capacity
    total = float((need * share).sum())
    step = max(total / rounds, 1e-9)
    rest, done, found = need.copy(), 0.0, []
    while (rest > 1e-6).any():
        lag = np.minimum(done / total, 1) - (1 - rest / np.maximum(need, 1e-9))
        value = np.where(rest > 1e-6, share * np.exp(EAGER * lag.clip(-1, 1)), 0)
        use = best_configuration(value, np.where(rest > 1e-6, np.ceil(rest / step), 0))
        on = use > 0
        times = min(step, float((rest[on] / use[on]).min()))
        rest[on] -= times * use[on]
        done += times
        found.append((use, times))
    return [u for u, _ in found], np.array([t for _, t in found])


def plan(counts: np.ndarray, rounds: int = ROUNDS) -> pd.DataFrame:
    """Slots for every piece: length, first rank, number of ranks, first sequence, offset.

    Row (length, rank, n, sequence, offset): pieces of this length with ranks from
    ``rank`` to ``rank + n - 1`` go to sequences from ``sequence`` on, one each, at
    ``offset``. There are at most as many rows as rounds times lengths of a
    configuration, plus those of the left-over."""
    capacity = len(counts)
    left, rows, sequence = counts.astype("i8").copy(), [], 0
    given = np.zeros(capacity, "i8")

    def emit(use: np.ndarray, times: int) -> None:
        nonlocal sequence
        offset = 0
        for size in (np.flatnonzero(use) + 1)[::-1]:
            for _ in range(int(use[size - 1])):
                rows.append((int(size), int(given[size - 1]), times, sequence, offset))
                given[size - 1] += times
                offset += int(size)
        sequence += times

    used, times = fractional(counts, rounds)
    for use, n in zip(used, np.floor(times + 1e-6).astype("i8")):
        on = use > 0
        n = min(int(n), int((left[on] // use[on]).min()))
        if n:
            left -= n * use
            emit(use, n)
    for sizes in best_fit(left):
        emit(np.bincount(np.array(sizes) - 1, minlength=capacity), 1)
    return pd.DataFrame(rows, columns=["length", "rank", "n", "sequence", "offset"])


def best_fit(left: np.ndarray) -> list[list[int]]:
    """What rounding left over, longest first, each into the fullest sequence it fits."""
    capacity = len(left)
    bins: list[list[int]] = []
    room: list[tuple[int, int]] = []
    for size in (np.flatnonzero(left)[::-1] + 1).tolist():
        for _ in range(int(left[size - 1])):
            at = bisect_left(room, (size, -1))
            if at == len(room):
                bins.append([])
                free, b = capacity, len(bins) - 1
            else:
                free, b = room.pop(at)
            bins[b].append(size)
            insort(room, (free - size, b))
    return bins


def ranked(parts: DataFrame) -> DataFrame:
    """Adds ``rank`` from 0 among pieces of equal length.

    A length may hold a third of all rows, so ranks are counted inside the pieces'
    stored chunks (hash of the document, fixed number of rows on average) and
    shifted by the sizes of earlier chunks."""
    chunks = max(1, parts.count() // 20_000)
    spread = parts.withColumn("chunk", F.pmod(
        F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(chunks)))
    sizes = spread.groupBy("length", "chunk").agg(F.count("*").alias("size"))
    before = Window.partitionBy("length").orderBy("chunk").rowsBetween(
        Window.unboundedPreceding, -1)
    starts = sizes.select("length", "chunk",
                          F.coalesce(F.sum("size").over(before), F.lit(0)).alias("first"))
    inside = Window.partitionBy("chunk", "length").orderBy("doc_id", "piece", "ids_crc32")
    return (spread.withColumn("__n", F.row_number().over(inside) - 1)
            .join(starts, ["chunk", "length"])
            .withColumn("rank", F.col("first") + F.col("__n")).drop("chunk", "__n", "first"))


def pack(docs: DataFrame, tokenizer: str | None = None, capacity: int = CAPACITY,
         end_id: int = END_ID, rounds: int = ROUNDS) -> DataFrame:
    """One row per piece with sequence_id and offset; sequences are gapless from 0."""
    parts = stored(pieces(docs, tokenizer, capacity, end_id), "pieces")
    counts = np.zeros(capacity, "i8")
    for length, n in parts.groupBy("length").count().collect():  # at most ``capacity`` rows
        counts[length - 1] = n
    slots = plan(counts, rounds)

    def place(frames):
        by_length = {k: g.to_numpy().T for k, g in slots.groupby("length")}
        for frame in frames:
            sequence, offset = np.zeros(len(frame), "i8"), np.zeros(len(frame), "i8")
            for length, index in frame.groupby("length").indices.items():
                _, first, _, start, at = by_length[length]
                rank = frame["rank"].to_numpy()[index]
                k = np.searchsorted(first, rank, "right") - 1
                sequence[index], offset[index] = start[k] + rank - first[k], at[k]
            yield frame.drop(columns="rank").assign(sequence_id=sequence, offset=offset)

    return ranked(parts).select("doc_id", "piece", "start", "length", "ids_crc32", "rank") \
        .mapInPandas(place, f"{PIECES}, sequence_id long, offset long")

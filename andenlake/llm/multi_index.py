"""Nearest neighbours by an inverted multi-index.

A vector's two halves are quantised separately, so ``K`` centroids each make
``K * K`` cells. For a query, pairs of centroids are visited in the order of
their summed inner product with the two halves, by a heap over the two sorted
lists, until the visited cells hold ``share`` of all distinct vectors, and one
more than a query can return (all, if there are fewer); only their entries count.
Vectors without structure need a large share (README), so every pair of a query
and an entry is multiplied, in blocks that keep it out of memory, and the visited
cells are applied as a mask. What may be among the nearest is then scored exactly.

Equal vectors are one entry that carries its smallest ids: never more than a
query can return, so nothing is lost and a very common vector costs one entry.

Inputs: null, zero, and non-finite vectors, or those with null components, take
no part, nor do vectors of another length than the most common one (ties: the
shortest) and rows without id. Ties in the score go to the smaller id. Repeated
rows count once. A table without vectors gives no rows. Only ``vec_id`` and
``embedding`` are read. The centroids are fitted on about ``SAMPLE`` vectors
chosen by a hash of the id; every vector is indexed.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from andenlake.llm.shared import stored

CENTROIDS = 64
SAMPLE = 20_000
#: Part of the distinct vectors that the visited cells of a query must hold.
SHARE = 0.55
NEAREST = 20
#: Entries and queries of one block.
ENTRIES = 4096
QUERIES = 2048
LOWEST = -np.finfo("f8").max


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, v (array of double) of the rows that take part."""
    parts = F.transform("embedding", lambda x: x.cast("double"))
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), parts.alias("v")).filter(
        "vec_id is not null and v is not null and size(v) > 1"
        " and forall(v, x -> x is not null and not isnan(x) and abs(x) < double('infinity'))"
        " and exists(v, x -> x <> 0)")
    sizes = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return rows.filter(F.size("v") == (sizes.d if sizes else 0))


def entries(rows: DataFrame, keep: int = NEAREST + 1) -> DataFrame:
    """v, ids: distinct vectors with their ``keep`` smallest ids. Batches are reduced before
    the shuffle, so a common vector brings at most ``keep`` ids from each."""
    def reduce(frames):
        for frame in frames:
            seen: dict[bytes, list] = {}
            for i, v in zip(frame["vec_id"], frame["v"]):
                seen.setdefault(np.asarray(v, "f8").tobytes(), [v, []])[1].append(i)
            yield pd.DataFrame({"v": [v for v, _ in seen.values()],
                                "ids": [sorted(set(i))[:keep] for _, i in seen.values()]})

    reduced = rows.mapInPandas(reduce, "v array<double>, ids array<long>")
    return reduced.groupBy("v").agg(F.slice(F.array_sort(F.array_distinct(
        F.flatten(F.collect_list("ids")))), 1, keep).alias("ids"))


def fit(sample: np.ndarray, k: int, rounds: int = 12) -> np.ndarray:
    """Lloyd's algorithm from evenly spaced rows of the sorted sample; at most ``k`` centroids."""
    points = np.unique(sample, axis=0)
    centre = points[np.linspace(0, len(points) - 1, min(k, len(points))).astype(int)]
    for _ in range(rounds):
        near = nearest_centre(points, centre)
        sums, n = np.zeros_like(centre), np.bincount(near, minlength=len(centre))
        np.add.at(sums, near, points)
        centre = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centre)
    return centre


def nearest_centre(points: np.ndarray, centre: np.ndarray) -> np.ndarray:
    return (-2 * points @ centre.T + (centre ** 2).sum(1)).argmin(1)


def visit(first: np.ndarray, second: np.ndarray, held: np.ndarray, enough: float) -> np.ndarray:
    """Cells in the order of ``first[i] + second[j]``, largest first, until they hold
    ``enough`` entries. ``held`` is the number of entries by (i, j)."""
    a, b = np.argsort(-first, kind="stable"), np.argsort(-second, kind="stable")
    x, y, have = first[a].tolist(), second[b].tolist(), held[np.ix_(a, b)].tolist()
    heap, taken, total = [(-x[0] - y[0], 0, 0)], np.zeros(held.shape, bool), 0
    while heap and total < enough:
        _, i, j = heapq.heappop(heap)
        taken[a[i], b[j]] = True
        total += have[i][j]
        if j + 1 < len(y):
            heapq.heappush(heap, (-x[i] - y[j + 1], i, j + 1))
        if j == 0 and i + 1 < len(x):
            heapq.heappush(heap, (-x[i + 1] - y[0], i + 1, 0))
    return taken


def deal(held: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """First shard of each cell and how many it has. Small cells share one of about ``size``
    entries, in their order; a cell of more entries has shards of its own."""
    first, parts = np.zeros(held.size, "i8"), np.ones(held.size, "i8")
    shard = fill = 0
    for cell, n in enumerate(held.ravel().astype("i8").tolist()):
        if fill and fill + n > size:
            shard, fill = shard + 1, 0
        first[cell], parts[cell] = shard, max(1, -(-n // size))
        fill += n
        if n > size:
            shard, fill = shard + parts[cell], 0
    return first, parts


def products(query: np.ndarray, taken: np.ndarray, entry: np.ndarray,
             cell: np.ndarray) -> np.ndarray:
    """Inner products of queries with the entries of the cells they visit, minus infinity
    elsewhere. ``taken``: visited or not, by query and cell; ``cell`` ascends."""
    value = np.full((len(query), len(entry)), -np.inf)
    edges = np.flatnonzero(np.diff(cell, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        who = np.flatnonzero(taken[:, cell[a]])
        value[who, a:b] = query[who] @ entry[a:b].T
    return value


def search(vectors: DataFrame, queries: DataFrame, nearest: int = NEAREST,
           share: float = SHARE, centroids: int = CENTROIDS, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: each query's ``nearest`` by inner product among the
    vectors with another id. ``queries`` has the columns of ``vectors``."""
    spark = vectors.sparkSession
    rows = usable(vectors)
    distinct = stored(entries(rows, nearest + 1), "entries")
    total = distinct.count()
    schema = "query_id long, rank int, vec_id long, score double"
    if not total:
        return spark.createDataFrame([], schema)
    some = distinct.filter(F.pmod(F.xxhash64(F.col("ids")[0]), F.lit(1_000_003))
                           < F.lit(1_000_003.0 * sample / total)).select("v").toPandas()
    if not len(some):
        some = distinct.limit(1).select("v").toPandas()
    fitted = np.stack(some["v"].to_numpy())
    half = fitted.shape[1] // 2
    one, two = (fit(x, centroids) for x in (fitted[:, :half], fitted[:, half:]))

    def cells(frames):
        for frame in frames:
            m = np.stack(frame["v"].to_numpy())
            yield frame.assign(cell=nearest_centre(m[:, :half], one) * len(two)
                               + nearest_centre(m[:, half:], two))

    index = stored(distinct.filter(F.size("v") == fitted.shape[1])
                   .mapInPandas(cells, "v array<double>, ids array<long>, cell long")
                   .withColumn("draw", F.pmod(F.xxhash64("v"), F.lit(1 << 30))), "index")
    held = np.zeros(len(one) * len(two))
    for cell, n in index.groupBy("cell").count().collect():  # at most centroids squared rows
        held[cell] = n
    held = held.reshape(len(one), len(two))
    first, parts = deal(held, ENTRIES)

    asked = stored(usable(queries).filter(F.size("v") == fitted.shape[1])
                   .groupBy("vec_id", "v").agg(F.lit(1).alias("n")).drop("n"), "queries")
    blocks = max(1, -(-asked.count() // QUERIES))

    enough = max(share * total, nearest + 1)  # the walk ends at the last cell in any case

    def route(frames):
        for frame in frames:
            m = np.stack(frame["v"].to_numpy())
            near = zip(m[:, :half] @ one.T, m[:, half:] @ two.T)
            taken = [visit(x, y, held, enough).ravel() for x, y in near]
            yield frame.assign(visited=[np.packbits(t).tobytes() for t in taken],
                               shards=[shards_of(np.flatnonzero(t & (held.ravel() > 0)))
                                       for t in taken])

    def shards_of(cell):
        return sorted({s for a, n in zip(first[cell].tolist(), parts[cell].tolist())
                       for s in range(a, a + n)})

    def place(frames):
        for frame in frames:
            cell, draw = (frame[c].to_numpy() for c in ("cell", "draw"))
            yield frame.assign(shard=first[cell] + draw % parts[cell])[
                ["v", "ids", "cell", "shard"]]

    block = F.pmod(F.xxhash64("vec_id", F.lit(1)), F.lit(blocks)).cast("int").alias("block")
    sent = (stored(asked.repartition(blocks * 4, "vec_id").mapInPandas(
        route, "vec_id long, v array<double>, visited binary, shards array<long>"), "routes")
        .select("vec_id", "v", "visited", block, F.explode("shards").alias("shard")))
    dealt = index.mapInPandas(place, "v array<double>, ids array<long>, cell long, shard long") \
        .withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))))

    def score(entry, query):
        out = {k: [] for k in ("query_id", "vec_id", "score")}
        if len(entry) and len(query):
            entry = entry.sort_values("cell", kind="stable", ignore_index=True)
            e, q = (np.stack(f["v"].to_numpy()) for f in (entry, query))
            taken = np.unpackbits(np.stack([np.frombuffer(b, "u1") for b in query["visited"]]),
                                  axis=1).astype(bool)
            value = products(q, taken, e, entry["cell"].to_numpy())
            keep = min(nearest + 1, value.shape[1])
            floor = np.maximum(np.partition(value, -keep, axis=1)[:, -keep] - 1e-9, LOWEST)
            for k, me in enumerate(query["vec_id"]):
                at = np.flatnonzero(value[k] >= floor[k])
                exact = (e[at] * q[k]).sum(1)
                pairs = sorted((-s, i) for s, x in zip(exact, at) for i in entry["ids"][x]
                               if i != me)[:nearest]
                out["query_id"] += [me] * len(pairs)
                out["vec_id"] += [i for _, i in pairs]
                out["score"] += [-s for s, _ in pairs]
        return pd.DataFrame(out)

    found = (dealt.groupBy("block", "shard").cogroup(sent.groupBy("block", "shard"))
             .applyInPandas(score, "query_id long, vec_id long, score double"))
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (found.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= nearest)
            .select("query_id", "rank", "vec_id", "score"))

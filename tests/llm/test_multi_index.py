import numpy as np
from pyspark.sql import functions as F

from andenlake.llm import multi_index
from andenlake.llm.shared import documents


def slow(rows, queries, k=20):
    ids = np.array([i for i, _ in rows])
    m = np.array([v for _, v in rows], "f8")
    out = {}
    for i, v in queries:
        s = (m * np.array(v, "f8")).sum(1)
        order = sorted((-x, j) for x, j in zip(s, ids) if j != i)
        out[i] = list(dict.fromkeys((j, -x) for x, j in order))[:k]
    return out


def test_recall_on_the_given_vectors(spark):
    table = documents(spark, "/root/testdata/sf0.01", "embeddings")
    rows = [(r.vec_id, r.embedding) for r in table.collect()]
    queries = [x for x in rows if x[0] % 20 == 0]
    want = slow(rows, queries)
    got = multi_index.search(table, table.filter(F.col("vec_id") % 20 == 0)).collect()
    assert len(got) == 20 * len(queries)
    exact = dict(rows)
    for r in got:
        assert r.score == float((np.array(exact[r.query_id], "f8") * np.array(
            exact[r.vec_id], "f8")).sum())
    hits = sum((r.vec_id in {j for j, _ in want[r.query_id]}) for r in got)
    assert hits / len(got) >= 0.9
    ranks = {}
    for r in got:
        ranks.setdefault(r.query_id, []).append((r.rank, -r.score, r.vec_id))
    for x in ranks.values():
        x.sort()
        assert [k for k, *_ in x] == list(range(1, 21)) and [y[1:] for y in x] == sorted(
            y[1:] for y in x)


def test_everything_visited_is_exact_with_copies_and_odd_rows(spark):
    rng = np.random.default_rng(3)
    rows = [(i, rng.integers(-3, 4, 6).astype(float).tolist()) for i in range(300)]
    rows = [(i, v) for i, v in rows if any(v)]
    rows += [(i, [1.0, 2.0, 0.0, 1.0, -1.0, 2.0]) for i in range(1000, 1400)]
    odd = [(1, rows[1][1]), (2000, None), (2001, [0.0] * 6), (2002, [1.0, None] * 3),
           (2003, [float("nan")] * 6), (2004, [float("inf")] * 6), (2005, [1.0, 2.0]),
           (2020, [0.0] * 6), (None, [1.0] * 6)]
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows + odd],
                               "vec_id long, embedding array<double>, cell int, shard int")
    got = multi_index.search(df, df.filter(F.col("vec_id") % 20 == 0), share=1.1, centroids=8)
    want = slow(rows, [x for x in rows if x[0] % 20 == 0])
    found = {}
    for r in got.orderBy("query_id", "rank").collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == want


def test_heap_visits_cells_in_order():
    rng = np.random.default_rng(4)
    for _ in range(20):
        a, b = rng.random(5), rng.random(7)
        held = rng.integers(0, 4, (5, 7))
        taken = multi_index.visit(a, b, held, 20)
        order = np.argsort(-(a[:, None] + b[None]).ravel())
        n = int(np.searchsorted(np.cumsum(held.ravel()[order]), 20)) + 1
        want = np.zeros(35, bool)
        want[order[:n]] = True
        assert (taken.ravel() == want).all()


def test_cells_are_dealt_whole_unless_they_fill_a_shard():
    first, parts = multi_index.deal(np.array([[3, 0, 4], [25, 2, 9], [1, 10, 0]]), 10)
    assert first.tolist() == [0, 0, 0, 1, 4, 5, 5, 6, 6] and parts.tolist() == [
        1, 1, 1, 3, 1, 1, 1, 1, 1]


def test_only_visited_cells_are_multiplied():
    rng = np.random.default_rng(6)
    e, q = rng.normal(size=(50, 4)), rng.normal(size=(7, 4))
    cell, taken = np.sort(rng.integers(0, 9, 50)), rng.random((7, 9)) < 0.5
    value, seen = multi_index.products(q, taken, e, cell), taken[:, cell]
    assert np.allclose(value[seen], (q @ e.T)[seen]) and (value[~seen] == -np.inf).all()


def test_a_cell_with_most_entries_is_split(spark, monkeypatch):
    monkeypatch.setattr(multi_index, "ENTRIES", 16)
    rng = np.random.default_rng(7)
    rows = [(i, (np.ones(6) + rng.normal(size=6) / 50 if i % 3 else rng.normal(size=6)).tolist())
            for i in range(240)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    ask = df.filter("vec_id % 20 = 0")
    got = multi_index.search(df, ask, share=1.1, centroids=4).orderBy("query_id", "rank")
    found = {}
    for r in got.collect():
        found.setdefault(r.query_id, []).append((r.vec_id, r.score))
    assert found == slow(rows, [x for x in rows if x[0] % 20 == 0])


def test_few_or_no_vectors(spark):
    schema = "vec_id long, embedding array<float>"
    assert multi_index.search(*[spark.createDataFrame([], schema)] * 2).collect() == []
    one = spark.createDataFrame([(0, [1.0, 0.0])], schema)
    assert multi_index.search(one, one).collect() == []
    two = spark.createDataFrame([(0, [1.0, 0.0]), (7, [0.5, 1.0])], schema)
    assert [tuple(r) for r in multi_index.search(two, two).orderBy("query_id").collect()] == [
        (0, 1, 7, 0.5), (7, 1, 0, 0.5)]


def test_small_tables_give_all_that_there_is(spark):
    rng = np.random.default_rng(9)
    for n in (10, 21, 30, 40):
        rows = [(i, rng.normal(size=6).tolist()) for i in range(n)]
        df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
        found = {}
        for r in multi_index.search(df, df).collect():
            found.setdefault(r.query_id, set()).add(r.vec_id)
        assert {i: len(x) for i, x in found.items()} == {i: min(20, n - 1) for i in range(n)}

import hashlib
import zlib

import duckdb
import numpy as np
import pandas as pd
import pytest

from andenlake.llm import merkle, merkle_sql

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, root string, tree int"


def h(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def row_digest(doc, source, lang, n, text) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}"
                     for v in (doc, source, lang, n, text)))


def slow_tree(nodes):
    """Root, and for each leaf the runs on its path with its place in them."""
    paths = [[] for _ in nodes]
    owners = [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        runs = [nodes[k:k + 16] for k in range(0, len(nodes), 16)]
        for k, group in enumerate(owners):
            for i in group:
                paths[i].append((runs[k // 16], k % 16))
        owners = [sum(owners[k:k + 16], []) for k in range(0, len(owners), 16)]
        nodes = [h("".join(r)) for r in runs]
    return nodes[0], paths


def slow(rows):
    """All expected rows, by plain recomputation."""
    by_source: dict = {}
    for r in rows:
        by_source.setdefault(r[1], []).append((r, row_digest(*r[:5])))
    names = sorted(by_source, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for s in names:
        by_source[s].sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
        trees[s] = slow_tree([d for _, d in by_source[s]])
    root, tops = slow_tree([trees[s][0] for s in names])
    out = []
    for place, s in enumerate(names):
        for (r, leaf), path in zip(by_source[s], trees[s][1]):
            path = path + tops[place]
            proof = "".join("".join(run[:k] + run[k + 1:]) for run, k in path)
            shown = r[4]
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and shown is not None:
                shown = "".join(c.lower() if c.isascii() else c for c in shown)
            node = row_digest(*r[:4], shown)
            for run, k in path:
                node = h("".join([*run[:k], node, *run[k + 1:]]))
            out.append((r[0], leaf, trees[s][0], root, h(proof), node, node == root))
    return out


def ordered(rows):
    return sorted(map(tuple, rows), key=lambda r: tuple((v is None, str(v)) for v in r))


def check(spark, rows):
    df = spark.createDataFrame([(*r, "own root", 7) for r in rows], SCHEMA)
    got = merkle.proofs(df)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root",
                           "verified"]
    assert ordered(got.collect()) == ordered(slow(rows))


def test_nulls_ties_and_odd_texts(spark):
    rows = [(i, f"s{i % 3}", "en", 5, f"Text {i}") for i in range(60)]
    rows += [(None, None, None, None, None)] * 3 + [(5, "s0", "en", 5, "tie"), (5, "s0", "en", 5, "TIE")]
    rows += [(7, "é", "", 0, ""), (8, "z", "de", 3, "ÄB:Ç"), (-10, "Z", "de", 3, "X" * 100_000)]
    check(spark, rows)


def test_several_blocks_of_one_source(spark):
    check(spark, [(i, "hot", None, 1, "Same") for i in range(4097 + 300)]
          + [(None, "hot", None, 1, "Same")] * 20 + [(1, "cold", None, 1, "x")])


def test_more_sources_than_a_block_holds(spark):
    check(spark, [(i, f"{i:05}", "en", 1, "Text") for i in range(4100)])


@pytest.mark.parametrize("n", [1, 2, 16, 17])
def test_small_trees(spark, n):
    check(spark, [(i, "one", "en", 1, "Text") for i in range(n)])
    check(spark, [(i, f"s{i:02}", "en", 1, "Text") for i in range(n)])


def test_empty_table(spark):
    assert merkle.proofs(spark.createDataFrame([], SCHEMA)).collect() == []


@pytest.mark.parametrize("fan, levels", [(2, 1), (2, 2), (2, 5), (2, 8), (16, 4), (3, 6)])
def test_layout(fan, levels):
    """Every node has one place; lower subtrees at half the height are contiguous."""
    places = [merkle.address(levels, d, np.arange(fan ** d), fan) for d in range(levels)]
    flat = np.concatenate(places)
    assert sorted(flat.tolist()) == list(range(merkle.nodes_in(levels, fan)))
    top = levels // 2
    if top:
        upper = np.concatenate(places[:top])
        assert upper.max() == merkle.nodes_in(top, fan) - 1
        each = merkle.nodes_in(levels - top, fan)
        for k in range(fan ** top):
            part = np.concatenate([p[k * fan ** d:(k + 1) * fan ** d]
                                   for d, p in enumerate(places[top:])])
            assert part.min() == merkle.nodes_in(top, fan) + k * each
            assert part.max() - part.min() == each - 1


@pytest.mark.parametrize("fan, levels", [(2, 6), (16, 3)])
def test_block_against_plain_levels(fan, levels):
    for n in (1, 2, fan, fan + 1, fan ** (levels - 1) - 1, fan ** (levels - 1)):
        leaves = np.array([h(str(k)) for k in range(n)], "S64")
        nodes = merkle.build(leaves, levels, fan)
        row = [x.decode() for x in leaves]
        for _ in range(levels - 1):
            row = [h("".join(row[k:k + fan])) for k in range(0, len(row), fan)]
        assert nodes[0].decode() == row[0]
        for leaf, path in zip(leaves, merkle.siblings(nodes, levels, n, fan)):
            assert merkle.fold(leaf, path).decode() == row[0]


def test_sql_on_planted_rows():
    rows = [(i, f"s{i % 3}" if i % 7 else None, "en", 5, f"Text {i}") for i in range(60)]
    rows += [(None, None, None, None, None)] * 3 + [(7, "é", "", 0, ""), (8, "z", "de", 3, "ÄB:Ç")]
    rows += [(100 + i, "long", "en", 1, "A") for i in range(300)]
    documents = pd.DataFrame(rows, columns=["doc_id", "source", "lang", "n_chars", "text"]).astype(
        {"doc_id": "Int64", "n_chars": "Int64"})
    con = duckdb.connect()
    con.register("documents", documents)
    assert ordered(con.execute(merkle_sql.proofs()).fetchall()) == ordered(slow(rows))

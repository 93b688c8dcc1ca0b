import random
from collections import Counter

import numpy as np

from andenlake.llm import suffix_dedup


def slow(texts, length):
    """Bytes kept, by counting every window."""
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i:i + length] for b in raw for i in range(len(b) - length + 1))
    out = []
    for b in raw:
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            if seen[b[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        runs = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(b), sum(gone), runs, bytes(x for x, g in zip(b, gone) if not g)))
    return out


def sample(length):
    rng = random.Random(9)
    block = "".join(rng.choices("abcdé ", k=3 * length))
    texts = [None, "", "short", block, block, "x" * (3 * length), "ab" * (2 * length),
             "y" + "ab" * (length // 2) + "z"]
    for _ in range(40):
        own = "".join(rng.choices("abcdé ", k=rng.randint(1, 2 * length)))
        a = rng.randrange(2 * length)
        part = list(block[a:a + rng.randint(1, 2 * length)])
        if rng.random() < 0.5:
            part[rng.randrange(len(part))] = "#"
        texts.append(own + "".join(part) + own[:rng.randint(0, length)])
    texts.append("".join(rng.choices("pqr", k=20_000)) + block)
    return texts


def check(spark, texts, ids, length):
    df = spark.createDataFrame([(i, t, "k", 3) for i, t in zip(ids, texts)],
                               "doc_id long, text string, key string, n int")
    got = suffix_dedup.remove(df, length).collect()
    want = Counter((i, *w) for i, w in zip(ids, slow(texts, length)))
    assert Counter((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, bytes(r.kept))
                   for r in got) == want
    assert sum(w[2] for w in want) > 0


def test_against_all_windows(spark):
    texts = sample(400)
    check(spark, texts, [*range(len(texts) - 3), None, 0, 0], 400)


def test_equal_rows_without_id_bring_their_regions_once_each(spark):
    text = " ".join(random.Random(8).choices("abcdefgh", k=500))
    for n in (10, 1000):
        df = spark.createDataFrame([(None, text)] * n + [(1, "other|" + text[100:]), (2, "x")],
                                   "doc_id long, text string")
        every = suffix_dedup.suffix_array(df)
        single = every.filter("key is not null").count()
        assert suffix_dedup.surroundings(df, every.filter("key is not null")).count() == single
    got = Counter((r.doc_id, r.n_removed) for r in suffix_dedup.remove(df).collect())
    assert got == {(None, len(text)): 1000, (1, len(text) - 100): 1, (2, 0): 1}


def test_large_groups_are_cut_into_narrower_ones(spark, monkeypatch):
    monkeypatch.setattr(suffix_dedup.repeated, "__defaults__", (400, 3))
    texts = sample(400)
    check(spark, texts, list(range(len(texts))), 400)


def test_aligned_windows_against_all_pairs():
    rng = random.Random(1)
    for _ in range(60):
        base = bytes(rng.choices(b"ab", k=30))
        regions, low, group = [], [], []
        for _ in range(12):
            x = bytearray(base)
            for _ in range(rng.randint(0, 3)):
                x[rng.randrange(30)] = rng.choice(b"abc")
            a = rng.randint(0, 8)
            regions.append(bytes(x[a:rng.randint(20, 30)]))
            low.append(10 - a)
            group.append(rng.randint(0, 2))
        got = suffix_dedup.aligned(regions, np.array(low), np.array(group), np.ones(12), 6)
        for r, x in enumerate(regions):
            for c in range(len(x) - 5):
                want = any(q != r and group[q] == group[r] and c - low[r] + low[q] >= 0
                           and y[c - low[r] + low[q]:][:6] == x[c:c + 6]
                           for q, y in enumerate(regions))
                assert got[r, c] == want


def test_levels_double(spark):
    family = suffix_dedup.Family()
    for k in range(6):
        again = family.add(spark.createDataFrame([(k,), (100,)], "key long"))
        assert {r.key for r in again.collect()} == ({100} if k else set())
    assert [size for size, _ in family.levels] == [4, 2]
    assert {r.key: r.n for r in family.levels[0][1].collect()} == {0: 1, 1: 1, 2: 1, 3: 1, 100: 4}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert suffix_dedup.remove(df).collect() == []

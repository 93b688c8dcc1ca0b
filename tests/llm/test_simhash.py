import random

import numpy as np
import xxhash

from andenlake.llm import simhash
from andenlake.llm.components import components


def slow_fingerprint(text, words=4):
    parts = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", "".join(
        chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")) if w]
    if not parts:
        return 0
    hashes = [xxhash.xxh64_intdigest(" ".join(parts[i:i + words]).encode(), 42)
              for i in range(max(1, len(parts) - words + 1))]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_components(ids, fps, radius=4):
    root = list(range(len(ids)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i
    for i in range(len(ids)):
        for j in range(i):
            if (fps[i] ^ fps[j]).bit_count() <= radius:
                root[find(i)] = find(j)
    best = {}
    for i, d in enumerate(ids):
        if d is not None:
            best[find(i)] = min(best.get(find(i), d), d)
    return [best.get(find(i)) for i in range(len(ids))]


def test_documents_against_brute_force(spark):
    rng = random.Random(3)
    vocab = ["Wort", "casa", "The", "of", "île", "x", "zebra", "Ünd"]
    base = [" ".join(rng.choices(vocab, k=60)) for _ in range(12)]
    rows = [(i, t) for i, t in enumerate(base)]
    rows += [(100 + i, base[i % 12].replace("zebra", "zebras", 1)) for i in range(24)]
    rows += [(200, None), (201, ""), (202, " \t\n"), (203, "one two"), (204, "ONE\x0btwo"),
             (100, rows[12][1]), (None, base[0]), (300, "a b c " * 30000)]
    df = spark.createDataFrame([(i, t, "k", 1) for i, t in rows],
                               "doc_id long, text string, fp string, bucket int")
    got = simhash.near_duplicates(df).collect()
    fps = [slow_fingerprint(t) for _, t in rows]
    want = {(i, f"{f:016x}", c) for (i, _), f, c in
            zip(rows, fps, slow_components([i for i, _ in rows], fps))}
    assert len(got) == len(rows) and {tuple(r) for r in got} == want


def test_ball_hashing_finds_every_link(spark, monkeypatch):
    rng = np.random.default_rng(1)
    centre = rng.integers(0, 2**63, 40, dtype="u8")
    fps = list(centre)
    for c in centre:
        for k in (1, 2, 3, 4, 5, 6):
            bits = rng.choice(64, k, replace=False)
            fps.append(c ^ np.bitwise_or.reduce(np.uint64(1) << bits.astype("u8")))
    fps = sorted({int(f) for f in fps})
    df = spark.createDataFrame([(int(np.uint64(f).view("i8")),) for f in fps], "fp long")
    want = slow_components(fps, fps)
    for bucket in (16, 100_000):
        pairs = simhash.links(df, bucket=bucket)
        found = {r.node: r.root for r in components(pairs, "a", "b").collect()}
        signed = [int(np.uint64(f).view("i8")) for f in fps]
        groups = {}
        for s, w in zip(signed, want):
            groups.setdefault(w, set()).add(found.get(s, s))
        assert all(len(g) == 1 for g in groups.values())
        assert len({next(iter(g)) for g in groups.values()}) == len(groups)


def test_split_buckets_give_the_same_links(monkeypatch):
    rng = np.random.default_rng(2)
    fp = np.unique(np.concatenate([np.uint64(77) ^ simhash._masks(64, 2)[rng.choice(2016, 90)],
                                   rng.integers(0, 2**63, 50, dtype="u8")]))
    whole, parts = [], []
    simhash.bucket_links(fp, np.full(len(fp), 2), 64, 4, whole)
    monkeypatch.setattr(simhash, "EXPAND", 40_000)
    monkeypatch.setattr(simhash, "PARTS", 3)
    simhash.bucket_links(fp, np.full(len(fp), 2), 64, 4, parts)
    assert len(parts) < 3
    a, b = (simhash.forest(np.concatenate(x)) for x in (whole, parts))
    assert (a == b).all() and len(a)


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(df).collect() == []


def test_chain_of_links_is_one_component(spark):
    df = spark.createDataFrame([(i, i + 1) for i in range(50)] + [(7, 7), (90, 91)],
                               "a long, b long")
    assert {(r.node, r.root) for r in components(df, "a", "b").collect()} == \
        {(i, 0) for i in range(1, 51)} | {(91, 90)}


def test_one_row_of_each_group_whatever_the_ids(spark):
    rng = random.Random(9)
    a, b, c = ([f"{x}{i}" for i in range(4000)] for x in "abc")

    def altered(words):
        at = rng.randrange(len(words))
        return " ".join([*words[:at], "new", *words[at + 1:]])

    rows = [(7, " ".join(a)), (7, " ".join(b)), (3, altered(b)),  # 7 twice, b said by 3
            (None, " ".join(c)), (None, " ".join(c)), (None, altered(c)),
            (None, altered(a)), (8, "short one"), (8, "short one"), (9, None), (None, "")]
    assert all(bin(slow_fingerprint(x) ^ slow_fingerprint(" ".join(y))).count("1") <= 4
               for x, y in ((rows[2][1], b), (rows[5][1], c), (rows[6][1], a)))
    df = spark.createDataFrame([(*r, k, "z") for k, r in enumerate(rows)],
                               "doc_id long, text string, key int, row string")
    kept = simhash.first_of_groups(df)
    assert kept.columns == df.columns
    found = sorted((r.doc_id or 0, (r.text or "none").split()[-1][0]) for r in kept.collect())
    assert found == [(0, "c"), (3, "b"), (7, "a"), (8, "o"), (9, "n")]
    assert simhash.first_of_groups(df.limit(0)).collect() == []

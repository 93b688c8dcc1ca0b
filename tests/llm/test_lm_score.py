import math
import random
from collections import Counter

import pytest

from andenlake.llm import lm_score as L


def slow(rows, target):
    docs = [(i, (t or "").lower().split()) for i, t in rows]
    models = []
    for column in (1, 0):
        mine = [w for i, w in docs if not column or i in target and i is not None]
        models.append((Counter(x for w in mine for x in w),
                       Counter(p for w in mine for p in zip(w, w[1:])), sum(map(len, mine))))
    vocabulary, size = len(models[1][0]), models[0][2]
    out = []
    for i, words in docs:
        if not words or not size:
            out.append((i, len(words), None, None))
            continue
        loss = []
        for (one, two, total), own in zip(models, (i in target and i is not None, True)):
            scale, mine, pairs = size / total, Counter(words), Counter(zip(words, words[1:]))
            sum_ = 0.0
            for k, w in enumerate(words):
                p = ((one[w] - own * mine[w]) * scale + L.WORD_PRIOR) / (
                    (total - own * len(words)) * scale + L.WORD_PRIOR * vocabulary)
                pair = context = 0.0
                if k:
                    u = words[k - 1]
                    pair = (two[u, w] - own * pairs[u, w]) * scale
                    context = max((one[u] - own * mine[u]) * scale, pair)
                sum_ -= math.log((pair + L.CONTEXT_PRIOR * p) / (context + L.CONTEXT_PRIOR))
            loss.append(sum_ / len(words))
        out.append((i, len(words), *loss))
    return out


@pytest.mark.parametrize("block", [1 << 20, 600])
def test_against_counters(spark, block):
    rng = random.Random(5)
    vocab = ["Alpha", "beta", "île", "GAMMA", "the", "of", "x1"] + [f"w{k}" for k in range(30)]
    rows = [(i, " ".join(rng.choices(vocab, k=rng.randint(1, 60)))) for i in range(40)]
    rows += [(50, None), (51, ""), (52, "beta " * 20_000), (None, "the of beta"), (3, rows[3][1]),
             (3, "another text of the same id")]
    target = {1, 2, 3, 5, 8, 52}
    df = spark.createDataFrame([(i, t, 1, True) for i, t in rows],
                               "doc_id long, text string, n int, mark boolean")
    ids = spark.createDataFrame([(i, "z") for i in [*target, 1, None, 999]], "doc_id long, q string")
    got = L.score(df, ids, block).collect()
    key = lambda r: (r[0] is None, r[0] or 0, r[1])
    want = sorted(slow(rows, target), key=key)
    got = sorted(((r.doc_id, r.n_tokens, r.target_loss, r.background_loss, r.score)
                  for r in got), key=key)
    assert len(got) == len(want)
    for g, w in zip(got, want):
        assert g[:2] == w[:2]
        if w[2] is None:
            assert g[2:] == (None, None, None)
        else:
            assert g[2:4] == pytest.approx(w[2:]) and g[4] == pytest.approx(w[2] - w[3])


def test_without_target_and_without_rows(spark):
    df = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    assert [tuple(r) for r in L.score(df, none).collect()] == [(1, 2, None, None, None)]
    assert L.score(df.limit(0), none).collect() == []

import zlib

import numpy as np

from andenlake.llm import langid
from andenlake.llm.shared import documents


def test_forward_sums_all_segmentations():
    rng = np.random.default_rng(0)
    pieces = langid.vocabulary()
    prob = rng.random((len(pieces), 2))
    model = langid.Model(["a", "b"], pieces, prob / prob.sum(0))
    index = {p: i for i, p in enumerate(pieces)}
    words = ["hello", "naïve", "a", "thndhaea"]

    def slow(raw):
        if not raw:
            return np.ones(2)
        return sum((model.probability[index[raw[:n]]] * slow(raw[n:])
                    for n in range(1, len(raw) + 1) if raw[:n] in index), np.zeros(2))
    lattice = langid.Lattice(words, langid.lookup(pieces))
    want = np.log([slow(w.encode() + langid.END) for w in words])
    assert np.allclose(lattice.log_likelihood(model.scaled), want)
    uses = lattice.expected(model.scaled, np.ones((4, 2)))
    sizes = np.array([len(p) for p in pieces])
    assert np.allclose((uses * sizes[:, None]).sum(0), sum(len(w.encode()) + 1 for w in words))


def test_held_out_accuracy(spark):
    docs = documents(spark, "/root/testdata/sf0.01")
    truth = {r.doc_id: r.lang for r in docs.collect()}
    got = langid.identify(docs).collect()
    assert len(got) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in got)
    held = [r for r in got if r.held_out and r.lang_pred != langid.UNKNOWN]
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.98
    assert all(0 <= r.score <= 1 for r in got)


def test_odd_rows_and_filter(spark):
    rows = [(i, "the house and the garden " * 3, "en", "s", 1) for i in range(30)]
    rows += [(100 + i, "la casa y el jardín de los niños " * 3, "es", "s", 1) for i in range(30)]
    odd = [(200, None, "en", "s", 1), (201, "", None, "s", 1), (202, "12 + 34 = ½²", "es", "s", 1),
           (None, "the garden", None, None, None), (203, "x" * 50_000, None, "s", 1),
           (204, "el jardín", None, "s", 1), (0, "the house", "en", "s", 1)]
    df = spark.createDataFrame(rows + odd, "doc_id long, text string, lang string, source string,"
                               " score long")
    model = langid.train(df)
    assert model.languages == ["en", "es"]
    got = langid.predict(df, model).collect()
    assert len(got) == len(rows) + len(odd)
    said = {r.doc_id: (r.lang_pred, r.held_out) for r in got}
    assert [said[i][0] for i in (200, 201, 202, None, 204)] == ["und", "und", "und", "en", "es"]
    assert said[203][0] in ("en", "es") and said[None][1] is False
    kept = langid.recognised(df, model)
    assert kept.columns == df.columns
    assert {r.doc_id: r.lang for r in kept.collect()} == {
        r.doc_id: r.lang_pred if r.doc_id in (None, 203, 204) else {**{x[0]: x[2] for x in rows}}[
            r.doc_id] for r in got if r.lang_pred != "und"}


def test_nothing_to_learn_from(spark):
    schema = "doc_id long, text string, lang string"
    df = spark.createDataFrame([(1, "text", None)], schema)
    assert [(r.lang_pred, r.score) for r in langid.identify(df).collect()] == [("und", 0.0)]
    assert langid.identify(spark.createDataFrame([], schema)).collect() == []


def test_prediction_sorts_edges_by_level_only(monkeypatch):
    """The order for the way back is made by training alone; edges keep the words' order in a level."""
    pieces = langid.vocabulary()
    prob = np.random.default_rng(2).random((len(pieces), 3))
    model = langid.Model(["a", "b", "c"], pieces, prob / prob.sum(0))
    words = ["el", "ñandú", "ñ" * 32, "\U00010400" * 4, "日本", "el"]
    lattice = langid.Lattice(words, langid.lookup(pieces))
    by_hand = np.lexsort((lattice.target, lattice.target - lattice.own))
    assert (by_hand == np.arange(len(by_hand))).all()
    uses = lattice.expected(model.scaled, np.ones((len(words), 3)))
    length = sum(len(w.encode()) + 1 for w in words)
    assert np.allclose((uses * model.bytes[:, None]).sum(0), length)  # the pieces cover every byte

    def refuse(*_):
        raise AssertionError("sorted for the way back")
    monkeypatch.setattr(np, "lexsort", refuse)
    got = langid.Lattice(words, langid.lookup(pieces)).log_likelihood(model.scaled)
    assert got.shape == (6, 3) and (got[0] == got[5]).all() and np.isfinite(got).all()

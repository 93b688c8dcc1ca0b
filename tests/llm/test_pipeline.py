import corpus_pipeline
from andenlake.llm import langid, packing, secret_scan
from andenlake.llm.shared import documents, stored, tokenizer_path
from tests.llm.test_line_dedup import slow as slow_lines
from tests.llm.test_line_dedup import words
from tests.llm.test_simhash import slow_components, slow_fingerprint

SMALL = "/root/testdata/sf0.001"


def table(df):
    return {r.doc_id: r.asDict() for r in df.collect()}


def test_every_stage_against_brute_force(spark):
    stages = dict(corpus_pipeline.STAGES)
    start = documents(spark, SMALL)
    extra = spark.createDataFrame([(10_001, "1234 !!", None, "s", 7), (10_002, None, "en", "s", 0),
                                   (10_003, "pwd: x9#kQ!vz2Lp and more words", None, "s", 9)],
                                  start.schema)
    docs = start.unionByName(extra)
    before, seen = table(docs), [docs]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        seen.append(stored(stage(spark, seen[-1], SMALL), name))
        assert seen[-1].columns == start.columns
    lang, line, near, secret = map(table, seen[1:])

    assert set(lang) == {i for i, r in before.items()
                         if any(c.isalpha() for c in r["text"] or "")}
    assert all(r["lang"] for r in lang.values())

    rows = [(i, r["text"]) for i, r in lang.items()]
    kept = slow_lines(rows)
    want = {i: "\n".join(t.split("\n")[k] for k in kept[i, t]) for i, t in rows}
    assert {i: r["text"] for i, r in line.items()} == {i: t for i, t in want.items() if words(t)}
    assert all(r["n_chars"] == len(r["text"]) for r in line.values())

    ids = sorted(line)
    groups = slow_components(ids, [slow_fingerprint(line[i]["text"]) for i in ids])
    assert set(near) == set(groups)

    cost = secret_scan.GuessCost.from_vocabulary(tokenizer_path())
    assert {i: r["text"] for i, r in secret.items()} == {
        i: secret_scan.blanked(r["text"], [(s, e) for s, _, e, _ in
                                           secret_scan.find(r["text"], cost)])
        for i, r in near.items()}
    assert "x9#kQ" not in secret[10_003]["text"]

    packed = stages["best_fit_packing"](spark, seen[-1], SMALL).toPandas()
    assert set(packed["doc_id"]) == set(secret)
    assert packed.groupby("sequence_id")["length"].sum().max() <= packing.CAPACITY


def test_empty_table_and_columns_of_any_name(spark):
    names = "row string, kept string, new string, key long, id long, first long, lang string"
    full = spark.createDataFrame(
        [(1, "one line of words here", 22, "s", "a", "b", "c", 4, 5, 6, None),
         (2, "one line of words here", 22, "s", "a", "b", "c", 4, 5, 6, "en"),
         (None, None, None, None, None, None, None, None, None, None, None),
         (3, "another text, password: hunter2hunter2", 9, "s", "d", "e", "f", 7, 8, 9, "en")],
        f"doc_id long, text string, n_chars long, source string, {names}")
    for docs in (full, full.limit(0)):
        at = docs
        for name, stage in corpus_pipeline.STAGES[:-1]:
            at = stored(stage(spark, at, SMALL), name)
            assert at.columns == docs.columns
        kept = {r.doc_id: r for r in at.collect()}
        if docs is full:
            assert set(kept) == {1, 3} and "hunter2" not in kept[3].text
            assert (kept[1].row, kept[1].new, kept[1].key, kept[1].first) == ("a", "c", 4, 6)
        else:
            assert not kept
        packed = corpus_pipeline.STAGES[-1][1](spark, at, SMALL)
        assert {r.doc_id for r in packed.collect()} == set(kept)


def test_near_dedup_stage_keeps_one_of_each_group(spark):
    """On raw texts, where the stage has groups to work on."""
    docs = documents(spark, SMALL)
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    groups = slow_components([i for i, _ in rows], [slow_fingerprint(t) for _, t in rows])
    assert len(set(groups)) < len(rows)
    got = dict(corpus_pipeline.STAGES)["near_dedup"](spark, docs, SMALL)
    assert sorted(r.doc_id for r in got.collect()) == sorted(set(groups))


def test_run_gives_the_packed_rows(spark):
    packed = corpus_pipeline.run(spark, SMALL).toPandas()
    assert len(packed) and packed.columns.tolist()[:2] == ["doc_id", "piece"]
    assert langid.UNKNOWN == "und" and corpus_pipeline.ORACLE_SQL is None

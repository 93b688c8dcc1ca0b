import zlib

import numpy as np
from tokenizers import Tokenizer

from andenlake.llm import packing
from andenlake.llm.shared import tokenizer_path


def test_every_piece_has_a_place(spark):
    tokenizer = Tokenizer.from_file(tokenizer_path())
    texts = [None, "", "hello world", "a " * 9001, "Ünï <|endoftext|> x\x1cy", "é" * 700]
    texts += [f"text {'of words ' * k}" for k in range(1, 60)] * 3
    rows = [(i, t, 5, 6) for i, t in enumerate(texts)] + [(None, "no id", 5, 6), (2, texts[2], 5, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, offset int")
    got = packing.pack(df).toPandas()
    want = []
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        for k in range(0, len(ids), 4096):
            part = ids[k:k + 4096]
            want.append((-1 if i is None else i, k // 4096, k, len(part),
                         zlib.crc32(np.array(part, "<u4").tobytes())))
    key = ["doc_id", "piece", "start", "length", "ids_crc32"]
    assert sorted(map(tuple, got[key].fillna(-1).astype(int).to_numpy())) == sorted(want)
    for _, s in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum()[:-1]] and s["length"].sum() <= 4096
    total = got["length"].sum()
    assert got["sequence_id"].nunique() <= -(-total // 4096) + 1
    assert sorted(got["sequence_id"].unique()) == list(range(got["sequence_id"].nunique()))


def test_plan_is_close_to_the_bound():
    rng = np.random.default_rng(1)
    for n in (0, 1, 50, 20_000):
        lengths = np.minimum(rng.lognormal(6, 1, n).astype(int) + 1, 4096)
        counts = np.bincount(lengths - 1, minlength=4096)
        slots = packing.plan(counts)
        assert (slots.groupby("length")["n"].sum().reindex(range(1, 4097), fill_value=0)
                == counts).all()
        used = 0 if slots.empty else int((slots["sequence"] + slots["n"]).max())
        assert used <= -(-int(lengths.sum()) // 4096) * 1.01 + 1


def test_configurations_fit():
    rng = np.random.default_rng(2)
    for _ in range(20):
        most = rng.integers(0, 3, 512)
        use = packing.best_configuration(rng.random(512) * np.arange(1, 513), most, 16)
        assert (use <= most).all() and (use * np.arange(1, 513)).sum() <= 512


def test_equal_lengths_only():
    counts = np.zeros(4096, "i8")
    counts[2047] = 7
    assert packing.plan(counts)["sequence"].max() == 3


def test_empty_table(spark):
    assert packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []

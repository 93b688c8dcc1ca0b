import zlib

import numpy as np
from tokenizers import Tokenizer

from andenlake.llm import ffd_packing
from andenlake.llm.shared import tokenizer_path


def check_places(got, capacity=2048):
    """Places are gapless and sequences are full or a power of two long."""
    for _, s in got.sort_values(["sequence_id", "offset"]).groupby("sequence_id"):
        assert s["offset"].tolist() == [0, *s["length"].cumsum()[:-1]]
        total = int(s["length"].sum())
        assert total == capacity or total < capacity and total & (total - 1) == 0


def test_pieces_are_the_documents(spark):
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    texts = [None, "", "hello  world\n\n", "a " * 5000, "Ünï <|endoftext|> x\x1cy", "é" * 700,
             " " * 5000 + "x", "\n\t" * 3000]
    texts += [f"text {'of words ' * k}" for k in range(1, 60)] * 3
    rows = [(i, t, 5, 6) for i, t in enumerate(texts)]
    rows += [(None, "no id", 5, 6)] * 3 + [(2, texts[2], 5, 6), (2, "other", 5, 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, length int, lot int")
    got = ffd_packing.pack(df).toPandas()
    check_places(got)
    # Every row's ids, as multisets of (id, total, ids cut at the found places).
    want: dict = {}
    for i, t, *_ in rows:
        ids = tokenizer.encode(t or "", add_special_tokens=False).ids + [1]
        want.setdefault(-1 if i is None else i, []).append(ids)
    seen = {k: g for k, g in got.assign(doc_id=got["doc_id"].fillna(-1).astype(int))
            .groupby("doc_id")}
    assert set(seen) == set(want)
    for doc, lists in want.items():
        pieces = seen[doc]
        assert pieces["length"].sum() == sum(map(len, lists))
        for ids in lists:
            mine = pieces[pieces["doc_tokens"] == len(ids)]
            crc = {(s, n): zlib.crc32(np.array(ids[s:s + n], "<u4").tobytes())
                   for s, n in zip(mine["start"], mine["length"])}
            assert set(crc.items()) <= {((s, n), c) for s, n, c in zip(
                mine["start"], mine["length"], mine["ids_crc32"])}
            same = sum(len(x) == len(ids) for x in lists)
            covered = np.zeros(len(ids), int)
            for s, n in zip(mine["start"], mine["length"]):
                covered[s:s + n] += 1
            assert (covered == same).all()


def test_tree_finds_the_first_fit():
    rng = np.random.default_rng(3)
    for n in (1, 2, 7, 300):
        sizes = sorted(rng.integers(1, 100, n).tolist(), reverse=True)
        room: list[int] = []
        want = []
        for size in sizes:
            at = next((k for k, r in enumerate(room) if r >= size), len(room))
            if at == len(room):
                room.append(100)
            room[at] -= size
            want.append(at)
        got = ffd_packing.first_fit(sizes, 100)
        place = {item: k for k, b in enumerate(got) for item, _, _ in b}
        assert [place[i] for i in range(n)] == want


def test_gaps_are_closed():
    rng = np.random.default_rng(4)
    for n in (0, 1, 50, 2000):
        for low in (1, 40, 60):
            sizes = sorted(rng.integers(low, 100, n).tolist(), reverse=True)
            bins = ffd_packing.close_gaps(ffd_packing.first_fit(sizes, 100), 100)
            filled = [sum(k for _, _, k in b) for b in bins]
            assert sum(filled) == sum(sizes)
            assert all(f == 100 or f & (f - 1) == 0 for f in filled)
            cells = sorted((i, s + k) for b in bins for i, s, m in b for k in range(m))
            assert cells == [(i, k) for i, m in enumerate(sizes) for k in range(m)]
            assert sum(map(len, bins)) <= n + len(bins) + 8  # few cuts


def test_one_id_and_text_on_all_rows(spark, monkeypatch):
    monkeypatch.setattr(ffd_packing, "GROUP_ROWS", 50)
    df = spark.range(1000).selectExpr("cast(null as long) as doc_id", "'the same words' as text")
    got = ffd_packing.pack(df).toPandas()
    check_places(got)
    assert got["length"].sum() == 1000 * 4
    lots = got.groupby(got["sequence_id"] // 2 ** 32)["length"].sum()
    assert len(lots) == 20 and lots.max() < 5 * lots.mean()


def test_encoder_agrees_with_the_tokenizer():
    tokenizer = Tokenizer.from_file(tokenizer_path("byte_bpe_50k.json"))
    encode = ffd_packing.Encoder(tokenizer_path("byte_bpe_50k.json"),
                                 tokenizer_path("byte_bpe_50k.tiktoken"))
    marks = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000]
    for at in range(0, len(marks), 64):
        text = "".join(f"a{m}b 1{m}2  {m} {m}{m}x" for m in marks[at:at + 64])
        assert encode(text) == tokenizer.encode(text, add_special_tokens=False).ids


def test_empty_table(spark):
    assert ffd_packing.pack(spark.createDataFrame([], "doc_id long, text string")).collect() == []

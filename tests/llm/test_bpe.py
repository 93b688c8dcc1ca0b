import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from andenlake.llm import bpe
from andenlake.llm.bpe_words import ChunkTable, chunk_table
from andenlake.llm.shared import tokenizer_path

TEXTS = [None, "", "Hello, world's end!", "naïve Straße ΑΣ ΣΑΣ İstanbul", "á é̂",
         "x<|endoftext|>y <|startoftext|>", "tab\tnew\nline\x0b\x0c\r end", "a\x1cb\x1fc",
         " wide space​zero", "日本語 テキスト 123٤٥", "can't I'LL we've 'sa",
         "word " * 30_000, "x" * 4000, "🙂🙂 ok 👩‍👩‍👧", "ﬁ Å ẞ", "<|ENDOFTEXT|>"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(tokenizer_path())


def test_ids_and_decoded_text_are_the_librarys(spark, library):
    rows = [(i, t, [1]) for i, t in enumerate(TEXTS)] + [(None, "no id", [1]), (2, TEXTS[2], [1])]
    df = spark.createDataFrame(rows, "doc_id long, text string, ids array<int>")
    want = {}
    for i, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids
        want[i] = (ids, library.decode(ids, skip_special_tokens=False))
    for block in (1 << 20, 400):
        got = bpe.encode(df, block_bytes=block)
        rows_out = got.collect()
        assert len(rows_out) == len(rows)
        assert all(r.ids == want[r.doc_id][0] for r in rows_out)
    assert {r.doc_id: r.text for r in bpe.decode(got).collect()} == {
        i: text for i, (_, text) in want.items()}
    for r in bpe.digests(df).collect():
        ids, text = want[r.doc_id]
        assert (r.n_tokens, r.ids_sha256, r.decoded_sha256) == (
            len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
            hashlib.sha256(text.encode()).hexdigest())


@settings(max_examples=300, deadline=None)
@given(st.text(st.characters(codec="utf-8", max_codepoint=0x2FFF), max_size=40))
def test_chunks_add_up_to_the_text(library, text):
    table = test_chunks_add_up_to_the_text.__dict__.setdefault("t", ChunkTable(tokenizer_path()))
    ids = library.encode(text, add_special_tokens=False).ids
    assert list(memoryview(table.encode(text)).cast("I")) == ids


def test_code_points_on_which_character_tables_differ(library):
    """Every code point up to U+33FF and in the blocks that grew of late, alone and in words."""
    table = ChunkTable(tokenizer_path())
    points = [*range(0x80, 0x3400), *range(0xA000, 0xAC00), *range(0xD7A4, 0xD800),
              *range(0xF900, 0x10000), *range(0x10000, 0x12000), *range(0x16100, 0x17000),
              *range(0x1D100, 0x1FC00), 0x2EBF0, 0x323AF, 0x323B0, 0xE0001, 0x10FFFF]
    for at in range(0, len(points), 256):
        part = list(map(chr, points[at:at + 256]))
        for text in (" ".join(part), " ".join(f"a{c}1" for c in part), "x" + "".join(part)):
            ids = library.encode(text, add_special_tokens=False).ids
            assert list(memoryview(table.encode(text)).cast("I")) == ids, hex(points[at])
    pair = chr(0x11935) + chr(0x11930)
    assert list(memoryview(table.encode(pair)).cast("I")) == library.encode(pair).ids[:]


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert bpe.digests(df).collect() == [] and bpe.encode(df).collect() == []


def test_ascii_text_is_cut_whole_and_words_are_kept_between_tasks(library):
    table = ChunkTable(tokenizer_path(), limit=50)
    for text in ("It's a test, isn't it?  We'LL see\x0b'S 'd''re 12a3\r\n\t(x_y)--" * 3, "", " \n",
                 " ".join(f"w{i}abc,D{i}" for i in range(200)), "\x00\x7f~ a\x0cb"):
        ids = library.encode(text, add_special_tokens=False).ids
        assert list(memoryview(table.encode(text)).cast("I")) == ids
    assert not table and 0 < len(table.words) <= 52  # no entry by chunk, and a bounded table
    assert chunk_table(tokenizer_path()) is chunk_table(tokenizer_path())

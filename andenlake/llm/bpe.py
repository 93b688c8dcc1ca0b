"""BPE encoding through a table of distinct words, and decoding through the piece table.

Texts are cut at white space. Every distinct chunk of the corpus is encoded once,
in the bucket of its hash (``blocks.exchange``), and its ids are joined back by
the chunk's position in each text. Decoding looks each id up in the piece table,
which has one row per id of the fixed vocabulary.

Inputs: null text counts as empty and has no ids. Repeated rows get a row each,
null ids too. Whole texts are encoded. Texts that hold the string of a special
token, or control characters at which the two sides would cut differently, go
through the tokenizer itself. Only ``doc_id`` and ``text`` are read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

from andenlake.llm.blocks import BLOCK_BYTES, exchange
from andenlake.llm.bpe_words import ChunkTable
from andenlake.llm.shared import map_batches, tokenizer_path


def bucket_of(word: bytes, buckets: int) -> int:
    import xxhash
    return xxhash.xxh64_intdigest(word) % buckets


def distinct_words(texts: list[bytes], odd, buckets: int) -> list[list[bytes]]:
    """Sorted distinct chunks by bucket, of the texts that are not ``odd``."""
    words: set[str] = set()
    for raw in texts:
        text = raw.decode()
        if not odd(text):
            words.update(text.split())
    out: list[list[bytes]] = [[] for _ in range(buckets)]
    for word in map(str.encode, words):
        out[bucket_of(word, buckets)].append(word)
    return [sorted(b) for b in out]


def pieces(path: str | None = None) -> dict[int, str]:
    """The piece table: id -> piece."""
    from tokenizers import Tokenizer
    return {i: p for p, i in Tokenizer.from_file(path or tokenizer_path())
            .get_vocab(with_added_tokens=True).items()}


def over_words(docs: DataFrame, per_text, schema: str, path: str | None = None,
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``per_text(ids of a text as bytes)`` gives the columns after doc_id; every distinct
    chunk is encoded once, whichever texts hold it."""
    place = path or tokenizer_path()
    held: dict = {}  # per Python worker: the table is made once

    def table() -> ChunkTable:
        if "t" not in held:
            held["t"] = ChunkTable(place)
        return held["t"]

    def keys(block, buckets):
        return [b"\n".join(words) for words in distinct_words(block["text"], table().odd, buckets)]

    def values(blobs):
        """For each chunk the number of its ids, then all ids."""
        lists = [blob.decode().split("\n") for blob in blobs]
        known = {w: table()[w] for w in set().union(*lists)}
        out = []
        for words in lists:
            ids = [known[w] for w in words]
            sizes = np.array([len(i) // 4 for i in ids], "<u4").tobytes()
            out.append(sizes + np.frombuffer(b"".join(ids), "<u4").astype("<u2").tobytes())
        return out

    def result(block, answers):
        known: dict[str, bytes] = {}
        for words, blob in zip(distinct_words(block["text"], table().odd, len(answers)), answers):
            sizes = np.frombuffer(blob, "<u4", len(words))
            ids = np.frombuffer(blob, "<u2", offset=4 * len(words)).astype("<u4").tobytes()
            ends = np.cumsum(sizes) * 4
            for word, a, b in zip(words, (ends - 4 * sizes).tolist(), ends.tolist()):
                known[word.decode()] = ids[a:b]
        rows = []
        for raw in block["text"]:
            text = raw.decode()
            ids = (table().encode(text) if table().odd(text)
                   else b"".join(map(known.__getitem__, text.split())))
            rows.append(per_text(ids))
        frame = pd.DataFrame(rows)
        frame.insert(0, "doc_id", block["doc_id"].astype("Int64"))
        return frame

    return exchange(docs, keys, values, result, schema, block_bytes=block_bytes)


def encode(docs: DataFrame, path: str | None = None,
           block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, ids: the ids of every text in order, no special tokens added."""
    return over_words(docs, lambda ids: {"ids": np.frombuffer(ids, "<u4").tolist()},
                      "doc_id long, ids array<int>", path, block_bytes)


def decode(encoded: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text from doc_id, ids: each id is joined with its piece, pieces are put
    together by position as the tokenizer does it (a space between pieces).

    The join is with the fixed piece table, held whole by every task; a null list
    of ids gives an empty text. An id outside the vocabulary has no piece."""
    place = path or tokenizer_path()

    def work(rows, piece):
        return {"doc_id": rows["doc_id"], "text": [
            " ".join(piece[i] for i in ids or [] if i in piece) for ids in rows["ids"]]}

    return map_batches(encoded.select("doc_id", "ids"), work, "doc_id long, text string",
                       lambda: pieces(place))


def digests(docs: DataFrame, path: str | None = None,
            block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens and SHA-256 of the ids and of the decoded text, from one pass."""
    place = path or tokenizer_path()
    held: dict = {}

    def per_text(ids: bytes) -> dict:
        if not held:
            known = pieces(place)
            size = max(known) + 1
            held["piece"] = np.array([known.get(i, "") for i in range(size)], object)
            held["number"] = np.array([str(i) for i in range(size)], object)
        row = np.frombuffer(ids, "<u4")
        said = [" ".join(held[k][row].tolist()).encode() for k in ("number", "piece")]
        return {"n_tokens": len(row), "ids_sha256": hashlib.sha256(said[0]).hexdigest(),
                "decoded_sha256": hashlib.sha256(said[1]).hexdigest()}

    return over_words(docs, per_text, "doc_id long, n_tokens long, ids_sha256 string,"
                      " decoded_sha256 string", path, block_bytes)

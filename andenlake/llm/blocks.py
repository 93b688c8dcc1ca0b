"""Looking up corpus-wide tables for every word of every text, without a row per word.

Texts are dealt to blocks by a hash of the id. Each block makes a sorted list of
its distinct keys (words, n-grams) once, cut into one blob per bucket of the
key's hash. A bucket thus meets each distinct key of the corpus in one place,
works out its value once, and answers every block with a blob in the order of the
keys it was sent. A block then has the values of all its keys side by side.

What is shuffled is the text once (compressed), and the distinct keys of each
block, not the words of the corpus. Blocks and buckets grow in number with the
corpus and stay of a size, whatever a key's frequency: a frequent key occurs once
in each block.
"""

from __future__ import annotations

from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from andenlake.llm.shared import block_count, map_batches, texts

#: Text of a block.
BLOCK_BYTES = 24 << 20


def exchange(docs: DataFrame, keys: Callable[[pd.DataFrame, int], list[bytes]],
             values: Callable[[list[bytes]], list[bytes]],
             result: Callable[[pd.DataFrame, list[bytes]], pd.DataFrame], schema: str,
             *more: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``keys(block, buckets)``: the block's distinct keys as one blob for each bucket.
    ``values(blobs)``: the blobs of one bucket, answered one by one.
    ``result(block, answers)``: result rows from the block and its answers by bucket.

    ``block`` has doc_id, text (UTF-8 bytes) and ``more``; rows are in a fixed order."""
    count = block_count(docs, block_bytes)

    def squeeze(rows):
        import zstandard
        pack = zstandard.ZstdCompressor(3).compress
        return {**rows, "utf8": [pack(t) for t in rows["utf8"]]}

    extra = "".join(f", {c} {dict(docs.dtypes)[c]}" for c in more)
    place = F.pmod(F.xxhash64(F.coalesce("doc_id", F.crc32(F.col("text").cast("binary")))),
                   F.lit(count))
    rows = map_batches(texts(docs, *more, place.cast("int").alias("block")), squeeze,
                       f"doc_id long, utf8 binary{extra}, block int")
    blocks = rows.groupBy("block")

    def unpack(block: pd.DataFrame) -> pd.DataFrame:
        import zstandard
        raw = zstandard.ZstdDecompressor().decompress
        block = block.sort_values(["doc_id", "utf8"], kind="stable", ignore_index=True)
        return block.assign(text=[raw(t) for t in block["utf8"]]).drop(columns="utf8")

    def ask(block):
        import zstandard
        pack = zstandard.ZstdCompressor(3).compress
        sent = [(b, blob) for b, blob in enumerate(keys(unpack(block), count)) if blob]
        return pd.DataFrame({"bucket": [b for b, _ in sent], "block": block["block"].iloc[0],
                             "blob": [pack(blob) for _, blob in sent]})

    def answer(bucket):
        import zstandard
        raw, pack = zstandard.ZstdDecompressor().decompress, zstandard.ZstdCompressor(3).compress
        said = values([raw(b) for b in bucket["blob"]])
        return bucket.assign(blob=[pack(b) for b in said])

    def finish(block, answers):
        import zstandard
        raw = zstandard.ZstdDecompressor().decompress
        got = [b""] * count
        for bucket, blob in zip(answers["bucket"], answers["blob"]):
            got[bucket] = raw(blob)
        return result(unpack(block), got)

    asked = blocks.applyInPandas(ask, "bucket int, block int, blob binary")
    answers = asked.groupBy("bucket").applyInPandas(answer, "bucket int, block int, blob binary")
    return blocks.cogroup(answers.groupBy("block")).applyInPandas(finish, schema)

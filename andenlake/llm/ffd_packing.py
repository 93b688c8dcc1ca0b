"""First-fit decreasing with a tournament tree, in randomised groups of documents.

A document is its token ids and an end id. What fills whole sequences is cut off as it
is encoded; of each document less than one sequence is left. Those rests are dealt at
random to groups of bounded size, and each group is packed by itself: longest rest first,
each into the first sequence with room for it. A tournament tree over the sequences'
room (every node holds the larger room of its two) finds that sequence in as many steps
as the tree is high.

First-fit decreasing leaves gaps, much of them where most rests are longer than half a
sequence. As documents may be cut freely, the emptiest sequences are then poured into
the gaps of the fullest. At most one sequence of a group stays open; it is divided into
sequences whose lengths are powers of two, which need no padding. So nothing is padded.

Groups are dealt by a random number of the row, not by its id or text: equal ids, equal
texts and rows without id spread like any other. Rows of a group are sorted before they
are packed, so the result depends on nothing but the numbers drawn, which a recomputed
task draws again.

Inputs: null and empty texts are one token (the end id alone). Repeated rows are packed
each. A null ``doc_id`` is carried along. An empty table gives no rows. Only ``doc_id``
and ``text`` are read.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from andenlake.llm.shared import map_batches, texts, to_arrow, tokenizer_path

CAPACITY = 2048
END_ID = 1
TOKENIZER = "byte_bpe_50k.json"
RANKS = "byte_bpe_50k.tiktoken"
#: Rows and bytes of text of a group, on average.
GROUP_ROWS = 4096
GROUP_BYTES = 1 << 23
SEED = 13
#: The faster encoder's pattern recurses over runs of white space; longer ones are left to the other.
LONGEST_SPACE = 2000

PARTS = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, ids binary"
PIECES = ("doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
          "sequence_id long, offset long")


class Encoder:
    """Ids of the byte-level vocabulary: by its rank table where that is known to agree, by
    the tokenizer's own file for texts that hold a special token or a very long run of
    white space."""

    def __init__(self, path: str, ranks: str):
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer
        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        with open(ranks, "rb") as lines:
            table = {base64.b64decode(piece): int(rank) for piece, rank in map(bytes.split, lines)}
        self.plain = tiktoken.Encoding("bytes", pat_str=public_tokenizers.PATTERN,
                                       mergeable_ranks=table, special_tokens={}).encode_ordinary
        self.blank = re.compile(rf"\s{{{LONGEST_SPACE}}}").search

    def __call__(self, text: str) -> list[int]:
        if any(s in text for s in self.special) or len(text) > LONGEST_SPACE and self.blank(text):
            return self.tokenizer.encode(text, add_special_tokens=False).ids
        return self.plain(text)


def parts(docs: DataFrame, tokenizer: str, ranks: str, capacity: int = CAPACITY,
          end_id: int = END_ID) -> DataFrame:
    """Whole sequences of each document (``ids`` null), and its rest with its ids."""
    names = [f.split()[0] for f in PARTS.split(", ")]

    def work(rows, encode):
        out = {n: [] for n in names}
        for doc, utf8 in zip(rows["doc_id"], rows["utf8"]):
            ids = encode(utf8.decode())
            ids.append(end_id)
            data, total = np.array(ids, "<u4").tobytes(), len(ids)
            for at in range(0, total, capacity):
                part = data[4 * at:4 * (at + capacity)]
                whole = len(part) == 4 * capacity
                row = (doc, at, len(part) // 4, zlib.crc32(part) if whole else None, total,
                       None if whole else part)
                for n, value in zip(names, row):
                    out[n].append(value)
        return out

    return map_batches(texts(docs), work, PARTS, lambda: Encoder(tokenizer, ranks))


class Tournament:
    """Room of a row of sequences; each inner node holds the larger room of its two."""

    def __init__(self, bins: int, capacity: int):
        self.leaves = 1 << max(0, bins - 1).bit_length()
        self.room = [capacity] * (2 * self.leaves)

    def place(self, size: int) -> int:
        """The first sequence with room for ``size``, its room reduced by that."""
        room, at = self.room, 1
        while at < self.leaves:
            at *= 2
            at += room[at] < size
        found = at - self.leaves
        room[at] -= size
        while at > 1:
            at //= 2
            room[at] = max(room[2 * at], room[2 * at + 1])
        return found


def first_fit(sizes: list[int], capacity: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of (item, start in it, length), for sizes in falling order."""
    tree, bins = Tournament(len(sizes), capacity), []
    for item, size in enumerate(sizes):
        at = tree.place(size)
        if at == len(bins):  # first fit opens them in order
            bins.append([])
        bins[at].append((item, 0, size))
    return bins


def close_gaps(bins: list[list[tuple[int, int, int]]], capacity: int
               ) -> list[list[tuple[int, int, int]]]:
    """Pours the emptiest sequences into the gaps of the fullest, pieces cut as the gaps need
    it; the one that may stay open is divided at powers of two."""
    def filled(b):
        return sum(n for _, _, n in b)

    bins = sorted(bins, key=filled, reverse=True)
    low, high = 0, len(bins) - 1
    while low < high:
        gap = capacity - filled(bins[low])
        while gap and low < high:
            item, start, n = bins[high].pop()
            take = min(gap, n)
            bins[low].append((item, start, take))
            if take < n:
                bins[high].append((item, start + take, n - take))
            gap -= take
            high -= not bins[high]
        low += not gap
    return bins[:low] + [b for last in bins[low:high + 1] for b in _halved(last, capacity)]


def _halved(pieces: list[tuple[int, int, int]], capacity: int) -> Iterator[list]:
    total = sum(n for _, _, n in pieces)
    if total == capacity:
        yield pieces
        return
    left = list(reversed(pieces))
    for bit in reversed(range(total.bit_length())):
        room, part = total & 1 << bit, []
        while room:
            item, start, n = left.pop()
            take = min(room, n)
            part.append((item, start, take))
            if take < n:
                left.append((item, start + take, n - take))
            room -= take
        if part:
            yield part


def pack_group(group: int, rows: pa.Table, capacity: int, schema: pa.Schema) -> pa.Table:
    """All pieces of one group with their places; sequences are numbered from the group's own."""
    rows = rows.sort_by([("length", "descending"), ("doc_id", "ascending"),
                         ("start", "ascending"), ("ids_crc32", "ascending"),
                         ("ids", "ascending")])
    length, start = (rows[n].to_numpy() for n in ("length", "start"))
    whole = int((length == capacity).sum())
    ids = rows["ids"].slice(whole).to_pylist()
    bins = close_gaps(first_fit(length[whole:].tolist(), capacity), capacity)
    row, first, size, crc, sequence, offset = ([] for _ in range(6))
    for number, pieces in enumerate(bins, whole):
        at = 0
        for item, begin, n in pieces:
            for out, value in zip((row, first, size, crc, sequence, offset), (
                    whole + item, begin, n, zlib.crc32(ids[item][4 * begin:4 * (begin + n)]),
                    number, at)):
                out.append(value)
            at += n
    index = np.concatenate([np.arange(whole), np.array(row, "i8")])
    zeros = np.zeros(whole, "i8")
    done = rows.select(["doc_id", "doc_tokens"]).take(pa.array(index))
    return pa.table([
        done["doc_id"], start[index] + np.concatenate([zeros, np.array(first, "i8")]),
        np.concatenate([length[:whole], np.array(size, "i8")]),
        np.concatenate([rows["ids_crc32"].slice(0, whole).to_numpy(), np.array(crc, "i8")]),
        done["doc_tokens"],
        (group << 32) + np.concatenate([np.arange(whole), np.array(sequence, "i8")]),
        np.concatenate([zeros, np.array(offset, "i8")])], schema=schema)


def group_count(docs: DataFrame) -> int:
    """Enough groups for rows and bytes alike; grows with the corpus."""
    rows, size = docs.agg(F.count("*"), F.sum(F.octet_length("text"))).first()
    return max(1, -(-rows // GROUP_ROWS), -(-(size or 0) // GROUP_BYTES))


def pack(docs: DataFrame, tokenizer: str | None = None, ranks: str | None = None,
         capacity: int = CAPACITY, end_id: int = END_ID) -> DataFrame:
    """One row per piece with its place; lengths of sequences are ``capacity`` or powers of two."""
    spark = docs.sparkSession
    schema = to_arrow(spark, PIECES)
    groups = group_count(docs)
    dealt = parts(docs, tokenizer or tokenizer_path(TOKENIZER), ranks or tokenizer_path(RANKS),
                  capacity, end_id).withColumn("lot", F.floor(F.rand(SEED) * groups))

    def work(key, rows):
        return pack_group(key[0].as_py(), rows, capacity, schema)

    return dealt.groupBy("lot").applyInArrow(work, PIECES)

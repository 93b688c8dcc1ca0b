"""Cross-entropy difference between two matched bigram models.

The target model is counted on the rows marked as target, the background model
on all rows. They are matched: the same order, the same smoothing, one shared
vocabulary (every word of the corpus), and background counts scaled to the
target's number of tokens, so neither is smoothed more than the other. A
document's score is the mean over its tokens of target loss minus background
loss, in nats: the lower, the closer to the target. A document's own counts are
taken out of both models when it is scored, so target rows have no advantage.

Counts are exact and over the whole corpus. They are summed by n-gram and brought
back to the documents by ``blocks.exchange``.

Inputs: null and empty texts have no tokens and null losses and score. Rows with
null id cannot be target. Repeated rows are counted and scored each. Without
target tokens all scores are null; an empty table gives no rows. Target ids that
are null, repeated, or not in the table have no effect.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from andenlake.llm.blocks import exchange

#: Pseudo-tokens that a context's distribution borrows from the word distribution.
CONTEXT_PRIOR = 20.0
#: Pseudo-count of every word of the vocabulary.
WORD_PRIOR = 0.1
BLOCK_BYTES = 12 << 20
START = np.uint64(0x9E3779B97F4A7C15)  # stands before the first word


class WordHash(dict):
    """word -> 64-bit hash, each distinct word hashed once."""

    def __missing__(self, word: bytes) -> int:
        import xxhash
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


def bigrams(words: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Hash of (previous word, word) at every token; START before each text."""
    before = np.empty_like(words)
    before[1:] = words[:-1]
    before[starts] = START
    mixed = before * np.uint64(0xBF58476D1CE4E5B9) + words
    mixed ^= mixed >> np.uint64(29)
    mixed *= np.uint64(0x94D049BB133111EB)
    return mixed ^ mixed >> np.uint64(32)


def tokens(texts) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the lower-cased words of all texts, and the number of words of each."""
    known, out, sizes = WordHash(), [], []
    for raw in texts:
        words = raw.decode().lower().encode().split()
        out.append(np.fromiter(map(known.__getitem__, words), "u8", len(words)))
        sizes.append(len(words))
    return np.concatenate(out) if out else np.empty(0, "u8"), np.array(sizes, "i8")


def lines_of(block: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray]:
    """The documents of a block, and which are target. Marks are rows of their own."""
    marks = set(block.loc[block["mark"], "doc_id"].dropna())
    docs = block[~block["mark"]].reset_index(drop=True)
    return docs, docs["doc_id"].isin(marks).to_numpy() & docs["doc_id"].notna().to_numpy()


def counted(block: pd.DataFrame):
    """Sorted distinct words and bigrams of a block with their counts in all and in target."""
    docs, target = lines_of(block)
    words, sizes = tokens(docs["text"])
    starts = (np.cumsum(sizes) - sizes)[sizes > 0]
    inside = np.repeat(target, sizes)
    out = []
    for keys in (words, bigrams(words, starts)):
        distinct, where = np.unique(keys, return_inverse=True)
        out.append((distinct, np.bincount(where, minlength=len(distinct)),
                    np.bincount(where[inside], minlength=len(distinct))))
    return docs, target, words, sizes, starts, out


def cut(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket's range of hashes begins in the sorted keys, and the end."""
    edges = [np.uint64((1 << 64) * b // buckets) for b in range(1, buckets)]
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]]).astype(int)


def to_blob(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> bytes:
    """Sorted keys as differences, and their two counts."""
    sizes = np.array([len(k) for k, _, _ in parts], "<u8").tobytes()
    return sizes + b"".join(
        np.diff(k, prepend=np.uint64(0)).astype("<u8").tobytes() + a.astype("<u8").tobytes()
        + t.astype("<u8").tobytes() for k, a, t in parts)


def from_blob(blob: bytes) -> list[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    sizes, at, parts = np.frombuffer(blob, "<u8", 2).tolist(), 16, []
    for n in sizes:
        k, a, t = (np.frombuffer(blob, "<u8", n, at + 8 * n * i) for i in range(3))
        parts.append((np.cumsum(k, dtype="u8"), a, t))
        at += 24 * n
    return parts


def score(docs: DataFrame, target_ids: DataFrame, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """doc_id, n_tokens, target_loss, background_loss, score for each row of ``docs``;
    ``target_ids`` has the doc_id of the target rows."""
    def keys(block, buckets):
        *_, parts = counted(block)
        edges = [cut(k, buckets) for k, _, _ in parts]
        return [to_blob([tuple(x[e[b]:e[b + 1]] for x in part) for part, e in zip(parts, edges)])
                for b in range(buckets)]

    def values(blobs):
        """Corpus counts of the keys of every blob, after the bucket's number of words and
        its tokens in all and in target."""
        sent = [from_blob(blob) for blob in blobs]
        answers, head = [[] for _ in blobs], []
        for kind in (0, 1):
            every = np.concatenate([s[kind][0] for s in sent])
            distinct, where = np.unique(every, return_inverse=True)
            sums = []
            for column in (1, 2):
                total = np.zeros(len(distinct), "u8")
                np.add.at(total, where, np.concatenate([s[kind][column] for s in sent]))
                sums.append(total)
            if kind == 0:
                head = [len(distinct), int(sums[0].sum()), int(sums[1].sum())]
            ends = np.cumsum([len(s[kind][0]) for s in sent])
            for k, mine in enumerate(np.split(where, ends[:-1])):
                answers[k] += [total[mine].astype("<u8").tobytes() for total in sums]
        first = np.array(head, "<u8").tobytes()
        return [first + b"".join(a) for a in answers]

    def result(block, answers):
        docs, target, words, sizes, starts, parts = counted(block)
        edges = [cut(k, len(answers)) for k, _, _ in parts]
        heads = np.stack([np.frombuffer(a, "<u8", 3) for a in answers]).sum(0).astype("f8")
        sums = []
        for kind, (k, _, _) in enumerate(parts):
            total = np.zeros((2, len(k)))
            for b, blob in enumerate(answers):
                n = [int(e[b + 1] - e[b]) for e in edges]
                at = 24 + 16 * n[0] * kind
                total[:, edges[kind][b]:edges[kind][b + 1]] = np.frombuffer(
                    blob, "<u8", 2 * n[kind], at).reshape(2, -1)
            sums.append(total)
        frame = losses(words, sizes, starts, target, [k for k, _, _ in parts], sums, heads)
        frame.insert(0, "doc_id", docs["doc_id"].astype("Int64"))
        return frame

    marks = target_ids.select(F.col("doc_id").cast("long").alias("doc_id"),
                              F.lit(None).cast("string").alias("text"), F.lit(True).alias("mark"))
    both = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text",
                       F.lit(False).alias("mark")).unionByName(marks.filter("doc_id is not null"))
    return exchange(both, keys, values, result, "doc_id long, n_tokens long, target_loss double,"
                    " background_loss double, score double", "mark", block_bytes=block_bytes)


def losses(words, sizes, starts, target, keys, sums, heads) -> pd.DataFrame:
    """Mean losses of each text. ``sums``: corpus counts (all, target) by distinct word and
    bigram; ``heads``: size of the vocabulary, tokens in all, tokens in target."""
    vocabulary, tokens_all, tokens_target = heads
    pairs = bigrams(words, starts)
    at = [np.searchsorted(k, x) for k, x in zip(keys, (words, pairs))]
    text = np.repeat(np.arange(len(sizes)), sizes)
    own = [_own(text, x) for x in at]
    before = np.roll(at[0], 1)
    own_before = np.roll(own[0], 1)
    first = np.zeros(len(words), bool)
    first[starts] = True
    loss = []
    for column, size, mine in ((1, tokens_target, target[text].astype("f8")),
                               (0, tokens_all, np.ones(len(words)))):
        held = size - sizes[text] * mine
        scale = tokens_target / max(size, 1.0)
        word = np.maximum(sums[0][column][at[0]] - own[0] * mine, 0) * scale
        pair = np.maximum(sums[1][column][at[1]] - own[1] * mine, 0) * scale
        context = np.maximum(sums[0][column][before] - own_before * mine, 0) * scale
        context[first] = 0
        pair[first] = 0  # the first word of a text is scored by the word distribution
        p = (word + WORD_PRIOR) / (np.maximum(held, 0) * scale + WORD_PRIOR * vocabulary)
        p = (pair + CONTEXT_PRIOR * p) / (np.maximum(context, pair) + CONTEXT_PRIOR)
        loss.append(np.bincount(text, -np.log(p), len(sizes)))
    known = (sizes > 0) & (tokens_target > 0)
    mean = [np.where(known, x / np.maximum(sizes, 1), np.nan) for x in loss]
    frame = pd.DataFrame({"n_tokens": sizes, "target_loss": mean[0], "background_loss": mean[1],
                          "score": mean[0] - mean[1]})
    return frame.astype(object).where(frame.notna(), None)


def _own(text: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How often each token's key occurs in its own text."""
    order = np.lexsort((key, text))
    new = np.concatenate([[True], (np.diff(text[order]) != 0) | (np.diff(key[order]) != 0)]) \
        if len(text) else np.empty(0, bool)
    group = np.cumsum(new) - 1
    out = np.empty(len(text), "f8")
    out[order] = np.bincount(group)[group] if len(text) else 0
    return out

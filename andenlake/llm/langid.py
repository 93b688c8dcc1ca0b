"""Language identification by segmentation-marginalised unigrams.

For each language every piece of a fixed public vocabulary has a probability. A
word may be cut into pieces in many ways; the forward algorithm sums over all of
them, so a word's likelihood does not hang on one tokenisation. Probabilities
are learned by expectation-maximisation over the same lattices. A text's
log-likelihood is the sum over its words; the posterior under equal priors is
the score.

Words are runs of letters, lower-cased; runs of more than ``LONGEST`` letters
are cut there. Every byte is a piece, so no word is impossible.

Inputs: null texts and texts without letters are ``und`` with score 0, as is
every text if there is nothing to learn from. Ties go to the first language by
name. Repeated rows get a row each. Training takes a bounded sample, at most
about ``PER_LANGUAGE`` documents of each language, chosen by a hash of the id;
null ``lang`` or ``doc_id`` rows are not trained on. Only ``doc_id``, ``text``
and ``lang`` are read, ``lang`` by training alone.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from andenlake.llm.bpe_words import byte_letters
from andenlake.llm.shared import map_batches, stored, texts, tokenizer_path

UNKNOWN = "und"
#: The bound of the training sample, in documents of a language.
PER_LANGUAGE = 400
#: The most frequent labels that are learned; bounds the model.
LANGUAGES = 1000
ROUNDS = 3
LONGEST = 32
#: Added to every expected count.
SMOOTHING = 0.02
#: Probabilities are scaled by this per byte, which keeps long words in range.
SCALE = 50.0
CACHE = 200_000
WORDS = re.compile(rf"[^\W\d_]{{1,{LONGEST}}}")
END = b"\xff"  # closes a word; never occurs in UTF-8


def vocabulary(path: str | None = None) -> list[bytes]:
    """Pieces as bytes, a closing END where the piece ends a word."""
    back = {c: bytes([b]) for b, c in enumerate(byte_letters())}
    vocab = json.load(open(path or tokenizer_path(), encoding="utf-8"))["model"]["vocab"]
    out = []
    for piece in sorted(vocab, key=vocab.get):
        word = piece.removesuffix("</w>")
        raw = b"".join(back[c] for c in word)
        if raw and END not in raw:
            out.append(raw + END * (word != piece))
    return list(dict.fromkeys(out))


def lookup(pieces: list[bytes]) -> dict[int, list]:
    """A tree of the pieces: for each byte the length and number of the piece that ends there,
    as ``length << 20 | number`` (-1: none does), and the tree of what goes on from it."""
    root = {}
    for i, piece in enumerate(pieces):
        node, entry = root, None
        for byte in piece:
            entry = node.setdefault(byte, [-1, {}])
            node = entry[1]
        entry[0] = len(piece) << 20 | i
    return root


def words_of(text: str) -> list[str]:
    return WORDS.findall(text.lower())


class Lattice:
    """All segmentations of a batch of words, as edges between byte positions."""

    def __init__(self, words: list[str], pieces: dict[int, list]):
        edges, first = [], 0
        starts, lengths = [], []
        add = edges.append
        for word in words:
            raw = word.encode() + END
            n = len(raw)
            for i in range(n - 1):
                place, node = first + i << 40, pieces
                for byte in raw[i:]:
                    entry = node.get(byte)
                    if entry is None:
                        break
                    k, node = entry
                    if k >= 0:
                        add(place + k)
            starts.append(first)
            lengths.append(n)
            first += n + 1
        packed = np.array(edges, "i8")
        source, self.size = packed >> 40, first
        target = source + (packed >> 20 & 0xFFFFF)
        self.starts, self.lengths = np.array(starts, "i8"), np.array(lengths, "i8")
        self.ends = self.starts + self.lengths
        own = np.repeat(self.starts, self.lengths + 1)[source]
        level = (target - own).astype("i2")  # LONGEST letters have at most 128 bytes
        order = np.argsort(level, kind="stable")  # in a level the words' order is the targets'
        self.source, self.target = source[order], target[order]
        self.piece = packed[order] & 0xFFFFF
        self.bounds = np.flatnonzero(np.diff(level[order], prepend=-1, append=-1))
        self.own = own[order]

    def forward(self, prob: np.ndarray) -> np.ndarray:
        """Summed probability of reaching each position; ``prob`` is pieces x languages."""
        alpha = np.zeros((self.size, prob.shape[1]))
        alpha[self.starts] = 1
        for a, b in zip(self.bounds, self.bounds[1:]):
            step = alpha[self.source[a:b]] * prob[self.piece[a:b]]
            target = self.target[a:b]
            cut = np.flatnonzero(np.diff(target, prepend=-1))
            alpha[target[cut]] = np.add.reduceat(step, cut, axis=0)
        return alpha

    def backward(self, prob: np.ndarray) -> np.ndarray:
        """From each position to the word's end: edges by the place they leave, last first."""
        begin = self.own - self.source
        back = np.lexsort((self.source, begin))
        bounds = np.flatnonzero(np.diff(begin[back], prepend=1, append=1))
        beta = np.zeros((self.size, prob.shape[1]))
        beta[self.ends] = 1
        for a, b in zip(bounds, bounds[1:]):
            edge = back[a:b]
            step = beta[self.target[edge]] * prob[self.piece[edge]]
            cut = np.flatnonzero(np.diff(self.source[edge], prepend=-1))
            beta[self.source[edge][cut]] = np.add.reduceat(step, cut, axis=0)
        return beta

    def log_likelihood(self, prob: np.ndarray) -> np.ndarray:
        total = self.forward(prob)[self.ends]
        return np.log(np.maximum(total, 1e-300)) - np.log(SCALE) * self.lengths[:, None]

    def expected(self, prob: np.ndarray, counts: np.ndarray) -> np.ndarray:
        """Expected uses of each piece, the words weighted by ``counts`` (words x languages)."""
        alpha, beta = self.forward(prob), self.backward(prob)
        word = np.repeat(np.arange(len(self.ends)), self.lengths + 1)
        share = counts / np.maximum(alpha[self.ends], 1e-300)
        uses = (alpha[self.source] * prob[self.piece] * beta[self.target]
                * share[word[self.source]])
        return np.stack([np.bincount(self.piece, x, len(prob)) for x in uses.T], 1)


class Model:
    """Languages, pieces and their log probabilities; what a task needs to predict."""

    def __init__(self, languages: list[str], pieces: list[bytes], probability: np.ndarray):
        self.languages, self.pieces = languages, pieces
        self.bytes = np.array([len(p) for p in pieces])
        self.probability = probability
        self.scaled = probability * SCALE ** self.bytes[:, None]

    @classmethod
    def start(cls, languages: list[str], pieces: list[bytes]) -> Model:
        """Equal for all languages: the same probability for pieces of the same length."""
        weight = np.array([0.25 ** len(p) for p in pieces])
        return cls(languages, pieces, np.repeat((weight / weight.sum())[:, None],
                                                len(languages), axis=1))


def training_rows(docs: DataFrame, per_language: int = PER_LANGUAGE) -> DataFrame:
    """At most about ``per_language`` labelled rows of each language outside the held-out
    fifth; the lowest hashes of the id, at a rate that follows from the language's count."""
    mine = docs.select("doc_id", "text", "lang").filter(
        F.col("text").isNotNull() & F.col("lang").isNotNull()
        & (F.crc32(F.col("doc_id").cast("string")) % 5 != 0))
    rates = (mine.groupBy("lang").agg(F.count("*").alias("n")).orderBy(F.desc("n"), "lang")
             .limit(LANGUAGES).select("lang", (F.lit(per_language) / F.col("n")).alias("rate")))
    at = F.pmod(F.xxhash64("doc_id"), F.lit(1_000_003)) / 1_000_003
    return mine.join(F.broadcast(rates), "lang").filter(at < F.col("rate")).select("doc_id", "text", "lang")


def train(docs: DataFrame, per_language: int = PER_LANGUAGE, rounds: int = ROUNDS,
          path: str | None = None) -> Model:
    """Expectation-maximisation on the word counts of the sample.

    Every round is one pass over the stored counts; what reaches the driver is one
    number for each piece and language."""
    pieces = vocabulary(path)
    ids = lookup(pieces)

    def split(rows):
        pairs = [(lang, w) for lang, t in zip(rows["lang"], rows["utf8"])
                 for w in words_of(t.decode())]
        got = pd.Series(1, index=pd.MultiIndex.from_tuples(pairs, names=["lang", "word"])
                        ).groupby(level=[0, 1]).sum() if pairs else pd.Series(dtype="i8")
        return {"lang": [k[0] for k in got.index], "word": [k[1] for k in got.index],
                "n": pa.array(got.to_numpy(), pa.int64())}

    counts = stored(
        map_batches(texts(training_rows(docs, per_language), "lang"), split,
                    "lang string, word string, n long")
        .groupBy("lang", "word").agg(F.sum("n").alias("n")), "words")
    languages = [r.lang for r in counts.select("lang").distinct().orderBy("lang").collect()]
    model = Model.start(languages, pieces)
    column = {lang: k for k, lang in enumerate(languages)}
    for _ in range(rounds if languages else 0):
        scaled = model.scaled

        def expect(frames, scaled=scaled):
            total = np.zeros_like(scaled)
            for frame in frames:
                weight = np.zeros((len(frame), len(column)))
                weight[np.arange(len(frame)), frame["lang"].map(column)] = frame["n"]
                for a in range(0, len(frame), 4000):
                    part = Lattice(frame["word"].tolist()[a:a + 4000], ids)
                    total += part.expected(scaled, weight[a:a + 4000])
            piece, lang = np.nonzero(total)
            yield pd.DataFrame({"piece": piece, "lang": lang, "uses": total[piece, lang]})

        uses = np.full(scaled.shape, SMOOTHING)
        got = (counts.mapInPandas(expect, "piece long, lang long, uses double")
               .groupBy("piece", "lang").agg(F.sum("uses").alias("uses")).toPandas())
        uses[got["piece"], got["lang"]] += got["uses"]
        model = Model(languages, pieces, uses / uses.sum(0))
    return model


class Scorer(dict):
    """word -> row of its log likelihoods by language, computed for many new words at once."""

    def __init__(self, model: Model, limit: int = CACHE):
        self.model, self.limit = model, limit
        self.ids = lookup(model.pieces)
        self.rows = np.empty((0, len(model.languages)))

    def learn(self, batch: list[list[str]]) -> None:
        new = list({w for words in batch for w in words if w not in self})
        if len(self) + len(new) > self.limit:
            self.clear()
            self.rows = self.rows[:0]
            new = list({w for words in batch for w in words})
        parts = [self.rows]
        for a in range(0, len(new), 4000):
            parts.append(Lattice(new[a:a + 4000], self.ids).log_likelihood(self.model.scaled))
        self.update(zip(new, range(len(self.rows), len(self.rows) + len(new))))
        self.rows = np.concatenate(parts)

    def posteriors(self, batch: list[list[str]]) -> np.ndarray:
        self.learn(batch)
        total = np.stack([self.rows[[self[w] for w in words]].sum(0) for words in batch])
        share = np.exp(total - total.max(1, keepdims=True))
        return share / share.sum(1, keepdims=True)


def judged(batch: list[str], scorer: Scorer) -> tuple[list[str], list[float]]:
    """Language and posterior of every text. Words are made for a few texts at a time."""
    lang, score = [UNKNOWN] * len(batch), [0.0] * len(batch)
    for a in range(0, len(batch) if scorer.model.languages else 0, 250):
        found = {k: words_of(batch[k]) for k in range(a, min(a + 250, len(batch)))}
        sure = [k for k, words in found.items() if any(c.isalpha() for w in words for c in w)]
        if not sure:
            continue
        share = scorer.posteriors([found[k] for k in sure])
        for k, best, row in zip(sure, share.argmax(1), share):
            lang[k], score[k] = scorer.model.languages[best], float(row[best])
    return lang, score


def predict(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, lang_pred, score: one row for each row of ``docs``."""
    def work(rows, scorer):
        lang, score = judged([t.decode() for t in rows["utf8"]], scorer)
        return {"doc_id": rows["doc_id"], "held_out": rows["held_out"], "lang_pred": lang,
                "score": score}

    held = F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 5 == 0, F.lit(False))
    return map_batches(texts(docs, held.alias("held_out")), work, "doc_id long, held_out boolean,"
                       " lang_pred string, score double", lambda: Scorer(model))


def identify(docs: DataFrame, **options) -> DataFrame:
    return predict(docs, train(docs, **options))


def recognised(docs: DataFrame, model: Model, min_score: float = 0.0) -> DataFrame:
    """The rows of ``docs`` that are in some language, with a null ``lang`` filled in.

    Rejected are texts that are ``und`` or have a score below ``min_score``."""
    def run(batches):
        scorer = Scorer(model)
        for batch in batches:
            raw = batch.column("text").to_pylist()
            lang, score = judged([(t or "") for t in raw], scorer)
            fits = [x != UNKNOWN and s >= min_score for x, s in zip(lang, score)]
            i = batch.schema.get_field_index("lang")
            old = batch.column(i).to_pylist()
            filled = pa.array([a if a is not None else b for a, b in zip(old, lang)],
                              batch.schema.field(i).type)
            yield batch.set_column(i, batch.schema.field(i), filled).filter(pa.array(fits))

    return docs.mapInArrow(run, docs.schema)

"""Secret scan: fixed patterns, and values after credential words judged by guess cost.

The base kinds are three patterns. Every value that follows a credential word, inside a
base span or not, is judged by how many guesses it would take: dynamic programming finds
the cheapest segmentation into dictionary words (rank in a fixed public vocabulary),
dates, repeats, keyboard walks and brute-force spans. Values from ``MIN_COST`` on are spans
of kind ``guess``; base spans stay as they are.

Inputs: null text counts as empty and gives no spans. Whole texts are scanned; the
segments of a value are found by an automaton and by run lengths and visited once, so the
program is linear in its length. Repeated rows get a row each. Only
``doc_id`` and ``text`` are read. Positions are code points, ends exclusive.
"""

from __future__ import annotations

import hashlib
import json
import math
import re

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from andenlake.llm.shared import map_batches, texts, tokenizer_path

KINDS = ["assign", "access", "hex", "guess"]
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?"""
                    r"([A-Za-z0-9+/_.=-]+)", re.I | re.A)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{32,}")  # the runs of [0-9a-f]+ that are long enough
#: A credential word, a separator, and the value up to a space, quote or bracket.
CONTEXT = re.compile(
    r"""(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|credentials?|(?:api|access|private"""
    r"""|secret)[_\x20-]?key)["']?\x20{0,4}(?:[:=]|=>|\bis\b)\x20{0,4}["']?"""
    r"""([^\s"'<>()\[\]{},;]{6,})""", re.I | re.A)
#: log10 of the guesses from which a value counts as secret.
MIN_COST = 7.0
LONGEST_WORD = 24
#: The rows of the common keyboard, and substitutions for letters.
ROWS = ["1234567890", "qwertyuiop", "asdfghjkl", "zxcvbnm"]
SUBSTITUTES = {"4": "a", "@": "a", "3": "e", "1": "l", "!": "i", "0": "o", "5": "s", "$": "s",
               "7": "t"}

DATE = re.compile(r"(?=((?:19|20)\d\d(?:[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01]))?"
                  r"|(?:0?[1-9]|[12]\d|3[01])[-/.](?:0?[1-9]|1[0-2])[-/.](?:(?:19|20)\d\d|\d\d)))")
#: Longest unit of a repeat.
UNIT = 8


def near_keys() -> dict[str, set[str]]:
    """Keys beside each key: in the row, and above or below it."""
    near: dict[str, set[str]] = {}
    for r, row in enumerate(ROWS):
        for c, key in enumerate(row):
            beside = [(r, c - 1), (r, c + 1), (r - 1, c), (r - 1, c + 1), (r + 1, c - 1),
                      (r + 1, c)]
            near[key] = {ROWS[i][j] for i, j in beside
                         if 0 <= i < len(ROWS) and 0 <= j < len(ROWS[i])}
    return near


def run_lengths(same: np.ndarray) -> np.ndarray:
    """For each place, how many places from there on are true without a gap."""
    n = len(same)
    stops = np.where(same, n, np.arange(n))
    return np.minimum.accumulate(stops[::-1])[::-1] - np.arange(n)


class GuessCost:
    """log10 of the guesses for a value, over a word list given by rank."""

    def __init__(self, ranks: dict[str, int]):
        import ahocorasick
        self.plain = str.maketrans(SUBSTITUTES)
        self.ranks = {w: r for w, r in ranks.items() if 3 <= len(w) <= LONGEST_WORD}
        self.words = ahocorasick.Automaton()
        for word, rank in self.ranks.items():
            self.words.add_word(word, (len(word), math.log10(rank)))
        self.words.make_automaton()
        near = near_keys()
        self.first_turn = math.log10(len(near))
        self.beside = np.zeros((128, 128), bool)
        for key, others in near.items():
            self.beside[ord(key), [ord(o) for o in others]] = True

    @classmethod
    def from_vocabulary(cls, path: str) -> GuessCost:
        """Whole words of the vocabulary file; the id order stands for the rank."""
        vocab = json.load(open(path, encoding="utf-8"))["model"]["vocab"]
        words = [w.removesuffix("</w>") for w in sorted(vocab, key=vocab.get)
                 if w.endswith("</w>") and len(w) > 6]
        return cls({w: i + 1 for i, w in enumerate(words)})

    def _words(self, value: str, lower: str, plain: str):
        """Dictionary words; letters in upper case and substitutes double the guesses each."""
        double = math.log10(2)
        for last, (size, cost) in self.words.iter(lower) if self.ranks else ():
            at, end = last + 1 - size, last + 1
            yield at, end, cost + (double if value[at:end] != lower[at:end] else 0)
        for last, (size, cost) in self.words.iter(plain) if self.ranks and plain != lower else ():
            at, end = last + 1 - size, last + 1
            word = lower[at:end]
            if plain[at:end] != word and word not in self.ranks:
                yield at, end, cost + double + (double if value[at:end] != word else 0)

    def segments(self, value: str) -> list[tuple[int, int, float]]:
        """(start, end, cost) of all segments, brute force apart, by start. A repeat goes on
        as long as it can, in its shortest unit, and so does a keyboard walk."""
        lower = value.lower()
        lower = lower if len(lower) == len(value) else value
        found = list(self._words(value, lower, lower.translate(self.plain)))
        for date in DATE.finditer(value):
            digits = sum(c.isdigit() for c in date[1])
            found.append((*date.span(1), math.log10(120 if digits == 4 else 120 * 365 * 4)))
        said = np.frombuffer(value.encode("utf-32-le"), "<u4")
        free = np.ones(len(said), bool)  # places at which no shorter unit repeats
        for unit in range(1, min(UNIT, len(said) // 2) + 1):
            run = run_lengths(said[:-unit] == said[unit:])
            starts = np.flatnonzero((run >= unit) & free[:len(run)])
            times = 1 + run[starts] // unit
            free[starts] = False
            found += zip(starts.tolist(), (starts + unit * times).tolist(),
                         (unit + np.log10(times)).tolist())
        keys = np.minimum(np.frombuffer(lower.encode("utf-32-le"), "<u4"), 127)
        turns = run_lengths(self.beside[keys[:-1], keys[1:]])
        starts = np.flatnonzero(turns >= 2)
        found += zip(starts.tolist(), (starts + turns[starts] + 1).tolist(),
                     (self.first_turn + 0.35 * turns[starts]).tolist())
        return sorted(found)

    def __call__(self, value: str) -> float:
        """Cheapest segmentation: the sum of the segments' costs, a factor of two for every
        segment after the first, brute-force characters at ten guesses each. Only places at
        which a segment begins or ends are visited."""
        joint = math.log10(2)
        ending = {0: -joint}  # cheapest, a segment ends there
        brute, at = math.inf, 0  # cheapest, the last segment is brute force and ends at ``at``
        segments = self.segments(value)
        places = sorted({0, len(value), *(s for s, _, _ in segments), *(e for _, e, _ in segments)})
        following = iter(segments)
        start, end, cost = next(following, (-1, 0, 0.0))
        for place in places:
            brute += place - at
            at, done = place, ending.pop(place, math.inf)
            here = min(done, brute) + joint
            while start == place:
                if here + cost < ending.get(end, math.inf):
                    ending[end] = here + cost
                start, end, cost = next(following, (-1, 0, 0.0))
            if place < len(value):
                brute = min(brute, done + joint)
        return max(0.0, min(done, brute))


def judged(text: str, cost: GuessCost) -> list[tuple[int, int, float]]:
    """(start, end, cost) of every value that follows a credential word."""
    return [(*m.span(1), cost(m[1])) for m in CONTEXT.finditer(text)]


def find(text: str, cost: GuessCost,
         min_cost: float = MIN_COST) -> list[tuple[int, str, int, float]]:
    """(start, kind, end, cost) by start, then kind as listed; cost is 0 for base kinds."""
    return spans_of(text, judged(text, cost), min_cost)


def spans_of(text: str, values: list[tuple[int, int, float]],
             min_cost: float = MIN_COST) -> list[tuple[int, str, int, float]]:
    """``find`` for a text whose ``judged`` values are known.

    A pattern's matches are non-overlapping before those that are too short are dropped."""
    found = [(m.start(), 0, m.end(), 0.0) for m in ASSIGN.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), 0.0) for m in ACCESS.finditer(text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), 0.0) for m in HEX.finditer(text)]
    found += [(s, 3, e, c) for s, e, c in values if c >= min_cost]
    return [(s, KINDS[k], e, c) for s, k, e, c in sorted(found)]


def scan(docs: DataFrame, vocabulary: str | None = None,
         min_cost: float = MIN_COST) -> DataFrame:
    """One row per row of ``docs``: doc_id, its spans, and all judged values with their cost."""
    path = vocabulary or tokenizer_path()

    def work(rows, cost):
        said = [t.decode() for t in rows["utf8"]]
        values = [judged(t, cost) for t in said]
        return {"doc_id": rows["doc_id"], "spans": [
            [{"kind": k, "start": s, "end": e, "cost": c}
             for s, k, e, c in spans_of(t, v, min_cost)] for t, v in zip(said, values)],
            "judged": [[{"start": s, "end": e, "cost": c} for s, e, c in v] for v in values]}

    return map_batches(texts(docs), work, "doc_id long, spans array<struct<kind:string,"
                       "start:long,end:long,cost:double>>, judged array<struct<start:long,"
                       "end:long,cost:double>>", lambda: GuessCost.from_vocabulary(path))


def counted(found: DataFrame) -> DataFrame:
    """doc_id, counts by kind, digest of the base spans, all spans as text, and the judged
    values as ``start:end:cost``, the cost in log10 of guesses to two places."""
    def joined(spans):
        return F.array_join(F.transform(spans, lambda x: F.concat_ws(
            ":", x.kind, x.start, x.end)), ",")

    def number(kind):
        return F.size(F.filter("spans", lambda x: x.kind == kind)).cast("long").alias(f"n_{kind}")

    return found.select(
        "doc_id", *[number(k) for k in KINDS],
        F.sha2(joined(F.filter("spans", lambda x: x.kind != "guess")), 256).alias("base_sha256"),
        joined(F.col("spans")).alias("spans"),
        F.array_join(F.transform("judged", lambda x: F.concat_ws(
            ":", x.start, x.end, F.round(x.cost, 2))), ",").alias("guess_costs"))


def blanked(text: str, spans: list[tuple[int, int]], mark: str = "[SECRET]") -> str:
    """``text`` with the union of the spans replaced by ``mark``."""
    out, at = [], 0
    for start, end in sorted(spans):
        if start > at or not out and start == at == 0:
            out += [text[at:start], mark]
        elif end <= at:
            continue
        at = max(at, end)
    return "".join(out) + text[at:]


def redact(docs: DataFrame, vocabulary: str | None = None,
           min_cost: float = MIN_COST) -> DataFrame:
    """``docs`` with every found span of ``text`` replaced and ``n_chars`` counted anew;
    null text stays null."""
    path = vocabulary or tokenizer_path()
    fields = docs.schema

    def run(batches):
        import pyarrow as pa
        cost = GuessCost.from_vocabulary(path)
        for batch in batches:
            rows = [t and blanked(t, [(s, e) for s, _, e, _ in find(t, cost, min_cost)])
                    for t in batch.column("text").to_pylist()]
            i = batch.schema.get_field_index("text")
            yield batch.set_column(i, batch.schema.field(i), pa.array(rows, batch.schema.field(i).type))

    out = docs.mapInArrow(run, fields)
    return out.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns \
        else out


def digest(spans: list[tuple[int, str, int, float]]) -> str:
    """The digest of base spans, stated without Spark."""
    return hashlib.sha256(",".join(f"{k}:{s}:{e}" for s, k, e, _ in spans if k != "guess")
                          .encode()).hexdigest()

"""Quality rules as a short-circuit cascade, in DataFrame expressions only.

Every rule is a condition that rejects a text. A bounded sample of the texts that
pass the base rules tells what a rule costs and how much it rejects; rules are then
tried in the order of rejection per cost, and a text rejected by one rule is not shown
to the next (nested ``CASE WHEN``). The order changes the work, never the verdict.

A rule's cost is the characters it reads: one for a comparison of counts that are there
already, the length of the text for each pattern run over it. That is counted on the
sample in the same pass as the rejections, so the order is the same in every run and
does not hang on the load of the machines.

Inputs: null and empty texts have no words and fail ``too_few_words``. Repeated
rows get the same row each. Only ``doc_id`` and ``text`` are read, so extra
columns cannot clash. All counts are over the whole text.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from andenlake.llm.shared import stored

SPACE = r"[\x20\x09-\x0D]"
SYMBOLS = "[#*$%&|<>]"
#: Texts of the sample that the order of the rules is fitted on (not the verdicts).
SAMPLE_ROWS = 1000
MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50


@dataclass(frozen=True)
class Rule:
    """``rejects``: a condition on the columns of ``measured``; ``scans``: how often it reads
    the text."""
    name: str
    rejects: Callable[[], Column]
    scans: int = 0


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over ``value``, which is computed once however often ``body`` uses it."""
    return F.transform(F.array(value), body)[0]


def words_of(text: Column) -> Column:
    return F.filter(F.split(text, SPACE + "+"), lambda w: w != "")


def repeated_words(words: Column) -> Column:
    """Words covered by 3-word windows that occur twice or more in the text.

    Windows are compared by 64-bit hash. Only texts in which a hash repeats sort
    their windows; each repeated window adds the words that the next one does not."""
    windows = F.transform(
        F.slice(words, 1, F.greatest(F.size(words) - 2, F.lit(0))),
        lambda w, i: F.xxhash64(w, F.get(words, i + 1), F.get(words, i + 2)))

    def covered(at: Column) -> Column:
        steps = F.transform(at, lambda p, j: F.least(F.coalesce(F.get(at, j + 1) - p, F.lit(3)),
                                                     F.lit(3)))
        return F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)

    def twins(pairs: Column) -> Column:
        again = F.filter(pairs, lambda x, j: F.coalesce(
            (x.h == F.get(pairs, j + 1).h) | ((j > 0) & (x.h == F.get(pairs, j - 1).h)),
            (j > 0) & (x.h == F.get(pairs, j - 1).h)))
        return let(F.sort_array(F.transform(again, lambda x: x.i)), covered)

    def count(hashes: Column) -> Column:
        pairs = F.sort_array(F.transform(
            hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0).cast("long")
                      ).otherwise(let(pairs, twins))

    return let(windows, count)


def measured(docs: DataFrame) -> DataFrame:
    """doc_id, text and the counts that the rules use."""
    lines = F.filter(F.split("text", "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    base = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    parts = base.select("doc_id", "text", words_of(F.col("text")).alias("words"))
    return parts.select(
        "doc_id", "text", F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("long").alias("n_symbols"),
        let(lines, lambda x: F.size(x) - F.size(F.array_distinct(x))).cast("long")
        .alias("n_dup_lines"),
        repeated_words(F.col("words")).alias("n_repeat_words"))


def base_failed() -> Column:
    return ((F.col("n_words") < MIN_WORDS)
            | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words")))


def _lines() -> Column:
    return F.regexp_count("text", F.lit(r"[^\n\x20\x09-\x0D][^\n]*"))


RULES = [
    Rule("symbols", lambda: 10 * F.col("n_symbols") > F.col("n_words")),
    Rule("repeated_lines", lambda: 2 * F.col("n_dup_lines") > _lines(), 1),
    Rule("word_length", lambda: (F.col("word_chars") < 2 * F.col("n_words"))
         | (F.col("word_chars") > 15 * F.col("n_words"))),
    Rule("exclamations", lambda: 2 * F.regexp_count("text", F.lit("!")) > F.col("n_words"), 1),
    Rule("capitals", lambda: 2 * F.regexp_count("text", F.lit(r"\p{Lu}"))
         > F.regexp_count("text", F.lit(r"\p{L}")), 2),
    Rule("few_letters", lambda: 2 * F.regexp_count("text", F.lit(r"\p{L}"))
         < F.col("word_chars"), 1),
]


def sampled(docs: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` different rows (fewer, if the table has many equal ones), by a hash of
    id and text: the same in every run, however the table is partitioned."""
    total = docs.count()
    at = F.pmod(F.xxhash64("doc_id", "text"), F.lit(1_000_003))
    return docs.select("doc_id", "text").filter(
        at < F.lit(1_000_003.0 * rows / max(1, total))).distinct()


def order_rules(docs: DataFrame, rules: list[Rule],
                sample_rows: int = SAMPLE_ROWS) -> list[tuple[Rule, float, float]]:
    """Rules by rejected share per character read, with the two figures, from one pass over a
    sample of about ``sample_rows`` texts. Ties keep the given order; an empty sample keeps
    it altogether."""
    sample = stored(sampled(docs, sample_rows), "sample")
    passed = stored(measured(sample), "measured-sample").filter(~base_failed())
    seen, length, *rejected = passed.agg(
        F.count("*"), F.avg(F.length("text")), *[F.count_if(r.rejects()) for r in rules]).first()
    scored = [(rule, n / max(1, seen), 1 + rule.scans * (length or 0.0))
              for rule, n in zip(rules, rejected)]
    return sorted(scored, key=lambda x: -x[1] / x[2])


def cascade(measures: DataFrame, rules: list[Rule]) -> Column:
    """Name of the first rule that rejects, null if none does."""
    verdict = F.lit(None).cast("string")
    for rule in reversed(rules):
        verdict = F.when(rule.rejects(), F.lit(rule.name)).otherwise(verdict)
    return verdict


def judge(docs: DataFrame, rules: list[Rule] | None = None,
          sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """One row per row of ``docs``: the counts, base_failed, kept and the failed rule.

    Which of several failing rules is named depends on the fitted order; ``kept``
    does not."""
    measures = measured(docs)
    ordered = order_rules(docs, rules or RULES, sample_rows)
    failed = F.when(F.col("base_failed"), F.lit("base")).otherwise(
        cascade(measures, [rule for rule, _, _ in ordered]))
    return (measures.withColumn("base_failed", base_failed())
            .withColumn("failed_rule", failed)
            .withColumn("kept", F.col("failed_rule").isNull()).drop("text"))

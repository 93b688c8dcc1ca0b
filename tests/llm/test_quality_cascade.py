import random
import re
from collections import Counter

from andenlake.llm import quality_cascade as Q


def slow(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    lines = [x for x in (text or "").split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = Counter(tuple(words[i:i + 3]) for i in range(len(words) - 2))
    covered = {i + k for i in range(len(words) - 2) for k in range(3)
               if windows[tuple(words[i:i + 3])] > 1}
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text or "")),
            len(lines) - len(set(lines)), len(covered),
            len(words) < 50 or 100 * len(covered) > 50 * len(words))


def sample():
    rng = random.Random(2)
    vocab = ["word", "casa", "île", "a", "the", "x#", "|", "Zebra", "running"] + [
        f"term{k}" for k in range(40)]
    texts = [None, "", " \t\n\x0b", "one", "a b c a b c", "é " * 3, "A!! " * 80,
             "same line of words here\n" * 30, "same " * 20_000]
    texts += ["".join(rng.choice(vocab) + rng.choice([" ", "\n", "  ", "\t"])
                      for _ in range(rng.randint(0, 400))) for _ in range(40)]
    return texts


def test_counts_against_brute_force(spark):
    texts = sample()
    df = spark.createDataFrame([(i, t, 1, "y") for i, t in enumerate(texts)] + [(None, "x", 1, "y")],
                               "doc_id long, text string, n_words int, words string")
    got = Q.judge(df).collect()
    assert len(got) == len(texts) + 1
    for r in got:
        want = slow("x" if r.doc_id is None else texts[r.doc_id])
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words,
                r.base_failed) == want
        assert not (r.kept and r.base_failed)


def test_order_does_not_change_the_verdict(spark):
    df = spark.createDataFrame(list(enumerate(sample())), "doc_id long, text string")
    one = {(r.doc_id, r.kept) for r in Q.judge(df).collect()}
    other = {(r.doc_id, r.kept) for r in Q.judge(df, Q.RULES[::-1], 5).collect()}
    assert one == other and {True, False} == {k for _, k in one}


def test_rules_that_reject_more_per_cost_come_first(spark):
    df = spark.createDataFrame(list(enumerate(sample())), "doc_id long, text string")
    ordered = Q.order_rules(df, Q.RULES)
    worth = [share / cost for _, share, cost in ordered]
    assert worth == sorted(worth, reverse=True) and len(worth) == len(Q.RULES)


def test_the_order_does_not_depend_on_partitions_or_repeated_rows(spark):
    rows = list(enumerate(sample()))
    df = spark.createDataFrame(rows, "doc_id long, text string")
    many = spark.createDataFrame(rows + [rows[9]] * 500, "doc_id long, text string")

    def figures(x):
        return [(rule.name, share, cost) for rule, share, cost in Q.order_rules(x, Q.RULES, 10**6)]

    assert figures(df) == figures(df.repartition(7)) == figures(many)
    cost = {name: c for name, _, c in figures(df)}
    assert cost["symbols"] == cost["word_length"] == 1 < cost["few_letters"] < cost["capitals"]


def test_a_cheap_rule_goes_before_an_equal_dear_one(spark):
    df = spark.createDataFrame([(k, f"w{k} x # " * 1 + " ".join(f"q{k}z{j}" for j in range(60)))
                                for k in range(50)], "doc_id long, text string")
    dear = Q.Rule("dear", lambda: Q.F.regexp_count("text", Q.F.lit("#")) > 0, 1)
    cheap = Q.Rule("cheap", lambda: Q.F.col("n_symbols") > 0)
    never = Q.Rule("never", lambda: Q.F.col("n_words") < 0)
    assert [r.name for r, *_ in Q.order_rules(df, [never, dear, cheap])] == [
        "cheap", "dear", "never"]


def test_empty_table(spark):
    assert Q.judge(spark.createDataFrame([], "doc_id long, text string")).collect() == []

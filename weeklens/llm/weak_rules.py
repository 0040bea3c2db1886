"""Quality rules by weak supervision: rules vote or abstain, and expectation-maximisation weighs them.

Everything on the way from texts to verdicts is a DataFrame expression; the only values that reach the driver are the
model's parameters, two per rule and one prior.
"""

from __future__ import annotations

import math
import warnings
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weeklens.llm.common import WORD, bound, text_or_empty, written

# The symbols that count, and the base rule's limits.
SYMBOLS = "#*$%&|<>"
LEAST_WORDS = 50
MOST_REPEATED_PERCENT = 50
SPAN = 3
# Frequent function words of the four languages of the corpus.
COMMON = (
    "the of and to in is that it for was de la le les des et un une que el los en der die das und von den zu ist mit"
).split()


@dataclass(frozen=True)
class Rule:
    """Votes +1 where ``good`` holds, -1 where ``bad`` holds, else abstains (0)."""

    name: str
    good: str
    bad: str


RULES = (
    Rule("length", "n_words >= 120", "n_words < 50"),
    Rule("word_length", "word_chars between 4 * n_words and 8.5 * n_words", "word_chars < 3 * n_words or word_chars > 11 * n_words"),
    Rule("symbols", "100 * n_symbols <= n_words", "10 * n_symbols >= n_words"),
    Rule("lines", "n_lines >= 3 and n_dup_lines = 0", "n_dup_lines > 0 and 10 * n_dup_lines >= 3 * n_lines"),
    Rule("repeats", "100 * n_repeat_words <= 10 * n_words", "100 * n_repeat_words > 30 * n_words"),
    Rule("capitals", "100 * n_capitals <= 5 * n_words", "100 * n_capitals > 30 * n_words"),
    Rule("common", "100 * n_common >= 10 * n_words", "100 * n_common < 2 * n_words"),
    Rule("marks", "100 * n_marks <= 20 * n_words and n_marks > 0", "100 * n_marks > 60 * n_words"),
)


def repeated_words(words: Column) -> Column:
    """How many words lie in a window of 3 words that is in the array twice or more.

    Windows are compared by a 64-bit hash. Sorted with their places, equal ones stand side by side; arrays without a
    repeat, which most are, skip the sort. Each array is bound to a lambda variable, so that it is made once.
    """
    n = F.size(words)
    windows = F.transform(
        F.sequence(F.lit(1), n - (SPAN - 1)),
        lambda i: F.xxhash64(F.element_at(words, i), F.element_at(words, i + 1), F.element_at(words, i + 2)),
    )

    def covered(hashes: Column) -> Column:
        placed = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def twice(rows: Column) -> Column:
            same = lambda x, k: (k >= 0) & (k < F.size(rows)) & (F.get(rows, k)["h"] == x["h"])
            found = F.filter(rows, lambda x, k: same(x, k - 1) | same(x, k + 1))
            places = F.sort_array(F.transform(found, lambda x: x["i"]))
            start = F.struct(F.lit(-SPAN).alias("last"), F.lit(0).alias("n"))
            step = lambda acc, i: F.struct(i.alias("last"), (acc["n"] + F.least(F.lit(SPAN), i - acc["last"])).alias("n"))
            return F.aggregate(places, start, step, lambda acc: acc["n"])

        return F.when(F.size(F.array_distinct(hashes)) == F.size(hashes), F.lit(0)).otherwise(bound(placed, twice))

    return F.when(n < SPAN + 1, F.lit(0)).otherwise(bound(windows, covered))


def features(docs: DataFrame) -> DataFrame:
    """Counts of each whole text, null as an empty one, beside doc_id."""
    text = text_or_empty()
    long = lambda c: c.cast("bigint")
    of_words = bound(
        F.regexp_extract_all(text, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(
            long(F.size(w)).alias("n_words"),
            long(repeated_words(w)).alias("n_repeat_words"),
        ),
    )
    of_lines = bound(
        F.filter(F.split(text, "\n", -1), lambda line: line.rlike(r"[^\x20\x09-\x0D]")),
        lambda x: F.struct(long(F.size(x)).alias("n_lines"), long(F.size(x) - F.size(F.array_distinct(x))).alias("n_dup_lines")),
    )
    common = r"(?i)(?<![^\x20\x09-\x0D])(?:" + "|".join(COMMON) + r")(?![^\x20\x09-\x0D])"
    count = lambda pattern: long(F.regexp_count(text, F.lit(pattern)))
    counted = docs.select(
        "doc_id",
        of_words.alias("w"),
        of_lines.alias("l"),
        (F.length(text) - count(r"[\x20\x09-\x0D]")).alias("word_chars"),
        long(F.length(F.regexp_replace(text, r"[^#*$%&|<>]+", ""))).alias("n_symbols"),
        count(r"\p{Lu}\p{Lu}+").alias("n_capitals"),
        count(common).alias("n_common"),
        count(r"[.,;:!?]").alias("n_marks"),
    )
    return counted.select("doc_id", "w.*", "l.*", "word_chars", "n_symbols", "n_capitals", "n_common", "n_marks")


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words"))


def vote(rule: Rule) -> Column:
    return F.when(F.expr(rule.bad), -1).when(F.expr(rule.good), 1).otherwise(0)


VOTES = (-1, 0, 1)
#: Where the search starts, and what is mixed in as pseudo-counts: shares of the votes -1, 0, +1 on good and on bad texts.
START = ((0.03, 0.47, 0.50), (0.40, 0.15, 0.45))


@dataclass(frozen=True)
class VoteModel:
    """prior: share of good texts; for each rule the shares of its votes -1, 0, +1 on good and on bad texts.

    A rule's accuracy is its share of right votes among those that it casts: see ``accuracy``.
    """

    prior: float
    on_good: tuple[tuple[float, float, float], ...]
    on_bad: tuple[tuple[float, float, float], ...]

    def accuracy(self, rule: int) -> float:
        good, bad, p = self.on_good[rule], self.on_bad[rule], self.prior
        right, wrong = p * good[2] + (1 - p) * bad[0], p * good[0] + (1 - p) * bad[2]
        return right / (right + wrong)


def posterior(model: VoteModel) -> Column:
    """Probability of a good text given the votes in columns v0, v1, ..."""
    odds = F.lit(math.log(model.prior / (1 - model.prior)))
    for i, (good, bad) in enumerate(zip(model.on_good, model.on_bad)):
        down, none, up = (math.log(g / b) for g, b in zip(good, bad))
        odds = odds + F.when(F.col(f"v{i}") == -1, down).when(F.col(f"v{i}") == 1, up).otherwise(none)
    return 1 / (1 + F.exp(-odds))


def _told(good: list[float], bad: list[float]) -> tuple[tuple[float, ...], tuple[float, ...]]:
    """The shares with both classes alike in a vote that would speak for the wrong class, so they cannot change places."""
    g, b = list(good), list(bad)
    for vote_, wrong in ((0, g[0] > b[0]), (2, g[2] < b[2])):
        if wrong:
            g[vote_] = b[vote_] = (good[vote_] + bad[vote_]) / 2
    return tuple(x / sum(g) for x in g), tuple(x / sum(b) for x in b)


def estimate(votes: DataFrame, rules: tuple[Rule, ...] = RULES, rounds: int = 400, tolerance: float = 1e-5, smooth: float = 0.002) -> VoteModel:
    """Expectation-maximisation over the distinct vote patterns and their counts.

    A pattern is one of 3 to the power of the number of rules, so the table is small whatever the corpus, and it counts
    every document. The start trusts each rule alike. Pseudo-counts of ``smooth`` times all documents keep shares off
    zero. Rounds go on to the tolerance; a warning says if it was not reached.
    """
    names = [f"v{i}" for i in range(len(rules))]
    patterns = written(votes.groupBy(*names).agg(F.count("*").alias("n")), "votes")
    total = patterns.agg(F.sum("n")).first()[0]
    model = VoteModel(0.85, (START[0],) * len(rules), (START[1],) * len(rules))
    if not total:
        return model
    extra = smooth * total
    good, bad = F.col("n") * F.col("p"), F.col("n") * (1 - F.col("p"))
    sums = [F.sum(good).alias("good"), F.sum(bad).alias("bad")]
    for name in names:
        for side, mass in (("good", good), ("bad", bad)):
            sums += [F.sum(F.when(F.col(name) == v, mass).otherwise(0.0)).alias(f"{name}_{side}_{v}") for v in VOTES]
    for _ in range(rounds):
        r = patterns.withColumn("p", posterior(model)).agg(*sums).first()
        share = lambda name, side, k: [
            (r[f"{name}_{side}_{v}"] + extra * START[k][i]) / (r[side] + extra) for i, v in enumerate(VOTES)
        ]
        tables = [_told(share(name, "good", 0), share(name, "bad", 1)) for name in names]
        prior = min(0.99, max(0.01, r["good"] / total))
        new = VoteModel(prior, tuple(g for g, _ in tables), tuple(b for _, b in tables))
        moved = max(
            [abs(new.prior - model.prior)]
            + [abs(x - y) for a, b in ((new.on_good, model.on_good), (new.on_bad, model.on_bad)) for u, v in zip(a, b) for x, y in zip(u, v)]
        )
        model = new
        if moved < tolerance:
            return model
    warnings.warn(f"vote shares still moved by {moved:.1e} after {rounds} rounds", stacklevel=2)
    return model


def judged(docs: DataFrame, rules: tuple[Rule, ...] = RULES, threshold: float = 0.5) -> DataFrame:
    """Per row of ``docs``: doc_id, the counts, base_failed, probability and kept.

    Null and empty texts have no words and fail the base rule. Repeated rows are counted and judged as often as they
    come. Columns other than doc_id and text are not read. Texts are read whole.
    """
    counts = written(features(docs), "counts").withColumns({f"v{i}": vote(rule) for i, rule in enumerate(rules)})
    model = estimate(counts, rules)
    scored = counts.withColumns({"base_failed": base_failed(), "probability": posterior(model)})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("probability") >= threshold))

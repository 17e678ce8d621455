"""Quality by weak supervision, with DataFrame functions alone.

Every rule looks at one figure of a document and votes good (1), bad (-1) or, between its two thresholds,
abstains (0). The votes of all documents are counted per vote pattern, at most 3 ** len(rules())
patterns whatever the number of documents. On these counts expectation-maximisation estimates the share
of good documents and two accuracies of each rule: how often its votes on good documents are good, and its
votes on bad documents bad. What a vote weighs follows from these alone, so a rule that keeps disagreeing
with the others loses weight, and what one rule says can be outvoted. The posterior probability of being
good takes the place of passing every rule: a document is kept if it reaches KEEP and does not fail the two
base rules.

The estimate starts from the same accuracies for all rules, and documents worth PRIOR of the corpus keep
voting by them, whatever its size. One constraint fixes which of the two classes is called good: a
rule votes at least as often good on good documents as on bad ones.

Defined results. A null or empty text has no words and fails the base rules. A rule that has nothing
to measure abstains. Ties (posterior equal to KEEP) are kept. Repeated rows are judged alike. An
empty table gives no rows. Only the id and text columns are read.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradeflow.llm.common import SPACE, WORD, let, quoted, written

SYMBOLS = r"[^#*$%&|<>]+"  # everything but symbols
KEEP = 0.5
ROUNDS = 100
# Where the estimate starts: share of good documents, accuracy of votes on good and on bad ones.
GOOD, ON_GOOD, ON_BAD = 0.8, 0.9, 0.6
PRIOR = 0.01


def _count_other(text: Column, pattern: str) -> Column:
    """Characters that the pattern does not match."""
    return F.length(F.regexp_replace(text, pattern, "")).cast("long")


def repeated_words(words: Column, width: int = 3) -> Column:
    """Words inside a window of that many words which occurs twice or more in the list.

    Windows are compared by 64-bit hashes within a document. Sorting (hash, place) brings equal
    ones together; their places, sorted, cover width words each less what the next one covers too.
    """

    def covered(places: Column) -> Column:
        nexts = F.slice(places, 2, F.size(places))
        steps = F.zip_with(
            places, nexts, lambda a, b: F.least(F.coalesce(b - a, F.lit(width)), F.lit(width))
        )
        return F.aggregate(steps, F.lit(0), lambda total, n: total + n)

    def in_order(ordered: Column) -> Column:
        pairs = F.size(ordered)
        same = lambda i, j: F.coalesce(
            F.get(ordered, i)["h"] == F.get(ordered, j)["h"], F.lit(False)
        )
        twice = F.filter(
            F.sequence(F.lit(0), pairs - 1), lambda i: same(i, i - 1) | same(i, i + 1)
        )
        places = F.transform(twice, lambda i: ordered[i]["at"])
        return let(F.sort_array(places), covered)

    def windows(hashes: Column) -> Column:
        at = F.sequence(F.lit(0), F.size(hashes) - width)
        rows = F.transform(
            at,
            lambda i: F.struct(
                F.xxhash64(*[hashes[i + k] for k in range(width)]).alias("h"), i.alias("at")
            ),
        )
        return let(F.sort_array(rows), in_order)

    counted = let(F.transform(words, lambda w: F.xxhash64(w)), windows)
    return F.when(F.size(words) > width, counted).otherwise(0).cast("long")


def measured(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key and what the rules look at."""
    texts = docs.select(quoted(key).alias("key"), F.coalesce(quoted(text), F.lit("")).alias("t"))
    t = F.col("t")
    lines = F.filter(F.split(t, "\n", -1), lambda x: x.rlike(WORD))
    line_counts = let(
        lines,
        lambda x: F.struct(
            F.size(x).cast("long").alias("n"),
            (F.size(x) - F.size(F.array_distinct(x))).cast("long").alias("dup"),
        ),
    )
    counts = let(
        F.regexp_extract_all(t, F.lit(WORD), F.lit(0)),
        lambda w: F.struct(F.size(w).cast("long").alias("n"), repeated_words(w).alias("repeated")),
    )
    return texts.select(
        "key",
        counts.alias("words"),
        line_counts.alias("lines"),
        _count_other(t, SPACE).alias("word_chars"),
        _count_other(t, SYMBOLS).alias("n_symbols"),
        _count_other(t, r"[^\p{Lu}]+").alias("n_capitals"),
        _count_other(t, r"[^0-9]+").alias("n_digits"),
        _count_other(t, r"[^.!?]+").alias("n_stops"),
        _count_other(t, r"[^\p{L}]+").alias("n_letters"),
    ).select(
        "key",
        F.col("words.n").alias("n_words"),
        F.col("words.repeated").alias("n_repeat_words"),
        F.col("lines.n").alias("n_lines"),
        F.col("lines.dup").alias("n_dup_lines"),
        "word_chars", "n_symbols", "n_capitals", "n_digits", "n_stops", "n_letters",
    )


def rules() -> dict[str, tuple[Column, Column]]:
    """By name: when the rule votes bad, and when good."""
    n = F.col("n_words")
    share = lambda part, whole: F.try_divide(F.col(part), F.col(whole))
    symbols, letters = share("n_symbols", "n_words"), share("n_letters", "word_chars")
    lines, repeats = share("n_dup_lines", "n_lines"), share("n_repeat_words", "n_words")
    capitals, digits = share("n_capitals", "word_chars"), share("n_digits", "word_chars")
    stops, length = share("n_stops", "n_words"), share("word_chars", "n_words")
    return {
        "symbols": (symbols > 0.1, symbols < 0.02),
        "letters": (letters < 0.8, letters > 0.9),
        "word_length": ((length < 2.5) | (length > 7), length.between(3.5, 6.5)),
        "repeated_lines": (lines > 0.25, (F.col("n_lines") >= 3) & (lines < 0.1)),
        "repeated_words": (repeats > 0.25, (n >= 20) & (repeats < 0.1)),
        "capitals": (capitals > 0.2, capitals < 0.1),
        "digits": (digits > 0.15, digits < 0.05),
        "sentences": ((stops > 0.5) | ((n >= 50) & (stops == 0)), stops.between(0.02, 0.25)),
    }


Votes = tuple[int, ...]


def posterior(votes: Votes, good: float, accuracy: list[tuple[float, float]]) -> float:
    """Probability that a document with these votes is good."""
    odds = math.log(good / (1 - good))
    for vote, (on_good, on_bad) in zip(votes, accuracy, strict=True):
        odds += weight(vote, on_good, on_bad)
    return 1 / (1 + math.exp(-odds)) if odds > -700 else 0.0


def weight(vote: int, on_good: float, on_bad: float) -> float:
    """Log-odds that a vote adds."""
    if vote == 0:
        return 0.0
    return math.log(on_good / (1 - on_bad)) if vote > 0 else math.log((1 - on_good) / on_bad)


def estimate(patterns: list[tuple[Votes, int]]) -> tuple[float, list[tuple[float, float]]]:
    """Share of good documents and the two accuracies of each rule, from (votes, documents) counts.

    Given whether a document is good, a rule that votes is right with its accuracy there, whatever the
    others say. Expected counts of right votes, with those of the prior, give the next accuracies.
    """
    n_rules = len(patterns[0][0]) if patterns else 0
    extra = PRIOR * sum(n for _, n in patterns)
    good, accuracy = GOOD, [(ON_GOOD, ON_BAD)] * n_rules
    for _ in range(ROUNDS if patterns else 0):
        total, mass = extra, extra * GOOD
        right = [[extra * ON_GOOD, extra * ON_BAD] for _ in range(n_rules)]
        voted = [[extra, extra] for _ in range(n_rules)]
        for votes, n in patterns:
            p = posterior(votes, good, accuracy)
            total, mass = total + n, mass + n * p
            for r, vote in enumerate(votes):
                if vote:
                    voted[r][0] += n * p
                    voted[r][1] += n * (1 - p)
                    right[r][vote < 0] += n * (p if vote > 0 else 1 - p)
        good = mass / total
        accuracy = [
            # No better than chance: the votes then weigh nothing.
            (a / b, max(c / d, 1 - a / b)) for (a, c), (b, d) in zip(right, voted, strict=True)
        ]
    return good, accuracy


def judged(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """measured() with the votes, the posterior quality and the verdict."""
    votes = F.array(*[F.when(bad, -1).when(good, 1).otherwise(0) for bad, good in rules().values()])
    stats = written(measured(docs, key, text).withColumn("votes", votes), "quality-votes")
    counts = stats.groupBy("votes").count().collect()  # at most 3 ** len(rules()) rows
    good, accuracy = estimate(sorted((tuple(r["votes"]), r["count"]) for r in counts))
    odds = F.lit(math.log(good / (1 - good)))
    for r, of in enumerate(accuracy):
        vote = F.col("votes")[r]
        odds = odds + F.when(vote > 0, weight(1, *of)).when(vote < 0, weight(-1, *of)).otherwise(0.0)
    n = F.col("n_words")
    failed = (n < 50) | (100 * F.col("n_repeat_words") > 50 * n)
    return (
        stats.withColumn("quality", 1 / (1 + F.exp(-odds)))
        .withColumn("base_failed", failed)
        .withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= KEEP))
    )


def quality(docs: DataFrame) -> DataFrame:
    """Digest of the verdicts, one row per document."""
    return judged(docs).select(
        F.col("key").alias("doc_id"),
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        "base_failed", "kept", "quality",
    )

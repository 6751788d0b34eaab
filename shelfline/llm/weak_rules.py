"""Quality rules as weak supervision: rules vote or abstain, and their agreement decides.

Each rule votes for good (1), for bad (0) or abstains (null). Expectation-maximisation over the
counts of vote patterns estimates how often each rule is right on good and on bad documents; the
posterior of "good" replaces passing every rule. Only DataFrame functions touch the documents; the
estimation reads the pattern counts, at most 3 to the number of rules rows whatever the input.

Null text counts as empty. A document on which every rule abstains gets the estimated share of good
documents as its posterior. Without documents nothing is estimated and nothing is returned.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.llm.texts import table
from shelfline.session import cut_lineage

# Fixed values of the statement: separators, symbols, window and the two base limits.
SPACE = r"[\x20\x09-\x0D]+"
SPACE_CHARS = " \t\n\x0b\f\r"
SYMBOLS = r"[#*$%&|<>]"
WINDOW = 8
MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30

# Frequent short words of the languages covered; a text in sentences has some of them.
COMMON = "the of and to in is that for it as de la le les et que des der die und von das el los y en un una".split()
ROUNDS = 40
PRIOR_VOTES = (8.0, 2.0)  # pseudo-votes that start each rule as right four times out of five


def statistics(docs: DataFrame) -> DataFrame:
    """doc_id and the counts that the rules read, one row per row of docs."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    base = docs.select("doc_id", text.alias("text")).select("doc_id", "text", F.array_remove(F.split("text", SPACE), "").alias("words"))
    lines = F.filter(F.split("text", "\n", -1), lambda line: F.btrim(line, F.lit(SPACE_CHARS)) != "")
    base = base.select("*", lines.alias("lines"), F.size("words").alias("n"))
    # Hash of the 8-word window at each place: of 1, 2, 4, then 8 words, each from two of the level
    # before. Places too near the end for a whole window are cut off.
    base = base.select("*", F.transform("words", lambda w: F.xxhash64(w)).alias("hashes"))
    for reach in (1, 2, 4):
        joined = F.transform("hashes", lambda h, i: F.xxhash64(h, F.get("hashes", i + reach)))  # noqa: B023
        base = base.select(*[c for c in base.columns if c != "hashes"], joined.alias("hashes"))
    base = base.select("*", F.slice("hashes", 1, F.greatest(F.col("n") - (WINDOW - 1), F.lit(0))).alias("windows"))
    total = lambda words: F.aggregate(words, F.lit(0).cast("bigint"), lambda a, w: a + F.length(w))
    return base.select(
        "doc_id",
        F.col("n").cast("bigint").alias("n_words"),
        total(F.col("words")).alias("word_chars"),
        F.regexp_count("text", F.lit(SYMBOLS)).cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        F.when(F.size(F.array_distinct("windows")) < F.size("windows"), repeated_words(F.col("windows"))).otherwise(0).cast("bigint").alias("n_repeat_words"),
        F.size("lines").cast("bigint").alias("n_lines"),
        F.size(F.filter("words", lambda w: F.lower(w).isin(COMMON))).cast("bigint").alias("n_common"),
        F.size(F.filter("lines", lambda line: F.substring(F.rtrim(line), -1, 1).isin(".", "!", "?", '"', ":"))).cast("bigint").alias("n_ended"),
        F.size(F.filter("words", lambda w: w.rlike(r"\p{L}"))).cast("bigint").alias("n_lettered"),
    )


def repeated_words(windows: Column) -> Column:
    """Words covered by windows that occur twice or more: sort (hash, place), keep places whose hash
    has an equal neighbour, and add up the union of their spans in order of place."""
    ordered = F.array_sort(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def places(rows: Column) -> Column:
        last = F.size(rows) - 1
        twin = lambda r, i: (
            ((i > 0) & (F.get(rows, i - 1)["h"] == r["h"])) | ((i < last) & (F.get(rows, i + 1)["h"] == r["h"]))
        )
        return F.array_sort(F.transform(F.filter(rows, twin), lambda r: r["i"]))

    start = F.struct(F.lit(-WINDOW).alias("last"), F.lit(0).alias("words"))
    step = lambda a, i: F.struct(i.alias("last"), (a["words"] + F.least(F.lit(WINDOW), i - a["last"])).alias("words"))
    # A one-element transform names the sorted array, so it is made once per document.
    return F.get(F.transform(F.array(ordered), lambda rows: F.aggregate(places(rows), start, step, lambda a: a["words"])), F.lit(0))


def vote(good: Column, bad: Column) -> Column:
    return F.when(bad, 0).when(good, 1)


def votes() -> dict[str, Column]:
    """The rules; every one abstains between its two limits or where it does not apply."""
    n, long_enough = F.col("n_words"), F.col("n_words") >= 50
    mean = F.try_divide(F.col("word_chars"), n)
    share = lambda c, of: F.coalesce(F.try_divide(F.col(c), of), F.lit(0.0))
    return {
        "length": vote(n >= 50, n < MIN_WORDS),
        "word_length": vote(mean.between(3, 10), (mean < 2) | (mean > 14)),
        "symbols": vote(long_enough & (share("n_symbols", n) <= 0.01), share("n_symbols", n) > 0.1),
        "letters": vote(long_enough & (share("n_lettered", n) >= 0.9), share("n_lettered", n) < 0.7),
        "duplicate_lines": vote((F.col("n_lines") >= 3) & (F.col("n_dup_lines") == 0), share("n_dup_lines", F.col("n_lines")) > 0.3),
        "repetition": vote(long_enough & (F.col("n_repeat_words") == 0), share("n_repeat_words", n) > 0.3),
        "common_words": vote(long_enough & (share("n_common", n) >= 0.05), long_enough & (share("n_common", n) < 0.01)),
        "ended_lines": vote((F.col("n_lines") >= 3) & (share("n_ended", F.col("n_lines")) >= 0.7), (F.col("n_lines") >= 3) & (share("n_ended", F.col("n_lines")) < 0.1)),
    }


def estimate(patterns: list[tuple[tuple, int]], rounds: int = ROUNDS) -> tuple[float, list[tuple[float, float]]]:
    """Share of good documents and, per rule, how often it is right on good and on bad ones.

    patterns: (votes, count) rows. The counts are taken in sorted order, so a repeated run gives the
    same figures.
    """
    patterns = sorted(patterns, key=lambda p: tuple(-1 if v is None else v for v in p[0]))
    rules = len(patterns[0][0]) if patterns else 0
    right, wrong = PRIOR_VOTES
    good, rates = 0.8, [(right / (right + wrong),) * 2 for _ in range(rules)]
    for _ in range(rounds):
        weights = [(pattern, count, posterior(pattern, good, rates)) for pattern, count in patterns]
        everyone = sum(count for _, count, _ in weights)
        good = (sum(count * p for _, count, p in weights) + right) / (everyone + right + wrong)
        fresh = []
        for j in range(rules):
            sums = {(v, y): 0.0 for v in (0, 1) for y in (0, 1)}
            for pattern, count, p in weights:
                if pattern[j] is not None:
                    sums[pattern[j], 1] += count * p
                    sums[pattern[j], 0] += count * (1 - p)
            fresh.append(tuple((sums[y, y] + right) / (sums[0, y] + sums[1, y] + right + wrong) for y in (1, 0)))
        # A rule's bad vote never counts for good, so the two classes keep their meaning.
        rates = [(max(a, 1 - b), b) if a + b < 1 else (a, b) for a, b in fresh]
    return good, rates


def posterior(pattern: tuple, good: float, rates: list[tuple[float, float]]) -> float:
    return 1 / (1 + math.exp(-sum(terms(pattern, good, rates))))


def terms(pattern: tuple, good: float, rates: list[tuple[float, float]]) -> list[float]:
    """Log odds: of the classes, then of each vote."""
    out = [math.log(good / (1 - good))]
    for v, (on_good, on_bad) in zip(pattern, rates):
        if v is not None:
            out.append(math.log(on_good / (1 - on_bad)) if v else math.log((1 - on_good) / on_bad))
    return out


def weigh(docs: DataFrame, keep_at: float = 0.5) -> DataFrame:
    """Per document its counts, votes, posterior `quality` and the decision `kept`."""
    rules = votes()
    names = [f"vote_{r}" for r in rules]
    # Counts of a few numbers per document are stored once: they are read for the estimate and again
    # for the decision, and the text is read only once.
    counted = cut_lineage(statistics(docs).select("*", *[c.cast("int").alias(n) for n, c in zip(names, rules.values())]))
    rows = counted.groupBy(*names).count().collect()  # at most 3 ** len(rules) rows
    good, rates = estimate([(tuple(r[:-1]), r[-1]) for r in rows])
    odds = F.lit(math.log(good / (1 - good)))
    for n, (on_good, on_bad) in zip(names, rates):
        odds = odds + F.when(F.col(n) == 1, math.log(on_good / (1 - on_bad))).when(F.col(n) == 0, math.log((1 - on_good) / on_bad)).otherwise(0.0)
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    scored = counted.withColumns({"base_failed": failed, "quality": 1 / (1 + F.exp(-odds))})
    return scored.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= keep_at))


def op8_weak_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = weigh(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", F.round("quality", 6).alias("quality"))

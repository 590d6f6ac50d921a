"""Quality rules by weak supervision, with DataFrame functions alone.

Each rule votes that a text is good (1) or bad (-1), or abstains (0).  The
votes of all documents are counted by pattern, and expectation-maximisation
over the pattern counts (at most ``3 ** rules`` rows, however large the corpus)
estimates each rule's rates of the three votes among good and bad texts.  A
text's posterior probability of being good replaces "all rules must pass".

Counts per text (words are ``[^\\x20\\x09-\\x0D]+``): ``n_words``,
``word_chars``, ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``; the last
covers 3-word windows found twice or more.  Windows are sorted by two hashes
and their place, in an array inside the row (no shuffle), so that equal windows
are neighbours in texts of any length; neighbours are then confirmed on the
words themselves.  The counts of all documents are stored once: the votes are
estimated from them, and the verdicts read them again.

Edge cases: null and empty texts count as no words and fail the base; null
doc_ids and repeated rows are judged like any row; an empty table gives an
empty result (the rates stay at their start); other columns are ignored.
"""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkmart.llm._common import stored, workspace

SPACE = r"[\x20\x09-\x0D]+"
SYMBOLS = r"[^#*$%&|<>]+"
STOP_WORDS = ("the", "of", "and", "to", "in", "is", "that", "der", "die", "und", "das", "ist", "den", "le", "la",
              "les", "de", "et", "des", "el", "los", "que", "y", "en", "un", "une", "del", "se", "a", "with", "zu")
EM_ROUNDS = 40
#: vote: rate among good and among bad texts, to start with and as a prior.  A
#: bad text passes most rules; a good one hardly ever gets a bad vote.
START = {1: (0.9, 0.75), 0: (0.095, 0.1), -1: (0.005, 0.15)}
#: Documents that the prior counts as, by share of all.
PRIOR = 0.02


def counts(docs: DataFrame) -> DataFrame:
    """``doc_id``, the contract's counts and what the rules read."""
    at = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                     F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    at = at.withColumn("words", F.filter(F.split("text", SPACE), lambda w: w != ""))
    at = at.withColumn("n_words", F.size("words").cast("long"))
    three = lambda i: (F.get("words", i), F.get("words", i + 1), F.get("words", i + 2))
    windows = F.transform(F.sequence(F.lit(0), F.col("n_words").cast("int") - 3), lambda i: F.struct(
        F.xxhash64(*three(i)).alias("name"), F.hash(*three(i)).alias("check"), i.alias("place")))
    at = at.withColumn("sorted", F.when(F.col("n_words") >= 4, F.sort_array(windows)))
    # Places whose neighbour in sorted order has the same hashes; the words decide.
    same = lambda x, y: (x["name"] == y["name"]) & (x["check"] == y["check"]) & reduce(
        Column.__and__, [p == q for p, q in zip(three(x["place"]), three(y["place"]))])
    hit = F.filter("sorted", lambda x, i: F.coalesce(same(x, F.get("sorted", i - 1)), F.lit(False))
                   | F.coalesce(same(x, F.get("sorted", i + 1)), F.lit(False)))
    at = at.withColumn("again", F.sort_array(F.transform(hit, lambda x: x["place"])))
    # Each window covers three words, less what the next one covers.
    covered = F.aggregate(
        F.transform("again", lambda x, i: F.least(F.lit(3), F.coalesce(F.get("again", i + 1) - x, F.lit(3)))),
        F.lit(0).cast("long"), lambda s, x: s + x)
    at = at.withColumn("lines", F.filter(F.split("text", "\n"), lambda s: F.regexp_replace(s, SPACE, "") != ""))
    bare = F.regexp_replace("text", SPACE, "")
    letters = F.length(F.regexp_replace("text", r"[^\p{L}]+", ""))
    return at.select(
        "doc_id", "n_words",
        F.length(bare).cast("long").alias("word_chars"),
        F.length(F.regexp_replace("text", SYMBOLS, "")).cast("long").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long").alias("n_dup_lines"),
        F.coalesce(covered, F.lit(0)).cast("long").alias("n_repeat_words"),
        F.size("lines").cast("long").alias("n_lines"),
        letters.cast("long").alias("n_letters"),
        F.length(F.regexp_replace("text", r"[^\p{Lu}]+", "")).cast("long").alias("n_capitals"),
        F.length(F.regexp_replace("text", r"[^!?]+", "")).cast("long").alias("n_shouts"),
        F.size(F.filter(F.transform("words", F.lower), lambda w: w.isin(*STOP_WORDS))).cast("long").alias("n_stop_words"),
        F.size(F.array_distinct("words")).cast("long").alias("n_distinct"))


def _vote(good: Column, bad: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Votes as integer expressions over ``counts``; all compare integers."""
    n, c = F.col("n_words"), F.col
    return {
        "length": _vote((n >= 50) & (n <= 100_000), n < 20),
        "word_size": F.when(n == 0, -1).otherwise(_vote(
            (c("word_chars") >= 3 * n) & (c("word_chars") <= 10 * n), (c("word_chars") < 2 * n) | (c("word_chars") > 20 * n))),
        "symbols": _vote(100 * c("n_symbols") <= n, 10 * c("n_symbols") > n),
        "repeats": _vote(100 * c("n_repeat_words") <= 20 * n, 100 * c("n_repeat_words") > 50 * n),
        "lines": _vote((c("n_dup_lines") < 3) | (20 * c("n_dup_lines") <= c("n_lines")),
                       (c("n_dup_lines") >= 3) & (10 * c("n_dup_lines") > 3 * c("n_lines"))),
        "capitals": _vote(10 * c("n_capitals") <= 3 * c("n_letters"), 10 * c("n_capitals") > 6 * c("n_letters")),
        "shouts": _vote(20 * c("n_shouts") <= n, 4 * c("n_shouts") > n),
        "stop_words": F.when(n < 10, 0).otherwise(_vote(25 * c("n_stop_words") >= n, 200 * c("n_stop_words") < n)),
        "variety": F.when(n < 30, 0).when(10 * c("n_distinct") < n, -1).when(5 * c("n_distinct") < n, 0).otherwise(1),
    }


def estimate(votes: DataFrame, names: list[str]) -> tuple[float, dict[str, dict[int, tuple[float, float]]]]:
    """EM over the counted vote patterns: share of good texts, and for each
    rule the rate of each vote among good and bad texts."""
    patterns = votes.groupBy(*names).agg(F.count(F.lit(1)).alias("n")).collect()   # at most 3 ** len(names) rows
    patterns = sorted((tuple(r[x] for x in names), r["n"]) for r in patterns)
    total = sum(n for _, n in patterns)
    share, rate = 0.8, {x: dict(START) for x in names}
    weight = PRIOR * total
    for _ in range(EM_ROUNDS if total else 0):
        good = {x: {v: weight * START[v][0] for v in START} for x in names}
        bad = {x: {v: weight * START[v][1] for v in START} for x in names}
        sum_good = 0.0
        for pattern, n in patterns:
            p, q = share, 1 - share
            for x, v in zip(names, pattern):
                p, q = p * rate[x][v][0], q * rate[x][v][1]
            g = n * p / (p + q)
            sum_good += g
            for x, v in zip(names, pattern):
                good[x][v] += g
                bad[x][v] += n - g
        share = min(max(sum_good / total, 1e-3), 1 - 1e-3)
        rate = {x: {v: (good[x][v] / (sum_good + weight), bad[x][v] / (total - sum_good + weight)) for v in START}
                for x in names}
    return share, rate


def judged(docs: DataFrame, least: float = 0.5) -> DataFrame:
    """``counts`` with the posterior ``quality`` of every text and ``kept``."""
    measured = stored(counts(docs), f"{workspace(docs.sparkSession, 'quality')}/counts")
    named = rules()
    names = list(named)
    share, rate = estimate(measured.select(*[named[x].alias(x) for x in names]), names)
    odds = [F.lit(_log(share) - _log(1 - share))]
    for x in names:
        by = {v: _log(rate[x][v][0]) - _log(rate[x][v][1]) for v in (1, 0, -1)}
        odds.append(F.when(named[x] == 1, by[1]).when(named[x] == -1, by[-1]).otherwise(by[0]))
    z = reduce(lambda a, b: a + b, odds)
    failed = (F.col("n_words") < 50) | (100 * F.col("n_repeat_words") > 50 * F.col("n_words"))
    out = measured.withColumn("base_failed", failed).withColumn("quality", 1 / (1 + F.exp(-z)))
    return out.withColumn("kept", ~F.col("base_failed") & (F.col("quality") >= least))


def _log(x: float) -> float:
    return math.log(max(x, 1e-12))


def op4_quality_rules(spark, sf_dir: str) -> DataFrame:
    """Counts, base rules and weak-supervision verdict of every document."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return judged(docs).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
                               "base_failed", "kept", "quality")

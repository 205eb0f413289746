"""Quality rules: simple counts of a text, and how much it looks like trusted text.

Every word gives two n-grams, hashed into a fixed number of buckets: its first three characters,
and its last three with a class, by hash, of all that lies between. Trusted texts and the whole
corpus each make a multinomial over the buckets; a document's score is the mean log of the ratio
of the two over its n-grams. Markup, shouting and strings of signs give n-grams that trusted
text lacks, and so do toxic words.

The score's bound is a low quantile of trusted rows that the target model has not seen: half of
the trusted ids, by hash, are held out, and the bound is their score of rank q (n + 1), rounded
up. That is one rule at every size: of few rows it is the least score. All trusted rows are used,
for the model or for the bound.

Everything is built-in functions. Counts are summed per bucket before the shuffle, and the
weights, ``BUCKETS`` rounded numbers whatever the corpus, are a constant of the plan; documents
are shuffled only where the trusted ids are too many to be broadcast. The bound is found by
counts of ever smaller ranges of scores.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.shared import WORD_RUN, free_name, store, whole_text, word_list

BUCKETS = 1 << 15
SMOOTHING = 1.0
HELD_OUT_QUANTILE = 0.001
THRESHOLD = float("-inf")  # of a score, where no held-out trusted row tells one
SCORE_RANGES = 1000  # ranges that scores are counted in at once
MIDDLES = 4  # classes of what lies between a word's first and last three characters
MIN_WORDS = 10
MAX_REPEATED_PERCENT = 20
WINDOW = 5
_SIGNS = "[^#*$%&|<>]+"


def _first(word: Column) -> Column:
    return F.pmod(F.xxhash64(F.substring(word, 1, 3)), F.lit(BUCKETS)).cast("int")


def _last(word: Column) -> Column:
    between = F.substring(word, F.lit(4), F.length(word) - 6)
    # all characters count, but whole words would be too rare to have a weight
    kind = F.when(F.length(word) > 6, F.pmod(F.xxhash64(between), F.lit(MIDDLES))).otherwise(-1)
    return F.pmod(F.xxhash64(F.substring(word, -3, 3), F.lit("$"), kind), F.lit(BUCKETS)).cast("int")


def trusted_rows(trusted: DataFrame, id_col: str) -> DataFrame:
    """All trusted ids that are not null, once each, written: Spark broadcasts them if they are few."""
    ids = trusted.select(F.col(id_col).alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    return store(ids, "trusted")


def trusted_sample(trusted: DataFrame, id_col: str, rows: int) -> DataFrame:
    """At most ``rows`` of the trusted ids, those with the smallest hash, for trials; no query uses it."""
    ids = trusted.select(F.col(id_col).alias("trusted_id")).where("trusted_id IS NOT NULL").distinct()
    return ids.orderBy(F.xxhash64("trusted_id"), "trusted_id").limit(rows)


def weights(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row: the array ``weights`` of log(target share / corpus share) per bucket.

    The corpus counts are over all of ``docs``, the target counts over all
    trusted rows of it. Without trusted text all weights are zero.
    """
    texts = docs.select(F.col(id_col).alias("i"), whole_text(text_col).alias("t")).join(
        trusted_rows(trusted, id_col), F.col("i") == F.col("trusted_id"), "left"
    )
    words = texts.select(
        F.col("trusted_id").isNotNull().cast("long").alias("target"), F.explode(word_list(F.col("t"))).alias("w")
    )
    grams = words.select("target", F.explode(F.array(_first(F.col("w")), _last(F.col("w")))).alias("bucket"))
    counts = grams.groupBy("bucket").agg(F.count("*").alias("corpus"), F.sum("target").alias("target"))
    every = docs.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    filled = every.join(counts, "bucket", "left").fillna(0)
    one = filled.agg(
        F.sort_array(F.collect_list(F.struct("bucket", "corpus", "target"))).alias("b"),
        F.sum("corpus").alias("n"),
        F.sum("target").alias("m"),
    )
    a = F.lit(SMOOTHING)
    share = lambda count, total: F.log((count + a) / (total + a * BUCKETS))
    ratio = F.transform("b", lambda x: share(x.target, F.col("m")) - share(x.corpus, F.col("n")))
    nothing = F.transform("b", lambda x: F.lit(0.0))
    return one.select(F.when(F.col("m") > 0, ratio).otherwise(nothing).alias("weights"))


def fitted(docs: DataFrame, trusted: DataFrame, id_col: str, text_col: str) -> tuple[Column, float]:
    """The weights as a constant array, and the bound that the score of a kept text reaches.

    The bound is exact for its rows and depends on nothing but them: of all n held-out trusted rows
    that are not ``base_failed``, the score of rank ``HELD_OUT_QUANTILE`` (n + 1), rounded up, from
    the least one. Without such rows no score is too low.
    """

    def constant(ids: DataFrame) -> Column:
        found = weights(docs, ids, id_col, text_col)
        numbers = found.select(F.array_join(F.transform("weights", lambda w: F.format_number(w, 4)), ";"))
        # folded into one constant array when the plan is made; a subquery may not stand in a lambda
        return F.split(F.lit(numbers.first()[0]), ";").cast("array<double>")

    held = F.pmod(F.xxhash64(F.col(id_col), F.lit("held out")), F.lit(2)) == 1
    texts = docs.select(F.col(id_col).alias("i"), whole_text(text_col).alias("t")).join(
        trusted_rows(trusted.where(held), id_col), F.col("i") == F.col("trusted_id"), "left_semi"
    )
    model = constant(trusted.where(~held))
    # not a filter, which would be moved below the join and judge all documents
    score = _let(verdict(F.col("t"), model, THRESHOLD), lambda v: F.when(~v.base_failed, v.score))
    scores = store(texts.select(score.alias("s")), "scores")
    n = scores.agg(F.count("s")).first()[0]
    return model, _of_rank(scores, math.ceil(HELD_OUT_QUANTILE * (n + 1))) if n else THRESHOLD


def _of_rank(scores: DataFrame, rank: int) -> float:
    """The number of this rank, from 1, in column ``s``, nulls left out: equal ranges are counted,
    and the one that holds the rank is divided again till it has one number."""
    while True:
        low, high = scores.agg(F.min("s"), F.max("s")).first()
        step = (high - low) / SCORE_RANGES
        if low == high:
            return low
        # numbers too near to each other for a step are few
        at = F.least(F.floor((F.col("s") - low) / step), F.lit(SCORE_RANGES)) if step else F.col("s")
        ranges = scores.where("s IS NOT NULL").groupBy(at.alias("at")).agg(F.count("*").alias("n")).orderBy("at").collect()
        for found in ranges:
            if rank <= found.n:
                break
            rank -= found.n
        scores = scores.where(at == found["at"])


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, wherever the optimizer moves the expression.

    Columns made step by step would be put into each other when a filter on the last one is
    pushed down, and a list inside a lambda would then be made anew for each of its elements.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _repeated_words(windows: Column) -> Column:
    """Words inside windows of five words that occur twice or more."""
    numbered = F.sort_array(F.transform(windows, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

    def twice(sorted_windows: Column) -> Column:
        same = lambda x, j: x.h.eqNullSafe(F.get(sorted_windows, j).h)
        found = F.transform(sorted_windows, lambda x, j: F.when(same(x, j - 1) | same(x, j + 1), x.i))
        return F.sort_array(F.filter(found, lambda i: i.isNotNull()))

    covered = lambda places: F.aggregate(
        places,
        F.struct(F.lit(-WINDOW).alias("at"), F.lit(0).alias("n")),
        lambda s, i: F.struct(i.alias("at"), (s.n + F.least(F.lit(WINDOW), i - s.at)).alias("n")),
        lambda s: s.n,
    )
    repeats = F.size(F.array_distinct(windows)) < F.size(windows)
    return F.when(repeats, _let(numbered, lambda x: _let(twice(x), covered))).otherwise(0).cast("long")


def _windows(hashes: Column) -> Column:
    at = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
    made = F.transform(at, lambda i: F.xxhash64(*(F.get(hashes, i + k) for k in range(WINDOW))))
    return F.when(F.size(hashes) >= WINDOW, made).otherwise(F.array().cast("array<bigint>"))


def verdict(text: Column, model: Column, threshold: float) -> Column:
    """Struct of the counts, ``base_failed``, ``score`` and ``kept`` of a text that is not null."""
    full_lines = F.filter(F.split(text, "\n"), lambda x: F.rlike(x, F.lit(WORD_RUN)))

    def counts(words: Column, windows: Column) -> Column:
        n = F.size(words)
        summed = F.aggregate(
            words, F.lit(0.0), lambda s, w: s + F.get(model, _first(w)) + F.get(model, _last(w))
        )
        repeated_lines = _let(full_lines, lambda x: F.size(x) - F.size(F.array_distinct(x)))
        return F.struct(
            n.cast("long").alias("n_words"),
            (F.length(text) - F.length(F.regexp_replace(text, WORD_RUN, ""))).cast("long").alias("word_chars"),
            F.length(F.regexp_replace(text, _SIGNS, "")).cast("long").alias("n_symbols"),
            repeated_lines.cast("long").alias("n_dup_lines"),
            _repeated_words(windows).alias("n_repeat_words"),
            F.when(n > 0, summed / (2 * n)).otherwise(0.0).alias("score"),
        )

    def judge(c: Column) -> Column:
        failed = (c.n_words < MIN_WORDS) | (100 * c.n_repeat_words > MAX_REPEATED_PERCENT * c.n_words)
        names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "score"]
        return F.struct(
            *(c[n].alias(n) for n in names),
            failed.alias("base_failed"),
            (~failed & (c.score >= threshold)).alias("kept"),
        )

    hashed = lambda words: F.transform(words, lambda w: F.xxhash64(w))
    return _let(
        word_list(text),
        lambda words: _let(
            hashed(words), lambda h: _let(_windows(h), lambda windows: _let(counts(words, windows), judge))
        ),
    )


def judged(docs: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row of ``docs`` with its counts, ``base_failed``, ``score`` and ``kept``, in a struct
    column ``verdict`` (renamed with ``_`` while a column has that name; it is the last column).

    ``trusted`` holds ids of trusted documents in ``id_col``. ``base_failed``: under 10 words, or
    over a fifth of the words in repeated five-word windows (whose words are compared by 64-bit
    hash). ``kept``: not ``base_failed``, and a score of the bound of ``fitted`` or more. A
    null text is empty. Without trusted ids every score is zero. Rows with equal texts get equal verdicts,
    whatever their ids; no rows give no rows.
    """
    model, bound = fitted(docs, trusted, id_col, text_col)
    name = free_name(docs, "verdict")
    return docs.withColumn(name, verdict(whole_text(text_col), model, bound))

from __future__ import annotations

import contextlib
import io
import math
import re
from collections import Counter

import brute
import pytest
from pyspark.sql import functions as F

from saleslake.llm import quality
from saleslake.llm.queries import QUERIES

BASE = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def plain(text):
    text = text or ""
    words = WORD.findall(text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    count = Counter(windows)
    inside = {j for i, w in enumerate(windows) if count[w] > 1 for j in range(i, i + 5)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    failed = len(words) < 10 or 100 * len(inside) > 20 * len(words)
    symbols = sum(c in "#*$%&|<>" for c in text)
    return len(words), sum(map(len, words)), symbols, len(lines) - len(set(lines)), len(inside), failed


def plain_values(docs, labels, words):
    """What each word adds to a score, from the model of the trusted rows that are not held out."""
    held = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(2)) == 1
    w = quality.weights(docs, labels.where(~held), "doc_id", "text").first()[0]
    frame = docs.sparkSession.createDataFrame([(x,) for x in words], "w string")
    at = frame.select("w", quality._first(F.col("w")).alias("a"), quality._last(F.col("w")).alias("b"))
    return {r.w: round(w[r.a], 4) + round(w[r.b], 4) for r in at.collect()}


def plain_bound(docs, labels, q):
    """The held-out score of rank q (n + 1)."""
    held = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(2)) == 1
    mine = [WORD.findall(r.text or "") for r in docs.join(labels.where(held).distinct(), "doc_id").collect() if not plain(r.text)[-1]]
    value = plain_values(docs, labels, {x for words in mine for x in words} | {"x"})
    scores = sorted(sum(value[x] for x in words) / (2 * len(words)) for words in mine)
    return scores[math.ceil(q * (len(scores) + 1)) - 1] if scores else -math.inf


def test_counts_score_and_verdict_equal_brute_force(spark):
    frame = QUERIES["op8_quality_rules"](spark, brute.SF)
    got = {r.doc_id: r for r in frame.collect()}
    docs = brute.rows("documents", "doc_id, text")
    assert len(got) == len(docs)
    table = spark.read.parquet(f"{brute.SF}/documents.parquet")
    labels = spark.read.parquet(f"{brute.SF}/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    value = plain_values(table, labels, {x for _, t in docs for x in WORD.findall(t or "")})
    bound = plain_bound(table, labels, quality.HELD_OUT_QUANTILE)
    for ident, text in docs:
        r, words = got[ident], WORD.findall(text or "")
        assert tuple(r[c] for c in BASE) == plain(text)
        assert r.score == pytest.approx(sum(value[x] for x in words) / max(2 * len(words), 1), abs=1e-9)
        assert r.kept == (not r.base_failed and r.score >= bound - 1e-9)


def test_junk_goes_and_clean_text_stays(spark):
    labels = dict(brute.rows("labels", "doc_id, quality", "/root/testdata/sf0.01"))
    got = QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.01").collect()
    junk = [r.kept for r in got if labels.get(r.doc_id) == 0]
    clean = [r.kept or r.base_failed for r in got if labels.get(r.doc_id) == 1]
    assert len(junk) > 30 and not any(junk)
    assert len(clean) > 200 and all(clean)


def test_toxic_texts_go_where_held_out_trusted_rows_tell_the_bound(spark):
    labels = {i: (q, t) for i, q, t in brute.rows("labels", "doc_id, quality, toxic", "/root/testdata/sf0.1")}
    got = QUERIES["op8_quality_rules"](spark, "/root/testdata/sf0.1").collect()
    rows = {
        pair: [r.kept for r in got if labels.get(r.doc_id) == pair and not r.base_failed] for pair in [(1, 0), (1, 1), (0, 0)]
    }
    assert len(rows[1, 1]) > 300 and sum(rows[1, 1]) <= 0.45 * len(rows[1, 1])
    assert len(rows[1, 0]) > 2500 and sum(rows[1, 0]) >= 0.995 * len(rows[1, 0])
    # a few junk rows are prose in a score's eyes, whatever the bound
    assert len(rows[0, 0]) > 200 and sum(rows[0, 0]) <= 0.02 * len(rows[0, 0])


@pytest.mark.parametrize("q", [0.001, 0.01, 0.1])
def test_bound_is_a_held_out_score_by_one_rule_at_every_size(spark, monkeypatch, q):
    labels = spark.read.parquet("/root/testdata/sf0.01/labels.parquet").where("quality = 1 AND toxic = 0").select("doc_id")
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    monkeypatch.setattr(quality, "HELD_OUT_QUANTILE", q)
    for some in (labels, labels.where("doc_id % 9 = 0")):
        bound = quality.fitted(docs, some, "doc_id", "text")[1]
        assert bound == pytest.approx(plain_bound(docs, some, q), abs=1e-9)
        assert quality.fitted(docs.repartition(7), some.repartition(3), "doc_id", "text")[1] == bound
    got = quality.judged(docs, labels.where("doc_id % 9 = 0")).select("verdict.*").collect()
    assert all(r.kept == (not r.base_failed and r.score >= bound) for r in got)


def test_only_built_in_functions_and_no_shuffle_of_documents(spark):
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        QUERIES["op8_quality_rules"](spark, brute.SF).explain("formatted")
    plan = out.getvalue()
    assert "Python" not in plan and "Pandas" not in plan and "Exchange" not in plan
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


SCHEMA = "doc_id long, text string, verdict int, words string"
ODD = [
    (1, None), (2, ""), (3, " \t\n\x0b\x0c\r "), (4, "\n a  b\n\n a  b\x0bc\n a  b\n"), (5, "é ü 漢字 😀 <#>" * 3),
    (6, "a b c d e f " * 2000), (7, "x " * 9), (8, "a b c d e z a b c d e"), (9, "one two three four"), (None, "w " * 12),
    (10, " ".join(str(n) for n in range(30_000)) + " 1 2 3 4 5 6"), (1, "again the same id"), (7, "x " * 9),
]


def test_odd_rows(spark):
    frame = spark.createDataFrame([(i, t, 1, "clash") for i, t in ODD], SCHEMA)
    trusted = spark.createDataFrame([(9,), (9,), (None,), (77,)], "doc_id long")
    judged = quality.judged(frame, trusted)
    assert judged.columns == [*frame.columns, "verdict_"]
    got = Counter((r.doc_id, r.text, *(r.verdict_[c] for c in BASE)) for r in judged.collect())
    assert got == Counter((i, t, *plain(t)) for i, t in ODD)


def test_nothing_trusted_and_empty_tables(spark):
    frame = spark.createDataFrame([(1, "a b c d e f g h i j")], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long")
    row = quality.judged(frame, none).first()
    assert row.verdict.score == 0 and row.verdict.kept
    assert quality.judged(frame.limit(0), none).count() == 0


def test_weights_are_the_log_ratio_of_smoothed_shares(spark):
    frame = spark.createDataFrame([(1, "aa aa bb"), (2, "cc")], "doc_id long, text string")
    trusted = spark.createDataFrame([(1,)], "doc_id long")
    weights = quality.weights(frame, trusted, "doc_id", "text").first()[0]
    assert len(weights) == quality.BUCKETS
    bucket = spark.createDataFrame([("aa",)], "w string").select(quality._first(F.col("w"))).first()[0]
    b = quality.BUCKETS
    assert weights[bucket] == pytest.approx(math.log(3 / (6 + b)) - math.log(3 / (8 + b)))


def test_sample_of_trusted_is_bounded_and_repeats(spark):
    ids = spark.range(1000).withColumnRenamed("id", "doc_id")
    first = quality.trusted_sample(ids, "doc_id", 50)
    again = quality.trusted_sample(ids.repartition(7), "doc_id", 50)
    assert first.count() == 50 and first.exceptAll(again).count() == 0


def test_every_character_of_a_word_counts(spark):
    word, letters = "abcdefghijklm", "0123456789"
    words = [word, *(word[:i] + x + word[i + 1 :] for i in range(len(word)) for x in letters)]
    frame = spark.createDataFrame([(x,) for x in words], "w string")
    at = {r[0]: r[1:] for r in frame.select("w", quality._first(F.col("w")), quality._last(F.col("w"))).collect()}
    for i in range(len(word)):
        assert any(at[word[:i] + x + word[i + 1 :]] != at[word] for x in letters)


def test_model_and_bound_take_all_trusted_rows(spark):
    ids = spark.range(42_000).select(F.col("id").alias("doc_id"))
    docs = ids.select("doc_id", F.lit("a b c d e f g h i j").alias("text"))
    docs = docs.union(spark.createDataFrame([(-1, "not trusted " * 5)], "doc_id long, text string"))
    w = quality.weights(docs, ids, "doc_id", "text").first()[0]
    at = spark.createDataFrame([("a",)], "w string").select(quality._first(F.col("w"))).first()[0]
    n, b = 42_000, quality.BUCKETS
    assert w[at] == pytest.approx(math.log((n + 1) / (20 * n + b)) - math.log((n + 1) / (20 * n + 20 + b)))
    # odd texts among those of the largest hashes, which samples of the smallest ones leave out
    held = F.pmod(F.xxhash64("doc_id", F.lit("held out")), F.lit(2)) == 1
    odd = ids.where(held).orderBy(F.xxhash64("doc_id").desc()).limit(100).withColumn("odd", F.lit(True))
    docs = docs.join(odd, "doc_id", "left").select("doc_id", F.when(F.col("odd"), F.lit("k l m n o p q r s t")).otherwise(F.col("text")).alias("text"))
    assert quality.judged(docs, ids).where("text LIKE 'k l%' AND verdict.kept").count() == 100


@pytest.mark.parametrize("numbers", [[1.0], [2.5] * 7, [float(i % 97) ** 3 for i in range(5000)], [-1e300, 0.0, 5e-324, 1e-300, 1e300]])
def test_number_of_a_rank(spark, numbers):
    frame = spark.createDataFrame([(x,) for x in [None, *numbers]], "s double")
    for rank in {1, (len(numbers) + 1) // 2, len(numbers)}:
        assert quality._of_rank(frame, rank) == sorted(numbers)[rank - 1]

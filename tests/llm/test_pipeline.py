from __future__ import annotations

import brute
import pytest
from test_lines import plain as plain_lines
from test_packing import assert_packed
from test_quality import plain as plain_quality
from test_simhash import plain_groups

import __spark_entry__ as entry
import corpus_pipeline
from saleslake.llm import quality

SF = "/root/testdata/sf0.001"
COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark):
    """The rows after each stage, cached."""
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    out = [docs.collect()]
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF).cache()
        out.append(docs.collect())
    return out


def test_stages_and_columns(stages):
    assert [name for name, _ in corpus_pipeline.STAGES] == [
        "language_id", "quality_rules", "line_dedup", "simhash_near_dedup", "packing",
    ]
    assert all(list(rows[0].asDict()) == COLUMNS for rows in stages[:5])


def test_language_keeps_texts_of_known_languages(stages):
    kept = {r.doc_id for r in stages[1]}
    lost = [r for r in stages[0] if r.doc_id not in kept]
    assert len(lost) <= 0.01 * len(stages[0])


def test_quality_takes_junk_and_only_junk(stages):
    labels = {i: q for i, q in brute.rows("labels", "doc_id, quality", SF)}
    kept = {r.doc_id for r in stages[2]}
    for r in stages[1]:
        if plain_quality(r.text)[5]:
            assert r.doc_id not in kept
        elif labels.get(r.doc_id) is not None:
            assert (r.doc_id in kept) == (labels[r.doc_id] == 1)


def test_line_dedup_equals_brute_force(stages):
    want = plain_lines([(r.doc_id, r.text) for r in stages[2]])
    assert {r.doc_id: r.text for r in stages[3]} == {i: left for (i, _), (left, _, _) in want.items()}
    assert all(r.n_chars == len(r.text) for r in stages[3] if r.text != "")


def test_one_document_of_each_group_stays(stages):
    groups = plain_groups([(r.doc_id, r.text) for r in stages[3]])
    assert sorted(r.doc_id for r in stages[4]) == sorted({component for _, _, component in groups})


def test_packing_of_what_is_left(stages):
    assert_packed(stages[5], {r.doc_id: r.text for r in stages[4]}, 2048)


def test_run_equals_the_stages(spark, stages):
    ran = entry.queries()["pipeline"](spark, SF)
    key = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
    # the order of documents is that of the input's partitions, which may differ between runs
    assert {(r.doc_id, r.doc_tokens) for r in ran.collect()} == {(r.doc_id, r.doc_tokens) for r in stages[5]}
    assert set(key) <= set(ran.columns)


def test_empty_table(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF)
    assert docs.count() == 0 and quality.THRESHOLD < 0

from __future__ import annotations

import zlib
from collections import defaultdict

import brute
import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from saleslake.llm import packing, tokens
from saleslake.llm.queries import QUERIES
from saleslake.llm.shared import BATCH_BYTES, small_batches, tokenizer_file
from saleslake.llm.tokens import encode

PATH = tokenizer_file("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)


def ids_of(text):
    return [*PLAIN.encode(text or "", add_special_tokens=False).ids, 1]


def assert_packed(pieces, texts, length):
    """Every id in one piece; sequences without a gap, all full but the last."""
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p.doc_id].append(p)
        by_sequence[p.sequence_id].append(p)
    assert set(by_doc) == set(texts)
    for ident, own in by_doc.items():
        ids, at = ids_of(texts[ident]), 0
        for p in sorted(own, key=lambda p: p.start):
            assert p.start == at and p.doc_tokens == len(ids)
            part = ids[at : at + p.length]
            assert p.ids_crc32 == zlib.crc32(np.array(part, "<u4").tobytes())
            at += p.length
        assert at == len(ids)
    assert sorted(by_sequence) == list(range(len(by_sequence)))
    for number, own in by_sequence.items():
        at = 0
        for p in sorted(own, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at == length or number == len(by_sequence) - 1 and at < length


def test_query_packs_every_document(spark):
    texts = dict(brute.rows("documents", "doc_id, text"))
    assert_packed(QUERIES["op2_packing"](spark, brute.SF).collect(), texts, 2048)


@pytest.mark.parametrize("length", [1, 7, 2048])
def test_odd_rows(spark, length):
    texts = {1: None, 2: "", 3: " \n", 4: "It's a\ttest, O'Neil’s 3½!", 5: "word " * 5000, None: "x"}
    frame = spark.createDataFrame(
        [(i, t, 9, b"y") for i, t in texts.items()], "doc_id long, text string, start long, ids binary"
    ).repartition(3)
    pieces = packing.described(packing.pack(frame, PATH, length)).collect()
    assert_packed(pieces, texts, length)


def test_repeated_rows_and_empty_table(spark):
    frame = spark.createDataFrame([(1, "a b")] * 3, "doc_id long, text string")
    pieces = packing.pack(frame, PATH).collect()
    assert sorted(p.offset for p in pieces) == [0, 3, 6]
    assert packing.pack(frame.limit(0), PATH).count() == 0


@settings(max_examples=300, deadline=None)
@given(
    st.lists(
        st.one_of(
            st.none(),
            st.text(alphabet=st.characters(exclude_categories=["Cs"]), max_size=30),
            st.text(alphabet="aAßİıÉé'stll <|>endoftext.,!*#\n\t\x1f  1²한ᄀ", max_size=30),
            st.sampled_from(["<|endoftext|> A", "<|ENDOFTEXT|>", "a<|startoftext|>b", "don't DON'T", "ſ K Å"]),
        ),
        max_size=5,
    )
)
def test_ids_are_those_of_the_tokenizer(texts):
    ids, starts = encode(pa.array(texts, pa.string()), PATH, 1)
    got = [ids[a:b].tolist() for a, b in zip(starts, starts[1:], strict=False)]
    assert got == [ids_of(t) for t in texts]


def test_texts_are_grouped_by_bytes_in_whole_rows_and_order():
    texts = ["", None, "x" * (tokens.TEXT_BYTES_AT_ONCE + 1), *(["y" * 30_000] * 700), ""]
    rows = pa.record_batch({"id": pa.array(range(len(texts))), "text": pa.array(texts)})
    groups = list(tokens.grouped([rows.slice(0, 0), rows.slice(0, 5), rows.slice(5)], 1))
    assert len(groups) > 1
    assert [t for g in groups for t in g.column(1).to_pylist()] == texts
    assert [i for g in groups for i in g.column(0).to_pylist()] == list(range(len(texts)))
    assert list(tokens.grouped([], 1)) == []


def test_known_strings_give_the_same_ids_again():
    texts = ["Plain words, plain words.", None, "", "a\x1fb odd \x1f", "Größe (x) 3.5 plain"]
    for _ in range(2):
        ids, starts = encode(pa.array(texts), PATH, 1)
        assert [ids[a:b].tolist() for a, b in zip(starts, starts[1:])] == [ids_of(text) for text in texts]


def test_worker_is_handed_a_few_mb_at_once(spark, monkeypatch):
    setting, sizes = "spark.sql.execution.arrow.maxBytesPerBatch", []
    former = spark.conf.get(setting)
    docs = spark.range(4000).coalesce(1).selectExpr("id AS doc_id", "repeat('abcd ', 800) AS text")

    def measured(batches):
        for batch in batches:
            yield pa.record_batch({"n": [batch.num_rows], "size": [batch.nbytes]})

    with small_batches(spark):
        got = docs.mapInArrow(measured, "n long, size long").collect()
    assert sum(r.n for r in got) == 4000 and max(r["size"] for r in got) < 2 * BATCH_BYTES

    kept = packing.store

    def noted(frame, name):
        sizes.append(spark.conf.get(setting))
        return kept(frame, name)

    monkeypatch.setattr(packing, "store", noted)
    packing.pack(docs.limit(3), PATH).count()
    assert sizes == [str(BATCH_BYTES)] and spark.conf.get(setting) == former

from __future__ import annotations

import brute
import numpy as np
import pytest
from tokenizers import Tokenizer

from saleslake.llm import token_scan
from saleslake.llm.queries import QUERIES
from saleslake.llm.shared import tokenizer_file

PATH = tokenizer_file("word_bpe_49k.json")
PLAIN = Tokenizer.from_file(PATH)
PLAIN.encode_special_tokens = True


def size(text):
    return len(PLAIN.encode(text or "", add_special_tokens=False).ids)


def test_query_equals_the_tokenizer(spark):
    got = QUERIES["op4_token_counts"](spark, brute.SF).collect()
    want = sorted((i, size(t)) for i, t in brute.rows("documents", "doc_id, text"))
    assert sorted((r.doc_id, r.n_tokens) for r in got) == want


def test_odd_rows(spark, tmp_path):
    docs = [(1, None), (2, ""), (3, "a <|endoftext|> b"), (None, "x"), (4, "w " * 9000), (1, "again"), (1, "again")]
    frame = spark.createDataFrame([(*d, "f", 3) for d in docs], "doc_id long, text string, file string, bytes int")
    files, places = token_scan.write_flat_files(frame.repartition(3), str(tmp_path), PATH, 49407)
    lengths = token_scan.document_lengths(files, 49407, block_bytes=64)
    got = places.join(lengths.where("closed"), ["file", "number"]).select("id", "tokens").collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((i, size(t)) for i, t in docs), key=repr)
    assert lengths.where("NOT closed").count() == 0
    files, places = token_scan.write_flat_files(frame.limit(0), str(tmp_path), PATH, 49407)
    assert token_scan.document_lengths(files, 49407).count() == 0 and places.count() == 0


@pytest.mark.parametrize(("width", "kind"), [(2, "<u2"), (4, "<u4")])
@pytest.mark.parametrize("block_tokens", [1, 2, 3, 7, 1000])
def test_blocks_are_stitched(spark, tmp_path, width, kind, block_tokens):
    rng = np.random.default_rng(8)
    made = {
        "empty": [], "none": [5, 6, 7], "only": [9], "two": [9, 9], "open": [1, 9, 2, 3], "long": [4] * 50 + [9],
        "mixed": np.where(rng.random(300) < 0.2, 9, 1).tolist(),
    }
    rows, want = [], set()
    for name, ids in made.items():
        path = tmp_path / name
        path.write_bytes(np.array(ids, kind).tobytes())
        rows.append((str(path), len(ids) * width))
        begin = number = 0
        for i, token in enumerate(ids):
            if token == 9:
                want.add((str(path), number, i - begin, True))
                begin, number = i + 1, number + 1
        if begin < len(ids):
            want.add((str(path), number, len(ids) - begin, False))
    files = spark.createDataFrame(rows, "file string, bytes long")
    got = token_scan.document_lengths(files, 9, width, block_tokens * width)
    got = [(r.file, r.number, r.tokens, r.closed) for r in got.collect()]
    assert len(got) == len(want) and set(got) == want


def test_a_part_of_a_token_is_refused(spark, tmp_path):
    (tmp_path / "odd").write_bytes(b"123")
    files = spark.createDataFrame([(str(tmp_path / "odd"), 3)], "file string, bytes long")
    with pytest.raises(Exception, match="part of a token"):
        token_scan.document_lengths(files, 9).count()


def test_what_grows_with_the_documents_is_not_sent_through_the_driver(spark):
    """Before, places and blocks were broadcast, as their files compress well: 547 MB of 1.5 million documents."""
    found = QUERIES["op4_token_counts"](spark, brute.SF)
    assert found.count() == len(brute.rows("documents", "doc_id"))
    for plan in (found, found.groupBy().count()):
        text = plan._jdf.queryExecution().executedPlan().toString()
        assert text.count("SortMergeJoin") == 2
        # the files alone, a row for each
        assert text.count("BroadcastHashJoin") <= 1

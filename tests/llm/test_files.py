from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from saleslake.llm import files, lines, simhash, token_scan
from saleslake.llm.shared import tokenizer_file
from saleslake.session import work_dir


@pytest.mark.parametrize(
    ("uri", "spelled"),
    [
        ("s3a://bucket/a b/c", "s3://bucket/a b/c"), ("S3N://bucket/x", "s3://bucket/x"), ("s3://b/k", "s3://b/k"),
        ("hdfs://host:8020/x", "hdfs://host:8020/x"), ("abfss://c@a.dfs.core.windows.net/x", "abfss://c@a.dfs.core.windows.net/x"),
        ("file:///tmp/x", "file:///tmp/x"), ("/tmp/x", "/tmp/x"), ("file:/tmp/x", "file:/tmp/x"),
    ],
)
def test_addresses_of_stores(uri, spelled):
    assert files.spelled(uri) == spelled


def test_files_are_written_under_names_of_their_attempt(tmp_path):
    uris = [files.write_file(f"file://{tmp_path}/new", "part", b"abc", b"def") for _ in range(2)]
    assert uris[0] != uris[1]
    assert files.read_file(uris[0]) == b"abcdef" and files.read_range(uris[1], 2, 3) == b"cde"


@pytest.mark.parametrize("kind", ["string", "int", "long", "double"])
def test_names_with_dots_and_ids_of_any_type(spark, kind):
    text = "one a\ntwo b\nthree c\nfour d"
    rows = [(1, text, 5, 27), (2, f"{text}\nfive e", 6, 34), (None, "x y", 7, 3)]
    frame = spark.createDataFrame(rows, "`d.id` long, `te.xt` string, `a.b` int, `n.c` long")
    frame = frame.withColumn("d.id", F.col("`d.id`").cast(kind))
    cut = lines.deduplicated(frame, "d.id", "te.xt", "n.c")
    assert cut.columns == [*frame.columns, "lines"]
    assert sorted(r["te.xt"] for r in cut.collect()) == ["five e", text, "x y"]
    kept = simhash.keep_one_of_group(frame, "d.id", "te.xt")
    assert kept.columns == frame.columns and kept.count() == 3
    plain = frame.toDF("doc_id", "text", "number", "bytes")
    _, places = token_scan.write_flat_files(plain, work_dir(spark, "t"), tokenizer_file("word_bpe_49k.json"), 49407)
    assert places.count() == 3 and places.schema["id"].dataType == plain.schema["doc_id"].dataType


def test_ids_beyond_the_width_are_refused(spark):
    frame = spark.createDataFrame([(1, "a b")], "doc_id long, text string")
    with pytest.raises(Exception, match="does not fit into 2 bytes"):
        token_scan.write_flat_files(frame, work_dir(spark, "t"), tokenizer_file("word_bpe_49k.json"), 1 << 16)

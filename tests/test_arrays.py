"""Large JSON arrays, read in blocks."""

from __future__ import annotations

import json
import os
import random

import pytest

from saleslake.schemas import FEEDS
from saleslake.sources import arrays, landing


@pytest.fixture
def tiny_blocks(spark):
    keys = {"spark.sql.files.maxPartitionBytes": "61", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "64"}
    before = {key: spark.conf.get(key, None) for key in keys}
    for key, value in keys.items():
        spark.conf.set(key, value)
    yield
    for key, value in before.items():
        spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def both_ways(spark, paths, schema=FEEDS["sales"]):
    """Rows of a plain read and of a read in blocks, without the order."""
    shown = lambda rows: sorted((tuple(map(str, r)) for r in rows.collect()))
    plain = landing.read_landing(spark, paths, schema, multi_line=True)
    split = landing.read_landing(spark, paths, schema, multi_line=True, sizes={p: landing.SPLIT_BYTES + 1 for p in paths})
    assert split.columns == plain.columns
    return shown(plain), shown(split)


def random_value(rng, depth=0):
    text = "".join(rng.choice('ab"\\{}[],: \n\té漢') for _ in range(rng.randrange(12)))
    kinds = [text, rng.randrange(1000), None, True, 1.5]
    if depth < 3:
        kinds += [{f"k{i}": random_value(rng, depth + 1) for i in range(rng.randrange(4))}, [random_value(rng, depth + 1) for _ in range(rng.randrange(4))]]
    return rng.choice(kinds)


@pytest.mark.parametrize("seed", range(3))
def test_escapes_and_nesting_across_blocks(spark, tmp_path, tiny_blocks, seed):
    rng = random.Random(seed)
    paths = []
    for n in range(4):
        records = [{"id": i, "amount_paid": i / 4, "note": random_value(rng), "x": random_value(rng)} for i in range(rng.randrange(1, 40))]
        records += [random_value(rng)] * rng.randrange(2)
        text = json.dumps(records, ensure_ascii=rng.random() < 0.5, indent=rng.choice([None, 1]))
        paths.append(str(tmp_path / f"a {n}.json"))
        mark = rng.choice(["", "﻿", "\n "])
        (tmp_path / f"a {n}.json").write_text(mark + text + rng.choice(["", "\n"]), encoding="utf-8")
    plain, split = both_ways(spark, paths)
    assert split == plain and len(plain) > 4


def test_small_and_odd_arrays(spark, tmp_path, tiny_blocks):
    texts = ["[]", " [ ] ", "[1, null, \"a\", [2], {\"id\": 3}]", '[{"id": 1}]', '{"id": 2, "x": {"id": 9}}', "", "\n",
             '[{"id": 4, "note": "' + "}{][,\\\"\\\\" * 40 + '"}]', '[{"id": 1.0}, {"id": 1.5}]']
    paths = []
    for n, text in enumerate(texts):
        path = tmp_path / f"{n}.json"
        path.write_text(text)
        paths.append(str(path))
    for path, text in zip(paths, texts, strict=True):
        plain, split = both_ways(spark, [path])
        assert split == plain, text
    plain, split = both_ways(spark, paths)
    assert split == plain


def test_broken_arrays_lose_nothing_in_silence(spark, tmp_path, tiny_blocks):
    filler = ", ".join(json.dumps({"id": i, "note": "x" * 20}) for i in range(10))
    cases = {
        f"[{filler}] {{\"id\": 99}}": 1, f"[{filler}]garbage": 1, f"[{filler}": 1, f"[{filler},,{{\"id\": 10}}]": 1,
        f"[{filler}, {{\"id\": 10}} junk]": 1, f"[{filler},]": 1,
    }
    for n, (text, corrupt) in enumerate(cases.items()):
        path = tmp_path / f"{n}.json"
        path.write_text(text)
        rows = landing.read_landing(spark, str(path), FEEDS["sales"], multi_line=True, sizes={str(path): 1 << 40}).collect()
        bad = [r for r in rows if r.id is None]
        assert len(bad) == corrupt and all(r._corrupt_record for r in bad), text
        assert {r.id for r in rows} - {None} <= set(range(11)) and len(rows) >= 10


def test_an_array_is_read_by_many_tasks(spark, tmp_path):
    path = tmp_path / "big.json"
    with open(path, "w") as out:
        out.write("[" + ",".join(json.dumps({"id": i, "note": "a \\ \" } ] " * 8}) for i in range(60_000)) + "]")
    size = os.path.getsize(path)
    spark.conf.set("spark.sql.files.maxPartitionBytes", str(size // 7))
    try:
        values, plain = arrays.array_values(spark, [str(path)])
        blocks = spark.read.option("lineSep", "}").text(str(path)).rdd.getNumPartitions()
        rows = landing.read_landing(spark, str(path), FEEDS["sales"], multi_line=True, sizes={str(path): 1 << 40})
        assert not plain and blocks >= 7 and values.count() == 60_000
        assert rows.where("_corrupt_record is null").selectExpr("sum(id)", "count(*)").first() == (60_000 * 59_999 // 2, 60_000)
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")


@pytest.mark.parametrize("text", ['{"id":1}],[{"id":2}', '[{"id":1}]]garbage', '{"id":1}, "end":[{"mark":"0"}]', '{"id":1} {"id":2}', "]", '{"id":1'])
def test_no_text_closes_what_it_is_read_in(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    for multi_line in (False, True):
        rows = landing.read_landing(spark, str(tmp_path / "a.json"), FEEDS["sales"], multi_line=multi_line).collect()
        assert [(r.id, r._corrupt_record) for r in rows] == [(None, text)]


def test_byte_order_marks(spark, tmp_path):
    for name, text in (("a.json", '[{"id": 1}]'), ("b.json", '{"id": 2}')):
        (tmp_path / name).write_text("﻿" + text, encoding="utf-8")
        for multi_line in (False, True):
            rows = landing.read_landing(spark, str(tmp_path / name), FEEDS["sales"], multi_line=multi_line).collect()
            assert [(r.id, r._corrupt_record) for r in rows] == [(1 if name == "a.json" else 2, None)]

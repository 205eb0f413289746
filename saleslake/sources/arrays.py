"""One JSON array of any size in a file, read by many tasks.

Where a value of the array begins cannot be seen from the middle of a file: a bracket or comma
counts only outside strings, and only at the array's own depth. So the file is read twice in
blocks, which Spark's text source deals out as it does lines, at closing braces. The first pass
takes from each block how it changes the state of a reader: whether its quotes turn "inside a
string" over, and its change of depth for either beginning. A prefix scan over these rows, one
per block, gives the state at each block's start. The second pass cuts the array at the commas of
its own depth; pieces of a value that lies across blocks are put together by a running count.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslake.session import work_dir, write_out

_SEPARATOR = "}"
_STEPS = np.array([(chr(b) in "{[") - (chr(b) in "}]") for b in range(256)], np.int8)
_QUOTE, _BACKSLASH, _COMMA, _LEFT, _RIGHT = (ord(c) for c in '"\\,[]')
# what may stand around a value: white space and a byte order mark
_BLANK = r"^[ \t\r\n\x{FEFF}]*$"
_NOTHING = 0


def _real_quotes(data: np.ndarray) -> np.ndarray:
    """Places of the quotes that no backslash escapes. The data begin after a brace."""
    quotes = np.flatnonzero(data == _QUOTE)
    odd = np.zeros(len(quotes), bool)
    at, some = quotes - 1, np.arange(len(quotes))
    while len(some):
        more = (at >= 0) & (data[np.maximum(at, 0)] == _BACKSLASH)
        some, at = some[more], at[more] - 1
        odd[some] ^= True
    return quotes[~odd]


def _outside(data: np.ndarray, inside: int) -> tuple[np.ndarray, int]:
    """Which bytes stand outside of strings, and whether the end is inside one."""
    quotes = _real_quotes(data)
    turned = np.zeros(len(data), np.int32)
    turned[quotes] = 1
    state = (np.cumsum(turned) + inside) & 1
    outside = state == 0
    outside[quotes] = False
    return outside, int(state[-1]) if len(state) else inside


def _bytes(values: pa.Array) -> np.ndarray:
    """The rows' bytes one after the other, each with the separator that ended it."""
    values = values.cast(pa.large_binary())
    ends = np.frombuffer(values.buffers()[1], np.int64)[values.offset : values.offset + len(values) + 1]
    data = np.frombuffer(values.buffers()[2] or b"", np.uint8)[ends[0] : ends[-1]]
    return np.insert(data, ends[1:] - ends[0], ord(_SEPARATOR))


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[str, int], pa.RecordBatch]]:
    """Batches cut where the block changes; the rows of a block follow each other."""
    for batch in batches:
        keys = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
        begin = 0
        for i in range(1, len(keys) + 1):
            if i == len(keys) or keys[i] != keys[begin]:
                yield keys[begin], batch.slice(begin, i - begin)
                begin = i


def _summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row per block: its bytes, first visible byte, turns of strings, and depths."""
    now, row = None, None
    for key, part in _blocks(batches):
        if key != now:
            if row is not None:
                yield pa.RecordBatch.from_pylist([row], _SUMMARY)
            now = key
            row = dict(source_file=key[0], start=key[1], n_bytes=0, first=_NOTHING, turns=0, depth_0=0, depth_1=0)
        data = _bytes(part.column(2))
        steps = _STEPS[data]
        outside, turns = _outside(data, 0)
        from_outside = int(steps[outside].sum())
        from_inside = int(steps[_outside(data, 1)[0]].sum())
        if row["turns"]:
            from_outside, from_inside = from_inside, from_outside
        row["depth_0"] += from_outside
        row["depth_1"] += from_inside
        row["turns"] ^= turns
        row["n_bytes"] += len(data)
        if row["first"] == _NOTHING:
            seen = data[~np.isin(data, [32, 9, 10, 13, 0xEF, 0xBB, 0xBF])]
            row["first"] = int(seen[0]) if len(seen) else _NOTHING
    if row is not None:
        yield pa.RecordBatch.from_pylist([row], _SUMMARY)


_SUMMARY = pa.schema(
    [("source_file", pa.string()), ("start", pa.int64()), ("n_bytes", pa.int64()), ("first", pa.int32()),
     ("turns", pa.int32()), ("depth_0", pa.int64()), ("depth_1", pa.int64())]
)
_PIECE = "source_file string, start long, before int, after int, text binary"


def _pieces(states: dict[tuple[str, int], tuple[int, int, int, bool]]):
    """Pieces of each block between cuts, with the byte of the cut before and after: 0 where the
    block begins or ends. ``states`` has of each block whether it begins in a string, its depth,
    its bytes, and whether its last separator stands for the end of the file."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, inside, depth, left, held, before, ended = None, 0, 0, 0, b"", _NOTHING, False

        def made(befores, afters, texts) -> pa.RecordBatch:
            n = len(befores)
            columns = [pa.array([now[0]] * n), pa.array([now[1]] * n, pa.int64()), pa.array(befores, pa.int32()),
                       pa.array(afters, pa.int32()), texts]
            return pa.RecordBatch.from_arrays(columns, names=["source_file", "start", "before", "after", "text"])

        for key, part in _blocks(batches):
            if key != now:
                if now is not None:
                    yield made([before], [_NOTHING], pa.array([held], pa.binary()))
                now, held, before = key, b"", _NOTHING
                inside, depth, left, ended = states[key]
            data = _bytes(part.column(2))
            left -= len(data)
            if not left and ended:
                data = data[:-1]
            outside, inside = _outside(data, inside)
            steps = np.where(outside, _STEPS[data], 0)
            depths = depth + np.cumsum(steps, dtype=np.int64)
            depth = int(depths[-1]) if len(depths) else depth
            cuts = np.flatnonzero(
                outside
                & (
                    ((data == _COMMA) & (depths == 1))
                    | ((data == _LEFT) & (depths == 1))
                    | ((data == _RIGHT) & (depths == 0))
                )
            )
            if not len(cuts):
                held += data.tobytes()
                continue
            marks = data[cuts].astype(np.int32)
            texts = np.delete(data, cuts)
            ends = cuts - np.arange(len(cuts))
            first = held + texts[: ends[0]].tobytes()
            yield made([before], marks[:1], pa.array([first], pa.binary()))
            if len(cuts) > 1:
                buffers = [None, pa.py_buffer(ends.astype("<i8").tobytes()), pa.py_buffer(texts.tobytes())]
                inner = pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(cuts) - 1, buffers).cast(pa.binary())
                yield made(marks[:-1], marks[1:], inner)
            held, before = texts[ends[-1] :].tobytes(), int(marks[-1])
        if now is not None:
            yield made([before], [_NOTHING], pa.array([held], pa.binary()))

    return cut


def array_values(spark: SparkSession, paths: list[str]) -> tuple[DataFrame | None, list[str]]:
    """The values of files of one JSON array each, and the paths of those that hold no array.

    A row per value: ``value`` as it is written, ``source_file``, ``received_at``. Text before or
    after an array, and nothing between two commas, are values as well, with the bracket or comma
    beside them, so that no reader takes them for JSON.
    """
    text = spark.read.option("lineSep", _SEPARATOR).text(paths)
    facts = text.select(
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_block_start").alias("start"),
        F.col("value").cast("binary").alias("value"),
    )
    rows = facts.mapInArrow(
        _summaries, "source_file string, start long, n_bytes long, first int, turns int, depth_0 long, depth_1 long"
    )
    files = (
        spark.read.format("binaryFile")
        .load(paths)
        .select("path", F.col("_metadata.file_path").alias("source_file"), F.col("length").alias("n"),
                F.col("_metadata.file_modification_time").alias("received_at"))
    )
    # as many rows as there are blocks, which the driver has planned itself
    summaries = sorted(rows.collect(), key=lambda r: (r["source_file"], r["start"]))
    known = {row["source_file"]: row for row in files.collect()}
    states, arrays = _scanned(summaries, {name: row["n"] for name, row in known.items()})
    plain = [row["path"] for name, row in known.items() if name not in arrays]
    if not arrays:
        return None, plain
    pieces = facts.where(F.col("source_file").isin(sorted(arrays))).mapInArrow(_pieces(states), _PIECE)
    pieces = pieces.select("source_file", "start", "before", "after", F.col("text").cast("string").alias("text"))
    pieces = write_out(pieces, work_dir(spark, "arrays"))
    whole = pieces.where((F.col("before") != _NOTHING) & (F.col("after") != _NOTHING))
    # at most three pieces of a block are open; a value goes on until a block with a cut ends it
    opened = pieces.where((F.col("before") == _NOTHING) | (F.col("after") == _NOTHING))
    order = Window.partitionBy("source_file").orderBy("start", F.col("before") != _NOTHING)
    group = F.sum((F.col("before") != _NOTHING).cast("int")).over(order)
    joined = opened.withColumn("group", group).groupBy("source_file", "group").agg(
        F.max("before").alias("before"),
        F.max("after").alias("after"),
        F.sort_array(F.collect_list(F.struct("start", "text"))).alias("parts"),
    )
    joined = joined.select("source_file", "before", "after", F.array_join("parts.text", "").alias("text"))
    values = whole.drop("start").unionByName(joined)
    blank = F.col("text").rlike(_BLANK)
    of_array = F.col("before").isin(_LEFT, _COMMA)
    empty = (F.col("before") == _LEFT) & (F.col("after") == _RIGHT)
    values = values.where(~blank | (of_array & ~empty))
    beside = F.when(F.col("before") == _RIGHT, F.concat(F.lit("]"), "text")).otherwise(F.concat("text", F.lit("[")))
    unended = F.concat(F.lit("["), "text")
    value = (
        F.when(~of_array, beside)
        .when(F.col("after") == _NOTHING, unended)
        .when(blank, F.lit(","))
        .otherwise(F.col("text"))
    )
    named = values.select(value.alias("value"), "source_file")
    return named.join(files.select("source_file", "received_at"), "source_file"), plain


def _scanned(summaries: list, sizes: dict[str, int]) -> tuple[dict, set[str]]:
    """State of a reader at the start of each block, and the files that begin with a bracket."""
    states, arrays = {}, set()
    total: dict[str, int] = {}
    last: dict[str, int] = {}
    for row in summaries:
        total[row["source_file"]] = total.get(row["source_file"], 0) + row["n_bytes"]
        last[row["source_file"]] = row["start"]
    name, inside, depth, first = None, 0, 0, _NOTHING
    for row in summaries:
        if row["source_file"] != name:
            name, inside, depth, first = row["source_file"], 0, 0, _NOTHING
        # a byte order mark is not read; the end of the file reads like one more separator
        ended = total[name] - sizes[name] in (1, -2)
        states[(name, row["start"])] = (inside, depth, row["n_bytes"], ended and row["start"] == last[name])
        depth += row["depth_1"] if inside else row["depth_0"]
        inside ^= row["turns"]
        if first == _NOTHING and row["first"] != _NOTHING:
            first = row["first"]
            if first == _LEFT:
                arrays.add(name)
    return states, arrays

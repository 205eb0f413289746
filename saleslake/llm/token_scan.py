"""Token counts of documents in flat token files, by a scan for separators.

A flat file is nothing but token ids of fixed width, each document closed by a separator. Files
are cut into blocks of equal size, whatever documents they hold; a block's separators are found
by one vectorised comparison. Documents that cross blocks are stitched by prefix scans over the
blocks of a file: the separators before a block give its documents their number, the last
separator before it gives its first document its begin. Only one row per block enters the scans.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from saleslake.llm.files import attempt_name, give_back_memory, read_range, store_of
from saleslake.llm.shared import store
from saleslake.llm.tokens import encode, grouped

BLOCK_BYTES = 8 << 20
WIDTHS = {2: "<u2", 4: "<u4"}


def write_flat_files(
    docs: DataFrame, folder: str, tokenizer: str, end_id: int, width: int = 2, id_col: str = "doc_id", text_col: str = "text"
) -> tuple[DataFrame, DataFrame]:
    """Encode documents into one flat file per input partition.

    (file, bytes) of the files, and (file, number, id): which document is where. Null texts are
    empty; strings of special tokens are ordinary text, so that a separator is never inside one.
    Ids of any simple type; a token id that does not fit into ``width`` bytes is an error.
    """

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = store_of(folder)
        target.create_dir(root, recursive=True)
        name = attempt_name(f"tokens-{TaskContext.get().partitionId():06d}")
        size = number = 0
        with target.open_output_stream(f"{root}/{name}", compression=None) as out:
            for some in grouped(batches, 1):
                ids, _ = encode(some.column(1).combine_chunks(), tokenizer, end_id, plain_specials=True)
                if ids.max(initial=0) >> (8 * width):
                    raise ValueError(f"id {ids.max()} does not fit into {width} bytes")
                out.write(ids.astype(WIDTHS[width]).tobytes())
                size += width * len(ids)
                n = some.num_rows
                numbers = pa.array(np.arange(number, number + n))
                number += n
                yield from pa.table(
                    {"file": [f"{folder}/{name}"] * n, "number": numbers, "id": some.column(0), "bytes": pa.nulls(n, pa.int64())}
                ).to_batches()
        last = {"file": [f"{folder}/{name}"], "number": [-1], "id": pa.nulls(1, some_type), "bytes": [size]}
        yield pa.record_batch(last)

    kind = docs.schema[id_col].dataType.simpleString()
    some_type = to_arrow_type(docs.schema[id_col].dataType)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))
    written = store(rows.mapInArrow(write, f"file string, number long, id {kind}, bytes long"), "flat")
    files = written.where("number < 0").select("file", "bytes")
    return files, written.where("number >= 0").select("file", "number", "id")


def placed_lengths(places: DataFrame, lengths: DataFrame) -> DataFrame:
    """The places with the lengths of their documents, neither of them sent through the driver."""
    return places.join(lengths.hint("merge"), ["file", "number"])


def document_lengths(files: DataFrame, end_id: int, width: int = 2, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(file, number, tokens, closed) of every document in ``files`` (file, bytes).

    ``number`` counts from 0 in each file, ``tokens`` leaves out the separator. Tokens after the
    last separator are a document that is not ``closed``; without any there is none. An empty
    file has no documents. A size that is no multiple of the width is an error.
    """
    if block_bytes % width:
        raise ValueError("a block must hold whole tokens")

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                if row["bytes"] % width:
                    raise ValueError(f"{row['file']} has a part of a token")
                offset = row["block"] * block_bytes
                data = read_range(row["file"], offset, min(block_bytes, row["bytes"] - offset))
                ends = np.flatnonzero(np.frombuffer(data, WIDTHS[width]) == end_id) + offset // width
                yield pa.record_batch(
                    {
                        "file": [row["file"]],
                        "block": pa.array([row["block"]], pa.int64()),
                        "ends": pa.array([ends], pa.list_(pa.int64())),
                    }
                )
        give_back_memory()

    count = F.ceil(F.col("bytes") / block_bytes)
    full = files.where("bytes > 0")
    blocks = full.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), count - 1)))
    total = full.agg(F.sum(count)).first()[0] or 1
    found = store(
        blocks.repartition(int(total), "file", "block").mapInArrow(scan, "file string, block long, ends array<long>"), "ends"
    )
    before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    last = F.try_element_at("ends", F.lit(-1))
    # one short row per block
    heads = found.select("file", "block", F.size("ends").alias("n"), last.alias("last"))
    heads = heads.select(
        "file",
        "block",
        F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"),
        F.coalesce(F.max("last").over(before), F.lit(-1)).alias("before"),
    )
    # Both sides of the joins grow with the documents, and files that compress well look small: without
    # the hint one side is sent through the driver.
    placed = found.join(heads.hint("merge"), ["file", "block"])
    inner = placed.select("file", "base", "before", "ends", F.posexplode("ends").alias("i", "end"))
    begin = F.coalesce(F.get("ends", F.col("i") - 1), F.col("before"))
    closed = inner.select(
        "file", (F.col("base") + F.col("i")).alias("number"), (F.col("end") - begin - 1).alias("tokens"), F.lit(True).alias("closed")
    )
    ends = found.groupBy("file").agg(F.sum(F.size("ends")).alias("number"), F.coalesce(F.max(last), F.lit(-1)).alias("last"))
    left = (F.col("bytes") / width).cast("long") - F.col("last") - 1
    opened = full.join(ends, "file").select("file", "number", left.alias("tokens"), F.lit(False).alias("closed"))
    return closed.unionByName(opened.where("tokens > 0"))

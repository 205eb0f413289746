"""Concatenate and cut: documents one after the other, cut into windows of equal length.

The first pass encodes the documents and writes them with their place inside their input
partition; the partitions' token totals, summed up, then give every document its global
offset, and the second pass cuts at the windows' borders. Documents are not shuffled. The
order is that of the input's partitions. Only the last sequence can need padding.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.shared import small_batches, store
from saleslake.llm.tokens import encode, grouped

LENGTH = 2048
END_ID = 1


def encoded(docs: DataFrame, tokenizer: str, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, part, at, tokens, ids): ids as little-endian 32-bit numbers, ``at`` within the part."""

    def encode_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for some in grouped(batches, 1):
            ids, starts = encode(some.column(1).combine_chunks(), tokenizer, end_id)
            blob = pa.py_buffer(ids.astype("<u4", copy=False).tobytes())
            n = some.num_rows
            bounds = pa.py_buffer((4 * starts).astype("<i8").tobytes())
            yield from pa.table(
                {
                    "id": some.column(0),
                    "part": pa.array(np.full(n, part, np.int64)),
                    "at": pa.array(at + starts[:-1]),
                    "tokens": pa.array(np.diff(starts)),
                    "ids": pa.LargeBinaryArray.from_buffers(pa.large_binary(), n, [None, bounds, blob])
                    .cast(pa.binary()),
                }
            ).to_batches(max_chunksize=2000)
            at += int(starts[-1])

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text")).mapInArrow(
        encode_part, f"id {kind}, part long, at long, tokens long, ids binary"
    )


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Pieces of documents in sequences of ``length`` tokens, with their ids.

    One row per piece: the id, ``start`` (the document's tokens before it), ``length``, ``ids``
    (little-endian 32-bit), ``doc_tokens``, ``sequence_id`` from 0 and ``offset`` there. A null
    text is empty and has the end id alone. Repeated rows and null ids are packed like others;
    other columns of ``docs`` are not read. No rows give no rows.
    """
    with small_batches(docs.sparkSession):
        coded = store(encoded(docs, tokenizer, end_id, id_col, text_col), "tokens")
    # one row per input partition, whose number the driver knows anyhow
    totals = coded.groupBy("part").agg(F.sum("tokens").alias("n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    begin, end = F.col("begin"), F.col("begin") + F.col("tokens")
    first, last = F.floor(begin / length), F.floor((end - 1) / length)
    placed = coded.join(F.broadcast(bases), "part").withColumn("begin", F.col("base") + F.col("at"))
    pieces = placed.select(
        "id", "tokens", "begin", "ids", F.explode(F.sequence(first, last)).alias("sequence_id")
    )
    left = F.greatest(F.col("sequence_id") * length, F.col("begin"))
    right = F.least((F.col("sequence_id") + 1) * length, F.col("begin") + F.col("tokens"))
    cut = pieces.withColumn("left", left).withColumn("right", right)
    start, size = F.col("left") - F.col("begin"), F.col("right") - F.col("left")
    return cut.select(
        F.col("id").alias(id_col),
        start.alias("start"),
        size.alias("length"),
        F.substring("ids", (4 * start + 1).cast("int"), (4 * size).cast("int")).alias("ids"),
        F.col("tokens").alias("doc_tokens"),
        "sequence_id",
        (F.col("left") - F.col("sequence_id") * length).alias("offset"),
    )


def described(pieces: DataFrame) -> DataFrame:
    """The pieces with the crc32 of their ids in place of the ids."""
    columns = [F.crc32("ids").alias("ids_crc32") if c == "ids" else F.col(c) for c in pieces.columns]
    return pieces.select(columns)

"""What several operators need: tables, written intermediates, words, held-out folds."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from saleslake.session import work_dir

SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = "[\\x20\\x09-\\x0D]+"
WORD_RUN = "[^\\x20\\x09-\\x0D]+"
BATCH_BYTES = 4 << 20  # what a Python worker is handed at once
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def store(frame: DataFrame, name: str) -> DataFrame:
    """Write a frame to the folder that all executors share and read it back.

    This cuts the lineage: the files outlive the executor that made them, and a frame
    that several steps read is computed once.
    """
    path = f"{work_dir(frame.sparkSession, f'llm-{name}')}/{name}"
    frame.write.option("compression", "zstd").parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession) -> Iterator[None]:
    """Frames that are written within it hand ``BATCH_BYTES`` of rows, one row at least, to a Python
    worker at once. A batch of Spark's 10,000 rows holds tens of MB of texts, some times over: in
    buffers of the JVM that double as they grow, and in the worker."""
    former = spark.conf.get(_BATCH_BYTES)
    spark.conf.set(_BATCH_BYTES, str(BATCH_BYTES))
    try:
        yield
    finally:
        spark.conf.set(_BATCH_BYTES, former)


def tokenizer_file(name: str) -> str:
    """Where this machine and the executors have a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def whole_text(name: str = "text") -> Column:
    """The text of a row; null counts as empty."""
    return F.coalesce(named(name), F.lit(""))


def word_list(text: Column) -> Column:
    """Runs of characters other than the six ASCII white spaces; none gives an empty array."""
    bare = F.btrim(text, F.lit(SPACES))
    return F.when(bare == "", F.array().cast("array<string>")).otherwise(F.split(bare, SPACE_RUN))


def id_remainder(name: str, by: int) -> Column:
    """crc32 of the id written as text, modulo ``by``; a null id counts as an empty text."""
    as_text = F.coalesce(F.col(name).cast("string"), F.lit(""))
    return F.crc32(as_text.cast("binary")) % by


def power_of_two(at_least: float) -> int:
    n = 1
    while n < at_least:
        n *= 2
    return n


def named(name: str) -> Column:
    """A column by its whole name, dots and all."""
    return F.col("`" + name.replace("`", "``") + "`")


def free_name(frame: DataFrame, name: str) -> str:
    """``name``, lengthened until no column of the frame has it."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name

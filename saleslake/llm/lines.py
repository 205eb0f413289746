"""Line dedup by overlapping windows of three lines.

Consecutive lines that hold a word, trimmed, make overlapping windows of three. Of a window that
occurs more than once in the corpus the first occurrence, by document and then by place, stays;
the lines that later occurrences cover go, overlapping ones merged.

Windows travel as two 64-bit hashes, an id and a place. Their first occurrence is an aggregate
with partial sums, and the join back to it is a sort-merge join, so a window that a third of all
documents share is split by adaptive execution. Texts are joined once, with the places to cut.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.shared import WORD_RUN, free_name, named, whole_text

WINDOW = 3
_TRIMMED = " \t\x0b\x0c\r"


def _lines(text: Column) -> Column:
    """Structs (line trimmed, place from 0) of the lines with a word."""
    numbered = F.transform(
        F.split(text, "\n"), lambda x, i: F.struct(F.btrim(x, F.lit(_TRIMMED)).alias("s"), i.alias("i"))
    )
    return F.filter(numbered, lambda x: F.rlike(x.s, F.lit(WORD_RUN)))


def windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(h1, h2, id, h, at) of every window; h tells apart texts of the same id."""
    lines = docs.select(
        named(id_col).alias("id"), F.xxhash64(whole_text(text_col)).alias("h"), _lines(whole_text(text_col)).alias("x")
    )
    line = lambda i, k: F.get("x", i + k).s
    keys = F.transform(
        F.sequence(F.lit(0), F.size("x") - WINDOW),
        lambda i: F.struct(
            F.xxhash64(*(line(i, k) for k in range(WINDOW))).alias("h1"),
            F.xxhash64(F.lit("second"), *(line(i, k) for k in reversed(range(WINDOW)))).alias("h2"),
            i.alias("at"),
        ),
    )
    keys = F.when(F.size("x") >= WINDOW, keys)
    return lines.select("id", "h", F.explode(keys).alias("w")).select("w.h1", "w.h2", "id", "h", "w.at")


def later_windows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(id, h, at) of the windows that have occurred before."""
    every = windows(docs, id_col, text_col)
    place = F.struct("id", "h", "at")
    first = every.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count("*").alias("n"))
    repeated = first.where("n > 1").select("h1", "h2", "first")
    joined = every.join(repeated, ["h1", "h2"])
    return joined.where(~place.eqNullSafe(F.col("first"))).select("id", "h", "at")


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size_col: str = "n_chars") -> DataFrame:
    """``docs`` without the lines that repeat earlier windows; the last column, a struct
    ``lines`` (renamed with ``_`` while a column has that name), has the lines before and those
    removed.

    The text and, if there is one, ``size_col`` are those of what remains. Texts with fewer than
    three lines with words, and texts of which nothing goes (null ones too), stay as they are; a
    text of which every line goes becomes empty. The first occurrence is that of the smallest
    id (null before all), then by place; rows of equal id and text are one occurrence, so that
    they keep equal texts. No rows give no rows.
    """
    gone = later_windows(docs, id_col, text_col).groupBy("id", "h").agg(F.collect_set("at").alias("at"))
    name = free_name(docs, "lines")
    keyed = docs.select(F.struct(*map(named, docs.columns)).alias("row"), F.xxhash64(whole_text(text_col)).alias("text_h"))
    # two plain equalities: ids are given a stand-in for null, so that the join can sort and split
    other = F.lit("0").cast(docs.schema[id_col].dataType)
    ids = lambda c: (c.isNull().alias("no_id"), F.coalesce(c, other).alias("some_id"))
    row = lambda c: F.col("row").getField(c)
    whole = F.coalesce(row(text_col), F.lit(""))
    left = keyed.select("row", "text_h", *ids(row(id_col)))
    right = gone.select(F.col("h").alias("text_h"), "at", *ids(F.col("id")))
    joined = left.join(right, ["text_h", "no_id", "some_id"], "left").select(
        "row", "at", _lines(whole).alias("x"), F.split(whole, "\n").alias("all")
    )
    covered = F.array_distinct(F.flatten(F.transform("at", lambda a: F.transform(
        F.sequence(a, a + WINDOW - 1), lambda i: F.get("x", i).i))))
    cut = joined.withColumn("covered", covered)
    left_over = F.array_join(
        F.transform(
            F.array_except(F.sequence(F.lit(0), F.size("all") - 1), F.col("covered")), lambda i: F.get("all", i)
        ),
        "\n",
    )
    text = F.when(F.col("at").isNull(), row(text_col)).otherwise(left_over)
    removed = F.coalesce(F.size(F.col("covered")), F.lit(0))
    removed = F.when(F.col("at").isNull(), 0).otherwise(removed)
    cut = cut.withColumn("new", text).withColumn(
        "told", F.struct(F.size("x").cast("long").alias("n_lines"), removed.cast("long").alias("n_removed"))
    )

    def column(c: str) -> Column:
        if c == text_col:
            return F.col("new").alias(c)
        if c == size_col:
            kind = docs.schema[c].dataType
            return F.when(F.col("at").isNull(), row(c)).otherwise(F.length("new")).cast(kind).alias(c)
        return row(c).alias(c)

    return cut.select(*(column(c) for c in docs.columns), F.col("told").alias(name))

"""Landing files: listing, choosing the newest, reading.

Two layouts are read. Named objects, ``<prefix>_<anything>.json`` under a root, one
JSON array each. Dated folders, ``ingest_date=YYYY-MM-DD/part-*``, as written by
:mod:`saleslake.sinks.landing`, one record per line and therefore splittable.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from saleslake.functions.stamp import with_received_at
from saleslake.schemas import CORRUPT, OTHER, with_corrupt
from saleslake.sources.arrays import array_values
from saleslake.sources.files import qualified


SPLIT_BYTES = 64 << 20


class NoLandingFile(LookupError):
    """There is no landing file for the prefix that was asked for."""


FILE_COLUMNS = ("path", "source_file", "received_at", "n_bytes")


def described(files: DataFrame) -> DataFrame:
    """The columns of files listed as binary files: path, source_file, received_at, n_bytes."""
    return files.select(
        "path",
        F.col("_metadata.file_path").alias("source_file"),
        F.col("_metadata.file_modification_time").alias("received_at"),
        F.col("length").alias("n_bytes"),
    )


def manifest(
    spark: SparkSession, root: str, prefix: str | None = None, suffix: str | None = ".json"
) -> DataFrame:
    """One row per landing object: path, name, batch_day, source_file, received_at, n_bytes.

    ``name`` is relative to the root, and the prefix and suffix rules look at all of
    it: with prefix ``sales``, ``sales_dir/x.json`` belongs and ``sub/sales_1.json``
    does not. An object is identified by (source_file, received_at), the pair that
    bronze keeps. The scan lists files only; contents are not a column of the plan.
    """
    base = qualified(spark, root)
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    named = described(listed).withColumn("name", F.substr("path", F.lit(len(base) + 2)))
    if prefix is not None:
        named = named.where(F.col("name").startswith(f"{prefix}_"))
    if suffix is not None:
        named = named.where(F.col("name").endswith(suffix))
    day = F.regexp_extract("name", r"(\d{4}-\d{2}-\d{2})", 1)
    return named.withColumn("batch_day", F.nullif(day, F.lit("")))


def newest_first(files: DataFrame) -> DataFrame:
    """The one newest object; the smallest path wins a tie."""
    return files.orderBy(F.col("received_at").desc(), F.col("path").asc()).limit(1)


def latest_file(spark: SparkSession, root: str, prefix: str, suffix: str = ".json") -> Row:
    found = newest_first(manifest(spark, root, prefix, suffix)).first()
    if found is None:
        raise NoLandingFile(f"no landing file {prefix}_*{suffix} under {root}")
    return found


def read_landing(
    spark: SparkSession,
    paths: str | Sequence[str],
    schema: T.StructType,
    fmt: str = "json",
    multi_line: bool = False,
    sizes: Mapping[str, int] | None = None,
) -> DataFrame:
    """Rows of landing files with the given schema, their file and its arrival time.

    The schema is given, not inferred: no extra pass over the files, and a column
    cannot change type between batches. A value that does not fit becomes NULL and
    the record's text is kept in ``_corrupt_record``. Attributes of a JSON record that the
    schema does not name are kept in ``_other_attributes``.

    Without ``multi_line``, a line holds a record or an array of records. With it, a
    file holds one array or record, over any number of lines. The whole text of a line or
    file that holds anything else is kept in ``_corrupt_record``. With the files' ``sizes`` an
    array of more than ``SPLIT_BYTES`` is read by many tasks (:mod:`saleslake.sources.arrays`);
    of one that is broken only the values around the break are corrupt.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    reader = spark.read.option("recursiveFileLookup", True)
    if fmt == "json" and multi_line:
        large = [path for path in paths if (sizes or {}).get(path, 0) > SPLIT_BYTES]
        small = [path for path in paths if path not in set(large)]
        found, plain = array_values(spark, large) if large else (None, [])
        parts = [json_records(found, schema, lists=False)] if found is not None else []
        if small or plain or not parts:
            parts.append(json_records(reader.text(small + plain or large, wholetext=True), schema))
        return reduce(DataFrame.unionByName, parts)
    if fmt == "json":
        return json_records(reader.text(paths), schema, plain=True)
    if fmt == "csv":
        rows = reader.schema(with_corrupt(schema)).csv(
            paths, header=True, enforceSchema=False, multiLine=multi_line, columnNameOfCorruptRecord=CORRUPT
        )
        return with_received_at(rows.withColumn(OTHER, F.lit(None).cast("string")))
    raise ValueError(f"unsupported landing format: {fmt!r}")


_RECORDS = "map<string,array<map<string,string>>>"


def _let(value: Column, of: Callable[[Column], Column]) -> Column:
    """What is made of a value that is computed once."""
    return F.get(F.transform(F.array(value), of), F.lit(0))


def _as_written(texts: DataFrame, schema: T.StructType) -> DataFrame:
    """Texts with ``written``, the attributes of one that is written as Spark writes a record with all
    of them, and ``same``, whether it is.

    What stands between commas is cast, and the record is written again from these values. If that
    is the text, and its strings hold no escape, then the text is this record and nothing else,
    however its values were found.
    """
    kept = ["source_file", "received_at", "value"]
    fits, found, again, end = F.size("parts") == len(schema), [], [], ""
    for at, field in enumerate(schema):
        quote = '"' if isinstance(field.dataType, T.StringType) else ""
        fits = fits & F.lit(isinstance(field.dataType, (T.LongType, T.DecimalType, T.StringType)))
        begin = f'{"" if at else "{"}"{field.name}":{quote}'
        part = F.substr(F.get("parts", F.lit(at)), F.lit(len(begin) + 1))
        if quote or at + 1 == len(schema):
            part = F.substring_index(part, quote or "}", 1)
        found.append(part.alias(field.name))
        again += [F.lit(f"{end}{begin}"), F.col(field.name).cast("string")]
        end = f"{quote},"
    texts = texts.select(*kept, F.split("value", ",").alias("parts"))
    texts = texts.select(*kept, fits.alias("fits"), *found)
    texts = texts.select(*kept, "fits", *(F.col(field.name).try_cast(field.dataType).alias(field.name) for field in schema))
    same = F.col("fits") & (F.concat(*again, F.lit(f"{end[:-1]}}}")) == F.col("value"))
    for field in schema:
        if isinstance(field.dataType, T.StringType):
            same = same & ~F.col(field.name).rlike(r"[\x00-\x1f\\]") & F.is_valid_utf8(field.name)
    return texts.select(*kept, F.struct(*schema.names).alias("written"), F.coalesce(same, F.lit(False)).alias("same"))


def _plain(files: DataFrame, schema: T.StructType) -> DataFrame:
    """Texts with ``plain``, their attributes as the schema has them, and ``is_plain``, whether that is all.

    A text is plain if its length is that of its braces, commas, names and values as Spark writes
    them, text in quotes and numbers without. Then it holds no blank, escape, null, second value or
    attribute of another name, and nothing beside the record. Texts that are not plain may be right.
    Texts that were told to be the record without a JSON reader are plain too, and not read by one.
    """
    files = _as_written(files, schema)
    # whole numbers as such; others as they are written, to be cast like those of other texts
    kinds = [field.dataType if isinstance(field.dataType, T.LongType) else T.StringType() for field in schema]
    fields = [T.StructField(field.name, kind, True) for field, kind in zip(schema, kinds, strict=True)]
    read = F.from_json(F.when(~F.col("same"), F.col("value")), T.StructType(fields), {"allowSingleQuotes": "false"})
    files = files.select("source_file", "received_at", "value", "written", "same", read.alias("plain"))
    text = F.col("value")
    size, fits, values = F.lit(1), F.octet_length(text) > 1, []
    for field in schema:
        value = written = F.col("plain")[field.name]
        name = f'"{field.name}":'
        marks = len(f"{name},".encode())
        if isinstance(field.dataType, T.StringType):
            # a number in its place would be two bytes shorter than it seems
            fits = fits & (value.isNull() | F.contains(text, F.lit(f'{name}"')))
            marks += 2
        elif not isinstance(field.dataType, T.LongType):
            # a number with all digits of its type, or as the reader tells it: the text shows which
            told, value = value, value.try_cast(field.dataType)
            forms = [value.cast("string"), told]
            at = [F.contains(text, F.concat(F.lit(name), form)) for form in forms]
            written = F.when(at[0], forms[0]).when(at[1], forms[1])
            fits = fits & (told.isNull() | (value.isNotNull() & written.isNotNull()))
        size = size + F.coalesce(F.octet_length(written.cast("string")) + F.lit(marks), F.lit(0))
        values.append(F.when(F.col("same"), F.col("written")[field.name]).otherwise(value).alias(field.name))
    is_plain = F.col("same") | F.coalesce(fits & (F.octet_length(text) == size), F.lit(False))
    return files.select("source_file", "received_at", "value", is_plain.alias("is_plain"), F.struct(*values).alias("plain"))


def _apart(text: Column, lists: bool) -> Column:
    """The records of a text: a list of ``parsed``, a record's map or null, and ``text``."""

    def record(parsed: Column, written: Column) -> Column:
        return F.struct(parsed.alias("parsed"), written.alias("text"))

    def read(whole: Column, listed: Column, mark: Column, framed: Column) -> Column:
        def by_map(read: Column) -> Column:
            found = F.try_element_at(read, F.lit("records"))
            end = F.try_element_at(read, F.lit("end"))
            done = (
                (F.size(read) == 2)
                & (F.try_element_at(F.get(end, F.lit(0)), F.lit("mark")) == mark)
                & (listed | (F.size(found) <= 1))
            )
            each = F.transform(found, lambda m: record(m, F.lit("null")))
            return F.when(F.coalesce(done, F.lit(False)), each).otherwise(
                _let(F.from_json(framed, "map<string,array<string>>"), by_value)
            )

        def by_value(values: Column) -> Column:
            single = F.try_element_at(values, F.lit("records"))
            ended = F.get(F.try_element_at(values, F.lit("end")), F.lit(0)) == F.concat(
                F.lit('{"mark":"'), mark, F.lit('"}')
            )
            whole_read = (F.size(values) == 2) & ended & (listed | (F.size(single) <= 1))
            each = F.transform(
                single,
                lambda x: record(F.from_json(F.coalesce(x, F.lit("null")), "map<string,string>"), F.coalesce(x, F.lit("null"))),
            )
            broken = F.array(record(F.lit(None).cast("map<string,string>"), whole))
            return F.when(F.coalesce(whole_read, F.lit(False)), each).otherwise(broken)

        return _let(F.from_json(framed, _RECORDS), by_map)

    def framed(whole: Column) -> Column:
        listed = whole.rlike(r"^[ \t\r\n]*\[") & F.lit(lists)
        mark = F.xxhash64(whole).cast("string")
        body = F.when(listed, whole).otherwise(F.concat(F.lit("["), whole, F.lit("]")))
        frame = F.concat(F.lit('{"records":'), body, F.lit(',"end":[{"mark":"'), mark, F.lit('"}]}'))
        parts = F.struct(listed.alias("listed"), mark.alias("mark"), frame.alias("framed"))
        return _let(parts, lambda p: read(whole, p["listed"], p["mark"], p["framed"]))

    marked = text.startswith("\ufeff")  # a byte order mark
    return _let(F.when(marked, F.substr(text, F.lit(2))).otherwise(text), framed)


def json_records(texts: DataFrame, schema: T.StructType, lists: bool = True, plain: bool = False) -> DataFrame:
    """The records of texts (lines, or whole files) of one JSON value each.

    A record is read as a map of its attributes as they are written: those of the schema become
    columns, and the rest is kept as JSON text, nested values as text in it.

    A reader stops after the first value of a text. So a text is read inside an object that ends
    with the text's own hash, which nothing can stand in for: one pass gives the records and shows
    that the text was read to its end. What cannot be read so (values that are no records, broken
    texts) is taken apart value by value. Without ``lists`` a list is such a value too.

    With ``plain`` each text is first read as a record of the schema's attributes; where its length
    shows that it holds nothing else, this spares the map. The rows are the same.
    """
    files = with_received_at(texts) if "source_file" not in texts.columns else texts
    files = _plain(files, schema) if plain else files.withColumn("is_plain", F.lit(False))
    is_plain, kept = F.col("is_plain"), ["plain"] if plain else []
    # an outer one: for others the optimizer adds a filter that reads the text once more
    apart = F.when(~is_plain, _apart(F.col("value"), lists)).alias("apart")
    rows = files.select("source_file", "received_at", "is_plain", *kept, apart)
    rows = rows.select("source_file", "received_at", "is_plain", *kept, F.explode_outer("apart").alias("found"))
    rows = rows.where(is_plain | F.col("found").isNotNull())
    parsed = F.col("found.parsed")
    corrupt = F.when(parsed.isNull(), F.col("found.text"))
    written = {field.name: F.try_element_at(parsed, F.lit(field.name)) for field in schema}
    known = reduce(Column.__add__, [value.isNotNull().cast("int") for value in written.values()])
    rest = F.map_filter(parsed, lambda name, _: ~name.isin(list(written)))
    other = F.when(F.size(parsed) > known, F.when(F.size(rest) > 0, F.to_json(rest)))
    values, corrupt = _typed(written, corrupt, schema)
    if plain:
        values = {name: F.when(is_plain, F.col("plain")[name]).otherwise(value) for name, value in values.items()}
        corrupt, other = (F.when(~is_plain, column) for column in (corrupt, other))
    columns = [value.alias(name) for name, value in values.items()]
    return rows.select(*columns, corrupt.alias(CORRUPT), other.alias(OTHER), "source_file", "received_at")


def _cast(text: Column, kind: T.DataType) -> Column:
    """Text as a value; a whole number may be written with a point and zeros."""
    value = text.try_cast(kind)
    if isinstance(kind, T.IntegralType):
        return F.coalesce(value, F.regexp_replace(text, r"\.0+$", "").try_cast(kind))
    return value


def _typed(written: Mapping[str, Column], corrupt: Column, schema: T.StructType) -> tuple[dict[str, Column], Column]:
    """Values read as text, cast to their types, and the text of a record that does not fit.

    To the reader an array is one record: a single value of a wrong type would attach
    the text of the whole array to each of its rows. Casting afterwards keeps the text
    of the bad element alone.
    """
    cast = {field.name: _cast(written[field.name], field.dataType) for field in schema}
    misfits = [written[name].isNotNull() & value.isNull() for name, value in cast.items()]
    as_read = F.struct(*(value.alias(name) for name, value in written.items()))
    return cast, F.coalesce(corrupt, F.when(reduce(Column.__or__, misfits), F.to_json(as_read)))


def read_latest(
    spark: SparkSession, root: str, prefix: str, schema: T.StructType, multi_line: bool = True
) -> DataFrame:
    """Rows of the newest named object."""
    return read_landing(spark, latest_file(spark, root, prefix)["path"], schema, multi_line=multi_line)


def pending_files(files: DataFrame, loaded: DataFrame) -> DataFrame:
    """Objects not loaded yet. An object replaced under its name is a new one.

    ``loaded`` has a row for each ``source_file`` and ``received_at``.
    """
    return files.join(loaded, ["source_file", "received_at"], "left_anti")

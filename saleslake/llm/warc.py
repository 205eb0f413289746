"""WARC archives: a deterministic sharded writer and a reader.

The same pages give the same files, byte for byte, however they are partitioned. Page ids fall
into a fixed number of equal ranges; the ranges' sizes, summed up in order, give each its
shard, and a range that is larger than a shard is dealt by a hash of the id. Inside a shard
records are sorted by id and digest, and a new file begins when the compressed size is reached.

Which page of equal payloads is the response is an aggregate over digests alone; its result is
sent to the shards beside the payloads, which so are shuffled once, by id: copies of one page,
however many, are dealt evenly. Files are written under names of the task's attempt; the written
manifest of attempts that count is then renamed, file by file, and repeating that changes nothing.
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from saleslake.llm.files import attempt_name, give_back_memory, store_of
from saleslake.llm.shared import small_batches, store

RANGES = 1 << 12
SHARD_BYTES = 16 << 20  # payload bytes of a shard, about
FILE_BYTES = 4 << 20  # compressed bytes at which a new file begins
REVISIT_BYTES = 1000  # payloads below are never written as revisits
DATE = "2024-01-01T00:00:00Z"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_OVERHEAD = 600
_READ_BYTES = 1 << 20
_MANIFEST = "shard string, number int, temporary string, name string, records long, bytes long"


def _clean(value: str) -> str:
    return "".join(c if c > " " and c != "\x7f" else f"%{ord(c):02X}" for c in value)


def record_id(page: int | None, digest: str, copy: int) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'{page} {digest} {copy}')}>"


def _sha1(data: bytes) -> str:
    return "sha1:" + base64.b32encode(hashlib.sha1(data).digest()).decode()


def record(page, url, payload: bytes, digest: str, copy: int, refers_to: tuple | None) -> bytes:
    """One record; ``refers_to``: the page whose record is the response, as a tuple of its id."""
    http = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
    http += b"Content-Length: %d\r\n\r\n" % len(payload)
    block = http if refers_to else http + payload
    fields = [
        ("WARC-Type", "revisit" if refers_to else "response"),
        ("WARC-Record-ID", record_id(page, digest, copy)),
        ("WARC-Date", DATE),
        ("Content-Type", "application/http;msgtype=response"),
        ("Content-Length", str(len(block))),
        ("WARC-Payload-Digest", "sha1:" + base64.b32encode(bytes.fromhex(digest)).decode()),
        ("WARC-Block-Digest", _sha1(block)),
    ]
    if url is not None:
        fields.append(("WARC-Target-URI", _clean(url)))
    if page is not None:
        fields.append(("X-Page-ID", str(page)))
    if refers_to:
        fields += [("WARC-Profile", PROFILE), ("WARC-Refers-To", record_id(refers_to[0], digest, 0))]
        if refers_to[0] is not None:
            fields.append(("X-Refers-To-Page-ID", str(refers_to[0])))
    head = "WARC/1.1\r\n" + "".join(f"{k}: {v}\r\n" for k, v in fields) + "\r\n"
    return head.encode() + block + b"\r\n\r\n"


def _member(data: bytes) -> bytes:
    packer = zlib.compressobj(6, zlib.DEFLATED, 31)
    return packer.compress(data) + packer.flush()


def _shards(meta: DataFrame, shard_bytes: int) -> tuple[Column, DataFrame, int]:
    """The range of a page id, (range, base, parts) of every range, and about how many shards."""
    low, high, total = meta.agg(F.min("page"), F.max("page"), F.sum(F.col("n") + _OVERHEAD)).first()
    low, high = low or 0, high or 0
    width = (high - low) // RANGES + 1
    page = F.coalesce(F.col("page"), F.lit(low))
    # in decimals, as the distance of two longs may not be a long
    which = F.floor((page.cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("int")
    sizes = meta.groupBy(which.alias("range")).agg(F.sum(F.col("n") + _OVERHEAD).alias("bytes"))
    before = Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    placed = sizes.select(
        "range",
        F.floor(F.coalesce(F.sum("bytes").over(before), F.lit(0)) / shard_bytes).alias("base"),
        F.ceil(F.col("bytes") / shard_bytes).cast("int").alias("parts"),
    )
    return which, placed, max(1, -(-(total or 0) // shard_bytes))


def _write(folder: str, file_bytes: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = store_of(folder)
        target.create_dir(f"{root}/temporary", recursive=True)
        out, state, done = None, None, []

        def close():
            out.close()
            done.append(state)

        role = last = None
        copies = 0
        for batch in batches:
            for row in batch.to_pylist():
                if row["role"]:
                    role = row
                    continue
                key = (row["page"], row["digest"])
                copies = copies + 1 if last == key else 0
                last = key
                found = role is not None and (role["page"], role["digest"]) == key
                refers_to = (role["responder"],) if found else None
                if found and copies == 0 and role["responder"] == row["page"]:
                    refers_to = None
                data = _member(record(row["page"], row["url"], row["payload"], row["digest"], copies, refers_to))
                if state is None or state["shard"] != row["shard"] or state["bytes"] >= file_bytes:
                    number = state["number"] + 1 if state and state["shard"] == row["shard"] else 0
                    if state:
                        close()
                    name = f"{row['shard']}-{number:05d}.warc.gz"
                    temporary = f"temporary/{attempt_name(name)}"
                    state = dict(shard=row["shard"], number=number, temporary=temporary, name=name, records=0, bytes=0)
                    out = target.open_output_stream(f"{root}/{temporary}", compression=None)
                out.write(data)
                state["records"] += 1
                state["bytes"] += len(data)
        if state:
            close()
        kinds = {"number": pa.int32()}
        names = [f.split()[0] for f in _MANIFEST.split(", ")]
        give_back_memory()
        yield pa.record_batch(
            {
                n: pa.array([d[n] for d in done], kinds.get(n, pa.int64() if n in ("records", "bytes") else pa.string()))
                for n in names
            }
        )

    return write


def _publish(folder: str):
    def publish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        target, root = store_of(folder)
        for batch in batches:
            for row in batch.to_pylist():
                source = f"{root}/{row['temporary']}"
                if target.get_file_info(source).is_file:
                    target.move(source, f"{root}/{row['name']}")
                elif not target.get_file_info(f"{root}/{row['name']}").is_file:
                    raise FileNotFoundError(source)
            yield batch

    return publish


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    payload_col: str = "html",
    url_col: str = "url",
    shard_bytes: int = SHARD_BYTES,
    file_bytes: int = FILE_BYTES,
    revisit_bytes: int = REVISIT_BYTES,
) -> DataFrame:
    """Write one record per row into ``folder``, a new one; the manifest, also written there.

    Of records with equal payloads of ``revisit_bytes`` or more, the one of the largest id is the
    response and the others revisit it; rows that repeat it revisit it too. A null payload is
    empty, null ids are smaller than all others, a null address is left out, and other columns
    are not read. No rows give a manifest without files. The manifest has a row per file.
    """
    rows = pages.select(
        F.col(id_col).cast("long").alias("page"),
        F.col(url_col).cast("string").alias("url"),
        F.coalesce(F.col(payload_col).cast("string"), F.lit("")).cast("binary").alias("payload"),
    ).withColumn("digest", F.sha1("payload"))
    meta = store(rows.select("page", "digest", F.length("payload").alias("n")), "payloads")
    which, placed, shards = _shards(meta, shard_bytes)
    copies = meta.where(F.col("n") >= revisit_bytes).groupBy("digest")
    responders = copies.agg(F.max("page").alias("responder"), F.count("*").alias("c")).where("c > 1")
    roles = meta.join(responders.select("digest", "responder"), "digest").select("page", "digest", "responder").distinct()
    none = F.lit(None)
    both = rows.select(
        "page", "url", "payload", "digest", F.lit(False).alias("role"), none.cast("long").alias("responder")
    ).unionByName(
        roles.select(
            "page", none.cast("string").alias("url"), none.cast("binary").alias("payload"), "digest",
            F.lit(True).alias("role"), "responder",
        )
    )
    part = F.when(F.col("parts") > 1, F.pmod(F.xxhash64("page"), F.col("parts"))).otherwise(0)
    shard = F.concat(F.lpad(F.col("base").cast("string"), 8, "0"), F.lit("-"), F.lpad(part.cast("string"), 5, "0"))
    # RANGES rows at most
    dealt = both.withColumn("range", which).join(F.broadcast(placed), "range").withColumn("shard", shard)
    ready = (
        dealt.select("shard", "page", "digest", "role", "responder", "url", "payload")
        .repartition(shards, "shard")
        .sortWithinPartitions("shard", "page", "digest", F.desc("role"), "url")
    )
    with small_batches(pages.sparkSession):
        written = store(ready.mapInArrow(_write(folder, file_bytes), _MANIFEST), "manifest")
    published = written.mapInArrow(_publish(folder), _MANIFEST)
    published.write.parquet(f"{folder}/manifest")
    return pages.sparkSession.read.schema(written.schema).parquet(f"{folder}/manifest")


def members(uri: str) -> Iterator[bytes]:
    """The uncompressed members of a gzip file, one at a time."""
    target, path = store_of(uri)
    with target.open_input_stream(path, compression=None) as source:
        unpacker, parts = zlib.decompressobj(31), []
        data = source.read(_READ_BYTES)
        while data:
            parts.append(unpacker.decompress(data))
            data = unpacker.unused_data
            if unpacker.eof:
                yield b"".join(parts)
                unpacker, parts = zlib.decompressobj(31), []
            data = data or source.read(_READ_BYTES)
        if any(parts):
            raise ValueError(f"{uri} ends inside a record")


def parsed(data: bytes) -> dict:
    """Fields of a record; its lengths and digests are checked."""
    head, _, rest = data.partition(b"\r\n\r\n")
    lines = head.decode().split("\r\n")
    fields = dict(line.split(": ", 1) for line in lines[1:])
    block = rest[: int(fields["Content-Length"])]
    if lines[0] != "WARC/1.1" or rest[len(block) :] != b"\r\n\r\n" or _sha1(block) != fields["WARC-Block-Digest"]:
        raise ValueError(f"broken record {fields.get('WARC-Record-ID')}")
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(http.rpartition(b"Content-Length: ")[2])
    kind = fields["WARC-Type"]
    if kind == "response" and (len(payload) != size or _sha1(payload) != fields["WARC-Payload-Digest"]):
        raise ValueError(f"broken payload {fields['WARC-Record-ID']}")
    number = lambda name: int(fields[name]) if name in fields else None
    return {
        "page_id": number("X-Page-ID"),
        "url": fields.get("WARC-Target-URI"),
        "payload_bytes": size,
        "payload_digest": base64.b32decode(fields["WARC-Payload-Digest"][5:]).hex(),
        "record_type": kind,
        "refers_to": number("X-Refers-To-Page-ID"),
        "payload": payload if kind == "response" else None,
    }


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of the files in a folder's manifest; payloads of responses if asked for."""
    manifest = spark.read.parquet(f"{folder}/manifest")
    columns = [
        ("page_id", pa.int64()), ("url", pa.string()), ("payload_bytes", pa.int64()), ("payload_digest", pa.string()),
        ("record_type", pa.string()), ("refers_to", pa.int64()),
    ] + [("payload", pa.binary())] * payloads
    kind = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary"}
    schema = ", ".join(f"{n} {kind[t]}" for n, t in columns)

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch_of(rows: list[dict]) -> pa.RecordBatch:
            return pa.record_batch({n: pa.array([r[n] for r in rows], t) for n, t in columns})

        for batch in batches:
            for name in batch.column(0).to_pylist():
                rows: list[dict] = []
                for data in members(f"{folder}/{name}"):
                    rows.append(parsed(data))
                    if len(rows) == 500:
                        yield batch_of(rows)
                        rows = []
                yield batch_of(rows)
        give_back_memory()

    files = max(1, manifest.count())
    return manifest.select("name").repartition(files).mapInArrow(read, schema)

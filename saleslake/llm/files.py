"""Files that tasks write and read themselves, on any store that pyarrow reaches.

A task's attempt writes under a name of its own and returns that name in a row; the written
table of these rows says which files count. What a lost or repeated attempt has left is in no
row and is never read.
"""

from __future__ import annotations

import ctypes
import uuid

import pyarrow as pa
from pyarrow import fs


# Schemes of Hadoop's file systems, and pyarrow's for the same stores.
SCHEMES = {"s3a": "s3", "s3n": "s3", "wasb": "abfs", "wasbs": "abfss"}


def spelled(uri: str) -> str:
    """An address as pyarrow spells it: Hadoop has names of its own for some stores."""
    scheme, mark, rest = uri.partition("://")
    return SCHEMES.get(scheme.lower(), scheme) + mark + rest


def store_of(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(spelled(uri))


def attempt_name(stem: str) -> str:
    return f"{stem}-{uuid.uuid4().hex}"


def write_file(folder: str, stem: str, *parts: bytes) -> str:
    """A new file of these bytes; its address."""
    uri = f"{folder.rstrip('/')}/{attempt_name(stem)}"
    store, path = store_of(uri)
    store.create_dir(path.rpartition("/")[0], recursive=True)
    with store.open_output_stream(path, compression=None) as out:
        for part in parts:
            out.write(part)
    return uri


def read_range(uri: str, offset: int, length: int) -> bytes:
    store, path = store_of(uri)
    with store.open_input_file(path) as file:
        file.seek(offset)
        return file.read(length)


def read_file(uri: str) -> bytes:
    store, path = store_of(uri)
    with store.open_input_file(path) as file:
        return file.read()


def give_back_memory() -> None:
    """Return what a task has freed to the system, as its worker lives on for other tasks."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)

"""Plain helpers that the tests compare with."""

from __future__ import annotations

import zlib

import duckdb

SF = "/root/testdata/sf0.001"


def rows(name: str, columns: str, sf: str = SF) -> list[tuple]:
    return duckdb.sql(f"SELECT {columns} FROM '{sf}/{name}.parquet'").fetchall()


def remainder(ident, by: int) -> int:
    return zlib.crc32(b"" if ident is None else str(ident).encode()) % by


def components(nodes, links) -> dict:
    """Smallest reachable node of each node."""
    parent = {n: n for n in nodes}

    def root(n):
        while parent[n] != n:
            parent[n] = parent[parent[n]]
            n = parent[n]
        return n

    for a, b in links:
        a, b = root(a), root(b)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {n: root(n) for n in nodes}

"""SimHash near-duplicates by meet-in-the-middle ball hashing.

Two fingerprints at most 2r bits apart share a variant at most r bits from each. Every
fingerprint's variants within r bits meet in shuffled slices; fingerprints with a common variant
are linked after a check of their distance.

A slice is chosen by a linear hash (parities of fixed bit sets), so that the slice of a variant
is the slice of its fingerprint XOR the slice of its mask. A fingerprint is shuffled once to each
slice that holds variants of it, and the slice writes out those variants itself: every slice
holds the same share of every fingerprint's variants, however alike the fingerprints are, and
8 bytes travel instead of one row per variant.
"""

from __future__ import annotations

import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import LongType

from saleslake.llm.components import connected_components, spanning_links
from saleslake.llm.files import give_back_memory
from saleslake.llm.shared import free_name, named, power_of_two, store

HASH_SEED = 42
SLICES = 64
FINGERPRINTS_A_SLICE_MORE = 1 << 17
SLICE_FINGERPRINTS = 1 << 25
CHUNK_VARIANTS = 1 << 22
_OWNERS_AT_ONCE = 1 << 18
_COUNTED_AT_ONCE = 1 << 18


def fingerprint_of(text: str | None, shingle: int) -> int:
    """The fingerprint, as a signed 64-bit number; a null or blank text has 0."""
    words = (text or "").encode("utf-8", "replace").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    ends = np.cumsum(lengths + 1) - 1
    starts = ends - lengths
    last = min(shingle, len(words)) - 1
    digest = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - last].tolist(), ends[last:].tolist(), strict=True)
    ones, total = np.zeros(64, np.int64), 0
    while True:
        hashes = np.fromiter(
            (digest(joined[s:e], HASH_SEED) for s, e in itertools.islice(pairs, _COUNTED_AT_ONCE)),
            np.uint64,
        )
        if not len(hashes):
            break
        total += len(hashes)
        bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    value = np.packbits(2 * ones > total, bitorder="little").view(np.int64)[0]
    return int(value)


def fingerprint(text: Column, shingle: int = 4) -> Column:
    """Majority bits of the XXH64 (seed 42) of a text's word shingles, as a long.

    Words are runs of characters other than ASCII white space, A-Z in lower case. Fewer words
    than a shingle make one shingle of all; no words, or a null text, make zero.
    """

    def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            yield pa.array((fingerprint_of(t.as_py(), shingle) for t in batch), pa.int64(), size=len(batch))
        give_back_memory()

    batches.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, LongType())(text)


def ball(radius: int) -> np.ndarray:
    """Every mask of at most ``radius`` of 64 bits."""
    masks = [0]
    for n in range(1, radius + 1):
        masks += [sum(1 << b for b in bits) for bits in itertools.combinations(range(64), n)]
    return np.array(masks, np.uint64)


def _bit_sets(n: int) -> list[int]:
    """Fixed, arbitrary sets of bits, one per bit of the slice number."""
    return [xxhash.xxh64_intdigest(f"slice bit {i}") for i in range(n)]


def _slice_of(values: np.ndarray, bits: int) -> np.ndarray:
    out = np.zeros(len(values), np.int64)
    for i, chosen in enumerate(_bit_sets(bits)):
        out |= (np.bitwise_count(values & np.uint64(chosen)).astype(np.int64) & 1) << i
    return out


def _colliding(variants: np.ndarray, owners: np.ndarray, max_bits: int):
    """Links from every owner of a shared variant to the variant's smallest owner."""
    ordered = np.sort(variants)
    shared = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(shared):
        return shared, shared
    # a small table drops most variants that nothing shares before the exact sort
    spread = lambda v: (v * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(42)
    marked = np.zeros(1 << 22, bool)
    marked[spread(shared)] = True
    some = marked[spread(variants)]
    variants, owners = variants[some], owners[some]
    order = np.lexsort((owners, variants))
    variants, owners = variants[order], owners[order]
    first = np.flatnonzero(np.r_[True, variants[1:] != variants[:-1]])
    head = np.repeat(owners[first], np.diff(np.r_[first, len(variants)]))
    near = (owners != head) & (np.bitwise_count(owners ^ head) <= max_bits)
    return owners[near], head[near]


def copies_of(n_masks: int, slices: int) -> float:
    """To how many slices a fingerprint goes: those that some of its variants are dealt to."""
    return slices * -math.expm1(n_masks * math.log1p(-1 / slices))


def slices_for(n: int, n_masks: int) -> int:
    """Slices for ``n`` fingerprints, doubled as they double, and enough that a slice holds
    ``SLICE_FINGERPRINTS`` at most (8 bytes each)."""
    slices = max(SLICES, power_of_two(min(n, SLICE_FINGERPRINTS) / FINGERPRINTS_A_SLICE_MORE))
    while n * copies_of(n_masks, slices) / slices > SLICE_FINGERPRINTS:
        slices *= 2
    return slices


def similar_fingerprints(distinct: DataFrame, name: str, n: int, max_bits: int = 4) -> DataFrame:
    """Links (a, b) with the components of all pairs at most ``max_bits`` (even) bits apart.

    ``distinct`` holds each of the ``n`` fingerprints once. A slice gives a spanning forest of
    the links that it finds, at most one row per fingerprint.
    """
    if max_bits % 2:
        raise ValueError("max_bits must be even: half of it is the radius of the variants")
    masks = ball(max_bits // 2)
    slices = slices_for(n, len(masks))
    bits = int(math.log2(slices))
    chunks = power_of_two(max(n, 1) * len(masks) / slices / CHUNK_VARIANTS)
    all_bits = bits + int(math.log2(chunks))

    def links(key: tuple, table: pa.Table) -> pa.Table:
        owners = table.column("f").to_numpy().view(np.uint64)
        mask_slice = _slice_of(masks, all_bits)
        order = np.argsort(mask_slice, kind="stable")
        sorted_masks = masks[order]
        starts = np.searchsorted(mask_slice[order], np.arange((1 << all_bits) + 1))
        own = _slice_of(owners, all_bits).astype(np.int32)
        found: list[tuple[np.ndarray, np.ndarray]] = []
        for chunk in range(1 << (all_bits - bits)):
            variants, of = [], []
            for at in range(0, len(owners), _OWNERS_AT_ONCE):
                some = owners[at : at + _OWNERS_AT_ONCE]
                wanted = own[at : at + _OWNERS_AT_ONCE] ^ (key[0].as_py() | (chunk << bits))
                begin, counts = starts[wanted], starts[wanted + 1] - starts[wanted]
                within = np.arange(int(counts.sum())) - np.repeat(np.cumsum(counts) - counts, counts)
                of.append(np.repeat(some, counts))
                variants.append(of[-1] ^ sorted_masks[np.repeat(begin, counts) + within])
            a, b = _colliding(np.concatenate(variants), np.concatenate(of), max_bits)
            if len(a):
                found.append(spanning_links(a, b))
        if not found:
            return pa.table({"a": pa.array([], pa.int64()), "b": pa.array([], pa.int64())})
        a, b = spanning_links(*(np.concatenate(x) for x in zip(*found, strict=True)))
        return pa.table({"a": a.view(np.int64), "b": b.view(np.int64)})

    own_slice = F.lit(0)
    for i, chosen in enumerate(_bit_sets(bits)):
        signed = chosen - (1 << 64) if chosen >> 63 else chosen
        parity = F.bit_count(F.col(name).bitwiseAND(F.lit(signed))) % 2
        own_slice = own_slice.bitwiseOR(F.shiftleft(parity.cast("int"), i))
    reached = sorted(set(_slice_of(masks, bits).tolist()))
    return (
        distinct.select(F.col(name).alias("f"), own_slice.alias("own"))
        .select("f", "own", F.explode(F.lit(reached).cast("array<int>")).alias("mask"))
        .select("f", F.col("own").bitwiseXOR(F.col("mask")).alias("slice"))
        .repartition(slices, "slice")
        .groupBy("slice")
        .applyInArrow(links, "a long, b long")
        .distinct()
    )


def simhash_groups(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """(id, fingerprint, component_id) of every document, one row per row of ``docs``.

    Fingerprints link at ``max_bits`` or fewer differing bits; the component is the smallest id
    reachable by links. Texts that are null or without words have fingerprint zero, which links
    like any other. Null ids are never a component; a group of null ids alone has a null one.
    No rows give no rows; repeated rows stay.
    """
    prints = store(
        docs.select(named(id_col).alias("id"), fingerprint(named(text_col), shingle).alias("f")),
        "fingerprints",
    )
    distinct = store(prints.groupBy("f").agg(F.min("id").alias("least")), "distinct")
    links = similar_fingerprints(distinct.select("f"), "f", distinct.count(), max_bits)
    groups = connected_components(links)
    rooted = distinct.join(groups.withColumnRenamed("node", "f"), "f", "left").select(
        "f", "least", F.coalesce("component", "f").alias("root")
    )
    rooted = store(rooted, "rooted")
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    labels = rooted.join(least, "root").select("f", "component_id")
    return prints.join(labels, "f").select(
        F.col("id").alias(id_col), F.col("f").alias("fingerprint"), "component_id"
    )


def keep_one_of_group(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 4, max_bits: int = 4
) -> DataFrame:
    """The rows whose id is their group's component, once each, with all columns of ``docs``.

    Rows with a null id stay only when no row of their group has an id.
    """
    groups = simhash_groups(docs, id_col, text_col, shingle, max_bits)
    heads = groups.where(named(id_col) == F.col("component_id")).select(named(id_col)).distinct()
    f, other = free_name(docs, "fingerprint"), free_name(docs, "head_id")
    columns = [named(c) for c in docs.columns]
    with_id = docs.where(named(id_col).isNotNull())
    kept = with_id.join(heads, id_col).select(*columns)
    kept = kept.dropDuplicates([id_col])
    nameless = groups.where(F.col("component_id").isNull()).select(F.col("fingerprint").alias(other))
    alone = (
        docs.where(named(id_col).isNull())
        .withColumn(f, fingerprint(named(text_col), shingle))
        .join(nameless.distinct(), F.col(f) == F.col(other), "left_semi")
        .select(*columns)
        .dropDuplicates([text_col])
    )
    return kept.unionByName(alone)

"""Best-fit packing after a reduction by dominance (Martello and Toth).

An item is a document's ids, or a piece of one longer than a sequence; only its number of tokens
matters, so an instance of any size is a count per length, ``length`` rows at most. On these
counts the reduction goes from the longest items down. For an item j, a set that holds j and fits
dominates the others when their items can be exchanged for its own: such a set is a whole sequence
of some best packing, so it is fixed, as often as its lengths are there, and the instance shrinks.
Sets of up to three items are looked at:

* j alone, when nothing fits beside it;
* j and the longest that fits, k, when they fill the sequence, when no two items fit beside j, or
  when no three do and no pair beside j is longer than k;
* j, k and the longest that still fits, l, when no three items fit beside j and no pair of items
  both longer than l does.

What is left is packed best-fit by descending length, again on counts: sequences in the same state
are one row. The packing is then a list of patterns with how often each occurs, from which an
item's place follows by its rank among the items of its length. Ranks are sums per input partition
and length; nothing is ordered globally, no group of equal lengths comes to one task, and the ids
are not shuffled unless they are asked for.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.shared import named, store
from saleslake.llm.tokens import encode, grouped

LENGTH = 2048
END_ID = 0


class Counts:
    """How many items of each length are left."""

    def __init__(self, counts: np.ndarray):
        self.n = counts.astype(np.int64)

    def longest(self, upto: int, without: tuple[int, ...] = ()) -> int:
        """The longest length of at most ``upto`` that is left; 0 when there is none."""
        for size in np.flatnonzero(self.n[: max(upto, 0) + 1])[::-1]:
            if self.n[size] > without.count(size):
                return int(size)
        return 0

    def shortest(self, k: int, above: int = 0, without: tuple[int, ...] = ()) -> list[int]:
        """The ``k`` shortest items that are longer than ``above``, fewer if there are fewer."""
        out: list[int] = []
        for size in np.flatnonzero(self.n[above + 1 :])[: k + len(without)] + above + 1:
            out += [int(size)] * min(k - len(out), int(self.n[size]) - without.count(size))
        return out

    def best_pair(self, room: int, without: tuple[int, ...]) -> int:
        """The largest sum of two items that is at most ``room``; 0 when there is none."""
        left = self.n.copy()
        for size in without:
            left[size] -= 1
        sizes = np.flatnonzero(left[: max(room, 0) + 1] > 0)
        partner = np.searchsorted(sizes, room - sizes, side="right") - 1
        # an item is no partner of itself unless there are two
        lone = (partner >= 0) & (sizes[partner] == sizes) & (left[sizes] < 2)
        partner = np.where(lone, partner - 1, partner)
        sums = np.where(partner >= 0, sizes + sizes[partner], 0)
        return int(sums.max(initial=0))


def reduced(counts: np.ndarray, length: int) -> tuple[list[tuple[tuple[int, ...], int]], np.ndarray]:
    """Sets that dominate, with how often each is fixed, and the counts of what is left."""
    left, fixed = Counts(counts), []
    for j in range(length, 0, -1):
        while left.n[j]:
            chosen = _dominating(left, j, length)
            if not chosen:
                break
            times = min(int(left.n[size]) // chosen.count(size) for size in set(chosen))
            for size in chosen:
                left.n[size] -= times
            fixed.append((chosen, times))
    return fixed, left.n


def _dominating(left: Counts, j: int, length: int) -> tuple[int, ...]:
    """A set with j that dominates all others with j; empty when none of the tests holds.

    What only removes other items keeps the tests true, so a set is fixed as often as it can be.
    """
    room = length - j
    least = left.shortest(3, without=(j,))
    if not least or least[0] > room:
        return (j,)
    k = left.longest(room, without=(j,))
    if k == room or len(least) < 2 or sum(least[:2]) > room:
        return (j, k)
    if len(least) > 2 and sum(least) <= room:
        return ()
    if k >= left.best_pair(room, (j,)):
        return (j, k)
    third = left.longest(room - k, without=(j, k))
    if not third:
        return ()
    longer = left.shortest(2, above=third, without=(j,))
    return (j, k, third) if len(longer) < 2 or sum(longer) > room else ()


def best_fit(counts: np.ndarray, length: int) -> list[tuple[dict[int, int], int]]:
    """Best-fit by descending length: what a sequence holds of each length, and how often.

    An item goes to the fullest sequence that has room. Sequences of equal contents are one entry;
    a length changes entries as wholes and splits at most one, so that there are a few times
    ``length`` of them whatever the counts are.
    """
    free: dict[int, list[tuple[dict[int, int], int]]] = defaultdict(list)
    for size in np.flatnonzero(counts)[::-1].tolist():
        left = int(counts[size])
        for room in [*sorted(r for r in free if r >= size), length]:
            each = room // size
            entries = free.pop(room, []) if room < length else []
            entries.reverse()
            while left and (entries or room == length):
                held, n = entries.pop() if entries else ({}, -(-left // each))
                whole = min(n, left // each)
                rest = left - whole * each if whole < n else 0
                if rest:
                    free[room - rest * size].append(({**held, size: rest}, 1))
                if whole:
                    free[room - each * size].append(({**held, size: each}, whole))
                untouched = n - whole - bool(rest)
                if untouched:
                    entries.append((held, untouched))
                left -= whole * each + rest
            if room < length:
                free[room] += entries[::-1]
            if not left:
                break
    return [entry for entries in free.values() for entry in entries]


@dataclass(frozen=True)
class Slots:
    """Places of all items: slots of the items of a length one after the other, by patterns.

    ``base`` has how many items are shorter than each length. Slots from ``start`` on, counted
    through all lengths, lie ``each`` to a sequence from sequence ``first`` on, the first of a
    sequence at ``offset``.
    """

    base: np.ndarray
    start: np.ndarray
    each: np.ndarray
    first: np.ndarray
    offset: np.ndarray

    def place(self, size: np.ndarray, rank: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(sequence, offset) of the items of these lengths and ranks among their length."""
        slot = self.base[size] + rank
        at = np.searchsorted(self.start, slot, side="right") - 1
        sequence, turn = np.divmod(slot - self.start[at], self.each[at])
        return self.first[at] + sequence, self.offset[at] + turn * size


def plan(counts: np.ndarray, length: int) -> Slots:
    """Slots for so many items of each length from 0 to ``length``."""
    fixed, left = reduced(counts, length)
    patterns = [({size: chosen.count(size) for size in chosen}, n) for chosen, n in fixed]
    patterns += best_fit(left, length)
    by_size: dict[int, list[tuple[int, int, int, int]]] = defaultdict(list)
    sequence = 0
    for held, n in patterns:
        offset = 0
        for size in sorted(held, reverse=True):
            by_size[size].append((n * held[size], held[size], sequence, offset))
            offset += size * held[size]
        sequence += n
    rows = [row for size in sorted(by_size) for row in by_size[size]]
    slots, each, first, offset = np.array(rows, np.int64).reshape(-1, 4).T
    base = np.r_[0, np.cumsum(counts)][: length + 1]
    return Slots(base, np.r_[0, np.cumsum(slots)][:-1], each, first, offset)


def _cut(tokens: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, piece, tokens) of the pieces of texts of so many tokens."""
    pieces = -(-tokens // length)
    text = np.repeat(np.arange(len(tokens)), pieces)
    piece = np.arange(len(text)) - np.repeat(np.cumsum(pieces) - pieces, pieces)
    return text, piece, np.minimum(tokens[text] - piece * length, length)


def _ranks(sizes: np.ndarray, seen: np.ndarray) -> np.ndarray:
    """Each item's rank among those of its length; ``seen`` counts the earlier ones and is raised."""
    order = np.argsort(sizes, kind="stable")
    ordered = sizes[order]
    begins = np.searchsorted(ordered, ordered)
    ranks = np.empty(len(sizes), np.int64)
    ranks[order] = np.arange(len(sizes)) - begins
    ranks += seen[sizes]
    seen += np.bincount(sizes, minlength=len(seen))
    return ranks


def encoded_pieces(docs: DataFrame, tokenizer: str, length: int, end_id: int, id_col: str, text_col: str) -> DataFrame:
    """(id, piece, start, length, ids, part, rank): ids as little-endian 32-bit numbers, ``rank``
    among the pieces of the length in the input partition ``part``."""

    def encode_part(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seen = TaskContext.get().partitionId(), np.zeros(length + 1, np.int64)
        for some in grouped(batches, 1):
            ids, starts = encode(some.column(1).combine_chunks(), tokenizer, end_id)
            text, piece, sizes = _cut(np.diff(starts), length)
            bounds = np.r_[starts[text] + piece * length, starts[-1]]
            blob = [None, pa.py_buffer((4 * bounds).astype("<i8").tobytes()), pa.py_buffer(ids.astype("<u4", copy=False).tobytes())]
            yield from pa.table(
                {
                    "id": some.column(0).take(pa.array(text)),
                    "piece": pa.array(piece, pa.int32()),
                    "start": pa.array(piece * length),
                    "length": pa.array(sizes),
                    "ids": pa.LargeBinaryArray.from_buffers(pa.large_binary(), len(text), blob).cast(pa.binary()),
                    "part": pa.array(np.full(len(text), part, np.int64)),
                    "rank": pa.array(_ranks(sizes, seen)),
                }
            ).to_batches(max_chunksize=2000)

    kind = docs.schema[id_col].dataType.simpleString()
    return docs.select(named(id_col).alias("id"), named(text_col).cast("string").alias("text")).mapInArrow(
        encode_part, f"id {kind}, piece int, start long, length long, ids binary, part long, rank long"
    )


def _placed(slots: Slots, size: Column, rank: Column) -> Column:
    def place(sizes: pd.Series, ranks: pd.Series) -> pd.DataFrame:
        sequence, offset = slots.place(sizes.to_numpy(), ranks.to_numpy())
        return pd.DataFrame({"sequence_id": sequence, "offset": offset})

    place.__annotations__ = {"sizes": pd.Series, "ranks": pd.Series, "return": pd.DataFrame}
    return F.pandas_udf(place, "sequence_id long, offset long")(size, rank)


def pack(
    docs: DataFrame,
    tokenizer: str,
    length: int = LENGTH,
    end_id: int = END_ID,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Documents in few sequences of at most ``length`` tokens; only longer ones are cut.

    One row per piece: the id, ``piece`` from 0, ``start`` (the document's tokens before it),
    ``length``, ``ids`` (little-endian 32-bit), ``ids_crc32``, ``sequence_id`` from 0 and
    ``offset`` there, without a gap from 0. A null text is empty and has the end id alone. Repeated
    rows and null ids are packed like others; other columns of ``docs`` are not read. No rows give
    no rows. The driver holds a count per length and the patterns, a few times ``length`` rows.
    """
    coded = encoded_pieces(docs, tokenizer, length, end_id, id_col, text_col)
    coded = store(coded.withColumn("ids_crc32", F.crc32("ids")), "pieces")
    totals = store(coded.groupBy("part", "length").agg(F.count("*").alias("n")), "totals")
    counts = np.zeros(length + 1, np.int64)
    for row in totals.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``length`` rows
        counts[row["length"]] = row["n"]
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = totals.select("part", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    placed = coded.join(bases, ["part", "length"])
    place = _placed(plan(counts, length), F.col("length"), F.col("base") + F.col("rank"))
    return placed.withColumn("place", place).select(
        F.col("id").alias(id_col), "piece", "start", "length", "ids", "ids_crc32", "place.sequence_id", "place.offset"
    )

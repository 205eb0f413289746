"""Stretches of words that repeat with a period, and texts without their repetitions.

An online dynamic programme over sparse diagonals: a word that stands ``lag`` words after an
equal one lengthens the match on the diagonal of that lag, and a diagonal whose match ends long
enough is a run there and then. All earlier occurrences of a frequent word would be a square of
the text's length, so a diagonal is entered by groups of k words, k = 1, 2, 4, ..., and at each
k only by the nearest earlier occurrence, for lags above k / 2 and up to k. That loses nothing:
in a run whose smallest period is q <= k, a group of k words that occurs less than q words
earlier would make both distances periods of one stretch of k + q words or more, and so (by Fine
and Wilf) a divisor of q would be a smaller period. A run of four periods or more is then one
unbroken stretch of groups with the lag q, and a stretch on a multiple of q has no such group.
A text of n words costs n log n at most, however often its words repeat; groups that occur once
are not looked at again with more words, which leaves little of ordinary texts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from saleslake.llm.files import give_back_memory
from saleslake.llm.shared import free_name, named

LEAST_WORDS = 6
LEAST_PERIODS = 4
_TEXT_BYTES_AT_ONCE = 4 << 20
_RUN = pa.struct([("start", pa.int64()), ("length", pa.int64()), ("period", pa.int64())])
FOUND = T.StructType(
    [
        T.StructField(
            "runs",
            T.ArrayType(T.StructType([T.StructField(f.name, T.LongType()) for f in _RUN]), False),
        ),
        T.StructField("text", T.StringType()),
    ]
)


def words_of(texts: pa.Array) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The distinct words, the code of every word in turn, and how many words each text has."""
    texts = pc.fill_null(texts, "").cast(pa.large_string())
    for space in "\t\n\x0b\x0c\r":
        texts = pc.replace_substring(texts, space, " ")
    parts = pc.split_pattern(texts, " ")
    sizes = pc.list_value_length(parts).to_numpy(zero_copy_only=False).astype(np.int64)
    coded = parts.flatten().dictionary_encode()
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    empty = pc.index(coded.dictionary, pa.scalar("", coded.dictionary.type)).as_py()
    full = codes != empty
    upto = np.r_[0, np.cumsum(full)]
    ends = np.r_[0, np.cumsum(sizes)]
    return coded.dictionary, codes[full], np.diff(upto[ends])


def _nearest(names: np.ndarray, places: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """How far before each place the same name stands (0: nowhere), and which names repeat.

    ``places`` ascend.
    """
    order = np.argsort(names, kind="stable")
    same = names[order[1:]] == names[order[:-1]]
    lags = np.zeros(len(names), np.int64)
    lags[order[1:][same]] = np.diff(places[order])[same]
    repeated = np.zeros(len(names), bool)
    repeated[order[1:][same]] = True
    repeated[order[:-1][same]] = True
    return lags, repeated


def runs_of(
    codes: np.ndarray, sizes: np.ndarray, least_words: int = LEAST_WORDS, least_periods: int = LEAST_PERIODS
) -> np.ndarray:
    """(first word, length, period) of all runs, by first word and then period.

    ``codes`` are the words of all texts in turn, ``sizes`` the number of words of each; words
    are numbered through all texts.
    """
    if least_periods < 3:
        raise ValueError("runs of fewer than three periods are not found by their nearest groups")
    text = np.repeat(np.arange(len(sizes)), sizes)
    places = np.arange(len(codes))
    names = text * (int(codes.max(initial=0)) + 1) + codes
    at = np.full(len(codes), -1, np.int64)  # the name of the group that begins at a word
    found, k = [], 1
    while len(places):
        lags, repeated = _nearest(names, places)
        # what goes on is not the same diagonal, or not the next word
        breaks = (np.diff(lags, prepend=-1) != 0) | (np.diff(places, prepend=-2) != 1)
        first = np.flatnonzero(breaks)
        matched = np.diff(np.r_[first, len(places)]) + k - 1
        period = lags[first]
        length = matched + period
        long_enough = length >= np.maximum(least_words, least_periods * period)
        kept = (period > k // 2) & (period <= k) & long_enough
        found.append(np.stack([places[first] - period, length, period], axis=1)[kept])
        # groups of twice as many words: two that repeat, one after the other
        at[places] = np.where(repeated, names, -1)
        wide = sizes[text[places]] >= least_periods * (k + 1)
        left = places[repeated & wide]
        left = left[left + k < len(codes)]
        left = left[at[left + k] >= 0]
        _, names_left = np.unique(at[left], return_inverse=True)
        _, names_right = np.unique(at[left + k], return_inverse=True)
        at[places] = -1
        names = names_left.astype(np.int64) * (int(names_right.max(initial=0)) + 1) + names_right
        places, k = left, 2 * k
    runs = np.concatenate(found) if found else np.zeros((0, 3), np.int64)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def _covered(runs: np.ndarray, n: int) -> np.ndarray:
    """Which words some run holds after its first period."""
    change = np.zeros(n + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    return np.cumsum(change)[:n] > 0


def _found(texts: pa.Array, least_words: int, least_periods: int) -> pa.Array:
    words, codes, sizes = words_of(texts)
    runs = runs_of(codes, sizes, least_words, least_periods)
    begins = np.r_[0, np.cumsum(sizes)]
    owner = np.searchsorted(begins, runs[:, 0], side="right") - 1
    of_text = np.r_[0, np.cumsum(np.bincount(owner, minlength=len(sizes)))]
    columns = [runs[:, 0] - begins[owner], runs[:, 1], runs[:, 2]]
    listed = pa.ListArray.from_arrays(
        pa.array(of_text, pa.int32()), pa.StructArray.from_arrays([pa.array(c) for c in columns], fields=list(_RUN))
    )
    kept = ~_covered(runs, len(codes))
    ends = np.r_[0, np.cumsum(kept)][begins]
    left = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), words.take(pa.array(codes[kept])))
    text = pc.binary_join(left, pa.scalar(" ", words.type)).cast(pa.string())
    return pa.StructArray.from_arrays([listed, text], names=["runs", "text"])


def collapsed(
    docs: DataFrame,
    text_col: str = "text",
    least_words: int = LEAST_WORDS,
    least_periods: int = LEAST_PERIODS,
) -> DataFrame:
    """Every row of ``docs`` with a last column ``periods`` (renamed with ``_`` while a column has
    that name): a struct of ``runs``, an array of (start, length, period) in words by start and
    then period, and ``text``, the words that are in no run or in the first period of each of
    theirs, joined by one space.

    A run is a stretch of ``least_words`` words and ``least_periods`` of its smallest period or
    more that no neighbouring word extends. Words are what stands between the six ASCII white
    spaces. A null text counts as empty: no runs and an empty text. Repeated rows and null ids
    are rows like others; no rows give no rows. A text is worked on as a whole, some tens of
    bytes a word, and with others up to a few MB, so a row's result depends on its text alone.
    """
    columns = docs.columns
    name, index = free_name(docs, "periods"), columns.index(text_col)

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part in parts:
            size = part.column(index).nbytes
            step = max(1, int(part.num_rows * _TEXT_BYTES_AT_ONCE / max(size, 1)))
            for at in range(0, part.num_rows, step):
                some = part.slice(at, step)
                found = _found(some.column(index).cast(pa.string()), least_words, least_periods)
                yield pa.RecordBatch.from_arrays([*some.columns, found], names=[*columns, name])
        give_back_memory()

    texts = docs.withColumn(text_col, named(text_col).cast("string"))
    schema = T.StructType([*texts.schema.fields, T.StructField(name, FOUND)])
    # names without dots, which mapInArrow could not read
    return texts.toDF(*(f"c{i}" for i in range(len(columns)))).mapInArrow(batches, schema)

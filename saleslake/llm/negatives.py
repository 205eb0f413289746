"""Hard negatives by a secondary-sort shuffle of pair scores.

The key of a pair is (anchor, descending score, rows of the anchor's label first, id): dealt by
anchor and sorted within each partition in the shuffle itself, an anchor's pairs come to one
iterator in the order in which they count. Positives come before the negatives of their windows,
as a window ends at or below its positive's score, so the iterator opens a window at each
positive and hands every negative to the windows that it lies in; it holds an anchor's open
windows and never its pairs.

The stated anchors meet all rows in blocks. Before the shuffle a block keeps of an anchor's pairs
only those that could be among its first positives, or, in a second round that knows the
positives, among the first negatives of a window. What is shuffled so is a few rows per anchor and
block, whatever label holds most rows; the iterator decides.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.shared import named, store

POSITIVES = 5
NEGATIVES = 3
LOW, HIGH = 50, 95
SCALE = 256
BLOCK_ROWS = 2048
BLOCK_ANCHORS = 2048
# scores times 100 stay within 64 bits
_SCORE_BITS = 55
_EXACT = 1 << 53


def _whole(vector: Column, scale: int) -> Column:
    return F.transform(vector, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")))


def _usable(vector: Column, scale: int) -> Column:
    """A vector with all numbers given, finite, and small enough for scores of 64 bits."""
    most = F.sqrt(F.lit(float(1 << _SCORE_BITS)) / F.greatest(F.size(vector), F.lit(1)))
    fine = lambda x: x.isNotNull() & (F.abs(x.cast("double") * scale) < most - 1)
    return F.coalesce(F.forall(vector, fine), F.lit(False))


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    flat = np.concatenate([np.zeros(0, np.int64), *(c.flatten().to_numpy() for c in column.chunks)])
    return flat.astype(np.int64).reshape(len(column), len(flat) // max(len(column), 1))


def _scores(anchors: np.ndarray, rows: np.ndarray) -> np.ndarray:
    """Inner products, exact: in doubles where none can round."""
    if not anchors.size or not rows.size:
        return np.zeros((len(anchors), len(rows)), np.int64)
    most = int(np.abs(anchors).max()) * int(np.abs(rows).max()) * anchors.shape[1]
    if most < _EXACT:
        return (anchors.astype(np.float64) @ rows.astype(np.float64).T).astype(np.int64)
    return anchors @ rows.T


_PAIR = "anchor long, score long, negative boolean, id long"


def _pairs(anchor: list, score: list, negative: bool, ident: list) -> pa.Table:
    join = lambda parts: np.concatenate(parts) if parts else np.zeros(0, np.int64)
    score = join(score)
    return pa.table(
        {"anchor": join(anchor), "score": score, "negative": np.full(len(score), negative), "id": join(ident)}
    )


def _first_positives(n: int):
    """Of a block, each anchor's first ``n`` other rows of its label."""

    def block(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        labels, codes = np.unique(_labels(rows, anchors), return_inverse=True)
        row_label, anchor_label = codes[: len(rows)], codes[len(rows) :]
        ids, anchor_ids = rows["id"].to_numpy(), anchors["id"].to_numpy()
        vectors, wanted = _matrix(rows["v"]), _matrix(anchors["v"])
        for label in range(len(labels)):
            mine, those = np.flatnonzero(row_label == label), np.flatnonzero(anchor_label == label)
            if not len(mine) or not len(those):
                continue
            scores = _scores(wanted[those], vectors[mine])
            for i, at in enumerate(those):
                other = np.flatnonzero(ids[mine] != anchor_ids[at])
                some = scores[i, other]
                if len(some) > n:  # all that tie with the last one, then the smallest ids
                    near = some >= -np.partition(-some, n - 1)[n - 1]
                    other, some = other[near], some[near]
                best = np.lexsort((ids[mine[other]], -some))[:n]
                out[0].append(np.full(len(best), anchor_ids[at]))
                out[1].append(some[best])
                out[2].append(ids[mine[other[best]]])
        return _pairs(out[0], out[1], False, out[2])

    return block


def _labels(rows: pa.Table, anchors: pa.Table) -> np.ndarray:
    both = pa.chunked_array([*rows["label"].chunks, *anchors["label"].chunks], rows["label"].type)
    return both.combine_chunks().dictionary_encode().indices.to_numpy(zero_copy_only=False)


def _first_negatives(n: int, low: int, high: int):
    """Of a block, the first ``n`` rows of other labels in each window of each anchor."""

    def block(key: tuple, rows: pa.Table, anchors: pa.Table) -> pa.Table:
        out: tuple[list, list, list] = ([], [], [])
        codes = _labels(rows, anchors)
        row_label, anchor_label = codes[: len(rows)], codes[len(rows) :]
        ids, anchor_ids = rows["id"].to_numpy(), anchors["id"].to_numpy()
        windows = anchors["windows"].to_pylist()
        scores = _scores(_matrix(anchors["v"]), _matrix(rows["v"]))
        for i, (ident, own) in enumerate(zip(anchor_ids.tolist(), windows, strict=True)):
            bounds = np.unique(np.array(own, np.int64))
            line = 100 * scores[i]
            inside = (row_label != anchor_label[i]) & (line >= low * bounds.min()) & (line <= high * bounds.max())
            some = np.flatnonzero(inside)
            some = some[np.lexsort((ids[some], -scores[i, some]))]
            line = line[some]
            taken = np.zeros(len(some), bool)
            begins = np.searchsorted(-line, -high * bounds)
            ends = np.searchsorted(-line, -low * bounds, side="right")
            for begin, end in zip(begins, ends, strict=True):
                taken[begin : max(begin, min(end, begin + n))] = True
            some = some[taken]
            out[0].append(np.full(len(some), ident))
            out[1].append(scores[i, some])
            out[2].append(ids[some])
        return _pairs(out[0], out[1], True, out[2])

    return block


def _sorted_pairs(pairs: DataFrame) -> DataFrame:
    """Dealt by anchor and sorted in the same shuffle: each anchor's pairs as they count."""
    dealt = pairs.repartition(F.col("anchor"))
    return dealt.sortWithinPartitions("anchor", F.desc("score"), "negative", "id")


def _streamed(positives: int, negatives: int, low: int, high: int):
    """One pass over sorted pairs, carrying the windows of one anchor from batch to batch."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor, windows, opened = None, [], 0
        for batch in batches:
            out = []
            columns = (batch.column(i).to_pylist() for i in range(4))
            for pair_anchor, score, negative, ident in zip(*columns, strict=True):
                if pair_anchor != anchor:
                    anchor, windows, opened = pair_anchor, [], 0
                if not negative:
                    if opened < positives:
                        opened += 1
                        windows.append([ident, score, 0])
                    continue
                for window in windows:
                    if low * window[1] <= 100 * score <= high * window[1]:
                        window[2] += 1
                        out.append((anchor, window[0], window[2], ident, window[1], score))
                windows = [w for w in windows if w[2] < negatives and 100 * score >= low * w[1]]
            names = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
            kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            parts = list(zip(*out, strict=True)) or [()] * 6
            yield pa.RecordBatch.from_arrays([pa.array(p, k) for p, k in zip(parts, kinds, strict=True)], names=names)

    return stream


def _opened(n: int):
    """The first ``n`` pairs of each anchor, in one pass over sorted pairs."""

    def stream(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, seen = None, 0
        for batch in batches:
            anchors = batch.column(0).to_numpy()
            begins = np.flatnonzero(np.diff(anchors, prepend=anchors[:1] - 1)) if len(anchors) else []
            rank = np.arange(len(anchors)) - np.repeat(begins, np.diff(np.r_[begins, len(anchors)]))
            if len(anchors):
                head = np.arange(len(anchors)) < (begins[1] if len(begins) > 1 else len(anchors))
                before = seen if anchors[0] == last else 0
                rank = rank + np.where(head, before, 0)
                last, seen = anchors[-1], int(rank[-1]) + 1
            yield batch.filter(pa.array(rank < n))

    return stream


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    id_col: str = "vec_id",
    label_col: str = "label",
    vector_col: str = "embedding",
    scale: int = SCALE,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score): for every
    anchor and each of its first ``positives`` other rows of the same label, the first
    ``negatives`` rows of other labels whose score is ``low`` to ``high`` hundredths of the
    positive's.

    A row's score is the inner product with the anchor of vectors whose numbers x became
    floor(scale * x); higher scores come first, then smaller ids. ``is_anchor`` is a condition on
    the column ``id``. Ids are whole numbers. Rows without an id or a label, and vectors that are
    null or hold a null, a non-finite number or one so large that scores pass 64 bits (2 ** 16 in
    size at 64 numbers and a scale of 256), take no part. Of rows that repeat an id the one that is
    least by (label, vector) counts. Vectors meet those of their own length; empty ones score 0.
    Other columns are not read; no rows, or no anchor, give no rows.
    """
    usable = vectors.select(
        named(id_col).cast("long").alias("id"), named(label_col).alias("label"), named(vector_col).alias("v")
    ).where(F.col("id").isNotNull() & F.col("label").isNotNull() & _usable(F.col("v"), scale))
    whole = usable.select("id", F.struct("label", _whole(F.col("v"), scale).alias("v")).alias("row"))
    one = whole.groupBy("id").agg(F.min("row").alias("row")).select("id", "row.label", "row.v")
    rows = store(one.withColumn("dim", F.size("v")), "vectors")
    # columns of its own, as it meets the rows it comes from
    anchors = rows.where(is_anchor).select(*(F.col(c).alias(c) for c in rows.columns))
    blocks = lambda n, size: F.ceil(F.count("*") / size).cast("int").alias(n)
    # one row per length of vector
    of_rows = rows.groupBy("dim").agg(blocks("row_blocks", BLOCK_ROWS))
    of_anchors = anchors.groupBy("dim").agg(blocks("anchor_blocks", BLOCK_ANCHORS))
    sizes = of_rows.join(of_anchors, "dim")
    own = lambda c: F.pmod(F.xxhash64("id"), F.col(c)).cast("int")
    every = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    unit = ["dim", "i", "j"]

    def dealt(frame: DataFrame, i, j) -> DataFrame:
        return frame.join(sizes, "dim").withColumn("i", i("row_blocks")).withColumn("j", j("anchor_blocks")).drop(
            "row_blocks", "anchor_blocks"
        )

    def scored(asked: DataFrame, block) -> DataFrame:
        left, right = dealt(rows, own, every), dealt(asked, every, own)
        return left.groupBy(*unit).cogroup(right.groupBy(*unit)).applyInArrow(block, _PAIR)

    near = _sorted_pairs(scored(anchors, _first_positives(positives)))
    first = store(near.mapInArrow(_opened(positives), _PAIR), "positives")
    windows = first.groupBy("anchor").agg(F.collect_list("score").alias("windows"))
    asked = anchors.join(windows, anchors["id"] == windows["anchor"]).drop("anchor")
    far = scored(asked, _first_negatives(negatives, low, high))
    pairs = _sorted_pairs(first.unionByName(far))
    return pairs.mapInArrow(
        _streamed(positives, negatives, low, high),
        "anchor_id long, positive_id long, rank int, negative_id long, positive_score long, negative_score long",
    )

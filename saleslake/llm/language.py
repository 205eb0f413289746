"""Language identification by the nearest of several centroids per language.

A text is a normalised TF-IDF vector of hashed two- and three-byte n-grams of its letters, in
lower case, with everything else as word breaks. Spherical k-means on a bounded sample of
labelled rows gives the centroids of each language; the language of the centroid with the
largest cosine wins, and a text farther from it than nearly all of that language's sample is
rejected. A text of few n-grams cannot come near to a centroid, its cosine grows with the root of
their number; so below ``FULL_GRAMS`` of them the bound falls by that root.

Only the sample and the centroids are gathered: at most ``SAMPLE_ROWS`` rows and ``CENTROIDS``
vectors per language. Texts are scored where they are read and are not shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from saleslake.llm.files import give_back_memory
from saleslake.llm.shared import free_name, id_remainder, store

DIMENSIONS = 1 << 12
CENTROIDS = 4
SAMPLE_ROWS = 1000  # labelled rows per language that the model is fitted on, at most
ROUNDS = 12
REJECT_QUANTILE, REJECT_SHARE = 0.01, 0.62
REJECT_MOST = 0.45  # a sample of nearly equal texts has a quantile near 1, which says little of others
FULL_GRAMS = 128
UNDECIDED = "und"
_TEXTS_AT_ONCE = 256
_TEXT_BYTES_AT_ONCE = 1 << 20
_BYTES_AT_ONCE = 1 << 18
_SPACE = 32
# letters a-z and the bytes of all letters beyond ASCII stay, the rest are breaks
_LETTERS = np.array([b if 97 <= b <= 122 or b >= 128 else _SPACE for b in range(256)], np.uint8)


def pieces(texts: pa.Array) -> Iterator[pa.Array]:
    """The texts in turn, a bounded number and about a bounded size at a time, one at least."""
    sizes = pc.fill_null(pc.binary_length(texts), 0).to_numpy(zero_copy_only=False)
    upto, at = np.cumsum(sizes, dtype=np.int64), 0
    while at < len(texts):
        before = upto[at] - sizes[at]
        end = int(np.searchsorted(upto, before + _TEXT_BYTES_AT_ONCE, side="right"))
        end = min(max(end, at + 1), at + _TEXTS_AT_ONCE)
        yield texts.slice(at, end - at)
        at = end


def letter_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all texts one after the other, lowered, breaks single, and each text's end."""
    lowered = pc.utf8_lower(pc.fill_null(texts, "")).cast(pa.large_string())
    # marks, signs and digits beyond ASCII are breaks as well
    ascii_only = pc.fill_null(pc.all(pc.string_is_ascii(lowered)), True).as_py()
    if not ascii_only:
        lowered = pc.replace_substring_regex(lowered, r"[^\pL\x00-\x7f]+", " ")
    ends = np.frombuffer(lowered.buffers()[1], np.int64)[lowered.offset : lowered.offset + len(lowered) + 1]
    data = lowered.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[ends[0] : ends[-1]] if data else np.empty(0, np.uint8)
    # one break before each text, so that no n-gram spans two
    out = np.insert(_LETTERS[raw], ends[:-1] - ends[0], _SPACE)
    keep = np.ones(len(out), bool)
    keep[1:] = (out[1:] != _SPACE) | (out[:-1] != _SPACE)
    begins = ends[:-1] - ends[0] + np.arange(len(lowered))
    lasts = np.r_[begins[1:], len(out)] - 1
    keep[begins] = True
    # a break at the end goes: the one that opens the next text closes this one
    keep[lasts[(out[lasts] == _SPACE) & (lasts > begins)]] = False
    upto = np.r_[0, np.cumsum(keep)]
    return out[keep], upto[np.r_[begins[1:], len(out)]]


def gram_counts(texts: pa.Array) -> np.ndarray:
    """Hashed n-gram counts, a row per text."""
    data, ends = letter_bytes(texts)
    starts = np.r_[0, ends[:-1]]
    counts = np.zeros(len(texts) * DIMENSIONS, np.float32)
    wide = np.r_[data, np.uint8(_SPACE), np.uint8(_SPACE)].astype(np.uint32)
    for a in range(0, len(data), _BYTES_AT_ONCE):
        b = min(a + _BYTES_AT_ONCE, len(data))
        x, y, z = wide[a:b], wide[a + 1 : b + 1], wide[a + 2 : b + 2]
        row = np.searchsorted(ends, np.arange(a, b), side="right")
        last = ends[row] - 1
        here = np.arange(a, b)
        two = (x << 8 | y) * np.uint32(2654435761) >> np.uint32(20)
        three = (x << 16 | y << 8 | z) * np.uint32(2246822519) >> np.uint32(20)
        at = row * DIMENSIONS
        inner = here < last
        both = np.concatenate([at + two, (at + three)[inner]])
        low = int(row[0]) * DIMENSIONS
        part = np.bincount(both - low)
        counts[low : low + len(part)] += part
    counts = counts.reshape(len(texts), DIMENSIONS)
    counts[ends - starts <= 1] = 0
    return counts


def unit(rows: np.ndarray) -> np.ndarray:
    norm = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norm, out=np.zeros_like(rows), where=norm > 0)


def vectors(counts: np.ndarray, idf: np.ndarray) -> np.ndarray:
    return unit(np.log1p(counts) * idf)


def k_means(rows: np.ndarray, k: int) -> np.ndarray:
    """Spherical k-means from far apart rows; the same rows in the same order give the same."""
    chosen = [0]
    nearest = rows @ rows[0]
    while len(chosen) < min(k, len(rows)):
        chosen.append(int(np.argmin(nearest)))
        nearest = np.maximum(nearest, rows @ rows[chosen[-1]])
    centroids = rows[chosen]
    for _ in range(ROUNDS):
        own = np.argmax(rows @ centroids.T, axis=1)
        sums = np.stack([rows[own == i].sum(axis=0) for i in range(len(centroids))])
        empty = ~sums.any(axis=1)
        sums[empty] = centroids[empty]
        centroids = unit(sums)
    return centroids


@dataclass(frozen=True)
class Languages:
    """Centroids (a row each), their language, and the cosine below which one rejects a text of
    ``FULL_GRAMS`` or more."""

    idf: np.ndarray
    centroids: np.ndarray
    langs: tuple[str, ...]
    least: np.ndarray

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, cosine and whether it is rejected, of each text."""
        langs: list[str] = []
        scores, rejected = np.zeros(len(texts)), np.ones(len(texts), bool)
        for piece in pieces(texts):
            counts = gram_counts(piece)
            rows = vectors(counts, self.idf)
            some = slice(len(langs), len(langs) + len(rows))
            known = rows.any(axis=1)
            if not self.langs:
                langs += [UNDECIDED] * len(rows)
                continue
            cosines = rows @ self.centroids.T
            best = np.argmax(cosines, axis=1)
            scores[some] = np.clip(np.where(known, cosines[np.arange(len(rows)), best], 0), 0, 1)
            least = self.least[best] * np.sqrt(np.minimum(counts.sum(axis=1) / FULL_GRAMS, 1))
            rejected[some] = ~known | (scores[some] < least)
            langs += [self.langs[b] if k else UNDECIDED for b, k in zip(best, known, strict=True)]
        return langs, scores, rejected


def labelled_sample(docs: DataFrame, id_col: str, text_col: str, lang_col: str) -> DataFrame:
    """(lang, text, rank) of at most ``SAMPLE_ROWS`` rows per language: those of smallest hash."""
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).rlike(r"\p{L}"))
    keyed = rows.select(
        F.col(lang_col).cast("string").alias("lang"), F.xxhash64(F.col(id_col), F.col(text_col)).alias("rank")
    )
    # of a language with more rows, those of small hash, about four times as many as wanted, are
    # ranked; so no task gets more, however many partitions there are
    sizes = F.broadcast(keyed.groupBy("lang").agg(F.count("*").alias("rows")))
    share = F.col("rank") / F.lit(2.0**64) + 0.5
    low = keyed.join(sizes, "lang").where(share * F.col("rows") <= 4 * SAMPLE_ROWS)
    order = Window.partitionBy("lang").orderBy("rank")
    chosen = low.withColumn("n", F.row_number().over(order)).where(F.col("n") <= SAMPLE_ROWS)
    chosen = chosen.select(F.col("lang").alias("l"), F.col("rank").alias("r")).distinct()
    texts = rows.select(
        F.col(lang_col).cast("string").alias("lang"),
        F.col(text_col).alias("text"),
        F.xxhash64(F.col(id_col), F.col(text_col)).alias("rank"),
    )
    found = texts.join(F.broadcast(chosen), (F.col("lang") == F.col("l")) & (F.col("rank") == F.col("r")))
    return found.select("lang", "text", "rank").dropDuplicates(["lang", "rank"])


def fit(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> Languages:
    """Centroids of the languages of ``docs``, from a bounded sample of its labelled rows."""
    sample = labelled_sample(docs, id_col, text_col, lang_col)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, _TEXTS_AT_ONCE):
                part = batch.slice(at, _TEXTS_AT_ONCE)
                rows = gram_counts(part.column(1))
                yield pa.record_batch(
                    {
                        "lang": part.column(0),
                        "rank": part.column(2),
                        "grams": pa.array([r.astype("<f4").tobytes() for r in rows], pa.binary()),
                    }
                )

    counted = store(sample.mapInArrow(count, "lang string, rank long, grams binary"), "grams")

    def present(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen, n = np.zeros(DIMENSIONS, np.int64), 0
        for batch in batches:
            for grams in batch.column(0):
                seen += np.frombuffer(grams.as_py(), "<f4") > 0
                n += 1
        yield pa.record_batch({"n": [n], "seen": pa.array([seen.tolist()], pa.list_(pa.int64()))})

    parts = counted.select("grams").repartition(8).mapInArrow(present, "n long, seen array<long>").collect()
    n = sum(r.n for r in parts)
    seen = np.sum([r.seen for r in parts], axis=0) if parts else np.zeros(DIMENSIONS)
    idf = (np.log((1 + n) / (1 + seen)) + 1).astype(np.float32)

    def cluster(key: tuple, frame: pd.DataFrame) -> pd.DataFrame:
        frame = frame.sort_values(["rank", "grams"])
        rows = vectors(np.stack([np.frombuffer(g, "<f4") for g in frame["grams"]]), idf)
        centroids = k_means(rows, CENTROIDS)
        near = np.max(rows @ centroids.T, axis=1)
        least = min(REJECT_SHARE * float(np.quantile(near, REJECT_QUANTILE)), REJECT_MOST)
        packed = [c.astype("<f4").tobytes() for c in centroids]
        return pd.DataFrame({"lang": key[0], "i": range(len(packed)), "c": packed, "least": least})

    found = counted.groupBy("lang").applyInPandas(cluster, "lang string, i int, c binary, least double")
    found = sorted(found.collect(), key=lambda r: (r.lang, r.i))
    centroids = [np.frombuffer(r.c, "<f4") for r in found]
    return Languages(
        idf,
        np.stack(centroids) if centroids else np.zeros((0, DIMENSIONS), np.float32),
        tuple(r.lang for r in found),
        np.array([r.least for r in found]),
    )


def predicted(text: Column, model: Languages) -> Column:
    """Struct (lang_pred, score, rejected) of a text.

    A null text, a text without a letter, and any text when nothing was learned, are ``und``
    with score 0 and rejected.
    """

    def batches(texts: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in texts:
            langs, scores, rejected = model.predict(batch)
            columns = [pa.array(langs, pa.string()), pa.array(scores), pa.array(rejected)]
            yield pa.StructArray.from_arrays(columns, names=["lang_pred", "score", "rejected"])
        give_back_memory()

    batches.__annotations__ = {"texts": Iterator[pa.Array], "return": Iterator[pa.Array]}
    return F.arrow_udf(batches, "lang_pred string, score double, rejected boolean")(text)


def identified(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 3
) -> DataFrame:
    """Every row of ``docs`` with a last column ``language``: a struct of lang_pred, score,
    rejected and held_out (renamed with ``_`` while a column has that name).

    The model learns from rows with a language whose crc32(id) modulo ``folds`` is not 1; the
    language is no input of a prediction. Rows with equal texts get equal predictions; null ids
    are hashed as empty texts; no rows give no rows.
    """
    held_out = id_remainder(id_col, folds) == 1
    model = fit(docs.where(~held_out), id_col, text_col, lang_col)
    name = free_name(docs, "language")
    return docs.withColumn(name, predicted(F.col(text_col).cast("string"), model)).withColumn(
        name, F.col(name).withField("held_out", held_out)
    )

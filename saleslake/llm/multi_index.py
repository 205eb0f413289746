"""Near-duplicate embeddings by an inverted multi-index.

Unit vectors are cut in two halves with a codebook each; a vector's cell is its pair of nearest
codewords, and the product of the codebooks is the grid. A vector visits the cells of its label
in the order in which a neighbour could lie there: by how far it would have to move to cross into
them, summed over the halves. It stops at the distance that the wanted recall of neighbours just
at the threshold needs, measured on a bounded sample. What shares a visited cell is verified by
cosine in double precision.

Equal vectors of a label are one row with a weight. A cell's members and visitors are dealt into
blocks, which meet block by block, so that a crowded cell is many small tasks. A pair that finds
each other both ways is counted in the smaller cell alone. A block gives sums and a spanning
forest of its links, never its pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from saleslake.llm.components import connected_components, spanning_links
from saleslake.llm.files import give_back_memory
from saleslake.llm.shared import store

CELL_ROWS = 256  # rows per cell that the codebooks may be refined to
VISITS = 16  # cells that a vector visits on average, at most: what is shuffled grows with the rows
MAX_CODEWORDS = 1024  # of a half: about 20 sampled vectors each; beyond, cells grow and blocks share them
SAMPLE_ROWS = 20_000  # vectors that codebooks and stopping distance are fitted on, at most
SAMPLE_VALUES = 4_000_000
RECALL = 0.9995
BLOCK_ROWS = 1024
ROUNDS = 10
_AT_ONCE = 2048


def _unit(rows: np.ndarray) -> np.ndarray:
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)  # so that no square overflows
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


def _codebook(rows: np.ndarray, k: int, rng: np.random.Generator) -> np.ndarray:
    words = rows[np.sort(rng.choice(len(rows), min(k, len(rows)), replace=False))]
    for _ in range(ROUNDS):
        parts = [rows[at : at + _AT_ONCE] for at in range(0, len(rows), _AT_ONCE)]
        near = np.concatenate([np.argmin((words**2).sum(axis=1) - 2 * part @ words.T, axis=1) for part in parts])
        sums = np.zeros_like(words)
        np.add.at(sums, near, rows)
        n = np.bincount(near, minlength=len(words))[:, None]
        words = np.where(n > 0, sums / np.maximum(n, 1), words)
    return words


def _between(words: np.ndarray) -> np.ndarray:
    """Distances of all codewords from each other."""
    squares = (words**2).sum(axis=1)
    apart = np.sqrt(np.maximum(squares[:, None] + squares[None] - 2 * words @ words.T, 0))
    np.fill_diagonal(apart, 0)
    return apart


@dataclass(frozen=True)
class Grid:
    """Codebooks of the halves, and the squared way at which a traversal stops."""

    first: np.ndarray
    second: np.ndarray
    stop: float = 0.0

    def _ways(self, rows: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest codeword, and the squared way into the cell of each codeword."""
        far = (words**2).sum(axis=1) - 2 * rows @ words.T
        near = np.argmin(far, axis=1)
        between = _between(words)[near]
        lead = far - far[np.arange(len(rows)), near][:, None]
        return near, np.divide(lead, 2 * between, out=np.zeros_like(lead), where=between > 0) ** 2

    def ways(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        half = rows.shape[1] // 2
        near1, way1 = self._ways(rows[:, :half], self.first)
        near2, way2 = self._ways(rows[:, half:], self.second)
        return near1 * len(self.second) + near2, way1, way2

    def visits(self, rows: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
        """Own cell, and the cells visited, nearest first (the own one among the first)."""
        home, way1, way2 = self.ways(rows)
        out = []
        for a, b in zip(way1, way2, strict=True):
            # codewords beyond the stop are in no visited pair
            one, two = np.flatnonzero(a <= self.stop), np.flatnonzero(b <= self.stop)
            pair = a[one][:, None] + b[two][None]
            x, y = np.nonzero(pair <= self.stop)
            order = np.argsort(pair[x, y], kind="stable")
            out.append((one[x] * len(self.second) + two[y])[order].astype(np.int32))
        return home, out


def fit(rows: np.ndarray, k: int, threshold: float, recall: float = RECALL) -> Grid:
    """Codebooks of ``k`` words, and the stop at which a share ``recall`` of neighbours, at just
    the threshold in every direction alike, lies in a visited cell."""
    rng = np.random.default_rng(1)
    half = rows.shape[1] // 2
    grid = Grid(_codebook(rows[:, :half], k, rng), _codebook(rows[:, half:], k, rng))
    moved = rng.standard_normal(rows.shape)
    moved -= (moved * rows).sum(axis=1, keepdims=True) * rows
    length = np.linalg.norm(moved, axis=1, keepdims=True)
    moved = np.divide(moved, length, out=np.zeros_like(moved), where=length > 0)
    near = threshold * rows + math.sqrt(1 - threshold**2) * moved
    need = []
    for at in range(0, len(rows), _AT_ONCE):
        some = slice(at, at + _AT_ONCE)
        target, _, _ = grid.ways(near[some])
        _, way1, way2 = grid.ways(rows[some])
        i = np.arange(len(target))
        need.append(way1[i, target // len(grid.second)] + way2[i, target % len(grid.second)])
    return Grid(grid.first, grid.second, float(np.quantile(np.concatenate(need), recall)))


def refined(rows: np.ndarray, k: int, threshold: float) -> Grid:
    """The finest grid of up to ``k`` words a half whose traversal visits few cells.

    Its recall is that of any other: a coarser grid has larger cells, of which as many rows or
    a few more are verified, but fewer copies of a vector travel.
    """
    few = rows[:: max(1, len(rows) // 256)]
    words = min(k, 4)
    grid = fit(rows, words, threshold)
    while words < k:
        words = min(k, words * 3 // 2)
        finer = fit(rows, words, threshold)
        if np.mean([len(cells) for cells in finer.visits(few)[1]]) > VISITS:
            break
        grid = finer
    return grid


def _usable(vector: Column) -> Column:
    good = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce(good & F.exists(vector, lambda x: x != 0), F.lit(False))


def _vectors(column: pa.Array, dim: int) -> np.ndarray:
    return _unit(column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim))


def _placed(classes: DataFrame, grids: dict[int, Grid], kind: str) -> DataFrame:
    """The classes with their cell and the cells that they visit."""

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            dims = whole.column("dim").to_numpy()
            for dim in np.unique(dims).tolist():
                own = whole.filter(pa.array(dims == dim))
                for at in range(0, own.num_rows, _AT_ONCE):
                    batch = own.slice(at, _AT_ONCE)
                    home, visits = grids[dim].visits(_vectors(batch.column("v"), dim))
                    columns = {c: batch.column(c) for c in ("node", "label", "dim", "v", "w")}
                    yield pa.record_batch(
                        columns
                        | {"home": pa.array(home.astype(np.int32)), "visits": pa.array(visits, pa.list_(pa.int32()))}
                    )
        give_back_memory()

    schema = f"node long, {kind}, home int, visits array<int>"
    return classes.select("node", "label", "dim", "v", "w").mapInArrow(place, schema)


def _verify(threshold: float):
    def verify(key: tuple, table: pa.Table) -> pa.Table:
        cell, dim = key[2].as_py(), key[1].as_py()
        member = table.column("member").to_numpy()
        nothing = pa.table({n: pa.array([], pa.int64()) for n in ("node", "n", "root")})
        if member.all() or not member.any():
            return nothing
        y, x = table.filter(pa.array(member)), table.filter(pa.array(~member))
        rows = lambda t: _vectors(t.column("v").combine_chunks(), dim)
        i, j = np.nonzero(rows(x) @ rows(y).T >= threshold)
        xs, ys = (t.column("node").to_numpy() for t in (x, y))
        home = x.column("home").to_numpy()[i]
        same = home == cell
        keep = ~same | (xs[i] != ys[j])
        # the pair is found in the visitor's home too, if this member visits that
        lengths = y.column("visits").combine_chunks().value_lengths().to_numpy()
        visited = y.column("visits").combine_chunks().flatten().to_numpy().astype(np.int64)
        base = 1 << 32
        codes = np.repeat(np.arange(len(ys)), lengths) * base + visited
        keep &= same | (home > cell) | ~np.isin(j * base + home, codes)
        i, j, same = i[keep], j[keep], same[keep]
        if not len(i):
            return nothing
        wx, wy = (t.column("w").to_numpy() for t in (x, y))
        n = np.r_[np.bincount(i, wy[j], len(xs)), np.bincount(j[~same], wx[i[~same]], len(ys))]
        nodes = np.r_[xs, ys]
        a, root = spanning_links(xs[i], ys[j])
        some = n > 0
        give_back_memory()
        return pa.table(
            {
                "node": np.r_[nodes[some], a],
                "n": np.r_[n[some].astype(np.int64), np.zeros(len(a), np.int64)],
                "root": np.r_[nodes[some], root],
            }
        )

    return verify


def near_vectors(
    vectors: DataFrame,
    threshold: float = 0.93,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
) -> DataFrame:
    """(id, n_links, component_id, kept) of every row of ``vectors``.

    Rows of equal label whose vectors have a cosine of ``threshold`` or more are linked.
    ``n_links`` counts the other rows linked directly; the component is the smallest id reachable,
    and the row of that id is kept. Rows without a label, vectors that are null, empty, zero or
    hold a null or a non-finite number, and vectors of different lengths, link with nothing.
    Repeated rows are rows of their own. Null ids are counted, but no component unless a group has
    no other. No rows give no rows.
    """
    ok = F.col("label").isNotNull() & _usable(F.col("v"))
    dim = F.when(ok, F.size("v")).otherwise(0)
    rows = vectors.select(
        F.col(id_col).alias("id"), F.col(label_col).alias("label"), F.col(vector_col).alias("v")
    ).withColumn("dim", dim)
    node = F.xxhash64("label", "dim", "v").alias("node")
    usable = rows.where("dim > 0")
    classes = usable.groupBy("label", "dim", "v").agg(F.min("id").alias("least"), F.count("*").alias("w"))
    classes = store(classes.withColumn("node", node), "classes")

    grids: dict[int, Grid] = {}
    for d, n in classes.groupBy("dim").count().collect():
        limit = max(2, min(SAMPLE_ROWS, SAMPLE_VALUES // d))
        sample = classes.where(F.col("dim") == d).orderBy("node").limit(limit).select("v").toPandas()["v"]
        k = max(1, min(MAX_CODEWORDS, round(math.sqrt(n / CELL_ROWS))))
        grids[d] = refined(_unit(np.stack(sample.to_list()).astype(np.float64)), k, threshold)

    kinds = {f.name: f.dataType.simpleString() for f in classes.schema}
    placed = store(_placed(classes, grids, f"label {kinds['label']}, dim int, v {kinds['v']}, w long"), "placed")
    cell = ["label", "dim", "cell"]
    members = placed.withColumn("cell", F.col("home"))
    visitors = placed.withColumn("cell", F.explode("visits")).withColumn("visits", F.array().cast("array<int>"))
    sizes = members.groupBy(*cell).agg(F.count("*").alias("m")).join(
        visitors.groupBy(*cell).agg(F.count("*").alias("q")), cell
    )
    blocks = lambda c: F.ceil(F.col(c) / BLOCK_ROWS).cast("int")
    sizes = sizes.select(*cell, blocks("m").alias("mb"), blocks("q").alias("qb"))
    own = lambda c: F.pmod(F.xxhash64("node"), F.col(c)).cast("int")
    other = lambda c: F.explode(F.sequence(F.lit(0), F.col(c) - 1))
    fields = [*cell, "node", "v", "w", "home", "visits"]
    dealt = (
        members.join(sizes, cell).select(*fields, own("mb").alias("i"), other("qb").alias("j"), F.lit(True).alias("member"))
    ).unionByName(
        visitors.join(sizes, cell).select(*fields, other("mb").alias("i"), own("qb").alias("j"), F.lit(False).alias("member"))
    )
    found = dealt.groupBy(*cell, "i", "j").applyInArrow(_verify(threshold), "node long, n long, root long")
    found = store(found, "found")

    counts = found.groupBy("node").agg(F.sum("n").alias("n"))
    groups = connected_components(found.select("node", "root"), "node", "root")
    named = store(classes.select("node", "least", "w").join(groups, "node", "left"), "named")
    named = named.withColumn("component", F.coalesce("component", "node"))
    least = named.groupBy("component").agg(F.min("least").alias("component_id"))
    facts = named.join(least, "component").join(counts, "node", "left")
    facts = facts.select("node", "component_id", (F.coalesce("n", F.lit(0)) + F.col("w") - 1).alias("n_links"))
    linked = usable.select("id", node).join(facts, "node").select("id", "n_links", "component_id")
    alone = rows.where("dim = 0").select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return linked.unionByName(alone).select(
        F.col("id").alias(id_col), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )

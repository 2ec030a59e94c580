"""Exact and approximate vector search over catalogue cells.

The catalogue is cut into cells around centroids, each with the least cosine of a
member to its centroid. By the triangle inequality of angles a query cannot be
closer to a member than ``angle(query, centroid) - angle(centroid, farthest member)``,
so that whole cells are left out by one number.

* Centroids are fitted by a few Lloyd rounds on at most ``FIT_ROWS`` vectors, the
  ones of smallest hash; every vector of the catalogue gets a cell. The fit moves
  borders only, never results of the exact search.
* Neighbouring cells share a shelf, so that a query is sent once for many cells.
  Shelves larger than ``BLOCK_ROWS`` are dealt into blocks, and the queries of a shelf
  into turns of ``BLOCK_QUERIES``; a block and a turn meet in one task as two
  matrices. Queries and catalogue both stay partitioned, whatever their sizes.
* Exact search runs in two passes with a running top k: the shelves nearest to a query
  give its k-th best similarity so far, and the other shelves are visited only where
  the bound of one of their cells is above it, and give only what is not below it.
* The approximate search visits ``probes`` cells and ranks their members exactly.
  New vectors join the cells of their nearest centroids (``place``); only the cells'
  farthest members and sizes are counted again.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from stockwise.session import cut_lineage

FIT_ROWS, MAX_CELLS, FIT_ROUNDS = 20_000, 1_024, 8
BLOCK_ROWS, BLOCK_QUERIES = 32_768, 32_768
AT_ONCE, PAIRS = 1_024, 1_000_000       # rows sent on, and similarities held, at a time
SLACK = 1e-9                    # rounding of bounds and of matrix products
HITS = "q long, qid long, sku string, similarity double"


@dataclass
class Cells:
    """Unit centroids with each cell's least member cosine and size."""

    centres: np.ndarray
    nearest: np.ndarray
    sizes: np.ndarray

    def bounds(self, unit: np.ndarray) -> np.ndarray:
        """For each query row and cell, what a member's similarity can at most be."""
        apart = np.arccos(np.clip(unit @ self.centres.T, -1.0, 1.0)) - np.arccos(np.clip(self.nearest, -1.0, 1.0))
        return np.where(self.sizes > 0, np.cos(np.maximum(apart, 0.0)) + SLACK, -2.0)


@dataclass
class Shelves:
    """Each cell's shelf, and the number of members of each shelf."""

    shelf: np.ndarray
    sizes: np.ndarray

    @property
    def blocks(self) -> np.ndarray:
        return np.maximum(1, -(-self.sizes // BLOCK_ROWS))

    def of(self, mask: np.ndarray) -> np.ndarray:
        """Rows by cells to rows by shelves: whether any cell of the shelf is set."""
        member = np.zeros((len(self.shelf), len(self.sizes)), np.float32)
        member[np.arange(len(self.shelf)), self.shelf] = 1
        return mask.astype(np.float32) @ member > 0


def single(cells: Cells) -> Shelves:
    """A shelf for each cell."""
    return Shelves(np.arange(len(cells.sizes)), cells.sizes)


def shared(cells: Cells) -> Shelves:
    """Cells chained to their nearest neighbours, and the chain cut into shelves of
    about a block, smaller ones where the catalogue is small."""
    room = min(BLOCK_ROWS, max(BLOCK_ROWS // 8, int(cells.sizes.sum()) // 16))
    left, at = np.ones(len(cells.sizes), bool), 0
    shelf, sizes = np.zeros(len(cells.sizes), np.int64), [0]
    while True:
        if sizes[-1] and sizes[-1] + cells.sizes[at] > room:
            sizes.append(0)
        shelf[at], left[at] = len(sizes) - 1, False
        sizes[-1] += int(cells.sizes[at])
        if not left.any():
            return Shelves(shelf, np.array(sizes))
        at = int(np.where(left, cells.centres @ cells.centres[at], -2.0).argmax())


def vectors(df: DataFrame, vec_col: str, *keep: str) -> DataFrame:
    """Rows with a vector of some length, as doubles in ``vec`` with its ``norm``."""
    v = F.transform(vec_col, lambda x: x.cast("double"))
    out = df.where(F.col(vec_col).isNotNull()).select(*keep, v.alias("vec"))
    return out.withColumn("norm", F.sqrt(F.aggregate("vec", F.lit(0.0), lambda a, x: a + x * x))).where("norm > 0")


def _matrix(rows: pa.RecordBatch | pa.Table) -> tuple[np.ndarray, np.ndarray]:
    vec = rows.column("vec")
    vec = vec.combine_chunks() if isinstance(vec, pa.ChunkedArray) else vec
    return np.asarray(vec.flatten()).reshape(rows.num_rows, -1), np.asarray(rows.column("norm"))


def _unit(rows: pa.RecordBatch | pa.Table) -> np.ndarray:
    vec, norm = _matrix(rows)
    return vec / norm[:, None]


def _slices(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo in range(0, batch.num_rows, AT_ONCE):
            yield batch.slice(lo, AT_ONCE)


def _with(batch: pa.RecordBatch, **columns: pa.Array) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([*batch.columns, *columns.values()], [*batch.schema.names, *columns])


def _nearest(unit: np.ndarray, centres: np.ndarray) -> np.ndarray:
    """Each row's nearest centroid, some rows at a time: the driver holds no row's
    similarities for long."""
    return np.concatenate([(unit[lo:lo + AT_ONCE] @ centres.T).argmax(axis=1) for lo in range(0, len(unit), AT_ONCE)])


def fit_centres(catalogue: DataFrame, cells: int | None = None) -> np.ndarray:
    """Unit centroids, about the square root of the catalogue's size in number."""
    sample = catalogue.orderBy(F.xxhash64("sku"), "sku").limit(FIT_ROWS).select("vec", "norm").toArrow()
    if not sample.num_rows:
        return np.zeros((0, 0))
    unit = _unit(sample)
    cells = cells or int(min(MAX_CELLS, max(1, np.sqrt(catalogue.count()))))
    centres = unit[np.linspace(0, len(unit) - 1, min(cells, len(unit))).astype(int)].copy()
    for _ in range(FIT_ROUNDS):
        home = _nearest(unit, centres)
        total = np.zeros_like(centres)
        np.add.at(total, home, unit)
        size = np.linalg.norm(total, axis=1)
        centres = np.where(size[:, None] > 0, total / np.maximum(size, 1e-300)[:, None], centres)
    return centres


def place(catalogue: DataFrame, centres: np.ndarray) -> DataFrame:
    """(sku, vec, norm, cell, cosine): each vector in the cell of its nearest centroid."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            cosines = _unit(batch) @ centres.T
            cell = cosines.argmax(axis=1)
            yield _with(batch, cell=pa.array(cell.astype(np.int32)), cosine=pa.array(cosines[np.arange(len(cell)), cell]))

    return catalogue.select("sku", "vec", "norm").mapInArrow(run, "sku string, vec array<double>, norm double, cell int, cosine double")


def summarise(placed: DataFrame, centres: np.ndarray) -> Cells:
    """Each cell's least cosine and size: one row a cell comes to the driver."""
    nearest, sizes = np.ones(len(centres)), np.zeros(len(centres), np.int64)
    for r in placed.groupBy("cell").agg(F.min("cosine").alias("least"), F.count(F.lit(1)).alias("n")).collect():
        nearest[r.cell], sizes[r.cell] = r.least - SLACK, r.n
    return Cells(centres, nearest, sizes)


def build(product: DataFrame, cells: int | None = None, vec_col: str = "embedding") -> tuple[DataFrame, Cells]:
    """The catalogue in its cells, and their summary."""
    catalogue = vectors(product, vec_col, "sku")
    centres = fit_centres(catalogue, cells)
    placed = place(catalogue, centres)
    return placed, summarise(placed, centres)


def _first_cells(bounds: np.ndarray, sizes: np.ndarray, k: int, floor: np.ndarray) -> np.ndarray:
    """The cells of highest bound that together hold k members, as a mask."""
    order = np.argsort(-bounds, axis=1, kind="stable")
    before = np.cumsum(sizes[order], axis=1) - sizes[order]
    mask = np.zeros(bounds.shape, bool)
    np.put_along_axis(mask, order, before < k, axis=1)
    return mask & (bounds > floor[:, None])


ROUTES = "q long, qid long, vec array<double>, norm double, floor double, shelf int, block int"


def _routes(queries: DataFrame, shelves: Shelves, threshold: float, choose) -> DataFrame:
    """Each query once for each block of each shelf that ``choose`` takes, with the
    similarity below which its hits are of no use: ``kth``, where there is one."""
    blocks = shelves.blocks
    asked = queries if "kth" in queries.columns else queries.withColumn("kth", F.lit(None).cast("double"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches):
            kth = np.array(batch.column("kth").to_pylist(), float)
            floor = np.where(np.isnan(kth), threshold, np.maximum(kth, threshold))
            row, shelf = np.nonzero(choose(_unit(batch), floor))
            times = blocks[shelf]
            row, shelf = np.repeat(row, times), np.repeat(shelf, times)
            block = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            sent = _with(batch.select(["q", "qid", "vec", "norm"]), floor=pa.array(floor))
            for lo in range(0, len(row), AT_ONCE):
                part = slice(lo, lo + AT_ONCE)
                yield _with(sent.take(pa.array(row[part])), shelf=pa.array(shelf[part].astype(np.int32)), block=pa.array(block[part].astype(np.int32)))

    return asked.select("q", "qid", "vec", "norm", "kth").mapInArrow(run, ROUTES)


def _block_hits(k: int, threshold: float):
    def run(asked: pa.Table, members: pa.Table) -> pa.Table:
        found: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        if asked.num_rows and members.num_rows:
            (a, an), (b, bn) = _matrix(asked), _matrix(members)
            least = np.asarray(asked.column("floor"))
            place = np.zeros(len(b), np.int64)
            place[np.argsort(np.asarray(members.column("sku").to_pylist(), dtype=str), kind="stable")] = np.arange(len(b))
            step = max(1, PAIRS // len(b))
            for lo in range(0, len(a), step):
                near = (a[lo:lo + step] @ b.T) / (an[lo:lo + step, None] * bn)
                floor = least[lo:lo + step]
                if near.shape[1] > k:
                    floor = np.maximum(floor, np.partition(near, -k, axis=1)[:, -k])
                i, j = np.nonzero(near > floor[:, None] - SLACK)
                # row by row, so that a pair's value does not depend on its block
                value = np.concatenate([(a[lo + i[x:x + AT_ONCE]] * b[j[x:x + AT_ONCE]]).sum(axis=1) for x in range(0, len(i), AT_ONCE)] or [np.zeros(0)])
                value = value / (an[lo + i] * bn[j])
                ok = (value > threshold) & (value >= least[lo + i])
                i, j, value = i[ok], j[ok], value[ok]
                order = np.lexsort((place[j], -value, i))
                i, j, value = i[order], j[order], value[order]
                rank = np.arange(len(i)) - np.searchsorted(i, i)
                top = rank < k
                found.append((lo + i[top], j[top], value[top]))
        i, j, value = (np.concatenate(x) if found else np.zeros(0, np.int64) for x in (zip(*found) if found else ((), (), ())))
        at = pa.array(i.astype(np.int64))
        return pa.table({"q": asked.column("q").take(at), "qid": asked.column("qid").take(at),
                         "sku": members.column("sku").take(pa.array(j.astype(np.int64))), "similarity": pa.array(value.astype(float))})
    return run


def _meet(routes: DataFrame, placed: DataFrame, shelves: Shelves, k: int, threshold: float) -> DataFrame:
    """Top k hits of every query in every block it was sent to."""
    asked = np.zeros(len(shelves.sizes), np.int64)
    for r in routes.where("block = 0").groupBy("shelf").count().collect():      # one row a shelf
        asked[r["shelf"]] = r["count"]
    turns, blocks, shelf_of = np.maximum(1, -(-asked // BLOCK_QUERIES)), shelves.blocks, shelves.shelf
    wanted = asked > 0

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            turn = np.asarray(batch.column("q")).astype(np.int64) % turns[np.asarray(batch.column("shelf"))]
            yield _with(batch, turn=pa.array(turn.astype(np.int32)))

    def repeat(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dealt = 0
        for batch in _slices(batches):
            shelf = shelf_of[np.asarray(batch.column("cell"))]
            block = (np.arange(len(shelf)) + dealt) % blocks[shelf]
            dealt += len(shelf)
            times = np.where(wanted[shelf], turns[shelf], 0)
            row = np.repeat(np.arange(len(shelf)), times)
            turn = np.arange(len(row)) - np.repeat(np.cumsum(times) - times, times)
            sent = batch.select(["sku", "vec", "norm"])
            for lo in range(0, len(row), AT_ONCE):
                at, its = row[lo:lo + AT_ONCE], turn[lo:lo + AT_ONCE]
                yield _with(sent.take(pa.array(at)), shelf=pa.array(shelf[at].astype(np.int32)), block=pa.array(block[at].astype(np.int32)), turn=pa.array(its.astype(np.int32)))

    key = ["shelf", "block", "turn"]
    left = routes.mapInArrow(deal, f"{ROUTES}, turn int")
    right = placed.mapInArrow(repeat, "sku string, vec array<double>, norm double, shelf int, block int, turn int")
    return left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(_block_hits(k, threshold), HITS)


def _ranked(hits: DataFrame, k: int) -> DataFrame:
    w = Window.partitionBy("q").orderBy(F.col("similarity").desc(), "sku")
    return hits.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)


def _keyed(queries: DataFrame, vec_col: str) -> DataFrame:
    """Queries once each by id and vector, under a key of both."""
    q = vectors(queries, vec_col, "qid").withColumn("q", F.xxhash64("qid", "vec"))
    return q.dropDuplicates(["q"])


def _shown(ranked: DataFrame) -> DataFrame:
    return ranked.select("qid", "sku", F.round(F.least(F.greatest("similarity", F.lit(0.0)), F.lit(1.0)), 6).alias("similarity"), "rank")


def exact_top_k(queries: DataFrame, placed: DataFrame, cells: Cells, k: int, threshold: float, vec_col: str = "vec") -> DataFrame:
    """(qid, sku, similarity, rank): the k most similar members above ``threshold``."""
    q = _keyed(queries, vec_col)
    if not len(cells.centres):
        return _shown(_ranked(q.limit(0).select("q", "qid", F.lit("").alias("sku"), F.lit(0.0).alias("similarity")), k))

    shelves = shared(cells)

    def first(unit: np.ndarray, floor: np.ndarray) -> np.ndarray:
        return shelves.of(_first_cells(cells.bounds(unit), cells.sizes, k, np.full(len(unit), threshold)))

    def others(unit: np.ndarray, floor: np.ndarray) -> np.ndarray:
        return shelves.of(cells.bounds(unit) > floor[:, None]) & ~first(unit, floor)

    begun = cut_lineage(_ranked(_meet(_routes(q, shelves, threshold, first), placed, shelves, k, threshold), k))
    kth = begun.where(F.col("rank") == k).select("q", F.col("similarity").alias("kth"))
    rest = _meet(_routes(q.join(kth, "q", "left"), shelves, threshold, others), placed, shelves, k, threshold)
    return _shown(_ranked(begun.drop("rank").unionByName(rest), k))


def probed_top_k(queries: DataFrame, placed: DataFrame, cells: Cells, k: int, threshold: float, probes: int, vec_col: str = "vec") -> DataFrame:
    """As ``exact_top_k``, but from the ``probes`` cells nearest to a query only."""
    q = _keyed(queries, vec_col)
    if not len(cells.centres):
        return _shown(_ranked(q.limit(0).select("q", "qid", F.lit("").alias("sku"), F.lit(0.0).alias("similarity")), k))

    shelves = single(cells)

    def nearest(unit: np.ndarray, floor: np.ndarray) -> np.ndarray:
        near = np.where(cells.sizes > 0, unit @ cells.centres.T, -2.0)
        mask = np.zeros(near.shape, bool)
        np.put_along_axis(mask, np.argsort(-near, axis=1, kind="stable")[:, :probes], True, axis=1)
        return mask & (cells.bounds(unit) > threshold)

    return _shown(_ranked(_meet(_routes(q, shelves, threshold, nearest), placed, shelves, k, threshold), k))

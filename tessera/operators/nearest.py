"""Exact cosine top-k for any number of queries: blocks of the index are left out where the triangle inequality rules them out.

Angles are a metric. A bounded sample of the index gives pivots; each vector goes to the cell of its nearest one, and for each
pair of a cell and a pivot the least and the greatest angle are kept (a table of ``pivots`` squared numbers). They bound the
cosine of a query to anything in a cell. Each query first searches its most promising cells until they hold k vectors; what it has found then
rules out every cell with a lower bound, and the others are searched. Whatever the pivots, the result is that of comparing all.

Cells are cut into slices of a bounded number of vectors and a cell's queries into chunks; a task multiplies a slice by a chunk and
gives each query's k best. So neither a cell that holds most of the index nor a query that needs all cells meets in one task.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from tessera.operators.vectors import EPSILON
from tessera.sources import files

#: Vectors of a block, queries of a block; angles and scores are compared with so much room for rounding.
SLICE, CHUNK, ROOM = 4096, 1024, 1e-6
#: Scores are rounded, so that equal vectors have equal ones in whatever block they are.
DIGITS = 12


@dataclass
class Cells:
    """What bounds a query, of the size of the pivots alone; tasks get it."""

    pivots: np.ndarray
    counts: np.ndarray
    low: np.ndarray
    high: np.ndarray


def _matrix(column: pa.Array, n: int) -> np.ndarray:
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, n)


def _angles(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    norms = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.arccos(np.clip((x @ pivots.T) / np.where(norms == 0, 1, norms), -1, 1))


def _sound(vector: str, n: int | None = None) -> Column:
    """Vectors that take part: not null, not empty, no nulls inside."""
    v = F.col(f"`{vector}`")
    sized = F.size(v) > 0 if n is None else F.size(v) == n
    return v.isNotNull() & sized & ~F.exists(v, lambda x: x.isNull() | F.isnan(x))


def build(index: DataFrame, n: int, id_column: str, vector: str, pivots: int) -> tuple[DataFrame, Cells] | None:
    """Cells of the vectors of n components. Vectors without a direction have a cell of their own, the last one, that no bound holds for."""
    own = index.filter(_sound(vector, n)).select(F.col(id_column).alias("id"), F.col(f"`{vector}`").cast("array<double>").alias("v"))
    length = F.sqrt(F.aggregate("v", F.lit(0.0), lambda s, x: s + x * x))
    sample = own.filter(length > ROOM).orderBy(F.xxhash64("v"), "v").limit(pivots).select("v").toArrow()
    p = np.unique(_matrix(sample.column("v"), n), axis=0) if sample.num_rows else np.zeros((0, n))
    p = p / np.sqrt((p * p).sum(axis=1, keepdims=True))
    last = len(p)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = _matrix(b.column("v"), n)
            flat = np.sqrt((x * x).sum(axis=1)) <= ROOM
            cell = np.where(flat, last, _angles(x, p).argmin(axis=1) if last else last)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(cell.astype(np.int32))], names=["id", "v", "cell"])

    rows = files.stored(own.mapInArrow(assign, T.StructType([*own.schema.fields, T.StructField("cell", T.IntegerType())])))

    def extremes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, low, high = np.zeros(last + 1, np.int64), np.full((last + 1, last), np.pi), np.zeros((last + 1, last))
        for b in batches:
            cell, angle = b.column("cell").to_numpy(), _angles(_matrix(b.column("v"), n), p)
            counts += np.bincount(cell, minlength=last + 1)
            np.minimum.at(low, cell, angle)
            np.maximum.at(high, cell, angle)
        for c in np.flatnonzero(counts):
            yield pa.RecordBatch.from_pydict({"cell": pa.array([c], pa.int32()), "n": pa.array([counts[c]], pa.int64()), "low": pa.array([low[c]], pa.list_(pa.float64())), "high": pa.array([high[c]], pa.list_(pa.float64()))})

    each = lambda f, c: F.array(*[f(F.get(c, F.lit(i))) for i in range(last)]).cast("array<double>").alias(c)
    table = rows.select("v", "cell").mapInArrow(extremes, "cell int, n long, low array<double>, high array<double>").groupBy("cell").agg(F.sum("n").alias("n"), each(F.min, "low"), each(F.max, "high")).toArrow()
    if not table.num_rows:
        return None
    cells = Cells(p, np.zeros(last + 1, np.int64), np.full((last + 1, last), np.pi), np.zeros((last + 1, last)))
    at = table.column("cell").to_numpy()
    cells.counts[at] = table.column("n").to_numpy()
    cells.low[at], cells.high[at] = _matrix(table.column("low"), last) if last else 0, _matrix(table.column("high"), last) if last else 0
    return rows, cells


def bounds(cells: Cells, x: np.ndarray) -> np.ndarray:
    """The greatest score that each query may reach in each cell."""
    angle = _angles(x, cells.pivots)
    best = np.zeros((len(x), len(cells.counts)))
    for p in range(len(cells.pivots)):  # pivot by pivot, so that memory stays that of queries times cells
        gap = np.maximum(cells.low[None, :, p] - angle[:, None, p], angle[:, None, p] - cells.high[None, :, p])
        np.maximum(best, gap, out=best)
    out = np.cos(np.clip(best - ROOM, 0, np.pi)) + ROOM
    out[:, -1] = 1.0 + ROOM
    out[np.sqrt((x * x).sum(axis=1)) <= ROOM] = 1.0 + ROOM  # nothing bounds a query without a direction
    return out


def wanted(cells: Cells, queries: DataFrame, n: int, k: int) -> DataFrame:
    """(query_id, cell, bound, first) of each query and cell; first: the best cells that hold k vectors together."""
    kind = queries.schema["query_id"]
    id_type = to_arrow_type(kind.dataType)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        full = np.flatnonzero(cells.counts)
        for b in batches:
            if not b.num_rows:
                continue
            bound = bounds(cells, _matrix(b.column("q"), n))[:, full]
            order = np.argsort(-bound, axis=1, kind="stable")
            before = np.cumsum(cells.counts[full][order], axis=1) - cells.counts[full][order]
            ids = pc.take(b.column("query_id"), pa.array(np.repeat(np.arange(b.num_rows), len(full))))
            ordered = np.take_along_axis(bound, order, axis=1)
            yield pa.RecordBatch.from_arrays([ids.cast(id_type), pa.array(full[order].ravel().astype(np.int32)), pa.array(ordered.ravel()), pa.array((before < k).ravel())], names=["query_id", "cell", "bound", "first"])

    schema = T.StructType([kind, *T._parse_datatype_string("cell int, bound double, first boolean").fields])
    return queries.select("query_id", "q").mapInArrow(run, schema)


def _scan(index: DataFrame, cells: Cells, pairs: DataFrame, queries: DataFrame, n: int, k: int) -> DataFrame:
    """(query_id, id, score): of each block that a query asks for, its k best."""
    slices = F.array(*[F.lit(max(1, -(-int(c) // SLICE))) for c in cells.counts])
    n_slices = F.get(slices, F.col("cell"))
    asked = pairs.groupBy("cell").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"))  # a row a cell: as many as pivots
    left = index.join(F.broadcast(asked), "cell").select("id", "v", "cell", F.pmod(F.xxhash64("id", "v"), n_slices).cast("int").alias("slice"), F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk"))
    right = pairs.join(F.broadcast(asked), "cell").join(queries.select("query_id", "q"), "query_id")
    right = right.select("query_id", "q", "cell", F.explode(F.sequence(F.lit(0), n_slices - 1)).alias("slice"), F.pmod(F.xxhash64("query_id"), F.col("chunks")).cast("int").alias("chunk"))
    kind, id_kind = queries.schema["query_id"], index.schema["id"]
    names = ["query_id", "id", "score"]
    types = [to_arrow_type(kind.dataType), to_arrow_type(id_kind.dataType), pa.float64()]

    def multiply(rows: pa.Table, asked: pa.Table) -> pa.Table:
        if not rows.num_rows or not asked.num_rows:
            return pa.table([pa.array([], t) for t in types], names=names)
        rows = rows.take(pc.sort_indices(rows.column("id"), sort_keys=[("", "descending")]))  # equal scores: the greater id first
        x, q = _matrix(rows.column("v"), n), _matrix(asked.column("q"), n)
        norm = lambda m: np.sqrt((m * m).sum(axis=1)) + EPSILON
        score = np.round((q @ x.T) / (norm(q)[:, None] * norm(x)[None, :]), DIGITS)
        best = np.argsort(-score, axis=1, kind="stable")[:, :k]
        of = np.repeat(np.arange(len(q)), best.shape[1])
        return pa.table([asked.column("query_id").take(pa.array(of)).cast(types[0]), rows.column("id").take(pa.array(best.ravel())).cast(types[1]), pa.array(np.take_along_axis(score, best, axis=1).ravel())], names=names)

    by = ["cell", "slice", "chunk"]
    schema = T.StructType([kind, T.StructField("id", id_kind.dataType), T.StructField("score", T.DoubleType())])
    return left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(multiply, schema)


def _best(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.desc("id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)


def _of_length(index: DataFrame, queries: DataFrame, n: int, k: int, id_column: str, vector: str, pivots: int) -> tuple[DataFrame, DataFrame] | None:
    built = build(index, n, id_column, vector, pivots)
    if built is None:
        return None
    rows, cells = built
    asked = queries.filter(_sound("q", n)).select("query_id", F.col("q").cast("array<double>").alias("q"))
    pairs = files.stored(wanted(cells, asked, n, k))
    first = files.stored(_best(_scan(rows, cells, pairs.filter("first"), asked, n, k), k))
    # a query that hasn't found k yet has no cell left to search
    reached = first.filter(F.col("rank") == k).select("query_id", F.col("score").alias("reached"))
    more = pairs.filter("NOT first").join(reached, "query_id").filter(F.col("bound") >= F.col("reached")).select("query_id", "cell", "bound", "first")
    size = F.get(F.array(*[F.lit(int(c)) for c in cells.counts]), F.col("cell"))
    searched = pairs.filter("first").unionByName(more).select("query_id", size.alias("n"))
    return first.drop("rank").unionByName(_scan(rows, cells, more, asked, n, k)), searched


def search(index: DataFrame, queries: DataFrame, k: int, id_column: str = "id", vector: str = "embedding", pivots: int = 64) -> DataFrame:
    """(query_id, rank, id, score) for queries (query_id, q): their k nearest by cosine, ties to the greater id.

    Query ids are unique. Vectors that are null or empty or hold nulls or NaN take no part, and those of one length meet only
    those of the same; a zero vector has score 0 with everything. ``pivots`` only decides how much is left out.
    """
    return _search(index, queries, k, id_column, vector, pivots)[0]


def compared(index: DataFrame, queries: DataFrame, k: int, id_column: str = "id", vector: str = "embedding", pivots: int = 64) -> DataFrame:
    """(query_id, n): with how many vectors each query was compared, of those in cells; the rest was ruled out."""
    return _search(index, queries, k, id_column, vector, pivots)[1].groupBy("query_id").agg(F.sum("n").alias("n"))


def _search(index: DataFrame, queries: DataFrame, k: int, id_column: str, vector: str, pivots: int) -> tuple[DataFrame, DataFrame]:
    lengths = [r[0] for r in queries.filter(_sound("q")).select(F.size("q")).distinct().collect()]  # models have few lengths
    kind, id_kind = queries.schema["query_id"], T.StructField("id", index.schema[id_column].dataType)
    found = queries.sparkSession.createDataFrame([], T.StructType([kind, id_kind, T.StructField("score", T.DoubleType())]))
    searched = queries.sparkSession.createDataFrame([], T.StructType([kind, T.StructField("n", T.IntegerType())]))
    for n in sorted(lengths):
        if (part := _of_length(index, queries, n, k, id_column, vector, pivots)) is not None:
            found, searched = found.unionByName(part[0]), searched.unionByName(part[1])
    best = _best(found, k)
    return best.select("query_id", "rank", F.col("id").alias(id_column), "score"), searched

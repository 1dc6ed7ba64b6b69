"""Approximate nearest neighbours by largest inner product: an inverted file with product-quantised residuals.

Fitted on a bounded sample (``SAMPLE`` vectors, those with the least hashes of their ids): coarse centroids by
k-means, and for every pair of dimensions a codebook of up to 256 residuals. Every vector is indexed: its list and its
codes, and how far they are from its own components. A query probes the lists whose centroids have the largest inner
product with it; in each it scores all codes from a table of its own (asymmetric distances), and scores exactly, in double
precision, on the original vectors, those whose distance from their codes lets them be among its ``k`` nearest. How many
lists are probed at first is calibrated on the sample: the fewest that find ``RECALL`` of the sample's own nearest
neighbours. Then every further list is probed whose radius lets one of its vectors reach the k-th score found so far:
whatever rows the sample stands for, the nearest are found.

A list and the queries that probe it meet in cells of at most ``CELL_VECTORS`` by ``CELL_QUERIES`` (in the mean), so that
neither a crowded list nor a popular one lands in one task.

Edge cases: vectors that are null, zero, or hold null or non-finite components take no part, nor do those whose length
isn't the most common one; rows with a query's vec_id are never its neighbours; repeated rows are one query, but a
candidate each; equal scores go to the smaller vec_id; an empty table gives an empty result; other columns aren't read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.llm._spark import cut, prepare

SAMPLE = 20_000
MAX_LISTS = 512
RECALL = 0.98
CELL_VECTORS = 4096
CELL_QUERIES = 1024
#: Queries that are scored together, and pairs that are scored exactly together.
TOGETHER, PAIRS = 128, 1 << 16
#: What rounding may add to a score of codes (single precision) and to one of vectors (double), in parts of the lengths.
ROUGH, FINE = 1e-5, 1e-9
SEED = 5


@dataclass
class Index:
    """What is broadcast: at most MAX_LISTS centroids and 256 codewords for each pair of dimensions."""

    centroids: np.ndarray  # lists x d
    codebooks: np.ndarray  # parts x words x width
    probes: int
    #: The vectors' largest component: inside, all are divided by it.
    scale: float = 1.0

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Of each vector: its list, its codes, how far its score may be from its codes', and its distance from the centroid."""
        x = x / self.scale
        lists = nearest(x, self.centroids)
        rest = self._parts(x - self.centroids[lists])
        codes = np.stack([nearest(rest[:, m], self.codebooks[m]) for m in range(len(self.codebooks))], axis=1)
        told = self.codebooks[np.arange(len(self.codebooks)), codes]
        length = lambda a: np.sqrt((a**2).reshape(len(a), -1).sum(axis=1))
        whole = length(self.centroids[lists])
        return lists, codes.astype(np.uint8), length(rest - told) + ROUGH * (whole + length(told)), length(rest) + FINE * (whole + length(rest))

    def units(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Queries of length one, and what their scores with scaled vectors are to be multiplied by."""
        top = np.abs(q).max(axis=1)
        length = np.sqrt(((q / top[:, None]) ** 2).sum(axis=1))
        return q / top[:, None] / length[:, None], top * length * self.scale

    def _parts(self, x: np.ndarray) -> np.ndarray:
        parts, _, width = self.codebooks.shape
        padded = np.zeros((len(x), parts * width), dtype=x.dtype)
        padded[:, : x.shape[1]] = x
        return padded.reshape(len(x), parts, width)

    def approximate(self, q: np.ndarray, lists: np.ndarray, codes: np.ndarray) -> np.ndarray:
        """Asymmetric scores of all queries with all coded vectors of a cell, which share a list."""
        tables = np.einsum("qmw,mkw->mqk", self._parts(q), self.codebooks).astype(np.float32)
        out = (q @ self.centroids[lists].T).astype(np.float32)
        for m in range(len(tables)):
            out += tables[m][:, codes[:, m]]
        return out


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    half = (centres**2).sum(1) / 2
    return np.concatenate([np.argmax(x[i : i + 4096] @ centres.T - half, axis=1) for i in range(0, max(len(x), 1), 4096)])


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    centres = x[rng.choice(len(x), min(k, len(x)), replace=False)].copy()
    for _ in range(rounds):
        of = nearest(x, centres)
        n = np.bincount(of, minlength=len(centres))
        sums = np.stack([np.bincount(of, x[:, j], len(centres)) for j in range(x.shape[1])], axis=1)
        full = n > 0
        centres[full] = sums[full] / n[full, None]
    return centres


def fit(sample: np.ndarray, n: int, k: int, recall: float = RECALL) -> Index:
    rng = np.random.default_rng(SEED)
    x = np.unique(sample, axis=0)
    lists = int(min(max(1, round(n**0.5 / 4)), MAX_LISTS, max(1, len(x) // 39)))
    centroids = kmeans(x, lists, rng)
    of = nearest(x, centroids)
    width = 2 if x.shape[1] > 1 else 1
    rest = x - centroids[of]
    rest = np.pad(rest, ((0, 0), (0, -rest.shape[1] % width))).reshape(len(x), -1, width)
    books = [kmeans(rest[:, m], min(256, len(x)), rng, 6) for m in range(rest.shape[1])]
    index = Index(centroids, np.stack(books), lists)
    # probes: in which place of a query's order of lists its true neighbours in the sample are
    asked = rng.choice(len(x), min(200, len(x)), replace=False)
    scores = x[asked] @ x.T
    scores[np.arange(len(asked)), asked] = -np.inf
    best = np.argsort(-scores, axis=1)[:, : min(k, len(x) - 1)]
    place = np.argsort(np.argsort(-(x[asked] @ centroids.T), axis=1), axis=1)
    if best.size:
        at = np.sort(np.take_along_axis(place, of[best], axis=1).ravel())
        index.probes = int(at[min(int(np.ceil(recall * len(at))), len(at)) - 1]) + 1
    return index


def _matrix(column: pa.Array | pa.ChunkedArray) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(len(column), -1) if len(column) else np.zeros((0, 0))


def valid(vectors: DataFrame, column: str = "embedding") -> DataFrame:
    """(vec_id, v) of the vectors that take part."""
    v = F.col(column)
    sound: Column = F.forall(v, lambda x: F.coalesce(~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))), F.lit(False))) & F.exists(v, lambda x: x != 0)
    rows = vectors.filter(v.isNotNull() & (F.size(v) > 0)).select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).filter(F.col("vec_id").isNotNull() & sound)
    lengths = rows.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").limit(1).collect()
    return rows.filter(F.size("v") == (lengths[0]["n"] if lengths else 0))


def _least(score: np.ndarray) -> np.ndarray:
    """The score, with unit queries and scaled vectors, below which nothing rounds to it."""
    return score - FINE * (1 + np.abs(score))


def search(vectors: DataFrame, is_query: Column | None = None, k: int = 20, column: str = "embedding", recall: float = RECALL, sample: int = SAMPLE) -> DataFrame:
    """query_id, rank, vec_id, score: the k nearest found of every row for which ``is_query`` (default: every 20th id)."""
    spark = prepare(vectors.sparkSession)
    rows = valid(vectors, column)
    is_query = F.col("vec_id") % 20 == 0 if is_query is None else is_query
    schema = "query_id long, rank int, vec_id long, score double"
    n = rows.count()
    if not n:
        return spark.createDataFrame([], schema)
    top = rows.agg(F.max(F.array_max(F.transform("v", lambda x: F.abs(x.cast("double")))))).first()[0]
    picked = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample).select("v").toArrow()
    index = fit(_matrix(picked.column("v")) / top, n, k, recall)
    index.scale = top
    held = spark.sparkContext.broadcast(index)
    kind = rows.schema["v"].dataType.simpleString()

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                lists, codes, off, far = held.value.encode(_matrix(batch.column("v")))
                yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(lists.astype(np.int32)), pa.array([c.tobytes() for c in codes], pa.binary()), pa.array(off), pa.array(far)], ["vec_id", "v", "list", "codes", "off", "far"])

    coded = cut(rows.mapInArrow(encode, f"vec_id long, v {kind}, list int, codes binary, off double, far double"))
    # at most MAX_LISTS entries
    sizes, radius = np.zeros(len(index.centroids), dtype=np.int64), np.zeros(len(index.centroids))
    for r in coded.groupBy("list").agg(F.count("*").alias("n"), F.max("far").alias("far")).collect():
        sizes[r["list"]], radius[r["list"]] = r["n"], r["far"]
    # a repeated row is one query
    own = cut(rows.filter(is_query).groupBy("vec_id").agg(F.min("v").alias("v")))

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The lists that a query probes at first (``reach`` null), or those others that may hold a score of ``reach``."""
        at = held.value
        for batch in batches:
            if batch.num_rows:
                q, unit = at.units(_matrix(batch.column("v")))
                scores = q @ at.centroids.T
                order = np.argsort(-scores, axis=1, kind="stable")
                # further lists are probed while those so far hold too few vectors
                held_before = np.cumsum(sizes[order], axis=1) - sizes[order]
                wanted = (np.arange(order.shape[1]) < at.probes) | (held_before < 2 * k + 1)
                reach = batch.column("reach").to_numpy(zero_copy_only=False)
                later = ~np.isnan(reach)
                # in the place of an order: what its list's closest vector may score
                most = np.take_along_axis(scores, order, axis=1) + radius[order]
                wanted[later] = ~wanted[later] & (sizes[order[later]] > 0) & ~(most[later] < _least(reach[later] / unit[later])[:, None])
                which, where = np.nonzero(wanted)
                yield pa.RecordBatch.from_arrays([*(batch.column(c).take(pa.array(which)) for c in ("vec_id", "v", "reach")), pa.array(order[which, where].astype(np.int32))], ["query_id", "q", "reach", "list"])

    def cell(vectors: pa.Table, queries: pa.Table) -> pa.Table:
        names = ["query_id", "vec_id", "score"]
        if not vectors.num_rows or not queries.num_rows:
            return pa.Table.from_arrays([pa.array([], pa.int64()), pa.array([], pa.int64()), pa.array([], pa.float64())], names)
        ids = vectors.column("vec_id").to_numpy()
        by_id = np.argsort(ids, kind="stable")
        ids, x = ids[by_id], _matrix(vectors.column("v"))[by_id]
        # of equal vectors only those of the least ids can be among a query's k nearest: k, and as many as the query's own rows
        _, same = np.unique(x, axis=0, return_inverse=True)
        grouped = np.argsort(same.ravel(), kind="stable")
        starts = np.flatnonzero(np.diff(same.ravel()[grouped], prepend=-1))
        nth = np.empty(len(ids), dtype=np.int64)
        nth[grouped] = np.arange(len(ids)) - np.repeat(starts, np.diff(starts, append=len(ids)))
        runs = np.flatnonzero(np.diff(ids[grouped], prepend=ids[grouped[0]] - 1) | np.diff(same.ravel()[grouped], prepend=-1))
        repeats = np.zeros(len(starts), dtype=np.int64)
        np.maximum.at(repeats, same.ravel()[grouped[runs]], np.diff(runs, append=len(ids)))
        kept = np.flatnonzero(nth < k + repeats[same.ravel()])
        by_id, ids, x = by_id[kept], ids[kept], x[kept]
        codes = np.frombuffer(b"".join(vectors.column("codes").to_pylist()), np.uint8).reshape(vectors.num_rows, -1)[by_id]
        off = vectors.column("off").to_numpy()[by_id].astype(np.float32)
        lists = np.full(len(ids), vectors.column("list")[0].as_py())
        asked, q = queries.column("query_id").to_numpy(), _matrix(queries.column("q"))
        unit_q, unit = held.value.units(q)
        reach = queries.column("reach").to_numpy()
        out = []

        def exact(which: np.ndarray, where: np.ndarray) -> np.ndarray:
            parts = [np.einsum("pd,pd->p", q[which[i : i + PAIRS]], x[where[i : i + PAIRS]]) for i in range(0, max(len(which), 1), PAIRS)]
            return np.concatenate(parts)

        for a in range(0, len(asked), TOGETHER):
            mine = np.arange(a, min(a + TOGETHER, len(asked)))
            rough = held.value.approximate(unit_q[mine], lists, codes)
            rough[asked[mine][:, None] == ids[None, :]] = -np.inf
            # the k best by their codes have k exact scores: what surely scores less than all of those is left out
            least = np.where(np.isnan(reach[mine]), -np.inf, reach[mine])
            if len(ids) > k:
                near = np.argpartition(-rough, k - 1, axis=1)[:, :k]
                worst = exact(np.repeat(mine, k), near.ravel()).reshape(len(mine), k).min(axis=1)
                full = np.take_along_axis(rough, near, axis=1).min(axis=1) > -np.inf
                least = np.maximum(least, np.where(full, worst, -np.inf))
            which, where = np.nonzero((rough > -np.inf) & ~(rough + off < _least(least / unit[mine])[:, None]))
            score = exact(mine[which], where)
            # ids rise with their places: equal scores keep the smaller ids
            order = np.lexsort((where, -score, which))
            which, where, score = which[order], where[order], score[order]
            place = np.arange(len(which)) - np.searchsorted(which, which)
            first = place < k
            out.append((asked[mine[which[first]]], ids[where[first]], score[first]))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names)

    keys = ["list", "chunk", "block"]
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def nearest_in(queries: DataFrame) -> DataFrame:
        """The scores of the nearest in the lists that (query_id, q, reach, list) name."""
        asked = {r["list"]: r["count"] for r in queries.groupBy("list").count().collect()}
        plan = spark.createDataFrame(
            [(i, max(1, -(-int(sizes[i]) // CELL_VECTORS)), max(1, -(-asked[i] // CELL_QUERIES))) for i in sorted(asked)],
            "list int, chunks int, blocks int",
        )
        plan = F.broadcast(plan)
        cell_of = lambda x, n: F.pmod(F.xxhash64(x), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        left = coded.join(plan, "list").select("list", cell_of("vec_id", "chunks").alias("chunk"), every("blocks").alias("block"), "vec_id", "v", "codes", "off")
        right = queries.join(plan, "list").select("list", every("chunks").alias("chunk"), cell_of("query_id", "blocks").alias("block"), "query_id", "q", "reach")
        return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(cell, "query_id long, vec_id long, score double")

    def ranked(scores: DataFrame) -> DataFrame:
        return scores.withColumn("rank", F.row_number().over(best)).filter(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")

    probed = f"query_id long, q {kind}, reach double, list int"
    found = cut(ranked(nearest_in(cut(own.withColumn("reach", F.lit(None).cast("double")).mapInArrow(probe, probed)))))
    # a query that has fewer than k has a reach that any list passes
    kth = found.groupBy("query_id").agg(F.when(F.count("*") == k, F.min("score")).alias("kth"))
    reach = F.coalesce("kth", F.lit(float("-inf"))).alias("reach")
    more = own.join(kth, own["vec_id"] == kth["query_id"], "left").select("vec_id", "v", reach).mapInArrow(probe, probed)
    return ranked(found.drop("rank").unionByName(nearest_in(cut(more))))

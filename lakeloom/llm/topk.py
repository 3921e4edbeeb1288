"""Exact top-k inner products with a pivot-distance index.

Vectors are keyed by their nearest pivot and the distance to it; the distances of a pivot are
cut into rings (annuli). A cell's extent (least and greatest distance, greatest norm) bounds the
score of all it holds: ``<q,v> <= <q,p> + |q| d(v,p)`` and, by the triangle inequality,
``<q,v> = (|q|^2 + |v|^2 - d(q,v)^2) / 2`` with ``d(q,v) >= |d(q,p) - d(v,p)|``. A query first
expands its most promising cells, which gives it a k-th score; every other cell whose bound does
not reach that score is left out, all others are searched. Pivots come from a bounded sample,
every vector is indexed, and the result is exact (recall 1).

Queries and cells meet in blocks (about ``QUERY_BLOCK`` by ``CELL_BLOCK`` vectors) over an
equi-join on the cell and its block, so a large cell is searched by many tasks. Pivots grow with
the square root of the rows, up to ``MOST_PIVOTS``. Equal vectors are kept up to their k + 1 smallest ids, as no other can
be among k results; that limit is applied before the shuffle, so a hot vector costs nothing.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import Scratch

SAMPLE_ROWS = 2048
PIVOTS, MOST_PIVOTS, RINGS = 32, 512, 12
CELL_BLOCK, QUERY_BLOCK = 4096, 512
FIRST_ROWS = 512
SCALE = 256


def _vectors(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Row numbers of valid vectors, their lengths, offsets and flat quantised components."""
    column = batch.column("embedding")
    column = column.cast(pa.large_list(pa.float64()))
    offsets = column.offsets.to_numpy()
    values = column.values.to_numpy(zero_copy_only=False)  # nulls become NaN
    bad = np.concatenate([[0], np.cumsum(~np.isfinite(values))])
    null = column.is_null().to_numpy(zero_copy_only=False) | batch.column("vec_id").is_null().to_numpy(zero_copy_only=False)
    rows = np.flatnonzero(~null & (np.diff(offsets) > 0) & (bad[offsets[1:]] == bad[offsets[:-1]]))
    with np.errstate(invalid="ignore", over="ignore"):
        whole = np.floor(values * SCALE)
        large = np.concatenate([[0], np.cumsum(np.abs(whole) >= 2.0**62)])
    if (large[offsets[rows + 1]] != large[offsets[rows]]).any():
        raise OverflowError("a component times 256 does not fit a long")
    return rows, np.diff(offsets)[rows], offsets, np.where(np.abs(whole) < 2.0**62, whole, 0).astype(np.int64)


def _quantise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows, length, offsets, whole = _vectors(batch)
        take = np.arange(int(length.sum())) + np.repeat(offsets[rows] - (np.cumsum(length) - length), length)
        at = pa.array(np.concatenate([[0], np.cumsum(length)]).astype(np.int32))
        pick = pa.array(rows)
        yield pa.RecordBatch.from_arrays([batch.column("vec_id").take(pick), pa.ListArray.from_arrays(at, pa.array(whole[take])), batch.column("asks").take(pick)], names=["vec_id", "v", "asks"])


def choose_pivots(sample: list[list[int]], most: int) -> dict[int, np.ndarray]:
    """Per length, up to ``most`` sample vectors by farthest-first traversal."""
    out = {}
    for dim in {len(v) for v in sample}:
        have = np.unique(np.array([v for v in sample if len(v) == dim], np.float64).reshape(-1, dim), axis=0)
        picked = [0]
        far = np.linalg.norm(have - have[0], axis=1)
        while len(picked) < min(most, len(have)) and far.max() > 0:
            picked.append(int(far.argmax()))
            far = np.minimum(far, np.linalg.norm(have - have[picked[-1]], axis=1))
        out[dim] = have[picked]
    return out


def _distances(v: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    square = (v**2).sum(1)[:, None] + (pivots**2).sum(1)[None] - 2 * v @ pivots.T
    return np.sqrt(np.maximum(square, 0))


def _by_length(batch: pa.RecordBatch, column: str):
    lists = batch.column(column)
    offsets, flat = lists.offsets.to_numpy(), lists.values.to_numpy()
    length = np.diff(offsets)
    for dim in np.unique(length):
        rows = np.flatnonzero(length == dim)
        yield int(dim), rows, flat[(offsets[rows][:, None] + np.arange(dim)[None]).ravel()].reshape(len(rows), dim)


def _pivots_of(held: dict[int, np.ndarray], dim: int) -> np.ndarray:
    return held.get(dim, np.zeros((1, dim)))


def _assign(held, edges):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = batch.num_rows
            pivot, near, norm, dims = np.zeros(n, np.int32), np.zeros(n), np.zeros(n), np.zeros(n, np.int32)
            for dim, rows, v in _by_length(batch, "v"):
                away = _distances(v.astype(np.float64), _pivots_of(held.value, dim))
                pivot[rows], near[rows] = away.argmin(1), away.min(1)
                norm[rows], dims[rows] = np.sqrt((v.astype(np.float64) ** 2).sum(1)), dim
            ring = np.searchsorted(edges.value, near).astype(np.int32)
            yield pa.RecordBatch.from_arrays([batch.column("vec_id"), batch.column("v"), pa.array(dims), pa.array(pivot), pa.array(ring), pa.array(near), pa.array(norm)], names=["vec_id", "v", "dim", "pivot", "ring", "near", "norm"])

    return run


def _bounds(q: np.ndarray, pivots: np.ndarray, cells: np.ndarray) -> np.ndarray:
    """Greatest possible score of each query (rows) in each cell; with slack for rounding."""
    pivot = cells["pivot"]
    away, inner, norm = _distances(q, pivots)[:, pivot], (q @ pivots.T)[:, pivot], np.sqrt((q**2).sum(1))[:, None]
    gap = np.maximum(0, np.maximum(cells["lo"] - away, away - cells["hi"]) - 1e-6 * (1 + away))
    bound = np.minimum(inner + norm * cells["hi"], (norm**2 + cells["norm"] ** 2 - gap**2) / 2)
    return bound + 1 + 1e-9 * (norm * (cells["norm"] + cells["hi"]) + norm**2 + cells["norm"] ** 2)


def _expand(held, summary, first: bool):
    """Rows (cell, query) to search: the first cells of each query, or all others that its k-th score allows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            floor = None if first else batch.column("floor").to_numpy(zero_copy_only=False)
            at, cell = [], []
            for dim, rows, v in _by_length(batch, "v"):
                cells = summary.value[summary.value["dim"] == dim]
                if not len(cells):
                    continue
                bound = _bounds(v.astype(np.float64), _pivots_of(held.value, dim), cells)
                order = np.argsort(-bound, axis=1, kind="stable")
                seen = np.cumsum(cells["n"][order], axis=1)
                early = np.zeros_like(bound, bool)
                np.put_along_axis(early, order, np.concatenate([np.ones((len(rows), 1), bool), seen[:, :-1] < FIRST_ROWS], axis=1), axis=1)
                wanted = early if first else ~early & ~(bound < np.where(np.isnan(floor[rows]), -np.inf, floor[rows])[:, None])
                r, c = np.nonzero(wanted)
                at.append(rows[r])
                cell.append(cells["cell"][c])
            pick = np.concatenate(at) if at else np.empty(0, np.int64)
            taken = batch.select(["query_id", "v"]).take(pa.array(pick))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(cell) if cell else np.empty(0, np.int64)), *taken.columns], names=["cell", "query_id", "v"])

    return run


def _pack(names: tuple[str, str, str]):
    """One row for a group: ids and flat components."""

    def run(key, table):
        flat, ids = table.column("v").combine_chunks(), table.column(names[1]).combine_chunks()
        one = lambda x: pa.ListArray.from_arrays(pa.array([0, len(x)], pa.int32()), x)
        return pa.table({"cell": [key[0].as_py()], "block": [key[1].as_py()], names[0]: one(ids), names[2]: one(flat.flatten())})

    return run


def _score(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    most = float(np.abs(q).max(initial=0)) * float(np.abs(v).max(initial=0)) * max(1, q.shape[1])
    if most < 2.0**53:
        return (q.astype(np.float64) @ v.T.astype(np.float64)).astype(np.int64)
    if most < 2.0**63:
        return q @ v.T
    raise OverflowError("a score does not fit a long")


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list[np.ndarray]] = [[], [], []]
            for i in range(batch.num_rows):
                asks, ids = batch.column("queries")[i].values.to_numpy(), batch.column("ids")[i].values.to_numpy()
                q, v = (batch.column(c)[i].values.to_numpy().reshape(n, -1) for c, n in (("qflat", len(asks)), ("vflat", len(ids))))
                order = np.argsort(ids, kind="stable")
                ids, scores = ids[order], _score(q, v[order])
                for j in range(len(asks)):
                    other = np.flatnonzero(ids != asks[j])
                    own = scores[j, other]
                    if len(own) > k:
                        least = np.partition(own, len(own) - k)[len(own) - k]
                        other, own = other[own >= least], own[own >= least]
                    best = np.argsort(-own, kind="stable")[:k]
                    for store, value in zip(out, (np.full(len(best), asks[j]), ids[other[best]], own[best]), strict=True):
                        store.append(value)
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x) if x else np.empty(0, np.int64), pa.int64()) for x in out], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, asks: Column, k: int = 5) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the ``k`` best rows for every row where ``asks`` holds.

    ``vectors(vec_id, embedding, ...)``; a component x counts as floor(256 x), the score is the
    integer inner product, ties go to the smaller id, and a query is no result of its own id.
    Rows with a null id, a null or empty vector, or a null or non-finite component take no part; vectors of
    another length than the query's are not compared with it; a component of a row that takes part
    which does not fit a long after scaling, or a score that does not, is an OverflowError; repeated rows count once; a query
    with fewer than ``k`` others gets them all, one with none no row; further columns are ignored.
    """
    spark = vectors.sparkSession
    scratch = Scratch(spark, "topk")
    narrow = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"), F.coalesce(asks, F.lit(False)).alias("asks"))
    whole = scratch.save(narrow.mapInArrow(_quantise, "vec_id long, v array<long>, asks boolean").distinct(), "vectors")
    queries = whole.where("asks").select(F.col("vec_id").alias("query_id"), "v")
    n_rows, n_queries = whole.agg(F.count("*"), F.count_if("asks")).first()
    # by a hash first, so that about twice as many rows as are wanted reach the limit, however many there are
    thin = whole.where(F.pmod(F.xxhash64("vec_id", F.lit("sample")), F.lit(max(1, n_rows // (2 * SAMPLE_ROWS)))) == 0)
    sample = [r["v"] for r in thin.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS).select("v").collect()]
    most = min(MOST_PIVOTS, max(PIVOTS, math.isqrt(n_rows) // 8))
    pivots = choose_pivots(sample, most)
    near = np.concatenate([_distances(np.array([v for v in sample if len(v) == d], np.float64).reshape(-1, d), p).min(1) for d, p in pivots.items()]) if pivots else np.zeros(1)
    held = spark.sparkContext.broadcast(pivots)
    edges = spark.sparkContext.broadcast(np.unique(np.quantile(near, np.linspace(0, 1, RINGS + 1)[1:-1])))

    few = Window.partitionBy("v").orderBy("vec_id")
    kept = whole.select("vec_id", "v").withColumn("nth", F.row_number().over(few)).where(F.col("nth") <= k + 1).select("vec_id", "v")
    keyed = kept.mapInArrow(_assign(held, edges), "vec_id long, v array<long>, dim int, pivot int, ring int, near double, norm double")
    keyed = scratch.save(keyed.withColumn("cell", F.col("dim").cast("long") * (MOST_PIVOTS * (RINGS + 1)) + F.col("pivot") * (RINGS + 1) + F.col("ring")), "keyed")
    extent = keyed.groupBy("cell", "dim", "pivot").agg(F.count("*").alias("n"), F.min("near").alias("lo"), F.max("near").alias("hi"), F.max("norm").alias("norm"))
    extent = scratch.save(extent, "extent")
    # at most MOST_PIVOTS * RINGS rows for each length of vector
    cells = np.array([tuple(r) for r in extent.select("cell", "dim", "pivot", "n", "lo", "hi", "norm").collect()], dtype=[("cell", "i8"), ("dim", "i8"), ("pivot", "i8"), ("n", "i8"), ("lo", "f8"), ("hi", "f8"), ("norm", "f8")])
    summary = spark.sparkContext.broadcast(cells)
    sized = F.broadcast(extent.select(F.col("cell").alias("of"), F.ceil(F.col("n") / CELL_BLOCK).alias("blocks")))
    blocks = keyed.join(sized, F.col("cell") == F.col("of"))
    blocks = blocks.select("cell", F.pmod(F.xxhash64("vec_id"), F.col("blocks")).alias("block"), "vec_id", "v")
    index = scratch.save(blocks.groupBy("cell", "block").applyInArrow(_pack(("ids", "vec_id", "vflat")), "cell long, block long, ids array<long>, vflat array<long>"), "index")

    n_blocks = max(1, -(-n_queries // QUERY_BLOCK))

    def searched(wanted: DataFrame) -> DataFrame:
        packed = wanted.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(n_blocks)).cast("long")).groupBy("cell", "block").applyInArrow(_pack(("queries", "query_id", "qflat")), "cell long, block long, queries array<long>, qflat array<long>")
        # each block of queries goes to every block of its cell
        packed = packed.join(sized, F.col("cell") == F.col("of")).select("cell", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"), "queries", "qflat")
        hits = packed.join(index, ["cell", "block"]).select("queries", "qflat", "ids", "vflat").mapInArrow(_search(k), "query_id long, vec_id long, score long")
        return best(hits)

    def best(hits: DataFrame) -> DataFrame:
        order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
        return hits.distinct().withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)

    early = scratch.save(searched(queries.mapInArrow(_expand(held, summary, True), "cell long, query_id long, v array<long>")), "early")
    floor = early.where(F.col("rank") == k).select(F.col("query_id").alias("of"), F.col("score").cast("double").alias("floor"))
    rest = queries.join(floor, F.col("query_id") == F.col("of"), "left").select("query_id", "v", "floor")
    late = searched(rest.mapInArrow(_expand(held, summary, False), "cell long, query_id long, v array<long>"))
    return best(early.drop("rank").unionByName(late.drop("rank"))).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")

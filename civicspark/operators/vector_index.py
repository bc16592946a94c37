"""Nearest vectors by cosine over a table laid out by spherical k-means cells.

``build`` fits centroids on a bounded sample, assigns every vector to its nearest one and
writes the vectors partitioned by cell, with a small table of centroids, sizes and
widths. ``search`` takes any number of queries at once: each goes to the cells of its
nearest centroids, only those partitions are read, queries and vectors of neighbouring
cells meet in blocks of bounded size (a query is sent to a block once, with the cells it
visits there), and each block returns at most k rows a query. ``complete``
then visits every further cell that could still hold one of the k best: a vector's angle
to its centroid is at most the cell's width, so the angle between query and vector is at
least that between query and centroid less the width. The result is then the exact one.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from ..session import scratch_path

#: Vectors aimed at in a cell; most rows that centroids are fitted on; most bytes of all centroids as doubles.
CELL_ROWS, SAMPLE_ROWS, CENTROID_BYTES = 1000, 50_000, 64 << 20
PROBES = 16
#: Vectors and queries of a block.
SIDE, QUERY_SIDE = 4096, 1024
#: Visits (a query at a block) that leave a task in one batch.
VISITS = 65_536


def unit_rows(column: pa.ChunkedArray | pa.Array, dim: int) -> np.ndarray:
    """Lists of ``dim`` numbers as rows of length one."""
    raw = pc.list_flatten(column).to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, dim)
    return raw / np.sqrt((raw * raw).sum(axis=1, keepdims=True))


def usable(vector: str, dim: int):
    """Vectors of the dimension with finite components, not all zero."""
    x = F.col(vector)
    return (
        F.coalesce(F.size(x) == dim, F.lit(False)) & F.forall(x, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
        & F.exists(x, lambda v: v != 0)
    )


def _stretches(batch: pa.RecordBatch, size: int = 1024) -> Iterator[pa.RecordBatch]:
    for at in range(0, batch.num_rows, size):
        yield batch.slice(at, size)


def _visited(cell: pa.ChunkedArray, cells: pa.ChunkedArray) -> np.ndarray:
    """Whether a query (row) visits the cell of a vector (column)."""
    known, of = np.unique(cell.to_numpy(), return_inverse=True)
    lists = cells.combine_chunks()
    lists = lists.combine_chunks() if isinstance(lists, pa.ChunkedArray) else lists
    flat = lists.flatten().to_numpy()
    query, at = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), np.minimum(np.searchsorted(known, flat), len(known) - 1)
    here = known[at] == flat
    out = np.zeros((len(lists), len(known)), bool)
    out[query[here], at[here]] = True
    return out[:, of]


class VectorIndex:
    """Vectors of ``path``/vectors by cell, and ``path``/cells (cell, centroid, rows, least): ``least`` is the smallest cosine to the centroid."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self.vectors = spark.read.parquet(f"{self.path}/vectors")
        cells = spark.read.parquet(f"{self.path}/cells").orderBy("cell").collect()  # bounded by CENTROID_BYTES
        self.rows = np.array([r["rows"] for r in cells], np.int64)
        self.least = np.array([r["least"] for r in cells], np.float64)
        self.centroids = np.array([r["centroid"] for r in cells], np.float64)
        #: Neighbouring cells of together about ``SIDE`` vectors are a block: a query goes there once, however many of them it visits.
        self.block = (np.cumsum(self.rows) - self.rows) // SIDE

    @classmethod
    def build(cls, df: DataFrame, key: str, vector: str, path: str, *, dim: int | None = None, cell_rows: int = CELL_ROWS,
              sample_rows: int = SAMPLE_ROWS, seed: int = 7) -> VectorIndex:
        """Lay out (key, vector). Null, zero, non-finite vectors and those of another dimension than
        ``dim`` (by default the most frequent) are not part of the index."""
        spark, path = df.sparkSession, path.rstrip("/")
        rows = df.select(F.col(key).alias("key"), F.col(vector).alias("vector"))
        if dim is None:
            top = rows.where("size(vector) > 0").groupBy(F.size("vector").alias("d")).count().orderBy(F.desc("count"), "d").first()
            dim = top["d"] if top else 1
        rows = rows.where(usable("vector", dim))
        total = rows.count()
        wanted = max(1, min(-(-total // cell_rows), CENTROID_BYTES // (8 * dim)))
        centroids = np.eye(1, dim)
        if total:
            sample = rows.orderBy(F.xxhash64(F.lit(seed), "key")).limit(sample_rows).select(
                array_to_vector(F.col("vector").cast("array<double>")).alias("features"))
            if wanted > 1:
                model = KMeans(k=wanted, seed=seed, distanceMeasure="cosine", maxIter=15).fit(sample)
                centroids = np.array(model.clusterCenters())
            centroids = centroids / np.sqrt((centroids ** 2).sum(axis=1, keepdims=True))
        out = f"{path}/vectors"
        assigned = rows.mapInArrow(cls._assigner(centroids, dim), f"key {dict(rows.dtypes)['key']}, vector {dict(rows.dtypes)['vector']}, cell int, cosine double")
        if total:
            assigned.hint("rebalance", "cell").write.partitionBy("cell").parquet(out)
        else:  # divided by cell no file would be written, and none could tell the columns
            assigned.select("key", "vector", "cosine", "cell").write.parquet(out)
        stats = spark.read.schema(assigned.schema).parquet(out).groupBy("cell").agg(F.count(F.lit(1)).alias("rows"), F.min("cosine").alias("least"))
        known = {r["cell"]: r for r in stats.collect()}
        spark.createDataFrame(
            [(i, c.tolist(), known[i]["rows"] if i in known else 0, known[i]["least"] if i in known else 1.0) for i, c in enumerate(centroids)],
            "cell int, centroid array<double>, rows bigint, least double").coalesce(1).write.parquet(f"{path}/cells")
        return cls(spark, path)

    @staticmethod
    def _assigner(centroids: np.ndarray, dim: int):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in _stretches(whole):
                    score = unit_rows(batch.column("vector"), dim) @ centroids.T
                    cell = score.argmax(axis=1)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("key"), batch.column("vector"), pa.array(cell.astype(np.int32)), pa.array(score[np.arange(len(cell)), cell])],
                        ["key", "vector", "cell", "cosine"])

        return run

    def _cells(self, probes: int, further: bool):
        """The blocks a query goes to, each with the cells it visits there: its nearest ones, or all others that can reach its k-th score."""
        centroids, rows = self.centroids, self.rows
        width = np.arccos(np.clip(self.least, -1, 1))
        blocks, starts = np.unique(self.block, return_index=True)
        size = max(1, min(1024, VISITS // len(blocks)))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for whole in batches:
                for batch in _stretches(whole, size):
                    score = np.clip(unit_rows(batch.column("qvector"), centroids.shape[1]) @ centroids.T, -1, 1)
                    score[:, rows == 0] = -2
                    k = min(probes, len(centroids))
                    near = np.zeros(score.shape, bool)
                    np.put_along_axis(near, np.argpartition(-score, k - 1, axis=1)[:, :k], True, 1)
                    if further:
                        reach = np.cos(np.maximum(0, np.arccos(np.clip(score, -1, 1)) - width))
                        near = ~near & (reach >= batch.column("kth").to_numpy(zero_copy_only=False)[:, None] - 1e-9)
                    near[:, rows == 0] = False
                    counts = np.add.reduceat(near.astype(np.int32), starts, axis=1)
                    row, at = np.nonzero(counts)
                    lists = pa.ListArray.from_arrays(pa.array(np.append(0, counts[row, at].cumsum()), pa.int32()), pa.array(np.nonzero(near)[1], pa.int32()))
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("query").take(pa.array(row)), batch.column("qvector").take(pa.array(row)), pa.array(blocks[at].astype(np.int32)), lists],
                        ["query", "qvector", "block", "cells"])

        return run

    def _best(self, visits: DataFrame, k: int) -> DataFrame:
        """(query, key, score): the k best of the visited cells of each query (query, qvector, block, cells)."""
        # one row for each block (cell -1: its queries) and each cell
        seen = visits.select("block", F.explode(F.concat(F.array(F.lit(-1)), "cells")).alias("cell")).groupBy("block", "cell").agg(
            F.count(F.lit(1)).alias("n")).collect()
        kinds = f"query {dict(visits.dtypes)['query']}, key {dict(self.vectors.dtypes)['key']}, score double"
        if not seen:
            return _top(self.spark.createDataFrame([], kinds), k)
        asked, wanted = {r["block"]: r["n"] for r in seen if r["cell"] < 0}, sorted(r["cell"] for r in seen if r["cell"] >= 0)
        held = np.bincount(self.block, self.rows).astype(np.int64)
        of_block = [(b, int(-(-held[b] // SIDE)), int(-(-n // QUERY_SIDE))) for b, n in asked.items()]
        chunks = self.spark.createDataFrame(of_block, "block int, v int, q int")
        of_cell = self.spark.createDataFrame([(c, int(self.block[c])) for c in wanted], "cell int, block int").join(F.broadcast(chunks), "block")
        part = lambda of, n: F.pmod(F.xxhash64(of), F.col(n)).cast("int")
        every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
        keys = ["block", "_v", "_q"]
        read = self.vectors.where(F.col("cell").isin(wanted))  # only these partitions are read
        stored = read.join(F.broadcast(of_cell), "cell").withColumn("_v", part("key", "v")).withColumn("_q", every("q")).select(*keys, "key", "vector", "cell")
        asking = visits.join(F.broadcast(chunks), "block").withColumn("_q", part("query", "q")).withColumn("_v", every("v")).select(
            *keys, "query", "qvector", "cells")
        dim = self.centroids.shape[1]

        def run(left: pa.Table, right: pa.Table) -> pa.Table:
            if not left.num_rows or not right.num_rows:
                return pa.table({"query": right.column("query").slice(0, 0), "key": left.column("key").slice(0, 0), "score": pa.array([], pa.float64())})
            left = left.sort_by("key")
            # equal directions must tie exactly
            score = np.round(unit_rows(right.column("qvector"), dim) @ unit_rows(left.column("vector"), dim).T, 12)
            score[~_visited(left.column("cell"), right.column("cells"))] = -np.inf
            least = np.partition(score, -min(k, left.num_rows), axis=1)[:, -min(k, left.num_rows)]
            row, at = np.nonzero((score >= least[:, None]) & (score > -np.inf))
            found = score[row, at]
            order = np.lexsort((at, -found, row))  # of ties the lower keys come first
            row, at, found = row[order], at[order], found[order]
            first = np.arange(len(row)) - np.searchsorted(row, row) < k
            return pa.table({
                "query": right.column("query").take(pa.array(row[first])), "key": left.column("key").take(pa.array(at[first])),
                "score": pa.array(found[first])})

        found = stored.groupBy(*keys).cogroup(asking.groupBy(*keys)).applyInArrow(run, kinds)
        return _top(found, k)

    def search(self, queries: DataFrame, query: str, vector: str, k: int = 10, probes: int = PROBES, complete: bool = False) -> DataFrame:
        """(query, key, rank, score): the ``k`` nearest vectors of each query, cosine rounded to 12 decimals, lower keys first on ties.

        Queries must have different keys; those without a usable vector find nothing.
        """
        asked = queries.select(F.col(query).alias("query"), F.col(vector).alias("qvector")).where(usable("qvector", self.centroids.shape[1]))
        kinds = f"query {dict(asked.dtypes)['query']}, qvector {dict(asked.dtypes)['qvector']}, block int, cells array<int>"
        found = self._best(asked.mapInArrow(self._cells(probes, False), kinds), k)
        if complete:
            path = scratch_path(self.spark, "nearest")
            found.write.parquet(path)
            found = self.spark.read.schema(found.schema).parquet(path)
            kth = found.groupBy("query").agg(F.when(F.count(F.lit(1)) >= k, F.min("score")).otherwise(F.lit(-2.0)).alias("kth"))
            wide = asked.join(kth, "query", "left").select("query", "qvector", F.coalesce("kth", F.lit(-2.0)).alias("kth"))
            more = self._best(wide.mapInArrow(self._cells(probes, True), kinds), k)
            found = _top(found.union(more), k)
        return found


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("query").orderBy(F.desc("score"), "key")
    return found.select("query", "key", "score", F.row_number().over(order).alias("rank")).where(F.col("rank") <= k)


def recall(found: DataFrame, exact: DataFrame) -> DataFrame:
    """One row (pares, achados, desiguais): pairs of the exact result, those of them that were found, and those with another score."""
    marks = [df.select("query", "key", "score", F.lit(i).alias("of")) for i, df in enumerate((found, exact))]
    both = reduce(DataFrame.union, marks).groupBy("query", "key").agg(
        F.max("of").alias("exact"), F.min("of").alias("least"), (F.max("score") != F.min("score")).alias("other"))
    return both.agg(
        F.count_if(F.col("exact") == 1).alias("pares"), F.count_if((F.col("exact") == 1) & (F.col("least") == 0)).alias("achados"),
        F.count_if("other").alias("desiguais"))

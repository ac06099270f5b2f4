"""Approximate nearest neighbours: inverted file of coarse centroids with product-quantised residuals.

* Training: k-means on a bounded sample (`sample_rows`, the smallest id hashes) gives the coarse centroids, and for each
  group of components a codebook of residuals.  Everything else covers all rows.
* Equal vectors are one class: its first k + 1 ids are kept, which is all that k results can use, so a vector with
  very many copies is indexed and scanned once.
* Index: every class's cell, code, vector and its distance from what the code stands for, a written table dealt out in
  ranges of cells and sorted by cell, so that a file's footer tells which cells it holds.
* Probes: the fewest cells that hold `recall` of the nearest sampled neighbours of sampled vectors, found by brute force
  within the sample.  Vectors without clusters need most cells, others few.
* Search: the queries come in blocks of `query_block`, in the order of their nearest cells, so a block's queries share
  cells and its job reads only these.  Each task streams its part of the index and, for the cells that a query probes,
  sums asymmetric distances from the query's own tables.
* Reranking: by the triangle inequality a vector is no nearer than its asymmetric distance less its code's error.  The
  task measures candidates exactly, in double precision on the original vectors, least bound first and `rerank` at a
  time, until the bounds of all others are above its k-th best: no candidate of a probed cell is left out unproven.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sparktel.llm.common import Workspace, shuffle_partitions


def kmeans(x: np.ndarray, k: int, rounds: int = 10, seed: int = 7) -> np.ndarray:
    """k centroids at most (k distinct starts, Lloyd's rounds; an empty cluster keeps its centroid)."""
    r = np.random.default_rng(seed)
    starts = np.unique(x, axis=0)
    c = starts[r.permutation(len(starts))[:k]].astype(np.float32)
    for _ in range(rounds):
        at = nearest(x, c)
        n = np.bincount(at, minlength=len(c))
        sums = np.stack([np.bincount(at, x[:, j], len(c)) for j in range(x.shape[1])], axis=1)
        c = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], c).astype(np.float32)
    return c


def distances(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    return (x * x).sum(1)[:, None] - 2 * x @ c.T + (c * c).sum(1)[None, :]


def nearest(x: np.ndarray, c: np.ndarray, block: int = 4096) -> np.ndarray:
    return np.concatenate([distances(x[i : i + block], c).argmin(1) for i in range(0, len(x), block)]) if len(x) else np.zeros(0, np.int64)


@dataclass
class Quantizer:
    """coarse (cells, d) and books (groups, entries, width); d is padded with zeros to groups * width."""

    coarse: np.ndarray
    books: np.ndarray

    @classmethod
    def train(cls, x: np.ndarray, cells: int, groups: int) -> Quantizer:
        d = x.shape[1]
        groups = min(groups, d)
        width = -(-d // groups)
        coarse = kmeans(x, cells)
        rest = np.zeros((len(x), groups * width), np.float32)
        rest[:, :d] = x - coarse[nearest(x, coarse)]
        books = []
        for g in range(groups):
            b = kmeans(rest[:, g * width : (g + 1) * width], 256)
            books.append(np.concatenate([b, np.full((256 - len(b), width), 1e18, np.float32)]))
        return cls(coarse, np.stack(books))

    def pad(self, x: np.ndarray) -> np.ndarray:
        out = np.zeros((len(x), self.books.shape[0] * self.books.shape[2]), x.dtype)
        out[:, : x.shape[1]] = x
        return out

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cells and codes (rows, groups)."""
        cell = nearest(x, self.coarse)
        rest, width = self.pad(x - self.coarse[cell]), self.books.shape[2]
        return cell, np.stack([nearest(rest[:, g * width : (g + 1) * width], b) for g, b in enumerate(self.books)], axis=1).astype(np.uint8)

    def errors(self, x: np.ndarray, cell: np.ndarray, code: np.ndarray) -> np.ndarray:
        """Distance of each vector, in double precision, from what its cell and code stand for."""
        rest = self.pad(x - self.coarse[cell]).reshape(len(x), self.books.shape[0], -1)
        return np.sqrt(((rest - self.books[np.arange(len(self.books)), code]) ** 2).sum((1, 2)))

    def tables(self, q: np.ndarray, cell: int) -> np.ndarray:
        """Squared distances of each query's residual to every codebook entry: (queries, groups, 256)."""
        rest = self.pad(q - self.coarse[cell]).reshape(len(q), self.books.shape[0], 1, -1)
        return ((rest - self.books[None]) ** 2).sum(-1)


def _matrix(column: pa.Array, kind: type, d: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), d)


def _valid(v: Column) -> Column:
    return v.isNotNull() & (F.size(v) > 0) & F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists(v, lambda x: x != 0)


def search(vectors: DataFrame, is_query: Column, key: str = "vec_id", body: str = "embedding", k: int = 10, cells: int | None = None, probes: int | None = None, groups: int = 16, rerank: int = 300, sample_rows: int = 20_000, query_block: int = 4096, recall: float = 0.97) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: each query's k nearest found by Euclidean distance, ties to the smaller id.

    is_query is a condition on the key column.  Null ids and vectors that are null, empty, zero or hold a null or non-finite component take no part,
    nor do vectors whose length isn't the commonest one (ties: the larger).  Rows with equal id and vector are one.  All candidates, if fewer than k; an empty table gives an
    empty one; no other column is read.  By default cells is the root of the number of classes, 4096 at most.  Components
    are scaled by a power of two, which is exact, so that none overflows on the way; the result is a written table.
    """
    spark = vectors.sparkSession
    rows = vectors.select(vectors[key].cast("bigint").alias("id"), vectors[body].cast("array<double>").alias("v")).where(F.col("id").isNotNull() & _valid(F.col("v")))
    shape = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("count"), F.max(F.array_max(F.transform("v", F.abs))).alias("most")).orderBy(F.desc("count"), F.desc("d")).first()
    schema = "query_id bigint, rank int, vec_id bigint, score double"
    if shape is None:
        return spark.createDataFrame([], schema)
    d, scale = shape["d"], 2.0 ** min(1000, math.frexp(shape["most"])[1])
    with Workspace(spark, "ann") as space:
        return space.kept(_search(space, rows, d, scale, is_query, key, k, cells, probes, groups, rerank, sample_rows, query_block, recall))


def _search(space: Workspace, rows: DataFrame, d: int, scale: float, is_query: Column, key: str, k: int, cells: int | None, probes: int | None, groups: int, rerank: int, sample_rows: int, query_block: int, recall: float) -> DataFrame:
    spark = space.spark
    rows = rows.where(F.size("v") == d).withColumns({"c1": F.xxhash64("v"), "c2": F.xxhash64(F.lit(5), F.col("v"))})
    unique = rows.groupBy("c1", "c2", "id").agg(F.first("v").alias("v"))
    order = Window.partitionBy("c1", "c2").orderBy("id")
    members = space.written(unique.withColumn("n", F.row_number().over(order)).where(F.col("n") <= k + 1), "members")
    classes = members.where("n = 1").select("c1", "c2", "id", "v")
    count = classes.count()
    cells = cells or max(1, min(4096, round(count**0.5)))

    span = float(1 << 64)
    rate = 1.1 * sample_rows / count
    drawn = classes if rate >= 1 else classes.where((F.xxhash64("c1", F.lit(9)).cast("double") + span / 2) / span < rate)
    sample = (_matrix(drawn.orderBy("c1", "c2").limit(sample_rows).select("v").toArrow()["v"].combine_chunks(), np.float64, d) / scale).astype(np.float32)
    own = Quantizer.train(sample, cells, groups)
    cells = len(own.coarse)
    probes = min(cells, probes) if probes else needed_probes(own, sample, k, recall)
    quantizer = spark.sparkContext.broadcast(own)

    def index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        q = quantizer.value
        for batch in batches:
            x = _matrix(batch.column(3), np.float64, d) / scale
            cell, code = q.encode(x.astype(np.float32))
            yield pa.RecordBatch.from_arrays([pa.array(cell.astype(np.int32)), pa.array([c.tobytes() for c in code], pa.binary()), pa.array(q.errors(x, cell, code)), *batch.columns], ["cell", "code", "error", "c1", "c2", "id", "v"])

    placed = classes.select("c1", "c2", "id", "v").mapInArrow(index, "cell int, code binary, error double, c1 bigint, c2 bigint, id bigint, v array<double>")
    table = space.written(placed.repartitionByRange(shuffle_partitions(spark), "cell", "c1").sortWithinPartitions("cell"), "index")

    def nearest_cell(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = (_matrix(batch.column(1), np.float64, d) / scale).astype(np.float32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nearest(x, quantizer.value.coarse).astype(np.int32))], ["id", "v", "cell"])

    asked = unique.select("id", "v").withColumnRenamed("id", key).where(is_query).withColumnRenamed(key, "id")
    asked = space.written(asked.mapInArrow(nearest_cell, "id bigint, v array<double>, cell int"), "queries").orderBy("cell", "id")
    found = space.path("candidates")
    block: list[tuple[int, list[float]]] = []
    wrote = False

    def run(block: list[tuple[int, list[float]]]) -> None:
        ids, q = np.array([b[0] for b in block]), np.array([b[1] for b in block], np.float64) / scale
        who = probed(q, own.coarse, probes)
        scan = _scan(spark.sparkContext.broadcast((ids, q)), quantizer, probes, k + 1, rerank, scale)
        some = np.flatnonzero(who.any(axis=0)).tolist()
        part = table if len(some) == cells else table.where(F.col("cell").isin(some))
        best = part.mapInArrow(scan, "query_id bigint, c1 bigint, c2 bigint, id bigint, score double")
        first = Window.partitionBy("query_id").orderBy("score", "id")
        best.withColumn("n", F.row_number().over(first)).where(F.col("n") <= k + 1).select("query_id", "c1", "c2", "score").write.mode("append").parquet(found)

    for r in asked.toLocalIterator():
        block.append((r["id"], r["v"]))
        if len(block) == query_block:
            run(block)
            block, wrote = [], True
    if block:
        run(block)
    elif not wrote:
        return spark.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")

    near = spark.read.schema("query_id bigint, c1 bigint, c2 bigint, score double").parquet(found)
    near = near.join(members.select("c1", "c2", F.col("id").alias("vec_id")), ["c1", "c2"]).where("query_id != vec_id")
    final = Window.partitionBy("query_id").orderBy("score", "vec_id")
    return near.select("query_id", F.row_number().over(final).alias("rank"), "vec_id", (F.col("score") * scale).alias("score")).where(F.col("rank") <= k)


def probed(q: np.ndarray, coarse: np.ndarray, probes: int) -> np.ndarray:
    """Which cells each query probes: (queries, cells)."""
    far = distances(q.astype(np.float32), coarse)
    if probes >= far.shape[1]:
        return np.ones(far.shape, bool)
    who = np.zeros(far.shape, bool)
    np.put_along_axis(who, np.argpartition(far, probes - 1, axis=1)[:, :probes], True, axis=1)
    return who


def needed_probes(quantizer: Quantizer, sample: np.ndarray, k: int, recall: float, queries: int = 200) -> int:
    """The fewest nearest cells of a query that hold the share `recall` of its k nearest in the sample, over some sampled queries.

    All neighbours of the table are nearer than those of a sample of it, so it needs no more.
    """
    cells, at = len(quantizer.coarse), nearest(sample, quantizer.coarse)
    need = []
    for x in range(0, min(queries, len(sample))):
        q = sample[x : x + 1]
        near = np.argsort(distances(q, sample)[0], kind="stable")[: k + 1]
        order = np.empty(cells, np.int64)
        order[np.argsort(distances(q, quantizer.coarse)[0], kind="stable")] = np.arange(1, cells + 1)
        need.append(order[at[near[near != x][:k]]])
    ranks = np.sort(np.concatenate(need)) if need else np.zeros(0, np.int64)
    return int(min(cells, max(8, ranks[math.ceil(recall * len(ranks)) - 1]))) if len(ranks) else cells


def _scan(asked, quantizer, probes: int, most: int, rerank: int, scale: float):
    """The task of a search: index rows to each query's `most` nearest classes of them, exactly measured, ties to the smaller id.

    Queries and distances are in units of `scale`.  `most` is one more than the results, as the query's own class may hold no other row.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        quant, (ids, q) = quantizer.value, asked.value
        coarse = quant.coarse.astype(np.float64)
        who = probed(q, quant.coarse, probes)
        # What rounding in double precision can add to a bound, with a wide margin.
        norm, middle = np.sqrt((q * q).sum(1)), np.sqrt((coarse * coarse).sum(1))
        best: dict[int, tuple[np.ndarray, ...]] = {}
        kth = np.full(len(q), np.inf)
        for batch in batches:
            cell, error = batch.column(0).to_numpy(), batch.column(2).to_numpy()
            code = np.frombuffer(b"".join(batch.column(1).to_pylist()), np.uint8).reshape(len(cell), -1)
            c1, c2, key = (batch.column(i).to_numpy() for i in (3, 4, 5))
            x = _matrix(batch.column(6), np.float64, q.shape[1]) / scale
            for c in np.unique(cell).tolist():
                at = np.flatnonzero(cell == c)
                queries = np.flatnonzero(who[:, c])
                for lo in range(0, len(queries), 64):
                    some = queries[lo : lo + 64]
                    lut = quant.tables(q[some], c)
                    near = np.zeros((len(some), len(at)))
                    for g in range(code.shape[1]):
                        near += lut[:, g, code[at, g]]
                    near = np.sqrt(near)
                    least = near - error[at] - 1e-9 * (near + error[at] + norm[some, None] + middle[c])
                    for i, j in enumerate(some.tolist()):
                        left = np.flatnonzero(~(least[i] > kth[j]))  # a bound that isn't a number proves nothing
                        if len(left) > rerank:
                            left = left[np.argsort(least[i, left])]
                        for start in range(0, len(left), rerank):
                            part = left[start : start + rerank]
                            part = at[part[~(least[i, part] > kth[j])]]
                            # Summed in the order of the components, so that equal distances come out equal.
                            score = np.sqrt(np.cumsum((q[j] - x[part]) ** 2, axis=1)[:, -1])
                            good = score <= kth[j]
                            part = part[good]
                            if not len(part):
                                continue
                            new = (score[good], key[part], c1[part], c2[part])
                            old = best.get(j)
                            if old is not None:
                                new = tuple(np.concatenate(p) for p in zip(old, new, strict=True))
                            keep = np.lexsort((new[3], new[2], new[1], new[0]))[:most]
                            best[j] = new = tuple(p[keep] for p in new)
                            if len(keep) == most:
                                kth[j] = new[0][-1]
        for j, (score, key, c1, c2) in best.items():
            yield pa.RecordBatch.from_arrays([pa.array(np.full(len(score), ids[j])), pa.array(c1), pa.array(c2), pa.array(key), pa.array(score)], ["query_id", "c1", "c2", "id", "score"])

    return run

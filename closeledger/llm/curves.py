"""Approximate nearest neighbours by shifted space-filling curves.

Every vector is projected ``CURVES`` times onto ``DIMS`` random directions,
shifted, quantised and placed on a Hilbert curve; Spark range-partitions and
ranks each curve.  A query is compared with the vectors whose rank on some
curve is within a window of its own; the best of all windows are reranked by
their exact distance.  Windows are cut into blocks of ``BLOCK`` ranks, so that
a task holds one block of vectors and the queries that reach it.

Directions are scaled on a bounded sample (``FIT_ROWS`` vectors).  The window
is fitted to the data: at most ``PROBES`` queries are answered by brute force
in one pass, and the window is the smallest that would have found the share
``TARGET`` of their neighbours.  Data without structure need wide windows,
embeddings with some structure need narrow ones; every row is indexed.

Equal vectors are indexed once, with the smallest of their ids: as many as any
answer can use, so a vector that a third of the rows share costs one place.

Defined cases: vectors that are null, empty, zero, or hold null or non-finite
components take no part, nor do those of another length than the commonest
(the shorter of equally common ones); null ids take no part; rows repeated
with one id count once; with fewer candidates than ``k`` all are returned; an
empty table gives no rows; further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from closeledger.llm.common import arrow_map, ranked, read_table, stored
from closeledger.llm.hilbert import hilbert_index

CURVES, DIMS, CELL_BITS = 16, 8, 7
FIT_ROWS, PROBES, TARGET = 10_000, 96, 0.97
BLOCK = 2048
LEAST_WINDOW = 32


def usable(vectors: DataFrame) -> tuple[DataFrame, int]:
    """Rows (vec_id, v, key) that take part, and their length."""
    v = F.col("embedding").cast("array<double>")
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), v.alias("v")).where("vec_id is not null and size(v) > 0")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf"))) & F.exists("v", lambda x: x != 0)
    rows = rows.where(F.coalesce(fine, F.lit(False)))
    common = rows.groupBy(F.size("v").alias("d")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "d").first()
    dims = common["d"] if common else 0
    rows = rows.where(F.size("v") == dims)
    zero = F.transform("v", lambda x: F.when(x == 0, F.lit(0.0)).otherwise(x))  # -0.0 equals 0.0
    return rows.withColumn("v", zero).withColumn("key", F.xxhash64("v")), dims


def _matrix(batch: pa.RecordBatch, dims: int, column: str = "v") -> np.ndarray:
    return batch.column(column).flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)


def _nearest(query: np.ndarray, candidates: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Places and exact distances of the k nearest, and all that tie."""
    apart = candidates - query
    squares = np.einsum("ij,ij->i", apart, apart)
    if len(squares) > k:
        places = np.flatnonzero(squares <= np.partition(squares, k - 1)[k - 1])
    else:
        places = np.arange(len(squares))
    return places, np.sqrt(squares[places])


def _best(found: DataFrame, k: int, by: str) -> DataFrame:
    """The k nearest distinct candidates (c) of each query (q)."""
    once = found.groupBy("q", "c").agg(F.min("distance").alias("distance"), F.min("first_id").alias("first_id"))
    place = F.row_number().over(Window.partitionBy("q").orderBy("distance", "first_id", "c"))
    return once.withColumn(by, place).where(F.col(by) <= k)


def _brute(nodes: DataFrame, probes: list, dims: int, k: int) -> DataFrame:
    """Exact k nearest nodes (q, c) of the probe rows, in one pass."""
    shared = nodes.sparkSession.sparkContext.broadcast(([r["key"] for r in probes], np.array([r["v"] for r in probes])))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, queries = shared.value
        for batch in batches:
            matrix, own = _matrix(batch, dims), batch.column("key").to_numpy()
            out = []
            for key, query in zip(keys, queries, strict=True):
                places, distance = _nearest(query, matrix, k)
                out.append((np.full(len(places), key), own[places], distance, batch.column("first_id").to_numpy()[places]))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(c)) for c in zip(*out, strict=True)], names=["q", "c", "distance", "first_id"])

    return _best(arrow_map(nodes.select("key", "v", "first_id"), search, "q long, c long, distance double, first_id long"), k, "place")


def neighbours(vectors: DataFrame, queries: DataFrame, k: int = 10, window: int | None = None) -> DataFrame:
    """query_id, rank, vec_id, score of the k nearest of every query id.
    ``queries`` holds vec_id, some of the ids of ``vectors``."""
    spark = vectors.sparkSession
    rows, dims = usable(vectors)
    rows = stored(rows.dropDuplicates(["vec_id", "key"]), "vectors")
    empty = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    asked = rows.join(queries.select(F.col("vec_id").cast("long").alias("vec_id")).distinct(), "vec_id", "left_semi")
    # equal vectors: the k + 1 smallest ids, cut in every task before they meet
    few = F.row_number().over(Window.partitionBy("key").orderBy("vec_id"))
    nodes = rows.withColumn("place", few).where(F.col("place") <= k + 1).groupBy("key")
    nodes = nodes.agg(F.first("v").alias("v"), F.min("vec_id").alias("first_id"), F.sort_array(F.collect_list("vec_id")).alias("ids"))
    nodes = stored(nodes.join(asked.select("key").distinct().withColumn("asked", F.lit(True)), "key", "left"), "nodes")

    sample = nodes.orderBy(F.xxhash64("key", F.lit(1))).limit(FIT_ROWS).select("v").toArrow()["v"]
    if not len(sample):
        return empty
    sample = np.array(sample.to_pylist())
    rng = np.random.default_rng(11)
    directions = rng.normal(size=(CURVES, dims, DIMS)) / np.sqrt(dims)
    shifts = rng.uniform(-0.5, 0.5, (CURVES, DIMS))
    seen = sample @ directions
    middle, spread = seen.mean(axis=1), seen.std(axis=1) + 1e-12

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = 1 << CELL_BITS
        for batch in batches:
            matrix, key = _matrix(batch, dims), batch.column("key")
            for curve in range(CURVES):
                at = (matrix @ directions[curve] - middle[curve]) / spread[curve] + shifts[curve]
                grid = np.clip((at / 8 + 0.5) * cells, 0, cells - 1).astype(np.int64)
                columns = [pa.array(np.full(len(key), curve, np.int32)), pa.array(hilbert_index(grid, CELL_BITS)), key]
                yield pa.RecordBatch.from_arrays(columns, names=["curve", "at", "key"])

    placed = arrow_map(nodes.select("key", "v"), place, "curve int, at long, key long")
    placed, total = ranked(placed, ["curve", "at", "key"], "r", "curves")
    placed = placed.select("curve", "key", (F.col("r") - F.col("curve") * (total // CURVES)).alias("r"))

    if window is None:
        probes = nodes.where("asked").orderBy(F.xxhash64("key", F.lit(2))).limit(PROBES).select("key", "v").collect()
        if not probes:
            return empty
        true = stored(_brute(nodes, probes, dims, k + 1).select("q", "c"), "probes")
        ends = [placed.select("curve", F.col("key").alias(s), F.col("r").alias(f"{s}_r")) for s in ("q", "c")]
        gaps = true.join(F.broadcast(true.select("q").distinct().join(ends[0], "q")), "q").join(ends[1], ["curve", "c"])
        gaps = gaps.groupBy("q", "c").agg(F.min(F.abs(F.col("q_r") - F.col("c_r"))).alias("gap")).where("q <> c")
        window = int(gaps.agg(F.percentile("gap", TARGET)).first()[0] or 0)
    window = max(window, LEAST_WINDOW)

    with_vectors = placed.join(nodes.select("key", "v", "first_id", "asked"), "key")
    block = F.floor(F.col("r") / BLOCK).cast("long")
    columns = ["curve", "key", "r", "v", "first_id"]
    own = with_vectors.select(*columns, block.alias("block"), F.lit(False).alias("query"))
    reach = F.sequence(F.floor((F.col("r") - window) / BLOCK).cast("long"), F.floor((F.col("r") + window) / BLOCK).cast("long"))
    wanted = with_vectors.where("asked").select(*columns, F.explode(reach).alias("block"), F.lit(True).alias("query"))

    def rerank(table: pa.Table) -> pa.Table:
        query = table.column("query").to_numpy()
        r, key, first = (table.column(c).to_numpy() for c in ("r", "key", "first_id"))
        matrix = np.concatenate([_matrix(b, dims) for b in table.to_batches()])
        candidates = np.flatnonzero(~query)
        candidates = candidates[np.argsort(r[candidates], kind="stable")]
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0), np.zeros(0, np.int64))]
        for i in np.flatnonzero(query).tolist():
            low, high = np.searchsorted(r[candidates], [r[i] - window, r[i] + window + 1])
            near = candidates[low:high]
            if len(near):
                places, distance = _nearest(matrix[i], matrix[near], k + 1)
                near = near[places]
                out.append((np.full(len(near), key[i]), key[near], distance, first[near]))
        return pa.table([np.concatenate(c) for c in zip(*out, strict=True)], names=["q", "c", "distance", "first_id"])

    found = own.unionByName(wanted).groupBy("curve", "block").applyInArrow(rerank, "q long, c long, distance double, first_id long")
    best = _best(found, k + 1, "place").join(nodes.select(F.col("key").alias("c"), "ids"), "c")
    best = best.select("q", "distance", F.explode("ids").alias("vec_id"))
    order = Window.partitionBy("q").orderBy("distance", "vec_id")
    best = best.withColumn("place", F.row_number().over(order)).where(F.col("place") <= k + 1)
    answers = asked.select(F.col("vec_id").alias("query_id"), F.col("key").alias("q")).join(best, "q").where("query_id <> vec_id")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy("distance", "vec_id")).cast("int")
    answers = answers.withColumn("rank", rank).where(F.col("rank") <= k)
    return answers.select("query_id", "rank", "vec_id", F.col("distance").alias("score"))


def op5_curve_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest found for every vector whose id is divisible by 100."""
    vectors = read_table(spark, sf_dir, "embeddings")
    return neighbours(vectors, vectors.where("vec_id % 100 = 0").select("vec_id"))

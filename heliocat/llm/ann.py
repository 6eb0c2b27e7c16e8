"""Approximate nearest neighbours with an inverted multi-index.

Both halves of a vector are quantised on their own; a pair of centroids is a cell. A query
walks the cells by the sum of its two half distances, with a heap, until they hold enough
entries; these are reranked by their exact distance. Every row is in the index; only the
centroids are learned from a bounded sample (SAMPLE rows and SAMPLE_FLOATS numbers).

Cells and queries meet in a shuffle by the first half's centroid (a band of cells); a query
carries the list of its cells there. Bands are cut into blocks on both sides, so neither a
crowded band nor one that many queries visit is one group.

Defined results. Vectors that are null, empty, all zero or hold null or non-finite numbers take
no part, nor do rows without an id and vectors whose length is not the most common one (ties:
the shorter). Rows that share an id are candidates each, and never of a query of that id, which
is asked once, with the least of its vectors. Equal distances rank by id. With fewer
candidates than ``k`` all are returned; an empty table gives an empty result. Other columns
are ignored.
"""

from __future__ import annotations

import heapq

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import written

SAMPLE, SAMPLE_FLOATS = 20_000, 4_000_000
#: Share of all rows a query reranks, and the least number; see the README for the recall.
PROBE, PROBE_LEAST = 0.45, 3000
#: Entries of a cell on average, and the most centroids of a half.
CELL_ROWS, MOST_CENTROIDS = 3, 256
BLOCK_VECTORS, BLOCK_QUERIES = 4000, 2000
#: Walks of a task, until there are MOST_TASKS such tasks.
WALKS, MOST_TASKS = 50, 4096


def usable(df: DataFrame, vector: str, key: str) -> DataFrame:
    """vec_id and vec (doubles) of the rows that take part."""
    rows = df.select(F.col(key).cast("long").alias("vec_id"), F.col(vector).cast("array<double>").alias("vec"))
    rows = rows.where(
        "vec_id IS NOT NULL AND vec IS NOT NULL AND exists(vec, x -> x <> 0) AND "
        "NOT exists(vec, x -> x IS NULL OR isnan(x) OR abs(x) = double('infinity'))"
    )
    sizes = rows.groupBy(F.size("vec").alias("s")).agg(F.count("*").alias("n")).orderBy(F.desc("n"), "s").first()
    return rows.where(F.size("vec") == (sizes["s"] if sizes else 0))


def centroids(points: np.ndarray, k: int, rounds: int = 10, seed: int = 1) -> np.ndarray:
    """Lloyd's iterations from random distinct points."""
    distinct = np.unique(points, axis=0)
    rng = np.random.default_rng(seed)
    centres = distinct[rng.permutation(len(distinct))[:k]]
    for _ in range(rounds):
        near = nearest(points, centres)
        sums = np.zeros_like(centres)
        np.add.at(sums, near, points)
        counts = np.bincount(near, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def squared(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return (points**2).sum(1)[:, None] - 2 * points @ centres.T + (centres**2).sum(1)[None]


def nearest(points: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return squared(points, centres).argmin(axis=1)


def walk(left: np.ndarray, right: np.ndarray, counts: np.ndarray, wanted: int) -> list[int]:
    """Cells by summed half distance until they hold ``wanted`` entries; empty cells are left out."""
    rows, cols = np.argsort(left, kind="stable"), np.argsort(right, kind="stable")
    heap, out, held = [(left[rows[0]] + right[cols[0]], 0, 0)], [], 0
    while heap and held < wanted:
        _, i, j = heapq.heappop(heap)
        if n := counts[rows[i], cols[j]]:
            out.append(int(rows[i]) * len(right) + int(cols[j]))
            held += n
        # each pair is pushed once: to the right always, downward only from the first column
        if j + 1 < len(right):
            heapq.heappush(heap, (left[rows[i]] + right[cols[j + 1]], i, j + 1))
        if j == 0 and i + 1 < len(left):
            heapq.heappush(heap, (left[rows[i + 1]] + right[cols[0]], i + 1, 0))
    return out


def search(
    df: DataFrame,
    k: int = 10,
    every: int = 100,
    vector: str = "embedding",
    key: str = "vec_id",
    probe: float = PROBE,
    probe_least: int = PROBE_LEAST,
) -> DataFrame:
    """query_id, rank, vec_id, score (Euclidean distance) for queries whose id is divisible by ``every``."""
    spark = df.sparkSession
    rows = written(usable(df, vector, key))
    empty = "query_id long, rank int, vec_id long, score double"
    first = rows.select("vec").first()
    if first is None:
        return spark.createDataFrame([], empty)
    size, n = len(first["vec"]), rows.count()
    half = (size + 1) // 2
    bound = max(1, min(SAMPLE, SAMPLE_FLOATS // size))
    # by a bound on a uniform hash, so that what is sent does not grow with the tasks
    limit = int(min(1.0, bound / n) * 2.0**64) - (1 << 63) - 1
    sample = rows.select("vec", F.xxhash64("vec_id", "vec").alias("h")).where(F.col("h") <= F.lit(limit)).collect()
    points = np.array([r["vec"] for r in sorted(sample, key=lambda r: (r["h"], r["vec"]))[:bound]])
    wide = int(min(MOST_CENTROIDS, max(1, round((n / CELL_ROWS) ** 0.5))))
    halves = [centroids(points[:, :half], wide), centroids(points[:, half:], wide)]
    model = spark.sparkContext.broadcast(halves)

    def place(batches):
        a, b = model.value
        for batch in batches:
            v = np.array(batch["vec"].flatten()).reshape(-1, size)
            out = batch.append_column("band", pa.array(nearest(v[:, :half], a).astype(np.int32)))
            yield out.append_column("col", pa.array(nearest(v[:, half:], b).astype(np.int32)))

    index = written(rows.mapInArrow(place, "vec_id long, vec array<double>, band int, col int"))
    counts = np.zeros((len(halves[0]), len(halves[1])), np.int64)
    for r in index.groupBy("band", "col").agg(F.count("*").alias("n")).collect():  # one row per cell
        counts[r["band"], r["col"]] = r["n"]
    held = spark.sparkContext.broadcast(counts)
    wanted = max(probe_least, int(np.ceil(probe * n)))

    def visit(batches):
        a, b = model.value
        for batch in batches:
            v = np.array(batch["vec"].flatten()).reshape(-1, size)
            left, right = squared(v[:, :half], a), squared(v[:, half:], b)
            found = []
            for i, (x, y) in enumerate(zip(left, right)):
                band, col = np.divmod(np.sort(walk(x, y, held.value, wanted)), len(b))
                bands, start = np.unique(band, return_index=True)
                found += [(i, k, c.tolist()) for k, c in zip(bands.tolist(), np.split(col, start[1:]))]
            row = pa.array([x[0] for x in found], pa.int64())
            yield pa.record_batch(
                {
                    "band": pa.array([x[1] for x in found], pa.int32()),
                    "cols": pa.array([x[2] for x in found], pa.list_(pa.int32())),
                    "query_id": batch["vec_id"].take(row),
                    "query": batch["vec"].take(row),
                }
            )

    queries = rows.where(F.col("vec_id") % every == 0).groupBy("vec_id").agg(F.min("vec").alias("vec"))
    schema = "band int, cols array<int>, query_id long, query array<double>"
    queries = written(queries)
    # by a count of its own, so that adaptive execution does not put all walks into one task
    tasks = min(MOST_TASKS, -(-queries.count() // WALKS) or 1)
    visits = written(queries.repartition(tasks, "vec_id").mapInArrow(visit, schema))
    in_band = {i: int(c) for i, c in enumerate(counts.sum(axis=1)) if c}
    asked = {r["band"]: r["m"] for r in visits.groupBy("band").agg(F.count("*").alias("m")).collect()}
    parts = [(i, -(-c // BLOCK_VECTORS), -(-asked[i] // BLOCK_QUERIES)) for i, c in in_band.items() if i in asked]
    blocks = F.broadcast(spark.createDataFrame(parts, "band int, v_parts int, q_parts int"))  # one row per band
    vectors = index.join(blocks, "band").select(
        "band", "col", "vec_id", "vec",
        F.pmod(F.xxhash64("vec_id", "vec"), "v_parts").cast("int").alias("v_part"),
        F.explode(F.sequence(F.lit(0), F.col("q_parts") - 1)).alias("q_part"),
    )
    asks = visits.join(blocks, "band").select(
        "band", "cols", "query_id", "query",
        F.pmod(F.xxhash64("query_id"), "q_parts").cast("int").alias("q_part"),
        F.explode(F.sequence(F.lit(0), F.col("v_parts") - 1)).alias("v_part"),
    )

    def rerank(entries: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        out = []
        if len(entries) and len(asked):
            entries = entries.sort_values("col", kind="stable")
            v, ids, col = np.stack(entries["vec"].to_numpy()), entries["vec_id"].to_numpy(), entries["col"].to_numpy()
            for q_id, q, cols in zip(asked["query_id"].to_numpy(), asked["query"].to_numpy(), asked["cols"]):
                at = np.flatnonzero(np.isin(col, cols) & (ids != q_id))
                d = np.sqrt(((v[at] - q) ** 2).sum(axis=1))
                best = _least(d, ids[at], k)
                out.append((np.full(len(best), q_id), ids[at[best]], d[best]))
        columns = [np.concatenate(x) for x in zip(*out)] if out else [[], [], []]
        return pd.DataFrame(dict(zip(("query_id", "vec_id", "score"), columns)))

    on = ["band", "v_part", "q_part"]
    found = vectors.groupBy(*on).cogroup(asks.groupBy(*on)).applyInPandas(
        rerank, "query_id long, vec_id long, score double"
    )
    return found.withColumn(
        "rank", F.expr("row_number() OVER (PARTITION BY query_id ORDER BY score, vec_id)")
    ).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _least(d: np.ndarray, ids: np.ndarray, k: int) -> np.ndarray:
    """Places of the k least by (d, id); all places tied with the last are looked at."""
    near = np.flatnonzero(d <= np.partition(d, k - 1)[k - 1]) if len(d) > k else np.arange(len(d))
    return near[np.lexsort((ids[near], d[near]))[:k]]

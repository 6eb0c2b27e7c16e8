"""What the operators share: written tables, hot-key joins, Arrow batches, spans."""

from __future__ import annotations

import ctypes
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, functions as F

#: Bytes of text that Python code works on at a time.
SLICE_BYTES = 2 << 20
#: A key with more than this share of the rows is hot; so there are fewer than 1 / HOT_SHARE such keys.
HOT_SHARE = 0.002
#: Below this many rows a key is never hot.
HOT_ROWS = 2000


def shared_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``; where that is unset, only a local session gets one."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="heliocat-")
        spark.conf.set("spark.checkpoint.dir", shared)
    return f"{shared.rstrip('/')}/llm-{uuid.uuid4()}"


def written(df: DataFrame) -> DataFrame:
    """The frame as a table in the shared folder, so a lost executor costs no more than its tasks."""
    path = shared_folder(df.sparkSession)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Rows that travel to a Python worker at once; Spark's default is made for short rows.
BATCH_ROWS = 1000


def in_small_batches(docs: DataFrame) -> DataFrame:
    """Limits the session's Arrow batches to BATCH_ROWS rows, as texts are long."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(docs.sparkSession.conf.get(name, "10000")) <= BATCH_ROWS:
        docs.sparkSession.conf.set(name, BATCH_ROWS)
    return docs


def documents(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """``doc_id`` and ``text`` only, whatever else the frame holds; a null text is empty."""
    return in_small_batches(docs).select(
        F.col(key).cast("long").alias("doc_id"),
        F.coalesce(F.col(text).cast("string"), F.lit("")).alias("text"),
    )


def content_key() -> list[Column]:
    """128 bits that are equal for rows equal in ``doc_id`` and ``text``; needs no stored row number."""
    return [
        F.xxhash64("doc_id", "text").alias("key_a"),
        F.xxhash64("text", F.lit(1), "doc_id").alias("key_b"),
    ]


KEY = ["key_a", "key_b"]


def attach(rows: DataFrame, facts: DataFrame, on: list[str], count: str = "n") -> DataFrame:
    """Inner join of ``rows`` with one fact row per key, safe for keys that hold much of ``rows``.

    ``count`` in ``facts`` is the number of rows of the key. Keys above HOT_SHARE of all rows
    number under 1 / HOT_SHARE; only those facts are broadcast, so their rows are not shuffled.
    """
    total = facts.agg(F.sum(count)).first()[0] or 0
    limit = max(HOT_ROWS, total * HOT_SHARE)
    if total <= limit:
        return rows.join(facts, on)
    hot = facts.where(F.col(count) > limit)
    if hot.isEmpty():
        return rows.join(facts, on)
    names = [c for c in facts.columns if c not in on]
    out = [*rows.columns, *names]
    marks = F.broadcast(hot.select(*on, F.struct(*names).alias("_hot")))
    marked = rows.join(marks, on, "left")
    first = marked.where("_hot IS NOT NULL").select(
        *rows.columns, *[F.col(f"_hot.{c}").alias(c) for c in names]
    )
    rest = marked.where("_hot IS NULL").drop("_hot")
    return first.select(*out).unionByName(
        rest.join(facts.where(F.col(count) <= limit), on).select(*out)
    )


def rows_of(docs: DataFrame, kept: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """One row of ``docs``, with all its columns, for each row of ``kept`` (doc_id, sha: the text's SHA-256).

    Of rows equal in id and text the one stays whose other columns come first as JSON; an empty
    text stands before a null one.
    """
    no_id, on = F.lit(-(1 << 63)), ["id", "sha"]  # stands for a null id
    kept = kept.select(F.coalesce("doc_id", no_id).alias("id"), "sha")
    # the row's own columns are one, so that their names cannot clash
    marked = docs.select(
        F.coalesce(F.col(key).cast("long"), no_id).alias("id"),
        F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")), 256).alias("sha"),
        F.struct(*docs.columns).alias("row"),
    )
    left = marked.join(kept, on, "left_semi")
    # such rows are rare
    twins = written(marked.groupBy(*on).agg(F.count("*").alias("n")).where("n > 1").drop("n"))
    if twins.isEmpty():
        return left.select("row.*")
    others = F.to_json(F.struct(*[F.col("row")[c].alias(c) for c in docs.columns if c != text]))
    place = F.struct(others, F.col("row")[text].isNull())
    one = left.join(twins, on, "left_semi").groupBy(*on).agg(F.min_by("row", place).alias("row"))
    return left.join(twins, on, "left_anti").select("row.*").unionByName(one.select("row.*"))


def slices(batches: Iterator[pa.RecordBatch], column: str = "text") -> Iterator[pa.RecordBatch]:
    """Batches cut so that each holds about SLICE_BYTES of the column, or a single row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = np.asarray(pc.binary_length(batch[column]).fill_null(0)).astype(np.int64)
        block = (np.cumsum(sizes) - sizes) // SLICE_BYTES
        cuts = np.flatnonzero(np.diff(block)) + 1
        for a, b in zip([0, *cuts], [*cuts, batch.num_rows]):
            yield batch.slice(a, b - a)


def per_batch(
    work: Callable[[pa.RecordBatch], pa.RecordBatch | None], column: str = "text"
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` that applies ``work`` to bounded slices."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for part in slices(batches, column):
                out = work(part)
                if out is not None and out.num_rows:
                    yield out
        finally:
            give_back()

    return run


def give_back() -> None:
    """Free memory to the system: a worker stays for the tasks of other stages."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # another C library than glibc
        pass


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column one after another, and the offsets of its rows."""
    column = column.cast(pa.large_binary()) if not pa.types.is_large_binary(column.type) else column
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1), modulo 2 ** 64."""
    out = np.full(n, base, np.uint64)
    if n:
        out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads 64-bit values over all bits."""
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2 ** 64
INVERSE = pow(BASE, -1, 1 << 64)


_kept = [powers(BASE, 1), powers(INVERSE, 1)]


def _tables(n: int) -> list[np.ndarray]:
    """Powers of the base and its inverse, at least n + 1; kept, as slices are of like size."""
    if len(_kept[0]) <= n:
        size = 1 << (n + 1).bit_length()
        _kept[:] = powers(BASE, size), powers(INVERSE, size)
    return _kept


def range_hashes(values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of values[start:end] for each pair; equal content gives equal hashes."""
    n = len(values)
    ahead, back = _tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum((values.astype(np.uint64) + np.uint64(1)) * ahead[:n], out=sums[1:])
    return mix((sums[end] - sums[start]) * back[start] + (end - start).astype(np.uint64))


def smallest_hashes(rows: DataFrame, key: str, hash_: str, most: int) -> DataFrame:
    """At most ``most`` rows of each key, those of smallest ``hash_`` (a uniform 64-bit hash).

    ``key`` has few values. A bound on the hash, from the key's count, leaves a few times
    ``most`` rows before they are ranked, so a key with much of the rows meets in no task.
    """
    share = F.least(F.lit(1.0), F.lit(4.0 * most) / F.col("_n"))
    bound = (share * (2.0**64) - 2.0**63).alias("_bound")
    bounds = rows.groupBy(key).agg(F.count("*").alias("_n")).select(key, bound)
    few = rows.join(F.broadcast(bounds), key).where(F.col(hash_) <= F.col("_bound")).drop("_bound")
    ranked = few.withColumn("_rank", F.expr(f"row_number() OVER (PARTITION BY `{key}` ORDER BY `{hash_}`)"))
    return ranked.where(F.col("_rank") <= most).drop("_rank")


def lists(values: np.ndarray, lengths: np.ndarray, kind: pa.DataType) -> pa.Array:
    """A list column from its values one after another and each row's length."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, kind))


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of True."""
    edge = np.diff(np.concatenate([[0], mask.view(np.int8), [0]]))
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def union(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sorted maximal runs of the union of half-open ranges; ranges that touch become one."""
    if not len(starts):
        return starts, ends
    order = np.argsort(starts, kind="stable")
    starts, reach = starts[order], np.maximum.accumulate(ends[order])
    first = np.concatenate([[True], starts[1:] > reach[:-1]])
    return starts[first], reach[np.concatenate([first[1:], [True]])]

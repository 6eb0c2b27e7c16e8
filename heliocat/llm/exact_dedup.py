"""Exact duplicates by content-defined chunk recipes.

A text is cut where a rolling hash of its last 32 bytes has its low bits zero, so equal
stretches give equal chunks. A chunk's identifier is its 64-bit hash, verified: all chunks
meet by hash once, and where one hash stands for several contents each content gets an
identifier of its own. A text's recipe is its ordered list of identifiers; texts are equal
when length and recipe are equal. After the one pass over the chunks only recipes move.

Defined results. A null text counts as empty; all empty texts are one group. Of a group the
row with the largest ``doc_id`` stays (a null id is smaller than any); of equal rows with
that id exactly one stays. An empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import attach, documents, lists, per_batch, rows_of, text_bytes, written

#: Bytes of a chunk: never under MIN_CHUNK (but at a text's end), MEAN_CHUNK more on average, at most MAX_CHUNK.
MIN_CHUNK, MEAN_CHUNK, MAX_CHUNK = 256, 2048, 16384
_GEAR = np.random.default_rng(20240901).integers(0, 1 << 32, 256, dtype=np.uint32)


def _rolling(data: np.ndarray) -> np.ndarray:
    """For each byte, a 32-bit hash of it and the 31 bytes before."""
    h = _GEAR[data]
    for width in (1, 2, 4, 8, 16):
        shifted = h[:-width] << np.uint32(width)
        h[width:] += shifted
    return h


def chunk_ends(data: np.ndarray, offsets: np.ndarray) -> list[list[int]]:
    """For each row, the ends of its chunks as places in ``data``."""
    marks = np.flatnonzero(_rolling(data) >> np.uint32(32 - (MEAN_CHUNK - 1).bit_length()) == 0) + 1
    found = []
    bounds = np.searchsorted(marks, offsets)
    for row in range(len(offsets) - 1):
        at, stop, ends = int(offsets[row]), int(offsets[row + 1]), []
        for mark in [*marks[bounds[row] : bounds[row + 1]].tolist(), stop]:
            while mark - at > MAX_CHUNK:
                at += MAX_CHUNK
                ends.append(at)
            if mark - at >= MIN_CHUNK or mark == stop and mark > at:
                ends.append(mark)
                at = mark
        found.append(ends)
    return found


def _chunks(batch: pa.RecordBatch, bits: int):
    data, offsets = text_bytes(batch["text"])
    ends = chunk_ends(data, offsets)
    raw, keep = data.tobytes(), (1 << bits) - 1
    for row, stops in enumerate(ends):
        at = int(offsets[row])
        for stop in stops:
            chunk = raw[at:stop]
            at = stop
            yield row, xxhash.xxh3_64_intdigest(chunk) & keep, chunk


def _signed(values) -> np.ndarray:
    return np.array(values, np.uint64).astype(np.int64)


def recipes(docs: DataFrame, bits: int = 64) -> DataFrame:
    """doc_id, n_bytes, recipe (chunk hashes in order), text_sha256; one row per input row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, ids = [], []
        for row, h, _ in _chunks(batch, bits):
            rows.append(row)
            ids.append(h)
        lengths = np.bincount(np.array(rows, np.int64), minlength=batch.num_rows)
        texts = batch["text"].cast(pa.binary()).to_pylist()
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "n_bytes": pa.array([len(x) for x in texts], pa.int64()),
                "recipe": lists(_signed(ids), lengths, pa.int64()),
                "text_sha256": pa.array([hashlib.sha256(x).hexdigest() for x in texts]),
            }
        )

    return docs.mapInArrow(
        per_batch(work), "doc_id long, n_bytes long, recipe array<long>, text_sha256 string"
    )


def _chunk_rows(docs: DataFrame, bits: int) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = {(h, chunk) for _, h, chunk in _chunks(batch, bits)}
        return pa.record_batch(
            {
                "id": pa.array(_signed([h for h, _ in found])),
                "chunk": pa.array([c for _, c in found], pa.binary()),
            }
        )

    return docs.mapInArrow(per_batch(work), "id long, chunk binary")


def _verified(docs: DataFrame, table: DataFrame, bits: int) -> DataFrame:
    """Recipes in which each identifier stands for one content."""
    distinct = _chunk_rows(docs, bits).groupBy("id", "chunk").agg(F.count("*").alias("n"))
    shared = distinct.groupBy("id").agg(F.count("*").alias("n")).where("n > 1").select("id")
    shared = written(shared)
    if shared.isEmpty():
        return table
    # Contents that share a hash: number them, and put the number of the content into the recipe.
    # A recipe holds hashes only, so the documents' chunks with such a hash are read again.
    clashing = _clashes(docs, bits).join(shared, "id")
    numbers = clashing.select("id", "chunk").distinct()
    numbers = numbers.withColumn("no", F.expr("row_number() OVER (PARTITION BY id ORDER BY chunk)"))
    fixes = (
        clashing.join(numbers, ["id", "chunk"])
        .groupBy("text_sha256")
        .agg(F.map_from_entries(F.collect_set(F.struct("at", "no"))).alias("fixes"))
    )
    numbered = F.transform(
        "recipe", lambda h, i: F.array(h, F.coalesce(F.col("fixes")[i.cast("int")], F.lit(0)).cast("long"))
    )
    plain = F.transform("recipe", lambda h: F.array(h, F.lit(0).cast("long")))
    joined = table.join(fixes, "text_sha256", "left")
    return joined.withColumn(
        "recipe", F.flatten(F.when(F.col("fixes").isNotNull(), numbered).otherwise(plain))
    ).drop("fixes")


def _clashes(docs: DataFrame, bits: int) -> DataFrame:
    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        names = [hashlib.sha256(x).hexdigest() for x in batch["text"].cast(pa.binary()).to_pylist()]
        out, at, last = [], 0, -1
        for row, h, chunk in _chunks(batch, bits):
            at = at + 1 if row == last else 0
            last = row
            out.append((names[row], at, h, chunk))
        return pa.record_batch(
            {
                "text_sha256": pa.array([x[0] for x in out], pa.string()),
                "at": pa.array([x[1] for x in out], pa.int32()),
                "id": pa.array(_signed([x[2] for x in out])),
                "chunk": pa.array([x[3] for x in out], pa.binary()),
            }
        )

    return docs.mapInArrow(per_batch(work), "text_sha256 string, at int, id long, chunk binary")


def exact_groups(docs: DataFrame, text: str = "text", key: str = "doc_id", bits: int = 64) -> DataFrame:
    """One row per input row: doc_id, n_bytes, text_sha256, keep_id, group_size, kept.

    ``bits`` shortens the chunk hashes, for tests of hashes that clash.
    """
    docs = documents(docs, text, key)
    table = recipes(docs, bits)
    # the row number tells equal rows apart; it is fixed once the table is written
    table = written(table.withColumn("row_no", F.monotonically_increasing_id()))
    table = _verified(docs, table, bits)
    same = ["n_bytes", "recipe"]
    groups = table.groupBy(*same).agg(
        F.max(F.struct("doc_id", "row_no")).alias("best"), F.count("*").alias("n")
    )
    # the recipe's own identifier, again verified: only if it is unique does it replace the list
    groups = written(groups.withColumn("fold", F.xxhash64(*same)))
    if groups.groupBy("fold").agg(F.count("*").alias("c")).where("c > 1").isEmpty():
        table, groups, on = table.withColumn("fold", F.xxhash64(*same)), groups.drop(*same), ["fold"]
    else:
        groups, on = groups.drop("fold"), same
    joined = attach(table, groups, on)
    return joined.select(
        "doc_id",
        "n_bytes",
        "text_sha256",
        F.col("best.doc_id").alias("keep_id"),
        F.col("n").alias("group_size"),
        (F.col("row_no") == F.col("best.row_no")).alias("kept"),
    )


def drop_copies(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The rows that stay, with all their columns."""
    kept = exact_groups(docs, text, key).where("kept")
    return rows_of(docs, kept.select("doc_id", F.col("text_sha256").alias("sha")), text, key)

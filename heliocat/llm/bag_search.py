"""Ranked lexical search that scores equal bags of words once.

A score depends on a document only by its counts of the items' terms and by its length number
``m``. So documents are cut to the items' vocabulary first. Those with equal counts and equal
``m`` form a class: rows meet by a 64-bit hash, and the group key holds the counts and ``m`` too,
so rows whose hashes clash stay apart. A class is scored once, for all items whose terms it
holds; then its members take the score, least ``doc_id`` first. A class never needs more members
than an item has places.

Items are taken in blocks of bounded vocabulary; a block reads the documents once. What is
broadcast is one block: its terms, and which items hold them. Counts of documents per term are
added up in each task first; one number per term comes to the driver.

Defined results. Only A-Z are lower-cased. A null text has no term; a document without terms is
neither counted nor found. Equal scores are ranked by ``doc_id``, a null one last; equal rows each
take a place. Each row of the items is an item, also where ids repeat or are null; one without
terms, or empty tables, give no rows. Other columns are ignored.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window, functions as F

from .common import documents, give_back, slices, written

#: Bounds of a block of items: terms that it adds up to, repeats not counted, and items.
BLOCK_TERMS, BLOCK_ITEMS = 1 << 16, 4096
#: Scores held at once, and bytes of a text that are cut into terms at once.
_SCORES, _PIECE = 1 << 22, 1 << 20
_TERM_BYTES = [*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]
_SHOWN = bytes(b if b in _TERM_BYTES else 0x20 for b in range(256)).lower()


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text, in order, some at a time: letters, digits and all beyond ASCII."""
    shown = text.translate(_SHOWN)
    at = 0
    while at < len(shown):
        stop = shown.find(b" ", at + _PIECE)
        stop = len(shown) if stop < 0 else stop
        yield shown[at:stop].split()
        at = stop


@dataclass
class Block:
    """Some items: the number of each term, and for each term the items that hold it, and how often."""

    ids: list[int | None]
    term: dict[bytes, int]
    starts: np.ndarray
    items: np.ndarray
    times: np.ndarray


def _block(rows: list[tuple[int | None, Counter]]) -> Block:
    term = {t: i for i, t in enumerate(sorted(set().union(*(c for _, c in rows))))}
    holds = sorted((term[t], i, n) for i, (_, c) in enumerate(rows) for t, n in c.items())
    of, items, times = (np.array(x, np.int64) for x in zip(*holds))
    return Block([i for i, _ in rows], term, np.searchsorted(of, np.arange(len(term) + 1)), items, times)


def blocks(items: DataFrame, text: str, key: str) -> Iterator[Block]:
    """The items in blocks; the driver holds one of them."""
    rows: list[tuple[int | None, Counter]] = []
    held: set[bytes] = set()
    for item in documents(items, text, key).toLocalIterator():
        count = Counter(t for part in terms(item["text"].encode()) for t in part)
        if not count:
            continue
        if rows and (len(rows) >= BLOCK_ITEMS or len(held | count.keys()) > BLOCK_TERMS):
            yield _block(rows)
            rows, held = [], set()
        rows.append((item["doc_id"], count))
        held |= count.keys()
    if rows:
        yield _block(rows)


def _bag(ids: np.ndarray, tf: np.ndarray) -> bytes:
    """Sorted term numbers and their counts; equal bags give equal bytes."""
    small = int(tf.max(initial=0)) < 256
    return bytes([small]) + ids.astype("<u4").tobytes() + tf.astype(np.uint8 if small else "<i8").tobytes()


def _unbag(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    wide = 1 if raw[0] else 8
    n = (len(raw) - 1) // (4 + wide)
    ids = np.frombuffer(raw, "<u4", n, 1)
    return ids, np.frombuffer(raw, np.uint8 if raw[0] else "<i8", n, 1 + 4 * n)


def _bags(term: dict[bytes, int]):
    """Documents to (doc_id, n, bag), and behind a task's last one its counts of documents per term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        df = np.zeros(len(term), np.int64)
        for batch in slices(batches):
            ns, bags = [], []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                n, found = 0, []
                for part in terms(text):
                    n += len(part)
                    found += [term[t] for t in part if t in term]
                ids, tf = np.unique(np.array(found, np.int64), return_counts=True)
                df[ids] += 1
                ns.append(n)
                bags.append(_bag(ids, tf) if len(ids) else None)
            none = pa.nulls(len(ns), pa.list_(pa.int64()))
            yield pa.record_batch(
                {"doc_id": batch["doc_id"], "n": pa.array(ns, pa.int64()), "bag": pa.array(bags, pa.binary()), "df": none}
            )
        last = {"doc_id": [None], "n": [None], "bag": [None], "df": [df]}
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.list_(pa.int64()))
        yield pa.record_batch({c: pa.array(v, k) for (c, v), k in zip(last.items(), kinds)})
        give_back()

    return run


class _Best:
    """The best classes of each item among those that a task has seen."""

    def __init__(self, items: int, k: int):
        self.k = k
        self.found: list[list] = [[] for _ in range(items)]
        self.least = np.ones(items, np.int64)  # scores below this cannot enter

    def add(self, item: int, score: int, members: list) -> None:
        self.found[item].append((-score, members[0] is None, members[0] or 0, members))
        if len(self.found[item]) >= 4 * self.k:
            self.cut(item)

    def cut(self, item: int) -> None:
        self.found[item].sort(key=lambda x: x[:3])
        del self.found[item][self.k :]
        if len(self.found[item]) == self.k:
            self.least[item] = -self.found[item][-1][0]

    def rows(self, item: int) -> list[tuple[int, int | None]]:
        """(score, doc_id) of the best members."""
        self.cut(item)
        every = [(s, d is None, d or 0, d) for s, _, _, members in self.found[item] for d in members]
        return [(-s, d) for s, _, _, d in sorted(every, key=lambda x: x[:3])[: self.k]]


def _scores(block: Block, weight: np.ndarray, bags: list[bytes], ms: np.ndarray) -> np.ndarray:
    """Scores of some classes for all items of a block."""
    pairs = [_unbag(b) for b in bags]
    size = np.array([len(i) for i, _ in pairs])
    ids = np.concatenate([i for i, _ in pairs]).astype(np.int64)
    tf = np.concatenate([t.astype(np.int64) for _, t in pairs])
    row = np.repeat(np.arange(len(bags)), size)
    part = weight[ids] * (1_000_000_000 * tf // (1000 * tf + 12 * ms[row]))
    a, n = block.starts[ids], block.starts[ids + 1] - block.starts[ids]
    at = np.arange(n.sum()) + np.repeat(a - (np.cumsum(n) - n), n)
    out = np.zeros(len(bags) * len(block.ids), np.int64)
    np.add.at(out, np.repeat(row * len(block.ids), n) + block.items[at], np.repeat(part, n) * block.times[at])
    return out.reshape(len(bags), -1)


def _ranked(block: Block, weight: np.ndarray, k: int):
    """Classes to each item's best documents among a task's classes."""
    step = max(1, _SCORES // len(block.ids))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best = _Best(len(block.ids), k)
        for batch in slices(batches, "bag"):
            bags, members = batch["bag"].to_pylist(), batch["members"].to_pylist()
            ms = batch["m"].to_numpy()
            for lo in range(0, len(bags), step):
                score = _scores(block, weight, bags[lo : lo + step], ms[lo : lo + step])
                for r, i in zip(*np.nonzero(score >= best.least)):
                    if score[r, i] >= best.least[i]:
                        best.add(i, int(score[r, i]), [x["doc_id"] for x in members[lo + r]])
        found = [(i, *row) for i in range(len(block.ids)) for row in best.rows(i)]
        if found:
            items, scores, docs = zip(*found)
            yield pa.record_batch(
                {
                    "item": pa.array(items, pa.int32()),
                    "score": pa.array(scores, pa.int64()),
                    "doc_id": pa.array(docs, pa.int64()),
                }
            )
        give_back()

    return run


def classes(bags: DataFrame, total: int, length: int, k: int) -> DataFrame:
    """m, bag, members (the k least ids, as rank and doc_id): one row per distinct bag and ``m``."""
    # decimals, as the product of three counts may pass 64 bits
    m = F.expr(f"75 + CAST(25 * CAST(n AS DECIMAL(18, 0)) * {total} DIV {length} AS BIGINT)").alias("m")
    rows = bags.where("bag IS NOT NULL").select("doc_id", m, "bag")
    same = [F.xxhash64("m", "bag").alias("h"), F.col("m"), F.col("bag")]
    by_id = Window.partitionBy("h", "m", "bag").orderBy(F.col("doc_id").asc_nulls_last())
    first = rows.select(*same, "doc_id").withColumn("rank", F.row_number().over(by_id)).where(F.col("rank") <= k)
    member = F.struct("rank", "doc_id")
    return first.groupBy("h", "m", "bag").agg(F.sort_array(F.collect_list(member)).alias("members"))


def _of_block(docs: DataFrame, block: Block, k: int) -> DataFrame | None:
    spark = docs.sparkSession
    bags = written(docs.mapInArrow(_bags(block.term), "doc_id long, n long, bag binary, df array<long>"))
    whole = bags.where("n > 0").agg(F.count("*"), F.sum("n")).first()
    total, length = whole
    if not total:
        return None
    df = np.zeros(len(block.term), np.int64)
    counts = bags.select(F.posexplode("df").alias("t", "n")).where("n > 0").groupBy("t").agg(F.sum("n"))
    for t, n in counts.collect():  # at most one row per term of the block
        df[t] = n
    weight = np.array([math.floor(1000 * math.log((2 * total + 2) / (2 * int(n) + 1))) for n in df], np.int64)
    grouped = classes(bags, total, length, k)
    found = grouped.select("m", "bag", "members").mapInArrow(_ranked(block, weight, k), "item int, score long, doc_id long")
    best = Window.partitionBy("item").orderBy(F.desc("score"), F.col("doc_id").asc_nulls_last())
    top = written(found).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    names = spark.createDataFrame(list(enumerate(block.ids)), "item int, item_id long")  # as many as a block has
    return top.join(F.broadcast(names), "item").select("item_id", "rank", "doc_id", "score")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 20,
    text: str = "text",
    key: str = "doc_id",
    item_text: str = "text",
    item_key: str = "item_id",
) -> DataFrame:
    """item_id, rank, doc_id, score: the ``k`` documents of highest score above 0 for each item."""
    rows, out = documents(docs, text, key), None
    for block in blocks(items, item_text, item_key):
        found = _of_block(rows, block, k)
        if found is not None:
            out = found if out is None else out.unionByName(found)
    if out is None:
        out = rows.sparkSession.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return out

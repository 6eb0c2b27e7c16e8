"""Lexical retrieval packing of documents into windows of a fixed number of tokens.

Documents are dealt to shards of bounded size, those with the same rare token together: a random
order in which a token comes early the rarer its place in the vocabulary makes it likely to be
(byte pairs are merged by their frequency, so rarity grows as the logarithm of the place). Each
shard has a BM25 inverted index over token ids, with document frequencies and mean length of
the whole corpus. A seed document queries it; its unused neighbours, best first, fill the rest
of its window. A document that crosses the end of a window is cut there and seeds the next
one. So only a shard's last window can be short, and that one is split into sequences whose
lengths are powers of two, which need no padding.

Defined results. A null or empty text has only the end token. Equal rows are packed each. An
empty table gives an empty result. Other columns are ignored.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .bpe import encoder
from .common import documents, give_back, slices, written

WINDOW = 2048
END = 1
#: Tokens of a shard; a shard exceeds it by one document at most.
SHARD_TOKENS = 400_000
K1, B = 1.2, 0.75

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
)


def tokenised(docs: DataFrame, path: str, end: int = END) -> DataFrame:
    """doc_id, n, ids (little-endian, two bytes each if the vocabulary allows, else four), key, df.

    ``key`` is the document's token that is first in ``_order``. The last row of a task has only
    ``df``: in how many of its documents each token stands.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = encoder(path)
        kind, size = _kind(model), max([*model.token, end]) + 1
        order, seen = _order(size), np.zeros(size, np.int64)
        token_at = np.argsort(order)
        for batch in slices(batches):
            ids, keys = [np.append(x, end).astype(kind) for x in model.encode(batch["text"].to_pylist())], []
            for x in ids:
                terms = np.unique(x)
                seen[terms] += 1
                keys.append(token_at[order[terms].min()])
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n": pa.array([len(x) for x in ids], pa.int64()),
                    "ids": pa.array([x.tobytes() for x in ids], pa.binary()),
                    "key": pa.array(keys, pa.int32()),
                    "df": pa.nulls(len(ids), pa.list_(pa.int64())),
                }
            )
        kinds = (pa.int64(), pa.int64(), pa.binary(), pa.int32(), pa.list_(pa.int64()))
        last = [pa.array([x], k) for x, k in zip((None, None, None, None, seen), kinds)]
        yield pa.record_batch(last, ["doc_id", "n", "ids", "key", "df"])
        give_back()

    return docs.mapInArrow(run, "doc_id long, n long, ids binary, key int, df array<long>")


def _order(size: int) -> np.ndarray:
    """Each token's place in a random order, weighted by the logarithm of its place in the vocabulary."""
    drawn = np.random.default_rng(7).exponential(size=size) / np.log(np.arange(size) + 2.0)
    return np.argsort(np.argsort(drawn))


def _kind(model) -> str:
    return "<u2" if max(model.token) < 1 << 16 else "<u4"


def document_frequencies(table: DataFrame, size: int) -> np.ndarray:
    """In how many documents each token stands; as many numbers as the vocabulary has tokens."""
    out = np.zeros(size, np.int64)
    counts = table.select(F.posexplode("df").alias("term", "df")).where("df > 0")
    for term, df in counts.groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


def _deal(tokens: list[tuple[int, int]], most: int) -> list[tuple[int, int, int]]:
    """(key, first shard, number of shards): small keys share a shard, large ones have several."""
    out, shard, filled = [], 0, 0
    for key, n in sorted(tokens):
        if n > most:
            shard += filled > 0
            parts = -(-n // most)
            out.append((key, shard, parts))
            shard, filled = shard + parts, 0
            continue
        if filled + n > most:
            shard, filled = shard + 1, 0
        out.append((key, shard, 1))
        filled += n
    return out


class Index:
    """A BM25 inverted index of one shard."""

    def __init__(self, docs: list[np.ndarray], idf: np.ndarray, mean_length: float):
        self.docs = docs
        length = np.array([len(d) for d in docs], np.int64)
        doc = np.repeat(np.arange(len(docs)), length)
        key, tf = np.unique(np.concatenate(docs).astype(np.int64) * len(docs) + doc, return_counts=True)
        term, self.doc = key // len(docs), (key % len(docs)).astype(np.int32)
        self.first = np.searchsorted(term, np.arange(len(idf) + 1))
        norm = K1 * (1 - B + B * length[self.doc] / mean_length)
        self.weight = idf[term] * tf * (K1 + 1) / (tf + norm)

    def scores(self, query: int) -> np.ndarray:
        terms = np.unique(self.docs[query])
        lo, hi = self.first[terms], self.first[terms + 1]
        sizes = hi - lo
        at = np.arange(sizes.sum()) + np.repeat(lo - (np.cumsum(sizes) - sizes), sizes)
        return np.bincount(self.doc[at], self.weight[at], minlength=len(self.docs))


def packing_order(docs: list[np.ndarray], idf: np.ndarray, mean_length: float, window: int = WINDOW) -> list[int]:
    """The documents in the order in which they fill the windows."""
    index = Index(docs, idf, mean_length)
    length = np.array([len(d) for d in docs], np.int64)
    unused = np.ones(len(docs), bool)
    order: list[int] = []
    filled, next_seed = 0, 0
    while len(order) < len(docs):
        if filled == 0 or not order:
            while not unused[next_seed]:
                next_seed += 1
            seed = next_seed
            unused[seed] = False
            order.append(seed)
            filled = (filled + int(length[seed])) % window
        else:
            seed = order[-1]
        # the seed's window has this much room left; its neighbours fill it
        while filled:
            found = np.flatnonzero(unused)
            if not len(found):
                return order
            score = index.scores(seed)[found]
            found = found[np.lexsort((found, -score))]
            reach = filled + np.cumsum(length[found])
            taken = int(np.searchsorted(reach, window)) + 1  # up to the one that fills the window
            chosen = found[:taken]
            unused[chosen] = False
            order += chosen.tolist()
            over = int(reach[min(taken, len(found)) - 1])
            filled, seed = over % window, int(chosen[-1])
            if over < window:
                return order
    return order


def cut(lengths: np.ndarray, window: int = WINDOW) -> tuple[np.ndarray, ...]:
    """Pieces of documents laid end to end: document, start, length, sequence, offset.

    Sequences have ``window`` tokens; what is left over is split into powers of two.
    """
    ends = np.cumsum(lengths)
    total = int(ends[-1])
    bounds = list(range(0, total - total % window, window))
    at, rest = total - total % window, total % window
    for bit in reversed(range(rest.bit_length())):
        if rest >> bit & 1:
            bounds.append(at)
            at += 1 << bit
    bounds = np.array(bounds, np.int64)
    points = np.union1d(bounds, ends - lengths)
    doc = np.searchsorted(ends, points, "right")
    sequence = np.searchsorted(bounds, points, "right") - 1
    size = np.diff(points, append=total)
    return doc, points - (ends - lengths)[doc], size, sequence, points - bounds[sequence]


def pack(
    docs: DataFrame,
    path: str,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    shard_tokens: int = SHARD_TOKENS,
) -> DataFrame:
    """One row per piece, with the columns of PIECES."""
    spark = docs.sparkSession
    model = encoder(path)
    kind, size = _kind(model), max([*model.token, END]) + 1
    table = tokenised(documents(docs, text, key), path)
    # the row number spreads the rows of a large key; it is fixed once the table is written
    table = written(table.withColumn("row_no", F.monotonically_increasing_id()))
    n_docs, n_tokens = table.agg(F.count("n"), F.sum("n")).first()
    df = document_frequencies(table, size)
    idf = np.log1p((n_docs - df + 0.5) / (df + 0.5)) if n_docs else np.zeros(size)
    mean_length = (n_tokens or 1) / max(n_docs, 1)
    keyed = table.drop("df").where("n IS NOT NULL")
    tokens = [tuple(r) for r in keyed.groupBy("key").agg(F.sum("n")).collect()]  # a row per token at most
    plan = spark.createDataFrame(_deal(tokens, shard_tokens), "key int, first long, parts long")
    spread = F.pmod(F.xxhash64("row_no"), "parts")
    dealt = keyed.join(F.broadcast(plan), "key").withColumn("shard", F.col("first") + spread)
    shared = spark.sparkContext.broadcast((idf, mean_length))

    def fill(group: pa.Table) -> pa.Table:
        group = group.sort_by([("key", "ascending"), ("row_no", "ascending")])
        ids = [np.frombuffer(x, kind) for x in group["ids"].to_pylist()]
        at = np.array(packing_order(ids, *shared.value, window), np.int64)
        doc, start, length, sequence, offset = cut(np.array([len(ids[i]) for i in at], np.int64), window)
        doc = at[doc]
        sums = [
            zlib.crc32(ids[d][s : s + n].astype("<u4").tobytes())
            for d, s, n in zip(doc.tolist(), start.tolist(), length.tolist())
        ]
        names = group["doc_id"].combine_chunks().take(pa.array(doc))
        give_back()
        return pa.table(
            {
                "doc_id": names,
                "start": start,
                "length": length,
                "ids_crc32": pa.array(sums, pa.int64()),
                "doc_tokens": np.array([len(x) for x in ids], np.int64)[doc],
                "sequence_id": (group["shard"][0].as_py() << 32) + sequence,
                "offset": offset,
            }
        )

    return dealt.select("shard", "key", "row_no", "doc_id", "ids").groupBy("shard").applyInArrow(fill, PIECES)

"""Quality scores of texts by a factorisation machine.

A text is a sparse vector: its hashed lower-case words, and one indicator per structure
statistic (shares of letter cases, digits, marks and white space, repeated words, lengths, the
row's stored length against the text's) for the quantile it falls in. The score is a bias,
linear weights and low-rank interactions of all pairs, summed in linear time:
sum_{i<j} <v_i, v_j> x_i x_j = 1/2 sum_f ((sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2).

Training takes at most TRAIN_ROWS labelled rows per class, of at most TRAIN_CHARS characters,
to the driver, weighted so that the classes keep their shares; scoring runs on all rows and
whole texts.

Defined results. A null text counts as empty and gets the score of its (empty) features; a null
stored length counts as the text's own. Without labels of both classes every score is the share
of the class there is (0.5 if none); so it is if a class has no row to learn from. Equal rows are scored each; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, functions as F

from .common import in_small_batches, per_batch, range_hashes, slices, smallest_hashes, text_bytes, written

TRAIN_ROWS = 2500
TRAIN_CHARS = 20_000
WORD_BUCKETS = 1 << 15
FACTORS = 8
CUTS = 10  # quantile ranges of a statistic
EPOCHS = 6

#: Classes of bytes: lower case, upper case, digits, white space, bytes of other letters, marks.
_LOWER, _UPPER, _DIGIT, _SPACE, _HIGH, _MARK = range(6)
_CLASS = np.full(256, _MARK, np.uint8)
_CLASS[ord("a") : ord("z") + 1] = _LOWER
_CLASS[ord("A") : ord("Z") + 1] = _UPPER
_CLASS[ord("0") : ord("9") + 1] = _DIGIT
_CLASS[[9, 10, 11, 12, 13, 32]] = _SPACE
_CLASS[128:] = _HIGH
_FOLD = np.arange(256, dtype=np.uint8)
_FOLD[ord("A") : ord("Z") + 1] += 32
STATISTICS = 17


def _per_row(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a byte-wise array over each row."""
    sums = np.concatenate([[0], np.cumsum(values, dtype=np.int64)])
    return sums[offsets[1:]] - sums[offsets[:-1]]


def features(batch: pa.RecordBatch):
    """(row, bucket, value) of the words and the statistics of each row."""
    data, offsets = text_bytes(batch["text"])
    n = batch.num_rows
    kind = _CLASS[data]
    size = np.diff(offsets)
    row_of = np.repeat(np.arange(n), size)
    space = kind == _SPACE
    # words: runs without white space, inside one row
    starts_row = np.zeros(len(data) + 1, bool)
    starts_row[offsets[:-1]] = True
    begin = ~space & (np.concatenate([[True], space[:-1]]) | starts_row[:-1]) if len(data) else space
    stop = ~space & (np.concatenate([space[1:], [True]]) | starts_row[1:]) if len(data) else space
    at, end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
    word_row = row_of[at]
    h = range_hashes(_FOLD[data], at, end)
    key, tf = np.unique((word_row.astype(np.uint64) << np.uint64(40)) | (h >> np.uint64(24)), return_counts=True)
    row = (key >> np.uint64(40)).astype(np.int64)
    bucket = (key & np.uint64(WORD_BUCKETS - 1)).astype(np.int64)
    value = np.log1p(tf)
    norm = np.sqrt(np.bincount(row, value**2, minlength=n))
    value = value / norm[row]
    # statistics
    n_words = np.bincount(word_row, minlength=n)
    distinct = np.bincount(row, minlength=n)
    most = np.zeros(n)
    np.maximum.at(most, row, tf)
    lengths = np.bincount(word_row, end - at, minlength=n)
    upper_words = np.bincount(word_row, (kind[at] == _UPPER) & (kind[end - 1] != _LOWER) & (end - at > 1), minlength=n)
    marked = np.bincount(word_row, kind[end - 1] == _MARK, minlength=n)
    bare = np.bincount(word_row, (kind[at] == _MARK) & (kind[end - 1] == _MARK), minlength=n)
    digits = np.bincount(word_row, kind[end - 1] == _DIGIT, minlength=n)
    letters, words = np.maximum(size, 1), np.maximum(n_words, 1)
    same = np.zeros(len(h))
    if len(h) > 1:
        same[1:] = (h[1:] == h[:-1]) & (word_row[1:] == word_row[:-1])
    stored = batch["n_chars"].to_numpy(zero_copy_only=False).astype(np.float64)
    real = np.array(pc.utf8_length(batch["text"]), np.float64)
    stored = np.where(np.isnan(stored), real, stored)
    statistics = [
        *(_per_row(kind == k, offsets) / letters for k in (_LOWER, _UPPER, _DIGIT, _SPACE, _HIGH, _MARK)),
        _per_row(data == 10, offsets) / words,
        np.log1p(n_words),
        distinct / words,
        most / words,
        lengths / words,
        upper_words / words,
        marked / words,
        bare / words,
        np.bincount(word_row, same, minlength=n) / words,
        digits / words,
        np.abs(stored - real),
    ]
    return row, bucket, value, np.stack(statistics, 1)


def all_features(batches: list[pa.RecordBatch]):
    """The features of several batches, worked out in bounded slices."""
    parts, before = [], 0
    for part in slices(iter(batches)):
        row, bucket, value, statistics = features(part)
        parts.append((row + before, bucket, value, statistics))
        before += part.num_rows
    return tuple(np.concatenate(x) for x in zip(*parts))


class Machine:
    """A factorisation machine over word buckets and statistic ranges."""

    def __init__(self, edges: np.ndarray, seed: int = 11):
        rng = np.random.default_rng(seed)
        size = WORD_BUCKETS + STATISTICS * CUTS
        self.edges = edges  # (statistics, cuts - 1)
        self.bias, self.linear = 0.0, np.zeros(size)
        self.factors = rng.normal(0, 0.05, (size, FACTORS))

    def vectors(self, found):
        """All entries (row, feature, value) sorted by row."""
        row, bucket, value, statistics = found
        n = len(statistics)
        cut = np.stack([np.searchsorted(e, statistics[:, i], "right") for i, e in enumerate(self.edges)], 1)
        extra = WORD_BUCKETS + np.arange(STATISTICS) * CUTS + cut
        rows = np.concatenate([row, np.repeat(np.arange(n), STATISTICS)])
        features_ = np.concatenate([bucket, extra.ravel()])
        values = np.concatenate([value, np.full(n * STATISTICS, STATISTICS**-0.5)])
        order = np.argsort(rows, kind="stable")
        return rows[order], features_[order], values[order], n

    def raw(self, rows, features_, values, n):
        """The scores before the logistic function, and the sums per factor."""
        first = np.searchsorted(rows, np.arange(n))  # every row has its statistics
        vx = self.factors[features_] * values[:, None]
        total = np.add.reduceat(vx, first)
        squares = np.add.reduceat((vx * vx).sum(axis=1), first)
        linear = np.add.reduceat(self.linear[features_] * values, first)
        return self.bias + linear + 0.5 * ((total * total).sum(axis=1) - squares), total, vx

    def score(self, found) -> np.ndarray:
        if not len(found[3]):
            return np.zeros(0)
        return 1 / (1 + np.exp(-np.clip(self.raw(*self.vectors(found))[0], -30, 30)))

    def fit(self, found, label: np.ndarray, weight: np.ndarray, seed: int = 3) -> None:
        rows, features_, values, n = self.vectors(found)
        start = np.searchsorted(rows, np.arange(n + 1))
        rng = np.random.default_rng(seed)
        share = np.average(label, weights=weight)
        self.bias = float(np.log(share / (1 - share)))
        square_v, square_w = np.full(self.factors.shape, 1e-6), np.full(self.linear.shape, 1e-6)
        for epoch in range(EPOCHS):
            order = rng.permutation(n)
            for at in range(0, n, 64):
                part = order[at : at + 64]
                sizes = start[part + 1] - start[part]
                pick = np.repeat(start[part] - (np.cumsum(sizes) - sizes), sizes) + np.arange(sizes.sum())
                r = np.repeat(np.arange(len(part)), sizes)
                f, x = features_[pick], values[pick]
                z, total, vx = self.raw(r, f, x, len(part))
                error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - label[part]) * weight[part]
                g = error[r] * x
                gv = g[:, None] * (total[r] - vx)
                used, place = np.unique(f, return_inverse=True)
                sum_w = np.bincount(place, g) + 1e-4 * self.linear[used]
                sum_v = np.stack([np.bincount(place, gv[:, k]) for k in range(FACTORS)], 1) + 1e-4 * self.factors[used]
                square_w[used] += sum_w**2
                square_v[used] += sum_v**2
                self.linear[used] -= 0.2 * sum_w / np.sqrt(square_w[used])
                self.factors[used] -= 0.05 * sum_v / np.sqrt(square_v[used])
                self.bias -= 0.05 * float(error.mean())


def _inputs(docs: DataFrame, text: str, key: str, length: str) -> DataFrame:
    text_ = F.coalesce(F.col(text).cast("string"), F.lit(""))
    stored = F.col(length).cast("double") if length in docs.columns else F.lit(None).cast("double")
    return in_small_batches(docs).select(F.col(key).cast("long").alias("doc_id"), text_.alias("text"), stored.alias("n_chars"))


def training_rows(rows: DataFrame, marks: DataFrame) -> DataFrame:
    """doc_id, text, n_chars, y: at most TRAIN_ROWS rows of each class, those of smallest hash of the id.

    Only rows of at most TRAIN_CHARS characters are ranked, one for each id and label: of rows
    that share an id the one of the smallest hash of its content.
    """
    short = rows.where(f"length(text) <= {TRAIN_CHARS}").withColumn("content", F.xxhash64("text", "n_chars"))
    firsts = short.groupBy("doc_id").agg(F.min("content").alias("content"))
    marked = written(firsts.join(marks.distinct(), "doc_id").withColumn("h", F.xxhash64("doc_id")))
    taken = smallest_hashes(marked, "y", "h", TRAIN_ROWS).select("doc_id", "content", "y")
    found = short.join(F.broadcast(taken), ["doc_id", "content"]).drop("content")
    return found.dropDuplicates(["doc_id", "y"])  # equal rows


def train(
    docs: DataFrame,
    labels: DataFrame,
    usable: Column,
    label: str = "quality",
    text: str = "text",
    key: str = "doc_id",
    length: str = "n_chars",
) -> Machine | float:
    """The machine learned from labelled rows for which ``usable`` (of ``key``) holds.

    Without rows of both classes to learn from, the share of label 1.
    """
    marks = labels.where(usable).select(F.col(key).cast("long").alias("doc_id"), F.col(label).cast("int").alias("y"))
    marks = marks.where("y IN (0, 1) AND doc_id IS NOT NULL")
    shares = dict(marks.groupBy("y").agg(F.count("*")).collect())
    if len(shares) < 2:
        return float(next(iter(shares), 0.5))
    rows = training_rows(_inputs(docs, text, key, length), marks).orderBy("doc_id", "text", "y").toArrow()
    if len(rows["y"].unique()) < 2:
        return shares[1] / (shares[0] + shares[1])
    y = rows["y"].to_numpy().astype(np.float64)
    found = all_features(rows.to_batches())
    edges = np.quantile(found[3], np.arange(1, CUTS) / CUTS, axis=0).T
    total = sum(shares.values())
    weight = np.where(y == 1, shares[1] / y.sum(), shares[0] / (len(y) - y.sum())) * len(y) / total
    machine = Machine(edges)
    machine.fit(found, y, weight)
    return machine


def score(
    docs: DataFrame, machine: Machine | float, text: str = "text", key: str = "doc_id", length: str = "n_chars"
) -> DataFrame:
    """doc_id, score; one row per input row."""
    shared = docs.sparkSession.sparkContext.broadcast(machine)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = shared.value
        values = np.full(batch.num_rows, model) if isinstance(model, float) else model.score(features(batch))
        return pa.record_batch({"doc_id": batch["doc_id"], "score": pa.array(values, pa.float64())})

    return _inputs(docs, text, key, length).mapInArrow(per_batch(work), "doc_id long, score double")

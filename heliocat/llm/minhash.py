"""Near duplicates by MinHash signatures, joined over an inverted index of their coordinates.

A text's set of word shingles has a signature of ``COORDINATES`` least hashes; two sets agree in
a coordinate with the probability of their similarity. Texts of equal words are one class.

Classes are posted under each pair of coordinate and value. A pair of classes is a candidate if
it agrees in at least ``least_matches`` coordinates. Prefix: pairs seldom in the corpus come
first, values of one class only are never posted, and the first ``s - least + 1`` of a class's
``s`` shared values are enough to meet every candidate. Skip: in a list, agreements are counted
some coordinates at a time, and pairs that cannot reach the least number, or are connected
already, are skipped. Long lists are cut into blocks, whose pairs are units of work.

Candidates form clusters. The shingle sets of clustered classes are read again, meet in their
cluster (in blocks too, if it is large), and links are confirmed on whole sets of 64-bit shingle
hashes. Units return spanning forests, never all pairs; components are found by star contraction.

The signature loses a link of exactly the least similarity with probability ``LOSS``; more
similar pairs less often.

Defined results. Only A-Z are lower-cased. A text of fewer words than a shingle is one shingle;
null texts and texts without words have an empty set, no link and their own id as component.
Equal rows share a component. A null ``doc_id`` names no component unless all members have one,
and a row is kept if its id is its component's, nulls being equal. An empty table gives an empty
result. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable, Iterator
from math import comb

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import attach, documents, give_back, mix, per_batch, slices, written
from .components import components

#: Coordinates of a signature; their number takes the low bits of a value.
COORDINATES = 64
_BITS = np.uint64(COORDINATES - 1)
#: Chance that a link of exactly the least similarity is lost.
LOSS = 1e-8
#: Classes of one block of a list, and of one block of a cluster.
LIST_ROWS, CLUSTER_ROWS = 1024, 1024
#: Bytes of shingle sets in one block of a cluster.
CLUSTER_BYTES = 8 << 20
#: Coordinates that are compared before pairs are skipped, words whose hashes a worker keeps, bytes cut at once.
_STRIDE, _CACHE, _PIECE = 16, 500_000, 1 << 20
#: Bits of a class's digest that its place in the filter of clustered classes is made of.
_FILTER_BITS = 24
_RANDOM = np.random.default_rng(20240917)
_FACTORS = _RANDOM.integers(0, 1 << 63, (2, COORDINATES), dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACES = _RANDOM.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = re.compile(rb"[\x20\x09-\x0D]")


def least_matches(percent: int) -> int:
    """The largest number of agreements that a link of this similarity falls short of with chance LOSS at most."""
    p, chance = percent / 100, 0.0
    for n in range(COORDINATES + 1):
        chance += comb(COORDINATES, n) * p**n * (1 - p) ** (COORDINATES - n)
        if chance > LOSS:
            return max(1, n)
    return COORDINATES


class _Words(dict):
    """64-bit hashes of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _CACHE:
            self.clear()
        value = self[word] = xxhash.xxh64_intdigest(word)
        return value


_words = _Words()


def shingles(text: bytes, width: int) -> tuple[np.ndarray, bytes]:
    """The sorted distinct shingle hashes of a text, and a digest that is equal for equal words."""
    digest, parts, at = hashlib.blake2b(digest_size=16), [], 0
    while at < len(text):
        space = _SPACE.search(text, at + _PIECE)
        stop = space.start() if space else len(text)
        words = text[at:stop].lower().split()
        if words:
            digest.update(b" ".join(words) + b" ")
            parts.append(np.fromiter(map(_words.__getitem__, words), np.uint64, len(words)))
        at = stop
    if not parts:
        return np.zeros(0, np.uint64), digest.digest()
    words = np.concatenate(parts)
    n = min(width, len(words))
    total = np.full(len(words) - n + 1, n, np.uint64)
    for d in range(n):
        total += words[d : len(words) - n + 1 + d] * _place(d)
    return np.unique(mix(total)), digest.digest()


def _place(d: int) -> np.uint64:
    return _PLACES[d % 64] + np.uint64(2 * (d // 64))


def signatures(sets: list[np.ndarray]) -> np.ndarray:
    """One row of coordinate values per set that is not empty; a value's low bits are its coordinate."""
    every = np.concatenate(sets)
    starts = np.cumsum([0, *map(len, sets[:-1])])
    out = np.empty((len(sets), COORDINATES), np.uint64)
    for k in range(COORDINATES):
        h = every * _FACTORS[0, k]
        h ^= h >> np.uint64(29)
        h *= _FACTORS[1, k]
        out[:, k] = np.minimum.reduceat(h, starts) & ~_BITS | np.uint64(k)
    return out


def _signed(values: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(values).view(np.int64)


def signed_rows(docs: DataFrame, width: int) -> DataFrame:
    """doc_id, words (digest), n_shingles, sig (null without a word); one row per input row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [shingles(t, width) for t in batch["text"].cast(pa.binary()).to_pylist()]
        sets = [s for s, _ in found if len(s)]
        values = _signed(signatures(sets)).ravel() if sets else np.zeros(0, np.int64)
        some = np.array([len(s) > 0 for s, _ in found])
        ends = np.concatenate([[0], np.cumsum(some)]) * COORDINATES
        sig = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(values), mask=pa.array(~some))
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "words": pa.array([d for _, d in found], pa.binary()),
                "n_shingles": pa.array([len(s) for s, _ in found], pa.int64()),
                "sig": sig,
            }
        )

    return docs.mapInArrow(per_batch(work), "doc_id long, words binary, n_shingles long, sig array<long>")


class _Trees:
    """Members of a unit, joined as links are found; keeps the links that joined two trees."""

    def __init__(self, n: int):
        self.tree, self.links = np.arange(n), []

    def others(self, i: int, lo: int, hi: int) -> np.ndarray:
        """Members of [lo, hi) that are not connected with i yet."""
        return lo + np.flatnonzero(self.tree[lo:hi] != self.tree[i])

    def join(self, i: int, found: np.ndarray) -> None:
        trees, first = np.unique(self.tree[found], return_index=True)
        self.links += [(i, j) for j in found[first].tolist()]
        self.tree[np.isin(self.tree, trees)] = self.tree[i]


def forest(n: int, left: int, near: Callable[[int, np.ndarray], np.ndarray]) -> list[tuple[int, int]]:
    """A spanning forest of the links among n members, or between the first ``left`` and the rest.

    ``near(i, others)`` says which of some members i is linked with; connected pairs are not asked.
    """
    trees = _Trees(n)
    for i in range(left or n):
        others = trees.others(i, left or i + 1, n)
        if len(others) and (linked := near(i, others)).any():
            trees.join(i, others[linked])
    return trees.links


def _units(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[pa.Table]:
    """Whole units, some at a time, from batches sorted by unit."""
    held: list[pa.RecordBatch] = []
    for batch in slices(batches, column):
        keys = [batch[c].to_numpy(zero_copy_only=False) for c in ("token", "i", "j")]
        edge = np.flatnonzero(np.logical_or.reduce([k[1:] != k[:-1] for k in keys])) + 1
        if held:
            before = held[-1]
            if any(before[c][-1].as_py() != batch[c][0].as_py() for c in ("token", "i", "j")):
                edge = np.concatenate([[0], edge])
        if len(edge):
            last = int(edge[-1])
            if held or last:
                yield pa.Table.from_batches([*held, batch.slice(0, last)])
            held = [batch.slice(last)]
        else:
            held.append(batch)
    if held:
        yield pa.Table.from_batches(held)


def _per_unit(column: str, near_of: Callable, least: int):
    """Sorted units to links a, b of their members' ``cid``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _units(batches, column):
            token, i, j, side, cid = (table[c].to_numpy() for c in ("token", "i", "j", "side", "cid"))
            edge = np.flatnonzero((token[1:] != token[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1])) + 1
            starts = np.concatenate([[0], edge])
            ends = np.concatenate([edge, [len(cid)]])
            several = ends - starts > 1
            # of a pair of blocks the left one's rows come first
            left = np.add.reduceat((side == 0) & (i != j), starts)
            near = near_of(table, least)
            found = []
            for a, b, split, cross in zip(starts[several], ends[several], left[several], (i != j)[starts[several]]):
                if cross and split in (0, b - a):
                    continue
                links = forest(int(b - a), int(split), lambda x, others: near(a + x, a + others))
                found += [(cid[a + x], cid[a + y]) for x, y in links]
            if found:
                pairs = np.sort(np.array(found, np.int64), axis=1)
                yield pa.record_batch({"a": pa.array(pairs[:, 0]), "b": pa.array(pairs[:, 1])})
        give_back()

    return run


def _agreeing(table: pa.Table, least: int) -> Callable[[int, np.ndarray], np.ndarray]:
    """Whether sketches agree in the least number of coordinates; 0 stands for a value of one class only."""
    sketch = np.frombuffer(b"".join(table["sketch"].to_pylist()), np.uint16).reshape(-1, COORDINATES)

    def near(i: int, others: np.ndarray) -> np.ndarray:
        mine, count, open_ = sketch[i], np.zeros(len(others), np.int64), np.arange(len(others))
        for at in range(0, COORDINATES, _STRIDE):
            part = mine[at : at + _STRIDE]
            count[open_] += ((sketch[others[open_], at : at + _STRIDE] == part) & (part != 0)).sum(axis=1)
            open_ = open_[count[open_] + (COORDINATES - _STRIDE - at) >= least]
        return count >= least

    return near


def _similar(table: pa.Table, percent: int) -> Callable[[int, np.ndarray], np.ndarray]:
    """Whether whole sets reach the similarity, in per cent."""
    sets = [np.frombuffer(s, np.uint64) for s in table["shingles"].to_pylist()]
    size = np.array([len(s) for s in sets])

    def near(i: int, others: np.ndarray) -> np.ndarray:
        out = np.zeros(len(others), bool)
        small, large = np.minimum(size[others], size[i]), np.maximum(size[others], size[i])
        rest = np.flatnonzero(100 * small >= percent * large)
        for part in np.array_split(rest, max(1, size[others[rest]].sum() // (1 << 21))):
            if not len(part):
                continue
            n = size[others[part]]
            every = np.concatenate([sets[k] for k in others[part]])
            at = np.minimum(np.searchsorted(sets[i], every), size[i] - 1)
            shared = np.add.reduceat((sets[i][at] == every).astype(np.int64), np.cumsum(n) - n)
            out[part] = 100 * shared >= percent * (n + size[i] - shared)
        return out

    return near


def _posted(least: int, list_rows: int):
    """Classes with their shared values to postings under the values of their prefix."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = []
            for cid, shared in zip(batch["cid"].to_pylist(), batch["shared"].to_pylist()):
                shared = sorted((s["n"], s["token"]) for s in shared)
                token = np.array([t for _, t in shared], np.int64).view(np.uint64)
                sketch = np.zeros(COORDINATES, np.uint16)
                sketch[(token & _BITS).astype(int)] = np.maximum(token >> np.uint64(6) & np.uint64(0xFFFF), 1)
                raw = sketch.tobytes()
                for n, t in shared[: len(shared) - least + 1]:
                    blocks = -(-n // list_rows)
                    own = xxhash.xxh64_intdigest(cid.to_bytes(8, "little")) % blocks
                    rows += [(t, min(own, x), max(own, x), int(own > x), cid, raw) for x in range(blocks)]
            if rows:
                kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.binary())
                names = ("token", "i", "j", "side", "cid", "sketch")
                yield pa.record_batch([pa.array(v, k) for v, k in zip(zip(*rows), kinds)], names)
        give_back()

    return run


def _sorted_units(rows: DataFrame) -> DataFrame:
    return rows.repartition("token", "i", "j").sortWithinPartitions("token", "i", "j", "side", "cid")


def candidates(classes: DataFrame, least: int, list_rows: int) -> DataFrame:
    """a, b: links that connect all classes (cid, sig) which agree in the least number of coordinates."""
    tokens = classes.select("cid", F.explode("sig").alias("token"))
    counts = written(tokens.groupBy("token").agg(F.count("*").alias("n")).where("n > 1"))
    shared = attach(tokens, counts, ["token"]).groupBy("cid").agg(F.collect_list(F.struct("n", "token")).alias("shared"))
    schema = "token long, i int, j int, side int, cid long, sketch binary"
    posted = shared.where(F.size("shared") >= least).mapInArrow(_posted(least, list_rows), schema)
    return _sorted_units(posted).mapInArrow(_per_unit("sketch", _agreeing, least), "a long, b long").distinct()


def _filter_words(members: DataFrame) -> np.ndarray:
    """A bit for each value of the digests' first bits; its size does not depend on the table."""
    place = F.conv(F.hex(F.substring("words", 1, _FILTER_BITS // 8)), 16, 10).cast("long").alias("p")
    bit = F.expr("shiftleft(1L, CAST(p % 64 AS INT))")
    found = members.select(place).groupBy(F.expr("p DIV 64").alias("w")).agg(F.bit_or(bit).alias("bits")).collect()
    out = np.zeros((1 << _FILTER_BITS) // 64, np.uint64)
    for w, bits in found:
        out[w] = bits % (1 << 64)
    return out


def _sets(docs: DataFrame, width: int, wanted: np.ndarray) -> DataFrame:
    """words, shingles: the shingle hashes of texts that pass the filter, once per task and digest."""
    shared = docs.sparkSession.sparkContext.broadcast(wanted)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[bytes] = set()
        for batch in slices(batches):
            found = []
            for text in batch["text"].cast(pa.binary()).to_pylist():
                digest = shingles_digest(text)
                p = int.from_bytes(digest[: _FILTER_BITS // 8], "big")
                if digest not in seen and int(shared.value[p // 64]) >> (p % 64) & 1:
                    seen.add(digest)
                    found.append((digest, shingles(text, width)[0].tobytes()))
            if found:
                columns = [pa.array(x, pa.binary()) for x in zip(*found)]
                yield pa.record_batch(columns, ["words", "shingles"])
        give_back()

    return docs.mapInArrow(run, "words binary, shingles binary")


def shingles_digest(text: bytes) -> bytes:
    """The digest that ``shingles`` gives."""
    digest, at = hashlib.blake2b(digest_size=16), 0
    while at < len(text):
        space = _SPACE.search(text, at + _PIECE)
        stop = space.start() if space else len(text)
        words = text[at:stop].lower().split()
        if words:
            digest.update(b" ".join(words) + b" ")
        at = stop
    return digest.digest()


def links(docs: DataFrame, classes: DataFrame, clusters: DataFrame, width: int, percent: int, cluster_rows: int) -> DataFrame:
    """a, b: links that connect all classes of a cluster whose whole sets are similar. ``clusters``: cid, root."""
    members = written(classes.select("cid", "words", "n_shingles").join(clusters, "cid"))
    need = F.greatest(F.count("*") / cluster_rows, F.sum("n_shingles") * 8 / CLUSTER_BYTES)
    sizes = members.groupBy("root").agg(F.count("*").alias("m"), F.ceil(need).cast("int").alias("blocks"))
    dealt = attach(members, written(sizes), ["root"], "m").withColumn("own", F.expr("CAST(pmod(xxhash64(cid), blocks) AS INT)"))
    each = dealt.withColumn("x", F.explode(F.expr("sequence(0, blocks - 1)"))).select(
        "words",
        "cid",
        F.col("root").alias("token"),
        F.least("own", "x").alias("i"),
        F.greatest("own", "x").alias("j"),
        (F.col("own") > F.col("x")).cast("int").alias("side"),
    )
    sets = _sets(docs, width, _filter_words(members)).groupBy("words").agg(F.first("shingles").alias("shingles"))
    units = _sorted_units(sets.join(each, "words").drop("words"))
    return units.mapInArrow(_per_unit("shingles", _similar, percent), "a long, b long")


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    width: int = 5,
    percent: int = 85,
    list_rows: int = LIST_ROWS,
    cluster_rows: int = CLUSTER_ROWS,
) -> DataFrame:
    """doc_id, n_shingles, component_id, kept; one row per input row.

    Texts are linked whose sets of ``width``-word shingles share ``percent`` per cent of their union.
    """
    docs = documents(docs, text, key)
    rows = written(signed_rows(docs, width))
    grouped = rows.where("n_shingles > 0").groupBy("words").agg(
        F.count("*").alias("n"),
        F.min("doc_id").alias("least"),
        F.first("n_shingles").alias("n_shingles"),
        F.first("sig").alias("sig"),
    )
    # numbered once, as written
    classes = written(grouped.withColumn("cid", F.monotonically_increasing_id()))
    near = components(written(candidates(classes.select("cid", "sig"), least_matches(percent), list_rows)))
    clusters = written(near.withColumnRenamed("node", "cid"))
    confirmed = components(written(links(docs, classes, clusters, width, percent, cluster_rows)))
    named = classes.drop("sig").join(confirmed.withColumnRenamed("node", "cid"), "cid", "left")
    named = written(named.withColumn("root", F.coalesce("root", "cid")))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("m"))
    facts = attach(named.drop("least"), smallest, ["root"], "m").select("words", "n", "component_id")
    some = attach(rows.where("n_shingles > 0").drop("sig"), written(facts), ["words"])
    none = rows.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    columns = ["doc_id", "n_shingles", "component_id"]
    every = some.select(*columns).unionByName(none.select(*columns))
    return every.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))

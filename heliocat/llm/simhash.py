"""Near duplicates by SimHash, joined by walking a binary trie against itself.

A fingerprint bit is set if it is set in over half of the text's shingle hashes. The distinct
fingerprints form a binary trie. Pairs of nodes of equal depth are walked together; each step
adds the bits in which the two paths differ, and a pair above the error budget is left.

The trie's upper part is cut into nodes of bounded size (counts per prefix, never the
fingerprints, come to the driver); node pairs within the budget are the units of work, spread
over the cluster. A unit returns a spanning forest of its links, never all pairs. Forests are
joined into components by star contraction.

Defined results. Null and empty texts have fingerprint zero, linked like any other. Equal rows
are linked by their equal fingerprint. An empty table gives an empty result; other columns are
ignored. A null ``doc_id`` never names a component unless all its members have one.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, functions as F

from .common import attach, documents, per_batch, rows_of, written
from .components import components

BITS = 64
#: Fingerprints of a trie node that is one side of a unit of work; more only beyond MAX_NODES such nodes.
NODE_ROWS = 1 << 16
MAX_NODES = 4096
#: Node pairs that are compared fingerprint by fingerprint.
LEAF_PAIRS = 64
_HALF = 1 << 63


def fingerprint(text: bytes, width: int = 3, seed: int = 42) -> int:
    words = text.lower().split()  # of bytes: A-Z, and the six ASCII white spaces
    if not words:
        return 0
    if len(words) <= width:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(width))))
    h = np.frombuffer(b"".join([xxhash.xxh64_digest(s, seed) for s in shingles]), np.uint8).reshape(-1, 8)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(h), 1 << 16):  # bounded for very long texts
        counts += np.unpackbits(h[at : at + (1 << 16)], axis=1).sum(axis=0, dtype=np.uint32)
    return int.from_bytes(np.packbits(counts * 2 > len(h)).tobytes(), "big")


def fingerprints(docs: DataFrame, width: int = 3, seed: int = 42, digest: bool = False) -> DataFrame:
    """doc_id, fp (the fingerprint as a long, its unsigned order kept); one row per input row.

    ``digest`` adds sha, the text's SHA-256 in hex digits.
    """

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        texts = batch["text"].cast(pa.binary()).to_pylist()
        values = [fingerprint(t, width, seed) - _HALF for t in texts]
        out = {"doc_id": batch["doc_id"], "fp": pa.array(values, pa.int64())}
        if digest:
            out["sha"] = pa.array([hashlib.sha256(t).hexdigest() for t in texts], pa.string())
        return pa.record_batch(out)

    return docs.mapInArrow(per_batch(work), "doc_id long, fp long" + ", sha string" * digest)


def _unsigned(fp: np.ndarray) -> np.ndarray:
    return fp.astype(np.int64).view(np.uint64) ^ np.uint64(_HALF)


def _signed(fp: np.ndarray) -> np.ndarray:
    return (fp ^ np.uint64(_HALF)).view(np.int64)


def trie_nodes(fps: DataFrame, node_rows: int) -> list[tuple[int, int]]:
    """(prefix, depth) of nodes that together hold every fingerprint, each at most node_rows of them.

    Levels are cut eight bits at a time, and only below nodes that are too large, so what comes
    to the driver is at most 256 counts for each node that is split.
    """
    done, large = [], [(0, 0)]
    total = fps.count()
    node_rows = max(node_rows, -(-total // MAX_NODES))
    if total <= node_rows:
        return [(0, 0)]
    while large:
        depth = large[0][1]
        shift = BITS - depth - 8
        prefix = lambda bits: F.shiftrightunsigned(F.col("fp").bitwiseXOR(F.lit(-_HALF)), bits)
        rows = fps.withColumn("child", prefix(shift) if shift else F.col("fp").bitwiseXOR(F.lit(-_HALF)))
        if depth:
            keep = fps.sparkSession.createDataFrame([(_to_long(p),) for p, _ in large], "parent long")
            rows = rows.withColumn("parent", prefix(BITS - depth)).join(F.broadcast(keep), "parent", "left_semi")
        counts = {r["child"] % (1 << BITS): r["n"] for r in rows.groupBy("child").agg(F.count("*").alias("n")).collect()}
        now, large = large, []
        for parent, _ in now:
            _cut(parent, depth, depth + 8, counts, node_rows, done, large)
    return sorted(done, key=lambda n: n[0] << (BITS - n[1]))


def _to_long(x: int) -> int:
    return x - (1 << 64) if x >= _HALF else x


def _cut(prefix: int, depth: int, floor: int, counts: dict, most: int, done: list, large: list) -> None:
    below = range(prefix << (floor - depth), (prefix + 1) << (floor - depth))
    n = sum(counts.get(p, 0) for p in below)
    if not n:
        return
    if n <= most or depth == BITS:
        done.append((prefix, depth))
    elif depth == floor:
        large.append((prefix, depth))
    else:
        for bit in (0, 1):
            _cut(prefix * 2 + bit, depth + 1, floor, counts, most, done, large)


def node_pairs(nodes: list[tuple[int, int]], budget: int) -> list[tuple[int, int]]:
    """Pairs (i <= j) of nodes whose common depth differs in at most ``budget`` bits.

    The nodes are walked as a trie: ranges of nodes sorted by prefix, halved bit by bit.
    """
    starts = [p << (BITS - d) for p, d in nodes]
    depths = [d for _, d in nodes]

    def halves(lo: int, hi: int, level: int) -> list[tuple[int, int, int | None]]:
        """The children of a node range, with their bit; a node that is not split has both bits."""
        if hi - lo == 1 and depths[lo] <= level:
            return [(lo, hi, None)]
        cut = lo
        while cut < hi and not starts[cut] >> (BITS - 1 - level) & 1:
            cut += 1
        return [(a, b, bit) for a, b, bit in ((lo, cut, 0), (cut, hi, 1)) if a < b]

    found, stack = [], [(0, len(nodes), 0, len(nodes), 0, 0)]
    while stack:
        a, b, c, d, level, off = stack.pop()
        if b - a == 1 and d - c == 1 and (a == c or level >= min(depths[a], depths[c])):
            found.append((a, c))
            continue
        same = (a, b) == (c, d)
        for x0, x1, xb in halves(a, b, level):
            for y0, y1, yb in halves(c, d, level):
                if same and y0 < x0:
                    continue
                more = off + (xb is not None and yb is not None and xb != yb)
                if more <= budget:
                    stack.append((x0, x1, y0, y1, level + 1, more))
    return sorted(set(found))


def linked_pairs(left: np.ndarray, right: np.ndarray | None, budget: int, depth: int = 0) -> Iterator[np.ndarray]:
    """Pairs of places (left, right) whose fingerprints differ in at most ``budget`` bits, in blocks.

    Both are sorted distinct uint64; ``right`` None joins ``left`` with itself (i < j only). The
    tries are the sorted arrays: a node is a range whose fingerprints share ``depth`` bits. All
    node pairs of a block go down one bit together; blocks are walked depth first, so memory
    stays bounded.
    """
    own = right is None
    other = left if own else right
    if not len(left) or not len(other):
        return
    first = np.array([[0, len(left), 0, len(other), 0]], np.int64)
    stack = [(depth, first)]
    while stack:
        level, block = stack.pop()
        small = (block[:, 1] - block[:, 0]) * (block[:, 3] - block[:, 2]) <= LEAF_PAIRS
        if level == BITS:
            small[:] = True
        if small.any():
            yield from _leaves(left, other, block[small], budget, own)
            block = block[~small]
        if not len(block):
            continue
        if len(block) > 1 << 15:
            half = len(block) // 2
            stack += [(level, block[:half]), (level, block[half:])]
            continue
        bit = np.uint64(BITS - 1 - level)
        a, b, c, d, off = block.T
        x, y = _split(left, a, b, bit), _split(other, c, d, bit)
        parts = []
        for l0, l1, r0, r1, add in ((a, x, c, y, 0), (x, b, y, d, 0), (a, x, y, d, 1), (x, b, c, y, 1)):
            keep = (l1 > l0) & (r1 > r0) & (off + add <= budget)
            if own:
                keep &= r1 > l0  # the mirror image of a pair is left out
                if add:
                    keep &= l0 <= r0
            parts.append(np.stack([l0, l1, r0, r1, off + add], 1)[keep])
        stack.append((level + 1, np.concatenate(parts)))


def _split(values: np.ndarray, lo: np.ndarray, hi: np.ndarray, bit: np.uint64) -> np.ndarray:
    """For each range, the first place whose ``bit`` is set; bits above are equal in a range."""
    lo, hi = lo.copy(), hi.copy()
    while (open_ := lo < hi).any():
        mid = (lo + hi) // 2
        ones = open_ & ((values[np.minimum(mid, len(values) - 1)] >> bit & np.uint64(1)) == 1)
        hi = np.where(ones, mid, hi)
        lo = np.where(open_ & ~ones, mid + 1, lo)
    return lo


def _leaves(left, other, block, budget, own) -> Iterator[np.ndarray]:
    n, m = block[:, 1] - block[:, 0], block[:, 3] - block[:, 2]
    sizes = n * m
    for lo in range(0, len(block), 1 << 14):
        part, count = block[lo : lo + (1 << 14)], sizes[lo : lo + (1 << 14)]
        which = np.repeat(np.arange(len(part)), count)
        at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count)
        width = m[lo : lo + (1 << 14)][which]
        i, j = part[which, 0] + at // width, part[which, 2] + at % width
        near = np.bitwise_count(left[i] ^ other[j]) <= budget
        if own:
            near &= i < j
        if near.any():
            yield np.stack([i[near], j[near]], 1)


class Forest:
    """Union-find that keeps the links which joined two trees."""

    def __init__(self, n: int):
        self.parent, self.links = list(range(n)), []

    def find(self, x: int) -> int:
        while self.parent[x] != x:
            self.parent[x] = self.parent[self.parent[x]]
            x = self.parent[x]
        return x

    def add(self, pairs: np.ndarray) -> None:
        for a, b in pairs.tolist():
            x, y = self.find(a), self.find(b)
            if x != y:
                self.parent[max(x, y)] = min(x, y)
                self.links.append((a, b))


def unit_links(left: np.ndarray, right: np.ndarray | None, budget: int) -> np.ndarray:
    """A spanning forest of the links of one unit, as pairs of fingerprints."""
    left = np.unique(left)
    right = None if right is None else np.unique(right)
    every = left if right is None else np.concatenate([left, right])
    forest = Forest(len(every))
    for pairs in linked_pairs(left, right, budget):
        forest.add(pairs if right is None else pairs + np.array([0, len(left)]))
    links = np.array(forest.links, np.int64).reshape(-1, 2)
    return every[links]


def links(fps: DataFrame, budget: int = 2, node_rows: int = NODE_ROWS) -> DataFrame:
    """a, b: links between distinct fingerprints that connect all that are within ``budget`` bits.

    ``fps`` has one row per distinct ``fp``.
    """
    spark = fps.sparkSession
    nodes = trie_nodes(fps, node_rows)
    pairs = node_pairs(nodes, budget)
    starts = np.array([p << (BITS - d) for p, d in nodes], np.uint64)
    of: list[list[tuple[int, int]]] = [[] for _ in nodes]
    for unit, (i, j) in enumerate(pairs):
        of[i].append((unit, 0))
        if j != i:
            of[j].append((unit, 1))
    plan = spark.sparkContext.broadcast((starts, of, pairs))  # bounded by the number of nodes

    def deal(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        starts, of, _ = plan.value
        for pdf in batches:
            fp = pdf["fp"].to_numpy()
            node = np.searchsorted(starts, _unsigned(fp), "right") - 1
            # fingerprints travel in blocks, one for each unit a node belongs to
            blocks = [(u, s, fp[node == k].tobytes()) for k in np.unique(node) for u, s in of[k]]
            yield pd.DataFrame(blocks, columns=["unit", "side", "block"])

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        i, j = plan.value[2][int(pdf["unit"].iloc[0])]
        sides = [_unsigned(np.frombuffer(b"".join(pdf["block"][pdf["side"] == s]), np.int64)) for s in (0, 1)]
        found = unit_links(sides[0], None if i == j else sides[1], budget)
        return pd.DataFrame({"a": _signed(found[:, 0]), "b": _signed(found[:, 1])})

    dealt = fps.select("fp").mapInPandas(deal, "unit int, side int, block binary")
    return dealt.groupBy("unit").applyInPandas(walk, "a long, b long")


def rooted(distinct: DataFrame, budget: int, node_rows: int) -> DataFrame:
    """The rows of ``distinct``, one per ``fp``, with ``root``, which is equal within a component."""
    roots = components(written(links(distinct, budget, node_rows)))  # node, root
    found = distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left")
    return found.withColumn("root", F.coalesce("root", "fp"))


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    width: int = 3,
    budget: int = 2,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """doc_id, fingerprint (16 hex digits), component_id; one row per input row."""
    rows = written(fingerprints(documents(docs, text, key), width))
    distinct = written(
        rows.groupBy("fp").agg(F.count("*").alias("n"), F.min("doc_id").alias("least"))
    )
    named = written(rooted(distinct, budget, node_rows))
    smallest = named.groupBy("root").agg(F.min("least").alias("component_id"), F.count("*").alias("m"))
    facts = attach(named.drop("least"), smallest, ["root"], "m").select("fp", "n", "component_id")
    unsigned = F.lpad(F.lower(F.hex(F.col("fp").bitwiseXOR(F.lit(-_HALF)))), 16, "0")
    return attach(rows, written(facts), ["fp"]).select(
        "doc_id", unsigned.alias("fingerprint"), "component_id"
    )


def drop_near_duplicates(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    width: int = 3,
    budget: int = 2,
    node_rows: int = NODE_ROWS,
) -> DataFrame:
    """The rows that stay, with all their columns: exactly one of each component.

    It is the row with the smallest id (a null id only if the component has no other); of rows
    that share this id the one whose text has the smallest SHA-256. An id alone does not name a
    row: rows of several components may share it.
    """
    rows = fingerprints(documents(docs, text, key), width, digest=True)
    first = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sha")
    distinct = written(rows.groupBy("fp").agg(F.min(first).alias("least")))
    named = rooted(distinct, budget, node_rows)
    kept = named.groupBy("root").agg(F.min("least").alias("least"))
    return rows_of(docs, kept.select("least.doc_id", "least.sha"), text, key)

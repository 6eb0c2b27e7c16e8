"""Segments of documents that may repeat, brought together by content.

A window is a fixed number of consecutive units (bytes or words). Its anchor is the least hash
of the grams in it, so equal windows have equal anchors wherever they stand. Consecutive
windows with one anchor form a segment. Only segments whose anchor occurs more than once can
hold a repeated window; all segments of an anchor go to one shard, which compares them
exactly. An anchor with more text than a shard takes is split into several shards. Each of them
gives its windows as one sorted run of digests, cut into ranges; the runs of a range are merged by
binary search, and what was found goes back to the shards as numbers of their windows.

A row is known by 128 bits of its id and text, so no stored row number is needed and equal rows
get equal results.
"""

from __future__ import annotations

import hashlib
import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from .common import KEY, attach, content_key, give_back, per_batch, range_hashes, runs, union, written

#: Bytes of segments that one shard compares.
SHARD_BYTES = 3 << 20
#: Ranges of digests per shard of a split anchor; more make the merging tasks smaller.
RANGES = 4
#: A shard's window in a sorted run: its digest and number, the least document and times (2: or more).
ENTRY = np.dtype([("digest", "S16"), ("window", "<i4"), ("times", "<i4"), ("doc", "<i8")])


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` consecutive values."""
    n = len(values)
    if n < width:
        return values[:0]
    padded = np.full(-(-n // width) * width, np.iinfo(values.dtype).max, values.dtype)
    padded[:n] = values
    grid = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(grid, axis=1).ravel()
    behind = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def segments(units: np.ndarray, offsets: np.ndarray, window: int, gram: int):
    """(row, anchor, first window, last window, occurrences of the anchor) of each segment.

    Windows are numbered within their row. ``units`` are the rows' values one after another.
    """
    n = len(units)
    none = np.zeros(0, np.int64)
    if n < window:
        return none, none.astype(np.uint64), none, none, none
    at = np.arange(n - gram + 1)
    grams = range_hashes(units, at, at + gram)
    wide = window - gram + 1
    least = sliding_min(grams, wide)
    ends = np.repeat(offsets[1:], np.diff(offsets))[: len(least)]
    valid = np.arange(len(least)) + window <= ends
    row_of = np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))[: len(least)]
    change = np.ones(len(least), bool)
    change[1:] = (least[1:] != least[:-1]) | (row_of[1:] != row_of[:-1]) | (valid[1:] != valid[:-1])
    first = np.flatnonzero(change)
    last = np.append(first[1:], len(least)) - 1
    first, last = first[valid[first]], last[valid[first]]
    anchor, row = least[first], row_of[first]
    # where an anchor stands: grams that are the least of some window around them
    top = np.iinfo(np.uint64).max
    around = np.concatenate([np.full(wide - 1, top), np.where(valid, ~least, top), np.full(wide - 1, top)])
    stands = np.flatnonzero(~sliding_min(around, wide) == grams)
    lo, hi = np.searchsorted(stands, first), np.searchsorted(stands, last + wide)
    size = hi - lo
    owner = np.repeat(np.arange(len(first)), size)
    place = stands[np.arange(size.sum()) + np.repeat(lo - (np.cumsum(size) - size), size)]
    seen = np.bincount(owner[grams[place] == anchor[owner]], minlength=len(first))
    return row, anchor, first - offsets[row], last - offsets[row], seen


POSTING = "anchor:long,first:int,last:int,seen:int,n_bytes:long"


class Matcher:
    """What an operator gives to ``repeated``; see there."""

    window: int  # units of a window
    gram: int  # units of a gram
    between: bool  # a window counts as repeated only if a smaller document has it
    base_schema: str

    def units(self, batch: pa.RecordBatch):
        """(values, offsets, sizes): the rows' units, and a function for the bytes of unit ranges."""
        raise NotImplementedError

    def base(self, batch: pa.RecordBatch) -> dict:
        """Columns with the results of rows in which nothing is removed."""
        raise NotImplementedError

    def cutter(self, text: str):
        """A function (start, stop) -> the bytes of these units of the text."""
        raise NotImplementedError

    def classes(self, bodies: list[bytes]) -> list[np.ndarray]:
        """For each segment the class of each of its windows; equal windows, and only they, share one."""
        raise NotImplementedError

    def windows(self, body: bytes, at: list[int]) -> list[bytes]:
        """The windows of a segment that start at these places."""
        raise NotImplementedError


def repeated(docs: DataFrame, matcher: Matcher, shard_bytes: int = SHARD_BYTES):
    """(base, touched, spans).

    base: one row per input row with the results that hold if nothing is removed.
    touched: key, doc_id and text of rows that may hold a repeated window.
    spans: key, start, stop of ranges of units that repeated windows cover.
    """
    docs = docs.select(*content_key(), "doc_id", "text")

    def post(batch: pa.RecordBatch) -> pa.RecordBatch:
        units, offsets, sizes = matcher.units(batch)
        row, anchor, first, last, seen = segments(units, offsets, matcher.window, matcher.gram)
        bytes_ = sizes(first + offsets[row], last + offsets[row] + matcher.window)
        fields = [("anchor", pa.int64()), ("first", pa.int32()), ("last", pa.int32()), ("seen", pa.int32()), ("n_bytes", pa.int64())]
        values = [anchor.view(np.int64), first, last, seen, bytes_]
        entries = pa.StructArray.from_arrays(
            [pa.array(v.astype(t.to_pandas_dtype())) for v, (_, t) in zip(values, fields)], fields=[pa.field(*f) for f in fields]
        )
        counts = np.bincount(row, minlength=batch.num_rows)
        offsets_ = pa.array(np.concatenate([[0], np.cumsum(counts)]).astype(np.int32))
        columns = {c: batch[c] for c in (*KEY, "doc_id")} | matcher.base(batch)
        return pa.record_batch(columns | {"posts": pa.ListArray.from_arrays(offsets_, entries)})

    schema = f"key_a long, key_b long, doc_id long, {matcher.base_schema}, posts array<struct<{POSTING}>>"
    table = written(docs.mapInArrow(per_batch(post), schema))
    posts = table.select(*KEY, "doc_id", F.inline("posts"))
    grouped = posts.groupBy("anchor")
    total = [F.count("*").alias("n"), F.sum("n_bytes").alias("all_bytes")]
    if matcher.between:
        lowest = F.coalesce("doc_id", F.lit(-(1 << 63)))
        anchors = grouped.agg(*total, F.min(lowest).alias("lo"), F.max(lowest).alias("hi")).where("lo < hi")
    else:
        anchors = grouped.agg(*total, F.sum("seen").alias("seen")).where("seen > 1")
    parts = F.ceil(F.col("all_bytes") / shard_bytes).cast("int")
    anchors = written(anchors.select("anchor", "n", "all_bytes", parts.alias("parts")))
    found_bytes, most_parts = anchors.agg(F.sum("all_bytes"), F.max("parts")).first()
    found_bytes = found_bytes or 0
    shards = max(1, -(-found_bytes // shard_bytes))
    marked = attach(posts.select(*KEY, "anchor", "first", "last"), anchors.drop("all_bytes"), ["anchor"])
    wanted = marked.groupBy(*KEY).agg(F.collect_set(F.struct("anchor", "first", "last", "parts")).alias("posts"))
    touched = written(docs.join(wanted.hint("shuffle_hash"), KEY))

    def extract(batch: pa.RecordBatch) -> pa.RecordBatch:
        rows, bodies = [], []
        fields = {"anchor": pa.int64(), "first": pa.int32(), "last": pa.int32(), "parts": pa.int32()}
        values = {f: [] for f in fields}
        for i, (text, posts) in enumerate(zip(batch["text"].to_pylist(), batch["posts"].to_pylist())):
            cut = matcher.cutter(text)
            for p in posts:
                rows.append(i)
                for f in fields:
                    values[f].append(p[f])
                bodies.append(cut(p["first"], p["last"] + matcher.window))
        at = pa.array(rows, pa.int64())
        return pa.record_batch(
            {c: batch[c].take(at) for c in (*KEY, "doc_id")}
            | {f: pa.array(values[f], t) for f, t in fields.items()}
            | {"body": pa.array(bodies, pa.binary())}
        )

    schema = "key_a long, key_b long, doc_id long, anchor long, first int, last int, parts int, body binary"
    bodies = touched.mapInArrow(per_batch(extract), schema)
    split = F.col("parts") > 1
    dealt = bodies.withColumns(
        {
            "bucket": F.when(split, F.col("anchor")).otherwise(F.pmod("anchor", F.lit(shards))),
            "part": F.when(split, 1 + F.pmod(F.xxhash64(*KEY, "first"), "parts")).otherwise(0).cast("int"),
        }
    )

    def compare(group: pa.Table) -> pa.Table:
        try:
            return compared(group, matcher)
        finally:
            give_back()

    result = "key_a long, key_b long, start long, stop long, bucket long, part int, range int, body binary"
    found = written(dealt.groupBy("bucket", "part").applyInArrow(compare, result))
    spans = found.where("bucket IS NULL").select(*KEY, "start", "stop")
    if (most_parts or 0) > 1:
        spans = spans.unionByName(across(found.where("bucket IS NOT NULL"), matcher))
    return table.drop("posts"), touched.drop("posts"), spans


def across(found: DataFrame, matcher: Matcher) -> DataFrame:
    """The spans that shards of a split anchor repeat of one another."""
    between, window = matcher.between, matcher.window

    def look_up(group: pa.Table) -> pa.Table:
        group = group.combine_chunks()
        runs_ = [np.frombuffer(b, ENTRY) for b in group["body"].to_pylist()]
        whole, out = merged(runs_), []
        for run in runs_:
            held = whole[np.searchsorted(whole["digest"], run["digest"])]
            again = held["doc"] < run["doc"] if between else (held["times"] > 1) & (run["times"] == 1)
            out.append(run["window"][again].tobytes())
        bodies = pa.chunked_array([pa.array(out, pa.binary())])
        table = pa.table({"bucket": group["bucket"], "part": group["part"], "body": bodies})
        return table.filter(pc.greater(pc.binary_length(table["body"]), 0))

    def give(opened: pa.Table, windows: pa.Table) -> pa.Table:
        numbers = np.frombuffer(b"".join(windows["body"].to_pylist()), "<i4")
        rows, starts, stops = [], [], []
        for i, body in enumerate(opened["body"].to_pylist() if len(numbers) else ()):
            at = opened["start"][i].as_py()
            for a, b in zip(*runs(np.isin(np.frombuffer(body, "<i4"), numbers))):
                rows.append(i), starts.append(at + int(a)), stops.append(at + int(b) - 1 + window)
        taken = {c: opened[c].take(pa.array(rows, pa.int64())) for c in KEY}
        return pa.table(taken | {"start": pa.array(starts, pa.int64()), "stop": pa.array(stops, pa.int64())})

    sorted_runs = found.where("range IS NOT NULL").select("bucket", "part", "range", "body")
    windows = sorted_runs.groupBy("bucket", "range").applyInArrow(look_up, "bucket long, part int, body binary")
    opened = found.where("range IS NULL").select("bucket", "part", *KEY, "start", "body")
    both = opened.groupBy("bucket", "part").cogroup(windows.groupBy("bucket", "part"))
    return both.applyInArrow(give, "key_a long, key_b long, start long, stop long")


def merged(sorted_runs: list[np.ndarray]) -> np.ndarray:
    """One sorted run of several: digests once each, with the least document and all times (2: or more)."""
    while len(sorted_runs) > 1:
        odd = sorted_runs[len(sorted_runs) & ~1 :]
        sorted_runs = [_merged(a, b) for a, b in zip(sorted_runs[::2], sorted_runs[1::2])] + odd
    return sorted_runs[0]


def _merged(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    if len(a) < len(b):
        a, b = b, a
    a, at = a.copy(), np.searchsorted(a["digest"], b["digest"])
    held = at < len(a)
    held[held] = a["digest"][at[held]] == b["digest"][held]
    same, twin = at[held], b[held]
    a["doc"][same] = np.minimum(a["doc"][same], twin["doc"])
    a["times"][same] = np.minimum(a["times"][same] + twin["times"], 2)
    return np.insert(a, at[~held], b[~held])


def compared(group: pa.Table, matcher: Matcher) -> pa.Table:
    """The spans that a shard's segments repeat, and what a split anchor tells its other shards.

    That is a sorted run of the shard's windows, in ranges of digests, and for each segment the
    numbers of its windows that no segment here repeats (-1 for the others). Such a window's
    document is the least that the shard has it in.
    """
    group = group.combine_chunks()
    bodies, anchors = group["body"].to_pylist(), group["anchor"].to_pylist()
    doc = group["doc_id"].fill_null(-(1 << 63)).to_numpy()
    first = group["first"].to_numpy()
    split = group["part"][0].as_py() > 0
    number: dict[tuple[int, bytes], int] = {}
    which = np.array([number.setdefault(x, len(number)) for x in zip(anchors, bodies)], np.int64)
    copies = np.bincount(which)
    least = np.full(len(number), np.iinfo(np.int64).max)
    np.minimum.at(least, which, doc)
    # an anchor's only distinct segment has nothing else to be compared with, but with itself
    _, group_of, times = np.unique([a for a, _ in number], return_inverse=True, return_counts=True)
    alone = (times[group_of] == 1) & (matcher.between | (copies > 1)) & (not split)
    order = np.flatnonzero(~alone)
    order = order[np.argsort(least[order], kind="stable")]
    distinct = [b for _, b in number]
    found = matcher.classes([distinct[i] for i in order])
    sizes = np.array([len(c) for c in found], np.int64)
    flat = np.concatenate(found) if found else np.zeros(0, np.int64)
    total = int(flat.max()) + 1 if len(flat) else 0
    owner = np.repeat(order, sizes)
    seen = np.bincount(flat, copies[owner], minlength=total)
    lowest = np.full(total, np.iinfo(np.int64).max)
    np.minimum.at(lowest, flat, least[owner])
    class_of = dict(zip(order.tolist(), found))
    digests: dict[int, bytes] = {}
    rows, starts, stops = [], [], []
    open_rows, open_windows = [], []
    for i, d in enumerate(which.tolist()):
        at = int(first[i])
        if alone[d]:
            if not matcher.between or least[d] < doc[i]:
                n = group["last"][i].as_py() - at + 1
                rows.append(i), starts.append(at), stops.append(at + n - 1 + matcher.window)
            continue
        kind = class_of[d]
        again = lowest[kind] < doc[i] if matcher.between else seen[kind] > 1
        for a, b in zip(*runs(again)):
            rows.append(i), starts.append(at + int(a)), stops.append(at + int(b) - 1 + matcher.window)
        if split:
            new = {c: k for k, c in enumerate(kind.tolist()) if c not in digests}
            for c, window in zip(new, matcher.windows(bodies[i], list(new.values()))):
                digests[c] = hashlib.blake2b(window, digest_size=16).digest()
            if not again.all():
                open_rows.append(i)
                open_windows.append(np.where(again, -1, kind).astype("<i4").tobytes())
    run = np.zeros(len(digests), ENTRY)
    run["window"], run["digest"] = list(digests), list(digests.values())
    run["doc"], run["times"] = lowest[run["window"]], np.minimum(seen[run["window"]], 2)
    run = run[np.argsort(run["digest"])]
    ranges = group["parts"][0].as_py() * RANGES
    range_of = run["digest"].copy().view(">u4")[::4].astype(np.int64) * ranges >> 32
    cuts = np.flatnonzero(np.diff(range_of, prepend=-1, append=ranges))
    pieces = [run[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]

    at = pa.array(rows + open_rows, pa.int64())
    no_rows, no_spans, no_pieces = [None] * len(rows), [None] * len(open_rows), [None] * len(pieces)
    shard = len(open_rows) + len(pieces)
    return pa.table(
        {c: pa.chunked_array([*group[c].take(at).chunks, pa.nulls(len(pieces), pa.int64())], pa.int64()) for c in KEY}
        | {
            "start": pa.array(starts + first[open_rows].tolist() + no_pieces, pa.int64()),
            "stop": pa.array(stops + no_spans + no_pieces, pa.int64()),
            "bucket": pa.array(no_rows + [group["bucket"][0].as_py()] * shard, pa.int64()),
            "part": pa.array(no_rows + [group["part"][0].as_py()] * shard, pa.int32()),
            "range": pa.array(no_rows + no_spans + range_of[cuts[:-1]].tolist(), pa.int32()),
            "body": pa.array(no_rows + open_windows + pieces, pa.binary()),
        }
    )


def cut_spans(touched: DataFrame, spans: DataFrame, cut, schema: str) -> DataFrame:
    """``cut(text, starts, stops)`` -> dict of columns, for each touched row that has spans.

    The spans of a row come as maximal runs. A row's spans are bounded by its own text.
    """
    grouped = spans.groupBy(*KEY).agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    joined = touched.join(grouped.hint("shuffle_hash"), KEY)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        out = []
        for text, found in zip(batch["text"].to_pylist(), batch["spans"].to_pylist()):
            pairs = np.array([(x["start"], x["stop"]) for x in found], np.int64)
            out.append(cut(text, *union(pairs[:, 0], pairs[:, 1])))
        names = out[0].keys()
        return pa.record_batch({c: batch[c] for c in (*KEY, "doc_id")} | {c: pa.array([x[c] for x in out]) for c in names})

    return joined.mapInArrow(per_batch(work), f"key_a long, key_b long, doc_id long, {schema}")


def replaced(base: DataFrame, cut: DataFrame) -> DataFrame:
    """One row per input row: those that were cut instead of their base rows."""
    cut = written(cut)
    rest = base.join(cut.select(*KEY).distinct(), KEY, "left_anti")
    return rest.unionByName(cut).drop(*KEY)

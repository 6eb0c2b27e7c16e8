"""Repeated passages by relative Lempel-Ziv parsing.

Segments that may repeat are dealt to reference blocks by content (see ``segments``), each block
in the order of its documents' ids. A segment is factored greedily against the block's index of
all windows of earlier segments: where an indexed window starts, the factor is extended as far
as the words agree; behind a factor the windows that straddle its end are looked up too. Words
no factor covers enter the index. Factors that point into a smaller document become spans to
remove. An anchor too large for one block has several; each gives its indexed windows as a sorted
run of 128-bit digests, and every block's windows are looked up in all the others' by binary search.

Defined results. Words are runs of anything but the six ASCII white spaces, unchanged; null and
empty texts have none. A window counts only if a document with a smaller id has it: the first
document keeps it, as do repeats inside one document and rows that share an id; a null id is
smaller than any. Texts shorter than a window lose nothing. An empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .common import documents, range_hashes, text_bytes
from .segments import SHARD_BYTES, Matcher, cut_spans, repeated, replaced

WINDOW = 50
GRAM = 8
_SPACE = np.zeros(256, bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True


def word_bounds(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of all rows; no word crosses a row."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    space = _SPACE[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[offsets] = True
    begin = ~space & (np.concatenate([[True], space[:-1]]) | edge[:-1])
    end = ~space & (np.concatenate([space[1:], [True]]) | edge[1:])
    return np.flatnonzero(begin), np.flatnonzero(end) + 1


class Index:
    """The windows of a reference block, by hash; equal hashes are told apart by their words."""

    def __init__(self, words: np.ndarray, hashes: list[int], window: int):
        self.words, self.hashes, self.window = words, hashes, window
        self.at: dict[int, int] = {}
        self.exact: dict[bytes, int] = {}  # windows whose hash another window has

    def _same(self, a: int, b: int) -> bool:
        return bool((self.words[a : a + self.window] == self.words[b : b + self.window]).all())

    def find(self, i: int) -> int:
        """The place of an indexed window equal to the one at ``i``, or -1."""
        found = self.at.get(self.hashes[i], -1)
        if found < 0 or self._same(found, i):
            return found
        return self.exact.get(self.words[i : i + self.window].tobytes(), -1)

    def add(self, i: int) -> None:
        if self.at.setdefault(self.hashes[i], i) != i:
            self.exact[self.words[i : i + self.window].tobytes()] = i


def factors(words: np.ndarray, hashes: list[int], bounds: np.ndarray, window: int):
    """Factors (start, reference, length in words) of segments laid end to end, and window classes.

    Segment k is words[bounds[k]:bounds[k + 1]]. A window's class is the place of its first
    occurrence.
    """
    index, found = Index(words, hashes, window), []
    kind = np.arange(len(words))
    end_of = np.repeat(bounds[1:], np.diff(bounds))
    for k in range(len(bounds) - 1):
        i, last = int(bounds[k]), int(bounds[k + 1]) - window
        while i <= last:
            at = index.find(i)
            if at < 0:
                index.add(i)
                i += 1
                continue
            most = min(last + window - i, int(end_of[at]) - at)
            differ = np.flatnonzero(words[i + window : i + most] != words[at + window : at + most])
            length = window + int(differ[0]) if len(differ) else most
            if at + length > i:  # the segment repeats itself: its own words are no finished reference
                length = window
            found.append((i, at, length))
            covered = length - window + 1
            kind[i : i + covered] = kind[at : at + covered]
            i += covered  # the next window straddles the factor's end
    return found, kind


class Words(Matcher):
    """Windows of words, for ``segments.repeated``."""

    between = True
    base_schema = "n_words long, n_removed long, kept_sha256 string"

    def __init__(self, window: int = WINDOW, gram: int = GRAM):
        self.window, self.gram = window, min(gram, window)

    def units(self, batch: pa.RecordBatch):
        data, offsets = text_bytes(batch["text"])
        begin, end = word_bounds(data, offsets)
        bounds = np.searchsorted(begin, offsets)
        bounds[-1] = len(begin)

        def sizes(start: np.ndarray, stop: np.ndarray) -> np.ndarray:
            return end[stop - 1] - begin[start]

        return range_hashes(data, begin, end), bounds, sizes

    def base(self, batch: pa.RecordBatch) -> dict:
        words = [t.split() for t in batch["text"].cast(pa.binary()).to_pylist()]
        return {
            "n_words": pa.array([len(w) for w in words], pa.int64()),
            "n_removed": pa.array(np.zeros(len(words), np.int64)),
            "kept_sha256": pa.array([hashlib.sha256(b" ".join(w)).hexdigest() for w in words], pa.string()),
        }

    def cutter(self, text: str):
        words = text.encode().split()
        return lambda start, stop: b" ".join(words[start:stop])

    def windows(self, body: bytes, at: list[int]) -> list[bytes]:
        words = body.split(b" ") if at else []
        return [b" ".join(words[i : i + self.window]) for i in at]

    def classes(self, bodies: list[bytes]) -> list[np.ndarray]:
        if not bodies:
            return []
        number: dict[bytes, int] = {}
        cut = [[number.setdefault(w, len(number)) for w in b.split(b" ")] for b in bodies]
        bounds = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64)
        words = np.array([w for c in cut for w in c], np.int64)
        at = np.arange(len(words) - self.window + 1)
        hashes = range_hashes(words, at, at + self.window).tolist()
        _, kind = factors(words, hashes, bounds, self.window)
        return [kind[a : b - self.window + 1] for a, b in zip(bounds[:-1], bounds[1:])]


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    key: str = "doc_id",
    window: int = WINDOW,
    gram: int = GRAM,
    shard_bytes: int = SHARD_BYTES,
) -> DataFrame:
    """doc_id, n_words, n_removed, kept_sha256; one row per input row."""
    base, touched, spans = repeated(documents(docs, text, key), Words(window, gram), shard_bytes)

    def cut(text: str, starts: np.ndarray, stops: np.ndarray) -> dict:
        words = text.encode().split()
        kept, at = [], 0
        for a, b in zip(starts.tolist(), stops.tolist()):
            kept += words[at:a]
            at = b
        kept += words[at:]
        name = hashlib.sha256(b" ".join(kept)).hexdigest()
        return {"n_words": len(words), "n_removed": int((stops - starts).sum()), "kept_sha256": name}

    return replaced(base, cut_spans(touched, spans, cut, Words.base_schema))

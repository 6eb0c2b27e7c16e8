"""Byte-pair encoding by forced-boundary splitting, and decoding.

A merge can only join bytes that stand next to each other inside some vocabulary token. So
between two bytes that never do, a cut is certain, and the fragments between certain cuts are
encoded independently. All new fragments of a batch are merged together in numpy: each round
every fragment does its merge of lowest rank. A bounded cache keeps the ids of words seen.
Words of up to 16 bytes are known by their bytes, as two numbers and the length; a hash only
finds them. Longer ones are keys of a dictionary, up to a length beyond which none is kept.

Reads a ``tokenizers`` JSON file of byte-level BPE with word ends. For texts beyond the Latin
letters the library's own normaliser and splitter cut the words; the ids are always made here.
Null and empty texts have no ids. Strings of special tokens in a text become those tokens, as
in the library. Equal rows are encoded each; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import functools
import hashlib
import json
import re
import unicodedata

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from tokenizers import Tokenizer

from .common import documents, mix, per_batch

#: Words whose ids a Python worker keeps; beyond that the cache starts anew.
CACHE_WORDS = 400_000
#: Bytes of words that are known as two numbers; words of more bytes that are kept, and the longest kept.
_SHORT, _LONG_WORDS, _LONGEST = 16, 50_000, 256
_PLAIN = 0x180  # texts of characters below this need no library call
_NEVER = np.iinfo(np.int32).max


def _byte_letters() -> list[str]:
    """The printable letter of each byte in a byte-level vocabulary."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = iter(range(0x100, 0x200))
    return [chr(b) if b in shown else chr(next(others)) for b in range(256)]


_SPACE, _LETTER, _NUMBER, _OTHER = range(4)


def _plain_classes() -> np.ndarray:
    """The splitter's class of each character below _PLAIN, by its Unicode category."""
    kind = np.full(_PLAIN, _OTHER, np.uint8)
    for c in range(_PLAIN):
        kind[c] = {"L": _LETTER, "N": _NUMBER}.get(unicodedata.category(chr(c))[0], _OTHER)
    kind[[9, 10, 11, 12, 13, 32, 0x85, 0xA0]] = _SPACE
    return kind


_CLASSES = _plain_classes()


def plain_words(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the splitter's words in lower-case UTF-8 of plain characters.

    A word is a run of letters, one number character or a run of anything else but white
    space; an apostrophe that stands alone takes the contraction behind it along.
    """
    n = len(data)
    kind = np.zeros(n + 3, np.uint8)  # white space behind the end
    kind[:n] = _CLASSES[np.minimum(data, 127)]
    lead = np.flatnonzero(data >= 0xC2)
    code = ((data[lead].astype(np.int64) & 0x1F) << 6) | (data[lead + 1] & 0x3F)
    kind[lead] = kind[lead + 1] = _CLASSES[code]
    start = np.zeros(n + 3, bool)
    start[:n] = (data >> 6 != 2) & (kind[:n] != _SPACE)
    start[1:n] &= (kind[1:n] != kind[: n - 1]) | (kind[1:n] == _NUMBER)
    text = np.zeros(n + 3, np.uint8)
    text[:n] = data
    mark = np.flatnonzero(start[:n] & (data == ord("'")))
    mark = mark[start[mark + 1] & (kind[mark + 1] == _LETTER)]
    one, two = text[mark + 1], text[mark + 2]
    single = np.isin(one, list(b"stmd"))
    double = (np.isin(one, list(b"rv")) & (two == ord("e"))) | ((one == ord("l")) & (two == ord("l")))
    for found, size in ((mark[single], 1), (mark[double], 2)):
        start[found + 1] = False
        behind = found + 1 + size
        start[behind[kind[behind] == _LETTER]] = True
    stop = np.flatnonzero(start[:n] | (kind[:n] == _SPACE))
    begins = start[stop]
    return stop[begins], np.append(stop[1:], n)[begins]


class Encoder:
    """Ids of texts under one vocabulary file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        if model["type"] != "BPE" or model["continuing_subword_prefix"] or not model["end_of_word_suffix"]:
            raise ValueError("a byte-level BPE file with word ends is needed")
        self.end = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.token = {i: t for t, i in [*self.vocab.items(), *self.special.items()]}
        self.library = Tokenizer.from_file(path)
        self.letters = _byte_letters()
        self.byte_of = {c: b for b, c in enumerate(self.letters)}
        self.inner = np.array([self.vocab[c] for c in self.letters], np.int32)
        self.last = np.array([self.vocab[c + self.end] for c in self.letters], np.int32)
        self._merge_table(model["merges"])
        self._pair_tables()
        # a character beyond the plain ones, or a letter that becomes two in lower case
        self.beyond = re.compile(f"[^\x00-\u012f\u0131-{chr(_PLAIN - 1)}]")
        self.specials = re.compile("(" + "|".join(map(re.escape, self.special)) + ")") if self.special else None
        self._forget()

    def _forget(self) -> None:
        """Known words: hash (sorted), their bytes and length, and where their ids lie in the pool."""
        self.known = np.zeros(0, np.uint64)
        self.check = np.zeros((0, 3), np.uint64)
        self.long: dict[bytes, tuple[int, int]] = {}
        self.place = np.zeros((0, 2), np.int64)
        self.pool = np.zeros(0, np.uint32)

    def _merge_table(self, merges: list) -> None:
        pairs = [m if isinstance(m, list) else m.split(" ") for m in merges]
        size = len(self.vocab)
        keys = np.array([self.vocab[a] * size + self.vocab[b] for a, b in pairs], np.int64)
        self.size = size
        self.merged = np.array([self.vocab[a + b] for a, b in pairs], np.int32)
        # open addressing: a pair's rank lies in its slot or in one of the next
        self.shift = np.uint64(64 - max(4, (4 * len(pairs)).bit_length()))
        slots = 1 << (64 - int(self.shift))
        self.keys, self.rank_at, self.probes = np.full(slots, -1, np.int64), np.full(slots, _NEVER, np.int32), 1
        wait = np.arange(len(pairs))
        slot = self._slots(keys)
        while len(wait):
            free = self.keys[slot[wait]] < 0
            first = wait[free][np.unique(slot[wait[free]], return_index=True)[1]]
            self.keys[slot[first]], self.rank_at[slot[first]] = keys[first], first
            wait = np.setdiff1d(wait, first)
            slot[wait] = (slot[wait] + 1) % slots
            self.probes += bool(len(wait))

    def _pair_tables(self) -> None:
        """Whether two bytes ever stand side by side in a token: the second inside a word, or ending it."""
        self.joined = np.zeros((2, 256, 256), bool)
        for token in self.vocab:
            ends = token.endswith(self.end)
            raw = [self.byte_of[c] for c in (token[: -len(self.end)] if ends else token)]
            for i in range(len(raw) - 1):
                self.joined[int(ends and i == len(raw) - 2), raw[i], raw[i + 1]] = True

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.view(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> self.shift).astype(np.int64)

    def _ranks(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of the merges of these pairs."""
        key = left.astype(np.int64) * self.size + right
        slot = self._slots(key)
        rank = np.where(self.keys[slot] == key, self.rank_at[slot], _NEVER)
        open_ = np.flatnonzero((rank == _NEVER) & (self.keys[slot] >= 0))
        for _ in range(self.probes):
            if not len(open_):
                break
            slot[open_] = (slot[open_] + 1) % len(self.keys)
            there = self.keys[slot[open_]]
            hit = there == key[open_]
            rank[open_[hit]] = self.rank_at[slot[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return rank

    def words(self, text: str) -> list[bytes]:
        """The words of a text, as the library's normaliser and splitter cut them."""
        library, byte_of = self.library, self.byte_of
        cut = library.pre_tokenizer.pre_tokenize_str(library.normalizer.normalize_str(text))
        return [bytes(byte_of[c] for c in word) for word, _ in cut]

    def _by_word(self, text: str) -> np.ndarray:
        """The ids of a text with special tokens or characters beyond the plain ones."""
        parts = self.specials.split(text) if self.specials else [text]
        out = []
        for i, part in enumerate(parts):
            out.append(np.array([self.special[part]], np.uint32) if i % 2 else self.merge(self.words(part))[0])
        return np.concatenate(out)

    def _plain(self, texts: list[bytes]) -> list[np.ndarray]:
        """The ids of lower-case texts of plain characters; each distinct word is merged once."""
        joined = b" ".join([*texts, bytes(_SHORT)])
        data = np.frombuffer(joined, np.uint8)
        start, end = plain_words(data[: -_SHORT or None])
        ends = np.cumsum([len(t) + 1 for t in texts])
        if not len(start):
            return [np.zeros(0, np.uint32)] * len(texts)
        place = np.empty((len(start), 2), np.int64)
        short = end - start <= _SHORT
        if not self._short_places(data, start[short], (end - start)[short], place, short):
            return [self._by_word(t.decode()) for t in texts]
        long = np.flatnonzero(~short)
        more = np.zeros(0, np.uint32)
        if len(long):
            place[long], more = self._long_places([joined[a:b] for a, b in zip(start[long].tolist(), end[long].tolist())])
        pool = np.concatenate([self.pool, more]) if len(more) else self.pool
        size = place[:, 1]
        stop = np.cumsum(size)
        flat = pool[np.arange(stop[-1]) + np.repeat(place[:, 0] - (stop - size), size)]
        words_before = np.searchsorted(start, ends)
        cuts = np.concatenate([[0], stop])[words_before]
        return np.split(flat, cuts[:-1])

    def _long_places(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Where the ids of words lie, and ids to be put behind the pool, of words that are not kept."""
        new = [w for w in dict.fromkeys(words) if w not in self.long]
        kept = [w for w in new if len(w) <= _LONGEST and len(self.long) < _LONG_WORDS]
        rest = [w for w in new if len(w) > _LONGEST or len(self.long) >= _LONG_WORDS]
        ids, counts = self.merge([*kept, *rest])
        ends = np.cumsum(counts)
        begins = len(self.pool) + ends - counts
        there = dict(zip([*kept, *rest], zip(begins.tolist(), counts.tolist())))
        self.long |= {w: there[w] for w in kept}
        n = int(ends[len(kept) - 1]) if kept else 0
        self.pool = np.concatenate([self.pool, ids[:n]])
        return np.array([self.long.get(w) or there[w] for w in words], np.int64), ids[n:]

    def _short_places(self, data: np.ndarray, start: np.ndarray, size: np.ndarray, out: np.ndarray, rows: np.ndarray) -> bool:
        """Where the ids of short words lie, into ``out[rows]``; False if two words share a hash."""
        if not len(start):
            return True
        letters = np.lib.stride_tricks.sliding_window_view(data, _SHORT)[start]
        letters = letters * (np.arange(_SHORT) < size[:, None])
        check = np.empty((len(start), 3), np.uint64)
        check[:, :2] = letters.view("<u8")
        check[:, 2] = size
        hash_ = mix(check[:, 0] * np.uint64(0x9E3779B97F4A7C15) + mix(check[:, 1] + check[:, 2]))
        hashes, first, which = np.unique(hash_, return_index=True, return_inverse=True)
        if len(self.known) + len(hashes) > CACHE_WORDS:
            self._forget()
        at = np.minimum(np.searchsorted(self.known, hashes), max(len(self.known) - 1, 0))
        new = np.flatnonzero(self.known[at] != hashes) if len(self.known) else np.arange(len(hashes))
        if len(new):
            a, sizes = start[first[new]], size[first[new]]
            offset = np.cumsum(sizes) - sizes
            raw = data[np.arange(sizes.sum()) + np.repeat(a - offset, sizes)]
            ids, counts = self._merged(raw, sizes)
            place = np.stack([len(self.pool) + np.cumsum(counts) - counts, counts], 1)
            self.pool = np.concatenate([self.pool, ids])
            known = np.concatenate([self.known, hashes[new]])
            order = np.argsort(known, kind="stable")
            self.known = known[order]
            self.check = np.concatenate([self.check, check[first[new]]])[order]
            self.place = np.concatenate([self.place, place])[order]
            at = np.searchsorted(self.known, hashes)
        if (self.check[at[which]] != check).any():  # two words with one hash
            return False
        out[rows] = self.place[at[which]]
        return True

    def merge(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of the words one after another, and each word's number of ids."""
        sizes = np.array([len(w) for w in words], np.int64)
        return self._merged(np.frombuffer(b"".join(words), np.uint8), sizes)

    def _merged(self, raw: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        n = len(raw)
        ends = np.cumsum(sizes)
        word = np.repeat(np.arange(len(sizes), dtype=np.int32), sizes)
        out = self.inner[raw]
        final = np.zeros(n, bool)
        final[ends[sizes > 0] - 1] = True
        out[final] = self.last[raw[final]]
        # a fragment starts with a word and behind every certain cut
        first = np.ones(n, bool)
        first[1:] = (word[1:] != word[:-1]) | ~self.joined[final[1:].astype(np.int8), raw[:-1], raw[1:]]
        there = np.ones(n, bool)
        place, sym = np.arange(n, dtype=np.int32), out.copy()
        rank = np.full(n, _NEVER, np.int32)
        inside = np.flatnonzero(~first[1:])
        rank[inside] = self._ranks(sym[inside], sym[inside + 1])
        while len(sym):
            starts = np.flatnonzero(first)
            best = np.repeat(np.minimum.reduceat(rank, starts), np.diff(starts, append=len(sym)))
            active = best != _NEVER
            if not active.all():  # finished fragments leave
                out[place[~active]] = sym[~active]
                place, sym, rank, first, best = (x[active] for x in (place, sym, rank, first, best))
                if not len(sym):
                    break
            chosen = rank == best
            double = np.flatnonzero(chosen[1:] & chosen[:-1])
            if len(double):  # runs of one symbol: pairs from the left
                starts = np.flatnonzero(chosen & ~np.concatenate([[False], chosen[:-1]]))
                where = np.flatnonzero(chosen)
                run = starts[np.searchsorted(starts, where, "right") - 1]
                chosen[where[(where - run) % 2 == 1]] = False
            at = np.flatnonzero(chosen)
            sym[at] = self.merged[best[at]]
            there[place[at + 1]] = False
            keep = np.ones(len(sym), bool)
            keep[at + 1] = False
            moved = np.cumsum(keep) - 1
            at = moved[at]
            place, sym, rank, first = place[keep], sym[keep], rank[keep], first[keep]
            follows = np.concatenate([~first[1:], [False]])  # the next symbol is of the same fragment
            stale = np.concatenate([at, at[~first[at]] - 1])
            known = stale[follows[stale]]
            rank[stale] = _NEVER
            rank[known] = self._ranks(sym[known], sym[known + 1])
        return out[there].astype(np.uint32), np.bincount(word[there], minlength=len(sizes))

    def encode(self, texts: list[str]) -> list[np.ndarray]:
        """uint32 ids of each text."""
        out: list = [None] * len(texts)
        plain = []
        for i, t in enumerate(texts):
            if self.beyond.search(t) or "<" in t and self.specials and self.specials.search(t):
                out[i] = self._by_word(t)
            else:
                plain.append(i)
        for i, ids in zip(plain, self._plain([texts[i].lower().encode() for i in plain]) if plain else ()):
            out[i] = ids
        return out

    def decode(self, ids) -> str:
        """The tokens joined by a space: the file has no decoder."""
        return " ".join([self.token[i] for i in ids])


@functools.lru_cache(maxsize=2)
def encoder(path: str) -> Encoder:
    """One encoder per Python worker."""
    return Encoder(path)


def encoded(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, ids array<int>; one row per input row."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids = encoder(path).encode(batch["text"].to_pylist())
        return pa.record_batch(
            {"doc_id": batch["doc_id"], "ids": pa.array([x.astype(np.int32) for x in ids], pa.list_(pa.int32()))}
        )

    return documents(docs, text, key).mapInArrow(per_batch(work), "doc_id long, ids array<int>")


def digests(docs: DataFrame, path: str, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and decoded_sha256, from encoding and decoding each text."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        model = encoder(path)
        counts, names, texts = [], [], []
        shown = list(map(str, range(max(model.token) + 1)))
        for ids in model.encode(batch["text"].to_pylist()):
            ids = ids.tolist()
            counts.append(len(ids))
            names.append(hashlib.sha256(" ".join([shown[i] for i in ids]).encode()).hexdigest())
            texts.append(hashlib.sha256(model.decode(ids).encode()).hexdigest())
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "n_tokens": pa.array(counts, pa.int64()),
                "ids_sha256": pa.array(names, pa.string()),
                "decoded_sha256": pa.array(texts, pa.string()),
            }
        )

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    return documents(docs, text, key).mapInArrow(per_batch(work), schema)

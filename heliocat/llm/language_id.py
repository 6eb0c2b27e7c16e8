"""Language of texts by a linear-chain conditional random field over their words.

A word's label depends on features of the word (character n-grams up to four letters of the
word with marks at both ends, so those that touch a mark are its affixes, and membership in a
lexicon of each language) and on its neighbours through learned transitions. Training text is
spliced from runs of words of several documents, so the transitions fit code-switched text.
Marginals come from the forward-backward algorithm over the whole text; a text's language is
the label with the largest mean marginal, which is the score.

Training takes at most TRAIN_ROWS rows of each language, of at most TRAIN_CHARS characters
each, to the driver; prediction runs on all rows and whole texts. A long text is cut in blocks
whose transfer matrices are multiplied up, which gives the same marginals as one long chain.

Defined results. ``und`` with score 0 for a null or empty text and for one without a letter
(or if nothing could be learned). Equal rows are labelled each; ties go to the first language
by name; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import documents, in_small_batches, per_batch, smallest_hashes

TRAIN_ROWS = 150
TRAIN_CHARS = 20_000
LEXICON = 2000  # words of each language's lexicon
BUCKETS = 1 << 16  # of n-gram features
BLOCK = 64  # words of a block of the chain
ROUNDS = 20
CACHE_WORDS = 400_000
UNKNOWN = "und"

_WORD = re.compile(r"[^\W\d_]+")
_START, _END = "\x02", "\x03"


def words(text: str | None) -> list[str]:
    """The runs of letters, in lower case; none if no letter is among them."""
    found = _WORD.findall(text.lower()) if text else []
    return found if any(c.isalpha() for w in found for c in w) else []


def _grams(part: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """n-gram buckets of all words, whether each lies in one word, and where words begin."""
    codes = np.frombuffer("".join([_START + w + _END for w in part]).encode("utf-32-le", "surrogatepass"), np.uint32)
    first = np.flatnonzero(codes == 2)
    end = np.append(first[1:], len(codes))
    room = np.repeat(end, end - first) - np.arange(len(codes))  # letters up to the word's end
    rows, h = [], np.zeros(len(codes), np.uint64)
    for n in range(4):
        shifted = np.zeros(len(codes), np.uint64)
        shifted[: len(codes) - n] = codes[n:]
        h = (h ^ (shifted + np.uint64(n + 1))) * np.uint64(0x9E3779B97F4A7C15)
        h ^= h >> np.uint64(29)
        rows.append((h >> np.uint64(20)) & np.uint64(BUCKETS - 1))
    valid = np.stack([room > n for n in range(4)])
    return np.stack(rows).astype(np.int64), valid, first


def transfer(emission: np.ndarray, there: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """For blocks (n, t, L) the product of their step matrices, each scaled to a largest entry of 1."""
    n, steps, size = emission.shape
    out = np.broadcast_to(np.eye(size, dtype=emission.dtype), (n, size, size)).copy()
    for t in range(steps):
        now = (out @ trans) * emission[:, t, None, :]
        now /= now.max(axis=(1, 2), keepdims=True)
        out = np.where(there[:, t, None, None], now, out)
    return out


def marginals(emission: np.ndarray, doc: np.ndarray, trans: np.ndarray) -> np.ndarray:
    """Label probabilities of every word of several chains.

    ``emission`` (words, L) are positive potentials, ``doc`` the chain of each word (sorted).
    A chain starts with equal weights; between words the potentials ``trans`` apply.
    """
    total, size = emission.shape
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    length = np.diff(starts, append=total)
    blocks = -(-length // BLOCK)
    first = np.cumsum(blocks) - blocks
    n = int(blocks.sum())
    inside = np.arange(total) - np.repeat(starts, length)
    row, col = np.repeat(first, length) + inside // BLOCK, inside % BLOCK
    e = np.ones((n, BLOCK, size), emission.dtype)
    there = np.zeros((n, BLOCK), bool)
    e[row, col], there[row, col] = emission, True
    whole = transfer(e, there, trans)
    # what enters each block from the left and from the right, block by block of all chains at once
    left = np.ones((n, size), emission.dtype)
    right = np.ones((n, size), emission.dtype)
    for k in range(1, int(blocks.max())):
        at = first[blocks > k] + k
        left[at] = _scaled(np.einsum("ni,nij->nj", left[at - 1], whole[at - 1]))
        last = first[blocks > k] + blocks[blocks > k] - 1 - k
        right[last] = _scaled(np.einsum("nij,nj->ni", whole[last + 1], right[last + 1]))
    alpha = np.empty_like(e)
    state = left
    for t in range(BLOCK):
        state = _scaled((state @ trans) * e[:, t])
        alpha[:, t] = state
    state = right
    for t in reversed(range(BLOCK)):
        alpha[:, t] *= state
        state = np.where(there[:, t, None], _scaled((e[:, t] * state) @ trans.T), state)
    out = alpha[row, col]
    return out / out.sum(axis=1, keepdims=True)


def transitions(emission: np.ndarray, doc: np.ndarray, trans: np.ndarray, weight: np.ndarray) -> np.ndarray:
    """Expected transitions of several chains, each weighted by its left word; the start counts by its shares.

    A pair of neighbours has the probability forward state x transition x emission x backward
    state, scaled to 1. The chains are short, as they are all held at once.
    """
    total, size = emission.shape
    starts = np.flatnonzero(np.concatenate([[True], doc[1:] != doc[:-1]]))
    length = np.diff(starts, append=total)
    n, steps = len(starts), int(length.max())
    row = np.repeat(np.arange(n), length)
    col = np.arange(total) - starts[row]
    e, there, w = np.ones((n, steps, size)), np.zeros((n, steps), bool), np.zeros((n, steps))
    e[row, col], there[row, col], w[row, col] = emission, True, weight
    ahead = np.empty((n, steps, size))
    state = np.ones((n, size))
    for t in range(steps):
        state = _scaled((state @ trans) * e[:, t])
        ahead[:, t] = state
    back = np.ones((n, size))
    out = np.zeros((size, size))
    for t in reversed(range(steps - 1)):
        after = e[:, t + 1] * back
        pair = ahead[:, t, :, None] * trans * after[:, None, :]
        pair *= (w[:, t] * there[:, t + 1] / pair.sum(axis=(1, 2)))[:, None, None]
        out += pair.sum(axis=0)
        back = np.where(there[:, t + 1, None], _scaled(after @ trans.T), back)
    first = ahead[:, 0] * back
    first *= (w[:, 0] / first.sum(axis=1))[:, None]
    return out + trans / trans.sum(axis=0) * first.sum(axis=0)


def _scaled(x: np.ndarray) -> np.ndarray:
    return x / x.max(axis=1, keepdims=True)


class Model:
    """Weights of the field; a worker keeps the scores of words it has seen."""

    def __init__(self, languages: list[str]):
        size = len(languages)
        self.languages = languages
        self.grams = np.zeros((BUCKETS, size), np.float32)
        self.in_lexicon = np.zeros((size, size), np.float32)
        self.bias = np.zeros(size, np.float32)
        self.trans = np.zeros((size, size), np.float32)
        self.lexicon: dict[str, tuple[int, ...]] = {}
        self._forget()

    def _forget(self) -> None:
        self.place: dict[str, int] = {}
        self.known = np.zeros((1024, len(self.languages)), np.float32)

    def __getstate__(self) -> dict:
        return {k: v for k, v in self.__dict__.items() if k not in ("place", "known")}

    def __setstate__(self, state: dict) -> None:
        self.__dict__.update(state)
        self._forget()

    def features(self, part: list[str]):
        """n-gram buckets with the word of each, and the lexicon matrix."""
        grams, valid, first = _grams(part)
        member = np.zeros((len(part), len(self.languages)), np.float32)
        for i, w in enumerate(part):
            if w in self.lexicon:
                member[i, list(self.lexicon[w])] = 1
        return grams, valid, first, member

    def word_scores(self, part: list[str]) -> np.ndarray:
        grams, valid, first, member = self.features(part)
        summed = np.zeros((grams.shape[1], len(self.languages)), np.float32)
        for bucket, ok in zip(grams, valid):
            summed += self.grams[bucket] * ok[:, None]
        return np.add.reduceat(summed, first) + member @ self.in_lexicon + self.bias

    def emissions(self, flat: list[str]) -> np.ndarray:
        """The potentials of words, largest 1."""
        new = [w for w in dict.fromkeys(flat) if w not in self.place]
        if len(self.place) + len(new) > CACHE_WORDS:
            self._forget()
            new = list(dict.fromkeys(flat))
        base, need = len(self.place), len(self.place) + len(new)
        if need > len(self.known):
            grown = np.zeros((max(need, 2 * len(self.known)), self.known.shape[1]), np.float32)
            grown[:base] = self.known[:base]
            self.known = grown
        for at in range(0, len(new), 20_000):
            part = new[at : at + 20_000]
            scores = self.word_scores(part)
            self.known[base + at : base + at + len(part)] = np.exp(
                np.maximum(scores - scores.max(axis=1, keepdims=True), -30)
            )
        self.place.update({w: base + i for i, w in enumerate(new)})
        return self.known[[self.place[w] for w in flat]]

    def label(self, texts: list[str | None]) -> list[tuple[list[str], np.ndarray]]:
        """The words of each text with their label probabilities."""
        cut = [words(t) for t in texts]
        sizes = [len(x) for x in cut]
        flat = [w for x in cut for w in x]
        if not flat:
            return [(x, np.zeros((0, len(self.languages)))) for x in cut]
        doc = np.repeat(np.arange(len(cut)), sizes)
        found = marginals(self.emissions(flat), doc, np.exp(self.trans))
        return list(zip(cut, np.split(found, np.cumsum(sizes)[:-1])))


def fit(rows: list[tuple[str, str]], seed: int = 5) -> Model | None:
    """The field learned from (text, language) rows; None if there is no word."""
    rows = [(lang, w) for text, lang in rows if (w := words(text))]
    if not rows:
        return None
    rng = np.random.default_rng(seed)
    model = Model(sorted({lang for lang, _ in rows}))
    code = {lang: i for i, lang in enumerate(model.languages)}
    counts = {lang: Counter() for lang in code}
    for lang, w in rows:
        counts[lang].update(w)
    for lang, i in code.items():
        for w, n in counts[lang].most_common(LEXICON):
            if n > 1:
                model.lexicon[w] = (*model.lexicon.get(w, ()), i)
    # runs of 8 to 40 words in random order, laid end to end and cut into chains of 64 words
    pieces = []
    for lang, w in rows:
        at = 0
        while at < len(w):
            n = int(rng.integers(8, 41))
            pieces.append((code[lang], w[at : at + n]))
            at += n
    order = rng.permutation(len(pieces))
    flat = [w for i in order for w in pieces[i][1]]
    gold = np.concatenate([np.full(len(pieces[i][1]), pieces[i][0]) for i in order])
    chain = np.arange(len(flat)) // BLOCK
    types = list(dict.fromkeys(flat))
    where = {w: i for i, w in enumerate(types)}
    token = np.array([where[w] for w in flat])
    grams, valid, first, member = model.features(types)
    owner = np.repeat(np.arange(len(types)), np.diff(first, append=grams.shape[1]))
    size = len(code)
    # how often a language's words appear must not decide: each language weighs the same
    weight = (1 / np.bincount(gold, minlength=size) / size).astype(np.float64)[gold]
    same = chain[1:] == chain[:-1]
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    squares = [np.full(x.shape, 1e-8) for x in (model.grams, model.in_lexicon, model.bias, model.trans)]
    onehot = np.eye(size)[gold]
    seen = (onehot[:-1][same] * weight[:-1][same, None]).T @ onehot[1:][same]
    for _ in range(ROUNDS):
        scores = model.word_scores(types)
        e = np.exp(np.maximum(scores - scores.max(axis=1, keepdims=True), -30))[token].astype(np.float64)
        trans = np.exp(model.trans.astype(np.float64))
        p = marginals(e, chain, trans)
        error = (onehot - p) * weight[:, None]
        by_type = np.stack([np.bincount(token, error[:, k], minlength=len(types)) for k in range(size)], 1)
        slope = np.zeros(model.grams.shape)
        for bucket, ok in zip(grams, valid):
            for k in range(size):
                slope[:, k] += np.bincount(bucket[ok], by_type[owner[ok], k], minlength=BUCKETS)
        # transitions seen against those expected under the field; a start is one from any label
        begun = (onehot[starts] * weight[starts, None]).sum(axis=0)
        moved = seen + trans / trans.sum(axis=0) * begun - transitions(e, chain, trans, weight)
        slopes = (slope, member.T @ by_type, by_type.sum(axis=0), moved)
        for value, square, g in zip((model.grams, model.in_lexicon, model.bias, model.trans), squares, slopes):
            square += g * g
            value += (0.3 * g / np.sqrt(square) - 1e-4 * value).astype(np.float32)
    return model


def training_rows(docs: DataFrame, usable: Column, text: str, lang: str, key: str) -> list[tuple[str, str]]:
    """At most TRAIN_ROWS rows of each language, those of smallest hash; bounded for the driver."""
    rows = docs.select(F.col(text).alias("t"), F.col(lang).cast("string").alias("l"), usable.alias("ok"))
    rows = rows.where("ok AND l IS NOT NULL AND length(t) BETWEEN 1 AND " + str(TRAIN_CHARS))
    rows = rows.withColumn("h", F.xxhash64("t"))
    distinct = rows.select("l", "h").distinct()
    last = smallest_hashes(distinct, "l", "h", TRAIN_ROWS).groupBy("l").agg(F.max("h").alias("last"))
    taken = rows.join(F.broadcast(last), "l").where("h <= last").select("l", "h", "t").distinct()
    return [(r["t"], r["l"]) for r in taken.orderBy("l", "h", "t").collect()]


def train(
    docs: DataFrame, usable: Column, text: str = "text", lang: str = "lang", key: str = "doc_id"
) -> Model | None:
    """The field learned from the rows for which ``usable`` holds."""
    return fit(training_rows(docs, usable, text, lang, key))


def predict(docs: DataFrame, model: Model | None, text: str = "text", key: str = "doc_id") -> DataFrame:
    """doc_id, lang_pred, score, n_words, runs (stretches of one label: label, first word, words)."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    run = pa.list_(pa.struct([("lang", pa.string()), ("start", pa.int64()), ("n_words", pa.int64())]))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        field = shared.value
        texts = batch["text"].to_pylist()
        found = field.label(texts) if field else [((), ())] * len(texts)
        out = []
        for cut, p in found:
            if not len(cut):
                out.append((UNKNOWN, 0.0, 0, []))
                continue
            mean = p.mean(axis=0)
            best = int(mean.argmax())
            label = p.argmax(axis=1)
            at = np.flatnonzero(np.concatenate([[True], label[1:] != label[:-1]]))
            runs = [
                {"lang": field.languages[label[i]], "start": i, "n_words": n}
                for i, n in zip(at.tolist(), np.diff(at, append=len(label)).tolist())
            ]
            out.append((field.languages[best], min(float(mean[best]), 1.0), len(cut), runs))
        return pa.record_batch(
            {
                "doc_id": batch["doc_id"],
                "lang_pred": pa.array([x[0] for x in out], pa.string()),
                "score": pa.array([x[1] for x in out], pa.float64()),
                "n_words": pa.array([x[2] for x in out], pa.int64()),
                "runs": pa.array([x[3] for x in out], run),
            }
        )

    schema = "doc_id long, lang_pred string, score double, n_words long, runs array<struct<lang:string,start:long,n_words:long>>"
    return documents(docs, text, key).mapInArrow(per_batch(work), schema)


def keep_known(docs: DataFrame, model: Model | None, text: str = "text", least: float = 0.0) -> DataFrame:
    """The rows whose language is known with at least the score ``least``, with all their columns."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if shared.value is None:
            return batch.slice(0, 0)
        found = shared.value.label(batch[text].to_pylist())
        return batch.filter(pa.array([len(c) > 0 and p.mean(axis=0).max() >= least for c, p in found], pa.bool_()))

    return in_small_batches(docs).mapInArrow(per_batch(work, text), docs.schema)

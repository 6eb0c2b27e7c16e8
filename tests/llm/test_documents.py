"""The operators over documents against plain Python, on a test folder and edge rows."""

import random
import zlib
from collections import Counter

import brute
import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from heliocat.llm import bpe, exact_dedup, language_id, packing, pii, quality, rlz_dedup, segments, simhash, suffix_dedup

FOLDER = "/root/testdata/sf0.001"
VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def docs(spark):
    return brute.documents(spark, FOLDER).cache()


@pytest.fixture(scope="module")
def data(docs):
    return brute.rows(docs)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(VOCABULARY)


def counted(df, *columns) -> Counter:
    return Counter(tuple(r) for r in df.select(*columns).collect())


@pytest.mark.parametrize("bits", [64, 3])
def test_exact_groups(docs, data, bits):
    """Three-bit hashes clash all the time; the result is the same."""
    found = exact_dedup.exact_groups(docs, bits=bits)
    assert counted(found, "doc_id", "keep_id", "group_size", "text_sha256") == brute.exact(data)
    kept = counted(found.where("kept"), "doc_id", "text_sha256")
    assert kept == Counter({(k, s): 1 for (_, k, _, s) in brute.exact(data)})


def test_drop_copies_keeps_columns(docs, data):
    left = exact_dedup.drop_copies(docs)
    assert left.columns == docs.columns
    assert Counter(brute.sha(t) for _, t in brute.rows(left)) == Counter({brute.sha(t) for _, t in data})


def test_chunks_depend_on_content_only():
    text = np.random.default_rng(0).integers(97, 123, 100_000, dtype=np.uint8)
    whole = exact_dedup.chunk_ends(text, np.array([0, len(text)]))[0]
    moved = exact_dedup.chunk_ends(np.concatenate([text[:777], text]), np.array([0, 777, 777 + len(text)]))[1]
    assert [e + 777 for e in whole] == moved
    assert len(whole) > 20 and max(np.diff(whole)) <= exact_dedup.MAX_CHUNK


@pytest.mark.parametrize("node_rows", [1 << 16, 8])
def test_simhash(docs, data, node_rows):
    found = simhash.near_duplicates(docs, node_rows=node_rows)
    assert counted(found, "doc_id", "fingerprint", "component_id") == brute.near(data)


def test_trie_join_finds_all_pairs():
    rng = np.random.default_rng(4)
    seeds = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 30), dtype=np.uint64)
    fps = np.unique(np.concatenate([seeds, (seeds[:, None] ^ flips).ravel(), (seeds[:, None] ^ flips ^ flips[:, ::-1]).ravel()]))
    for budget in (0, 1, 2, 5):
        pairs = {tuple(p) for block in simhash.linked_pairs(fps, None, budget) for p in block.tolist()}
        near = np.argwhere(np.triu(np.bitwise_count(fps[:, None] ^ fps[None]) <= budget, 1))
        assert pairs == {tuple(p) for p in near.tolist()}
        some, rest = fps[::3], fps[1::3]
        pairs = {tuple(p) for block in simhash.linked_pairs(some, rest, budget) for p in block.tolist()}
        assert pairs == {tuple(p) for p in np.argwhere(np.bitwise_count(some[:, None] ^ rest[None]) <= budget).tolist()}


def test_near_stage_keeps_one_of_each_component(docs, data):
    left = simhash.drop_near_duplicates(docs)
    assert left.columns == docs.columns
    kept = Counter(r["doc_id"] for r in left.collect())
    assert set(kept.values()) == {1} and set(kept) == {c for _, _, c in brute.near(data)}


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2000])
def test_relative_parsing(docs, data, shard_bytes):
    """Small shards split every repeated anchor."""
    found = rlz_dedup.remove_repeats(docs, shard_bytes=shard_bytes)
    assert counted(found, "doc_id", "n_words", "n_removed", "kept_sha256") == brute.passages(data)


@pytest.mark.parametrize("shard_bytes", [1 << 20, 2000])
def test_suffix_arrays(docs, data, shard_bytes):
    found = suffix_dedup.remove_repeats(docs, shard_bytes=shard_bytes)
    assert counted(found, "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256") == brute.strings(data)


@pytest.mark.parametrize("window", [50, 400])
def test_classes_of_near_copies(window):
    """Strings equal over more than a window and then not; each class is one window's bytes."""
    rng, wrong = random.Random(2), 0
    for _ in range(5):
        base = bytes(rng.choices(b"ab", k=6 * window))
        bodies = [bytearray(base) for _ in range(12)]
        for body in bodies:
            for _ in range(rng.randrange(1, 6)):
                body[rng.randrange(len(body))] = rng.choice(b"abc")
        class_of, window_of = {}, {}
        for body, kinds in zip(map(bytes, bodies), suffix_dedup.Bytes(window, 8).classes(list(map(bytes, bodies)))):
            for at, kind in enumerate(kinds.tolist()):
                here = body[at : at + window]
                wrong += class_of.setdefault(here, kind) != kind or window_of.setdefault(kind, here) != here
    assert wrong == 0


@pytest.mark.parametrize("window", [16, 50, 400])
def test_classes_of_strings_that_end_in_zero_bytes(window):
    """Zero bytes at a shard's end are no end; each class is one window's bytes."""
    wrong = 0
    for bodies in ([b"x" + bytes(window + 1)], [bytes(window + 5) + b"q", b"q" + bytes(window)], [b"ab" + bytes(3 * window)]):
        class_of, window_of = {}, {}
        for body, kinds in zip(bodies, suffix_dedup.Bytes(window, 8).classes(bodies)):
            for at, kind in enumerate(kinds.tolist()):
                here = body[at : at + window]
                wrong += class_of.setdefault(here, kind) != kind or window_of.setdefault(kind, here) != here
    assert wrong == 0


def test_sorted_runs_of_shards_merge():
    rng = random.Random(5)
    plain, some = {}, []
    for part in range(5):
        run = np.zeros(rng.randrange(60), segments.ENTRY)
        names = sorted(rng.sample([bytes([a, b]) * 7 + bytes([a, 0]) for a in range(9) for b in range(9)], len(run)))
        run["digest"], run["window"] = names, range(len(run))
        run["times"], run["doc"] = rng.choices([1, 2], k=len(run)), rng.sample(range(99), len(run))
        some.append(run)
        for name, times, doc in zip(names, run["times"].tolist(), run["doc"].tolist()):
            before = plain.get(name, (0, doc))
            plain[name] = min(before[0] + times, 2), min(before[1], doc)
    whole = segments.merged(some)
    found = zip(whole["digest"].tolist(), whole["times"].tolist(), whole["doc"].tolist())
    assert [(d.ljust(16, b"\0"), n, m) for d, n, m in found] == [(d, *plain[d]) for d in sorted(plain)]


def test_suffix_order_and_common_prefixes():
    rng = random.Random(2)
    text = bytes(rng.choice(b"ab\x00") for _ in range(600)) + b"abab" * 300
    array = np.frombuffer(text, np.uint8)
    words = suffix_dedup.first_words(array)
    sa = suffix_dedup.suffix_array(array, words, 1 << 12)
    shared = suffix_dedup.common_prefixes(words, sa, 1 << 12)
    # suffixes that differ only in length beyond zero padding may tie; prefixes tell them apart
    for a, b in zip(sa[:-1], sa[1:]):
        x, y = text[a:], text[b:]
        n = next((i for i, (p, q) in enumerate(zip(x, y)) if p != q), min(len(x), len(y)))
        assert shared[b] == n
        assert x[: n + 1] <= y[: n + 1] or n == min(len(x), len(y))


def test_language(docs, data):
    usable = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 5 != 0
    model = language_id.train(docs, usable)
    found = language_id.predict(docs, model).collect()
    assert len(found) == len(data)
    lang = {r["doc_id"]: r["lang"] for r in docs.select("doc_id", "lang").collect()}
    held = [r for r in found if r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0 and lang[r["doc_id"]]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) > 0.95
    assert all(0 <= r["score"] <= 1 for r in found)
    und = {r["doc_id"] for r in found if r["lang_pred"] == "und"}
    assert und == {i for i, t in data if not any(c.isalpha() for c in t)}
    assert language_id.keep_known(docs, model).columns == docs.columns


def test_code_switched_words(docs):
    model = language_id.train(docs, F.lit(True))
    by_lang = {r["lang"]: r["text"] for r in docs.where("lang IN ('en', 'de') AND n_chars > 500").collect()}
    mixed = " ".join(by_lang["en"].split()[:60] + by_lang["de"].split()[:60])
    _, p = model.label([mixed])[0]
    label = [model.languages[i] for i in p.argmax(axis=1)]
    assert label[:50].count("en") > 45 and label[-50:].count("de") > 45


def test_marginals_equal_the_plain_chain():
    rng = np.random.default_rng(0)
    sizes = [1, 400, 64, 65, 170]
    e, trans = rng.random((sum(sizes), 3)) + 0.01, rng.random((3, 3)) + 0.1
    doc = np.repeat(np.arange(len(sizes)), sizes)
    got = language_id.marginals(e, doc, trans)
    for d in range(len(sizes)):
        x = e[doc == d]
        ahead, back = [], []
        state = np.ones(3)
        for row in x:
            state = (state @ trans) * row
            state /= state.sum()
            ahead.append(state)
        state = np.ones(3)
        for row in x[::-1]:
            back.append(state)
            state = trans @ (row * state)
            state /= state.sum()
        p = np.array(ahead) * np.array(back[::-1])
        assert np.allclose(p / p.sum(axis=1, keepdims=True), got[doc == d])


def test_transition_gradient_by_finite_differences():
    """Seen less expected transitions are the slope of the chains' log-likelihood."""
    rng = np.random.default_rng(2)
    sizes = [64, 1, 17, 2]
    doc = np.repeat(np.arange(4), sizes)
    e, theta, gold = rng.random((84, 4)) + 0.05, rng.normal(size=(4, 4)), rng.integers(0, 4, 84)

    def likelihood(theta):
        total = 0.0
        for d in range(4):
            x, y = e[doc == d], gold[doc == d]
            state = np.ones(4)
            scale = 0.0
            for row in x:
                state = (state @ np.exp(theta)) * row
                scale += np.log(state.sum())
                state /= state.sum()
            path = np.log(np.exp(theta)[:, y[0]].sum()) + np.log(x[np.arange(len(y)), y]).sum() + theta[y[:-1], y[1:]].sum()
            total += path - scale
        return total

    trans, onehot = np.exp(theta), np.eye(4)[gold]
    same = doc[1:] == doc[:-1]
    starts = np.flatnonzero(np.concatenate([[True], ~same]))
    seen = onehot[:-1][same].T @ onehot[1:][same] + trans / trans.sum(axis=0) * onehot[starts].sum(axis=0)
    slope = seen - language_id.transitions(e, doc, trans, np.ones(84))
    for i in range(4):
        for j in range(4):
            step = np.zeros((4, 4))
            step[i, j] = 1e-5
            assert abs((likelihood(theta + step) - likelihood(theta - step)) / 2e-5 - slope[i, j]) < 1e-4


def test_quality(spark, docs, data):
    labels = spark.read.parquet(f"{FOLDER}/labels.parquet")
    labels = labels.unionByName(spark.createDataFrame([(None, 1, 0), (900001, None, 0)], labels.schema))
    model = quality.train(docs, labels, F.lit(True))
    found = quality.score(docs, model).collect()
    assert len(found) == len(data) and all(0 <= r["score"] <= 1 for r in found)
    marks = {r["doc_id"]: r["quality"] for r in labels.collect()}
    known = [r for r in found if marks.get(r["doc_id"]) is not None]
    assert np.mean([(r["score"] >= 0.7) == (marks[r["doc_id"]] == 1) for r in known]) > 0.95
    one = labels.where("quality = 1")
    assert {r["score"] for r in quality.score(docs, quality.train(docs, one, F.lit(True))).collect()} == {1.0}
    assert quality.train(docs, labels.limit(0), F.lit(True)) == 0.5


def test_quality_ranks_only_rows_it_can_learn_from(spark, monkeypatch):
    """The labels of smallest hash in class 0 have texts that are too long; one id has many rows."""
    monkeypatch.setattr(quality, "TRAIN_ROWS", 20)
    ids = [r["id"] for r in spark.range(200).orderBy(F.xxhash64("id")).collect()]
    junk, good = ids[:100], ids[100:]
    text = {i: f"buy now {i} !!! " * 5 for i in junk} | {i: f"The house of number {i} is old and quiet. " * 2 for i in good}
    long = {i: text[i] * 400 for i in junk[:60]}
    labels = spark.createDataFrame([(i, int(i in good)) for i in ids], "doc_id long, quality int")
    rows = [*(text | long).items(), *[(good[0], text[good[0]])] * 200, *[(good[0], f"another {k}") for k in range(200)]]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    marks = labels.withColumnRenamed("quality", "y")
    taken = Counter(r["y"] for r in quality.training_rows(quality._inputs(docs, "text", "doc_id", "n_chars"), marks).collect())
    assert taken == {0: 20, 1: 20}
    found = quality.score(docs, quality.train(docs, labels, F.lit(True))).collect()
    assert np.mean([r["score"] < 0.4 for r in found if r["doc_id"] in junk]) > 0.9
    assert np.mean([r["score"] > 0.6 for r in found if r["doc_id"] in good[1:]]) > 0.9
    only_long = docs.where(~F.col("doc_id").isin(junk[60:]))
    assert quality.train(only_long, labels, F.lit(True)) == 0.5


def test_interactions_in_linear_time_equal_all_pairs():
    rng = np.random.default_rng(1)
    machine = quality.Machine(np.zeros((quality.STATISTICS, quality.CUTS - 1)))
    machine.linear = rng.normal(size=len(machine.linear))
    rows, feature, value = np.zeros(9, int), rng.permutation(5000)[:9], rng.random(9)
    fast = machine.raw(rows, feature, value, 1)[0][0]
    v = machine.factors[feature]
    slow = machine.linear[feature] @ value + sum(
        v[i] @ v[j] * value[i] * value[j] for i in range(9) for j in range(i)
    )
    assert abs(fast - slow) < 1e-9


def test_encoding(docs, data, library):
    found = {(r["doc_id"], r["n_tokens"], r["ids_sha256"], r["decoded_sha256"]) for r in bpe.digests(docs, VOCABULARY).collect()}
    exp = set()
    for i, t in data:
        ids = library.encode(t, add_special_tokens=False).ids
        exp.add((i, len(ids), brute.sha(" ".join(map(str, ids))), brute.sha(library.decode(ids, skip_special_tokens=False))))
    assert found == exp


def test_encoding_of_random_texts(library):
    rng = random.Random(3)
    pools = [
        "abcdefghijklmnopqrstuvwxyz      '",
        "aàáâÀÉéñÑüßſİıÿ's're'll123½²ªº\xa0\x85\x1c\x00\t\n",
        "".join(chr(c) for c in range(0x3000)),
        "日本語テ한국어​　 é ΣΑΣ ς <|endoftext|>",
    ]
    texts = ["".join(rng.choice(p) for _ in range(rng.randrange(60))) for p in pools for _ in range(300)]
    texts += ["aaaaaaaaaa", "hahahahaha", "x<|endoftext|>y<|startoftext|>", "<|endoftext"]
    got = bpe.encoder(VOCABULARY).encode(texts)
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def thue_morse(n, pair):
    return "".join(pair[i.bit_count() & 1] for i in range(n))


def test_words_are_known_by_their_bytes(spark, library):
    """Thue-Morse words and their complements collide in any polynomial hash modulo a power of two."""
    texts = [thue_morse(n, p) for n in (8, 16, 17, 64, 256, 257, 512, 1024, 2048, 4096) for p in ("ab", "ba")]
    texts += [f"{a} {b}" for a in texts[:6] for b in texts[:6]]
    got = bpe.Encoder(VOCABULARY).encode(texts)
    assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]
    docs = spark.createDataFrame(list(enumerate(texts[14:18])), "doc_id long, text string")
    found = {r["doc_id"]: r["ids_sha256"] for r in bpe.digests(docs.coalesce(1), VOCABULARY).collect()}
    exp = [library.encode(t, add_special_tokens=False).ids for t in texts[14:18]]
    assert found == {i: brute.sha(" ".join(map(str, ids))) for i, ids in enumerate(exp)}


@pytest.mark.parametrize("words", [400_000, 300])
def test_many_random_texts(library, monkeypatch, words):
    """100,000 texts of short and long words through one encoder, whose caches start anew at times."""
    monkeypatch.setattr(bpe, "CACHE_WORDS", words)
    monkeypatch.setattr(bpe, "_LONG_WORDS", max(5, words // 100))
    rng = random.Random(12)
    model, count = bpe.Encoder(VOCABULARY), 100_000 if words > 1000 else 5000
    pool = ["".join(rng.choice("abcdefgeeennrst\x00éü'") for _ in range(rng.choice([1, 3, 7, 15, 16, 17, 30, 300]))) for _ in range(1000)]
    for at in range(0, count, 1000):
        texts = [" ".join(rng.choice(pool) for _ in range(rng.randrange(5))) + str(at) for _ in range(1000)]
        got = model.encode(texts)
        assert [g.tolist() for g in got] == [e.ids for e in library.encode_batch(texts, add_special_tokens=False)]


def test_cuts_are_where_no_token_joins():
    model = bpe.encoder(VOCABULARY)
    inside = {(a, b) for t in model.vocab for a, b in zip(t.removesuffix(model.end), t.removesuffix(model.end)[1:])}
    never = [(a, b) for a in range(256) for b in range(256) if not model.joined[:, a, b].any()]
    assert len(never) > 1000 and not any((model.letters[a], model.letters[b]) in inside for a, b in never)


def test_personal_data(docs, data):
    found = {(r["doc_id"], r["base_sha256"]) for r in pii.digest(docs).collect()}
    assert found == {(i, pii.sha256_of(brute.base_spans(t))) for i, t in data}
    alphabet = "a.b@c-1 2+3(4)5 9:/é"
    rng = random.Random(6)
    for _ in range(20_000):
        text = "".join(rng.choice(alphabet) for _ in range(rng.randrange(50)))
        assert [s for s in pii.find(text) if s[0] in pii.BASE_KINDS] == brute.base_spans(text), text


def test_added_kinds_and_redaction():
    text = "see https://a.example/x?y=1. IBAN: DE89 3704 0044 0532 0130 00, mail a.b@c.org or +49 30 1234567"
    kinds = [k for k, _, _ in pii.find(text)]
    assert kinds.count("url") == 1 and kinds.count("account") == 1 and kinds.count("email") == 1
    clean = pii.redacted(text)
    assert "DE89" not in clean and "@" not in clean and "[PHONE]" in clean and clean.startswith("see [URL].")


def test_very_long_numbers(spark):
    zeros = "0" * 5000
    texts = [f"{zeros}.1.1.1", f"1.{zeros}255.{zeros}.9", f"{zeros}256.1.1.1", f"{'9' * 5000}.1.1.1"]
    spans = [[("ip", 0, len(t))] if i < 2 else [] for i, t in enumerate(texts)]
    assert [pii.find(t) for t in texts] == spans
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = {(r["doc_id"], r["base_sha256"]) for r in pii.digest(docs).collect()}
    assert found == {(i, pii.sha256_of(x)) for i, x in enumerate(spans)}
    assert [t for _, t in sorted(brute.rows(pii.redact(docs)))] == ["[IP]", "[IP]", *texts[2:]]


def test_redaction_keeps_rows(docs, data):
    left = pii.redact(docs)
    assert left.columns == docs.columns and left.count() == len(data)
    assert not [t for _, t in brute.rows(left) if brute.base_spans(t)]


@pytest.mark.parametrize("shard_tokens", [packing.SHARD_TOKENS, 5000])
def test_packing(docs, data, library, shard_tokens):
    found = packing.pack(docs, VOCABULARY, shard_tokens=shard_tokens).collect()
    full = {(i, t): [*library.encode(t, add_special_tokens=False).ids, packing.END] for i, t in data}
    pieces = Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in found)
    assert sum(r["length"] for r in found) == sum(len(full[x]) for x in data)
    for (i, t), n in Counter(data).items():  # each id of each row lies in exactly one piece
        ids = full[i, t]
        sums = {(r["start"], r["length"]) for r in found if r["doc_id"] == i and r["doc_tokens"] == len(ids)
                and zlib.crc32(np.array(ids[r["start"] : r["start"] + r["length"]], "<u4").tobytes()) == r["ids_crc32"]}
        assert {s + k for s, m in sums for k in range(m)} == set(range(len(ids)))
    sequences = {}
    for r in found:
        sequences.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= packing.WINDOW and at & (at - 1) == 0  # a whole window or a power of two
    assert all(n >= 1 for n in pieces.values())


def greedy(docs, idf, mean_length, window):
    """Plain BM25: a seed's best unused neighbours fill the rest of its window; who crosses its end seeds the next."""
    unused, order, filled = list(range(len(docs))), [], 0

    def score(query, doc):
        counts = Counter(docs[doc].tolist())
        norm = packing.K1 * (1 - packing.B + packing.B * len(docs[doc]) / mean_length)
        return sum(idf[t] * counts[t] * (packing.K1 + 1) / (counts[t] + norm) for t in set(docs[query].tolist()) if counts[t])

    while unused:
        if not filled:
            order.append(unused.pop(0))
            filled = len(docs[order[-1]]) % window
            continue
        seed = order[-1]
        for doc in sorted(unused, key=lambda d: (-round(score(seed, d), 9), d)):
            unused.remove(doc)
            order.append(doc)
            filled += len(docs[doc])
            if filled >= window:
                filled %= window
                break
        else:
            return order
    return order


def test_packing_order_against_plain_greedy():
    rng = np.random.default_rng(9)
    for window in (40, 100):
        docs = [rng.zipf(1.3, rng.integers(1, 70)) % 200 for _ in range(70)]
        df = np.zeros(200)
        for d in docs:
            df[np.unique(d)] += 1
        idf = np.log1p((70 - df + 0.5) / (df + 0.5))
        assert packing.packing_order(docs, idf, 35.0, window) == greedy(docs, idf, 35.0, window)


def test_neighbours_fill_the_seeds_window():
    rng = np.random.default_rng(8)
    topics = [rng.integers(k * 100, k * 100 + 100, 4000) for k in range(5)]
    docs = [topics[i % 5][at : at + 200] for i, at in enumerate(rng.integers(0, 3800, 60))]
    df = np.zeros(501)
    for d in docs:
        df[np.unique(d)] += 1
    order = packing.packing_order(docs, np.log1p((60 - df + 0.5) / (df + 0.5)), 200.0, 1000)
    assert sorted(order) == list(range(60))
    # five documents fill a window exactly, so only the four behind a seed can be its neighbours
    windows = [order[i : i + 5] for i in range(0, 60, 5)]
    assert np.mean([d % 5 == w[0] % 5 for w in windows for d in w[1:]]) > 0.75


def test_text_of_many_megabytes(spark, docs, library):
    """Long texts are worked on whole: what their last part holds counts."""
    one = max((r["text"] for r in docs.where("lang = 'en'").select("text").collect()), key=len)
    other = max((r["text"] for r in docs.where("lang = 'de'").select("text").collect()), key=len)
    times = (4 << 20) // len(one) + 1
    text = f"{one} " * times + f"{other} " * (3 * times * len(one) // len(other))
    long = spark.createDataFrame([(1, text), (2, one)], "doc_id long, text string")
    model = language_id.train(docs, F.lit(True))
    assert [r["lang_pred"] for r in language_id.predict(long, model).orderBy("doc_id").collect()] == ["de", "en"]
    scorer = quality.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"), F.lit(True))
    assert all(0 <= r["score"] <= 1 for r in quality.score(long, scorer).collect())
    ids = [*library.encode(text, add_special_tokens=False).ids, packing.END]
    found = packing.pack(long, VOCABULARY).where("doc_id = 1").orderBy("start").collect()
    assert sum(r["length"] for r in found) == len(ids) and {r["doc_tokens"] for r in found} == {len(ids)}
    for r in found:
        piece = np.array(ids[r["start"] : r["start"] + r["length"]], "<u4")
        assert zlib.crc32(piece.tobytes()) == r["ids_crc32"]


def test_ties_are_settled_the_same_way(spark, docs):
    """Equal rows, and rows whose languages are as likely, get one result on every run."""
    model = language_id.train(docs, F.lit(True))
    rows = spark.createDataFrame([(i, "a b c 1 é") for i in range(40)], "doc_id long, text string")
    found = {(r["lang_pred"], r["score"]) for n in (1, 4) for r in language_id.predict(rows.repartition(n), model).collect()}
    assert len(found) == 1


def test_empty_table(spark, docs):
    none = docs.limit(0)
    model = language_id.train(docs, F.lit(True))
    assert exact_dedup.exact_groups(none).count() == 0
    assert exact_dedup.drop_copies(none).count() == 0
    assert simhash.near_duplicates(none).count() == 0
    assert simhash.drop_near_duplicates(none).count() == 0
    assert rlz_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert language_id.predict(none, model).count() == 0
    assert language_id.train(none, F.lit(True)) is None
    assert {r["lang_pred"] for r in language_id.predict(docs, None).collect()} == {"und"}
    assert bpe.digests(none, VOCABULARY).count() == 0
    assert pii.digest(none).count() == 0
    assert quality.score(none, 0.5).count() == 0
    assert packing.pack(none, VOCABULARY).count() == 0

"""Ranked search against plain Python."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

import brute
from heliocat.llm import bag_search

FOLDER = "/root/testdata/sf0.001"
TERM = re.compile(rb"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    lower = re.sub(rb"[A-Z]", lambda m: m[0].lower(), (text or "").encode())
    return Counter(TERM.findall(lower))


def ranked(docs, items, k=20):
    """(item_id, rank, doc_id, score) with one row per place."""
    bags = [(i, c) for i, c in ((i, terms(t)) for i, t in docs) if c]
    n, length = len(bags), sum(sum(c.values()) for _, c in bags)
    df = Counter(t for _, c in bags for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in bags:
            m = 75 + 25 * sum(c.values()) * n // length
            s = sum(
                times * math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                for t, times in terms(text).items()
                if t in c
            )
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        out += [(item, r, d, -s) for r, (s, _, _, d) in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return sorted(out, key=str)


@pytest.fixture(scope="module")
def docs(spark):
    copies = spark.createDataFrame(
        [*((920000 + i, "Equal bag, bag of words: ÄÖ été 7up") for i in range(70)), (920100, "words of bag; bag EQUAL Äö ÄÖ été 7up")]
        + [(920200, "equal bag " * 30_000), (None, "equal"), (None, "equal"), (920300, "equal"), (920300, "equal")],
        "doc_id long, text string",
    )
    return brute.documents(spark, FOLDER).unionByName(copies, allowMissingColumns=True).repartition(4).cache()


@pytest.fixture(scope="module")
def items(spark):
    more = [(7001, "bag bag equal"), (7001, "été ÉTÉ"), (None, "7up"), (7002, None), (7003, "?!"), (7004, "nothing_of_this zzzzqq")]
    clashes = spark.createDataFrame([(*m, 1, 2) for m in more], "item_id long, text string, doc_id int, score int")
    return spark.read.parquet(f"{FOLDER}/benchmark.parquet").unionByName(clashes, allowMissingColumns=True)


@pytest.mark.parametrize("bound", [bag_search.BLOCK_ITEMS, 3])
def test_search(docs, items, monkeypatch, bound):
    """Blocks of three items give the same."""
    monkeypatch.setattr(bag_search, "BLOCK_ITEMS", bound)
    rows = [(r["item_id"], r["text"]) for r in items.collect()]
    found = bag_search.search(docs, items if bound > 3 else items.where("item_id IS NULL OR item_id > 7000"))
    some = [r for r in rows if bound > 3 or r[0] is None or r[0] > 7000]
    assert sorted(map(tuple, found.collect()), key=str) == ranked(brute.rows(docs), some)


def test_a_class_is_scored_once(spark, docs):
    """Seventy equal documents and one of the same counts are one class, with as many members as places."""
    item = Counter(t for part in bag_search.terms(b"bag equal") for t in part)
    block = bag_search._block([(1, item)])
    some = docs.where("doc_id BETWEEN 920000 AND 920100").select("doc_id", "text")
    bags = some.mapInArrow(bag_search._bags(block.term), "doc_id long, n long, bag binary, df array<long>").cache()
    found = bag_search.classes(bags.where("n = 8"), 71, 71 * 8, 20).collect()
    assert [len(r["members"]) for r in found] == [20]
    assert [m["doc_id"] for m in found[0]["members"]] == list(range(920000, 920020))


def test_terms_of_long_texts(monkeypatch):
    rng = random.Random(4)
    text = "".join(rng.choice("aB9_ -é日\x00\x7f{") for _ in range(5000)).encode()
    whole = [t for part in bag_search.terms(text) for t in part]
    assert whole == TERM.findall(text.lower())
    monkeypatch.setattr(bag_search, "_PIECE", 7)
    assert [t for part in bag_search.terms(text) for t in part] == whole


def test_bags_round_trip():
    for ids, tf in (([1, 5], [1, 255]), ([0, 70000], [256, 1 << 40])):
        raw = bag_search._bag(np.array(ids), np.array(tf))
        assert [x.tolist() for x in bag_search._unbag(raw)] == [ids, tf]


def test_empty_tables(docs, items):
    assert bag_search.search(docs.limit(0), items).count() == 0
    assert bag_search.search(docs, items.limit(0)).columns == ["item_id", "rank", "doc_id", "score"]
    assert bag_search.search(docs.where("text IS NULL OR text = ''"), items).count() == 0

"""MinHash near duplicates against all pairs in plain Python."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

import brute
from heliocat.llm import minhash

FOLDER = "/root/testdata/sf0.001"


def shingle_set(text, width=5):
    words = "".join(c.lower() if "A" <= c <= "Z" else c for c in text).encode().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def components(data, percent=85):
    """(doc_id, n_shingles, component_id, kept)."""
    sets = [shingle_set(t) for _, t in data]
    posts, root = defaultdict(list), list(range(len(data)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i, s in enumerate(sets):
        shared = Counter(j for x in s for j in posts[x])
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j]) - n):
                root[max(find(i), find(j))] = min(find(i), find(j))
        for x in s:
            posts[x].append(i)
    members = defaultdict(list)
    for i, (doc, _) in enumerate(data):
        members[find(i)].append(doc)
    least = {r: min((d for d in m if d is not None), default=None) for r, m in members.items()}
    return Counter((d, len(sets[i]), least[find(i)], d == least[find(i)]) for i, (d, _) in enumerate(data))


@pytest.fixture(scope="module")
def docs(spark):
    """The edge rows, a group of near copies of near copies, and texts that share most of a passage."""
    rng = random.Random(7)
    words = [f"w{i}" for i in range(3000)]
    base = [rng.choice(words) for _ in range(150)]
    group = [base]
    while len(group) < 60:
        copy = list(rng.choice(group))
        for _ in range(rng.randrange(1, 6)):
            copy[rng.randrange(len(copy))] = rng.choice(words)
        group.append(copy)
    group += [base[:90] + [rng.choice(words) for _ in range(rng.randrange(5, 60))] for _ in range(40)]
    rows = [(930000 + i, " ".join(w)) for i, w in enumerate(group)] + [(930000, " ".join(base).upper().replace(" ", "\n ")), *brute.SHARED]
    more = spark.createDataFrame(rows, "doc_id long, text string")
    return brute.documents(spark, FOLDER).unionByName(more, allowMissingColumns=True).repartition(4).cache()


@pytest.mark.parametrize("rows", [1024, 7])
def test_components(docs, rows):
    """Blocks of seven classes split every long list and cluster."""
    found = minhash.near_duplicates(docs, list_rows=rows, cluster_rows=rows)
    got = Counter(tuple(r) for r in found.select("doc_id", "n_shingles", "component_id").collect())
    exp = Counter()
    for (doc, n, least, _), times in components(brute.rows(docs)).items():
        exp[doc, n, doc if n == 0 else least] += times
    assert got == exp
    assert all(r["kept"] == (r["doc_id"] == r["component_id"]) for r in found.collect())


def test_signatures_estimate_similarity():
    rng = np.random.default_rng(3)
    for share in (0.5, 0.85):
        both, n = int(4000 * share), 4000
        agree = []
        for _ in range(20):
            h = rng.integers(0, 1 << 63, 2 * n - both, dtype=np.uint64)
            a, b = minhash.signatures([np.sort(h[:n]), np.sort(h[n - both :])])
            agree.append((a == b).mean())
        assert abs(np.mean(agree) - both / (2 * n - both)) < 0.04


def test_least_matches_keeps_links():
    """The chance to miss a link of the least similarity, summed by simulation-free binomials."""
    from math import comb

    for percent in (50, 85, 95):
        least, p, k = minhash.least_matches(percent), percent / 100, minhash.COORDINATES
        missed = sum(comb(k, i) * p**i * (1 - p) ** (k - i) for i in range(least))
        assert missed <= minhash.LOSS < missed + comb(k, least) * p**least * (1 - p) ** (k - least)


def test_forest_connects_what_links_connect():
    rng = np.random.default_rng(5)
    for left in (0, 4):
        for _ in range(50):
            n = 12
            linked = rng.random((n, n)) < 0.12
            linked |= linked.T
            if left:
                linked[:left, :left] = linked[left:, left:] = False
            trees = minhash.forest(n, left, lambda i, others: linked[i, others])
            assert all(linked[a, b] for a, b in trees)
            groups = [set(range(n)), set(range(n))]
            labels = []
            for edges in (np.argwhere(linked).tolist(), trees):
                root = list(range(n))
                for a, b in list(edges) * n:
                    root[a] = root[b] = min(root[a], root[b])
                labels.append(root)
            assert labels[0] == labels[1] and len(trees) == n - len(set(labels[0])), groups


def test_long_texts_in_pieces(monkeypatch):
    text = " ".join(f"Word{i % 300}\t" for i in range(2000)).encode()
    whole = minhash.shingles(text, 5)
    monkeypatch.setattr(minhash, "_PIECE", 11)
    cut = minhash.shingles(text, 5)
    assert (whole[0] == cut[0]).all() and len(whole[0]) == len(shingle_set(text.decode()))
    assert minhash.shingles_digest(text) == cut[1]


def test_empty_table(docs):
    assert minhash.near_duplicates(docs.limit(0)).count() == 0

"""Vector search and components against plain Python."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from heliocat.llm import ann, common
from heliocat.llm.components import components


def brute(rows, every: int, k: int):
    """(query, rank, id, distance) by comparing all."""
    out = []
    for q in sorted({i for i, _ in rows if i % every == 0}):
        v = min(tuple(x) for i, x in rows if i == q)
        near = sorted((float(np.sqrt(((np.array(x) - v) ** 2).sum())), i) for i, x in rows if i != q)[:k]
        out += [(q, r + 1, i, d) for r, (d, i) in enumerate(near)]
    return out


def test_all_cells_give_the_exact_result(spark):
    rng = np.random.default_rng(1)
    good = [(i, rng.normal(size=5).tolist()) for i in range(300)]
    good += [(1000 + i, good[7][1]) for i in range(40)]  # ties
    good.append((20, good[3][1]))  # an id twice
    bad = [(5000, None), (5010, []), (5020, [0.0] * 5), (5030, [1.0, None, 1.0, 1.0, 1.0]), (5040, [1.0, float("nan"), 1.0, 1.0, 1.0]),
           (5050, [float("inf")] * 5), (5060, [1.0, 2.0]), (None, [1.0] * 5)]
    df = spark.createDataFrame(good + bad, "vec_id long, embedding array<double>").withColumn("cell", F.lit(1)).withColumn("vec", F.lit("x"))
    got = sorted(tuple(r) for r in ann.search(df, k=10, every=10).collect())
    exp = brute(good, 10, 10)
    assert [g[:3] for g in got] == [e[:3] for e in exp]
    assert np.allclose([g[3] for g in got], [e[3] for e in exp], atol=1e-12)


def test_few_and_none(spark):
    schema = "vec_id long, embedding array<float>"
    assert ann.search(spark.createDataFrame([], schema)).count() == 0
    assert ann.search(spark.createDataFrame([(100, [1.0, 2.0])], schema)).count() == 0
    two = spark.createDataFrame([(100, [1.0, 2.0]), (7, [1.0, 3.0])], schema)
    assert [tuple(r) for r in ann.search(two).collect()] == [(100, 1, 7, 1.0)]


def test_recall(spark):
    """The given vectors and as many again turned and shifted, so that the cells left out count: defaults."""
    df = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    rows = np.array([r["embedding"] for r in df.orderBy("vec_id").collect()])
    rng = np.random.default_rng(4)
    turns = [np.linalg.qr(rng.normal(size=(rows.shape[1],) * 2))[0] for _ in range(4)]
    every = np.concatenate([rows, *(rows @ t for t in turns)])
    assert ann.PROBE * len(every) > ann.PROBE_LEAST  # else all is reranked
    table = spark.createDataFrame([(i, v) for i, v in enumerate(every.tolist())], "vec_id long, embedding array<double>")
    found = {(r["query_id"], r["vec_id"]) for r in ann.search(table).collect()}
    exp = set()
    for q in range(0, len(every), 100):
        d = np.sqrt(((every - every[q]) ** 2).sum(axis=1))
        d[q] = np.inf
        exp |= {(q, int(i)) for i in np.lexsort((np.arange(len(every)), d))[:10]}
    assert len(found & exp) / len(exp) >= 0.9


def test_walk_is_by_summed_distance():
    rng = np.random.default_rng(2)
    left, right, counts = rng.random(9), rng.random(7), rng.integers(0, 3, (9, 7))
    cells = ann.walk(left, right, counts, 1 << 30)
    sums = [left[c // 7] + right[c % 7] for c in cells]
    assert sums == sorted(sums) and len(set(cells)) == len(cells) == (counts > 0).sum()


@pytest.mark.parametrize("hot", [False, True])
def test_components(spark, monkeypatch, hot):
    """A chain, a star, a pair and noise; with every key taken as hot and with none."""
    if hot:
        monkeypatch.setattr(common, "HOT_ROWS", 2)
        monkeypatch.setattr(common, "HOT_SHARE", 0.02)
    links = [(i, i + 1) for i in range(100, 160)] + [(7, i) for i in range(200, 260)] + [(1, 2), (2, 1), (5, 5), (None, 3), (259, 300)]
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long")).collect()}
    exp = {i: 100 for i in range(100, 161)} | {i: 7 for i in [7, *range(200, 260), 300]} | {1: 1, 2: 1}
    assert got == exp
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0

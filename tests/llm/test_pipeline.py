"""The pipeline and the registered queries."""

import zlib
from collections import Counter

import brute
import duckdb
import numpy as np
import pytest
import corpus_pipeline
import __spark_entry__ as entry
from compare import connect, differences
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from heliocat.llm import exact_dedup, language_id, packing, pii, queries, simhash

FOLDER = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    columns = docs.columns
    for name, stage in corpus_pipeline.STAGES[:-1]:
        before = docs.count()
        docs = stage(spark, docs, FOLDER)
        assert docs.columns == columns, name
        assert 0 < docs.count() <= before, name


def test_run_returns_pieces(spark):
    pieces = corpus_pipeline.run(spark, FOLDER)
    texts = duckdb.sql(f"SELECT count(DISTINCT text) FROM '{FOLDER}/documents.parquet'").fetchall()[0][0]
    assert 0.5 * texts < pieces.select("doc_id").distinct().count() <= texts


def test_language_stage_rejects_mixtures(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    held = docs.where(queries.remainder(5) == 0).where("n_chars > 500").orderBy("doc_id").collect()
    text = {r["lang"]: r["text"].split() for r in held}
    assert len(text) == 4
    part = lambda langs, n: " ".join(w for x in langs for w in text[x][:n])
    names = sorted(text)
    mixed = [part(names, 40), part(names[:3], 40), " ".join(w for ws in zip(*text.values()) for w in ws)]
    two = [part([a, b], 40) for a in names for b in names if a < b]
    clean = [part([a], n) for a in names for n in (20, 60)]
    rows = [(-1 - i, t, "edge", "x", len(t)) for i, t in enumerate([*mixed, "12 34 !", *two, *clean])]
    added = spark.createDataFrame(rows, "doc_id long, text string, source string, lang string, n_chars long")
    added = added.withColumn("lang", F.lit(None).cast("string"))
    left = corpus_pipeline.language_stage(spark, docs.unionByName(added.select(docs.columns)), FOLDER)
    assert sorted(r["text"] for r in left.where("doc_id < 0").collect()) == sorted([*two, *clean])
    assert left.where("doc_id >= 0").count() == docs.count()


@pytest.fixture(scope="module")
def shared_ids(spark, tmp_path_factory):
    """A folder whose documents have null and shared ids on different texts."""
    folder = str(tmp_path_factory.mktemp("documents"))
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    rows = spark.createDataFrame(brute.EDGES + brute.SHARED, "doc_id long, text string").withColumns(
        {"lang": F.lit(None).cast("string"), "source": F.lit("edge"), "n_chars": F.length("text").cast("long")}
    )
    docs.unionByName(rows).select(docs.columns).repartition(3).write.parquet(f"{folder}/documents.parquet")
    return folder


def test_near_stage_by_id_and_text(spark, shared_ids):
    docs = spark.read.parquet(f"{shared_ids}/documents.parquet")
    expected = brute.near_left(brute.rows(docs))
    assert sum(i is None for i, _ in expected) > 3 and sum(i == 910001 for i, _ in expected) > 3
    left = simhash.drop_near_duplicates(docs)
    assert Counter((i, brute.sha(t)) for i, t in brute.rows(left)) == Counter((i, brute.sha(t)) for i, t in expected)


def test_kept_rows_keep_their_values(spark):
    """Of rows equal in id and text one stays, the same however they lie; names used inside clash."""
    rows = [
        (1, "one", "fr", 7, 5), (1, "one", "de", 8, 4), (1, "one", "de", 9, 3), (0, "one", "de", 0, 0),
        (2, None, "en", 1, 1), (2, "", "en", 1, 1), (None, "two", None, 2, 2), (None, "two", "en", 2, 2),
        (3, "three", "en", 3, 3),
    ]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, _id int, sha int")
    expected = [(1, "one", "de", 8, 4), (2, "", "en", 1, 1), (3, "three", "en", 3, 3)]
    for parts in (1, 4):
        left = exact_dedup.drop_copies(docs.repartition(parts))
        assert left.columns == docs.columns
        found = [tuple(r) for r in left.collect()]
        assert sorted(r for r in found if r[0]) == expected
        # without a language the JSON begins with the number, which stands before the language's name
        assert [r for r in found if not r[0]] == [(None, "two", None, 2, 2)]


def test_run_of_an_empty_table(spark, tmp_path):
    spark.read.parquet(f"{FOLDER}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).collect() == []


def test_run_equals_the_plain_versions(spark, shared_ids):
    docs = spark.read.parquet(f"{shared_ids}/documents.parquet")
    model = language_id.train(docs, queries.remainder(5) != 0)
    data = brute.rows(docs)
    scored = zip(data, model.label([t for _, t in data]))
    data = [r for r, (w, p) in scored if w and p.mean(axis=0).max() >= corpus_pipeline.LEAST_LANGUAGE_SCORE]
    data = [(i, pii.redacted(t)) for i, t in brute.near_left(brute.exact_left(data))]
    library = Tokenizer.from_file(queries.WORD_BPE)
    full = {}
    for i, t in data:
        ids = [*library.encode(t, add_special_tokens=False).ids, packing.END]
        full.setdefault((i, len(ids)), []).append(ids)
    pieces = corpus_pipeline.run(spark, shared_ids).collect()
    assert Counter((r["doc_id"], r["doc_tokens"]) for r in pieces if r["start"] == 0) == Counter(
        {k: len(v) for k, v in full.items()}
    )
    crc = lambda ids: zlib.crc32(np.array(ids, "<u4").tobytes())
    for r in pieces:
        a, b = r["start"], r["start"] + r["length"]
        assert r["ids_crc32"] in [crc(ids[a:b]) for ids in full[r["doc_id"], r["doc_tokens"]]]
    assert sum(r["length"] for r in pieces) == sum(len(ids) for v in full.values() for ids in v)


def test_sql(spark):
    con = connect(FOLDER)
    for name, sql in entry._llm.ORACLE.items():
        assert differences(spark, con, FOLDER, entry.queries()[name], sql) is None, name


def test_one_query_per_operator():
    names = [n for n in entry.queries() if n.startswith("op")]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == list(range(1, 14))

"""The corpus pipeline: language, exact copies, near copies, personal data, packing."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliocat.llm import exact_dedup, language_id, packing, pii, queries, simhash
from heliocat.llm.common import shared_folder

#: The share of its words' weight that a document's best language needs to stay. Equal parts of three
#: or more languages score about 1/3 or less, of two about 1/2. Of the rows that are not held out none
#: scores under 0.340 (check_l), and texts of few words in two languages score down to 0.347.
LEAST_LANGUAGE_SCORE = 0.34


def language_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of no known language go: those without a letter, and mixtures of three or more in like parts.

    Texts of two languages stay, so where one or two languages are learned only letterless texts go.
    """
    model = language_id.train(docs, queries.remainder(5) != 0)
    return language_id.keep_known(docs, model, least=LEAST_LANGUAGE_SCORE)


def exact_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the largest id stays."""
    return exact_dedup.drop_copies(docs)


def near_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each component of near copies the document with the smallest id stays."""
    return simhash.drop_near_duplicates(docs, width=3, budget=2)


def pii_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Personal data in the texts is replaced by its kind; the stored length follows."""
    found = pii.redact(docs)
    return found.withColumn("n_chars", F.length("text").cast(docs.schema["n_chars"].dataType))


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The remaining documents packed into windows, one row per piece."""
    return packing.pack(docs, queries.WORD_BPE)


STAGES = [
    ("language ID", language_stage),
    ("exact dedup", exact_stage),
    ("near dedup", near_stage),
    ("personal data", pii_stage),
    ("packing", packing_stage),
]
#: SQL has no random field, fingerprint or tokenizer; the tests hold run() against plain Python.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents; each result is written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        path = shared_folder(spark)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs

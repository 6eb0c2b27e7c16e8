"""Link picking on listing pages, and the choice of files still to read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from heliocat.constants import ARRAY_FILE_PREFIX, ARRAY_FILE_SUFFIX, LATEST_EVENT_FILE
from heliocat.functions.texts import first_href_equal, first_href_with_suffix


def first_links(
    pages: DataFrame, suffix: str = ARRAY_FILE_SUFFIX, html: str = "html", link: str = "link"
) -> DataFrame:
    """Add the first link that ends with ``suffix``; null where a page has none."""
    return pages.withColumn(link, first_href_with_suffix(F.col(html), suffix))


def named_links(
    pages: DataFrame, name: str = LATEST_EVENT_FILE, html: str = "html", link: str = "link"
) -> DataFrame:
    """Add ``name`` where the page links to it, else null."""
    return pages.withColumn(link, first_href_equal(F.col(html), name))


def missing_links(pages: DataFrame, link: str = "link") -> DataFrame:
    """One row: pages read, and pages without a match."""
    return pages.agg(
        F.count("*").alias("pages"), F.count_if(F.col(link).isNull()).alias("missing")
    )


def list_files(spark: SparkSession, folder: str, glob: str) -> DataFrame:
    """``path, file_name`` of the files of a folder; contents are not read."""
    return (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", glob)
        .load(folder)
        .select("path", F.element_at(F.split("path", "/"), -1).alias("file_name"))
    )


def newest_file(
    spark: SparkSession,
    folder: str,
    prefix: str = ARRAY_FILE_PREFIX,
    suffix: str = ARRAY_FILE_SUFFIX,
) -> DataFrame:
    """One row: the greatest file name with the prefix and suffix, or null."""
    return newest_name(list_files(spark, folder, f"{prefix}*{suffix}"), prefix, suffix)


def newest_name(
    listed: DataFrame, prefix: str, suffix: str, name: str = "file_name"
) -> DataFrame:
    """One row: the greatest name with the prefix and suffix in a table of names, or null."""
    fits = F.col(name).startswith(prefix) & F.col(name).endswith(suffix)
    return listed.agg(F.max(F.when(fits, F.col(name))).alias(name))


def unread_files(
    listed: DataFrame, processed: DataFrame, key: str = "file_name", refresh: bool = False
) -> DataFrame:
    """Listed files that are not yet processed; all of them on ``refresh``."""
    if refresh:
        return listed
    return listed.join(processed.select(key).distinct(), key, "left_anti")

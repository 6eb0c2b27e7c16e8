"""The historical catalog: tab-separated text with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from heliocat.schemas import CATALOG


def read_catalog(spark: SparkSession, path: str, with_ordinal: bool = False) -> DataFrame:
    """Catalog rows; ``with_ordinal`` adds each row's position as ``ordinal``.

    Columns are found by their names in the header, whatever their order; their types
    are fixed. A field that does not parse is null.
    """
    reader = spark.read.option("sep", "\t").option("header", True)
    types = {f.name: f.dataType for f in CATALOG.fields}
    found = T.StructType(
        [T.StructField(name, types.get(name, T.StringType())) for name in reader.csv(path).columns]
    )
    rows = reader.schema(found).csv(path)
    return add_ordinal(rows) if with_ordinal else rows


def add_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """Number the rows of a file scan 0, 1, 2, ... by file name and place in the file.

    Each split of a file is scanned in order, so a row's place is counted within its split;
    the rows before the split are added from one count per split.
    """
    split = ["_file", "_block"]
    placed = df.withColumns(
        {
            "_file": F.col("_metadata.file_path"),
            "_block": F.col("_metadata.file_block_start"),
            "_place": F.monotonically_increasing_id(),
        }
    )
    splits = placed.groupBy(*split).agg(F.min("_place").alias("_first"), F.count("*").alias("_rows"))
    before = F.sum("_rows").over(Window.orderBy(*split)) - F.col("_rows")
    starts = splits.select(*split, (before - F.col("_first")).alias("_start"))  # a row per split
    numbered = placed.join(starts, split).withColumn(name, F.col("_start") + F.col("_place"))
    return numbered.select(name, *df.columns)

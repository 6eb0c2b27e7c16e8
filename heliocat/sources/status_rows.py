"""Status rows: several rows per event, as decoded from array files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window, functions as F, types as T

from heliocat.functions.numeric import fill_masked
from heliocat.functions.texts import join_chars
from heliocat.schemas import STATUS_ROWS


def read_status_rows(
    spark: SparkSession,
    path: str,
    format: str = "parquet",
    fills: dict | None = None,
    schema: T.StructType = STATUS_ROWS,
    **options,
) -> DataFrame:
    """Rows with an explicit ``pos`` column, or arrays with one row per file.

    A source with array columns becomes rows; otherwise rows are taken as they are
    and must carry ``pos``, their place in the file. In the result ``pos`` is the place
    among all files, by path and then by the place in the file.
    """
    arrays = any(isinstance(f.dataType, T.ArrayType) for f in schema.fields)
    if not arrays and "pos" not in schema.names:
        schema = T.StructType([*schema.fields, T.StructField("pos", T.LongType())])
    df = (
        spark.read.format(format)
        .schema(schema)
        .options(**options)
        .load(path)
        .withColumn("file", F.col("_metadata.file_path"))
    )
    rows = arrays_to_rows(df, schema.names) if arrays else df
    return finish(in_arrival_order(rows), fills)


#: places of one file; a place among all files is the file's rank times this and the place
FILE_PLACES = 1 << 40


def in_arrival_order(rows: DataFrame, file: str = "file", pos: str = "pos") -> DataFrame:
    """``pos`` made the place among all files; files are ranked by name, one row per file."""
    ranks = rows.select(file).distinct().withColumn(
        "_rank", F.row_number().over(Window.orderBy(file)).cast("long")
    )
    return (
        rows.join(ranks, file)
        .withColumn(pos, F.col("_rank") * F.lit(FILE_PLACES) + F.col(pos))
        .select(*rows.columns)
    )


def arrays_to_rows(df: DataFrame, columns: list[str], keep: tuple = ("file",)) -> DataFrame:
    """Equal-length arrays to rows; ``pos`` is the place in the arrays."""
    kept = [F.col(k) for k in keep]
    return df.select(
        *kept, F.posexplode(F.arrays_zip(*columns)).alias("pos", "_row")
    ).select(*kept, F.col("pos").cast("long").alias("pos"), "_row.*")


def finish(rows: DataFrame, fills: dict | None = None) -> DataFrame:
    """Fill masked cells and make the class one string."""
    changed: dict[str, Column] = {
        name: fill_masked(F.col(name), fill) for name, fill in (fills or {}).items()
    }
    if isinstance(rows.schema["flare_class"].dataType, T.ArrayType):
        changed["flare_class"] = join_chars(F.col("flare_class"))
    return rows.withColumns(changed) if changed else rows

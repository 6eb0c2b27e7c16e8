"""The latest-event document: a JSON array whose closing bracket may be missing."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from heliocat.functions.texts import close_json_array, trim_blank
from heliocat.schemas import LATEST_EVENT

EVENTS_JSON = T.ArrayType(LATEST_EVENT)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """One row per landed document, whole text in ``value``."""
    return spark.read.text(path, wholetext=True)


def parse_array(raw: Column, schema: T.DataType = EVENTS_JSON) -> Column:
    """Elements of the array; null for anything that is not an array, even after repair.

    A strict parse comes first in effect: the repair leaves closed arrays alone.
    """
    is_array = trim_blank(raw).startswith("[")
    return F.when(is_array, _only_value(close_json_array(raw), schema))


def parse_single(raw: Column, schema: T.DataType = LATEST_EVENT) -> Column:
    """The older reading: drop the first and last character and parse one object."""
    inner = F.substr(raw, F.lit(2), F.length(raw) - 2)
    return F.when(trim_blank(inner).startswith("{"), _only_value(inner, schema))


def _only_value(text: Column, schema: T.DataType) -> Column:
    """The one JSON value of a text; null if the text holds anything else beside it.

    The text is parsed as the first of an array's two elements: whatever follows the value is
    then a syntax error, a further element or the end of the array.
    """
    wrapped = F.concat(F.lit("["), text, F.lit(",null]"))
    values = F.from_json(wrapped, T.ArrayType(schema), {"allowSingleQuotes": "false"})
    # the values are named once, so the text is parsed once
    fitting = F.get(F.filter(F.array(values), lambda v: F.size(v) == 2), F.lit(0))
    return F.get(fitting, F.lit(0))


def latest_events(
    documents: DataFrame,
    column: str = "value",
    mode: str = "all",
    schema: T.StructType = LATEST_EVENT,
    keep: tuple = (),
    refused: bool = False,
) -> DataFrame:
    """Events of each document, with ``element``, their place in it.

    With ``refused`` a document without any element is one row without event and element, and
    an element that is no object a row without event, both with a ``reject_hint``; so each
    document is seen in the result of the one parse.

    ``all``     every element of the array
    ``latest``  the first element only
    ``legacy``  the single object of the older reading
    """
    raw = F.col(column)
    if mode == "legacy":
        events = F.filter(F.array(parse_single(raw, schema)), lambda e: e.isNotNull())
    elif mode == "latest":
        events = F.slice(parse_array(raw, T.ArrayType(schema)), 1, 1)
    elif mode == "all":
        events = parse_array(raw, T.ArrayType(schema))
    else:
        raise ValueError(f"unknown mode: {mode}")
    # exploded in every mode: filters on the fields then stay above the one parse
    if not refused:
        return (
            documents.select(*keep, F.posexplode(events).alias("element", "_event"))
            .filter("_event IS NOT NULL")
            .select(*keep, "element", "_event.*")
        )
    why = F.when(F.col("element").isNull(), F.col("_why")).when(F.col("_event").isNull(), "element is no object")
    return documents.select(
        *keep, refusal(raw, mode).alias("_why"), F.posexplode_outer(events).alias("element", "_event")
    ).select(*keep, "element", "_event.*", why.alias("reject_hint"))


def refusal(raw: Column, mode: str = "all") -> Column:
    """Why a document that gives no element gives none, by its text."""
    text = trim_blank(raw)
    return (
        F.when(raw.isNull() | (text == ""), "document is empty")
        .when(F.lit(mode != "legacy") & ~text.startswith("["), "document is no array")
        .when(F.lit(mode != "legacy") & text.rlike(r"^\[\s*\]?$"), "document has no event")
        .otherwise("document is no JSON")
    )


def count_documents(rows: DataFrame, file: str = "file") -> DataFrame:
    """One row: documents landed, those with an element, and those refused. ``rows``: as
    ``latest_events`` gives them with ``refused``."""
    document = rows.groupBy(file).agg(F.count("element").alias("_n"))
    return document.agg(
        F.count("*").alias("landed"),
        F.count_if(F.col("_n") > 0).alias("good"),
        F.count_if(F.col("_n") == 0).alias("refused"),
    )

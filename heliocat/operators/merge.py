"""Idempotent merges by key: insert-if-absent, column upsert, migration."""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from heliocat.functions.texts import metadata_json, one_decimal
from heliocat.schemas import EVENTS, FLARES_KEY, align
from heliocat.session import shared_folder


def has_key(key: list[str]) -> Column:
    return reduce(and_, [F.col(k).isNotNull() for k in key])


def first_per_key(df: DataFrame, key: list[str], order: list[str]) -> DataFrame:
    """The first row per key. Each task keeps one row per key before the shuffle,
    so a key that holds much of the data does not gather in one task."""
    by_key = Window.partitionBy(*key).orderBy(*order)
    return (
        df.withColumn("_rank", F.row_number().over(by_key)).filter("_rank = 1").drop("_rank")
    )


def last_per_key(df: DataFrame, key: list[str], columns: list[str], seq: str) -> DataFrame:
    """``columns`` of the last row per key."""
    return df.groupBy(*key).agg(*[F.max_by(c, seq).alias(c) for c in columns])


def insert_ignore(
    existing: DataFrame,
    batch: DataFrame,
    key: list[str] = FLARES_KEY,
    order: list[str] = ["seq"],
    nullable: list[str] | None = None,
    unique: bool = False,
) -> DataFrame:
    """Rows of ``batch`` that an insert-if-absent would add.

    The first row per key in arrival order wins. A key with a null never equals another, so
    such rows are all kept, equal ones too: they pass by the window and the anti-join and are
    not shuffled, in however many batches they come. The window and the anti-join of the
    others share one shuffle.

    ``nullable`` names the key columns that may be null in the batch; without it all may.
    ``unique`` says that no whole key comes twice in ``existing``; without it the keys
    are made distinct before they are shuffled.
    """
    nullable = key if nullable is None else nullable
    held = existing.select(*key).filter(has_key(key))
    held = held if unique else held.distinct()
    if not nullable:
        return first_per_key(batch, key, order).join(held, key, "left_anti")
    firsts = first_per_key(batch.filter(has_key(nullable)), key, order)
    return firsts.join(held, key, "left_anti").unionByName(batch.filter(~has_key(nullable)))


def exists_in(df: DataFrame, table: DataFrame, key: list[str]) -> DataFrame:
    """Rows whose key the table holds."""
    return df.join(table.select(*key).distinct(), key, "left_semi")


def upsert_columns(
    existing: DataFrame,
    feed: DataFrame,
    columns: list[str],
    key: list[str] = ["date"],
    insert_only: list[str] = [],
    seq: str = "seq",
) -> DataFrame:
    """The table after inserting or updating only ``columns`` by key.

    The last feed row per key wins. ``insert_only`` columns are set when a key is
    new and never changed afterwards; other columns keep what they hold.
    """
    given = [*columns, *insert_only]
    new = last_per_key(feed, key, given, seq).withColumnsRenamed(
        {c: f"_new_{c}" for c in given}
    )
    joined = existing.withColumn("_old", F.lit(True)).join(
        new.withColumn("_new", F.lit(True)), key, "full_outer"
    )
    is_new, is_old = F.col("_new").isNotNull(), F.col("_old").isNotNull()
    merged = joined.withColumns(
        {
            **{c: F.when(is_new, F.col(f"_new_{c}")).otherwise(F.col(c)) for c in columns},
            **{c: F.when(is_old, F.col(c)).otherwise(F.col(f"_new_{c}")) for c in insert_only},
        }
    )
    if "created_at" in existing.columns:
        merged = merged.withColumn(
            "created_at", F.when(is_old, F.col("created_at")).otherwise(F.current_timestamp())
        )
    return align(merged, existing.schema)


Feed = tuple[DataFrame, list[str], list[str]]


def last_of_feeds(feeds: list[Feed], key: list[str] = ["date"], seq: str = "seq") -> DataFrame:
    """One row per key with the last row of each feed that has it, as ``_feed0``, ``_feed1``, ...

    A feed is its rows, the columns it updates and those it only sets on insert. All feeds go
    through one shuffle, after each task has kept one row per key and feed.
    """
    parts = [
        rows.filter(has_key(key)).select(*key, F.struct(*given, *only).alias(f"_feed{i}"), F.col(seq).alias(f"_seq{i}"))
        for i, (rows, given, only) in enumerate(feeds)
    ]
    united = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return united.groupBy(*key).agg(
        *[F.max_by(f"_feed{i}", f"_seq{i}").alias(f"_feed{i}") for i in range(len(feeds))]
    )


def merge_feeds(existing: DataFrame, last: DataFrame, feeds: list[Feed], key: list[str] = ["date"]) -> DataFrame:
    """The table after inserting or updating by key from ``last``, the feeds' last rows.

    The same as ``upsert_columns`` feed by feed, with one join.
    """
    joined = existing.withColumn("_old", F.lit(True)).join(last, key, "full_outer")
    there, changed = F.col("_old").isNotNull(), {c: F.col(c) for c in existing.columns}
    for i, (_, given, only) in enumerate(feeds):
        feed = f"_feed{i}"
        has = F.col(feed).isNotNull()
        changed |= {c: F.when(has, F.col(f"{feed}.{c}")).otherwise(changed[c]) for c in given}
        changed |= {c: F.when(has & ~there, F.col(f"{feed}.{c}")).otherwise(changed[c]) for c in only}
        there = there | has
    if "created_at" in existing.columns:
        changed["created_at"] = F.when(F.col("_old"), F.col("created_at")).otherwise(F.current_timestamp())
    merged = joined.select(*[F.col(k) for k in key], *[v.alias(c) for c, v in changed.items() if c not in key])
    return align(merged, existing.schema)


def observations_to_events(observations: DataFrame, seq: str = "id") -> DataFrame:
    """Older observation rows in event columns, and ``seq``, their arrival order."""
    c = F.col
    mapped = observations.withColumns(
        {
            "_event_peak": c("max_peak_event"),
            "_event_end": c("event_finish"),
            "magnitude": F.concat(c("classification"), one_decimal(c("sub_classification"))),
            "instrument": c("observation_instrument"),
            "source": F.lit("JSON"),
            "metadata": metadata_json(
                c("max_energy"),
                c("total_energy"),
                c("active_region"),
                c("latitude"),
                c("longitude"),
            ),
        }
    ).withColumnsRenamed({"_event_peak": "event_peak", "_event_end": "event_end"})
    return align(mapped, EVENTS, [F.col(seq).alias("seq")])


def migrate_observations(
    observations: DataFrame,
    flares: DataFrame,
    key: list[str] = FLARES_KEY,
    seq: str = "id",
    strict: bool = False,
) -> DataFrame:
    """Event rows of observations that the table does not hold yet, with ``seq``.

    A plain insert fails on keys repeated inside ``observations``: ``strict`` does the
    same, before anything is written. Otherwise the first row per key wins.
    """
    events = observations_to_events(observations, seq)
    if strict:
        refuse_repeats(events, flares, key)
    return insert_ignore(flares, events, key)


def refuse_repeats(events: DataFrame, flares: DataFrame, key: list[str] = FLARES_KEY) -> None:
    """Raise if a key that ``flares`` does not hold comes twice in ``events``."""
    twice = events.filter(has_key(key)).groupBy(*key).count().filter("count > 1")
    fresh = twice.join(flares.select(*key), key, "left_anti").first()
    if fresh is not None:
        raise ValueError(f"observations repeat a key: {fresh.asDict()}")


def number_rows(ordered: DataFrame, name: str, start: int = 0) -> DataFrame:
    """Number rows ``start, start + 1, ...`` in their order.

    The rows are written once, as they are; what is counted and added up is one number per
    partition.
    """
    shared_folder(ordered.sparkSession)
    stored = ordered.checkpoint()
    place = F.monotonically_increasing_id()  # the partition's number above 33 bits of places
    part = F.shiftright(place, 33)
    sizes = stored.select(part.alias("_part")).groupBy("_part").count()
    before = F.sum("count").over(Window.orderBy("_part")) - F.col("count")
    starts = sizes.select("_part", (before + F.lit(start)).alias("_start"))
    placed = stored.withColumn("_place", place).withColumn("_part", F.shiftright("_place", 33))
    number = F.col("_start") + F.col("_place").bitwiseAND(F.lit((1 << 33) - 1))
    return placed.join(starts, "_part").withColumn(name, number).drop("_part", "_place", "_start")


def assign_ids(
    df: DataFrame,
    mode: str = "hash",
    after: int = 0,
    key: list[str] = FLARES_KEY,
    order: list[str] = ["seq"],
) -> DataFrame:
    """Give rows an ``id``.

    ``hash``       from the key, the same on every run; rows with a null in the key add
                   their ``order``, which must tell them apart. 64 bits: expect a shared id only among billions, so look
                   a row up by id and start there (``get_flare``).
    ``increment``  unique and above ``after``, with gaps; not the same on every run.
    ``dense``      ``after + 1, after + 2, ...`` in key order; costs a global sort, whose
                   result is written to the shared checkpoint folder.
    """
    if mode == "hash":
        salt = [F.when(~has_key(key), F.col(c)) for c in order]
        return df.withColumn("id", F.xxhash64(*key, *salt))
    if mode == "increment":
        return df.withColumn("id", F.monotonically_increasing_id() + F.lit(after + 1))
    if mode == "dense":
        return number_rows(df.drop("id").orderBy(*key, *order), "id", after + 1)
    raise ValueError(f"unknown id mode: {mode}")

"""The stored tables: events in committed parts, the lookup in parts by year."""

from __future__ import annotations

import re
import uuid
from dataclasses import asdict, dataclass

from pyspark.sql import DataFrame, SparkSession, Window, functions as F, types as T

from heliocat.commits import CommitLog, Files, State
from heliocat.functions.times import exact_seconds_since, seconds_since
from heliocat.operators.merge import assign_ids, has_key, insert_ignore, last_of_feeds, merge_feeds
from heliocat.operators.paging import newest_first, page_offset
from heliocat.operators.predicates import all_of, between, moment
from heliocat.schemas import (
    FLARES,
    FLARES_KEY,
    OBSERVATIONS,
    SOLAR_INDICES,
    align,
    conform_events,
)


@dataclass(frozen=True)
class InsertResult:
    """What became of a batch: ``read = inserted + held + repeated + rejected``.

    ``rejected`` rows did not fit the table, ``held`` keys were in it already and ``repeated``
    rows have the key of another row of the batch.
    """

    read: int
    inserted: int
    rejected: int
    held: int = 0
    repeated: int = 0


#: a row's place in its written batch, and with the insert's name the place it has for good
_ROW, _PLACE = "_row", "_place"
#: the folder of rows of a stretch of time, and how many rows it has, more or less
_SLICE, SLICE_ROWS = "slice", 4_000_000
_DAY = re.compile(r"\d{4}-\d\d-\d\d")
_FILES = "file string, rows long, first timestamp_ntz, last timestamp_ntz"
#: files that a ledger knows; one that is written anew has another length or time
LEDGER = "path string, length long, modified timestamp"


class KeyedTable:
    """Parquet rows with a key, in parts that each insert adds by one commit.

    Any number of writers: an insert is computed against the newest commit and published as the
    next. If another writer was first, the keys it has added are taken out of the insert, which
    then tries the next number. A reader has one commit; a killed insert is in none.

    The batch is written once before it is merged, so its rows are counted and merged as
    written. An insert with a name (``batch_name``) that is committed already adds nothing and
    gives the counts of the first. Rows whose key has a null equal no other and are all added.

    Rows that do not fit the table are committed with the insert, with a reason, below
    ``rejects_path``, beside the table unless given. A batch of at most ``small_batch_rows`` rows
    broadcasts its keys to the table; beyond that both sides are shuffled.

    Rows lie by year and, within a part, by slices of time of some ``slice_rows`` rows; each part
    has a list of its files with their times, from which a page finds the files around it.
    """

    def __init__(
        self,
        spark: SparkSession,
        path: str,
        schema: T.StructType = FLARES,
        key: list[str] = FLARES_KEY,
        time: str = "event_start",
        id_mode: str = "hash",
        rejects_path: str | None = None,
        small_batch_rows: int = 200_000,
        slice_rows: int = SLICE_ROWS,
    ):
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.key, self.time, self.id_mode = key, time, id_mode
        self.rejects_path = rejects_path or f"{self.path}-rejects"
        self.small_batch_rows, self.slice_rows = small_batch_rows, slice_rows
        self._year = f"{time}_year"
        # rows without a time are rejected before the merge
        self._nullable = [k for k in key if k != time]
        self._log = CommitLog(spark, f"{self.path}/log")

    @property
    def _stored(self) -> T.StructType:
        folders = [("part", T.StringType()), (self._year, T.IntegerType()), (_SLICE, T.LongType())]
        return T.StructType([*self.schema.fields, *[T.StructField(*f) for f in folders]])

    def create(self) -> "KeyedTable":
        """Publish the empty table; one that is there already stays."""
        self._log.create()
        return self

    def _parts(self, kind: str, state: State, schema: T.StructType | str) -> DataFrame:
        """Rows of one kind of folder that belong to a commit."""
        wanted = T._parse_datatype_string(schema) if isinstance(schema, str) else schema
        folders = [self._folder(kind, n) for p in state.parts.values() for n in p.get(kind, ())]
        if not folders:
            return self.spark.createDataFrame([], wanted)
        rows = self.spark.read.schema(wanted).option("basePath", self._folder(kind)).parquet(*folders)
        return rows.select(*wanted.names)

    def _folder(self, kind: str, name: str | None = None) -> str:
        """Where folders of a kind lie, or the one of a name."""
        folder = self.rejects_path if kind == "rejects" else f"{self.path}/{kind}"
        return f"{folder}/part={name}" if name else folder

    def _rows(self, state: State, date_from=None, date_to=None) -> DataFrame:
        """The rows of a commit, of the parts whose times meet the bounds."""
        lower, upper = (str(d)[:10] if d and _DAY.match(str(d)) else "" for d in (date_from, date_to))
        meets = {
            n: p
            for n, p in state.parts.items()
            if not (lower and p["last"] < lower) and not (upper and p["first"][:10] > upper)
        }
        return self._parts("data", State(state.version, meets), self._stored)

    def read(self, date_from=None, date_to=None) -> DataFrame:
        """The table as of the newest commit; bounds on the time skip parts and folders of years."""
        return self._within(self._log.latest(), date_from, date_to).select(*self.schema.names)

    def _within(self, state: State, date_from=None, date_to=None) -> DataFrame:
        within = between(self.time, date_from, date_to)
        if date_from:
            within.append(F.col(self._year) >= F.year(moment(date_from)))
        if date_to:
            within.append(F.col(self._year) <= F.year(moment(date_to)))
        return self._rows(state, date_from, date_to).filter(all_of(within))

    def read_rejects(self, *kept: str) -> DataFrame:
        """Rows that did not fit, with ``reject_reason``; those of committed inserts only.

        ``kept`` names further columns of the batches, such as ``"file string"``.
        """
        fields = [f for f in self.schema.fields if f.name not in ("id", "created_at")]
        more = T._parse_datatype_string(", ".join(["reject_reason string", *kept])).fields
        return self._parts("rejects", self._log.latest(), T.StructType([*fields, *more]))

    def read_ledger(self) -> DataFrame:
        """path, length, modified: the files that committed inserts have read."""
        return self._parts("ledger", self._log.latest(), LEDGER)

    # pages

    def _around(self, offset: int, size: int) -> tuple[DataFrame, int]:
        """Rows of the files that may hold rows ``offset .. offset + size`` of the list, newest
        first, and how many rows of other files lie above them. Files are found by their counts.
        """
        listed = self._parts("files", self._log.latest(), _FILES)
        # as numbers that do not depend on the session's zone
        micros = lambda c: (exact_seconds_since(F.col(c)) * 1_000_000).cast("long")
        places = listed.select("file", "rows", (-micros("last")).alias("top"), (-micros("first")).alias("end"))
        above = Window.orderBy("top").rangeBetween(Window.unboundedPreceding, -1)
        whole = Window.orderBy("end").rangeBetween(Window.unboundedPreceding, Window.currentRow)
        counted = places.withColumns({"_above": F.coalesce(F.sum("rows").over(above), F.lit(0)), "_whole": F.sum("rows").over(whole)})
        # no row above ``top`` is wanted, as at most ``offset`` rows are; none below ``end``, as enough are above
        bounds = counted.agg(
            F.max(F.when(F.col("_above") <= offset, F.col("top"))).alias("top"),
            F.min(F.when(F.col("_whole") >= offset + size, F.col("end"))).alias("end"),
        ).first()
        if bounds["top"] is None:
            return self.spark.createDataFrame([], self.schema), 0
        meets = F.col("end") >= F.lit(bounds["top"])
        skipped = places.agg(F.sum(F.when(~meets, F.col("rows")))).first()[0] or 0
        if bounds["end"] is not None:
            meets = meets & (F.col("top") <= F.lit(bounds["end"]))
        names = [r["file"] for r in places.filter(meets).select("file").collect()]
        rows = (
            self.spark.read.schema(self._stored)
            .option("basePath", f"{self.path}/data")
            .parquet(*[f"{self.path}/data/{n}" for n in names])
        )
        return rows.select(*self.schema.names), skipped

    def read_page(self, page: int, page_size: int, tie: str = "id") -> DataFrame:
        """One page of the whole list, newest first, from the files around it."""
        offset = page_offset(page, page_size)
        rows, skipped = self._around(offset, page_size)
        return newest_first(rows, offset - skipped, page_size, self.time, tie)

    def read_newest(self, size: int = 1) -> DataFrame:
        """Rows of the files that may hold the newest ``size`` rows."""
        return self._around(0, size)[0]

    # inserts

    def _conform(self, batch: DataFrame, order: list[str]) -> DataFrame:
        if self.schema is FLARES:
            return conform_events(batch, order)
        given = [f for f in self.schema.fields if f.name not in ("id", "created_at")]
        hint = ["reject_hint"] if "reject_hint" in batch.columns else []
        reasons = [*map(F.col, hint), F.when(F.col(self.time).isNull(), f"{self.time} is null")]
        return align(batch, T.StructType(given), [*order, *hint]).withColumn(
            "reject_reason", F.coalesce(*reasons)
        ).drop(*hint)

    def _tally(self, conformed: DataFrame) -> dict:
        """Counts of a batch and its times, from one pass; repeats are folded in each task first."""
        whole = F.col("reject_reason").isNull() & has_key(self.key)
        kind = F.when(F.col("reject_reason").isNotNull(), "rejected").when(whole, "whole").otherwise("loose")
        keys = [F.when(whole, F.col(k)).alias(k) for k in self.key]
        times = [f(F.when(F.col("reject_reason").isNull(), F.col(self.time))) for f in (F.min, F.max)]
        grouped = conformed.groupBy(kind.alias("_kind"), *keys).agg(
            F.count("*").alias("_n"), times[0].alias("_first"), times[1].alias("_last")
        )
        of = lambda name: F.col("_kind") == name
        total = lambda name: F.coalesce(F.sum(F.when(of(name), F.col("_n"))), F.lit(0)).alias(name)
        row = grouped.agg(
            *map(total, ("rejected", "whole", "loose")),
            F.count_if(of("whole")).alias("keys"),
            F.min("_first").alias("first"),
            F.max("_last").alias("last"),
        ).first()
        return row.asDict()

    def _result(self, tally: dict, inserted: int) -> InsertResult:
        return InsertResult(
            read=tally["rejected"] + tally["whole"] + tally["loose"],
            inserted=inserted,
            rejected=tally["rejected"],
            held=tally["keys"] + tally["loose"] - inserted,
            repeated=tally["whole"] - tally["keys"],
        )

    def fresh(self, batch: DataFrame, order: list[str] = ["seq"]) -> DataFrame:
        """The rows an insert of ``batch`` would add; nothing is written (dry run)."""
        fitting = self._conform(batch, order).filter("reject_reason IS NULL").drop("reject_reason")
        table = self._rows(self._log.latest())
        return insert_ignore(table, fitting, self.key, order, self._nullable, unique=True)

    def count_fresh(self, batch: DataFrame, order: list[str] = ["seq"]) -> InsertResult:
        """What an insert of ``batch`` would count; nothing is written (dry run)."""
        return self._result(self._tally(self._conform(batch, order)), self.fresh(batch, order).count())

    def insert_ignore(
        self,
        batch: DataFrame,
        order: list[str] = ["seq"],
        batch_name: str | None = None,
        files: DataFrame | None = None,
    ) -> InsertResult:
        """Add the rows whose key is new; the first of a key by ``order`` wins.

        ``files`` (path, length, modified) are entered into the ledger by the same commit. The
        batch's times limit what is read of the table, and its size decides whether its keys are
        broadcast or both sides are shuffled.
        """
        state = self._log.latest()
        if batch_name and (done := _counts_of(state, batch_name)):
            return done
        name, own = str(uuid.uuid4()), Files(self.spark, self.path)
        conformed = self._conform(batch, order).withColumn(_ROW, F.monotonically_increasing_id())
        staged = self._written(conformed, "staged", name)
        tally = self._tally(staged)
        fits = F.col("reject_reason").isNull()
        part: dict = {"rows": 0, "first": "", "last": ""}
        if tally["rejected"]:
            self._written(staged.filter(~fits).drop(_ROW), "rejects", name)
            part["rejects"] = [name]
        if files is not None:
            self._written(align(files, T._parse_datatype_string(LEDGER)), "ledger", name)
            part["ledger"] = [name]
        if tally["whole"] + tally["loose"]:
            fitting = staged.filter(fits).drop("reject_reason")
            new = self._new_rows(state, fitting, tally, order)
            place = F.concat(F.lit(f"{batch_name or name} "), F.col(_ROW))
            stamped = new.withColumns({_PLACE: place, "created_at": F.current_timestamp()})
            part |= self._lay_out(self._numbered(stamped, state), name, tally)
        while True:
            result = self._result(tally, part["rows"])
            part["batches"] = {batch_name: asdict(result)} if batch_name else {}
            if self._log.publish(state, {"add": {name: part}}):
                break
            before, state = state, self._log.latest()
            if batch_name and (done := _counts_of(state, batch_name)):
                return done  # another run of the same insert was first
            if part["rows"] and (late := self._late_keys(before, state, part, tally)) is not None:
                rest = self._parts("data", State(0, {name: part}), self._stored).join(late, self.key, "left_anti")
                part |= self._lay_out(self._numbered(rest, state, again=True), str(uuid.uuid4()), tally)
        own.delete(self._folder("staged", name))
        return result

    def _written(self, rows: DataFrame, kind: str, name: str) -> DataFrame:
        """Rows written to a folder of the table, which no commit names yet."""
        rows.write.parquet(self._folder(kind, name))
        return self.spark.read.schema(rows.schema).parquet(self._folder(kind, name))

    def _new_rows(self, state: State, fitting: DataFrame, tally: dict, order: list[str]) -> DataFrame:
        held = self._within(state, tally["first"], tally["last"])
        if tally["whole"] <= self.small_batch_rows:
            wanted = F.broadcast(fitting.select(*self.key).distinct())
            held = held.select(*self.key).join(wanted, self.key, "left_semi")
        return insert_ignore(held, fitting, self.key, order, self._nullable, unique=True)

    def _late_keys(self, before: State, after: State, part: dict, tally: dict) -> DataFrame | None:
        """Keys of an insert's written rows that other writers have added meanwhile, or None.

        Ids that go on from the table's last one are given anew if any rows were added.
        """
        since = {n: p for n, p in after.parts.items() if n not in before.parts and not p.get("moved")}
        added = self._within(State(0, since), tally["first"], tally["last"]).select(*self.key)
        mine = self._parts("data", State(0, {"": part}), self._stored).select(*self.key)
        late = added.join(mine, self.key, "left_semi")
        renumber = self.id_mode != "hash" and any(p["rows"] for p in since.values())
        return late if renumber or not late.isEmpty() else None

    def _numbered(self, rows: DataFrame, state: State, again: bool = False) -> DataFrame:
        """Rows with ids; ``again`` if they have some that are not to be kept but in hash mode."""
        if self.id_mode == "hash":
            return rows if again else assign_ids(rows, "hash", 0, self.key, [_PLACE])
        after = self._rows(state).agg(F.max("id")).first()[0] or 0
        rows = rows.withColumnRenamed("id", _PLACE) if again else rows
        return assign_ids(rows, self.id_mode, after, self.key, [_PLACE])

    def _lay_out(self, rows: DataFrame, name: str, tally: dict) -> dict:
        """Write rows as files of one year and slice of time each, and the list of these files.

        Gives what a commit says of them; the counts are taken from what was written.
        """
        fitting = tally["whole"] + tally["loose"]
        part = F.lit(0).cast("long")
        if slices := fitting // self.slice_rows:
            width = int((tally["last"] - tally["first"]).total_seconds()) // slices + 1
            part = F.call_function("div", seconds_since(F.col(self.time), str(tally["first"])), F.lit(width))
        placed = align(rows, self.schema).withColumns({self._year: F.year(self.time), _SLICE: part})
        # sorted within each file, so its min and max let readers skip parts of it
        (
            # few files per slice; adaptive execution splits one that is too large
            placed.hint("rebalance", self._year, _SLICE)
            .sortWithinPartitions(self._year, _SLICE, self.time)
            .write.partitionBy(self._year, _SLICE)
            # ids are not sorted, so min and max do not help a lookup by id
            .option("parquet.bloom.filter.enabled#id", "true")
            .option("parquet.bloom.filter.adaptive.enabled", "true")
            .parquet(self._folder("data", name))
        )
        lies = F.element_at(F.split("_path", f"/data/part={name}"), -1)
        listed = (
            self.spark.read.schema(self._stored)
            .option("basePath", self._folder("data"))
            .parquet(self._folder("data", name))
            .groupBy(F.col("_metadata.file_path").alias("_path"))
            .agg(F.count("*").alias("rows"), F.min(self.time).alias("first"), F.max(self.time).alias("last"))
            .select(F.concat(F.lit(f"part={name}"), lies).alias("file"), "rows", "first", "last")
        )
        found = self._written(listed, "files", name).agg(F.sum("rows"), F.min("first"), F.max("last")).first()
        there = [name] if found[0] else []
        return {"rows": found[0] or 0, "first": str(found[1] or ""), "last": str(found[2] or ""), "data": there, "files": there}

    def compact(self, below_rows: int = SLICE_ROWS) -> int:
        """Make one part of those under ``below_rows`` rows; gives the number of parts merged.

        Old folders stay for readers of earlier commits. Of numbered inserts of one name, such as
        a stream's, only the last stays known, as only that can come again.
        """
        state = self._log.latest()
        small = {n: p for n, p in state.parts.items() if p["rows"] < below_rows}
        if len(small) < 2:
            return 0
        name, rows = str(uuid.uuid4()), sum(p["rows"] for p in small.values())
        part: dict = {"rows": 0, "first": "", "last": "", "moved": True}
        if rows:
            merged = self._rows(State(0, small))
            ends = merged.agg(F.min(self.time).alias("first"), F.max(self.time).alias("last")).first()
            part |= self._lay_out(merged, name, {"whole": rows, "loose": 0, **ends.asDict()})
        for kind in ("rejects", "ledger"):
            part[kind] = [n for p in small.values() for n in p.get(kind, ())]
        part["batches"] = _last_of_each({b: c for p in small.values() for b, c in p["batches"].items()})
        while not self._log.publish(state, {"add": {name: part}, "remove": list(small)}):
            state = self._log.latest()
            if not small.keys() <= state.parts.keys():
                return 0  # another writer has merged them
        return len(small)


def _counts_of(state: State, batch: str) -> InsertResult | None:
    """What an insert of this name has counted, if one is committed."""
    counts = next((p["batches"][batch] for p in state.parts.values() if batch in p["batches"]), None)
    return InsertResult(**counts) if counts else None


def _last_of_each(batches: dict[str, dict]) -> dict[str, dict]:
    """Of names that differ in a number at their end, the one of the largest number."""
    last: dict[str, tuple[int, str]] = {}
    for name in batches:
        head, _, number = name.rpartition(" ")
        if head and number.isdigit():
            last[head] = max(last.get(head, (-1, "")), (int(number), name))
        else:
            last[name] = (0, name)
    return {name: batches[name] for _, name in last.values()}


def observation_table(spark: SparkSession, path: str) -> KeyedTable:
    """The older table, where an event is known by its start alone."""
    return KeyedTable(spark, path, OBSERVATIONS, ["event_start"])


class SnapshotTable:
    """A lookup with one row per key, in parts by year; each change is one commit.

    A change writes the years that it touches anew, all in one part, and its commit puts them
    in the place of the old ones; files of other years are not touched. Readers never see half
    of a change, and of two writers the later one merges again, on top of the other's commit.
    """

    def __init__(self, spark: SparkSession, path: str, schema: T.StructType = SOLAR_INDICES, day: str = "date"):
        self.spark, self.path, self.schema, self.day = spark, path.rstrip("/"), schema, day
        self._log = CommitLog(spark, f"{self.path}/log")

    def create(self) -> "SnapshotTable":
        """Publish the empty lookup; one that is there already stays."""
        self._log.create()
        return self

    def version(self) -> int:
        """Number of the newest commit; 0 before the first change."""
        return self._log.latest().version

    def read(self, version: int | None = None) -> DataFrame:
        """The lookup as of a commit; without one the newest."""
        state = self._log.latest() if version is None else self._log.at(version)
        return self._of_years(state)

    def _of_years(self, state: State, years: list[int] | None = None) -> DataFrame:
        folders = [
            f"{self.path}/data/part={p['data']}/year={p['year']}"
            for p in state.parts.values()
            if years is None or p["year"] in years
        ]
        if not folders:
            return self.spark.createDataFrame([], self.schema)
        return self.spark.read.schema(self.schema).parquet(*folders)

    def upsert(
        self, feed: DataFrame, columns: list[str], insert_only: list[str] = [], key: list[str] = ["date"]
    ) -> int:
        """Insert or update the feed's own columns; gives the new version."""
        return self.upsert_all([(feed, columns, insert_only)], key)

    def upsert_all(self, feeds: list[tuple[DataFrame, list[str], list[str]]], key: list[str] = ["date"]) -> int:
        """Several feeds (rows, their columns, those only set on insert) in one merge and one commit.

        Gives the new version. A later feed comes on top of an earlier one. The feeds' last rows
        per key are written once; their years, which are few, are what is read of the lookup.
        """
        name, own = str(uuid.uuid4()), Files(self.spark, self.path)
        folder = f"{self.path}/staged/part={name}"
        given = last_of_feeds(feeds, key)
        given.write.parquet(folder)
        staged = self.spark.read.schema(given.schema).parquet(folder)
        years = sorted(r[0] for r in staged.select(F.year(self.day)).distinct().collect() if r[0] is not None)
        while True:
            state = self._log.latest()
            merged = merge_feeds(self._of_years(state, years), staged, feeds, key).withColumn("year", F.year(self.day))
            part = str(uuid.uuid4())
            # a year has few days, so it is one file
            merged.repartition("year").sortWithinPartitions("year", *key).write.partitionBy("year").parquet(
                f"{self.path}/data/part={part}"
            )
            entry = {"add": {str(y): {"year": y, "data": part} for y in years}}
            if self._log.publish(state, entry):
                own.delete(folder)
                return state.version + 1


def write_csv(df: DataFrame, path: str) -> None:
    """The catalog as CSV with a header."""
    df.write.mode("overwrite").option("header", True).csv(path)

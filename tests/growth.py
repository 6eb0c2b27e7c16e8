"""Growth of collapse, insert-if-absent and statistics with the rows.

``python tests/growth.py SCRATCH ROWS [ROWS ...]`` makes the rows once per size, a third
of them under one key, and prints the seconds of each operator.
"""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from heliocat.functions.times import utc  # noqa: E402
from heliocat.operators.collapse import StatusColumns, collapse_events  # noqa: E402
from heliocat.operators.merge import insert_ignore  # noqa: E402
from heliocat.operators.statistics import stats_long  # noqa: E402
from heliocat.session import spark_session  # noqa: E402

STATUSES = ["EVENT_START", "EVENT_PEAK", "EVENT_END", "POST_EVENT"]


def status_rows(spark, n):
    status = F.element_at(F.array(*map(F.lit, STATUSES)), (F.col("id") % 4 + 1).cast("int"))
    hot = F.rand(1) < 1 / 3
    return spark.range(n).select(
        F.when(hot, 7).otherwise(F.floor(F.col("id") / 4)).alias("flare_id"),
        status.alias("status"),
        F.col("id").cast("double").alias("time"),
        (F.rand(2) * 1e-4).alias("xrsb_flux"),
        F.rand(3).alias("integrated_flux"),
        F.concat(F.lit("C"), F.round(F.rand(4) * 9, 1).cast("string")).alias("flare_class"),
        F.col("id").alias("pos"),
    )


def events(spark, n, seed):
    seconds = F.floor(F.rand(seed) * 1.5e9).cast("bigint")
    start = F.timestamp_add("SECOND", seconds, utc("1975-01-01 00:00:00"))
    return spark.range(n).withColumn("hot", F.rand(seed + 1) < 1 / 3).select(
        F.when(F.col("hot"), utc("2001-01-01 00:00:00")).otherwise(start).alias("event_start"),
        F.when(F.rand(seed + 2) < 0.9, "G18").alias("instrument"),
        F.concat(F.lit("C"), (F.col("id") % 90 / 10).cast("string")).alias("magnitude"),
        F.rand(seed + 3).alias("xrsb_flux_peak"),
        F.col("id").alias("seq"),
    )


def main(scratch, *sizes):
    spark = spark_session(
        "growth",
        "local[8]",
        **{
            "spark.sql.shuffle.partitions": "32",
            "spark.driver.memory": "12g",
            "spark.local.dir": scratch,
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def stored(name, df):
        df.write.parquet(f"{scratch}/{name}")
        return spark.read.parquet(f"{scratch}/{name}")

    for n in map(int, sizes):
        rows = stored(f"status-{n}", status_rows(spark, n))
        batch = stored(f"batch-{n}", events(spark, n, 1))
        held = stored(f"held-{n}", events(spark, n // 2, 11))
        runs = {
            "collapse": lambda: collapse_events(rows),
            "collapse, numeric": lambda: collapse_events(rows, StatusColumns(magnitude=None)),
            "insert-if-absent": lambda: insert_ignore(held, batch),
            "insert, unique table": lambda: insert_ignore(held, batch, unique=True),
            "statistics": lambda: stats_long(batch),
        }
        for name, run in runs.items():
            spent = []
            for _ in range(2):
                start = time.perf_counter()
                run().write.format("noop").mode("overwrite").save()
                spent.append(time.perf_counter() - start)
            print(f"{n:>10} {name:20s} {min(spent):7.2f}", flush=True)


if __name__ == "__main__":
    main(*sys.argv[1:])

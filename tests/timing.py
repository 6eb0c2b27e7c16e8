"""Wall time of registered queries: ``python tests/timing.py FOLDER [name ...]``."""

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

import __spark_entry__ as entry  # noqa: E402
from heliocat.session import spark_session  # noqa: E402

if __name__ == "__main__":
    folder, *names = sys.argv[1:]
    spark = spark_session("timing", "local[8]", **{"spark.sql.shuffle.partitions": "8"})
    spark.sparkContext.setLogLevel("ERROR")
    for name, query in entry.queries().items():
        if names and name not in names:
            continue
        spent = []
        for _ in range(2):
            start = time.perf_counter()
            query(spark, folder).write.format("noop").mode("overwrite").save()
            spent.append(time.perf_counter() - start)
        print(f"{name:28s} {spent[0]:7.2f} {spent[1]:7.2f}", flush=True)

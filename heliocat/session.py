"""Session settings the jobs rely on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
}


def spark_session(
    app: str = "heliocat", master: str | None = None, **settings: str
) -> SparkSession:
    """A session with the settings above; ``settings`` use ``_`` for ``.``-separated names."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**SETTINGS, **settings}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


#: tasks that look up the files a read names; by Spark's default each file is a task
LISTING = "spark.sql.sources.parallelPartitionDiscovery.parallelism"
LISTING_TASKS = 100


def list_in_few_tasks(spark: SparkSession) -> None:
    """Let a task of the session look up many files, as starting it takes longer than a look-up.

    A session that is set to fewer tasks already stays as it is.
    """
    if int(spark.conf.get(LISTING)) > LISTING_TASKS:
        spark.conf.set(LISTING, str(LISTING_TASKS))


def shared_folder(spark: SparkSession) -> str:
    """A new folder's name below ``spark.checkpoint.dir``, which all machines must share.

    Where that is unset, a local session gets a temporary folder for it; any other fails.
    """
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local["):
            raise RuntimeError("spark.checkpoint.dir must name a folder that all machines share")
        shared = tempfile.mkdtemp(prefix="heliocat-")
        spark.conf.set("spark.checkpoint.dir", shared)
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared)
    return f"{shared.rstrip('/')}/heliocat-{uuid.uuid4()}"

"""Session settings the operators are tuned for."""

from __future__ import annotations

from pyspark.sql import SparkSession


def build_session(app: str = "pagetide", master: str | None = None, **conf: str) -> SparkSession:
    """A session in UTC with ANSI mode and adaptive execution.

    On a cluster leave ``master`` unset so that the submit command decides, and size
    ``spark.sql.shuffle.partitions`` there (about 2-3 tasks per core, 100-200 MB each);
    adaptive execution merges the partitions that turn out small.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.ansi.enabled": "true",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        # Call sites are not recorded for every column: plans here are built from many.
        "spark.python.sql.dataFrameDebugging.enabled": "false",
        **conf,
    }
    for key, value in settings.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()

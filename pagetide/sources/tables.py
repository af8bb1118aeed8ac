"""The shared work folder, tables stored in it for the length of a job, and numbered versions."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

#: Folder of a local run whose session names none.
_local: dict[str, str] = {}


def use_local_dir(spark: SparkSession, path: str | None = None) -> None:
    """Name a work folder for a session on one machine that has no ``spark.checkpoint.dir``.

    Does nothing where the session names a shared folder or runs on a cluster.
    """
    context = spark.sparkContext
    if _shared_dir(spark) is None and context.master.startswith(("local[", "local")):
        if not context.master.startswith("local-cluster"):
            _local[context.applicationId] = path or f"/tmp/pagetide-{context.applicationId}"


def _shared_dir(spark: SparkSession) -> str | None:
    shared = spark.conf.get("spark.checkpoint.dir", None)
    return shared or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)


def work_dir(spark: SparkSession) -> str:
    """The shared folder that ``spark.checkpoint.dir`` names."""
    found = _shared_dir(spark) or _local.get(spark.sparkContext.applicationId)
    if found is None:
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    return found


def _fs(spark: SparkSession, path: str):
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop, hadoop.getFileSystem(spark._jsc.hadoopConfiguration())


def write_version(df: DataFrame, root: str, version: int) -> None:
    """Write a version of a table to a folder of its own; its number is the caller's to give, once."""
    df.write.parquet(f"{root}/version={int(version)}")


def read_version(spark: SparkSession, root: str, version: int | None = None) -> DataFrame:
    """A version of a table, by default the one with the highest number."""
    if version is None:
        numbers = spark.read.parquet(root).agg(F.max("version").alias("newest"))
        version = numbers.first()["newest"]
    return spark.read.parquet(f"{root}/version={int(version)}")


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """No rows of a schema, known as empty to Catalyst; ``createDataFrame`` would start Python workers."""
    return spark.range(1).select(*[F.lit(None).cast(f.dataType).alias(f.name) for f in schema]).limit(0)


def scratch(spark: SparkSession, kind: str = "stored") -> str:
    """A new path under this application's part of the shared folder."""
    return f"{work_dir(spark)}/pagetide-{spark.sparkContext.applicationId}/{kind}-{uuid.uuid4().hex}"


def stored(df: DataFrame) -> DataFrame:
    """The frame written to the shared folder and read back.

    Cuts the lineage where a result is read many times, survives the loss of executors, and
    gives Catalyst the size of what was written. ``clean`` removes it.
    """
    path = scratch(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_with(df: DataFrame, **counts: Column) -> tuple[DataFrame, dict]:
    """``stored``, and aggregates of the rows that are worked out while they are written."""
    seen = Observation()
    frame = stored(df.observe(seen, *[value.alias(name) for name, value in counts.items()]))
    return frame, seen.get


def clean(spark: SparkSession) -> None:
    """Remove all that ``stored`` wrote in this application; frames that read it end here."""
    path, fs = _fs(spark, f"{work_dir(spark)}/pagetide-{spark.sparkContext.applicationId}")
    fs.delete(path, True)

"""Session settings that the engine relies on."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Duplicate keys of a JSON object: the last one counts. Instants are read and written in UTC.
SETTINGS = {"spark.sql.variant.allowDuplicateKeys": "true", "spark.sql.session.timeZone": "UTC"}


def configure(spark: SparkSession) -> SparkSession:
    for key, value in SETTINGS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_folder(spark: SparkSession, label: str) -> str:
    """A new folder that all executors see: under spark.checkpoint.dir; where that is unset, a temporary one in local mode and an error on a cluster.

    It is removed when the driver's process ends.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if not named:
        master = spark.sparkContext.master
        if not master.startswith("local") or master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that all executors see")
        named = "file://" + tempfile.mkdtemp(prefix="tidewheel-")
    folder = f"{named.rstrip('/')}/{label}-{uuid.uuid4().hex}"
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(path)
    files.deleteOnExit(path)
    return folder


def written(df: DataFrame, folder: str) -> DataFrame:
    """df as a table that is written once: several steps read it, and a lost executor costs none of what made it."""
    df.write.mode("overwrite").parquet(folder)
    return df.sparkSession.read.schema(df.schema).parquet(folder)

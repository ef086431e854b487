"""Tables written to the folder that all machines share, which end a plan's lineage."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir. A local session that names none (as in tests) gets a temporary one; on a cluster it is an error."""
    context = spark.sparkContext
    folder = context.getCheckpointDir()
    if folder is None:
        named = spark.conf.get("spark.checkpoint.dir", None)
        if named is None and not context.master.startswith("local"):
            raise RuntimeError("spark.checkpoint.dir has to name a folder that driver and executors share")
        context.setCheckpointDir(named or tempfile.mkdtemp(prefix="tidepanel-"))
        folder = context.getCheckpointDir()
    return folder


def exists(spark: SparkSession, path: str) -> bool:
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()).exists(place)


def fresh_path(spark: SparkSession) -> str:
    return f"{shared_folder(spark)}/tidepanel-{uuid.uuid4().hex}"


def written(df: DataFrame) -> DataFrame:
    """df as a table of the shared folder: computed once, and a lost executor costs nothing."""
    path = fresh_path(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)

"""Session helpers: where iterative jobs cut their lineage, and stages of a run that end with it."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_CONF = "spark.checkpoint.dir"


def checkpoint_dir(spark: SparkSession) -> str:
    """Folder shared by all executors, as the session names it.

    Only a local session without the setting falls back to a temporary folder.
    """
    sc = spark.sparkContext
    named = spark.conf.get(CHECKPOINT_CONF, None) or sc.getCheckpointDir()
    if named:
        if not sc.getCheckpointDir():
            sc.setCheckpointDir(named)
        return named
    if not sc.master.startswith("local"):
        raise ValueError(f"set {CHECKPOINT_CONF} to a folder that every executor can reach")
    local = tempfile.mkdtemp(prefix="townform-")
    sc.setCheckpointDir(local)
    return local


def delete_folder(spark: SparkSession, path: str) -> bool:
    """Delete a folder in whatever store it lies."""
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(target, True)


class Stages:
    """Tables that several branches of a run read, as Parquet in the shared folder.

    Unlike a checkpoint of rows a stage gives each reader its columns only. All stages of a run lie in one
    folder, which is removed when the run ends, also when it fails.
    """

    def __init__(self, spark: SparkSession):
        self.spark, self.folder = spark, f"{checkpoint_dir(spark).rstrip('/')}/stages-{uuid.uuid4().hex}"
        self.count = 0

    def __call__(self, df: DataFrame) -> DataFrame:
        self.count += 1
        path = f"{self.folder}/{self.count}"
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def __enter__(self) -> Stages:
        return self

    def __exit__(self, *failure) -> None:
        delete_folder(self.spark, self.folder)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Run ``df`` once and continue from its reliable checkpoint."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)

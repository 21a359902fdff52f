"""Input tables and tables staged in the folder that all executors share."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from townform.session import checkpoint_dir, delete_folder


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder name below ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _written(df: DataFrame, path: str, **options: str) -> DataFrame:
    spark = df.sparkSession
    before = spark.conf.get(CLEANUP, "false")  # without a default of ours an unset one would read as None
    spark.conf.set(CLEANUP, "true")  # the exchanges behind the table are not read again
    try:
        df.write.options(**options).parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def staged(df: DataFrame, name: str, **options: str) -> DataFrame:
    """Write ``df`` once as Parquet in the shared folder and go on from there. ``options`` are the writer's.

    The lineage ends at the written table, so a lost executor recomputes nothing before it.
    """
    return _written(df, shared_folder(df.sparkSession, name), **options)


@contextmanager
def passing(df: DataFrame, name: str) -> Iterator[DataFrame]:
    """As ``staged``, for the time of the block: then the folder goes, also after a failure."""
    path = shared_folder(df.sparkSession, name)
    try:
        yield _written(df, path)
    finally:
        delete_folder(df.sparkSession, path)


def fresh(name: str, taken: Sequence[str]) -> str:
    """``name``, lengthened until no column of ``taken`` has it (Spark compares names without case)."""
    lower = {c.lower() for c in taken}
    while name.lower() in lower:
        name += "_"
    return name


def columns(names: Sequence[str]) -> list[Column]:
    """Columns by their whole names, dots included, as new attributes."""
    return [F.col(f"`{c.replace('`', '``')}`").alias(c) for c in names]


def width(spark: SparkSession) -> int:
    """Number of shuffle partitions, for the few exchanges that name their own."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))

"""Result tables as Parquet, typed, and published together.

A run writes its tables below folders of its own, ``table/run=<run>/part=<zone modulo PARTS>``, sorted by zone, so
that tens of thousands of zones do not make as many files. Nobody sees them until
the run adds one file to ``manifest``: the next version of the list of all (table, zone, run) that count.
Readers take the last version and only the folders it lists, so a run that ends between two tables leaves
everything as it was, and a reader never sees tables of different runs. One run at a time may write.
"""

from __future__ import annotations

import uuid
from collections.abc import Mapping

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from townform.functions import geometry as G
from townform.params import Params
from townform.schemas import FINAL_TABLES, documented, final_schema
from townform.session import delete_folder

MANIFEST = "version long, table_name string, id_zone long, run string"
MODES = ("replace", "append", "recreate")
PARTS = 256  # folders that the zones of a run share
RUNS = 1000  # named in a scan's filter; more are only joined


def _as_declared(column: Column, given: T.DataType, declared: T.DataType, what: str, srid: int) -> Column:
    """The column in its declared type. Numbers may widen; anything else of another type is refused."""
    same = given.simpleString() == declared.simpleString()
    whole = isinstance(given, T.IntegralType) and isinstance(declared, T.IntegralType)
    wider = isinstance(given, T.NumericType) and isinstance(declared, T.DoubleType)
    if not (same or whole or wider or isinstance(given, T.NullType)):
        raise ValueError(f"{what} is {given.simpleString()}, not {declared.simpleString()}")
    if declared != G.GEOMETRY:
        return column if same else column.cast(declared)
    # coordinates of no named system are taken to be in the declared one, those of another are refused
    wrong = F.raise_error(F.concat(F.lit(f"{what} has the reference system "), column["srid"].cast("string")))
    return F.when(F.coalesce(column["srid"], F.lit(0)).isin(0, srid), G.set_srid(column, srid)).when(column.isNotNull(), wrong)


def as_final(df: DataFrame, table: str, p: Params = Params()) -> DataFrame:
    """Columns by name in the declared order and types, under the final key names, with comments. None may be missing."""
    declared = final_schema(table)
    if "pk" in df.columns and declared[0].name != "pk":
        df = df.withColumnRenamed("pk", declared[0].name)
    missing = [f.name for f in declared if f.name not in df.columns]
    if missing:
        raise ValueError(f"{table} lacks {', '.join(missing)}")
    typed = df.select(*[_as_declared(F.col(f.name), df.schema[f.name].dataType, f.dataType, f"{table}.{f.name}", p.srid).alias(f.name)
                        for f in declared])
    return documented(typed, table)


def _manifest(spark: SparkSession, path: str) -> tuple[int, DataFrame]:
    """Last version and its entries (table_name, id_zone, run); 0 and none where nothing is published."""
    try:
        versions = spark.read.schema(MANIFEST).parquet(f"{path}/manifest")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        versions = spark.createDataFrame([], MANIFEST)
    last = versions.agg(F.max("version")).first()[0] or 0
    return last, versions.where(F.col("version") == last).drop("version")


def write_tables(tables: Mapping[str, DataFrame], path: str, mode: str = "replace", p: Params = Params()) -> None:
    """Write the zones present in the tables below ``path`` and publish all at once.

    ``replace`` puts them in the place of those zones only, so a repeated run changes nothing; ``append``
    adds rows; ``recreate`` starts the tables anew. Rows are rebalanced by folder: the small zones of a folder
    share a file, a huge zone gets several. Names, types and reference systems of all tables are checked before the first is
    written, the systems of single rows while they are.
    """
    if mode not in MODES:
        raise ValueError(f"unknown mode {mode}")
    if not tables:
        return
    finals = {name: as_final(df, name, p) for name, df in tables.items()}
    spark = next(iter(finals.values())).sparkSession
    run = uuid.uuid4().hex
    new = []
    for name, rows in finals.items():
        folder = f"{path}/{name}/run={run}"
        (rows.withColumn("part", F.pmod("id_zone", F.lit(PARTS)).cast("int")).hint("rebalance", "part")
         .sortWithinPartitions("part", "id_zone").write.partitionBy("part").parquet(folder))
        zones = spark.read.schema(rows.schema).parquet(folder).select("id_zone").distinct()
        new.append(zones.select(F.lit(name).alias("table_name"), "id_zone", F.lit(run).alias("run")))
    entries = new[0]
    for more in new[1:]:
        entries = entries.unionByName(more)
    version, old = _manifest(spark, path)
    if mode == "replace":
        old = old.join(entries.select("table_name", "id_zone"), ["table_name", "id_zone"], "left_anti")
    elif mode == "recreate":
        old = old.where(~F.col("table_name").isin(list(finals)))
    listed = old.unionByName(entries).select(F.lit(version + 1).cast("long").alias("version"), "table_name", "id_zone", "run")
    listed.coalesce(1).write.mode("append").parquet(f"{path}/manifest")  # one file: it is there or it is not


def write_final(df: DataFrame, path: str, table: str, mode: str = "replace", p: Params = Params()) -> None:
    """Write and publish one table."""
    write_tables({table: df}, path, mode, p)


def read_final(spark: SparkSession, path: str, table: str) -> DataFrame:
    """The published rows of a table, with its declared types and comments."""
    _, entries = _manifest(spark, path)
    entries = entries.where(F.col("table_name") == table).select("run", "id_zone")
    declared = final_schema(table)
    runs = [r["run"] for r in entries.select("run").distinct().limit(RUNS + 1).collect()]
    if not runs:
        return spark.createDataFrame([], declared)
    stored = spark.read.schema(declared.add("run", "string")).parquet(f"{path}/{table}")
    if len(runs) <= RUNS:
        stored = stored.where(F.col("run").isin(runs))
    # columns that name folders lose their comment in a scan
    return documented(stored.join(entries, ["run", "id_zone"], "left_semi").select(*FINAL_TABLES[table]), table)


def drop_unpublished(spark: SparkSession, path: str, tables=tuple(FINAL_TABLES)) -> int:
    """Delete what the last version does not list: zones put out of place and runs that never ended. Gives the number of folders.

    A folder goes with the last of its zones; until then rows of zones put out of place stay in it, unread.
    No run may be writing, and no reader may still use an older version.
    """
    _, entries = _manifest(spark, path)
    gone = 0
    for table in tables:
        try:
            stored = spark.read.schema("id_zone long, run string, part int").parquet(f"{path}/{table}").distinct()
        except AnalysisException:
            continue
        kept = entries.where(F.col("table_name") == table).select("run", "id_zone", F.lit(1).alias("listed"))
        folders = stored.join(kept, ["run", "id_zone"], "left").groupBy("run", "part").agg(F.count("listed").alias("listed"))
        for r in folders.where("listed = 0").toLocalIterator():
            gone += delete_folder(spark, f"{path}/{table}/run={r['run']}/part={r['part']}")
    return gone


def final_counts(spark: SparkSession, path: str, tables=tuple(FINAL_TABLES)) -> DataFrame:
    """Rows per table and zone, read back."""
    counts = [read_final(spark, path, t).groupBy("id_zone").agg(F.count("*").alias("n"))
              .select(F.lit(t).alias("table_name"), "id_zone", "n") for t in tables]
    out = counts[0]
    for c in counts[1:]:
        out = out.union(c)
    return out

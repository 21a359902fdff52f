"""Exact duplicates by a tree merge of digest runs (DataFrame functions only).

Every text becomes a digest row. Rows start in the run of their input partition, pre-aggregated
there. A run number is written in base ``FAN``; in round ``r`` each run hands its rows to the runs
whose ``r``-th digit is that of the row's digest, so ``FAN`` runs exchange slices. Rows are dealt by
run number alone; each receiver merges what it gets into one run sorted by digest, and of equal
digests, now neighbours, the identifier that stays takes over the number of rows. After the last
round a run holds one slice of all digests. The number of rounds follows from the number of rows.

A digest alone is not trusted: at every level rows are merged only when SHA-256, byte length and a
second, independent 64-bit hash all agree. Hot digests shrink to one row for each run before the
first exchange.

Cases: a null text is the empty text. A null identifier is smaller than any other. Rows repeated
with the same identifier and text are one document for ``exact_groups`` (each row is reported, with
the same result) and one row in ``keep_one``. Empty tables give empty results. Other columns, of
whatever name, do not matter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from townform.llm.tables import columns, fresh, staged, width

FAN = 8
RUN_ROWS = 1 << 18
DIGEST = ("sha", "bytes", "check")


def digest_rows(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """id, SHA-256, byte length and check hash of every row."""
    body = F.coalesce(F.col(text), F.lit(""))
    return docs.select(F.col(key).alias("id"), F.unhex(F.sha2(body, 256)).alias("sha"),
                       F.octet_length(body).cast("long").alias("bytes"), F.xxhash64(body).alias("check"))


def _digit(number: Column, r: int) -> Column:
    return F.pmod(F.floor(number / F.lit(FAN ** r)), F.lit(FAN)).cast("long")


def rounds_for(rows: int, run_rows: int = RUN_ROWS) -> int:
    """Rounds after which a run holds ``run_rows`` rows or fewer on average, two at least."""
    rounds = 2
    while rows > run_rows * FAN ** rounds:
        rounds += 1
    return rounds


def merge_runs(rows: DataFrame, keep: str = "max", rounds: int | None = None) -> DataFrame:
    """One row per digest: the identifier that stays and the size of its group."""
    if rounds is None:
        rounds = rounds_for(rows.count())
    largest, runs = keep == "max", FAN ** rounds
    slice_of = F.conv(F.hex(F.substring("sha", 1, 4)), 16, 10).cast("long")
    start = F.pmod(F.spark_partition_id(), F.lit(runs)).cast("long")
    level = (rows.select("id", *DIGEST, start.alias("run")).groupBy("run", *DIGEST)
             .agg((F.max if largest else F.min)("id").alias("id"), F.count("*").alias("n")))
    # a merged run lies sorted by digest; of one digest it receives at most FAN rows
    own = Window.partitionBy("run", *DIGEST).orderBy(F.desc_nulls_last("id") if largest else F.asc_nulls_last("id"))
    everyone = own.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    dealt = (runs, "run") if runs > width(rows.sparkSession) else ("run",)
    for r in range(rounds):
        moved = F.col("run") - _digit(F.col("run"), r) * FAN ** r + _digit(slice_of, r) * FAN ** r
        level = (level.withColumn("run", moved).repartition(*dealt)
                 .select("run", *DIGEST, "id", F.sum("n").over(everyone).alias("n"), F.row_number().over(own).alias("place"))
                 .where("place = 1").drop("place"))
    return level.select(*DIGEST, F.col("id").alias("keep_id"), F.col("n").alias("group_size"))


def exact_groups(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "max") -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256."""
    rows = staged(digest_rows(docs, key, text), "digests")
    winners = merge_runs(rows, keep)
    both = rows.join(winners, list(DIGEST), "left")
    return both.select(F.col("id").alias(key), "keep_id", "group_size",
                       F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"),
                       F.lower(F.hex("sha")).alias("text_sha256"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", keep: str = "max") -> DataFrame:
    """The rows that stay, with all their columns."""
    name = fresh("kept_row", docs.columns)
    label = lambda number, sha: F.concat_ws(":", F.coalesce(number.cast("string"), F.lit("")), sha)
    winners = merge_runs(staged(digest_rows(docs, key, text), "digests"), keep)
    stay = winners.select(label(F.col("keep_id"), F.lower(F.hex("sha"))).alias(name))
    rows = docs.withColumn(name, label(F.col(key), F.sha2(F.coalesce(F.col(text), F.lit("")), 256)))
    # the join leaves rows dealt by label, so repeated rows go without another exchange
    # as new attributes: under a deduplication those of ``docs`` could not meet ``docs`` again in a set operation
    return rows.join(stay, name).dropDuplicates([name]).select(*columns(docs.columns))

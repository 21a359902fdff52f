"""Mix sources to target weights: a budget for each source, filled by bounded knapsack.

Documents are counted by source and exact length in words. A source's target gives whole passes
over it and a rest; the rest is fitted on the length counts: an even share of every length first,
then, for what is left, large lengths down to ``EXACT`` words and dynamic programming over the
bounded counts for all that remains. If that misses the budget, more and more is left to the dynamic
programming, until the budget is met, all of it is exact (then no choice is nearer), or its bit sets
would exceed ``BITS``; the miss is then below the shortest document left. Which documents of a length are taken is drawn by a seeded hash of the
identifier. Lengths, not documents, meet in one task: there are at most as many as the longest
document has words. Only one row per source passes the driver.

The drawing splits a (source, length) group into buckets of about ``BUCKET`` documents and ranks
inside a bucket, so a third of all rows with one length is no hot group.

Cases: a null text has size 0; size 0 is never taken. A null source is a source, the last one.
Repeated rows count as rows; which of two equal rows is taken does not show. A null identifier
draws like any other. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence
from math import gcd

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from townform.llm.tables import columns, fresh, staged

WORD = r"[^\x20\x09-\x0D]+"
EXACT = 1 << 16
BITS = 1 << 31
BUCKET = 1024


def targets(sizes: Sequence[int], weights: Sequence[float], total: float, most: float = 2.0) -> list[float]:
    """Split ``total`` by weight; nothing gets more than ``most`` times its size, others get the excess."""
    out, free = [0.0] * len(sizes), set(range(len(sizes)))
    left = float(total)
    while free:
        unit = left / sum(weights[i] for i in free)
        full = {i for i in free if weights[i] * unit > most * sizes[i]}
        if not full:
            for i in free:
                out[i] = weights[i] * unit
            break
        for i in full:
            out[i] = most * sizes[i]
            left -= out[i]
        free -= full
    return out


def fit_counts(lengths: Sequence[int], counts: Sequence[int], budget: int) -> list[int]:
    """How many documents of each length to take so that the words come as near below ``budget`` as they can.

    The last words are fitted by dynamic programming, bit sets of reachable sums: ``EXACT`` of them, and
    more as long as the budget is missed and the bit sets stay below ``BITS``.
    """
    total = sum(n * c for n, c in zip(lengths, counts))
    if total <= budget:
        return list(counts)
    unit = gcd(*lengths) or 1
    lengths, budget, total = [n // unit for n in lengths], budget // unit, total // unit
    even = [c * budget // total for c in counts]
    best, most, back, spare = None, -1, 0, EXACT
    while True:
        start = [max(0, t - back) for t in even]
        take = _filled(lengths, counts, start, budget, spare, best is None)
        if take is None:
            return best
        words = sum(n * t for n, t in zip(lengths, take))
        if words > most:
            best, most = take, words
        if most == budget or (spare >= budget and not any(start)):
            return best
        back, spare = 2 * back + 1, 2 * spare


def _filled(lengths: Sequence[int], counts: Sequence[int], start: Sequence[int], budget: int, spare: int, always: bool) -> list[int] | None:
    """``start``, large lengths down to ``spare`` words, and the best of the rest; None if that exceeds ``BITS``, unless ``always``."""
    take = list(start)
    rest = budget - sum(n * t for n, t in zip(lengths, take))
    order = sorted((i for i in range(len(lengths)) if 0 < lengths[i] and take[i] < counts[i]), key=lambda i: -lengths[i])
    for i in order:
        if rest > spare:
            more = min(counts[i] - take[i], (rest - spare) // lengths[i])
            take[i] += more
            rest -= more * lengths[i]
    reach, steps, mask = 1, [], (1 << (rest + 1)) - 1
    for i in order:
        left, part = min(counts[i] - take[i], rest // lengths[i]), 1
        while left and not reach >> rest & 1:
            part = min(part, left)
            steps.append((reach, i, part))
            if not always and len(steps) * rest > BITS:
                return None
            reach |= reach << (part * lengths[i]) & mask
            left, part = left - part, part * 2
    at = reach.bit_length() - 1
    for before, i, part in reversed(steps):
        if not before >> at & 1:
            take[i] += part
            at -= part * lengths[i]
    return take


def mixture(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source",
            weights: Sequence[float] = (3, 1, 2), share: float = 1.5, most: int = 2, seed: int = 7) -> DataFrame:
    """One row per input row: doc_id, source, size, source_size, target, taken."""
    at = F.when(F.col(source).isNull(), F.lit("1")).otherwise(F.concat(F.lit("0"), F.col(source)))
    sized = staged(docs.select(
        F.col(key).alias("id"), at.alias("at"),
        F.coalesce(F.regexp_count(F.col(text), F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
        F.xxhash64(F.lit(seed), F.col(key)).alias("draw")), "sizes")
    lengths = staged(sized.groupBy("at", "size").agg(F.count("*").alias("n")), "lengths")
    sums = lengths.groupBy("at").agg(F.sum(F.col("size") * F.col("n")).alias("size")).collect()
    sums = sorted(((r["at"], r["size"]) for r in sums), key=lambda r: (r[0][0], r[0][1:]))
    goals = targets([s for _, s in sums], [weights[i % len(weights)] for i in range(len(sums))],
                    share * sum(s for _, s in sums), most)
    budget = {name: (size, goal) for (name, size), goal in zip(sums, goals)}

    def fit(rows: pd.DataFrame) -> pd.DataFrame:
        rows = rows.sort_values("size", ignore_index=True)
        size, goal = budget[rows["at"].iloc[0]]
        passes = min(most, int(goal / size + 1e-9)) if size else 0
        rest = max(0, round(goal - passes * size)) if passes < most else 0
        return rows.assign(source_size=size, target=goal, passes=passes,
                           extra=fit_counts(rows["size"].tolist(), rows["n"].tolist(), rest))

    plan = lengths.groupBy("at").applyInPandas(
        fit, "at string, size long, n long, source_size long, target double, passes long, extra long")
    plan = staged(plan, "plan")
    cells = F.greatest(F.lit(1).cast("long"), F.ceil(F.col("n") / BUCKET))
    drawn = staged(sized.join(plan, ["at", "size"]).withColumn("bucket", F.pmod(F.xxhash64("draw"), cells)), "drawn")
    before = W.partitionBy("at", "size").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    ahead = (drawn.groupBy("at", "size", "bucket").agg(F.count("*").alias("here"))
             .withColumn("ahead", F.coalesce(F.sum("here").over(before), F.lit(0))).drop("here"))
    inside = F.row_number().over(W.partitionBy("at", "size", "bucket").orderBy("draw", "id"))
    ranked = drawn.withColumn("rank", inside).join(ahead, ["at", "size", "bucket"])
    once_more = (F.col("ahead") + F.col("rank") <= F.col("extra")).cast("long")
    name = F.when(F.col("at") != "1", F.expr("substring(at, 2)"))
    return ranked.select(F.col("id").alias(key), name.alias(source), "size", "source_size", "target",
                         (F.col("size") * (F.col("passes") + once_more)).alias("taken"))


def mixed(docs: DataFrame, key: str = "doc_id", text: str = "text", source: str = "source", **how) -> DataFrame:
    """The documents of the mix, with all their columns and ``copies``, the number of times each is taken.

    Rows are told apart by identifier and text; fully repeated rows count once. A column ``copies`` of
    ``docs`` is replaced; all others, of whatever name, go through.
    """
    name = fresh("drawn_row", [*docs.columns, "text", "source"])
    times = fresh("copies", docs.columns)
    label = F.concat_ws(":", F.coalesce(F.col(key).cast("string"), F.lit("")), F.xxhash64(F.coalesce(F.col(text), F.lit(""))).cast("string"))
    rows = docs.withColumn(name, label)
    taken = (mixture(rows.select(name, F.col(text).alias("text"), F.col(source).alias("source")), name, "text", "source", **how)
             .where("taken > 0").groupBy(name).agg(F.max(F.col("taken") / F.col("size")).cast("int").alias(times)))
    return rows.join(taken, name).select(*columns([c for c in docs.columns if c.lower() != "copies"]), F.col(times).alias("copies"))

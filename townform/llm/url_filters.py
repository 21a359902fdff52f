"""URL filters: rules on host and path, and trust spread over host links (DataFrame functions only).

A rule names a host and a path; it fits the host and all subdomains when the url's path starts with
the rule's path. The longest fitting rule decides. Other urls get their host's verdict:

* a host is a trusted seed by the share of its pages that rules allow, a distrusted one by the share
  that rules block;
* links in the pages' html, with a scheme or without (``//host/``), are summed to weighted host edges,
  without those inside one host;
* trust runs along the edges (personalised PageRank from the trusted seeds), distrust against them
  (who links to blocked hosts), for ``ROUNDS`` rounds with ``DAMPING``;
* both are scaled so that a host wholly of seeds, without links, has 1. Where distrust exceeds trust
  by ``THRESHOLD`` the host is blocked, else allowed.

Counts by host are pre-aggregated in the map tasks, so a host with a third of all pages is one row
per task. Joins by host are plain joins that Spark splits where they are skewed.

Cases: a null url or one without ``://`` has an empty host and path, fits no rule and is allowed.
Null html has no links. Repeated pages count as often as they stand. Without edges the seeds alone
decide. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from townform.llm.tables import staged

#: host, path, verdict
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
         ("net", "/es/", "block"), ("net", "/fr/", "block"))
DAMPING, ROUNDS, THRESHOLD, EVERY = 0.7, 12, 0.5, 4
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LINK = r"""(?i)(?:href|src)\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'<>\s]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def longest_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> tuple[Column, Column]:
    """Name and verdict of the longest rule that fits, else null."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for h, p, said in sorted(rules, key=lambda r: len(r[0] + r[1])):  # later ones are longer and win
        fits = ((host == h) | host.endswith(F.lit("." + h))) & path.startswith(F.lit(p))
        name, verdict = F.when(fits, F.lit(h + p)).otherwise(name), F.when(fits, F.lit(said)).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """src, dst, links: number of links between different hosts."""
    return (pages.select(host_of(F.col(url)).alias("src"), F.explode(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1))).alias("dst"))
            .withColumn("dst", F.translate("dst", UPPER, LOWER)).where("src <> '' AND dst <> '' AND src <> dst")
            .groupBy("src", "dst").agg(F.count("*").alias("links")))


def spread(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, rounds: int = ROUNDS) -> DataFrame:
    """host, trust, distrust. ``seeds``: host, trust, distrust (shares from 0 to 1)."""
    edges = staged(edges, "edges")
    long_seeds = seeds.select("host", F.explode(F.map_from_arrays(
        F.array(F.lit("trust"), F.lit("distrust")), F.array("trust", "distrust"))).alias("kind", "score"))
    score = seeds.select("host", "trust", "distrust")
    if not edges.isEmpty():
        total = edges.groupBy("src").agg(F.sum("links").alias("links_of"))
        forward = edges.join(total, "src").select(F.lit("trust").alias("kind"), F.col("src").alias("host"), F.col("dst").alias("to"),
                                                  (F.col("links") / F.col("links_of")).alias("part"))
        total = edges.groupBy("dst").agg(F.sum("links").alias("links_of"))
        backward = edges.join(total, "dst").select(F.lit("distrust").alias("kind"), F.col("dst").alias("host"), F.col("src").alias("to"),
                                                   (F.col("links") / F.col("links_of")).alias("part"))
        flow = staged(forward.unionByName(backward), "flow")
        long_seeds = staged(long_seeds.where("score > 0"), "seeds")
        long_scores = long_seeds
        for r in range(rounds):
            sent = flow.join(long_scores, ["kind", "host"]).select(F.col("to").alias("host"), "kind", (F.col("score") * F.col("part") * damping).alias("score"))
            long_scores = long_seeds.unionByName(sent).groupBy("host", "kind").agg(F.sum("score").alias("score"))
            if (r + 1) % EVERY == 0:
                long_scores = staged(long_scores, "scores")
        of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("score"))), F.lit(0.0)).alias(kind)
        score = long_scores.groupBy("host").agg(of("trust"), of("distrust"))
    return score


def judged(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html", rules: Sequence[tuple[str, str, str]] = RULES,
           threshold: float = THRESHOLD) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust."""
    host, path = host_of(F.col(url)), path_of(F.col(url))
    rule, said = longest_rule(F.col("host"), F.col("path"), rules)
    rows = staged(pages.select(F.col(key).alias("page"), host.alias("host"), path.alias("path"))
                  .select("page", "host", "path", rule.alias("rule"), said.alias("said")), "urls")
    share = lambda verdict: F.avg(F.when(F.col("said") == verdict, 1.0).otherwise(0.0)).alias
    seeds = rows.where("host <> ''").groupBy("host").agg(share("allow")("trust"), share("block")("distrust"))
    scores = spread(seeds, host_edges(pages, url, html))
    blocked = F.coalesce(F.col("distrust") - F.col("trust"), F.lit(0.0)) >= threshold
    return (rows.join(scores, "host", "left")
            .select(F.col("page").alias(key), "host", "path", "rule",
                    F.coalesce("said", F.when(blocked, "block").otherwise("allow")).alias("verdict"), "trust", "distrust"))

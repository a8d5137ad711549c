"""Url filters: rules first, then trust and distrust over the host link graph.

The method is link-graph propagation.  Hosts whose pages an allow rule covers
are trusted seeds and hosts whose pages a block rule covers are distrusted
seeds, each weighted by its share of such pages.  Trust runs along the links
(personalised PageRank), distrust runs against them (who links to a blocked
host is suspect).  A host is blocked when its distrust exceeds its trust by
more than ``margin``; a host without any propagated mass is allowed.

Everything is DataFrame and SQL functions.  Edges are aggregated to one
weighted row per host pair before the first iteration, so one host that
holds a third of all pages is a single node.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cdrflow.llm.common import staged

# Fixed values of the rule set (verdict, host, path).
RULES = (
    ("allow", "com", "/"),
    ("block", "example.com", "/en/"),
    ("allow", "www.example.com", "/en/"),
    ("block", "net", "/es/"),
    ("block", "net", "/fr/"),
)

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"

# href targets with a host of their own: scheme://host or //host.
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def url_host(url: Column) -> Column:
    """What stands between the first ``://`` and the next / ? # or end, A-Z
    lower-cased; empty for null or a url without ``://``."""
    return F.coalesce(ascii_lower(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    """From the end of the host up to ? # or end; empty where the host is not defined."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def _fits(host: Column, path: Column, rule_host: str, rule_path: str) -> Column:
    on_host = (host == rule_host) | host.endswith("." + rule_host)
    return on_host & path.startswith(rule_path)


def longest_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, both null if none does.
    Rules of the same length are taken in the order given."""
    rule = verdict = None
    for v, h, p in sorted(rules, key=lambda r: -len(r[1] + r[2])):
        hit = _fits(host, path, h, p)
        rule = F.when(hit, F.lit(h + p)) if rule is None else rule.when(hit, F.lit(h + p))
        verdict = F.when(hit, F.lit(v)) if verdict is None else verdict.when(hit, F.lit(v))
    if rule is None:
        return F.lit(None).cast("string"), F.lit(None).cast("string")
    return rule, verdict


def host_edges(pages: DataFrame, host: str = "host", html: str = "html") -> DataFrame:
    """(src, dst, weight): links between different hosts, one row per pair."""
    links = pages.select(
        F.col(host).alias("src"),
        F.explode(F.array_distinct(F.regexp_extract_all(F.col(html), F.lit(LINK), F.lit(1)))).alias("target"),
    )
    return (
        links.select("src", ascii_lower("target").alias("dst"))
        .filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst")))
        .groupBy("src", "dst")
        .agg(F.count(F.lit(1)).cast("double").alias("weight"))
    )


def personalised_pagerank(
    edges: DataFrame, seeds: DataFrame, damping: float = 0.85, iterations: int = 20, cut_every: int = 5
) -> DataFrame:
    """(host, mass) of a random walk that restarts at the seeds.

    ``edges``: (src, dst, weight); ``seeds``: (host, seed) with seeds that sum
    to 1.  Mass that reaches a host without out-links is lost, so the sum is
    below 1; ``shares_of`` makes up for it.  The rank table has one row per host; it is written
    every ``cut_every`` rounds, which keeps the plan short and gives a lost
    executor little to recompute.
    """
    out = edges.groupBy("src").agg(F.sum("weight").alias("total"))
    steps = staged(
        edges.join(out, "src").select("src", "dst", (F.col("weight") / F.col("total")).alias("p")), "host-steps"
    )
    restart = seeds.select("host", (F.col("seed") * (1 - damping)).alias("mass"))
    rank = seeds.select("host", F.col("seed").alias("mass"))
    for i in range(iterations):
        moved = steps.join(rank, steps["src"] == rank["host"]).select(
            F.col("dst").alias("host"), (F.col("mass") * F.col("p") * damping).alias("mass")
        )
        rank = moved.unionByName(restart).groupBy("host").agg(F.sum("mass").alias("mass"))
        if (i + 1) % cut_every == 0:
            rank = staged(rank, "host-rank")
    return rank


def shares_of(rank: DataFrame) -> DataFrame:
    """``rank`` with masses that sum to 1.

    Lost mass that returns to the seeds is moved on like the seeds' own, which
    in the limit scales all masses alike, so scaling them is the same.
    """
    sums = rank.agg(F.sum("mass").alias("mass")).first()
    return rank.withColumn("mass", F.col("mass") / F.lit(sums["mass"] or 1.0))


def host_verdicts(
    edges: DataFrame, seeds: DataFrame, damping: float = 0.85, iterations: int = 20, margin: float = 0.0
) -> DataFrame:
    """(host, trust, distrust, host_verdict) of every seed and linked host.

    ``seeds``: (host, trusted, blocked) non-negative weights.  Without edges
    the mass stays where the seeds put it.
    """
    seeds = staged(seeds, "host-seeds")
    edges = staged(edges, "host-edges")
    sums = seeds.agg(F.sum("trusted").alias("trusted"), F.sum("blocked").alias("blocked")).first()
    shares = seeds.select("host", *((F.col(c) / (sums[c] or 1.0)).alias(c) for c in ("trusted", "blocked")))
    trusted = shares.filter("trusted > 0").select("host", F.col("trusted").alias("seed"))
    blocked = shares.filter("blocked > 0").select("host", F.col("blocked").alias("seed"))
    if edges.isEmpty():
        trust = trusted.select("host", F.col("seed").alias("trust"))
        distrust = blocked.select("host", F.col("seed").alias("distrust"))
    else:
        reverse = edges.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "weight")
        trust = shares_of(personalised_pagerank(edges, trusted, damping, iterations)).withColumnRenamed("mass", "trust")
        distrust = shares_of(personalised_pagerank(reverse, blocked, damping, iterations)).withColumnRenamed("mass", "distrust")
    both = trust.join(distrust, "host", "full").fillna(0.0, ["trust", "distrust"])
    bad = F.col("distrust") > F.col("trust") + margin
    return both.withColumn("host_verdict", F.when(bad, F.lit("block")).otherwise(F.lit("allow")))


def filter_urls(pages: DataFrame, rules=RULES, damping: float = 0.85, iterations: int = 20, margin: float = 0.0) -> DataFrame:
    """(page_id, host, path, rule, verdict) for every row of ``pages``.

    Null or scheme-less urls have an empty host and path, fit no rule and are
    allowed.  Null html has no links.  Repeated rows are judged one by one
    and each counts as a page of its host.  Other columns are ignored.  An
    empty table gives an empty result.
    """
    host, path = url_host(F.col("url")), url_path(F.col("url"))
    rule, verdict = longest_rule(F.col("host"), F.col("path"), rules)
    judged = (
        pages.select("page_id", "html", host.alias("host"), path.alias("path"))
        .withColumn("rule", rule)
        .withColumn("by_rule", verdict)
    )
    seeds = judged.filter("by_rule is not null").groupBy("host").agg(
        F.sum((F.col("by_rule") == "allow").cast("double")).alias("trusted"),
        F.sum((F.col("by_rule") == "block").cast("double")).alias("blocked"),
    )
    hosts = staged(host_verdicts(host_edges(judged), seeds, damping, iterations, margin), "host-verdicts")
    # The host table was written, so its size is known to the planner: small
    # ones are broadcast, larger ones are joined by a shuffle with skew splits.
    return judged.join(hosts.select("host", "host_verdict"), "host", "left").select(
        "page_id",
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", "host_verdict", F.lit("allow")).alias("verdict"),
    )

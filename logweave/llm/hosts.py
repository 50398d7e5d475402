"""URL filters by rules and by trust and distrust that spread over links between hosts.

Rules name a host and a path; they fit the host, all its subdomains and all paths that start with
theirs, and the longest rule that fits a page decides. Pages without a rule are judged by their
host: hosts with allowed pages are trusted seeds, hosts with blocked pages blocked seeds, each with
as many units as they have such pages. Trust flows along links (personalised PageRank), distrust
against them (who links to a blocked host is suspect). A host is blocked if its distrust exceeds its
trust and reaches ``threshold`` units per page of it.

Links of a host to itself say nothing and are left out; edges carry the number of links. Rank that
reaches a host without links ends there.

Edge cases: a null url or one without ``://`` has an empty host and path, fits no rule with a host,
and takes part in no edge; null html has no links; urls and html of any length are read whole; equal rows are judged alike; of two longest
rules of equal length a blocking one wins; hosts without seeds in reach are allowed; empty tables
give empty results; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from logweave.llm.common import ascii_lower, broadcast_if_small, stage

DAMPING, THRESHOLD = 0.85, 0.5
#: Units of trust and distrust that one turn may still move, over all hosts, when propagation ends.
TOLERANCE = 1e-6
LINK = r"""(?i)<a\s[^>]*?href\s*=\s*["']?([^"'\s>]+)"""


def host_of(url: Column) -> Column:
    return ascii_lower(F.regexp_extract(F.coalesce(url, F.lit("")), "://([^/?#]*)", 1))


def path_of(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), "://[^/?#]*([^?#]*)", 1)


def rules_frame(spark, rules: list[tuple[str, str]]) -> DataFrame:
    """(verdict, rule) pairs as a table (rule, rule_host, rule_path, verdict)."""
    rows = [(r, r.split("/", 1)[0], r[len(r.split("/", 1)[0]) :], v) for v, r in rules]
    return spark.createDataFrame(rows, "rule string, rule_host string, rule_path string, verdict string")


def rules_of_hosts(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """(host, rules): the rules that fit each host, by an equality join on its suffixes."""
    labels = F.split("host", "\\.")
    suffixes = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = hosts.select("host", F.explode(suffixes).alias("rule_host")).join(rules, "rule_host")
    return fitting.groupBy("host").agg(F.collect_list(F.struct(F.length("rule").alias("n"), (F.col("verdict") == "block").alias("b"), "rule", "rule_path", "verdict")).alias("rules"))


def by_rules(pages: DataFrame, rules: DataFrame, page: str = "page_id", url: str = "url") -> DataFrame:
    """(page, host, path, rule, verdict) with null rule and verdict where no rule fits."""
    parts = pages.select(F.col(page).alias("page"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    fitted = broadcast_if_small(stage(rules_of_hosts(parts.select("host").distinct(), rules), "host-rules"), F.size("rules") * 100)
    best = F.array_max(F.filter(F.coalesce("rules", F.array().cast(fitted.schema["rules"].dataType)), lambda r: F.col("path").startswith(r["rule_path"])))
    return parts.join(fitted, "host", "left").withColumn("best", best).select("page", "host", "path", F.col("best.rule").alias("rule"), F.col("best.verdict").alias("verdict"))


def host_edges(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """(src, dst, links) between different hosts, from absolute and protocol-relative links."""
    found = pages.select(
        host_of(F.col(url)).alias("src"), F.explode(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(LINK), F.lit(1))).alias("href")
    ).where(F.col("href").rlike("^([A-Za-z][A-Za-z0-9+.-]*:)?//"))
    dst = ascii_lower(F.regexp_extract("href", "//([^/?#]*)", 1))
    return found.select("src", dst.alias("dst")).where("src <> '' and dst <> '' and src <> dst").groupBy("src", "dst").agg(F.count("*").alias("links"))


def spread(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE) -> DataFrame:
    """(host, trust, distrust) from seeds (host, allowed, blocked: doubles). Every turn is two joins of
    the edges with the last ranks and one aggregate, and is staged.

    Turns start from the part of the seeds that stays where it is, so ranks only grow and no unfinished
    mass is counted. They go on until one moves at most ``tolerance`` units, summed over all hosts, or
    what doubles can tell apart."""
    out = edges.groupBy("src").agg(F.sum("links").alias("n_out"))
    back = edges.groupBy("dst").agg(F.sum("links").alias("n_in"))
    shares = stage(edges.join(out, "src").join(back, "dst").select("src", "dst", (F.col("links") / F.col("n_out")).alias("ahead"), (F.col("links") / F.col("n_in")).alias("behind")), "edges")
    keep, zero = F.lit(1 - damping), F.lit(0.0)
    start = stage(
        seeds.where("allowed > 0 or blocked > 0").select("host", (keep * F.col("allowed")).alias("trust"), (keep * F.col("blocked")).alias("distrust")), "seeds"
    )
    mass = lambda df: df.agg(F.sum(F.col("trust") + F.col("distrust"))).first()[0] or 0.0
    ranks, total, before = start, mass(start), None
    while before is None or total - before > max(tolerance * (1 - damping), 1e-13 * total):
        ahead = shares.join(ranks.withColumnRenamed("host", "src"), "src").select(F.col("dst").alias("host"), (damping * F.col("trust") * F.col("ahead")).alias("trust"), zero.alias("distrust"))
        behind = shares.join(ranks.withColumnRenamed("host", "dst"), "dst").select(F.col("src").alias("host"), zero.alias("trust"), (damping * F.col("distrust") * F.col("behind")).alias("distrust"))
        flow = ahead.unionAll(behind).unionAll(start)
        ranks = stage(flow.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")), "ranks")
        before, total = total, mass(ranks)
    return ranks.select("host", (F.col("trust") / keep).alias("trust"), (F.col("distrust") / keep).alias("distrust"))


def judge(pages: DataFrame, rules: DataFrame, threshold: float = THRESHOLD, page: str = "page_id", url: str = "url", html: str = "html", tolerance: float = TOLERANCE) -> DataFrame:
    """Per page: page, host, path, rule, verdict, and the finished trust and distrust of its host."""
    ruled = stage(by_rules(pages, rules, page, url), "ruled")
    counted = stage(
        ruled.groupBy("host").agg(
            F.count("*").alias("pages"),
            F.count_if(F.col("verdict") == "allow").cast("double").alias("allowed"),
            F.count_if(F.col("verdict") == "block").cast("double").alias("blocked"),
        ),
        "host-pages",
    )
    ranks = spread(counted.where("host <> ''"), host_edges(pages, url, html), tolerance=tolerance)
    zero = lambda c: F.coalesce(F.col(c), F.lit(0.0)).alias(c)
    judged = counted.join(ranks, "host", "left").select("host", zero("trust"), zero("distrust"), "pages")
    bad = (F.col("distrust") > F.col("trust")) & (F.col("distrust") >= threshold * F.col("pages"))
    hosts = broadcast_if_small(stage(judged.withColumn("by_host", F.when(bad, "block").otherwise("allow")).drop("pages"), "host-verdicts"), F.octet_length("host"))
    return ruled.join(hosts, "host").select(F.col("page").alias(page), "host", "path", "rule", F.coalesce("verdict", "by_host").alias("verdict"), "trust", "distrust")

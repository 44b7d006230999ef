"""URL rules first, then trust and distrust carried over the links between hosts.

Only DataFrame functions: the work stays in the JVM.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from spikelens.llm.common import ascii_lower
from spikelens.sources import stage

# The rules of the registered query, (host, path, verdict).
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))
MOST_RULES = 2000
DAMPING = 0.85
TOLERANCE = 1e-4
LEAST = 1e-9


def host_of(url: Column) -> Column:
    return ascii_lower(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def matching_rule(host: Column, path: Column, rules: Sequence[tuple[str, str, str]]) -> Column:
    """The longest rule that fits, as a struct of rule and verdict; null if none does.

    A rule fits its host and all subdomains when the path starts with its path. Equal lengths: the
    longer path, then the greater text.
    """
    if len(rules) > MOST_RULES:
        raise ValueError("so many rules belong in a table joined by host")
    if not rules:
        return F.lit(None).cast("struct<rule:string,verdict:string>")
    fits = [
        F.when(
            ((host == h) | host.endswith("." + h)) & path.startswith(p),
            F.struct(F.lit(len(h + p)).alias("n"), F.lit(len(p)).alias("m"), F.lit(h + p).alias("rule"), F.lit(v).alias("verdict")),
        )
        for h, p, v in rules
    ]
    best = F.array_max(F.filter(F.array(*fits), lambda r: r.isNotNull()))
    return F.when(best.isNotNull(), F.struct(best["rule"].alias("rule"), best["verdict"].alias("verdict")))


def host_links(pages: DataFrame, url: str = "url", html: str = "html") -> DataFrame:
    """``src, dst, links``: links from one host to another, summed before they are shuffled.

    A link without a host of its own stays on its page's host and is no edge.
    """
    target = F.explode(F.regexp_extract_all(F.coalesce(F.col(html), F.lit("")), F.lit(r"(?i)\bhref\s*=\s*[\"']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^\s\"'<>]+)"), F.lit(1)))
    links = pages.select(host_of(F.col(url)).alias("src"), target.alias("to"))
    links = links.withColumn("dst", host_of(F.regexp_replace("to", r"^//", "http://")))
    return links.filter((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst"))).groupBy("src", "dst").agg(F.count("*").alias("links"))


def propagate(seeds: DataFrame, edges: DataFrame, damping: float = DAMPING, tolerance: float = TOLERANCE, least: float = LEAST / 1000) -> DataFrame:
    """``host, trust, distrust`` from ``host, trusted, blocked`` seed weights.

    Personalised PageRank in units of a seed's weight: trust flows along links from the trusted seeds, in
    shares of a host's links; distrust flows against them from the blocked seeds, in shares of the links that
    a host receives. Seeds are not divided by their number, so hosts without a way to a neighbourhood don't
    change it. What reaches a host without a way on is not returned to the seeds.
    In every round a host hands on what the last one brought it, unless that is at most ``tolerance`` of what
    it has by now, or ``least``, far below what decides a verdict: settled hosts drop out. There is no limit
    of rounds; what is under way shrinks by ``damping`` in each, so all hosts settle. A round is written out,
    so a lost executor costs one.
    """
    base = seeds.select("host", F.col("trusted").cast("double").alias("trusted"), F.col("blocked").cast("double").alias("blocked"))
    start = base.select("host", F.explode(F.array(*(F.struct(F.lit(k).alias("kind"), ((1 - damping) * F.col(c)).alias("had")) for k, c in enumerate(("trusted", "blocked"))))).alias("s"))
    start = start.select("host", "s.kind", "s.had").filter("had > 0")
    ends = [edges.select(F.col(x).alias("src"), F.col(y).alias("dst"), "links", F.lit(k).alias("kind")) for k, (x, y) in enumerate((("src", "dst"), ("dst", "src")))]
    flows = ends[0].union(ends[1])
    all_links = flows.groupBy(F.col("src").alias("_s"), F.col("kind").alias("_k")).agg(F.sum("links").alias("_all"))
    flows = flows.join(all_links, (F.col("src") == F.col("_s")) & (F.col("kind") == F.col("_k")))
    flows = stage(flows.select("src", "dst", F.col("kind").alias("_kind"), (damping * F.col("links") / F.col("_all")).alias("share")), "host-flows")
    now = stage(start.groupBy("host", "kind").agg(F.sum("had").alias("has")).withColumn("came", F.col("has")), "host-trust")
    moving = (F.col("came") > tolerance * F.col("has")) & (F.col("came") > least)
    while not now.filter(moving).isEmpty():
        sent = now.filter(moving).join(flows, (F.col("host") == F.col("src")) & (F.col("kind") == F.col("_kind")))
        sent = sent.select(F.col("dst").alias("host"), "kind", F.lit(0.0).alias("has"), (F.col("came") * F.col("share")).alias("came"))
        # What was too little to hand on waits for more to come.
        kept = now.select("host", "kind", "has", F.when(moving, 0.0).otherwise(F.col("came")).alias("came"), F.lit(1).alias("old"))
        both = kept.union(sent.withColumn("old", F.lit(0))).groupBy("host", "kind")
        new = F.sum(F.when(F.col("old") == 0, F.col("came")).otherwise(0.0))
        now = stage(both.agg((F.sum("has") + new).alias("has"), F.sum("came").alias("came")), "host-trust")
    hosts = base.select("host").union(edges.select("src")).union(edges.select("dst")).distinct()
    has = lambda k: F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("has"))), F.lit(0.0))
    known = now.groupBy("host").agg(has(0).alias("trust"), has(1).alias("distrust"))
    return hosts.join(known, "host", "left").na.fill(0.0, ["trust", "distrust"])


def judge_urls(
    pages: DataFrame, rules: Sequence[tuple[str, str, str]] = RULES, least_distrust: float = LEAST, url: str = "url", html: str = "html", page_id: str = "page_id", **walk
) -> DataFrame:
    """``page_id, host, path, rule, verdict, trust, distrust`` of every page.

    A page that a rule fits has the rule's verdict. Any other page has its host's: ``block`` when the
    host's distrust is at least ``least_distrust`` of a seed's weight and above its trust, else ``allow``.
    Hosts are seeds by the share of their pages that rules allow or block. A null url, or one without ``://``, has an empty
    host and path and is no seed; an empty host is never blocked.
    """
    rule = matching_rule(F.col("host"), F.col("path"), rules)
    ruled = pages.select(F.col(page_id).alias("page_id"), host_of(F.col(url)).alias("host"), path_of(F.col(url)).alias("path"))
    ruled = ruled.withColumn("_rule", rule).select("page_id", "host", "path", F.col("_rule.rule").alias("rule"), F.col("_rule.verdict").alias("_verdict"))
    share = lambda v: F.avg(F.when(F.col("_verdict") == v, 1.0).otherwise(0.0))
    seeds = ruled.filter(F.col("host") != "").groupBy("host").agg(share("allow").alias("trusted"), share("block").alias("blocked"))
    edges = stage(host_links(pages, url, html), "links")
    known = propagate(seeds, edges, **walk)
    judged = ruled.join(known, "host", "left").na.fill(0.0, ["trust", "distrust"])
    own = F.when((F.col("distrust") >= least_distrust) & (F.col("distrust") > F.col("trust")), "block").otherwise("allow")
    return judged.select("page_id", "host", "path", "rule", F.coalesce("_verdict", own).alias("verdict"), "trust", "distrust")

"""URL verdicts by rules and by trust and distrust that flow over host links.

A rule names a host (with all its subdomains) and a path prefix; the longest that fits
decides. Pages without a rule take the verdict of their host, from its links to other
hosts. Trust starts on hosts in proportion to their allowed pages and flows along links
(personalised PageRank); distrust starts from blocked pages and flows against links, to
the hosts that lead there. Both are set against the same flow started from all pages, so a
host's distrust is the blocked share of the pages it leads to, near ones counting more, and
its trust the allowed share of what leads to it. A host is blocked if its distrust reaches
``threshold`` and exceeds its trust. A host without links keeps its mass.

Everything is built-in functions. Links are counted per pair of hosts before anything
else, so the loop runs over host edges only; every few rounds scores are written. It ends when a
round moves less than ``TOLERANCE`` of the mass, and not before, however long chains are.

Edge cases: a url that is null or has no ``://`` has empty host and path, which link to
nothing and are allowed; a null html has no links; links of a host to itself do not count;
rows that repeat count each; an empty table gives no rows. Of the input only ``page_id``,
``url`` and ``html`` are read, so other columns may have any name.
"""

from __future__ import annotations

from itertools import count

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeload.llm.scratch import few, written

# The rules of the contract.
RULES = (("allow", "com", "/"), ("block", "example.com", "/en/"), ("allow", "www.example.com", "/en/"), ("block", "net", "/es/"), ("block", "net", "/fr/"))

DAMPING = 0.85
ROUNDS_WRITTEN = 4
TOLERANCE = 1e-6
THRESHOLD = 0.5

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Hosts of absolute and scheme-relative links.
LINKED = r"""(?i)\b(?:href|src)\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s<>]+)"""


def lower_ascii(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    host = F.regexp_extract(rest, r"^([^/?#]*)", 1)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.coalesce(lower_ascii(host), F.lit("")), F.coalesce(path, F.lit(""))


def rules_by_host(hosts: DataFrame, rules: DataFrame) -> DataFrame:
    """``host, rules``: for each host the rules for it and its parent domains, longest first."""
    labels = F.split("host", r"\.")
    parents = F.transform(F.sequence(F.lit(1), F.size(labels)), lambda i: F.array_join(F.slice(labels, i, F.size(labels)), "."))
    fitting = hosts.select("host", F.explode(parents).alias("rule_host")).join(few(rules), "rule_host")
    size = F.length("rule_host") + F.length("rule_path")
    rule = F.struct((-size).alias("order"), F.concat("rule_host", "rule_path").alias("rule"), "rule_path", "verdict")
    return fitting.groupBy("host").agg(F.array_sort(F.collect_set(rule)).alias("rules"))


def host_edges(pages: DataFrame) -> DataFrame:
    """``src, dst, links`` between different hosts."""
    host, _ = url_parts(F.col("url"))
    targets = F.explode(F.regexp_extract_all("html", F.lit(LINKED), 1))
    found = pages.filter(F.contains("html", F.lit("//"))).select(host.alias("src"), targets.alias("target"))
    links = found.select("src", lower_ascii(F.col("target")).alias("dst")).filter((F.col("src") != F.col("dst")) & (F.col("src") != ""))
    return links.groupBy("src", "dst").agg(F.count("*").alias("links"))


def flowed(start: DataFrame, edges: DataFrame, source: str, target: str, values: list[str]) -> DataFrame:
    """``values`` of the nodes after they flowed along the edges from ``source`` to ``target``, returning to their start by DAMPING."""
    out = edges.groupBy(source).agg(F.sum("links").alias("total"))
    steps = edges.join(out, source).select(F.col(source).alias("from_host"), F.col(target).alias("host"), (F.col("links") / F.col("total")).alias("part"))
    steps = written(steps, "host-steps")
    ends = written(start.join(out.select(F.col(source).alias("host")), "host", "left_anti").select("host", F.lit(True).alias("ends")), "host-ends")
    base = written(start.select("host", *[F.col(v).cast("double").alias(v) for v in values]), "host-start")
    scores = base
    # a round moves at most DAMPING of what the one before moved, so the loop ends
    for round_no in count(1):
        moved = steps.join(scores.withColumnRenamed("host", "from_host"), "from_host").select("host", *[(F.col("part") * F.col(v)).alias(v) for v in values])
        kept = scores.join(ends, "host", "left_semi").select("host", *values)
        inflow = moved.unionByName(kept).groupBy("host").agg(*[F.sum(v).alias(f"in_{v}") for v in values])
        mixed = [((1 - DAMPING) * F.col(v) + DAMPING * F.coalesce(f"in_{v}", F.lit(0.0))).alias(v) for v in values]
        following = base.join(inflow, "host", "left").select("host", *mixed)
        if round_no % ROUNDS_WRITTEN == 0 or round_no == 1:
            following = written(following, "host-scores")
            old = scores.select("host", *[F.col(v).alias(f"old_{v}") for v in values])
            change = sum(F.sum(F.abs(F.col(v) - F.col(f"old_{v}"))) / F.greatest(F.sum(v), F.lit(1e-9)) for v in values)
            done = following.join(old, "host").agg(change).first()[0]
            scores = following
            if done is None or done < TOLERANCE:
                break
        else:
            scores = following
    return scores


def judged_pages(pages: DataFrame, rules: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """``page_id, host, path, rule, verdict`` of each row; and the host's ``trust`` and ``distrust``.

    ``rules`` holds ``verdict, rule_host, rule_path``.
    """
    host, path = url_parts(F.col("url"))
    parsed = pages.select("page_id", host.alias("host"), path.alias("path"))
    hosts = written(parsed.groupBy("host").agg(F.count("*").alias("n_pages")), "hosts")
    by_host = written(hosts.join(rules_by_host(hosts, rules), "host", "left").select("host", "rules"), "host-rules")
    best = F.get(F.filter("rules", lambda r: F.startswith(F.col("path"), r["rule_path"])), F.lit(0))
    ruled = parsed.join(few(by_host), "host", "left").select("page_id", "host", "path", best.alias("best"))

    counts = ruled.groupBy("host").agg(
        F.count("*").alias("pages"), F.count_if(F.col("best.verdict") == "allow").alias("allowed"), F.count_if(F.col("best.verdict") == "block").alias("blocked")
    )
    edges = written(host_edges(pages), "host-edges")
    linked = edges.select(F.explode(F.array("src", "dst")).alias("host")).distinct()
    counted = counts.join(linked, "host", "full_outer")
    start = written(counted.select("host", *[F.coalesce(c, F.lit(0).cast("long")).alias(c) for c in ("pages", "allowed", "blocked")]), "host-seeds")
    along = flowed(start, edges, "src", "dst", ["allowed", "pages"])
    against = flowed(start, edges, "dst", "src", ["blocked", "pages"])
    share = lambda part: F.when(F.col("pages") > 0, F.col(part) / F.col("pages")).otherwise(0.0)
    flows = along.select("host", share("allowed").alias("trust")).join(against.select("host", share("blocked").alias("distrust")), "host")
    flows = written(flows.join(hosts.select("host"), "host", "left_semi"), "host-verdicts")
    is_bad = (F.col("distrust") >= threshold) & (F.col("distrust") > F.col("trust")) & (F.col("host") != "")
    verdict = F.coalesce("best.verdict", F.when(is_bad, "block").otherwise("allow"))
    return ruled.join(few(flows), "host", "left").select("page_id", "host", "path", F.col("best.rule").alias("rule"), verdict.alias("verdict"), "trust", "distrust")

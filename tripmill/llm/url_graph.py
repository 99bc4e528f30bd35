"""URL filter by link-graph propagation.

Explicit rules judge a url first. Where none fits, its host is judged by two walks over the host
graph: PageRank personalised to trusted hosts along the links, and the same from blocked hosts
against them, so that hosts linking to blocked ones are distrusted. Both walks are one table with a
``walk`` column and share every iteration. After ITERATIONS steps the scores of a walk are off by
less than SETTLED of their sum, whatever the graph: each step passes on DAMPING of what is still to be
dealt out. So the number of steps depends on the damping alone; a host further than that from every
seed has no score and is allowed. They end sooner if nothing moves any more. DataFrame functions only.

Defined results: a null url or one without ``://`` has empty host and path, fits no rule and gets
the method's verdict for an unknown host, allow; a null html has no links; repeated pages are judged
row by row, but count once per row as seeds; a host of equal trust and distrust is allowed; an html
of any length is read whole; an empty table gives no rows. Only the columns named in
OUTPUT and the page id are returned, so other columns cannot clash.
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.llm.shared import cut

# Rule text -> verdict.
RULES: tuple[tuple[str, str], ...] = (
    ("net/", "block"),
    ("example.net/en/", "allow"),
    ("example.com/de/", "block"),
    ("org/fr/", "allow"),
)
DAMPING = 0.85
# Share of a walk's scores that may still be dealt out when it ends, and the steps that takes.
SETTLED = 1e-3
ITERATIONS = math.ceil(math.log(SETTLED) / math.log(DAMPING))
CUT_EVERY = 4
# Scores that move by less than this share of themselves stand still but for rounding.
STILL = 1e-12
OUTPUT = ("host", "path", "rule", "verdict", "trust", "distrust")


def lower_ascii(text: Column) -> Column:
    return F.translate(text, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def url_host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(url, r"^(?s:.*?)://([^/?#]*)", 1)), F.lit(""))


def url_path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"^(?s:.*?)://[^/?#]*([^?#]*)", 1), F.lit(""))


def fitting_rule(host: Column, path: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    """Text of the longest rule that fits, or null. ``rules`` is a short configured list."""
    found = F.lit(None).cast("string")
    for text, _ in sorted(rules, key=lambda r: len(r[0])):
        name, slash, rest = text.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.lit(text)).otherwise(found)
    return found


def rule_verdict(rule: Column, rules: Sequence[tuple[str, str]] = RULES) -> Column:
    return reduce(lambda kept, r: F.when(rule == r[0], F.lit(r[1])).otherwise(kept), rules, F.lit(None).cast("string"))


def host_edges(pages: DataFrame, html: str = "html") -> DataFrame:
    """Distinct links between different hosts; relative links stay on their host and drop out."""
    link = r"""(?i)href\s*=\s*["']?\s*(?:https?:)?//([^/?#"'\s>]+)"""
    links = pages.select("host", F.explode(F.regexp_extract_all(F.col(f"`{html}`"), F.lit(link), F.lit(1))).alias("to"))
    links = links.select(F.col("host").alias("src"), lower_ascii(F.col("to")).alias("dst"))
    return links.where("src <> '' and dst <> '' and src <> dst").distinct()


def still(old: DataFrame, new: DataFrame) -> bool:
    """Whether no host was just reached and no score moved but for rounding."""
    before = old.select("walk", "host", F.col("score").alias("before"))
    moved = F.col("before").isNull() | (F.abs(F.col("score") - F.col("before")) > STILL * F.col("score"))
    return new.join(before, ["walk", "host"], "left").where(moved).isEmpty()


def propagate(edges: DataFrame, seeds: DataFrame, iterations: int = ITERATIONS, damping: float = DAMPING) -> DataFrame:
    """(walk, host, score) of personalised PageRank after ``iterations`` steps, or when all stand still.

    ``edges(walk, src, dst)`` are distinct, ``seeds(walk, host, seed)`` sum to 1 per walk. A host
    without out-links gives its score back to the seeds. Contributions are summed before the
    shuffle, so a host many link to costs one row per task.
    """
    out = edges.groupBy("walk", "src").agg(F.count("*").alias("degree"))
    links = cut(edges.join(out, ["walk", "src"]).select("walk", "src", "dst", (1 / F.col("degree")).alias("share")))
    seeds = cut(seeds)
    scores = seeds.select("walk", "host", F.col("seed").alias("score"))
    last = scores
    for step in range(iterations):
        given = (
            links.join(scores.withColumnRenamed("host", "src"), ["walk", "src"])
            .groupBy("walk", F.col("dst").alias("host"))
            .agg(F.sum(F.col("score") * F.col("share")).alias("got"))
        )
        passed = given.groupBy("walk").agg(F.sum("got").alias("passed"))
        base = (
            seeds.join(passed, "walk", "left")
            .select("walk", "host", (F.col("seed") * (1 - damping * F.coalesce("passed", F.lit(0.0)))).alias("part"))
        )
        parts = base.union(given.select("walk", "host", (damping * F.col("got")).alias("part")))
        scores = parts.groupBy("walk", "host").agg(F.sum("part").alias("score"))
        if step % CUT_EVERY == 0 or step + 1 == iterations:
            scores = cut(scores)
            if still(last, scores):  # damping leaves no cycles, so what is the same after some steps stays so
                break
            last = scores
    return scores


def judge_urls(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]] = RULES,
    key: str = "page_id",
    url: str = "url",
    html: str = "html",
) -> DataFrame:
    """Host, path, rule and verdict of every page.

    Trusted seeds are hosts with pages that an allow rule fits; blocked seeds are hosts that a rule
    over the whole host blocks. Both weigh by such pages.
    """
    link = F.col(f"`{url}`")
    rows = pages.select(
        F.col(f"`{key}`").alias("__key"), F.col(f"`{html}`").alias("__html"), url_host(link).alias("host"), url_path(link).alias("path")
    )
    rows = rows.withColumn("rule", fitting_rule(F.col("host"), F.col("path"), rules))
    ruled = rows.withColumn("by_rule", rule_verdict(F.col("rule"), rules))

    counts = cut(
        ruled.where("rule is not null")
        .groupBy("host")
        .agg(
            F.sum(F.when(F.col("by_rule") == "allow", 1).otherwise(0)).alias("trust"),
            F.sum(F.when((F.col("by_rule") == "block") & F.col("rule").endswith("/") & (F.instr("rule", "/") == F.length("rule")), 1).otherwise(0)).alias("distrust"),
        )
    )
    weights = counts.select(
        "host", F.explode(F.create_map(F.lit("trust"), F.col("trust"), F.lit("distrust"), F.col("distrust"))).alias("walk", "weight")
    ).where("weight > 0")
    totals = weights.groupBy("walk").agg(F.sum("weight").alias("total"))
    seeds = weights.join(totals, "walk").select("walk", "host", (F.col("weight") / F.col("total")).alias("seed"))

    edges = cut(host_edges(ruled.withColumnRenamed("__html", html), html))
    walks = edges.select(F.lit("trust").alias("walk"), "src", "dst").union(
        edges.select(F.lit("distrust").alias("walk"), F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    scores = propagate(walks, seeds)
    by_host = scores.groupBy("host").agg(
        F.sum(F.when(F.col("walk") == "trust", F.col("score")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("walk") == "distrust", F.col("score")).otherwise(0.0)).alias("distrust"),
    )
    by_host = by_host.withColumnRenamed("host", "__host")
    # Pages of one host may be a third of all; adaptive execution broadcasts or splits this join.
    judged = ruled.drop("__html").join(by_host, F.col("host") == F.col("__host"), "left")
    trust, distrust = F.coalesce("trust", F.lit(0.0)), F.coalesce("distrust", F.lit(0.0))
    method = F.when(distrust > trust, "block").otherwise("allow")
    return judged.select(
        F.col("__key").alias(key),
        "host",
        "path",
        "rule",
        F.coalesce("by_rule", method).alias("verdict"),
        trust.alias("trust"),
        distrust.alias("distrust"),
    )

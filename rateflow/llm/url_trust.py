"""URL filter: allow and block rules, and trust propagated over host edges for the rest.

Rules are (verdict, host, path prefix); a rule fits its host and all subdomains, and the
longest fitting rule decides. Pages that no rule fits get their host's verdict:

- Host edges are the links from a host's pages to other hosts, weighted by how many there are,
  and one link each way between a host and its parent domain if that is itself a host seen.
- Trust is personalised PageRank along the edges from the hosts whose pages rules allow;
  distrust is the same against the edges from the hosts whose pages rules block (who links to
  bad hosts is distrusted). A seed's mass is the share of its pages with that verdict.
- Ranks are iterated until what is still under way, over all hosts, is below a hundredth of the
  mean host's rank.
- A host is blocked if its distrust is above its trust and above the mean host's rank.

DataFrame functions only. Links are counted per pair of hosts before the shuffle, so a host
with a third of all pages is one row per linked host and task. Ranks are rows, never collected.

Defined cases: a null url or one without ``://`` has empty host and path, fits no rule and is
allowed; null html has no links; repeated rows are judged alike, each adding its links; an
empty table gives an empty result; extra columns are kept unless they bear an output's name.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from rateflow.llm.common import written

DAMPING = 0.85
#: Rank that may still be under way, over all hosts, as a part of the mean host's rank.
REST = 0.01
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
LINK = r"(?i)<a\s[^>]*?href\s*=\s*[\"']?[a-z]*:?//([^/?#\"'\s>]+)"


@dataclass(frozen=True)
class UrlRule:
    verdict: str
    host: str
    path: str

    @property
    def text(self) -> str:
        return self.host + self.path


RULES = [UrlRule("block", "net", "/"), UrlRule("allow", "example.net", "/en/"), UrlRule("block", "example.com", "/de/"), UrlRule("allow", "org", "/fr/")]


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, URL, 2), F.lit(""))


def match(host: Column, path: Column, rules: list[UrlRule], value) -> Column:
    """``value(rule)`` of the longest rule that fits; null if none does."""
    found = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.text)):  # the longest is asked first
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        found = F.when(fits, value(rule)).otherwise(found)
    return found


def host_edges(pages: DataFrame) -> DataFrame:
    """``src``, ``dst``, ``weight``: links between different hosts."""
    linked = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), F.lit(1))).alias("to"))
    linked = linked.select(F.col("host").alias("src"), F.translate("to", UPPER, LOWER).alias("dst"))
    hosts = pages.select("host").distinct()
    parent = hosts.select(F.col("host").alias("child"), F.regexp_extract("host", r"^[^.]+\.(.+)$", 1).alias("host")).join(hosts, "host")
    family = parent.select(F.col("host").alias("src"), F.col("child").alias("dst")).union(parent.select("child", "host"))
    return (
        linked.union(family).filter("src != dst and src != '' and dst != ''")
        .groupBy("src", "dst").agg(F.count(F.lit(1)).alias("weight"))
    )


def propagate(edges: DataFrame, seeds: DataFrame, rounds: int | None = None, damping: float = DAMPING) -> DataFrame:
    """``host``, ``trust`` and ``distrust``, after ``rounds`` or until they settle. ``seeds``: host,
    allowed, blocked (masses)."""
    # both kinds of rank go through one join a round: distrust runs along reversed edges
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").union(
        edges.select(F.lit("distrust"), F.col("dst"), F.col("src"), "weight"))
    out = both.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    both = written(both.join(out, ["kind", "src"]).select(
        "kind", "src", F.col("dst").alias("host"), (F.col("weight") / F.col("out")).alias("part")), "edges")
    total = seeds.agg(F.sum("allowed").alias("a"), F.sum("blocked").alias("b")).collect()[0]  # two numbers
    allowed, blocked = (F.lit(max(x or 0.0, 1e-12)) for x in total)
    start = seeds.select("host", F.inline(F.array(
        F.struct(F.lit("trust").alias("kind"), (F.col("allowed") / allowed).alias("seed")),
        F.struct(F.lit("distrust").alias("kind"), (F.col("blocked") / blocked).alias("seed")))))
    start = written(start.select("kind", "host", "seed"), "seeds")
    rank = start.select("kind", F.col("host").alias("src"), F.col("seed").alias("rank"))
    hosts = both.select("host").union(start.select("host")).distinct().count()
    i = 0
    while rounds is None or i < rounds:
        last = rank
        sent = both.join(rank, ["kind", "src"]).select("kind", "host", (F.col("rank") * F.col("part") * damping).alias("rank"))
        kept = start.select("kind", "host", (F.col("seed") * (1 - damping)).alias("rank"))
        rank = sent.union(kept).groupBy("kind", "host").agg(F.sum("rank").alias("rank")).withColumnRenamed("host", "src")
        i += 1
        if i % 4 == 3:
            rank = written(rank, "rank")
        if i % 4 == 0:
            rank = written(rank, "rank")
            change = rank.union(last.select("kind", "src", -F.col("rank"))).groupBy("kind", "src").agg(F.sum("rank").alias("d"))
            moved = change.groupBy("kind").agg(F.sum(F.abs("d")).alias("d")).agg(F.max("d").alias("d")).collect()[0].d  # one number
            # each later round moves at most ``damping`` of the one before
            if rounds is None and (moved or 0.0) * damping / (1 - damping) <= REST / max(hosts, 1):
                break
    return rank.groupBy(F.col("src").alias("host")).agg(
        F.sum(F.when(F.col("kind") == "trust", F.col("rank")).otherwise(0.0)).alias("trust"),
        F.sum(F.when(F.col("kind") == "distrust", F.col("rank")).otherwise(0.0)).alias("distrust"))


def judge(pages: DataFrame, rules: list[UrlRule] = RULES) -> DataFrame:
    """``pages`` with host, path, ``rule`` (null if none fits), ``verdict`` and the host's
    ``trust`` and ``distrust`` (null for an unknown host)."""
    pages = pages.withColumns({"host": host_of(F.col("url")), "path": path_of(F.col("url"))})
    pages = pages.withColumns({
        "rule": match(F.col("host"), F.col("path"), rules, lambda r: r.text),
        "_ruled": match(F.col("host"), F.col("path"), rules, lambda r: r.verdict)})
    share = lambda verdict: F.avg(F.when(F.col("_ruled") == verdict, 1.0).otherwise(0.0))
    seeds = written(pages.filter("host != ''").groupBy("host").agg(share("allow").alias("allowed"), share("block").alias("blocked")), "hosts")
    ranks = written(propagate(written(host_edges(pages.select("host", "html")), "links"), seeds), "ranks")
    mean = F.lit(1 / max(ranks.count(), 1))
    judged = ranks.select("host", "trust", "distrust", (F.round("distrust", 9) > F.round(F.greatest("trust", mean), 9)).alias("_bad"))
    return (
        pages.drop("trust", "distrust").join(judged, "host", "left")
        .withColumn("verdict", F.coalesce("_ruled", F.when(F.col("_bad"), "block").otherwise("allow")))
        .drop("_ruled", "_bad")
    )

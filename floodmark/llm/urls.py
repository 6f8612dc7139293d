"""URL verdicts: host and path rules, and trust and distrust spread over the graph of hosts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from floodmark.llm.scratch import Scratch
from floodmark.llm.text import LOWER, UPPER, column

RULES = [("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/")]
#: Share of rank that moves on along links, and rounds.
DAMPING, ROUNDS = 0.85, 8
#: A host is blocked if its distrust is at least this many times the mean of all hosts, and so many times its trust.
LEAST_DISTRUST, OVER_TRUST = 1.0, 2.0
_URL = r"(?s)^.*?://([^/?#]*)([^?#]*)"
_LINK = r"""(?i)\b(?:href|src)\s*=\s*["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s<>]+)"""


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, _URL, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, _URL, 2), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[tuple[str, str]]) -> Column:
    """struct<rule, verdict> of the longest rule that fits, the first of equal length; null if none does."""
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    ordered = sorted(rules, key=lambda r: -len(r[1]))
    for verdict, rule in reversed(ordered):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith("." + name)) & path.startswith(slash + rest)
        found = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def host_edges(pages: DataFrame, host: str, html: str) -> DataFrame:
    """(src, dst, weight): links from a host's pages to another host, and one from each host to its parent domain.

    Links are addresses with a host in href and src attributes. A parent has one label less, two at least; a host that
    is only linked to, or is only a parent, is a node as any other.
    """
    linked = pages.filter(F.col(host) != "").select(F.col(host).alias("src"), F.explode(F.regexp_extract_all(html, F.lit(_LINK), 1)).alias("dst"))
    links = linked.select("src", F.translate("dst", UPPER, LOWER).alias("dst")).filter("src <> dst and dst <> ''").groupBy("src", "dst").agg(
        F.count(F.lit(1)).cast("double").alias("weight"))
    names = links.select(F.col("src").alias("h")).unionByName(links.select(F.col("dst").alias("h"))).unionByName(
        pages.filter(F.col(host) != "").select(F.col(host).alias("h"))).distinct()
    parents = names.filter(F.size(F.split("h", r"\.")) > 2).select(
        F.col("h").alias("src"), F.regexp_replace("h", r"^[^.]*\.", "").alias("dst"), F.lit(1.0).alias("weight"))
    return links.unionByName(parents).groupBy("src", "dst").agg(F.sum("weight").alias("weight"))


def spread(edges: DataFrame, seeds: DataFrame, scratch: Scratch, rounds: int = ROUNDS) -> DataFrame:
    """(kind, host, rank) of personalised page rank; edges (kind, src, dst, weight), seeds (kind, host, share).

    Both kinds run together; the shares of each sum to one. A host without links passes nothing on, so the ranks of a kind
    sum to less than one; divided by their sum they are what they would be with that rank returned to the seeds. Each
    round is written, so a lost executor costs one round.
    """
    out = edges.groupBy("kind", "src").agg(F.sum("weight").alias("out"))
    steps = scratch.keep(edges.join(out, ["kind", "src"]).select("kind", F.col("src").alias("host"), "dst", (F.col("weight") / F.col("out")).alias("part")))
    rank = seeds.select("kind", "host", F.col("share").alias("rank"))
    start = seeds.select("kind", "host", ((1 - DAMPING) * F.col("share")).alias("rank"))
    for _ in range(rounds):
        moved = steps.join(rank, ["kind", "host"]).select("kind", F.col("dst").alias("host"), (DAMPING * F.col("part") * F.col("rank")).alias("rank"))
        rank = scratch.keep(moved.unionByName(start).groupBy("kind", "host").agg(F.sum("rank").alias("rank")))
    return rank


def judge_urls(
    pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html",
    rules: list[tuple[str, str]] = RULES, least: float = LEAST_DISTRUST, over: float = OVER_TRUST,
) -> DataFrame:
    """One row per row of `pages`: id, host, path, rule, verdict, trust, distrust.

    A page's rule is the longest that fits host and path and gives its verdict. Other pages get their host's: trust spreads
    along links from hosts by their share of allowed pages, distrust against links from hosts by their share of blocked
    pages. A host is blocked if its distrust, in means of all hosts, is >= `least` and > `over` times its trust in
    means of all hosts. The columns trust and distrust are ranks times the number of hosts, before that division: their
    mean over all hosts is below 1 where hosts without links lose rank.
    Null addresses and those without `://` have empty host and path and are allowed. Null html has no links. Null ids and
    repeated rows are rows; other columns are ignored; an empty table gives none. Pages move only as host sums.
    """
    scratch = Scratch(pages.sparkSession)
    url = column(url_col)
    narrow = pages.select(column(id_col).alias("_id"), host_of(url).alias("host"), path_of(url).alias("path"), column(html_col).alias("_html"))
    edges = scratch.keep(host_edges(narrow, "host", "_html"))
    judged = narrow.drop("_html").withColumn("_r", rule_of(F.col("host"), F.col("path"), rules))
    share = lambda verdict: F.avg(F.coalesce(F.col("_r.verdict") == verdict, F.lit(False)).cast("double"))
    own = judged.filter("host <> ''").groupBy("host").agg(share("allow").alias("trust"), share("block").alias("distrust"))
    own = scratch.keep(own)
    raw = own.select(F.expr("stack(2, 'trust', host, trust, 'distrust', host, distrust) as (kind, host, w)")).filter("w > 0")
    sums = raw.groupBy("kind").agg(F.sum("w").alias("total"))
    # One row per kind beside the seeds: two rows at most.
    seeds = scratch.keep(raw.join(F.broadcast(sums), "kind").select("kind", "host", (F.col("w") / F.col("total")).alias("share")))
    both = edges.select(F.lit("trust").alias("kind"), "src", "dst", "weight").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"), "weight"))
    ranks = spread(both, seeds, scratch)
    nodes = own.select("host").unionByName(edges.select(F.col("src").alias("host"))).unionByName(edges.select(F.col("dst").alias("host"))).distinct().count()
    of = lambda kind: F.coalesce(F.sum(F.when(F.col("kind") == kind, F.col("rank"))), F.lit(0.0)) * nodes
    scores = ranks.groupBy("host").agg(of("trust").alias("trust"), of("distrust").alias("distrust"))
    # Two rows: the real sum of each kind's ranks, so that the mean of all hosts is 1. Rounded, as sums depend on order.
    totals = {r["kind"]: r["total"] for r in ranks.groupBy("kind").agg(F.sum("rank").alias("total")).collect()}
    means = lambda kind: F.round(F.col(kind) / (totals.get(kind) or 1.0), 9)
    bad = (means("distrust") >= least) & (means("distrust") > over * means("trust"))
    method = F.when(F.coalesce(bad, F.lit(False)), "block").otherwise("allow")
    return judged.join(scores, "host", "left").select(
        F.col("_id").alias(id_col), "host", "path", F.col("_r.rule").alias("rule"),
        F.coalesce(F.col("_r.verdict"), method).alias("verdict"),
        F.coalesce("trust", F.lit(0.0)).alias("trust"), F.coalesce("distrust", F.lit(0.0)).alias("distrust"),
    )

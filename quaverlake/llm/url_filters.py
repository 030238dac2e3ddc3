"""URL filters: rules first, then trust and distrust that spread over links between hosts.

Trust starts at hosts most of whose rule-judged pages are allowed and follows links;
distrust starts at hosts most of whose are blocked and runs against them (who links
to bad hosts is suspect). Both are personalised PageRanks by power iteration over
weighted host edges. A page no rule fits is judged by its host: blocked where
distrust less trust exceeds ``threshold`` times the mean over the hosts that the
graph or a rule knows. DataFrame and SQL functions only.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaverlake.llm.common import cut

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
#: absolute or scheme-relative targets of anchors
LINK = r"""(?is)<a\s(?:[^>]*?\s)?href\s*=\s*["']?\s*(?:[a-z][a-z0-9+.-]*:)?//([^/?#"'\s>]+)"""


@dataclass(frozen=True)
class Rule:
    host: str
    path: str
    verdict: str

    @property
    def text(self) -> str:
        return self.host + self.path


def host_of(url: Column) -> Column:
    return F.translate(F.coalesce(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), F.lit("")), _UPPER, _UPPER.lower())


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: list[Rule]) -> Column:
    """The longest rule that fits, as struct(text, verdict); of equal rules the blocking one."""
    chosen = F.lit(None).cast("struct<text:string,verdict:string>")
    for rule in sorted(rules, key=lambda r: (len(r.text), r.verdict == "block", r.text)):
        fits = ((host == rule.host) | host.endswith("." + rule.host)) & path.startswith(rule.path)
        chosen = F.when(fits, F.struct(F.lit(rule.text).alias("text"), F.lit(rule.verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def _spread(edges: DataFrame, seeds: DataFrame, source: str, target: str, damping: float, rounds: int, tolerance: float) -> DataFrame:
    """(host, score): personalised PageRank from ``seeds`` along source -> target.

    What hosts without outgoing links hold is not passed on. Rounds go on until scores
    move by less than ``tolerance`` in all; not to settle within ``rounds`` is an error.
    """
    total = seeds.agg(F.sum("weight").alias("w")).first()["w"]
    start = seeds.select("host", (F.col("weight") / F.lit(total)).alias("score"))
    if not total or edges.isEmpty():
        return start
    out = edges.groupBy(source).agg(F.sum("n").alias("total"))
    links = cut(edges.join(out, source).select(F.col(source).alias("host"), F.col(target).alias("to"), (F.col("n") / F.col("total")).alias("share")))
    base = cut(start)
    scores = base
    for _ in range(rounds):
        flow = links.join(scores, "host").groupBy(F.col("to").alias("host")).agg(F.sum(F.col("score") * F.col("share") * damping).alias("score"))
        after = cut(base.select("host", (F.col("score") * (1 - damping)).alias("score")).unionByName(flow).groupBy("host").agg(F.sum("score").alias("score")))
        moved = after.alias("a").join(scores.alias("b"), "host", "full").agg(F.sum(F.abs(F.coalesce("a.score", F.lit(0.0)) - F.coalesce("b.score", F.lit(0.0)))).alias("d")).first()["d"]
        scores = after
        if moved < tolerance:
            return scores
    raise RuntimeError(f"scores still moved by {moved} after {rounds} rounds")


def host_edges(pages: DataFrame, url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(src, dst, n): links from pages of one host to another host."""
    found = pages.select(host_of(F.col(url_col)).alias("src"), F.explode(F.regexp_extract_all(F.col(html_col), F.lit(LINK), F.lit(1))).alias("dst"))
    found = found.select("src", F.translate("dst", _UPPER, _UPPER.lower()).alias("dst"))
    return found.where("src <> '' and dst <> src").groupBy("src", "dst").agg(F.count(F.lit(1)).alias("n"))


def judge_urls(pages: DataFrame, rules: list[Rule], id_col: str = "page_id", url_col: str = "url", html_col: str = "html", damping: float = 0.85, rounds: int = 500, tolerance: float = 1e-6, threshold: float = 0.5) -> DataFrame:
    """(id, host, path, rule, verdict, trust, distrust), one row per page.

    A null url, or one without ``://``, has an empty host and path, fits no rule and is
    allowed (nothing speaks against it); a null html has no links; rows that repeat
    are judged each; urls and pages may be of any length; of rules of equal length the
    blocking one wins; other columns are ignored; no pages give no rows.
    """
    judged = pages.select(F.col(id_col).alias("id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path")).withColumn("fit", rule_of(F.col("host"), F.col("path"), rules))
    side = F.when(F.col("fit.verdict") == "allow", 1.0).otherwise(-1.0)
    seeds = cut(judged.where("fit is not null and host <> ''").groupBy("host").agg(F.avg(side).alias("net")))
    edges = cut(host_edges(pages, url_col, html_col))
    trust = _spread(edges, seeds.where("net > 0").select("host", F.col("net").alias("weight")), "src", "dst", damping, rounds, tolerance)
    distrust = _spread(edges, seeds.where("net < 0").select("host", (-F.col("net")).alias("weight")), "dst", "src", damping, rounds, tolerance)
    scores = trust.select("host", F.col("score").alias("trust"), F.lit(0.0).alias("distrust")).unionByName(distrust.select("host", F.lit(0.0).alias("trust"), F.col("score").alias("distrust")))
    scores = cut(scores.groupBy("host").agg(F.sum("trust").alias("trust"), F.sum("distrust").alias("distrust")))
    mean = 1.0 / max(1, scores.count())
    held = judged.join(scores, "host", "left").withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("trust", "distrust")})
    by_graph = F.when(F.col("distrust") - F.col("trust") > threshold * mean, "block").otherwise("allow")
    return held.select("id", "host", "path", F.col("fit.text").alias("rule"), F.coalesce("fit.verdict", by_graph).alias("verdict"), "trust", "distrust")

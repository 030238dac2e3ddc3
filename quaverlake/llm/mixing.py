"""Mixing sources to target weights by temperature.

Source token shares p are raised to an exponent t and normalised; t is found by
bisection (many points a round, in one aggregation over the sources) as the largest
that reaches the target entropy, but not below the smallest that keeps every source
within the repetition limit. A source's quota is its weight times the token budget,
realised as block permutations: whole passes over the source, each in a hash order of
its own, and a last pass cut at the budget. DataFrame and SQL functions only.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaverlake.llm.common import cut, stored

WORD = r"[^\x20\x09-\x0D]+"


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


@dataclass(frozen=True)
class Mixture:
    exponent: float
    budget: float
    sources: DataFrame  # source, tokens, weight, quota


def _at(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float, float]]:
    """(sum of p^t, sum of p^t log p, largest p^(t-1)) for each t, in one aggregation."""
    grid = shares.select("p", F.explode(F.lit(exponents)).alias("t"))
    power = F.pow("p", F.col("t"))
    rows = grid.groupBy("t").agg(F.sum(power).alias("z"), F.sum(power * F.log("p")).alias("l"), F.max(F.pow("p", F.col("t") - 1)).alias("r")).collect()
    found = {r["t"]: (r["z"], r["l"], r["r"]) for r in rows}
    return [found[t] for t in exponents]


def _bisect(shares: DataFrame, target: float, budget_ratio: float, repetition: float, points: int = 32, rounds: int = 5) -> tuple[float, float]:
    """(largest exponent with the target entropy, smallest within the repetition limit), both in [0, 1].

    Every round cuts the interval into ``points`` parts.
    """

    def narrow(kind: str) -> float:
        low, high = 0.0, 1.0
        for _ in range(rounds):
            at = sorted({low + (high - low) * i / points for i in range(points + 1)})
            values = _at(shares, at)
            if kind == "entropy":  # falls as the exponent rises
                fits = [_log(z) - t * w / z >= target for t, (z, w, _) in zip(at, values, strict=True)]
                last = max((i for i, f in enumerate(fits) if f), default=0)
                low, high = at[last], at[min(last + 1, len(at) - 1)]
            else:  # the most repeated source's passes fall as the exponent rises
                fits = [r / z * budget_ratio <= repetition for z, _, r in values]
                first = min((i for i, f in enumerate(fits) if f), default=len(at) - 1)
                low, high = at[max(first - 1, 0)], at[first]
            if low == high:
                break
        return low if kind == "entropy" else high

    return narrow("entropy"), narrow("repetition")


def _log(x: float) -> float:
    return math.log(x)


def mixture(totals: DataFrame, target_entropy: float, max_repetition: float, budget: float | None, cover: bool) -> Mixture:
    """Weights for ``totals`` (source, tokens). ``target_entropy`` is a share of the largest possible."""
    totals = cut(totals.where("tokens > 0"))
    facts = totals.agg(F.sum("tokens").alias("t"), F.count(F.lit(1)).alias("n")).first()
    if not facts["n"]:
        return Mixture(1.0, 0.0, totals.withColumns({"weight": F.lit(0.0), "quota": F.lit(0.0)}))
    total = float(facts["t"])
    shares = cut(totals.withColumn("p", F.col("tokens") / F.lit(total)))
    size = total if budget is None else float(budget)
    if size > max_repetition * total * (1 + 1e-9):
        raise ValueError(f"a budget of {size:g} tokens repeats {total:g} more than {max_repetition:g} times whatever the weights")
    by_entropy, by_repetition = _bisect(shares, target_entropy * _log(facts["n"]), size / total, max_repetition)
    exponent = max(by_entropy, by_repetition)
    if cover:  # the largest budget's least repeated source sees one whole pass
        ends = shares.agg(F.max(F.pow("p", F.lit(exponent - 1))).alias("most"), F.min(F.pow("p", F.lit(exponent - 1))).alias("least"), F.sum(F.pow("p", F.lit(exponent))).alias("z"))
        while True:
            row = ends.first()
            if row["most"] / row["least"] <= max_repetition * (1 + 1e-12) or exponent >= 1.0:
                break
            # proportional weights, at which every source is seen alike, are the end
            exponent = 1.0 - (1.0 - exponent) * 0.9 if exponent < 0.999 else 1.0
            ends = shares.agg(F.max(F.pow("p", F.lit(exponent - 1))).alias("most"), F.min(F.pow("p", F.lit(exponent - 1))).alias("least"), F.sum(F.pow("p", F.lit(exponent))).alias("z"))
        size = total * row["z"] / row["least"]
    z = shares.agg(F.sum(F.pow("p", F.lit(exponent))).alias("z")).first()["z"]
    weighted = shares.withColumn("weight", F.pow("p", F.lit(exponent)) / F.lit(z))
    return Mixture(exponent, size, cut(weighted.select("source", "tokens", "weight", (F.col("weight") * F.lit(size)).alias("quota"))))


def mix_sources(docs: DataFrame, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text", target_entropy: float = 0.9, max_repetition: float = 4.0, budget: float | None = None, cover: bool = False, seed: int = 17, bucket_rows: int = 5_000) -> DataFrame:
    """``docs`` as drawn: with block (pass, from 0), tokens, weight and draw_key added.

    ``budget`` is in tokens (words), by default all of the input's; with ``cover`` it is
    the least that gives every source one whole pass, the exponent then rising to what
    the repetition limit allows. A document of the last pass is drawn if fewer tokens
    than remain stand before it in that pass's order, so quotas are met within a
    document. Documents without a word (null or empty texts) carry no tokens and are
    drawn once, in block 0. A null source is a source of its own; rows that repeat
    are drawn each; null ids are allowed; texts may be of any length; ties of the draw
    order go by id, then text; a budget that no weights can meet within ``max_repetition``
    is an error; columns of added names are replaced; no
    rows give no rows. ``draw_key`` orders a block.
    """
    docs = docs.drop("block", "tokens", "weight", "draw_key")
    counted = docs.withColumn("tokens", word_count(F.col(f"`{text_col}`"))).withColumn("__source", F.to_json(F.struct(F.col(f"`{source_col}`").alias("s"))))
    totals = counted.groupBy(F.col("__source").alias("source")).agg(F.sum("tokens").alias("tokens"), F.count(F.lit(1)).alias("rows"))
    totals = cut(totals)
    plan = mixture(totals.select("source", "tokens"), target_entropy, max_repetition, budget, cover)
    # whole passes, what the last pass holds, and into how many buckets its order is cut
    passes = plan.sources.join(totals.select("source", "rows"), "source").select(
        F.col("source").alias("__source"), "weight", F.floor(F.col("quota") / F.col("tokens")).cast("int").alias("whole"), F.expr("quota - floor(quota / tokens) * tokens").alias("rest"), F.ceil(F.col("rows") / bucket_rows).cast("long").alias("buckets")
    )
    passes = stored(passes)
    last = F.xxhash64(F.lit(seed), F.col("whole"), F.col(f"`{id_col}`"), text_col)
    bucket = F.least(F.floor((last / F.lit(2.0**64) + 0.5) * F.col("buckets")).cast("long"), F.col("buckets") - 1)
    sums = counted.where("tokens > 0").join(passes, "__source").groupBy("__source", bucket.alias("__bucket")).agg(F.sum("tokens").alias("n"))
    order = Window.partitionBy("__source").orderBy("__bucket")
    ahead = sums.withColumn("__ahead", F.sum("n").over(order) - F.col("n")).join(passes, "__source")
    # the bucket that the cut falls into; only its rows need an order among themselves
    cutoff = ahead.where("__ahead + n > rest").groupBy("__source").agg(F.min("__bucket").alias("__cut"), F.min_by(F.col("rest") - F.col("__ahead"), "__bucket").alias("__left"))
    # stored, so that Spark knows its size: a small table of sources is sent to the documents, a large one shuffled
    plan_rows = stored(passes.join(cutoff, "__source", "left"))
    marked = counted.join(plan_rows, "__source", "left").withColumns({"__last": last, "__bucket": bucket})
    at_cut = F.coalesce((F.col("tokens") > 0) & (F.col("__bucket") == F.col("__cut")), F.lit(False))
    within = Window.partitionBy("__source").orderBy("__last", F.col(f"`{id_col}`"), F.col(f"`{text_col}`")).rowsBetween(Window.unboundedPreceding, -1)
    cutting = marked.where(at_cut).withColumn("__part", F.coalesce(F.sum("tokens").over(within), F.lit(0)) < F.col("__left"))
    sure = marked.where(~at_cut).withColumn("__part", F.coalesce(F.col("__bucket") < F.col("__cut"), F.lit(False)))
    drawn = sure.unionByName(cutting)
    n_blocks = F.when(F.col("tokens") == 0, 1).otherwise(F.col("whole") + F.col("__part").cast("int"))
    drawn = drawn.where(n_blocks > 0).withColumn("block", F.explode(F.sequence(F.lit(0), n_blocks - 1)))
    key = F.xxhash64(F.lit(seed), F.col("block"), F.col(f"`{id_col}`"), text_col)
    return drawn.withColumn("draw_key", key).select(*(F.col(f"`{c}`") for c in docs.columns), "block", "tokens", F.coalesce("weight", F.lit(0.0)).alias("weight"), "draw_key")

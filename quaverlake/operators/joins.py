"""Joins (J1-J21) and set operations (U1-U4) over keyed tables."""

from __future__ import annotations

from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaverlake.functions.paths import proper_prefixes

Keys = list[str]


def require_empty(df: DataFrame, what: str, key: str, shown: int = 10) -> None:
    """Raise with the first keys of ``df`` unless it is empty (a bounded look on the driver)."""
    found = [str(r[0]) for r in df.select(key).orderBy(key).limit(shown).collect()]
    if found:
        raise ValueError(f"{what}: {', '.join(found)}")


def coverage_gaps(expected: DataFrame, values: DataFrame, key: str) -> DataFrame:
    """(key, side): missing keys and extra ones; empty when the key sets are equal."""
    missing = expected.select(key).distinct().join(values.select(key), key, "left_anti").withColumn("side", F.lit("missing"))
    extra = values.select(key).distinct().join(expected.select(key), key, "left_anti").withColumn("side", F.lit("extra"))
    return missing.unionByName(extra)


def covered_join(left: DataFrame, right: DataFrame, key: str, stage: str) -> DataFrame:
    """1:1 join of tables whose key sets must be equal."""
    require_empty(coverage_gaps(left, right, key), f"{stage} does not cover the same keys", key)
    return left.join(right, key)


def split_active(base: DataFrame, stages: list[tuple[str, DataFrame]], key: str) -> DataFrame:
    """``base`` with failure_stage and failure: the first stage, in order, whose ``error`` is not null.

    Each stage table is (key, error) with one row per key; a key without a row failed.
    """
    out = base
    for name, table in stages:
        rows = table.select(key, F.col("error").alias(f"__{name}"), F.lit(True).alias(f"__has_{name}"))
        out = out.join(rows, key, "left").withColumn(f"__{name}", F.when(F.col(f"__has_{name}").isNull(), "missing").otherwise(F.col(f"__{name}"))).drop(f"__has_{name}")
    failure = F.coalesce(*(F.when(F.col(f"__{n}").isNotNull(), F.struct(F.lit(n).alias("stage"), F.col(f"__{n}").alias("error"))) for n, _ in stages))
    out = out.withColumn("__failure", failure)
    return out.withColumns({"failure_stage": F.col("__failure.stage"), "failure": F.col("__failure.error")}).drop("__failure", *(f"__{n}" for n, _ in stages))


def keep_listed(rows: DataFrame, manifest: DataFrame, key: str, order: str) -> DataFrame:
    """Rows of the listed keys, with the manifest's order; a listed key without a row is an error."""
    require_empty(manifest.join(rows, key, "left_anti"), "keys without a row", key)
    return rows.join(manifest.select(key, order), key)


def pending(inputs: DataFrame, cache: DataFrame, keys: Keys) -> DataFrame:
    """Inputs without a reusable result for the same id and fingerprint."""
    return inputs.join(cache.select(*keys), keys, "left_anti")


def foreign(outputs: DataFrame, inputs: DataFrame, key: str) -> DataFrame:
    """Outputs of keys that the inputs lack (fatal when there are any)."""
    return outputs.join(inputs.select(key), key, "left_anti")


def changed_inputs(inputs: DataFrame, done: DataFrame, key: str, fingerprint: str) -> DataFrame:
    """Finished keys whose input is no longer the same."""
    old = done.select(key, F.col(fingerprint).alias("__old"))
    return inputs.join(old, key).where(~F.col(fingerprint).eqNullSafe(F.col("__old"))).drop("__old")


def overlay(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Left rows with the right side's columns; where both have one, the right wins if it is not null."""
    r = right.select(F.col(key), *(F.col(c).alias(f"__r_{c}") for c in right.columns if c != key))
    joined = left.join(r, key, "left")
    shared = {c: F.coalesce(f"__r_{c}", c) for c in left.columns if c != key and c in right.columns}
    new = {c: F.col(f"__r_{c}") for c in right.columns if c not in left.columns}
    return joined.withColumns(shared | new).drop(*(f"__r_{c}" for c in right.columns if c != key))


def _stack(tables: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), (t.withColumn("__source", F.lit(i)) for i, t in enumerate(tables)))


def merge_first(tables: list[DataFrame], key: str) -> DataFrame:
    """One row per key, the first table's non-null value wins; conflicts counts values that differ from it.

    Rows with a blank key are left out. ``""`` is a value.
    """
    rows = _stack(tables).where(F.coalesce(F.trim(F.col(key).cast("string")), F.lit("")) != "")
    fields = [c for c in rows.columns if c not in (key, "__source")]
    first = {c: F.min_by(c, F.when(F.col(c).isNotNull(), F.col("__source"))) for c in fields}
    won = rows.groupBy(key).agg(*(first[c].alias(c) for c in fields))
    differs = rows.join(won.select(key, *(F.col(c).alias(f"__{c}") for c in fields)), key)
    each = [F.when(F.col(c).isNotNull() & (F.col(c) != F.col(f"__{c}")), 1).otherwise(0) for c in fields]
    conflicts = differs.groupBy(key).agg(F.sum(reduce(lambda a, b: a + b, each, F.lit(0))).alias("conflicts"))
    return won.join(conflicts, key)


def overlay_last(tables: list[DataFrame], key: str, maps: Keys = ()) -> DataFrame:
    """One row per key, the last table's non-null value wins; map columns merge entry by entry."""
    rows = _stack(tables)
    fields = [c for c in rows.columns if c not in (key, "__source")]
    at = F.col("__source")

    def value(c: str) -> Column:
        if c not in maps:
            return F.max_by(c, F.when(F.col(c).isNotNull(), at))
        held = F.array_sort(F.collect_list(F.when(F.col(c).isNotNull(), F.struct(at.alias("at"), F.map_entries(c).alias("e")))))
        kind = rows.schema[c].dataType.simpleString()
        return F.aggregate(held, F.create_map().cast(kind), lambda m, x: F.map_concat(m, F.map_from_entries(x["e"])))

    return rows.groupBy(key).agg(*(value(c).alias(c) for c in fields))


def merged_versions(model: Column, stage: Column, stage_wins: bool = True) -> Column:
    """Version maps of a record; batch runs let stage versions win, streaming ones model versions."""
    empty = F.create_map().cast("map<string,string>")
    a, b = F.coalesce(model, empty), F.coalesce(stage, empty)
    return F.map_concat(a, b) if stage_wins else F.map_concat(b, a)


def join_sections(left: DataFrame, right: DataFrame, key: str, tolerance: float = 0.001) -> DataFrame:
    """Child join on (key, section_id): all ids on both sides, bounds within ``tolerance``.

    ``problem`` is null for matching children; values of the right side do not touch ids and bounds.
    """
    r = right.select(key, "section_id", F.col("start").alias("__start"), F.col("end").alias("__end"), *(c for c in right.columns if c not in left.columns))
    both = left.withColumn("__left", F.lit(True)).join(r, [key, "section_id"], "full")
    apart = (F.abs(F.col("start") - F.col("__start")) > tolerance) | (F.abs(F.col("end") - F.col("__end")) > tolerance)
    problem = F.when(F.col("__left").isNull(), "extra").when(F.col("__start").isNull(), "missing").when(apart, "bounds differ")
    return both.withColumn("problem", problem).drop("__left", "__start", "__end")


def nearest(left: DataFrame, right: DataFrame, keys: Keys, at: str, point: str, tolerance: float, unique: Keys, name: str = "nearest") -> DataFrame:
    """As-of join both ways: the nearest point within ``tolerance`` (inclusive); of equally near ones the earlier.

    Times are cut into buckets of the tolerance, so only neighbours meet, whatever
    the length of a series. Rows without a match keep null; ``unique`` names a row.
    """
    if tolerance <= 0:
        raise ValueError("tolerance must be positive")
    bucket = lambda c: F.floor(F.col(c) / tolerance)
    spread = left.withColumn("__bucket", F.explode(F.array(*(bucket(at) + d for d in (-1, 0, 1)))))
    points = right.select(*keys, F.col(point).alias("__point"), bucket(point).alias("__bucket")).distinct()
    pairs = spread.join(points, [*keys, "__bucket"]).where(F.abs(F.col("__point") - F.col(at)) <= tolerance)
    best = pairs.groupBy(*keys, *(u for u in unique if u not in keys)).agg(F.min_by("__point", F.struct(F.abs(F.col("__point") - F.col(at)), F.col("__point"))).alias(name))
    return left.join(best, list(dict.fromkeys([*keys, *unique])), "left")


def snapped(value: Column, near: Column) -> Column:
    return F.coalesce(near, value)


def overlap_argmax(intervals: DataFrame, sources: DataFrame, keys: Keys, unique: Keys, width: float) -> DataFrame:
    """Each interval's source: those that hold its midpoint, else all of its key; largest overlap, then earliest.

    ``intervals``: start, end; ``sources``: raw_start, raw_end and more. Keys without sources give none.
    Time is cut into buckets of ``width`` (about the length of an interval), so only
    neighbours meet; a key's earliest source stands by for intervals that meet none.
    """
    if width <= 0:
        raise ValueError("width must be positive")
    own = [c for c in sources.columns if c not in keys]
    cells = lambda a, b: F.explode(F.sequence(F.floor(F.col(a) / width), F.greatest(F.floor(F.col(a) / width), F.floor(F.col(b) / width))))
    held = sources.select(*keys, *(F.col(c).alias(f"__{c}") for c in own))
    near = intervals.withColumn("__cell", cells("start", "end")).join(held.withColumn("__cell", cells("__raw_start", "__raw_end")), [*keys, "__cell"]).drop("__cell")
    whole = F.struct(*(F.col(f"__{c}") for c in own))
    earliest = held.groupBy(*keys).agg(F.min_by(whole, F.struct("__raw_start", "__raw_end")).alias("__first")).select(*keys, "__first.*")
    pairs = near.unionByName(intervals.join(earliest, keys))
    middle = (F.col("start") + F.col("end")) / 2
    holds = ((F.col("__raw_start") <= middle) & (middle < F.col("__raw_end"))).cast("int")
    shared = F.greatest(F.lit(0.0), F.least("end", "__raw_end") - F.greatest("start", "__raw_start"))
    best = F.struct(-holds, -shared, F.col("__raw_start"), F.col("__raw_end"))
    found = pairs.groupBy(*keys, *(u for u in unique if u not in keys)).agg(F.min_by(F.struct(*(F.col(f"__{c}").alias(c) for c in own)), best).alias("__s"), F.max(shared).alias("__o"))
    return intervals.join(found, list(dict.fromkeys([*keys, *unique])), "left").select("*", *(F.col(f"__s.{c}").alias(c if c not in intervals.columns else f"source_{c}") for c in own)).drop("__s", "__o")


def frame_slice(probabilities: Column | str, start: Column | str, end: Column | str, hop: Column | float) -> Column:
    """Frames floor(start / hop) up to ceil(end / hop) of a series."""
    p = F.col(probabilities) if isinstance(probabilities, str) else probabilities
    step = F.lit(hop) if isinstance(hop, float) else hop
    low = F.greatest(F.lit(0), F.floor((F.col(start) if isinstance(start, str) else start) / step)).cast("int")
    high = F.least(F.size(p), F.ceil((F.col(end) if isinstance(end, str) else end) / step)).cast("int")
    return F.when(high > low, F.slice(p, low + 1, high - low)).otherwise(F.slice(p, 1, 0))


def frames_in_sections(frames: DataFrame, sections: DataFrame, keys: Keys, index: str, hop: float) -> DataFrame:
    """Long form of ``frame_slice``: one row per section and frame; sections explode to their frames, then equi-join."""
    low, high = F.floor(F.col("start") / hop).cast("long"), F.ceil(F.col("end") / hop).cast("long")
    wanted = sections.where(high > low).withColumn(index, F.explode(F.sequence(low, high - 1)))
    return wanted.join(frames, [*keys, index])


def crop_tokens(tokens: Column | str, decoded_start: Column, core_start: Column, core_end: Column) -> Column:
    """Tokens in track time whose midpoint lies in [core_start, core_end)."""
    t = F.col(tokens) if isinstance(tokens, str) else tokens
    moved = F.transform(t, lambda x: F.struct(x["text"].alias("text"), (x["start"] + decoded_start).alias("start"), (F.coalesce(x["end"], x["start"]) + decoded_start).alias("end")))
    inside = F.filter(moved, lambda x: ((x["start"] + x["end"]) / 2 >= core_start) & ((x["start"] + x["end"]) / 2 < core_end))
    return F.transform(inside, lambda x: F.struct(x["text"].alias("text"), F.round(x["start"], 6).alias("start"), F.round(x["end"], 6).alias("end")))


def path_conflicts(records: DataFrame, key: str, path: str) -> DataFrame:
    """Keys whose path equals another's, or one is a folder on the other's way.

    Prefixes are exploded and joined by equality, so no pair of unrelated paths meets.
    """
    rows = records.select(key, F.col(path).alias("__path"))
    twice = rows.groupBy("__path").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    same = rows.join(twice, "__path", "left_semi").select(key)
    inside = rows.select(F.col(key).alias("__inner"), F.explode(proper_prefixes("__path")).alias("__path")).join(rows, "__path")
    return same.unionByName(inside.select(key)).unionByName(inside.select(F.col("__inner").alias(key))).distinct()


def similarity_pairs(frames: DataFrame, keys: Keys, index: str, vector: str) -> DataFrame:
    """Cosine of all pairs of frames of a key (a track's self-similarity), clipped to [-1, 1]."""
    from quaverlake.functions.values import dot, unit

    unit_frames = frames.select(*keys, index, unit(vector).alias("__v"))
    right = unit_frames.select(*keys, F.col(index).alias("j"), F.col("__v").alias("__w"))
    pairs = unit_frames.withColumnRenamed(index, "i").join(right, keys)
    return pairs.select(*keys, "i", "j", F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot("__v", "__w"))).alias("value"))


def similarity_rows(frames: DataFrame, keys: Keys, index: str, vector: str, block: int = 8192, chunk: int = 256) -> DataFrame:
    """(keys, index, mean, nearest): of each frame's cosines with all frames of its key the mean, and the largest with another.

    Exact over all pairs, so the work is quadratic in a key's frames; it is spread over pairs of blocks, and a
    task holds two blocks and ``chunk`` rows of cosines. As among all pairs, those of a vector that is missing
    or not finite are 1. Vectors of a key have one length.
    """
    from quaverlake.functions.values import comparable

    group = Window.partitionBy(*keys)
    place = F.floor((F.row_number().over(group.orderBy(index)) - 1) / block).cast("int")
    own = comparable(frames.select(*keys, index, F.col(vector).alias("__v")), "__v").withColumn("__own", place)
    blocks = own.withColumn("__last", F.max("__own").over(group)).withColumn("__other", F.explode(F.sequence(F.lit(0), F.col("__last")))).drop("__last")
    dealt = blocks.withColumns({"__a": F.least("__own", "__other"), "__b": F.greatest("__own", "__other")}).drop("__other")
    names = [*keys, index]

    def compare(rows: pd.DataFrame) -> pd.DataFrame:
        finite = rows["__u"].notna().to_numpy()
        width = len(rows["__u"].to_numpy()[finite][0]) if finite.any() else 0
        x = np.zeros((len(rows), width))
        if finite.any():
            x[finite] = np.stack(rows["__u"].to_numpy()[finite])
        n, total, nearest = np.zeros(len(rows), np.int64), np.zeros(len(rows)), np.full(len(rows), -np.inf)
        side = rows["__own"].to_numpy()
        a, b = rows["__a"].iloc[0], rows["__b"].iloc[0]
        left, right = np.flatnonzero(side == a), np.flatnonzero(side == b)
        for some, others in [(left, right)] if a == b else [(left, right), (right, left)]:
            n[some] = len(others)
            odd = len(others) - finite[others].sum()
            total[some] = np.where(finite[some], x[some] @ x[others].sum(axis=0) + odd, len(others))
        y, strange = x[right], ~finite[right]
        for low in range(0, len(left), chunk):
            some = left[low : low + chunk]
            m = x[some] @ y.T
            m[~finite[some]] = 1.0
            m[:, strange] = 1.0
            if a == b:
                m[np.arange(len(some)), np.arange(low, low + len(some))] = -np.inf
            if m.size:
                nearest[some] = m.max(axis=1)
                if a != b:
                    nearest[right] = np.maximum(nearest[right], m.max(axis=0))
        nearest = np.where(np.isfinite(nearest), np.clip(nearest, -1.0, 1.0), np.nan)
        return rows[names].assign(__n=n, __total=total, __nearest=nearest)

    kinds = ", ".join(f"`{k}` {frames.schema[k].dataType.simpleString()}" for k in names)
    found = dealt.groupBy(*keys, "__a", "__b").applyInPandas(compare, f"{kinds}, __n long, __total double, __nearest double")
    mean = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.sum("__total") / F.sum("__n")))
    return found.groupBy(*names).agg(mean.alias("mean"), F.max("__nearest").alias("nearest"))


def lookup(rows: DataFrame, table: DataFrame, key: str) -> DataFrame:
    """Inner join with segment metadata; rows without any are left out. Spark broadcasts a side it knows to be small."""
    return rows.join(table, key)


def merge_back(inputs: DataFrame, predictions: DataFrame, key: str, result: str) -> DataFrame:
    """Inputs with their prediction, else a class of error."""
    out = inputs.join(predictions.withColumn("__seen", F.lit(True)), key, "left")
    size = F.size(result) if predictions.schema[result].dataType.typeName() == "array" else F.length(F.col(result).cast("string"))
    error = F.when(F.col("__seen").isNull(), "missing_prediction").when(F.col(result).isNull(), "invalid_prediction").when(size == 0, "empty_prediction")
    return out.withColumn("error", error).drop("__seen")


def timeline_accuracy(reference: DataFrame, estimate: DataFrame, keys: Keys, at: str, label: str) -> DataFrame:
    """(keys, accuracy): share of the common time in which two timelines agree.

    A timeline's rows say which label starts at a time; its last row only ends it.
    """
    ms = F.round(F.col(at) * 1000).cast("long")
    tagged = reference.select(*keys, ms.alias("t"), F.col(label).alias("a"), F.lit(None).cast("string").alias("b"), F.lit("a").alias("side")).unionByName(estimate.select(*keys, ms.alias("t"), F.lit(None).cast("string").alias("a"), F.col(label).alias("b"), F.lit("b").alias("side")))
    group = Window.partitionBy(*keys)
    ends = {f"{f}_{s}": g(F.when(F.col("side") == s, F.col("t"))).over(group) for s in "ab" for f, g in (("lo", F.min), ("hi", F.max))}
    points = tagged.withColumns(ends).groupBy(*keys, "t").agg(F.max("a").alias("a"), F.max("b").alias("b"), *(F.max(c).alias(c) for c in ends))
    w = Window.partitionBy(*keys).orderBy("t")
    sofar = w.rowsBetween(Window.unboundedPreceding, 0)
    low, high = F.greatest("lo_a", "lo_b"), F.least("hi_a", "hi_b")
    marked = points.withColumns({"__a": F.last("a", True).over(sofar), "__b": F.last("b", True).over(sofar), "__next": F.least(F.lead("t").over(w), high)})
    spans = marked.where((F.col("t") >= low) & (F.col("t") < high)).withColumn("__d", F.col("__next") - F.col("t"))
    return spans.groupBy(*keys).agg(F.try_divide(F.sum(F.when(F.col("__a") == F.col("__b"), F.col("__d")).otherwise(0)), F.sum("__d")).alias("accuracy"))


def tree_differences(written: DataFrame, expected: DataFrame) -> DataFrame:
    """Rows only one side has, repeats counted."""
    columns = expected.columns
    a, b = written.select(*columns), expected
    return a.exceptAll(b).withColumn("side", F.lit("written")).unionByName(b.exceptAll(a).withColumn("side", F.lit("expected")))


def unique_union(tables: list[DataFrame], key: str) -> DataFrame:
    """UNION ALL of tables that share no key."""
    from quaverlake.operators.aggregates import repeated_keys

    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)
    require_empty(repeated_keys(rows, key), "repeated or blank keys", key)
    return rows


def in_task_order(results: DataFrame, order: DataFrame, key: str, at: str) -> DataFrame:
    """Results by task order, unknown tasks last, then by key."""
    return results.join(order.select(key, at), key, "left").orderBy(F.asc_nulls_last(at), key)


def first_unallocated(tasks: DataFrame, taken: DataFrame, key: str, at: str, n: int) -> DataFrame:
    return tasks.join(taken.select(key), key, "left_anti").orderBy(at, key).limit(n)


def upsert(old: DataFrame, new: DataFrame, key: str, order: str | None = None) -> DataFrame:
    """Old rows replaced by new ones of the same key (K6's key merge); of several new ones the last by ``order``."""
    rows = old.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)), allowMissingColumns=True)
    age = F.struct("__new", *([order] if order else []))
    held = [c for c in rows.columns if c not in (key, "__new")]
    last = rows.groupBy(key).agg(F.max_by(F.struct(*held), age).alias("__row"))
    return last.select(key, *(F.col(f"__row.`{c}`").alias(c) for c in held))


def rank_slice(paths: DataFrame, path: str, rank: int, world: int) -> DataFrame:
    """A worker's contiguous block of sorted paths, the remainder on low ranks.

    Path lists are driver-made and small; their order is global.
    """
    if not 0 <= rank < world:
        raise ValueError("rank must lie in [0, world)")
    return paths.withColumn("__tile", F.ntile(world).over(Window.orderBy(path))).where(F.col("__tile") == rank + 1).drop("__tile")

"""Ordered-series operators.

Series are long DataFrames with key columns and an order; every order must be total.
Fixed plans over one value (windows of a duration, offsets) are array expressions.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

Keys = list[str]


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def over(keys: Keys, order: Keys):
    return Window.partitionBy(*keys).orderBy(*order)


def upto(n: Column) -> Column:
    """0 .. n-1; empty for n <= 0 (``sequence`` alone would count down)."""
    return F.when(n > 0, F.sequence(F.lit(0), (n - 1).cast("int"))).otherwise(F.array().cast("array<int>"))


def differences(df: DataFrame, keys: Keys, order: Keys, value: str, name: str = "diff") -> DataFrame:
    return df.withColumn(name, F.col(value) - F.lag(value).over(over(keys, order)))


def change_points(df: DataFrame, keys: Keys, order: Keys, value: str) -> DataFrame:
    """First row of each key and rows whose value differs from the one before."""
    w = over(keys, order)
    marked = df.withColumns({"__n": F.row_number().over(w), "__before": F.lag(value).over(w)})
    return marked.where((F.col("__n") == 1) | ~F.col(value).eqNullSafe(F.col("__before"))).drop("__n", "__before")


def label_set_changes(frames: DataFrame, keys: Keys, index: str, label: str, probability: str, threshold: float, hop: float, duration: str) -> DataFrame:
    """(keys, index, time, active): frames whose set of labels at or over ``threshold`` differs from the frame before; the first always.

    ``frames`` has a row per frame and label, and the track's ``duration`` on each.
    """
    on = F.when(F.col(probability) >= threshold, F.col(label))
    sets = frames.groupBy(*keys, index).agg(F.array_sort(F.collect_set(on)).alias("active"), F.max(duration).alias("__duration"))
    first = change_points(sets, keys, [index], "active")
    return first.select(*keys, index, F.round(F.least("__duration", F.col(index) * hop), 6).alias("time"), "active")


def with_runs(df: DataFrame, keys: Keys, order: Keys, value: str, name: str = "run") -> DataFrame:
    """Number runs of equal values, from 1."""
    w = over(keys, order)
    marked = df.withColumns({"__n": F.row_number().over(w), "__before": F.lag(value).over(w)})
    new = ((F.col("__n") == 1) | ~F.col(value).eqNullSafe(F.col("__before"))).cast("int")
    return marked.withColumn("__new", new).withColumn(name, F.sum("__new").over(w)).drop("__n", "__before", "__new")


def longest_run(df: DataFrame, keys: Keys, order: Keys, flag: Column) -> DataFrame:
    """(keys, longest): most rows in a row with a true flag, 0 if none."""
    w = over(keys, order)
    marked = df.withColumn("__flag", F.coalesce(flag, F.lit(False)))
    island = F.row_number().over(w) - F.sum(F.col("__flag").cast("int")).over(w)
    runs = marked.withColumn("__island", island).groupBy(*keys, "__island").agg(F.sum(F.col("__flag").cast("long")).alias("n"))
    return runs.groupBy(*keys).agg(F.max("n").alias("longest"))


def merge_adjacent(sections: DataFrame, keys: Keys, order: Keys, label: str = "label") -> DataFrame:
    """One row per run of equal labels: the first's fields, end, raw_end and confidence of the last."""
    runs = with_runs(sections, keys, order, label, "__run")
    at = F.struct(*order)
    last = [c for c in ("end", "raw_end", "boundary_confidence") if c in sections.columns]
    rest = [c for c in sections.columns if c not in (*keys, *last)]
    return runs.groupBy(*keys, "__run").agg(*(F.min_by(c, at).alias(c) for c in rest), *(F.max_by(c, at).alias(c) for c in last)).drop("__run").select(*sections.columns)


def renumber(sections: DataFrame, keys: Keys, order: Keys, name: str = "section_id") -> DataFrame:
    return sections.withColumn(name, F.lpad(F.row_number().over(over(keys, order)).cast("string"), 4, "0"))


def contiguity_violations(sections: DataFrame, keys: Keys, start: str = "start", end: str = "end", duration: str | None = "duration", tolerance: float = 0.01) -> DataFrame:
    """Rows that leave a gap, overlap or are empty; a key's last row must end at its duration."""
    w = Window.partitionBy(*keys).orderBy(start, end)
    marked = sections.withColumns({"previous_end": F.lag(end, 1, 0.0).over(w), "__next": F.lead(start).over(w)})
    gap = F.when(F.abs(F.col(start) - F.col("previous_end")) > tolerance, "gap_or_overlap").when(F.col(end) <= F.col(start), "empty")
    if duration:
        gap = F.coalesce(gap, F.when(F.col("__next").isNull() & (F.abs(F.col(end) - F.col(duration)) > tolerance), "short_of_duration"))
    return marked.withColumn("problem", gap).where("problem is not null").drop("__next")


def local_maxima(df: DataFrame, keys: Keys, order: Keys, value: str, size: int = 3, name: str = "peak") -> DataFrame:
    """The value where it is the largest of its centred window, else 0."""
    if size % 2 == 0:
        raise ValueError("size must be odd")
    w = over(keys, order).rowsBetween(-(size // 2), size // 2)
    return df.withColumn(name, F.when(F.col(value) == F.max(value).over(w), F.col(value)).otherwise(F.lit(0.0)))


def pick_peaks(df: DataFrame, keys: Keys, order: Keys, value: str, past: int = 99, future: int = 99, name: str = "strength") -> DataFrame:
    """Height over the mean of what surrounds a local peak; what lies outside counts as zero."""
    w = over(keys, order)
    around = w.rowsBetween(-past, future)
    before = F.coalesce(F.sum(value).over(w.rowsBetween(-past, -1)), F.lit(0.0)) / past
    after = F.coalesce(F.sum(value).over(w.rowsBetween(1, future)), F.lit(0.0)) / future
    peak = (F.col(value) == F.max(value).over(around)) & (F.col(value) > 0)
    strength = F.when(peak, F.col(value) - (before + after) / 2).otherwise(F.lit(0.0))
    return df.withColumn(name, F.greatest(strength, F.lit(0.0)))


def prefix_sums_2d(matrix: DataFrame, keys: Keys, i: str = "i", j: str = "j", value: str = "value", name: str = "total") -> DataFrame:
    """Sum of the rectangle from the origin to each cell, inclusive."""
    rows = matrix.withColumn("__row", F.sum(value).over(Window.partitionBy(*keys, i).orderBy(j)))
    return rows.withColumn(name, F.sum("__row").over(Window.partitionBy(*keys, j).orderBy(i))).drop("__row")


def rectangle_means(totals: DataFrame, rectangles: DataFrame, keys: Keys, total: str = "total") -> DataFrame:
    """``rectangles`` (keys, i0, i1, j0, j1; ends exclusive) with their mean, from prefix sums."""
    out = rectangles
    corners = {"a": ("i1", "j1"), "b": ("i0", "j1"), "c": ("i1", "j0"), "d": ("i0", "j0")}
    for name, (r, c) in corners.items():
        corner = totals.select(*(F.col(k).alias(f"__{name}_{k}") for k in keys), (F.col("i") + 1).alias(f"__{name}i"), (F.col("j") + 1).alias(f"__{name}j"), F.col(total).alias(f"__{name}"))
        on = [F.col(k) == F.col(f"__{name}_{k}") for k in keys] + [F.col(r) == F.col(f"__{name}i"), F.col(c) == F.col(f"__{name}j")]
        out = out.join(corner, on, "left").drop(*(f"__{name}_{k}" for k in keys), f"__{name}i", f"__{name}j")
    part = {n: F.coalesce(F.col(f"__{n}"), F.lit(0.0)) for n in corners}
    area = (F.col("i1") - F.col("i0")) * (F.col("j1") - F.col("j0"))
    return out.withColumn("mean", F.when(area > 0, (part["a"] - part["b"] - part["c"] + part["d"]) / area).otherwise(F.lit(0.0))).drop(*(f"__{n}" for n in corners))


def similarity_rectangle_means(frames: DataFrame, rectangles: DataFrame, keys: Keys, index: str, vector: str) -> DataFrame:
    """``rectangles`` (keys, i0, i1, j0, j1; ends exclusive) of the keys' self-similarity with their mean cosine.

    A rectangle's sum is the dot product of its sides' sums of unit vectors, and these are differences of
    running sums, so no pair is ever made. As among all pairs, those of a vector that is missing or not
    finite are 1. No frame at all gives null, no area 0. One key's frames fit in one task; vectors of a key
    have one length.
    """
    from quaverlake.functions.values import comparable, dot

    own = comparable(frames.select(*keys, F.col(index).cast("long").alias("__at"), F.col(vector).alias("__v")), "__v")
    ends = [rectangles.select(*keys, F.col(f"{c}0").cast("long").alias("__lo"), F.col(f"{c}1").cast("long").alias("__hi")) for c in "ij"]
    sides = ends[0].unionByName(ends[1]).distinct()

    def sums(vectors: pd.DataFrame, wanted: pd.DataFrame) -> pd.DataFrame:
        vectors = vectors.sort_values("__at", kind="stable")
        finite = vectors["__u"].notna().to_numpy()
        units = np.stack(vectors["__u"].to_numpy()[finite]) if finite.any() else np.zeros((0, 0))
        at, running = vectors["__at"].to_numpy(), np.vstack([np.zeros(units.shape[1]), units.cumsum(axis=0)])
        good = np.append(0, finite.astype(np.int64).cumsum())
        lo = np.searchsorted(at, wanted["__lo"].to_numpy())
        hi = np.maximum(lo, np.searchsorted(at, wanted["__hi"].to_numpy()))
        return wanted.assign(__n=hi - lo, __g=good[hi] - good[lo], __s=list(running[good[hi]] - running[good[lo]]))

    kinds = ", ".join(f"`{k}` {rectangles.schema[k].dataType.simpleString()}" for k in keys)
    summed = own.groupBy(*keys).cogroup(sides.groupBy(*keys)).applyInPandas(sums, f"{kinds}, __lo long, __hi long, __n long, __g long, __s array<double>")
    out = rectangles
    for c in "ij":
        side = summed.select(*(F.col(k).alias(f"__{c}_{k}") for k in keys), *(F.col(f"__{x}").alias(f"__{x}{c}") for x in ("lo", "hi", "n", "g", "s")))
        on = [F.col(k) == F.col(f"__{c}_{k}") for k in keys] + [F.col(f"{c}0") == F.col(f"__lo{c}"), F.col(f"{c}1") == F.col(f"__hi{c}")]
        out = out.join(side, on, "left").drop(*(f"__{c}_{k}" for k in keys), f"__lo{c}", f"__hi{c}")
    pairs = F.col("__ni") * F.col("__nj")
    total = F.when(F.col("__gi") * F.col("__gj") > 0, dot("__si", "__sj")).otherwise(F.lit(0.0)) + pairs - F.col("__gi") * F.col("__gj")
    empty = (F.col("i1") <= F.col("i0")) | (F.col("j1") <= F.col("j0"))
    mean = F.when(empty, F.lit(0.0)).otherwise(F.greatest(F.lit(-1.0), F.least(F.lit(1.0), F.try_divide(total, pairs))))
    return out.withColumn("mean", F.when(empty | (pairs > 0), mean)).drop(*(f"__{x}{c}" for c in "ij" for x in "ngs"))


def window_ranges(duration: Column | str, window: float = 10.0, hop: float = 10.0, least_tail: float = 2.0) -> Column:
    """Windows over a duration; a tail under ``least_tail`` joins the window before it.

    Windows start every ``hop`` until one reaches the end.
    """
    d = F.greatest(_col(duration).cast("double"), F.lit(0.0))
    n = F.when(d <= 0, 0).when(d <= window, 1).otherwise(F.ceil((d - window) / hop) + 1)
    tail = d - (n - 1) * hop
    folded = (n > 1) & (tail < least_tail)
    kept = F.when(folded, n - 1).otherwise(n)
    cut = lambda i: F.when(i == kept - 1, d).otherwise(F.least(d, i * hop + window))
    return F.transform(upto(kept), lambda i: F.struct((i * F.lit(float(hop))).alias("start"), cut(i).alias("end")))


def sample_offsets(duration: Column | str, fractions: list[float], window: float = 8.0) -> Column:
    """Where to sample a track: fractions of what a window leaves free."""
    free = F.greatest(_col(duration).cast("double") - window, F.lit(0.0))
    return F.transform(F.array(*(F.lit(f) for f in fractions)), lambda f: F.round(free * f, 6))


def patches(n: Column | str, size: int = 128, hop: int = 62) -> Column:
    """Starts of full patches; an incomplete tail is left out."""
    n = _col(n)
    return F.transform(upto(F.when(n >= size, F.floor((n - size) / hop) + 1).otherwise(0)), lambda i: i * hop)


def chunks(n: Column | str, size: int, overlap: int, least: int = 1024) -> Column:
    """Overlapping chunks (start, end) that cover n samples; chunks of ``least`` or fewer are dropped."""
    n, step = _col(n), size - overlap
    count = F.when(n <= 0, 0).when(n <= size, 1).otherwise(F.ceil((n - size) / step) + 1)
    all_chunks = F.transform(upto(count), lambda i: F.struct((i * step).cast("long").alias("start"), F.least(n, i * step + size).cast("long").alias("end")))
    return F.filter(all_chunks, lambda c: c["end"] - c["start"] > least)


def alphabet_label(index: Column | str) -> Column:
    """0 -> A, 25 -> Z, 26 -> AA (two letters and more as needed, up to four)."""
    i = _col(index).cast("long")
    letter = lambda x: F.chr(F.lit(65) + x % 26)
    a, b = F.floor(i / 26) - 1, F.floor((F.floor(i / 26) - 1) / 26) - 1
    c = F.floor(b / 26) - 1
    return F.concat(F.when(c >= 0, letter(c)).otherwise(""), F.when(b >= 0, letter(b)).otherwise(""), F.when(a >= 0, letter(a)).otherwise(""), letter(i))


def label_by_appearance(df: DataFrame, keys: Keys, order: Keys, cluster: str, name: str = "label") -> DataFrame:
    """Letters in the order in which clusters first appear."""
    first = df.withColumn("__first", F.min(F.struct(*order)).over(Window.partitionBy(*keys, cluster)))
    rank = F.dense_rank().over(Window.partitionBy(*keys).orderBy("__first")) - 1
    return first.withColumn(name, alphabet_label(rank)).drop("__first")


def frame_batches(items: DataFrame, keys: Keys, order: Keys, frames: str, size: int) -> DataFrame:
    """Bins of ``size`` frames filled in order, items split across them, every frame once.

    Adds batch, first (frame in the item) and count.
    """
    w = over(keys, order)
    placed = items.withColumn("__end", F.sum(frames).over(w)).withColumn("__begin", F.col("__end") - F.col(frames)).where(F.col(frames) > 0)
    bins = F.sequence(F.floor(F.col("__begin") / size), F.floor((F.col("__end") - 1) / size))
    cut = placed.withColumn("batch", F.explode(bins))
    low = F.greatest(F.col("__begin"), F.col("batch") * size)
    high = F.least(F.col("__end"), (F.col("batch") + 1) * size)
    return cut.withColumns({"first": low - F.col("__begin"), "count": high - low}).drop("__begin", "__end")


def bucket_batches(items: DataFrame, bucket: str, order: Keys, size: int) -> DataFrame:
    """Batches of at most ``size`` within each bucket."""
    n = F.row_number().over(Window.partitionBy(bucket).orderBy(*order)) - 1
    return items.withColumn("batch", F.floor(n / size))


def equal_length_batches(items: DataFrame, keys: Keys, order: Keys, length: str, size: int) -> DataFrame:
    """Batches of adjacent items of equal length, at most ``size`` each."""
    runs = with_runs(items, keys, order, length, "run")
    n = F.row_number().over(Window.partitionBy(*keys, "run").orderBy(*order)) - 1
    return runs.withColumn("part", F.floor(n / size))


def next_ordinals(new: DataFrame, existing: DataFrame, key: str, order: Keys, ordinal: str = "ordinal") -> DataFrame:
    """Number new rows on from the largest ordinal of their key."""
    top = existing.groupBy(key).agg(F.max(ordinal).alias("__top"))
    n = F.row_number().over(Window.partitionBy(key).orderBy(*order))
    return new.join(top, key, "left").withColumn(ordinal, F.coalesce("__top", F.lit(-1)) + n).drop("__top")


def padded(start: Column | str, end: Column | str, duration: Column | str, padding: float) -> Column:
    """A section with padding, inside its track: struct(start, end)."""
    return F.struct(F.greatest(F.lit(0.0), _col(start) - padding).alias("start"), F.least(_col(duration), _col(end) + padding).alias("end"))

"""Aggregations."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quaverlake.functions.hashing import multiset_hash
from quaverlake.functions.values import rate, seconds_per_item, unit
from quaverlake.operators.sequences import longest_run, over
from quaverlake.plans.vocabulary import FAILED_ASR_STATUS, STAGE_ORDER, VOICE_HOP_SECONDS

Keys = list[str]


def content_dedup(files: DataFrame, content_id: Column, path: str) -> DataFrame:
    """One row per content: canonical path (smallest), other paths, their count.

    Files without a readable id stay on their own.
    """
    group = F.coalesce(content_id, F.concat(F.lit("unreadable:"), F.col(path).cast("string")))
    held = files.groupBy(group.alias("group_id")).agg(F.array_sort(F.collect_list(path)).alias("paths"))
    return held.select(
        F.when(~F.col("group_id").startswith("unreadable:"), F.col("group_id")).alias("audio_id"),
        F.element_at("paths", 1).alias(path),
        F.slice("paths", F.lit(2), F.greatest(F.size("paths") - 1, F.lit(0))).alias("duplicate_paths"),
        (F.size("paths") - 1).cast("long").alias("duplicate_count"),
    )


def repeated_keys(df: DataFrame, key: str) -> DataFrame:
    """Keys that are blank or occur more than once; empty for a proper table."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("n")).where((F.col("n") > 1) | F.coalesce(F.trim(F.col(key).cast("string")) == "", F.lit(True)))


def weighted_trimmed_mean(df: DataFrame, keys: Keys, value: str, weight: str, order: Keys, trim: float = 0.1, name: str = "trimmed") -> DataFrame:
    """Mean after a share of the weight is taken off each tail, in part at the edges.

    Negative weights count as zero; where all are zero each row counts as one.
    """
    t = max(0.0, min(0.49, trim))
    group = Window.partitionBy(*keys)
    w = F.greatest(F.coalesce(F.col(weight), F.lit(0.0)), F.lit(0.0))
    weighed = df.withColumn("__w", w).withColumn("__w", F.when(F.sum("__w").over(group) > 0, F.col("__w")).otherwise(F.lit(1.0)))
    upto = Window.partitionBy(*keys).orderBy(value, *order).rowsBetween(Window.unboundedPreceding, 0)
    placed = weighed.withColumns({"__end": F.sum("__w").over(upto), "__total": F.sum("__w").over(group)})
    begin = F.col("__end") - F.col("__w")
    kept = F.greatest(F.lit(0.0), F.least(F.col("__end"), F.col("__total") * (1 - t)) - F.greatest(begin, F.col("__total") * t))
    held = placed.withColumn("__kept", kept)
    return held.groupBy(*keys).agg(F.coalesce(F.try_divide(F.sum(F.col(value) * F.col("__kept")), F.sum("__kept")), F.lit(0.0)).alias(name))


def weighted_coverage(value: Column | str, weight: Column | str, least: float = 0.5) -> Column:
    """Aggregate: share of the weight with at least this value."""
    v, w = (F.col(c) if isinstance(c, str) else c for c in (value, weight))
    return F.coalesce(F.try_divide(F.sum(F.when(v >= least, w).otherwise(0.0)), F.sum(w)), F.lit(0.0))


def gate_summary(windows: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """Score, coverage, singing and speech scores of windows (music/singing/speech_probability, start, end)."""
    w = windows.withColumn("__weight", F.greatest(F.coalesce("end", F.lit(1.0)) - F.coalesce("start", F.lit(0.0)), F.lit(0.0)))
    group = Window.partitionBy(*keys)
    w = w.withColumn("__weight", F.when(F.sum("__weight").over(group) > 0, F.col("__weight")).otherwise(F.lit(1.0)))
    out = w.groupBy(*keys).agg(weighted_coverage("music_probability", "__weight").alias("coverage"), F.count(F.lit(1)).alias("window_count"))
    for kind in ("music", "singing", "speech"):
        out = out.join(weighted_trimmed_mean(w.withColumn("__v", F.coalesce(f"{kind}_probability", F.lit(0.0))), keys, "__v", "__weight", order, name=f"__{kind}"), keys)
    score = F.round(F.col("__music") * 0.7 + F.col("coverage") * 0.3, 6)
    return out.select(*keys, score.alias("score"), F.round("coverage", 6).alias("coverage"), F.round("__singing", 6).alias("singing_score"), F.round("__speech", 6).alias("speech_score"), "window_count")


def trimmed_mean(values: Column | str, trim: float = 0.1) -> Column:
    """Mean of an array without int(n * trim) values at either end; 0 if empty."""
    ordered = F.array_sort(F.col(values) if isinstance(values, str) else values)
    n = F.size(ordered)
    cut = F.floor(n * max(0.0, min(0.49, trim))).cast("int")
    kept = F.slice(ordered, cut + 1, n - cut * 2)
    return F.when(n > 0, F.aggregate(kept, F.lit(0.0), lambda s, x: s + x) / F.size(kept)).otherwise(F.lit(0.0))


def voice_summary(frames: DataFrame, keys: Keys, order: Keys, value: str, hop: float = VOICE_HOP_SECONDS, least: float = 0.5) -> DataFrame:
    """voice_mean, voice_max, voice_coverage and longest_voice_sec of frame probabilities."""
    base = frames.groupBy(*keys).agg(F.avg(value).alias("voice_mean"), F.max(value).alias("voice_max"), F.avg((F.col(value) >= least).cast("double")).alias("voice_coverage"))
    run = longest_run(frames, keys, order, F.col(value) >= least)
    return base.join(run, keys).withColumn("longest_voice_sec", F.col("longest") * hop).drop("longest")


def top_labels(frames: DataFrame, key: str, label: str, value: str, k: int = 8) -> DataFrame:
    """The k labels of largest mean; of equal means the larger label first."""
    means = frames.groupBy(key, label).agg(F.round(F.avg(value), 6).alias("probability"))
    rank = F.row_number().over(Window.partitionBy(key).orderBy(F.desc("probability"), F.desc(label)))
    return means.withColumn("rank", rank).where(F.col("rank") <= k)


def tempo(beats: DataFrame, keys: Keys, order: Keys, time: str, low: float = 0.1, high: float = 3.0) -> DataFrame:
    """(keys, bpm): 60 over the mean of the gaps between low and high; null if there are none."""
    gap = F.col(time) - F.lag(time).over(over(keys, order))
    gaps = beats.withColumn("__gap", gap)
    usable = (F.col("__gap") > low) & (F.col("__gap") < high)
    return gaps.groupBy(*keys).agg((60 / F.avg(F.when(usable, F.col("__gap")))).alias("bpm"))


def failure_counts(records: DataFrame, stage: str) -> DataFrame:
    return records.groupBy(F.coalesce(F.col(stage), F.lit("unknown")).alias("stage")).agg(F.count(F.lit(1)).alias("failures"))


def content_counts(records: DataFrame, kind: str, kinds: list[str]) -> DataFrame:
    """One row: total and a count per kind."""
    return records.agg(F.count(F.lit(1)).alias("total"), *(F.count_if(F.col(kind) == k).alias(k) for k in kinds))


def partition_membership(inventory: DataFrame, partitions: dict[str, DataFrame], key: str) -> DataFrame:
    """Ids that are not in exactly one partition, or that the inventory lacks; empty when all is well."""
    tagged = None
    for name, part in partitions.items():
        rows = part.select(F.col(key), F.lit(name).alias("partition"))
        tagged = rows if tagged is None else tagged.unionByName(rows)
    placed = tagged.groupBy(key).agg(F.count(F.lit(1)).alias("n"), F.array_join(F.array_sort(F.collect_list("partition")), ",").alias("partitions"))
    both = inventory.select(key, F.lit(True).alias("__known")).distinct().join(placed, key, "full")
    problem = F.when(F.col("__known").isNull(), "foreign").when(F.col("n").isNull(), "missing").when(F.col("n") > 1, "repeated")
    return both.select(key, problem.alias("problem"), F.coalesce("partitions", F.lit("")).alias("partitions")).where("problem is not null")


def best_retries(failures: DataFrame, placed: DataFrame, key: str, stage: str, order: str) -> DataFrame:
    """One failure per id that is placed nowhere: earliest stage, then first seen."""
    rank = F.coalesce(F.nullif(F.array_position(F.array(*(F.lit(s) for s in STAGE_ORDER)), F.col(stage)), F.lit(0)), F.lit(len(STAGE_ORDER) + 1))
    open_rows = failures.join(placed.select(key).distinct(), key, "left_anti").withColumn("__rank", rank)
    first = F.struct("__rank", order)
    return open_rows.groupBy(key).agg(*(F.min_by(c, first).alias(c) for c in failures.columns if c != key))


def latest(df: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """Last row per key."""
    at = F.struct(*order)
    return df.groupBy(*keys).agg(*(F.max_by(c, at).alias(c) for c in df.columns if c not in keys))


def progress(tasks: DataFrame, key: str, status: str, order: str) -> DataFrame:
    """One row: tasks by their last status."""
    last = latest(tasks.select(key, status, order), [key], [order])
    s = F.col(status)
    allocated = s.isin("allocated", "running")
    return last.agg(F.count(F.lit(1)).alias("total"), F.count_if(s == "completed").alias("completed"), F.count_if(s == "failed").alias("failed"), F.count_if(allocated).alias("allocated"), F.count_if(~s.isin("completed", "failed", "allocated", "running")).alias("unallocated"))


def manifest_hash(rows: DataFrame, keys: Keys, row_hash: Column) -> DataFrame:
    """Order-free hash of each key's rows, and their number."""
    return rows.withColumn("__h", row_hash).groupBy(*keys).agg(multiset_hash("__h").alias("manifest"), F.count(F.lit(1)).alias("rows"))


def transcript(sections: DataFrame, keys: Keys, order: Keys, lyrics: str) -> DataFrame:
    """Lyrics of the sections that have some, one line each; null if none has."""
    have = F.when(F.coalesce(F.col(lyrics), F.lit("")) != "", F.struct(*order, F.col(lyrics).alias("__text")))
    held = sections.groupBy(*keys).agg(F.array_sort(F.collect_list(have)).alias("__lines"))
    return held.select(*keys, F.nullif(F.array_join(F.col("__lines.__text"), "\n"), F.lit("")).alias("full_transcript"))


def asr_roll_up(tracks: DataFrame, sections: DataFrame, keys: Keys, order: Keys) -> DataFrame:
    """(keys, stage_status, stage_error): failed sections fail a track, and so does having none."""
    given = lambda c: F.nullif(F.col(c), F.lit(""))
    detail = F.concat(F.col("section_id"), F.lit(": "), F.coalesce(given("alignment_error"), given("asr_error"), "asr_status"))
    failed = F.when(F.col("asr_status").isin(FAILED_ASR_STATUS), F.struct(*order, detail.alias("d")))
    held = sections.groupBy(*keys).agg(F.array_sort(F.collect_list(failed)).alias("bad"))
    problem = F.when(F.col("bad").isNull(), "input contains no sections").when(F.size("bad") > 0, F.array_join(F.col("bad.d"), "; "))
    return tracks.select(*keys).distinct().join(held, keys, "left").select(*keys, F.when(problem.isNull(), "ok").otherwise("error").alias("stage_status"), problem.alias("stage_error"))


def stage_rates(stages: DataFrame, processed: str = "processed", seconds: str = "elapsed") -> DataFrame:
    return stages.withColumns({"items_per_second": rate(processed, seconds), "seconds_per_item": seconds_per_item(processed, seconds)})


def run_report(stages: DataFrame, retries: Column, order: str) -> DataFrame:
    """One row over the stages of a run."""
    at = F.array_sort(F.collect_list(F.struct(order, "stage")))
    return stages.agg(F.sum("processed").alias("processed"), F.round(F.sum("elapsed"), 6).alias("elapsed"), F.array_join(F.transform(at, lambda x: x["stage"]), ",").alias("completed_stages"), retries.alias("retries")).withColumn("status", F.when(F.col("retries") > 0, "partial_success").otherwise("success"))


def segment_embeddings(frames: DataFrame, keys: Keys, vector: str, dims: int) -> DataFrame:
    """Unit mean vector per key."""
    means = frames.groupBy(*keys).agg(F.array(*(F.avg(F.element_at(vector, d + 1)) for d in range(dims))).alias("mean"))
    length = F.greatest(F.sqrt(F.aggregate("mean", F.lit(0.0), lambda s, x: s + x * x)), F.lit(1e-8))
    return means.withColumn("mean", F.transform("mean", lambda x: x / length))


def overlap_add(frames: DataFrame, keys: Keys, value: str, weight: str) -> DataFrame:
    """Weighted mean of what overlapping chunks say of a frame."""
    return frames.groupBy(*keys).agg((F.sum(F.col(value) * F.col(weight)) / F.greatest(F.sum(weight), F.lit(1e-8))).alias(value))


def fade(position: Column, length: Column, overlap: int, low: float = 0.05) -> Column:
    """Linear weights from ``low`` to 1 over the overlap at either end of a chunk."""
    rise = low + (1 - low) * F.least(position, length - 1 - position) / max(overlap - 1, 1)
    return F.least(F.lit(1.0), rise)


def cluster_confidence(pairs: DataFrame, keys: Keys, item: str, same: Column, similarity: str) -> DataFrame:
    """Mean similarity within the cluster against the nearest item outside it, to [.05, .95]."""
    held = pairs.groupBy(*keys, item).agg(F.avg(F.when(same, F.col(similarity))).alias("__own"), F.coalesce(F.max(F.when(~same, F.col(similarity))), F.lit(0.0)).alias("__other"))
    raw = F.when(F.col("__own").isNotNull(), 0.5 + 0.5 * F.greatest(F.lit(0.0), F.col("__own") - F.col("__other"))).otherwise(0.5 * F.greatest(F.lit(0.0), 1 - F.col("__other")))
    return held.select(*keys, item, F.greatest(F.lit(0.05), F.least(F.lit(0.95), raw)).alias("confidence"))


def segment_labels(frames: DataFrame, keys: Keys, label: str, probability: str) -> DataFrame:
    """The label of largest mean probability per segment; of equal ones the first."""
    means = frames.groupBy(*keys, label).agg(F.avg(probability).alias("__mean"))
    best = F.struct(F.col("__mean"), -F.col(label))
    return means.groupBy(*keys).agg(F.max_by(label, best).alias(label), F.max("__mean").alias("label_confidence"))


def frame_means(frames: DataFrame, keys: Keys, value: str) -> DataFrame:
    """Mean per frame over the windows that saw it."""
    return frames.groupBy(*keys).agg((F.sum(value) / F.greatest(F.count(value), F.lit(1))).alias(value))


def filled_rows(lines: DataFrame, column: str = "value") -> DataFrame:
    return lines.where(F.trim(column) != "").agg(F.count(F.lit(1)).alias("rows"))


def label_agreement(frames: DataFrame, keys: Keys, reference: str, estimate: str) -> DataFrame:
    """Pairwise precision, recall and F of two labellings of the same frames, and over- and under-segmentation scores.

    Frames are counted per pair of labels first, so nothing larger than that table is
    shuffled. Scores are 0 where no two frames share a label, segmentation scores also
    where there is but one label; frames without either label are left out.
    """
    cells = frames.where(F.col(reference).isNotNull() & F.col(estimate).isNotNull()).groupBy(*keys, reference, estimate).agg(F.count(F.lit(1)).alias("__n"))
    of = lambda label: Window.partitionBy(*keys, label)
    cells = cells.withColumns({"__r": F.sum("__n").over(of(reference)), "__e": F.sum("__n").over(of(estimate))})
    pairs = lambda n: n * (n - 1) / 2
    n, r, e = F.col("__n"), F.col("__r"), F.col("__e")
    sums = cells.groupBy(*keys).agg(
        F.sum(pairs(n)).alias("__both"),
        F.sum(n / r * pairs(r)).alias("__ref"),
        F.sum(n / e * pairs(e)).alias("__est"),
        F.sum(n).alias("__all"),
        F.sum(-n * F.log2(n / r)).alias("__est_open"),
        F.sum(-n * F.log2(n / e)).alias("__ref_open"),
        F.log2(F.count_distinct(reference)).alias("__ref_most"),
        F.log2(F.count_distinct(estimate)).alias("__est_most"),
    )
    share = lambda a, b: F.when(b > 0, a / b).otherwise(F.lit(0.0))
    closed = lambda left, most: F.when(most > 0, 1 - left / F.col("__all") / most).otherwise(F.lit(0.0))
    out = sums.select(
        *keys,
        share(F.col("__both"), F.col("__est")).alias("precision"),
        share(F.col("__both"), F.col("__ref")).alias("recall"),
        closed(F.col("__est_open"), F.col("__est_most")).alias("over_segmentation"),
        closed(F.col("__ref_open"), F.col("__ref_most")).alias("under_segmentation"),
    )
    total = F.col("precision") + F.col("recall")
    return out.withColumn("f_measure", share(2 * F.col("precision") * F.col("recall"), total))


def block_cohesion(frames: DataFrame, keys: Keys, block: str, vector: str) -> DataFrame:
    """Mean cosine over all pairs of frames of a block, each with itself too.

    It is the squared length of the mean of the unit vectors, so no pair is ever made.
    """
    one = frames.select(*keys, block, F.posexplode(unit(vector)).alias("__at", "__x"))
    mean = one.groupBy(*keys, block, "__at").agg(F.avg("__x").alias("__m"))
    return mean.groupBy(*keys, block).agg(F.sum(F.col("__m") * F.col("__m")).alias("cohesion"))


def hit_rates(matched_reference: DataFrame, matched_estimate: DataFrame, hit: Column) -> DataFrame:
    """Precision, recall and F of boundaries, from each side's nearest-neighbour join."""
    recall = matched_reference.agg(F.avg(hit.cast("double")).alias("recall"))
    precision = matched_estimate.agg(F.avg(hit.cast("double")).alias("precision"))
    both = recall.withColumn("__one", F.lit(1)).join(precision.withColumn("__one", F.lit(1)), "__one").drop("__one")
    total = F.col("recall") + F.col("precision")
    return both.withColumn("f_measure", F.when(total > 0, 2 * F.col("recall") * F.col("precision") / total).otherwise(F.lit(0.0)))

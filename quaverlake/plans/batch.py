"""The batch run: inventory -> gate -> route -> fan-out -> sections -> transcription -> four partitions."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaverlake.functions import hashing, routing
from quaverlake.operators import aggregates, joins, structure, validation
from quaverlake.plans.stages import Models
from quaverlake.plans.vocabulary import PIPELINE_VERSION, STAGE_A, STAGE_B, VOICE_HOP_SECONDS
from quaverlake.session import materialise


@dataclass(frozen=True)
class Outcome:
    """Four partitions, pairwise disjoint, that make up the inventory; and the base they are held against."""

    annotations: DataFrame
    review: DataFrame
    rejected: DataFrame
    retry: DataFrame
    base: DataFrame


def median(values: str) -> Column:
    """Median of a non-empty array of finite scores."""
    s = F.array_sort(values)
    n = F.size(s)
    return F.when(n % 2 == 1, F.element_at(s, (n / 2 + 0.5).cast("int"))).otherwise((F.element_at(s, (n / 2).cast("int")) + F.element_at(s, (n / 2 + 1).cast("int"))) / 2)


def cascade(tracks: DataFrame, models: Models) -> DataFrame:
    """Gate decision and probability; the second, dearer look is for grey tracks only."""
    first = models.gate_a(tracks).withColumn("a", F.round(median("stage_a"), 6)).withColumn("a_decision", routing.decide("a", STAGE_A["reject"], STAGE_A["accept"]))
    grey = models.gate_b(first.where("a_decision = 'review'").select("audio_id", "duration")).select("audio_id", F.round(median("stage_b"), 6).alias("b"))
    grey = grey.withColumn("b_decision", routing.decide("b", STAGE_B["reject"], STAGE_B["accept"]))
    out = first.join(grey, "audio_id", "left")
    return out.withColumns({"decision": F.coalesce("b_decision", "a_decision"), "probability": F.coalesce("b", "a")}).drop("stage_a", "a", "a_decision", "b", "b_decision")


def route(tracks: DataFrame, models: Models) -> DataFrame:
    """Song or instrumental by the voice of accepted music."""
    frames = models.voice(tracks).select("audio_id", F.posexplode("probabilities").alias("frame", "p"))
    voices = aggregates.voice_summary(frames, ["audio_id"], ["frame"], "p", VOICE_HOP_SECONDS)
    scored = tracks.join(voices, "audio_id").withColumn("vocal_score", routing.vocal_score("voice_mean", "voice_coverage", "longest_voice_sec"))
    return scored.withColumn("__r", routing.vocal_route("vocal_score")).withColumns({"route_status": F.col("__r.status"), "content_type": F.col("__r.content_type"), "content_confidence": F.col("__r.confidence")}).drop("__r")


def run(inventory: DataFrame, models: Models = Models(), alm: bool = True, asr: bool = True) -> Outcome:
    """``inventory``: audio_id, audio_path, source_relpath, duration, decode_status, one row per content."""
    usable = inventory.where(~routing.undecodable("decode_status"))
    invalid = inventory.where(routing.undecodable("decode_status")).select("audio_id", F.lit("inventory_decode_failed").alias("reason"))
    gated = materialise(cascade(usable, models).withColumn("__o", routing.gate_outcome("decision")))
    grey = gated.where("decision = 'review'").select("audio_id", F.col("__o.reason").alias("reason"))
    refused = gated.where("decision = 'rejected'").select("audio_id", F.col("__o.reason").alias("reason"))
    music = gated.where("decision = 'accepted'").drop("__o", "decision", "probability")
    routed = materialise(route(music, models))
    unsure = routed.where("route_status = 'review'").select("audio_id", F.lit("vocal_route_gray").alias("reason"))
    version = F.create_map(F.lit("music_gate"), F.lit("stand-in"), F.lit("discogs_mir"), F.lit("stand-in"))
    mir = F.create_map(F.lit("vocal_score"), F.format_string("%.6f", "vocal_score"))
    base = routed.where("route_status = 'accepted'").select(
        "audio_id", "audio_path", "source_relpath", "duration", "content_type", "content_confidence", mir.alias("global_mir"), version.alias("model_versions"), F.create_map().cast("map<string,string>").alias("stage_versions")
    )
    cpu, raw = models.cpu(base), models.structure(base)
    parts = [("music_cpu", cpu), ("structure_raw", raw)]
    captions = models.captions(base) if alm else None
    if captions is not None:
        parts.append(("alm", captions))
    split = joins.split_active(base, parts, "audio_id")
    conflicts = joins.path_conflicts(base, "audio_id", "source_relpath").withColumn("clash", F.lit(True))
    split = split.join(conflicts, "audio_id", "left")
    split = materialise(split.withColumns({"failure_stage": F.coalesce("failure_stage", F.when(F.col("clash"), "annotation_path")), "failure": F.coalesce("failure", F.when(F.col("clash"), "path conflict"))}).drop("clash"))
    active = split.where("failure_stage is null").drop("failure_stage", "failure")
    long = raw.join(active.select("audio_id", "duration"), "audio_id").select("audio_id", "duration", F.explode("structure_raw").alias("s")).select("audio_id", "duration", "s.*")
    cleaned = structure.postprocess_sections(long, "audio_id")
    typed = cleaned.join(active.select("audio_id", "content_type"), "audio_id")
    spoken = models.transcripts(typed.where("content_type = 'song'")) if asr else None
    final = materialise(validation.final_sections(typed, spoken, "audio_id", "content_type", asr))
    nested = final.groupBy("audio_id").agg(F.array_sort(F.collect_list(F.struct("start", "end", "section_id", "label", "raw_start", "raw_end", "boundary_confidence", "lyrics", "asr_tokens", "asr_status", "asr_error", "alignment_error"))).alias("sections"))
    texts = aggregates.transcript(final, ["audio_id"], ["start"], "lyrics") if asr else None
    annotations = materialise(validation.assemble(active, "audio_id", None if captions is None else captions.drop("error"), cpu.drop("error"), raw.drop("error"), nested, texts))
    failed = split.where("failure_stage is not null")
    retry = failed.select(
        "audio_id",
        "audio_path",
        "source_relpath",
        "failure_stage",
        F.lit(True).alias("retryable"),
        F.create_map(F.col("failure_stage"), F.lit("error")).alias("stage_status"),
        F.create_map(F.col("failure_stage"), F.col("failure")).alias("stage_errors"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        hashing.fingerprint({c: F.col(c) for c in ("audio_id", "source_relpath", "content_type", "failure_stage")}).alias("semantic_input_fingerprint"),
    )
    return Outcome(annotations, grey.unionByName(unsure), refused.unionByName(invalid), retry, base)


def validate(inventory: DataFrame, outcome: Outcome, alm: bool = True, asr: bool = True) -> DataFrame:
    return validation.violations(inventory, outcome.base, outcome.annotations, outcome.review, outcome.rejected, outcome.retry, alm=alm, asr=asr)

"""Annotation assembly (I7) and the global validator (I8): one violations DataFrame, empty when all is well."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaverlake.functions.paths import annotation_relpath, normal_relpath
from quaverlake.operators.aggregates import partition_membership
from quaverlake.operators.joins import merged_versions
from quaverlake.operators.sequences import contiguity_violations
from quaverlake.plans.vocabulary import BAD_ASR_STATUS, FINAL_STAGES, PIPELINE_VERSION, REMOVED_SECTION_FIELDS, REMOVED_STAGES, REQUIRED_FIELDS, RETRY_FIELDS, SCHEMA_VERSION


def expected_status(content_type: Column, alm: bool = True, asr: bool = True) -> Column:
    """The stage_status map an annotation must have."""
    fixed = {s: F.lit("ok") for s in FINAL_STAGES}
    fixed["alm"] = F.lit("ok" if alm else "not_run")
    fixed["section_asr"] = F.when(content_type == "song", "ok").otherwise("not_run") if asr else F.lit("not_run")
    return F.create_map(*(x for k, v in fixed.items() for x in (F.lit(k), v)))


def same_map(a: Column, b: Column) -> Column:
    return F.array_sort(F.map_entries(a)).eqNullSafe(F.array_sort(F.map_entries(b)))


def final_sections(sections: DataFrame, transcribed: DataFrame | None, key: str, content_type: str, asr: bool = True) -> DataFrame:
    """Sections with their transcription (key, section_id, lyrics, asr_status, ...), defaults filled, removed fields gone."""
    out = sections.drop(*REMOVED_SECTION_FIELDS)
    fields = {"lyrics": "string", "asr_status": "string", "asr_error": "string", "alignment_error": "string", "asr_tokens": "array<struct<text:string,start:double,end:double>>"}
    if transcribed is not None:
        own = [c for c in fields if c in transcribed.columns]
        held = transcribed.select(key, "section_id", *(F.col(c).alias(f"__{c}") for c in own))
        out = out.join(held, [key, "section_id"], "left")
        out = out.withColumns({c: F.coalesce(F.col(f"__{c}"), F.col(c)) if c in out.columns else F.col(f"__{c}") for c in own}).drop(*(f"__{c}" for c in own))
    out = out.withColumns({c: F.lit(None).cast(k) for c, k in fields.items() if c not in out.columns})
    instrumental = F.col(content_type) == "instrumental"
    nothing = F.array().cast(fields["asr_tokens"])
    return out.withColumns(
        {
            "lyrics": F.when(~instrumental, F.col("lyrics")),
            "asr_tokens": F.when(instrumental, nothing).otherwise(F.coalesce("asr_tokens", nothing)),
            "asr_status": F.when(instrumental, "not_applicable").otherwise(F.coalesce("asr_status", F.lit("error" if asr else "not_run"))),
        }
    )


def assemble(base: DataFrame, key: str, alm: DataFrame | None, cpu: DataFrame, structure: DataFrame, sections: DataFrame, asr: DataFrame | None) -> DataFrame:
    """Final annotations. ``base``: accepted tracks with audio_path, source_relpath, duration, content_type,
    content_confidence, global_mir (map), model_versions, stage_versions and, if it was kept, music_gate; ``alm``: ALM_Caption; ``cpu``: chords,
    beatnet, key (strings); ``structure``: structure_raw; ``sections``: nested sections; ``asr``: full_transcript.
    """
    out = base
    for part in (alm, cpu.select(F.col(key), *(F.col(c).alias(f"cpu_{c}") for c in ("chords", "beatnet", "key"))), structure, sections, asr):
        if part is not None:
            out = out.join(part, key, "left")
    enabled = {"alm": alm is not None, "asr": asr is not None}
    kind = F.lower("content_type")
    mir = F.map_concat(F.coalesce("global_mir", F.create_map().cast("map<string,string>")), F.create_map(*(x for c in ("chords", "beatnet", "key") for x in (F.lit(c), F.col(f"cpu_{c}")))))
    versions = F.map_filter(merged_versions(F.col("model_versions"), F.col("stage_versions")), lambda k, v: ~k.isin(REMOVED_STAGES))
    for name in ("alm", "section_asr", "forced_aligner"):
        versions = F.when(F.map_contains_key(versions, name), versions).otherwise(F.map_concat(versions, F.create_map(F.lit(name), F.lit(None).cast("string"))))
    return out.select(
        key,
        "audio_path",
        normal_relpath("source_relpath").alias("source_relpath"),
        F.col("duration").cast("double").alias("duration"),
        F.lit("accepted").alias("status"),
        kind.alias("content_type"),
        "content_confidence",
        F.col("ALM_Caption").alias("global_caption") if enabled["alm"] else F.lit(None).cast("string").alias("global_caption"),
        mir.alias("global_mir"),
        F.col("structure_raw").alias("raw_structure"),
        F.col("full_transcript") if enabled["asr"] else F.lit(None).cast("string").alias("full_transcript"),
        "sections",
        expected_status(kind, enabled["alm"], enabled["asr"]).alias("stage_status"),
        F.create_map(*(x for s in FINAL_STAGES for x in (F.lit(s), F.lit(None).cast("string")))).alias("stage_errors"),
        versions.alias("model_versions"),
        F.lit(PIPELINE_VERSION).alias("pipeline_version"),
        F.lit(SCHEMA_VERSION).alias("annotation_schema_version"),
        *(["music_gate"] if "music_gate" in base.columns else []),
    )


def _stack(rows: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), rows)


def violations(inventory: DataFrame, base: DataFrame, annotations: DataFrame, review: DataFrame, rejected: DataFrame, retry: DataFrame, key: str = "audio_id", alm: bool = True, asr: bool = True) -> DataFrame:
    """(audio_id, rule, detail) of everything wrong with a finished run (rules R1-R15)."""
    found: list[DataFrame] = []
    a = annotations
    rules: list[tuple[DataFrame, list[Column]]] = []

    def rule(name: str, bad: Column, detail: Column | str, rows: DataFrame = a) -> None:
        d = F.lit(detail) if isinstance(detail, str) else detail
        broken = F.when(F.coalesce(bad, F.lit(True)), F.struct(F.lit(name).alias("rule"), d.cast("string").alias("detail")))
        own = next((checks for table, checks in rules if table is rows), None)
        if own is None:
            rules.append((rows, own := []))
        own.append(broken)

    def results() -> DataFrame:
        """One pass over each table, however many rules it has."""
        passes = [t.select(F.col(key).cast("string").alias("audio_id"), F.explode(F.array_compact(F.array(*checks))).alias("v")).select("audio_id", "v.*") for t, checks in rules]
        return _stack(found + passes)

    twice = a.groupBy(key).agg(F.count(F.lit(1)).alias("n"))
    rule("R1", (F.col("n") > 1) | (F.trim(F.col(key).cast("string")) == ""), "id is blank or repeated", twice)
    paths = a.groupBy("source_relpath").agg(F.count(F.lit(1)).alias("n"), F.min(key).alias(key))
    rule("R1", F.col("n") > 1, F.concat(F.lit("path is repeated: "), F.col("source_relpath")), paths)
    if "file_path" in a.columns:
        rule("R1", ~F.col("file_path").endswith(annotation_relpath("source_relpath")), "file is not where its path says")
    placed = partition_membership(inventory, {"annotations": a, "review": review, "rejected": rejected, "retry": retry}, key)
    found.append(placed.select(F.col(key).cast("string").alias("audio_id"), F.lit("R2").alias("rule"), F.concat_ws(" ", "problem", "partitions").alias("detail")))
    done = a.select(key).unionByName(retry.select(key).join(base.select(key), key, "left_semi")).distinct()
    rule("R3", F.lit(True), "base track is neither annotated nor to be retried", base.select(key).join(done, key, "left_anti"))
    rule("R3", F.lit(True), "annotated track is not in the base", a.select(key).join(base.select(key), key, "left_anti"))
    missing = [c for c in REQUIRED_FIELDS if c not in a.columns]
    if missing:
        rule("R4", F.lit(True), "missing fields: " + ", ".join(missing))
        return results()
    wrong = ~(F.col("pipeline_version").eqNullSafe(PIPELINE_VERSION) & F.col("annotation_schema_version").eqNullSafe(SCHEMA_VERSION) & F.col("status").eqNullSafe("accepted"))
    rule("R5", wrong, "version or status")
    b = base.select(F.col(key), *(F.col(c).alias(f"b_{c}") for c in ("content_type", "duration", "audio_path", "source_relpath", "global_mir") if c in base.columns))
    with_base = a.join(b, key)
    for c in ("content_type", "audio_path", "source_relpath"):
        rule("R6", ~F.col(c).eqNullSafe(F.col(f"b_{c}")), f"{c} differs from base", with_base)
    rule("R6", ~F.col("content_type").isin("song", "instrumental"), "content type")
    rule("R6", F.abs(F.col("duration") - F.col("b_duration")) > 1e-6, "duration differs from base", with_base)
    if "music_gate" in a.columns:
        rule("R7", ~F.col("music_gate.decision").eqNullSafe("music"), "gate decision")
    rule("R8", ~same_map(F.col("stage_status"), expected_status(F.col("content_type"), alm, asr)), F.to_json("stage_status"))
    keys = F.array_sort(F.map_keys("stage_errors"))
    rule("R9", ~keys.eqNullSafe(F.array(*(F.lit(s) for s in sorted(FINAL_STAGES)))) | F.exists(F.map_values("stage_errors"), lambda v: v.isNotNull()), F.to_json("stage_errors"))
    lacks = [~F.map_contains_key("model_versions", k) for k in ("alm", "section_asr", "forced_aligner")] + [F.map_contains_key("model_versions", k) for k in REMOVED_STAGES]
    rule("R10", reduce(lambda x, y: x | y, lacks), F.to_json("model_versions"))
    spoken = F.coalesce(F.trim("global_caption"), F.lit("")) != ""
    rule("R11", ~spoken if alm else F.col("global_caption").isNotNull(), "caption")
    for name in ("chords", "beatnet", "key"):
        rule("R12", F.coalesce(F.try_element_at("global_mir", F.lit(name)), F.lit("")) == "", f"{name} is empty")
    if "b_global_mir" in with_base.columns:
        changed = F.exists(F.map_entries("b_global_mir"), lambda e: ~F.try_element_at(F.col("global_mir"), e["key"]).eqNullSafe(e["value"]))
        rule("R12", F.coalesce(changed, F.lit(False)), "base analysis changed", with_base)
    rule("R13", F.size("raw_structure") <= 0, "raw structure is empty")
    rule("R14", F.size("sections") <= 0, "no sections")
    inner = {f.name for f in a.schema["sections"].dataType.elementType.fields}
    if inner & set(REMOVED_SECTION_FIELDS):
        rule("R14", F.lit(True), "removed section fields")
    s = a.select(key, "duration", "content_type", F.explode("sections").alias("s")).select(key, "duration", "content_type", "s.*")
    gaps = contiguity_violations(s, [key])
    rule("R14", F.lit(True), F.concat_ws(" ", "section_id", "problem"), gaps)
    ids = s.groupBy(key, "section_id").agg(F.count(F.lit(1)).alias("n"))
    rule("R14", (F.col("n") > 1) | (F.trim("section_id") == ""), F.concat(F.lit("section id: "), F.col("section_id")), ids)
    status = F.col("asr_status")
    silent = status.eqNullSafe("not_applicable") & F.col("lyrics").isNull()
    sung = status.isNotNull() & ~status.isin(BAD_ASR_STATUS) if asr else status.eqNullSafe("not_run")
    rule("R14", ~F.when(F.col("content_type") == "instrumental", silent).otherwise(sung), F.concat(F.lit("transcription: "), F.coalesce(status, F.lit("none"))), s)
    rule("R14", F.col("asr_tokens").isNull(), "asr_tokens is not a list", s)
    absent = [c for c in RETRY_FIELDS if c not in retry.columns]
    if absent:
        rule("R15", F.lit(True), "missing fields: " + ", ".join(absent), retry)
    else:
        stage = F.col("failure_stage")
        own = F.try_element_at("stage_status", stage)
        rule("R15", ~F.col("retryable"), "retryable", retry)
        rule("R15", stage.isNull() | (stage == "") | own.isNull() | (own == "ok"), "stage or its status", retry)
        rule("R15", F.coalesce(F.try_element_at("stage_errors", stage), F.lit("")) == "", "stage error is missing", retry)
        source = retry.join(inventory.select(key, F.col("audio_path").alias("__path")), key)
        rule("R15", ~F.col("audio_path").eqNullSafe(F.col("__path")), "audio_path differs from inventory", source)
    return results()

"""Predicates and routes (P1-P23) as column expressions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from quaverlake.plans.vocabulary import BAD_ASR_STATUS, INSTRUMENTAL_LABELS, MUSIC_CLASSES, STAGE_ORDER, VOCAL_INSTRUMENTAL, VOCAL_SONG


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def number(c: Column | str) -> Column:
    """Missing numbers count as zero in every score."""
    return F.coalesce(_col(c).cast("double"), F.lit(0.0))


def text(c: Column | str) -> Column:
    """Blank strings count as missing."""
    return F.nullif(F.trim(_col(c)), F.lit(""))


def decide(p: Column | str, reject: float, accept: float) -> Column:
    """accepted / rejected / review by two thresholds."""
    if not 0 <= reject < accept <= 1:
        raise ValueError("thresholds must satisfy 0 <= reject < accept <= 1")
    p = _col(p)
    return F.when(p >= accept, "accepted").when(p <= reject, "rejected").otherwise("review")


def vocal_score(mean: Column | str, coverage: Column | str, longest: Column | str) -> Column:
    steady = F.least(F.lit(1.0), F.greatest(F.lit(0.0), number(longest)) / 30.0)
    return F.round(clip(number(mean) * 0.55 + number(coverage) * 0.30 + steady * 0.15), 6)


def clip(c: Column, low: float = 0.0, high: float = 1.0) -> Column:
    return F.least(F.lit(high), F.greatest(F.lit(low), c))


def _unsure(score: Column) -> Column:
    return F.greatest(F.lit(0.0), 1 - F.abs(score - 0.5) * 2)


def vocal_route(score: Column | str, song: float = VOCAL_SONG, instrumental: float = VOCAL_INSTRUMENTAL) -> Column:
    """struct(status, content_type, confidence) of a vocal score."""
    s = _col(score)
    row = lambda status, kind, conf: F.struct(F.lit(status).alias("status"), F.lit(kind).alias("content_type"), conf.cast("double").alias("confidence"))
    return F.when(s >= song, row("accepted", "song", s)).when(s <= instrumental, row("accepted", "instrumental", 1 - s)).otherwise(row("review", "unknown", _unsure(s)))


def track_route(music: Column, singing: Column, speech: Column, mean: Column, coverage: Column, longest: Column, has_voice: Column | None = None, keep: float = 0.60, reject: float = 0.30, song: float = 0.55, instrumental: float = 0.20) -> Column:
    """The combined route over gate and voice scores: struct(status, content_type, confidence)."""
    music, singing, speech = number(music), number(singing), number(speech)
    steady = F.least(F.lit(1.0), F.greatest(F.lit(0.0), number(longest)) / 30.0)
    vocal = clip(number(mean) * 0.50 + number(coverage) * 0.20 + singing * 0.15 + steady * 0.15)
    row = lambda status, kind, conf: F.struct(F.lit(status).alias("status"), F.lit(kind).alias("content_type"), conf.cast("double").alias("confidence"))
    heard = F.lit(True) if has_voice is None else has_voice
    return (
        F.when(music <= reject, row("rejected", "unknown", 1 - music))
        .when(music < keep, row("review", "unknown", 1 - F.abs(music - 0.5) * 2))
        .when(~heard, row("review", "unknown", music))
        .when((speech >= 0.65) & (speech >= singing + 0.25), row("review", "unknown", F.least(F.lit(1.0), speech)))
        .when(vocal >= song, row("accepted", "song", vocal))
        .when(vocal <= instrumental, row("accepted", "instrumental", 1 - vocal))
        .otherwise(row("review", "unknown", 1 - F.abs(vocal - 0.5) * 2))
    )


def gate_outcome(decision: Column | str) -> Column:
    """struct(decision, status, content_type, partition, reason) of a gate decision."""
    d = _col(decision)
    row = lambda *v: F.struct(*(F.lit(x).alias(n) for x, n in zip(v, ("decision", "status", "content_type", "partition", "reason"), strict=True)))
    return F.when(d == "accepted", row("music", "accepted", "music", "accepted.music", "fast_gate_music")).when(d == "rejected", row("non_music", "rejected", "non_music", "rejected", "fast_gate_non_music")).otherwise(row("review", "review", "unknown", "review", "fast_gate_gray_zone"))


def add_reason(reasons: Column | str, reason: Column | str) -> Column:
    """Append a reason code unless it is there."""
    return F.array_union(F.coalesce(_col(reasons), F.array().cast("array<string>")), F.array(_col(reason)))


def undecodable(decode_status: Column | str) -> Column:
    """True for assets that no model may see."""
    return F.coalesce(_col(decode_status), F.lit("ok")) != "ok"


def invalid_asset() -> Column:
    return F.struct(*(F.lit(v).alias(n) for n, v in (("decision", "invalid_asset"), ("status", "rejected"), ("content_type", "invalid_asset"), ("stage_status", "skipped_invalid_asset"), ("reason", "inventory_decode_failed"))))


def failed(stage_status: Column | str, stage_errors: Column | str, stage: str, error: Column | str) -> tuple[Column, Column]:
    """(stage_status, stage_errors) with ``stage`` marked as failed."""
    status = F.map_concat(F.coalesce(_col(stage_status), F.create_map().cast("map<string,string>")), F.create_map(F.lit(stage), F.lit("error")))
    errors = F.map_concat(F.coalesce(_col(stage_errors), F.create_map().cast("map<string,string>")), F.create_map(F.lit(stage), _col(error)))
    return status, errors


def output_partition(stage: str, status: Column | str, content_type: Column | str, decision: Column | str | None = None) -> Column:
    """Which output of a stage a record belongs to; what fits none is a failure."""
    s, kind = _col(status), F.lower(_col(content_type))
    ok = F.lit(True) if decision is None else F.coalesce(_col(decision) != "error", F.lit(True))
    if stage == "fast_gate":
        return F.when(ok & (s == "accepted"), "accepted.music").when(ok & (s == "review"), "review").when(ok & (s == "rejected"), "rejected").otherwise("failures")
    if stage == "discogs_mir":
        return F.when(ok & (s == "accepted") & (kind == "song"), "accepted.song").when(ok & (s == "accepted") & (kind == "instrumental"), "accepted.instrumental").when(ok & (s == "review"), "review").otherwise("failures")
    return F.when(ok & (s == "ok"), "results").otherwise("failures")


def stage_status(statuses: Column | str, stage: str) -> Column:
    """A stage's status; structure results of an older name count, and none is an error."""
    m = _col(statuses)
    found = text(F.try_element_at(m, F.lit(stage)))
    if stage == "structure_raw":
        found = F.coalesce(found, text(F.try_element_at(m, F.lit("structure"))))
    return F.coalesce(found, F.lit("error"))


def stage_error(stage: str, statuses: Column | str, errors: Column | str, payload_problem: Column | None = None, content_type: Column | None = None, error: Column | None = None) -> Column:
    """Why a record's stage is unacceptable, or null. ``payload_problem`` is null for a complete payload."""
    status = stage_status(statuses, stage)
    detail = F.try_element_at(_col(errors), F.lit(stage))
    if stage == "structure_raw":
        detail = F.coalesce(detail, F.try_element_at(_col(errors), F.lit("structure")))
    why = F.coalesce(text(detail), *([text(error)] if error is not None else []), status)
    problem = payload_problem if payload_problem is not None else F.lit(None).cast("string")
    found = F.when(status != "ok", why).otherwise(problem)
    if stage == "section_asr" and content_type is not None:
        found = F.when((F.lower(content_type) == "instrumental") & (status == "not_run"), F.lit(None).cast("string")).otherwise(found)
    return found


def incomplete_sections(sections: Column | str) -> Column:
    """Payload problem of a transcription: no sections, or one with an unfinished status."""
    s = _col(sections)
    bad = F.exists(s, lambda x: x["asr_status"].isNull() | x["asr_status"].isin(BAD_ASR_STATUS))
    return F.when(F.coalesce(F.size(s), F.lit(0)) <= 0, "incomplete_section_asr").when(bad, "incomplete_section_asr")


def failure_stage(explicit: Column | str, statuses: Column | str, discogs_error: Column | None = None, gate_error: Column | None = None) -> Column:
    """The stage a retry belongs to: named, else the first in stage order that is not fine."""
    m = _col(statuses)

    def bad(stage: str) -> Column:
        s = F.try_element_at(m, F.lit(stage))
        if stage == "structure_raw":
            s = F.coalesce(s, F.try_element_at(m, F.lit("structure")))
        return F.when(s.isNotNull() & ~s.isin("ok", "accepted", "review", "rejected"), F.lit(stage))

    tail = [F.when(text(e).isNotNull(), F.lit(n)) for e, n in ((discogs_error, "discogs_mir"), (gate_error, "music_gate")) if e is not None]
    return F.coalesce(text(explicit), *(bad(s) for s in STAGE_ORDER), *tail, F.lit("metadata_merge"))


def asr_eligible(label: Column | str, voice_coverage: Column | str, low: float = 0.03) -> Column:
    """struct(run, reason)."""
    name = F.lower(F.trim(F.coalesce(_col(label), F.lit(""))))
    row = lambda run, why: F.struct(F.lit(run).alias("run"), F.lit(why).alias("reason"))
    return F.when(name == "silence", row(False, "silence")).when(name.isin(INSTRUMENTAL_LABELS) & (number(voice_coverage) < low), row(False, "low_voice_instrumental_section")).otherwise(row(True, "eligible"))


def duration_bucket(seconds: Column | str) -> Column:
    s = _col(seconds)
    return F.when(s <= 15, "8-15").when(s <= 30, "15-30").when(s <= 60, "30-60").otherwise("60+")


def gate_terminal(status: Column | str) -> Column:
    """The final partition the gate alone decides, or null to go on."""
    return F.when(_col(status).isin("review", "rejected"), _col(status))


def accepted_route(status: Column | str, content_type: Column | str) -> Column:
    kind = F.lower(_col(content_type))
    return F.when((_col(status) == "accepted") & kind.isin("song", "instrumental"), kind)


def accepted_music_problem(status: Column | str, content_type: Column | str, decision: Column | str) -> Column:
    """Why a record may not be routed, or null."""
    return F.when(~_col(status).eqNullSafe("accepted"), "not accepted").when(~_col(content_type).eqNullSafe("music"), "content type is not music").when(~_col(decision).eqNullSafe("music"), "gate decision is not music")


def reusable(status: Column | str, fingerprint: Column | str, wanted: Column | str, identity: list[tuple[Column, Column]] = ()) -> Column:
    """A cached result stands: fine, and made from the same input, else the same identity."""
    same = reduce(lambda a, b: a & b, (a.eqNullSafe(b) for a, b in identity), F.lit(bool(identity)))
    have = text(fingerprint)
    return (_col(status) == "ok") & F.when(have.isNotNull(), have == _col(wanted)).otherwise(same)


def drop_section_fields(sections: Column | str, fields: list[str]) -> Column:
    return F.transform(_col(sections), lambda s: s.dropFields(*fields))


def instrumental_sections(sections: Column | str, token_type: str = "array<struct<text:string,start:double,end:double>>") -> Column:
    """Sections of an instrumental: no lyrics, no tokens, transcription not applicable."""
    return F.transform(_col(sections), lambda s: s.withField("lyrics", F.lit(None).cast("string")).withField("asr_tokens", F.array().cast(token_type)).withField("asr_status", F.lit("not_applicable")))


def nested_errors(m: Column | str) -> Column:
    """Names of the ``*_error`` entries that hold something."""
    return F.array_sort(F.map_keys(F.map_filter(_col(m), lambda k, v: k.endswith("_error") & text(v).isNotNull())))


def surfaced_status(m: Column | str) -> Column:
    return F.when(F.size(nested_errors(m)) > 0, "partial_error").otherwise("ok")


def real_chords(chords: Column | str) -> Column:
    return F.filter(_col(chords), lambda c: ~c["chord"].eqNullSafe("N"))


def downbeats(beats: Column | str) -> Column:
    """Sorted distinct times of the first beats of bars."""
    first = F.filter(_col(beats), lambda b: (b["beat"] == 1) & b["timestamp"].isNotNull())
    return F.array_sort(F.array_distinct(F.transform(first, lambda b: b["timestamp"].cast("double"))))


def paired_beats(pairs: Column | str) -> Column:
    """Beats given as (time, number) pairs in the form ``downbeats`` reads; shorter ones go."""
    whole = F.filter(_col(pairs), lambda p: F.size(p) >= 2)
    return F.transform(whole, lambda p: F.struct(F.element_at(p, 1).alias("timestamp"), F.element_at(p, 2).alias("beat")))


def first_filled(*arrays: Column | str) -> Column:
    """The first array that holds anything: sources in the order of their precedence."""
    return F.coalesce(*(F.when(F.size(_col(a)) > 0, _col(a)) for a in arrays))


def split_known(fields: Column | str, known: list[str]) -> tuple[Column, Column]:
    """(known, extra) parts of a map of fields."""
    m = _col(fields)
    return F.map_filter(m, lambda k, v: k.isin(known)), F.map_filter(m, lambda k, v: ~k.isin(known))


def joined_fields(known: Column | str, extra: Column | str, left_out: tuple[str, ...] = ("audio_bytes",)) -> Column:
    """One map again: known fields without nulls and raw bytes, extra ones as they came."""
    kept = F.map_filter(_col(known), lambda k, v: v.isNotNull() & ~k.isin(*left_out))
    return F.map_concat(kept, F.coalesce(_col(extra), F.map_filter(kept, lambda k, v: F.lit(False))))


def music_score(probabilities: Column | str, classes: list[int] = MUSIC_CLASSES) -> Column:
    """Largest probability of the music classes; anything but probabilities is an error."""
    p = _col(probabilities)
    best = F.array_max(F.array(*(F.try_element_at(p, F.lit(i + 1)) for i in classes)))
    sane = F.forall(p, lambda x: x.isNotNull() & ~F.isnan(x) & (x >= 0) & (x <= 1))
    return F.when(sane, best).otherwise(F.raise_error(F.lit("probabilities must lie in [0, 1]")).cast("double"))


def gate_constraints(metrics: dict[str, float], support: dict[str, int], recall: float = 0.99, false_accept: float = 0.02, review: float = 0.05, least: int = 10) -> list[str]:
    """What of a calibrated gate's metrics is out of bounds (driver-side configuration check)."""
    found = []
    if not metrics.get("song_recall", 0.0) >= recall:
        found.append("song_recall")
    if not metrics.get("nonmusic_false_accept_rate", 1.0) <= false_accept:
        found.append("nonmusic_false_accept_rate")
    if not metrics.get("review_rate", 1.0) <= review:
        found.append("review_rate")
    return found + sorted(k for k, n in support.items() if n < least)

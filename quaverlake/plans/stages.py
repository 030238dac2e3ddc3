"""Model stages as pluggable functions (UDF surface). Defaults are deterministic stand-ins.

A stage maps a DataFrame of tracks to one with its payload columns plus ``error``.
Stand-ins derive numbers from the id alone, so runs repeat and need no weights.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

Stage = Callable[[DataFrame], DataFrame]


def _share(key: str, salt: str) -> Column:
    return F.pmod(F.xxhash64(F.lit(salt), key), F.lit(10_000)) / 10_000.0


def gate_a(df: DataFrame) -> DataFrame:
    """Window probabilities at the first offsets."""
    return df.withColumn("stage_a", F.transform(F.array(*(F.lit(i) for i in range(3))), lambda i: F.pmod(F.xxhash64(F.lit("gate"), "audio_id", i), F.lit(1000)) / 1000.0))


def gate_b(df: DataFrame) -> DataFrame:
    return df.withColumn("stage_b", F.transform(F.array(*(F.lit(i) for i in range(5))), lambda i: F.pmod(F.xxhash64(F.lit("gate"), "audio_id", i), F.lit(1000)) / 1000.0))


def voice(df: DataFrame) -> DataFrame:
    """Voice probabilities per frame of a track."""
    n = F.greatest(F.floor(F.col("duration")), F.lit(1.0)).cast("int")
    level = _share("audio_id", "voice")
    return df.withColumn("probabilities", F.transform(F.sequence(F.lit(1), n), lambda i: F.least(F.lit(1.0), level + F.pmod(F.xxhash64("audio_id", i), F.lit(100)) / 500.0)))


def cpu(df: DataFrame) -> DataFrame:
    return df.select("audio_id", F.lit("C,G,Am,F").alias("chords"), F.format_string("%.1f", 80 + _share("audio_id", "bpm") * 80).alias("beatnet"), F.lit("C major").alias("key"), F.when(_share("audio_id", "cpu") < 0.02, "analysis failed").alias("error"))


def structure(df: DataFrame) -> DataFrame:
    """Raw sections of about twenty seconds."""
    n = F.greatest(F.floor(F.col("duration") / 20), F.lit(1.0)).cast("int")
    label = lambda i: F.element_at(F.array(F.lit("intro"), F.lit("verse"), F.lit("chorus"), F.lit("outro")), (F.pmod(i, F.lit(4)) + 1).cast("int"))
    section = lambda i: F.struct(label(i).alias("label"), (i * 20.0).alias("raw_start"), F.when(i == n - 1, F.col("duration")).otherwise((i + 1) * 20.0).alias("raw_end"), (F.pmod(F.xxhash64("audio_id", i), F.lit(100)) / 100.0).alias("boundary_confidence"))
    return df.select("audio_id", F.transform(F.sequence(F.lit(0), n - 1), section).alias("structure_raw"), F.lit(None).cast("string").alias("error"))


def captions(df: DataFrame) -> DataFrame:
    return df.select("audio_id", F.concat(F.lit("A "), F.col("content_type"), F.lit(" track.")).alias("ALM_Caption"), F.when(_share("audio_id", "alm") < 0.02, "empty_alm_caption").alias("error"))


def transcripts(sections: DataFrame) -> DataFrame:
    """Lyrics per (audio_id, section_id)."""
    return sections.select("audio_id", "section_id", F.concat(F.lit("la "), F.col("label")).alias("lyrics"), F.lit("ok").alias("asr_status"))


@dataclass(frozen=True)
class Models:
    gate_a: Stage = gate_a
    gate_b: Stage = gate_b
    voice: Stage = voice
    cpu: Stage = cpu
    structure: Stage = structure
    captions: Stage = captions
    transcripts: Stage = transcripts

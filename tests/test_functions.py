"""Column functions on literal cases."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from quaverlake.functions import hashing, paths, routing, values
from quaverlake.operators import sequences as S


def one(spark, *columns):
    return spark.range(1).select(*(c.alias(f"c{i}") for i, c in enumerate(columns))).first()


def test_window_ranges(spark):
    r = one(spark, *(S.window_ranges(F.lit(x)) for x in (0.0, 1.0, 10.0, 21.5, 22.0)))
    got = [[(w["start"], w["end"]) for w in c] for c in r]
    assert got == [[], [(0, 1)], [(0, 10)], [(0, 10), (10, 21.5)], [(0, 10), (10, 20), (20, 22)]]


def test_offsets(spark):
    r = one(spark, S.sample_offsets(F.lit(100.0), [0.1, 0.5, 0.9]), S.sample_offsets(F.lit(100.0), [0.05, 0.25, 0.5, 0.75, 0.95]), S.sample_offsets(F.lit(8.0), [0.1, 0.9]))
    assert list(r) == [[9.2, 46.0, 82.8], [4.6, 23.0, 46.0, 69.0, 87.4], [0.0, 0.0]]


def test_scorer_and_decide(spark):
    tags = [[0.0] * 527 for _ in range(4)]
    for row, (i, p) in zip(tags, ((137, 0.8), (27, 0.7), (266, 0.9), (140, 0.95)), strict=True):
        row[i] = p
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(tags)], "i int, p array<double>").select("i", routing.music_score("p").alias("s")).orderBy("i").collect()
    assert [r["s"] for r in rows] == [0.8, 0.7, 0.9, 0.0]
    r = one(spark, *(routing.decide(F.lit(p), 0.2, 0.8) for p in (0.8, 0.2, 0.5)))
    assert list(r) == ["accepted", "rejected", "review"]
    with pytest.raises(ValueError):
        routing.decide(F.lit(0.5), 0.8, 0.2)


def test_vocal_score(spark):
    score = lambda *v: routing.vocal_score(*(F.lit(x) for x in v))
    r = one(spark, score(1.0, 1.0, 30.0), score(0.3333333, 0.3333333, 9.999999), routing.vocal_route(score(0.5, 0.3, 0.0)), routing.vocal_route(F.lit(0.55)), routing.vocal_route(F.lit(0.2)))
    assert (r[0], r[1]) == (1.0, 0.333333)
    assert (r[2]["status"], r[3]["content_type"], r[4]["content_type"], r[4]["confidence"]) == ("review", "song", "instrumental", 0.8)


def test_track_route(spark):
    route = lambda music, singing, speech, mean=0.9, cover=0.9, longest=30.0: routing.track_route(*(F.lit(x) for x in (music, singing, speech, mean, cover, longest)))
    r = one(spark, route(0.3, 0.0, 0.0), route(0.5, 0.0, 0.0), route(0.9, 0.1, 0.85), route(0.9, 0.8, 0.7), route(0.9, 0.0, 0.0, 0.0, 0.0, 0.0))
    assert [(x["status"], x["content_type"]) for x in r] == [("rejected", "unknown"), ("review", "unknown"), ("review", "unknown"), ("accepted", "song"), ("accepted", "instrumental")]


def test_asr_rules(spark):
    r = one(spark, routing.asr_eligible(F.lit("solo"), F.lit(0.0)), routing.asr_eligible(F.lit(" Silence"), F.lit(1.0)), routing.asr_eligible(F.lit("verse"), F.lit(None).cast("double")))
    assert [x["run"] for x in r] == [False, False, True]


def test_stage_error(spark):
    m = lambda *kv: F.create_map(*(F.lit(x) for x in kv))
    none = F.create_map().cast("map<string,string>")
    r = one(
        spark,
        routing.stage_error("alm", m("alm", "ok"), none),
        routing.stage_error("structure_raw", m("structure", "ok"), none),
        routing.stage_error("alm", m("alm", "error"), m("alm", "boom")),
        routing.stage_error("alm", none, none),
        routing.stage_error("section_asr", m("section_asr", "not_run"), none, content_type=F.lit("Instrumental")),
        routing.failure_stage(F.lit(" "), m("music_gate", "ok", "structure", "error", "alm", "error")),
        routing.failure_stage(F.lit(None).cast("string"), none),
    )
    assert list(r) == [None, None, "boom", "error", None, "structure_raw", "metadata_merge"]


def test_hashing(spark):
    expected = hashlib.sha256(b"job\x00a\x00alm\x00fp").hexdigest()
    r = one(spark, hashing.request_id(F.lit("job"), F.lit("a"), F.lit("alm"), F.lit("fp")), hashing.canonical({"b": F.lit(1), "a": F.lit(None).cast("string")}))
    assert list(r) == [expected, '{"a":null,"b":1}']


@pytest.mark.parametrize(("path", "expected"), [("中文 目录/歌曲(现场).mp3", "中文 目录/歌曲(现场).mp3"), ("./a//b", "a/b"), ("../outside.mp3", None), ("/abs", None), ("", None), (None, None), ("a\x00b", None)])
def test_relpath(spark, path, expected):
    df = spark.createDataFrame([(path,)], "p string")
    assert df.select(paths.normal_relpath("p").alias("p")).first()["p"] == expected


def test_output_name_is_cut_at_a_character(spark):
    name = "歌" * 120
    got = spark.createDataFrame([(f"x/{name}",), ("y/s",)], "p string").select(paths.annotation_relpath("p").alias("o")).collect()
    long = got[0]["o"].removeprefix("x/")
    assert len(long.encode()) <= 255 and long.endswith(f"__p{hashlib.sha1(name.encode()).hexdigest()[:10]}.json") and long.startswith("歌")
    assert got[1]["o"] == "y/s.json"


def test_elapsed_and_rates(spark):
    r = one(spark, values.elapsed(F.lit(3661.2344)), values.rate(F.lit(20), F.lit(5.0)), values.seconds_per_item(F.lit(20), F.lit(5.0)), values.rate(F.lit(0), F.lit(5.0)))
    assert list(r) == ["01:01:01.234", 4.0, 0.25, None]


def test_caption(spark):
    bodies = ['{"choices":[{"finish_reason":"stop","message":{"content":" hi "}}]}', '{"choices":[{"finish_reason":"length","message":{"content":"x"}}]}', '{"choices":[]}', "broken", '{"choices":[{"message":{"content":"  "}}]}']
    got = spark.createDataFrame([(i, b) for i, b in enumerate(bodies)], "i int, b string").select("i", values.caption("b").alias("c")).orderBy("i").collect()
    assert [(r["c"]["caption"], r["c"]["error"]) for r in got] == [("hi", None), (None, "answer was cut short"), (None, "no choices"), (None, "no choices"), (None, "empty caption")]


def test_typed_overrides():
    assert values.typed(3, "4") == 4 and values.typed(True, "no") is False and values.typed(0.5, "1") == 1.0 and values.typed(["a"], "b, c") == ["b", "c"]
    assert values.find_classes({"x": [{"classes": ["a", "b"]}]}) == ["a", "b"]


def test_alphabet(spark):
    r = one(spark, *(S.alphabet_label(F.lit(i)) for i in (0, 25, 26, 51, 52, 701, 702)))
    assert list(r) == ["A", "Z", "AA", "AZ", "BA", "ZZ", "AAA"]


def test_canonical_json_against_the_standard_library(spark):
    numbers = [0.0, -0.0, 1.0, 0.1, 12.5, 0.0001, 0.00012345, 1e-5, 1.25e-7, -3.5e-9, 1e7, 12345678.25, -1e7, 1.5e15, 123456789012345.6, 1e16, 1.25e22, 1e100, 2e23, 2.0e-3, 0.001, 9999999.5, 1e-300, 2.0**53, None]
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(numbers)], "i long, v double")
    for r in rows.select("v", hashing.json_float("v").alias("s")).collect():
        assert r["s"] == (None if r["v"] is None else json.dumps(r["v"])), r
    sections = [("0001", 1 / 3, 20.1234567, "verse", 0.25), ("0002", 20.1234567, None, None, None)]
    for name, part in (("a\"b", sections), (None, [])):
        df = spark.createDataFrame([(name, part)], "k string, s array<struct<section_id:string,start:double,end:double,label:string,voice_coverage:double>>")
        fields = ("section_id", "start", "end", "label", "voice_coverage")
        plan = [dict(zip(fields, x, strict=True)) for x in part]
        for x in plan:
            x["start"], x["end"] = round(x["start"] or 0.0, 6), round(x["end"] or 0.0, 6)
        text = json.dumps({"audio_id": name or "", "content_type": "song", "sections": plan}, ensure_ascii=False, sort_keys=True, separators=(",", ":"))
        assert df.select(hashing.sections_hash(F.col("k"), F.lit("song"), "s")).first()[0] == hashlib.sha256(text.encode()).hexdigest()


def test_stage_record(spark):
    rows = spark.createDataFrame([("a", 10.0, 14.0, 8), ("b", 5.0, 4.0, -1)], "s string, b double, e double, n long")
    got = [tuple(r["r"]) for r in rows.select(values.stage_record("s", "b", "e", "n").alias("r")).collect()]
    assert got == [("a", 10.0, 14.0, 4.0, 8, 0.5, 2.0), ("b", 5.0, 4.0, 0.0, 0, None, None)]


def test_require_relpath_from(spark):
    assert spark.range(1).select(paths.require_relpath_from(F.lit("/in/a/b.wav"), "/in/").alias("p")).first()["p"] == "a/b.wav"
    for bad in (F.lit("/else/b.wav"), F.lit(None).cast("string")):
        with pytest.raises(Exception, match="outside the input root"):
            spark.range(1).select(paths.require_relpath_from(bad, "/in")).collect()


def test_json_float_formats_each_number_once(spark):
    rng = random.Random(5)
    numbers = [rng.choice([-1, 1]) * rng.randrange(10**k) / 10**p for k in (1, 3, 7, 12, 15) for p in range(9) for _ in range(12)]
    numbers += [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-12, 16) for _ in range(400)] + [99e-6, 1e-4, 101e-6, 999999999.999999, 1e9, 0.1 + 0.2, 1.0000001, 5e-7, 2.5e-6]
    rows = spark.createDataFrame([(v,) for v in numbers], "v double").select("v", hashing.json_float("v").alias("s"))
    assert all(r["s"] == json.dumps(r["v"]) for r in rows.collect())
    # a form for 15, 16 and 17 digits each; nothing is worked out again for every part of the text
    assert rows._jdf.queryExecution().analyzed().toString().count("format_string(") <= 3

"""Sources, sinks, the batch run, its validator and streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaverlake.plans import batch
from quaverlake.queries.state import batch_inventory
from quaverlake.sources import readers, sinks
from quaverlake.streaming import streams
from quaverlake.streaming.machine import Item, request_id

SCHEMA = StructType().add("audio_id", "string").add("v", "integer")


def test_truncated_tail(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"audio_id":"ok","v":1}\n\n{"audio_id":"x","v":2}\n{"audio_id":')
    got = readers.read_jsonl_recovering(spark, str(tmp_path / "a.jsonl"), SCHEMA)
    assert [(r["audio_id"], r["v"]) for r in got.orderBy("ordinal").collect()] == [("ok", 1), ("x", 2)]
    (tmp_path / "b.jsonl").write_text('{"audio_id":\n{"audio_id":"x","v":2}\n')
    with pytest.raises(Exception, match="bad JSON line"):
        readers.read_jsonl_recovering(spark, str(tmp_path / "b.jsonl"), SCHEMA).collect()


def test_strict_and_lenient(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text('{"audio_id":"ok","v":1}\nnonsense\n')
    assert readers.read_jsonl_lenient(spark, str(tmp_path), SCHEMA).count() == 1
    with pytest.raises(Exception):
        readers.read_jsonl(spark, str(tmp_path), SCHEMA).collect()


def test_strict_lines_are_objects(spark, tmp_path):
    (tmp_path / "a.jsonl").write_text(' {"audio_id":"ok","v":1}\n\n \t\n{"audio_id":"x"}\n')
    assert sorted(r["audio_id"] for r in readers.read_jsonl(spark, str(tmp_path / "a.jsonl"), SCHEMA).collect()) == ["ok", "x"]
    for bad in ('[{"v":1},{"v":2}]', "7", "null"):
        (tmp_path / "b.jsonl").write_text('{"audio_id":"ok","v":1}\n' + bad + "\n")
        with pytest.raises(Exception, match="no JSON object"):
            readers.read_jsonl(spark, str(tmp_path / "b.jsonl"), SCHEMA).collect()


def test_items_keep_physical_lines(spark, tmp_path):
    lines = {"a.jsonl": ['{"url":"u0"}', "", "broken", '{"path":"p3"}', '{"v":4}'], "b.jsonl": [f'{{"file":"f{i}"}}' if i % 3 else "" for i in range(400)]}
    for name, body in lines.items():
        (tmp_path / name).write_text("\n".join(body) + "\n")
    schema = StructType().add("url", "string").add("path", "string").add("file", "string").add("v", "integer")
    size = "spark.sql.files.maxPartitionBytes"
    old = spark.conf.get(size)
    spark.conf.set(size, "700")  # several splits a file
    try:
        got = sorted((r["file_path"].rsplit("/", 1)[1], r["line"], r["item_path"]) for r in readers.read_items(spark, str(tmp_path), schema).collect())
        splits = spark.read.text(str(tmp_path)).rdd.getNumPartitions()
    finally:
        spark.conf.set(size, old)
    assert splits > 3
    assert got == [("a.jsonl", 0, "u0"), ("a.jsonl", 3, "p3")] + [("b.jsonl", i, f"f{i}") for i in range(400) if i % 3]


def test_shard_files(spark, tmp_path):
    for name in ("segment_01.jsonl", "segment_00.jsonl", "other.jsonl", "segment_02.txt"):
        (tmp_path / name).write_text("{}\n")
    assert [p.rsplit("/", 1)[1] for p in readers.shard_files(spark, str(tmp_path))] == ["segment_00.jsonl", "segment_01.jsonl"]
    assert readers.shard_files(spark, str(tmp_path / "none")) == []


def test_media_scan_and_inventory(spark, tmp_path):
    for name, body in (("a/x.MP3", b"1"), ("b.wav", b"1"), ("c.txt", b"2"), ("d.mkv", b"3")):
        (tmp_path / name).parent.mkdir(exist_ok=True)
        (tmp_path / name).write_bytes(body)
    media = readers.scan_media(spark, str(tmp_path))
    rows = {r["source_relpath"]: r for r in readers.inventory(media, lambda p: None if p.endswith("mkv") else 2.5).collect()}
    assert sorted(rows) == ["a/x.MP3", "b.wav", "d.mkv"] and rows["a/x.MP3"]["audio_id"] == rows["b.wav"]["audio_id"]
    assert rows["d.mkv"]["decode_status"] == "failed" and rows["b.wav"]["duration"] == 2.5


def test_rank_paths():
    paths = [f"p{i:02d}" for i in range(11)]
    parts = [readers.rank_paths(paths, r, 4) for r in range(4)]
    assert [len(p) for p in parts] == [3, 3, 3, 2] and sum(parts, []) == paths


def test_inference_falls_back_to_items(spark):
    def call(payloads):
        if any(p["v"] == 3 for p in payloads):
            raise RuntimeError("bad item")
        return [{"request_id": p["request_id"], "result": str(p["v"] * 2)} for p in payloads]

    requests = spark.createDataFrame([(f"r{i}", i) for i in range(6)], "request_id string, v int")
    got = {r["v"]: (r["result"], r["error"]) for r in readers.infer(requests, readers.InferenceClient(call, batch=4), ["v"]).collect()}
    assert got[2] == ("4", None) and got[3][0] is None and "bad item" in got[3][1]


def test_routes_write_empty_partitions(spark, tmp_path):
    df = spark.createDataFrame([("a", "review")], "id string, route string")
    sinks.write_routes(df, str(tmp_path), "route", ["review", "rejected"])
    assert (tmp_path / "rejected.jsonl").is_dir() and spark.read.schema("id string").json(str(tmp_path / "rejected.jsonl")).count() == 0


def test_publish_swaps_the_tree(spark, tmp_path):
    rows = lambda *v: spark.createDataFrame([(x, f"d/{x}.wav", "song") for x in v], "audio_id string, source_relpath string, content_type string")
    folder = str(tmp_path / "annotations")
    assert sinks.publish(rows("a", "b"), folder) == {"total": 2, "song": 2}
    sinks.publish(rows("c"), folder)
    assert [p.name for p in (tmp_path / "annotations/d").iterdir() if p.suffix == ".json"] == ["c.wav.json"]
    assert readers.find_annotation(spark, folder, "d/c.wav").first()["audio_id"] == "c"
    with pytest.raises(ValueError):
        sinks.publish(rows("x", "x"), folder)
    assert json.loads((tmp_path / "annotations/d/c.wav.json").read_text())["audio_id"] == "c"


def test_merge_results_keeps_latest(spark, tmp_path):
    path = str(tmp_path / "r")
    df = lambda *v: spark.createDataFrame(list(v), "k string, v double")
    sinks.merge_results(spark, df(("a", 1.0), ("b", 2.0)), path, "k")
    sinks.merge_results(spark, df(("b", 3.0)), path, "k")
    assert sorted((r["k"], r["v"]) for r in spark.read.parquet(path).collect()) == [("a", 1.0), ("b", 3.0)]
    with pytest.raises(Exception, match="finite"):
        sinks.merge_results(spark, df(("c", float("nan"))), path, "k")


@pytest.fixture(scope="module")
def finished(spark, data):
    from quaverlake.session import configure

    configure(spark)
    inventory = batch_inventory(spark, data).cache()
    out = batch.run(inventory)
    return inventory, batch.Outcome(*(getattr(out, n).cache() for n in ("annotations", "review", "rejected", "retry", "base")))


def test_batch_run_is_valid(finished):
    inventory, out = finished
    sizes = [getattr(out, n).count() for n in ("annotations", "review", "rejected", "retry")]
    assert sum(sizes) == inventory.count() and sizes[0] > 0
    assert batch.validate(inventory, out).count() == 0


@pytest.mark.parametrize(
    ("rule", "change"),
    [
        ("R5", lambda a: a.withColumn("pipeline_version", F.lit("old"))),
        ("R6", lambda a: a.withColumn("duration", F.col("duration") + 1)),
        ("R9", lambda a: a.withColumn("stage_errors", F.create_map(F.lit("alm"), F.lit("x")))),
        ("R11", lambda a: a.withColumn("global_caption", F.lit(" "))),
        ("R13", lambda a: a.withColumn("raw_structure", F.slice("raw_structure", 1, 0))),
        ("R2", lambda a: a.limit(1)),
    ],
)
def test_tampering_is_found(finished, rule, change):
    from dataclasses import replace

    inventory, out = finished
    found = batch.validate(inventory, replace(out, annotations=change(out.annotations)))
    assert rule in {r["rule"] for r in found.select("rule").distinct().collect()}


def test_machine_runs_a_song():
    item = Item("job", "a")
    assert item.register("fp") is None and item.register("fp") == "duplicate id" and item.register("other") == "input changed"
    steps = []
    results = {"music_gate": "music", "discogs_mir": "song"}
    while stages := item.ready():
        for stage in stages:
            steps.append(stage)
            assert item.prepare(stage, "fp") is None and item.claim(stage, "fp") is None
            assert item.settle(stage, request_id("job", "a", stage, "fp"), results.get(stage, "ok"), None) is None
    assert steps == ["music_gate", "discogs_mir", "music_cpu", "structure_raw", "alm", "section_asr"]
    assert item.publish() is None and item.status == "published" and item.unpublish() is None


def test_machine_refuses_and_recovers():
    item = Item("job", "a")
    item.prepare("music_gate", "fp")
    assert item.prepare("music_gate", "new") == "stage input changed"
    assert item.claim("music_gate", "new") and item.claim("music_gate", "fp") is None and item.claim("music_gate", "fp")
    before = item.stages["music_gate"].request
    assert item.recover() == 1 and item.claim("music_gate", "fp") is None
    assert item.stages["music_gate"].attempt == 2 and item.stages["music_gate"].request == before
    assert item.settle("music_gate", "other", "music", None) == "not running this request"
    item.settle("music_gate", before, "rejected", None)
    assert item.status == "rejected" and item.ready() == []
    assert Item.load(item.dump()) == item


def test_stream_equals_table(spark, data):
    from quaverlake.queries.state import stage_machine, stage_stream

    columns = ["audio_id", "seq", "accepted", "attempt", "ready"]
    a = sorted(tuple(r) for r in stage_machine(spark, data).select(columns).collect())
    b = sorted(tuple(r) for r in stage_stream(spark, data).select(columns).collect())
    assert a == b and any(r[2] for r in a) and any(not r[2] for r in a)


def test_source_bounds(spark):
    with pytest.raises(ValueError):
        streams.source(spark, "/tmp", "a int", files_per_trigger=0)


def test_failed_rewrite_keeps_the_old_table(spark, tmp_path):
    from quaverlake.sources import sinks

    path = str(tmp_path / "t.jsonl")
    sinks.write_jsonl(spark.range(3), path)
    with pytest.raises(Exception, match="boom"):
        sinks.write_jsonl(spark.range(2).selectExpr("raise_error('boom') AS id"), path)
    assert spark.read.json(path).count() == 3 and [p.name for p in tmp_path.iterdir() if "staged" in p.name] == []

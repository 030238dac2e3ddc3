"""Operators on literal cases and invariants."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from quaverlake.operators import aggregates as A
from quaverlake.operators import joins as J
from quaverlake.operators import sequences as S
from quaverlake.operators import structure as I


def test_gate_summary(spark):
    rows = [("t", 0.0, 10.0, 0.9, 0.2, 0.1), ("t", 10.0, 11.0, 0.0, 0.0, 0.9)]
    df = spark.createDataFrame(rows, "k string, start double, end double, music_probability double, singing_probability double, speech_probability double")
    r = A.gate_summary(df, ["k"], ["start"]).first()
    assert r["coverage"] == round(10 / 11, 6) and r["score"] > 0.85 and r["window_count"] == 2


def test_weighted_trimmed_against_procedure(spark):
    rng = np.random.default_rng(3)
    rows = [(g, i, float(rng.random()), float(rng.integers(0, 4))) for g in range(12) for i in range(int(rng.integers(1, 15)))]
    got = {r["g"]: r["trimmed"] for r in A.weighted_trimmed_mean(spark.createDataFrame(rows, "g int, i int, v double, w double"), ["g"], "v", "w", ["i"]).collect()}
    for g in range(12):
        own = sorted((v, w) for k, _, v, w in rows if k == g)
        if not any(w for _, w in own):
            own = [(v, 1.0) for v, _ in own]
        left = [w for _, w in own]
        for order in (range(len(own)), reversed(range(len(own)))):
            take = 0.1 * sum(w for _, w in own)
            for i in order:
                d = min(take, left[i])
                left[i] -= d
                take -= d
        assert got[g] == pytest.approx(sum(v * w for (v, _), w in zip(own, left, strict=True)) / sum(left), abs=1e-9)


def test_frame_batches_cover_all_once(spark):
    df = spark.createDataFrame([("b", i, n) for i, n in enumerate([3, 0, 9, 2])], "k string, i int, n long")
    rows = S.frame_batches(df, ["k"], ["i"], "n", 4).collect()
    seen = [(r["i"], f) for r in rows for f in range(r["first"], r["first"] + r["count"])]
    assert sorted(seen) == [(i, f) for i, n in enumerate([3, 0, 9, 2]) for f in range(n)]
    sizes = {}
    for r in rows:
        sizes[r["batch"]] = sizes.get(r["batch"], 0) + r["count"]
    assert max(sizes.values()) <= 4


def test_bucket_batches(spark):
    df = spark.createDataFrame([("8-15", 1), ("8-15", 2), ("8-15", 3), ("30-60", 4), ("30-60", 5)], "b string, i int")
    got = sorted((r["b"], r["batch"], r["i"]) for r in S.bucket_batches(df, "b", ["i"], 2).collect())
    assert got == [("30-60", 0, 4), ("30-60", 0, 5), ("8-15", 0, 1), ("8-15", 0, 2), ("8-15", 1, 3)]


def raw(*rows):
    return pd.DataFrame(rows, columns=["label", "raw_start", "raw_end", "boundary_confidence"])


def clean(frame, duration, beats=()):
    return I.SectionCleaner(frame, duration, np.array(beats, dtype=float), I.Tolerances()).run()


def test_sections_snap_and_stay_contiguous():
    out = clean(raw(("verse", 0, 12.2, 0.8), ("chorus", 12.2, 29.1, 0.9), ("outro", 29.1, 40, 0.7)), 40, [12.0, 29.0])
    assert out["end"].tolist() == [12.0, 29.0, 40.0] and out["start"].tolist() == [0.0, 12.0, 29.0]
    assert out["section_id"].tolist() == ["0001", "0002", "0003"]


def test_short_sections():
    kept = clean(raw(("verse", 0, 12, 0.9), ("bridge", 12, 16, 0.9), ("chorus", 16, 40, 0.9)), 40)
    gone = clean(raw(("verse", 0, 12, 0.9), ("bridge", 12, 13, 0.9), ("chorus", 13, 40, 0.9)), 40)
    assert (len(kept), len(gone)) == (3, 2)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.floats(0.5, 30), st.sampled_from(["verse", "chorus", "bridge", "intro"]), st.floats(0, 1)), min_size=1, max_size=15), st.lists(st.floats(0, 300), max_size=10))
def test_sections_cover_the_track(parts, beats):
    ends = np.cumsum([p[0] for p in parts])
    frame = raw(*((label, e - d, e, c) for (d, label, c), e in zip(parts, ends, strict=True)))
    out = clean(frame, float(ends[-1]), sorted(beats))
    assert out["start"].iloc[0] == 0 and out["end"].iloc[-1] == pytest.approx(ends[-1], abs=1e-6)
    assert np.allclose(out["start"].iloc[1:], out["end"].iloc[:-1]) and (out["label"].iloc[1:].to_numpy() != out["label"].iloc[:-1].to_numpy()).all()


def plain_tidy(times, labels):
    """The rule word for word: marks near the ends, then repeats near the ends."""
    end, inner = times[-1], range(1, len(times) - 1)
    near = [i for i in range(len(times) - 1) if i == 0 or times[i] - times[0] < 1]
    kept = [i for i in inner if times[i] - times[0] >= 1 and end - times[i] >= 1]
    opening = labels[near[-1]]
    while kept and labels[kept[0]] == opening and times[kept[0]] <= 10:
        kept = kept[1:]
    while kept and end - times[kept[-1]] <= 10 and labels[kept[-1]] == (labels[kept[-2]] if len(kept) > 1 else opening):
        kept = kept[:-1]
    return [(times[0], opening), *((times[i], labels[i]) for i in kept), (end, labels[-1])]


def test_tidy_structure(spark):
    rng, rows, want = np.random.default_rng(5), [], {}
    tracks = [([0.0, 0.4, 18.0, 33.2, 33.9], ["p", "q", "r", "s", "end"]), ([2.0, 9.0, 26.0, 41.0], ["p", "p", "q", "end"]), ([0.0, 5.0], ["p", "end"])]
    for _ in range(60):
        times = np.round(np.cumsum(rng.choice([0.3, 0.7, 1.5, 4.0, 12.0], rng.integers(2, 12))), 3).tolist()
        tracks.append((times, [*rng.choice(list("pqr"), len(times) - 1).tolist(), "end"]))
    for track, (times, labels) in enumerate(tracks):
        rows += [(track, t, x, i) for i, (t, x) in enumerate(zip(times, labels, strict=True))]
        want[track] = plain_tidy(times, labels)
    got: dict = {}
    for r in sorted(I.tidy_structure(spark.createDataFrame(rows, "track long, time double, label string, i long"), "track", "i").collect()):
        got.setdefault(r["track"], []).append((r["time"], r["label"]))
    assert got == want


def test_forced_stops_follow_the_best_place_ahead():
    curve = np.random.default_rng(7).random(400)
    want, at = [], 0
    while 400 - at > 60:
        at += 20 + int(np.argmax(curve[at + 20 : at + 60]))
        want.append(at)
    assert I._stops(curve, 20, 60).tolist() == want and not len(I._stops(curve, 20, 20)) and not len(I._stops(curve[:50], 20, 60))


def test_upsert_takes_the_last_new_row(spark):
    old = spark.createDataFrame([(1, "a", 0), (2, "b", 0)], "k long, v string, at long")
    new = spark.createDataFrame([(1, "late", 9), (1, "early", 3), (3, None, 1)], "k long, v string, at long")
    assert {r["k"]: r["v"] for r in J.upsert(old, new, "k", "at").collect()} == {1: "late", 2: "b", 3: None}


def test_instrumental_decoder_finds_blocks():
    rng = np.random.default_rng(0)
    a, b = rng.standard_normal(16), rng.standard_normal(16)
    x = np.concatenate([np.tile(v, (40, 1)) for v in (a, b, a)]) + 0.05 * rng.standard_normal((120, 16))
    out = I.decode_instrumental(x, 60.0)
    assert np.allclose(out["start"].to_numpy(), [0, 20, 40], atol=1.0)
    assert out["label"].iloc[0] == out["label"].iloc[2] != out["label"].iloc[1] and out["end"].iloc[-1] == 60.0


def test_find_peaks():
    x = np.array([0, 1, 0, 3, 3, 0, 2, 0, 0.5, 0.0])
    assert I.find_peaks(x, 0.8, 1, 0.03).tolist() == [1, 3, 6]
    assert I.find_peaks(x, 0.8, 4, 0.03).tolist() == [3]


def test_token_crop(spark):
    token = F.array(*(F.struct(F.lit(t).alias("text"), F.lit(a).alias("start"), F.lit(b).alias("end")) for t, a, b in (("cut", 0.0, 1.0), ("kept", 1.4, 2.0))))
    r = spark.range(1).select(J.crop_tokens(token, F.lit(8.5), F.lit(10.0), F.lit(20.0)).alias("t")).first()["t"]
    assert [(x["text"], x["start"], x["end"]) for x in r] == [("kept", 9.9, 10.5)]


def test_path_conflicts(spark):
    df = spark.createDataFrame([("a", "foo.json"), ("b", "foo.json/bar.wav"), ("c", "safe.wav"), ("d", "x"), ("e", "x")], "id string, p string")
    assert sorted(r["id"] for r in J.path_conflicts(df, "id", "p").collect()) == ["a", "b", "d", "e"]


def test_multiset_hash_ignores_order(spark):
    rows = [("k", i, f"h{i}") for i in range(20)]
    schema = "k string, i int, h string"
    a = A.manifest_hash(spark.createDataFrame(rows, schema), ["k"], F.col("h")).first()["manifest"]
    b = A.manifest_hash(spark.createDataFrame(rows[::-1], schema).repartition(3), ["k"], F.col("h")).first()["manifest"]
    assert a == b


def test_partition_membership(spark):
    ids = lambda *v: spark.createDataFrame([(x,) for x in v], "audio_id string")
    parts = {"annotations": ids("a"), "review": ids("b"), "rejected": ids("b", "z"), "retry": ids()}
    got = {r["audio_id"]: r["problem"] for r in A.partition_membership(ids("a", "b", "c"), parts, "audio_id").collect()}
    assert got == {"b": "repeated", "c": "missing", "z": "foreign"}


def test_covered_join_names_missing_keys(spark):
    a, b = spark.createDataFrame([("x",), ("y",)], "k string"), spark.createDataFrame([("x", 1)], "k string, v int")
    with pytest.raises(ValueError, match="y"):
        J.covered_join(a, b, "k", "stage")


def test_functional_structure(spark):
    logits = [-6.0] * 60
    logits[25] = 6.0
    rows = [("t", i, x, [0.9, 0.1] if i < 25 else [0.2, 0.8]) for i, x in enumerate(logits)]
    out = I.functional_structure(spark.createDataFrame(rows, "k string, i int, l double, p array<double>"), ["k"], "i", "l", "p", frame_rate=1.0, reach=10).orderBy("section").collect()
    # flat stretches near the ends stand out too, as what lies outside counts as zero
    assert 25.0 in {r["start"] for r in out} and all(r["label"] == int(r["start"] >= 25) for r in out)
    assert [r["start"] for r in out[1:]] == [r["end"] for r in out[:-1]] and out[0]["start"] == 0 and out[-1]["end"] == 60


def _odd_frames(spark):
    rng = np.random.default_rng(11)
    rows = [("a", i, rng.standard_normal(6).tolist()) for i in range(23)] + [("b", i, rng.standard_normal(4).tolist()) for i in range(7)] + [("c", 0, [1.0, 0.0])]
    rows[3], rows[8], rows[11] = ("a", 3, None), ("a", 8, [0.0] * 6), ("a", 11, [1.0, float("inf"), *[0.0] * 4])
    return spark.createDataFrame(rows, "k string, i long, v array<double>")


def test_rectangles_of_self_similarity_without_pairs(spark):
    frames = _odd_frames(spark)
    pairs = {(r["k"], r["i"], r["j"]): r["value"] for r in J.similarity_pairs(frames, ["k"], "i", "v").collect()}
    rectangles = [("a", 0, 23, 0, 23), ("a", 2, 9, 10, 20), ("a", 3, 4, 0, 5), ("a", 11, 12, 8, 12), ("a", 5, 5, 0, 3), ("a", 20, 40, 0, 3), ("b", 1, 6, 1, 6), ("c", 0, 1, 0, 1), ("none", 0, 2, 0, 2)]
    given = spark.createDataFrame(rectangles, "k string, i0 long, i1 long, j0 long, j1 long")
    got = {(r["k"], r["i0"], r["i1"], r["j0"], r["j1"]): r["mean"] for r in S.similarity_rectangle_means(frames, given, ["k"], "i", "v").collect()}
    assert set(got) == set(rectangles)
    for k, i0, i1, j0, j1 in rectangles:
        held = [pairs[k, i, j] for i in range(i0, i1) for j in range(j0, j1) if pairs.get((k, i, j)) is not None]
        want = 0.0 if i0 == i1 else float(np.mean(held)) if held else None
        assert got[k, i0, i1, j0, j1] == (want if want is None else pytest.approx(want, abs=1e-12))


def test_rectangle_query_makes_no_pairs(spark, data, monkeypatch):
    from quaverlake.queries import QUERIES

    monkeypatch.setattr(J, "similarity_pairs", lambda *a: pytest.fail("pairs were made"))
    assert QUERIES["rectangle_means"](spark, data).count() > 0


def test_similarity_rows_block_against_block(spark):
    frames = _odd_frames(spark)
    held: dict = {}
    for r in J.similarity_pairs(frames, ["k"], "i", "v").collect():
        held.setdefault((r["k"], r["i"]), {})[r["j"]] = r["value"]
    for block in (4, 100):
        rows = J.similarity_rows(frames, ["k"], "i", "v", block, 3).collect()
        assert len(rows) == len(held)
        for r in rows:
            own = held[r["k"], r["i"]]
            others = [v for j, v in own.items() if j != r["i"]]
            assert r["mean"] == pytest.approx(np.mean(list(own.values())), abs=1e-12)
            assert r["nearest"] == (pytest.approx(max(others), abs=1e-12) if others else None)


def test_similarity_query_joins_no_frames(spark, data, monkeypatch):
    from quaverlake.queries import QUERIES

    monkeypatch.setattr(J, "similarity_pairs", lambda *a: pytest.fail("pairs were joined"))
    assert QUERIES["self_similarity"](spark, data).count() == 500


def test_instrumental_decoder_against_the_whole_matrix():
    rng = np.random.default_rng(21)
    x = np.repeat(rng.standard_normal((5, 12)), 30, axis=0) + 0.2 * rng.standard_normal((150, 12))
    y = I.unit_rows(x)
    m = y @ y.T
    want, active = np.zeros(150), np.zeros(150)
    for r in (4, 8, 16):
        curve = np.zeros(150)
        for t in range(r, 150 - r):
            a, b = slice(t - r, t), slice(t, t + r)
            curve[t] = max(0.0, (m[a, a].mean() + m[b, b].mean() - m[a, b].mean() - m[b, a].mean()) / 2)
        want += np.minimum(curve / np.quantile(curve[curve > 0], 0.95), 1.0)
        active += curve > 0
    want = I.gaussian(want / np.maximum(active, 1.0), 0.7)
    want[:4] = want[-4:] = 0.0
    assert np.allclose(I.novelty(y, 2.0), (want - want.min()) / (want.max() - want.min()), atol=1e-9)
    for cut in (0.1, 0.5, 0.9, 1.1):
        clusters = [[i] for i in range(60)]
        while len(clusters) > 1:
            d, a, b = min((1 - m[np.ix_(p, q)].mean(), i, j) for i, p in enumerate(clusters) for j, q in enumerate(clusters) if i < j)
            if d > cut:
                break
            clusters[a] += clusters.pop(b)
        assert {tuple(sorted(c)) for c in clusters} == {tuple(np.flatnonzero(I.average_linkage(y[:60], cut) == c)) for c in set(I.average_linkage(y[:60], cut).tolist())}


def test_instrumental_decoder_memory_is_linear():
    import tracemalloc

    x = np.random.default_rng(4).standard_normal((4000, 8))
    tracemalloc.start()
    out = I.decode_instrumental(x, 2000.0)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert out["end"].iloc[-1] == 2000.0 and peak < 4000 * 4000 * 8 / 4  # the matrix alone would be 128 MB


def test_sections_of_all_tracks_cross_to_python_in_batches(spark):
    rng, rows, beats = np.random.default_rng(8), [], []
    for t in range(40):
        ends = np.round(np.cumsum(rng.uniform(0.5, 15, rng.integers(1, 14))), 3).tolist()
        own = [(f"t{t}", ends[-1], str(rng.choice(["verse", "chorus", "intro"])), s, e, None if rng.random() < 0.1 else float(rng.random())) for s, e in zip([0.0, *ends], ends, strict=False)]
        rows += [own[i] for i in rng.permutation(len(own))]
        beats += [(f"t{t}", float(b)) for b in rng.uniform(0, ends[-1], rng.integers(0, 30) * (t % 3 > 0))]
    beats.append(("without sections", 1.0))
    schema = "k string, duration double, label string, raw_start double, raw_end double, boundary_confidence double"
    df, times = spark.createDataFrame(rows, schema), spark.createDataFrame(beats, "k string, time double")
    for known in (None, times):
        out = I.postprocess_sections(df, "k", known)
        got: dict = {}
        for r in out.collect():
            got.setdefault(r["k"], []).append(tuple(r)[1:])
        assert len(got) == 40
        for t, sections in got.items():
            own = pd.DataFrame([r[1:] for r in rows if r[0] == t], columns=["duration", "label", "raw_start", "raw_end", "boundary_confidence"])
            near = sorted(b for k, b in beats if k == t) if known is not None else []
            want = I.SectionCleaner(own, own["duration"].iloc[0], np.array(near, float), I.Tolerances()).run()
            assert sorted(sections) == list(want.itertuples(index=False, name=None))
        # one call of Python for all tracks of a batch, whose few bytes AQE does not put into one task
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "MapInArrow" in plan and "FlatMap" not in plan and "Repartition" in plan

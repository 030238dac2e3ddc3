"""Gates, routes and aggregations."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from quaverlake.functions import routing
from quaverlake.functions.values import sigmoid
from quaverlake.operators import aggregates as A
from quaverlake.operators import sequences as S
from quaverlake.plans.vocabulary import STAGE_A, STAGE_B
from quaverlake.queries.registry import FRAMES, frames, query, table

_VOICE = (
    "WITH "
    + FRAMES
    + """, r AS (SELECT *, p >= 0.5 AS on_, row_number() OVER w - sum((p >= 0.5)::INT) OVER w AS island FROM f WINDOW w AS (PARTITION BY user_id ORDER BY t, event_id)),
l AS (SELECT user_id, max(n) AS longest FROM (SELECT user_id, island, sum(on_::BIGINT) AS n FROM r GROUP BY 1, 2) GROUP BY 1),
b AS (SELECT user_id, avg(p) AS voice_mean, max(p) AS voice_max, avg((p >= 0.5)::INT) AS voice_coverage FROM f GROUP BY 1),
v AS (SELECT user_id, voice_mean, voice_max, voice_coverage, (longest * 0.992)::DOUBLE AS longest_voice_sec FROM b JOIN l USING (user_id))"""
)


@query(_VOICE + " SELECT user_id, round(voice_mean, 4) AS voice_mean, round(voice_max, 4) AS voice_max, round(voice_coverage, 4) AS voice_coverage, round(longest_voice_sec, 4) AS longest_voice_sec FROM v")
def voice_summary(spark: SparkSession, d: str) -> DataFrame:
    out = A.voice_summary(frames(spark, d), ["user_id"], ["t", "event_id"], "p")
    return out.select("user_id", *(F.round(c, 4).alias(c) for c in ("voice_mean", "voice_max", "voice_coverage", "longest_voice_sec")))


@query(
    _VOICE
    + """, q AS (SELECT user_id, round(least(1, greatest(0, 0.55 * voice_mean + 0.30 * voice_coverage + 0.15 * least(1, longest_voice_sec / 30))), 6) AS s FROM v)
SELECT user_id, round(s, 4) AS vocal_score, CASE WHEN s >= 0.55 THEN 'accepted' WHEN s <= 0.20 THEN 'accepted' ELSE 'review' END AS status,
CASE WHEN s >= 0.55 THEN 'song' WHEN s <= 0.20 THEN 'instrumental' ELSE 'unknown' END AS content_type,
round(CASE WHEN s >= 0.55 THEN s WHEN s <= 0.20 THEN 1 - s ELSE greatest(0, 1 - abs(s - 0.5) * 2) END, 4) AS confidence FROM q"""
)
def vocal_route(spark: SparkSession, d: str) -> DataFrame:
    voices = A.voice_summary(frames(spark, d), ["user_id"], ["t", "event_id"], "p")
    scored = voices.withColumn("s", routing.vocal_score("voice_mean", "voice_coverage", "longest_voice_sec")).withColumn("r", routing.vocal_route("s"))
    return scored.select("user_id", F.round("s", 4).alias("vocal_score"), "r.status", "r.content_type", F.round("r.confidence", 4).alias("confidence"))


def _windows(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    return f.withColumn("weight", F.coalesce(F.lead("t").over(w) - F.col("t"), F.lit(3600.0)))


_WINDOWS = "WITH " + FRAMES + ", w AS (SELECT *, coalesce(lead(t) OVER (PARTITION BY user_id ORDER BY t, event_id) - t, 3600.0) AS weight FROM f)"
_TRIM = """, x AS (SELECT user_id, p, weight, sum(weight) OVER (PARTITION BY user_id ORDER BY p, event_id ROWS UNBOUNDED PRECEDING) AS e, sum(weight) OVER (PARTITION BY user_id) AS total FROM w),
k AS (SELECT user_id, p, greatest(0, least(e, 0.9 * total) - greatest(e - weight, 0.1 * total)) AS kept FROM x),
m AS (SELECT user_id, sum(p * kept) / sum(kept) AS trimmed FROM k GROUP BY 1),
c AS (SELECT user_id, sum(CASE WHEN p >= 0.5 THEN weight ELSE 0 END) / sum(weight) AS coverage, count(*) AS windows FROM w GROUP BY 1)"""


@query(_WINDOWS + _TRIM + " SELECT user_id, round(trimmed, 4) AS trimmed, round(coverage, 4) AS coverage, round(0.7 * trimmed + 0.3 * coverage, 4) AS score, windows FROM m JOIN c USING (user_id)")
def weighted_trimmed(spark: SparkSession, d: str) -> DataFrame:
    w = _windows(spark, d)
    trimmed = A.weighted_trimmed_mean(w, ["user_id"], "p", "weight", ["event_id"])
    cover = w.groupBy("user_id").agg(A.weighted_coverage("p", "weight").alias("coverage"), F.count(F.lit(1)).alias("windows"))
    both = trimmed.join(cover, "user_id")
    return both.select("user_id", F.round("trimmed", 4).alias("trimmed"), F.round("coverage", 4).alias("coverage"), F.round(F.col("trimmed") * 0.7 + F.col("coverage") * 0.3, 4).alias("score"), "windows")


@query(
    "WITH "
    + FRAMES
    + """, g AS (SELECT user_id, list_sort(list(p)) AS v FROM f GROUP BY 1), n AS (SELECT user_id, v, len(v) AS n, floor(len(v) * 0.1)::INT AS c FROM g)
SELECT user_id, round(list_avg(v[c + 1 : n - c]), 4) AS trimmed FROM n"""
)
def trimmed_mean(spark: SparkSession, d: str) -> DataFrame:
    held = frames(spark, d).groupBy("user_id").agg(F.collect_list("p").alias("v"))
    return held.select("user_id", F.round(A.trimmed_mean("v"), 4).alias("trimmed"))


@query(
    """WITH e AS (SELECT label, vec_id, 1 / (1 + exp(-list_max(embedding[28:38])::DOUBLE)) AS score FROM embeddings)
SELECT label, round(median(score), 4) AS score, round(max(score), 4) AS best, count(*) AS windows FROM e GROUP BY label"""
)
def gate_scores(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("label", F.transform("embedding", lambda x: sigmoid(x)).alias("probabilities"))
    scored = e.select("label", routing.music_score("probabilities", list(range(27, 38))).alias("score"))
    return scored.groupBy("label").agg(F.round(F.median("score"), 4).alias("score"), F.round(F.max("score"), 4).alias("best"), F.count(F.lit(1)).alias("windows"))


def _tracks(spark: SparkSession, d: str) -> DataFrame:
    """Tracks are users, windows their frames by index."""
    w = Window.partitionBy("user_id").orderBy("t", "event_id")
    return frames(spark, d).select("user_id", (F.row_number().over(w) - 1).alias("i"), F.col("p"))


def _stage(tracks: DataFrame, offsets: list[float]) -> DataFrame:
    """Median of the frames at relative offsets."""
    n = tracks.groupBy("user_id").agg(F.count(F.lit(1)).alias("n"))
    at = n.select("user_id", F.explode(S.sample_offsets("n", offsets)).alias("o")).select("user_id", F.floor("o").alias("i"))
    return at.join(tracks, ["user_id", "i"]).groupBy("user_id").agg(F.round(F.median("p"), 6).alias("score"))


def _offsets(name: str, offsets: list[float]) -> str:
    values = ", ".join(f"({o})" for o in offsets)
    return f""", {name} AS (SELECT user_id, round(median(p), 6) AS score FROM (SELECT user_id, floor(round(greatest(n - 8.0, 0) * o, 6))::BIGINT AS i FROM n, (VALUES {values}) v(o)) JOIN x USING (user_id, i) GROUP BY 1)"""


_CASCADE = (
    "WITH "
    + FRAMES
    + ", x AS (SELECT user_id, row_number() OVER (PARTITION BY user_id ORDER BY t, event_id) - 1 AS i, p FROM f), n AS (SELECT user_id, count(*) AS n FROM f GROUP BY 1)"
    + _offsets("a", STAGE_A["offsets"])
    + _offsets("b", STAGE_B["offsets"])
    + f""", j AS (SELECT a.user_id, a.score AS sa, b.score AS sb, a.score > {STAGE_A["reject"]} AND a.score < {STAGE_A["accept"]} AS grey FROM a JOIN b USING (user_id)),
o AS (SELECT user_id, grey AS looked_twice, CASE WHEN grey THEN sb ELSE sa END AS s,
 CASE WHEN NOT grey THEN CASE WHEN sa >= {STAGE_A["accept"]} THEN 'accepted' ELSE 'rejected' END WHEN sb >= {STAGE_B["accept"]} THEN 'accepted' WHEN sb <= {STAGE_B["reject"]} THEN 'rejected' ELSE 'review' END AS d FROM j)
SELECT user_id, looked_twice, round(s, 4) AS probability, CASE d WHEN 'accepted' THEN 'music' WHEN 'rejected' THEN 'non_music' ELSE 'review' END AS decision, d AS status,
CASE d WHEN 'accepted' THEN 'fast_gate_music' WHEN 'rejected' THEN 'fast_gate_non_music' ELSE 'fast_gate_gray_zone' END AS reason FROM o"""
)


@query(_CASCADE)
def gate_cascade(spark: SparkSession, d: str) -> DataFrame:
    tracks = _tracks(spark, d)
    a = _stage(tracks, STAGE_A["offsets"]).withColumn("d", routing.decide("score", STAGE_A["reject"], STAGE_A["accept"]))
    grey = a.where("d = 'review'").select("user_id")
    b = _stage(tracks.join(grey, "user_id", "left_semi"), STAGE_B["offsets"])
    b = b.select("user_id", F.col("score").alias("b_score"), routing.decide("score", STAGE_B["reject"], STAGE_B["accept"]).alias("b"))
    out = a.join(b, "user_id", "left").withColumn("o", routing.gate_outcome(F.coalesce("b", "d")))
    return out.select("user_id", F.col("b").isNotNull().alias("looked_twice"), F.round(F.coalesce("b_score", "score"), 4).alias("probability"), "o.decision", "o.status", "o.reason")


@query(
    """WITH x AS (SELECT c_custkey, sum(o_totalprice) AS total, max(o_totalprice) AS best, count(o_orderkey) AS n, max(c_acctbal) AS bal FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1),
y AS (SELECT c_custkey, least(1, coalesce(total, 0) / 4000000.0) AS music, least(1, greatest(0, bal / 10000.0)) AS singing, least(1, coalesce(best, 0) / 400000.0) AS speech, least(1, n / 20.0) AS mean, least(1, n / 30.0) AS cov, n * 1.0 AS longest FROM x),
z AS (SELECT *, greatest(0, least(1, 0.5 * mean + 0.2 * cov + 0.15 * singing + 0.15 * least(1, longest / 30))) AS vocal FROM y)
SELECT c_custkey, CASE WHEN music <= 0.3 THEN 'rejected' WHEN music < 0.6 THEN 'review' WHEN speech >= 0.65 AND speech >= singing + 0.25 THEN 'review' WHEN vocal >= 0.55 OR vocal <= 0.2 THEN 'accepted' ELSE 'review' END AS status,
CASE WHEN music < 0.6 OR (speech >= 0.65 AND speech >= singing + 0.25) THEN 'unknown' WHEN vocal >= 0.55 THEN 'song' WHEN vocal <= 0.2 THEN 'instrumental' ELSE 'unknown' END AS content_type,
round(CASE WHEN music <= 0.3 THEN 1 - music WHEN music < 0.6 THEN 1 - abs(music - 0.5) * 2 WHEN speech >= 0.65 AND speech >= singing + 0.25 THEN least(1, speech) WHEN vocal >= 0.55 THEN vocal WHEN vocal <= 0.2 THEN 1 - vocal ELSE 1 - abs(vocal - 0.5) * 2 END, 4) AS confidence FROM z"""
)
def legacy_route(spark: SparkSession, d: str) -> DataFrame:
    c, o = table(spark, d, "customer"), table(spark, d, "orders")
    x = c.join(o, c.c_custkey == o.o_custkey, "left").groupBy("c_custkey").agg(F.sum("o_totalprice").alias("total"), F.max("o_totalprice").alias("best"), F.count("o_orderkey").alias("n"), F.max("c_acctbal").alias("bal"))
    part = lambda v, by: F.least(F.lit(1.0), F.greatest(F.lit(0.0), F.coalesce(v, F.lit(0.0)) / by))
    r = routing.track_route(part(F.col("total"), 4e6), part(F.col("bal"), 1e4), part(F.col("best"), 4e5), part(F.col("n"), 20.0), part(F.col("n"), 30.0), F.col("n"))
    return x.withColumn("r", r).select("c_custkey", "r.status", "r.content_type", F.round("r.confidence", 4).alias("confidence"))


@query(
    """WITH m AS (SELECT l_suppkey, l_partkey, round(avg(l_quantity), 6) AS probability FROM lineitem GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY l_suppkey ORDER BY probability DESC, l_partkey DESC) AS rank FROM m) SELECT l_suppkey, l_partkey, round(probability, 4) AS probability, rank FROM r WHERE rank <= 8"""
)
def topk_labels(spark: SparkSession, d: str) -> DataFrame:
    top = A.top_labels(table(spark, d, "lineitem").select("l_suppkey", "l_partkey", "l_quantity"), "l_suppkey", "l_partkey", "l_quantity")
    return top.select("l_suppkey", "l_partkey", F.round("probability", 4).alias("probability"), F.col("rank").cast("long").alias("rank"))


@query("WITH " + FRAMES + ", g AS (SELECT user_id, t / 86400 - lag(t / 86400) OVER (PARTITION BY user_id ORDER BY t, event_id) AS gap FROM f) SELECT user_id, round(60 / avg(gap) FILTER (WHERE gap > 0.1 AND gap < 3.0), 4) AS bpm FROM g GROUP BY 1")
def tempo(spark: SparkSession, d: str) -> DataFrame:
    beats = frames(spark, d).withColumn("day", F.col("t") / 86400)
    return A.tempo(beats, ["user_id"], ["t", "event_id"], "day").select("user_id", F.round("bpm", 4).alias("bpm"))


@query(
    "SELECT o_orderstatus AS stage, count(*) AS processed, round(sum(o_totalprice) / 1000, 3) AS elapsed, round(count(*) / (round(sum(o_totalprice) / 1000, 3)), 6) AS items_per_second, round(round(sum(o_totalprice) / 1000, 3) / count(*), 6) AS seconds_per_item FROM orders GROUP BY 1"
)
def stage_rates(spark: SparkSession, d: str) -> DataFrame:
    stages = table(spark, d, "orders").groupBy(F.col("o_orderstatus").alias("stage")).agg(F.count(F.lit(1)).alias("processed"), F.round(F.sum("o_totalprice") / 1000, 3).alias("elapsed"))
    return A.stage_rates(stages)


@query(
    """WITH s AS (SELECT o_orderpriority AS stage, min(o_orderkey) AS ord, count(*) AS processed, round(sum(o_totalprice) / 1000, 3) AS elapsed, count(*) FILTER (WHERE o_orderstatus = 'P') AS failed FROM orders GROUP BY 1)
SELECT sum(processed)::BIGINT AS processed, round(sum(elapsed), 2) AS elapsed, string_agg(stage, ',' ORDER BY ord) AS completed_stages, sum(failed)::BIGINT AS retries, CASE WHEN sum(failed) > 0 THEN 'partial_success' ELSE 'success' END AS status FROM s"""
)
def run_report(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    stages = o.groupBy(F.col("o_orderpriority").alias("stage")).agg(F.min("o_orderkey").alias("at"), F.count(F.lit(1)).alias("processed"), F.round(F.sum("o_totalprice") / 1000, 3).alias("elapsed"), F.count_if(F.col("o_orderstatus") == "P").alias("failed"))
    return A.run_report(stages, F.sum("failed"), "at").withColumn("elapsed", F.round("elapsed", 2))


@query("SELECT coalesce(CASE WHEN o_orderstatus <> 'O' THEN o_orderpriority END, 'unknown') AS stage, count(*) AS failures FROM orders GROUP BY 1")
def failure_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.failure_counts(table(spark, d, "orders").select(F.when(F.col("o_orderstatus") != "O", F.col("o_orderpriority")).alias("stage")), "stage")


@query("SELECT count(*) AS total, count(*) FILTER (WHERE event_type = 'click') AS click, count(*) FILTER (WHERE event_type = 'purchase') AS purchase, count(*) FILTER (WHERE event_type = 'none') AS none FROM events")
def content_counts(spark: SparkSession, d: str) -> DataFrame:
    return A.content_counts(table(spark, d, "events"), "event_type", ["click", "purchase", "none"])


@query("SELECT count(*) FILTER (WHERE trim(text) <> '') AS rows FROM documents")
def filled_rows(spark: SparkSession, d: str) -> DataFrame:
    return A.filled_rows(table(spark, d, "documents").select(F.col("text").alias("value")))


_DIMS = 16


@query(
    """WITH m AS (SELECT label, i, avg(embedding[i]::DOUBLE) AS m FROM embeddings, range(1, 17) r(i) GROUP BY 1, 2),
n AS (SELECT label, greatest(sqrt(sum(m * m)), 1e-8) AS n FROM m GROUP BY 1) SELECT label, i::INT AS dim, round(m / n, 4) AS mean FROM m JOIN n USING (label)"""
)
def segment_embeddings(spark: SparkSession, d: str) -> DataFrame:
    held = A.segment_embeddings(table(spark, d, "embeddings").select("label", "embedding"), ["label"], "embedding", _DIMS)
    return held.select("label", F.posexplode("mean").alias("dim", "mean")).select("label", (F.col("dim") + 1).alias("dim"), F.round("mean", 4).alias("mean"))


@query(
    "WITH "
    + FRAMES
    + """, h AS (SELECT floor(t / 3600)::BIGINT AS frame, p, user_id % 30 AS pos FROM f), w AS (SELECT frame, p, least(1.0, 0.05 + 0.95 * least(pos, 29 - pos) / 4)::DOUBLE AS wt FROM h)
SELECT frame, round(sum(p * wt) / greatest(sum(wt), 1e-8), 4) AS p FROM w GROUP BY 1"""
)
def overlap_add(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d).select(F.floor(F.col("t") / 3600).alias("frame"), "p", A.fade(F.col("user_id") % 30, F.lit(30), 5).alias("weight"))
    return A.overlap_add(f, ["frame"], "p", "weight").select("frame", F.round("p", 4).alias("p"))


@query("WITH " + FRAMES + " SELECT floor(t / 86400)::BIGINT AS frame, round(avg(p), 4) AS p FROM f GROUP BY 1")
def frame_means(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d).select(F.floor(F.col("t") / 86400).alias("frame"), "p")
    return A.frame_means(f, ["frame"], "p").select("frame", F.round("p", 4).alias("p"))


@query(
    "WITH "
    + FRAMES
    + """, m AS (SELECT user_id, CASE event_type WHEN 'click' THEN 0 WHEN 'view' THEN 1 WHEN 'signup' THEN 2 WHEN 'purchase' THEN 3 ELSE 4 END AS label, avg(p) AS m FROM f GROUP BY 1, 2),
r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY m DESC, label) AS k FROM m) SELECT user_id, label, round(m, 4) AS label_confidence FROM r WHERE k = 1"""
)
def segment_labels(spark: SparkSession, d: str) -> DataFrame:
    kinds = ["click", "view", "signup", "purchase"]
    label = F.coalesce(*(F.when(F.col("event_type") == k, F.lit(i)) for i, k in enumerate(kinds)), F.lit(4))
    out = A.segment_labels(frames(spark, d).withColumn("label", label), ["user_id"], "label", "p")
    return out.select("user_id", "label", F.round("label_confidence", 4).alias("label_confidence"))


@query(
    """WITH t AS (SELECT conv_id, turn, CASE WHEN turn % 5 = 3 THEN 'asr_error' WHEN role = 'user' THEN 'ok' ELSE 'no_lyrics_detected' END AS asr_status FROM conversations)
SELECT conv_id, CASE WHEN count(*) FILTER (WHERE asr_status = 'asr_error') > 0 THEN 'error' ELSE 'ok' END AS stage_status, string_agg(lpad(turn::VARCHAR, 4, '0') || ': asr_error', '; ' ORDER BY turn) FILTER (WHERE asr_status = 'asr_error') AS stage_error FROM t WHERE conv_id % 7 <> 0 GROUP BY 1
UNION ALL SELECT DISTINCT conv_id, 'error', 'input contains no sections' FROM t WHERE conv_id % 7 = 0"""
)
def asr_roll_up(spark: SparkSession, d: str) -> DataFrame:
    """Every seventh conversation stands for a track without sections."""
    c = table(spark, d, "conversations").select("conv_id", "turn", "role")
    status = F.when(F.col("turn") % 5 == 3, "asr_error").when(F.col("role") == "user", "ok").otherwise("no_lyrics_detected")
    none = F.lit(None).cast("string")
    sections = c.where("conv_id % 7 <> 0").withColumns({"asr_status": status, "section_id": F.lpad(F.col("turn").cast("string"), 4, "0"), "asr_error": none, "alignment_error": none})
    return A.asr_roll_up(c, sections, ["conv_id"], ["turn"])


@query(
    """WITH c AS (SELECT user_id, event_type AS r, event_id % 3 AS e, count(*)::DOUBLE AS n FROM events GROUP BY 1, 2, 3), t AS (SELECT *, sum(n) OVER (PARTITION BY user_id, r) AS nr, sum(n) OVER (PARTITION BY user_id, e) AS ne FROM c),
r AS (SELECT user_id, sum(nr * (nr - 1) / 2) AS pr, count(*) AS kr FROM (SELECT DISTINCT user_id, r, nr FROM t) GROUP BY 1), e AS (SELECT user_id, sum(ne * (ne - 1) / 2) AS pe, count(*) AS ke FROM (SELECT DISTINCT user_id, e, ne FROM t) GROUP BY 1),
b AS (SELECT user_id, sum(n * (n - 1) / 2) AS pb, sum(n) AS total, -sum(n * log2(n / nr)) AS he, -sum(n * log2(n / ne)) AS hr FROM t GROUP BY 1),
s AS (SELECT user_id, CASE WHEN pe > 0 THEN pb / pe ELSE 0 END AS p, CASE WHEN pr > 0 THEN pb / pr ELSE 0 END AS q, CASE WHEN ke > 1 THEN 1 - he / total / log2(ke) ELSE 0 END AS o, CASE WHEN kr > 1 THEN 1 - hr / total / log2(kr) ELSE 0 END AS u FROM b JOIN r USING (user_id) JOIN e USING (user_id))
SELECT user_id, round(p + 1e-9, 4) AS precision, round(q + 1e-9, 4) AS recall, round(CASE WHEN p + q > 0 THEN 2 * p * q / (p + q) ELSE 0 END + 1e-9, 4) AS f_measure, round(o + 1e-9, 4) AS over_segmentation, round(u + 1e-9, 4) AS under_segmentation FROM s"""
)
def label_agreement(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_type", (F.col("event_id") % 3).alias("other"))
    out = A.label_agreement(e, ["user_id"], "event_type", "other")
    return out.select("user_id", *(F.round(F.col(c) + 1e-9, 4).alias(c) for c in ("precision", "recall", "f_measure", "over_segmentation", "under_segmentation")))


@query("SELECT conv_id, nullif(string_agg(CASE WHEN role = 'user' THEN text END, chr(10) ORDER BY turn), '') AS full_transcript FROM conversations GROUP BY 1")
def transcript(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations").withColumn("lyrics", F.when(F.col("role") == "user", F.col("text")))
    return A.transcript(c, ["conv_id"], ["turn"], "lyrics")


@query(
    """SELECT doc_id, CASE WHEN n_chars / 60.0 <= 15 THEN '8-15' WHEN n_chars / 60.0 <= 30 THEN '15-30' WHEN n_chars / 60.0 <= 60 THEN '30-60' ELSE '60+' END AS bucket,
CASE lang WHEN 'fr' THEN 'silence' WHEN 'de' THEN CASE WHEN n_chars < 1000 THEN 'low_voice_instrumental_section' ELSE 'eligible' END ELSE 'eligible' END AS reason FROM documents"""
)
def asr_eligibility(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars")
    label = F.when(F.col("lang") == "fr", " Silence ").when(F.col("lang") == "de", "SOLO").otherwise("verse")
    return docs.select("doc_id", routing.duration_bucket(F.col("n_chars") / 60.0).alias("bucket"), routing.asr_eligible(label, F.when(F.col("n_chars") < 1000, 0.0).otherwise(0.5))["reason"].alias("reason"))


@query(
    """SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'accepted.music' WHEN 'O' THEN 'rejected' ELSE 'review' END AS partition,
CASE o_orderstatus WHEN 'F' THEN 'large_order,fast_gate_music' WHEN 'O' THEN 'large_order,fast_gate_non_music' ELSE 'large_order,fast_gate_gray_zone' END AS reasons FROM orders"""
)
def gate_partitions(spark: SparkSession, d: str) -> DataFrame:
    decision = F.when(F.col("o_orderstatus") == "F", "accepted").when(F.col("o_orderstatus") == "O", "rejected").otherwise("review")
    o = table(spark, d, "orders").select("o_orderkey", routing.gate_outcome(decision).alias("g"))
    reasons = routing.add_reason(routing.add_reason(F.array(F.lit("large_order")), F.col("g.reason")), F.lit("large_order"))
    return o.select("o_orderkey", routing.output_partition("fast_gate", F.col("g.status"), F.col("g.content_type"), F.col("g.decision")).alias("partition"), F.array_join(reasons, ",").alias("reasons"))


@query("SELECT o_orderpriority AS priority, date_trunc('month', o_orderdate) AS month, count(*) AS n FROM orders GROUP BY CUBE (1, 2)")
def order_cube(spark: SparkSession, d: str) -> DataFrame:
    """A Spark extra: grouping sets."""
    o = table(spark, d, "orders").select(F.col("o_orderpriority").alias("priority"), F.expr("cast(date_trunc('MONTH', o_orderdate) as timestamp_ntz)").alias("month"))
    return o.cube("priority", "month").agg(F.count(F.lit(1)).alias("n"))



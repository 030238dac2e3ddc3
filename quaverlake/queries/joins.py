"""Joins, set operations and nested data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaverlake.functions import routing
from quaverlake.functions.paths import normal_relpath
from quaverlake.functions.values import joined_tokens
from quaverlake.operators import aggregates as A
from quaverlake.operators import joins as J

from quaverlake.queries.registry import FRAMES, RUNS, frames, query, runs, table


@query("SELECT o_custkey AS key, 'extra' AS side FROM orders WHERE o_custkey % 3 = 0 GROUP BY 1 UNION ALL SELECT c_custkey, 'missing' FROM customer WHERE c_custkey % 3 <> 0 AND c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_custkey % 3 <> 0)")
def coverage_gaps(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("key"))
    return J.coverage_gaps(c, table(spark, d, "orders").select(F.col("o_custkey").alias("key")), "key")


@query("SELECT n_nationkey, n_name, r_name FROM nation JOIN region ON n_regionkey = r_regionkey")
def covered_join(spark: SparkSession, d: str) -> DataFrame:
    n = table(spark, d, "nation").select(F.col("n_regionkey").alias("k"), "n_nationkey", "n_name")
    r = table(spark, d, "region").select(F.col("r_regionkey").alias("k"), "r_name")
    J.require_empty(J.coverage_gaps(r, n, "k"), "regions without nations", "k")
    return J.lookup(n, r, "k").drop("k")


@query(
    """WITH l AS (SELECT l_orderkey, count(*) AS n, max(l_tax) AS tax, min(l_discount) AS disc FROM lineitem GROUP BY 1)
SELECT o_orderkey, CASE WHEN l.l_orderkey IS NULL THEN 'music_cpu' WHEN n < 2 THEN 'music_cpu' WHEN disc > 0.03 THEN 'structure_raw' WHEN tax > 0.07 THEN 'alm' END AS failure_stage,
CASE WHEN l.l_orderkey IS NULL THEN 'missing' WHEN n < 2 THEN 'incomplete_music_cpu' WHEN disc > 0.03 THEN 'error' WHEN tax > 0.07 THEN 'empty_alm_caption' END AS failure FROM orders LEFT JOIN l ON o_orderkey = l_orderkey"""
)
def active_retry(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n"), F.max("l_tax").alias("tax"), F.min("l_discount").alias("disc"))  # noqa: E741
    status = lambda bad: F.create_map(F.lit("structure"), F.when(bad, "error").otherwise("ok"))
    none = F.create_map().cast("map<string,string>")
    ok = lambda s: F.create_map(F.lit(s), F.lit("ok"))
    cpu = l.select("o_orderkey", routing.stage_error("music_cpu", ok("music_cpu"), none, F.when(F.col("n") < 2, "incomplete_music_cpu")).alias("error"))
    raw = l.select("o_orderkey", routing.stage_error("structure_raw", status(F.col("disc") > 0.03), none).alias("error"))
    alm = l.select("o_orderkey", routing.stage_error("alm", ok("alm"), none, F.when(F.col("tax") > 0.07, "empty_alm_caption")).alias("error"))
    split = J.split_active(table(spark, d, "orders").select("o_orderkey"), [("music_cpu", cpu), ("structure_raw", raw), ("alm", alm)], "o_orderkey")
    return split.select("o_orderkey", "failure_stage", "failure")


@query("SELECT o_orderkey, c_name, c_custkey AS ordinal FROM orders JOIN customer ON o_custkey = c_custkey WHERE c_mktsegment = 'BUILDING'")
def keep_listed(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "customer").where("c_mktsegment = 'BUILDING'").select(F.col("c_custkey").alias("k"), "c_name", F.col("c_custkey").alias("ordinal"))
    o = table(spark, d, "orders").select(F.col("o_custkey").alias("k"), "o_orderkey")
    have = o.select("k").distinct()
    listed = J.keep_listed(have, c.join(have, "k", "left_semi"), "k", "ordinal")
    return o.join(listed, "k").join(c.select("k", "c_name"), "k").select("o_orderkey", "c_name", "ordinal")


@query("SELECT o_orderkey, 'pending' AS kind FROM orders WHERE NOT (o_orderkey % 3 = 0 AND o_orderkey % 15 <> 0) UNION ALL SELECT o_orderkey, 'changed' FROM orders WHERE o_orderkey % 15 = 0")
def resume_pending(spark: SparkSession, d: str) -> DataFrame:
    """A third of the orders is cached, some of it from an older input."""
    o = table(spark, d, "orders").select("o_orderkey", F.sha2(F.col("o_orderkey").cast("string"), 256).alias("fp"))
    cache = o.where("o_orderkey % 3 = 0").withColumn("fp", F.when(F.col("o_orderkey") % 15 == 0, "old").otherwise(F.col("fp")))
    J.require_empty(J.foreign(cache, o, "o_orderkey"), "foreign results", "o_orderkey")
    todo = J.pending(o, cache, ["o_orderkey", "fp"]).select("o_orderkey", F.lit("pending").alias("kind"))
    return todo.unionByName(J.changed_inputs(o, cache, "o_orderkey", "fp").select("o_orderkey", F.lit("changed").alias("kind")))


@query("SELECT d.doc_id, d.lang, CASE WHEN l.quality = 1 THEN 'reviewed' ELSE d.source END AS source, l.toxic FROM documents d LEFT JOIN labels l USING (doc_id)")
def overlay(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", F.when(F.col("quality") == 1, "reviewed").alias("source"), "toxic")
    return J.overlay(table(spark, d, "documents").select("doc_id", "lang", "source"), labels, "doc_id")


_PARTS = """WITH t AS (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN lang END AS a, NULL::VARCHAR AS b, 0 AS o FROM documents UNION ALL SELECT doc_id, CASE WHEN quality = 1 THEN 'en' ELSE 'xx' END, 'q' || quality, 1 FROM labels UNION ALL SELECT doc_id, lang, source, 2 FROM documents WHERE doc_id % 3 = 0)"""


def _parts(spark: SparkSession, d: str) -> list[DataFrame]:
    docs, labels = table(spark, d, "documents"), table(spark, d, "labels")
    return [
        docs.select("doc_id", F.when(F.col("doc_id") % 2 == 0, F.col("lang")).alias("a")),
        labels.select("doc_id", F.when(F.col("quality") == 1, "en").otherwise("xx").alias("a"), F.concat(F.lit("q"), F.col("quality").cast("string")).alias("b")),
        docs.where("doc_id % 3 = 0").select("doc_id", F.col("lang").alias("a"), F.col("source").alias("b")),
    ]


@query(
    _PARTS
    + """, w AS (SELECT doc_id, arg_min(a, o) FILTER (WHERE a IS NOT NULL) AS a, arg_min(b, o) FILTER (WHERE b IS NOT NULL) AS b FROM t GROUP BY 1)
SELECT t.doc_id, any_value(w.a) AS a, any_value(w.b) AS b, (sum((coalesce(t.a <> w.a, false))::INT) + sum((coalesce(t.b <> w.b, false))::INT))::BIGINT AS conflicts FROM t JOIN w USING (doc_id) GROUP BY 1"""
)
def merge_first(spark: SparkSession, d: str) -> DataFrame:
    return J.merge_first(_parts(spark, d), "doc_id").select("doc_id", "a", "b", F.col("conflicts").cast("long").alias("conflicts"))


@query(_PARTS + " SELECT doc_id, arg_max(a, o) FILTER (WHERE a IS NOT NULL) AS a, arg_max(b, o) FILTER (WHERE b IS NOT NULL) AS b FROM t GROUP BY 1")
def overlay_last(spark: SparkSession, d: str) -> DataFrame:
    return J.overlay_last(_parts(spark, d), "doc_id").select("doc_id", "a", "b")


@query("SELECT doc_id, 'lang=' || CASE WHEN quality IS NOT NULL THEN 'q' || quality ELSE lang END || ';source=' || source || CASE WHEN toxic IS NOT NULL THEN ';toxic=' || toxic ELSE '' END AS merged FROM documents LEFT JOIN labels USING (doc_id)")
def overlay_maps(spark: SparkSession, d: str) -> DataFrame:
    """Map columns merge entry by entry, the last wins."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    docs = table(spark, d, "documents").select("doc_id", F.create_map(F.lit("lang"), F.col("lang"), F.lit("source"), F.col("source")).alias("m"))
    labels = table(spark, d, "labels").select("doc_id", F.create_map(F.lit("lang"), F.concat(F.lit("q"), F.col("quality").cast("string")), F.lit("toxic"), F.col("toxic").cast("string")).alias("m"))
    out = J.overlay_last([docs, labels], "doc_id", ["m"])
    entries = F.array_sort(F.transform(F.map_entries("m"), lambda e: F.concat(e["key"], F.lit("="), e["value"])))
    return out.select("doc_id", F.array_join(entries, ";").alias("merged"))


@query(
    """WITH a AS (SELECT l_orderkey, l_linenumber, l_quantity AS s, l_quantity + 10 AS e FROM lineitem WHERE l_linenumber < 6), b AS (SELECT l_orderkey, l_linenumber, l_quantity + CASE WHEN l_partkey % 10 = 0 THEN 0.5 ELSE 0.0005 END AS s, l_quantity + 10 AS e FROM lineitem WHERE l_linenumber > 1)
SELECT coalesce(a.l_orderkey, b.l_orderkey) AS l_orderkey, lpad(coalesce(a.l_linenumber, b.l_linenumber)::VARCHAR, 4, '0') AS section_id, CASE WHEN a.s IS NULL THEN 'extra' WHEN b.s IS NULL THEN 'missing' WHEN abs(a.s - b.s) > 0.001 THEN 'bounds differ' END AS problem FROM a FULL JOIN b ON a.l_orderkey = b.l_orderkey AND a.l_linenumber = b.l_linenumber"""
)
def join_sections(spark: SparkSession, d: str) -> DataFrame:
    l = table(spark, d, "lineitem").withColumn("section_id", F.lpad(F.col("l_linenumber").cast("string"), 4, "0"))  # noqa: E741
    a = l.where("l_linenumber < 6").select("l_orderkey", "section_id", F.col("l_quantity").alias("start"), (F.col("l_quantity") + 10).alias("end"))
    off = F.when(F.col("l_partkey") % 10 == 0, 0.5).otherwise(0.0005)
    b = l.where("l_linenumber > 1").select("l_orderkey", "section_id", (F.col("l_quantity") + off).alias("start"), (F.col("l_quantity") + 10).alias("end"), F.col("l_tax").alias("score"))
    return J.join_sections(a, b, "l_orderkey").select("l_orderkey", "section_id", "problem")


@query(
    "WITH "
    + FRAMES
    + """, p AS (SELECT user_id, event_id, c.t, q.t AS n, row_number() OVER (PARTITION BY c.event_id ORDER BY abs(q.t - c.t), q.t) AS k FROM f c JOIN (SELECT user_id, t FROM f WHERE event_type = 'purchase') q USING (user_id) WHERE event_type = 'click' AND abs(q.t - c.t) <= 21600)
SELECT c.user_id, c.event_id, round(coalesce(p.n, c.t), 3) AS snapped, p.n IS NOT NULL AS moved FROM f c LEFT JOIN p ON p.event_id = c.event_id AND k = 1 WHERE event_type = 'click'"""
)
def nearest_snap(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    near = J.nearest(f.where("event_type = 'click'"), f.where("event_type = 'purchase'"), ["user_id"], "t", "t", 21600.0, ["event_id"])
    return near.select("user_id", "event_id", F.round(J.snapped(F.col("t"), F.col("nearest")), 3).alias("snapped"), F.col("nearest").isNotNull().alias("moved"))


@query(
    "WITH "
    + RUNS
    + """, u AS (SELECT DISTINCT user_id FROM s), i AS (SELECT user_id, k, k * 432000.0 AS a, (k + 1) * 432000.0 AS z FROM u, (SELECT unnest(range(6)) AS k)),
j AS (SELECT i.user_id, k, label, raw_start, row_number() OVER (PARTITION BY i.user_id, k ORDER BY (raw_start <= (a + z) / 2 AND (a + z) / 2 < raw_end) DESC, greatest(0, least(z, raw_end) - greatest(a, raw_start)) DESC, raw_start, raw_end) AS r FROM i JOIN s USING (user_id))
SELECT user_id, k, label, round(raw_start, 3) AS raw_start FROM j WHERE r = 1"""
)
def overlap_argmax(spark: SparkSession, d: str) -> DataFrame:
    s = runs(spark, d).select("user_id", "label", "raw_start", "raw_end")
    i = s.select("user_id").distinct().select("user_id", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(5).cast("long"))).alias("k"))
    i = i.withColumns({"start": F.col("k") * 432000.0, "end": (F.col("k") + 1) * 432000.0})
    return J.overlap_argmax(i, s, ["user_id"], ["k"], 432000.0).select("user_id", "k", "label", F.round("raw_start", 3).alias("raw_start"))


@query(
    "WITH "
    + FRAMES
    + """, x AS (SELECT user_id, list(p ORDER BY t, event_id) AS v FROM f GROUP BY 1), w AS (SELECT user_id, v, k, k * 13.7 AS a, (k + 1) * 13.7 AS z FROM (SELECT user_id, v, unnest(range(ceil(len(v) * 2.5 / 13.7)::BIGINT)) AS k FROM x)),
c AS (SELECT user_id, k, v[greatest(0, floor(a / 2.5))::INT + 1 : least(len(v), ceil(z / 2.5))::INT] AS s FROM w) SELECT user_id, k, len(s) AS frames, round(list_avg(s) + 1e-9, 4) AS mean FROM c"""
)
def interval_slice(spark: SparkSession, d: str) -> DataFrame:
    held = frames(spark, d).groupBy("user_id").agg(F.array_sort(F.collect_list(F.struct("t", "event_id", "p"))).alias("v")).select("user_id", F.col("v.p").alias("v"))
    w = held.withColumn("k", F.explode(F.sequence(F.lit(0).cast("long"), F.ceil(F.size("v") * 2.5 / 13.7) - 1))).withColumn("s", J.frame_slice("v", F.col("k") * 13.7, (F.col("k") + 1) * 13.7, 2.5))
    mean = F.when(F.size("s") > 0, F.aggregate("s", F.lit(0.0), lambda a, x: a + x) / F.size("s"))
    return w.select("user_id", "k", F.size("s").cast("long").alias("frames"), F.round(mean + 1e-9, 4).alias("mean"))


@query(
    "WITH "
    + RUNS
    + """, h AS (SELECT user_id, floor(t / 86400)::BIGINT AS frame, avg(p) AS p FROM f GROUP BY 1, 2) SELECT s.user_id, n::BIGINT AS n, count(*) AS frames, round(avg(p) + 1e-9, 4) AS voice_score, round(avg((p >= 0.5)::INT) + 1e-9, 4) AS voice_coverage FROM s JOIN h ON h.user_id = s.user_id AND frame >= floor(raw_start / 86400) AND frame < ceil(raw_end / 86400) GROUP BY 1, 2"""
)
def frames_in_sections(spark: SparkSession, d: str) -> DataFrame:
    h = frames(spark, d).groupBy("user_id", F.floor(F.col("t") / 86400).alias("frame")).agg(F.avg("p").alias("p"))
    s = runs(spark, d).select("user_id", F.col("n").cast("long").alias("n"), F.col("raw_start").alias("start"), F.col("raw_end").alias("end"))
    rows = J.frames_in_sections(h, s, ["user_id"], "frame", 86400.0)
    return rows.groupBy("user_id", "n").agg(F.count(F.lit(1)).alias("frames"), F.round(F.avg("p") + 1e-9, 4).alias("voice_score"), F.round(F.avg((F.col("p") >= 0.5).cast("double")) + 1e-9, 4).alias("voice_coverage"))


@query(
    """WITH t AS (SELECT conv_id, turn, role, (turn * 10 + 5.0)::DOUBLE AS a, turn * 10 + length(text) / 100.0 + 5 AS z FROM conversations)
SELECT conv_id, count(*) AS tokens, string_agg(role, ' ' ORDER BY turn) AS text, round(min(a), 3) AS first, round(max(z), 3) AS last FROM t WHERE (a + z) / 2 >= 15 AND (a + z) / 2 < 45 GROUP BY 1"""
)
def token_crop(spark: SparkSession, d: str) -> DataFrame:
    c = table(spark, d, "conversations")
    token = F.struct(F.col("turn"), F.col("role").alias("text"), (F.col("turn") * 10.0).alias("start"), (F.col("turn") * 10 + F.length("text") / 100.0).alias("end"))
    held = c.groupBy("conv_id").agg(F.array_sort(F.collect_list(token)).alias("tokens"))
    cut = held.select("conv_id", J.crop_tokens("tokens", F.lit(5.0), F.lit(15.0), F.lit(45.0)).alias("t")).where(F.size("t") > 0)
    return cut.select("conv_id", F.size("t").cast("long").alias("tokens"), joined_tokens(F.col("t.text"), F.lit("english")).alias("text"), F.round(F.array_min("t.start"), 3).alias("first"), F.round(F.array_max("t.end"), 3).alias("last"))


_URL = """regexp_replace(regexp_replace(regexp_extract(url, '://[^/]*/([^?#]*)', 1), '/+$', ''), '\\.html$', '')"""


@query(
    f"""WITH p AS (SELECT page_id, CASE WHEN page_id % 10 = 0 THEN split_part({_URL}, '/', 1) || '/0' ELSE {_URL} || CASE WHEN page_id % 7 = 0 THEN '/0/x' ELSE '' END END AS path FROM pages),
s AS (SELECT page_id FROM p WHERE path IN (SELECT path FROM p GROUP BY 1 HAVING count(*) > 1)), i AS (SELECT a.page_id AS x, b.page_id AS y FROM p a JOIN p b ON starts_with(a.path, b.path || '/'))
SELECT page_id FROM s UNION SELECT x FROM i UNION SELECT y FROM i"""
)
def path_conflicts(spark: SparkSession, d: str) -> DataFrame:
    pages = table(spark, d, "pages").select("page_id", normal_relpath(F.regexp_replace(F.regexp_replace(F.regexp_extract("url", "://[^/]*/([^?#]*)", 1), "/+$", ""), r"\.html$", "")).alias("path"))
    bent = F.when(F.col("page_id") % 10 == 0, F.concat(F.split_part("path", F.lit("/"), F.lit(1)), F.lit("/0"))).otherwise(F.concat("path", F.when(F.col("page_id") % 7 == 0, "/0/x").otherwise("")))
    return J.path_conflicts(pages.withColumn("path", bent), "page_id", "path")


@query("SELECT s_suppkey, s_name, n_name FROM supplier JOIN nation ON s_nationkey = n_nationkey")
def metadata_lookup(spark: SparkSession, d: str) -> DataFrame:
    s = table(spark, d, "supplier").select("s_suppkey", "s_name", F.col("s_nationkey").alias("k"))
    return J.lookup(s, table(spark, d, "nation").select(F.col("n_nationkey").alias("k"), "n_name"), "k").drop("k")


@query("SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'missing_prediction' WHEN quality IS NULL THEN 'invalid_prediction' END AS error FROM documents d LEFT JOIN (SELECT doc_id, CASE WHEN toxic = 0 THEN quality END AS quality FROM labels) l USING (doc_id)")
def merge_back(spark: SparkSession, d: str) -> DataFrame:
    labels = table(spark, d, "labels").select("doc_id", F.when(F.col("toxic") == 0, F.col("quality")).alias("result"))
    return J.merge_back(table(spark, d, "documents").select("doc_id"), labels, "doc_id", "result").select("doc_id", "error")


@query(
    """WITH e AS (SELECT user_id, event_id, event_type, epoch_ms(ts) - epoch_ms(timestamp '2024-01-01') AS t FROM events), a AS (SELECT user_id, t, max(event_type) AS l FROM e WHERE event_id % 2 = 0 GROUP BY 1, 2), b AS (SELECT user_id, t, max(event_type) AS l FROM e WHERE event_id % 2 = 1 GROUP BY 1, 2),
r AS (SELECT user_id, greatest(a0, b0) AS lo, least(a1, b1) AS hi FROM (SELECT user_id, min(t) AS a0, max(t) AS a1 FROM a GROUP BY 1) JOIN (SELECT user_id, min(t) AS b0, max(t) AS b1 FROM b GROUP BY 1) USING (user_id)),
p AS (SELECT user_id, t FROM a UNION SELECT user_id, t FROM b), q AS (SELECT p.user_id, t, lead(t) OVER (PARTITION BY p.user_id ORDER BY t) AS n, lo, hi FROM p JOIN r USING (user_id)),
x AS (SELECT q.user_id, least(q.n, hi) - q.t AS d, a.l AS la, b.l AS lb FROM q ASOF JOIN a ON a.user_id = q.user_id AND q.t >= a.t ASOF JOIN b ON b.user_id = q.user_id AND q.t >= b.t WHERE q.t >= lo AND q.t < hi)
SELECT user_id, round(sum(CASE WHEN la = lb THEN d ELSE 0 END)::DOUBLE / sum(d), 4) AS accuracy FROM x GROUP BY 1"""
)
def timeline_accuracy(spark: SparkSession, d: str) -> DataFrame:
    ms = F.expr("timestampdiff(MILLISECOND, timestamp_ntz'2024-01-01 00:00:00', ts)") / 1000
    e = table(spark, d, "events").select("user_id", "event_id", "event_type", ms.alias("t"))
    one = lambda r: e.where(F.col("event_id") % 2 == r).groupBy("user_id", "t").agg(F.max("event_type").alias("event_type"))
    out = J.timeline_accuracy(one(0), one(1), ["user_id"], "t", "event_type")
    return out.select("user_id", F.round("accuracy", 4).alias("accuracy"))


@query("SELECT 'd' || doc_id AS key, length(text) AS n, 'documents' AS origin FROM documents UNION ALL SELECT 'b' || item_id, length(text), 'benchmark' FROM benchmark")
def unique_union(spark: SparkSession, d: str) -> DataFrame:
    a = table(spark, d, "documents").select(F.concat(F.lit("d"), F.col("doc_id").cast("string")).alias("key"), F.length("text").cast("long").alias("n"), F.lit("documents").alias("origin"))
    b = table(spark, d, "benchmark").select(F.concat(F.lit("b"), F.col("item_id").cast("string")).alias("key"), F.length("text").cast("long").alias("n"), F.lit("benchmark").alias("origin"))
    return J.unique_union([a, b], "key")


@query("(SELECT o_custkey AS k, 'both' AS side FROM orders INTERSECT SELECT c_custkey, 'both' FROM customer) UNION ALL (SELECT c_custkey, 'only customer' FROM customer EXCEPT SELECT o_custkey, 'only customer' FROM orders)")
def set_operations(spark: SparkSession, d: str) -> DataFrame:
    o, c = table(spark, d, "orders").select(F.col("o_custkey").alias("k")), table(spark, d, "customer").select(F.col("c_custkey").alias("k"))
    return o.intersect(c).withColumn("side", F.lit("both")).unionByName(c.subtract(o).withColumn("side", F.lit("only customer")))


@query("SELECT r_name, side FROM (SELECT r_name, 'written' AS side FROM region WHERE r_regionkey = 1 UNION ALL SELECT upper(r_name) || '!', 'expected' FROM region WHERE r_regionkey = 1)")
def tree_differences(spark: SparkSession, d: str) -> DataFrame:
    r = table(spark, d, "region").select("r_regionkey", "r_name")
    changed = r.withColumn("r_name", F.when(F.col("r_regionkey") == 1, F.concat(F.upper("r_name"), F.lit("!"))).otherwise(F.col("r_name")))
    return J.tree_differences(r, changed).select("r_name", "side")


@query(
    "WITH "
    + FRAMES
    + """, p AS (SELECT user_id, event_type, t FROM f WHERE event_type IN ('click', 'purchase')), a AS (SELECT event_type, t, EXISTS (SELECT 1 FROM p q WHERE q.user_id = p.user_id AND q.event_type <> p.event_type AND abs(q.t - p.t) <= 43200) AS hit FROM p),
r AS (SELECT avg(hit::INT) FILTER (WHERE event_type = 'click') AS recall, avg(hit::INT) FILTER (WHERE event_type = 'purchase') AS prec FROM a) SELECT round(recall, 4) AS recall, round(prec, 4) AS precision, round(2 * recall * prec / (recall + prec), 4) AS f_measure FROM r"""
)
def hit_rates(spark: SparkSession, d: str) -> DataFrame:
    f = frames(spark, d)
    ref, est = f.where("event_type = 'click'"), f.where("event_type = 'purchase'")
    near = lambda a, b: J.nearest(a, b, ["user_id"], "t", "t", 43200.0, ["event_id"])
    out = A.hit_rates(near(ref, est), near(est, ref), F.col("nearest").isNotNull())
    return out.select(F.round("recall", 4).alias("recall"), F.round("precision", 4).alias("precision"), F.round("f_measure", 4).alias("f_measure"))



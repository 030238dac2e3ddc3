"""Identities, paths, formats and nested values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaverlake.functions import hashing, paths, routing, values
from quaverlake.operators import aggregates as A
from quaverlake.queries.registry import query, table


@query(
    """WITH g AS (SELECT sha256(text) AS audio_id, list_sort(list(lpad(doc_id::VARCHAR, 10, '0'))) AS p FROM documents GROUP BY 1)
SELECT audio_id, p[1] AS path, array_to_string(p[2:], ',') AS duplicate_paths, len(p) - 1 AS duplicate_count FROM g"""
)
def content_dedup(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.lpad(F.col("doc_id").cast("string"), 10, "0").alias("path"), "text")
    out = A.content_dedup(docs, hashing.content_id(F.encode("text", "UTF-8")), "path")
    return out.select("audio_id", "path", F.array_join("duplicate_paths", ",").alias("duplicate_paths"), "duplicate_count")


@query(
    """SELECT doc_id, sha256('{"doc_id":' || doc_id || ',"lang":' || coalesce('"' || lang || '"', 'null') || ',"n_chars":' || n_chars || ',"source":"' || source || '"}') AS fingerprint,
sha256('job' || chr(0) || doc_id || chr(0) || 'music_cpu' || chr(0) || lang) AS request_id, left(sha256(source), 24) AS short_id, sha1(source) AS uid FROM documents"""
)
def fingerprints(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("doc_id", "lang", "n_chars", "source")
    return docs.select(
        "doc_id",
        hashing.fingerprint({c: F.col(c) for c in ("source", "lang", "n_chars", "doc_id")}).alias("fingerprint"),
        hashing.request_id(F.lit("job"), F.col("doc_id").cast("string"), F.lit("music_cpu"), F.col("lang")).alias("request_id"),
        hashing.short_id("source").alias("short_id"),
        hashing.uid("source").alias("uid"),
    )


@query("""SELECT lang, sha256(string_agg(h, chr(10) ORDER BY h)) AS manifest, count(*) AS rows FROM (SELECT lang, sha256('{"doc_id":' || doc_id || ',"source":"' || source || '"}') AS h FROM documents) GROUP BY 1""")
def manifest_hash(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select("lang", "doc_id", "source")
    return A.manifest_hash(docs, ["lang"], hashing.fingerprint({"doc_id": F.col("doc_id"), "source": F.col("source")}))


@query(
    """SELECT l_orderkey, sha256('{"audio_id":"' || l_orderkey || '","content_type":"song","sections":[' || string_agg('{"end":' || (l_quantity + 10)::DOUBLE || ',"label":"' || l_returnflag || '","section_id":"' || lpad(l_linenumber::VARCHAR, 4, '0') || '","start":' || l_quantity::DOUBLE || ',"voice_coverage":' || l_discount::DOUBLE || '}', ',' ORDER BY l_linenumber, l_quantity, l_returnflag, l_discount) || ']}') AS sections_hash FROM lineitem GROUP BY l_orderkey"""
)
def sections_hash(spark: SparkSession, d: str) -> DataFrame:
    section = F.struct(F.col("l_linenumber").alias("n"), F.lpad(F.col("l_linenumber").cast("string"), 4, "0").alias("section_id"), F.col("l_quantity").alias("start"), (F.col("l_quantity") + 10).alias("end"), F.col("l_returnflag").alias("label"), F.col("l_discount").alias("voice_coverage"))
    held = table(spark, d, "lineitem").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(section)).alias("s"))
    return held.select("l_orderkey", hashing.sections_hash(F.col("l_orderkey"), F.lit("song"), "s").alias("sections_hash"))


@query(
    """SELECT o_orderkey, sha256('{"audio_id":"' || o_orderkey || '","audio_path":"a/' || o_orderkey || '","content_type":"' || o_orderstatus || '","duration":' || o_totalprice::DOUBLE || ',"source_relpath":null,"stage":"structure_raw"}') AS semantic,
sha256('{"record":{"o_orderkey":' || o_orderkey || ',"o_orderstatus":"' || o_orderstatus || '"},"stage":"music_gate"}') AS whole FROM orders"""
)
def record_fingerprints(spark: SparkSession, d: str) -> DataFrame:
    o = table(spark, d, "orders")
    key = F.col("o_orderkey")
    semantic = hashing.input_fingerprint("structure_raw", key, F.concat(F.lit("a/"), key.cast("string")), F.lit(None).cast("string"), F.col("o_totalprice"), F.col("o_orderstatus"))
    whole = hashing.record_fingerprint("music_gate", {"o_orderkey": key, "o_orderstatus": F.col("o_orderstatus"), "o_totalprice": F.col("o_totalprice")}, ("o_totalprice",))
    return o.select("o_orderkey", semantic.alias("semantic"), whole.alias("whole"))


@query(
    """SELECT doc_id, 'audio_bytes=x;duration=' || coalesce(n_chars::VARCHAR, 'null') || ';path=' || coalesce(source, 'null') || ';subset_name=' || CASE WHEN doc_id % 2 = 0 THEN 'even' ELSE 'null' END AS known, 'lang=' || coalesce(lang, 'null') AS extra,
concat_ws(';', 'duration=' || n_chars, 'lang=' || coalesce(lang, 'null'), 'path=' || source, CASE WHEN doc_id % 2 = 0 THEN 'subset_name=even' END) AS fields FROM documents"""
)
def known_fields(spark: SparkSession, d: str) -> DataFrame:
    fields = {"path": F.col("source"), "duration": F.col("n_chars").cast("string"), "lang": F.col("lang"), "audio_bytes": F.lit("x"), "subset_name": F.when(F.col("doc_id") % 2 == 0, "even")}
    docs = table(spark, d, "documents").select("doc_id", F.create_map(*(c for k, v in fields.items() for c in (F.lit(k), v))).alias("m"))
    known, extra = routing.split_known("m", ["path", "duration", "audio_bytes", "subset_name"])
    shown = lambda m: F.array_join(F.array_sort(F.transform(F.map_entries(m), lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))), ";")
    return docs.select("doc_id", shown(known).alias("known"), shown(extra).alias("extra"), shown(routing.joined_fields(known, extra)).alias("fields"))


_PATH = "regexp_extract(url, '://[^/]*(/[^?#]*)', 1)"


@query(
    f"""WITH p AS (SELECT page_id, CASE WHEN page_id % 9 = 0 THEN {_PATH} WHEN page_id % 9 = 1 THEN 'a/../' || page_id WHEN page_id % 9 = 2 THEN './x//' || page_id ELSE ltrim({_PATH}, '/') END AS path FROM pages)
SELECT page_id, CASE WHEN starts_with(path, '/') OR page_id % 9 = 1 THEN NULL WHEN page_id % 9 = 2 THEN 'x/' || page_id ELSE rtrim(path, '/') END AS relpath,
'file:///music/' || page_id || '%20a%2Bb.mp3' AS uri, CASE WHEN page_id % 2 = 0 THEN '/new/t' || page_id ELSE '/other/t' || page_id END AS moved FROM p"""
)
def path_functions(spark: SparkSession, d: str) -> DataFrame:
    raw = F.regexp_extract("url", "://[^/]*(/[^?#]*)", 1)
    n = F.col("page_id").cast("string")
    path = F.when(F.col("page_id") % 9 == 0, raw).when(F.col("page_id") % 9 == 1, F.concat(F.lit("a/../"), n)).when(F.col("page_id") % 9 == 2, F.concat(F.lit("./x//"), n)).otherwise(F.ltrim(raw, F.lit("/")))
    pages = table(spark, d, "pages").select("page_id", path.alias("path"), n.alias("n"))
    moved = paths.swap_prefix(F.concat(F.when(F.col("page_id") % 2 == 0, "/old/t").otherwise("/other/t"), "n"), "/old/", "/new/")
    return pages.select("page_id", paths.normal_relpath("path").alias("relpath"), paths.file_uri(F.concat(F.lit("/music/"), "n", F.lit(" a+b.mp3"))).alias("uri"), moved.alias("moved"))


@query("SELECT doc_id, source || '/' || CASE WHEN length(lang) > 0 THEN lang || doc_id || '.json' END AS target FROM documents")
def annotation_paths(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents")
    return docs.select("doc_id", paths.annotation_relpath(F.concat("source", F.lit("/"), "lang", F.col("doc_id").cast("string"))).alias("target"))


@query("SELECT o_orderkey, printf('%02d:%02d:%02d.%03d', ms // 3600000, ms // 60000 % 60, ms // 1000 % 60, ms % 1000) AS elapsed FROM (SELECT o_orderkey, round(o_totalprice * 1000)::BIGINT AS ms FROM orders)")
def elapsed_format(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "orders").select("o_orderkey", values.elapsed("o_totalprice").alias("elapsed"))


@query(
    """WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS v FROM embeddings)
SELECT vec_id, round(sqrt(list_dot_product(v, v)), 4) AS norm, round(1 / (1 + exp(-v[1])), 4) AS sig, round(exp(v[1]) / list_sum(list_transform(v, lambda x: exp(x))), 4) AS soft, round(greatest(-1, least(1, list_dot_product(v, list_reverse(v)) / list_dot_product(v, v))), 4) AS cos FROM v"""
)
def vector_functions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "embeddings").select("vec_id", F.transform("embedding", lambda x: x.cast("double")).alias("v"))
    return e.select("vec_id", F.round(values.norm("v"), 4).alias("norm"), F.round(values.sigmoid(F.col("v")[0]), 4).alias("sig"), F.round(values.softmax("v")[0], 4).alias("soft"), F.round(values.cosine("v", F.reverse("v")), 4).alias("cos"))


@query("SELECT conv_id, CASE WHEN conv_id % 3 = 0 THEN replace(t, ' ', '') ELSE t END AS text FROM (SELECT conv_id, coalesce(string_agg(trim(role), ' ' ORDER BY turn) FILTER (WHERE turn % 4 <> 3), '') AS t FROM conversations GROUP BY conv_id)")
def joined_tokens(spark: SparkSession, d: str) -> DataFrame:
    token = F.struct("turn", F.when(F.col("turn") % 4 == 3, "  ").otherwise(F.concat(F.lit(" "), "role", F.lit(" "))).alias("t"))
    held = table(spark, d, "conversations").groupBy("conv_id").agg(F.array_sort(F.collect_list(token)).alias("t"))
    return held.select("conv_id", values.joined_tokens(F.col("t.t"), F.when(F.col("conv_id") % 3 == 0, "Japanese").otherwise("english")).alias("text"))


@query(
    """SELECT event_id, CASE WHEN event_id % 4 = 0 THEN 'k' || json_extract_string(props, '$.k') WHEN event_id % 4 = 3 THEN 'a b' END AS caption,
CASE event_id % 4 WHEN 1 THEN 'answer was cut short' WHEN 2 THEN 'no choices' END AS error FROM events"""
)
def captions(spark: SparkSession, d: str) -> DataFrame:
    k = F.get_json_object("props", "$.k")
    body = (
        F.when(F.col("event_id") % 4 == 0, F.concat(F.lit('{"choices":[{"finish_reason":"stop","message":{"content":" k'), k, F.lit('"}}]}')))
        .when(F.col("event_id") % 4 == 1, F.lit('{"choices":[{"finish_reason":"length","message":{"content":"half"}}]}'))
        .when(F.col("event_id") % 4 == 2, F.lit('{"choices":[]}'))
        .otherwise(F.lit('{"choices":[{"finish_reason":"stop","message":{"content":[{"type":"text","text":"a "},{"type":"text","text":"b"}]}}]}'))
    )
    return table(spark, d, "events").select("event_id", values.caption(body).alias("c")).select("event_id", "c.caption", "c.error")


@query("SELECT user_id, string_agg(DISTINCT (event_id % 50)::VARCHAR, ',' ORDER BY (event_id % 50)::VARCHAR) FILTER (WHERE event_type = 'purchase') AS beats FROM events GROUP BY 1")
def downbeats(spark: SparkSession, d: str) -> DataFrame:
    beat = F.struct((F.col("event_id") % 50).cast("double").alias("timestamp"), F.when(F.col("event_type") == "purchase", 1).otherwise(2).alias("beat"))
    held = table(spark, d, "events").groupBy("user_id").agg(F.collect_list(beat).alias("b"))
    names = F.transform(routing.downbeats("b"), lambda x: x.cast("long").cast("string"))
    return held.select("user_id", F.nullif(F.array_join(F.array_sort(names), ","), F.lit("")).alias("beats"))


@query(
    """SELECT user_id, string_agg(DISTINCT v::VARCHAR, ',' ORDER BY v::VARCHAR) FILTER (WHERE event_type = 'purchase') AS beats
FROM (SELECT user_id, event_type, event_id % CASE user_id % 3 WHEN 0 THEN 50 WHEN 1 THEN 30 ELSE 20 END AS v FROM events) GROUP BY 1"""
)
def downbeat_sources(spark: SparkSession, d: str) -> DataFrame:
    """Of three sources of beats, the first as pairs, the first that holds any counts."""
    number = F.when(F.col("event_type") == "purchase", 1.0).otherwise(2.0)
    at = lambda n: (F.col("event_id") % n).cast("double")
    beat = lambda n: F.struct(at(n).alias("timestamp"), number.alias("beat"))
    pairs = F.when(F.col("user_id") % 3 == 0, F.array(at(50), number))
    held = table(spark, d, "events").groupBy("user_id").agg(F.collect_list(pairs).alias("a"), F.collect_list(F.when(F.col("user_id") % 3 == 1, beat(30))).alias("b"), F.collect_list(beat(20)).alias("c"))
    names = F.transform(routing.downbeats(routing.first_filled(routing.paired_beats("a"), "b", "c")), lambda x: x.cast("long").cast("string"))
    return held.select("user_id", F.nullif(F.array_join(F.array_sort(names), ","), F.lit("")).alias("beats"))


@query("SELECT user_id, count(*) FILTER (WHERE event_type <> 'error') AS chords FROM events GROUP BY 1")
def real_chords(spark: SparkSession, d: str) -> DataFrame:
    chord = F.struct(F.when(F.col("event_type") == "error", "N").otherwise(F.col("event_type")).alias("chord"), F.col("event_id").alias("timestamp"))
    held = table(spark, d, "events").groupBy("user_id").agg(F.collect_list(chord).alias("c"))
    return held.select("user_id", F.size(routing.real_chords("c")).cast("long").alias("chords"))


@query("SELECT doc_id, CASE WHEN n_chars > 3000 THEN 'chords_error' WHEN lang = 'fr' THEN 'key_error' ELSE '' END AS errors, CASE WHEN n_chars > 3000 OR lang = 'fr' THEN 'partial_error' ELSE 'ok' END AS status FROM documents")
def nested_errors(spark: SparkSession, d: str) -> DataFrame:
    m = F.create_map(F.lit("chords_error"), F.when(F.col("n_chars") > 3000, "x"), F.lit("key_error"), F.when((F.col("n_chars") <= 3000) & (F.col("lang") == "fr"), "y").otherwise(""), F.lit("chords"), F.lit("C"))
    docs = table(spark, d, "documents").select("doc_id", m.alias("m"))
    return docs.select("doc_id", F.array_join(routing.nested_errors("m"), ",").alias("errors"), routing.surfaced_status("m").alias("status"))


@query("SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_shipmode END AS lyrics, CASE WHEN l_returnflag = 'R' THEN 'not_applicable' ELSE 'ok' END AS asr_status FROM (SELECT l_orderkey, l_linenumber, l_returnflag, l_linestatus AS l_shipmode FROM lineitem)")
def instrumental_sections(spark: SparkSession, d: str) -> DataFrame:
    section = F.struct("l_linenumber", F.col("l_linestatus").alias("lyrics"), F.array().cast("array<struct<text:string,start:double,end:double>>").alias("asr_tokens"), F.lit("ok").alias("asr_status"), F.lit("gone").alias("key_status"))
    one = table(spark, d, "lineitem").select("l_orderkey", F.col("l_returnflag").alias("flag"), F.array(section).alias("s"))
    s = routing.drop_section_fields("s", ["key_status"])
    kept = F.when(F.col("flag") == "R", routing.instrumental_sections(s)).otherwise(s)
    return one.select("l_orderkey", F.explode(kept).alias("x")).select("l_orderkey", "x.l_linenumber", "x.lyrics", "x.asr_status")


@query("SELECT p_partkey, replace(lower(trim(p_type)), '_', '-') AS label, len(string_split(p_name, ' ')) AS words FROM part")
def label_functions(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "part").select("p_partkey", paths.normal_label("p_type").alias("label"), F.size(F.split("p_name", " ")).cast("long").alias("words"))

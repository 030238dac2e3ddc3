"""Resume, partitions, upserts, validation and streams."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaverlake.operators import aggregates as A
from quaverlake.operators import joins as J
from quaverlake.plans import batch
from quaverlake.queries.registry import query, table
from quaverlake.streaming import streams


@query("SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, arg_max(event_type, (ts, event_id)) AS event_type, round(arg_max(value, (ts, event_id)), 4) AS value FROM events GROUP BY 1")
def latest_per_key(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "ts", "event_id", "event_type", "value")
    return A.latest(e, ["user_id"], ["ts", "event_id"]).select("user_id", "event_id", "event_type", F.round("value", 4).alias("value"))


_STATUS = "CASE event_type WHEN 'purchase' THEN 'completed' WHEN 'error' THEN 'failed' WHEN 'click' THEN 'allocated' ELSE 'unallocated' END"


@query(
    f"""WITH l AS (SELECT user_id, arg_max({_STATUS}, event_id) AS s FROM events GROUP BY 1)
SELECT count(*) AS total, count(*) FILTER (WHERE s = 'completed') AS completed, count(*) FILTER (WHERE s = 'failed') AS failed, count(*) FILTER (WHERE s = 'allocated') AS allocated, count(*) FILTER (WHERE s = 'unallocated') AS unallocated FROM l"""
)
def task_progress(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select("user_id", "event_id", F.expr(_STATUS).alias("status"))
    return A.progress(e, "user_id", "status", "event_id")


@query(
    """WITH p AS (SELECT doc_id, 'annotations' AS part FROM labels WHERE quality = 1 AND toxic = 0 UNION ALL SELECT doc_id, 'review' FROM labels WHERE quality = 0 AND toxic = 0 UNION ALL SELECT doc_id, 'rejected' FROM labels WHERE toxic = 1
UNION ALL SELECT doc_id, 'retry' FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels) AND doc_id % 7 <> 0 UNION ALL SELECT doc_id, 'retry' FROM labels WHERE doc_id % 50 = 0 UNION ALL SELECT -item_id - 1, 'review' FROM benchmark),
g AS (SELECT doc_id, count(*) AS n, string_agg(part, ',' ORDER BY part) AS partitions FROM p GROUP BY 1)
SELECT coalesce(d.doc_id, g.doc_id) AS doc_id, CASE WHEN d.doc_id IS NULL THEN 'foreign' WHEN n IS NULL THEN 'missing' ELSE 'repeated' END AS problem, coalesce(partitions, '') AS partitions FROM documents d FULL JOIN g ON d.doc_id = g.doc_id WHERE d.doc_id IS NULL OR n IS NULL OR n > 1"""
)
def partition_exclusive(spark: SparkSession, d: str) -> DataFrame:
    docs, labels, bench = (table(spark, d, t) for t in ("documents", "labels", "benchmark"))
    open_docs = docs.select("doc_id").join(labels.select("doc_id"), "doc_id", "left_anti").where("doc_id % 7 <> 0")
    parts = {
        "annotations": labels.where("quality = 1 and toxic = 0").select("doc_id"),
        "review": labels.where("quality = 0 and toxic = 0").select("doc_id").unionByName(bench.select((-F.col("item_id") - 1).alias("doc_id"))),
        "rejected": labels.where("toxic = 1").select("doc_id"),
        "retry": open_docs.unionByName(labels.where("doc_id % 50 = 0").select("doc_id")),
    }
    return A.partition_membership(docs.select("doc_id"), parts, "doc_id")


@query(
    """WITH s AS (SELECT o_custkey, o_orderkey, CASE o_orderkey % 4 WHEN 0 THEN 'section_asr' WHEN 1 THEN 'music_cpu' WHEN 2 THEN 'alm' ELSE 'odd' END AS stage, CASE o_orderkey % 4 WHEN 0 THEN 8 WHEN 1 THEN 4 WHEN 2 THEN 6 ELSE 11 END AS r FROM orders WHERE o_custkey % 10 <> 0)
SELECT o_custkey, arg_min(stage, (r, o_orderkey)) AS stage, arg_min(o_orderkey, (r, o_orderkey)) AS o_orderkey FROM s GROUP BY 1"""
)
def best_retries(spark: SparkSession, d: str) -> DataFrame:
    names = ["section_asr", "music_cpu", "alm", "odd"]
    stage = F.element_at(F.array(*(F.lit(n) for n in names)), (F.col("o_orderkey") % 4 + 1).cast("int"))
    o = table(spark, d, "orders").select("o_custkey", "o_orderkey", stage.alias("stage"))
    placed = table(spark, d, "customer").where("c_custkey % 10 = 0").select(F.col("c_custkey").alias("o_custkey"))
    return A.best_retries(o, placed, "o_custkey", "stage", "o_orderkey").select("o_custkey", "stage", "o_orderkey")


@query("SELECT lang AS key, count(*) AS n FROM documents GROUP BY 1 HAVING count(*) > 1")
def repeated_keys(spark: SparkSession, d: str) -> DataFrame:
    return A.repeated_keys(table(spark, d, "documents").select(F.col("lang").alias("key")), "key")


@query("SELECT c_custkey, coalesce(n.v, c_acctbal) AS v FROM customer LEFT JOIN (SELECT o_custkey, round(max(o_totalprice), 4) AS v FROM orders GROUP BY 1) n ON c_custkey = o_custkey")
def upsert(spark: SparkSession, d: str) -> DataFrame:
    old = table(spark, d, "customer").select("c_custkey", F.col("c_acctbal").alias("v"))
    new = table(spark, d, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.round(F.max("o_totalprice"), 4).alias("v"))
    return J.upsert(old, new, "c_custkey").select("c_custkey", "v")


@query("SELECT o_orderkey FROM orders WHERE o_custkey % 2 = 0 ORDER BY o_orderkey LIMIT 25")
def first_unallocated(spark: SparkSession, d: str) -> DataFrame:
    """A limit is what this operator is for: the next few tasks of a queue."""
    o = table(spark, d, "orders").select("o_orderkey", "o_custkey")
    return J.first_unallocated(o, o.where("o_custkey % 2 = 1"), "o_orderkey", "o_orderkey", 25).select("o_orderkey")


@query("SELECT p_partkey, p_name FROM part ORDER BY p_partkey LIMIT 40 OFFSET 20")
def offset_scan(spark: SparkSession, d: str) -> DataFrame:
    """Offset and limit are the feature of the columnar loader."""
    from quaverlake.sources.readers import columnar_rows

    return columnar_rows(spark, f"{d}/part.parquet", ["p_partkey", "p_name"], "p_partkey", 20, 40)


@query("SELECT n_name FROM (SELECT n_name, ntile(4) OVER (ORDER BY n_name) AS t FROM nation) WHERE t = 2")
def rank_slice(spark: SparkSession, d: str) -> DataFrame:
    return J.rank_slice(table(spark, d, "nation").select("n_name"), "n_name", 1, 4)


def _events(spark: SparkSession, d: str, stage: str = "music_gate") -> DataFrame:
    """Events of a user as events of a track's gate stage."""
    kind = F.expr("CASE event_type WHEN 'signup' THEN 'register' WHEN 'view' THEN 'prepare' WHEN 'click' THEN 'claim' WHEN 'purchase' THEN 'finish' ELSE 'recover' END")
    user = F.col("user_id").cast("string")
    request = F.sha2(F.concat_ws("\x00", F.lit("job"), user, F.lit(stage), F.lit("fp")), 256)
    none = F.lit(None).cast("string")
    e = table(spark, d, "events") if not isinstance(spark, DataFrame) else spark
    return e.select(F.lit("job").alias("job_id"), user.alias("audio_id"), F.col("event_id").alias("seq"), kind.alias("kind"), F.lit(stage).alias("stage"), F.lit("fp").alias("fingerprint"), request.alias("request_id"), F.lit("music").alias("result"), none.alias("error"))


@query()
def stage_machine(spark: SparkSession, d: str) -> DataFrame:
    """The stage machine folded over a table of events."""
    return streams.stage_outcomes(_events(spark, d))


@query()
def stage_stream(spark: SparkSession, d: str) -> DataFrame:
    """The same as a stream with its state in a store; what it emitted, read back."""
    base = spark.conf.get("spark.checkpoint.dir", None) or tempfile.mkdtemp(prefix="quaverlake-")
    import uuid

    folder = f"{base}/stream-{uuid.uuid4().hex}"
    schema = table(spark, d, "events").schema
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 8).option("pathGlobFilter", "*.parquet").parquet(f"{d}/event[s].parquet")
    parts = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        streams.run_available(streams.stage_outcomes(_events(stream, d)), streams.idempotent_parquet(f"{folder}/out"), f"{folder}/checkpoint")
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", parts)
    return spark.read.schema(streams.OUTCOME).option("recursiveFileLookup", True).parquet(f"{folder}/out")


@query("SELECT date_trunc('day', ts) AS start, date_trunc('day', ts) + INTERVAL 1 DAY AS \"end\", event_type, count(*) AS n FROM events GROUP BY 1, 2, 3")
def windowed_counts(spark: SparkSession, d: str) -> DataFrame:
    """A Spark extra: event-time windows."""
    e = table(spark, d, "events").select("ts", "event_type")
    return streams.windowed_counts(e, "ts", ["event_type"], "1 day")


@query("SELECT CASE WHEN event_type = 'purchase' THEN 'annotations' WHEN event_type IN ('review', 'rejected') THEN event_type ELSE 'retry' END AS part, count(*) AS n FROM events GROUP BY 1")
def item_partitions(spark: SparkSession, d: str) -> DataFrame:
    e = table(spark, d, "events").select(F.when(F.col("event_type") == "purchase", "published").otherwise(F.col("event_type")).alias("status"))
    return e.groupBy(streams.item_partition().alias("part")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT NULL::VARCHAR AS audio_id, NULL::VARCHAR AS rule, NULL::VARCHAR AS detail WHERE false")
def batch_violations(spark: SparkSession, d: str) -> DataFrame:
    """A whole batch run over documents as tracks: what the validator finds wrong with it (nothing)."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    inventory = batch_inventory(spark, d)
    return batch.validate(inventory, batch.run(inventory))


def batch_inventory(spark: SparkSession, d: str) -> DataFrame:
    docs = table(spark, d, "documents").select(F.lpad(F.col("doc_id").cast("string"), 10, "0").alias("path"), "text", F.col("n_chars"))
    one = A.content_dedup(docs, F.sha2("text", 256), "path").join(docs.select("path", "n_chars"), "path")
    return one.select("audio_id", F.concat(F.lit("/music/"), "path").alias("audio_path"), F.col("path").alias("source_relpath"), (F.col("n_chars") / 20.0).alias("duration"), F.when(F.col("n_chars") % 37 == 0, "failed").otherwise("ok").alias("decode_status"))


@query()
def batch_partitions(spark: SparkSession, d: str) -> DataFrame:
    """How many tracks of that run each partition got."""
    spark.conf.set("spark.sql.mapKeyDedupPolicy", "LAST_WIN")
    out = batch.run(batch_inventory(spark, d))
    parts = {"annotations": out.annotations, "review": out.review, "rejected": out.rejected, "retry": out.retry}
    rows = None
    for name, part in parts.items():
        one = part.agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("partition"), "n")
        rows = one if rows is None else rows.unionByName(one)
    return rows



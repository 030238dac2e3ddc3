"""Scans (S1-S19): media trees, strict and lenient JSON lines, segments, annotation trees, inference sources."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from quaverlake.functions.paths import annotation_relpath, relpath_from
from quaverlake.functions.values import typed  # noqa: F401  (part of the reader configuration surface)
from quaverlake.plans.vocabulary import AUDIO_EXTENSIONS, VIDEO_EXTENSIONS


def scan_media(spark: SparkSession, root: str, content: bool = True) -> DataFrame:
    """Audio and video files below ``root`` by extension: path, relpath, length, modified, is_video[, content].

    Spark's file index leaves out names that start with a dot or underscore, and empty files.
    """
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(root)
    ext = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    out = files.where(ext.isin(AUDIO_EXTENSIONS + VIDEO_EXTENSIONS))
    plain = F.regexp_replace("path", r"^file:/+", "/")
    columns = [plain.alias("audio_path"), relpath_from(plain, root).alias("source_relpath"), "length", F.col("modificationTime").alias("modified"), ext.isin(VIDEO_EXTENSIONS).alias("is_video")]
    return out.select(*columns, *(["content"] if content else []))


def inventory(media: DataFrame, probe: Callable[[str], float | None] | None = None) -> DataFrame:
    """Identity and duration of media: audio_id (SHA-256 of the bytes), duration, decode_status, error.

    ``probe`` gives seconds for a path; without one durations are null. A duration that
    is not finite and positive is null, and fails the decode check.
    """
    rows = media.withColumn("audio_id", F.sha2("content", 256)).drop("content")
    if probe is None:
        return rows.withColumns({"duration": F.lit(None).cast("double"), "decode_status": F.lit("ok"), "error": F.lit(None).cast("string")})

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            seconds, errors = [], []
            for path in batch["audio_path"]:
                try:
                    found = probe(path)
                    good = found is not None and 0 < found < float("inf")
                    seconds.append(found if good else None)
                    errors.append(None if good else "invalid duration")
                except Exception as e:  # an unreadable file is a row, not a failed job
                    seconds.append(None)
                    errors.append(str(e)[:500])
            yield batch.assign(duration=pd.Series(seconds, dtype=float, index=batch.index), decode_status=["ok" if e is None else "failed" for e in errors], error=errors)

    schema = StructType(list(rows.schema.fields)).add("duration", "double").add("decode_status", "string").add("error", "string")
    return rows.mapInPandas(run, schema)


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: StructType | str) -> DataFrame:
    """Strict JSON lines: blank lines are skipped, any line that is no object of the schema fails the job.

    Lines that are arrays or plain values fail too, where Spark's own JSON source would
    take an array of objects for several rows. Files are split as any text.
    """
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    lines = spark.read.option("recursiveFileLookup", True).text(paths).where(r"value rlike '\\S'")
    checked = F.when(F.col("value").rlike(r"^\s*\{"), F.col("value")).otherwise(F.raise_error(F.concat(F.lit("no JSON object: "), F.substring("value", 1, 80))).cast("string"))
    return lines.where(checked.isNotNull()).select(F.from_json("value", ddl, {"mode": "FAILFAST"}).alias("r")).select("r.*")


def numbered_lines(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """Every line of text files, blank ones too: file_path, line (its number in the file, from 0), value.

    A split numbers its own lines; the lines of a file's earlier splits are counted in a
    pass before, so large files are read by many tasks.
    """
    id_ = F.monotonically_increasing_id().alias("id")  # goes up by one within a split
    rows = spark.read.option("recursiveFileLookup", True).text(paths).select("value", F.col("_metadata.file_path").alias("file_path"), F.col("_metadata.file_block_start").alias("block"), id_)
    splits = rows.groupBy("file_path", "block").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("n"))
    earlier = Window.partitionBy("file_path").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("before", F.coalesce(F.sum("n").over(earlier), F.lit(0))).drop("n")
    line = (F.col("id") - F.col("first") + F.col("before")).alias("line")
    return rows.join(splits, ["file_path", "block"]).select("file_path", line, "value")


def read_items(spark: SparkSession, paths: str | list[str], schema: StructType, order: tuple[str, ...] = ("audio_path", "url", "path", "file")) -> DataFrame:
    """Items of JSON lines with their physical line number: bad and blank lines are skipped but counted."""
    full = StructType(list(schema.fields)).add("_corrupt_record", "string")
    lines = numbered_lines(spark, paths).where(F.col("value").rlike(r"^\s*\{"))
    rows = lines.select("file_path", "line", F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    good = rows.where(F.col("r").isNotNull() & F.col("r._corrupt_record").isNull()).select("file_path", "line", "r.*").drop("_corrupt_record")
    return item_rows(good, order)


def read_jsonl_lenient(spark: SparkSession, paths: str | list[str], schema: StructType) -> DataFrame:
    """JSON lines without the corrupt ones."""
    full = StructType(list(schema.fields)).add("_corrupt_record", "string")
    lines = spark.read.option("recursiveFileLookup", True).text(paths).where(F.trim("value") != "")
    rows = lines.select(F.from_json("value", full, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"}).alias("r"))
    return rows.where(F.col("r").isNotNull() & F.col("r._corrupt_record").isNull()).select("r.*").drop("_corrupt_record")


def read_hash_cache(spark: SparkSession, paths: str | list[str], tag: str) -> DataFrame:
    """Cached file identities of this schema tag with a well-formed id."""
    schema = StructType.fromDDL("schema string, audio_path string, audio_id string, size long, mtime_ns long, ctime_ns long, device long, inode long")
    return read_jsonl_lenient(spark, paths, schema).where((F.col("schema") == tag) & F.col("audio_id").rlike("^[0-9a-f]{64}$"))


def read_jsonl_recovering(spark: SparkSession, path: str, schema: StructType | str) -> DataFrame:
    """JSON lines whose last line may be cut off: that line is dropped, any other bad line fails.

    A file is one row here, as only its end tells whether its last line was finished.
    """
    ddl = schema if isinstance(schema, str) else schema.simpleString()
    body = F.decode("content", "UTF-8")
    lines = spark.read.format("binaryFile").load(path).select("path", F.posexplode(F.split(body, "\n")).alias("at", "line"), F.size(F.split(body, "\n")).alias("n"))
    lines = lines.where(F.trim("line") != "").withColumn("parsed", F.try_parse_json("line"))
    good = F.col("parsed").isNotNull() & F.col("line").rlike(r"^\s*\{")
    tail = F.col("at") == F.col("n") - 1  # no newline after it
    kept = lines.where(good | ~tail).withColumn("line", F.when(good, F.col("line")).otherwise(F.raise_error(F.concat(F.lit("bad JSON line "), (F.col("at") + 1).cast("string"), F.lit(" of "), F.col("path"))).cast("string")))
    return kept.select("at", F.from_json("line", ddl).alias("r")).select("r.*", F.col("at").alias("ordinal"))


def expand_paths(spark: SparkSession, inputs: list[str], suffix: str = ".jsonl", recursive: bool = True) -> list[str]:
    """Files of mixed file and folder inputs, each once, sorted (driver-side listing through Hadoop)."""
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    found: set[str] = set()
    for item in inputs:
        path = jvm.org.apache.hadoop.fs.Path(item)
        fs = path.getFileSystem(conf)
        if fs.getFileStatus(path).isFile():
            found.add(fs.makeQualified(path).toString())
            continue
        files = fs.listFiles(path, recursive)
        while files.hasNext():
            name = files.next().getPath().toString()
            if name.lower().endswith(suffix):
                found.add(name)
    return sorted(found)


def item_rows(lines: DataFrame, order: tuple[str, ...] = ("audio_path", "url", "path", "file")) -> DataFrame:
    """Items with the first filled path column of ``order`` as item_path."""
    have = [F.nullif(F.trim(c), F.lit("")) for c in order if c in lines.columns]
    return lines.withColumn("item_path", F.coalesce(*have, F.lit(None).cast("string"))).where("item_path is not null")


def audio_rows(lines: DataFrame) -> DataFrame:
    """As ``item_rows`` for prompt files: prompt, then path, then file."""
    return item_rows(lines, ("prompt", "path", "file"))


def segment_rows(segments: DataFrame, metadata: DataFrame, old: str, new: str) -> DataFrame:
    """Segments with all of their four fields, joined with the metadata of their subset.

    ``segments``: oid, subset, start, end; ``metadata``: oid, subset, path and more.
    Segments without metadata are left out; paths move from ``old`` to ``new``.
    """
    whole = segments.dropna(subset=["oid", "subset", "start", "end"])
    joined = whole.join(metadata, ["oid", "subset"])
    moved = F.when(F.col("path").startswith(old), F.concat(F.lit(new), F.substring("path", len(old) + 1, 2**30))).otherwise(F.col("path"))
    return joined.withColumns({"path": moved, "duration": F.greatest(F.col("end") - F.col("start"), F.lit(0.0))})


def columnar_rows(spark: SparkSession, path: str, columns: list[str], order: str, offset: int = 0, limit: int | None = None, id_column: str | None = None) -> DataFrame:
    """Projected columnar scan in order, with offset and limit; an ``$oid`` struct gives its id."""
    rows = spark.read.parquet(path).select(*dict.fromkeys([*columns, order])).orderBy(order).offset(offset)
    if limit is not None:
        rows = rows.limit(limit)
    if id_column is not None and isinstance(rows.schema[id_column].dataType, StructType):
        rows = rows.withColumn(id_column, F.col(f"{id_column}.`$oid`"))
    return rows


def shard_paths(root: str, n: int = 256) -> list[str]:
    """``segment_00`` .. ``segment_ff``."""
    return [f"{root.rstrip('/')}/segment_{i:02x}" for i in range(n)]


def shard_files(spark: SparkSession, root: str, pattern: str = "segment*.jsonl") -> list[str]:
    """Shards that are there by name, sorted (driver-side listing of one folder through Hadoop)."""
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(f"{root.rstrip('/')}/{pattern}")
    found = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).globStatus(path)
    return sorted(f.getPath().toString() for f in found or [])


def rank_paths(paths: list[str], rank: int, world: int) -> list[str]:
    """A worker's contiguous block; low ranks take the remainder."""
    if not 0 <= rank < world:
        raise ValueError("rank must lie in [0, world)")
    each, more = divmod(len(paths), world)
    begin = rank * each + min(rank, more)
    return sorted(paths)[begin : begin + each + (rank < more)]


READERS: dict[str, Callable[..., DataFrame]] = {"jsonl": read_jsonl, "jsonl_lenient": read_jsonl_lenient, "jsonl_recovering": read_jsonl_recovering, "items": read_items, "columnar": columnar_rows, "media": scan_media}


def reader(kind: str) -> Callable[..., DataFrame]:
    """Reader by name; unknown names list what there is."""
    if kind not in READERS:
        raise ValueError(f"unknown reader {kind!r}; have {', '.join(sorted(READERS))}")
    return READERS[kind]


def read_annotations(spark: SparkSession, folder: str, schema: StructType | str | None = None) -> DataFrame:
    """One JSON record per file below ``folder``, with its file_path."""
    source = spark.read.option("multiLine", True).option("recursiveFileLookup", True).option("pathGlobFilter", "*.json")
    if schema is not None:
        source = source.schema(schema).option("mode", "FAILFAST")
    return source.json(folder).select("*", F.regexp_replace(F.col("_metadata.file_path"), r"^file:/+", "/").alias("file_path"))


def find_annotation(spark: SparkSession, folder: str, relpath: str, schema: StructType | str | None = None) -> DataFrame:
    """One annotation by its source path, read without a scan of the tree."""
    from quaverlake.functions.paths import _output_name

    head, name = os.path.split(relpath)
    source = spark.read.option("multiLine", True)
    if schema is not None:
        source = source.schema(schema)
    return source.json("/".join(x for x in (folder.rstrip("/"), head, _output_name(name)) if x))


def annotation_file(folder: str, relpath: Column | str) -> Column:
    return F.concat(F.lit(folder.rstrip("/") + "/"), annotation_relpath(relpath))


@dataclass
class InferenceClient:
    """A model service seen from a partition: ``call(payloads) -> results`` with retries on passing errors.

    Identities are echoed and checked. Any callable that takes and returns a list of
    dictionaries can stand in, so tests need no network.
    """

    call: Callable[[list[dict]], list[dict]]
    batch: int = 64
    attempts: int = 3
    passing: tuple[type[Exception], ...] = field(default=(ConnectionError, TimeoutError))

    def infer(self, payloads: list[dict]) -> list[dict]:
        """A failing batch falls back to its items; a failing item becomes an error row."""
        try:
            answers = self._retry(payloads)
            if [a.get("request_id") for a in answers] != [p["request_id"] for p in payloads]:
                raise ValueError("service answered other requests")
            return answers
        except Exception as e:
            if len(payloads) == 1:
                return [{"request_id": payloads[0]["request_id"], "result": None, "error": f"{type(e).__name__}: {e}"[:500]}]
            return [a for p in payloads for a in self.infer([p])]

    def _retry(self, payloads: list[dict]) -> list[dict]:
        for attempt in range(self.attempts):
            try:
                return self.call(payloads)
            except self.passing:
                if attempt + 1 == self.attempts:
                    raise
        raise AssertionError


def infer(requests: DataFrame, client: InferenceClient, payload: list[str]) -> DataFrame:
    """``requests`` (request_id and payload columns) with result and error; place anti-joins below this."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in batches:
            answers: list[dict] = []
            rows = frame[["request_id", *payload]].to_dict("records")
            for low in range(0, len(rows), client.batch):
                answers += client.infer(rows[low : low + client.batch])
            yield frame.assign(result=[a.get("result") for a in answers], error=[a.get("error") for a in answers])

    schema = StructType(list(requests.schema.fields)).add("result", "string").add("error", "string")
    return requests.mapInPandas(run, schema)


def windows_in_track_order(windows: DataFrame, track: str, start: str) -> DataFrame:
    """Windows of a track next to each other, so that a decoder opens each track once."""
    return windows.repartition(track).sortWithinPartitions(track, start)


def padded_window(samples: Column | str, size: int) -> Column:
    """A window of ``size`` samples, zeros at the end where it is short."""
    s = F.col(samples) if isinstance(samples, str) else samples
    return F.when(F.size(s) >= size, F.slice(s, 1, size)).otherwise(F.concat(s, F.array_repeat(F.lit(0.0), F.lit(size) - F.size(s))))


def with_ordinal(df: DataFrame, key: str, order: list[str]) -> DataFrame:
    """First-seen order of each key's rows as a column."""
    return df.withColumn("ordinal", F.row_number().over(Window.partitionBy(key).orderBy(*order)) - 1)

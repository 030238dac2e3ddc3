"""Sinks (K1-K11). Every write goes through Spark's commit protocol; swaps go through Hadoop's file system."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from quaverlake.functions.paths import annotation_relpath, require_relpath
from quaverlake.operators.joins import tree_differences, upsert

ROUTES = ["accepted.music", "accepted.song", "accepted.instrumental", "review", "rejected", "results", "failures"]


def write_jsonl(df: DataFrame, path: str) -> None:
    """Replace a JSON-lines table as a whole: written beside it first, so a failed job leaves the old one."""
    staged = f"{path.rstrip('/')}.staged-{uuid.uuid4().hex[:8]}"
    try:
        serialisable(df).write.option("ignoreNullFields", False).json(staged)
    except Exception:
        Files(df.sparkSession, path).delete(staged)
        raise
    swap(df.sparkSession, staged, path)


def append_jsonl(df: DataFrame, path: str) -> None:
    serialisable(df).write.mode("append").option("ignoreNullFields", False).json(path)


def write_routes(df: DataFrame, folder: str, route: str, routes: list[str]) -> None:
    """One table per route, empty ones included; rows of any other route are an error."""
    known = F.col(route).isin(routes)
    checked = df.withColumn(route, F.when(known, F.col(route)).otherwise(F.raise_error(F.concat(F.lit("unknown route: "), F.coalesce(F.col(route).cast("string"), F.lit("null")))).cast("string")))
    for name in routes:
        write_jsonl(checked.where(F.col(route) == name).drop(route), f"{folder.rstrip('/')}/{name}.jsonl")


class Files:
    """Hadoop's file system of a path."""

    def __init__(self, spark: SparkSession, path: str):
        self.jvm = spark.sparkContext._jvm
        self.fs = self.path(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    def path(self, path: str):
        return self.jvm.org.apache.hadoop.fs.Path(path)

    def exists(self, path: str) -> bool:
        return self.fs.exists(self.path(path))

    def delete(self, path: str) -> None:
        self.fs.delete(self.path(path), True)

    def move(self, old: str, new: str) -> None:
        if not self.fs.rename(self.path(old), self.path(new)):
            raise OSError(f"cannot move {old} to {new}")


def swap(spark: SparkSession, staged: str, target: str) -> None:
    """Put a staged tree in a target's place; the previous tree comes back if that fails."""
    files = Files(spark, target)
    old = f"{target.rstrip('/')}.old-{uuid.uuid4().hex[:8]}"
    had = files.exists(target)
    if had:
        files.move(target, old)
    try:
        files.move(staged, target)
    except Exception:
        if had:
            files.move(old, target)
        raise
    if had:
        files.delete(old)


def publish(annotations: DataFrame, folder: str, key: str = "audio_id", buckets: int = 64) -> dict[str, int]:
    """Annotations as one JSON line per track under its own relative path.

    Rows are staged with their target path as text, read back, compared with what was
    to be written, and swapped in. Returns counts by content type.
    """
    spark = annotations.sparkSession
    rows = serialisable(annotations).withColumn("relpath", annotation_relpath(require_relpath("source_relpath")))
    twice = rows.groupBy("relpath").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if not twice.isEmpty():
        raise ValueError("two tracks share an annotation path")
    staged = f"{folder.rstrip('/')}.stage-{uuid.uuid4().hex[:8]}"
    body = rows.select("relpath", F.to_json(F.struct(*serialisable(annotations).columns), {"ignoreNullFields": "false"}).alias("json"))
    body.foreachPartition(_file_writer(staged))
    files = Files(spark, folder)
    try:
        back = spark.read.option("wholetext", True).option("recursiveFileLookup", True).text(staged) if files.exists(staged) else spark.createDataFrame([], "value string")
        different = tree_differences(back.select(F.rtrim("value").alias("json")), body.select("json"))
        if not different.isEmpty():
            raise ValueError("written annotations differ from what was to be written")
        if not files.exists(staged):
            files.fs.mkdirs(files.path(staged))
        swap(spark, staged, folder)
    except Exception:
        files.delete(staged)
        raise
    counts = {r["content_type"]: r["n"] for r in annotations.groupBy("content_type").agg(F.count(F.lit(1)).alias("n")).collect()}
    return {"total": sum(counts.values()), **counts}


def _file_writer(folder: str):
    """One small file per row through pyarrow's file systems, atomic by rename."""

    def write(rows) -> None:
        from pyarrow import fs as pafs

        system, base = pafs.FileSystem.from_uri(folder) if "://" in folder else (pafs.LocalFileSystem(), folder.removeprefix("file:"))
        for row in rows:
            target = f"{base}/{row['relpath']}"
            system.create_dir(target.rsplit("/", 1)[0], recursive=True)
            part = f"{target}.{uuid.uuid4().hex[:8]}.part"
            with system.open_output_stream(part) as out:
                out.write(row["json"].encode() + b"\n")
            system.move(part, target)

    return write


def write_failures(df: DataFrame, path: str, source: str = "audio_path", error: str = "error") -> None:
    """Failures as two tab-separated columns."""
    df.where(F.col(error).isNotNull()).select(source, F.translate(error, "\t\n\r", "   ").alias(error)).write.mode("overwrite").option("sep", "\t").option("header", False).csv(path)


def merge_results(spark: SparkSession, new: DataFrame, path: str, key: str, order: DataFrame | None = None, at: str = "ordinal") -> None:
    """Replace rows of the same key in a stored table, in task order; NaN is refused."""
    numbers = [f.name for f in new.schema.fields if f.dataType.typeName() in ("double", "float")]
    for name in numbers:
        bad = F.isnan(name) | (F.abs(F.col(name)) == float("inf"))
        new = new.withColumn(name, F.when(bad, F.raise_error(F.lit(f"{name} is not finite")).cast("double")).otherwise(F.col(name)))
    files = Files(spark, path)
    merged = upsert(spark.read.parquet(path), new, key) if files.exists(path) else new
    if order is not None:
        merged = merged.join(order.select(key, at), key, "left").orderBy(F.asc_nulls_last(at), key).drop(at)
    staged = f"{path.rstrip('/')}.stage-{uuid.uuid4().hex[:8]}"
    merged.write.parquet(staged)
    swap(spark, staged, path)


def write_report(report: DataFrame, folder: str) -> None:
    """Run report and, last, the marker that it is complete."""
    write_jsonl(report, f"{folder.rstrip('/')}/run_report")
    spark = report.sparkSession
    spark.range(1).select(F.lit("ok").alias("value")).coalesce(1).write.mode("overwrite").text(f"{folder.rstrip('/')}/_complete")


def with_artifact_hash(frames: DataFrame, values: str) -> DataFrame:
    """Frame logits as floats with the hash of their text, as a Parquet artifact has them."""
    logits = F.transform(F.col(values), lambda x: x.cast("float"))
    return frames.withColumns({values: logits, "sha256": F.sha2(F.array_join(F.transform(logits, lambda x: x.cast("string")), ","), 256)})


def serialisable(df: DataFrame) -> DataFrame:
    """Without raw bytes; all else has a type that can be written."""
    return df.drop(*(f.name for f in df.schema.fields if isinstance(f.dataType, BinaryType)))


def migrate(lines: DataFrame, folder: str, root: str | None = None) -> dict[str, int]:
    """Annotations of an older JSON-lines file into the per-track tree."""
    from quaverlake.functions.paths import relpath_from

    if root is not None and "source_relpath" not in lines.columns:
        lines = lines.withColumn("source_relpath", relpath_from("audio_path", root))
    return publish(lines, folder)


def routed(df: DataFrame, route: Column) -> DataFrame:
    return df.withColumn("route", route)

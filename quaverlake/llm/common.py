"""Shared pieces: lineage cuts, text classes, connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` to the shared checkpoint folder and go on from there.

    The folder is the session's ``spark.checkpoint.dir``; only a session that
    names none (tests, local mode) gets a temporary one.
    """
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_folder(spark: SparkSession) -> str:
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="quaverlake-")
        context.setCheckpointDir(named)
    return named


def stored(df: DataFrame) -> DataFrame:
    """As ``cut``, but as a Parquet table, for results of the order of the input."""
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/tables/{uuid.uuid4().hex}"
    df.write.parquet(path)
    atexit.register(_remove, spark, path)
    return spark.read.schema(df.schema).parquet(path)


def _remove(spark: SparkSession, path: str) -> None:
    context = spark.sparkContext
    if context._jsc is None or context._jsc.sc().isStopped():
        return
    at = context._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(context._jsc.hadoopConfiguration()).delete(at, True)


def text_key(text: Column | str) -> Column:
    """128-bit key of a text (null counts as empty)."""
    c = F.col(text) if isinstance(text, str) else text
    return F.unhex(F.md5(F.coalesce(c, F.lit(""))))


def connected_components(edges: DataFrame, max_rounds: int = 200) -> DataFrame:
    """(node, root) for every node of ``edges`` (a, b), root the smallest node reachable.

    Alternates large-star and small-star contraction; every round is two
    aggregations with map-side combine and two equi-joins that AQE can split, and
    is cut into the shared folder, so neither a hub nor a long chain of rounds
    gathers in one task. Works on any orderable node type.
    """
    current = cut(
        edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v"))
        .where(F.col("u") != F.col("v"))
        .distinct()
    )
    mark = _digest(current)
    for _ in range(max_rounds):
        if mark[0] == 0:
            break
        both = current.unionByName(current.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.distinct()
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (
            large.join(low, "u")
            .select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u"), F.col("m").alias("v")))).alias("e"))
            .select("e.u", "e.v")
            .where("u <> v")
            .distinct()
        )
        current = cut(small)
        seen = _digest(current)
        if seen == mark:
            break
        mark = seen
    else:
        raise RuntimeError("components did not settle")
    roots = current.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return current.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots)


def _digest(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h")).first()
    return row["n"], row["h"]

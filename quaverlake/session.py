"""Session defaults."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.mapKeyDedupPolicy": "LAST_WIN",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Set what the operators rely on in a session made elsewhere."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def build(master: str = "local[8]", partitions: int = 8, **more: str) -> SparkSession:
    builder = SparkSession.builder.master(master).appName("quaverlake")
    for key, value in (SETTINGS | {"spark.sql.shuffle.partitions": str(partitions), "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false"} | more).items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The session's checkpoint folder; a session that names none (tests, local mode) gets a temporary one."""
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        named = tempfile.mkdtemp(prefix="quaverlake-")
        context.setCheckpointDir(named)
    return named


def materialise(df: DataFrame) -> DataFrame:
    """A resume point: write ``df`` to the shared folder and go on from there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)

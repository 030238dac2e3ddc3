"""Structured Streaming around the stage machine."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterator
from typing import Any

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery
from pyspark.sql.types import StructType

from quaverlake.operators.aggregates import repeated_keys
from quaverlake.operators.joins import require_empty
from quaverlake.streaming.machine import Item

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
EVENT = "job_id string, audio_id string, seq long, kind string, stage string, fingerprint string, request_id string, result string, error string"
OUTCOME = "job_id string, audio_id string, seq long, kind string, stage string, accepted boolean, reason string, status string, attempt int, request_id string, ready string"


def _outcomes(item: Item, events: pd.DataFrame, fatal_duplicates: bool) -> pd.DataFrame:
    rows = []
    clean = lambda v: None if v is None or v != v else v
    for e in events.sort_values("seq", kind="stable").to_dict("records"):
        e = {k: clean(v) for k, v in e.items()}
        reason = item.apply(e["kind"], e["stage"], e["fingerprint"], e["request_id"], e["result"], e["error"])
        if fatal_duplicates and e["kind"] == "register" and reason:
            raise ValueError(f"{reason}: job {item.job}, track {item.audio}")
        row = item.stages.get(e["stage"] or "")
        rows.append((item.job, item.audio, e["seq"], e["kind"], e["stage"], reason is None, reason, item.status, row.attempt if row else 0, row.request if row else None, ",".join(item.ready())))
    return pd.DataFrame(rows, columns=[c.split()[0] for c in OUTCOME.split(", ")])


class StageProcessor(StatefulProcessor):
    """Keeps one ``Item`` per (job, track) in the state store."""

    def __init__(self, fatal_duplicates: bool = False):
        self.fatal_duplicates = fatal_duplicates

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("item", StructType().add("json", "string"))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timers: Any) -> Iterator[pd.DataFrame]:
        item = Item.load(json.loads(self.state.get()[0])) if self.state.exists() else Item(*key)
        events = pd.concat(list(rows))
        yield _outcomes(item, events, self.fatal_duplicates)
        self.state.update((json.dumps(item.dump()),))

    def close(self) -> None:
        pass


def stage_outcomes(events: DataFrame, fatal_duplicates: bool = False) -> DataFrame:
    """What each event did to its item; a stream keeps items between batches, a table is folded in one go.

    Refused events (wrong state, changed input, unknown request) change nothing.
    """
    if events.isStreaming:
        return events.groupBy("job_id", "audio_id").transformWithStateInPandas(StageProcessor(fatal_duplicates), OUTCOME, "Append", "None")

    def fold(own: pd.DataFrame) -> pd.DataFrame:
        return _outcomes(Item(own["job_id"].iloc[0], own["audio_id"].iloc[0]), own, fatal_duplicates)

    return events.groupBy("job_id", "audio_id").applyInPandas(fold, OUTCOME)


class RequestProcessor(StatefulProcessor):
    """Answers of requests by id: the same payload is answered from memory, another is a conflict."""

    def __init__(self, compute: Callable[[str], str]):
        self.compute = compute

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.state = handle.getValueState("answer", StructType().add("payload", "string").add("result", "string"))

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timers: Any) -> Iterator[pd.DataFrame]:
        known = self.state.get() if self.state.exists() else None
        out = []
        for payload in pd.concat(list(rows)).sort_values("seq", kind="stable")["payload"]:
            if known is None:
                known = (payload, self.compute(payload))
                self.state.update(known)
                out.append((key[0], "computed", known[1]))
            elif known[0] == payload:
                out.append((key[0], "cached", known[1]))
            else:
                out.append((key[0], "conflict", None))
        yield pd.DataFrame(out, columns=["request_id", "status", "result"])

    def close(self) -> None:
        pass


def answers(requests: DataFrame, compute: Callable[[str], str]) -> DataFrame:
    """Streaming (request_id, seq, payload) -> (request_id, status, result), computed once per id."""
    return requests.groupBy("request_id").transformWithStateInPandas(RequestProcessor(compute), "request_id string, status string, result string", "Append", "None")


def source(spark: SparkSession, folder: str, schema: StructType | str, kind: str = "json", files_per_trigger: int = 64) -> DataFrame:
    """Files of a folder as they appear, at most so many a batch (1 to 64)."""
    if not 1 <= files_per_trigger <= 64:
        raise ValueError("files_per_trigger must lie in 1..64")
    return spark.readStream.schema(schema).format(kind).option("maxFilesPerTrigger", files_per_trigger).load(folder)


def distinct_items(items: DataFrame, key: str = "audio_id") -> DataFrame:
    """Stream without items of a known id."""
    return items.dropDuplicates([key])


def batch_sink(write: Callable[[DataFrame, int], None], key: str = "audio_id", fatal_duplicates: bool = False) -> Callable[[DataFrame, int], None]:
    """``foreachBatch`` function; with ``fatal_duplicates`` a repeated id in a batch stops the stream."""

    def run(batch: DataFrame, number: int) -> None:
        if fatal_duplicates:
            require_empty(repeated_keys(batch, key), "repeated ids", key)
        write(batch, number)

    return run


def idempotent_parquet(folder: str) -> Callable[[DataFrame, int], None]:
    """A batch replaces what an earlier attempt at it wrote."""
    return lambda batch, number: batch.write.mode("overwrite").parquet(f"{folder.rstrip('/')}/batch={number}")


def run_available(stream: DataFrame, sink: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process what is there, then stop; a restart goes on behind the last finished batch."""
    spark = stream.sparkSession
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    query = stream.writeStream.outputMode("append").foreachBatch(sink).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def lost_publications(items: DataFrame, files: DataFrame, key: str = "audio_id") -> DataFrame:
    """Published items without a file, to be published again."""
    return items.where("status = 'published'").join(files.select(key), key, "left_anti").withColumn("status", F.lit("pending"))


def item_partition(status: str = "status") -> Column:
    """Final partition of an item: what failed or never finished is retried."""
    return F.when(F.col(status) == "published", "annotations").when(F.col(status).isin("review", "rejected"), F.col(status)).otherwise("retry")


def windowed_counts(events: DataFrame, time: str, keys: list[str], size: str = "1 hour", slide: str | None = None, late: str = "10 minutes") -> DataFrame:
    """Event-time counts per window with late data bound by a watermark (a Spark extra)."""
    span = F.window(time, size, slide) if slide else F.window(time, size)
    rows = events.withWatermark(time, late) if events.isStreaming else events
    return rows.groupBy(span.alias("window"), *keys).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), F.col("window.end").alias("end"), *keys, "n")

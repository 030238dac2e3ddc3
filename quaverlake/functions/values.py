"""Arrays, maps, vectors, text formats and JSON answers."""

from __future__ import annotations

from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quaverlake.plans.vocabulary import UNSPACED_LANGUAGES


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def elapsed(seconds: Column | str) -> Column:
    """HH:MM:SS.mmm, negative times as zero."""
    ms = F.round(F.greatest(_col(seconds).cast("double"), F.lit(0.0)) * 1000).cast("long")
    return F.format_string("%02d:%02d:%02d.%03d", F.floor(ms / 3600000), F.floor(ms / 60000) % 60, F.floor(ms / 1000) % 60, ms % 1000)


def rate(n: Column | str, seconds: Column | str) -> Column:
    """Items per second, null without items or time."""
    return F.when((_col(n) > 0) & (_col(seconds) > 0), F.round(_col(n) / _col(seconds), 6))


def seconds_per_item(n: Column | str, seconds: Column | str) -> Column:
    return F.when(_col(n) > 0, F.round(_col(seconds) / _col(n), 6))


def stage_record(stage: Column | str, started: Column | str, finished: Column | str, processed: Column | str) -> Column:
    """A stage's run as a struct: epochs and elapsed seconds to six places, items, both rates."""
    begin, end, n = _col(started).cast("double"), _col(finished).cast("double"), _col(processed).cast("long")
    took = F.greatest(end - begin, F.lit(0.0))
    return F.struct(
        _col(stage).cast("string").alias("stage"),
        F.round(begin, 6).alias("started_at_epoch"),
        F.round(end, 6).alias("finished_at_epoch"),
        F.round(took, 6).alias("elapsed_seconds"),
        F.greatest(n, F.lit(0)).alias("processed"),
        seconds_per_item(n, took).alias("seconds_per_item"),
        rate(n, took).alias("items_per_second"),
    )


def typed(current: Any, value: str) -> Any:
    """A configuration override read as the type of what it replaces."""
    if isinstance(current, bool):
        if value.strip().lower() in ("1", "true", "yes", "on"):
            return True
        if value.strip().lower() in ("0", "false", "no", "off"):
            return False
        raise ValueError(f"not a truth value: {value!r}")
    for kind in (int, float):
        if isinstance(current, kind):
            return kind(value)
    if isinstance(current, (list, tuple)):
        return type(current)(x.strip() for x in value.split(",") if x.strip())
    return None if current is None and value.lower() in ("none", "null", "") else value


def dot(a: Column | str, b: Column | str) -> Column:
    return F.aggregate(F.zip_with(_col(a), _col(b), lambda x, y: x.cast("double") * y.cast("double")), F.lit(0.0), lambda s, x: s + x)


def norm(a: Column | str, least: float = 0.0) -> Column:
    return F.greatest(F.sqrt(dot(a, a)), F.lit(least))


def unit(a: Column | str, least: float = 1e-8) -> Column:
    n = norm(a, least)
    return F.transform(_col(a), lambda x: x.cast("double") / n)


def comparable(df: DataFrame, vector: str) -> DataFrame:
    """``vector`` as ``__u``, its unit vector; null if it or a component is missing or not finite."""
    units = df.withColumn("__u", unit(vector)).drop(vector)
    return units.withColumn("__u", F.when(~F.exists("__u", lambda x: x.isNull() | F.isnan(x)), F.col("__u")))


def cosine(a: Column | str, b: Column | str) -> Column:
    """Cosine, clipped to [-1, 1]."""
    return F.greatest(F.lit(-1.0), F.least(F.lit(1.0), dot(a, b) / (norm(a, 1e-8) * norm(b, 1e-8))))


def sigmoid(x: Column | str) -> Column:
    return 1 / (1 + F.exp(-_col(x).cast("double")))


def softmax(a: Column | str) -> Column:
    top = F.array_max(_col(a))
    raised = F.transform(_col(a), lambda x: F.exp(x.cast("double") - top))
    return F.transform(raised, lambda x: x / F.aggregate(raised, F.lit(0.0), lambda s, y: s + y))


def merged(*maps: Column | str) -> Column:
    """Shallow merge of maps, the last wins (needs the session's LAST_WIN policy)."""
    return F.map_concat(*(F.coalesce(_col(m), F.create_map().cast("map<string,string>")) for m in maps))


def without(m: Column | str, *keys: str) -> Column:
    return F.map_filter(_col(m), lambda k, v: ~k.isin(*keys))


def with_default(m: Column | str, key: str, value: Column) -> Column:
    return F.when(F.map_contains_key(_col(m), key), _col(m)).otherwise(F.map_concat(_col(m), F.create_map(F.lit(key), value)))


def find_classes(value: Any) -> list[str] | None:
    """The first list under a key ``classes`` anywhere in a sidecar (driver-side)."""
    todo = [value]
    while todo:
        item = todo.pop(0)
        if isinstance(item, dict):
            if isinstance(item.get("classes"), list):
                return [str(x) for x in item["classes"]]
            todo.extend(item.values())
        elif isinstance(item, list):
            todo.extend(item)
    return None



def caption(body: Column | str) -> Column:
    """struct(caption, error) of a chat answer: first choice, not cut short, its text not empty."""
    choice = F.from_json(_col(body), "struct<choices:array<struct<finish_reason:string,message:struct<content:string>>>>")["choices"]
    choice = F.get(choice, 0)
    content = choice["message"]["content"]
    parts = F.from_json(content, "array<struct<type:string,text:string>>")
    joined = F.array_join(F.transform(F.filter(parts, lambda p: p["text"].isNotNull()), lambda p: p["text"]), "")
    said = F.nullif(F.trim(F.when(content.startswith("["), joined).otherwise(content)), F.lit(""))
    error = F.when(choice.isNull(), "no choices").when(choice["finish_reason"] == "length", "answer was cut short").when(said.isNull(), "empty caption")
    return F.struct(F.when(error.isNull(), said).alias("caption"), error.alias("error"))


def joined_tokens(tokens: Column | str, language: Column | str) -> Column:
    """Words of a transcript: stripped, empty ones dropped, no spaces for scripts without them."""
    words = F.filter(F.transform(_col(tokens), lambda t: F.trim(t)), lambda t: t != "")
    return F.when(F.lower(_col(language)).isin(UNSPACED_LANGUAGES), F.array_join(words, "")).otherwise(F.array_join(words, " "))


def token_times(token: Column) -> Column:
    """Timestamp aliases of aligners: start_time / end_time or start / end."""
    start = F.coalesce(token["start_time"], token["start"], F.lit(0.0))
    return F.struct(token["text"].alias("text"), start.alias("start"), F.coalesce(token["end_time"], token["end"], start).alias("end"))


def pick(key: Column | str, pool: list[str]) -> Column:
    """A choice from a pool that depends on the key alone."""
    return F.element_at(F.array(*(F.lit(p) for p in pool)), (F.pmod(F.xxhash64(_col(key)), F.lit(len(pool))) + 1).cast("int"))

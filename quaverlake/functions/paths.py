"""Paths and names."""

from __future__ import annotations

import hashlib

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

NAME_BYTES = 255


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def normal_relpath(path: Column | str) -> Column:
    """A relative path without ``.`` and doubled slashes; null if empty, absolute, with NUL or ``..``."""
    p = _col(path)
    parts = F.filter(F.split(p, "/"), lambda x: (x != "") & (x != "."))
    bad = F.trim(p).eqNullSafe("") | p.startswith("/") | p.contains("\x00") | F.array_contains(parts, "..") | (F.size(parts) == 0)
    return F.when(p.isNotNull() & ~bad, F.array_join(parts, "/"))


def require_relpath(path: Column | str) -> Column:
    """As ``normal_relpath``, but an unsafe path is an error."""
    good = normal_relpath(path)
    return F.when(good.isNotNull(), good).otherwise(F.raise_error(F.concat(F.lit("unsafe relative path: "), F.coalesce(_col(path), F.lit("null")))).cast("string"))


def relpath_from(path: Column | str, root: str) -> Column:
    """Path below ``root``; null outside it."""
    base = root.rstrip("/") + "/"
    return F.when(_col(path).startswith(base), F.substring(_col(path), len(base) + 1, 2**30))


def require_relpath_from(path: Column | str, root: str) -> Column:
    """Path below ``root``; a path outside it, or none, fails the job."""
    shown = F.coalesce(_col(path), F.lit("null"))
    return F.coalesce(relpath_from(path, root), F.raise_error(F.concat(F.lit("outside the input root: "), shown)).cast("string"))


def _output_name(name: str | None) -> str | None:
    if name is None:
        return None
    full = f"{name}.json"
    if len(full.encode()) <= NAME_BYTES:
        return full
    tail = f"__p{hashlib.sha1(name.encode()).hexdigest()[:10]}.json"
    return name.encode()[: NAME_BYTES - len(tail)].decode("utf-8", "ignore") + tail


def output_name(name: Column | str) -> Column:
    """File name of an annotation; over-long ones are cut at a character and marked with a hash."""

    def run(names: pd.Series) -> pd.Series:
        return names.map(_output_name)

    return F.pandas_udf(run, StringType())(_col(name))


def annotation_relpath(relpath: Column | str) -> Column:
    """Where below the tree a track's annotation goes."""
    p = _col(relpath)
    folder = F.regexp_extract(p, r"^(.*/)?[^/]*$", 1)
    return F.concat(folder, output_name(F.regexp_extract(p, r"[^/]*$", 0)))


def file_uri(path: Column | str) -> Column:
    """``file://`` address with percent-encoded components; addresses stay."""
    p = _col(path)
    coded = F.transform(F.split(p, "/"), lambda x: F.replace(F.replace(F.url_encode(x), F.lit("+"), F.lit("%20")), F.lit("%7E"), F.lit("~")))
    return F.when(p.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), p).otherwise(F.concat(F.lit("file://"), F.array_join(coded, "/")))


def normal_label(label: Column | str) -> Column:
    return F.replace(F.lower(F.trim(F.coalesce(_col(label), F.lit("")))), F.lit("_"), F.lit("-"))


def endpoint(value: Column | str) -> Column:
    """Host of an object-store endpoint: no scheme, no trailing slash."""
    return F.regexp_replace(F.regexp_replace(F.trim(_col(value)), r"^[A-Za-z][A-Za-z0-9+.-]*://", ""), r"/+$", "")


def swap_prefix(path: Column | str, old: str, new: str) -> Column:
    p = _col(path)
    return F.when(p.startswith(old), F.concat(F.lit(new), F.substring(p, len(old) + 1, 2**30))).otherwise(p)


def split_uri(uri: Column | str) -> Column:
    """struct(scheme, bucket, key)."""
    u = _col(uri)
    return F.struct(F.regexp_extract(u, r"^([A-Za-z][A-Za-z0-9+.-]*)://", 1).alias("scheme"), F.regexp_extract(u, r"://([^/]*)", 1).alias("bucket"), F.regexp_extract(u, r"://[^/]*/(.*)$", 1).alias("key"))


def proper_prefixes(path: Column | str) -> Column:
    """Every proper component prefix of a path."""
    parts = F.split(_col(path), "/")
    n = F.size(parts)
    return F.when(n > 1, F.transform(F.sequence(F.lit(1), n - 1), lambda k: F.array_join(F.slice(parts, F.lit(1), k), "/"))).otherwise(F.array().cast("array<string>"))

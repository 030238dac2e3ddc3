"""Identities and fingerprints."""

from __future__ import annotations

from collections.abc import Callable
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F


def content_id(content: Column | str) -> Column:
    """SHA-256 of raw bytes, whatever the path."""
    return F.sha2(F.col(content) if isinstance(content, str) else content, 256)


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` over a value that is worked out once, however often it is named."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def json_float(c: Column | str) -> Column:
    """Shortest decimal of a double: plain from 1e-4 up to 1e16, else with an exponent of two digits or more; null stays null.

    A number of at most six places below 1e9 is written from its millionths: it has at most 15 digits, and
    no two such decimals read as one double. Of others the fewest of 15, 16 and 17 digits that read back as
    the same number are taken, as the JVM's own text is not always the shortest. Subnormal numbers may keep
    a digit more.
    """
    return _let((F.col(c) if isinstance(c, str) else c).cast("double"), lambda x: _let(F.when(F.abs(x) < 1e9, F.rint(x * 1e6).cast("long")), lambda n: F.when((n / 1e6 == x) & (F.abs(n) >= 100), _millionths(n)).otherwise(_digits(x))))


def _millionths(n: Column) -> Column:
    size = F.abs(n)
    places = F.rtrim(F.lpad((size % 1000000).cast("string"), 6, "0"), F.lit("0"))
    return F.concat(F.when(n < 0, "-").otherwise(""), F.floor(size / 1000000).cast("string"), F.lit("."), F.when(size % 1000000 == 0, "0").otherwise(places))


def _digits(x: Column) -> Column:
    digits = lambda n: F.format_string(f"%.{n - 1}e", x)
    parsed = lambda t: t.cast("double") == x
    written = _let(digits(15), lambda a: F.when(parsed(a), a).otherwise(_let(digits(16), lambda b: F.when(parsed(b), b).otherwise(digits(17)))))
    parts = lambda t: F.struct(
        t.alias("t"),
        F.regexp_extract(t, "^(-?)", 1).alias("sign"),
        F.regexp_extract(t, "^-?([0-9])", 1).alias("head"),
        F.regexp_extract(t, "\\.([0-9]*?)0*e", 1).alias("tail"),
        F.regexp_extract(t, "e([+-][0-9]+)$", 1).alias("exponent"),
    )
    power = lambda p: p["exponent"].try_cast("int")
    text = _let(_let(written, parts), lambda p: _let(power(p), lambda e: F.when(e.isNull(), p["t"]).otherwise(F.concat(p["sign"], _placed(p, e)))))
    return F.when(x == 0, x.cast("string")).when(x.isNotNull(), text)


def _placed(p: Column, power: Column) -> Column:
    """Sign left out, a number's digits around the point, or with its exponent."""
    head, tail = p["head"], p["tail"]
    small = F.concat(F.lit("0."), F.repeat(F.lit("0"), -power - 1), head, tail)
    filled = F.concat(head, F.rpad(tail, F.greatest(F.length(tail), power), "0"))
    rest = F.substr(filled, power + 2)
    large = F.concat(F.substr(filled, F.lit(1), power + 1), F.lit("."), F.when(rest == "", "0").otherwise(rest))
    wide = F.concat(head, F.when(tail != "", F.concat(F.lit("."), tail)).otherwise(""), F.lit("e"), p["exponent"])
    return F.when((power < 0) & (power >= -4), small).when((power >= 0) & (power < 16), large).otherwise(wide)


def canonical(fields: dict[str, Column], floats: tuple[str, ...] = ()) -> Column:
    """Compact JSON of named columns in the order of their names, nulls kept.

    Strings, integers, booleans and nested columns of these as they are; floating-point
    columns must be named in ``floats``. Control characters are escaped in upper-case hex.
    """
    whole = {"ignoreNullFields": "false"}
    if not floats:
        return F.to_json(F.struct(*(fields[k].alias(k) for k in sorted(fields))), whole)
    inner = lambda names: _let(F.to_json(F.struct(*(fields[k].alias(k) for k in names)), whole), lambda t: F.substr(t, F.lit(2), F.length(t) - 2))
    part = lambda k: F.concat(F.lit(f'"{k}":'), F.coalesce(json_float(fields[k]), F.lit("null")))
    parts = [p for given, names in groupby(sorted(fields), lambda k: k in floats) for p in (map(part, names) if given else [inner(list(names))])]
    return F.concat(F.lit("{"), F.concat_ws(",", *parts), F.lit("}"))


def fingerprint(fields: dict[str, Column], floats: tuple[str, ...] = ()) -> Column:
    return F.sha2(canonical(fields, floats), 256)


def input_fingerprint(stage: str, audio_id: Column, audio_path: Column, source_relpath: Column, duration: Column, content_type: Column) -> Column:
    """What a stage's result depends on; a missing id counts as blank."""
    fields = {"stage": F.lit(stage), "audio_id": F.coalesce(audio_id.cast("string"), F.lit("")), "audio_path": audio_path, "source_relpath": source_relpath, "duration": duration, "content_type": content_type}
    return fingerprint(fields, ("duration",))


def record_fingerprint(stage: str, fields: dict[str, Column], ignored: tuple[str, ...] = (), floats: tuple[str, ...] = ()) -> Column:
    """Fingerprint of a whole record, nested beside its stage, provenance left out."""
    record = canonical({k: v for k, v in fields.items() if k not in ignored}, tuple(k for k in floats if k not in ignored))
    return F.sha2(F.concat(F.lit('{"record":'), record, F.lit(","), F.substr(canonical({"stage": F.lit(stage)}), F.lit(2))), 256)


def request_id(job: Column, audio: Column, stage: Column, input_fingerprint: Column) -> Column:
    """The same request has the same id in every attempt."""
    return F.sha2(F.concat_ws("\x00", job, audio, stage, input_fingerprint), 256)


def sections_hash(audio_id: Column, content_type: Column, sections: Column | str) -> Column:
    """Hash of a track's section plan as canonical JSON: ids, bounds to 6 places (0 if missing), label, coverage."""
    s = F.col(sections) if isinstance(sections, str) else sections
    bound = lambda c: F.coalesce(F.bround(c.cast("double"), 6), F.lit(0.0))
    blank = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    one = lambda x: canonical({"section_id": blank(x["section_id"]), "start": bound(x["start"]), "end": bound(x["end"]), "label": x["label"], "voice_coverage": x["voice_coverage"]}, ("start", "end", "voice_coverage"))
    plan = F.coalesce(F.array_join(F.transform(s, one), ","), F.lit(""))
    track = F.regexp_replace(canonical({"audio_id": blank(audio_id), "content_type": blank(content_type)}), "\\}$", "")
    return F.sha2(F.concat(track, F.lit(',"sections":['), plan, F.lit("]}")), 256)


def short_id(value: Column | str, length: int = 24) -> Column:
    return F.left(F.sha2(F.col(value) if isinstance(value, str) else value, 256), F.lit(length))


def uid(value: Column | str) -> Column:
    return F.sha1(F.col(value) if isinstance(value, str) else value)


def multiset_hash(row_hash: Column | str) -> Column:
    """Aggregate: hash of a set of rows that their order does not change."""
    h = F.col(row_hash) if isinstance(row_hash, str) else row_hash
    return F.sha2(F.array_join(F.array_sort(F.collect_list(h)), "\n"), 256)

"""Substring dedup by seed and extend.

Seeds are winnowed anchors: in every window of ``min_words`` words the k-gram with
the smallest hash is chosen, so two equal windows always choose the same anchor at
the same place. Documents are joined on anchors that occur twice or more; each
such seed is extended both ways, first over its whole zone (all windows that chose
it), and where zones differ window by window. Overlapping repeated windows join to
maximal repeats of ``min_words`` words or more.

A text's further copies are left out of the join where a task meets them; anchors
and windows are counted with map-side combine and joined with joins AQE can split,
so neither a common passage nor a large group of copies meets in one task, and no
pairs are listed. Texts are shuffled once; seeds come straight from the scan.
Windows are compared by 128-bit hashes; the 64-bit anchors only nominate them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaverlake.llm.common import stored, text_key
from quaverlake.llm.wordhash import Words, blocks, last_minimum


def _zones(words: Words, size: int, gram: int) -> tuple[np.ndarray, ...]:
    """(text, anchor word, first window, last window) of each chosen anchor, in order."""
    n = len(words.begin)
    if n < size:
        return (np.zeros(0, np.int64),) * 4
    starts = np.arange(n - gram + 1)
    lowest = last_minimum(words.window_hash(starts, starts + gram), size - gram + 1)
    windows = np.arange(len(lowest))
    text = words.text_of(windows)
    windows = windows[windows + size <= words.first[text + 1]]
    if not len(windows):
        return (np.zeros(0, np.int64),) * 4
    text, anchor = words.text_of(windows), lowest[windows]
    new = np.ones(len(windows), dtype=bool)
    new[1:] = (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return text[at], anchor[at], windows[at], windows[np.append(at[1:], len(windows)) - 1]


def _ordinals(text: np.ndarray) -> np.ndarray:
    """Running number within each run of equal values."""
    if not len(text):
        return text
    new = np.append(True, text[1:] != text[:-1])
    at = np.flatnonzero(new)
    return np.arange(len(text)) - np.repeat(at, np.diff(np.append(at, len(text))))


def _unseen(batches: Iterator[pa.RecordBatch], text_col: str, memory: int = 200_000) -> Iterator[pa.RecordBatch]:
    """(tk, text, ...) without the copies of what this task has met lately."""
    met: set[bytes] = set()
    for batch in batches:
        if len(met) > memory:
            met.clear()
        keep = []
        for i, key in enumerate(batch.column("tk").to_pylist()):
            if key not in met:
                met.add(key)
                keep.append(i)
        batch = batch.take(pa.array(keep, pa.int64()))
        row = batch.column("row")
        text = row.field(row.type.get_field_index(text_col))
        yield pa.RecordBatch.from_arrays([batch.column("tk"), text, *(batch.column(c) for c in batch.schema.names if c not in ("tk", "row"))], names=["tk", "text", *(c for c in batch.schema.names if c not in ("tk", "row"))])


def _seeds(size: int, gram: int, text_col: str):
    schema = pa.schema([("tk", pa.binary()), ("ord", pa.int32()), ("anchor", pa.int64()), ("z1", pa.int64()), ("z2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _unseen(batches, text_col):
            keys, texts = batch.column(0), batch.column(1)
            for low, high in blocks(texts):
                words = Words(texts.slice(low, high - low))
                text, anchor, begin, end = _zones(words, size, gram)
                if not len(text):
                    continue
                hashed = [words.window_hash(anchor, anchor + gram), *(words.window_hash(begin, end + size, lane) for lane in (0, 1))]
                yield pa.RecordBatch.from_arrays([keys.slice(low, high - low).take(pa.array(text)), pa.array(_ordinals(text).astype(np.int32)), *(pa.array(h.view(np.int64)) for h in hashed)], schema=schema)

    return run


def _windows(size: int, gram: int, text_col: str):
    """Hashes of all windows of the zones a text is to list."""
    schema = pa.schema([("tk", pa.binary()), ("start", pa.int32()), ("weight", pa.int32()), ("w1", pa.int64()), ("w2", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _unseen(batches, text_col):
            keys, texts = batch.column(0), batch.column(1)
            for low, high in blocks(texts):
                words = Words(texts.slice(low, high - low))
                text, _, begin, end = _zones(words, size, gram)
                weight = np.zeros(len(text), dtype=np.int32)
                first = np.searchsorted(text, np.arange(high - low + 1))
                for i in range(low, high):
                    for ordinal, n in zip(batch.column(2)[i].values.to_pylist(), batch.column(3)[i].values.to_pylist(), strict=True):
                        weight[first[i - low] + ordinal] = n
                listed = np.flatnonzero(weight)
                if not len(listed):
                    continue
                counts = end[listed] - begin[listed] + 1
                of = np.repeat(listed, counts)
                start = begin[of] + np.arange(counts.sum()) - np.repeat(np.cumsum(counts) - counts, counts)
                hashed = [words.window_hash(start, start + size, lane) for lane in (0, 1)]
                for a in range(0, len(of), 1 << 16):
                    part = slice(a, a + (1 << 16))
                    yield pa.RecordBatch.from_arrays([keys.slice(low, high - low).take(pa.array(text[of[part]])), pa.array((start[part] - words.first[text[of[part]]]).astype(np.int32)), pa.array(weight[of[part]]), *(pa.array(h[part].view(np.int64)) for h in hashed)], schema=schema)

    return run


def _removal(size: int, gram: int, text_col: str):
    repeats = pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())]))
    added = [pa.field("n_words", pa.int64()), pa.field("n_removed", pa.int64()), pa.field("kept_text", pa.string()), pa.field("repeats", repeats)]

    def covered(n: int, begin: np.ndarray, end: np.ndarray) -> list[tuple[int, int]]:
        steps = np.zeros(n + 1, dtype=np.int32)
        np.add.at(steps, begin, 1)
        np.add.at(steps, end, -1)
        edge = np.diff(np.concatenate([[0], (np.cumsum(steps[:-1]) > 0).astype(np.int8), [0]]))
        return list(zip(np.flatnonzero(edge == 1).tolist(), np.flatnonzero(edge == -1).tolist(), strict=True))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            row, copies, whole, single = (batch.column(c) for c in ("row", "copies", "whole", "starts"))
            texts = row.field(row.type.get_field_index(text_col))
            n_copies = copies.to_pylist()
            for low, high in blocks(texts):
                touched = [i for i in range(low, high) if n_copies[i] == 1]
                zones: dict[int, tuple[np.ndarray, np.ndarray]] = {}
                if touched:
                    again = Words(texts.take(pa.array(touched)), lanes=1)
                    text, _, begin, end = _zones(again, size, gram)
                    first = np.searchsorted(text, np.arange(len(touched) + 1))
                    for j, i in enumerate(touched):
                        own = first[j] + np.array(whole[i].as_py() or [], dtype=np.int64)
                        starts = np.array(single[i].as_py() or [], dtype=np.int64)
                        zones[i] = (np.concatenate([begin[own] - again.first[j], starts]), np.concatenate([end[own] - again.first[j], starts]) + size)
                out: list[tuple] = []
                for i, value in enumerate(texts.slice(low, high - low).to_pylist(), low):
                    found = (value or "").encode().split()
                    n, runs = len(found), []
                    if n_copies[i] is not None and n_copies[i] > 1 and n >= size:
                        runs = [(0, n)]
                    elif i in zones and len(zones[i][0]):
                        runs = covered(n, *zones[i])
                    kept, at = [], 0
                    for a, b in runs:
                        kept += found[at:a]
                        at = b
                    kept = (kept + found[at:]) if runs else found
                    out.append((n, sum(b - a for a, b in runs), b" ".join(kept).decode(), [{"begin": a, "end": b} for a, b in runs]))
                columns = [pa.array(c, type=f.type) for f, c in zip(added, zip(*out, strict=True), strict=True)]
                yield pa.RecordBatch.from_arrays([row.slice(low, high - low), *columns], schema=pa.schema([pa.field("row", row.type), *added]))

    return run


def substring_dedup(docs: DataFrame, text_col: str = "text", min_words: int = 35, gram: int = 10) -> DataFrame:
    """``docs`` with n_words, n_removed, kept_text and repeats (word ranges) added.

    A window is repeated when its words also start anywhere else in ``docs``, the
    same text included; repeats are judged on the input. A null text is empty; rows
    that repeat are copies of each other; texts under ``min_words`` words stay whole;
    other columns, null keys included, pass unchanged, but a column of an added name
    is replaced; no rows give no rows. Words follow the ``wordhash`` module.
    """
    if not 1 <= gram <= min_words:
        raise ValueError("gram must lie between 1 and min_words")
    docs = docs.drop("n_words", "n_removed", "kept_text", "repeats")
    base = docs.select(F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row"), text_key(f"`{text_col}`").alias("tk"))
    seeds = docs.where(F.octet_length(text_col) >= 2 * min_words - 1).select(F.struct(F.col(text_col)).alias("row"), text_key(text_col).alias("tk"))
    seeds = seeds.mapInArrow(_seeds(min_words, gram, text_col), "tk binary, ord int, anchor long, z1 long, z2 long")
    shared = seeds.groupBy("anchor").agg(F.count(F.lit(1)).alias("n"), *(f(z).alias(f"{g}_{z}") for z in ("z1", "z2") for g, f in (("lo", F.min), ("hi", F.max))))
    # counts are stored, so that both sides of each join are dealt out for it and AQE can split a hot key
    shared = stored(shared.where("n > 1").select("anchor", F.expr("lo_z1 = hi_z1 and lo_z2 = hi_z2").alias("alike")))
    hits = stored(seeds.join(shared, "anchor").select("tk", "ord", "alike", *(F.when(~F.col("alike"), F.col(z)).alias(z) for z in ("z1", "z2"))))
    mixed = hits.where("not alike").select("tk", "ord", "z1", "z2", F.xxhash64("tk", "ord").alias("pick"))
    zones = stored(mixed.groupBy("z1", "z2").agg(F.count(F.lit(1)).alias("n"), F.min("pick").alias("least")))
    mixed = mixed.join(zones, ["z1", "z2"]).select("tk", "ord", (F.col("n") > 1).alias("whole"), (F.col("pick") == F.col("least")).alias("lists"))
    found = hits.where("alike").select("tk", "ord", F.lit(True).alias("whole"), F.lit(False).alias("lists")).unionByName(mixed)
    per_text = stored(
        found.groupBy("tk").agg(
            F.collect_set(F.when(F.col("whole"), F.col("ord"))).alias("whole"),
            F.collect_set(F.when(F.col("lists"), F.struct("ord", F.when(F.col("whole"), 2).otherwise(1).alias("weight")))).alias("lists"),
        )
    )
    listing = base.join(per_text.where(F.size("lists") > 0).select("tk", F.col("lists.ord").alias("ords"), F.col("lists.weight").alias("weights")), "tk")
    windows = stored(listing.select("row", "tk", "ords", "weights").mapInArrow(_windows(min_words, gram, text_col), "tk binary, start int, weight int, w1 long, w2 long"))
    repeated = stored(windows.groupBy("w1", "w2").agg(F.sum("weight").alias("n")).where("n > 1").select("w1", "w2"))
    single = windows.where("weight = 1").join(repeated, ["w1", "w2"]).select("tk", "start", F.lit(None).cast("array<int>").alias("whole"), F.lit(None).cast("long").alias("copies"))
    copies = docs.groupBy(text_key(text_col).alias("tk")).agg(F.count(F.lit(1)).alias("copies")).where("copies > 1")
    nothing = F.lit(None).cast("int").alias("start")
    facts = single.unionByName(per_text.where(F.size("whole") > 0).select("tk", nothing, "whole", F.lit(None).cast("long").alias("copies"))).unionByName(copies.select("tk", nothing, F.lit(None).cast("array<int>").alias("whole"), "copies"))
    facts = stored(facts.groupBy("tk").agg(F.collect_set("start").alias("starts"), F.flatten(F.collect_set("whole")).alias("whole"), F.coalesce(F.max("copies"), F.lit(1)).alias("copies")))
    kept = base.join(facts, "tk", "left").select("row", "copies", "whole", "starts").mapInArrow(
        _removal(min_words, gram, text_col), f"row {base.schema['row'].dataType.simpleString()}, n_words long, n_removed long, kept_text string, repeats array<struct<begin:int,end:int>>"
    )
    return kept.select("row.*", "n_words", "n_removed", "kept_text", "repeats")

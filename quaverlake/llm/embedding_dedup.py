"""Embedding near-dedup by sorted projection passes.

In a pass every vector gets a code, the concatenated bits of random projections, and
vectors are ordered lexicographically by it; each is compared with the ``window`` before
it in that order. Links found in any pass are united into components, and within a
component every pair of members that can link is compared, so counts of links are whole.

Whether the passes suffice is measured, not assumed: synthetic partners of a few
thousand vectors, at the very threshold, go through the same passes, and passes go on
until they have met their vectors. Later passes also project about the
neighbourhoods of those that did not, which splits crowds; the window doubles when that
gains little, so in the last resort everything is compared with everything.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quaverlake.llm.common import connected_components, stored

#: bits of a code that projections fill; the rest spread vectors of equal bits
BITS = 40
#: most ranges that one pass is dealt to; beyond, ranges grow (a range is read as a stream)
MOST_CELLS = 4096


def _keys(kind: str):
    """Raw bytes of each usable vector, else null."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for v in batch.column(1):
                x = None if not v.is_valid or v.values.null_count else v.values.to_numpy(zero_copy_only=False).astype(kind) + 0
                usable = x is not None and len(x) and np.isfinite(x).all() and x.any()
                found.append(x.tobytes() if usable else None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, pa.binary())], names=["id", "vector"])

    return run


def _unit(raw: list[bytes], kind: str) -> np.ndarray:
    x = np.frombuffer(b"".join(raw), dtype=kind).reshape(len(raw), -1).astype(np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def _near(x: np.ndarray, y: np.ndarray, cosine: float) -> np.ndarray:
    """Which rows of x and y link; rows that single precision cannot tell are compared in double."""
    margin = (x.shape[1] + 8) * 2.0**-23
    product = x.astype(np.float32) @ y.astype(np.float32).T
    near = product >= cosine
    unsure = np.flatnonzero((np.abs(product - np.float32(cosine)) <= margin).any(axis=1))
    if len(unsure):
        near[unsure] = x[unsure] @ y.T >= cosine
    return near


def _joined(n: int, parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Smallest index that each of n rows reaches by links given as (rows, columns, matrix)."""
    label = np.arange(n, dtype=np.int32)
    while True:
        before = label.copy()
        for rows, columns, near in parts:
            label[rows] = np.minimum(label[rows], np.where(near, label[columns][None, :], n).min(axis=1))
            label[columns] = np.minimum(label[columns], np.where(near, label[rows][:, None], n).min(axis=0))
        label = label[label]
        if (label == before).all():
            return label


@dataclass
class Pass:
    """What one pass sorts by: projections, their cut points, and the ranges the order is dealt to."""

    number: int
    offsets: dict[int, np.ndarray]  # by vector length; lengths not named are cut at zero
    cells: dict[int, np.ndarray] = field(default_factory=dict)  # first code of each range but the first
    lent: dict[int, np.ndarray] = field(default_factory=dict)  # up to which code a range's head is lent to the one before

    def projections(self, dim: int) -> np.ndarray:
        return np.random.default_rng([11, self.number, dim]).standard_normal((dim, BITS))

    def codes(self, x: np.ndarray, keys: list[bytes]) -> np.ndarray:
        dim = x.shape[1]
        bits = x @ self.projections(dim) > self.offsets.get(dim, np.zeros(BITS))
        high = bits.astype(np.uint64) @ (np.uint64(1) << np.arange(63, 63 - BITS, -1, dtype=np.uint64))
        spread = np.frombuffer(b"".join(k[:8] for k in keys), dtype=np.uint64) >> np.uint64(BITS)
        return high | spread


def _plan(number: int, sample: dict[int, np.ndarray], sizes: dict[int, int], window: int, centres: dict[int, np.ndarray]) -> Pass:
    """Cut points from the sample (medians, or through ``centres`` for half the bits) and ranges of codes."""
    rng = np.random.default_rng([13, number])
    plan = Pass(number, {})
    for dim, x in sample.items():
        projected = x @ plan.projections(dim)
        offsets = np.median(projected, axis=0)
        if len(about := centres.get(dim, ())):
            chosen = about[rng.integers(len(about), size=BITS)]
            through = np.einsum("bd,db->b", chosen, plan.projections(dim))
            offsets = np.where(rng.random(BITS) < 0.5, through, offsets)
        plan.offsets[dim] = offsets
        codes = np.sort(plan.codes(x, [hashlib.md5(row.tobytes()).digest() for row in x]))
        n = min(MOST_CELLS, -(-sizes[dim] // max(8192, 8 * window)))
        at = np.arange(1, n) * len(codes) // n
        reach = max(8, math.ceil(2 * window * len(codes) / sizes[dim]))
        plan.cells[dim] = codes[at]
        plan.lent[dim] = codes[np.minimum(at + reach, len(codes) - 1)]
    return plan


def _deal(plans: list[Pass], kind: str):
    """Each row once a pass in its range, and again as a guest of the range before if it stands at its head."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, raw = batch.column(0).to_pylist(), batch.column(2).to_pylist()
            lengths = np.array([len(v) for v in raw])
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                for low in range(0, len(rows), 2048):
                    some = rows[low : low + 2048]
                    x = _unit([raw[i] for i in some], kind)
                    dim, own = x.shape[1], [keys[i] for i in some]
                    for plan in plans:
                        codes = plan.codes(x, own)
                        cell = np.searchsorted(plan.cells.get(dim, np.zeros(0, np.uint64)), codes, side="right")
                        at, home, guest = some, cell, np.zeros(len(some), bool)
                        if len(plan.cells.get(dim, ())):
                            lent = np.flatnonzero((cell > 0) & (codes <= plan.lent[dim][np.maximum(cell - 1, 0)]))
                            at, home = np.concatenate([some, some[lent]]), np.concatenate([cell, cell[lent] - 1])
                            codes, guest = np.concatenate([codes, codes[lent]]), np.concatenate([guest, np.ones(len(lent), bool)])
                        signed = (codes ^ np.uint64(1 << 63)).view(np.int64)
                        n = len(at)
                        columns = [pa.array(np.full(n, plan.number, np.int32)), pa.array(np.full(n, dim, np.int32)), pa.array(home.astype(np.int32)), pa.array(signed), pa.array(guest)]
                        yield pa.RecordBatch.from_arrays([*columns, *(batch.column(c).take(pa.array(at)) for c in range(3))], names=["pass", "dim", "cell", "code", "guest", "tk", "probe_of", "vector"])

    return run


def _grouped(batches: Iterator[pa.RecordBatch], head: int, most: int) -> Iterator[tuple[tuple, list[tuple], bool]]:
    """Rows of each run of equal first ``head`` columns, at most ``most`` at once; True ends the run."""
    group, rows = None, []
    for batch in batches:
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if row[:head] != group:
                if rows:
                    yield group, rows, True
                group, rows = row[:head], []
            elif len(rows) >= most:
                yield group, rows, False
                rows = []
            rows.append(row[head:])
    if rows:
        yield group, rows, True


def _scan(cosine: float, window: int, kind: str, block: int = 512):
    """Spanning links (a, b) among neighbours in the order, and (probe, null) of probes that met their vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        past: list[tuple] = []
        x_past = None
        for _, rows, last in _grouped(batches, 3, block):
            rows = [r[1:] for r in rows]  # guest, tk, probe_of, vector
            x = _unit([r[3] for r in rows], kind)
            both = past + rows
            x_both = x if x_past is None else np.concatenate([x_past, x])
            n = len(past)
            real = np.array([r[2] is None for r in both])
            own = real & ~np.array([r[0] for r in both])
            parts = []
            for low in range(0, len(both), 2048):
                near = _near(x, x_both[low : low + 2048], cosine)
                # a pair of guests is the next range's own; probes link with nothing
                near &= (own[n:, None] | own[None, low : low + 2048]) & real[n:, None] & real[None, low : low + 2048]
                place = np.arange(len(rows)) + n - low
                inside = (place >= 0) & (place < near.shape[1])
                near[np.flatnonzero(inside), place[inside]] = False
                a, b = np.flatnonzero(near.any(axis=1)), np.flatnonzero(near.any(axis=0))
                if len(a):
                    parts.append((n + a, low + b, near[np.ix_(a, b)]))
            left, right = [], []
            if parts:
                label = _joined(len(both), parts)
                for i in np.flatnonzero(label != np.arange(len(both))):
                    left.append(both[i][1]), right.append(both[label[i]][1])
            known = {r[1]: i for i, r in enumerate(both) if r[2] is None}
            for i, r in enumerate(both):
                if r[2] is not None and max(i, known.get(r[2], -1)) >= n and r[2] in known:
                    left.append(r[1]), right.append(None)
            if left:
                yield pa.RecordBatch.from_arrays([pa.array(left, pa.binary()), pa.array(right, pa.binary())], names=["a", "b"])
            past, x_past = ([], None) if last else (both[-window:], x_both[-window:])

    return run


def _partners(sample: dict[int, np.ndarray], n: int, cosine: float, kind: str) -> dict[bytes, tuple[int, int, bytes]]:
    """Probe key -> (length, row of the sample, bytes): partners at the threshold from vectors of the sample.

    Every other partner lies towards one of its vector's nearest neighbours, where a crowd is.
    """
    rng = np.random.default_rng(17)
    total = sum(len(x) for x in sample.values())
    found = {}
    for dim, x in sample.items():
        if dim == 1:
            continue
        m = min(len(x), max(1, n * len(x) // total))
        rows = rng.permutation(len(x))[:m]
        toward = rng.standard_normal((m, dim))
        for k in range(0, m, 2):
            likes = x @ x[rows[k]]
            close = np.argpartition(-likes, min(33, len(likes) - 1))[:33]
            if len(close := close[likes[close] < cosine]):
                toward[k] = x[rng.choice(close)]
        toward -= (toward * x[rows]).sum(axis=1, keepdims=True) * x[rows]
        length = np.sqrt((toward * toward).sum(axis=1, keepdims=True))
        made = cosine * x[rows] + math.sqrt(1 - cosine * cosine) * toward / np.maximum(length, 1e-9)
        for row, y in zip(rows, made.astype(kind), strict=True):
            raw = y.tobytes()
            found[hashlib.md5(b"probe" + raw).digest()] = (dim, int(row), raw)
    return found


def _sample(different: DataFrame, sizes: dict[int, int], rows: int, kind: str) -> tuple[dict[int, np.ndarray], dict[int, list[bytes]]]:
    """About ``rows`` vectors (all, if fewer), chosen by their keys, as units by length, and their keys."""
    share = min(1.0, rows / max(1, sum(sizes.values())))
    chosen = different if share == 1.0 else different.where(F.xxhash64("tk") / F.lit(2.0**64) + 0.5 < share)
    by_dim: dict[int, list] = {}
    width = np.dtype(kind).itemsize
    for r in chosen.select("tk", "vector").collect():
        by_dim.setdefault(len(r["vector"]) // width, []).append((bytes(r["tk"]), bytes(r["vector"])))
    ordered = {dim: sorted(found) for dim, found in by_dim.items()}
    return {dim: _unit([v for _, v in found], kind) for dim, found in ordered.items()}, {dim: [k for k, _ in found] for dim, found in ordered.items()}


def pass_links(different: DataFrame, kind: str, cosine: float, window: int = 512, passes: int = 4, missed: float = 0.0, probes: int = 4000, sample_rows: int = 16_384) -> DataFrame:
    """Links (a, b) between keys of ``different`` (tk, vector), by passes that go on while more than ``missed`` of the probes are open."""
    spark = different.sparkSession
    width = np.dtype(kind).itemsize
    sizes = {r["dim"]: r["n"] for r in different.groupBy((F.length("vector") / width).cast("int").alias("dim")).agg(F.count(F.lit(1)).alias("n")).collect()}
    links = spark.createDataFrame([], "a binary, b binary")
    most = max(sizes.values(), default=0)
    if not sizes:
        return links
    sample, sample_keys = _sample(different, sizes, max(sample_rows, 16 * min(MOST_CELLS, most // 8192)), kind)
    partners = _partners(sample, probes, cosine, kind)
    parts = max(2, int(spark.conf.get("spark.sql.shuffle.partitions")))
    open_, number, centres = set(partners), 0, {}
    while True:
        plans = [_plan(number + i, sample, sizes, window, centres) for i in range(passes)]
        number += passes
        rows = [(k, sample_keys[partners[k][0]][partners[k][1]], partners[k][2]) for k in open_]
        lent = spark.createDataFrame(rows, "tk binary, probe_of binary, vector binary")
        dealt = different.select("tk", F.lit(None).cast("binary").alias("probe_of"), "vector").unionByName(lent).mapInArrow(_deal(plans, kind), "pass int, dim int, cell int, code long, guest boolean, tk binary, probe_of binary, vector binary")
        ordered = dealt.repartition(parts, "pass", "dim", "cell").sortWithinPartitions("pass", "dim", "cell", "code", "tk")
        found = stored(ordered.mapInArrow(_scan(cosine, window, kind), "a binary, b binary"))
        links = links.unionByName(found.where("b is not null"))
        before = len(open_)
        open_ -= {bytes(r["a"]) for r in found.where("b is null").select("a").distinct().collect()}
        if len(open_) <= missed * len(partners) or window >= most:
            return links
        centres = {}
        for k in sorted(open_)[:256]:
            dim, row, _ = partners[k]
            close = np.argsort(-(sample[dim] @ sample[dim][row]))[:32]
            centres.setdefault(dim, []).append(sample[dim][close].mean(axis=0))
        centres = {dim: np.array(found) for dim, found in centres.items()}
        if 2 * len(open_) > before:
            window *= 2


def _compare(cosine: float, kind: str, chunk: int = 512):
    """Links of each member with the other block of its pair, by copies."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), rows, _ in _grouped(batches, 3, 1 << 30):
            block = np.array([r[0] for r in rows])
            copies = np.array([r[2] for r in rows], dtype=np.int64)
            left, right = np.flatnonzero(block == i), np.flatnonzero(block == j)
            x = _unit([r[3] for r in rows], kind)
            n = np.zeros(len(rows), dtype=np.int64)
            for low in range(0, len(left), chunk):
                some = left[low : low + chunk]
                near = _near(x[some], x[right], cosine)
                if i == j:
                    near[np.arange(len(some)), np.arange(low, low + len(some))] = True
                else:
                    n[right] += near.T @ copies[some]
                n[some] += near @ copies[right]
            out = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([rows[k][1] for k in out], pa.binary()), pa.array(n[out])], names=["tk", "n"])

    return run


def _split(kind: str, bits: int = 16):
    """Codes of the members of large components, by random planes through their root's vector."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            raw, about, want = (batch.column(c).to_pylist() for c in (3, 4, 5))
            codes = np.zeros(len(raw), np.int64)
            lengths = np.array([len(v) for v in raw])
            for length in np.unique(lengths):
                rows = np.flatnonzero(lengths == length)
                x, c = _unit([raw[i] for i in rows], kind), _unit([about[i] for i in rows], kind)
                planes = np.random.default_rng([19, x.shape[1]]).standard_normal((x.shape[1], bits))
                side = ((x - c) @ planes > 0).astype(np.int64) @ (1 << np.arange(bits, dtype=np.int64))
                codes[rows] = side & ((1 << np.minimum(bits, np.array([want[i] for i in rows]))) - 1)
            yield pa.RecordBatch.from_arrays([*batch.columns[:4], pa.array(codes)], names=["root", "tk", "copies", "vector", "code"])

    return run


def _balls(kind: str):
    """Centre and radius (an angle) of each block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (root, block), rows, _ in _grouped(batches, 2, 1 << 30):
            x = _unit([r[0] for r in rows], kind)
            centre = x.mean(axis=0)
            centre = x[0] if np.abs(centre).max() < 1e-12 else centre / np.sqrt(centre @ centre)
            radius = float(np.arccos(np.clip((x @ centre).min(), -1, 1)))
            yield pa.RecordBatch.from_arrays([pa.array([root], pa.binary()), pa.array([block], pa.int64()), pa.array([centre.tolist()], pa.list_(pa.float64())), pa.array([radius])], names=["root", "block", "centre", "radius"])

    return run


def _counts(members: DataFrame, kind: str, cosine: float, block: int) -> DataFrame:
    """(tk, n): links of every member of a component, itself included, by copies.

    A component beyond ``block`` members is cut into blocks of vectors on like sides of
    random planes; pairs of blocks whose balls lie too far apart are not compared.
    """
    parts = max(2, int(members.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    sizes = members.groupBy("root").agg(F.count(F.lit(1)).alias("size"))
    sized = stored(members.join(sizes, "root"))
    compare = _compare(cosine, kind)

    def compared(dealt: DataFrame) -> DataFrame:
        ordered = dealt.select("root", "i", "j", "block", "tk", "copies", "vector").repartition(parts, "root", "i", "j").sortWithinPartitions("root", "i", "j")
        return ordered.mapInArrow(compare, "tk binary, n long")

    zero = F.lit(0).cast("long")
    small = compared(sized.where(F.col("size") <= block).withColumns({"i": zero, "j": zero, "block": zero}))
    large = sized.where(F.col("size") > block)
    if large.isEmpty():
        return small
    about = large.where("tk = root").select("root", F.col("vector").alias("about"))
    want = F.ceil(F.log2(F.col("size") / block)).cast("int") + 1
    coded = stored(large.join(about, "root").select("root", "tk", "copies", "vector", "about", want.alias("want")).mapInArrow(_split(kind), "root binary, tk binary, copies long, vector binary, code long"))
    chunks = coded.groupBy("root", "code").agg(F.ceil(F.count(F.lit(1)) / block).cast("long").alias("chunks"))
    blocked = stored(coded.join(chunks, ["root", "code"]).withColumn("block", F.col("code") * F.lit(1 << 32) + F.pmod(F.xxhash64("tk"), F.col("chunks"))).drop("code", "chunks"))
    balls = blocked.select("root", "block", "vector").repartition(parts, "root", "block").sortWithinPartitions("root", "block").mapInArrow(_balls(kind), "root binary, block long, centre array<double>, radius double")
    balls = stored(balls)
    other = balls.select("root", F.col("block").alias("j"), F.col("centre").alias("there"), F.col("radius").alias("reach"))
    dot = F.aggregate(F.zip_with("centre", "there", lambda a, b: a * b), F.lit(0.0), lambda s, v: s + v)
    apart = F.acos(F.least(F.lit(1.0), F.greatest(F.lit(-1.0), dot)))
    pairs = stored(balls.join(other, "root").where(F.col("block") <= F.col("j")).where(apart <= F.col("radius") + F.col("reach") + math.acos(cosine) + 1e-6).select("root", F.col("block").alias("i"), "j"))
    sides = pairs.select("root", "i", "j", F.col("i").alias("block")).unionByName(pairs.where("i < j").select("root", "i", "j", F.col("j").alias("block")))
    return small.unionByName(compared(blocked.join(sides, ["root", "block"])))


def embedding_links(
    vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", cosine: float = 0.95, window: int = 512, passes: int = 4, missed: float = 0.0, probes: int = 4000, block: int = 4096
) -> DataFrame:
    """(id, n_links, component_id, kept), one row per row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite components link with
    nothing, as do vectors of different lengths; such rows are components of their
    own. Rows that repeat are vectors of their own and link with each other; null ids
    stay null and are never the smallest unless alone. Other columns are ignored; no
    rows give no rows. No link below ``cosine`` is reported; rounds of ``passes`` passes
    go on until all but a share ``missed`` of the ``probes`` synthetic pairs at the
    threshold met within ``window``. All vectors go through every pass, in ranges that
    overlap by twice the window, so results do not hang on the number of partitions.
    """
    if not 0 < cosine <= 1:
        raise ValueError("cosine must lie in (0, 1]")
    if not isinstance(vectors.schema[vector_col].dataType, T.ArrayType):
        raise TypeError("vectors must be arrays of numbers")
    kind = "<f4" if isinstance(vectors.schema[vector_col].dataType.elementType, T.FloatType) else "<f8"
    id_type = vectors.schema[id_col].dataType.simpleString()
    numbers = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("vector"))
    keyed = stored(numbers.mapInArrow(_keys(kind), f"id {id_type}, vector binary").select("id", "vector", F.unhex(F.md5("vector")).alias("tk")))
    different = stored(keyed.where("vector is not null").groupBy("tk").agg(F.first("vector").alias("vector"), F.count(F.lit(1)).alias("copies"), F.min("id").alias("least")))
    roots = connected_components(pass_links(different, kind, cosine, window, passes, missed, probes))
    members = stored(different.join(roots.select(F.col("node").alias("tk"), "root"), "tk"))
    linked = stored(_counts(members.select("root", "tk", "copies", "vector"), kind, cosine, block)).groupBy("tk").agg(F.sum("n").alias("n"))
    least = members.groupBy("root").agg(F.min("least").alias("component_id"))
    near = members.join(least, "root").select("tk", "component_id")
    facts = different.select("tk", "copies", "least").join(linked, "tk", "left").join(near, "tk", "left")
    facts = stored(facts.select("tk", (F.coalesce("n", "copies") - 1).alias("n_links"), F.coalesce("component_id", "least").alias("component_id")))
    found = keyed.select("id", "tk").join(facts, "tk", "left")
    return found.select("id", F.coalesce("n_links", F.lit(0)).alias("n_links"), F.coalesce("component_id", "id").alias("component_id")).withColumn("kept", F.expr("id <=> component_id"))

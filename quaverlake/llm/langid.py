"""Language ID: multinomial logistic regression on TF-IDF character n-grams.

N-grams (lengths 1 to 3 of the lower-cased text) are hashed into ``buckets``.
Document frequencies come from every training document; weights are learned by
follow-the-regularised-leader with elastic-net penalties on a bounded sample of
labelled documents; a part of that sample is set aside to fit the temperature.
The fitted table (buckets x languages) has a fixed size and is broadcast.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_STEP = (np.uint32(0x9E3779B1), np.uint32(0x85EBCA6B), np.uint32(0xC2B2AE35))
UNKNOWN = "und"
NO_LETTER = "text is null or not text rlike '\\\\p{L}'"
HAS_LETTER = f"not ({NO_LETTER})"


@dataclass
class LanguageModel:
    """languages; table[bucket, language] = idf * weight; bias; temperature."""

    languages: list[str]
    table: np.ndarray
    bias: np.ndarray
    temperature: float
    bits: int
    n_documents: int = 0
    n_sampled: int = 0


def _codes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    lowered = [t.lower() for t in texts]
    at = np.zeros(len(texts) + 1, dtype=np.int64)
    np.cumsum([len(t) for t in lowered], out=at[1:])
    return np.frombuffer("".join(lowered).encode("utf-32-le", "surrogatepass"), dtype="<u4"), at


def _grams(codes: np.ndarray, bits: int) -> list[np.ndarray]:
    """Bucket of the n-gram that starts at each position, for n = 1, 2, 3."""
    out, running = [], np.zeros(len(codes), dtype=np.uint32)
    for n in range(3):
        m = len(codes) - n
        if m <= 0:
            break
        running = (running[:m] ^ codes[n:]) * _STEP[n]
        running ^= running >> np.uint32(15)
        out.append(((running * np.uint32(0x2C1B3C6D)) >> np.uint32(32 - bits)).astype(np.int32))
    return out


def _within(at: np.ndarray, size: int, n: int) -> np.ndarray:
    """Mask of the starts whose n-gram stays inside its text."""
    ok = np.ones(max(size - n, 0), dtype=bool)
    for back in range(1, n + 1):
        edge = at[1:-1] - back
        ok[edge[(edge >= 0) & (edge < len(ok))]] = False
    return ok


def _blocks(texts: pa.Array, size: int = 1 << 18) -> Iterator[tuple[int, list[str]]]:
    values = texts.to_pylist()
    low = 0
    while low < len(values):
        high, n = low, 0
        while high < len(values) and (n == 0 or n + len(values[high] or "") <= size):
            n += len(values[high] or "")
            high += 1
        yield low, [v or "" for v in values[low:high]]
        low = high


def _frequencies(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros(1 << bits, dtype=np.int64), 0
        for batch in batches:
            for _, texts in _blocks(batch.column(0)):
                codes, at = _codes(texts)
                grams = _grams(codes, bits)
                for a, b in zip(at[:-1], at[1:], strict=True):
                    n += 1
                    own = [g[a : max(a, b - k)] for k, g in enumerate(grams)]
                    if b - a < 4000:
                        total[np.unique(np.concatenate(own))] += 1 if own else 0
                    else:
                        seen = np.zeros(1 << bits, dtype=bool)
                        for g in own:
                            seen[g] = True
                        total += seen
        if n:
            used = np.flatnonzero(total)
            yield pa.RecordBatch.from_arrays([pa.array(np.append(used, -1).astype(np.int32)), pa.array(np.append(total[used], n))], names=["bucket", "n"])

    return run


def _features(bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for low, texts in _blocks(batch.column(1)):
                codes, at = _codes(texts)
                grams = _grams(codes, bits)
                rows = [np.unique(np.concatenate([g[a : max(a, b - k)] for k, g in enumerate(grams)] or [np.zeros(0, np.int32)]), return_counts=True) for a, b in zip(at[:-1], at[1:], strict=True)]
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, len(texts)), batch.column(2).slice(low, len(texts)), pa.array([r[0] for r in rows], pa.list_(pa.int32())), pa.array([r[1].astype(np.int32) for r in rows], pa.list_(pa.int32()))], names=["pick", "lang", "buckets", "counts"])

    return run


def _softmax(z: np.ndarray) -> np.ndarray:
    e = np.exp(z - z.max(axis=-1, keepdims=True))
    return e / e.sum(axis=-1, keepdims=True)


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, n_classes: int, alpha: float, beta: float, l1: float, l2: float, epochs: int) -> tuple[np.ndarray, np.ndarray]:
    """Per-coordinate FTRL-proximal with elastic net; (weights, bias)."""
    z, n = np.zeros((size + 1, n_classes)), np.zeros((size + 1, n_classes))

    def weights(at: np.ndarray) -> np.ndarray:
        w = -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2)
        w[np.abs(z[at]) <= l1] = 0.0
        return w

    order = np.random.Generator(np.random.PCG64(7))
    for _ in range(epochs):
        for i in order.permutation(len(rows)):
            at, value, target = rows[i]
            at, value = np.append(at, size), np.append(value, 1.0)
            w = weights(at)
            error = _softmax(value @ w)
            error[target] -= 1.0
            g = value[:, None] * error[None, :]
            z[at] += g - (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha * w
            n[at] += g * g
    w = weights(np.arange(size + 1))
    return w[:size], w[size]


def _temperature(logits: np.ndarray, target: np.ndarray) -> float:
    """Golden-section search of the log temperature with least log loss."""
    if not len(target):
        return 1.0

    def loss(log_t: float) -> float:
        p = _softmax(logits / np.exp(log_t))[np.arange(len(target)), target]
        return float(-np.log(np.maximum(p, 1e-12)).mean())

    low, high, ratio = -3.0, 3.0, (5**0.5 - 1) / 2
    for _ in range(40):
        a, b = high - ratio * (high - low), low + ratio * (high - low)
        low, high = (low, b) if loss(a) <= loss(b) else (a, high)
    return float(np.exp((low + high) / 2))


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", key_col: str = "doc_id", sample: int = 3000, bits: int = 15, alpha: float = 0.5, beta: float = 1.0, l1: float = 1e-4, l2: float = 1e-4, epochs: int = 3, gain: float = 20.0) -> LanguageModel:
    """Fit on ``docs``; rows without a language or a letter are not learned from.

    ``sample`` bounds how many rows the weights and the temperature are fitted on,
    about as many of each language; document frequencies use all rows. Languages
    are few: they are listed on the driver. ``gain`` scales the features (term
    frequencies are shares of a text's n-grams, so they are small). Rows are sampled by
    their key and text, so null or repeated keys spread; rows that repeat whole are
    sampled as one. Texts may be of any length; an empty table, or one that names no
    language, gives a model of no languages.
    """
    known = docs.select(F.xxhash64(F.lit("langid"), key_col, text_col, lang_col).alias("pick"), F.col(text_col).alias("text"), F.col(lang_col).alias("lang")).where(f"lang is not null and not ({NO_LETTER})")
    counts = {r["lang"]: r["n"] for r in known.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}
    languages = sorted(counts)
    if not languages:
        return LanguageModel([], np.zeros((1 << bits, 0)), np.zeros(0), 1.0, bits)
    found = known.select("text").mapInArrow(_frequencies(bits), "bucket int, n long").groupBy("bucket").agg(F.sum("n").alias("n")).toPandas()
    total = int(found.loc[found["bucket"] == -1, "n"].sum())
    df = np.zeros(1 << bits)
    found = found[found["bucket"] >= 0]
    df[found["bucket"].to_numpy()] = found["n"].to_numpy()
    idf = np.log((1.0 + total) / (1.0 + df)) + 1.0
    each = max(1, sample // len(languages))
    share = F.create_map(*(F.lit(x) for k in languages for x in (k, min(1.0, each / counts[k]))))
    chosen = known.where((F.col("pick") / F.lit(2.0**64) + 0.5) < share[F.col("lang")]).dropDuplicates(["pick"]).select("pick", "text", "lang").mapInArrow(_features(bits), "pick long, lang string, buckets array<int>, counts array<int>")
    rows = []
    for r in sorted(chosen.toLocalIterator(), key=lambda r: r["pick"]):
        at, tf = np.array(r["buckets"], dtype=np.int64), np.array(r["counts"], dtype=np.float64)
        rows.append((at, tf / max(tf.sum(), 1.0) * idf[at] * gain, languages.index(r["lang"])))
    held = len(rows) // 5
    weights, bias = ftrl(rows[held:], 1 << bits, len(languages), alpha, beta, l1, l2, epochs)
    logits = np.array([x @ weights[at] + bias for at, x, _ in rows[:held]]).reshape(-1, len(languages))
    temperature = _temperature(logits, np.array([t for _, _, t in rows[:held]], dtype=np.int64))
    return LanguageModel(languages, (gain * idf[:, None] * weights).astype(np.float32), bias, temperature, bits, total, len(rows))


def predict(docs: DataFrame, model: LanguageModel, text_col: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score added (columns of these names are replaced).

    ``und`` with score 0 where the text is null or has no letter, or nothing was learned;
    rows that repeat are judged each; all other columns pass unchanged.
    """
    docs = docs.drop("lang_pred", "score")
    spark = docs.sparkSession
    shipped = spark.sparkContext.broadcast(model)  # 2**bits rows of one float a language

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shipped.value
        k = len(m.languages)
        for batch in batches:
            row, text, empty = batch.columns
            blank = empty.to_pylist()
            for low, texts in _blocks(text):
                codes, at = _codes(texts)
                sums = np.zeros((len(texts), max(k, 1)))
                n_grams = np.zeros(len(texts))
                if k and len(codes):
                    filled = np.flatnonzero(at[:-1] < at[1:])
                    for n, grams in enumerate(_grams(codes, m.bits)):
                        grams = np.append(grams, np.zeros(n, dtype=np.int32))
                        ok = np.append(_within(at, len(codes), n), np.zeros(n, dtype=bool))
                        value = m.table[grams]
                        value[~ok] = 0.0
                        sums[filled] += np.add.reduceat(value, at[:-1][filled], axis=0, dtype=np.float64)
                        n_grams += np.maximum(np.diff(at) - n, 0)
                p = _softmax((sums / np.maximum(n_grams, 1.0)[:, None] + m.bias) / m.temperature) if k else sums
                best = p.argmax(axis=1)
                und = [not k or blank[low + i] for i in range(len(texts))]
                yield pa.RecordBatch.from_arrays(
                    [row.slice(low, len(texts)), pa.array([UNKNOWN if u else m.languages[b] for u, b in zip(und, best, strict=True)]), pa.array(np.where(und, 0.0, p[np.arange(len(texts)), best]))], names=["row", "lang_pred", "score"]
                )

    row = F.struct(*(F.col(f"`{c}`") for c in docs.columns)).alias("row")
    keyed = docs.select(row, F.col(f"`{text_col}`").alias("text")).withColumn("empty", F.expr(NO_LETTER))
    kind = keyed.schema["row"].dataType.simpleString()
    return keyed.mapInArrow(run, f"row {kind}, lang_pred string, score double").select("row.*", "lang_pred", "score")

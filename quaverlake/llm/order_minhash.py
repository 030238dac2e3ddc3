"""Near-duplicate classes by order MinHash, verified by banded alignment.

A text's k-mers are runs of ``k`` words, labelled by how often they occurred before
in the text. Their hashes are dealt to ``bands`` bands; each keeps the ``per_sketch``
smallest in text order, so a sketch is sensitive to order as edit distance is.
Texts that share a sketch are candidates: each is aligned, word by word and within
the band its length allows, with its bucket's leader. In buckets that this leaves in
several components (a passage that many texts share, versions that drift away from the
leader) every pair not yet connected is judged, block of members against block: lengths
and counts of shared words and word pairs rule most pairs out for certain, the others
are aligned. Classes are the connected components of the links.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaverlake.llm.common import connected_components, stored, text_key
from quaverlake.llm.wordhash import Words, blocks, mix

def _ranks(keys: np.ndarray) -> np.ndarray:
    """How often each key occurred before; few keys occur twice, so only those are sorted by place."""
    out = np.zeros(len(keys), dtype=np.uint64)
    ordered = np.sort(keys)
    twice = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(twice):
        return out
    place = np.minimum(np.searchsorted(twice, keys), len(twice) - 1)
    at = np.flatnonzero(twice[place] == keys)
    order = at[np.argsort(keys[at], kind="stable")]
    new = np.append(True, keys[order][1:] != keys[order][:-1])
    first = np.flatnonzero(new)
    out[order] = np.arange(len(order)) - np.repeat(first, np.diff(np.append(first, len(order))))
    return out


def sketches(texts: pa.Array, k: int, bands: int, per_sketch: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text, band, sketch) of every band in which a text has a k-mer.

    Hashed k-mers are dealt to bands; in each, the ``per_sketch`` smallest (all, if
    there are fewer) are kept in text order. A text under ``k`` words is one k-mer.
    """
    words = Words(texts, lanes=1, fold=True)
    n_words = np.diff(words.first)
    some = np.flatnonzero(n_words)
    if not len(some):
        return some, some, some
    counts = np.maximum(n_words[some] - k + 1, 1)
    first = np.cumsum(counts) - counts
    owner = np.repeat(np.arange(len(some)), counts)
    begin = words.first[some][owner] + np.arange(len(owner)) - first[owner]
    grams = words.window_hash(begin, np.minimum(begin + k, words.first[some + 1][owner]))
    salt = mix(owner.astype(np.uint64) + np.uint64(1))
    labelled = mix(grams + _ranks(grams ^ salt) * np.uint64(0x9E3779B97F4A7C15))
    group = owner * bands + (labelled % np.uint64(bands)).astype(np.int64)
    bits = max(1, int(group[-1] + bands).bit_length())
    order = np.argsort((group.astype(np.uint64) << np.uint64(64 - bits)) | (labelled >> np.uint64(bits)))
    dealt = group[order]
    start = np.flatnonzero(np.append(True, dealt[1:] != dealt[:-1]))
    size = np.diff(np.append(start, len(dealt)))
    chosen = np.full((len(start), per_sketch), len(owner), dtype=np.int64)
    for j in range(per_sketch):
        have = size > j
        chosen[have, j] = order[start[have] + j]
    chosen.sort(axis=1)
    padded = np.append(labelled, np.uint64(0))
    sketch = dealt[start].astype(np.uint64) % np.uint64(bands)
    for j in range(per_sketch):
        sketch = mix(sketch * np.uint64(3) + padded[chosen[:, j]])
    return some[dealt[start] // bands], dealt[start] % bands, sketch.view(np.int64)


def _sketch(k: int, bands: int, per_sketch: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        met: set[bytes] = set()
        for batch in batches:
            if len(met) > 200_000:
                met.clear()
            keys = batch.column(0).to_pylist()
            keep = [i for i, key in enumerate(keys) if not (key in met or met.add(key))]
            batch = batch.take(pa.array(keep, pa.int64()))
            for low, high in blocks(batch.column(1)):
                text, _, found = sketches(batch.column(1).slice(low, high - low), k, bands, per_sketch)
                if len(text):
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(low + text)), pa.array(found)], names=["tk", "sketch"])

    return run


def _tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    met: set[bytes] = set()
    for batch in batches:
        if len(met) > 200_000:
            met.clear()
        keep = [i for i, key in enumerate(batch.column(0).to_pylist()) if not (key in met or met.add(key))]
        batch = batch.take(pa.array(keep, pa.int64()))
        for low, high in blocks(batch.column(1)):
            words = Words(batch.column(1).slice(low, high - low), lanes=1, fold=True)
            short = (words.hashes[0] >> np.uint64(32)).astype(np.uint32)
            tokens = [short[a:b].tobytes() for a, b in zip(words.first[:-1], words.first[1:], strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, high - low), pa.array(tokens, pa.binary())], names=["tk", "tokens"])


def _banded(a: list[int], b: list[int], limit: int) -> int:
    """Edit distance of a (the longer) and b along a band of ``limit`` diagonals either way.

    A column of the band is two bit vectors, where the distance rises and falls going
    down; the band moves one row down with each column, and its lowest cell's distance
    is carried along, first down the diagonal, then along the last row.
    """
    width = 2 * limit + 2
    full, corner, along = (1 << width) - 1, 1 << (width - 1), 1 << (width - 2)
    places: dict[int, int] = {}
    bit = 1
    for token in a:
        places[token] = places.get(token, 0) | bit
        bit <<= 1
    rises, falls = ((1 << (limit + 1)) - 1) << (width - limit - 1), 0
    shift = limit + 1 - width
    distance, most, turn = limit, 2 * limit + len(b) - len(a), len(a) - limit
    for i, token in enumerate(b):
        equal = places.get(token, 0)
        equal = (equal >> shift if shift >= 0 else equal << -shift) & full
        same = ((((equal & rises) + rises) ^ rises) | equal | falls) & full
        right_up, right_down = (falls | ~(same | rises)) & full, same & rises
        if i < turn:
            distance += not same & corner
            if distance > most:
                return limit + 1
        else:
            distance += bool(right_up & along) - bool(right_down & along)
            along >>= 1
        down = same >> 1
        rises, falls = (right_down | ~(down | right_up)) & full, down & right_up
        shift += 1
    return distance if distance <= limit else limit + 1


def _trimmed(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Both without what they begin and end with alike."""
    common = min(len(a), len(b))
    unlike = np.flatnonzero(a[:common] != b[:common])
    head = int(unlike[0]) if len(unlike) else common
    a, b = a[head:], b[head:]
    common = min(len(a), len(b))
    unlike = np.flatnonzero(a[len(a) - common :][::-1] != b[len(b) - common :][::-1])
    tail = int(unlike[0]) if len(unlike) else common
    return a[: len(a) - tail], b[: len(b) - tail]


def edits_within(a: np.ndarray, b: np.ndarray, limit: int) -> int:
    """Word edit distance of two token arrays if at most ``limit``, else limit + 1.

    What they begin and end with alike is set aside; then a bound from shared
    trigrams (an edit destroys three at most), then banded alignment.
    """
    if abs(len(a) - len(b)) > limit:
        return limit + 1
    a, b = _trimmed(a, b)
    n, m = len(a), len(b)
    if not n or not m:
        return max(n, m) if max(n, m) <= limit else limit + 1
    if min(n, m) > 12:
        grams = [mix(x[:-2].astype(np.uint64) + mix(x[1:-1].astype(np.uint64) + mix(x[2:].astype(np.uint64)))) for x in (a, b)]
        left, n_left = np.unique(grams[0], return_counts=True)
        right, n_right = np.unique(grams[1], return_counts=True)
        _, i, j = np.intersect1d(left, right, assume_unique=True, return_indices=True)
        if max(n, m) - 2 - np.minimum(n_left[i], n_right[j]).sum() > 3 * limit:
            return limit + 1
    if n < m:
        a, b = b, a
    return _banded(a.tolist(), b.tolist(), min(limit, max(n, m))) if limit < max(n, m) else _whole(a, b)


def _whole(a: np.ndarray, b: np.ndarray) -> int:
    """Distance where the band would be wider than the table; both are short then."""
    return _banded(a.tolist(), b.tolist(), len(a))


def _aligned(pairs: list[tuple[np.ndarray, np.ndarray]], limit: int) -> np.ndarray:
    """Edit distance of each pair where it is at most ``limit``, else more; a cell of the table is a row over all pairs.

    Tables are filled by antidiagonals, i words of the first text and d - i of the
    second, within the band of ``limit`` diagonals either way. Padding lies behind a
    pair's last cell and never reaches it.
    """
    sizes = np.array([(len(a), len(b)) for a, b in pairs])
    n, m = sizes.max(axis=0).tolist()
    first, second = np.zeros((n, len(pairs)), np.uint32), np.zeros((m, len(pairs)), np.uint32)
    for p, (a, b) in enumerate(pairs):
        first[: len(a), p] = a
        second[m - len(b) :, p] = b[::-1]
    ends = sizes.sum(axis=1)
    by_end = np.argsort(ends, kind="stable")
    met, out = 0, np.empty(len(pairs), dtype=np.int64)
    # row i + 1 is i words; the rows beside the band are out of reach
    older, old, new = (np.full((n + 3, len(pairs)), _FAR, dtype=np.int16) for _ in range(3))
    old[1] = 0
    unlike, beside = np.empty(first.shape, dtype=bool), np.empty(first.shape, dtype=np.int16)
    for d in range(1, int(ends.max()) + 1):
        low, high = max(0, d - m, (d - limit + 1) // 2), min(n, d, (d + limit) // 2)
        x, y = max(low, 1), min(high, d - 1)
        if x <= y:
            differ, step, cell = unlike[: y - x + 1], beside[: y - x + 1], new[x + 1 : y + 2]
            np.not_equal(first[x - 1 : y], second[m - d + x : m - d + y + 1], out=differ)
            np.add(older[x : y + 1], differ, out=cell)
            np.minimum(old[x : y + 1], old[x + 1 : y + 2], out=step)
            step += 1
            np.minimum(cell, step, out=cell)
        if low == 0:
            new[1] = d
        if high == d:
            new[d + 1] = d
        new[low] = new[high + 2] = _FAR
        while met < len(pairs) and ends[by_end[met]] == d:
            out[by_end[met]] = new[sizes[by_end[met], 0] + 1, by_end[met]]
            met += 1
        older, old, new = old, new, older
    return out


#: beyond any distance of texts aligned together, and how many cells their bands may have
_FAR, _CELLS = 32_000, 2_000_000


def alike(pairs: list[tuple[np.ndarray, np.ndarray]], similarity: float) -> np.ndarray:
    """Which pairs of token arrays are within the edits that ``similarity`` allows the longer.

    Pairs of like size are aligned together, so that a pair takes a few dozen
    microseconds; single ones and those with large bands are aligned by bit vectors.
    """
    near = np.zeros(len(pairs), dtype=bool)
    rest = []
    for p, (a, b) in enumerate(pairs):
        limit = int(max(len(a), len(b)) * (1 - similarity) + 1e-9)
        if abs(len(a) - len(b)) > limit:
            continue
        a, b = _trimmed(a, b)
        n, m = len(a), len(b)
        if max(n, m) <= limit or not min(n, m):
            near[p] = max(n, m) <= limit
        elif n + m < _FAR and n * min(m, 2 * limit + 1) <= _CELLS:
            rest.append((n + m, p, a, b, limit))
        else:
            near[p] = edits_within(a, b, limit) <= limit
    rest.sort(key=lambda r: r[:2])
    at = 0
    while at < len(rest):
        most = rest[at][0] + rest[at][0] // 4 + 8
        end = min(len(rest), at + max(32, 65_536 // most))
        while rest[end - 1][0] > most:
            end -= 1
        some = rest[at:end]
        if len(some) < 16:
            for _, p, a, b, limit in some:
                near[p] = edits_within(a, b, limit) <= limit
        else:
            found = _aligned([(a, b) for _, _, a, b, _ in some], max(r[4] for r in some))
            near[[r[1] for r in some]] = found <= np.array([r[4] for r in some])
        at = end
    return near


def _verify(similarity: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sides = ([np.frombuffer(x, np.uint32) for x in batch.column(c).to_pylist()] for c in (2, 3))
            found = alike(list(zip(*sides, strict=True)), similarity)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(found, pa.bool_())], names=["tk", "lead", "alike"])

    return run


def _features(tokens: list[np.ndarray], run: int, size: int) -> np.ndarray:
    """How often each text's runs of ``run`` words, told apart by occurrence, fall to each of ``size`` slots.

    The product of two rows is never less than the number of runs that both texts hold.
    """
    counts = np.array([max(0, len(t) - run + 1) for t in tokens])
    owner = np.repeat(np.arange(len(tokens)), counts)
    grams = np.concatenate([t[: n] for t, n in zip(tokens, counts, strict=True)]).astype(np.uint64)
    for j in range(1, run):
        grams = mix(grams) + np.concatenate([t[j : j + n] for t, n in zip(tokens, counts, strict=True)])
    salt = mix(owner.astype(np.uint64) + np.uint64(1))
    slot = mix(mix(grams) + _ranks(grams ^ salt) * np.uint64(0x9E3779B97F4A7C15)) & np.uint64(size - 1)
    return np.bincount(owner * size + slot.astype(np.int64), minlength=len(tokens) * size).reshape(len(tokens), size).astype(np.float32)


def hopeful(left: list[np.ndarray], right: list[np.ndarray] | None, similarity: float, chunk: int = 128) -> Iterator[tuple[int, int]]:
    """Index pairs of ``left`` with ``right`` (within ``left``, if None) less those that cannot be near.

    An edit destroys one word and two word pairs of the longer text at most, so texts
    with fewer in common, or lengths too far apart, are never within the limit.
    """
    inside = right is None
    sides = [left, left if inside else right]
    order = [np.argsort([len(t) for t in side], kind="stable") for side in sides]
    length = [np.array([len(side[i]) for i in o], dtype=np.int64) for side, o in zip(sides, order, strict=True)]
    made: dict = {}

    def rows(side: int, at: int, run: int, size: int) -> np.ndarray:
        key = (0 if inside else side, at, run, size)
        if key not in made:
            if len(made) >= 32:
                made.pop(next(iter(made)))
            made[key] = _features([sides[side][i] for i in order[side][at : at + chunk]], run, size)
        return made[key]

    for x in range(0, len(left), chunk):
        for y in range(x if inside else 0, len(sides[1]), chunk):
            n, m = length[0][x : x + chunk], length[1][y : y + chunk]
            longest = np.maximum(n[:, None], m[None, :])
            limit = (longest * (1 - similarity) + 1e-9).astype(np.int64)
            open_ = np.abs(n[:, None] - m[None, :]) <= limit
            if inside and x == y:
                open_ = np.triu(open_, 1)
            for run, lost in ((2, 2), (1, 1)):
                if open_.sum() > 8:
                    size = 1 << min(14, max(8, (8 * int(max(n[-1], m[-1]))).bit_length()))
                    open_ &= rows(0, x, run, size) @ rows(1, y, run, size).T >= longest - run + 1 - lost * limit
            for i, j in np.argwhere(open_):
                yield int(order[0][x + i]), int(order[1][y + j])


def _turns(key: bytes, buckets: list[int]) -> list[int]:
    """A text's buckets in an order of its own."""
    salt = int.from_bytes(key[:8])
    return sorted(buckets, key=lambda b: (b ^ salt) * 0x9E3779B97F4A7C15 % 2**64)


def _judge(similarity: float):
    """Links between unconnected members of the two blocks (or within the one) of each group."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        group, rows = None, []

        def flush() -> pa.RecordBatch | None:
            bucket, i, j = group
            left = [r for r in rows if r[0] == i]
            right = left if i == j else [r for r in rows if r[0] == j]
            above: dict[bytes, bytes] = {}

            def top(root: bytes) -> bytes:
                while root in above:
                    root = above[root]
                return root

            shared = [[set(r[3]) for r in side] for side in (left, right)]
            turns = [[_turns(r[1], r[3]) for r in side] for side in (left, right)]
            tokens = [[np.frombuffer(r[4], np.uint32) for r in side] for side in (left, right)]
            found, waiting = [], []

            def align() -> None:
                near = alike([(tokens[0][x], tokens[1][y]) for x, y in waiting], similarity)
                for k in np.flatnonzero(near).tolist():
                    x, y = waiting[k]
                    a, b = top(left[x][2]), top(right[y][2])
                    if a != b:
                        above[a] = b
                        found.append((left[x][1], right[y][1]))
                waiting.clear()

            for x, y in hopeful(tokens[0], None if i == j else tokens[1], similarity):
                if top(left[x][2]) == top(right[y][2]):
                    continue
                # pairs that meet in several buckets are judged in one: the first shared one in turn of the lesser key
                turn, other = (turns[0][x], shared[1][y]) if left[x][1] < right[y][1] else (turns[1][y], shared[0][x])
                if next(b for b in turn if b in other) != bucket:
                    continue
                waiting.append((x, y))
                if len(waiting) == 512:
                    align()
            if waiting:
                align()
            if not found:
                return None
            return pa.RecordBatch.from_arrays([pa.array(side, pa.binary()) for side in zip(*found, strict=True)], names=["a", "b"])

        for batch in batches:
            columns = (batch.column(c).to_pylist() for c in ("bucket", "i", "j", "block", "tk", "root", "buckets", "tokens"))
            for bucket, i, j, *row in zip(*columns, strict=True):
                if group != (bucket, i, j):
                    if rows and (out := flush()) is not None:
                        yield out
                    group, rows = (bucket, i, j), []
                rows.append(row)
        if rows and (out := flush()) is not None:
            yield out

    return run


def near_links(docs: DataFrame, text_col: str, k: int = 5, similarity: float = 0.8, bands: int = 32, per_sketch: int = 2, block: int = 1024) -> DataFrame:
    """Verified links (a, b) between keys of different texts, enough to connect whatever all candidate links connect."""
    texts = docs.select(text_key(f"`{text_col}`").alias("tk"), F.col(f"`{text_col}`").alias("text"))
    # of most sketches no other text has any: numbers alone go through this part
    drawn = stored(texts.mapInArrow(_sketch(k, bands, per_sketch), "tk binary, sketch long").select(F.xxhash64("tk").alias("h"), "sketch"))
    shared = drawn.groupBy("sketch").agg(F.min("h").alias("lead"), F.max("h").alias("last")).where("lead < last").select("sketch", "lead")
    met = stored(drawn.join(shared, "sketch").select("h", "lead", F.col("sketch").alias("bucket")).distinct())
    needed = met.select("h").distinct()
    tokens = texts.withColumn("h", F.xxhash64("tk")).join(needed, "h").select("tk", "text").mapInArrow(_tokens, "tk binary, tokens binary")
    tokens = stored(tokens.groupBy("tk").agg(F.first("tokens").alias("tokens")))
    # texts whose lengths are two classes or more apart are never within the limit
    length = F.floor(F.log(F.length("tokens") / 4) / F.lit(-math.log(similarity) + 1e-9)).cast("int")
    named = tokens.select(F.xxhash64("tk").alias("h"), "tk", length.alias("class"))
    rows = stored(met.join(named, "h").select("tk", "h", "lead", "bucket", "class"))
    pairs = rows.where("h <> lead").select("tk", "lead").distinct().withColumnRenamed("lead", "h").join(named.withColumnRenamed("tk", "lead"), "h").select("tk", "lead")
    with_a = pairs.join(tokens.withColumnRenamed("tokens", "a"), "tk")
    with_b = with_a.join(tokens.select(F.col("tk").alias("lead"), F.col("tokens").alias("b")), "lead")
    judged = with_b.select("tk", "lead", "a", "b").mapInArrow(_verify(similarity), "tk binary, lead binary, alike boolean")
    led = stored(judged.where("alike").select(F.col("tk").alias("a"), F.col("lead").alias("b")))
    # buckets still in several components: members in blocks, those of the largest component apart; large buckets by length class
    roots = connected_components(led)
    rooted = stored(rows.join(roots.withColumnRenamed("node", "tk"), "tk", "left").select("bucket", "tk", "class", F.coalesce("root", "tk").alias("root")))
    parts = rooted.groupBy("bucket", "root").agg(F.count(F.lit(1)).alias("n")).groupBy("bucket").agg(F.max(F.struct("n", "root")).alias("most"), F.sum("n").alias("n"))
    parts = parts.where("n > most.n").select("bucket", F.col("most.root").alias("largest"), "n")
    by_length = F.when(F.col("n") > block, F.col("class")).otherwise(0).alias("class")
    sided = stored(rooted.join(parts, "bucket").select("bucket", "tk", by_length, "root", (F.col("root") == F.col("largest")).alias("inside")))
    sizes = sided.groupBy("bucket", "inside", "class").agg(F.count(F.lit(1)).alias("n"))
    # a block is (class, inside, chunk) in one number; the pairs of blocks of a bucket that can hold an open pair
    chunks = stored(sizes.withColumn("chunks", F.ceil(F.col("n") / block).cast("int")))
    number = (F.col("class") * 2 + F.col("inside").cast("int")).cast("long") * F.lit(1 << 32)
    every = chunks.select("bucket", "class", "inside", "n", F.explode(F.sequence(F.lit(0), F.col("chunks") - 1)).alias("chunk")).withColumn("block", number + F.col("chunk"))
    near = every.select("bucket", F.explode(F.array(F.col("class") - 1, F.col("class"))).alias("class"), F.col("block").alias("i"), F.col("inside").alias("inside_i"), F.col("class").alias("class_i"))
    near = near.join(every.withColumnRenamed("block", "j"), ["bucket", "class"]).where("not (inside and inside_i) and (class < class_i or i < j or i = j and n > 1)")
    near = stored(near.select("bucket", "i", "j"))
    sides = near.select("bucket", "i", "j", F.col("i").alias("block")).unionByName(near.where("i <> j").select("bucket", "i", "j", F.col("j").alias("block")))
    dealt = sided.join(chunks.select("bucket", "inside", "class", "chunks"), ["bucket", "inside", "class"])
    dealt = stored(dealt.withColumn("block", number + F.pmod(F.xxhash64("tk"), F.col("chunks"))).join(sides, ["bucket", "block"]).select("bucket", "i", "j", "block", "tk", "root"))
    facts = stored(dealt.select("tk", "bucket").distinct().groupBy("tk").agg(F.collect_list("bucket").alias("buckets")).join(tokens, "tk"))
    dealt = dealt.join(facts, "tk").select("bucket", "i", "j", "block", "tk", "root", "buckets", "tokens")
    width = max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    crossed = dealt.repartition(width, "bucket", "i", "j").sortWithinPartitions("bucket", "i", "j").mapInArrow(_judge(similarity), "a binary, b binary")
    return led.unionByName(stored(crossed.distinct()))


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", k: int = 5, similarity: float = 0.8, bands: int = 32, per_sketch: int = 2) -> DataFrame:
    """``docs`` with class_id (smallest id of the class), class_key, class_texts, class_rows and kept added.

    Equal texts are one class whatever their length; different ones link when they
    share a sketch and one is the other after edits of at most ``1 - similarity`` of
    the longer's words, ASCII case aside. With the defaults pairs edited by up to 15 %
    share a sketch in at least nine cases of ten, those edited by 20 % in seven. Texts without a word (null and empty count as the same text)
    link with equal ones only. One row of each class is kept: the first by id, then
    any of the rows that repeat it; a null id loses against any other. As ids may
    be null or repeat, classes are told apart by ``class_key``, the key of the kept
    text. Texts may be of any length. Columns of added names are replaced; no rows
    give no rows.
    """
    docs = docs.drop("class_id", "class_key", "class_texts", "class_rows", "kept")
    keyed = docs.select("*", text_key(f"`{text_col}`").alias("__tk"))
    roots = connected_components(near_links(docs, text_col, k, similarity, bands, per_sketch))
    texts = keyed.groupBy("__tk").agg(F.min(id_col).alias("least"), F.count(F.lit(1)).alias("n"))
    rooted = stored(texts.join(roots.select(F.col("node").alias("__tk"), "root"), "__tk", "left").select("__tk", "least", "n", F.coalesce("root", "__tk").alias("root")))
    classes = rooted.groupBy("root").agg(F.min("least").alias("class_id"), F.count(F.lit(1)).alias("class_texts"), F.sum("n").alias("class_rows"))
    lead = rooted.join(classes, "root").groupBy("root").agg(F.min(F.when(F.expr("least <=> class_id"), F.col("__tk"))).alias("first_text"))
    facts = stored(rooted.join(classes, "root").join(lead, "root").select("__tk", "class_id", F.lower(F.hex("first_text")).alias("class_key"), "class_texts", "class_rows", (F.col("__tk") == F.col("first_text")).alias("leads")))
    return keyed.join(facts, "__tk").withColumn("kept", F.col("leads") & F.expr(f"`{id_col}` <=> class_id")).drop("leads", "__tk")


def keep_one(marked: DataFrame) -> DataFrame:
    """The kept row of each class; of rows that repeat it, one."""
    return marked.where("kept").dropDuplicates(["class_key"])

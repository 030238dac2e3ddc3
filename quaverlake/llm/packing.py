"""Best-fit packing of tokenised documents by bin completion on a length histogram.

Pieces of one length are interchangeable, so the search runs on how many pieces
there are of each length (at most ``capacity`` numbers, however large the corpus),
on the driver. Its answer is a list of fillings with multiplicities; pieces are
then dealt to the fillings by their rank within their length, in parallel.
"""

from __future__ import annotations

import bisect
import sys
import zlib
from array import array
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quaverlake.llm.common import cut

Filling = tuple[tuple[int, int], ...]

_TOKENIZERS: dict[str, "PieceTokenizer"] = {}


class PieceTokenizer:
    """Ids of a byte-level BPE tokenizer file, by the fastest engine that gives the same.

    The file's vocabulary is read as merge ranks for ``tiktoken``; what that engine
    does not know, strings of special tokens inside a text, goes to ``tokenizers``.
    """

    def __init__(self, path: str):
        import tiktoken
        from public_tokenizers import PATTERN
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
        shown = {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in set(plain))}
        ranks = {bytes(shown[c] for c in token): i for token, i in self.tokenizer.get_vocab(with_added_tokens=False).items() if token not in self.special}
        self.engine = tiktoken.Encoding("file", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    @classmethod
    def of(cls, path: str) -> "PieceTokenizer":
        if path not in _TOKENIZERS:
            _TOKENIZERS[path] = cls(path)
        return _TOKENIZERS[path]

    def encode(self, text: str) -> bytes:
        """Little-endian unsigned 32-bit ids."""
        if any(s in text for s in self.special):
            ids = self.tokenizer.encode(text, add_special_tokens=False).ids
        else:
            ids = self.engine.encode_ordinary(text)
        return array("I", ids).tobytes()


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of the pieces of ``n`` ids; only the first may be short."""
    if n <= capacity:
        return [(0, n)]
    head = n % capacity
    return ([(0, head)] if head else []) + [(s, capacity) for s in range(head, n, capacity)]


def _tokenise(path: str, end_id: int, capacity: int, keep_ids: bool):
    tail = int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = PieceTokenizer.of(path)
        for batch in batches:
            ids_in, texts = batch.column(0), batch.column(1)
            for low in range(0, len(texts), 256):
                rows: list[list] = [[] for _ in range(5 + keep_ids)]
                for i, text in enumerate(texts.slice(low, 256).to_pylist(), low):
                    coded = tokenizer.encode(text or "") + tail
                    for k, (start, length) in enumerate(cuts(len(coded) // 4, capacity)):
                        part = coded[4 * start : 4 * (start + length)]
                        for column, value in zip(rows, (i, k, start, length, zlib.crc32(part), part), strict=False):
                            column.append(value)
                columns = [ids_in.take(pa.array(rows[0])), pa.array(rows[1], pa.int32()), *(pa.array(r, pa.int64()) for r in rows[2:5])]
                if keep_ids:
                    columns.append(pa.array([np.frombuffer(p, "<u4").astype(np.int32) for p in rows[5]], pa.list_(pa.int32())))
                yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "crc", "ids"][: len(columns)])

    return run


def best_fit(counts: dict[int, int], capacity: int) -> list[tuple[Filling, int]]:
    """Best-fit decreasing, whole groups of equal bins at a time."""
    room: dict[int, list[tuple[Filling, int]]] = {}
    sizes: list[int] = []

    def put(residual: int, filling: Filling, n: int) -> None:
        if residual not in room:
            room[residual] = []
            bisect.insort(sizes, residual)
        room[residual].append((filling, n))

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            at = bisect.bisect_left(sizes, length)
            if at < len(sizes):
                residual = sizes[at]
                filling, n = room[residual].pop()
                if not room[residual]:
                    del room[residual]
                    sizes.pop(at)
            else:
                residual, filling, n = capacity, (), left
            each = residual // length
            full = min(n, left // each)
            if full:
                put(residual - each * length, (*filling, (length, each)), full)
                left -= full * each
            if full < n:
                if left and left < each:
                    put(residual - left * length, (*filling, (length, left)), 1)
                    left, full = 0, full + 1
                if full < n and filling:
                    put(residual, filling, n - full)
    return [x for group in room.values() for x in group]


def lower_bound(counts: dict[int, int], capacity: int) -> int:
    """The larger of the volume bound and the bounds that set small pieces aside."""
    total = sum(k * n for k, n in counts.items())
    best = -(-total // capacity)
    lengths = sorted(counts)
    for edge in [0, *(k for k in lengths if 2 * k <= capacity)]:
        big = sum(counts[k] for k in lengths if k > capacity - edge)
        mid = [k for k in lengths if capacity < 2 * k <= 2 * (capacity - edge)]
        n_mid = sum(counts[k] for k in mid)
        free = n_mid * capacity - sum(k * counts[k] for k in mid)
        small = sum(k * counts[k] for k in lengths if edge <= k and 2 * k <= capacity)
        best = max(best, big + n_mid + max(0, -(-(small - free) // capacity)))
    return best


def _dominated(used: Counter, left: int, have: dict[int, int], lengths: list[int]) -> bool:
    """Whether an unused piece could stand in for some of the chosen, leaving no more room: those are then best kept."""
    single, several = 0, 0  # bit s: a sum of one piece, of two or more
    for k, n in used.items():
        for _ in range(n):
            several |= (several | single) << k
            single |= 1 << k
    window = (1 << (left + 1)) - 1
    for k in lengths:
        if used[k] < have[k]:
            # subsets whose sum is k at most and k - left at least
            low = max(0, k - left)
            reach = (1 << (k - low + 1)) - 1 & window
            if several >> low & reach or single >> low & reach & ~(1 << (k - low)):
                return True
    return False


def _completions(lengths: list[int], have: dict[int, int], room: int, limit: int) -> tuple[list[Filling], bool]:
    """Undominated fillings of ``room``, fullest first, and whether these are all (``limit`` bounds the search)."""
    found: list[tuple[int, Filling]] = []
    visits = 0

    def grow(i: int, left: int, used: Counter) -> None:
        nonlocal visits
        visits += 1
        if len(found) >= limit or visits > 50 * limit:
            return
        fits = False
        for j in range(i, len(lengths)):
            k = lengths[j]
            if k <= left and used[k] < have[k]:
                fits = True
                used[k] += 1
                grow(j, left - k, used)
                used[k] -= 1
        if not fits and not any(k <= left and used[k] < have[k] for k in lengths) and not _dominated(used, left, have, lengths):
            found.append((left, tuple(sorted(((k, n) for k, n in used.items() if n), reverse=True))))

    grow(0, room, Counter())
    return [f for _, f in sorted(set(found))], len(found) < limit and visits <= 50 * limit


def complete(counts: dict[int, int], capacity: int, nodes: int = 2000, width: int = 12) -> list[tuple[Filling, int]]:
    """Bin completion: branch on the fillings around the largest piece, best-fit as incumbent.

    A branch takes a filling any number of times, most first, and is left when its waste
    exceeds what a better solution may waste. The search ends at the lower bound, when
    all undominated fillings are tried, or after ``nodes`` branches (the incumbent then
    stands). It starts with at most ``width`` fillings a branch and doubles that while
    branches are left.
    """
    counts = {k: n for k, n in counts.items() if n}
    incumbent = best_fit(counts, capacity)
    used, bound = sum(n for _, n in incumbent), lower_bound(counts, capacity)
    total = sum(k * n for k, n in counts.items())
    left, whole = nodes, True

    def branch(have: dict[int, int], made: list[tuple[Filling, int]], bins: int, waste: int, barred: tuple[int, frozenset]) -> None:
        nonlocal incumbent, used, left, whole
        if used <= bound or left <= 0:
            return
        left -= 1
        rest = best_fit(have, capacity)
        if bins + (n := sum(c for _, c in rest)) < used:
            incumbent, used = [*made, *rest], bins + n
        if not have:
            return
        largest = max(have)
        others = have | {largest: have[largest] - 1}
        lengths = sorted((k for k, n in others.items() if n and k <= capacity - largest), reverse=True)
        fillings, all_ = _completions(lengths, others, capacity - largest, width)
        whole &= all_
        done = barred[1] if barred[0] == largest else frozenset()
        for filling in fillings:
            # bins around one length hold fillings in one order, so that no other order of them is tried
            if filling in done:
                continue
            done |= {filling}
            need = Counter(dict(filling))
            need[largest] += 1
            each = capacity - sum(k * n for k, n in need.items())
            for times in range(min(have[k] // n for k, n in need.items()), 0, -1):
                idle = waste + times * each
                if idle > (used - 1) * capacity - total or used <= bound or left <= 0:
                    continue
                after = {k: n - times * need[k] for k, n in have.items() if n > times * need[k]}
                branch(after, [*made, (tuple(need.items()), times)], bins + times, idle, (largest, done))

    before = sys.getrecursionlimit()
    sys.setrecursionlimit(max(before, 4 * nodes + 8 * capacity))
    try:
        while used > bound and left > 0:
            whole = True
            branch(counts, [], 0, 0, (0, frozenset()))
            if whole:
                break
            width *= 2
    finally:
        sys.setrecursionlimit(before)
    return incumbent


def _deal(fillings: list[tuple[Filling, int]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per length: first rank, first sequence and offset of each of its slots."""
    slots: dict[int, list[tuple[int, int, int]]] = {}
    taken: Counter = Counter()
    base = 0
    for filling, n in fillings:
        offset = 0
        for length, each in filling:
            for _ in range(each):
                slots.setdefault(length, []).append((taken[length], base, offset))
                taken[length] += n
                offset += length
        base += n
    return {k: tuple(np.array(c, dtype=np.int64) for c in zip(*v, strict=True)) for k, v in slots.items()}


def pack_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", capacity: int = 1024, tokenizer_path: str | None = None, end_id: int = 2, keep_ids: bool = False, group: int = 20_000) -> DataFrame:
    """(id, piece, start, length, crc, sequence_id, offset[, ids]) of every piece.

    A null text is empty (its only token is ``end_id``); rows that repeat, also by
    id, are packed each; null ids stay null; texts may be of any length; pieces of one
    length are interchangeable, their ties go by id, piece and checksum; other columns
    are ignored; no rows give no pieces. ``group`` bounds how many pieces of one length are numbered together.
    """
    if tokenizer_path is None:
        import public_tokenizers

        tokenizer_path = public_tokenizers.path("byte_bpe_50k.json")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, piece int, start long, length long, crc long" + ", ids array<int>" * keep_ids
    pieces = cut(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).mapInArrow(_tokenise(tokenizer_path, end_id, capacity, keep_ids), schema))
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count(F.lit(1)).alias("n")).collect()}  # capacity rows at most
    slots = _deal(complete(counts, capacity))
    spread = F.create_map(*(F.lit(x) for k, n in counts.items() for x in (k, -(-n // group)))) if counts else F.lit(None)
    pieces = pieces.withColumn("part", F.pmod(F.xxhash64("id", "piece", "crc"), spread[F.col("length")]) if counts else F.lit(0))
    sizes = pieces.groupBy("length", "part").agg(F.count(F.lit(1)).alias("n"))
    before = sizes.select("length", "part", (F.sum("n").over(Window.partitionBy("length").orderBy("part")) - F.col("n")).alias("before"))
    ranked = pieces.withColumn("rank", F.row_number().over(Window.partitionBy("length", "part").orderBy("id", "piece", "crc")) - 1).join(before, ["length", "part"])
    ranked = ranked.select("id", "piece", "start", "length", "crc", (F.col("rank") + F.col("before")).alias("rank"), *["ids"] * keep_ids)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            length, rank = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            sequence, offset = np.empty(len(length), np.int64), np.empty(len(length), np.int64)
            for k in np.unique(length):
                own = length == k
                first, base, at = slots[int(k)]
                slot = np.searchsorted(first, rank[own], side="right") - 1
                sequence[own], offset[own] = base[slot] + rank[own] - first[slot], at[slot]
            columns = [*batch.columns[:5], pa.array(sequence), pa.array(offset), *batch.columns[6:]]
            yield pa.RecordBatch.from_arrays(columns, names=["id", "piece", "start", "length", "crc", "sequence_id", "offset", "ids"][: len(columns)])

    return ranked.mapInArrow(place, f"id {kind}, piece int, start long, length long, crc long, sequence_id long, offset long" + ", ids array<int>" * keep_ids)

"""Document fingerprints: a Merkle tree over leaves, paragraphs and sections.

Leaves are runs of a few words, cut where a word's hash says so and at line ends;
paragraphs are lines; a section is a run of paragraphs, cut at blank lines and where
a paragraph's hash says so. Cuts depend on content only, so an edit changes the
leaves it touches and the branches above them. Every digest is over its children's:
a paragraph's over the 64-bit hashes of its leaves, a section's over its paragraphs',
the root over its sections'. A fingerprint is written as

    root:section-section-...    section = digest(paragraph,paragraph,...)
                                paragraph = digest.leafleafleaf...

with 32, 16 and 16 hex digits and five characters (30 bits) a leaf. Roots test
equality; likeness and ``differences`` descend only into branches whose digests differ.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quaverlake.llm.common import stored
from quaverlake.llm.wordhash import _BASE, _BYTE, Words, mix, prefix, spans, string_buffers

LEAF_CHARS = 5
_ALPHABET = np.frombuffer(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz_~", dtype=np.uint8)
_LOWEST = -(2**63)


def _digest(parts: bytes, size: int) -> str:
    return hashlib.blake2b(parts, digest_size=size).hexdigest()


@dataclass
class Tree:
    """A text's branches: (section digest, [(paragraph digest, first leaf, end)]), with code and byte range of each leaf."""

    root: str
    sections: list[tuple[str, list[tuple[str, int, int]]]]
    codes: np.ndarray
    begin: np.ndarray
    end: np.ndarray


def fingerprints(texts: list[str], words_per_leaf: int = 4, paragraphs_per_section: int = 4) -> list[tuple[str, Tree]]:
    """Fingerprint and tree of each text."""
    column = pa.array(texts, pa.large_string())
    raw, at = string_buffers(column)
    words = Words(column, lanes=1)
    begin, n = words.begin, len(words.begin)
    # a leaf starts with a text's first word, after a cut word and after a line end
    lines = np.concatenate([[0], np.cumsum(raw == 10)])
    starts = np.zeros(n, dtype=bool)
    line_start, blank_before = np.zeros(n, dtype=bool), np.zeros(n, dtype=bool)
    if n:
        feeds = lines[begin[1:]] - lines[words.end[:-1]]
        line_start[1:], blank_before[1:] = feeds > 0, feeds > 1
        starts[1:] = (words.hashes[0][:-1] % np.uint64(words_per_leaf) == 0) | line_start[1:]
        firsts = words.first[:-1][np.diff(words.first) > 0]
        starts[firsts] = line_start[firsts] = True
        blank_before[firsts] = False
    leaf = np.flatnonzero(starts)
    first_leaf = np.searchsorted(leaf, words.first)
    # a leaf's bytes reach to the next leaf; a text's first also takes what stands before it
    ends = np.append(begin[leaf[1:]], 0) if len(leaf) else leaf
    low = begin[leaf] if len(leaf) else leaf
    filled = first_leaf[:-1] < first_leaf[1:]
    if len(leaf):
        low[first_leaf[:-1][filled]] = at[:-1][filled]
        ends[first_leaf[1:][filled] - 1] = at[1:][filled]
    base = int(_BASE[0, 0])
    hashes = mix(spans(prefix(_BYTE[0][raw[: at[-1]]], base), low, ends, base) + (ends - low).astype(np.uint64)) if len(leaf) else np.zeros(0, np.uint64)
    codes = (hashes >> np.uint64(34)).astype(np.int64)
    shown = _ALPHABET[(codes[:, None] >> (6 * np.arange(LEAF_CHARS))) & 63].tobytes().decode() if len(leaf) else ""
    exact = hashes.tobytes()
    para = np.flatnonzero(line_start[leaf]) if len(leaf) else leaf
    gap = blank_before[leaf[para]] if len(leaf) else leaf
    first_para = np.searchsorted(para, first_leaf)
    para_end = np.append(para[1:], len(leaf))
    out = []
    for i, text in enumerate(texts):
        a, b = int(first_para[i]), int(first_para[i + 1])
        if a == b:  # no word: only white space
            root = _digest(text.encode(), 16)
            out.append((root + ":", Tree(root, [], codes[:0], low[:0], ends[:0])))
            continue
        first, last = int(first_leaf[i]), int(first_leaf[i + 1])
        groups: list[list[tuple[str, int, int]]] = [[]]
        cut = False
        for p in range(a, b):
            x, y = int(para[p]), int(para_end[p]) if p + 1 < b else last
            digest = _digest(exact[8 * x : 8 * y], 8)
            if groups[-1] and (cut or gap[p]):
                groups.append([])
            cut = int(digest, 16) % paragraphs_per_section == 0
            groups[-1].append((digest, x - first, y - first))
        sections = [(_digest("".join(d for d, _, _ in g).encode(), 8), g) for g in groups]
        root = _digest("".join(m for m, _ in sections).encode(), 16)
        leaves = shown[LEAF_CHARS * first : LEAF_CHARS * last]
        body = "-".join(f"{m}({','.join(f'{d}.{leaves[LEAF_CHARS * x : LEAF_CHARS * y]}' for d, x, y in g)})" for m, g in sections)
        out.append((f"{root}:{body}", Tree(root, sections, codes[first:last], low[first:last] - at[i], ends[first:last] - at[i])))
    return out


def sound(fingerprint: str) -> bool:
    """Whether every section's and the root's digest is that of its children."""
    root, sections = tree(fingerprint)
    marks = all(m == _digest("".join(d for d, _ in g).encode(), 8) for m, g in sections)
    return not sections or marks and root == _digest("".join(m for m, _ in sections).encode(), 16)


def tree(fingerprint: str) -> tuple[str, list[tuple[str, list[tuple[str, list[str]]]]]]:
    """(root, [(section digest, [(paragraph digest, leaves)])])."""
    root, _, body = fingerprint.partition(":")
    sections = []
    for part in filter(None, body.split("-")):
        mark, _, inner = part.rstrip(")").partition("(")
        paragraphs = []
        for p in inner.split(","):
            digest, _, leaves = p.partition(".")
            paragraphs.append((digest, [leaves[i : i + LEAF_CHARS] for i in range(0, len(leaves), LEAF_CHARS)]))
        sections.append((mark, paragraphs))
    return root, sections


def _open(a: Tree, b: Tree) -> tuple[list[tuple[int, int]], list[tuple[int, int]], int]:
    """Leaf ranges of both that no equal section or paragraph of the other covers, and how many leaves those cover."""
    covered = 0
    met = Counter(m for m, _ in a.sections) & Counter(m for m, _ in b.sections)
    rest = []
    for side, count in ((a, True), (b, False)):
        left, paragraphs = Counter(met), []
        for mark, group in side.sections:
            if left[mark]:
                left[mark] -= 1
                covered += count * (group[-1][2] - group[0][1])
            else:
                paragraphs += group
        rest.append(paragraphs)
    met = Counter(d for d, _, _ in rest[0]) & Counter(d for d, _, _ in rest[1])
    ranges: list[list[tuple[int, int]]] = [[], []]
    for k in (0, 1):
        left = Counter(met)
        for digest, x, y in rest[k]:
            if left[digest]:
                left[digest] -= 1
                covered += (k == 0) * (y - x)
            else:
                ranges[k].append((x, y))
    return ranges[0], ranges[1], covered


def _of(codes: np.ndarray, ranges: list[tuple[int, int]]) -> np.ndarray:
    return np.concatenate([codes[x:y] for x, y in ranges]) if ranges else codes[:0]


def _compared(a: Tree, b: Tree) -> tuple[float, int | None, int | None]:
    """Likeness, and from which byte of a's text to which its leaves, in order, differ from b's (null if none does)."""
    if a.root == b.root:
        return 1.0, None, None
    left, right, covered = _open(a, b)
    mine, other = _of(a.codes, left), _of(b.codes, right)
    kinds, n = np.unique(mine, return_counts=True)
    others, m = np.unique(other, return_counts=True)
    _, i, j = np.intersect1d(kinds, others, assume_unique=True, return_indices=True)
    total = len(a.codes) + len(b.codes)
    like = 2.0 * (covered + int(np.minimum(n[i], m[j]).sum())) / total if total else 0.0
    # a leaf may stand elsewhere too, so the edit is what lies between the leaves that both begin and end with
    common = min(len(a.codes), len(b.codes))
    low = int(np.argmin(np.append(a.codes[:common] == b.codes[:common], False)))
    common -= low
    high = len(a.codes) - int(np.argmin(np.append(a.codes[len(a.codes) - common :][::-1] == b.codes[len(b.codes) - common :][::-1], False)))
    return (like, int(a.begin[low]), int(a.end[high - 1])) if low < high else (like, None, None)


def _parsed(fingerprint: str) -> Tree:
    root, sections = tree(fingerprint)
    shown, groups = [], []
    for mark, paragraphs in sections:
        groups.append((mark, [(d, len(shown), len(shown := shown + leaves)) for d, leaves in paragraphs]))
    return Tree(root, groups, np.array([hash(x) for x in shown], dtype=np.int64), np.arange(len(shown)), np.arange(1, len(shown) + 1))


def likeness(a: str, b: str) -> float:
    """1 for equal roots, else twice the leaves that both trees hold over all leaves (0 if there are none)."""
    return _compared(_parsed(a), _parsed(b))[0]


def differences(a: str, b: str) -> list[tuple[int, int, int]]:
    """(section, paragraph, leaf) of the leaves of ``a`` that no equal branch of ``b`` covers."""
    one, two = _parsed(a), _parsed(b)
    if one.root == two.root:
        return []
    left, right, _ = _open(one, two)
    other, open_ = set(_of(two.codes, right).tolist()), {x for x, _ in left}
    return [(i, j, k - x) for i, (_, g) in enumerate(one.sections) for j, (_, x, y) in enumerate(g) if x in open_ for k in range(x, y) if int(one.codes[k]) not in other]


def _walk(group: int = 256):
    """Each row with the row after it, in order within its bucket; the last is another bucket's first."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bucket, ids, texts, guest = None, [], [], []

        def flush(close: bool) -> pa.RecordBatch | None:
            """All but the newest row have what follows them."""
            n = len(texts) - 1
            if close:  # rows lent by the next bucket follow, but are its own to report
                n = min(n, guest.index(True) if True in guest else n)
            if n <= 0:
                return None
            edited = []
            for i in range(n):
                m = len(texts[i]) // 4
                edited.append(texts[i][: len(texts[i]) - m] + texts[i + 1][:m])
            own = fingerprints(texts[: n + 1])
            made = fingerprints(edited)
            to_edited = [_compared(x, y) for (_, x), (_, y) in zip(own, made, strict=False)]
            spots = [(None, None) if low is None else (len(t.encode()[:low].decode()), len(t.encode()[:high].decode())) for t, (_, low, high) in zip(texts, to_edited, strict=False)]
            out = pa.RecordBatch.from_arrays(
                [
                    pa.array(ids[:n], id_type),
                    pa.array([len(t) for t in texts[:n]], pa.int64()),
                    pa.array([hashlib.sha256(t.encode()).hexdigest() for t in edited]),
                    pa.array([f for f, _ in own[:n]]),
                    pa.array([f for f, _ in made]),
                    pa.array([x[0] for x in to_edited]),
                    pa.array([_compared(a, b)[0] for (_, a), (_, b) in zip(own, own[1:], strict=False)]),
                    pa.array([x for x, _ in spots], pa.int64()),
                    pa.array([y for _, y in spots], pa.int64()),
                ],
                names=["id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "edit_from", "edit_to"],
            )
            del ids[:n], texts[:n], guest[:n]
            return out

        for batch in batches:
            id_type = batch.schema.field("id").type
            for b, lent, key, text in zip(*(batch.column(c).to_pylist() for c in ("bucket", "lent", "id", "text")), strict=True):
                if b != bucket:
                    if texts and (out := flush(True)) is not None:
                        yield out
                    bucket = b
                    ids.clear(), texts.clear(), guest.clear()
                if lent and True in guest:
                    continue
                ids.append(key), texts.append(text or ""), guest.append(lent)
                if len(texts) > group and (out := flush(False)) is not None:
                    yield out
        if texts and (out := flush(True)) is not None:
            yield out

    return run


def _partitions(docs: DataFrame, size: int = 64 << 20) -> int:
    """As many ranges as the session's shuffle partitions, more where Spark expects them to exceed ``size`` bytes."""
    expected = int(str(docs._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    return max(2, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), expected // size if expected < 1 << 50 else 0)


def fingerprint_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, edit_from, edit_to).

    ``edit_from`` and ``edit_to`` are the code points between which leaves of the text
    are not the edited text's (null if there are none): where its tree locates the edit.
    Rows are ordered by their (integer) id, null ids first, rows of one id by a hash of
    the text, then by text; the row after the last is the first, so a single row follows
    itself. A null text is empty; rows that repeat count each; texts may be of any
    length; other columns are ignored; no rows give no rows. Rows are dealt to ranges of
    this order, so one id may fill several; the first row of a range is lent to the one
    before.
    """
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"id {kind}, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double, edit_from long, edit_to long"
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")).withColumn("key", F.coalesce(F.col("id").cast("long"), F.lit(_LOWEST))).withColumn("tie", F.xxhash64(F.coalesce("text", F.lit(""))))
    spark = docs.sparkSession
    parts = _partitions(docs)
    edges = np.array(rows.agg(F.percentile_approx("key", [i / parts for i in range(1, parts)], 10 * parts).alias("q")).first()["q"] or [], dtype=np.int64)

    @F.pandas_udf("int")
    def bucket_of(key: pd.Series, tie: pd.Series) -> pd.Series:
        first, end = np.searchsorted(edges, key, side="left"), np.searchsorted(edges, key, side="right")
        # an id at several edges fills the ranges between them, by tie
        share = tie.to_numpy().astype(np.float64) / 2.0**64 + 0.5
        inner = np.minimum((share * (end - first)).astype(np.int64), np.maximum(end - first - 1, 0))
        return pd.Series((first + inner).astype(np.int32))

    dealt = rows.withColumn("bucket", bucket_of("key", "tie"))
    firsts = dealt.groupBy("bucket").agg(F.min(F.struct("key", "tie")).alias("f")).select("bucket", "f.key", "f.tie").orderBy("bucket").collect()  # one row a range
    if not firsts:
        return spark.createDataFrame([], schema)
    lender = [(r["key"], r["tie"], firsts[i - 1]["bucket"]) for i, r in enumerate(firsts)]
    # stored, so that Spark knows how small it is
    lent = rows.join(stored(spark.createDataFrame(lender, "key long, tie long, bucket int")), ["key", "tie"])
    # rows of one id and hash may differ still: the least text of them is the first
    lent = lent.groupBy("bucket", "key", "tie").agg(F.min(F.struct(F.coalesce("text", F.lit("")).alias("text"), "id")).alias("r")).select("bucket", "key", "tie", "r.id", "r.text")
    both = dealt.select("bucket", F.lit(False).alias("lent"), "key", "tie", "id", "text").unionByName(lent.select("bucket", F.lit(True).alias("lent"), "key", "tie", "id", "text"))
    ordered = both.repartitionById(parts, "bucket").sortWithinPartitions("bucket", "lent", "key", "tie", F.coalesce("text", F.lit("")))
    return ordered.select("bucket", "lent", "id", "text").mapInArrow(_walk(), schema)

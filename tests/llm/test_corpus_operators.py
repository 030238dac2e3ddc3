"""Each operator against brute force, and on nulls, empties, ties, repeats, empty tables and clashing columns."""

from __future__ import annotations

import hashlib
import zlib

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quaverlake.llm import chat, embedding_dedup, fingerprints, html_text, langid, mixing, order_minhash, packing, substring_dedup, url_filters
from quaverlake.llm.common import connected_components
from quaverlake.llm.queries import URL_RULES

RNG = np.random.default_rng(5)
VOCAB = [f"w{i}" for i in range(400)]


def prose(n: int) -> str:
    return " ".join(RNG.choice(VOCAB, n))


def docs(spark, texts, more=""):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string")


# -- substring dedup


def brute_removal(texts, size):
    words = [(t or "").split() for t in texts]
    starts: dict = {}
    for w in words:
        for s in range(len(w) - size + 1):
            starts[tuple(w[s : s + size])] = starts.get(tuple(w[s : s + size]), 0) + 1
    out = []
    for w in words:
        gone = set()
        for s in range(len(w) - size + 1):
            if starts[tuple(w[s : s + size])] > 1:
                gone |= set(range(s, s + size))
        out.append(" ".join(x for i, x in enumerate(w) if i not in gone))
    return out


def test_substring_dedup(spark):
    shared, other = prose(50), prose(36)
    texts = [None, "", " \n", prose(34), prose(200) + " " + shared, shared + "\n" + prose(40), prose(20) + " " + other, other + " " + prose(3), "a " * 120, prose(80)]
    texts += [texts[4], texts[3], texts[3], prose(15) + " " + shared[: len(shared) // 2] + " " + shared, " ".join([other.split()[0], *other.split()])]
    df = docs(spark, texts).withColumn("n_words", F.lit("clash")).withColumn("row", F.lit(1)).withColumn("tk", F.lit(2))
    got = {r["doc_id"]: r for r in substring_dedup.substring_dedup(df).collect()}
    assert [got[i]["kept_text"] for i in range(len(texts))] == brute_removal(texts, 35)
    for i, t in enumerate(texts):
        assert got[i]["n_words"] == len((t or "").split()) and got[i]["n_removed"] == sum(r["end"] - r["begin"] for r in got[i]["repeats"]) and got[i]["row"] == 1
    assert substring_dedup.substring_dedup(docs(spark, texts).limit(0)).count() == 0


# -- mixing


def test_mixing_meets_quotas(spark):
    rows = [(i, "big" if i < 60 else ("small" if i < 66 else None), prose(10 + i % 7)) for i in range(90)] + [(None, "big", None), (7, "small", "  ")]
    df = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("block", F.lit("clash"))
    out = mixing.mix_sources(df, target_entropy=0.9, bucket_rows=4).collect()
    total = sum(len((t or "").split()) for _, _, t in rows)
    longest = max(len((t or "").split()) for _, _, t in rows)
    weights, drawn = {}, {}
    for r in out:
        if r["tokens"]:
            weights[r["source"]] = r["weight"]
            drawn[r["source"]] = drawn.get(r["source"], 0) + r["tokens"]
    assert sum(weights.values()) == pytest.approx(1)
    p = np.array(list(weights.values()))
    assert -(p * np.log(p)).sum() >= 0.9 * np.log(3) - 1e-6
    for s, w in weights.items():
        assert -1e-6 <= drawn[s] - w * total < longest + 1e-6
    assert sum(r["tokens"] == 0 for r in out) == 2
    blocks: dict = {}
    for r in out:
        blocks.setdefault((r["doc_id"], r["source"], r["text"]), []).append(r["block"])
    assert all(sorted(b) == list(range(len(b))) for b in blocks.values())
    covered = mixing.mix_sources(df, max_repetition=1.5, cover=True).collect()
    assert {r["doc_id"] for r in covered} == {r[0] for r in rows} and max(r["block"] for r in covered) <= 1
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_mixture_against_a_fine_search(spark):
    """The exponent: the largest of a fine grid that reaches the entropy, unless the repetition limit asks for more."""
    tokens = np.array([900_000, 40_000, 30_000, 2_000, 500])
    totals = spark.createDataFrame([(f"s{i}", int(n)) for i, n in enumerate(tokens)], "source string, tokens long")
    p = tokens / tokens.sum()
    grid = np.linspace(0, 1, 200_001)
    powers = p[None, :] ** grid[:, None]
    weights = powers / powers.sum(axis=1, keepdims=True)
    entropy = -(weights * np.log(weights)).sum(axis=1)
    repeats = (weights / p[None, :]).max(axis=1)
    for target, limit in ((0.5, 1e9), (0.9, 1e9), (0.9, 4.0), (0.3, 1.5), (1.0, 1e9)):
        by_entropy = grid[entropy >= target * np.log(5) - 1e-12].max(initial=0)
        want = max(by_entropy, grid[repeats <= limit].min())
        got = mixing.mixture(totals, target, limit, None, False)
        assert got.exponent == pytest.approx(want, abs=2e-5)
        rows = {r["source"]: r["weight"] for r in got.sources.collect()}
        made = p**got.exponent / (p**got.exponent).sum()
        assert [rows[f"s{i}"] for i in range(5)] == pytest.approx(made.tolist())
    with pytest.raises(ValueError, match="repeats"):
        mixing.mixture(totals, 0.9, 4.0, 5.0 * tokens.sum(), False)


# -- embeddings


def test_embedding_links(spark):
    base = RNG.standard_normal((40, 16))
    rows = [(i, v.tolist()) for i, v in enumerate(base)]
    rows += [(100 + i, (base[0] + 0.05 * RNG.standard_normal(16)).tolist()) for i in range(30)]
    rows += [(200, base[3].tolist()), (201, base[3].tolist()), (202, (base[3] * 7).tolist()), (203, None), (204, [0.0] * 16), (205, [float("nan")] * 16), (206, [1.0, None]), (207, []), (208, base[3][:8].tolist()), (None, base[3].tolist())]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("id", F.lit("clash"))
    got = embedding_dedup.embedding_links(df, window=8, block=8).collect()
    assert len(got) == len(rows)
    good = [(i, np.array(v)) for i, v in rows if v and len(v) == 16 and None not in v and np.isfinite(v).all() and any(v)]
    x = np.stack([v / np.linalg.norm(v) for _, v in good])
    near = x @ x.T >= 0.95
    want = {i: int(n) - 1 for (i, _), n in zip(good, near.sum(axis=1), strict=True)}
    for r in got:
        assert r["n_links"] == want.get(r["id"], 0)
    by = {r["id"]: r for r in got}
    assert by[202]["component_id"] == 3 and not by[202]["kept"] and by[3]["kept"] and by[204]["kept"] and by[115]["component_id"] == 0
    assert embedding_dedup.embedding_links(df.limit(0)).count() == 0


def test_embedding_links_in_a_crowd(spark):
    """Lone pairs among vectors that all lie close to one centre, against brute force."""
    rng = np.random.default_rng(8)
    rest = rng.standard_normal((17_000, 63))
    rest[16_500:] = rest[:500] * 0.6 / np.linalg.norm(rest[:500], axis=1, keepdims=True) + 0.8 * rest[16_500:] / np.linalg.norm(rest[16_500:], axis=1, keepdims=True)
    x = np.concatenate([np.full((len(rest), 1), 0.9**0.5), 0.1**0.5 * rest / np.linalg.norm(rest, axis=1, keepdims=True)], axis=1)
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    want = np.concatenate([(x[at : at + 1000] @ x.T >= 0.95).sum(axis=1) - 1 for at in range(0, len(x), 1000)])
    table = pa.table({"vec_id": np.arange(len(x)), "embedding": pa.array(list(x))})
    got = embedding_dedup.embedding_links(spark.createDataFrame(table)).select("id", "n_links").toArrow().sort_by("id")
    assert want.sum() > 500 and (got["n_links"].to_numpy() == want).all()


def test_components(spark):
    chain = [(i, i + 1) for i in range(60)] + [(100, 101), (101, 100), (102, 102), (100, 105)]
    got = {r["node"]: r["root"] for r in connected_components(spark.createDataFrame(chain, "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in (100, 101, 105)}}


# -- fingerprints


def test_fingerprints(spark):
    texts = [prose(300), "", None, "one", prose(40).replace(" ", "\n", 5), "  \n ", prose(2000), prose(9)]
    rows = [(i * 3, t) for i, t in enumerate(texts)] + [(None, "null id"), (9, "one")]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("key", F.lit(1)).repartition(3)
    got = fingerprints.fingerprint_documents(df).collect()
    ordered = sorted(((-1 if i is None else i, t or "") for i, t in rows))
    want = []
    for k, (_, t) in enumerate(ordered):
        nxt, m = ordered[(k + 1) % len(ordered)][1], len(t) // 4
        want.append((len(t), hashlib.sha256((t[: len(t) - m] + nxt[:m]).encode()).hexdigest()))
    assert sorted((r["n_chars"], r["edited_sha256"]) for r in got) == sorted(want)
    by = {r["id"]: r for r in got}
    assert by[0]["near_edited"] > 0.6 > 0.2 > by[0]["near_next"] and by[0]["near_edited"] == fingerprints.likeness(by[0]["fingerprint"], by[0]["edited_fingerprint"])
    nines = [r for r in got if r["id"] == 9]
    assert len(nines) == 2 and nines[0]["fingerprint"] == nines[1]["fingerprint"] and {r["near_next"] for r in nines} & {1.0}
    single = fingerprints.fingerprint_documents(docs(spark, [texts[0]])).collect()
    assert len(single) == 1 and single[0]["near_next"] == 1.0
    assert fingerprints.fingerprint_documents(df.limit(0)).count() == 0


def brute_likeness(a, b):
    """Leaves paired off under equal sections, then equal paragraphs, then one by one."""
    (x, left), (y, right) = fingerprints.tree(a), fingerprints.tree(b)
    if x == y:
        return 1.0
    total, same = sum(len(p) for side in (left, right) for _, s in side for _, p in s), 0
    for mark, s in list(left):
        if found := next((r for r in right if r[0] == mark), None):
            left.remove((mark, s)), right.remove(found)
            same += sum(len(p) for _, p in s)
    left, right = [p for _, s in left for p in s], [p for _, s in right for p in s]
    for p in list(left):
        if found := next((q for q in right if q[0] == p[0]), None):
            left.remove(p), right.remove(found)
            same += len(p[1])
    left, right = [x for _, p in left for x in p], [x for _, p in right for x in p]
    for x in left:
        if x in right:
            right.remove(x)
            same += 1
    return 2 * same / total if total else 0.0


def test_merkle_tree_against_brute_force():
    lines = [prose(int(n)) for n in np.random.default_rng(3).integers(1, 30, 60)]
    texts = ["\n".join(lines[i : i + 25] + lines[:3]) for i in range(0, 40, 5)] + ["", " \n", "one", "one two\n\none two"]
    prints = [f for f, _ in fingerprints.fingerprints(texts)]
    for text, f in zip(texts, prints, strict=True):
        root, sections = fingerprints.tree(f)
        marks = []
        for mark, paragraphs in sections:
            assert mark == hashlib.blake2b("".join(d for d, _ in paragraphs).encode(), digest_size=8).hexdigest()
            marks.append(mark)
        assert root == hashlib.blake2b("".join(marks).encode() or text.encode(), digest_size=16).hexdigest()
        assert sum(len(s) for _, s in sections) == sum(bool(line.split()) for line in text.split("\n"))
        if sections:
            digest = sections[-1][1][0][0]
            assert fingerprints.sound(f) and not fingerprints.sound(f.replace(digest, "0" * 16))
    for a in prints:
        for b in prints:
            assert abs(fingerprints.likeness(a, b) - brute_likeness(a, b)) < 1e-12


def test_fingerprints_of_hot_and_null_ids(spark):
    """A third of the rows share an id and a third have none; whatever the ranges, every row follows one other."""
    rows = [(None if i % 3 == 0 else 7 if i % 3 == 1 else i, prose(12)) for i in range(600)]
    got = fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id").collect()
    assert len(got) == 600 and sorted(r["n_chars"] for r in got) == sorted(len(t) for _, t in rows)
    assert len({r["fingerprint"] for r in got}) == len({t for _, t in rows})


def test_edit_is_located(spark):
    rows = [(i, prose(200)) for i in range(20)]
    for r in fingerprints.fingerprint_documents(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        at = r["n_chars"] - r["n_chars"] // 4
        assert r["edit_from"] <= at + 1 < r["edit_to"] <= r["n_chars"] and at - r["edit_from"] < 300


def test_edit_of_a_repeated_line_is_located():
    """A changed line is located where it is, also if it stands elsewhere too; within one line, by its leaves."""
    lines = ["one two", "red", "three", "red", "four", "red", "five"]
    text = "".join(x + "\n" for x in lines)
    for i, line in enumerate(lines):
        edited = "".join(("blue" if k == i else x) + "\n" for k, x in enumerate(lines))
        (_, a), (_, b) = fingerprints.fingerprints([text, edited])
        begin = len("".join(x + "\n" for x in lines[:i]))
        assert fingerprints._compared(a, b)[1:] == (begin, begin + len(line) + 1)
    rng = np.random.default_rng(2)
    words = [f"v{i}" for i in rng.integers(0, 12, 300)]
    for i in range(0, 300, 7):
        text, edited = " ".join(words), " ".join([*words[:i], "other", *words[i + 1 :]])
        (_, a), (_, b) = fingerprints.fingerprints([text, edited])
        _, low, high = fingerprints._compared(a, b)
        assert low <= len(" ".join([*words[:i], ""])) < high
    (_, a), (_, b) = fingerprints.fingerprints(["red\n", "red\nblue\n"])
    assert fingerprints._compared(a, b)[1:] == (None, None)


def test_tree_locates_edits():
    lines = [prose(20) for _ in range(12)]
    changed = [*lines[:5], lines[5] + " more", *lines[6:]]
    (a, _), (b, _), (c, _) = fingerprints.fingerprints(["\n".join(lines), "\n".join(changed), "\n".join(lines)])
    assert a == c and fingerprints.differences(a, c) == []
    where = fingerprints.differences(b, a)
    sections = fingerprints.tree(b)[1]
    flat = [(i, j) for i, (_, s) in enumerate(sections) for j in range(len(s))]
    assert where and {flat.index((i, j)) for i, j, _ in where} == {5}


# -- url filters


def test_url_rules_and_graph(spark):
    link = lambda *hosts: "".join(f'<a class="x" href="https://{h}/p">y</a>' for h in hosts)
    rows = [
        (1, "HTTPS://WWW.Example.ORG/es/x?q#f", link("spam.net")),
        (2, "http://a.example.org/en/12", None),
        (3, "http://example.org", ""),
        (4, "http://shop.com/de/1", link("friend.net")),
        (5, "http://shop.com/de/2", None),
        (6, "http://friend.net/x", link("shop.com") * 3),
        (7, "http://news.org/a", link("good.net")),
        (8, "http://good.net/a", None),
        (9, None, link("x.com")),
        (10, "no scheme", None),
        (11, "http://forg/", None),
        (11, "http://forg/", None),
    ]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").withColumn("host", F.lit("clash"))
    got = {r["id"]: r for r in url_filters.judge_urls(df, URL_RULES).collect()}
    assert {k: (r["host"], r["path"], r["rule"], r["verdict"]) for k, r in got.items() if k < 5} == {
        1: ("www.example.org", "/es/x", "example.org/es/", "block"),
        2: ("a.example.org", "/en/12", "example.org/en/1", "block"),
        3: ("example.org", "", None, "allow"),
        4: ("shop.com", "/de/1", "com/de/", "block"),
    }
    assert got[6]["verdict"] == "block" and got[6]["distrust"] > got[6]["trust"] and got[8]["verdict"] == "allow" and got[8]["trust"] > 0
    assert (got[9]["host"], got[9]["path"], got[9]["verdict"], got[10]["host"], got[11]["rule"]) == ("", "", "allow", "", None)
    assert url_filters.judge_urls(df.limit(0), URL_RULES).count() == 0


def test_scores_against_dense_pagerank(spark):
    """Trust along and distrust against host links, solved as linear equations."""
    rng = np.random.default_rng(2)
    hosts = [f"h{i}.{'com' if i % 3 else 'org'}" for i in range(24)]
    n = np.zeros((24, 24))
    rows = []
    for page in range(160):
        src, targets = int(rng.integers(24)), rng.integers(24, size=4)
        path = ("/fr/", "/de/", "/x/")[page % 3]
        rows.append((page, f"http://{hosts[src]}{path}{page}", "".join(f"<a data-href='//no.where' href='http://{hosts[t]}/'>" for t in targets)))
        for t in targets:
            n[src, t] += t != src
    got = url_filters.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES).collect()
    net = {h: [] for h in hosts}
    for r in got:
        if r["rule"]:
            net[r["host"]].append(1.0 if r["verdict"] == "allow" else -1.0)
    net = np.array([np.mean(net[h]) if net[h] else 0.0 for h in hosts])

    def solved(links, seeds):
        share = links / np.maximum(links.sum(axis=1, keepdims=True), 1)
        return np.linalg.solve(np.eye(24) - 0.85 * share.T, 0.15 * seeds / seeds.sum())

    trust, distrust = solved(n, np.maximum(net, 0)), solved(n.T, np.maximum(-net, 0))
    for r in got:
        i = hosts.index(r["host"])
        assert abs(r["trust"] - trust[i]) < 1e-5 and abs(r["distrust"] - distrust[i]) < 1e-5
        if not r["rule"]:
            known = ((trust > 0) | (distrust > 0)).sum()
            assert r["verdict"] == ("block" if distrust[i] - trust[i] > 0.5 / known else "allow")


def test_unsettled_scores_are_an_error(spark):
    rows = [(1, "http://a.com/fr/", "<a href='http://b.com/'>"), (2, "http://b.com/", "<a href='http://a.com/'>")]
    with pytest.raises(RuntimeError, match="moved"):
        url_filters.judge_urls(spark.createDataFrame(rows, "page_id long, url string, html string"), URL_RULES, rounds=3)


# -- chat


def test_chat_collapse(spark):
    turns = [("user", "a"), ("assistant", "b"), ("user", None), (None, "d")]
    rows = [(1, i, *t) for i, t in enumerate(turns[:2])] + [(2, i, *t) for i, t in enumerate(turns)] + [(3, i, *t) for i, t in enumerate(turns)]
    rows += [(4, 0, "user", "a"), (4, 1, "assistant", "other"), (5, 0, "user", ""), (6, 0, "user", None), (7, None, "user", "a"), (4, 1, "assistant", "other"), (None, 0, "system", "x")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("id", F.lit("clash"))
    got = {r["id"]: r for r in chat.format_conversations(df).collect()}
    assert sorted(got, key=str) == sorted([2, 4, 5, 6, None], key=str)
    assert got[2]["n_turns"] == 4 and got[2]["n_collapsed"] == 1 and got[4]["n_turns"] == 2
    assert got[2]["rendered"] == "<|im_start|>user\na<|im_end|>\n<|im_start|>assistant\nb<|im_end|>\n<|im_start|>user\n<|im_end|>\n<|im_start|>unknown\nd<|im_end|>\n"
    assert chat.format_conversations(df.limit(0)).count() == 0


# -- html


@pytest.mark.parametrize(
    ("html", "text"),
    [
        ("", ""),
        ("plain &amp; simple", "plain & simple"),
        ("<p>one<p>two<br>three", "one\n\ntwo\nthree"),
        ("<title>t</title><script>var a='</p>';</script><style>p{}</style><div>x</div>y", "x\ny"),
        ("<ul><li>a<li>b<ul><li>c</ul></ul><ol start=3><li>d<li>e</ol>", "- a\n- b\n  - c\n\n3. d\n4. e"),
        ("<table><tr><th>Name<th>N<tr><td>Ann<td>1<tr><td>Bartholomew<td>22</table>", "Name         N\nAnn          1\nBartholomew  22"),
        ("<table><tr><td rowspan=2>a<td>b<tr><td>c</table>", "a  b\n   c"),
        ("<pre>a\n  b</pre>", "a\n  b"),
        ("<p hidden>no</p><p style='display: none'>no</p><span>yes</span>", "yes"),
        ("<b>bo<i>th</b>x</i> y</p>z", "bothx y\n\nz"),
        ("<!-- a --><!DOCTYPE html>t<![CDATA[x]]>", "t"),
        ("a<", "a<"),
        ("<div>" * 3000 + "deep", "deep"),
    ],
)
def test_render(html, text):
    assert html_text.render(html) == text


def test_extract(spark):
    df = spark.createDataFrame([(1, "<p>a"), (2, None), (2, None), (3, "")], "page_id long, html string").withColumn("visible_text", F.lit(5)).withColumn("row", F.lit(1))
    got = sorted((r["page_id"], r["visible_text"], r["row"]) for r in html_text.extract_text(df).na.fill("∅").collect())
    assert got == [(1, "a", 1), (2, "∅", 1), (2, "∅", 1), (3, "", 1)]
    assert html_text.extract_text(df.limit(0)).count() == 0


# -- language


def test_language_id(spark, data):
    df = spark.read.parquet(f"{data}/documents.parquet").select("doc_id", "text", "lang")
    held = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    model = langid.train(df.where(~held))
    assert model.languages == ["de", "en", "es", "fr"]
    out = langid.predict(df.where(held), model).collect()
    assert np.mean([r["lang"] == r["lang_pred"] for r in out]) >= 0.95 and all(0 <= r["score"] <= 1 for r in out)
    odd = spark.createDataFrame([(None, None), (1, ""), (1, "12 !?"), (2, "é"), (3, "the of and " * 5000)], "doc_id long, text string").withColumn("score", F.lit("clash")).withColumn("row", F.lit(0))
    got = {(r["doc_id"], (r["text"] or "")[:5]): r for r in langid.predict(odd, model).collect()}
    assert [got[k]["lang_pred"] for k in ((None, ""), (1, ""), (1, "12 !?"))] == ["und"] * 3 and got[(3, "the o")]["lang_pred"] == "en"
    assert langid.predict(odd.limit(0), model).count() == 0
    assert langid.train(df.limit(0)).languages == [] and langid.predict(odd, langid.train(df.limit(0))).first()["lang_pred"] == "und"


# -- order MinHash


def brute_edits(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        prev, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            prev, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, prev + (x != y))
    return row[-1]


def test_banded_alignment():
    for _ in range(300):
        a = RNG.integers(0, 30, RNG.integers(0, 90)).astype(np.uint32)
        b = a.copy()
        for _ in range(RNG.integers(0, 40)):
            at = RNG.integers(0, len(b) + 1)
            b = np.concatenate([b[:at], RNG.integers(0, 30, RNG.integers(0, 2)).astype(np.uint32), b[at + RNG.integers(0, 2) :]])
        limit = int(RNG.integers(0, 50))
        d = brute_edits(a.tolist(), b.tolist())
        assert order_minhash.edits_within(a, b, limit) == (d if d <= limit else limit + 1)


def test_near_duplicates(spark):
    def edited(t, n):
        w = t.split()
        for i in RNG.choice(len(w), n, replace=False):
            w[i] = f"e{RNG.integers(1000)}"
        return " ".join(w)

    a, b = prose(120), prose(60)
    texts = [a, edited(a, 2), a.upper(), a, edited(a, 3), b, edited(b, 1), prose(100), prose(100), None, "", "  ", "two words", "two words", "two word", prose(4)]
    df = docs(spark, texts).withColumn("kept", F.lit("clash")).withColumn("tk", F.lit(1))
    marked = order_minhash.near_duplicates(df)
    got = {r["doc_id"]: r for r in marked.collect()}
    assert [got[i]["class_id"] for i in range(len(texts))] == [0, 0, 0, 0, 0, 5, 5, 7, 8, 9, 9, 11, 12, 12, 14, 15]
    assert got[0]["class_rows"] == 5 and got[0]["class_texts"] == 4 and [i for i in got if got[i]["kept"]] == sorted({r["class_id"] for r in got.values()})
    assert order_minhash.near_duplicates(df.limit(0)).count() == 0
    twice = order_minhash.near_duplicates(docs(spark, ["x y"]).union(docs(spark, ["x y"])).union(spark.createDataFrame([(None, "z")], "doc_id long, text string")))
    assert sorted((r["doc_id"] is None, r["doc_id"]) for r in order_minhash.keep_one(twice).collect()) == [(False, 0), (True, None)]


def test_keep_one_keeps_unlike_texts_of_one_id(spark):
    a, b, c, d = (prose(40) for _ in range(4))
    rows = [(None, a), (None, b), (None, b), (3, c), (3, d), (3, d), (4, None), (4, ""), (None, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = order_minhash.keep_one(order_minhash.near_duplicates(df)).collect()
    assert sorted((r["doc_id"] or 0, r["text"] or "") for r in got) == sorted([(0, a), (0, b), (3, c), (3, d), (4, "")])


def classes(spark, texts, **more):
    got = {r["doc_id"]: r["class_id"] for r in order_minhash.near_duplicates(docs(spark, texts), **more).collect()}
    return [got[i] for i in range(len(texts))]


def brute_classes(texts, k=5, bands=32, per_sketch=2):
    """Every pair that shares a sketch, judged one by one."""
    words = [[w.lower() for w in t.split()] for t in texts]
    text, band, sketch = order_minhash.sketches(pa.array(texts), k, bands, per_sketch)
    drawn: dict = {}
    for at in zip(text.tolist(), band.tolist(), sketch.tolist(), strict=True):
        drawn.setdefault(at[0], set()).add(at[1:])
    label = list(range(len(texts)))
    for i in range(len(texts)):
        for j in range(i):
            longest = max(len(words[i]), len(words[j]))
            if label[i] != label[j] and drawn[i] & drawn[j] and brute_edits(words[i], words[j]) <= int(longest * 0.2 + 1e-9):
                label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
    return label


def edited(rng, words, share, name):
    """A copy with ``share`` of the words replaced, left out or followed by a new one."""
    out = list(words)
    for n, i in enumerate(rng.choice(len(words), int(len(words) * share), replace=False)):
        out[i] = ([f"{name}n{n}"], [], [words[i], f"{name}n{n}"])[rng.integers(3)]
    return [w for part in out for w in (part if isinstance(part, list) else [part])]


def test_recall_over_all_pairs_within_the_limit(spark):
    """Classes against the whole definition, sketches aside: pairs edited by 5, 10, 15 and 19 of 100 words."""
    rng, texts, want = np.random.default_rng(6), [], []
    for share, least in ((0.05, 99), (0.1, 97), (0.15, 88), (0.19, 60)):
        want.append(least)
        for pair in range(100):
            words = [f"s{share}p{pair}x{i}" for i in range(int(rng.integers(30, 500)))]
            copy = edited(rng, words, share, f"s{share}p{pair}")
            assert brute_edits(words, copy) <= int(0.2 * max(len(words), len(copy)) + 1e-9)
            texts += [" ".join(words), " ".join(copy)]
    got = classes(spark, texts)
    found = np.array([got[i] == got[i + 1] for i in range(0, len(texts), 2)]).reshape(4, 100).sum(axis=1)
    assert (found >= want).all(), found
    assert len(set(got)) == len(texts) - found.sum()


def test_classes_of_null_ids_are_told_apart(spark):
    a, b = prose(40), prose(40)
    df = spark.createDataFrame([(None, a), (None, b), (5, prose(30)), (5, prose(50))], "doc_id long, text string")
    got = order_minhash.near_duplicates(df.withColumn("class_key", F.lit("clash"))).collect()
    assert len({r["class_key"] for r in got}) == 4 and all(r["kept"] for r in got)


def test_drifting_versions_stay_one_class(spark):
    rng, texts = np.random.default_rng(9), []
    for family in range(300):
        words = [f"f{family}x{i}" for i in range(266)]
        texts += [" ".join(words[:n]) for n in (200, 231, 266)]
    for n in (9, 30):
        words = [f"g{n}x{i}" for i in range(2000)]
        texts += [" ".join(words[: int(60 * 1.09**i)]) for i in range(n)]
    texts = [texts[i] for i in rng.permutation(len(texts))]
    assert classes(spark, texts) == brute_classes(texts)


def test_one_shared_sketch_makes_a_candidate(spark):
    rng, passage, texts = np.random.default_rng(4), " ".join(f"p{i}" for i in range(60)), []
    for pair in range(40):
        own = [f"o{pair}x{i}" for i in range(60)]
        other = [f"e{pair}x{i}" if i % 5 == 2 else w for i, w in enumerate(own)]
        texts += [f"{passage} {' '.join(own)}", f"{passage} {' '.join(other)}"]
    texts = [texts[i] for i in rng.permutation(len(texts))]
    assert classes(spark, texts) == brute_classes(texts)


def test_pipeline_dedup_stages_against_brute_force(spark, data):
    """Exact, near and drifting copies, a shared passage and null ids through the two dedup stages."""
    import corpus_pipeline as P

    rng = np.random.default_rng(12)
    make = lambda name, n: [f"{name}x{i}" for i in range(n)]
    passage, texts = make("p", 45), []
    for f in range(8):
        own = make(f"d{f}", 160)
        texts += [own[:n] for n in (120, 138, 160)]
        near = make(f"n{f}", 90)
        texts += [near, near, [*near[:40], "edit", *near[41:]]]
        texts += [make(f"s{f}", 80) + passage + make(f"t{f}", 20)]
    texts = [" ".join(t) for t in texts]
    ids = [None if i % 5 == 0 else i for i in range(len(texts))]
    order = rng.permutation(len(texts))
    rows = [(ids[i], texts[i], "en", "web", len(texts[i])) for i in order]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    label = brute_classes(texts)
    kept = [r["text"] for r in P.minhash_near_dedup(spark, df, data).collect()]
    of = {t: label[texts.index(t)] for t in texts}
    assert sorted(of[t] for t in kept) == sorted({of[t] for t in texts})
    stage = spark.createDataFrame([(i, t, "en", "web", len(t)) for i, t in enumerate(kept)], df.schema)
    cut = {r["doc_id"]: r["text"] for r in P.substring_dedup_stage(spark, stage, data).collect()}
    want = {i: t for i, t in enumerate(brute_removal(kept, 35)) if t}
    assert cut == want and any(want[i] != kept[i] for i in want)


def test_hopeful_keeps_every_near_pair():
    rng = np.random.default_rng(3)
    made = [rng.integers(0, 25, n).astype(np.uint32) for n in (0, 1, 2, 12, 40, 90)]
    for a in list(made):
        for _ in range(12):
            b = a.copy()
            for _ in range(rng.integers(0, 1 + len(a) // 3)):
                at = rng.integers(0, len(b) + 1)
                b = np.concatenate([b[:at], rng.integers(0, 25, rng.integers(0, 2)).astype(np.uint32), b[at + rng.integers(0, 2) :]])
            made.append(b.astype(np.uint32))
    near = lambda a, b: brute_edits(a.tolist(), b.tolist()) <= int(max(len(a), len(b)) * 0.2 + 1e-9)
    for chunk in (4, 128):
        kept = {(min(p), max(p)) for p in order_minhash.hopeful(made, None, 0.8, chunk)}
        assert kept >= {(i, j) for j in range(len(made)) for i in range(j) if near(made[i], made[j])}
        across = set(order_minhash.hopeful(made[:30], made[30:], 0.8, chunk))
        assert across >= {(i, j - 30) for i in range(30) for j in range(30, len(made)) if near(made[i], made[j])}


def test_pairs_aligned_together():
    """Near and far pairs of all sizes, few and many words, against the table of edit distances."""
    rng, pairs = np.random.default_rng(8), []
    for _ in range(600):
        a = rng.integers(0, rng.choice([2, 6, 60]), int(rng.integers(0, 70)))
        b = a.tolist()
        for _ in range(int(rng.integers(0, 16))):
            at, kind = int(rng.integers(0, len(b) + 1)), rng.integers(3)
            b[at : at + (kind > 0)] = [int(rng.integers(0, 60))] * int(kind < 2)
        pairs.append((a.astype(np.uint32), np.array(b if rng.random() < 0.8 else rng.integers(0, 3, 40), dtype=np.uint32)))
    for similarity in (0.8, 0.5, 0.0):
        want = [brute_edits(a.tolist(), b.tolist()) <= int(max(len(a), len(b)) * (1 - similarity) + 1e-9) for a, b in pairs]
        assert order_minhash.alike(pairs, similarity).tolist() == want
    assert order_minhash.alike([], 0.8).tolist() == []


def test_judging_is_spread_over_the_shared_buckets(monkeypatch):
    """Texts that meet in eight buckets: every pair is aligned once, and no bucket has a third of the pairs."""
    rng, passage, rows, judged = np.random.default_rng(3), np.arange(100, dtype=np.uint32), [], {}
    buckets = [int(b) for b in rng.integers(-(2**62), 2**62, 8)]
    for i in range(60):
        tokens = np.concatenate([np.arange(1000 * i + 1000, 1000 * i + 1026, dtype=np.uint32), passage])
        rows.append((rng.bytes(16), tokens.tobytes()))
    rows.append((rng.bytes(16), np.append(np.frombuffer(rows[0][1], np.uint32), np.uint32(7)).tobytes()))
    aligned = order_minhash.alike

    def counted(pairs, similarity):
        judged.setdefault(bucket, []).extend((a.tobytes(), b.tobytes()) for a, b in pairs)
        return aligned(pairs, similarity)

    monkeypatch.setattr(order_minhash, "alike", counted)
    links = []
    for bucket in buckets:
        columns = {"bucket": [bucket] * 61} | {c: [0] * 61 for c in ("i", "j", "block")}
        columns |= {"tk": [k for k, _ in rows], "root": [k for k, _ in rows], "buckets": [buckets] * 61, "tokens": [t for _, t in rows]}
        for out in order_minhash._judge(0.8)(iter([pa.RecordBatch.from_pydict(columns)])):
            links += [frozenset(x.values()) for x in out.to_pylist()]
    assert links == [frozenset((rows[0][0], rows[60][0]))]
    assert sorted(map(sorted, sum(judged.values(), []))) == sorted(sorted((rows[i][1], rows[j][1])) for i in range(61) for j in range(i))
    assert len(judged) == 8 and max(map(len, judged.values())) < 61 * 60 / 2 / 3


# -- packing


def test_packing(spark):
    import public_tokenizers
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    texts = [prose(int(n)) for n in RNG.integers(1, 700, 60)] + [None, "", "", "a  b\n\n c", "<|endoftext|> x", " lead", "don't  stop ", "日本語 text"]
    df = docs(spark, texts).withColumn("length", F.lit("clash"))
    rows = packing.pack_documents(df, keep_ids=True, group=7).collect()
    used: dict = {}
    for r in rows:
        used.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
        ids = np.array(r["ids"]).astype("<u4")
        assert len(ids) == r["length"] <= 1024 and zlib.crc32(ids.tobytes()) == r["crc"]
    for spans in used.values():
        spans.sort()
        assert [o for o, _ in spans] == np.concatenate([[0], np.cumsum([n for _, n in spans])[:-1]]).tolist() and sum(n for _, n in spans) <= 1024
    for i, t in enumerate(texts):
        own = sorted((r for r in rows if r["id"] == i), key=lambda r: r["piece"])
        assert sum((r["ids"] for r in own), []) == tokenizer.encode(t or "", add_special_tokens=False).ids + [2]
        assert all(r["length"] == 1024 for r in own[1:]) and [r["start"] for r in own] == np.concatenate([[0], np.cumsum([r["length"] for r in own])[:-1]]).tolist()
    total = sum(r["length"] for r in rows)
    assert len(used) <= -(-total // 1024) + 1
    assert packing.pack_documents(df.limit(0)).count() == 0


def exact_bins(items, capacity):
    best = [len(items)]

    def place(i, bins):
        if len(bins) >= best[0]:
            return
        if i == len(items):
            best[0] = len(bins)
            return
        for k in range(len(bins)):
            if bins[k] + items[i] <= capacity:
                bins[k] += items[i]
                place(i + 1, bins)
                bins[k] -= items[i]
        bins.append(items[i])
        place(i + 1, bins)
        bins.pop()

    place(0, [])
    return best[0]


def test_bin_completion_is_optimal_on_small_cases():
    for _ in range(60):
        items = sorted(RNG.integers(5, 60, RNG.integers(1, 10)).tolist(), reverse=True)
        counts: dict = {}
        for x in items:
            counts[x] = counts.get(x, 0) + 1
        made = packing.complete(counts, 60)
        back: dict = {}
        for filling, n in made:
            assert sum(k * m for k, m in filling) <= 60
            for k, m in filling:
                back[k] = back.get(k, 0) + m * n
        assert back == counts and sum(n for _, n in made) == exact_bins(items, 60) >= packing.lower_bound(counts, 60)


def test_bin_completion_with_many_equal_pieces():
    """Cases where bins must mix fillings of one largest piece, or repeat one less often than the pieces allow."""
    rng = np.random.default_rng(12)
    for _ in range(60):
        lengths = rng.choice(np.arange(4, 31), 4, replace=False).tolist()
        counts = {k: int(rng.integers(1, 4)) for k in lengths}
        made = packing.complete(counts, 40, nodes=20_000)
        items = sorted((k for k, n in counts.items() for _ in range(n)), reverse=True)
        assert sum(n for _, n in made) == exact_bins(items, 40)


def test_wordhash_windows_match_words():
    from quaverlake.llm.wordhash import Words

    words = Words(pa.array(["a b  c\n", None, "b c", "", "x\tb c"]))
    assert np.diff(words.first).tolist() == [3, 0, 2, 0, 3]
    h = words.window_hash(np.array([1, 3, 6]), np.array([3, 5, 8]))
    assert h[0] == h[1] == h[2]

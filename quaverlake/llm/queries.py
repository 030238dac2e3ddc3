"""The opN queries and the SQL that holds for them."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaverlake.llm.common import table
from quaverlake.llm.url_filters import Rule

URL_RULES = [
    Rule("org", "/", "allow"),
    Rule("example.org", "/es/", "block"),
    Rule("example.org", "/en/1", "block"),
    Rule("com", "/fr/", "allow"),
    Rule("com", "/de/", "block"),
]


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.substring_dedup import substring_dedup

    found = substring_dedup(table(spark, sf_dir, "documents").select("doc_id", "text"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"), F.size("repeats").alias("n_repeats"))


def op2_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.mixing import mix_sources

    drawn = mix_sources(table(spark, sf_dir, "documents").select("doc_id", "source", "text"))
    return drawn.select("doc_id", "source", "block", "tokens", F.round("weight", 9).alias("weight"))


def op3_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.embedding_dedup import embedding_links

    return embedding_links(table(spark, sf_dir, "embeddings")).withColumnRenamed("id", "vec_id")


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.fingerprints import fingerprint_documents

    return fingerprint_documents(table(spark, sf_dir, "documents")).withColumnRenamed("id", "doc_id")


def op5_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.url_filters import judge_urls

    judged = judge_urls(table(spark, sf_dir, "pages"), URL_RULES)
    return judged.select(F.col("id").alias("page_id"), "host", "path", "rule", "verdict", "trust", "distrust")


def op6_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.chat import format_conversations

    return format_conversations(table(spark, sf_dir, "conversations")).withColumnRenamed("id", "conv_id")


def op7_html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.html_text import extract_text

    return extract_text(table(spark, sf_dir, "pages").select("page_id", "html")).select("page_id", "visible_text")


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.langid import predict, train

    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    held_out = F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2
    held_out = F.coalesce(held_out, F.lit(False))
    model = train(docs.where(~held_out))
    return predict(docs.select("doc_id", "text"), model).select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


def op9_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.order_minhash import near_duplicates

    return near_duplicates(table(spark, sf_dir, "documents").select("doc_id", "text")).select("doc_id", "class_id", "class_key", "class_texts", "class_rows", "kept")


def op10_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    from quaverlake.llm.packing import pack_documents

    found = pack_documents(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (op1_substring_dedup, op2_source_mixing, op3_embedding_dedup, op4_fingerprints, op5_url_filters, op6_chat_formatting, op7_html_text, op8_language_id, op9_order_minhash, op10_best_fit_packing)
}

ORACLE_SQL: dict[str, str] = {
    "op1_substring_dedup": r"""WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
h AS (SELECT doc_id, s, md5(array_to_string(w[s : s + 34], ' ')) AS h FROM (SELECT doc_id, w, unnest(range(1, len(w) - 33)) AS s FROM d WHERE len(w) >= 35)),
r AS (SELECT doc_id, s FROM h WHERE h IN (SELECT h FROM h GROUP BY h HAVING count(*) > 1)), x AS (SELECT DISTINCT doc_id, unnest(range(s, s + 35)) AS i FROM r),
e AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS i, unnest(w) AS word FROM d),
m AS (SELECT e.doc_id, e.i, word, x.i IS NOT NULL AS gone, coalesce(lag(x.i IS NOT NULL) OVER (PARTITION BY e.doc_id ORDER BY e.i), false) AS before FROM e LEFT JOIN x ON x.doc_id = e.doc_id AND x.i = e.i),
k AS (SELECT doc_id, count(*) AS n, count(*) FILTER (WHERE gone) AS g, string_agg(word, ' ' ORDER BY i) FILTER (WHERE NOT gone) AS kept, count(*) FILTER (WHERE gone AND NOT before) AS runs FROM m GROUP BY 1)
SELECT d.doc_id, coalesce(n, 0) AS n_words, coalesce(g, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256, coalesce(runs, 0)::INT AS n_repeats FROM d LEFT JOIN k USING (doc_id)""",
    "op3_embedding_dedup": """WITH RECURSIVE v AS (SELECT vec_id, list_transform(embedding, lambda x: x::DOUBLE) AS e FROM embeddings), u AS (SELECT vec_id, e, sqrt(list_dot_product(e, e)) AS n FROM v),
l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM u a JOIN u b ON a.vec_id <> b.vec_id AND list_dot_product(a.e, b.e) / (a.n * b.n) >= 0.95),
r AS (SELECT vec_id AS v, vec_id AS m FROM embeddings UNION SELECT r.v, l.b FROM r JOIN l ON l.a = r.m), c AS (SELECT v, min(m) AS m FROM r GROUP BY 1), k AS (SELECT a, count(*) AS n FROM l GROUP BY 1)
SELECT v AS vec_id, coalesce(n, 0) AS n_links, m AS component_id, v = m AS kept FROM c LEFT JOIN k ON a = v""",
    "op6_chat_formatting": """WITH t AS (SELECT DISTINCT conv_id, turn, role, text FROM conversations),
c AS (SELECT conv_id, count(*) AS n_turns, string_agg('<|im_start|>' || coalesce(role, 'unknown') || chr(10) || coalesce(text, '') || '<|im_end|>' || chr(10), '' ORDER BY turn, role, text) AS rendered FROM t GROUP BY 1),
k AS (SELECT *, min(conv_id) OVER (PARTITION BY rendered) AS least, count(*) OVER (PARTITION BY rendered) - 1 AS n_collapsed FROM c)
SELECT conv_id, n_turns, rendered, n_collapsed FROM k WHERE conv_id = least AND NOT EXISTS (SELECT 1 FROM c o WHERE o.n_turns > k.n_turns AND starts_with(o.rendered, k.rendered))""",
}

"""The corpus pipeline: ten operators' worth of clean-up in five stages over ``documents``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quaverlake.llm.common import stored
from quaverlake.llm.langid import HAS_LETTER, UNKNOWN, predict, train
from quaverlake.llm.mixing import mix_sources
from quaverlake.llm.order_minhash import keep_one, near_duplicates
from quaverlake.llm.packing import pack_documents
from quaverlake.llm.substring_dedup import substring_dedup

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]
#: a prediction less sure than an even guess among the learned languages by this much is a rejection
MARGIN = 0.05
#: rows of an Arrow batch at most: with whole texts in them, batches of 10,000 rows take some 250 MB more of an executor
BATCH_ROWS = 1000


def _bound_batches(spark: SparkSession) -> None:
    """Lower the session's Arrow batches to BATCH_ROWS; results do not depend on them."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    now = int(spark.conf.get(name))
    if now <= 0 or now > BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with letters and a language the classifier is sure enough of.

    Null, empty and letterless texts go. A table that names no language teaches
    nothing, so all texts with letters stay. Rows that repeat, ties of score and null
    ids are judged each; texts may be of any length; an empty table stays empty; all
    columns but those of ``documents`` are left out.
    """
    _bound_batches(spark)
    held_out = F.coalesce(F.pmod(F.crc32(F.col("doc_id").cast("string")), F.lit(4)) == 2, F.lit(False))
    model = train(docs.where(~held_out))
    if not model.languages:
        return docs.where(HAS_LETTER).select(*COLUMNS)
    sure = 1 / len(model.languages) + MARGIN if len(model.languages) > 1 else 0.0
    judged = predict(docs, model)
    return judged.where((F.col("lang_pred") != UNKNOWN) & (F.col("score") >= sure)).select(*COLUMNS)


def minhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: that of the least id, a null id last.

    Null, empty and wordless texts are classes of equal texts; rows that repeat are one
    class; unlike texts stay, whatever ids they share; texts may be of any length; an
    empty table stays empty; all columns but those of ``documents`` are left out.
    """
    _bound_batches(spark)
    return keep_one(near_duplicates(docs)).select(*COLUMNS)


def substring_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without passages of 35 words or more that stand elsewhere too; emptied ones go.

    Texts that lose nothing stay as they are, white space included, also null and empty
    ones; those that lose every word go, and so do all rows of a text of 35 words that
    repeats. Ids may be null or repeat; texts may be of any length; an empty table stays
    empty; all columns but those of ``documents`` are left out.
    """
    _bound_batches(spark)
    cut = substring_dedup(docs)
    text = F.when(F.col("n_removed") > 0, F.col("kept_text")).otherwise(F.col("text"))
    cut = cut.where("n_removed < n_words or n_removed = 0").withColumn("text", text)
    return cut.withColumn("n_chars", F.char_length("text").cast("long")).select(*COLUMNS)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sources at their target weights: each whole at least once, small ones up to 1.25 times.

    A null source is a source; texts without words are drawn once; rows that repeat and
    null ids are drawn each; ties of the draw order go by id and text; texts may be of
    any length; an empty table stays empty; all columns but those of ``documents`` are
    left out.
    """
    return mix_sources(docs, max_repetition=1.25, cover=True).select(*COLUMNS)


def best_fit_packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of documents in sequences of at most 1024 tokens.

    Null and empty texts are one token; rows that repeat and null ids are packed each;
    pieces of one length are interchangeable, ties go by id, piece and checksum; texts
    may be of any length; an empty table gives no pieces.
    """
    _bound_batches(spark)
    return pack_documents(docs).select(F.col("id").alias("doc_id"), "piece", "start", "length", F.col("crc").alias("ids_crc32"), "sequence_id", "offset")


STAGES = [
    ("language_id", language_id),
    ("minhash_near_dedup", minhash_near_dedup),
    ("substring_dedup", substring_dedup_stage),
    ("source_mixing", source_mixing),
    ("best_fit_packing", best_fit_packing),
]

#: stages of trained models and sketches are beyond SQL; tests hold the two dedup stages against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply every stage to ``documents``, each to the stored result of the one before."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i + 1 < len(STAGES):
            docs = stored(docs)
    return docs

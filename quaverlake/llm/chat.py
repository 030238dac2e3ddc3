"""Chat formatting by cumulative-snapshot collapse.

Systems that log a conversation after every turn leave its prefixes behind. Turns are
chained into rolling hashes; a conversation whose whole chain is a proper prefix of a
longer one, or equals one with a smaller id, is left out by anti-join; what remains
is rendered.
"""

from __future__ import annotations

from collections.abc import Iterator

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _chain(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(id, hashes of every prefix, longest last)."""
    for batch in batches:
        chains = []
        for turns in batch.column(1).to_pylist():
            state, chain = b"", []
            for t in turns:
                for value in (t["role"], t["text"]):
                    coded = b"\x00" if value is None else b"\x01" + value.encode()
                    state = hashlib.blake2b(state + len(coded).to_bytes(8, "little") + coded, digest_size=16).digest()
                chain.append(state)
            chains.append(chain)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(chains, pa.list_(pa.binary()))], names=["id", "chain"])


def format_conversations(turns: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text", begin: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """(id, n_turns, rendered, n_collapsed) of every maximal conversation.

    Turns are ordered by turn (null first), role, text; a row that repeats wholly counts
    once, so a conversation is a set of turns. Null ids form one conversation. A null
    role renders as ``unknown`` and a null text as nothing, yet both differ from those
    in the comparison. Of equal conversations the smallest id stays (null last).
    ``n_collapsed`` counts the equal conversations it stands for, itself aside. Other
    columns are ignored; no rows give no rows. One conversation must fit in a row.
    """
    rows = turns.select(F.col(id_col).alias("id"), F.struct(F.col(turn_col).alias("turn"), F.col(role_col).alias("role"), F.col(text_col).alias("text")).alias("t"))
    whole = rows.groupBy("id").agg(F.array_sort(F.collect_set("t")).alias("turns"))
    whole = whole.withColumn("turns", F.array_sort("turns"))
    kind = turns.schema[id_col].dataType.simpleString()
    chained = whole.mapInArrow(_chain, f"id {kind}, chain array<binary>").withColumn("whole", F.element_at("chain", -1))
    same = chained.groupBy("whole").agg(F.min("id").alias("least"), (F.count(F.lit(1)) - 1).alias("n_collapsed"))
    proper = chained.select(F.explode(F.slice("chain", F.lit(1), F.greatest(F.size("chain") - 1, F.lit(0)))).alias("whole")).distinct()
    maximal = same.join(proper, "whole", "left_anti").select(F.col("least").alias("id"), "n_collapsed")
    kept = whole.join(maximal.select(F.col("id").alias("__id"), "n_collapsed"), F.expr("id <=> __id"))
    piece = lambda t: F.concat(F.lit(begin), F.coalesce(t["role"], F.lit("unknown")), F.lit("\n"), F.coalesce(t["text"], F.lit("")), F.lit(end + "\n"))
    return kept.select("id", F.size("turns").cast("long").alias("n_turns"), F.array_join(F.transform("turns", piece), "").alias("rendered"), "n_collapsed")

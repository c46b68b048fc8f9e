"""From raw documents to packed training sequences, in stages that hand on Parquet tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from icuriver.llm import dart_minhash, line_templates, packing, quality, suffix_dedup
from icuriver.llm.common import prepare, table
from icuriver.session import remove_table, shared_folder

#: No stage but packing of known texts could be said in SQL; the tests compare with brute force.
ORACLE_SQL = None


def _with_text(marked: DataFrame, docs: DataFrame, changed: str, text: str) -> DataFrame:
    """Columns of documents with the new text, and its length, where it changed; rows left without text go."""
    new = F.when(F.expr(changed), F.expr(text)).otherwise(F.col("text"))
    marked = marked.where(~F.coalesce(F.expr(changed), F.lit(False)) | (F.trim(F.expr(text)) != ""))
    out = marked.withColumns({"text": new} | ({"n_chars": F.when(F.expr(changed), F.length(F.expr(text)).cast("long")).otherwise(F.col("n_chars"))} if "n_chars" in docs.columns else {}))
    return out.select(*docs.columns)


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier, learned from the labelled ones among them, does not reject."""
    weights = quality.fit_quality(docs, table(spark, sf_dir, "labels"))
    return quality.keep_good(docs, weights)


def unrepeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines of recurring templates; one whose every line recurs has its text elsewhere and goes."""
    marked = line_templates.without_recurring_lines(docs)
    return _with_text(marked, docs, f"{marked.columns[-1]}.n_dropped > 0", f"{marked.columns[-1]}.kept")


def one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return dart_minhash.keep_one(docs)


def unrepeated_bytes(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without strings of 50 bytes of an earlier one; one that holds nothing else goes."""
    marked = suffix_dedup.without_repeats(docs, as_text=True)
    return _with_text(marked, docs, f"{marked.columns[-1]}.n_removed > 0", f"{marked.columns[-1]}.kept")


def packed_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of at most 2048 tokens, with their ids."""
    return packing.pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))


STAGES = [
    ("quality", good_documents),
    ("line_dedup", unrepeated_lines),
    ("minhash", one_of_near_copies),
    ("suffix_dedup", unrepeated_bytes),
    ("packing", packed_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents. Each but the last is written below the shared folder and read again."""
    docs, folder, before = table(prepare(spark), sf_dir, "documents"), shared_folder(spark), None
    for name, stage in STAGES[:-1]:
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
        if before is not None:
            remove_table(spark, before)
        before = f"{folder}/{name}"
    return STAGES[-1][1](spark, docs, sf_dir)

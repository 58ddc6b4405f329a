"""Training-corpus pipeline: each stage takes the documents its predecessor kept
and returns documents (the last one returns packed pieces)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from shortfall.llm import decontam, linededup, ngramjoin, packing, quality, queries, rowkeys
from shortfall.session import pin, pin_folder


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that importance resampling keeps."""
    return quality.select(docs, queries.table(spark, sf_dir, "labels"))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that repeat or nearly repeat an earlier line."""
    return linededup.remove_lines(docs, **linededup.ALL_LINES)


def one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that are the first of their component of near copies, also among rows of one doc_id or without one."""
    rows = rowkeys.keyed(docs)
    others = ngramjoin.join(rows).where("component_id <> doc_id").select("doc_id").distinct()
    return rowkeys.unkeyed(rows.join(others, "doc_id", "left_anti"), docs.columns)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows that hold no benchmark item."""
    return rowkeys.unkeyed(decontam.remove_leaks(rowkeys.keyed(docs), queries.table(spark, sf_dir, "benchmark")), docs.columns)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' token ids with their sequence and offset."""
    return packing.pack(docs, queries.tokenizer("byte_bpe_50k.json"), queries.END_BYTE_BPE)


STAGES = [
    ("quality classifier", keep_good),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", one_of_each_group),
    ("benchmark decontamination", drop_leaks),
    ("best-fit packing", pack_sequences),
]

#: Importance resampling, edit-distance components and token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read again."""
    docs, folder = queries.table(spark, sf_dir, "documents"), pin_folder(spark)
    for k, (_, stage) in enumerate(STAGES):
        docs = pin(stage(spark, docs, sf_dir), f"stage{k}", folder)
    return docs

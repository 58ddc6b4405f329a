"""One query per operator, over whole tables with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.llm import align, decontam, dialogue, fingerprint, idfiles, licenses, linededup, ngramjoin, packing, pieces, quality, sharding, suffixes
from shortfall.session import pin_folder

SHARDS = [f"shard-{i:02d}" for i in range(16)]
END_BYTE_BPE, END_WORD_BPE = 2, 1


def tokenizer(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.place(table(spark, sf_dir, "documents").select("doc_id"), "doc_id", SHARDS)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.resample(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))[0]


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), END_BYTE_BPE)


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The documents lie in folders ``source/lang/thousand``."""
    docs = table(spark, sf_dir, "documents")
    folder = F.concat_ws("/", "source", "lang", F.floor(F.col("doc_id") / 1000).cast("string"))
    files = docs.select(F.concat(folder, F.lit("/"), F.col("doc_id").cast("string"), F.lit(".txt")).alias("path"), "text")
    found = licenses.scan(files, licenses.template_table(spark))
    return found.select(F.regexp_extract("path", "([0-9]+)[.]txt$", 1).cast("long").alias("doc_id"), "license_id", "score", "origin", "from_dir")


def op5_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprint.fingerprint_edits(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return linededup.classes(table(spark, sf_dir, "documents"), **linededup.ALL_LINES)


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontam.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op8_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffixes.dedup(table(spark, sf_dir, "documents"))


def op9_token_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = f"{pin_folder(spark)}/id_files"
    idfiles.write(table(spark, sf_dir, "documents"), path, tokenizer("word_bpe_49k.json"), END_WORD_BPE, lower=True)
    return idfiles.read(spark, path)


def op10_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngramjoin.join(table(spark, sf_dir, "documents"))


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dialogue.repair_damaged(table(spark, sf_dir, "conversations"))


def op12_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.round_trip(table(spark, sf_dir, "documents"), tokenizer("piece_bpe_32k.model"))


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return align.align_tokenizers(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"), tokenizer("piece_bpe_32k.model"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (
    op1_sharding, op2_quality_classifier, op3_best_fit_packing, op4_license_scan, op5_fingerprints, op6_line_dedup,
    op7_decontamination, op8_suffix_dedup, op9_token_id_files, op10_ngram_jaccard_join,
    op11_conversation_repair, op12_sentencepiece, op13_tokenizer_alignment)}


def oracle_sql() -> dict[str, str]:
    files = ("SELECT doc_id, concat_ws('/', source, lang, CAST(doc_id // 1000 AS VARCHAR)) || '/' || CAST(doc_id AS VARCHAR) || '.txt' AS path, "
             "text FROM documents")
    return {"op1_sharding": sharding.oracle_sql(SHARDS), "op4_license_scan": licenses.oracle_sql(files)}

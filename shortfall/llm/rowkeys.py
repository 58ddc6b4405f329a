"""Row keys: a number for every row, so that rows of NULL or repeated doc_ids are told apart."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shortfall.session import pin, pin_folder


def fresh(name: str, columns: list[str]) -> str:
    """``name``, longer if a column (in any case) has it already."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


def _own(columns: list[str]) -> str:
    return fresh("_doc_id_of_row", columns)


def keyed(docs: DataFrame) -> DataFrame:
    """``docs`` with a number in ``doc_id`` that no other row has, in the order of doc_id (NULL last), then of
    the text's hash, then among equal rows. Where every row has a doc_id of its own, that is the number."""
    doc_id = F.col("doc_id").cast("long")
    rows = docs.withColumn(_own(docs.columns), F.col("doc_id"))
    row = fresh("_row", rows.columns)
    if docs.groupBy(doc_id.alias("k")).agg(F.count("*").alias("n")).where("k IS NULL OR n > 1").isEmpty():
        return rows
    order = [doc_id.asc_nulls_last(), F.xxhash64(F.col("text").cast("string")), F.col(row)]
    numbered = (rows.withColumn(row, F.monotonically_increasing_id()).repartitionByRange(*order).sortWithinPartitions(*order)
                .withColumn("doc_id", F.monotonically_increasing_id()).drop(row))
    return pin(numbered, "rows", pin_folder(docs.sparkSession))         # numbered once


def unkeyed(rows: DataFrame, columns: list[str]) -> DataFrame:
    """``rows`` of :func:`keyed` with their own doc_id again."""
    return rows.withColumn("doc_id", F.col(_own(columns))).select(*[F.col(f"`{c}`") for c in columns])

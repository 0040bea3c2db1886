"""Shared pieces of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weeklens.config import work_path

#: Fixed value: a word is a run of characters other than space, tab, line feed, vertical tab, form feed, return.
WORD = r"[^\x20\x09-\x0D]+"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: lineage is cut, lost executors cost no recomputation."""
    path = work_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def table(spark, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_or_empty(column: str = "text") -> Column:
    return F.coalesce(F.col(column), F.lit(""))


def fold_of(column: str = "doc_id", folds: int = 5) -> Column:
    """Remainder of the id's CRC-32, taken of the id as text; a null id counts as the empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string"), F.lit("")).cast("binary")) % folds


def bound(value: Column, body) -> Column:
    """``body(value)`` with the value computed once per row, also where the body uses it inside a lambda."""
    return F.element_at(F.transform(F.array(value), body), 1)


def row_key(df: DataFrame) -> DataFrame:
    """(row, id, tie): the row as a struct, so no name clashes; its doc_id as text; a hash that rows alike share."""
    columns = [F.col(f"`{c}`") for c in df.columns]
    return df.select(
        F.struct(*columns).alias("row"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), F.xxhash64(*columns).alias("tie")
    )

"""What operators share: tables, the folds of an id, and where lineage is cut (the shared folder that the session names, never one executor's disk)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from turnwright.session import Shelf, cut, discard, scratch, written

__all__ = ["Shelf", "crc_of_id", "cut", "discard", "kept", "sample", "scratch", "table"]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def sample(rows: DataFrame, order: list, text: str, limit: int, size: int) -> DataFrame:
    """The first `limit` rows in an order, as long as their texts have at most `size` bytes in all."""
    first = rows.orderBy(*order).limit(limit)
    so_far = F.sum(F.coalesce(F.octet_length(text), F.lit(0))).over(W.orderBy(*order).rowsBetween(W.unboundedPreceding, 0))  # over `limit` rows
    return first.withColumn("__bytes", so_far).where(F.col("__bytes") <= size).drop("__bytes")


def crc_of_id(doc_id: str | Column = "doc_id") -> Column:
    """crc32 of an id as text; null for a null id."""
    return F.crc32(F.col(doc_id).cast("string") if isinstance(doc_id, str) else doc_id.cast("string"))


def kept(df: DataFrame, path: str) -> DataFrame:
    """df written to a folder as Parquet, and read again."""
    return written(df, path, compression="zstd")

"""Deterministic "first" (T01, T02); stable output order (T03) is an explicit
``ord`` column on the datastream / relation tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def first_by(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """First in document order per key — ``min_by``, never bare ``first()``."""
    s = F.min_by(F.struct(*[F.col(v) for v in values]), F.col(order)).alias("_first")
    return df.groupBy(*keys).agg(s).select(*keys, *[F.col(f"_first.{v}").alias(v) for v in values])


def first_match(df: DataFrame, keys: list[str], pred: Column, value: str) -> DataFrame:
    """First match of a predicate; listing order is undefined, so the
    smallest value is the deterministic choice."""
    return df.where(pred).groupBy(*keys).agg(F.min(value).alias(value))


def bag_dir(deposit_dirs: DataFrame) -> DataFrame:
    """The bag of a deposit is its first child directory not named ``.git``."""
    return first_match(deposit_dirs, ["deposit_id"], F.col("is_dir") & (F.col("name") != ".git"), "name").withColumnRenamed(
        "name", "bag_dir"
    )

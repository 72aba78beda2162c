"""Reject rows: the engine's replacement for a failed ``Try``.

Every check appends rows ``(deposit_id, item, stage, code, message)`` instead
of throwing; ``stage`` is the position of the check in the failure order of
the dataset stage, so the first failure of a deposit is the minimum stage.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagyard import constants as K

REJECT_SCHEMA = "deposit_id bigint, item string, stage int, code string, message string"


def reject(df: DataFrame, code: str, message: Column, item: Column | None = None, key: str = "deposit_id") -> DataFrame:
    """Turn the rows of ``df`` (already filtered to failures) into reject rows."""
    return df.select(
        F.col(key).cast("bigint").alias("deposit_id"),
        (item if item is not None else F.lit(None)).cast("string").alias("item"),
        F.lit(K.STAGE.get(code, 99)).cast("int").alias("stage"),
        F.lit(code).alias("code"),
        message.cast("string").alias("message"),
    )


def union_all(frames: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)


def candidate(cond: Column, code: str, message: Column, item: Column | None = None) -> Column:
    """One candidate reject as a struct; null when the condition does not hold."""
    return F.when(
        cond,
        F.struct(
            (item if item is not None else F.lit(None)).cast("string").alias("item"),
            F.lit(K.STAGE[code]).alias("stage"),
            F.lit(code).alias("code"),
            message.cast("string").alias("message"),
        ),
    )


def explode_candidates(df: DataFrame, candidates: list[Column], key: str = "deposit_id") -> DataFrame:
    """All failed checks of a row in one pass: array of candidate structs -> reject rows."""
    arr = F.filter(F.array(*candidates), lambda x: x.isNotNull())
    return df.select(F.col(key).cast("bigint").alias("deposit_id"), F.inline(arr)).select(
        "deposit_id", "item", F.col("stage").cast("int").alias("stage"), "code", "message"
    )


def failures(df: DataFrame, key: str = "deposit_id") -> DataFrame:
    """Reject rows of the rows whose ``failure`` (a candidate) is not null."""
    f = df.where(F.col("failure").isNotNull())
    return f.select(F.col(key).cast("bigint").alias("deposit_id"), "failure.item", F.col("failure.stage").cast("int").alias("stage"), "failure.code", "failure.message")

"""Small DataFrame helpers shared by the operators of this package."""

from __future__ import annotations

import os
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bagyard.llm.textbytes import mix
from bagyard.session import checkpoint_dir, cut_lineage, written

__all__ = ["apart", "bloom", "cut_lineage", "in_bloom", "one_row_each", "rank_within", "running", "scratch_path", "ship", "table", "tokenizer_file", "written"]


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package from the folder that the driver imports it from.

    A cluster has the package installed; this covers drivers that only changed ``sys.path``."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    env = spark.sparkContext.environment
    paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
    if root not in paths and root not in os.environ.get("PYTHONPATH", "").split(os.pathsep):
        env["PYTHONPATH"] = os.pathsep.join([root, *paths])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new folder name under the shared checkpoint folder."""
    import uuid

    return f"{checkpoint_dir(spark).rstrip('/')}/files/{name}-{uuid.uuid4().hex}"


def apart(docs: DataFrame, used: Sequence[str]) -> DataFrame:
    """``docs`` with all but the ``used`` columns under names that no operator uses; ``toDF(*docs.columns)`` undoes it."""
    return docs.toDF(*[c if c in used else f"extra {i}" for i, c in enumerate(docs.columns)])


def one_row_each(rows: DataFrame, *keys: Column) -> DataFrame:
    """The first row of each key by all its columns; map tasks send one row per key."""
    first = W.partitionBy(*keys).orderBy(*[F.col(f"`{c}`") for c in rows.columns])
    return rows.withColumn("_nth", F.row_number().over(first)).where("_nth = 1").drop("_nth")


def tokenizer_file(name: str) -> str:
    import public_tokenizers

    return os.fspath(public_tokenizers.path(name))


def running(df: DataFrame, order: Sequence[Column], sums: dict[str, Column]) -> DataFrame:
    """Add running totals over the whole table in ``order`` (each row included).

    The rows are range partitioned and written once; totals of the partitions
    (one row per partition) give each partition its start, so no task sees more
    than its own range."""
    named = df.withColumns({f"_s_{k}": c for k, c in sums.items()})
    dealt = cut_lineage(named.repartitionByRange(*order).withColumn("_part", F.spark_partition_id()), "running")
    parts = dealt.groupBy("_part").agg(*[F.sum(f"_s_{k}").alias(f"_t_{k}") for k in sums])
    before = W.orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("_part", *[F.coalesce(F.sum(f"_t_{k}").over(before), F.lit(0)).alias(f"_b_{k}") for k in sums])
    within = W.partitionBy("_part").orderBy(*order).rowsBetween(W.unboundedPreceding, 0)
    out = dealt.join(parts, "_part").withColumns({k: F.sum(f"_s_{k}").over(within) + F.col(f"_b_{k}") for k in sums})
    return out.drop("_part", *[f"_s_{k}" for k in sums], *[f"_b_{k}" for k in sums])


def rank_within(df: DataFrame, keys: Sequence[str], seed: Column, order: Sequence[Column], name: str, buckets: int = 256) -> DataFrame:
    """Number the rows of each group of ``keys`` from 0, in an order that ``seed`` (a hash) and then ``order`` fix.

    A group is spread over ``buckets`` parts of the hash range: counts per part
    give each part its first number, and only a part is sorted by one task, so
    a group with a third of all rows is no hot task.  Null keys form a group."""
    df = df.withColumn("_bucket", F.pmod(F.shiftright(seed, 20), F.lit(buckets)).cast("int")).withColumn("_seed", seed)
    df = df.withColumn("_group", F.xxhash64(*[F.col(k) for k in keys], *[F.col(k).isNull() for k in keys]))
    counts = df.groupBy("_group", "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    ahead = W.partitionBy("_group").orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    counts = counts.select("_group", "_bucket", F.coalesce(F.sum("_n").over(ahead), F.lit(0)).alias("_first"))
    inner = W.partitionBy("_group", "_bucket").orderBy("_seed", *order)
    out = df.join(counts, ["_group", "_bucket"]).withColumn(name, F.row_number().over(inner) - F.lit(1) + F.col("_first"))
    return out.drop("_group", "_bucket", "_seed", "_first")


BLOOM_BITS = 1 << 23


def _bloom_places(ids: np.ndarray) -> list[np.ndarray]:
    h = mix(ids.astype(np.int64).view(np.uint64) + np.uint64(0x9E3779B97F4A7C15))
    return [((h >> np.uint64(s)) & np.uint64(BLOOM_BITS - 1)).astype(np.int64) for s in (0, 20, 40)]


def bloom(df: DataFrame, column: str) -> Broadcast:
    """A Bloom filter of fixed size (1 MiB) over a long column, as a broadcast variable.

    Built by a bitwise-or per 64-bit word before anything reaches the driver; a
    crowded filter lets more rows pass, never fewer."""

    def places(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words = np.zeros(BLOOM_BITS // 64, np.uint64)
        for batch in batches:
            for at in _bloom_places(batch.column(0).drop_null().to_numpy()):
                np.bitwise_or.at(words, at >> 6, np.uint64(1) << (at & 63).astype(np.uint64))
        full = np.flatnonzero(words)
        yield pa.RecordBatch.from_arrays([pa.array(full), pa.array(words[full].view(np.int64))], ["word", "bits"])

    found = df.select(F.col(column).cast("long")).mapInArrow(places, "word long, bits long").groupBy("word").agg(F.bit_or("bits").alias("bits")).toPandas()
    words = np.zeros(BLOOM_BITS // 64, np.uint64)
    words[found["word"].to_numpy(np.int64)] = found["bits"].to_numpy(np.int64).view(np.uint64)
    return df.sparkSession.sparkContext.broadcast(words)


def in_bloom(words: np.ndarray, ids: np.ndarray) -> np.ndarray:
    keep = np.ones(len(ids), bool)
    for at in _bloom_places(ids):
        keep &= (words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) == 1
    return keep

"""Aggregations.

All of them are expressible as hash aggregates with a partial (map-side)
phase: counts, min/max, ``max_by``/``min_by``.  Nothing collects an unbounded
group into one row; where the reference gathers a list (A09) the list stays a
long table and the aggregate keeps counts and the first entry.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagyard import constants as K


def _size0(c: Column) -> Column:
    return F.when(c.isNull(), F.lit(0)).otherwise(F.size(c))


def single_value(df: DataFrame, keys: list[str], array_cols: list[str]) -> DataFrame:
    """The value of a child element if it occurs exactly once over *all*
    records with the same key, else null.  Also returns ``n_<col>``.

    Empty-text elements count (they are '' inside the array).  Uses a sum of
    sizes and a conditional max, so the aggregate is partial/final split and
    never materialises the group.
    """
    aggs = []
    for c in array_cols:
        aggs.append(F.sum(_size0(F.col(c))).cast("bigint").alias(f"n_{c}"))
        aggs.append(F.max(F.when(_size0(F.col(c)) == 1, F.element_at(F.col(c), 1))).alias(f"_v_{c}"))
    g = df.groupBy(*keys).agg(*aggs)
    return g.select(
        *keys,
        *[F.when(F.col(f"n_{c}") == 1, F.col(f"_v_{c}")).alias(c) for c in array_cols],
        *[f"n_{c}" for c in array_cols],
    )


def last_by(df: DataFrame, keys: list[str], order: str, values: list[str]) -> DataFrame:
    """Last-wins per key by an explicit order column (``max_by``)."""
    s = F.max_by(F.struct(*[F.col(v) for v in values]), F.col(order)).alias("_last")
    return df.groupBy(*keys).agg(s).select(*keys, *[F.col(f"_last.{v}").alias(v) for v in values])


def require_format(files: DataFrame, format_col: str = "format") -> DataFrame:
    """Files whose MIME format is missing or not unique (A01 gave null)."""
    return files.where(F.col(format_col).isNull())


def rights_holders(df: DataFrame, key: str = "deposit_id", pos: str = "pos", value: str = "rights_holder") -> DataFrame:
    """Rights holders in document order joined with ', ' (per dataset; a handful)."""
    ordered = F.array_sort(F.collect_list(F.struct(F.col(pos).alias("p"), F.col(value).alias("v"))))
    return df.groupBy(key).agg(
        F.array_join(F.transform(ordered, lambda x: x["v"]), ", ").alias("rights_holders"),
        F.count(F.lit(1)).alias("n_rights_holders"),
    )


def count_per(df: DataFrame, key: str, name: str) -> DataFrame:
    return df.groupBy(key).agg(F.count(F.lit(1)).alias(name))


def cardinality(licenses: DataFrame, created: DataFrame) -> DataFrame:
    """(deposit_id, n_licenses, n_created, outcome) of deposits with a licence."""
    n = count_per(licenses, "deposit_id", "n_licenses").join(count_per(created, "deposit_id", "n_created"), "deposit_id", "left")
    n = n.withColumn("n_created", F.coalesce(F.col("n_created"), F.lit(0)).cast("bigint"))
    return n.withColumn("outcome", F.when(too_many_licenses(), "license_count").when(not_one_created(), "created_not_one").otherwise("ok"))


def too_many_licenses() -> Column:
    return F.col("n_licenses") > 1


def not_one_created() -> Column:
    return F.coalesce(F.col("n_created"), F.lit(0)) != 1


def catalog(df: DataFrame, key: str, value: str) -> DataFrame:
    """Key -> value, last wins; the reference order is undefined, so the
    greatest value wins."""
    return df.groupBy(key).agg(F.max(value).alias(value))


def collect_failures(rejects: DataFrame, key: str = "deposit_id") -> DataFrame:
    """Every failing child counts, not just the first.  The messages stay
    in the long reject table; this gives counts and the smallest message."""
    return rejects.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_failures"),
        F.countDistinct("code").alias("n_codes"),
        F.min("message").alias("first_message"),
    )


def first_failure(rejects: DataFrame, key: str = "deposit_id") -> DataFrame:
    """A10: first error in stage order (ties broken by code, item, message)."""
    order = F.struct("stage", "code", F.coalesce(F.col("item"), F.lit("")), "message")
    first = F.min_by(F.struct("stage", "code", "message", "item"), order).alias("f")
    return rejects.groupBy(key).agg(first).select(key, "f.stage", "f.code", "f.message", "f.item")


def batch_outcome(requests: DataFrame, rejects: DataFrame, key: str = "request_id") -> DataFrame:
    """SUCCESS / FAILED count over a batch of requests."""
    failed = rejects.select(F.col(key).alias("_k")).distinct()
    status = requests.select(key).join(failed, F.col(key) == F.col("_k"), "left").select(
        F.when(F.col("_k").isNull(), "SUCCESS").otherwise("FAILED").alias("status")
    )
    return status.groupBy("status").agg(F.count(F.lit(1)).alias("n"))


def bag_flags(bag_docs: DataFrame) -> DataFrame:
    """Presence flags per deposit (conditional pivot with max)."""

    def has(name: str, nonempty: bool = False) -> Column:
        cond = F.col("name") == name
        if nonempty:
            cond = cond & (F.col("length") > 0)
        return F.coalesce(F.max(cond), F.lit(False))

    return bag_docs.groupBy("deposit_id").agg(
        has("metadata/dataset.xml").alias("has_dataset_xml"),
        has("metadata/files.xml").alias("has_files_xml"),
        has("manifest-sha1.txt", True).alias("has_sha1_manifest"),
        has("metadata/depositor-info/agreements.xml").alias("has_agreements"),
        has("metadata/depositor-info/message-from-depositor.txt").alias("has_message"),
    )


def sdo_collisions(items: DataFrame, key: str = "deposit_id", path: str = "path") -> DataFrame:
    """Distinct paths that map to one SDO name."""
    from bagyard.functions.paths import sdo_name

    return (
        items.select(key, path, sdo_name(F.col(path)).alias("sdo_name"))
        .groupBy(key, "sdo_name")
        .agg(F.countDistinct(path).alias("n_paths"))
        .where(F.col("n_paths") > 1)
    )


def datastream_rows() -> Column:
    """A06 dimension: the fixed datastream list as an array of structs."""
    rows = []
    for ord_, cf, ds, label, cg, mime, cond in K.DATASET_DATASTREAMS:
        rows.append(
            F.struct(
                F.lit(ord_).alias("ord"),
                F.lit(cf).alias("content_file"),
                F.lit(ds).alias("ds_id"),
                F.lit(label).cast("string").alias("label"),
                F.lit(cg).alias("control_group"),
                F.lit(mime).cast("string").alias("mime_type"),
                F.lit(cond or "always").alias("cond"),
            )
        )
    return F.array(*rows)

"""Joins (J01-J12): the lookups of the reference as relational joins.

Big-to-big joins are keyed on ``(deposit_id, path)`` (or ``(dataset, path)``)
so that one deposit with millions of files spreads over many partitions.
Small dimensions are *not* hinted: AQE turns the join into a broadcast once
the dimension's shuffle stage has a measured size below
``spark.sql.adaptive.autoBroadcastJoinThreshold`` and keeps the shuffle join otherwise.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagyard import constants as K
from bagyard.functions import paths as P
from bagyard.functions.rights import category_rights_map
from bagyard.functions.text import fedora_object
from bagyard.operators.rejects import reject


def uris_not_in_bag(uris: DataFrame, bag_paths: DataFrame) -> DataFrame:
    """External-URI paths that are in no payload manifest (one row per path)."""
    return uris.select("deposit_id", "path").distinct().join(bag_paths.select("deposit_id", "path"), ["deposit_id", "path"], "left_anti")


def uris_not_in_bag_rejects(uris: DataFrame, bag_paths: DataFrame) -> DataFrame:
    missing = uris_not_in_bag(uris, bag_paths)
    return reject(
        missing,
        "uri_not_in_bag",
        F.concat(F.lit(K.MSG_URI_NOT_IN_BAG), F.col("path")),
        item=F.col("path"),
    )


def join_file_metadata(files: DataFrame, md: DataFrame) -> DataFrame:
    """Payload file left-join its (aggregated) metadata on (deposit, bag path)."""
    md = md.withColumnRenamed("filepath", "path")
    return files.join(md, ["deposit_id", "path"], "left")


def join_checksums(files: DataFrame, sha1: DataFrame) -> DataFrame:
    """File left-join the sha1 manifest; no match = no checksum."""
    return files.join(sha1.select("deposit_id", "path", "checksum"), ["deposit_id", "path"], "left")


def join_external(files: DataFrame, uris: DataFrame) -> DataFrame:
    """File left-join its external URI."""
    return files.join(uris.select("deposit_id", "path", "uri"), ["deposit_id", "path"], "left")


def join_disciplines(audiences: DataFrame, disciplines: DataFrame) -> DataFrame:
    """Audience -> discipline pid; a left join, so an unknown audience
    stays visible (null pid) and becomes a reject instead of vanishing."""
    return audiences.join(disciplines.select("audience", F.col("pid").alias("discipline_pid")), "audience", "left")


def unknown_audience_rejects(joined: DataFrame) -> DataFrame:
    bad = joined.where(F.col("discipline_pid").isNull())
    return reject(bad, "unknown_audience", F.concat(F.lit(K.MSG_KEY_NOT_FOUND), F.col("audience")), item=F.col("audience"))


def default_rights(deposits: DataFrame) -> DataFrame:
    """Access category -> default accessible-to right (8-entry literal map,
    evaluated in the projection: no join, no shuffle)."""
    return deposits.withColumn("default_accessible", F.try_element_at(category_rights_map(), F.col("access_category")))


def unknown_category_rejects(deposits_with_default: DataFrame) -> DataFrame:
    bad = deposits_with_default.where(F.col("default_accessible").isNull())
    return reject(bad, "unknown_access_category", F.concat(F.lit(K.MSG_KEY_NOT_FOUND), F.coalesce(F.col("access_category"), F.lit("null"))))


def match_license(lic: DataFrame, catalog: DataFrame, text: str = "text") -> DataFrame:
    """Licence URI -> template file.

    https becomes http; the exact URI is tried first, then the URI without one
    trailing '/'.  Asymmetric by design: a catalogue key *with* a trailing
    slash never matches a URI without one.  Two left joins against the small
    catalogue (broadcast by AQE when small), no aggregation.
    """
    u = F.regexp_replace(F.col(text), r"^https:", "http:")
    base = lic.withColumn("_u1", u).withColumn("_u2", F.when(u.endswith("/"), F.expr("substring(_u1, 1, length(_u1) - 1)")))
    cat = catalog.groupBy("uri").agg(F.max("file_name").alias("file_name"), F.max_by("content", "file_name").alias("content"))
    c1 = cat.select(F.col("uri").alias("_u1"), F.col("file_name").alias("_f1"), F.col("content").alias("_c1"))
    c2 = cat.select(F.col("uri").alias("_u2"), F.col("file_name").alias("_f2"), F.col("content").alias("_c2"))
    j = base.join(c1, "_u1", "left").join(c2, "_u2", "left")
    return j.select(
        *[c for c in lic.columns],
        F.coalesce("_f1", "_f2").alias("license_file"),
        F.when(F.col("_f1").isNotNull(), F.col("_c1")).otherwise(F.col("_c2")).alias("license_template"),
    )


def normalized_folders(folder_catalog: DataFrame) -> DataFrame:
    """Folder catalogue keyed by (dataset, path without one trailing '/');
    duplicates resolve to the smallest pid."""
    return (
        folder_catalog.select(
            F.col("dataset_sid").alias("dataset_id"),
            F.regexp_replace(F.col("path"), r"/$", "").alias("anc_path"),
            "pid",
        )
        .groupBy("dataset_id", "anc_path")
        .agg(F.min("pid").alias("anc_pid"))
    )


def nearest_ancestor(requests: DataFrame, folder_catalog: DataFrame, path: str = "path_in_dataset") -> DataFrame:
    """The requests with ``ancestor_path`` and ``ancestor_pid``, the deepest known folder
    above their path in the same dataset; none -> ('', dataset).

    Requests share parents, so ancestors are resolved once per distinct (dataset, parent):
    its ancestors, itself included, are exploded (depth-bounded) and equi-joined with the
    catalogue on (dataset, path), and the deepest hit is kept by ``max_by``.  The requests
    then join their parent's answer; they are never exploded nor grouped, and that join can
    be split where one folder gets very many requests.  A path at top level has no parent."""
    parent = P.parent_path(F.col(path))
    parents = requests.select("dataset_id", parent.alias("_parent")).where("_parent IS NOT NULL").distinct()
    within = F.posexplode(P.ancestor_paths(F.concat("_parent", F.lit("/")))).alias("depth", "anc_path")
    hits = parents.select("dataset_id", "_parent", within).join(normalized_folders(folder_catalog), ["dataset_id", "anc_path"])
    best = hits.groupBy("dataset_id", "_parent").agg(F.max_by(F.struct("anc_path", "anc_pid"), F.col("depth")).alias("_b"))
    found = requests.withColumn("_parent", parent).join(best, ["dataset_id", "_parent"], "left")
    return found.select(
        *requests.columns,
        F.coalesce(F.col("_b.anc_path"), F.lit("")).alias("ancestor_path"),
        F.coalesce(F.col("_b.anc_pid"), F.col("dataset_id")).alias("ancestor_pid"),
    )


def parent_sdo(items: DataFrame, path: str = "dataset_path") -> DataFrame:
    """Relation target = SDO of the parent folder, or the dataset SDO at top level.
    A derived key — no join needed."""
    parent = P.parent_path(F.col(path))
    return items.withColumn("parent_sdo", F.when(parent.isNull(), F.lit(K.DATASET_SDO)).otherwise(P.sdo_name(parent)))


def orphans(items_with_parent: DataFrame, folders: DataFrame) -> DataFrame:
    """J09 validation: parents that are neither the dataset nor a staged folder."""
    known = folders.select("deposit_id", F.col("sdo_name").alias("parent_sdo"))
    return items_with_parent.where(F.col("parent_sdo") != K.DATASET_SDO).join(known, ["deposit_id", "parent_sdo"], "left_anti")


def dataset_exists(requests: DataFrame, objects: DataFrame) -> DataFrame:
    """The requests with ``dataset_exists``, a left join against the distinct object ids:
    one row per dataset, broadcast by AQE when small; a hot dataset on the request side is
    split by AQE's skew handling otherwise."""
    known = objects.select(F.col("pid").alias("dataset_id")).distinct().withColumn("_known", F.lit(True))
    return requests.join(known, "dataset_id", "left").withColumn("dataset_exists", F.coalesce("_known", F.lit(False))).drop("_known")


def request_parent(req_with_ancestor: DataFrame, path: str = "path_in_dataset") -> DataFrame:
    """The existing folder is the direct parent -> repository relation; else SDO relation."""
    parent = F.coalesce(P.parent_path(F.col(path)), F.lit(""))
    is_direct = F.col("ancestor_path") == parent
    return req_with_ancestor.withColumn(
        "parent_kind", F.when(is_direct, F.lit("object")).otherwise(F.lit("objectSDO"))
    ).withColumn("parent_object", F.when(is_direct, fedora_object(F.col("ancestor_pid"))).otherwise(P.sdo_name(parent)))


def accepted(deposits: DataFrame, rejects: DataFrame) -> DataFrame:
    """A deposit with any reject produces no result."""
    return deposits.join(rejects.select("deposit_id").distinct(), "deposit_id", "left_anti")

"""The combined item-request job (bulk staging of files into existing datasets).

S09 -> P12 drop empty rows -> P11 defaults -> P08/P09/P10/P14/P18 checks ->
J10 dataset exists -> J08 nearest existing ancestor -> J11 parent relation ->
file SDO rows (N02) and ancestor folder SDOs (N09).

All joins are keyed on (dataset, path) or the request id; nothing is
collected per dataset, so a dataset receiving a third of all requests still
spreads over the cluster.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagyard import constants as K
from bagyard.functions import paths as P
from bagyard.functions.text import fedora_object
from bagyard.operators import checks, joins
from bagyard.plans import documents as D
from bagyard.session import cut_lineage
from bagyard.sources import scans

REQ_REJECT_SCHEMA = "request_id bigint, code string"


@dataclass
class ItemResult:
    requests: DataFrame  # after P12, with defaults and cleaned owner
    rejects: DataFrame  # (request_id, code)
    files: DataFrame  # file SDO rows of accepted requests
    folders: DataFrame  # ancestor folder SDOs (N09)
    file_rejects: DataFrame | None = None  # (file_id, code, message) of request files that were not read


def prepare_requests(raw: DataFrame) -> DataFrame:
    """P12 -> P11 -> P18."""
    return checks.clean_owner(checks.apply_request_defaults(checks.drop_empty_requests(raw)))


def request_codes() -> Column:
    """P08, P09, P10, P14, P18 and J10 as one array of failed codes per request."""
    own = [F.when(F.col("owner_id").isNull(), F.lit("owner_missing")), F.when((F.col("dataset_id") != "") & ~F.col("dataset_exists"), F.lit("dataset_not_found"))]
    extra = F.array(*checks.location_codes(), *checks.creator_role_codes(), *checks.request_rights_codes(), *own)
    return F.concat(checks.request_rule_codes(None), F.filter(extra, lambda x: x.isNotNull()))


def checked_requests(raw: DataFrame, objects: DataFrame) -> DataFrame:
    """Requests after P12/P11/P18 with the array of failed codes (one pass)."""
    return joins.dataset_exists(prepare_requests(raw), objects).withColumn("codes", request_codes()).drop("dataset_exists")


def request_rejects(req: DataFrame, objects: DataFrame) -> DataFrame:
    """(request_id, code) for every failed check of every request."""
    return checked_requests(req, objects).select("request_id", F.explode("codes").alias("code"))


def stage_items(raw_requests: DataFrame, folder_catalog: DataFrame, objects: DataFrame, only_missing: bool = False) -> ItemResult:
    # the checked requests feed the rejects, the files and the folders: materialise once
    r = cut_lineage(checked_requests(raw_requests, objects), "requests")
    rej = r.select("request_id", F.explode("codes").alias("code"))
    ok = r.where(F.size("codes") == 0).drop("codes")
    located = joins.nearest_ancestor(ok, folder_catalog)
    r2 = joins.request_parent(located)
    managed = F.col("file_location") != ""
    files = r2.select(
        "request_id",
        "dataset_id",
        P.sdo_set_name(F.col("dataset_id")).alias("set_name"),
        P.sdo_name(F.col("path_in_dataset")).alias("sdo_name"),
        F.col("path_in_dataset").alias("dataset_path"),
        F.when(managed, F.lit("M")).otherwise(F.lit("R")).alias("control_group"),
        F.when(~managed, F.col("datastream_location")).alias("ds_location"),
        F.when(managed, F.col("file_location")).alias("source"),
        F.col("format").alias("mime_type"),
        F.col("size").cast("bigint").alias("size"),
        P.file_name(F.col("path_in_dataset")).alias("title"),
        "owner_id",
        "creator_role",
        "visible_to",
        "accessible_to",
        "ancestor_path",
        "ancestor_pid",
        "parent_kind",
        "parent_object",
        F.lit("object").alias("subordinate_kind"),
        fedora_object(F.col("dataset_id")).alias("subordinate_object"),
    )
    folders = D.ancestor_sdos(ok, folder_catalog, only_missing=only_missing)
    return ItemResult(requests=r.drop("codes"), rejects=rej, files=files, folders=folders)


def stage_request_files(spark, csv: str | list[str], folder_catalog: DataFrame, objects: DataFrame, only_missing: bool = False, id_column: str | None = None) -> ItemResult:
    """N11 from request files: the header audit (U03) decides per file, then the requests of the accepted files are staged.

    A file that lacks a required column is rejected as a whole, with the message of the command; the others go on."""
    requests, files = scans.scan_request_batch(spark, csv, id_column)
    res = stage_items(requests, folder_catalog, objects, only_missing)
    missing = F.concat(F.lit(K.MSG_MISSING_COLUMNS), F.array_join(F.transform("missing", F.upper), ", "))
    res.file_rejects = files.where("NOT accepted").select("file_id", F.lit("missing_columns").alias("code"), missing.alias("message"))
    return res


def testdata_items(spark, sf_dir: str, only_missing: bool = False) -> ItemResult:
    from bagyard.sources import testdata as T

    return stage_items(T.item_requests(spark, sf_dir), T.folder_catalog(spark, sf_dir), T.object_catalog(spark, sf_dir), only_missing)

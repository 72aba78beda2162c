"""Registered queries: one per operator of the inventory, each over the whole
test tables (bindings in :mod:`bagyard.sources.testdata`).

Every callable takes ``(spark, sf_dir)`` and returns a DataFrame with scalar,
aliased columns; the DuckDB twin of each is in :mod:`bagyard.plans.oracles`.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from bagyard import constants as K
from bagyard.functions import paths as P
from bagyard.functions import text as TX
from bagyard.functions.dates import created_year, iso_timestamp
from bagyard.functions.rights import effective_accessible, effective_visible, parse_rights
from bagyard.operators import aggs, checks, joins, ordering, sets
from bagyard.operators.depositor import depositor_info, signer_display_name
from bagyard.operators.licenses import extension_mime, is_uri_license, license_outcome
from bagyard.plans import dataset_job as DJ
from bagyard.plans import documents as D
from bagyard.plans import item_job as IJ
from bagyard.session import checkpoint_dir, cut_lineage, drop_folder, shuffle_files_go, written
from bagyard.sources import listing as L
from bagyard.sources import scans, sinks
from bagyard.sources import testdata as T

Q = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Q] = {}


def q(name: str):
    def deco(fn: Q) -> Q:
        QUERIES[name] = fn
        return fn

    return deco


def _rej(df: DataFrame) -> DataFrame:
    return df.select("deposit_id", "code", "message")


def _md(s, d, keys: DataFrame | None = None) -> DataFrame:
    return aggs.single_value(T.file_metadata(s, d, keys), ["deposit_id", "filepath"], ["format", "title", "access_rights", "accessible_to", "visible_to"])


def _files_md(s, d) -> DataFrame:
    files = joins.default_rights(T.deposits(s, d)).select("deposit_id", "default_accessible").join(T.payload_files(s, d), "deposit_id")
    return joins.join_file_metadata(files, _md(s, d))


def _sha1(s, d, keys: DataFrame | None = None) -> DataFrame:
    e = checks.check_manifest_lines(scans.parse_manifest_lines(T.payload_manifest(s, d, keys)))
    return aggs.last_by(e.where("line_ok"), ["deposit_id", "path"], "line_no", ["checksum"])


def _bag_paths(s, d) -> DataFrame:
    return sets.paths_in_bag(scans.parse_manifest_lines(T.manifest_lines(s, d)))


def _licenses(s, d):
    return license_outcome(T.license_elements(s, d), T.ns_decls(s, d), T.rights_holders(s, d), T.created(s, d), T.license_catalog(s, d))


def _info(s, d) -> DataFrame:
    return depositor_info(T.deposits(s, d), T.agreements(s, d), T.agreement_signers(s, d), T.messages(s, d))


def _requests(s, d) -> DataFrame:
    return T.item_requests(s, d)


def _located(s, d) -> DataFrame:
    return joins.nearest_ancestor(_requests(s, d), T.folder_catalog(s, d))


def _keys(s, d) -> DataFrame:
    """The payload keys, written once: several inputs of a query derive from this aggregate of the largest table."""
    return cut_lineage(T.payload_keys(s, d), "payload_keys")


def _payload_items(s, d, keys: DataFrame | None = None) -> DataFrame:
    """Payload files with dataset path, SDO name and parent (no accept gate)."""
    return joins.parent_sdo(checks.with_paths(T.payload_files(s, d, keys))).withColumn("sdo_name", P.sdo_name(F.col("dataset_path")))


def _payload_entries(s, d, keys: DataFrame | None = None) -> DataFrame:
    """Payload files and directories with dataset path, SDO name and parent (no accept gate)."""
    listing = T.payload_listing(s, d, keys if keys is not None else _keys(s, d))
    return joins.parent_sdo(checks.with_paths(D.payload_entries(listing))).withColumn("sdo_name", P.sdo_name(F.col("dataset_path")))


def _stored_listing(s, d) -> DataFrame:
    """The corpus listing, written as a storage inventory to the shared checkpoint folder, read and stored.

    The inventory is compressed, as storages write theirs; what it was made from and the inventory itself go once they are read."""
    base, root = _scratch(s, "listing"), "store://corpus"
    with written(T.payload_keys(s, d), "payload_keys") as keys, shuffle_files_go(s):
        L.inventory_lines(T.corpus_listing(s, d, keys), root).write.option("compression", "snappy").text(f"{base}/inventory")
    L.store_listing(L.read_inventory(s, f"{base}/inventory", root), f"{base}/stored")
    drop_folder(s, f"{base}/inventory")
    return L.open_listing(s, f"{base}/stored")


def _scratch(s, name: str) -> str:
    return f"{checkpoint_dir(s).rstrip('/')}/{name}-{uuid.uuid4().hex}"


# ================================================================ sources / sinks
@q("S01_scan_deposits")
def s01(s, d):
    """Owner and bag of every deposit: bags from the stored listing, owners from the properties' lines."""
    return scans.scan_deposits(_stored_listing(s, d), T.property_lines(s, d))


@q("S02_scan_payload")
def s02(s, d):
    """Files and directories of every deposit's payload, from the stored listing."""
    return scans.scan_payload(_stored_listing(s, d))


@q("S03_scan_manifests")
def s03(s, d):
    return scans.parse_manifest_lines(T.manifest_lines(s, d))


@q("S04_parse_file_records")
def s04(s, d):
    r = scans.parse_file_records(T.file_records_xml(s, d))
    out = [F.col("deposit_id"), F.col("filepath")]
    for c in ["format", "title", "access_rights", "accessible_to", "visible_to"]:
        out += [F.size(c).alias(f"n_{c}"), F.array_join(c, "|").alias(f"{c}_text")]
    return r.select(*out)


@q("S05_parse_dataset_metadata")
def s05(s, d):
    r = scans.parse_dataset_metadata(T.dataset_xml(s, d))
    return r.select(
        "deposit_id",
        F.array_join("audience", "|").alias("audiences"),
        F.array_join("created", "|").alias("created"),
        F.array_join("rights_holder", "|").alias("rights_holders"),
        F.array_join(F.transform("license", lambda x: x["text"]), "|").alias("license_texts"),
        F.array_join(F.transform("license", lambda x: F.coalesce(x["xsi_type"], F.lit("-"))), "|").alias("license_types"),
        F.size("license").alias("n_licenses"),
    )


@q("S06_parse_agreements")
def s06(s, d):
    return scans.parse_agreements(T.agreements_xml(s, d)).select("deposit_id", "is_valid", "accepted_text", "privacy_text", "name", "account", "email")


@q("S07_scan_messages")
def s07(s, d):
    """Messages written by Spark as one text file per deposit to the shared
    checkpoint folder, read back whole and cleaned (F05)."""
    path = _scratch(s, "s07")
    (T.messages(s, d).select("deposit_id", F.col("text").alias("value"))
     .repartition("deposit_id")  # each deposit's file written once, by one of many tasks
     .write.partitionBy("deposit_id").text(path))
    m = scans.read_whole_texts(s, path)
    return m.select("deposit_id", "text", TX.clean_message(F.col("text")).alias("message"))


@q("S08_parse_uri_mapping")
def s08(s, d):
    return scans.parse_uri_mapping(T.uri_lines(s, d))


def _request_files(s, d) -> str:
    """Request files of four headers, written by Spark to the shared checkpoint folder; a glob over all of them."""
    path = _scratch(s, "requests")
    T.write_request_files(s, d, path)
    return f"{path}/*"


@q("S09_scan_item_requests")
def s09(s, d):
    """The requests of all files that have every required column, whatever their column order."""
    return scans.scan_request_batch(s, _request_files(s, d), "request-id")[0]


@q("S10_scan_folder_catalog")
def s10(s, d):
    return scans.scan_folder_catalog(T.all_folders(s, d))


@q("S11_discipline_catalog")
def s11(s, d):
    return scans.discipline_pairs(T.all_disciplines(s, d))


@q("S12_license_catalog")
def s12(s, d):
    """The licence catalogue written as a properties file (keys escaped) to
    the shared checkpoint folder by Spark and scanned back with its templates."""
    cat = T.all_licenses(s, d)
    line = F.concat(F.regexp_replace(F.col("uri"), r"([:=\\])", r"\\$1"), F.lit("="), F.col("file_name"))
    path = _scratch(s, "s12")
    cat.select(line.alias("value")).write.text(path)
    return scans.license_catalog(s, path, templates=cat)


@q("S13_object_catalog")
def s13(s, d):
    return scans.object_catalog(T.all_objects(s, d))


@q("K03_bag_metadata_documents")
def k03(s, d):
    copies, rej = sinks.bag_metadata_documents(T.deposits(s, d), aggs.bag_flags(T.bag_documents(s, d)))
    return copies.select("deposit_id", "file_name", F.lit("copy").alias("status")).unionByName(
        rej.select("deposit_id", F.col("item").alias("file_name"), F.lit("missing").alias("status"))
    )


@q("K03_bag_metadata_contents")
def k03c(s, d):
    """The copied bag documents with their contents, digest and size."""
    copies, _ = sinks.bag_metadata_documents(T.deposits(s, d), aggs.bag_flags(T.bag_documents(s, d)))
    return sinks.bag_metadata_contents(copies, T.bag_contents(s, d)).select("deposit_id", "file_name", "content", "sha1", "n_bytes")


@q("K01_staged_set")
def k01(s, d):
    """SDO, datastream and relation tables of the staged set, written, staged a second time and read back: one row per SDO."""
    res, path = _n10(s, d), _scratch(s, "staged")
    tables = {name: cut_lineage(df, name) for name, df in (("sdos", res.sdos()), ("datastreams", res.datastreams), ("relations", res.relations))}
    for _ in range(2):
        sinks.write_staged_set(tables, path, T.deposits(s, d), buckets=8)
    sdos, streams, rels = (sinks.read_staged(s, f"{path}/{name}") for name in tables)
    count = lambda df, name: df.groupBy("deposit_id", "sdo_name").agg(F.count(F.lit(1)).alias(name))
    keys = ["deposit_id", "sdo_name"]
    out = sdos.join(count(streams, "n_datastreams"), keys, "left").join(count(rels, "n_relations"), keys, "left")
    return out.select(*keys, "kind", "parent_sdo", "path", "n_datastreams", "n_relations")


@q("K02_outcome_log")
def k02(s, d):
    """The outcome log of a run that was written twice, read back."""
    res, path = _n10(s, d), _scratch(s, "log")
    for _ in range(2):
        sinks.write_outcome(T.deposits(s, d), res.rejects, path, "run-1")
    return s.read.parquet(f"{path}/outcomes").select("run_id", "deposit_id", "status", "message")


@q("K04_copy_plan")
def k04(s, d):
    f = checks.content_kind(joins.join_external(_payload_items(s, d), T.payload_uris(s, d)))
    return sinks.copy_plan(f)


# ================================================================ projections / checks
@q("P01_with_paths")
def p01(s, d):
    return checks.with_paths(T.payload_files(s, d)).select("deposit_id", "path", "dataset_path", "name", "parent_path")


@q("P02_sdo_name")
def p02(s, d):
    r = _requests(s, d)
    return r.select("request_id", P.sdo_name(F.col("path_in_dataset")).alias("sdo_name"), P.sdo_set_name(F.col("dataset_id")).alias("set_name"))


@q("P03_check_state")
def p03(s, d):
    return _rej(checks.check_state(T.deposits(s, d)))


@q("P04_check_urn")
def p04(s, d):
    return _rej(checks.check_urn(T.deposits(s, d)))


@q("P05_check_archive")
def p05(s, d):
    return _rej(checks.check_archive(T.deposits(s, d)))


@q("P06_payload_gate")
def p06(s, d):
    gated = checks.payload_gate(T.deposits(s, d)).where("stage_payload")
    return T.payload_files(s, d).join(gated, "deposit_id", "left_semi").select("deposit_id", "path")


@q("P07_content_kind")
def p07(s, d):
    f = checks.content_kind(joins.join_external(T.payload_files(s, d), T.payload_uris(s, d)))
    return f.select("deposit_id", "path", "control_group", "content_file", "ds_location")


@q("P08_check_request_rules")
def p08(s, d):
    return checks.check_request_rules(_requests(s, d))


@q("P09_check_location")
def p09(s, d):
    return checks.check_location(_requests(s, d))


@q("P10_check_creator_role")
def p10(s, d):
    return checks.check_creator_role(checks.apply_request_defaults(_requests(s, d)))


@q("P11_apply_request_defaults")
def p11(s, d):
    return checks.apply_request_defaults(_requests(s, d)).select("request_id", "accessible_to", "visible_to", "creator_role")


@q("P12_drop_empty_requests")
def p12(s, d):
    return checks.drop_empty_requests(_requests(s, d)).select("request_id")


@q("P14_parse_rights")
def p14(s, d):
    md = T.file_metadata(s, d)
    vals = md.select(F.explode(F.concat("access_rights", "accessible_to", "visible_to")).alias("raw")).distinct()
    return vals.select("raw", parse_rights(F.col("raw")).alias("parsed"))


@q("P15_effective_access")
def p15(s, d):
    f = _files_md(s, d)
    return f.select("deposit_id", "path", effective_accessible(F.col("access_rights"), F.col("accessible_to"), F.col("default_accessible")).alias("accessible_to"))


@q("P16_effective_visible")
def p16(s, d):
    return _files_md(s, d).select("deposit_id", "path", effective_visible(F.col("visible_to")).alias("visible_to"))


@q("P17_effective_title")
def p17(s, d):
    f = checks.with_paths(_files_md(s, d))
    return f.select("deposit_id", "path", F.coalesce(F.col("title"), F.col("name")).alias("title"))


@q("P18_clean_owner")
def p18(s, d):
    return checks.clean_owner(_requests(s, d)).select("request_id", "owner_id")


@q("P19_check_manifest_lines")
def p19(s, d):
    e = scans.parse_manifest_lines(T.manifest_lines(s, d).unionByName(T.payload_manifest(s, d)))
    return e.select(
        "deposit_id", "algorithm", "line_no",
        checks.manifest_line_ok(F.col("checksum"), F.col("path")).alias("ok_default"),
        checks.manifest_line_ok(F.col("checksum"), F.col("path"), strict=True).alias("ok_strict"),
    )


@q("P20_identifiers")
def p20(s, d):
    return checks.identifiers(T.deposits(s, d))


@q("P21_extra_descriptions")
def p21(s, d):
    return checks.extra_descriptions(T.deposits(s, d))


@q("P22_dataset_admin")
def p22(s, d):
    return checks.dataset_admin(T.deposits(s, d), _info(s, d).select("deposit_id", "accepted_license"))


@q("P23_fox_label")
def p23(s, d):
    return T.label_texts(s, d).select("doc_id", checks.fox_label("label_text").alias("label"))


# ================================================================ joins
@q("J01_uris_not_in_bag")
def j01(s, d):
    return joins.uris_not_in_bag(T.external_uris(s, d), _bag_paths(s, d))


@q("J02_join_file_metadata")
def j02(s, d):
    return joins.join_file_metadata(T.payload_files(s, d), _md(s, d)).select("deposit_id", "path", "format", "n_format")


@q("J03_join_checksums")
def j03(s, d):
    return joins.join_checksums(T.payload_files(s, d), _sha1(s, d)).select("deposit_id", "path", "checksum")


@q("J04_join_external")
def j04(s, d):
    return joins.join_external(T.payload_files(s, d), T.payload_uris(s, d)).select("deposit_id", "path", "uri")


@q("J05_join_disciplines")
def j05(s, d):
    return joins.join_disciplines(T.audiences(s, d), scans.discipline_catalog(T.discipline_xml(s, d))).select(
        "deposit_id", "pos", "audience", "discipline_pid"
    )


@q("J06_default_rights")
def j06(s, d):
    return joins.default_rights(T.deposits(s, d)).select("deposit_id", "access_category", "default_accessible")


@q("J07_match_license")
def j07(s, d):
    return joins.match_license(T.license_elements(s, d), T.license_catalog(s, d)).select("deposit_id", "pos", "text", "license_file")


@q("J08_nearest_ancestor")
def j08(s, d):
    return _located(s, d).select("request_id", "ancestor_path", "ancestor_pid")


@q("J09_parent_sdo")
def j09(s, d):
    return _payload_items(s, d).select("deposit_id", "path", "sdo_name", "parent_sdo")


@q("J09_staged_warnings")
def j09w(s, d):
    """The constraints on the staged set: no orphan parent (J09), and the SDO names that paths share."""
    return _n10(s, d).warnings


@q("J10_check_dataset_exists")
def j10(s, d):
    return joins.dataset_exists(_requests(s, d), T.object_catalog(s, d)).select("request_id", "dataset_id", "dataset_exists")


@q("J11_request_parent")
def j11(s, d):
    return joins.request_parent(_located(s, d)).select("request_id", "parent_kind", "parent_object")


@q("J12_accepted")
def j12(s, d):
    return DJ.stage_datasets(DJ.testdata_inputs(s, d)).accepted.select("deposit_id")


# ================================================================ aggregations
@q("A01_single_value")
def a01(s, d):
    return _md(s, d).select("deposit_id", "filepath", "format", "title", "n_format", "n_title")


@q("A02_last_by")
def a02(s, d):
    e = scans.parse_manifest_lines(T.manifest_lines(s, d)).where(F.col("path").isNotNull())
    return aggs.last_by(e, ["deposit_id", "algorithm", "path"], "line_no", ["checksum"])


@q("A03_require_format")
def a03(s, d):
    return aggs.require_format(joins.join_file_metadata(T.payload_files(s, d), _md(s, d))).select("deposit_id", "path")


@q("A04_rights_holders")
def a04(s, d):
    return aggs.rights_holders(T.rights_holders(s, d))


@q("A05_check_cardinality")
def a05(s, d):
    return aggs.cardinality(T.license_elements(s, d), T.created(s, d))


def _deposit_flags(s, d) -> DataFrame:
    flags = aggs.bag_flags(T.bag_documents(s, d))
    return T.deposits(s, d).join(flags, "deposit_id", "left")


@q("A06_dataset_datastreams")
def a06(s, d):
    lic, _ = _licenses(s, d)
    return D.dataset_datastreams(_deposit_flags(s, d), lic).select("deposit_id", "ord", "ds_id", "content_file", "label", "control_group", "mime_type")


def _relations(s, d) -> DataFrame:
    aud = joins.join_disciplines(T.audiences(s, d), scans.discipline_catalog(T.discipline_xml(s, d)))
    return D.dataset_relations(T.deposits(s, d), aud)


@q("A07_dataset_relations")
def a07(s, d):
    return _relations(s, d).select("deposit_id", "ord", "predicate", "object_kind", "object", "is_literal")


@q("A08_catalog")
def a08(s, d):
    return scans.discipline_catalog(T.all_disciplines(s, d))


def _n10(s, d):
    return DJ.stage_datasets(DJ.testdata_inputs(s, d))


@q("A09_collect_failures")
def a09(s, d):
    return aggs.collect_failures(DJ.all_failures(DJ.testdata_inputs(s, d)))


@q("A10_first_failure")
def a10(s, d):
    return aggs.first_failure(_n10(s, d).rejects)


@q("A11_batch_outcome")
def a11(s, d):
    it = IJ.testdata_items(s, d)
    return aggs.batch_outcome(it.requests, it.rejects)


@q("A12_bag_flags")
def a12(s, d):
    return aggs.bag_flags(T.bag_documents(s, d))


@q("A13_sdo_collisions")
def a13(s, d):
    return aggs.sdo_collisions(T.collision_items(s, d))


# ================================================================ order
@q("T01_first_by")
def t01(s, d):
    return ordering.first_by(T.agreement_signers(s, d), ["deposit_id"], "pos", ["name", "account", "email"])


@q("T02_first_match")
def t02(s, d):
    return ordering.bag_dir(T.deposit_dirs(s, d))


@q("T03_stable_order")
def t03(s, d):
    rel = _relations(s, d)
    ordered = F.array_sort(F.collect_list(F.struct("ord", "predicate")))
    return rel.groupBy("deposit_id").agg(F.array_join(F.transform(ordered, lambda x: x["predicate"]), "|").alias("predicates"))


# ================================================================ sets
@q("U01_paths_in_bag")
def u01(s, d):
    return _bag_paths(s, d)


@q("U02_declared_minus_bag")
def u02(s, d):
    return sets.declared_minus_bag(T.external_uris(s, d), _bag_paths(s, d))


@q("U03_header_audit")
def u03(s, d):
    return sets.header_audit(T.header_columns(s, d))


@q("U03_request_files")
def u03f(s, d):
    """The audit of request files on their own headers: what each kind of file lacks and what is ignored."""
    files = scans.scan_request_batch(s, _request_files(s, d), "request-id")[1]
    kind = F.regexp_extract("file_id", "/kind=([0-9]+)/", 1).cast("int").alias("kind")
    return files.select(kind, "signature", "n_columns", F.array_join("missing", "|").alias("missing"), F.array_join("ignored", "|").alias("ignored"), "accepted").distinct()


@q("U04_all_sdos")
def u04(s, d):
    keys = _keys(s, d)
    items = _payload_items(s, d, keys)
    folders = D.folder_sdos(_payload_entries(s, d, keys))
    ds = T.deposits(s, d).select("deposit_id", F.lit(K.DATASET_SDO).alias("sdo_name"), F.lit("dataset").alias("kind"))
    return sets.all_sdos(
        ds,
        folders.select("deposit_id", "sdo_name", F.lit("folder").alias("kind")),
        items.select("deposit_id", "sdo_name", F.lit("file").alias("kind")),
    )


# ================================================================ scalar functions
@q("F01_signer_display_name")
def f01(s, d):
    first = ordering.first_by(T.agreement_signers(s, d), ["deposit_id"], "pos", ["name", "account", "email"])
    return first.select("deposit_id", signer_display_name("name", "account", "email", F.lit(True)).alias("display_name"))


@q("F02_privacy_sentence")
def f02(s, d):
    return _info(s, d).select("deposit_id", "privacy_remark")


@q("F03_loose_boolean")
def f03(s, d):
    a = T.agreements(s, d)
    texts = a.select(F.col("accepted_text").alias("text")).unionByName(a.select(F.col("privacy_text").alias("text"))).where(F.col("text").isNotNull()).distinct()
    return texts.select("text", TX.loose_boolean(F.col("text")).alias("value"))


@q("F04_accepted_license")
def f04(s, d):
    return _info(s, d).select("deposit_id", "accepted_license")


@q("F05_clean_message")
def f05(s, d):
    return T.messages(s, d).select("deposit_id", TX.clean_message(F.col("text")).alias("message"))


@q("F06_remark")
def f06(s, d):
    return _info(s, d).select("deposit_id", "remark")


@q("F07_state_history")
def f07(s, d):
    return checks.state_history(T.deposits(s, d))


@q("F08_iso_timestamp")
def f08(s, d):
    return T.deposits(s, d).select("deposit_id", iso_timestamp(F.col("submission_ts")).alias("ts_text"))


@q("F09_created_year")
def f09(s, d):
    return T.created(s, d).select("deposit_id", "pos", "created", created_year(F.col("created")).alias("year"))


@q("F10_https_to_http")
def f10(s, d):
    return T.table(s, d, "pages").select("page_id", TX.https_to_http(F.col("url")).alias("http_url"))


@q("F11_extension_mime")
def f11(s, d):
    return T.all_licenses(s, d).select("file_name", extension_mime("file_name").alias("mime_type"))


@q("F12_template_fill")
def f12(s, d):
    lic, _ = _licenses(s, d)
    return lic.where(F.col("is_uri") & F.col("mime_type").isin("text/plain", "text/html")).select("deposit_id", "content")


@q("F13_license_kind")
def f13(s, d):
    t = T.license_elements(s, d).join(T.ns_decls(s, d), "deposit_id", "left")
    return t.select("deposit_id", "pos", "xsi_type", is_uri_license("xsi_type", "ns_decls").alias("is_uri"))


@q("F14_last_segment")
def f14(s, d):
    return T.all_disciplines(s, d).select("pid", TX.last_segment(F.col("pid")).alias("segment"))


@q("F15_relation_object")
def f15(s, d):
    r = _requests(s, d)
    return r.select("request_id", TX.fedora_object(F.col("dataset_id")).alias("subordinate_object"))


@q("F16_folder_name")
def f16(s, d):
    return D.folder_md(D.folder_sdos(_payload_entries(s, d))).select("deposit_id", "path", "name")


@q("F17_ancestor_paths")
def f17(s, d):
    r = _requests(s, d)  # a path without ancestors (a blank one, too) is one row without an ancestor
    return r.select("request_id", F.posexplode_outer(P.ancestor_paths(F.col("path_in_dataset"))).alias("depth", "ancestor"))


# ================================================================ documents
@q("N01_dataset_config")
def n01(s, d):
    """The configuration of every dataset, rendered and read back: one row per datastream and relation."""
    lic, _ = _licenses(s, d)
    return D.parse_config(D.config_json(K.NS_DATASET, D.dataset_datastreams(_deposit_flags(s, d), lic), _relations(s, d)))


def _file_items(s, d) -> DataFrame:
    keys = _keys(s, d)
    f = checks.content_kind(joins.join_checksums(joins.join_external(_payload_items(s, d, keys), T.payload_uris(s, d, keys)), _sha1(s, d, keys)))
    f = joins.join_file_metadata(f, _md(s, d, keys)).withColumnRenamed("format", "mime_type")
    return f


@q("N02_file_config")
def n02(s, d):
    f = _file_items(s, d).select("deposit_id", "sdo_name", "parent_sdo", "control_group", "ds_location", "mime_type", "checksum")
    f = cut_lineage(f, "file_items")  # its datastreams and its relations are read from it
    return D.config_rows(K.NS_FILE, D.file_datastreams(f), D.item_relations(f, K.MODEL_FILE))


@q("N02_file_documents")
def n02d(s, d):
    """The configuration documents of the files, rendered and read back."""
    return D.parse_config(D.file_configs(_file_items(s, d)))


@q("N03_folder_config")
def n03(s, d):
    f = cut_lineage(D.folder_sdos(_payload_entries(s, d)), "folders")  # its datastreams and its relations are read from it
    return D.config_rows(K.NS_FOLDER, D.folder_datastreams(f), D.item_relations(f, K.MODEL_FOLDER))


@q("N03_folder_documents")
def n03d(s, d):
    """The configuration documents of the folders, rendered and read back."""
    return D.parse_config(D.folder_configs(D.folder_sdos(_payload_entries(s, d))))


@q("N04_admin_metadata")
def n04(s, d):
    return D.admin_facts(T.deposits(s, d), _info(s, d))


@q("N04_workflow_steps")
def n04w(s, d):
    return D.workflow_steps(T.deposits(s, d))


@q("N05_object_documents")
def n05(s, d):
    """The object documents of the staged set, rendered and read back as XML."""
    return D.parse_foxml(DJ.object_documents(_n10(s, d)))


@q("N06_file_metadata")
def n06(s, d):
    f = _file_items(s, d).withColumn("creator_role", F.lit(K.REQUEST_DEFAULT_CREATOR_ROLE)).join(
        joins.default_rights(T.deposits(s, d)).select("deposit_id", "default_accessible"), "deposit_id")
    f = f.withColumn("visible_to", effective_visible(F.col("visible_to"))).withColumn(
        "accessible_to", effective_accessible(F.col("access_rights"), F.col("accessible_to"), F.col("default_accessible")))
    return D.file_md(f)


@q("N07_folder_metadata")
def n07(s, d):
    return D.folder_md(D.folder_sdos(_payload_entries(s, d)))


@q("N08_folder_sdos")
def n08(s, d):
    return D.folder_sdos(_payload_entries(s, d))


@q("N09_ancestor_sdos")
def n09(s, d):
    return IJ.testdata_items(s, d).folders


@q("N10_staging_job")
def n10(s, d):
    return flagship(DJ.stage_datasets(DJ.testdata_inputs(s, d)))


def flagship(res: DJ.DatasetResult) -> DataFrame:
    ds = res.datasets.select("deposit_id", F.lit(K.DATASET_SDO).alias("sdo_name"), F.lit("dataset").alias("kind"))
    fo = res.folders.select("deposit_id", "sdo_name", F.lit("folder").alias("kind"), "parent_sdo", F.col("dataset_path").alias("path"))
    fi = res.files.select("deposit_id", "sdo_name", F.lit("file").alias("kind"), "parent_sdo", F.col("dataset_path").alias("path"),
                          "mime_type", "accessible_to", "visible_to", "checksum", "control_group", "title")
    return sets.all_sdos(ds, fo, fi)


@q("N11_item_request_job")
def n11(s, d):
    return item_files(IJ.testdata_items(s, d))


@q("N11_item_request_files")
def n11f(s, d):
    """N11 from files of three column orders; a fourth kind of file lacks a column and is rejected whole."""
    it = IJ.stage_request_files(s, _request_files(s, d), T.folder_catalog(s, d), T.object_catalog(s, d), id_column="request-id")
    rejected = it.file_rejects.select(F.concat_ws(": ", "code", "message").alias("set_rejected")).distinct()
    return item_files(it).unionByName(rejected, allowMissingColumns=True)


def item_files(it: IJ.ItemResult) -> DataFrame:
    return it.files.select("request_id", "dataset_id", "sdo_name", "control_group", "ds_location", "mime_type", "size",
                           "parent_kind", "parent_object", "accessible_to", "visible_to", "creator_role", "owner_id")


@q("R01_arrival_staging")
def r01(s, d):
    from bagyard.streaming.arrival import drained_item_stream

    return drained_item_stream(s, d)


@q("R01_deposit_arrival")
def r01d(s, d):
    from bagyard.streaming.arrival import drained_deposit_stream

    return drained_deposit_stream(s, d)

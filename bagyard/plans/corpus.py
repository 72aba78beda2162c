"""Stage a corpus of bag directories end to end: the scans (S01-S08) give the
inputs of the dataset job (N10); what the staging tool takes from its command
line and configuration comes in as tables.

- ``settings``: one row per deposit with deposit_id, state, urn, doi,
  other_access_doi, archive, include_bag_metadata, skip_payload,
  extra_description, submission_ts, title, access_category (the crosswalk
  result, an input column);
- ``discipline_xml``: (pid, xml) relationship documents of the disciplines (S11);
- ``license_catalog``: (uri, file_name, content) — see :func:`scans.license_catalog` (S12).
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bagyard.plans.dataset_job import DatasetInputs
from bagyard.session import checkpoint_dir, cut_lineage
from bagyard.sources import listing as L
from bagyard.sources import scans


EMPTY = {
    "manifests": "deposit_id bigint, bag string, algorithm string, line_no struct<block:bigint,row:bigint>, raw string",
    "ddm": "deposit_id bigint, bag string, audience array<string>, created array<string>, rights_holder array<string>, "
           "license array<struct<text:string,xsi_type:string>>, ns_decls string",
    "agreements": "deposit_id bigint, bag string, is_valid boolean, parse_error string, accepted_text string, "
                  "privacy_text string, name string, account string, email string",
    "messages": "deposit_id bigint, bag string, text string",
    "files": "deposit_id bigint, bag string, filepath string, format array<string>, title array<string>, "
             "access_rights array<string>, accessible_to array<string>, visible_to array<string>",
    "properties": "deposit_id bigint, line_no struct<block:bigint,row:bigint>, value string",
    "uris": "deposit_id bigint, line_no struct<block:bigint,row:bigint>, line string",
}


def _exploded(md: DataFrame, col: str, name: str) -> DataFrame:
    return md.select("deposit_id", F.posexplode(col).alias("pos", name))


def corpus_inputs(spark: SparkSession, root: str, settings: DataFrame, discipline_xml: DataFrame,
                  license_catalog: DataFrame, listing: DataFrame | None = None) -> DatasetInputs:
    """Inputs of the dataset job over the deposits of ``settings``.

    ``listing`` is the stored listing (``listing.open_listing``), restricted to the
    buckets of these deposits if the job takes only some; without one the
    deposits' directories are listed first and the listing is kept under the shared
    checkpoint folder.  Only documents that it names are read, and only those of a
    deposit's first bag (S01/T02)."""
    if listing is None:
        path = f"{checkpoint_dir(spark).rstrip('/')}/listing-{uuid.uuid4().hex}"
        L.store_listing(L.crawl(root, settings), path)
        listing = L.open_listing(spark, path)
    bags = cut_lineage(L.bag_dirs(listing), "bags")
    entries = listing.where(~F.col("is_dir"))

    def beside(name: str) -> list[str]:
        return L.file_paths(entries.where(F.col("entry") == name), root)

    def inside(name: Column) -> list[str]:
        in_bag = L.in_bags(listing).where(~F.col("is_dir") & name).join(bags, ["deposit_id", "bag"])
        return L.file_paths(in_bag.select("deposit_id", F.concat("bag", F.lit("/"), "path").alias("entry")), root)

    def named(name: str) -> list[str]:
        return inside(F.col("path") == name)

    def scan(files: list[str], reader, kind: str) -> DataFrame:
        """The files' rows, or an empty table of their schema when no deposit has the document."""
        return reader(spark, root, files=files) if files else spark.createDataFrame([], EMPTY[kind])

    def contents(copies: DataFrame) -> DataFrame:
        """What the copied bag documents hold; only their files are opened."""
        files = copies.join(bags, "deposit_id").select("deposit_id", F.concat("bag", F.lit("/"), "source").alias("entry"))
        paths = L.file_paths(files, root)
        return scans.scan_contents(spark, root, paths) if paths else spark.createDataFrame([], "deposit_id bigint, name string, content binary")

    owners = scans.owners(scan(beside("deposit.properties"), scans.property_lines, "properties"))
    manifests = scan(inside(F.col("path").rlike(r"^manifest-[^/]+\.txt$")), scans.scan_manifest_lines, "manifests").drop("bag")
    ddm = scan(named("metadata/dataset.xml"), scans.scan_dataset_metadata, "ddm").drop("bag")
    agreements = scan(named("metadata/depositor-info/agreements.xml"), scans.scan_agreements, "agreements").drop("bag")
    lic = ddm.select("deposit_id", F.posexplode("license").alias("pos", "l")).select(
        "deposit_id", "pos", F.col("l.text").alias("text"), F.col("l.xsi_type").alias("xsi_type"))
    mapping = scan(beside("uri-mapping.txt"), scans.uri_mapping_lines, "uris")
    return DatasetInputs(
        deposits=settings.join(owners, "deposit_id", "left"),
        payload_files=scans.scan_payload(listing).drop("bag"),
        file_metadata=scan(named("metadata/files.xml"), scans.scan_file_metadata, "files").drop("bag"),
        sha1_manifest_lines=manifests.where(F.col("algorithm") == "sha1"),
        payload_manifest_lines=manifests,
        file_uris=scans.parse_uri_mapping(mapping).select("deposit_id", "path", "uri"),
        audiences=_exploded(ddm, "audience", "audience"),
        discipline_xml=discipline_xml,
        license_elements=lic,
        ns_decls=ddm.select("deposit_id", "ns_decls"),
        rights_holders=_exploded(ddm, "rights_holder", "rights_holder"),
        created=_exploded(ddm, "created", "created"),
        license_catalog=license_catalog,
        agreements=agreements.select("deposit_id", "is_valid", "parse_error", "accepted_text", "privacy_text"),
        agreement_signers=agreements.where(F.col("name").isNotNull()).select(
            "deposit_id", F.lit(0).alias("pos"), "name", "account", "email"),
        messages=scan(named("metadata/depositor-info/message-from-depositor.txt"), scans.scan_messages, "messages").drop("bag"),
        bag_documents=scans.scan_bag_documents(listing).drop("bag"),
        bad_uri_lines=scans.bad_uri_mapping_lines(mapping),
        bag_contents=contents,
    )

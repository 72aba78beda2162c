"""Projections, filters and predicates.

Checks return reject rows (see :mod:`bagyard.operators.rejects`); the
projections return the input with derived columns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagyard import constants as K
from bagyard.functions import paths as P
from bagyard.functions import text as T
from bagyard.functions.dates import iso_timestamp
from bagyard.functions.rights import parse_rights
from bagyard.operators.rejects import candidate, explode_candidates


# ---------------------------------------------------------------- dataset checks
# one candidate reject (a struct, null if the rule holds) per rule: the operators below and the staging job both use it
def _or_null(c: str) -> Column:
    return F.coalesce(F.col(c), F.lit("null"))


def owner_failure() -> Column:
    """P18 on deposits: nothing is staged for an owner who is not known."""
    return candidate(T.blank_to_null(F.col("owner_id")).isNull(), "owner_missing", F.lit(K.MSG_OWNER_MISSING))


def state_failure() -> Column:
    bad = ~F.coalesce(F.col("state").isin(*K.STATES), F.lit(False))
    return candidate(bad, "invalid_state", F.concat(F.lit(K.MSG_INVALID_STATE), _or_null("state")))


def urn_failure() -> Column:
    return candidate(F.col("urn").isNull(), "urn_missing", F.lit(K.MSG_URN_MISSING))


def archive_failure() -> Column:
    bad = ~F.coalesce(F.col("archive").isin(*K.ARCHIVES), F.lit(False))
    return candidate(bad, "invalid_archive", F.concat(F.lit(K.MSG_INVALID_ARCHIVE), _or_null("archive")))


def category_failure() -> Column:
    """The access category has no default right (``default_accessible`` is null)."""
    return candidate(F.col("default_accessible").isNull(), "unknown_access_category", F.concat(F.lit(K.MSG_KEY_NOT_FOUND), _or_null("access_category")))


def url_failure(uri: str = "uri") -> Column:
    bad = F.col(uri).isNotNull() & ~has_known_protocol(uri)
    return candidate(bad, "bad_url", F.concat(F.lit(K.MSG_BAD_URL), F.col(uri)), F.col("path"))


def check_state(deposits: DataFrame) -> DataFrame:
    """State must be one of four values (the code also accepts MAINTENANCE)."""
    return explode_candidates(deposits, [state_failure()])


def check_urn(deposits: DataFrame) -> DataFrame:
    """The URN is mandatory."""
    return explode_candidates(deposits, [urn_failure()])


def check_archive(deposits: DataFrame) -> DataFrame:
    """Archive is EASY or DATAVAULT."""
    return explode_candidates(deposits, [archive_failure()])


def payload_gate(deposits: DataFrame) -> DataFrame:
    """Files and folders are staged only without ``skip_payload`` and with a DOI."""
    return deposits.withColumn("stage_payload", ~F.col("skip_payload") & F.col("doi").isNotNull())


def content_kind(files: DataFrame, uri: str = "uri") -> DataFrame:
    """Redirect (``R``) when an external location exists, else managed (``M``)."""
    return files.withColumn("control_group", F.when(F.col(uri).isNotNull(), F.lit("R")).otherwise(F.lit("M"))).withColumn(
        "content_file", F.when(F.col(uri).isNull(), F.lit("EASY_FILE"))
    ).withColumn("ds_location", F.col(uri))


KNOWN_URL_PROTOCOLS = ["http", "https", "ftp", "file", "jar", "mailto"]


def has_known_protocol(uri: str) -> Column:
    """Whether a column holds an absolute URL of a known protocol, written in any case."""
    proto = F.lower(F.try_parse_url(F.col(uri), F.lit("PROTOCOL")))
    return F.coalesce(proto.isin(*KNOWN_URL_PROTOCOLS), F.lit(False))


# ---------------------------------------------------------------- request checks
REQUEST_COLS = [
    "path_in_dataset", "format", "datastream_location", "size", "file_location",
    "dataset_id", "accessible_to", "visible_to", "creator_role", "owner_id",
]


def drop_empty_requests(requests: DataFrame) -> DataFrame:
    """Drop rows with no value in any option column (an empty cell is no value)."""
    filled = [F.coalesce(F.col(c) != "", F.lit(False)) for c in REQUEST_COLS]
    any_filled = filled[0]
    for f in filled[1:]:
        any_filled = any_filled | f
    return requests.where(any_filled)


def _given(c: str) -> Column:
    """An option is given when its cell is non-empty (the CSV reader drops empty cells)."""
    return F.coalesce(F.col(c) != "", F.lit(False))


def apply_request_defaults(requests: DataFrame) -> DataFrame:
    """Blank (after trimming) = default; non-blank values are kept untrimmed."""

    def dflt(c: str, d: str) -> Column:
        return F.when(T.is_blank(F.col(c)), F.lit(d)).otherwise(F.col(c))

    return (
        requests.withColumn("accessible_to", dflt("accessible_to", K.REQUEST_DEFAULT_ACCESSIBLE))
        .withColumn("visible_to", dflt("visible_to", K.REQUEST_DEFAULT_VISIBLE))
        .withColumn("creator_role", dflt("creator_role", K.REQUEST_DEFAULT_CREATOR_ROLE))
    )


def request_rule_codes(requests: DataFrame | None = None) -> Column:
    """Codes of the failed option rules, as an array."""
    ds = _given("dataset_id")
    rules = [
        F.when(~ds, F.lit("dataset_id_missing")),
        F.when(ds & ~(_given("path_in_dataset") & _given("size") & _given("format")), F.lit("path_size_format_required")),
        F.when(ds & ~(_given("datastream_location") | _given("file_location")), F.lit("location_or_file_required")),
        F.when(_given("datastream_location") & _given("file_location"), F.lit("location_and_file")),
        F.when(_given("size") & F.col("size").try_cast("bigint").isNull(), F.lit("size_not_a_number")),
    ]
    return F.filter(F.array(*rules), lambda x: x.isNotNull())


def check_request_rules(requests: DataFrame) -> DataFrame:
    """P08 as long rows (request_id, code)."""
    return requests.select("request_id", F.explode(request_rule_codes(requests)).alias("code"))


def location_codes() -> list[Column]:
    """A datastream location must have a protocol starting with ``http``
    (not a URL at all fails too); non-ASCII text is flagged separately."""
    loc, given = F.col("datastream_location"), _given("datastream_location")
    return [F.when(given & ~T.has_http_protocol(loc), F.lit("location_not_http")), F.when(given & ~T.is_ascii(loc), F.lit("location_not_ascii"))]


def creator_role_codes() -> list[Column]:
    """P10: after defaults, the creator role is ARCHIVIST or DEPOSITOR (exact)."""
    return [F.when(~F.col("creator_role").isin(*K.CREATOR_ROLES), F.lit("invalid_creator_role"))]


def request_rights_codes() -> list[Column]:
    """P14 on request options: a non-default rights value must parse exactly."""
    return [F.when(parse_rights(F.col(c)).isNull(), F.lit(f"invalid_{c}")) for c in ("accessible_to", "visible_to")]


def failed_codes(requests: DataFrame, codes: list[Column]) -> DataFrame:
    """(request_id, code) of the codes that are not null."""
    return requests.select("request_id", F.explode(F.filter(F.array(*codes), lambda x: x.isNotNull())).alias("code"))


def check_location(requests: DataFrame) -> DataFrame:
    return failed_codes(requests, location_codes())


def check_creator_role(requests: DataFrame) -> DataFrame:
    return failed_codes(requests, creator_role_codes())


def check_request_rights(requests: DataFrame) -> DataFrame:
    return failed_codes(requests, request_rights_codes())


def clean_owner(requests: DataFrame) -> DataFrame:
    """Owner trimmed like the JVM; blank -> null (and rejected later)."""
    return requests.withColumn("owner_id", T.blank_to_null(F.col("owner_id")))


# ---------------------------------------------------------------- manifests
def manifest_line_ok(checksum: Column, path: Column, strict: bool = False) -> Column:
    """Two tokens and a checksum check.

    Default mode reproduces the reference: the negated check has no quantifier,
    so only a *single* hex digit is rejected.  ``strict`` wants 40 hex digits.
    """
    two = path.isNotNull()
    if strict:
        return two & checksum.rlike(r"^[0-9a-fA-F]{40}$")
    return two & ~checksum.rlike(r"^[a-fA-F0-9]$")


def check_manifest_lines(entries: DataFrame, strict: bool = False) -> DataFrame:
    return entries.withColumn("line_ok", manifest_line_ok(F.col("checksum"), F.col("path"), strict))


# ---------------------------------------------------------------- EMD facts
def identifiers(deposits: DataFrame) -> DataFrame:
    """P20: URN -> PID scheme; DOI -> DOI or other-access DOI; the DMO id placeholder."""
    rows = F.array(
        F.struct(F.lit(1).alias("pos"), F.col("urn").alias("value"), F.lit(K.SCHEME_PID).alias("scheme"), F.lit(K.PID_SYSTEM).alias("id_system")),
        F.struct(
            F.lit(2).alias("pos"),
            F.col("doi").alias("value"),
            F.when(F.col("other_access_doi"), F.lit(K.SCHEME_DOI_OTHER_ACCESS)).otherwise(F.lit(K.SCHEME_DOI)).alias("scheme"),
            F.lit(K.DOI_RESOLVER).alias("id_system"),
        ),
        F.struct(F.lit(3).alias("pos"), F.lit(K.DMO_ID_PLACEHOLDER).alias("value"), F.lit(K.SCHEME_DMO_ID).alias("scheme"), F.lit(None).cast("string").alias("id_system")),
    )
    return deposits.select("deposit_id", F.inline(rows)).where(F.col("value").isNotNull())


def extra_descriptions(deposits: DataFrame) -> DataFrame:
    """The extra description is added only when the payload is skipped."""
    return deposits.where(F.col("skip_payload") & F.col("extra_description").isNotNull()).select(
        "deposit_id", F.col("extra_description").alias("description")
    )


def dataset_admin(deposits: DataFrame, accepted_license: DataFrame) -> DataFrame:
    """Archive location, and the accepted licence when known (null = untouched)."""
    return deposits.join(accepted_license, "deposit_id", "left").select(
        "deposit_id", F.col("archive").alias("archive_location"), "accepted_license"
    )


def fox_label(c) -> Column:
    """Object label limited to 255 characters (code points)."""
    col = F.col(c) if isinstance(c, str) else c
    return F.substring(col, 1, K.MAX_LABEL_LENGTH)


def state_history(deposits: DataFrame) -> DataFrame:
    """a state change DRAFT -> state, only when the state is not DRAFT."""
    return deposits.where(F.col("state") != "DRAFT").select(
        "deposit_id",
        F.lit("DRAFT").alias("from_state"),
        F.col("state").alias("to_state"),
        iso_timestamp(F.col("submission_ts")).alias("change_date"),
    )


def with_paths(df: DataFrame, path: str = "path") -> DataFrame:
    """Bag-relative and dataset-relative path, name and parent."""
    rel = P.dataset_relative(F.col(path))
    return df.withColumn("dataset_path", rel).withColumn("name", P.file_name(rel)).withColumn("parent_path", P.parent_path(rel))

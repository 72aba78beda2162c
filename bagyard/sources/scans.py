"""Scans of a corpus of bag-style deposits.

Layout of one deposit below ``root``::

    <deposit>/deposit.properties
    <deposit>/<bag>/bagit.txt
    <deposit>/<bag>/data/**                      payload
    <deposit>/<bag>/manifest-<alg>.txt           "<checksum> <path>" lines
    <deposit>/<bag>/metadata/dataset.xml
    <deposit>/<bag>/metadata/files.xml
    <deposit>/<bag>/metadata/depositor-info/agreements.xml
    <deposit>/<bag>/metadata/depositor-info/message-from-depositor.txt

What exists comes from the stored corpus listing (:mod:`bagyard.sources.listing`);
contents come from Spark readers over the listed files (or a path pattern, where a
caller gives none), with the deposit and bag from ``_metadata.file_path``.  Deposit
directory names are the deposit ids and must be integers (the engine keys deposits by ``bigint``).
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as Ty

from bagyard import constants as K
from bagyard.functions.text import jtrim
from bagyard.session import cut_lineage
from bagyard.sources import listing as L


def _root_re(root: str) -> str:
    r = root.rstrip("/")
    if r.startswith("file:"):
        r = r[5:]
    return re.escape(r)


def _file_path() -> Column:
    return F.col("_metadata.file_path")


def _deposit_of(path: Column, root: str) -> Column:
    return F.regexp_extract(path, _root_re(root) + r"/([^/]+)/", 1).cast("bigint")


def _bag_of(path: Column, root: str) -> Column:
    return F.regexp_extract(path, _root_re(root) + r"/[^/]+/([^/]+)/", 1)


def _in_bag(path: Column, root: str) -> Column:
    """Bag-relative path of a file."""
    return F.regexp_extract(path, _root_re(root) + r"/[^/]+/[^/]+/(.*)$", 1)


# ------------------------------------------------------------------ S01
OWNER_LINE = r"^\s*depositor\.userId\s*[=:]\s*(.*)$"


def property_lines(spark: SparkSession, root: str, files: str | list[str] | None = None) -> DataFrame:
    """Lines of the ``deposit.properties`` files: (deposit_id, line_no, value)."""
    return spark.read.text(files or f"{root}/*/deposit.properties").select(
        _deposit_of(_file_path(), root).alias("deposit_id"), _line_order().alias("line_no"), "value"
    )


def owners(properties: DataFrame) -> DataFrame:
    """The trimmed value of ``depositor.userId``; of a repeated key the first line counts."""
    lines = properties.where(F.col("value").rlike(OWNER_LINE))
    value = jtrim(F.regexp_extract("value", OWNER_LINE, 1))
    return lines.select("deposit_id", "line_no", value.alias("owner_id")).groupBy("deposit_id").agg(F.min_by("owner_id", "line_no").alias("owner_id"))


def scan_deposits(listing: DataFrame, properties: DataFrame) -> DataFrame:
    """(deposit_id, owner_id, bag_dir); the bag is the first directory that is not ``.git``."""
    return owners(properties).join(L.bag_dirs(listing).withColumnRenamed("bag", "bag_dir"), "deposit_id", "full")


# ------------------------------------------------------------------ S02
def scan_payload(listing: DataFrame) -> DataFrame:
    """Everything below ``data`` of the deposit's bag, and ``data`` itself:
    (deposit_id, bag, path, size, is_dir).

    Empty folders are rows with ``is_dir``; a bag with an empty ``data`` has the
    one row of that directory, a bag without one has none.  One pass over the
    listing for the bag, one for its entries; no payload byte is read."""
    entries = L.in_bags(listing).where((F.col("path") == "data") | F.col("path").startswith("data/"))
    return entries.join(L.bag_dirs(listing), ["deposit_id", "bag"]).select("deposit_id", "bag", "path", "size", "is_dir")


# ------------------------------------------------------------------ S03
def parse_manifest_lines(lines: DataFrame, raw: bool = False) -> DataFrame:
    """S03 on raw lines: split once on horizontal whitespace; blank lines dropped.  ``raw`` keeps the line itself.

    A line is one row of a generator: it is made and split once, not again for each condition on its parts."""
    tokens = F.split(F.col("raw"), r"\h+", 2)
    parts = F.struct(
        F.element_at(tokens, 1).alias("checksum"),
        F.when(F.size(tokens) == 2, F.element_at(tokens, 2)).alias("path"),
        F.col("raw"),
    )
    rows = lines.select("deposit_id", "algorithm", "line_no", F.inline(F.array(parts))).where(F.col("raw") != "")
    return rows if raw else rows.drop("raw")


def _line_order() -> Column:
    """Order of a line within its file for a *splittable* text read: the start
    offset of the split it came from, then the row id.  Within one split rows
    are read in file order and ``monotonically_increasing_id`` grows with them,
    so the pair is a total order of the lines of one file without reading a
    file whole in one task."""
    return F.struct(F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("row"))


def scan_manifest_lines(spark: SparkSession, root: str, files: str | list[str] | None = None) -> DataFrame:
    """Raw payload-manifest lines (deposit_id, algorithm, line_no, raw), splittable."""
    return spark.read.text(files or f"{root}/*/*/manifest-*.txt").select(
        _deposit_of(_file_path(), root).alias("deposit_id"),
        _bag_of(_file_path(), root).alias("bag"),
        F.regexp_extract(_file_path(), r"manifest-([^/]+)\.txt$", 1).alias("algorithm"),
        _line_order().alias("line_no"),
        F.col("value").alias("raw"),
    )


def scan_manifests(spark: SparkSession, root: str) -> DataFrame:
    """S03 on files: ``manifest-<alg>.txt`` of every bag, line by line.

    The text read is splittable, so a manifest of a deposit with millions of
    files is spread over many tasks; ``line_no`` is the in-file order key
    (a struct), which is all the last-wins rule (A02) needs."""
    lines = spark.read.text(f"{root}/*/*/manifest-*.txt").select(
        _deposit_of(_file_path(), root).alias("deposit_id"),
        F.regexp_extract(_file_path(), r"manifest-([^/]+)\.txt$", 1).alias("algorithm"),
        _line_order().alias("line_no"),
        F.col("value").alias("raw"),
    )
    return parse_manifest_lines(lines)


# ------------------------------------------------------------------ S04
FILE_MD_SCHEMA = Ty.StructType(
    [
        Ty.StructField("_filepath", Ty.StringType()),
        Ty.StructField("format", Ty.ArrayType(Ty.StringType())),
        Ty.StructField("title", Ty.ArrayType(Ty.StringType())),
        Ty.StructField("accessRights", Ty.ArrayType(Ty.StringType())),
        Ty.StructField("accessibleToRights", Ty.ArrayType(Ty.StringType())),
        Ty.StructField("visibleToRights", Ty.ArrayType(Ty.StringType())),
    ]
)


def _xml_text(c: Column) -> Column:
    """Values as the XML loader of the reference gives them: trimmed, inner runs collapsed."""
    return F.transform(c, lambda x: F.regexp_replace(jtrim(F.coalesce(x, F.lit(""))), r"\s+", " "))


def scan_file_metadata(spark: SparkSession, root: str, files: str | list[str] | None = None) -> DataFrame:
    """One row per ``<file>`` record of every ``files.xml`` (splittable XML source)."""
    df = (
        spark.read.format("xml")
        .option("rowTag", "file")
        .option("ignoreNamespace", "true")
        .option("ignoreSurroundingSpaces", "false")
        .schema(FILE_MD_SCHEMA)
        .load(files or f"{root}/*/*/metadata/files.xml")
    )

    def arr(name: str) -> Column:
        return _xml_text(F.coalesce(F.col(name), F.array().cast("array<string>")))

    return df.select(
        _deposit_of(_file_path(), root).alias("deposit_id"),
        _bag_of(_file_path(), root).alias("bag"),
        F.col("_filepath").alias("filepath"),
        arr("format").alias("format"),
        arr("title").alias("title"),
        arr("accessRights").alias("access_rights"),
        arr("accessibleToRights").alias("accessible_to"),
        arr("visibleToRights").alias("visible_to"),
    )


def parse_file_records(df: DataFrame, xml: str = "xml") -> DataFrame:
    """S04 on a column of ``<file>`` record texts (e.g. records extracted from a
    stream): same schema and value normalisation as :func:`scan_file_metadata`."""
    p = df.withColumn("_r", F.from_xml(F.col(xml), FILE_MD_SCHEMA, {"ignoreNamespace": "true"}))

    def arr(name: str) -> Column:
        return _xml_text(F.coalesce(F.col(f"_r.{name}"), F.array().cast("array<string>")))

    keep = [c for c in df.columns if c != xml]
    return p.select(
        *keep,
        F.col("_r._filepath").alias("filepath"),
        arr("format").alias("format"),
        arr("title").alias("title"),
        arr("accessRights").alias("access_rights"),
        arr("accessibleToRights").alias("accessible_to"),
        arr("visibleToRights").alias("visible_to"),
    )


# ------------------------------------------------------------------ S05
DDM_SCHEMA = Ty.StructType(
    [
        Ty.StructField(
            "profile",
            Ty.StructType(
                [Ty.StructField("audience", Ty.ArrayType(Ty.StringType())), Ty.StructField("created", Ty.ArrayType(Ty.StringType()))]
            ),
        ),
        Ty.StructField(
            "dcmiMetadata",
            Ty.StructType(
                [
                    Ty.StructField("rightsHolder", Ty.ArrayType(Ty.StringType())),
                    Ty.StructField(
                        "license",
                        Ty.ArrayType(Ty.StructType([Ty.StructField("_VALUE", Ty.StringType()), Ty.StructField("_type", Ty.StringType())])),
                    ),
                ]
            ),
        ),
    ]
)


def parse_dataset_metadata(raw: DataFrame, xml: str = "xml") -> DataFrame:
    """S05 on a column of ``dataset.xml`` documents: audiences, created, rights
    holders, licences with ``xsi:type``, and the raw namespace declarations."""
    p = raw.withColumn("_d", F.from_xml(F.col(xml), DDM_SCHEMA, {"ignoreNamespace": "true"}))
    empty = F.array().cast("array<string>")
    keep = [c for c in raw.columns if c != xml]
    return p.select(
        *keep,
        _xml_text(F.coalesce(F.col("_d.profile.audience"), empty)).alias("audience"),
        _xml_text(F.coalesce(F.col("_d.profile.created"), empty)).alias("created"),
        _xml_text(F.coalesce(F.col("_d.dcmiMetadata.rightsHolder"), empty)).alias("rights_holder"),
        F.transform(
            F.coalesce(F.col("_d.dcmiMetadata.license"), F.array().cast("array<struct<_VALUE:string,_type:string>>")),
            lambda x: F.struct(jtrim(F.coalesce(x["_VALUE"], F.lit(""))).alias("text"), x["_type"].alias("xsi_type")),
        ).alias("license"),
        F.array_join(F.regexp_extract_all(F.col(xml), F.lit(r"""(xmlns:[^\s=]+\s*=\s*(?:"[^"]*"|'[^']*'))"""), 1), " ").alias("ns_decls"),
    )


def scan_dataset_metadata(spark: SparkSession, root: str, files: str | list[str] | None = None) -> DataFrame:
    """S05 on files: every ``metadata/dataset.xml`` of the corpus."""
    raw = spark.read.text(files or f"{root}/*/*/metadata/dataset.xml", wholetext=True).select(
        _deposit_of(_file_path(), root).alias("deposit_id"), _bag_of(_file_path(), root).alias("bag"), F.col("value").alias("xml")
    )
    return parse_dataset_metadata(raw)


# ------------------------------------------------------------------ S06
AGREEMENTS_SCHEMA = (
    "depositAgreement array<struct<signerId: array<struct<_VALUE: string, `_easy-account`: string, _email: string>>>>, _corrupt string"
)


def _anywhere(xml: str, name: str) -> Column:
    """Text of the first element of this local name at any depth, the root included; null if there is none."""
    found = f'//*[local-name()="{name}"]'
    return F.when(F.expr(f"xpath_boolean({xml}, 'boolean({found})')"), F.expr(f"xpath_string({xml}, '({found})[1]')"))


def parse_agreements(raw: DataFrame, xml: str = "xml") -> DataFrame:
    """S06 on a column of agreement documents: parse with a corrupt-record
    column, so an unparseable document gives ``is_valid`` false instead of failing.

    The acceptance and the privacy statement are sought among all descendants, the signer
    is the first ``signerId`` of a ``depositAgreement`` that is a child of the root.  A
    document with a document type is not valid: Spark's XML readers resolve none."""
    parsed = raw.withColumn(
        "a",
        F.from_xml(
            xml,
            AGREEMENTS_SCHEMA,
            {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt", "ignoreNamespace": "true", "ignoreSurroundingSpaces": "false"},
        ),
    )
    well_formed = F.col(xml).rlike(r"(?s)^\s*(<\?xml[^>]*\?>)?\s*<") & ~F.col(xml).contains("<!DOCTYPE")
    valid = F.coalesce(F.col("a").isNotNull() & F.col("a._corrupt").isNull() & well_formed, F.lit(False))
    signer = F.when(valid, F.try_element_at(F.flatten(F.transform("a.depositAgreement", lambda d: F.coalesce(d["signerId"], F.array()))), F.lit(1)))
    keep = [c for c in raw.columns if c != xml]
    return parsed.select(
        *keep,
        valid.alias("is_valid"),
        F.when(~valid, F.lit("the document is not well-formed XML")).alias("parse_error"),
        F.when(valid, _anywhere(xml, "depositAgreementAccepted")).alias("accepted_text"),
        F.when(valid, _anywhere(xml, "containsPrivacySensitiveData")).alias("privacy_text"),
        F.when(signer.isNotNull(), F.coalesce(signer["_VALUE"], F.lit(""))).alias("name"),
        signer["_easy-account"].alias("account"),
        signer["_email"].alias("email"),
    )


def scan_agreements(spark: SparkSession, root: str, files: str | list[str] | None = None) -> DataFrame:
    """Agreements per deposit; *missing* (no row) is told apart from *not
    parseable* (``is_valid`` false) — the document is read raw (no trimming)."""
    raw = spark.read.text(files or f"{root}/*/*/metadata/depositor-info/agreements.xml", wholetext=True).select(
        _deposit_of(_file_path(), root).alias("deposit_id"), _bag_of(_file_path(), root).alias("bag"), F.col("value").alias("xml")
    )
    return parse_agreements(raw)


# ------------------------------------------------------------------ S07
def scan_messages(spark: SparkSession, root: str, files: str | list[str] | None = None) -> DataFrame:
    """Message from the depositor as UTF-8 whole text (missing -> no row)."""
    return spark.read.text(files or f"{root}/*/*/metadata/depositor-info/message-from-depositor.txt", wholetext=True).select(
        _deposit_of(_file_path(), root).alias("deposit_id"), _bag_of(_file_path(), root).alias("bag"), F.col("value").alias("text")
    )


def read_whole_texts(spark: SparkSession, path: str, key: str = "deposit_id", written_by_spark: bool = True) -> DataFrame:
    """S07 on a folder partitioned by ``<key>=<id>``: each file read whole as
    UTF-8 (a small per-deposit document).  Spark's text writer ends every row
    with one line break; that one is removed again."""
    df = spark.read.text(path, wholetext=True)
    text = F.regexp_replace(F.col("value"), r"\n$", "") if written_by_spark else F.col("value")
    return df.select(F.col(key).cast("bigint").alias(key), text.alias("text"))


def scan_bag_documents(listing: DataFrame) -> DataFrame:
    """(deposit_id, bag, name, length) of the five bag documents that exist, read off the listing."""
    entries = L.in_bags(listing).where(~F.col("is_dir") & F.col("path").isin(*[name for name, _ in K.BAG_DOCUMENTS]))
    return entries.join(L.bag_dirs(listing), ["deposit_id", "bag"]).select("deposit_id", "bag", F.col("path").alias("name"), F.col("size").alias("length"))


def scan_contents(spark: SparkSession, root: str, files: list[str]) -> DataFrame:
    """(deposit_id, name, content) of bag documents; a file that is not read as long as it is listed fails the job."""
    df = spark.read.format("binaryFile").load(files)
    whole = F.when(F.octet_length("content") == F.col("length"), F.col("content")).otherwise(F.raise_error(F.concat(F.lit("cut short: "), F.col("path"))).cast("binary"))
    return df.select(_deposit_of(F.col("path"), root).alias("deposit_id"), _in_bag(F.col("path"), root).alias("name"), whole.alias("content"))


# ------------------------------------------------------------------ S08
URI_LINE = r"^(.*)\s+(.*)$"


def parse_uri_mapping(lines: DataFrame) -> DataFrame:
    """``<path><whitespace><uri>`` — the *last* whitespace run splits
    (greedy ``^(.*)\\s+(.*)$``), both sides trimmed; empty lines skipped; a line
    without whitespace is bad; the last duplicate path wins (A02).

    Returns (deposit_id, path, uri, bad_lines) with ``bad_lines`` the number of
    bad lines of the deposit's mapping file (any bad line fails the file).
    """
    parsed = lines.where(F.col("line") != "").select(
        "deposit_id",
        "line_no",
        F.col("line").rlike(URI_LINE).alias("ok"),
        jtrim(F.regexp_extract("line", URI_LINE, 1)).alias("path"),
        jtrim(F.regexp_extract("line", URI_LINE, 2)).alias("uri"),
    )
    from bagyard.operators.aggs import last_by

    good = last_by(parsed.where("ok"), ["deposit_id", "path"], "line_no", ["uri"])
    bad = parsed.where(~F.col("ok")).groupBy("deposit_id").agg(F.count(F.lit(1)).alias("bad_lines"))
    return good.join(bad, "deposit_id", "left").select(
        "deposit_id", "path", "uri", F.coalesce(F.col("bad_lines"), F.lit(0)).cast("bigint").alias("bad_lines")
    )


def bad_uri_mapping_lines(lines: DataFrame) -> DataFrame:
    """(deposit_id, line) of the lines that fail a deposit's mapping file, also
    of files without a good line."""
    return lines.where((F.col("line") != "") & ~F.col("line").rlike(URI_LINE)).select("deposit_id", "line")


def uri_mapping_lines(spark: SparkSession, root: str, file_name: str = "uri-mapping.txt", files: str | list[str] | None = None) -> DataFrame:
    """Lines of one mapping file per deposit, read line by line (splittable)."""
    return spark.read.text(files or f"{root}/*/{file_name}").select(
        _deposit_of(_file_path(), root).alias("deposit_id"),
        _line_order().alias("line_no"),
        F.col("value").alias("line"),
    )


def scan_uri_mapping(spark: SparkSession, root: str, file_name: str = "uri-mapping.txt") -> DataFrame:
    """S08 on files; the in-file order key drives last-wins."""
    return parse_uri_mapping(uri_mapping_lines(spark, root, file_name))


# ------------------------------------------------------------------ S09
HEADER_COMMA = r',(?=(?:[^"]*"[^"]*")*[^"]*$)'  # a comma outside quotes


def scan_request_headers(spark: SparkSession, csv: str | list[str]) -> DataFrame:
    """Header cells of many request CSVs as (file_id, col_pos, column) for U03.
    Only the first split of each file is considered, and the first line is
    its smallest in-file order key (a partial aggregate, no whole-file read)."""
    lines = spark.read.text(csv).select(
        F.col("_metadata.file_path").alias("file_id"), _line_order().alias("o"), F.col("value")
    ).where(F.col("o.block") == 0)
    first = lines.groupBy("file_id").agg(F.min_by("value", "o").alias("header"))
    cells = F.posexplode(F.split(jtrim(F.regexp_replace("header", "^\ufeff", "")), HEADER_COMMA))
    return first.select("file_id", cells.alias("col_pos", "column")).select(
        "file_id", "col_pos", F.replace(F.regexp_replace(jtrim(F.col("column")), r'^"|"$', ""), F.lit('""'), F.lit('"')).alias("column")
    )


def header_signatures(headers: DataFrame, required: list[str] | None = None) -> DataFrame:
    """Files grouped by what their header says: (file_id, signature, n_columns, positions, missing, ignored).

    ``signature`` is the lower-cased column list; ``positions`` has, for each required
    column in order, its first place in the file (-1 if it lacks it), ``missing`` and
    ``ignored`` are U03's findings.  One aggregate over the few header cells of each file."""
    req = [r.lower() for r in (required or K.REQUEST_OPTIONS)]
    cell = F.lower("column")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("col_pos", cell.alias("c")))), lambda x: x["c"])
    files = headers.groupBy("file_id").agg(ordered.alias("cells"))
    positions = F.array(*[F.array_position("cells", r).cast("int") - 1 for r in req])
    names = F.array(*[F.lit(r) for r in req])
    return files.select(
        "file_id",
        F.array_join("cells", ",").alias("signature"),
        F.size("cells").alias("n_columns"),
        positions.alias("positions"),
        F.array_except(names, F.col("cells")).alias("missing"),
        F.array_except(F.col("cells"), names).alias("ignored"),
    )


def scan_request_batch(spark: SparkSession, csv: str | list[str], id_column: str | None = None) -> tuple[DataFrame, DataFrame]:
    """S09 + U03 over a batch of RFC-4180 request CSVs, each with a column order of its own.

    Returns ``(requests, files)``.  ``files`` has one row per file: its signature, the
    missing and the ignored columns, and ``accepted`` (no required column is missing).
    ``requests`` has the rows of the accepted files, every cell by its own file's header,
    matched case-insensitively; unknown columns are ignored and empty cells are ''.

    All files are read in one scan whose columns are places, not names, so any number of
    signatures costs one pass: a row picks its cells by the positions of its file's
    signature (one small row per file).  Each file's header line is skipped by the reader.
    Cells may hold line breaks, so a file is parsed by one task (``multiLine``); the unit
    of parallelism is the file.  ``id_column`` names a further column that identifies a
    row in the outcome log; without one, rows are numbered."""
    options = K.REQUEST_OPTIONS + ([id_column] if id_column else [])
    found = header_signatures(scan_request_headers(spark, csv), options)
    missing = F.array_except("missing", F.array(F.lit(id_column))) if id_column else F.col("missing")
    files = cut_lineage(found.withColumn("missing", missing).withColumn("accepted", F.size("missing") == 0), "request_files")
    width = files.agg(F.max("n_columns")).first()[0]
    names = [o.replace("-", "_") for o in K.REQUEST_OPTIONS]
    if not width:  # no file with a header
        return spark.createDataFrame([], "request_id bigint, " + ", ".join(f"{n} string" for n in names)), files
    places = [f"c{i}" for i in range(width)]
    rows = (
        spark.read.schema(", ".join(f"{c} string" for c in places))
        .option("header", "true").option("enforceSchema", "true").option("multiLine", "true")
        .option("escape", '"').option("quote", '"').option("mode", "PERMISSIVE")
        .option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false")
        .csv(csv)
    )
    rows = rows.select(F.col("_metadata.file_path").alias("file_id"), F.array(*places).alias("cells"))
    rows = rows.join(files.where("accepted").select("file_id", "positions"), "file_id")
    cell = lambda i: F.coalesce(F.get("cells", F.get("positions", F.lit(i))), F.lit(""))
    number = cell(len(names)).try_cast("bigint") if id_column else F.monotonically_increasing_id()
    return rows.select(number.alias("request_id"), *[cell(i).alias(n) for i, n in enumerate(names)]), files


def scan_item_requests(spark: SparkSession, csv_path: str | list[str]) -> DataFrame:
    """The requests of the accepted files of a batch."""
    return scan_request_batch(spark, csv_path)[0]


# ------------------------------------------------------------------ S10, S13
def scan_folder_catalog(
    df_or_spark,
    jdbc_url: str | None = None,
    table: str = "easy_folders",
    props: dict | None = None,
    num_partitions: int = 64,
    partition_column: str | None = None,
    bounds: tuple[int, int] | None = None,
    predicates: list[str] | None = None,
) -> DataFrame:
    """The existing-folder catalogue, one scan (not one statement per
    ancestor level).  Pass a DataFrame (e.g. a Parquet export), or a session
    and a JDBC URL.

    A JDBC read is always split over ``num_partitions`` tasks, never pulled
    through one: by a numeric ``partition_column`` with ``bounds``, by explicit
    ``predicates``, or, for PostgreSQL, by a hash of the pid."""
    if isinstance(df_or_spark, DataFrame):
        src = df_or_spark
    else:
        reader = df_or_spark.read
        if partition_column and bounds:
            src = reader.jdbc(jdbc_url, table, column=partition_column, lowerBound=bounds[0], upperBound=bounds[1],
                              numPartitions=num_partitions, properties=props or {})
        else:
            if predicates is None:
                if not jdbc_url.startswith("jdbc:postgresql:"):
                    raise ValueError("give partition_column + bounds or predicates to split the JDBC read")
                predicates = [f"abs(hashtext(pid)) % {num_partitions} = {i}" for i in range(num_partitions)]
            src = reader.jdbc(jdbc_url, table, predicates=predicates, properties=props or {})
    return src.select("pid", "path", "dataset_sid", F.regexp_replace("path", r"/$", "").alias("norm_path"))


def object_catalog(df: DataFrame) -> DataFrame:
    """All known object ids (paging disappears)."""
    return df.select("pid").distinct()


# ------------------------------------------------------------------ S11
def discipline_pairs(pid_xml: DataFrame) -> DataFrame:
    """Relationship XML -> ``setSpec`` -> segment after the last ':' -> (audience, pid)."""
    spec = F.xpath_string(F.col("xml"), F.lit('//*[local-name()="Description"]/*[local-name()="setSpec"]'))
    return pid_xml.select(F.element_at(F.split(spec, ":", -1), -1).alias("audience"), "pid")


def discipline_catalog(pid_xml: DataFrame) -> DataFrame:
    """S11 + A08: audience code -> discipline pid, greatest pid wins."""
    from bagyard.operators.aggs import catalog

    return catalog(discipline_pairs(pid_xml), "audience", "pid")


# ------------------------------------------------------------------ S12
def license_catalog(spark: SparkSession, properties_path: str, lic_dir: str | None = None, templates: DataFrame | None = None) -> DataFrame:
    """``uri=file`` properties (``\\:`` / ``\\=`` escapes in keys, ``#``/``!``
    comments) joined with the template contents — read from ``lic_dir`` with
    ``binaryFile``, or given as a ``(file_name, content)`` table."""
    kv = r"^((?:[^=:\\\s]|\\.)+)\s*[=:]\s*(.*)$"
    props = spark.read.text(properties_path).where(~F.col("value").rlike(r"^\s*([#!].*)?$"))
    pairs = props.select(
        F.regexp_replace(F.regexp_extract(jtrim(F.col("value")), kv, 1), r"\\(.)", "$1").alias("uri"),
        jtrim(F.regexp_extract(jtrim(F.col("value")), kv, 2)).alias("file_name"),
    )
    if templates is None:
        files = spark.read.format("binaryFile").load(lic_dir.rstrip("/") + "/*").select(
            F.substring_index(F.col("path"), "/", -1).alias("file_name"), F.col("content").alias("content_bytes")
        )
        return pairs.join(files, "file_name", "left").select(
            "uri", "file_name", F.decode(F.col("content_bytes"), "UTF-8").alias("content"), "content_bytes"
        )
    return pairs.join(templates.groupBy("file_name").agg(F.min("content").alias("content")), "file_name", "left").select("uri", "file_name", "content")

"""Bindings of the engine's input tables onto the driver's test parquet.

Every binding is a projection / join of the given tables, so its size grows
with the scale factor; the same bindings are written a second time, in SQL,
in :mod:`bagyard.sources.testdata_sql` for the DuckDB oracle.

Engine tables produced here (see SURVEY §1.3):
deposits, payload_keys/payload_files, file_metadata, manifest_lines,
payload_manifest, external_uris, payload_uris, audiences, discipline_xml,
license_catalog, license_elements, ns_decls, rights_holders, created,
agreement_signers, agreements, messages, bag_documents, deposit_dirs,
item_requests, folder_catalog, object_catalog, header_columns, uri_lines,
collision_items.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from bagyard import constants as K
from bagyard.functions import paths as P

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"
SF1 = "/root/testdata/sf0.1"


_RELATIONS: dict[tuple[int, str], DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """The parquet relation of a test table.  The lazy relation (file listing
    and footer schema, no data) is reused per session and path, so the many
    bindings over one table do not list and infer it again each time."""
    path = f"{sf_dir}/{name}.parquet"
    key = (id(spark._jsparkSession), path)
    df = _RELATIONS.get(key)
    if df is None or df.sparkSession._jsparkSession is not spark._jsparkSession:
        df = spark.read.parquet(path)
        _RELATIONS[key] = df
    return df


def _empty_str_array() -> Column:
    return F.array().cast("array<string>")


def _arr(*values: str) -> Column:
    return F.array(*[F.lit(v) for v in values])


# ------------------------------------------------------------------ deposits
def deposits(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    categories = F.array(*[F.lit(c) for c, _ in K.ACCESS_CATEGORY_RIGHTS])
    return o.select(
        k.alias("deposit_id"),
        F.when(k % 103 == 0, F.lit("  ")).when(k % 101 != 0, F.concat(F.lit("user"), F.col("o_custkey"))).alias("owner_id"),
        F.col("o_orderdate").alias("submission_ts"),
        F.when(k % 97 == 0, "UNKNOWN")
        .when(k % 89 == 0, "MAINTENANCE")
        .when(F.col("o_orderstatus") == "F", "PUBLISHED")
        .when(F.col("o_orderstatus") == "O", "SUBMITTED")
        .otherwise("DRAFT")
        .alias("state"),
        F.when(k % 53 != 0, F.concat(F.lit("urn:nbn:nl:ui:13-"), k)).alias("urn"),
        F.when(k % 10 != 0, F.concat(F.lit("10.1234/set-"), k)).alias("doi"),
        (k % 4 == 1).alias("other_access_doi"),
        F.when(k % 41 == 0, "TAPE").when(k % 3 == 1, "DATAVAULT").otherwise("EASY").alias("archive"),
        (k % 4 != 0).alias("include_bag_metadata"),
        (k % 11 == 0).alias("skip_payload"),
        F.when(k % 2 == 0, F.concat(F.lit("Priority "), F.col("o_orderpriority"))).alias("extra_description"),
        F.concat(F.lit("Deposit "), k, F.lit(" "), F.col("o_orderpriority")).alias("title"),
        F.element_at(categories, (F.col("o_custkey") % 8 + 1).cast("int")).alias("access_category"),
    )


# ------------------------------------------------------------------ payload
def payload_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One payload file per distinct (l_orderkey, l_linenumber)."""
    li = table(spark, sf_dir, "lineitem")
    g = li.groupBy(F.col("l_orderkey").alias("deposit_id"), F.col("l_linenumber").alias("line_no")).agg(
        F.min("l_returnflag").alias("rf"), F.min("l_linestatus").alias("ls"), F.min("l_quantity").alias("q")
    )
    return g.select(
        "deposit_id",
        "line_no",
        F.concat(F.lit("data/"), "rf", F.lit("/"), "ls", F.lit("/f."), "line_no", F.lit(".bin")).alias("path"),
        F.floor("q").cast("bigint").alias("size"),
    )


def payload_files(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    return (keys if keys is not None else payload_keys(spark, sf_dir)).select("deposit_id", "path", "size", F.lit(False).alias("is_dir"))


def payload_dirs(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """Directories of the payload: those of the files, three empty folders in every sixth
    deposit, two of them with one SDO name, and ``data`` itself; a deposit without files has an empty ``data`` if its key is even."""
    files = payload_files(spark, sf_dir, keys)
    above = files.select("deposit_id", "path", F.explode(P.ancestor_depths("path")).alias("depth")).select("deposit_id", P.ancestor_at("path", "depth").alias("path"))
    k = F.col("o_orderkey")
    own = F.concat(F.when(k % 2 == 0, _arr("data")).otherwise(_empty_str_array()),
                   F.when(k % 6 == 0, _arr("data/empty.d", "data/empty.d/deep", "data/empty_d")).otherwise(_empty_str_array()))
    return above.unionByName(table(spark, sf_dir, "orders").select(k.alias("deposit_id"), F.explode(own).alias("path"))).distinct()


def payload_listing(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """Files and directories of the payload, as S02 gives them."""
    dirs = payload_dirs(spark, sf_dir, keys).select("deposit_id", "path", F.lit(None).cast("bigint").alias("size"), F.lit(True).alias("is_dir"))
    return payload_files(spark, sf_dir, keys).unionByName(dirs)


def file_metadata(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """One ``files.xml`` record per lineitem row; paths repeat over records."""
    li = table(spark, sf_dir, "lineitem")
    keys = (keys if keys is not None else payload_keys(spark, sf_dir)).select(
        F.col("deposit_id").alias("l_orderkey"), F.col("line_no").alias("l_linenumber"), F.col("path")
    )
    r = li.join(keys, ["l_orderkey", "l_linenumber"])
    p, s = F.col("l_partkey"), F.col("l_suppkey")
    fmt = (
        F.when(p % 13 == 0, _empty_str_array())
        .when(p % 17 == 0, _arr("application/pdf", "text/plain"))
        .when(p % 19 == 0, _arr(""))
        .otherwise(F.array(F.element_at(_arr("text/plain", "application/pdf", "image/png", "text/csv"), (p % 4 + 1).cast("int"))))
    )
    title = F.when(s % 3 == 0, _empty_str_array()).otherwise(F.array(F.concat(F.lit("Title "), p)))
    access = (
        F.when(s % 5 == 0, _empty_str_array())
        .when(s % 5 == 1, _arr("ANONYMOUS"))
        .when(s % 5 == 2, _arr("KNOWN"))
        .when(s % 5 == 3, _arr("bogus"))
        .otherwise(_arr("RESTRICTED_GROUP"))
    )
    accessible = F.when(p % 6 == 0, _arr("NONE")).when(p % 6 == 1, _arr("RESTRICTED_REQUEST")).otherwise(_empty_str_array())
    visible = (
        F.when(p % 7 == 0, _arr("KNOWN")).when(p % 7 == 1, _arr("invalid")).when(p % 7 == 2, _arr("NONE")).otherwise(_empty_str_array())
    )
    return r.select(
        F.col("l_orderkey").alias("deposit_id"),
        F.col("path").alias("filepath"),
        fmt.alias("format"),
        title.alias("title"),
        access.alias("access_rights"),
        accessible.alias("accessible_to"),
        visible.alias("visible_to"),
    )


def _doc_path(d="documents") -> Column:
    return F.concat(F.lit("data/"), F.col("source"), F.lit("/"), F.col("lang"), F.lit("/doc."), F.col("doc_id"), F.lit(".txt"))


def manifest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw manifest lines (deposit_id, algorithm, line_no, raw) from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    d = F.col("doc_id")
    checksum = F.when(d % 61 == 0, F.lit("a")).otherwise(F.sha1(F.col("text")))
    sep = F.when(d % 3 == 0, F.lit("  ")).when(d % 3 == 1, F.lit("\t")).otherwise(F.lit(" "))
    base = docs.select(
        (d % 7).alias("deposit_id"),
        F.when(d % 2 == 0, "sha1").otherwise("md5").alias("algorithm"),
        d.alias("line_no"),
        F.when(d % 50 == 0, checksum).otherwise(F.concat(checksum, sep, _doc_path())).alias("raw"),
    )
    dup = docs.join(labels, "doc_id").select(
        (d % 7).alias("deposit_id"),
        F.when(d % 2 == 0, "sha1").otherwise("md5").alias("algorithm"),
        (d + 1000000).alias("line_no"),
        F.concat(F.sha1(F.concat(F.col("text"), F.lit("#"), F.col("quality"))), F.lit(" "), _doc_path()).alias("raw"),
    )
    return base.unionByName(dup)


def payload_manifest(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """sha1 manifest of the payload: every file except line 3; a bad line in some deposits."""
    k = (keys if keys is not None else payload_keys(spark, sf_dir)).where(F.col("line_no") != 3)
    checksum = F.when((F.col("deposit_id") % 83 == 0) & (F.col("line_no") == 1), F.lit("f")).otherwise(
        F.sha1(F.concat(F.col("deposit_id"), F.col("path")))
    )
    return k.select(
        "deposit_id",
        F.lit("sha1").alias("algorithm"),
        "line_no",
        F.concat(checksum, F.lit(" "), F.col("path")).alias("raw"),
    )


def external_uris(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = table(spark, sf_dir, "labels")
    d = F.col("doc_id")
    return docs.join(labels, "doc_id").select(
        (d % 7).alias("deposit_id"),
        F.when(F.col("quality") == 1, _doc_path()).otherwise(F.concat(F.lit("data/missing/doc."), d, F.lit(".bin"))).alias("path"),
        F.concat(F.lit("https://store.example.org/"), d).alias("uri"),
    )


def payload_uris(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    k = keys if keys is not None else payload_keys(spark, sf_dir)
    dep = F.col("deposit_id")
    sel = k.where((dep % 5 == 0) & ((F.col("line_no") != 3) | (dep % 25 == 0)))
    return sel.select(
        "deposit_id",
        "path",
        F.when(dep % 35 == 0, F.concat(F.lit("ftp://store.example.org/"), F.col("path")))
        .otherwise(F.concat(F.lit("http://store.example.org/"), F.col("path")))
        .alias("uri"),
    )


# ------------------------------------------------------------------ disciplines
def audiences(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    c = table(spark, sf_dir, "customer")
    first = o.join(c, o.o_custkey == c.c_custkey).select(
        F.col("o_orderkey").alias("deposit_id"), F.lit(1).alias("pos"), F.col("c_mktsegment").alias("audience")
    )
    c2 = c.select(F.col("c_custkey").alias("k2"), F.col("c_mktsegment").alias("seg2"))
    second = (
        o.where(F.col("o_orderkey") % 4 == 0)
        .join(c2, F.col("o_custkey") + 1 == F.col("k2"))
        .select(F.col("o_orderkey").alias("deposit_id"), F.lit(2).alias("pos"), F.col("seg2").alias("audience"))
    )
    return first.unionByName(second)


def discipline_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The disciplines that the jobs know: one segment is unknown, so that audiences miss."""
    return _discipline_xml(table(spark, sf_dir, "customer").where(F.col("c_mktsegment") != "HOUSEHOLD"))


def all_disciplines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _discipline_xml(table(spark, sf_dir, "customer"))


def _discipline_xml(c: DataFrame) -> DataFrame:
    pid = F.concat(F.lit("easy-discipline:"), F.col("c_custkey"))
    xml = F.concat(
        F.lit('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#"><rdf:Description rdf:about="info:fedora/'),
        pid,
        F.lit('"><setSpec xmlns="http://www.openarchives.org/OAI/2.0/">a:b:'),
        F.col("c_mktsegment"),
        F.lit("</setSpec></rdf:Description></rdf:RDF>"),
    )
    return c.select(pid.alias("pid"), xml.alias("xml"))


# ------------------------------------------------------------------ licences
def license_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The licences that the jobs know: every other page, so that licence URIs miss."""
    return _license_catalog(table(spark, sf_dir, "pages").where(F.col("page_id") % 2 == 0))


def all_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _license_catalog(table(spark, sf_dir, "pages"))


def _license_catalog(p: DataFrame) -> DataFrame:
    m8 = F.col("page_id") % 8
    ext = F.when(m8 <= 1, ".txt").when(m8 <= 3, ".html").when(m8 <= 5, ".pdf").otherwise(".doc")
    uri = F.regexp_replace(F.regexp_replace(F.col("url"), r"^https:", "http:"), r"/$", "")
    return p.select(
        uri.alias("uri"),
        F.concat(F.lit("license-"), F.col("page_id"), ext).alias("file_name"),
        F.concat(F.lit("Licensed by <rightsHolder> in <year>; see "), F.col("url")).alias("content"),
    )


def license_elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "pages")
    m5 = F.col("page_id") % 5
    xsi = F.when(m5 == 0, "dcterms:URI").when(m5 == 1, "x:URI").when(m5 == 2, "URI").when(m5 == 3, "a:b:c")
    first = p.select(
        (F.col("page_id") * 3).alias("deposit_id"), F.lit(1).alias("pos"), F.col("url").alias("text"), xsi.alias("xsi_type")
    )
    second = p.where(F.col("page_id") % 37 == 0).select(
        (F.col("page_id") * 3).alias("deposit_id"),
        F.lit(2).alias("pos"),
        F.concat(F.col("url"), F.lit("#2")).alias("text"),
        F.lit(None).cast("string").alias("xsi_type"),
    )
    return first.unionByName(second)


def ns_decls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Namespace declarations of each deposit's ``dataset.xml`` root, as raw text."""
    p = table(spark, sf_dir, "pages")
    m3 = F.col("page_id") % 3
    decl = (
        F.when(m3 == 0, F.lit('xmlns:dcterms="http://purl.org/dc/terms/" xmlns:ddm="http://easy.dans.knaw.nl/schemas/md/ddm/"'))
        .when(m3 == 1, F.lit('xmlns:dcterms="http://purl.org/dc/elements/1.1/" xmlns:x="http://purl.org/dc/terms/"'))
        .otherwise(F.lit('xmlns:x="http://example.org/x/"'))
    )
    return p.select((F.col("page_id") * 3).alias("deposit_id"), decl.alias("ns_decls"))


def rights_holders(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations")
    return cv.select(
        (F.col("conv_id") * 3).alias("deposit_id"),
        F.col("turn").alias("pos"),
        F.concat(F.upper("role"), F.lit(" "), F.col("conv_id"), F.lit("."), F.col("turn")).alias("rights_holder"),
    )


def created(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    first = o.where(k % 37 != 0).select(
        k.alias("deposit_id"),
        F.lit(1).alias("pos"),
        F.when(k % 29 == 0, F.lit("not-a-date"))
        .when(k % 43 == 0, F.concat(F.substring(day, 1, 5), F.lit("13-45")))
        .when(k % 7 == 0, F.concat(day, F.lit("T23:30:00-05:00")))
        .when(k % 5 == 0, F.substring(day, 1, 7))
        .otherwise(day)
        .alias("created"),
    )
    second = o.where(k % 31 == 0).select(k.alias("deposit_id"), F.lit(2).alias("pos"), F.concat(day, F.lit("T12:00:00+01:00")).alias("created"))
    return first.unionByName(second)


# ------------------------------------------------------------------ depositor info
def agreement_signers(spark: SparkSession, sf_dir: str) -> DataFrame:
    cv = table(spark, sf_dir, "conversations")
    b = (F.col("conv_id") + F.col("turn")) % 8
    return cv.select(
        (F.col("conv_id") * 3).alias("deposit_id"),
        F.col("turn").alias("pos"),
        F.when(b.isin(1, 3, 5, 7), F.concat(F.lit("Signer "), F.col("conv_id"))).otherwise(F.lit("")).alias("name"),
        F.when(b.isin(2, 3, 6, 7), F.concat(F.lit("acct"), F.col("conv_id"))).when(b == 4, F.lit("  ")).alias("account"),
        F.when(b >= 4, F.concat(F.lit("c"), F.col("conv_id"), F.lit("@example.org"))).alias("email"),
    )


def agreements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One agreements document per conversation (turn 0), parsed into its facts."""
    cv = table(spark, sf_dir, "conversations").where(F.col("turn") == 0)
    c = F.col("conv_id")
    m5, m4 = c % 5, c % 4
    return cv.select(
        (c * 3).alias("deposit_id"),
        (c % 9 != 4).alias("is_valid"),
        F.when(c % 9 == 4, F.lit("Content is not allowed in prolog.")).alias("parse_error"),
        F.when(m5 == 0, "true").when(m5 == 1, "Yes").when(m5 == 2, "false").when(m5 == 4, " on").alias("accepted_text"),
        F.when(m4 == 0, "true").when(m4 == 1, "no").when(m4 == 3, "ON").alias("privacy_text"),
    )


def messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One message per conversation: all its turns in order, a line each."""
    turns = F.array_sort(F.collect_list(F.struct("turn", "text")))
    cv = table(spark, sf_dir, "conversations").groupBy("conv_id").agg(F.array_join(F.transform(turns, lambda t: t["text"]), "\n").alias("text"))
    m6 = F.col("conv_id") % 6
    return cv.select(
        (F.col("conv_id") * 3).alias("deposit_id"),
        F.when(m6 == 0, F.lit("   \n\t "))
        .when(m6 == 1, F.concat(F.lit("<p>"), F.col("text"), F.lit("</p>")))
        .otherwise(F.col("text"))
        .alias("text"),
    )


# ------------------------------------------------------------------ bag layout
def bag_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(deposit_id, name, length) for the five bag documents that exist."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    names = F.array(*[F.lit(n) for n, _ in K.BAG_DOCUMENTS])
    e = o.select(k.alias("deposit_id"), F.col("o_totalprice"), F.posexplode(names).alias("idx", "name"))
    k = F.col("deposit_id")
    present = (
        F.when(F.col("idx") == 0, k % 67 != 0)
        .when(F.col("idx") == 1, k % 71 != 0)
        .when(F.col("idx") == 2, k % 2 == 0)
        .when(F.col("idx") == 3, k % 3 != 0)
        .otherwise(k % 4 != 0)
    )
    length = F.when((F.col("idx") == 2) & (k % 8 == 0), F.lit(0)).otherwise(F.floor("o_totalprice")).cast("bigint")
    return e.where(present).select("deposit_id", "name", length.alias("length"))


def bag_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What each bag document holds: (deposit_id, name, content)."""
    text = F.concat("name", F.lit(" of "), "deposit_id", F.lit(" \u00e9\n"), F.repeat(F.lit("x"), (F.col("length") % 100).cast("int")))
    return bag_documents(spark, sf_dir).select("deposit_id", "name", text.alias("content"))


def deposit_dirs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Children of each deposit directory (name, is_dir)."""
    o = table(spark, sf_dir, "orders")
    k = F.col("o_orderkey")
    bag = F.concat(F.lit("bag-"), F.lower(F.regexp_replace("o_orderpriority", r"[^A-Za-z0-9]", "")))
    rows = F.array(
        F.struct(F.lit(".git").alias("name"), F.lit(True).alias("is_dir")),
        F.struct(bag.alias("name"), F.lit(True).alias("is_dir")),
        F.struct(F.lit("deposit.properties").alias("name"), F.lit(False).alias("is_dir")),
        F.struct(F.when(k % 13 == 0, F.lit("bag-0")).otherwise(F.lit("README")).alias("name"), (k % 13 == 0).alias("is_dir")),
    )
    return o.select(k.alias("deposit_id"), F.inline(rows))


def property_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of each ``deposit.properties``: the owner in several notations, sometimes repeated or missing."""
    o = table(spark, sf_dir, "orders")
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    owner = (
        F.when(k % 17 == 0, F.lit("depositor.userIdentity=none"))
        .when(k % 3 == 0, F.concat(F.lit("depositor.userId=user"), c))
        .when(k % 3 == 1, F.concat(F.lit("  depositor.userId :\tuser"), c, F.lit("  ")))
        .otherwise(F.concat(F.lit("depositor.userId = user"), c))
    )
    rows = F.array(
        F.struct(F.lit(1).alias("line_no"), F.lit("state.label=SUBMITTED").alias("value")),
        F.struct(F.lit(2).alias("line_no"), owner.alias("value")),
        F.struct(F.lit(3).alias("line_no"), F.when((k % 5 == 0) & (k % 17 != 0), F.lit("depositor.userId=second")).alias("value")),
    )
    return o.select(k.alias("deposit_id"), F.inline(rows)).where(F.col("value").isNotNull())


def corpus_listing(spark: SparkSession, sf_dir: str, keys: DataFrame | None = None) -> DataFrame:
    """Every file and some directories below the deposits, as a storage lists them: the
    bag, a decoy in a second bag, ``.git``, bag documents and payload."""
    dirs = deposit_dirs(spark, sf_dir)
    top = dirs.select("deposit_id", F.col("name").alias("entry"), F.when(~F.col("is_dir"), F.lit(100)).cast("bigint").alias("size"), "is_dir")
    bag = dirs.where(F.col("is_dir") & (F.col("name") != ".git")).groupBy("deposit_id").agg(F.min("name").alias("bag"), F.max("name").alias("last"))
    within = F.concat("bag", F.lit("/"), "path").alias("entry")
    payload = payload_listing(spark, sf_dir, keys).join(bag, "deposit_id").select("deposit_id", within, "size", "is_dir")
    docs = bag_documents(spark, sf_dir).withColumnRenamed("name", "path").join(bag, "deposit_id").select("deposit_id", within, F.col("length").alias("size"), F.lit(False).alias("is_dir"))
    decoy = bag.where("bag <> last").select("deposit_id", F.concat("last", F.lit("/data/decoy.bin")).alias("entry"), F.lit(7).cast("bigint").alias("size"), F.lit(False).alias("is_dir"))
    git = bag.select("deposit_id", F.lit(".git/data/x.bin").alias("entry"), F.lit(9).cast("bigint").alias("size"), F.lit(False).alias("is_dir"))
    return top.unionByName(payload).unionByName(docs).unionByName(decoy).unionByName(git)


# ------------------------------------------------------------------ item requests
def _request_path() -> Column:
    e, u, t = F.col("event_id"), F.col("user_id"), F.col("event_type")
    m = e % 10
    leaf = F.concat(F.lit("e"), e, F.lit(".dat"))
    return (
        F.when(m == 0, leaf)
        .when(m <= 3, F.concat(t, F.lit("/"), leaf))
        .when(m <= 7, F.concat(t, F.lit("/k"), u % 5, F.lit("/"), leaf))
        .otherwise(F.concat(t, F.lit("/k"), u % 5, F.lit("/m"), e % 4, F.lit("/"), leaf))
    )


def item_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bulk item request rows as read from CSV: all cells are text, blank = ''."""
    ev = table(spark, sf_dir, "events")
    e, t = F.col("event_id"), F.col("event_type")
    blank_row = e % 97 == 0

    def cell(value: Column, blank_when: Column) -> Column:
        return F.when(blank_row | blank_when, F.lit("")).otherwise(value)

    size = F.floor(F.col("value") * 100).cast("bigint").cast("string")
    dsl = F.when(e % 26 == 0, F.concat(F.lit("ftp://files.example.org/"), e)).when(
        (e % 2 == 0) | (e % 43 == 0), F.concat(F.lit("http://files.example.org/"), e)
    )
    fil = F.when(((e % 2 == 1) | (e % 43 == 0)) & (e % 47 != 0), F.concat(F.lit("/staging/"), e, F.lit(".dat")))
    acc = F.when(t == "view", "ANONYMOUS").when(t == "click", "KNOWN").when(t == "purchase", "RESTRICTED_REQUEST").when(t == "signup", "").otherwise("anyone")
    vis = F.when(t == "view", "").when(t == "click", "NONE").when(t == "purchase", "ANONYMOUS").when(t == "signup", "Known").otherwise("RESTRICTED_GROUP")
    role = F.when(e % 53 == 0, "archivist").when(e % 5 == 0, "ARCHIVIST").when(e % 5 == 1, "").otherwise("DEPOSITOR")
    owner = F.when(e % 41 == 0, F.lit("  ")).otherwise(F.concat(F.lit(" owner"), F.col("user_id"), F.lit(" ")))
    return ev.select(
        e.alias("request_id"),
        cell(_request_path(), e % 29 == 0).alias("path_in_dataset"),
        cell(F.lit("application/octet-stream"), e % 31 == 0).alias("format"),
        cell(F.coalesce(dsl, F.lit("")), F.lit(False)).alias("datastream_location"),
        cell(size, e % 37 == 0).alias("size"),
        cell(F.coalesce(fil, F.lit("")), F.lit(False)).alias("file_location"),
        cell(F.concat(F.lit("easy-dataset:"), F.col("user_id")), e % 23 == 0).alias("dataset_id"),
        cell(acc, F.lit(False)).alias("accessible_to"),
        cell(vis, F.lit(False)).alias("visible_to"),
        cell(role, F.lit(False)).alias("creator_role"),
        cell(owner, F.lit(False)).alias("owner_id"),
    )


def write_request_files(spark: SparkSession, sf_dir: str, path: str) -> None:
    """The item requests as RFC-4180 CSV files below ``path/kind=<k>``, with their number in a column ``Request-Id``:
    kind 0 in the order of the options in mixed case with a column that no option knows, kind 1 backwards,
    kind 2 rotated and in upper case, and kind 3 (every twentieth request) without ``owner-id``."""
    reqs = item_requests(spark, sf_dir).withColumn("kind", F.when(F.col("request_id") % 20 == 0, 3).otherwise(F.col("request_id") % 3))
    cells = [(F.col(o.replace("-", "_")), o) for o in K.REQUEST_OPTIONS]
    number = (F.col("request_id"), "Request-Id")
    orders = [
        [(c, o.upper() if i % 2 == 0 else o) for i, (c, o) in enumerate(cells)] + [(F.lit('a "b", c'), "My, comment"), number],
        [number, *cells[::-1]],
        [(c, o.upper()) for c, o in cells[4:] + cells[:4]] + [number],
        [number, *cells[:-1]],
    ]
    for kind, columns in enumerate(orders):
        rows = reqs.where(F.col("kind") == kind).select(*[c.alias(o) for c, o in columns])
        rows.write.option("header", "true").option("escape", '"').option("ignoreLeadingWhiteSpace", "false").option("ignoreTrailingWhiteSpace", "false").csv(f"{path}/kind={kind}")


def folder_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existing folders: parents (or grand-parents) of every third request path, so that requests miss."""
    return _folder_catalog(table(spark, sf_dir, "events").where(F.col("event_id") % 3 == 0))


def all_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _folder_catalog(table(spark, sf_dir, "events"))


def _folder_catalog(ev: DataFrame) -> DataFrame:
    e = F.col("event_id")
    parts = F.split(_request_path(), "/")
    n = F.size(parts)
    depth = F.when((e % 6 == 0) & (n >= 3), n - 2).otherwise(n - 1)
    path = F.array_join(F.slice(parts, F.lit(1), depth), "/")
    return ev.where(n >= 2).select(
        F.concat(F.lit("easy-folder:"), e).alias("pid"),
        F.when(e % 9 == 3, F.concat(path, F.lit("/"))).otherwise(path).alias("path"),
        F.concat(F.lit("easy-dataset:"), F.col("user_id")).alias("dataset_sid"),
    )


def object_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known datasets: those of even users, so that requests miss."""
    return all_objects(spark, sf_dir, F.col("user_id") % 2 == 0)


def all_objects(spark: SparkSession, sf_dir: str, known: Column | None = None) -> DataFrame:
    ev = table(spark, sf_dir, "events")
    return (ev if known is None else ev.where(known)).select(F.concat(F.lit("easy-dataset:"), F.col("user_id")).alias("pid"))


def header_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(file_id, col_pos, column) header cells of one request CSV per user."""
    ev = table(spark, sf_dir, "events").select("user_id").distinct()
    names = F.array(*[F.lit(n) for n in K.REQUEST_OPTIONS])
    e = ev.select(F.col("user_id").alias("file_id"), F.posexplode(names).alias("col_pos", "opt"))
    m = F.col("file_id") + F.col("col_pos")
    column = F.when(m % 7 == 0, F.upper("opt")).when(m % 11 == 0, F.concat(F.col("opt"), F.lit("-x"))).otherwise(F.col("opt"))
    main = e.select("file_id", "col_pos", column.alias("column"))
    extra = ev.where(F.col("user_id") % 3 == 0).select(F.col("user_id").alias("file_id"), F.lit(10).alias("col_pos"), F.lit("comment").alias("column"))
    return main.unionByName(extra)


def uri_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines of an external-URI mapping file per deposit."""
    p = table(spark, sf_dir, "pages")
    i = F.col("page_id")
    m4, m10 = i % 4, i % 10
    blanks = F.when(m4 == 0, F.lit(" ")).when(m4 == 1, F.lit("\t")).when(m4 == 2, F.lit("   ")).otherwise(F.lit(" \t "))
    path = F.when(m10 == 7, F.lit("data/p dup")).otherwise(F.concat(F.lit("data/p "), i))
    line = (
        F.when(m10 == 9, F.concat(F.lit("data/p_"), i, F.col("url")))
        .when(m10 == 8, F.concat(path, blanks, F.col("url"), F.lit(" ")))
        .otherwise(F.concat(path, blanks, F.col("url")))
    )
    return p.select((i % 3).alias("deposit_id"), i.alias("line_no"), line.alias("line"))


def collision_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dataset-relative item paths with deliberate SDO-name collisions."""
    docs = table(spark, sf_dir, "documents")
    rel = F.concat(F.col("source"), F.lit("/"), F.col("lang"), F.lit("/doc."), F.col("doc_id"), F.lit(".txt"))
    base = docs.select((F.col("doc_id") % 7).alias("deposit_id"), rel.alias("path"))
    twin = docs.where(F.col("doc_id") % 5 == 0).select(
        (F.col("doc_id") % 7).alias("deposit_id"), F.translate(rel, ".", "_").alias("path")
    )
    return base.unionByName(twin)


def label_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return docs.select("doc_id", F.col("text").alias("label_text"))


# ------------------------------------------------------------------ documents rendered from the bindings
def _esc(c: Column) -> Column:
    from bagyard.functions.text import xml_escape

    return xml_escape(c)


def file_records_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Each ``files.xml`` record of :func:`file_metadata` rendered as its XML element."""
    md = file_metadata(spark, sf_dir)

    def elems(col: str, tag: str) -> Column:
        return F.array_join(F.transform(F.col(col), lambda x: F.concat(F.lit(f"<{tag}>"), _esc(x), F.lit(f"</{tag}>"))), "")

    xml = F.concat(
        F.lit('<file xmlns:dcterms="http://purl.org/dc/terms/" filepath="'), _esc(F.col("filepath")), F.lit('">'),
        elems("format", "dcterms:format"), elems("title", "dcterms:title"), elems("access_rights", "accessRights"),
        elems("accessible_to", "accessibleToRights"), elems("visible_to", "visibleToRights"), F.lit("</file>"),
    )
    return md.select("deposit_id", xml.alias("xml"))


def agreements_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``agreements.xml`` per deposit rendered from :func:`agreements` and its
    signers (a handful per deposit, in document order); unparseable ones are junk text."""
    sg = agreement_signers(spark, sf_dir)
    signer = F.concat(
        F.lit("<signerId"),
        F.when(F.col("account").isNotNull(), F.concat(F.lit(' easy-account="'), _esc(F.col("account")), F.lit('"'))).otherwise(F.lit("")),
        F.when(F.col("email").isNotNull(), F.concat(F.lit(' email="'), _esc(F.col("email")), F.lit('"'))).otherwise(F.lit("")),
        F.lit(">"), _esc(F.col("name")), F.lit("</signerId>"),
    )
    signers = sg.groupBy("deposit_id").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", signer.alias("x")))), lambda t: t["x"]), "").alias("signers")
    )
    a = agreements(spark, sf_dir).join(signers, "deposit_id", "left")

    def element(name: str, value: str) -> Column:
        e = F.concat(F.lit(f"<{name}>"), _esc(F.col(value)), F.lit(f"</{name}>"))
        return F.when(F.col(value).isNotNull(), F.concat(e, F.lit(f"<{name}>later</{name}>"))).otherwise(F.lit(""))

    outside = F.col("deposit_id") % 2 == 0  # the same facts at the root or further down, by deposit
    accepted, privacy = element("depositAgreementAccepted", "accepted_text"), element("containsPrivacySensitiveData", "privacy_text")
    doc = F.concat(
        F.lit('<?xml version="1.0" encoding="UTF-8"?><agreements xmlns="http://easy.dans.knaw.nl/schemas/bag/metadata/agreements/"><depositAgreement>'),
        F.coalesce(F.col("signers"), F.lit("")),
        F.when(~outside, F.concat(F.lit("<terms><a:part xmlns:a='urn:a'>"), accepted, F.lit("</a:part></terms>"))).otherwise(F.lit("")),
        F.lit("</depositAgreement>"),
        F.when(outside, accepted).otherwise(F.lit("")),
        F.when(outside, F.concat(F.lit("<statements><p>"), privacy, F.lit("</p></statements>"))).otherwise(privacy),
        F.lit("</agreements>"),
    )
    return a.select("deposit_id", F.when(F.col("is_valid"), doc).otherwise(F.lit("this is not xml")).alias("xml"))


def dataset_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One ``dataset.xml`` per deposit rendered from the audience, created,
    rights-holder, licence and namespace bindings (a handful of elements each)."""

    def listed(df: DataFrame, value: Column, name: str) -> DataFrame:
        ordered = F.array_sort(F.collect_list(F.struct(F.col("pos"), value.alias("x"))))
        return df.groupBy("deposit_id").agg(F.array_join(F.transform(ordered, lambda t: t["x"]), "").alias(name))

    aud = listed(audiences(spark, sf_dir), F.concat(F.lit("<ddm:audience>"), _esc(F.col("audience")), F.lit("</ddm:audience>")), "aud")
    cre = listed(created(spark, sf_dir), F.concat(F.lit("<ddm:created>"), _esc(F.col("created")), F.lit("</ddm:created>")), "cre")
    rh = listed(rights_holders(spark, sf_dir), F.concat(F.lit("<rightsHolder>"), _esc(F.col("rights_holder")), F.lit("</rightsHolder>")), "rh")
    lic_el = F.concat(
        F.lit("<license"),
        F.when(F.col("xsi_type").isNotNull(), F.concat(F.lit(' xsi:type="'), _esc(F.col("xsi_type")), F.lit('"'))).otherwise(F.lit("")),
        F.lit(">"), _esc(F.col("text")), F.lit("</license>"),
    )
    lic = listed(license_elements(spark, sf_dir), lic_el, "lic")
    d = (deposits(spark, sf_dir).select("deposit_id").join(aud, "deposit_id", "left").join(cre, "deposit_id", "left")
         .join(rh, "deposit_id", "left").join(lic, "deposit_id", "left").join(ns_decls(spark, sf_dir), "deposit_id", "left"))
    doc = F.concat(
        F.lit('<ddm:DDM xmlns:ddm="http://easy.dans.knaw.nl/schemas/md/ddm/" xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance" '),
        F.coalesce(F.regexp_replace(F.col("ns_decls"), r'xmlns:ddm="[^"]*"', ""), F.lit("")),
        F.lit("><ddm:profile>"), F.coalesce(F.col("cre"), F.lit("")), F.coalesce(F.col("aud"), F.lit("")),
        F.lit("</ddm:profile><ddm:dcmiMetadata>"), F.coalesce(F.col("rh"), F.lit("")), F.coalesce(F.col("lic"), F.lit("")),
        F.lit("</ddm:dcmiMetadata></ddm:DDM>"),
    )
    return d.select("deposit_id", doc.alias("xml"))

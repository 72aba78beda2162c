"""Document jobs (N01-N09): SDO tables, datastreams, relations, metadata
projections, and their rendering to documents with ``concat`` templates.

The tables are the primary output (normalised: one row per datastream /
relation with an ``ord`` column, T03); documents are rendered only at the sink,
from the same arrays.  ``to_xml`` cannot print prefixed element names, hence concat.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagyard import constants as K
from bagyard.functions import paths as P
from bagyard.functions.dates import iso_timestamp
from bagyard.functions.text import fedora_object, xml_escape
from bagyard.operators.aggs import datastream_rows
from bagyard.operators.checks import fox_label

DS_COLS = ["deposit_id", "sdo_name", "ord", "ds_id", "content_file", "ds_location", "label", "control_group", "mime_type", "checksum_type", "checksum"]
REL_COLS = ["deposit_id", "sdo_name", "ord", "predicate", "object_kind", "object", "is_literal"]


def _rel(ord_: int | Column, predicate: str, kind: str | Column, obj: Column, literal: bool | None = None) -> Column:
    return F.struct(
        (F.lit(ord_) if isinstance(ord_, int) else ord_).cast("int").alias("ord"),
        F.lit(predicate).alias("predicate"),
        (F.lit(kind) if isinstance(kind, str) else kind).alias("object_kind"),
        obj.cast("string").alias("object"),
        F.lit(literal).cast("boolean").alias("is_literal"),
    )


# ------------------------------------------------------------------ A06 / N01
def dataset_datastreams(datasets: DataFrame, licenses: DataFrame) -> DataFrame:
    """3 fixed datastreams + bag documents when requested + the licence.

    ``datasets`` needs deposit_id, include_bag_metadata and the A12 flags
    (has_sha1_manifest, has_agreements, has_message).
    """
    d = datasets.join(licenses.select("deposit_id", F.col("label").alias("lic_label"), F.col("mime_type").alias("lic_mime")), "deposit_id", "left")
    bag = F.coalesce(F.col("include_bag_metadata"), F.lit(False))
    e = d.select("deposit_id", "lic_label", "lic_mime", bag.alias("bag_md"),
                 F.coalesce(F.col("has_sha1_manifest"), F.lit(False)).alias("has_sha1_manifest"),
                 F.coalesce(F.col("has_agreements"), F.lit(False)).alias("has_agreements"),
                 F.coalesce(F.col("has_message"), F.lit(False)).alias("has_message"),
                 F.inline(datastream_rows()))
    keep = (
        (F.col("cond") == "always")
        | ((F.col("cond") == "bag_md") & F.col("bag_md"))
        | ((F.col("cond") == "bag_md_manifest") & F.col("bag_md") & F.col("has_sha1_manifest"))
        | ((F.col("cond") == "bag_md_agreements") & F.col("bag_md") & F.col("has_agreements"))
        | ((F.col("cond") == "bag_md_message") & F.col("bag_md") & F.col("has_message"))
        | ((F.col("cond") == "license") & F.col("lic_label").isNotNull())
    )
    is_lic = F.col("cond") == "license"
    return e.where(keep).select(
        "deposit_id",
        F.lit(K.DATASET_SDO).alias("sdo_name"),
        "ord",
        "ds_id",
        "content_file",
        F.lit(None).cast("string").alias("ds_location"),
        F.when(is_lic, F.col("lic_label")).otherwise(F.col("label")).alias("label"),
        "control_group",
        F.when(is_lic, F.col("lic_mime")).otherwise(F.col("mime_type")).alias("mime_type"),
        F.lit(None).cast("string").alias("checksum_type"),
        F.lit(None).cast("string").alias("checksum"),
    )


def dataset_relations(datasets: DataFrame, audience_pids: DataFrame) -> DataFrame:
    """[DOI], PID, 3 models, OAI item id, one membership per audience and,
    when PUBLISHED, one OAI-set membership per audience (ord keeps the order)."""
    scalar = F.array(
        _rel(1, K.HAS_DOI, "object", F.col("doi"), True),
        _rel(2, K.HAS_PID, "object", F.col("urn"), True),
        _rel(3, K.HAS_MODEL, "object", F.lit(K.MODEL_RECURSIVE_ITEM)),
        _rel(4, K.HAS_MODEL, "object", F.lit(K.MODEL_DATASET)),
        _rel(5, K.HAS_MODEL, "object", F.lit(K.MODEL_OAI_ITEM)),
        _rel(6, K.OAI_ITEM_ID, "object", F.lit(K.OAI_ID_PLACEHOLDER), True),
    )
    s = datasets.select("deposit_id", F.inline(scalar)).where(F.col("object").isNotNull())
    aud = audience_pids.join(datasets.select("deposit_id", "state"), "deposit_id")
    member = aud.select("deposit_id", F.inline(F.array(
        _rel(F.col("pos") + 1000, K.IS_MEMBER_OF, "object", fedora_object(F.col("discipline_pid"))),
        _rel(F.when(F.col("state") == "PUBLISHED", F.col("pos") + 2000), K.IS_MEMBER_OF_OAI_SET, "object", fedora_object(F.col("discipline_pid"))),
    ))).where(F.col("ord").isNotNull())
    return s.unionByName(member).select("deposit_id", F.lit(K.DATASET_SDO).alias("sdo_name"), "ord", "predicate", "object_kind", "object", "is_literal")


# ------------------------------------------------------------------ N02 / N03
# the datastreams and relations of an item are arrays made from its own row: the tables inline
# them, the documents print them, and nothing is exploded only to be grouped again
_DATASTREAM = {c: "int" if c == "ord" else "string" for c in DS_COLS[2:]}


def _datastream(**known) -> Column:
    known = {k: v if isinstance(v, Column) else F.lit(v) for k, v in known.items()}
    return F.struct(*[known.get(c, F.lit(None)).cast(kind).alias(c) for c, kind in _DATASTREAM.items()])


def file_datastream_array() -> Column:
    """EASY_FILE (redirect R or managed M with SHA-1) and the file metadata."""
    managed = F.col("control_group") == "M"
    return F.array(
        _datastream(ord=1, ds_id="EASY_FILE", content_file=F.when(managed, "EASY_FILE"), ds_location=F.when(~managed, F.col("ds_location")), control_group=F.col("control_group"),
                    mime_type=F.col("mime_type"), checksum_type=F.when(managed, "SHA-1"), checksum=F.when(managed, F.col("checksum"))),
        _datastream(ord=2, ds_id="EASY_FILE_METADATA", content_file="EASY_FILE_METADATA", control_group="X", mime_type="text/xml"),
    )


def folder_datastream_array() -> Column:
    """The folder metadata."""
    return F.array(_datastream(ord=1, ds_id="EASY_ITEM_CONTAINER_MD", content_file="EASY_ITEM_CONTAINER_MD", control_group="X", mime_type="text/xml"))


def item_relation_array(model: str) -> Column:
    """N02/N03 in a dataset: member of the parent SDO, subordinate to the dataset SDO, two models."""
    return F.array(
        _rel(1, K.IS_MEMBER_OF, "objectSDO", F.col("parent_sdo")),
        _rel(2, K.IS_SUBORDINATE_TO, "objectSDO", F.lit(K.DATASET_SDO)),
        _rel(3, K.HAS_MODEL, "object", F.lit(model)),
        _rel(4, K.HAS_MODEL, "object", F.lit(K.MODEL_CONTAINER_ITEM)),
    )


def file_datastreams(files: DataFrame) -> DataFrame:
    return files.select("deposit_id", "sdo_name", F.inline(file_datastream_array())).select(*DS_COLS)


def folder_datastreams(folders: DataFrame) -> DataFrame:
    return folders.select("deposit_id", "sdo_name", F.inline(folder_datastream_array())).select(*DS_COLS)


def item_relations(items: DataFrame, model: str) -> DataFrame:
    return items.select("deposit_id", "sdo_name", F.inline(item_relation_array(model))).select(*REL_COLS)


def file_configs(files: DataFrame) -> DataFrame:
    """``cfg.json`` of every file, a projection of the file's row; two files with one SDO name keep a document each."""
    return files.select("deposit_id", "sdo_name", F.lit("cfg.json").alias("file_name"), _config(K.NS_FILE, file_datastream_array(), item_relation_array(K.MODEL_FILE)).alias("content"))


def folder_configs(folders: DataFrame) -> DataFrame:
    """``cfg.json`` of every folder, likewise."""
    return folders.select("deposit_id", "sdo_name", F.lit("cfg.json").alias("file_name"), _config(K.NS_FOLDER, folder_datastream_array(), item_relation_array(K.MODEL_FOLDER)).alias("content"))


def _config(namespace: str, datastreams: Column, relations: Column, compat: bool = True) -> Column:
    """The JSON of a configuration; ``to_json`` leaves out null fields, which gives the optional keys.  With
    ``compat`` the manifest datastream keeps its key ``dsId`` (all others ``dsID``), as the reference writes it (q2)."""
    manifest = lambda x: F.lit(compat) & (x["ds_id"] == "manifest-sha1.txt")
    ds = F.transform(datastreams, lambda x: F.struct(
        x["content_file"].alias("contentFile"), x["ds_location"].alias("dsLocation"),
        F.when(~manifest(x), x["ds_id"]).alias("dsID"), F.when(manifest(x), x["ds_id"]).alias(K.MANIFEST_DS_KEY),
        x["label"].alias("label"), x["control_group"].alias("controlGroup"), x["mime_type"].alias("mimeType"),
        x["checksum_type"].alias("checksumType"), x["checksum"].alias("checksum")))
    rel = F.transform(relations, lambda x: F.struct(
        x["predicate"].alias("predicate"),
        F.when(x["object_kind"] == "object", x["object"]).alias("object"),
        F.when(x["object_kind"] == "objectSDO", x["object"]).alias("objectSDO"),
        x["is_literal"].alias("isLiteral")))
    return F.to_json(F.struct(F.lit(namespace).alias("namespace"), ds.alias("datastreams"), rel.alias("relations")))


def config_json(namespace: str, datastreams: DataFrame, relations: DataFrame, compat: bool = True) -> DataFrame:
    """``cfg.json`` per dataset from the normalised tables, whose rows come from several sources (audiences,
    licence, bag documents); arrays are collected per SDO, a handful of entries each.

    The rows are dealt by SDO first: arrays of a task's own rows would be no fewer than its SDOs and only fill its memory."""
    keys = ["deposit_id", "sdo_name"]
    ds = datastreams.repartition(*keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*DS_COLS[2:]))).alias("ds"))
    rel = relations.repartition(*keys).groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct(*REL_COLS[2:]))).alias("rel"))
    return ds.join(rel, keys, "full").select(
        "deposit_id", "sdo_name", F.lit("cfg.json").alias("file_name"), _config(namespace, F.col("ds"), F.col("rel"), compat).alias("content"))


CONFIG_SCHEMA = (
    "namespace string, datastreams array<struct<contentFile: string, dsLocation: string, dsID: string, dsId: string, label: string, controlGroup: string,"
    " mimeType: string, checksumType: string, checksum: string>>, relations array<struct<predicate: string, object: string, objectSDO: string, isLiteral: boolean>>"
)


_CONFIG_FIELDS = ("content_file", "ds_location", "label", "control_group", "mime_type", "checksum_type", "checksum", "object", "object_sdo")


def parse_config(documents: DataFrame) -> DataFrame:
    """A configuration read back: one row per datastream and relation with all its fields, ``nth`` being its place."""
    exact = CONFIG_SCHEMA.replace("dsId: string", "manifestId: string")  # Spark takes dsID and dsId for one name
    text = F.replace("content", F.lit(f'"{K.MANIFEST_DS_KEY}":'), F.lit('"manifestId":'))
    # one row of a generator per document: it is made and parsed once, for all fields and both lists
    d = documents.select("deposit_id", "sdo_name", F.inline(F.array(F.from_json(text, exact, {"mode": "FAILFAST"}))))

    def element(kind: str, nth: Column, name: Column, **known) -> Column:
        fields = [known.get(c, F.lit(None)).cast("string").alias(c) for c in _CONFIG_FIELDS]
        return F.struct(F.lit(kind).alias("element"), nth.cast("int").alias("nth"), name.alias("name"), *fields, known.get("is_literal", F.lit(None)).cast("boolean").alias("is_literal"))

    ds = F.transform("datastreams", lambda x, i: element(
        "datastream", i, F.coalesce(x["dsID"], x["manifestId"]), content_file=x["contentFile"], ds_location=x["dsLocation"], label=x["label"],
        control_group=x["controlGroup"], mime_type=x["mimeType"], checksum_type=x["checksumType"], checksum=x["checksum"]))
    rel = F.transform("relations", lambda x, i: element("relation", i, x["predicate"], object=x["object"], object_sdo=x["objectSDO"], is_literal=x["isLiteral"]))
    none = F.filter(F.array(element("", F.lit(0), F.lit(""))), lambda x: F.lit(False))
    return d.select("deposit_id", "sdo_name", "namespace", F.inline(F.concat(F.coalesce(ds, none), F.coalesce(rel, none))))


def config_rows(namespace: str, datastreams: DataFrame, relations: DataFrame) -> DataFrame:
    """The rows of :func:`parse_config` for items (files or folders), straight from their tables."""
    keys = ["deposit_id", "sdo_name", F.lit(namespace).alias("namespace")]
    nth = (F.col("ord") - 1).cast("int").alias("nth")
    ds = datastreams.select(*keys, F.lit("datastream").alias("element"), nth, F.col("ds_id").alias("name"), *[c for c in DS_COLS if c not in ("deposit_id", "sdo_name", "ord", "ds_id")])
    of = lambda kind: F.when(F.col("object_kind") == kind, F.col("object"))
    rel = relations.select(*keys, F.lit("relation").alias("element"), nth, F.col("predicate").alias("name"), of("object").alias("object"), of("objectSDO").alias("object_sdo"), "is_literal")
    return ds.unionByName(rel, allowMissingColumns=True)


# ------------------------------------------------------------------ N04
def admin_facts(datasets: DataFrame, info: DataFrame) -> DataFrame:
    """N04 facts: state, previous state and change date when not DRAFT,
    depositor, remark (when non-empty)."""
    d = datasets.join(info.select("deposit_id", "remark"), "deposit_id", "left")
    not_draft = F.col("state") != "DRAFT"
    return d.select(
        "deposit_id",
        F.col("state").alias("dataset_state"),
        F.when(not_draft, F.lit("DRAFT")).alias("previous_state"),
        F.when(not_draft, iso_timestamp(F.col("submission_ts"))).alias("last_state_change"),
        F.col("owner_id").alias("depositor_id"),
        F.when(F.coalesce(F.col("remark"), F.lit("")) != "", F.col("remark")).alias("remark_text"),
    )


WORKFLOW_SQL = """
WITH RECURSIVE tree (id, parent, required, time_spent_writable, depth, path, place) AS (
  SELECT id, parent, required, time_spent_writable, 0, id, lpad(CAST(nth AS STRING), 3, '0') FROM {nodes} WHERE parent IS NULL
  UNION ALL
  SELECT n.id, n.parent, n.required, n.time_spent_writable, t.depth + 1, concat(t.path, '>', n.id), concat(t.place, '.', lpad(CAST(n.nth AS STRING), 3, '0'))
  FROM {nodes} n JOIN tree t ON n.parent = t.id
)
SELECT id, parent, required, time_spent_writable, depth, path, row_number() OVER (ORDER BY place) AS ord FROM tree
"""


def workflow_tree(spark) -> DataFrame:
    """The workflow dimension (19 rows) walked from its root: depth, path and document order of every node."""
    rows = [(i, *node) for i, node in enumerate(K.WORKFLOW_TREE)]
    nodes = spark.createDataFrame(rows, "nth int, id string, parent string, required boolean, time_spent_writable boolean")
    return spark.sql(WORKFLOW_SQL, nodes=nodes)


def workflow_steps(datasets: DataFrame) -> DataFrame:
    """The workflow of every dataset, one row per step below the root, all still to be done."""
    steps = [r for r in workflow_tree(datasets.sparkSession).orderBy("ord").collect() if r["depth"]]  # a constant dimension
    row = lambda r: F.struct(*[F.lit(r[c]).alias(c) for c in ("ord", "id", "parent", "depth", "path", "required", "time_spent_writable")])
    return datasets.select("deposit_id", F.inline(F.array(*[row(r) for r in steps])))


def _workflow_xml(spark) -> str:
    """The steps below the root in document order; a step closes when the next one is not below it."""
    out, depths = [], []
    for node in workflow_tree(spark).orderBy("ord").collect():
        if not node["depth"]:
            continue
        while depths and depths[-1] >= node["depth"]:
            out.append("</steps></wfs:workflow>")
            depths.pop()
        writable = "<timeSpentWritable>true</timeSpentWritable>" if node["time_spent_writable"] else ""
        required = "<required>true</required>" if node["required"] else ""
        out.append(f"<wfs:workflow><id>{node['id']}</id>{writable}{required}<remarks></remarks><steps>")
        depths.append(node["depth"])
    return "".join(out) + "</steps></wfs:workflow>" * len(depths)


def _text(c) -> Column:
    """Escaped text; an absent value is empty, so that it does not empty the whole document."""
    return F.coalesce(xml_escape(c), F.lit(""))


def render_amd(facts: DataFrame, remark_date: str) -> DataFrame:
    """N04 rendering; the remark date is a parameter (the reference uses wall-clock now)."""
    state_change = F.when(
        F.col("previous_state").isNotNull(),
        F.concat(F.lit("<previousState>DRAFT</previousState><lastStateChange>"), F.coalesce("last_state_change", F.lit("")), F.lit("</lastStateChange>")),
    ).otherwise(F.lit(""))
    dates = F.when(
        F.col("previous_state").isNotNull(),
        F.concat(F.lit("<stateChangeDates><damd:stateChangeDate><fromState>DRAFT</fromState><toState>"), _text(F.col("dataset_state")),
                 F.lit("</toState><changeDate>"), F.coalesce("last_state_change", F.lit("")), F.lit("</changeDate></damd:stateChangeDate></stateChangeDates>")),
    ).otherwise(F.lit("<stateChangeDates/>"))
    remark = F.when(
        F.col("remark_text").isNotNull(),
        F.concat(F.lit("<remark><text>"), _text(F.col("remark_text")), F.lit("</text><remarkerId>"), _text(F.col("depositor_id")),
                 F.lit(f"</remarkerId><remarkDate>{remark_date}</remarkDate></remark>")),
    ).otherwise(F.lit(""))
    content = F.concat(
        F.lit(f'<damd:administrative-md xmlns:damd="{K.NS_AMD}" version="0.1"><datasetState>'),
        _text(F.col("dataset_state")), F.lit("</datasetState>"), state_change,
        F.lit("<depositorId>"), _text(F.col("depositor_id")), F.lit("</depositorId>"), dates,
        F.lit(f'<groupIds/><damd:workflowData version="0.1"><assigneeId>{K.WORKFLOW_ASSIGNEE}</assigneeId>'
              f'<wfs:workflow xmlns:wfs="{K.NS_WORKFLOW}"><id>dataset</id><remarks>'),
        remark, F.lit(f"</remarks><steps>{_workflow_xml(facts.sparkSession)}</steps></wfs:workflow></damd:workflowData></damd:administrative-md>"),
    )
    return facts.select("deposit_id", F.lit(K.DATASET_SDO).alias("sdo_name"), F.lit("AMD").alias("file_name"), content.alias("content"))


# ------------------------------------------------------------------ N05
def render_foxml(sdos: DataFrame, label: str = "label", owner: str = "owner_id", mime: str | None = "mime_type") -> DataFrame:
    """Object document — state Active, label (255), owner, DC title / type."""
    dc_type = F.concat(F.lit("<dc:type>"), _text(F.col(mime)), F.lit("</dc:type>")) if mime else F.lit("")
    dc_type = F.when(F.col(mime).isNotNull(), dc_type).otherwise(F.lit("")) if mime else dc_type
    content = F.concat(
        F.lit(f'<foxml:digitalObject VERSION="1.1" xmlns:foxml="{K.NS_FOXML}" '
              f'xmlns:xsi="{K.NS_XSI}" '
              f'xsi:schemaLocation="{K.NS_FOXML} http://www.fedora.info/definitions/1/0/foxml1-1.xsd">'
              '<foxml:objectProperties><foxml:property NAME="info:fedora/fedora-system:def/model#state" VALUE="Active"/>'
              '<foxml:property NAME="info:fedora/fedora-system:def/model#label" VALUE="'),
        _text(fox_label(F.col(label))),
        F.lit('"/><foxml:property NAME="info:fedora/fedora-system:def/model#ownerId" VALUE="'),
        _text(F.col(owner)),
        F.lit('"/></foxml:objectProperties><foxml:datastream ID="DC" STATE="A" CONTROL_GROUP="X" VERSIONABLE="true">'
              f'<foxml:datastreamVersion ID="DC1.0" LABEL="Dublin Core Record" MIMETYPE="text/xml" FORMAT_URI="{K.NS_OAI_DC}">'
              f'<foxml:xmlContent><oai_dc:dc xmlns:oai_dc="{K.NS_OAI_DC}" xmlns:dc="{K.NS_DC}" '
              f'xmlns:xsi="{K.NS_XSI}" xsi:schemaLocation="{K.NS_OAI_DC} http://www.openarchives.org/OAI/2.0/oai_dc.xsd">'
              '<dc:title>'),
        _text(F.col(label)),
        F.lit("</dc:title>"),
        dc_type,
        F.lit("</oai_dc:dc></foxml:xmlContent></foxml:datastreamVersion></foxml:datastream></foxml:digitalObject>"),
    )
    return sdos.select("deposit_id", "sdo_name", F.lit("fo.xml").alias("file_name"), content.alias("content"))


FOXML_SCHEMA = (
    "objectProperties struct<property: array<struct<_NAME: string, _VALUE: string>>>,"
    " datastream struct<datastreamVersion: struct<xmlContent: struct<dc: struct<title: string, type: string>>>>"
)


def parse_foxml(documents: DataFrame) -> DataFrame:
    """N05 read back: state, label, owner, Dublin Core title and type of rendered object documents."""
    options = {"ignoreNamespace": "true", "ignoreSurroundingSpaces": "false", "mode": "FAILFAST"}
    # one row of a generator per document: it is made and parsed once, for all fields
    d = documents.select("deposit_id", "sdo_name", F.inline(F.array(F.from_xml("content", FOXML_SCHEMA, options))))
    value = lambda name: F.get(F.filter("objectProperties.property", lambda p: p["_NAME"].endswith(f"model#{name}")), F.lit(0))["_VALUE"]
    dc = "datastream.datastreamVersion.xmlContent.dc"
    return d.select("deposit_id", "sdo_name", value("state").alias("state"), value("label").alias("label"), value("ownerId").alias("owner_id"),
                    F.col(f"{dc}.title").alias("title"), F.col(f"{dc}.type").alias("type"))


# ------------------------------------------------------------------ N06 / N07
def file_md(files: DataFrame) -> DataFrame:
    """File metadata projection."""
    return files.select(
        "deposit_id", "sdo_name",
        P.file_name(F.col("dataset_path")).alias("name"),
        F.col("dataset_path").alias("path"),
        "mime_type", "size",
        F.coalesce(F.col("creator_role"), F.lit(K.REQUEST_DEFAULT_CREATOR_ROLE)).alias("creator_role"),
        "visible_to", "accessible_to",
    )


def render_file_md(md: DataFrame) -> DataFrame:
    content = F.concat(
        F.lit(f'<fimd:file-item-md xmlns:fimd="{K.NS_FILE_ITEM_MD}" version="0.1"><name>'), xml_escape(F.col("name")),
        F.lit("</name><path>"), xml_escape(F.col("path")), F.lit("</path><mimeType>"), xml_escape(F.col("mime_type")),
        F.lit("</mimeType><size>"), F.col("size").cast("string"), F.lit("</size><creatorRole>"), xml_escape(F.col("creator_role")),
        F.lit("</creatorRole><visibleTo>"), F.col("visible_to"), F.lit("</visibleTo><accessibleTo>"), F.col("accessible_to"),
        F.lit("</accessibleTo></fimd:file-item-md>"),
    )
    return md.select("deposit_id", "sdo_name", F.lit("EASY_FILE_METADATA").alias("file_name"), content.alias("content"))


def folder_md(folders: DataFrame) -> DataFrame:
    """Folder metadata projection (name = last segment, path)."""
    return folders.select("deposit_id", "sdo_name", P.file_name(F.col("dataset_path")).alias("name"), F.col("dataset_path").alias("path"))


def render_folder_md(md: DataFrame) -> DataFrame:
    content = F.concat(
        F.lit(f'<icmd:item-container-md xmlns:icmd="{K.NS_ITEM_CONTAINER_MD}" version="0.1"><name>'),
        xml_escape(F.col("name")), F.lit("</name><path>"), xml_escape(F.col("path")), F.lit("</path></icmd:item-container-md>"),
    )
    return md.select("deposit_id", "sdo_name", F.lit("EASY_ITEM_CONTAINER_MD").alias("file_name"), content.alias("content"))


PRSQL_DOCUMENT = (
    f'<psl:permissionSequenceList xmlns:psl="{K.NS_PERMISSION_SEQUENCE_LIST}"><sequences/></psl:permissionSequenceList>'
)


def render_prsql(datasets: DataFrame) -> DataFrame:
    """The constant empty permission list of every dataset."""
    return datasets.select("deposit_id", F.lit(K.DATASET_SDO).alias("sdo_name"), F.lit("PRSQL").alias("file_name"), F.lit(PRSQL_DOCUMENT).alias("content"))


# ------------------------------------------------------------------ N08
def payload_entries(payload: DataFrame) -> DataFrame:
    """Payload rows below ``data``: the directory ``data`` itself only tells that there is one."""
    return payload.where(F.col("path") != "data").withColumn("is_dir", F.coalesce(F.col("is_dir"), F.lit(False)))


def folder_sdos(files: DataFrame) -> DataFrame:
    """Every directory below ``data``: explode the ancestors of the file
    paths (plus explicit directory rows) and deduplicate on (deposit, path) —
    a partial aggregate keyed on the path, not on the deposit alone."""
    from_files = files.where(~F.coalesce(F.col("is_dir"), F.lit(False))).select(
        "deposit_id", F.col("dataset_path").alias("_file"), F.explode(P.ancestor_depths("dataset_path")).alias("_depth")
    ).select("deposit_id", P.ancestor_at("_file", "_depth").alias("dataset_path"))
    dirs = files.where(F.coalesce(F.col("is_dir"), F.lit(False))).select("deposit_id", "dataset_path")
    folders = from_files.unionByName(dirs).distinct()
    parent = P.parent_path(F.col("dataset_path"))
    return folders.select(
        "deposit_id",
        "dataset_path",
        P.sdo_name(F.col("dataset_path")).alias("sdo_name"),
        F.when(parent.isNull(), F.lit(K.DATASET_SDO)).otherwise(P.sdo_name(parent)).alias("parent_sdo"),
    )


# ------------------------------------------------------------------ N09
def ancestor_sdos(requests: DataFrame, folder_catalog: DataFrame | None = None, only_missing: bool = False) -> DataFrame:
    """Folder SDOs for the ancestors of requested files (per dataset).

    All ancestors are produced, also existing ones (the code's behaviour);
    ``only_missing=True`` anti-joins the catalogue (the documented behaviour).
    The parent is the raw grand-parent path, or the dataset's set name at top.
    """
    anc = requests.select("dataset_id", F.explode(P.ancestor_paths(F.col("path_in_dataset"))).alias("path")).distinct()
    if only_missing and folder_catalog is not None:
        from bagyard.operators.joins import normalized_folders

        known = normalized_folders(folder_catalog).select("dataset_id", F.col("anc_path").alias("path"))
        anc = anc.join(known, ["dataset_id", "path"], "left_anti")
    parent = P.parent_path(F.col("path"))
    return anc.select(
        "dataset_id",
        "path",
        P.sdo_name(F.col("path")).alias("sdo_name"),
        F.lit("objectSDO").alias("parent_kind"),
        F.coalesce(parent, P.sdo_set_name(F.col("dataset_id"))).alias("parent_object"),
    )

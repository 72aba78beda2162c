"""DuckDB oracle SQL for every registered query.

Written independently of the Spark plans where a different formulation
exists (A01 with list lengths, J08 as a correlated ``ORDER BY … LIMIT 1``,
A10 with ``row_number``, U03 with ``NOT IN`` over a VALUES list, …).  Each
query is prefixed with the SQL twins of the test-data bindings it reads.
"""

from __future__ import annotations

from bagyard import constants as K
from bagyard.sources.testdata_sql import with_bindings


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


# the oracles' own values, so that a wrong constant of the engine does not pass on both sides
STATES = ("DRAFT", "SUBMITTED", "PUBLISHED", "MAINTENANCE")
ARCHIVES = ("EASY", "DATAVAULT")
STAGES = {
    "invalid_state": 1, "uri_not_in_bag": 2, "no_data_dir": 3, "dataset_xml_missing": 4, "invalid_archive": 6, "urn_missing": 10, "unknown_audience": 11,
    "unknown_access_category": 11, "bag_metadata_missing": 12, "bad_manifest_line": 13, "files_xml_missing": 14, "format_not_unique": 14, "bad_url": 14,
}


def _in(values) -> str:
    return "(" + ", ".join(_q(v) for v in values) + ")"


def JTRIM(x: str) -> str:
    return rf"regexp_replace({x}, '^[\x00-\x20]+|[\x00-\x20]+$', '', 'g')"


def SDO(x: str) -> str:
    return f"regexp_replace(replace(replace({x}, '/', '_'), '.', '_'), '^_', '')"


def PARENT(x: str) -> str:
    return f"CASE WHEN strpos({x}, '/') > 0 THEN regexp_extract({x}, '^(.*)/[^/]*$', 1) END"


def NAME(x: str) -> str:
    return f"regexp_extract({x}, '([^/]*)$', 1)"


def DREL(x: str) -> str:
    return f"regexp_replace({x}, '^data/', '')"


def RIGHTS(x: str) -> str:
    return f"CASE WHEN {x} IN {_in(K.FILE_RIGHTS)} THEN {x} END"


def BLANK(x: str) -> str:
    return f"coalesce({JTRIM(x)} = '', true)"


CATEGORY = "CASE access_category " + " ".join(f"WHEN {_q(c)} THEN {_q(r)}" for c, r in K.ACCESS_CATEGORY_RIGHTS) + " END"

# Split once on the first run of blanks/tabs
def PARSED(src: str) -> str:
    return rf"""SELECT deposit_id, algorithm, line_no,
       CASE WHEN regexp_matches(raw, '[ \t]') THEN regexp_extract(raw, '^([^ \t]*)[ \t]', 1) ELSE raw END AS checksum,
       CASE WHEN regexp_matches(raw, '[ \t]') THEN regexp_extract(raw, '^[^ \t]*[ \t]+(.*)$', 1) END AS path
FROM {src} WHERE raw <> ''"""


OK_DEFAULT = "(path IS NOT NULL AND NOT regexp_full_match(checksum, '[a-fA-F0-9]'))"
OK_STRICT = "(path IS NOT NULL AND regexp_full_match(checksum, '[0-9a-fA-F]{40}'))"

MD = """SELECT deposit_id, filepath,
   CAST(sum(len(format)) AS BIGINT) AS n_format,
   CASE WHEN sum(len(format)) = 1 THEN max(CASE WHEN len(format) = 1 THEN format[1] END) END AS format,
   CAST(sum(len(title)) AS BIGINT) AS n_title,
   CASE WHEN sum(len(title)) = 1 THEN max(CASE WHEN len(title) = 1 THEN title[1] END) END AS title,
   CASE WHEN sum(len(access_rights)) = 1 THEN max(CASE WHEN len(access_rights) = 1 THEN access_rights[1] END) END AS access_rights,
   CASE WHEN sum(len(accessible_to)) = 1 THEN max(CASE WHEN len(accessible_to) = 1 THEN accessible_to[1] END) END AS accessible_to,
   CASE WHEN sum(len(visible_to)) = 1 THEN max(CASE WHEN len(visible_to) = 1 THEN visible_to[1] END) END AS visible_to
FROM file_metadata GROUP BY deposit_id, filepath"""

SHA1 = f"""SELECT deposit_id, path, arg_max(checksum, line_no) AS checksum
FROM ({PARSED('payload_manifest')}) WHERE {OK_DEFAULT} GROUP BY deposit_id, path"""

DISC = """SELECT regexp_extract(regexp_extract(xml, '<setSpec[^>]*>([^<]*)</setSpec>', 1), '([^:]*)$', 1) AS audience, max(pid) AS pid
FROM discipline_xml GROUP BY 1"""

_ISO = r"\d{4}(-\d{2}(-\d{2}(T\d{2}(:\d{2}(:\d{2}(\.\d{1,9})?)?)?(Z|[+-]\d{2}(:?\d{2})?)?)?)?)?"
YEAR = rf"""CASE WHEN regexp_full_match(created, '{_ISO}')
   AND try_strptime(CASE len(regexp_extract(created, '^(\d{{4}}(-\d{{2}}(-\d{{2}})?)?)', 1))
                      WHEN 4 THEN regexp_extract(created, '^(\d{{4}})', 1) || '-01-01'
                      WHEN 7 THEN regexp_extract(created, '^(\d{{4}}-\d{{2}})', 1) || '-01'
                      ELSE regexp_extract(created, '^(\d{{4}}-\d{{2}}-\d{{2}})', 1) END, '%Y-%m-%d') IS NOT NULL
   AND coalesce(TRY_CAST(nullif(regexp_extract(created, 'T(\d{{2}})', 1), '') AS INTEGER) < 24, true)
 THEN CAST(substr(created, 1, 4) AS INTEGER) END"""

IS_URI = """coalesce(
  len(string_split(regexp_replace(xsi_type, ':+$', ''), ':')) = 2
  AND string_split(regexp_replace(xsi_type, ':+$', ''), ':')[2] = 'URI'
  AND strpos(coalesce(ns_decls, ''), 'xmlns:' || string_split(xsi_type, ':')[1] || '="') > 0
  AND split_part(substr(coalesce(ns_decls, ''), strpos(coalesce(ns_decls, ''), 'xmlns:' || string_split(xsi_type, ':')[1] || '="')
        + length('xmlns:' || string_split(xsi_type, ':')[1] || '="')), '"', 1) = 'http://purl.org/dc/terms/', false)"""

MIME = "CASE regexp_extract({x}, '([^.]*)$', 1) " + " ".join(f"WHEN '{e}' THEN '{m}'" for e, m in K.LICENSE_MIME) + " END"

# licence outcome: facts, typed single licences, matched catalogue entries
LIC_CTES = f"""
n_lic AS (SELECT deposit_id, count(*) AS n_licenses FROM license_elements GROUP BY deposit_id),
holders AS (SELECT deposit_id, string_agg(rights_holder, ', ' ORDER BY pos) AS rights_holders, count(*) AS n_rights_holders
            FROM rights_holders GROUP BY deposit_id),
years AS (SELECT deposit_id, count(*) AS n_created, max({YEAR}) AS year, max(created) AS created_text FROM created GROUP BY deposit_id),
facts AS (SELECT n.deposit_id, n.n_licenses, h.rights_holders, y.n_created, y.year, y.created_text
          FROM n_lic n LEFT JOIN holders h USING (deposit_id) LEFT JOIN years y USING (deposit_id)),
cat AS (SELECT uri, max(file_name) AS file_name, arg_max(content, file_name) AS content FROM license_catalog GROUP BY uri),
typed AS (SELECT le.deposit_id, le.pos, le.text, le.xsi_type, {IS_URI} AS is_uri,
                 regexp_replace(le.text, '^https:', 'http:') AS u1
          FROM license_elements le JOIN n_lic USING (deposit_id) LEFT JOIN ns_decls USING (deposit_id) WHERE n_licenses = 1),
matched AS (SELECT t.*, coalesce(c1.file_name, c2.file_name) AS license_file,
                   CASE WHEN c1.file_name IS NOT NULL THEN c1.content ELSE c2.content END AS license_template
            FROM typed t LEFT JOIN cat c1 ON c1.uri = t.u1
            LEFT JOIN cat c2 ON right(t.u1, 1) = '/' AND c2.uri = left(t.u1, length(t.u1) - 1)),
lic AS (SELECT m.deposit_id, m.is_uri, m.license_file, m.text, f.rights_holders, f.year,
               CASE WHEN m.is_uri THEN m.license_file ELSE '{K.FREE_TEXT_LICENSE_NAME}' END AS label,
               CASE WHEN m.is_uri THEN {MIME.format(x='m.license_file')} ELSE 'text/plain' END AS mime_type,
               m.license_template
        FROM matched m LEFT JOIN facts f USING (deposit_id)),
licenses AS (SELECT deposit_id, is_uri, license_file, label, mime_type,
                    CASE WHEN NOT is_uri THEN text
                         WHEN mime_type IN ('text/plain', 'text/html')
                           THEN replace(replace(license_template, '<rightsHolder>', rights_holders), '<year>', CAST(year AS VARCHAR))
                         ELSE license_template END AS content
             FROM lic),
lic_rejects AS (
  SELECT deposit_id, 7 AS stage, 'no_rights_holder' AS code, 'No dcterms:rightsHolder element found. There should be at least one' AS message, NULL AS item
  FROM facts WHERE rights_holders IS NULL
  UNION ALL SELECT deposit_id, 8, 'created_not_one', CAST(coalesce(n_created, 0) AS VARCHAR) || ' ddm:created elements found. There must be exactly one', NULL
  FROM facts WHERE coalesce(n_created, 0) <> 1
  UNION ALL SELECT deposit_id, 8, 'bad_created_date', 'Invalid format: ' || created_text, NULL FROM facts WHERE n_created = 1 AND year IS NULL
  UNION ALL SELECT deposit_id, 9, 'license_count', 'Found ' || CAST(n_licenses AS VARCHAR) || ' dcterms:license elements. There should be exactly one', NULL
  FROM facts WHERE n_licenses > 1
  UNION ALL SELECT deposit_id, 9, 'unknown_license_uri', 'Not a valid license URI: ' || text, NULL FROM lic WHERE is_uri AND license_file IS NULL
  UNION ALL SELECT deposit_id, 9, 'unknown_license_extension', 'Unknown extension for license: .' || regexp_extract(license_file, '([^.]*)$', 1), NULL
  FROM lic WHERE is_uri AND license_file IS NOT NULL AND mime_type IS NULL)"""

LIC_BINDINGS = ("license_elements", "ns_decls", "rights_holders", "created", "license_catalog")

FLAGS = """SELECT deposit_id,
   bool_or(name = 'metadata/dataset.xml') AS has_dataset_xml,
   bool_or(name = 'metadata/files.xml') AS has_files_xml,
   bool_or(name = 'manifest-sha1.txt' AND length > 0) AS has_sha1_manifest,
   bool_or(name = 'metadata/depositor-info/agreements.xml') AS has_agreements,
   bool_or(name = 'metadata/depositor-info/message-from-depositor.txt') AS has_message
FROM bag_documents GROUP BY deposit_id"""

DSTREAM_VALUES = ", ".join(
    f"({o}, {_q(cf)}, {_q(ds)}, {_q(lbl) if lbl else 'NULL'}, {_q(cg)}, {_q(m) if m else 'NULL'}, {_q(c or 'always')})"
    for o, cf, ds, lbl, cg, m, c in K.DATASET_DATASTREAMS
)

DATASTREAMS = f"""SELECT d.deposit_id, v.ord, v.ds_id, v.content_file,
       CASE WHEN v.cond = 'license' THEN l.label ELSE v.label END AS label, v.control_group,
       CASE WHEN v.cond = 'license' THEN l.mime_type ELSE v.mime_type END AS mime_type
FROM dflags d CROSS JOIN (VALUES {DSTREAM_VALUES}) AS v(ord, content_file, ds_id, label, control_group, mime_type, cond)
LEFT JOIN licenses l ON l.deposit_id = d.deposit_id
WHERE v.cond = 'always'
   OR (v.cond = 'bag_md' AND d.include_bag_metadata)
   OR (v.cond = 'bag_md_manifest' AND d.include_bag_metadata AND coalesce(d.has_sha1_manifest, false))
   OR (v.cond = 'bag_md_agreements' AND d.include_bag_metadata AND coalesce(d.has_agreements, false))
   OR (v.cond = 'bag_md_message' AND d.include_bag_metadata AND coalesce(d.has_message, false))
   OR (v.cond = 'license' AND l.label IS NOT NULL)"""

RELATIONS = f"""SELECT deposit_id, 1 AS ord, '{K.HAS_DOI}' AS predicate, 'object' AS object_kind, doi AS object, true AS is_literal FROM deposits WHERE doi IS NOT NULL
UNION ALL SELECT deposit_id, 2, '{K.HAS_PID}', 'object', urn, true FROM deposits WHERE urn IS NOT NULL
UNION ALL SELECT deposit_id, 3, '{K.HAS_MODEL}', 'object', '{K.MODEL_RECURSIVE_ITEM}', NULL FROM deposits
UNION ALL SELECT deposit_id, 4, '{K.HAS_MODEL}', 'object', '{K.MODEL_DATASET}', NULL FROM deposits
UNION ALL SELECT deposit_id, 5, '{K.HAS_MODEL}', 'object', '{K.MODEL_OAI_ITEM}', NULL FROM deposits
UNION ALL SELECT deposit_id, 6, '{K.OAI_ITEM_ID}', 'object', '{K.OAI_ID_PLACEHOLDER}', true FROM deposits
UNION ALL SELECT a.deposit_id, 1000 + a.pos, '{K.IS_MEMBER_OF}', 'object', 'info:fedora/' || disc.pid, NULL
  FROM audiences a JOIN deposits USING (deposit_id) LEFT JOIN disc USING (audience)
UNION ALL SELECT a.deposit_id, 2000 + a.pos, '{K.IS_MEMBER_OF_OAI_SET}', 'object', 'info:fedora/' || disc.pid, NULL
  FROM audiences a JOIN deposits dp USING (deposit_id) LEFT JOIN disc USING (audience) WHERE dp.state = 'PUBLISHED'"""

SIGNER = """SELECT deposit_id, name, account, email, true AS has_signer FROM (
  SELECT *, row_number() OVER (PARTITION BY deposit_id ORDER BY pos) AS rn FROM agreement_signers) WHERE rn = 1"""


def DISPLAY(n="name", a="account", e="email") -> str:
    A = f"CASE WHEN {BLANK(a)} THEN NULL ELSE {JTRIM(a)} END"
    E = f"CASE WHEN {BLANK(e)} THEN NULL ELSE {JTRIM(e)} END"
    return f"""CASE WHEN {n} IS NULL THEN 'NOT KNOWN'
  WHEN {n} = '' AND {A} IS NULL AND {E} IS NULL THEN 'NOT KNOWN'
  WHEN {A} IS NULL AND {E} IS NULL THEN {n}
  WHEN {n} = '' AND {A} IS NULL THEN {E}
  WHEN {n} = '' AND {E} IS NULL THEN {A}
  WHEN {n} = '' THEN {A} || ' (' || {E} || ')'
  WHEN {A} IS NULL THEN {n} || ' (' || {E} || ')'
  WHEN {E} IS NULL THEN {n} || ' (' || {A} || ')'
  ELSE {n} || ' (' || {A} || ', ' || {E} || ')' END"""


LOOSE = "coalesce(lower({x}) IN " + _in(K.TRUE_WORDS) + ", false)"

INFO = f"""SELECT dp.deposit_id,
  CASE WHEN ag.deposit_id IS NULL THEN ''
       WHEN NOT ag.is_valid THEN 'File agreements.xml not valid: ' || coalesce(ag.parse_error, '')
       WHEN ag.privacy_text IS NOT NULL THEN 'According to depositor ' || {DISPLAY('sg.name', 'sg.account', 'sg.email')} || ' this dataset '
            || CASE WHEN {LOOSE.format(x='ag.privacy_text')} THEN 'DOES' ELSE 'DOES NOT' END || ' contain Privacy Sensitive data.'
       ELSE 'No statement by ' || {DISPLAY('sg.name', 'sg.account', 'sg.email')} || ' could be found whether this dataset contains Privacy Sensitive data.'
  END AS privacy_remark,
  CASE WHEN ag.deposit_id IS NULL OR NOT ag.is_valid THEN NULL
       WHEN ag.accepted_text IS NULL THEN false
       ELSE {LOOSE.format(x='ag.accepted_text')} END AS accepted_license,
  CASE WHEN m.text IS NULL OR {BLANK('m.text')} THEN '' ELSE replace(replace(m.text, '<', '&lt;'), '>', '&gt;') END AS message
FROM deposits dp LEFT JOIN agreements ag USING (deposit_id) LEFT JOIN signer sg USING (deposit_id) LEFT JOIN messages m USING (deposit_id)"""
INFO_BINDINGS = ("deposits", "agreements", "agreement_signers", "messages")
REMARK = JTRIM("privacy_remark || chr(10) || chr(10) || message || chr(10)")

LOCATED = f"""SELECT r.request_id, r.dataset_id, r.path_in_dataset,
  coalesce((SELECT regexp_replace(fc.path, '/$', '') FROM folder_catalog fc
            WHERE fc.dataset_sid = r.dataset_id AND r.path_in_dataset LIKE regexp_replace(fc.path, '/$', '') || '/%'
              AND regexp_replace(fc.path, '/$', '') <> ''
            ORDER BY length(regexp_replace(fc.path, '/$', '')) DESC LIMIT 1), '') AS ancestor_path
FROM item_requests r"""
LOCATED_PID = """SELECT l.request_id, l.dataset_id, l.path_in_dataset, l.ancestor_path,
  CASE WHEN l.ancestor_path = '' THEN l.dataset_id ELSE
    (SELECT min(fc.pid) FROM folder_catalog fc WHERE fc.dataset_sid = l.dataset_id AND regexp_replace(fc.path, '/$', '') = l.ancestor_path) END AS ancestor_pid
FROM located l"""

PAYLOAD_ITEMS = f"""SELECT deposit_id, path, size, is_dir, {DREL('path')} AS dataset_path, {SDO(DREL('path'))} AS sdo_name,
  CASE WHEN {PARENT(DREL('path'))} IS NULL THEN '{K.DATASET_SDO}' ELSE {SDO(PARENT(DREL('path')))} END AS parent_sdo
FROM payload_files"""

PAYLOAD_ENTRIES = f"""SELECT deposit_id, path, is_dir, {DREL('path')} AS dataset_path FROM payload_listing WHERE path <> 'data'"""

FOLDERS_FROM = """SELECT DISTINCT deposit_id, array_to_string(list_slice(parts, 1, i), '/') AS dataset_path
FROM (SELECT deposit_id, parts, unnest(range(1, len(parts) + CAST(is_dir AS INTEGER))) AS i FROM (SELECT deposit_id, is_dir, string_split(dataset_path, '/') AS parts FROM {src}))"""


def FOLDERS(src: str) -> str:
    return f"""SELECT deposit_id, dataset_path, {SDO('dataset_path')} AS sdo_name,
  CASE WHEN {PARENT('dataset_path')} IS NULL THEN '{K.DATASET_SDO}' ELSE {SDO(PARENT('dataset_path'))} END AS parent_sdo
FROM ({FOLDERS_FROM.format(src=src)})"""


# ---------------------------------------------------------------- item job
REQ_PREP = f"""SELECT request_id, path_in_dataset, format, datastream_location, size, file_location, dataset_id,
  CASE WHEN {BLANK('accessible_to')} THEN 'NONE' ELSE accessible_to END AS accessible_to,
  CASE WHEN {BLANK('visible_to')} THEN 'ANONYMOUS' ELSE visible_to END AS visible_to,
  CASE WHEN {BLANK('creator_role')} THEN 'DEPOSITOR' ELSE creator_role END AS creator_role,
  CASE WHEN {BLANK('owner_id')} THEN NULL ELSE {JTRIM('owner_id')} END AS owner_id
FROM item_requests
WHERE NOT (path_in_dataset = '' AND format = '' AND datastream_location = '' AND size = '' AND file_location = ''
           AND dataset_id = '' AND accessible_to = '' AND visible_to = '' AND creator_role = '' AND owner_id = '')"""

PROTO = "regexp_extract({x}, '^([A-Za-z][A-Za-z0-9+.-]*):', 1)"

REQ_RULES = f"""SELECT request_id, 'dataset_id_missing' AS code FROM {{src}} WHERE dataset_id = ''
UNION ALL SELECT request_id, 'path_size_format_required' FROM {{src}} WHERE dataset_id <> '' AND (path_in_dataset = '' OR size = '' OR format = '')
UNION ALL SELECT request_id, 'location_or_file_required' FROM {{src}} WHERE dataset_id <> '' AND datastream_location = '' AND file_location = ''
UNION ALL SELECT request_id, 'location_and_file' FROM {{src}} WHERE datastream_location <> '' AND file_location <> ''
UNION ALL SELECT request_id, 'size_not_a_number' FROM {{src}} WHERE size <> '' AND TRY_CAST(size AS BIGINT) IS NULL"""

REQ_LOCATION = f"""SELECT request_id, 'location_not_http' AS code FROM {{src}}
  WHERE datastream_location <> '' AND NOT coalesce(starts_with({PROTO.format(x='datastream_location')}, 'http'), false)
UNION ALL SELECT request_id, 'location_not_ascii' FROM {{src}} WHERE datastream_location <> '' AND regexp_matches(datastream_location, '[^\\x00-\\x7F]')"""

ITEM_CTES = f"""prep AS ({REQ_PREP}),
rrej AS ({REQ_RULES.format(src='prep')}
  UNION ALL {REQ_LOCATION.format(src='prep')}
  UNION ALL SELECT request_id, 'invalid_creator_role' FROM prep WHERE creator_role NOT IN {_in(K.CREATOR_ROLES)}
  UNION ALL SELECT request_id, 'invalid_accessible_to' FROM prep WHERE accessible_to NOT IN {_in(K.FILE_RIGHTS)}
  UNION ALL SELECT request_id, 'invalid_visible_to' FROM prep WHERE visible_to NOT IN {_in(K.FILE_RIGHTS)}
  UNION ALL SELECT request_id, 'owner_missing' FROM prep WHERE owner_id IS NULL
  UNION ALL SELECT request_id, 'dataset_not_found' FROM prep WHERE dataset_id <> '' AND dataset_id NOT IN (SELECT pid FROM object_catalog)),
okreq AS (SELECT * FROM prep WHERE request_id NOT IN (SELECT request_id FROM rrej)),
located AS ({LOCATED.replace('FROM item_requests r', 'FROM okreq r')}),
lp AS ({LOCATED_PID}),
ifiles AS (SELECT o.request_id, o.dataset_id, {SDO('o.path_in_dataset')} AS sdo_name,
    CASE WHEN o.file_location <> '' THEN 'M' ELSE 'R' END AS control_group,
    CASE WHEN o.file_location = '' THEN o.datastream_location END AS ds_location,
    o.format AS mime_type, TRY_CAST(o.size AS BIGINT) AS size,
    CASE WHEN lp.ancestor_path = coalesce({PARENT('o.path_in_dataset')}, '') THEN 'object' ELSE 'objectSDO' END AS parent_kind,
    CASE WHEN lp.ancestor_path = coalesce({PARENT('o.path_in_dataset')}, '') THEN 'info:fedora/' || lp.ancestor_pid
         ELSE {SDO(f"coalesce({PARENT('o.path_in_dataset')}, '')")} END AS parent_object,
    o.accessible_to, o.visible_to, o.creator_role, o.owner_id
  FROM okreq o JOIN lp USING (request_id))"""
ITEM_BINDINGS = ("item_requests", "folder_catalog", "object_catalog")


# ---------------------------------------------------------------- dataset job
def _stage(code: str) -> int:
    return STAGES[code]


N10_CTES = f"""flags AS ({FLAGS}),
d AS (SELECT dp.*, (NOT skip_payload AND doi IS NOT NULL) AS stage_payload, {CATEGORY} AS default_accessible,
        coalesce(f.has_dataset_xml, false) AS has_dataset_xml, coalesce(f.has_files_xml, false) AS has_files_xml,
        coalesce(f.has_sha1_manifest, false) AS has_sha1_manifest, coalesce(f.has_agreements, false) AS has_agreements,
        coalesce(f.has_message, false) AS has_message
      FROM deposits dp LEFT JOIN flags f USING (deposit_id)),
pm AS ({PARSED('payload_manifest')}),
bag_paths AS (SELECT DISTINCT deposit_id, path FROM pm WHERE path IS NOT NULL),
disc AS ({DISC}),
aud AS (SELECT a.deposit_id, a.pos, a.audience, disc.pid AS discipline_pid FROM audiences a JOIN d USING (deposit_id) LEFT JOIN disc USING (audience)),
{LIC_CTES},
md AS ({MD}),
sha1 AS ({SHA1}),
gfiles AS (SELECT pf.deposit_id, pf.path, pf.size, pf.is_dir, {DREL('pf.path')} AS dataset_path, d.default_accessible, d.has_files_xml,
                  md.format AS mime_type, md.title, md.access_rights, md.accessible_to AS acc, md.visible_to AS vis, s.checksum, u.uri
           FROM payload_listing pf JOIN d ON pf.deposit_id = d.deposit_id AND d.stage_payload
           LEFT JOIN md ON md.deposit_id = pf.deposit_id AND md.filepath = pf.path
           LEFT JOIN sha1 s ON s.deposit_id = pf.deposit_id AND s.path = pf.path
           LEFT JOIN payload_uris u ON u.deposit_id = pf.deposit_id AND u.path = pf.path
           WHERE NOT pf.is_dir),
found AS (
  SELECT deposit_id, CAST(NULL AS VARCHAR) AS item, -1 AS stage, 'owner_missing' AS code, 'depositor.userId is missing' AS message, '' AS ord FROM d WHERE {BLANK('owner_id')}
  UNION ALL SELECT deposit_id, NULL AS item, {_stage('invalid_state')} AS stage, 'invalid_state' AS code, 'Not a valid state: ' || coalesce(state, 'null') AS message, '' AS ord
  FROM d WHERE coalesce(state NOT IN {_in(STATES)}, true)
  UNION ALL SELECT u.deposit_id, u.path, {_stage('uri_not_in_bag')}, 'uri_not_in_bag',
    'The fileUris map must reference a subset of all files in the bag. Not found in bag: ' || u.path, u.path
  FROM (SELECT DISTINCT deposit_id, path FROM payload_uris WHERE deposit_id IN (SELECT deposit_id FROM d)) u
  WHERE NOT EXISTS (SELECT 1 FROM bag_paths b WHERE b.deposit_id = u.deposit_id AND b.path = u.path)
  UNION ALL SELECT deposit_id, NULL, {_stage('no_data_dir')}, 'no_data_dir', 'Bag doesn''t contain data directory.', ''
  FROM d WHERE deposit_id NOT IN (SELECT deposit_id FROM payload_listing)
  UNION ALL SELECT deposit_id, NULL, {_stage('dataset_xml_missing')}, 'dataset_xml_missing', 'Couldn''t find metadata/dataset.xml', '' FROM d WHERE NOT has_dataset_xml
  UNION ALL SELECT deposit_id, NULL, {_stage('invalid_archive')}, 'invalid_archive', 'Not a valid archive: ' || coalesce(archive, 'null'), ''
  FROM d WHERE coalesce(archive NOT IN {_in(ARCHIVES)}, true)
  UNION ALL SELECT deposit_id, item, stage, code, message, code FROM lic_rejects WHERE deposit_id IN (SELECT deposit_id FROM d)
  UNION ALL SELECT deposit_id, NULL, {_stage('urn_missing')}, 'urn_missing', 'URN must be provided', '' FROM d WHERE urn IS NULL
  UNION ALL SELECT deposit_id, audience, {_stage('unknown_audience')}, 'unknown_audience', 'key not found: ' || audience, 'a' || CAST(pos AS VARCHAR) FROM aud WHERE discipline_pid IS NULL
  UNION ALL SELECT deposit_id, NULL, {_stage('unknown_access_category')}, 'unknown_access_category', 'key not found: ' || coalesce(access_category, 'null'), 'b'
  FROM d WHERE default_accessible IS NULL
  UNION ALL SELECT deposit_id, 'metadata/files.xml', {_stage('bag_metadata_missing')}, 'bag_metadata_missing', 'File metadata/files.xml does not exist', ''
  FROM d WHERE include_bag_metadata AND NOT has_files_xml
  UNION ALL SELECT deposit_id, raw, {_stage('bad_manifest_line')}, 'bad_manifest_line',
    'Invalid line in manifest-sha1.txt: ' || checksum || coalesce(' ' || path, ''), lpad(CAST(line_no AS VARCHAR), 19, '0')
  FROM (SELECT p.*, m.raw FROM pm p JOIN payload_manifest m USING (deposit_id, algorithm, line_no))
  WHERE NOT {OK_DEFAULT} AND deposit_id IN (SELECT deposit_id FROM d WHERE stage_payload)
  UNION ALL SELECT deposit_id, path, {_stage('files_xml_missing')}, 'files_xml_missing', 'Unable to find `metadata/files.xml` in bag.', '1' FROM gfiles WHERE NOT has_files_xml
  UNION ALL SELECT deposit_id, path, {_stage('format_not_unique')}, 'format_not_unique', 'format element doesn''t exist for the file, or isn''t unique.', '2'
  FROM gfiles WHERE has_files_xml AND mime_type IS NULL
  UNION ALL SELECT deposit_id, path, {_stage('bad_url')}, 'bad_url', 'Not a valid URL: ' || uri, '3' FROM gfiles
  WHERE uri IS NOT NULL AND {PROTO.format(x='uri')} NOT IN ('http', 'https', 'ftp', 'file', 'jar', 'mailto')),
rejects AS (SELECT deposit_id, item, stage, code, message FROM (
  SELECT *, min(stage) OVER (PARTITION BY deposit_id) AS least, row_number() OVER (PARTITION BY deposit_id, stage ORDER BY ord) AS nth,
    row_number() OVER (PARTITION BY deposit_id, stage, item ORDER BY ord) AS nth_of_file FROM found)
  WHERE stage = least AND CASE WHEN stage = 14 THEN nth_of_file ELSE nth END = 1),
acc AS (SELECT * FROM d WHERE deposit_id NOT IN (SELECT deposit_id FROM rejects)),
afiles AS (SELECT * FROM gfiles WHERE deposit_id IN (SELECT deposit_id FROM acc)),
aentries AS (SELECT deposit_id, path, is_dir, {DREL('path')} AS dataset_path FROM payload_listing
             WHERE path <> 'data' AND deposit_id IN (SELECT deposit_id FROM acc WHERE stage_payload))"""
N10_BINDINGS = ("deposits", "payload_listing", "file_metadata", "payload_manifest", "payload_uris", "audiences", "discipline_xml",
                "bag_documents") + LIC_BINDINGS


def _with(ctes: str, body: str, *bindings: str) -> str:
    """Bindings first, then extra CTEs, then the body."""
    inner = with_bindings(f"SELECT 1", *bindings)
    head = inner[: inner.rfind("SELECT 1")].rstrip()
    if head:
        return f"{head},\n{ctes}\n{body}"
    return f"WITH {ctes}\n{body}"


def _item_config(namespace: str, src: str, model: str, datastreams: list[str]) -> str:
    """Configuration rows of files or folders; a datastream is name, content file, location, label, control group, MIME type, checksum type and checksum."""
    columns = ["name", "content_file", "ds_location", "label", "control_group", "mime_type", "checksum_type", "checksum", "object", "object_sdo", "is_literal"]
    ds = [f"{d}, NULL, NULL, CAST(NULL AS BOOLEAN)" for d in datastreams]
    blank = ", ".join(["NULL"] * 7)
    rel = [("http://dans.knaw.nl/ontologies/relations#isMemberOf", "NULL, parent_sdo"), ("http://dans.knaw.nl/ontologies/relations#isSubordinateTo", f"NULL, '{K.DATASET_SDO}'"),
           ("info:fedora/fedora-system:def/model#hasModel", f"'info:fedora/{model}', NULL"), ("info:fedora/fedora-system:def/model#hasModel", "'info:fedora/dans-container-item-v1', NULL")]
    rows = [("datastream", i, d) for i, d in enumerate(ds)] + [("relation", i, f"'{p}', {blank}, {o}, NULL") for i, (p, o) in enumerate(rel)]
    selects = [f"SELECT deposit_id, sdo_name, '{namespace}', '{element}', {i}, {row} FROM {src}" for element, i, row in rows]
    return _config_columns(f"(SELECT * FROM ({' UNION ALL '.join(selects)}) AS t(deposit_id, sdo_name, namespace, element, nth, {', '.join(columns)}))")


def _config_columns(src: str) -> str:
    texts = ["name", "content_file", "ds_location", "label", "control_group", "mime_type", "checksum_type", "checksum", "object", "object_sdo"]
    return f"SELECT deposit_id, sdo_name, namespace, element, nth, {', '.join(f'CAST({c} AS VARCHAR) AS {c}' for c in texts)}, is_literal FROM {src}"


ORACLES: dict[str, str] = {
    # ---------------------------------------------------------------- sources / sinks
    "S01_scan_deposits": _with(
        r"""own AS (SELECT deposit_id, arg_min(trim(regexp_extract(value, '^\s*depositor\.userId\s*[=:]\s*(.*)$', 1)), line_no) AS owner_id
  FROM property_lines WHERE regexp_matches(value, '^\s*depositor\.userId\s*[=:]') GROUP BY deposit_id)""",
        """SELECT b.deposit_id, owner_id, bag_dir FROM (SELECT deposit_id, min(name) AS bag_dir FROM deposit_dirs WHERE is_dir AND name <> '.git' GROUP BY deposit_id) b
LEFT JOIN own ON own.deposit_id = b.deposit_id""",
        "property_lines", "deposit_dirs"),
    "S02_scan_payload": _with(
        "bags AS (SELECT deposit_id, min(name) AS bag FROM deposit_dirs WHERE is_dir AND name <> '.git' GROUP BY deposit_id)",
        "SELECT deposit_id, bag, path, size, is_dir FROM payload_listing JOIN bags USING (deposit_id)",
        "payload_listing", "deposit_dirs"),
    "S03_scan_manifests": with_bindings(PARSED("manifest_lines"), "manifest_lines"),
    "S04_parse_file_records": with_bindings(
        "SELECT deposit_id, filepath, " + ", ".join(
            f"CAST(len({c}) AS INTEGER) AS n_{c}, array_to_string({c}, '|') AS {c}_text"
            for c in ["format", "title", "access_rights", "accessible_to", "visible_to"]) + " FROM file_metadata",
        "file_metadata"),
    "S05_parse_dataset_metadata": with_bindings(
        """SELECT dp.deposit_id,
  coalesce((SELECT string_agg(audience, '|' ORDER BY pos) FROM audiences a WHERE a.deposit_id = dp.deposit_id), '') AS audiences,
  coalesce((SELECT string_agg(created, '|' ORDER BY pos) FROM created c WHERE c.deposit_id = dp.deposit_id), '') AS created,
  coalesce((SELECT string_agg(rights_holder, '|' ORDER BY pos) FROM rights_holders r WHERE r.deposit_id = dp.deposit_id), '') AS rights_holders,
  coalesce((SELECT string_agg(text, '|' ORDER BY pos) FROM license_elements l WHERE l.deposit_id = dp.deposit_id), '') AS license_texts,
  coalesce((SELECT string_agg(coalesce(xsi_type, '-'), '|' ORDER BY pos) FROM license_elements l WHERE l.deposit_id = dp.deposit_id), '') AS license_types,
  CAST((SELECT count(*) FROM license_elements l WHERE l.deposit_id = dp.deposit_id) AS INTEGER) AS n_licenses
FROM deposits dp""",
        "deposits", "audiences", "created", "rights_holders", "license_elements"),
    "S06_parse_agreements": _with(
        "fs AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY deposit_id ORDER BY pos) AS rn FROM agreement_signers) WHERE rn = 1)",
        """SELECT a.deposit_id, a.is_valid,
  CASE WHEN a.is_valid THEN a.accepted_text END AS accepted_text, CASE WHEN a.is_valid THEN a.privacy_text END AS privacy_text,
  CASE WHEN a.is_valid THEN fs.name END AS name, CASE WHEN a.is_valid THEN fs.account END AS account,
  CASE WHEN a.is_valid THEN fs.email END AS email
FROM agreements a LEFT JOIN fs USING (deposit_id)""",
        "agreements", "agreement_signers"),
    "S09_scan_item_requests": with_bindings("SELECT * FROM item_requests WHERE request_id % 20 <> 0", "item_requests"),
    "S07_scan_messages": with_bindings(
        f"SELECT deposit_id, text, CASE WHEN text IS NULL OR {BLANK('text')} THEN '' ELSE replace(replace(text, '<', '&lt;'), '>', '&gt;') END AS message FROM messages",
        "messages"),
    "S08_parse_uri_mapping": _with(
        rf"""p AS (SELECT deposit_id, line_no, regexp_matches(line, '^(.*)\s+(.*)$') AS ok,
              {JTRIM(r"regexp_extract(line, '^(.*)\s+(.*)$', 1)")} AS path,
              {JTRIM(r"regexp_extract(line, '^(.*)\s+(.*)$', 2)")} AS uri
            FROM uri_lines WHERE line <> ''),
good AS (SELECT deposit_id, path, arg_max(uri, line_no) AS uri FROM p WHERE ok GROUP BY deposit_id, path),
bad AS (SELECT deposit_id, count(*) AS n FROM p WHERE NOT ok GROUP BY deposit_id)""",
        "SELECT g.deposit_id, g.path, g.uri, CAST(coalesce(b.n, 0) AS BIGINT) AS bad_lines FROM good g LEFT JOIN bad b USING (deposit_id)",
        "uri_lines",
    ),
    "S10_scan_folder_catalog": with_bindings("SELECT pid, path, dataset_sid, regexp_replace(path, '/$', '') AS norm_path FROM all_folders", "all_folders"),
    "S11_discipline_catalog": with_bindings(
        "SELECT regexp_extract(regexp_extract(xml, '<setSpec[^>]*>([^<]*)</setSpec>', 1), '([^:]*)$', 1) AS audience, pid FROM all_disciplines",
        "all_disciplines"),
    "S12_license_catalog": with_bindings(
        "SELECT c.uri, c.file_name, t.content FROM all_licenses c "
        "LEFT JOIN (SELECT file_name, min(content) AS content FROM all_licenses GROUP BY file_name) t USING (file_name)",
        "all_licenses"),
    "S13_object_catalog": with_bindings("SELECT DISTINCT pid FROM all_objects", "all_objects"),
    "K03_bag_metadata_documents": _with(
        f"flags AS ({FLAGS}), dd AS (SELECT dp.deposit_id, f.* EXCLUDE (deposit_id) FROM deposits dp LEFT JOIN flags f USING (deposit_id) WHERE dp.include_bag_metadata)",
        """SELECT deposit_id, 'dataset.xml' AS file_name, CASE WHEN coalesce(has_dataset_xml, false) THEN 'copy' ELSE 'missing' END AS status FROM dd
UNION ALL SELECT deposit_id, 'files.xml', CASE WHEN coalesce(has_files_xml, false) THEN 'copy' ELSE 'missing' END FROM dd
UNION ALL SELECT deposit_id, 'manifest-sha1.txt', 'copy' FROM dd WHERE has_sha1_manifest
UNION ALL SELECT deposit_id, 'agreements.xml', 'copy' FROM dd WHERE has_agreements
UNION ALL SELECT deposit_id, 'message-from-depositor.txt', 'copy' FROM dd WHERE has_message""".replace(
            "'dataset.xml' AS file_name, CASE WHEN coalesce(has_dataset_xml, false) THEN 'copy' ELSE 'missing' END",
            "CASE WHEN coalesce(has_dataset_xml, false) THEN 'dataset.xml' ELSE 'metadata/dataset.xml' END AS file_name, CASE WHEN coalesce(has_dataset_xml, false) THEN 'copy' ELSE 'missing' END",
        ).replace(
            "'files.xml', CASE WHEN coalesce(has_files_xml, false) THEN 'copy' ELSE 'missing' END",
            "CASE WHEN coalesce(has_files_xml, false) THEN 'files.xml' ELSE 'metadata/files.xml' END, CASE WHEN coalesce(has_files_xml, false) THEN 'copy' ELSE 'missing' END",
        ),
        "deposits", "bag_documents"),
    "K04_copy_plan": _with(
        f"items AS ({PAYLOAD_ITEMS})",
        "SELECT i.deposit_id, i.sdo_name, i.path AS source, i.sdo_name || '/EASY_FILE' AS target FROM items i "
        "WHERE NOT EXISTS (SELECT 1 FROM payload_uris u WHERE u.deposit_id = i.deposit_id AND u.path = i.path)",
        "payload_files", "payload_uris"),
    # ---------------------------------------------------------------- projections / checks
    "P01_with_paths": with_bindings(
        f"SELECT deposit_id, path, {DREL('path')} AS dataset_path, {NAME(DREL('path'))} AS name, {PARENT(DREL('path'))} AS parent_path FROM payload_files",
        "payload_files"),
    "P02_sdo_name": with_bindings(
        f"SELECT request_id, {SDO('path_in_dataset')} AS sdo_name, replace(dataset_id, ':', '_') AS set_name FROM item_requests",
        "item_requests"),
    "P03_check_state": with_bindings(
        f"SELECT deposit_id, 'invalid_state' AS code, 'Not a valid state: ' || coalesce(state, 'null') AS message FROM deposits WHERE coalesce(state NOT IN {_in(STATES)}, true)",
        "deposits"),
    "P04_check_urn": with_bindings("SELECT deposit_id, 'urn_missing' AS code, 'URN must be provided' AS message FROM deposits WHERE urn IS NULL", "deposits"),
    "P05_check_archive": with_bindings(
        f"SELECT deposit_id, 'invalid_archive' AS code, 'Not a valid archive: ' || coalesce(archive, 'null') AS message FROM deposits WHERE coalesce(archive NOT IN {_in(ARCHIVES)}, true)",
        "deposits"),
    "P06_payload_gate": with_bindings(
        "SELECT pf.deposit_id, pf.path FROM payload_files pf JOIN deposits dp ON pf.deposit_id = dp.deposit_id WHERE NOT dp.skip_payload AND dp.doi IS NOT NULL",
        "payload_files", "deposits"),
    "P07_content_kind": with_bindings(
        """SELECT pf.deposit_id, pf.path, CASE WHEN u.uri IS NULL THEN 'M' ELSE 'R' END AS control_group,
   CASE WHEN u.uri IS NULL THEN 'EASY_FILE' END AS content_file, u.uri AS ds_location
FROM payload_files pf LEFT JOIN payload_uris u ON u.deposit_id = pf.deposit_id AND u.path = pf.path""",
        "payload_files", "payload_uris"),
    "P08_check_request_rules": with_bindings(REQ_RULES.format(src="item_requests"), "item_requests"),
    "P09_check_location": with_bindings(REQ_LOCATION.format(src="item_requests"), "item_requests"),
    "P10_check_creator_role": with_bindings(
        f"SELECT request_id, 'invalid_creator_role' AS code FROM item_requests WHERE (CASE WHEN {BLANK('creator_role')} THEN 'DEPOSITOR' ELSE creator_role END) NOT IN {_in(K.CREATOR_ROLES)}",
        "item_requests"),
    "P11_apply_request_defaults": with_bindings(
        f"""SELECT request_id, CASE WHEN {BLANK('accessible_to')} THEN 'NONE' ELSE accessible_to END AS accessible_to,
  CASE WHEN {BLANK('visible_to')} THEN 'ANONYMOUS' ELSE visible_to END AS visible_to,
  CASE WHEN {BLANK('creator_role')} THEN 'DEPOSITOR' ELSE creator_role END AS creator_role FROM item_requests""",
        "item_requests"),
    "P12_drop_empty_requests": with_bindings(
        "SELECT request_id FROM item_requests WHERE concat(path_in_dataset, format, datastream_location, size, file_location, dataset_id, accessible_to, visible_to, creator_role, owner_id) <> ''",
        "item_requests"),
    "P14_parse_rights": with_bindings(
        f"SELECT raw, {RIGHTS('raw')} AS parsed FROM (SELECT DISTINCT unnest(list_concat(access_rights, accessible_to, visible_to)) AS raw FROM file_metadata)",
        "file_metadata"),
    "P15_effective_access": _with(
        f"md AS ({MD})",
        f"""SELECT pf.deposit_id, pf.path, coalesce({RIGHTS('coalesce(md.access_rights, md.accessible_to)')}, {CATEGORY.replace('access_category', 'dp.access_category')}) AS accessible_to
FROM payload_files pf JOIN deposits dp USING (deposit_id) LEFT JOIN md ON md.deposit_id = pf.deposit_id AND md.filepath = pf.path""",
        "payload_files", "deposits", "file_metadata"),
    "P16_effective_visible": _with(
        f"md AS ({MD})",
        f"""SELECT pf.deposit_id, pf.path, coalesce({RIGHTS('md.visible_to')}, 'ANONYMOUS') AS visible_to
FROM payload_files pf JOIN deposits dp USING (deposit_id) LEFT JOIN md ON md.deposit_id = pf.deposit_id AND md.filepath = pf.path""",
        "payload_files", "deposits", "file_metadata"),
    "P17_effective_title": _with(
        f"md AS ({MD})",
        f"""SELECT pf.deposit_id, pf.path, coalesce(md.title, {NAME(DREL('pf.path'))}) AS title
FROM payload_files pf JOIN deposits dp USING (deposit_id) LEFT JOIN md ON md.deposit_id = pf.deposit_id AND md.filepath = pf.path""",
        "payload_files", "deposits", "file_metadata"),
    "P18_clean_owner": with_bindings(f"SELECT request_id, CASE WHEN {BLANK('owner_id')} THEN NULL ELSE {JTRIM('owner_id')} END AS owner_id FROM item_requests", "item_requests"),
    "P19_check_manifest_lines": _with(
        f"allm AS (SELECT * FROM manifest_lines UNION ALL SELECT * FROM payload_manifest), p AS ({PARSED('allm')})",
        f"SELECT deposit_id, algorithm, line_no, {OK_DEFAULT} AS ok_default, {OK_STRICT} AS ok_strict FROM p",
        "manifest_lines", "payload_manifest"),
    "P20_identifiers": with_bindings(
        f"""SELECT deposit_id, 1 AS pos, urn AS value, '{K.SCHEME_PID}' AS scheme, '{K.PID_SYSTEM}' AS id_system FROM deposits WHERE urn IS NOT NULL
UNION ALL SELECT deposit_id, 2, doi, CASE WHEN other_access_doi THEN '{K.SCHEME_DOI_OTHER_ACCESS}' ELSE '{K.SCHEME_DOI}' END, '{K.DOI_RESOLVER}' FROM deposits WHERE doi IS NOT NULL
UNION ALL SELECT deposit_id, 3, '{K.DMO_ID_PLACEHOLDER}', '{K.SCHEME_DMO_ID}', NULL FROM deposits""",
        "deposits"),
    "P21_extra_descriptions": with_bindings(
        "SELECT deposit_id, extra_description AS description FROM deposits WHERE skip_payload AND extra_description IS NOT NULL", "deposits"),
    "P22_dataset_admin": _with(f"signer AS ({SIGNER}), info AS ({INFO})",
                               "SELECT dp.deposit_id, dp.archive AS archive_location, info.accepted_license FROM deposits dp JOIN info USING (deposit_id)",
                               *INFO_BINDINGS),
    "P23_fox_label": with_bindings(f"SELECT doc_id, substring(label_text, 1, {K.MAX_LABEL_LENGTH}) AS label FROM label_texts", "label_texts"),
    # ---------------------------------------------------------------- joins
    "J01_uris_not_in_bag": _with(
        f"bag AS (SELECT DISTINCT deposit_id, path FROM ({PARSED('manifest_lines')}) WHERE path IS NOT NULL)",
        "SELECT DISTINCT deposit_id, path FROM external_uris e WHERE NOT EXISTS (SELECT 1 FROM bag b WHERE b.deposit_id = e.deposit_id AND b.path = e.path)",
        "manifest_lines", "external_uris"),
    "J02_join_file_metadata": _with(
        f"md AS ({MD})",
        "SELECT pf.deposit_id, pf.path, md.format, md.n_format FROM payload_files pf LEFT JOIN md ON md.deposit_id = pf.deposit_id AND md.filepath = pf.path",
        "payload_files", "file_metadata"),
    "J03_join_checksums": _with(
        f"sha1 AS ({SHA1})",
        "SELECT pf.deposit_id, pf.path, s.checksum FROM payload_files pf LEFT JOIN sha1 s ON s.deposit_id = pf.deposit_id AND s.path = pf.path",
        "payload_files", "payload_manifest"),
    "J04_join_external": with_bindings(
        "SELECT pf.deposit_id, pf.path, u.uri FROM payload_files pf LEFT JOIN payload_uris u ON u.deposit_id = pf.deposit_id AND u.path = pf.path",
        "payload_files", "payload_uris"),
    "J05_join_disciplines": _with(f"disc AS ({DISC})",
                                  "SELECT a.deposit_id, a.pos, a.audience, disc.pid AS discipline_pid FROM audiences a LEFT JOIN disc USING (audience)",
                                  "audiences", "discipline_xml"),
    "J06_default_rights": with_bindings(f"SELECT deposit_id, access_category, {CATEGORY} AS default_accessible FROM deposits", "deposits"),
    "J07_match_license": _with(
        "cat AS (SELECT uri, max(file_name) AS file_name FROM license_catalog GROUP BY uri)",
        """SELECT le.deposit_id, le.pos, le.text,
  coalesce((SELECT file_name FROM cat WHERE cat.uri = regexp_replace(le.text, '^https:', 'http:')),
           (SELECT file_name FROM cat WHERE right(le.text, 1) = '/' AND cat.uri = left(regexp_replace(le.text, '^https:', 'http:'), length(regexp_replace(le.text, '^https:', 'http:')) - 1))) AS license_file
FROM license_elements le""",
        "license_elements", "license_catalog"),
    "J08_nearest_ancestor": _with(f"located AS ({LOCATED}), lp AS ({LOCATED_PID})",
                                  "SELECT request_id, ancestor_path, ancestor_pid FROM lp", "item_requests", "folder_catalog"),
    "J09_parent_sdo": _with(f"items AS ({PAYLOAD_ITEMS})", "SELECT deposit_id, path, sdo_name, parent_sdo FROM items", "payload_files"),
    "J10_check_dataset_exists": with_bindings(
        "SELECT request_id, dataset_id, dataset_id IN (SELECT pid FROM object_catalog) AS dataset_exists FROM item_requests",
        "item_requests", "object_catalog"),
    "J11_request_parent": _with(
        f"located AS ({LOCATED}), lp AS ({LOCATED_PID})",
        f"""SELECT request_id,
  CASE WHEN ancestor_path = coalesce({PARENT('path_in_dataset')}, '') THEN 'object' ELSE 'objectSDO' END AS parent_kind,
  CASE WHEN ancestor_path = coalesce({PARENT('path_in_dataset')}, '') THEN 'info:fedora/' || ancestor_pid
       ELSE {SDO(f"coalesce({PARENT('path_in_dataset')}, '')")} END AS parent_object FROM lp""",
        "item_requests", "folder_catalog"),
    "J12_accepted": _with(N10_CTES, "SELECT deposit_id FROM acc", *N10_BINDINGS),
    # ---------------------------------------------------------------- aggregations
    "A01_single_value": _with(f"md AS ({MD})", "SELECT deposit_id, filepath, format, title, n_format, n_title FROM md", "file_metadata"),
    "A02_last_by": _with(f"p AS ({PARSED('manifest_lines')})",
                         "SELECT deposit_id, algorithm, path, arg_max(checksum, line_no) AS checksum FROM p WHERE path IS NOT NULL GROUP BY ALL",
                         "manifest_lines"),
    "A03_require_format": _with(
        "fm AS (SELECT deposit_id, filepath, unnest(format) AS v FROM file_metadata)",
        """SELECT pf.deposit_id, pf.path FROM payload_files pf
WHERE NOT EXISTS (SELECT 1 FROM fm WHERE fm.deposit_id = pf.deposit_id AND fm.filepath = pf.path GROUP BY ALL HAVING count(*) = 1)""",
        "payload_files", "file_metadata"),
    "A04_rights_holders": with_bindings(
        "SELECT deposit_id, string_agg(rights_holder, ', ' ORDER BY pos) AS rights_holders, count(*) AS n_rights_holders FROM rights_holders GROUP BY deposit_id",
        "rights_holders"),
    "A05_check_cardinality": _with(
        "nl AS (SELECT deposit_id, count(*) AS n_licenses FROM license_elements GROUP BY 1), nc AS (SELECT deposit_id, count(*) AS n_created FROM created GROUP BY 1)",
        """SELECT nl.deposit_id, nl.n_licenses, CAST(coalesce(nc.n_created, 0) AS BIGINT) AS n_created,
  CASE WHEN nl.n_licenses > 1 THEN 'license_count' WHEN coalesce(nc.n_created, 0) <> 1 THEN 'created_not_one' ELSE 'ok' END AS outcome
FROM nl LEFT JOIN nc USING (deposit_id)""",
        "license_elements", "created"),
    "A06_dataset_datastreams": _with(
        f"flags AS ({FLAGS}), dflags AS (SELECT dp.*, f.* EXCLUDE (deposit_id) FROM deposits dp LEFT JOIN flags f USING (deposit_id)), {LIC_CTES.strip()}",
        DATASTREAMS, "deposits", "bag_documents", *LIC_BINDINGS),
    "A07_dataset_relations": _with(f"disc AS ({DISC})", RELATIONS, "deposits", "audiences", "discipline_xml"),
    "A08_catalog": _with(f"disc AS ({DISC.replace('discipline_xml', 'all_disciplines')})", "SELECT audience, pid FROM disc", "all_disciplines"),
    "A09_collect_failures": _with(
        N10_CTES,
        """SELECT deposit_id, count(*) AS n_failures, count(DISTINCT code) AS n_codes, min(message) AS first_message FROM (
  SELECT deposit_id, code, message FROM found
  UNION ALL SELECT deposit_id, 'bag_metadata_missing', 'File metadata/dataset.xml does not exist' FROM d WHERE include_bag_metadata AND NOT has_dataset_xml) GROUP BY deposit_id""",
        *N10_BINDINGS),
    "A10_first_failure": _with(
        N10_CTES,
        """SELECT deposit_id, stage, code, message, item FROM (
  SELECT *, row_number() OVER (PARTITION BY deposit_id ORDER BY stage, code, coalesce(item, ''), message) AS rn FROM rejects) WHERE rn = 1""",
        *N10_BINDINGS),
    "A11_batch_outcome": _with(
        ITEM_CTES,
        "SELECT CASE WHEN request_id IN (SELECT request_id FROM rrej) THEN 'FAILED' ELSE 'SUCCESS' END AS status, count(*) AS n FROM prep GROUP BY 1",
        *ITEM_BINDINGS),
    "A12_bag_flags": with_bindings(FLAGS, "bag_documents"),
    "A13_sdo_collisions": with_bindings(
        f"SELECT deposit_id, {SDO('path')} AS sdo_name, count(DISTINCT path) AS n_paths FROM collision_items GROUP BY 1, 2 HAVING count(DISTINCT path) > 1",
        "collision_items"),
    # ---------------------------------------------------------------- order
    "T01_first_by": with_bindings(
        """SELECT deposit_id, name, account, email FROM (
  SELECT *, row_number() OVER (PARTITION BY deposit_id ORDER BY pos) AS rn FROM agreement_signers) WHERE rn = 1""",
        "agreement_signers"),
    "T02_first_match": with_bindings("SELECT deposit_id, min(name) AS bag_dir FROM deposit_dirs WHERE is_dir AND name <> '.git' GROUP BY deposit_id", "deposit_dirs"),
    "T03_stable_order": _with(f"disc AS ({DISC}), rel AS ({RELATIONS})",
                              "SELECT deposit_id, string_agg(predicate, '|' ORDER BY ord) AS predicates FROM rel GROUP BY deposit_id",
                              "deposits", "audiences", "discipline_xml"),
    # ---------------------------------------------------------------- sets
    "U01_paths_in_bag": with_bindings(f"SELECT DISTINCT deposit_id, path FROM ({PARSED('manifest_lines')}) WHERE path IS NOT NULL", "manifest_lines"),
    "U02_declared_minus_bag": with_bindings(
        f"SELECT deposit_id, path FROM external_uris EXCEPT SELECT deposit_id, path FROM ({PARSED('manifest_lines')}) WHERE path IS NOT NULL",
        "manifest_lines", "external_uris"),
    "U03_header_audit": _with(
        "hc AS (SELECT file_id, lower(\"column\") AS col FROM header_columns), req AS (SELECT * FROM (VALUES "
        + ", ".join(f"({_q(o)})" for o in K.REQUEST_OPTIONS) + ") AS r(col))",
        """SELECT f.file_id, r.col AS "column", 'missing' AS kind FROM (SELECT DISTINCT file_id FROM hc) f, req r
WHERE r.col NOT IN (SELECT col FROM hc WHERE hc.file_id = f.file_id)
UNION ALL SELECT DISTINCT file_id, col, 'ignored' FROM hc WHERE col NOT IN (SELECT col FROM req)""",
        "header_columns"),
    "U03_request_files": """
WITH o AS (SELECT ['path-in-dataset', 'format', 'datastream-location', 'size', 'file-location', 'dataset-id', 'accessible-to', 'visible-to', 'creator-role', 'owner-id'] AS n),
f AS (
  SELECT 0 AS kind, list_concat(n, ['my, comment', 'request-id']) AS h, '' AS missing, 'my, comment' AS ignored FROM o
  UNION ALL SELECT 1, list_concat(['request-id'], list_reverse(n)), '', '' FROM o
  UNION ALL SELECT 2, list_concat(n[5:], n[:4], ['request-id']), '', '' FROM o
  UNION ALL SELECT 3, list_concat(['request-id'], n[:9]), 'owner-id', '' FROM o)
SELECT CAST(kind AS INTEGER) AS kind, array_to_string(h, ',') AS signature, CAST(len(h) AS INTEGER) AS n_columns, missing, ignored, missing = '' AS accepted
FROM f WHERE kind IN (SELECT CASE WHEN event_id % 20 = 0 THEN 3 ELSE event_id % 3 END FROM events)
""",
    "U04_all_sdos": _with(
        f"items AS ({PAYLOAD_ITEMS}), entries AS ({PAYLOAD_ENTRIES})",
        f"""SELECT deposit_id, '{K.DATASET_SDO}' AS sdo_name, 'dataset' AS kind FROM deposits
UNION ALL SELECT deposit_id, sdo_name, 'folder' FROM ({FOLDERS('entries')})
UNION ALL SELECT deposit_id, sdo_name, 'file' FROM items""",
        "deposits", "payload_files", "payload_listing"),
    # ---------------------------------------------------------------- scalar functions
    "F01_signer_display_name": _with(f"signer AS ({SIGNER})", f"SELECT deposit_id, {DISPLAY()} AS display_name FROM signer", "agreement_signers"),
    "F02_privacy_sentence": _with(f"signer AS ({SIGNER}), info AS ({INFO})", "SELECT deposit_id, privacy_remark FROM info", *INFO_BINDINGS),
    "F03_loose_boolean": with_bindings(
        f"SELECT text, {LOOSE.format(x='text')} AS value FROM (SELECT accepted_text AS text FROM agreements UNION SELECT privacy_text FROM agreements) WHERE text IS NOT NULL",
        "agreements"),
    "F04_accepted_license": _with(f"signer AS ({SIGNER}), info AS ({INFO})", "SELECT deposit_id, accepted_license FROM info", *INFO_BINDINGS),
    "F05_clean_message": with_bindings(
        f"SELECT deposit_id, CASE WHEN text IS NULL OR {BLANK('text')} THEN '' ELSE replace(replace(text, '<', '&lt;'), '>', '&gt;') END AS message FROM messages",
        "messages"),
    "F06_remark": _with(f"signer AS ({SIGNER}), info AS ({INFO})", f"SELECT deposit_id, {REMARK} AS remark FROM info", *INFO_BINDINGS),
    "F07_state_history": with_bindings(
        "SELECT deposit_id, 'DRAFT' AS from_state, state AS to_state, strftime(submission_ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS change_date FROM deposits WHERE state <> 'DRAFT'",
        "deposits"),
    "F08_iso_timestamp": with_bindings("SELECT deposit_id, strftime(submission_ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS ts_text FROM deposits", "deposits"),
    "F09_created_year": with_bindings(f"SELECT deposit_id, pos, created, {YEAR} AS year FROM created", "created"),
    "F10_https_to_http": "SELECT page_id, regexp_replace(url, '^https:', 'http:') AS http_url FROM pages",
    "F11_extension_mime": with_bindings(f"SELECT file_name, {MIME.format(x='file_name')} AS mime_type FROM all_licenses", "all_licenses"),
    "F12_template_fill": _with(LIC_CTES.strip(), "SELECT deposit_id, content FROM licenses WHERE is_uri AND mime_type IN ('text/plain', 'text/html')", *LIC_BINDINGS),
    "F13_license_kind": with_bindings(f"SELECT deposit_id, pos, xsi_type, {IS_URI} AS is_uri FROM license_elements LEFT JOIN ns_decls USING (deposit_id)",
                                      "license_elements", "ns_decls"),
    "F14_last_segment": with_bindings("SELECT pid, regexp_extract(pid, '([^:]*)$', 1) AS segment FROM all_disciplines", "all_disciplines"),
    "F15_relation_object": with_bindings("SELECT request_id, 'info:fedora/' || dataset_id AS subordinate_object FROM item_requests", "item_requests"),
    "F16_folder_name": _with(f"entries AS ({PAYLOAD_ENTRIES})", f"SELECT deposit_id, dataset_path AS path, {NAME('dataset_path')} AS name FROM ({FOLDERS('entries')})",
                             "payload_listing"),
    "F17_ancestor_paths": with_bindings(
        """SELECT r.request_id, depth, ancestor FROM item_requests r LEFT JOIN (
  SELECT request_id, CAST(i - 1 AS INTEGER) AS depth, array_to_string(list_slice(parts, 1, i), '/') AS ancestor
  FROM (SELECT request_id, parts, unnest(range(1, len(parts))) AS i FROM (SELECT request_id, string_split(path_in_dataset, '/') AS parts FROM item_requests))) a USING (request_id)""",
        "item_requests"),
    # ---------------------------------------------------------------- documents
    "N01_dataset_config": _with(
        f"flags AS ({FLAGS}), dflags AS (SELECT dp.*, f.* EXCLUDE (deposit_id) FROM deposits dp LEFT JOIN flags f USING (deposit_id)), {LIC_CTES.strip()}, "
        f"disc AS ({DISC}), ds AS ({DATASTREAMS}), rel AS ({RELATIONS})",
        _config_columns(f"""(SELECT deposit_id, '{K.DATASET_SDO}' AS sdo_name, 'easy-dataset' AS namespace, 'datastream' AS element, CAST(row_number() OVER (PARTITION BY deposit_id ORDER BY ord) - 1 AS INTEGER) AS nth,
  ds_id AS name, content_file, NULL AS ds_location, label, control_group, mime_type, NULL AS checksum_type, NULL AS checksum, NULL AS object, NULL AS object_sdo, CAST(NULL AS BOOLEAN) AS is_literal FROM ds
UNION ALL SELECT deposit_id, '{K.DATASET_SDO}', 'easy-dataset', 'relation', CAST(row_number() OVER (PARTITION BY deposit_id ORDER BY ord) - 1 AS INTEGER), predicate,
  NULL, NULL, NULL, NULL, NULL, NULL, NULL, object, NULL, is_literal FROM rel)"""),
        "deposits", "bag_documents", "audiences", "discipline_xml", *LIC_BINDINGS),
    "N02_file_config": _with(
        f"items AS ({PAYLOAD_ITEMS}), md AS ({MD}), sha1 AS ({SHA1}), "
        "f AS (SELECT i.*, u.uri, s.checksum, md.format AS mime_type FROM items i LEFT JOIN payload_uris u ON u.deposit_id = i.deposit_id AND u.path = i.path "
        "LEFT JOIN sha1 s ON s.deposit_id = i.deposit_id AND s.path = i.path LEFT JOIN md ON md.deposit_id = i.deposit_id AND md.filepath = i.path)",
        _item_config("easy-file", "f", "easy-model:EDM1FILE", [
            "'EASY_FILE', CASE WHEN uri IS NULL THEN 'EASY_FILE' END, uri, NULL, CASE WHEN uri IS NULL THEN 'M' ELSE 'R' END, mime_type, "
            "CASE WHEN uri IS NULL THEN 'SHA-1' END, CASE WHEN uri IS NULL THEN checksum END",
            "'EASY_FILE_METADATA', 'EASY_FILE_METADATA', NULL, NULL, 'X', 'text/xml', NULL, NULL"]),
        "payload_files", "payload_uris", "payload_manifest", "file_metadata"),
    "N03_folder_config": _with(
        f"entries AS ({PAYLOAD_ENTRIES}), fo AS ({FOLDERS('entries')})",
        _item_config("easy-folder", "fo", "easy-model:EDM1FOLDER", ["'EASY_ITEM_CONTAINER_MD', 'EASY_ITEM_CONTAINER_MD', NULL, NULL, 'X', 'text/xml', NULL, NULL"]),
        "payload_listing"),
    "N04_admin_metadata": _with(
        f"signer AS ({SIGNER}), info AS ({INFO})",
        f"""SELECT dp.deposit_id, dp.state AS dataset_state, CASE WHEN dp.state <> 'DRAFT' THEN 'DRAFT' END AS previous_state,
  CASE WHEN dp.state <> 'DRAFT' THEN strftime(dp.submission_ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' END AS last_state_change,
  dp.owner_id AS depositor_id, nullif({REMARK}, '') AS remark_text
FROM deposits dp JOIN info USING (deposit_id)""",
        *INFO_BINDINGS),
    "N06_file_metadata": _with(
        f"items AS ({PAYLOAD_ITEMS}), md AS ({MD})",
        f"""SELECT i.deposit_id, i.sdo_name, {NAME('i.dataset_path')} AS name, i.dataset_path AS path, md.format AS mime_type, i.size,
  'DEPOSITOR' AS creator_role, coalesce({RIGHTS('md.visible_to')}, 'ANONYMOUS') AS visible_to,
  coalesce({RIGHTS('coalesce(md.access_rights, md.accessible_to)')}, {CATEGORY.replace('access_category', 'dp.access_category')}) AS accessible_to
FROM items i JOIN deposits dp USING (deposit_id) LEFT JOIN md ON md.deposit_id = i.deposit_id AND md.filepath = i.path""",
        "payload_files", "deposits", "file_metadata"),
    "N07_folder_metadata": _with(f"entries AS ({PAYLOAD_ENTRIES})",
                                 f"SELECT deposit_id, sdo_name, {NAME('dataset_path')} AS name, dataset_path AS path FROM ({FOLDERS('entries')})", "payload_listing"),
    "N08_folder_sdos": _with(f"entries AS ({PAYLOAD_ENTRIES})", f"SELECT deposit_id, dataset_path, sdo_name, parent_sdo FROM ({FOLDERS('entries')})", "payload_listing"),
    "N09_ancestor_sdos": _with(
        ITEM_CTES,
        f"""SELECT DISTINCT dataset_id, anc AS path, {SDO('anc')} AS sdo_name, 'objectSDO' AS parent_kind,
  coalesce({PARENT('anc')}, replace(dataset_id, ':', '_')) AS parent_object
FROM (SELECT dataset_id, array_to_string(list_slice(parts, 1, i), '/') AS anc
      FROM (SELECT dataset_id, parts, unnest(range(1, len(parts))) AS i FROM (SELECT dataset_id, string_split(path_in_dataset, '/') AS parts FROM okreq)))""",
        *ITEM_BINDINGS),
    "K01_staged_set": _with(
        N10_CTES + f""", dflags AS (SELECT * FROM acc), ds AS ({DATASTREAMS}), rel AS ({RELATIONS.replace("FROM deposits", "FROM acc").replace("JOIN deposits", "JOIN acc")}),
nds AS (SELECT deposit_id, count(*) AS n FROM ds GROUP BY deposit_id), nrel AS (SELECT deposit_id, count(*) AS n FROM rel GROUP BY deposit_id)""",
        f"""SELECT deposit_id, '{K.DATASET_SDO}' AS sdo_name, 'dataset' AS kind, NULL AS parent_sdo, NULL AS path, nds.n AS n_datastreams, nrel.n AS n_relations
FROM acc LEFT JOIN nds USING (deposit_id) LEFT JOIN nrel USING (deposit_id)
UNION ALL SELECT f.deposit_id, f.sdo_name, 'folder', f.parent_sdo, f.dataset_path, c.n, 4 * c.n FROM ({FOLDERS('aentries')}) f
  JOIN (SELECT deposit_id, sdo_name, count(*) AS n FROM ({FOLDERS('aentries')}) GROUP BY ALL) c USING (deposit_id, sdo_name)
UNION ALL SELECT deposit_id, {SDO('dataset_path')}, 'file',
  CASE WHEN {PARENT('dataset_path')} IS NULL THEN '{K.DATASET_SDO}' ELSE {SDO(PARENT('dataset_path'))} END, dataset_path, 2, 4 FROM afiles""",
        *N10_BINDINGS),
    "K02_outcome_log": _with(
        N10_CTES,
        """SELECT 'run-1' AS run_id, d.deposit_id, CASE WHEN r.deposit_id IS NULL THEN 'OK' ELSE 'FAILED' END AS status,
  CASE WHEN r.deposit_id IS NULL THEN 'Completed succesfully' ELSE r.message END AS message
FROM d LEFT JOIN (SELECT * FROM rejects QUALIFY row_number() OVER (PARTITION BY deposit_id ORDER BY stage, code, coalesce(item, ''), message) = 1) r USING (deposit_id)""",
        *N10_BINDINGS),
    "K03_bag_metadata_contents": with_bindings(
        """SELECT b.deposit_id, regexp_extract(b.name, '([^/]*)$', 1) AS file_name, c.content, sha1(c.content) AS sha1, strlen(c.content) AS n_bytes
FROM bag_documents b JOIN deposits p USING (deposit_id) JOIN bag_contents c ON c.deposit_id = b.deposit_id AND c.name = b.name
WHERE p.include_bag_metadata AND (b.name <> 'manifest-sha1.txt' OR b.length > 0)""",
        "bag_documents", "deposits", "bag_contents"),
    "J09_staged_warnings": _with(
        N10_CTES + f""", fo AS ({FOLDERS('aentries')}), it AS (SELECT deposit_id, dataset_path, sdo_name, parent_sdo FROM fo
  UNION ALL SELECT deposit_id, dataset_path, {SDO('dataset_path')}, CASE WHEN {PARENT('dataset_path')} IS NULL THEN '{K.DATASET_SDO}' ELSE {SDO(PARENT('dataset_path'))} END FROM afiles)""",
        f"""SELECT deposit_id, 'name_collision' AS kind, sdo_name, count(DISTINCT dataset_path) AS n FROM it GROUP BY deposit_id, sdo_name HAVING count(DISTINCT dataset_path) > 1
UNION ALL SELECT deposit_id, 'orphan_parent', parent_sdo, count(*) FROM it WHERE parent_sdo <> '{K.DATASET_SDO}'
  AND NOT EXISTS (SELECT 1 FROM fo WHERE fo.deposit_id = it.deposit_id AND fo.sdo_name = it.parent_sdo) GROUP BY deposit_id, parent_sdo""",
        *N10_BINDINGS),
    "N04_workflow_steps": _with(
        "t(ord, id, required, time_spent_writable) AS (VALUES " + ", ".join(f"({i + 1}, {_q(n)}, {str(r).lower()}, {str(w).lower()})" for i, (n, _, r, w) in enumerate(K.WORKFLOW_TREE)) + ")",
        """SELECT deposit_id, CAST(ord AS INTEGER) AS ord, id, regexp_extract(id, '^(.*)[.][^.]*$', 1) AS parent, CAST(len(string_split(id, '.')) - 1 AS INTEGER) AS depth,
  array_to_string(list_transform(range(1, len(string_split(id, '.')) + 1), lambda i: array_to_string(string_split(id, '.')[1:i], '.')), '>') AS path, required, time_spent_writable
FROM deposits, t WHERE id <> 'dataset'""",
        "deposits"),
    "N05_object_documents": _with(
        N10_CTES,
        f"""SELECT deposit_id, sdo_name, 'Active' AS state, substring(label, 1, 255) AS label, owner_id, label AS title, type FROM (
  SELECT deposit_id, '{K.DATASET_SDO}' AS sdo_name, title AS label, CAST(NULL AS VARCHAR) AS type FROM acc
  UNION ALL SELECT deposit_id, {SDO('dataset_path')}, coalesce(title, {NAME('dataset_path')}), mime_type FROM afiles
  UNION ALL SELECT deposit_id, sdo_name, dataset_path, NULL FROM ({FOLDERS('aentries')}))
JOIN (SELECT deposit_id, owner_id FROM acc) USING (deposit_id)""",
        *N10_BINDINGS),
    "N10_staging_job": _with(
        N10_CTES,
        f"""SELECT deposit_id, '{K.DATASET_SDO}' AS sdo_name, 'dataset' AS kind, NULL AS parent_sdo, NULL AS path, NULL AS mime_type, NULL AS accessible_to,
  NULL AS visible_to, NULL AS checksum, NULL AS control_group, NULL AS title FROM acc
UNION ALL SELECT deposit_id, sdo_name, 'folder', parent_sdo, dataset_path, NULL, NULL, NULL, NULL, NULL, NULL FROM ({FOLDERS('aentries')})
UNION ALL SELECT deposit_id, {SDO('dataset_path')}, 'file',
  CASE WHEN {PARENT('dataset_path')} IS NULL THEN '{K.DATASET_SDO}' ELSE {SDO(PARENT('dataset_path'))} END, dataset_path, mime_type,
  coalesce({RIGHTS('coalesce(access_rights, acc)')}, default_accessible), coalesce({RIGHTS('vis')}, 'ANONYMOUS'), checksum,
  CASE WHEN uri IS NULL THEN 'M' ELSE 'R' END, coalesce(title, {NAME('dataset_path')}) FROM afiles""",
        *N10_BINDINGS),
    "N11_item_request_job": _with(ITEM_CTES, "SELECT * FROM ifiles", *ITEM_BINDINGS),
    "N11_item_request_files": _with(
        ITEM_CTES.replace("FROM item_requests\n", "FROM item_requests WHERE request_id % 20 <> 0\n", 1).replace("WHERE request_id % 20 <> 0\nWHERE", "WHERE request_id % 20 <> 0 AND", 1),
        """SELECT *, NULL AS set_rejected FROM ifiles
UNION ALL SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, 'missing_columns: Missing columns: OWNER-ID' WHERE EXISTS (SELECT 1 FROM events WHERE event_id % 20 = 0)""",
        *ITEM_BINDINGS),
    "R01_arrival_staging": _with(ITEM_CTES, "SELECT * FROM ifiles", *ITEM_BINDINGS),
}
ORACLES["R01_deposit_arrival"] = ORACLES["N10_staging_job"]
ORACLES["N02_file_documents"] = ORACLES["N02_file_config"]
ORACLES["N03_folder_documents"] = ORACLES["N03_folder_config"]

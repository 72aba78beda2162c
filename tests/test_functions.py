"""Literal-row unit tests: truth tables and the quirks of SURVEY §8."""

from pyspark.sql import functions as F

from bagyard import constants as K
from bagyard.functions import paths as P
from bagyard.functions import text as TX
from bagyard.functions.dates import created_year, iso_timestamp
from bagyard.functions.rights import effective_accessible, effective_visible, parse_rights
from bagyard.operators import aggs, checks, joins
from bagyard.operators.depositor import accepted_license, privacy_sentence, signer_display_name
from bagyard.operators.licenses import extension_mime, is_uri_license
from bagyard.sources import scans


def rows(df, *cols):
    return [tuple(r[c] for c in cols) for r in df.collect()]


# ---------------------------------------------------------------- P02 / F16 / F17
def test_sdo_name_cases(spark):
    df = spark.createDataFrame([(".hidden/x",), ("..a",), ("a.b/c",), ("a_b_c",), ("a/b.txt",)], "p string")
    got = dict(rows(df.select("p", P.sdo_name(F.col("p")).alias("s")), "p", "s"))
    assert got == {".hidden/x": "hidden_x", "..a": "_a", "a.b/c": "a_b_c", "a_b_c": "a_b_c", "a/b.txt": "a_b_txt"}


def test_set_name(spark):
    df = spark.createDataFrame([("easy-dataset:12",)], "d string")
    assert df.select(P.sdo_set_name(F.col("d"))).first()[0] == "easy-dataset_12"


def test_sdo_collisions(spark):
    df = spark.createDataFrame([(1, "a.b/c"), (1, "a_b_c"), (1, "a/b/c"), (1, "x"), (2, "a.b/c")], "deposit_id long, path string")
    got = rows(aggs.sdo_collisions(df), "deposit_id", "sdo_name", "n_paths")
    assert got == [(1, "a_b_c", 3)]


def test_ancestor_paths(spark):
    df = spark.createDataFrame([("a/b/c.txt",), ("top.txt",), ("x/y",)], "p string")
    got = dict(rows(df.select("p", P.ancestor_paths(F.col("p")).alias("a")), "p", "a"))
    assert got == {"a/b/c.txt": ["a", "a/b"], "top.txt": [], "x/y": ["x"]}


def test_paths(spark):
    df = checks.with_paths(spark.createDataFrame([("data/a/b/c.txt",), ("data/top",)], "path string"))
    got = rows(df.orderBy("path"), "dataset_path", "name", "parent_path")
    assert got == [("a/b/c.txt", "c.txt", "a/b"), ("top", "top", None)]


# ---------------------------------------------------------------- F01 truth table
def test_signer_display_name_truth_table(spark):
    cases = [
        (None, None, None, False, "NOT KNOWN"),  # no signer element
        ("", None, None, True, "NOT KNOWN"),
        ("", "  ", " ", True, "NOT KNOWN"),  # blank account / e-mail = missing
        ("n", None, None, True, "n"),
        ("", None, "e", True, "e"),
        ("", "a", None, True, "a"),
        ("", "a", "e", True, "a (e)"),
        ("n", None, "e", True, "n (e)"),
        ("n", "a", None, True, "n (a)"),
        ("n", "a", "e", True, "n (a, e)"),
    ]
    df = spark.createDataFrame(cases, "n string, a string, e string, s boolean, want string")
    out = df.select("want", signer_display_name("n", "a", "e", "s").alias("got")).collect()
    assert [r.got for r in out] == [r.want for r in out]


def test_privacy_and_accepted(spark):
    df = spark.createDataFrame(
        [
            (False, None, None, None, None),  # no agreements
            (True, False, "bad", "true", None),  # not parseable
            (True, True, None, "true", None),  # privacy DOES
            (True, True, None, "nope", "Yes"),  # DOES NOT, accepted yes
            (True, True, None, None, " on"),  # no statement; ' on' is not trimmed -> false
        ],
        "exists boolean, valid boolean, err string, privacy string, accepted string",
    )
    out = df.select(
        privacy_sentence(F.lit("X"), F.col("privacy"), F.col("exists"), F.col("valid"), F.col("err")).alias("p"),
        accepted_license(F.col("accepted"), F.col("exists"), F.col("valid")).alias("a"),
    ).collect()
    assert out[0].p == "" and out[0].a is None
    assert out[1].p == "File agreements.xml not valid: bad" and out[1].a is None
    assert out[2].p == "According to depositor X this dataset DOES contain Privacy Sensitive data." and out[2].a is False
    assert out[3].p == "According to depositor X this dataset DOES NOT contain Privacy Sensitive data." and out[3].a is True
    assert out[4].p.startswith("No statement by X could be found") and out[4].a is False


def test_message_and_remark(spark):
    df = spark.createDataFrame([("a <b> c", "P"), ("  \n\t", "P"), (None, ""), ("m", "")], "m string, p string")
    out = df.select(TX.clean_message(F.col("m")).alias("c")).collect()
    assert [r.c for r in out] == ["a &lt;b&gt; c", "", "", "m"]
    r = df.select(TX.remark(F.col("p"), TX.clean_message(F.col("m"))).alias("r")).collect()
    assert [x.r for x in r] == ["P\n\na &lt;b&gt; c", "P", "", "m"]


def test_loose_boolean(spark):
    df = spark.createDataFrame([("true",), ("YES",), ("On",), (" true",), ("y",), (None,)], "t string")
    assert [r[0] for r in df.select(TX.loose_boolean(F.col("t"))).collect()] == [True, True, True, False, False, False]


# ---------------------------------------------------------------- P14-P16, J06
def test_rights_parse_is_exact(spark):
    df = spark.createDataFrame([("KNOWN",), ("known",), (" KNOWN",), (None,)], "r string")
    assert [r[0] for r in df.select(parse_rights(F.col("r"))).collect()] == ["KNOWN", None, None, None]


def test_effective_access_parse_after_coalesce(spark):
    df = spark.createDataFrame(
        [
            ("bogus", "KNOWN", "NONE"),  # invalid accessRights does NOT fall through to accessibleToRights
            (None, "KNOWN", "NONE"),
            (None, None, "RESTRICTED_GROUP"),
            ("ANONYMOUS", "KNOWN", "NONE"),
        ],
        "a string, b string, dflt string",
    )
    got = [r[0] for r in df.select(effective_accessible(F.col("a"), F.col("b"), F.col("dflt"))).collect()]
    assert got == ["NONE", "KNOWN", "RESTRICTED_GROUP", "ANONYMOUS"]
    vis = [r[0] for r in df.select(effective_visible(F.col("a"))).collect()]
    assert vis == ["ANONYMOUS", "ANONYMOUS", "ANONYMOUS", "ANONYMOUS"]


def test_default_rights_map(spark):
    df = spark.createDataFrame([(c,) for c, _ in K.ACCESS_CATEGORY_RIGHTS] + [("NOPE",)], "access_category string").withColumn("deposit_id", F.lit(1))
    got = rows(joins.default_rights(df), "access_category", "default_accessible")
    assert got[:-1] == K.ACCESS_CATEGORY_RIGHTS and got[-1] == ("NOPE", None)
    assert joins.unknown_category_rejects(joins.default_rights(df)).count() == 1


# ---------------------------------------------------------------- A01
def test_single_value(spark):
    df = spark.createDataFrame(
        [
            (1, "p0", []),
            (1, "p1", ["x"]),
            (1, "p2", ["x", "y"]),
            (1, "p3", ["x"]),
            (1, "p3", ["y"]),  # 1 + 1 over two records -> not unique
            (1, "p4", [""]),  # an empty-text element counts
            (1, "p5", []),
            (1, "p5", ["z"]),
        ],
        "deposit_id long, filepath string, format array<string>",
    )
    got = {r.filepath: (r.format, r.n_format) for r in aggs.single_value(df, ["deposit_id", "filepath"], ["format"]).collect()}
    assert got == {"p0": (None, 0), "p1": ("x", 1), "p2": (None, 2), "p3": (None, 2), "p4": ("", 1), "p5": ("z", 1)}


def test_last_by(spark):
    df = spark.createDataFrame([(1, "a", 1, "x"), (1, "a", 5, "y"), (1, "a", 3, "z"), (1, "b", 2, "w")], "deposit_id long, path string, line_no long, v string")
    got = dict(rows(aggs.last_by(df, ["deposit_id", "path"], "line_no", ["v"]), "path", "v"))
    assert got == {"a": "y", "b": "w"}


def test_first_failure_in_stage_order(spark):
    rej = spark.createDataFrame(
        [(1, None, 10, "urn_missing", "m1"), (1, None, 1, "invalid_state", "m2"), (1, "f", 14, "format_not_unique", "m3"), (2, "b", 14, "bad_url", "m4")],
        "deposit_id long, item string, stage int, code string, message string",
    )
    got = {r.deposit_id: r.code for r in aggs.first_failure(rej).collect()}
    assert got == {1: "invalid_state", 2: "bad_url"}
    fails = {r.deposit_id: r.n_failures for r in aggs.collect_failures(rej).collect()}
    assert fails == {1: 3, 2: 1}


# ---------------------------------------------------------------- J07
def test_match_license(spark):
    cat = spark.createDataFrame(
        [("http://a.org/l", "l.txt", "c1"), ("http://b.org/m/", "m.pdf", "c2"), ("http://c.org/n", "n.html", "c3")],
        "uri string, file_name string, content string",
    )
    lic = spark.createDataFrame(
        [
            (1, "https://a.org/l"),  # https exact
            (2, "http://a.org/l/"),  # trailing slash stripped once
            (3, "http://b.org/m"),  # catalogue key with '/', URI without: no match
            (4, "HTTPS://a.org/l"),  # upper-case scheme is not rewritten: no match
            (5, "http://c.org/n"),
        ],
        "deposit_id long, text string",
    )
    got = dict(rows(joins.match_license(lic, cat), "deposit_id", "license_file"))
    assert got == {1: "l.txt", 2: "l.txt", 3: None, 4: None, 5: "n.html"}


def test_license_kind_and_mime(spark):
    df = spark.createDataFrame(
        [
            ("dcterms:URI", 'xmlns:dcterms="http://purl.org/dc/terms/"', True),
            ("x:URI", 'xmlns:dcterms="http://other/" xmlns:x="http://purl.org/dc/terms/"', True),
            ("dcterms:URI", 'xmlns:dcterms="http://other/"', False),
            ("URI", 'xmlns:dcterms="http://purl.org/dc/terms/"', False),
            ("a:b:c", 'xmlns:a="http://purl.org/dc/terms/"', False),
            ("q:URI", 'xmlns:dcterms="http://purl.org/dc/terms/"', False),  # undeclared prefix
            (None, 'xmlns:dcterms="http://purl.org/dc/terms/"', False),
        ],
        "xsi_type string, ns_decls string, want boolean",
    )
    out = df.select("want", is_uri_license("xsi_type", "ns_decls").alias("got")).collect()
    assert [r.got for r in out] == [r.want for r in out]
    m = spark.createDataFrame([("a.txt",), ("b.html",), ("c.pdf",), ("d.doc",), ("noext",)], "f string")
    assert [r[0] for r in m.select(extension_mime("f")).collect()] == ["text/plain", "text/html", "application/pdf", None, None]


# ---------------------------------------------------------------- J08 / J11
def test_nearest_ancestor(spark):
    req = spark.createDataFrame(
        [
            (1, "ds:1", "top.txt"),  # top level -> ('', dataset)
            (2, "ds:1", "a/b/c.txt"),  # direct parent known
            (3, "ds:1", "a/x/c.txt"),  # only grand-parent known
            (4, "ds:1", "t/u/v.txt"),  # stored with trailing '/'
            (5, "ds:2", "a/b/c.txt"),  # same path in another dataset: no match
        ],
        "request_id long, dataset_id string, path_in_dataset string",
    )
    cat = spark.createDataFrame(
        [("f:a", "a", "ds:1"), ("f:ab", "a/b", "ds:1"), ("f:t", "t/u/", "ds:1"), ("f:z", "a/b", "ds:3")],
        "pid string, path string, dataset_sid string",
    )
    anc = joins.nearest_ancestor(req, cat)
    got = {r.request_id: (r.ancestor_path, r.ancestor_pid) for r in anc.collect()}
    assert got == {1: ("", "ds:1"), 2: ("a/b", "f:ab"), 3: ("a", "f:a"), 4: ("t/u", "f:t"), 5: ("", "ds:2")}
    par = joins.request_parent(anc)
    pk = {r.request_id: (r.parent_kind, r.parent_object) for r in par.collect()}
    assert pk[1] == ("object", "info:fedora/ds:1")
    assert pk[2] == ("object", "info:fedora/f:ab")
    assert pk[3] == ("objectSDO", "a_x")
    assert pk[4] == ("object", "info:fedora/f:t")


# ---------------------------------------------------------------- S08 / S03 / P19
def test_uri_mapping_lines(spark):
    lines = spark.createDataFrame(
        [
            (1, 1, "data/a b  http://x/1"),  # two blank runs: the last one splits
            (1, 2, "data/t\thttp://x/2"),  # tab
            (1, 3, "data/e http://x/3 "),  # trailing blank -> empty URI
            (1, 4, ""),  # empty line skipped
            (1, 5, "data/a b http://x/5"),  # duplicate path: last wins
            (2, 1, "nowhitespace"),  # bad line
        ],
        "deposit_id long, line_no long, line string",
    )
    got = {(r.deposit_id, r.path): (r.uri, r.bad_lines) for r in scans.parse_uri_mapping(lines).collect()}
    assert got == {(1, "data/a b"): ("http://x/5", 0), (1, "data/t"): ("http://x/2", 0), (1, "data/e http://x/3"): ("", 0)}
    bad = scans.parse_uri_mapping(lines.where("deposit_id = 2"))
    assert bad.count() == 0
    assert [(r.deposit_id, r.line) for r in scans.bad_uri_mapping_lines(lines).collect()] == [(2, "nowhitespace")]


def test_manifest_line_modes(spark):
    raw = spark.createDataFrame(
        [(1, "sha1", 1, "a data/x"), (1, "sha1", 2, "zz data/y"), (1, "sha1", 3, "onlyonetoken"), (1, "sha1", 4, "a" * 40 + "  data/z w")],
        "deposit_id long, algorithm string, line_no long, raw string",
    )
    e = scans.parse_manifest_lines(raw)
    got = {r.line_no: (r.checksum, r.path, r.d, r.s) for r in e.select(
        "*", checks.manifest_line_ok(F.col("checksum"), F.col("path")).alias("d"),
        checks.manifest_line_ok(F.col("checksum"), F.col("path"), strict=True).alias("s")).collect()}
    # q1: only a single hex digit is rejected in the default mode
    assert got[1] == ("a", "data/x", False, False)
    assert got[2] == ("zz", "data/y", True, False)
    assert got[3] == ("onlyonetoken", None, False, False)
    assert got[4] == ("a" * 40, "data/z w", True, True)


# ---------------------------------------------------------------- dates, labels, URLs
def test_created_year(spark):
    df = spark.createDataFrame(
        [("2019-03-04",), ("2019",), ("2019-03",), ("2019-12-31T23:30:00-05:00",), ("2019-13-45",), ("not-a-date",), ("2019-02-30",)], "c string"
    )
    assert [r[0] for r in df.select(created_year(F.col("c"))).collect()] == [2019, 2019, 2019, 2019, None, None, None]


def test_iso_timestamp(spark):
    df = spark.sql("select timestamp_ntz'2020-01-02 03:04:05.1' as t")
    assert df.select(iso_timestamp(F.col("t"))).first()[0] == "2020-01-02T03:04:05.100Z"


def test_label_truncation(spark):
    df = spark.createDataFrame([("x" * 300,), ("é" * 300,), ("short",)], "l string")
    assert [len(r[0]) for r in df.select(checks.fox_label("l")).collect()] == [255, 255, 5]


def test_location_check(spark):
    df = spark.createDataFrame(
        [(1, "http://a/b"), (2, "https://a/b"), (3, "ftp://a/b"), (4, "not a url"), (5, "http://a/é"), (6, "")],
        "request_id long, datastream_location string",
    )
    got = sorted(rows(checks.check_location(df), "request_id", "code"))
    assert got == [(3, "location_not_http"), (4, "location_not_http"), (5, "location_not_ascii")]


def test_request_rules_and_defaults(spark):
    cols = "request_id long, path_in_dataset string, format string, datastream_location string, size string, file_location string, dataset_id string, accessible_to string, visible_to string, creator_role string, owner_id string"
    df = spark.createDataFrame(
        [
            (1, "a/b", "f", "http://x", "1", "", "ds:1", "", " ", "", " o "),
            (2, "", "", "", "", "", "", "", "", "", ""),  # empty row -> dropped
            (3, "a", "f", "http://x", "1", "/f", "ds:1", "KNOWN", "nope", "archivist", ""),
            (4, "a", "", "", "x", "", "ds:1", "", "", "", "o"),
        ],
        cols,
    )
    kept = checks.drop_empty_requests(df)
    assert sorted(r.request_id for r in kept.collect()) == [1, 3, 4]
    pre = checks.clean_owner(checks.apply_request_defaults(kept))
    d = {r.request_id: r for r in pre.collect()}
    assert (d[1].accessible_to, d[1].visible_to, d[1].creator_role, d[1].owner_id) == ("NONE", "ANONYMOUS", "DEPOSITOR", "o")
    assert d[3].owner_id is None
    codes = sorted(rows(checks.check_request_rules(pre), "request_id", "code"))
    assert codes == [(3, "location_and_file"), (4, "location_or_file_required"), (4, "path_size_format_required"), (4, "size_not_a_number")]
    assert rows(checks.check_creator_role(pre), "request_id", "code") == [(3, "invalid_creator_role")]
    assert rows(checks.check_request_rights(pre), "request_id", "code") == [(3, "invalid_visible_to")]


def test_discipline_catalog(spark):
    xml = '<r:RDF xmlns:r="u"><r:Description><setSpec xmlns="o">a:b:{}</setSpec></r:Description></r:RDF>'
    df = spark.createDataFrame([("d:1", xml.format("X")), ("d:2", xml.format("X")), ("d:3", xml.format("Y"))], "pid string, xml string")
    assert sorted(rows(scans.discipline_catalog(df), "audience", "pid")) == [("X", "d:2"), ("Y", "d:3")]


def test_identifiers(spark):
    df = spark.createDataFrame([(1, "urn:1", "10.1/x", True), (2, None, None, False)], "deposit_id long, urn string, doi string, other_access_doi boolean")
    got = sorted(rows(checks.identifiers(df), "deposit_id", "pos", "value", "scheme"))
    assert got == [(1, 1, "urn:1", K.SCHEME_PID), (1, 2, "10.1/x", K.SCHEME_DOI_OTHER_ACCESS), (1, 3, "$sdo-id", K.SCHEME_DMO_ID), (2, 3, "$sdo-id", K.SCHEME_DMO_ID)]


def test_counter_examples(spark):
    from bagyard.functions.dates import created_year
    from bagyard.functions.text import has_http_protocol
    from bagyard.operators.checks import has_known_protocol
    from bagyard.operators.licenses import is_uri_license
    from bagyard.plans.documents import render_foxml
    from pyspark.sql import functions as F

    urls = spark.createDataFrame([("HTTP://x/a",), ("https://x",), ("ftp://x",), ("nope",), (None,)], "u string")
    got = [tuple(r) for r in urls.select(has_http_protocol("u"), has_known_protocol("u")).collect()]
    assert got == [(True, True), (True, True), (False, True), (False, False), (False, False)]
    dates = ["2019-01-01T12:75:00", "2019-01-01T12:00:99Z", "2019-01-01T12:59:59Z", "2019", "2020-1-5"]
    years = spark.createDataFrame([(d,) for d in dates], "d string").select(created_year("d")).collect()
    assert [r[0] for r in years] == [None, None, 2019, 2019, None]
    ns = "http://purl.org/dc/terms/"
    rows = [("dcterms:URI", f"xmlns:dcterms='{ns}'"), ("dc-t:URI", f'xmlns:dc-t="{ns}"'), ("x:URI", f'xmlns:y="{ns}"')]
    uri = spark.createDataFrame(rows, "t string, ns string").select(is_uri_license("t", "ns")).collect()
    assert [r[0] for r in uri] == [True, True, False]
    sdos = spark.createDataFrame([(1, "s", None, None, None)], "deposit_id long, sdo_name string, label string, owner_id string, mime_type string")
    assert 'NAME="info:fedora/fedora-system:def/model#ownerId" VALUE=""' in render_foxml(sdos).first()["content"]


def test_ancestor_depths_are_the_ancestor_paths(spark):
    from pyspark.sql import functions as F

    from bagyard.functions import paths as P

    paths = ["a/b/c", "a", "", None, "/a", "a/", "a//b", "/", "data/A/F/f.1.bin", "é/ü/x"]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(paths)], "i int, p string")
    by_array = df.select("i", F.explode(P.ancestor_paths("p")).alias("a"))
    by_depth = df.select("i", "p", F.explode(P.ancestor_depths("p")).alias("d")).select("i", P.ancestor_at("p", "d").alias("a"))
    got = sorted((r.i, r.a) for r in by_depth.collect())
    assert got == sorted((r.i, r.a) for r in by_array.collect())
    assert got == [(0, "a"), (0, "a/b"), (4, ""), (5, "a"), (6, "a"), (6, "a/"), (7, ""), (8, "data"), (8, "data/A"), (8, "data/A/F"), (9, "é"), (9, "é/ü")]

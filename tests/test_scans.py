"""The corpus listing, scans (S01-S09, S12) and sinks (K01, K02) on a generated mini-corpus of bags."""

import os
import re
from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from bagyard.sources import listing as L
from bagyard.sources import scans, sinks

FILES_XML = """<?xml version="1.0" encoding="UTF-8"?>
<files xmlns:dcterms="http://purl.org/dc/terms/" xmlns="http://easy.dans.knaw.nl/schemas/bag/metadata/files/">
  <file filepath="data/a/one.txt">
    <dcterms:format>text/plain</dcterms:format>
    <dcterms:title>  The   one  </dcterms:title>
    <accessRights>KNOWN</accessRights>
  </file>
  <file filepath="data/a/one.txt">
    <dcterms:format>text/csv</dcterms:format>
  </file>
  <file filepath="data/two.bin">
    <dcterms:format>application/octet-stream</dcterms:format>
    <visibleToRights>NONE</visibleToRights>
  </file>
</files>
"""

DDM = """<?xml version="1.0" encoding="UTF-8"?>
<ddm:DDM xmlns:ddm="http://easy.dans.knaw.nl/schemas/md/ddm/" xmlns:dcterms="http://purl.org/dc/terms/"
         xmlns:xsi="http://www.w3.org/2001/XMLSchema-instance">
  <ddm:profile>
    <ddm:created>2017-05-01</ddm:created>
    <ddm:audience>D24000</ddm:audience>
    <ddm:audience>D30000</ddm:audience>
  </ddm:profile>
  <ddm:dcmiMetadata>
    <dcterms:rightsHolder>Alice</dcterms:rightsHolder>
    <dcterms:rightsHolder>Bob</dcterms:rightsHolder>
    <dcterms:license xsi:type="dcterms:URI">http://creativecommons.org/licenses/by/4.0</dcterms:license>
  </ddm:dcmiMetadata>
</ddm:DDM>
"""

AGREEMENTS = """<?xml version="1.0" encoding="UTF-8"?>
<agreements xmlns="http://easy.dans.knaw.nl/schemas/bag/metadata/agreements/">
  <depositAgreement>
    <signerId easy-account="acc1" email="a@x.org">Signer One</signerId>
    <dateAccepted>2018-01-01</dateAccepted>
    <depositAgreementAccepted>true</depositAgreementAccepted>
  </depositAgreement>
  <containsPrivacySensitiveData>false</containsPrivacySensitiveData>
</agreements>
"""


def _write(path, text):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


@pytest.fixture(scope="module")
def corpus(tmp_path_factory):
    root = str(tmp_path_factory.mktemp("corpus"))
    # deposit 1: complete bag
    _write(f"{root}/1/deposit.properties", "state.label=SUBMITTED\ndepositor.userId = user001\n")
    b = f"{root}/1/bag1"
    _write(f"{b}/bagit.txt", "BagIt-Version: 0.97\n")
    _write(f"{b}/data/a/one.txt", "hello")
    _write(f"{b}/data/two.bin", "xy")
    _write(f"{b}/manifest-sha1.txt", "aaa  data/a/one.txt\nbbb\tdata/two.bin\n\nccc data/a/one.txt\n")
    _write(f"{b}/manifest-md5.txt", "m1 data/a/one.txt\n")
    _write(f"{b}/metadata/files.xml", FILES_XML)
    _write(f"{b}/metadata/dataset.xml", DDM)
    _write(f"{b}/metadata/depositor-info/agreements.xml", AGREEMENTS)
    _write(f"{b}/metadata/depositor-info/message-from-depositor.txt", "Hi <there>")
    _write(f"{root}/1/.git/bagit.txt", "not a bag")
    _write(f"{root}/1/uri-mapping.txt", "data/two.bin  http://store/two\n")
    # deposit 2: two bag candidates, broken agreements, no message
    _write(f"{root}/2/deposit.properties", "depositor.userId=user002\n")
    _write(f"{root}/2/zbag/bagit.txt", "BagIt-Version: 0.97\n")
    _write(f"{root}/2/abag/bagit.txt", "BagIt-Version: 0.97\n")
    _write(f"{root}/2/abag/data/x.txt", "x")
    _write(f"{root}/2/abag/metadata/depositor-info/agreements.xml", "this is not xml")
    os.makedirs(f"{root}/1/bag1/data/hollow/deep")
    # deposit 3: an odd bag name, no bagit.txt, an empty data directory; deposit 4: no data directory, no properties
    _write(f"{root}/3/deposit.properties", "depositor.userId:user003\n")
    _write(f"{root}/3/b a[g]/metadata/dataset.xml", DDM.replace("    <dcterms:license", "    <!-- ").replace("by/4.0</dcterms:license>", "-->"))
    os.makedirs(f"{root}/3/b a[g]/data")
    _write(f"{root}/4/bag/metadata/x.txt", "x")
    return root


@pytest.fixture(scope="module")
def listing(spark, corpus):
    deposits = spark.createDataFrame([(1,), (2,), (3,), (4,), (99,)], "deposit_id long")  # 99 is not in the store
    path = f"{corpus}-listing"
    L.store_listing(L.crawl(corpus, deposits), path, buckets=4)
    return L.open_listing(spark, path)


def test_scan_deposits(spark, corpus, listing):
    got = {r.deposit_id: (r.owner_id, r.bag_dir) for r in scans.scan_deposits(listing, scans.property_lines(spark, corpus)).collect()}
    # the bag of 3 has no bagit.txt, 4 has no properties
    assert got == {1: ("user001", "bag1"), 2: ("user002", "abag"), 3: ("user003", "b a[g]"), 4: (None, "bag")}


def test_scan_payload_lists_folders(listing):
    got = sorted((r.deposit_id, r.path, r.size, r.is_dir) for r in scans.scan_payload(listing).collect())
    assert got == [
        (1, "data", None, True), (1, "data/a", None, True), (1, "data/a/one.txt", 5, False), (1, "data/hollow", None, True),
        (1, "data/hollow/deep", None, True), (1, "data/two.bin", 2, False),
        (2, "data", None, True), (2, "data/x.txt", 1, False),
        (3, "data", None, True),  # an empty data directory is one
    ]  # 4 has no data directory


def test_listing_crawled_equals_inventory(spark, corpus, listing, tmp_path):
    """The same rows from a storage inventory, also from one that names files only (empty folders are unknown to it)."""
    for name, lines in [("all", L.inventory_lines(listing, corpus)), ("files", L.inventory_lines(listing.where("NOT is_dir"), corpus))]:
        lines.unionByName(lines).write.text(str(tmp_path / name))  # lines may repeat
        L.store_listing(L.read_inventory(spark, str(tmp_path / name), corpus), str(tmp_path / f"{name}-stored"), buckets=4)
        got = {tuple(r) for r in L.open_listing(spark, str(tmp_path / f"{name}-stored")).select("deposit_id", "entry", "size", "is_dir").collect()}
        want = {tuple(r) for r in listing.select("deposit_id", "entry", "size", "is_dir").collect()}
        if name == "files":
            files = {w[1] for w in want if not w[3]}
            want = {w for w in want if not w[3] or any(f.startswith(w[1] + "/") for f in files)}
        assert got == want


def test_listing_reads_and_replaces_only_its_buckets(spark, listing, tmp_path):
    path = str(tmp_path / "stored")
    L.store_listing(listing, path, buckets=4)
    buckets = {r.deposit_id: r.deposit_bucket for r in listing.select("deposit_id", "deposit_bucket").distinct().collect()}
    one = L.open_listing(spark, path, only=[buckets[1]])
    plan = one._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^\]]*deposit_bucket", plan) and {r.deposit_bucket for r in one.collect()} == {buckets[1]}
    # storing one deposit's bucket again replaces it, twice equals once, and the others stay
    before = {tuple(r) for r in L.open_listing(spark, path).collect()}
    mine = spark.createDataFrame(L.open_listing(spark, path, only=[buckets[1]]).collect(), L.SCHEMA + ", deposit_bucket int")
    changed = mine.unionByName(spark.createDataFrame([(1, "bag1/data/new.txt", 3, False, buckets[1])], mine.schema))
    for _ in range(2):
        L.store_listing(changed, path, buckets=4)
        assert {tuple(r) for r in L.open_listing(spark, path).collect()} == before | {(1, "bag1/data/new.txt", 3, False, buckets[1])}


def test_scan_manifests(spark, corpus):
    df = scans.scan_manifests(spark, corpus)
    rows = df.collect()
    sha1 = [(r.checksum, r.path) for r in sorted((r for r in rows if r.algorithm == "sha1"), key=lambda r: (r.line_no.block, r.line_no.row))]
    assert sha1 == [("aaa", "data/a/one.txt"), ("bbb", "data/two.bin"), ("ccc", "data/a/one.txt")]  # blank line dropped, file order kept
    assert [(r.checksum, r.path) for r in rows if r.algorithm == "md5"] == [("m1", "data/a/one.txt")]
    # last wins by the in-file order key
    from bagyard.operators.aggs import last_by

    last = {r.path: r.checksum for r in last_by(df.where("algorithm = 'sha1'"), ["deposit_id", "path"], "line_no", ["checksum"]).collect()}
    assert last == {"data/a/one.txt": "ccc", "data/two.bin": "bbb"}


def test_scan_file_metadata(spark, corpus):
    df = scans.scan_file_metadata(spark, corpus)
    recs = sorted((r.filepath, tuple(r.format), tuple(r.title), tuple(r.access_rights), tuple(r.visible_to)) for r in df.collect())
    assert recs == [
        ("data/a/one.txt", ("text/csv",), (), (), ()),
        ("data/a/one.txt", ("text/plain",), ("The one",), ("KNOWN",), ()),
        ("data/two.bin", ("application/octet-stream",), (), (), ("NONE",)),
    ]


def test_scan_dataset_metadata(spark, corpus):
    r = scans.scan_dataset_metadata(spark, corpus).where("deposit_id = 1").first()
    assert r.audience == ["D24000", "D30000"]
    assert r.created == ["2017-05-01"]
    assert r.rights_holder == ["Alice", "Bob"]
    assert [(x.text, x.xsi_type) for x in r.license] == [("http://creativecommons.org/licenses/by/4.0", "dcterms:URI")]
    assert 'xmlns:dcterms="http://purl.org/dc/terms/"' in r.ns_decls


def test_scan_agreements_and_messages(spark, corpus):
    got = {r.deposit_id: r for r in scans.scan_agreements(spark, corpus).collect()}
    assert got[1].is_valid and got[1].accepted_text == "true" and got[1].privacy_text == "false"
    assert (got[1].name, got[1].account, got[1].email) == ("Signer One", "acc1", "a@x.org")
    assert not got[2].is_valid
    msgs = {r.deposit_id: r.text for r in scans.scan_messages(spark, corpus).collect()}
    assert msgs == {1: "Hi <there>"}


def test_agreements_are_searched_at_any_depth(spark):
    docs = [
        (1, "<agreements><a><b><n:depositAgreementAccepted xmlns:n='u'>yes</n:depositAgreementAccepted></b></a><containsPrivacySensitiveData>no</containsPrivacySensitiveData></agreements>"),
        (2, "<containsPrivacySensitiveData>true</containsPrivacySensitiveData>"),  # the root itself
        (3, "<x><depositAgreement><signerId email='e'>S</signerId><depositAgreementAccepted/></depositAgreement><y><signerId>other</signerId></y></x>"),
        (4, "<x><y><depositAgreement><signerId>deep</signerId></depositAgreement></y></x>"),  # no child of the root: no signer
        (5, "<!DOCTYPE x><x/>"), (6, "<x><unclosed></x>"), (7, ""), (8, None),
    ]
    got = {r.deposit_id: (r.is_valid, r.accepted_text, r.privacy_text, r.name, r.email) for r in scans.parse_agreements(spark.createDataFrame(docs, "deposit_id long, xml string")).collect()}
    bad = (False, None, None, None, None)
    assert got == {1: (True, "yes", "no", None, None), 2: (True, None, "true", None, None), 3: (True, "", None, "S", "e"), 4: (True, None, None, None, None), 5: bad, 6: bad, 7: bad, 8: bad}


def test_scan_bag_documents_and_uri_mapping(spark, corpus, listing):
    docs = sorted((r.deposit_id, r.name) for r in scans.scan_bag_documents(listing).collect())
    assert (1, "manifest-sha1.txt") in docs and (2, "metadata/depositor-info/agreements.xml") in docs
    assert (2, "metadata/dataset.xml") not in docs
    m = scans.scan_uri_mapping(spark, corpus).collect()
    assert [(r.deposit_id, r.path, r.uri) for r in m] == [(1, "data/two.bin", "http://store/two")]


FULL = "dataset-id,path-in-dataset,format,size,file-location,datastream-location,accessible-to,visible-to,creator-role,owner-id"


def test_scan_request_batch(spark, tmp_path):
    (tmp_path / "a.csv").write_text(FULL.upper() + ',"a ""note"", or two"\n'
                                    'easy-dataset:1,"a/b,c.txt",text/plain,12,/x/y,,,,,u1,"multi\nline"\n'
                                    ',,,,,,,,,,\n'
                                    'easy-dataset:1,short\n')  # a row with few cells
    (tmp_path / "b.csv").write_text(",".join(FULL.split(",")[::-1]) + "\nu2,,,,,,7,t,p2,easy-dataset:2\n" + ",".join(FULL.split(",")[::-1]) + "\n")  # a row that equals its header
    (tmp_path / "c.csv").write_text("size," + FULL + "\n1,easy-dataset:3,p3,t,2,,,,,,u3\n")  # a column twice: the first counts
    (tmp_path / "d.csv").write_text("dataset-id,Path-In-Dataset,format,size,file-location,comment\neasy-dataset:9,x,t,1,/x,\n")  # lacks five columns
    (tmp_path / "e.csv").write_text("")  # no header at all
    rows, files = scans.scan_request_batch(spark, str(tmp_path / "*.csv"))
    got = sorted((r.dataset_id, r.path_in_dataset, r.size, r.file_location, r.owner_id) for r in rows.collect())
    assert got == [("", "", "", "", ""), ("dataset-id", "path-in-dataset", "size", "file-location", "owner-id"), ("easy-dataset:1", "a/b,c.txt", "12", "/x/y", "u1"),
                   ("easy-dataset:1", "short", "", "", ""), ("easy-dataset:2", "p2", "7", "", "u2"), ("easy-dataset:3", "p3", "1", "", "u3")]
    assert "comment" not in rows.columns
    audit = {r.file_id[-5]: (r.accepted, r.missing, r.ignored) for r in files.collect()}
    assert audit["a"] == (True, [], ['a "note", or two']) and audit["b"] == audit["c"] == (True, [], [])
    assert audit["d"] == (False, ["datastream-location", "accessible-to", "visible-to", "creator-role", "owner-id"], ["comment"]) and "e" not in audit
    from bagyard.operators import sets

    heads = scans.scan_request_headers(spark, str(tmp_path / "*.csv"))
    audited = {(r.file_id[-5], r.column, r.kind) for r in sets.header_audit(heads).collect()}  # U03 says the same
    assert audited == {(f, c, k) for f, (_, m, i) in audit.items() for k, cs in (("missing", m), ("ignored", i)) for c in cs}


def test_request_batch_reads_files_once(spark, tmp_path):
    """Any number of column orders is one CSV scan."""
    for i in range(4):
        cols = FULL.split(",")[i:] + FULL.split(",")[:i]
        (tmp_path / f"{i}.csv").write_text(",".join(cols) + "\n" + ",".join(cols) + "\n")
    rows, _ = scans.scan_request_batch(spark, str(tmp_path))
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"FileScan csv", plan)) == 1 and {r.owner_id for r in rows.collect()} == {"owner-id"} and rows.count() == 4


def test_license_catalog(spark, tmp_path):
    lic = tmp_path / "lic"
    lic.mkdir()
    (lic / "cc.txt").write_text("By <rightsHolder> <year>")
    (lic / "licenses.properties").write_text("# comment\nhttp\\://creativecommons.org/licenses/by/4.0=cc.txt\n")
    got = scans.license_catalog(spark, str(lic / "licenses.properties"), str(lic)).collect()
    assert [(r.uri, r.file_name, r.content) for r in got] == [("http://creativecommons.org/licenses/by/4.0", "cc.txt", "By <rightsHolder> <year>")]


def test_sinks(spark, tmp_path):
    docs = spark.createDataFrame([(1, "s1", "cfg.json", "{}"), (2, "s2", "fo.xml", "<x/>")], "deposit_id long, sdo_name string, file_name string, content string")
    out = str(tmp_path / "staged")
    sinks.write_staged(docs, out, docs, buckets=4)
    back = sinks.read_staged(spark, out)
    assert sorted(r.sdo_name for r in back.collect()) == ["s1", "s2"] and "deposit_bucket" in back.columns
    rej = spark.createDataFrame([(1, None, 1, "invalid_state", "bad")], "deposit_id long, item string, stage int, code string, message string")
    log = sinks.outcome_log(spark.createDataFrame([(1,), (2,)], "deposit_id long"), rej)
    assert sorted((r.deposit_id, r.status) for r in log.collect()) == [(1, "FAILED"), (2, "OK")]


def _settings(spark, skip_payload):
    import datetime as dt

    rows = [(1, "SUBMITTED", "urn:nbn:nl:ui:13-1", "10.17026/x-1", False, "EASY", True, skip_payload, None,
             dt.datetime(2018, 1, 1), "Deposit one", "OPEN_ACCESS"),
            (2, "DRAFT", "urn:nbn:nl:ui:13-2", None, False, "EASY", False, False, None,
             dt.datetime(2018, 1, 2), "Deposit two", "OPEN_ACCESS"),
            (3, "DRAFT", "urn:nbn:nl:ui:13-3", "10.1/x-3", False, "EASY", False, False, None,
             dt.datetime(2018, 1, 3), "Deposit three", "OPEN_ACCESS")]
    return spark.createDataFrame(rows, "deposit_id long, state string, urn string, doi string, other_access_doi boolean, archive string, "
                                       "include_bag_metadata boolean, skip_payload boolean, extra_description string, submission_ts timestamp_ntz, "
                                       "title string, access_category string")


def test_stage_corpus_end_to_end(spark, corpus):
    from bagyard.operators.aggs import first_failure
    from bagyard.plans import dataset_job as DJ
    from bagyard.plans.corpus import corpus_inputs

    xml = '<r:RDF xmlns:r="u"><r:Description><setSpec>a:b:{}</setSpec></r:Description></r:RDF>'
    disc = spark.createDataFrame([("d:1", xml.format("D24000")), ("d:2", xml.format("D30000"))], "pid string, xml string")
    cat = spark.createDataFrame([("http://creativecommons.org/licenses/by/4.0", "cc.txt", "By <rightsHolder>, <year>")],
                                "uri string, file_name string, content string")
    # payload staged: data/a/one.txt has two format records -> the deposit is rejected (stage 14)
    res = DJ.stage_datasets(corpus_inputs(spark, corpus, _settings(spark, False), disc, cat))
    first = {r.deposit_id: (r.code, r.item) for r in first_failure(res.rejects).collect()}
    assert first[1] == ("format_not_unique", "data/a/one.txt")
    assert first[2][0] == "dataset_xml_missing"
    assert 3 not in first and [r.deposit_id for r in res.accepted.collect()] == [3]  # an empty data directory is accepted
    # payload skipped: the dataset is staged, with its licence filled in
    inp = corpus_inputs(spark, corpus, _settings(spark, True), disc, cat)
    res = DJ.stage_datasets(inp)
    assert sorted(r.deposit_id for r in res.accepted.collect()) == [1, 3]
    lic = res.licenses.first()
    assert (lic.label, lic.mime_type, lic.content) == ("cc.txt", "text/plain", "By Alice, Bob, 2017")
    docs = {r.file_name for r in DJ.documents(res).collect()}
    assert {"cfg.json", "AMD", "fo.xml", "PRSQL", "ADDITIONAL_LICENSE"} <= docs
    # the bag documents of flagged deposits are staged with what they hold
    held = {(r.deposit_id, r.file_name): r.content for r in DJ.documents(res).where("file_name LIKE '%.xml' AND file_name <> 'fo.xml' OR file_name LIKE '%.txt'").collect()}
    assert held == {(1, "dataset.xml"): DDM, (1, "files.xml"): FILES_XML, (1, "agreements.xml"): AGREEMENTS, (1, "message-from-depositor.txt"): "Hi <there>",
                    (1, "manifest-sha1.txt"): "aaa  data/a/one.txt\nbbb\tdata/two.bin\n\nccc data/a/one.txt\n"}
    # without an owner nothing is staged
    none = DJ.stage_datasets(replace(inp, deposits=inp.deposits.withColumn("owner_id", F.lit(" "))))
    assert {r.code for r in none.rejects.collect()} == {"owner_missing"} and none.accepted.count() == 0
    rels = {r.object for r in res.relations.collect()}
    assert {"info:fedora/d:1", "info:fedora/d:2", "urn:nbn:nl:ui:13-1"} <= rels
    # a bad line of the URI mapping fails the deposit before all else
    assert inp.bad_uri_lines.count() == 0
    inp.bad_uri_lines = spark.createDataFrame([(1, "noblank")], "deposit_id bigint, line string")
    first = {r.deposit_id: (r.code, r.message) for r in first_failure(DJ.stage_datasets(inp).rejects).collect()}
    assert first[1] == ("bad_uri_mapping_line", "Invalid line in input: 'noblank'")


def test_item_requests_csv_end_to_end(spark, tmp_path):
    from bagyard.plans import item_job as IJ

    p = tmp_path / "batch.csv"
    p.write_text(
        "dataset-id,path-in-dataset,format,size,file-location,datastream-location,accessible-to,visible-to,creator-role,owner-id,note\n"
        "easy-dataset:1,a/b/c.txt,text/plain,10,/in/c.txt,,,,,u1,x\n"           # ok, managed, nearest folder a/b
        "easy-dataset:1,a/x/d.txt,text/plain,11,,http://files/d,KNOWN,NONE,ARCHIVIST,u1,x\n"  # ok, redirect, grand-parent a
        "easy-dataset:9,e.txt,text/plain,12,/in/e.txt,,,,,u1,x\n"               # unknown dataset
        "easy-dataset:1,f.txt,text/plain,13,/in/f.txt,http://files/f,,,,u1,x\n"  # location and file
        ",,,,,,,,,,only a note\n")                                               # empty row: dropped
    (tmp_path / "broken.csv").write_text("dataset-id,format\neasy-dataset:1,x\n")
    cat = spark.createDataFrame([("f:a", "a", "easy-dataset:1"), ("f:ab", "a/b/", "easy-dataset:1")], "pid string, path string, dataset_sid string")
    objs = spark.createDataFrame([("easy-dataset:1",)], "pid string")
    res = IJ.stage_request_files(spark, [str(p), str(tmp_path / "broken.csv")], cat, objs)
    assert [(r.file_id.split("/")[-1], r.code, r.message) for r in res.file_rejects.collect()] == [
        ("broken.csv", "missing_columns", "Missing columns: PATH-IN-DATASET, DATASTREAM-LOCATION, SIZE, FILE-LOCATION, ACCESSIBLE-TO, VISIBLE-TO, CREATOR-ROLE, OWNER-ID")]
    files = {r.dataset_path: r for r in res.files.collect()}
    assert set(files) == {"a/b/c.txt", "a/x/d.txt"}
    assert (files["a/b/c.txt"].control_group, files["a/b/c.txt"].parent_kind, files["a/b/c.txt"].parent_object) == ("M", "object", "info:fedora/f:ab")
    assert (files["a/x/d.txt"].control_group, files["a/x/d.txt"].ds_location, files["a/x/d.txt"].parent_object) == ("R", "http://files/d", "a_x")
    assert (files["a/x/d.txt"].accessible_to, files["a/x/d.txt"].visible_to, files["a/x/d.txt"].creator_role) == ("KNOWN", "NONE", "ARCHIVIST")
    assert (files["a/b/c.txt"].accessible_to, files["a/b/c.txt"].visible_to) == ("NONE", "ANONYMOUS")
    codes = sorted(r.code for r in res.rejects.collect())
    assert codes == ["dataset_not_found", "location_and_file"]
    assert res.requests.count() == 4
    folders = {(r.path, r.parent_object) for r in res.folders.collect()}
    assert folders == {("a", "easy-dataset_1"), ("a/b", "a"), ("a/x", "a")}


def test_only_the_first_bag_is_staged(spark, tmp_path):
    from bagyard.plans.corpus import corpus_inputs

    root = str(tmp_path / "c")
    _write(f"{root}/7/deposit.properties", "depositor.userId=u7\n")
    for bag, f in [("abag", "data/first.txt"), ("bbag", "data/second.txt")]:
        _write(f"{root}/7/{bag}/bagit.txt", "BagIt-Version: 0.97\n")
        _write(f"{root}/7/{bag}/{f}", "x")
        _write(f"{root}/7/{bag}/manifest-sha1.txt", f"abc {f}\n")
    empty_xml = spark.createDataFrame([], "pid string, xml string")
    empty_cat = spark.createDataFrame([], "uri string, file_name string, content string")
    settings = _settings(spark, False).where("deposit_id = 1").withColumn("deposit_id", F.lit(7).cast("long"))
    inp = corpus_inputs(spark, root, settings, empty_xml, empty_cat)
    assert sorted(r.path for r in inp.payload_files.collect()) == ["data", "data/first.txt"]
    assert [r.raw for r in inp.sha1_manifest_lines.collect()] == ["abc data/first.txt"]
    # no dataset.xml anywhere: an empty table, and the deposit is rejected instead of the run failing
    from bagyard.operators.aggs import first_failure
    from bagyard.plans import dataset_job as DJ

    res = DJ.stage_datasets(inp)
    assert [r.code for r in first_failure(res.rejects).collect()] == ["dataset_xml_missing"]


def test_store_listing_reads_the_listing_once(spark, tmp_path):
    """The directories above the entries come from the same pass as the entries."""
    from pyspark.sql import functions as F

    from bagyard.sources import listing as L

    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    rows = [(1, "bag/data/a/x.txt", 5, False), (1, "bag/data/a/x.txt", 7, False), (1, "bag/data/a", None, True), (2, "deposit.properties", 1, False), (None, "bag/y", 3, False)]
    L.store_listing(spark.createDataFrame(rows, L.SCHEMA).mapInArrow(counted, L.SCHEMA), f"{tmp_path}/stored")
    assert seen.value == len(rows)
    got = {(r.deposit_id, r.entry, r.size, r.is_dir) for r in spark.read.parquet(f"{tmp_path}/stored").select("deposit_id", "entry", "size", "is_dir").collect()}
    assert got == {
        (1, "bag/data/a/x.txt", 7, False), (1, "bag/data/a", None, True), (1, "bag/data", None, True), (1, "bag", None, True),
        (2, "deposit.properties", 1, False), (None, "bag/y", 3, False), (None, "bag", None, True),
    }

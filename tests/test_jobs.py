"""Whole jobs: stream = batch (R01), documents render, failure order."""

import os
import re

from pyspark.sql import functions as F

from bagyard import constants as K
from bagyard.plans import dataset_job as DJ
from bagyard.plans import item_job as IJ
from bagyard.plans.queries import item_files
from bagyard.streaming.arrival import drained_item_stream

SF = os.environ.get("BAGYARD_TEST_SF", "/root/testdata/sf0.001")


def _rows(df):
    cols = sorted(df.columns)
    return sorted((tuple(r[c] for c in cols) for r in df.select(*cols).collect()), key=repr)


def test_stream_equals_batch(spark):
    batch = item_files(IJ.testdata_items(spark, SF))
    stream = drained_item_stream(spark, SF)
    assert _rows(stream) == _rows(batch)


def test_rejected_deposits_produce_nothing(spark):
    res = DJ.stage_datasets(DJ.testdata_inputs(spark, SF))
    rejected = res.rejects.select("deposit_id").distinct()
    assert res.files.join(rejected, "deposit_id", "left_semi").count() == 0
    assert res.datastreams.join(rejected, "deposit_id", "left_semi").count() == 0
    # every staged file's parent is the dataset or a staged folder (J09 orphans)
    from bagyard.operators.joins import orphans

    assert orphans(res.files, res.folders).count() == 0


def test_documents_render(spark):
    res = DJ.stage_datasets(DJ.testdata_inputs(spark, SF))
    docs = DJ.documents(res, remark_date="2020-01-01T00:00:00.000Z")
    kinds = {r.file_name for r in docs.select("file_name").distinct().collect()}
    assert {"cfg.json", "fo.xml", "AMD", "PRSQL", "EASY_FILE_METADATA", "EASY_ITEM_CONTAINER_MD"} <= kinds
    cfg = docs.where((F.col("file_name") == "cfg.json") & (F.col("sdo_name") == K.DATASET_SDO)).first().content
    assert cfg.startswith('{"namespace":"easy-dataset","datastreams":[{"contentFile":"AMD"')
    amd = docs.where(F.col("file_name") == "AMD").first().content
    assert amd.count("<wfs:workflow>") + amd.count("<wfs:workflow xmlns") == len(K.WORKFLOW_TREE) == amd.count("</wfs:workflow>")
    n_files = res.files.count()
    assert docs.where(F.col("file_name") == "EASY_FILE_METADATA").count() == n_files


def test_foxml_label_and_escape(spark):
    from bagyard.plans import documents as D

    df = spark.createDataFrame([(1, "s", "a<b>&\"c" + "x" * 300, "own&er", "text/plain")],
                               "deposit_id long, sdo_name string, label string, owner_id string, mime_type string")
    doc = D.render_foxml(df).first().content
    label = doc.split('model#label" VALUE="')[1].split('"/>')[0]
    assert label.startswith("a&lt;b&gt;&amp;&quot;c") and label.endswith("x")
    assert len(label.replace("&lt;", "<").replace("&gt;", ">").replace("&amp;", "&").replace("&quot;", '"')) == 255
    assert 'ownerId" VALUE="own&amp;er"' in doc and "<dc:type>text/plain</dc:type>" in doc


def test_ancestor_sdos_only_missing(spark):
    from bagyard.plans import documents as D

    req = spark.createDataFrame([("ds:1", "a/b/c.txt"), ("ds:1", "a/d.txt"), ("ds:2", "top.txt")], "dataset_id string, path_in_dataset string")
    cat = spark.createDataFrame([("f:a", "a/", "ds:1")], "pid string, path string, dataset_sid string")
    allf = {(r.dataset_id, r.path, r.parent_object) for r in D.ancestor_sdos(req).collect()}
    assert allf == {("ds:1", "a", "ds_1"), ("ds:1", "a/b", "a")}  # q8: the raw grand-parent path
    missing = {(r.dataset_id, r.path) for r in D.ancestor_sdos(req, cat, only_missing=True).collect()}
    assert missing == {("ds:1", "a/b")}


def test_bag_copies_and_copy_plan(spark):
    from bagyard.sources import sinks

    dep = spark.createDataFrame([(1, True), (2, True), (3, False)], "deposit_id long, include_bag_metadata boolean")
    flags = spark.createDataFrame(
        [(1, True, True, False, True, False), (2, True, False, True, False, False)],
        "deposit_id long, has_dataset_xml boolean, has_files_xml boolean, has_sha1_manifest boolean, has_agreements boolean, has_message boolean")
    copies, rej = sinks.bag_metadata_documents(dep, flags)
    assert sorted((r.deposit_id, r.file_name) for r in copies.collect()) == [
        (1, "agreements.xml"), (1, "dataset.xml"), (1, "files.xml"), (2, "dataset.xml"), (2, "manifest-sha1.txt")]
    assert [(r.deposit_id, r.item) for r in rej.collect()] == [(2, "metadata/files.xml")]
    files = spark.createDataFrame([(1, "a_b", "data/a/b", "M"), (1, "c", "data/c", "R")], "deposit_id long, sdo_name string, path string, control_group string")
    assert [(r.source, r.target) for r in sinks.copy_plan(files).collect()] == [("data/a/b", "a_b/EASY_FILE")]


def test_config_json_keys(spark):
    from bagyard.plans import documents as D

    ds = spark.createDataFrame(
        [(1, "S", 1, "AMD", "AMD", None, "L", "X", "text/xml", None, None),
         (1, "S", 6, "manifest-sha1.txt", "manifest-sha1.txt", None, "M", "M", "text/plain", None, None),
         (1, "F", 1, "EASY_FILE", "EASY_FILE", None, None, "M", "text/plain", "SHA-1", None)],
        "deposit_id long, sdo_name string, ord int, ds_id string, content_file string, ds_location string, label string, control_group string, mime_type string, checksum_type string, checksum string")
    rel = spark.createDataFrame([(1, "S", 1, "p", "objectSDO", "a_b", None)],
                                "deposit_id long, sdo_name string, ord int, predicate string, object_kind string, object string, is_literal boolean")
    got = {r.sdo_name: r.content for r in D.config_json("ns", ds, rel).collect()}
    assert got["S"] == ('{"namespace":"ns","datastreams":[{"contentFile":"AMD","dsID":"AMD","label":"L","controlGroup":"X","mimeType":"text/xml"},'
                        '{"contentFile":"manifest-sha1.txt","dsId":"manifest-sha1.txt","label":"M","controlGroup":"M","mimeType":"text/plain"}],'
                        '"relations":[{"predicate":"p","objectSDO":"a_b"}]}')
    # q20: a missing checksum still writes checksumType
    assert '"checksumType":"SHA-1"}' in got["F"] and '"checksum":' not in got["F"]


def test_files_with_one_sdo_name_keep_a_document_each(spark):
    from bagyard.plans import documents as D

    files = spark.createDataFrame([(1, "a_b", "p", "M", None, "text/plain", "c1"), (1, "a_b", "q", "R", "http://x", "text/csv", "c2")],
                                  "deposit_id long, sdo_name string, parent_sdo string, control_group string, ds_location string, mime_type string, checksum string")
    rows = D.parse_config(D.file_configs(files)).collect()
    assert sorted((r.mime_type, r.control_group, r.ds_location, r.checksum, r.checksum_type) for r in rows if r.name == "EASY_FILE") == [
        ("text/csv", "R", "http://x", None, None), ("text/plain", "M", None, "c1", "SHA-1")]
    assert sorted(r.object_sdo for r in rows if r.object_sdo and r.object_sdo != K.DATASET_SDO) == ["p", "q"] and len(rows) == 12
    plan = D.file_configs(files)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Generate" not in plan  # a projection of the row


def test_deposit_stream_equals_batch(spark):
    from bagyard.plans.queries import flagship
    from bagyard.streaming.arrival import drained_deposit_stream

    batch = flagship(DJ.stage_datasets(DJ.testdata_inputs(spark, SF)))
    assert _rows(drained_deposit_stream(spark, SF)) == _rows(batch)


def test_stored_inputs_are_pruned_and_not_shuffled(spark, tmp_path):
    """A micro-batch reads its own buckets of all fourteen inputs and shuffles none of them to find its rows."""
    from bagyard.sources.listing import bucket_of
    from bagyard.streaming.arrival import DEPOSIT_KEYED, StoredInputs

    inp = DJ.testdata_inputs(spark, SF)
    stored = StoredInputs.store(inp, str(tmp_path), buckets=16)
    some = inp.deposits.where("deposit_id IN (21, 42)")
    mine = {r[0] for r in some.select(bucket_of(F.col("deposit_id"), 16)).collect()}
    got = stored.of(some)
    for name in DEPOSIT_KEYED:
        df = getattr(got, name)
        plan = df._jdf.queryExecution().executedPlan().toString()
        filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
        assert {int(n) for n in re.search(r"deposit_bucket#\d+ IN \(([\d,]+)\)", filters).group(1).split(",")} == mine, name
        assert "Exchange hashpartitioning" not in plan and "Exchange SinglePartition" not in plan and "BroadcastExchange" in plan, name
        want = getattr(inp, name).where("deposit_id IN (21, 42)")
        assert _rows(df) == _rows(want), name


def test_payload_that_arrives_late_is_seen(spark, tmp_path):
    from dataclasses import replace

    from bagyard.plans.queries import flagship
    from bagyard.streaming.arrival import StoredInputs, run_deposit_stream

    inp = DJ.testdata_inputs(spark, SF)
    whole = flagship(DJ.stage_datasets(inp))
    late = sorted(r[0] for r in whole.where("kind = 'file'").select("deposit_id").distinct().limit(3).collect())
    is_late = F.col("deposit_id").isin(*late)
    stored = StoredInputs.store(replace(inp, payload_files=inp.payload_files.where(~is_late)), f"{tmp_path}/inputs", buckets=4)
    inp.deposits.where("deposit_id = 0").coalesce(1).write.parquet(f"{tmp_path}/arrivals")
    run = lambda: run_deposit_stream(spark, f"{tmp_path}/arrivals", inp.deposits.schema, stored, f"{tmp_path}/out", f"{tmp_path}/checkpoint")
    run()
    stored.append({"payload_files": inp.payload_files.where(is_late)})  # after the stream began
    inp.deposits.where(is_late).coalesce(1).write.mode("append").parquet(f"{tmp_path}/arrivals")
    run()
    got = spark.read.parquet(f"{tmp_path}/out/sdos").where(is_late).drop("batch_id")
    assert _rows(got) == _rows(whole.where(is_late))


def test_waves_write_nothing_for_rejected_deposits(spark, monkeypatch):
    """Every wave reads only the deposits alive; the file table holds accepted deposits only; a deposit has failures of one stage."""
    written = {}
    keep = DJ.cut_lineage

    def spy(df, name="t"):
        written[name] = keep(df, name)
        return written[name]

    monkeypatch.setattr(DJ, "cut_lineage", spy)
    res = DJ.stage_datasets(DJ.testdata_inputs(spark, SF))
    assert "files" not in written and "accepted" not in written  # rejects alone build no output
    failed = lambda name: {r[0] for r in written[name].where("failure IS NOT NULL").select("deposit_id").collect()}
    alive = {r[0] for r in written["wave2"].select("deposit_id").collect()}
    assert alive == {r[0] for r in written["wave1"].select("deposit_id").collect()} - failed("wave1")
    alive -= failed("wave2")
    third = {r[0] for r in written["wave3"].select("deposit_id").collect()}
    fourth = {r[0] for r in written["wave4"].select("deposit_id").collect()}
    assert third <= alive and fourth <= alive - third
    accepted = {r[0] for r in res.accepted.select("deposit_id").collect()}
    assert accepted == alive - third - fourth
    assert {r[0] for r in res.files.select("deposit_id").distinct().collect()} <= accepted and "files" in written
    stages = res.rejects.groupBy("deposit_id").agg(F.countDistinct("stage").alias("n"), F.max("stage").alias("s"), F.count("*").alias("rows")).collect()
    assert all(r.n == 1 and (r.s == 14 or r.rows == 1) for r in stages)


def test_staged_set_replaces_only_its_deposits(spark, tmp_path):
    from bagyard.sources import sinks

    schema = "deposit_id long, sdo_name string, kind string"
    ids = lambda *x: spark.createDataFrame([(i,) for i in x], "deposit_id long")
    path = str(tmp_path / "sdos")
    read = lambda: sorted((r.deposit_id, r.sdo_name, r.kind) for r in sinks.read_staged(spark, path).collect())
    first = spark.createDataFrame([(i, f"s{j}", "file") for i in range(1, 9) for j in range(2)], schema)
    for _ in range(2):
        sinks.write_staged(first, path, ids(*range(1, 9)), buckets=3)
        assert len(read()) == 16
    # a second run: deposit 1 changes, 2 is rejected now, 9 is new; the others stay
    second = spark.createDataFrame([(1, "new", "file"), (9, "x", "dataset")], schema)
    for _ in range(2):
        sinks.write_staged(second, path, ids(1, 2, 9), buckets=3)
        assert read() == sorted([(i, f"s{j}", "file") for i in range(3, 9) for j in range(2)] + [(1, "new", "file"), (9, "x", "dataset")])
    # all deposits of all buckets are rejected: nothing is left, and nothing old comes back
    sinks.write_staged(first.limit(0), path, ids(*range(1, 10)), buckets=3)
    assert read() == []


def test_outcome_log_of_a_replayed_run(spark, tmp_path):
    from bagyard.sources import sinks

    deposits = spark.createDataFrame([(1,), (2,)], "deposit_id long")
    rejects = spark.createDataFrame([(1, None, 1, "invalid_state", "bad")], "deposit_id long, item string, stage int, code string, message string")
    for run in ["a", "a", "b", "a"]:
        sinks.write_outcome(deposits, rejects, str(tmp_path), run)
    got = sorted((r.run_id, r.deposit_id, r.status, r.message) for r in spark.read.parquet(f"{tmp_path}/outcomes").collect())
    assert got == [(run, i, s, m) for run in "ab" for i, s, m in [(1, "FAILED", "bad"), (2, "OK", "Completed succesfully")]]
    assert spark.read.parquet(f"{tmp_path}/rejects").count() == 2


def test_workflow_tree_in_document_order(spark):
    from bagyard.plans import documents as D

    rows = D.workflow_tree(spark).orderBy("ord").collect()
    assert [r.id for r in rows] == [n[0] for n in K.WORKFLOW_TREE]  # the list is in document order
    parents = {n[0]: n[1] for n in K.WORKFLOW_TREE}
    for r in rows:
        up, path = r.id, []
        while up:
            path.append(up)
            up = parents[up]
        assert (r.depth, r.path) == (len(path) - 1, ">".join(reversed(path)))
    xml = D._workflow_xml(spark)
    assert xml.count("<wfs:workflow>") == xml.count("</wfs:workflow>") == len(rows) - 1
    assert "<id>dataset.sip.files.privacy</id><required>true</required><remarks></remarks><steps></steps></wfs:workflow></steps></wfs:workflow><wfs:workflow><id>dataset.sip.file-list</id>" in xml


def test_warnings_of_the_staged_set(spark):
    schema = "deposit_id long, dataset_path string, sdo_name string, parent_sdo string"
    folders = spark.createDataFrame([(1, "a", "a", K.DATASET_SDO), (1, "a.b", "a_b", K.DATASET_SDO), (1, "a_b", "a_b", K.DATASET_SDO)], schema)
    files = spark.createDataFrame([(1, "a/f", "a_f", "a"), (1, "lost/g", "lost_g", "lost"), (1, "lost/h", "lost_h", "lost"), (2, "a/f", "a_f", "a")], schema)
    got = {tuple(r[c] for c in ("deposit_id", "kind", "sdo_name", "n")) for r in DJ.warnings(folders, files).collect()}
    assert got == {(1, "name_collision", "a_b", 2), (1, "orphan_parent", "lost", 2), (2, "orphan_parent", "a", 1)}


def test_quirks_q3_q4_q18(spark):
    from bagyard.operators import checks
    from bagyard.plans import documents as D

    # q3: MAINTENANCE is a valid state
    dep = spark.createDataFrame([(1, "MAINTENANCE"), (2, "ARCHIVED")], "deposit_id long, state string")
    assert [r.deposit_id for r in checks.check_state(dep).collect()] == [2]
    # q4: the message column holds one escape; the AMD rendering escapes again
    facts = spark.createDataFrame([(1, "SUBMITTED", "DRAFT", "2020-01-01T00:00:00.000Z", "u1", "x &lt;b&gt;")],
                                  "deposit_id long, dataset_state string, previous_state string, last_state_change string, depositor_id string, remark_text string")
    amd = D.render_amd(facts, "2020-01-02T00:00:00.000Z").first().content
    assert "<text>x &amp;lt;b&amp;gt;</text>" in amd and "<toState>SUBMITTED</toState>" in amd
    # q18: explicit directory rows (empty folders) become folder SDOs too
    files = spark.createDataFrame([(1, "a/b/f.txt", False), (1, "empty", True)], "deposit_id long, dataset_path string, is_dir boolean")
    got = {(r.dataset_path, r.parent_sdo) for r in D.folder_sdos(files).collect()}
    assert got == {("a", K.DATASET_SDO), ("a/b", "a"), ("empty", K.DATASET_SDO)}


def test_documents_are_rendered_and_parsed_once(spark):
    from bagyard.plans import documents as D

    files = spark.createDataFrame([(1, "a_b", "p", "M", None, "text/plain", "c1")],
                                  "deposit_id long, sdo_name string, parent_sdo string, control_group string, ds_location string, mime_type string, checksum string")
    plan = D.parse_config(D.file_configs(files))._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json(") == 1 and "Union" not in plan
    sdos = spark.createDataFrame([(1, "s", "a label", "owner", "text/plain")], "deposit_id long, sdo_name string, label string, owner_id string, mime_type string")
    read = D.parse_foxml(D.render_foxml(sdos))
    assert read._jdf.queryExecution().executedPlan().toString().count("from_xml(") == 1
    assert [tuple(r) for r in read.collect()] == [(1, "s", "Active", "a label", "owner", "a label", "text/plain")]


def test_configuration_without_one_of_its_lists(spark):
    from bagyard.plans import documents as D

    docs = spark.createDataFrame([(1, "s", '{"namespace":"n","relations":[{"predicate":"p","object":"o"}]}'), (2, "s", '{"namespace":"n","datastreams":[{"dsId":"manifest-sha1.txt"}]}'), (3, "s", None)],
                                 "deposit_id long, sdo_name string, content string")
    rows = sorted((r.deposit_id, r.namespace, r.element, r.nth, r.name, r.object) for r in D.parse_config(docs).collect())
    assert rows == [(1, "n", "relation", 0, "p", "o"), (2, "n", "datastream", 0, "manifest-sha1.txt", None)]


def test_every_failure_of_a_deposit_is_collected(spark):
    """The failures of later checks count too, of the deposit and of all its files."""
    from dataclasses import fields

    from bagyard.operators import aggs

    like = DJ.testdata_inputs(spark, SF)
    good = dict(owner_id="u", state="DRAFT", urn="urn", doi="doi", other_access_doi=False, archive="EASY", include_bag_metadata=True, skip_payload=False, access_category=K.ACCESS_CATEGORY_RIGHTS[0][0])
    entry = lambda d, path: dict(deposit_id=d, path=path, size=1, is_dir=False)
    md = lambda d, path, *formats: dict(deposit_id=d, filepath=path, format=list(formats), title=[], access_rights=[], accessible_to=[], visible_to=[])
    manifest = [dict(deposit_id=1, algorithm="sha1", line_no=1, raw="f data/a"), dict(deposit_id=1, algorithm="sha1", line_no=2, raw="e data/c")]
    given = {
        "deposits": [dict(deposit_id=1, **{**good, "state": "LOST", "archive": "TAPE", "urn": None}), dict(deposit_id=2, **good), dict(deposit_id=3, **{**good, "skip_payload": True, "owner_id": " "})],
        "payload_files": [entry(1, "data/a"), entry(1, "data/b"), entry(1, None), entry(2, "data/a"), entry(3, "data/a")],
        "file_metadata": [md(1, "data/a", "text/plain"), md(1, "data/b", "text/plain", "text/csv"), md(2, "data/a", "text/plain")],
        "sha1_manifest_lines": manifest, "payload_manifest_lines": manifest,
        "file_uris": [dict(deposit_id=1, path="data/b", uri="odd://x")],
        "bag_documents": [dict(deposit_id=d, name=f"metadata/{n}.xml", length=1) for d, n in ((1, "dataset"), (1, "files"), (2, "dataset"), (2, "files"))],
    }
    tables = {f.name: spark.createDataFrame(given.get(f.name, []), getattr(like, f.name).schema, verifySchema=False) for f in fields(like) if getattr(like, f.name) is not None and f.name not in ("bad_uri_lines", "bag_contents")}
    bad = spark.createDataFrame([(1, "no uri"), (1, "nor here"), (9, "unknown deposit")], "deposit_id long, line string")
    found = DJ.all_failures(DJ.DatasetInputs(**tables, bad_uri_lines=bad))
    codes = sorted((r.deposit_id, r.code) for r in found.collect())
    assert codes == [(1, c) for c in ["bad_manifest_line"] * 2 + ["bad_uri_mapping_line"] * 2 + ["bad_url", "format_not_unique", "format_not_unique", "invalid_archive", "invalid_state", "uri_not_in_bag", "urn_missing"]] + [
        (3, c) for c in ["bag_metadata_missing"] * 2 + ["dataset_xml_missing", "owner_missing"]]
    assert sorted((r.deposit_id, r.n_failures, r.n_codes) for r in aggs.collect_failures(found).collect()) == [(1, 11, 8), (3, 4, 3)]


def test_arrivals_are_sized_by_rows(spark, tmp_path):
    """One arrival with all rows is written by many tasks, and all of its files are one micro-batch."""
    from bagyard.streaming.arrival import write_arrivals

    rows = spark.range(0, 200_000, 1, 8).select(F.col("id").alias("request_id"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
    size = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        per_batch = write_arrivals(rows, F.pmod(F.col("request_id"), F.lit(1)), 1, f"{tmp_path}/all")
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", size)
    back = spark.read.schema(rows.schema).parquet(f"{tmp_path}/all/*")
    assert per_batch == len(back.inputFiles()) > 4 and back.distinct().count() == 200_000
    few = rows.where("request_id < 40")
    assert write_arrivals(few, F.pmod(F.col("request_id"), F.lit(4)), 4, f"{tmp_path}/few") == 1
    assert len(spark.read.parquet(f"{tmp_path}/few/*").inputFiles()) == 4


def test_config_arrays_are_collected_after_the_rows_are_dealt(spark):
    """No task collects arrays of the rows that it happens to hold before they are dealt by SDO."""
    from bagyard.plans import documents as D

    streams = spark.createDataFrame([(1, "dataset", 2, "B"), (1, "dataset", 1, "A"), (2, "dataset", 1, "A")], "deposit_id bigint, sdo_name string, ord int, ds_id string")
    streams = streams.selectExpr(*[c if c in streams.columns else f"CAST(NULL AS string) AS {c}" for c in D.DS_COLS])
    rel = spark.createDataFrame([(1, "dataset", 1, "p", "object", "o", None)], "deposit_id bigint, sdo_name string, ord int, predicate string, object_kind string, object string, is_literal boolean")
    out = D.config_json("ns", streams, rel)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("REPARTITION_BY_COL") == 2 and "ENSURE_REQUIREMENTS" not in plan
    rows = sorted((r.deposit_id, r.element, r.nth, r.name) for r in D.parse_config(out).select("deposit_id", "element", "nth", "name").collect())
    assert rows == [(1, "datastream", 0, "A"), (1, "datastream", 1, "B"), (1, "relation", 0, "p"), (2, "datastream", 0, "A")]

"""Round 5: what the larger tables need (F1-F6 of FINDINGS_r04)."""

import os

SF = "/root/testdata/sf0.001"


def _folder(spark):
    from bagyard.session import checkpoint_dir

    return checkpoint_dir(spark).removeprefix("file:")


def test_stored_listing_keeps_no_other_form_on_disk(spark, monkeypatch):
    """the inventory is compressed, is gone when the listing is stored, and so are the tables it was made from."""
    from bagyard.plans import queries as Q
    from bagyard.sources import listing as L

    base = _folder(spark)
    before = {name: set(os.listdir(f"{base}/{name}")) if os.path.isdir(f"{base}/{name}") else set() for name in ("", "tables")}
    inventory, keep = [], L.store_listing

    def spy(listing, path, *rest):
        inventory.extend(os.listdir(os.path.join(os.path.dirname(path.removeprefix('file:')), 'inventory')))
        keep(listing, path, *rest)

    monkeypatch.setattr(L, "store_listing", spy)
    listing = Q._stored_listing(spark, SF)
    assert [f for f in inventory if f.startswith("part-")] and all(f.endswith(".snappy") for f in inventory if f.startswith("part-"))
    (mine,) = [f for f in set(os.listdir(base)) - before[""] if f.startswith("listing-")]
    assert os.listdir(f"{base}/{mine}") == ["stored"]
    assert set(os.listdir(f"{base}/tables")) == before["tables"]
    assert listing.count() > 0


def test_a_line_of_the_inventory_is_split_once(spark, tmp_path):
    """a line is not split again for each of its fields and for each condition on them."""
    from bagyard.sources import listing as L

    os.mkdir(f"{tmp_path}/inv")
    with open(f"{tmp_path}/inv/a.txt", "w") as f:
        f.write("d\t0\tstore://c/1/bag\nf\t7\tstore://c/1/bag/data/a\tb.txt\nf\tx\tstore://c/1/bag/data/c\nf\t3\tstore://c/x/bag/d\nf\t3\tstore://c/2\nf\nf\t9\tstore://other/1/a\nd\t0\tstore://c/3/bag/\n\nf\t\tstore://c/4/e\n")
    df = L.read_inventory(spark, f"{tmp_path}/inv", "store://c")
    assert sorted(map(tuple, df.collect())) == [(1, "bag", None, True), (1, "bag/data/a\tb.txt", 7, False), (1, "bag/data/c", None, False), (3, "bag", None, True), (4, "e", None, False)]
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    conditions = [line for line in plan.split("\n") if "Filter" in line]
    assert conditions and not any("split(" in line or "substring" in line for line in conditions)


def test_folders_and_accepted_files_are_made_once(spark, monkeypatch):
    """the folders, which the warnings read three times, and the accepted files are written tables."""
    from bagyard.plans import dataset_job as DJ

    written, keep = [], DJ.cut_lineage
    monkeypatch.setattr(DJ, "cut_lineage", lambda df, name="t": written.append(name) or keep(df, name))
    res = DJ.stage_datasets(DJ.testdata_inputs(spark, SF))
    plan = res.warnings._jdf.queryExecution().optimizedPlan().toString()
    assert written.count("folders") == written.count("files") == written.count("accepted_files") == 1
    assert "ancestor" not in plan and "substring_index" not in plan  # no folder is found again


def test_warnings_count_every_item_of_a_lost_parent(spark):
    """parents are looked up once each and still count all their items; a null deposit is lost too."""
    from bagyard.plans import dataset_job as DJ

    folders = spark.createDataFrame([(1, "a", "a", "easy-dataset:0")], "deposit_id long, dataset_path string, sdo_name string, parent_sdo string")
    files = spark.createDataFrame(
        [(1, "a/x", "a_x", "a"), (1, "b/x", "b_x", "b"), (1, "b/y", "b_y", "b"), (2, "a/x", "a_x", "a"), (None, "a/x", "a_x", "a"), (1, "b.x", "b_x", "dataset")],
        "deposit_id long, dataset_path string, sdo_name string, parent_sdo string")
    got = {tuple(r) for r in DJ.warnings(folders, files).where("kind = 'orphan_parent'").collect()}
    assert {(1, "orphan_parent", "b", 2), (2, "orphan_parent", "a", 1), (None, "orphan_parent", "a", 1)} <= got
    assert (1, "name_collision", "b_x", 2) in {tuple(r) for r in DJ.warnings(folders, files).collect()}


def test_a_manifest_line_is_made_and_split_once(spark):
    """the conditions on a line's parts do not make and split the line again."""
    from pyspark.sql import functions as F

    from bagyard.operators import checks
    from bagyard.sources import scans

    lines = spark.range(3).select(F.col("id").alias("deposit_id"), F.lit("sha1").alias("algorithm"), F.col("id").alias("line_no"),
                                  F.when(F.col("id") == 0, "").otherwise(F.concat(F.sha1(F.col("id").cast("string")), F.lit(" data/a"))).alias("raw"))
    bad = checks.check_manifest_lines(scans.parse_manifest_lines(lines, raw=True))
    assert [(r.deposit_id, r.path, r.line_ok) for r in bad.orderBy("deposit_id").collect()] == [(1, "data/a", True), (2, "data/a", True)]
    plan = bad.where(~F.col("line_ok"))._jdf.queryExecution().optimizedPlan().toString()
    assert not any("sha1(" in line or "split(" in line for line in plan.split("\n") if "Filter" in line)


def test_a_small_side_is_hashed_and_a_union_coalesced(spark):
    """settings of the joins and unions."""
    assert spark.conf.get("spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold") == "4m"
    assert spark.conf.get("spark.sql.unionOutputPartitioning") == "false"


def test_the_deposits_of_a_run_are_found_once(spark, tmp_path, monkeypatch):
    """the tables of a staged set share the deposits of the run and their buckets."""
    from bagyard.sources import sinks

    names, keep = [], sinks.cut_lineage
    monkeypatch.setattr(sinks, "cut_lineage", lambda df, name="t": names.append(name) or keep(df, name))
    rows = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "deposit_id long, sdo_name string")
    for _ in range(2):
        sinks.write_staged_set({"sdos": rows, "relations": rows}, str(tmp_path), rows, buckets=2)
    assert names == ["staged"] * 2
    assert sorted(map(tuple, sinks.read_staged(spark, f"{tmp_path}/relations").select("deposit_id", "sdo_name").collect())) == [(1, "a"), (2, "b"), (2, "b")]


def test_a_large_batch_does_not_shuffle_the_stored_inputs(spark, tmp_path, monkeypatch):
    """F1: rows of a large micro-batch are not looked for in each stored table before the job joins them; its result is the same."""
    from bagyard.plans import dataset_job as DJ
    from bagyard.plans.queries import flagship
    from bagyard.streaming import arrival as A

    inp = DJ.testdata_inputs(spark, SF)
    stored = A.StoredInputs.store(inp, str(tmp_path), buckets=2)
    some = inp.deposits.where("deposit_id % 3 = 0")
    want = sorted(map(str, flagship(DJ.stage_datasets(stored.of(some))).collect()))
    monkeypatch.setattr(A, "FEW", 5)
    got = stored.of(some)
    for name in A.DEPOSIT_KEYED:
        assert "Join" not in getattr(got, name)._jdf.queryExecution().executedPlan().toString(), name
    assert want and sorted(map(str, flagship(DJ.stage_datasets(got)).collect())) == want

"""Round 3, last pass: work of the driver that was done several times over."""

from __future__ import annotations

import os
import uuid

from bagyard.llm import minhash
from bagyard.llm.frames import cut_lineage, written


def _docs(spark):
    """Two texts of similarity 0.7, which share keys and are no link, and three far from them, two of them linked."""
    words = [f"w{i}" for i in range(100)]
    texts = [" ".join(words), " ".join(words[:83] + [f"x{i}" for i in range(17)]), " ".join(f"y{i}" for i in range(100)), " ".join([f"y{i}" for i in range(99)] + ["z"]), None]
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")


def test_a_round_looks_at_the_rows_of_its_keys_as_a_table(spark, monkeypatch):
    seen, was = [], minhash.later_pairs

    def held(members, *a):
        found = was(members, *a)
        seen.append([df._jdf.queryExecution().optimizedPlan().toString() for df in (members, found)])
        return found

    monkeypatch.setattr(minhash, "later_pairs", held)
    out = {r["doc_id"]: (r["component_id"], r["kept"]) for r in minhash.near_duplicates(_docs(spark)).collect()}
    assert out == {0: (0, True), 1: (1, True), 2: (2, True), 3: (2, False), 4: (4, True)}
    assert seen and not any("Join" in members or "Aggregate" in members for members, _ in seen)
    assert all(found.count("FlatMapGroupsInPandas") == 1 for _, found in seen)  # blocks are compared once


def test_a_written_table_is_read_back_without_a_job(spark):
    sc, group = spark.sparkContext, uuid.uuid4().hex
    sc.setJobGroup(group, "cut_lineage")
    try:
        out = cut_lineage(spark.range(10).selectExpr("id", "struct(id AS a, CAST(NULL AS string) AS b) AS s", "array(id) AS l"), "t")
        jobs = len(sc.statusTracker().getJobIdsForGroup(group))
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    assert jobs == 1
    assert out.schema == spark.read.parquet(out.inputFiles()[0]).schema
    assert sorted(map(tuple, out.collect())) == [(i, (i, None), [i]) for i in range(10)]


def test_a_table_for_a_block_goes_with_it(spark):
    with written(spark.range(10), "t") as table:
        folder = os.path.dirname(table.inputFiles()[0].removeprefix("file://"))
        kept = cut_lineage(table.where("id > 4"), "kept")
        assert os.path.isdir(folder)
    assert not os.path.exists(folder)
    assert kept.count() == 5

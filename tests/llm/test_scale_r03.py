"""Round 3: work that grew faster than its input, and files that outlived their job."""

from __future__ import annotations

import time
from itertools import combinations

from pyspark.sql import functions as F

from bagyard.llm import minhash, mixing
from bagyard.llm.frames import cut_lineage

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


def test_a_large_component_is_not_paired_with_itself(spark, monkeypatch):
    monkeypatch.setattr(minhash, "BLOCK", 8)
    rows = [(1, c, 0) for c in range(200)] + [(1, 1000 + c, 1 + c // 3) for c in range(20)]  # a large component, seven small ones
    rows += [(2, c, c % 2) for c in range(8)] + [(3, c, 0) for c in range(30)]  # one block; one component only
    found = minhash.meetings(spark.createDataFrame(rows, "key long, cls long, component long"), spark.range(2000).withColumnRenamed("id", "cls")).collect()
    assert len(found) <= 200 * 3 + 20 * 28 + 8  # all with all: 220 * 28 and 30 * 4 more
    placed, met = {}, set()
    for r in found:
        placed.setdefault((r["key"], r["lo"], r["hi"]), []).append((r["cls"], r["component"], r["block"]))
    for (key, lo, hi), held in placed.items():
        for a, b in combinations(held, 2):
            if a[1] != b[1] and {a[2], b[2]} == {lo, hi}:
                met.add((key, *sorted((a[0], b[0]))))
    wanted = {(a[0], *sorted((a[1], b[1]))) for a, b in combinations(rows, 2) if a[0] == b[0] and a[2] != b[2]}
    assert met == wanted


def test_mixed_reads_and_moves_the_texts_once(spark, tmp_path):
    rows = [(i, " ".join(["w"] * (i % 5 + 1)), "en", f"s{i % 3}", i) for i in range(60)]
    rows += [(7, "a b", "en", "s0", 1), (7, "a b", "de", "s0", 2), (None, "c", None, None, 3), (None, "c", None, None, 3), (0, "c", None, "", 4), (5, None, "en", "s1", 0)]
    spark.createDataFrame(rows, DOCS).write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    out = mixing.mixed(docs)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("text#") and sum("Relation" in line and "text#" in line for line in plan.splitlines()) == 1
    key = ["doc_id", "text_hash", "source"]
    hashed = docs.withColumn("text_hash", F.xxhash64("text"))
    want = {tuple(r[k] for k in key): r["c"] for r in mixing.mix(docs).groupBy(*key).agg(F.sum("copies").alias("c")).where("c > 0").collect()}
    first = {}
    for r in hashed.collect():
        k = tuple(r[c] for c in key)
        first[k] = min(first.get(k, r), r, key=lambda x: [(v is not None, v) for v in x[: len(docs.columns)]])
    expected = [tuple(first[k][: len(docs.columns)]) for k, n in want.items() for _ in range(n)]
    assert sorted(map(repr, map(tuple, out.collect()))) == sorted(map(repr, expected))


def test_a_written_table_leaves_no_shuffle_files(spark):
    def shuffles() -> set[str]:
        files = spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
        names = (files.apply(i).getName() for i in range(files.size()))
        return {n for n in names if n.startswith("shuffle_")}

    name = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before, held = spark.conf.get(name, None), shuffles()
    out = cut_lineage(spark.range(10_000).groupBy((F.col("id") % 100).alias("k")).count(), "t")
    until = time.time() + 3
    while shuffles() - held and time.time() < until:
        time.sleep(0.1)
    assert not shuffles() - held
    assert out.count() == 100 and spark.conf.get(name, None) == before

"""The pipeline against brute force: what each stage keeps, on the smallest table."""

import pytest

pytest.importorskip("bagyard.llm")

from collections import Counter  # noqa: E402

from pyspark.sql import functions as F  # noqa: E402

import corpus_pipeline  # noqa: E402
from bagyard.llm.frames import scratch_path  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_stages(spark):
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "minhash_near_dedup", "suffix_array_dedup", "source_mix", "best_fit_packing"]
    docs = before = spark.read.parquet(f"{SF}/documents.parquet")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch_path(spark, "stage")
        stage(spark, docs, SF).write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = docs.collect()
        if name != "best_fit_packing":
            assert docs.columns == before.columns
    grams = lambda t: {tuple(w[i : i + 5]) for w in [(t or "").lower().split()] for i in range(len(w) - 4)}
    sets = [grams(r.text) for r in seen["minhash_near_dedup"]]
    for i, a in enumerate(sets):
        for b in sets[:i]:
            assert not a or 100 * len(a & b) < 75 * len(a | b)
    assert len(seen["suffix_array_dedup"]) == len(seen["minhash_near_dedup"])
    fifty = Counter()
    for r in seen["suffix_array_dedup"]:
        w = (r.text or "").split()
        fifty.update({tuple(w[i : i + 50]) for i in range(len(w) - 49)})
        assert r.n_chars == len(r.text)
    assert not [g for g, n in fifty.items() if n > 1]
    ids = {r.doc_id for r in seen["source_mix"]}
    assert ids <= {r.doc_id for r in seen["suffix_array_dedup"]}
    fill = Counter()
    for r in seen["best_fit_packing"]:
        fill[r.sequence_id] += r.length
    assert max(fill.values()) <= 2048 and {r.doc_id for r in seen["best_fit_packing"]} == ids


ODD = "doc_id long, text string, lang string, source string, n_chars long, `_id` int, `_h` string, `_row` int, `_cuts` int, `_copies` int, `_source` int, `_n` int, `copies` int, `stays` int, `extra 0` int, `place` int"


def odd(spark, rows):
    """Documents with columns that the operators use themselves."""
    return spark.createDataFrame([(i, t, "en", s, None if t is None else len(t), 1, "h", 2, 3, 4, 5, 6, 7, 8, 9, 10) for i, t, s in rows], ODD)


def words(a, n=40):
    return " ".join(f"w{a}x{i}" for i in range(n))


def test_one_row_of_each_group_stays(spark):
    from bagyard.llm import minhash
    from bagyard.llm.frames import ship

    ship(spark)
    base = words(1).split()
    left, middle, right = " ".join(base), " ".join(base[4:] + ["y1", "y2"]), " ".join(base[8:] + ["y1", "y2", "y3", "y4"])
    rows = [(7, words(2), "s")] * 3 + [(None, words(3), "s")] * 3 + [(1, left, "s"), (None, middle, "s"), (3, right, "s"), (4, None, "s"), (5, "", "s"), (4, None, "s"), (9, words(2), "t"), (7, words(4), "s")]
    got = minhash.one_of_each(odd(spark, rows).repartition(3))
    assert got.columns == odd(spark, rows[:1]).columns
    assert Counter((r.doc_id, r.text) for r in got.collect()) == Counter([(7, words(2)), (None, words(3)), (1, left), (4, None), (5, ""), (4, None), (7, words(4))])
    # the null id links 1 and 3, which are not alike themselves
    found = {(r.doc_id, r.component_id) for r in minhash.near_duplicates(odd(spark, rows[6:9])).collect()}
    assert found == {(1, 1), (None, 1), (3, 1)}
    assert {(r.doc_id, r.component_id) for r in minhash.near_duplicates(odd(spark, [rows[6], rows[8]])).collect()} == {(1, 1), (3, 3)}
    assert minhash.one_of_each(odd(spark, rows).limit(0)).count() == 0


def test_mix_of_repeated_rows_meets_its_target(spark):
    from bagyard.llm import mixing
    from bagyard.llm.frames import ship

    ship(spark)
    rows = [(1, words(1, 2), "a")] * 100 + [(None, words(2, 3), None)] * 7 + [(5, None, "a"), (6, "", "a"), (8, words(3, 1), "b"), (8, words(3, 1), "c")]
    docs = odd(spark, rows).repartition(4)
    wanted = {r.source: (r.target, r.taken) for r in mixing.mix(docs).groupBy("source").agg(F.max("target").alias("target"), F.sum("taken").alias("taken")).collect()}
    got = mixing.mixed(docs)
    assert got.columns == docs.columns
    taken = Counter()
    for r in got.collect():
        taken[r.source] += len(r.text.split())
    for source, (target, words_taken) in wanted.items():
        assert taken[source] == words_taken and abs(taken[source] - target) <= 3
    assert mixing.mixed(docs.limit(0)).count() == 0


def test_cuts_leave_other_columns_alone(spark):
    from bagyard.llm import suffixes
    from bagyard.llm.frames import ship

    ship(spark)
    same = words(9, 60)
    rows = [(1, "a b " + same + " c", "s"), (2, same + " d", "s"), (None, same, "s"), (3, None, "s"), (4, "short", "s")]
    docs = odd(spark, rows)
    got = suffixes.without_repeats(docs)
    assert got.columns == docs.columns
    assert Counter((r.doc_id, r.text, r["_cuts"]) for r in got.collect()) == Counter([(1, rows[0][1], 3), (2, "d", 3), (None, same, 3), (3, None, 3), (4, "short", 3)])
    assert suffixes.without_repeats(docs.limit(0)).count() == 0

"""op11 to op13 against brute force: nulls, empty and long texts, ties, repeated rows, empty tables, clashing columns."""

import math
import random
import re
from collections import Counter, defaultdict

import pytest

pytest.importorskip("bagyard.llm")

from bagyard.llm import lexical, negatives, risk_rules  # noqa: E402
from bagyard.llm.frames import ship  # noqa: E402

# ---------------------------------------------------------------- op11

WORD = re.compile(r"[^\x20\x09-\x0D]+")
DOCS = "doc_id long, text string, lang string, `w` string, `pairs` int, `_cuts` int, n_words int, good int"


def counted(text):
    text = text or ""
    words = WORD.findall(text)
    places = defaultdict(list)
    for i in range(len(words) - 7):
        places[tuple(words[i : i + 8])].append(i)
    under = {j for v in places.values() if len(v) > 1 for p in v for j in range(p, p + 8)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), len(lines) - len(set(lines)), len(under)


def test_op11_counts_by_hand(spark):
    rng = random.Random(3)
    texts = [None, "", " \n ", "a", "a b c", "x\ny\nx\n\n \n \nx", "#*$%&|<> é語\U0001f600", "a b c d e f g h", "a b c d e f g h i a b c d e f g h", "a " * 30, "word " * 20000, "q\r\nq\r\n"]
    for _ in range(60):
        period = [f"w{rng.randrange(6)}" for _ in range(rng.randrange(1, 14))]
        texts.append(rng.choice([" ", "\n", "  "]).join(rng.choice(period) if rng.random() < 0.05 else period[i % len(period)] for i in range(rng.randrange(80))))
    rows = [(i, t, None, "z", 1, 2, 3, 4) for i, t in enumerate(texts)] + [(None, "a b", "en", "z", 1, 2, 3, 4)] * 2
    got = risk_rules.measures(spark.createDataFrame(rows, DOCS)).collect()
    want = Counter((r[0], r[2], *counted(r[1])) for r in rows)
    assert Counter((r.doc_id, r.lang, r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in got) == want


def test_op11_equal_hashes_of_different_windows_are_told_apart(spark, monkeypatch):
    from pyspark.sql import functions as F

    monkeypatch.setattr(risk_rules.F, "xxhash64", lambda *c: F.lit(7).cast("long"))
    texts = [" ".join(f"w{i}" for i in range(30)), "a b c d e f g h i a b c d e f g h"]
    got = {r.doc_id: r.n_repeat_words for r in risk_rules.measures(spark.createDataFrame([(i, t, None, "z", 1, 2, 3, 4) for i, t in enumerate(texts)], DOCS)).collect()}
    assert got == {0: 0, 1: 16}


def tail(n, k, p):
    return sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))


def test_op11_allowed_rejections_are_exact(spark):
    from pyspark.sql import functions as F

    cases = [(n, level) for n in (0, 1, 10, 99, 300, 777, 2500) for level in (0.05, 0.003, 1e-6)]
    df = spark.createDataFrame(cases, "n long, level double").select("n", "level", risk_rules._allowed(F.col("n"), F.col("level"), 0.01).alias("k"))
    for r in df.collect():
        want = max((k for k in range(r.n // 100 + 1) if tail(r.n, k, 0.01) <= r.level), default=-1)
        assert r.k == want, r


def test_op11_cutoffs_hold_the_risk(spark):
    """Rows of two languages and none: bad texts are full of symbols, a few good ones too; cutoffs by brute force."""
    rng = random.Random(5)
    docs, labels = [], []
    for i in range(2400):
        good, lang = int(rng.random() < 0.8), rng.choice(["en", "en", "de", None])
        heavy = rng.random() < (0.9 if not good else 0.003)
        words = [f"w{rng.randrange(900)}" + ("%" * rng.randrange(1, 4) if heavy else "") for _ in range(30)]
        docs.append((i, " ".join(words), lang, "z", 1, 2, 3, 4))
        labels.append((i, good, 0))
    labels += [(None, 0, 0), (5, None, 0), (7, 1, 0), (7, 0, 0)]
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    ruled = risk_rules.with_rules(risk_rules.measures(d))
    got = {(r.lang, r.rule): (r.cutoff, r.rejected_good, r.n_good, r.allowed) for r in risk_rules.cutoffs(ruled, lab).collect()}

    import hashlib

    known = {}
    for i, q, _ in labels:
        if i is not None and q is not None:
            known[i] = max(known.get(i, 0), q)
    rows = defaultdict(list)
    for r in ruled.collect():
        if not r.base_failed and r.doc_id in known:
            tuning = int(hashlib.md5(str(r.doc_id).encode()).hexdigest()[:7], 16) % 3 == 0
            rows[r.lang].append((tuning, known[r.doc_id], r))
    held = {lang: sum(1 for t, g, _ in x if g and not t) for lang, x in rows.items()}
    want = {}
    for lang, x in rows.items():
        n = held[lang]
        level = 0.05 / (len(risk_rules.RULES) * sum(1 for v in held.values() if v))
        allowed = max((k for k in range(n + 1) if tail(n, k, 0.01) <= level), default=-1)
        for rule in risk_rules.RULES:
            best = None
            for cut in sorted({r[rule] for _, _, r in x} - {0}):
                lost = sum(1 for t, g, r in x if g and not t and r[rule] >= cut)
                bad = [r[rule] >= cut for t, g, r in x if t and not g]
                fine = [r[rule] >= cut for t, g, r in x if t and g]
                gain = sum(bad) / len(bad) - 10 * sum(fine) / len(fine)
                if lost <= allowed and gain > 0 and (best is None or (gain, cut) > best[0]):
                    best = ((gain, cut), (cut, lost, n, allowed))
            if best:
                want[(lang, rule)] = best[1]
    assert got == want and any(rule == "symbol_share" for _, rule in got)
    judged = risk_rules.judge(d, lab).collect()
    assert len(judged) == len(docs)
    for r in judged:
        failed = [rule for rule in risk_rules.RULES if (r.lang, rule) in got and r[rule] >= got[(r.lang, rule)][0]]
        assert r.failed_rules == failed and r.kept == (not r.base_failed and not failed)


def test_op11_empty_tables(spark):
    d = spark.createDataFrame([(1, "a " * 40, "en", "z", 1, 2, 3, 4), (2, " ".join(f"w{i}%" for i in range(40)), "en", "z", 1, 2, 3, 4)], DOCS)
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert [(r.doc_id, r.kept) for r in risk_rules.judge(d, none).orderBy("doc_id").collect()] == [(1, False), (2, True)]
    assert risk_rules.judge(d.limit(0), none).count() == 0


# ---------------------------------------------------------------- op12

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def ranked(docs, items, k=10):
    bags = [(i, Counter(TERM.findall(t.translate(LOWER)))) for i, t in docs if t]
    bags = [(i, b) for i, b in bags if b]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    out = []
    for item, text in items:
        asked, found = Counter(TERM.findall((text or "").translate(LOWER))), []
        for i, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // n_terms
            s = sum(q * math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * b[t] // (1000 * b[t] + 8 * m)) for t, q in asked.items() if t in b)
            if s > 0:
                found.append((-s, i is None, i))
        out += [(item, r + 1, i, -s) for r, (s, _, i) in enumerate(sorted(found, key=lambda x: (x[0], x[1], x[2] or 0))[:k])]
    return Counter(out)


@pytest.mark.parametrize("block_bytes", [lexical.BLOCK_BYTES, 60])
def test_op12_against_brute_force(spark, block_bytes, monkeypatch):
    ship(spark)
    monkeypatch.setattr(lexical, "CELLS", 64)
    rng = random.Random(8)
    vocabulary = ["a", "b", "Été", "語", "x1", "don", "t", "zz", "q"] + [f"w{i}" for i in range(40)]
    docs = [(i, rng.choice([" ", "-", ", "]).join(rng.choice(vocabulary) for _ in range(rng.randrange(40)))) for i in range(150)]
    docs += [(200 + i, "a b Été zz zz") for i in range(25)] + [(300, None), (301, ""), (302, "!? ."), (None, "a b Été zz zz"), (None, "w1 w2"), (7, "w1 w2"), (7, "w1 w2"), (303, "LONG " * 50000 + "a"), (304, "A été ÉTÉ")]
    items = [(1, "a b c"), (2, "Été zz zz zz"), (3, None), (4, ""), (5, "unknown"), (6, "w1 W2 w3 w4 w5"), (6, "w1"), (None, "long"), (8, "w1 w2"), (9, "語 x1")]
    d = spark.createDataFrame([(i, t, "v", 1, 2) for i, t in docs], "doc_id long, text string, `vec` string, `m` int, `rank` int")
    b = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, `block` int")
    got = lexical.search(d.repartition(5), b, block_bytes=block_bytes)
    assert got.dtypes == [("item_id", "bigint"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert Counter(tuple(r) for r in got.collect()) == ranked(docs, items)


def test_op12_empty_tables(spark):
    ship(spark)
    d, b = spark.createDataFrame([(1, "a")], "doc_id long, text string"), spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert lexical.search(d.limit(0), b).count() == 0
    assert lexical.search(d, b.limit(0)).count() == 0
    assert lexical.search(d, b.where("false").unionByName(spark.createDataFrame([(2, None)], "item_id long, text string"))).count() == 0
    assert [tuple(r)[:3] for r in lexical.search(d, b).collect()] == [(1, 1, 1)]


# ---------------------------------------------------------------- op13


def mined(rows):
    rows = [(i, (l + 1) % 10 if i is not None and i % 7 == 0 else l, [math.floor(256 * x) for x in v]) for i, l, v in rows if l is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for a, (i, l, v) in enumerate(rows):
        if i is None or i % 100:
            continue
        order = sorted(((-sum(x * y for x, y in zip(v, w)), j is None, j or 0, b) for b, (j, _, w) in enumerate(rows) if b != a))
        same = [x for x in order if rows[x[3]][1] == l][:5]
        for p in same:
            fits = [x for x in order if rows[x[3]][1] != l and 80 * -p[0] <= 100 * -x[0] <= 100 * -p[0]][:5]
            out += [(i, rows[p[3]][0], r + 1, rows[x[3]][0], -p[0], -x[0]) for r, x in enumerate(fits)]
    return Counter(out)


@pytest.mark.parametrize("blocks", [{}, {"row_block": 40, "anchor_block": 3}])
def test_op13_against_brute_force(spark, blocks):
    ship(spark)
    rng = random.Random(11)
    rows = []
    for i in range(0, 900, 3):
        centre = rng.randrange(4)
        v = [float(centre == k % 4) + rng.choice([0.0, 0.25, -0.25]) for k in range(8)]
        rows.append((i, rng.choice([centre, centre, rng.randrange(3), None]) if i % 5 else 1, v))
    rows += [(1000 + i, i % 3, [1.0, 0.25] * 4) for i in range(60)] + [(1100, 0, [1.0, 0.25] * 4)] * 2 + [(None, 0, [1.0] * 8), (None, 2, [1.0] * 8)]
    rows += [(1200, 1, None), (1300, 1, [1.0, None]), (1400, 1, [float("nan")]), (1500, 1, [float("-inf")]), (1600, 1, []), (1700, 0, [0.5]), (1800, 2, [-1.0] * 8), (1900, 77, [1.0] * 8)]
    df = spark.createDataFrame([(i, None if l is None else l, v, 1, "z") for i, l, v in rows], "vec_id long, label int, embedding array<float>, `row` int, `v` string").repartition(4)
    got = negatives.mine(df, **blocks)
    assert got.dtypes == [("anchor_id", "bigint"), ("positive_id", "bigint"), ("rank", "int"), ("negative_id", "bigint"), ("positive_score", "bigint"), ("negative_score", "bigint")]
    want = mined(rows)
    assert Counter(tuple(r) for r in got.collect()) == want and len(want) > 50


def test_op13_large_components_and_empty_tables(spark):
    ship(spark)
    rows = [(100, 1, [3.0e6] * 4), (1, 1, [2.9e6] * 4), (2, 2, [2.8e6] * 4), (3, 2, [2.0e6] * 4)]
    df = spark.createDataFrame(rows, "vec_id long, label int, embedding array<double>")
    assert Counter(tuple(r) for r in negatives.mine(df).collect()) == mined(rows)
    assert negatives.mine(df.limit(0)).count() == 0
    assert negatives.mine(df.where("vec_id < 100")).count() == 0


def test_op13_stream_holds_open_windows_only():
    pairs = [(negatives._pack(1, 100, 0, 5, 0), 9), (negatives._pack(1, 100, 1, 4, 1), 9), (negatives._pack(1, 90, 0, None, 2), 9), (negatives._pack(1, 80, 1, 6, 3), 9), (negatives._pack(1, 79, 1, 7, 4), 9), (negatives._pack(2, 0, 0, 8, 5), 10), (negatives._pack(2, 0, 1, -3, 6), 10)]
    assert [p for p, _ in pairs] == sorted(p for p, _ in pairs)
    assert list(negatives.open_windows(iter(pairs), 2)) == [(9, 5, 1, 4, 100, 100), (9, 5, 2, 6, 100, 80), (9, None, 1, 6, 90, 80), (9, None, 2, 7, 90, 79), (10, 8, 1, -3, 0, 0)]


def test_every_query_has_sql_or_a_brute_force_test():
    """Queries that SQL can't express, and where they are held against brute force, an exact round trip or accuracy."""
    import os

    import __spark_entry__ as E
    from bagyard.llm.queries import ORACLES, QUERIES

    tested = {
        "op3_suffix_array": "test_op3_brute_force", "op4_toxicity": "test_op4", "op5_source_mix": "test_op5", "op7_token_records": "test_op7",
        "op8_best_fit_packing": "test_op8", "op9_quality": "test_op9", "op10_fingerprints": "test_op10", "pipeline": "test_stages",
    }
    assert set(QUERIES) | {"pipeline"} == set(ORACLES) | set(tested) and set(QUERIES) <= set(E.queries())
    here = os.path.dirname(os.path.abspath(__file__))
    source = "".join(open(os.path.join(here, name)).read() for name in os.listdir(here) if name.endswith(".py"))
    for name in tested.values():
        assert f"def {name}" in source, name


# ---------------------------------------------------------------- additions to op4, op7 and op9


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s") for i, t in rows], "doc_id long, text string, lang string, source string")


def test_training_sample_is_bounded_by_rows(spark):
    from bagyard.llm.labelled import held_out, training_sample
    from pyspark.sql import functions as F

    docs = documents(spark, [(1, f"copy {k}") for k in range(3000)] + [(i, f"text {i}") for i in range(2, 200)]).repartition(6)
    labels = spark.createDataFrame([(i, i % 2, 0) for i in range(1, 200)] + [(1, 1, 0)] * 50 + [(None, 1, 0), (5, None, 0)], "doc_id long, quality int, toxic int")
    sample, weight = training_sample(docs, labels, "quality", 5, 0, 10, 100)
    rows = sample.collect()
    assert len(rows) == len({r["_id"] for r in rows}) <= 20 and {r.label for r in rows} == {0, 1}
    known = labels.where(~held_out(F.col("doc_id"), 5, 0) & F.col("quality").isNotNull()).select("doc_id").distinct().count()
    assert sum(weight.values()) * 10 == known
    whole, weight = training_sample(docs, labels, "quality", 5, 0, 10_000, 100)
    assert whole.count() == known and set(weight.values()) == {1.0}
    assert sample.collect() == rows


def test_op7_shuffled_reads_seek_by_the_index(spark):
    from bagyard.llm import token_records
    from bagyard.llm.frames import scratch_path, tokenizer_file

    ship(spark)
    rng = random.Random(2)
    docs = documents(spark, [(i, None if i % 11 == 0 else "word é " * rng.randrange(30)) for i in range(120)] + [(None, "x"), (7, "again")])
    folder = scratch_path(spark, "records")
    token_records.write_records(docs.repartition(4), f"{folder}/data", tokenizer_file("byte_bpe_50k.json"))
    token_records.write_index(spark, f"{folder}/data", f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index").collect()
    whole = {(r.file, r.record): (r.doc_id, r.ids) for r in token_records.read_records(spark, f"{folder}/data").collect()}
    order = [rng.choice(index) for _ in range(300)]  # any order, some several times, some never
    places = spark.createDataFrame([(k, r.file, r.offset) for k, r in enumerate(order)], "place long, file int, offset long")
    got = token_records.read_shuffled(spark, f"{folder}/data", places.repartition(3), batch=16).collect()
    assert [r.place for r in got] == list(range(300))
    assert [(r.doc_id, r.ids) for r in got] == [whole[(r.file, r.record)] for r in order] and all(r.n_tokens * 4 == len(r.ids) for r in got)
    assert token_records.read_shuffled(spark, f"{folder}/data", places.limit(0)).count() == 0
    with pytest.raises(Exception, match="checksum|cut short"):
        token_records.read_shuffled(spark, f"{folder}/data", places.limit(1).selectExpr("place", "file", "offset + 1 AS offset")).collect()


def test_op4_scores_are_the_noisy_or_of_sentences(spark):
    import numpy as np

    from bagyard.llm import toxicity

    ship(spark)
    model = toxicity.Model(np.random.default_rng(1).normal(0, 1, toxicity.BUCKETS).astype(np.float32), -2.0)
    texts = [None, "", "...", "One two", "One two. Three four! five?six\nSeven", "é ü. \r\n 12 3. Word WORD word", "a. " * 300]
    got = {r.doc_id: r.score for r in toxicity.score(documents(spark, list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        none = 1.0
        for sentence in re.split(r"[.!?\r\n]", text or ""):
            data = np.frombuffer(sentence.encode(), np.uint8)
            *_, buckets = toxicity.instances(data, np.array([0, len(data)]))
            if len(buckets):
                logit = sum(float(model.weights[b]) for b in buckets.ravel()) + model.bias
                none *= 1 - 1 / (1 + math.exp(-max(-30.0, min(30.0, logit))))
        assert abs(got[i] - (1 - none)) < 1e-5, text


def test_op9_scores_are_the_softmax_of_the_mean(spark):
    import numpy as np

    from bagyard.llm import quality

    ship(spark)
    rng = np.random.default_rng(4)
    vectors, layer, bias = rng.normal(0, 1, (quality.BUCKETS, 8)), rng.normal(0, 1, (2, 8)), rng.normal(0, 1, 2)
    model = quality.Model((vectors @ (layer[1] - layer[0])).astype(np.float32), float(bias[1] - bias[0]))
    texts = [None, "", "a", "ab", "One two two three", "é ü é ü\nword " * 40]
    got = {r.doc_id: r.score for r in quality.score(documents(spark, list(enumerate(texts))), model).collect()}
    for i, text in enumerate(texts):
        data = np.frombuffer((text or "").encode(), np.uint8)
        buckets = np.concatenate([b for b, _ in quality.features(data, np.array([0, len(data)]))]) if len(data) else []
        hidden = vectors[buckets].mean(axis=0) if len(buckets) else np.zeros(8)
        logits = layer @ hidden + bias
        p = np.exp(logits - logits.max())
        assert abs(got[i] - p[1] / p.sum()) < 1e-4, text


def test_op9_features_by_hand(spark):
    import numpy as np

    from bagyard.llm import quality

    texts = ["", "ab", "a b a", "été été 東京東京", "x y\nx y", "\U0001f600éaé"]
    raw = [t.encode() for t in texts]
    found = quality.features(np.frombuffer(b"".join(raw), np.uint8), np.append(0, np.cumsum([len(r) for r in raw])))
    counts = [[int((owner == i).sum()) for _, owner in found] for i in range(len(texts))]
    for text, got in zip(texts, counts, strict=True):
        n = len(text.split())
        assert got == [n, max(0, n - 1), max(0, len(text) - 2), max(0, len(text) - 3)], text
    alone = quality.features(np.frombuffer(raw[3], np.uint8), np.array([0, len(raw[3])]))
    for (b, owner), (a, _) in zip(found, alone, strict=True):
        assert np.array_equal(b[owner == 3], a)  # a text has the same features wherever it lies in a batch
    grams = dict(zip((3, 4), found[2:], strict=True))
    assert len(set(grams[3][0][grams[3][1] == 3])) == len({texts[3][i : i + 3] for i in range(len(texts[3]) - 2)})

"""Nulls, empty and long texts, ties, repeated rows, empty tables and clashing columns for every operator."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
import pytest

pytest.importorskip("bagyard.llm")

from bagyard.llm import chunking, covertree, minhash, mixing, packing, quality, suffixes, textbytes, token_records, toxicity, warc  # noqa: E402
from bagyard.llm.frames import scratch_path, ship, tokenizer_file  # noqa: E402
from bagyard.llm.tokens import encoder  # noqa: E402

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, `cls` string, `_rank` int"
ODD_TEXTS = [None, "", " ", "a", "a  b", "\n x\t y\r\n", "don't I'll 's", "é é, é\n é  é", "a <|endoftext|> b", "한국어 テキスト", "a\xa0 b \xa0c", "word " * 3000, "ab0 c 0 0a", "İstanbul ΣΑΣ"]


def table(spark, texts, source="s", ids=None):
    ship(spark)
    rows = [(i if ids is None else ids[k], t, "en", source, None if t is None else len(t), "x", 1) for k, (i, t) in enumerate(enumerate(texts))]
    return spark.createDataFrame(rows, SCHEMA)


def words(rng, n, vocabulary=400):
    return [f"w{rng.randrange(vocabulary)}" for _ in range(n)]


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_pieces_equal_whole_text_encoding(name):
    enc = encoder(tokenizer_file(name), 64)
    rng = random.Random(1)
    alphabet = ["a", "B", "é", " ", " ", "\n", "'s", ",", "!!", "0", "\xa0", "ß", "x́", "語", "<|endoftext|>"]
    texts = [t or "" for t in ODD_TEXTS] + ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(400)]
    for _ in range(2):
        ids, bounds = enc.encode(*textbytes.text_bytes(pa.array(texts)))
        for i, want in enumerate(enc.plain(texts)):
            assert np.array_equal(ids[bounds[i] : bounds[i + 1]], want), texts[i]


def test_op1_round_trip(spark):
    ship(spark)
    html = [None, "", "x", "x", "x", "é" * 70000, "y", "", "x"]
    ids = [1, 2, 3, 9, 9, 5, None, 7, None]
    pages = spark.createDataFrame([(i, None if k % 3 == 0 else f"http://h/{k}\r\nZ", h, "z") for k, (i, h) in enumerate(zip(ids, html))], "page_id long, url string, html string, payload string")
    folder = scratch_path(spark, "warc")
    warc.write_archives(pages, folder)
    got = warc.read_archives(spark, folder, with_payload=True).collect()
    assert len(got) == len(html)
    first = {"": 7, "x": 9}
    want = Counter()
    for i, h in zip(ids, html):
        body = h or ""
        target = first.get(body)
        revisit = target is not None and i != target
        want[(i, len(body.encode()), warc.digest(body.encode()), "revisit" if revisit else "response", target if revisit else None)] += 1
    assert Counter((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in got) == want
    assert all(r.payload is not None for r in got if r.record_type == "response")
    empty = scratch_path(spark, "warc")
    warc.write_archives(pages.limit(0), empty)
    assert warc.read_archives(spark, empty).count() == 0


def test_op1_damage_is_found():
    good = warc.member(warc.record(1, "u", b"abc", warc.digest(b"abc"), 3, None))
    assert [r["page_id"] for r in warc.read_members(good + b"\0" + good)] == [1, 1]
    bad = warc.member(warc.record(1, "u", b"abc", warc.digest(b"abd"), 3, None))
    with pytest.raises(ValueError):
        list(warc.read_members(bad))
    with pytest.raises(ValueError):
        list(warc.read_members(good[:-12]))
    big = warc.member(warc.record(2, None, b"a" * (17 << 20), warc.digest(b"a" * (17 << 20)), 17 << 20, None))
    assert [r["payload_bytes"] for r in warc.read_members(big + b"\0" + good)] == [17 << 20, 3]


def test_op2_brute_force(spark):
    ship(spark)
    rng = np.random.default_rng(2)
    rows = []
    for i in range(400):
        centre = np.random.default_rng(i % 12).normal(size=8)
        rows.append((i, [float(x) for x in centre + rng.normal(size=8) * rng.choice([0.0, 0.2, 0.6])], int(i % 3)))
    rows += [(400, None, 1), (401, [0.0] * 8, 1), (402, [1.0] * 8, None), (403, [float("nan")] * 8, 1), (404, [None] * 8, 1), (405, [1.0, 2.0], 1), (406, [2.0, 4.0], 1), (407, [], 1)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "vec_id long, embedding array<double>, label int, cls string")
    links = defaultdict(set)
    for a, x, la in rows:
        for b, y, lb in rows:
            if a < b and la is not None and la == lb and x and y and len(x) == len(y) and None not in x and None not in y:
                u, v = np.array(x), np.array(y)
                n = np.linalg.norm(u) * np.linalg.norm(v)
                if np.isfinite(n) and n > 0 and u @ v / n >= 0.93:
                    links[a].add(b)
                    links[b].add(a)
    want = {i: (len(links[i]), c) for i, c in zip([r[0] for r in rows], _components([r[0] for r in rows], links))}
    for block in (1024, 16):
        got = {r.vec_id: (r.n_links, r.component_id) for r in covertree.near_vectors(df, block=block).collect()}
        assert got == want
    assert covertree.near_vectors(df.limit(0)).count() == 0


def _components(nodes, links):
    best = {}
    for n in sorted(nodes):
        if n in best:
            continue
        todo = [n]
        while todo:
            x = todo.pop()
            if x not in best:
                best[x] = n
                todo += links[x]
    return [best[n] for n in nodes]


def test_op3_brute_force(spark):
    rng = random.Random(3)
    shared = [words(rng, n, 5000) for n in (50, 55, 80, 300, 49)]
    docs = []
    for _ in range(60):
        w = words(rng, rng.randrange(0, 200), 5000)
        if rng.random() < 0.6:
            at = rng.randrange(len(w) + 1)
            w = w[:at] + rng.choice(shared) + w[at:]
        docs.append(w)
    docs += [["a"] * 200, ["a"] * 120, docs[0], docs[0]]
    texts = [" \n".join(w) for w in docs] + [None, ""]
    grams = defaultdict(set)
    for i, w in enumerate(docs):
        for k in range(len(w) - 49):
            grams[tuple(w[k : k + 50])].add(i)
    want = {}
    for i, w in enumerate(docs):
        found = {x for k in range(len(w) - 49) if len(grams[tuple(w[k : k + 50])]) > 1 for x in range(k, k + 50)}
        if found:
            want[i] = found
    df = table(spark, texts)
    got = {r.doc_id: {x for s in r.spans for x in range(s.start, s.end)} for r in suffixes.repeated_passages(df).collect()}
    assert got == want
    cleaned = {r.doc_id: r for r in suffixes.without_repeats(df).collect()}
    assert len(cleaned) == len(texts) and cleaned[len(texts) - 2].text is None
    for passage in shared[:4]:  # each passage stays somewhere, and in one document only
        held = [i for i, r in cleaned.items() if r.text and " ".join(passage) in " ".join(r.text.split())]
        before = [i for i, w in enumerate(docs) if " ".join(passage) in " ".join(w)]
        assert len(held) == min(1, len(before)), (held, before)
    assert suffixes.repeated_passages(df.limit(0)).count() == 0


def held_spans(rows):
    return {r.doc_id: {x for s in r.spans for x in range(s.start, s.end)} for r in rows}


def repeats(docs):
    """Words of each document that lie in a run of 50 words of another document, too."""
    grams = defaultdict(set)
    for i, w in enumerate(docs):
        for k in range(len(w) - 49):
            grams[tuple(w[k : k + 50])].add(i)
    found = {i: {x for k in range(len(w) - 49) if len(grams[tuple(w[k : k + 50])]) > 1 for x in range(k, k + 50)} for i, w in enumerate(docs)}
    return {i: f for i, f in found.items() if f}


def test_op3_passages_with_many_surroundings(spark):
    rng = random.Random(31)
    passage = words(rng, 60, 5000)
    long = [x for _ in range(300) for x in words(rng, 30, 5000) + passage]  # one document has most occurrences
    core = words(rng, 30, 5000)
    lefts, rights = ([words(rng, 12, 5000) for _ in range(40)] for _ in range(2))
    variants = [words(rng, 20, 5000) + a + core + b + words(rng, 20, 5000) for a in lefts for b in rights if rng.random() < 0.5]
    docs = [long, words(rng, 40, 5000) + passage + words(rng, 40, 5000), *variants]
    want = repeats(docs)
    assert len(want[0]) >= 300 * 60
    assert held_spans(suffixes.repeated_passages(table(spark, [" ".join(w) for w in docs])).collect()) == want


def test_op3_passages_that_share_a_core(spark):
    rng = random.Random(32)
    for n in (30, 49):
        x, common, y = words(rng, 40, 5000), words(rng, n, 5000), words(rng, 40, 5000)
        around = lambda w: words(rng, 30, 5000) + w + words(rng, 30, 5000)
        docs = [around(x + common), around(x + common), around(common + y), around(common + y)]
        df = table(spark, [" ".join(w) for w in docs])
        assert held_spans(suffixes.repeated_passages(df).collect()) == repeats(docs)
        cleaned = {r.doc_id: r.text for r in suffixes.without_repeats(df).collect()}
        for passage in (x + common, common + y):
            assert sum(" ".join(passage) in t for t in cleaned.values()) == 1


def test_op3_text_that_repeats_itself(spark):
    df = table(spark, ["a " * 200, "a " * 120])
    cleaned = {r.doc_id: r.text.split() for r in suffixes.without_repeats(df).collect()}
    assert cleaned == {0: ["a"] * 50, 1: []}


def test_op3_id_with_two_texts(spark):
    rng = random.Random(33)
    a, b = words(rng, 60, 5000), words(rng, 60, 5000)
    texts = [" ".join(w) for w in (a, b, ["x", *a], ["y", *b], ["y", *b], ["z"])]
    cleaned = suffixes.without_repeats(table(spark, texts, ids=[1, 2, 7, 7, 7, 7])).collect()
    assert sorted((r.doc_id, r.text.strip()) for r in cleaned) == sorted([(1, texts[0]), (2, texts[1]), (7, "x"), (7, "y"), (7, "y"), (7, "z")])


def test_op4_learns_from_documents_and_locates_sentences(spark):
    rng = random.Random(4)
    texts, toxic = [], []
    for i in range(400):
        sentences = [" ".join(words(rng, 8, 60)) for _ in range(rng.randrange(1, 12))]
        toxic.append(int(i % 4 == 0))
        if toxic[-1]:
            sentences.insert(rng.randrange(len(sentences) + 1), "you " + rng.choice(["zonk", "blarg"]) + " w1")
        texts.append(". ".join(sentences))
    texts += [None, "", "..."]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(toxic)] + [(None, 1), (3, None)], "doc_id long, toxic int")
    model = toxicity.fit(docs, labels)
    got = {r.doc_id: r.score for r in toxicity.score(docs, model).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 4 == 2]
    assert sum((got[i] >= 0.3) == bool(toxic[i]) for i in held) / len(held) > 0.97
    assert got[400] == got[401] == got[402] == 0
    found = toxicity.sentences(docs, model).collect()
    assert sum("zonk" in r.sentence or "blarg" in r.sentence for r in found) / len(found) > 0.95
    assert toxicity.score(docs.limit(0), model).count() == 0
    none = toxicity.fit(docs, labels.limit(0))
    assert all(r.score < 0.3 for r in toxicity.score(docs.limit(20), none).collect())


def test_op5_targets_and_subset_sums(spark):
    rng = random.Random(5)
    texts = [" ".join(words(rng, rng.randrange(1, 60))) for _ in range(300)] + [None, "", "\t "]
    df = table(spark, texts).selectExpr("doc_id", "text", "lang", "CASE doc_id % 4 WHEN 0 THEN 'b' WHEN 1 THEN 'a' WHEN 2 THEN 'C' END AS source", "n_chars")
    got = mixing.mix(df).collect()
    assert {r.doc_id: r.taken for r in mixing.mix(df.repartition(5)).collect()} == {r.doc_id: r.taken for r in got}
    size = Counter()
    for r in got:
        assert r.size == len((texts[r.doc_id] or "").split()) and 0 <= r.taken <= 2 * r.size
        size[r.source] += r.size
    order = sorted([s for s in size if s is not None]) + [None]
    weight = dict(zip(order, [5, 2, 1, 5]))
    left, target, budget = set(size), {}, 1.5 * sum(size.values())
    while left:
        level = (budget - sum(target.values())) / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] >= 2 * size[s]}
        target |= {s: 2.0 * size[s] for s in over} if over else {s: level * weight[s] for s in left}
        left -= over or left
    for r in got:
        assert r.source_size == size[r.source] and abs(r.target - target[r.source]) < 1e-6
    for s in size:
        assert abs(sum(r.taken for r in got if r.source == s) - target[s]) <= 1
    assert mixing.mix(df.limit(0)).count() == 0
    assert {r.doc_id for r in mixing.mixed(df).collect()} == {r.doc_id for r in got if r.taken}


def test_op5_budgets_against_brute_force():
    rng = random.Random(6)
    for _ in range(60):
        sizes = sorted(rng.sample(range(1, 30), rng.randrange(1, 5)))
        counts = [rng.randrange(1, 4) for _ in sizes]
        budget = rng.randrange(0, sum(s * c for s, c in zip(sizes, counts)) + 3)
        taken = mixing.fit_budget(np.array(sizes), np.array(counts), budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))


def test_op5_takes_the_nearest_sum():
    rng = random.Random(61)
    cases = [([300_000], [1], 200_000), ([150_000, 100_000, 99_000], [1, 1, 1], 199_000), ([10, 15, 16], [2, 1, 1], 31)]
    for longest in (30, 400_000):
        for _ in range(60):
            sizes = sorted(rng.sample(range(1, longest), rng.randrange(1, 5)))
            counts = [rng.randrange(1, 4) for _ in sizes]
            cases.append((sizes, counts, rng.randrange(0, sum(s * c for s, c in zip(sizes, counts)) + 3)))
    for sizes, counts, budget in cases:
        taken = mixing.fit_budget(np.array(sizes), np.array(counts), budget)
        assert all(0 <= t <= c for t, c in zip(taken, counts))
        sums = {0}
        for s, c in zip(sizes, counts):
            sums = {a + s * k for a in sums for k in range(c + 1)}
        assert abs(int(np.dot(sizes, taken)) - budget) == min(abs(a - budget) for a in sums), (sizes, counts, budget)


def test_op5_one_document_above_the_table(monkeypatch):
    monkeypatch.setattr(mixing, "MOST_SUMS", 0)  # the search of large sources
    assert mixing.fit_budget(np.array([300_000]), np.array([1]), 200_000).tolist() == [1]
    assert mixing.fit_budget(np.array([300_000]), np.array([1]), 100_000).tolist() == [0]


def test_op6_brute_force(spark):
    rng = random.Random(7)
    base = words(rng, 120, 3000)
    docs = [words(rng, rng.randrange(0, 80), 3000) for _ in range(40)] + [["A", "b"], ["a", "B"], ["a"], [], base]
    for _ in range(60):
        w = list(base)
        for _ in range(rng.randrange(0, 9)):
            w[rng.randrange(len(w))] = f"n{rng.randrange(10**6)}"
        docs.append(w)
    texts = [" ".join(w) for w in docs] + [None, texts_copy(docs[44])]
    sets = []
    for t in texts:
        w = [x for x in (t or "").lower().split()]
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    links = defaultdict(set)
    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and 100 * len(sets[i] & sets[j]) >= 75 * len(sets[i] | sets[j]):
                links[i].add(j)
                links[j].add(i)
    want = dict(enumerate(zip(map(len, sets), _components(range(len(sets)), links))))
    df = table(spark, texts)
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in minhash.near_duplicates(df).collect()} == want
    assert {r.doc_id for r in minhash.one_of_each(df).collect()} == {i for i, (_, c) in want.items() if i == c}
    assert minhash.near_duplicates(df.limit(0)).count() == 0
    nulls = table(spark, ["a b c d e f", "a b c d e f", "x"], ids=[None, 5, None])
    assert sorted((r.doc_id or -1, r.component_id, r.kept) for r in minhash.near_duplicates(nulls).select("doc_id", "component_id", "kept").collect() if r.doc_id) == [(5, 5, True)]


def texts_copy(w):
    return "  ".join(w).upper()


def test_op6_sketches_leave_out_no_link():
    rng = np.random.default_rng(66)
    sets = []
    for n in (1, 2, 3, 6, 7, 8, 40, 100, 600, 3000, 20000):
        base = rng.integers(0, 1 << 63, n, dtype=np.uint64)
        for share in (0.0, 0.05, 0.12, 0.14, 0.2, 0.3, 1.0):
            other = base.copy()
            other[: int(n * share)] = rng.integers(0, 1 << 63, int(n * share), dtype=np.uint64)
            sets += [np.unique(other), np.unique(other[: max(1, int(n * 0.8))])]
    sketches, sizes = [minhash.parity_sketch(m) for m in sets], np.array([len(m) for m in sets])
    a, b = (x.ravel() for x in np.meshgrid(np.arange(len(sets)), np.arange(len(sets))))
    able = minhash.may_link(a, b, sketches, sketches, sizes, sizes, 75)
    shared = np.array([len(np.intersect1d(sets[i], sets[j], assume_unique=True)) for i, j in zip(a, b, strict=True)])
    union = sizes[a] + sizes[b] - shared
    linked = 100 * shared >= 75 * union
    assert linked.sum() > len(sets) and able[linked].all()
    far = (100 * shared < 60 * union) & (np.maximum(sizes[a], sizes[b]) <= 8000)
    assert not able[far].all() and able[far].mean() < 0.02
    none = np.zeros(0, np.int64)
    assert len(minhash.may_link(none, none, [], [], none, none, 75)) == 0


def test_op7_round_trip(spark):
    path = tokenizer_file("byte_bpe_50k.json")
    df = table(spark, ODD_TEXTS).repartition(3)
    folder = scratch_path(spark, "records")
    token_records.write_records(df, f"{folder}/data", path)
    token_records.write_index(spark, f"{folder}/data", f"{folder}/index")
    index = spark.read.parquet(f"{folder}/index")
    got = token_records.read_records(spark, f"{folder}/data").join(token_records.file_starts(index), "file").orderBy("doc_id").collect()
    enc, start = encoder(path), 0
    for i, r in enumerate(got):
        ids = np.append(enc.plain([ODD_TEXTS[i] or ""])[0], 0).astype("<u4").tobytes()
        assert (r.doc_id, r.file_start + r.start_in_file, r.n_tokens, r.ids, r.ids_crc32) == (i, start, len(ids) // 4, ids, zlib.crc32(ids))
        start += r.n_tokens
    assert index.count() == len(ODD_TEXTS)
    frame = token_records.frame(token_records.serialize(3, np.arange(5), 2)) + b"\n"
    assert [token_records.parse(p)[1].tolist() for _, p in token_records.frames(frame * 2)] == [[0, 1, 2, 3, 4]] * 2
    for k in (0, 9, 14, len(frame) - 2):
        broken = bytearray(frame)
        broken[k] ^= 1
        with pytest.raises(ValueError):
            list(token_records.frames(bytes(broken)))


def test_op8_equals_best_fit_decreasing(spark):
    for seed in range(30):
        rng = random.Random(seed)
        cap = rng.choice([10, 50, 2048])
        items = [rng.choice([rng.randint(1, cap), rng.randint(1, max(1, cap // 9))]) for _ in range(rng.randint(0, 200))]
        bins = []
        for n in sorted(items, reverse=True):
            fit = [(g, i) for i, g in enumerate(bins) if g >= n]
            if fit:
                bins[min(fit)[1]] -= n
            else:
                bins.append(cap - n)
        assert packing.best_fit_plan(dict(Counter(items)), cap)[1] == len(bins)
    texts = [*ODD_TEXTS, *["a b c"] * 9]
    got = packing.pack(packing.token_pieces(table(spark, texts), tokenizer_file("word_bpe_49k.json"), 64), 64).collect()
    enc, whole, used = encoder(tokenizer_file("word_bpe_49k.json")), defaultdict(bytes), defaultdict(list)
    for r in sorted(got, key=lambda r: (r.doc_id, r.piece)):
        assert r.start == len(whole[r.doc_id]) // 4 and len(r.ids) == 4 * r.length
        whole[r.doc_id] += r.ids
        used[r.sequence_id].append((r.offset, r.length))
    for i, t in enumerate(texts):
        assert whole[i] == np.append(enc.plain([t or ""])[0], 0).astype("<u4").tobytes()
    for places in used.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= 64
    empty = table(spark, ["x"]).limit(0)
    assert packing.pack(packing.token_pieces(empty, tokenizer_file("word_bpe_49k.json"), 64), 64).count() == 0


def test_op9_held_out(spark):
    rng = random.Random(9)
    texts, good = [], []
    for i in range(400):
        w = words(rng, rng.randrange(5, 60))
        good.append(int(i % 3 > 0))
        texts.append(" ".join(w) if good[-1] else rng.choice([" ".join(w).upper() + "!!", " ".join(x for x in w for _ in range(5))]))
    texts += [None, ""]
    docs = table(spark, texts)
    labels = spark.createDataFrame([(i, y) for i, y in enumerate(good)] + [(None, 1), (2, None)], "doc_id long, quality int")
    got = {r.doc_id: r.score for r in quality.score(docs, quality.fit(docs, labels)).collect()}
    held = [i for i in range(400) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert sum((got[i] >= 0.3) == bool(good[i]) for i in held) / len(held) > 0.95
    assert got[400] == got[401] and all(0 <= s <= 1 for s in got.values())
    assert all(r.score == 0.5 for r in quality.score(docs.limit(5), quality.fit(docs, labels.limit(0))).collect())


def test_op10_pairs_and_likeness(spark):
    texts = [t for t in ODD_TEXTS] + ["".join(random.Random(8).choices("abcdé ", k=5000))] * 2
    got = {r.doc_id: r for r in chunking.edited_fingerprints(table(spark, texts).repartition(4)).collect()}
    assert len(got) == len(texts)
    for i, t in enumerate(texts):
        own, after = t or "", texts[(i - 1) % len(texts)] or ""
        half = len(own) // 2
        edited = own[: len(own) - half] + after[:half]
        r = got[i]
        assert (r.n_chars, r.edited_sha256) == (len(own), hashlib.sha256(edited.encode()).hexdigest())
        sets = chunking.chunk_sets(*textbytes.text_bytes(pa.array([own, edited, after])))
        assert r.fingerprint == chunking.fingerprint(sets[0]) and r.edited_fingerprint == chunking.fingerprint(sets[1])
        assert r.near_next == chunking.likeness(sets[0], sets[2])
    last = len(texts) - 1
    assert got[last].fingerprint == got[last - 1].fingerprint and got[last].near_next == 1.0
    assert chunking.edited_fingerprints(table(spark, ["x"]).limit(0)).count() == 0
    odd = chunking.edited_fingerprints(table(spark, ["abcd", "efgh", "ij", "kl"], ids=[None, 1, 1, None])).collect()
    assert sorted((r.doc_id or -1) for r in odd) == [-1, -1, 1, 1]


def test_op10_chunks_resist_shifts():
    rng = random.Random(10)
    text = "".join(rng.choices("abcdefgh ", k=20000))
    a, b = chunking.chunk_sets(*textbytes.text_bytes(pa.array([text, "zz" + text])))
    assert chunking.likeness(a, b) > 0.95

"""Randomised fixtures checked against brute-force Python versions of the
reference semantics (fixed seeds, one Spark job per operator)."""

import random
import re

from pyspark.sql import functions as F

from bagyard.functions import paths as P
from bagyard.functions import text as TX
from bagyard.operators import aggs, joins
from bagyard.sources import scans

SEGS = ["a", "b", "c", ".d", "e.f", "g_h"]


def _rand_path(rng, max_depth=5):
    return "/".join(rng.choice(SEGS) for _ in range(rng.randint(1, max_depth)))


def test_nearest_ancestor_bruteforce(spark):
    rng = random.Random(7)
    datasets = ["ds:1", "ds:2", "ds:3"]
    reqs = [(i, rng.choice(datasets), _rand_path(rng)) for i in range(400)]
    cat = []
    for i in range(150):
        p = _rand_path(rng, 4)
        cat.append((f"f:{i:03d}", p + ("/" if rng.random() < 0.3 else ""), rng.choice(datasets)))

    def brute(ds, path):
        # walk up: parent, grand-parent, ... ; a folder matches stored with or without one trailing '/'
        parts = path.split("/")
        for depth in range(len(parts) - 1, 0, -1):
            anc = "/".join(parts[:depth])
            pids = [pid for pid, cp, cds in cat if cds == ds and (cp == anc or cp == anc + "/")]
            if pids:
                return anc, min(pids)
        return "", ds

    r = spark.createDataFrame(reqs, "request_id long, dataset_id string, path_in_dataset string")
    c = spark.createDataFrame(cat, "pid string, path string, dataset_sid string")
    got = {x.request_id: (x.ancestor_path, x.ancestor_pid) for x in joins.nearest_ancestor(r, c).collect()}
    want = {i: brute(ds, p) for i, ds, p in reqs}
    assert got == want


def test_single_value_bruteforce(spark):
    rng = random.Random(11)
    vals = ["", "x", "y", "text/plain"]
    recs = [(rng.randint(1, 5), f"p{rng.randint(1, 40)}", [rng.choice(vals) for _ in range(rng.choice([0, 0, 1, 1, 1, 2]))]) for _ in range(600)]
    df = spark.createDataFrame(recs, "deposit_id long, filepath string, format array<string>")
    got = {(x.deposit_id, x.filepath): (x.format, x.n_format) for x in aggs.single_value(df, ["deposit_id", "filepath"], ["format"]).collect()}
    want = {}
    for d, p, f in recs:
        want.setdefault((d, p), []).extend(f)
    want = {k: (v[0] if len(v) == 1 else None, len(v)) for k, v in want.items()}
    assert got == want


def test_uri_mapping_bruteforce(spark):
    rng = random.Random(3)
    blanks = [" ", "\t", "  ", " \t "]
    lines = []
    for i in range(300):
        path = "data/" + rng.choice(["p", "q r", "s"]) + str(rng.randint(0, 30))
        kind = rng.random()
        if kind < 0.1:
            line = path.replace(" ", "_") + "http://x/" + str(i)  # no whitespace at all: bad
        elif kind < 0.15:
            line = ""
        else:
            line = path + rng.choice(blanks) + "http://x/" + str(i) + (" " if rng.random() < 0.1 else "")
        lines.append((i % 4, i, line))
    df = spark.createDataFrame(lines, "deposit_id long, line_no long, line string")
    got = {(x.deposit_id, x.path): (x.uri, x.bad_lines) for x in scans.parse_uri_mapping(df).collect()}

    pat = re.compile(r"^(.*)\s+(.*)$")

    def jtrim(s):
        return s.strip("".join(chr(c) for c in range(0x21)))

    mapping, bad = {}, {}
    for dep, _, line in sorted(lines, key=lambda t: t[1]):
        if line == "":
            continue
        m = pat.search(line)
        if not m:
            bad[dep] = bad.get(dep, 0) + 1
            continue
        mapping[(dep, jtrim(m.group(1)))] = jtrim(m.group(2))  # last wins
    want = {k: (v, bad.get(k[0], 0)) for k, v in mapping.items()}
    assert got == want


def test_path_functions_bruteforce(spark):
    rng = random.Random(5)
    paths = list({_rand_path(rng, 6) for _ in range(300)}) + ["_x", "__y", ".z"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    out = df.select("p", P.sdo_name(F.col("p")).alias("s"), P.ancestor_paths(F.col("p")).alias("a"), P.parent_path(F.col("p")).alias("par")).collect()
    for r in out:
        assert r.s == re.sub(r"^_", "", re.sub(r"[/.]", "_", r.p))
        parts = r.p.split("/")
        assert r.a == ["/".join(parts[:i]) for i in range(1, len(parts))]
        assert r.par == ("/".join(parts[:-1]) if len(parts) > 1 else None)


def test_jvm_trim_bruteforce(spark):
    rng = random.Random(9)
    alphabet = [" ", "\t", "\n", "\x01", "\x1f", "a", "b", " ", "é"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 8))) for _ in range(300)]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    got = [r[0] for r in df.select(TX.jtrim(F.col("t"))).collect()]
    assert got == [t.strip("".join(chr(c) for c in range(0x21))) for t in texts]


def test_first_failure_and_collect_bruteforce(spark):
    rng = random.Random(13)
    codes = [("invalid_state", 1), ("urn_missing", 10), ("format_not_unique", 14), ("bad_url", 14), ("license_count", 9)]
    rows = []
    for _ in range(500):
        code, stage = rng.choice(codes)
        rows.append((rng.randint(1, 40), rng.choice([None, f"f{rng.randint(0, 5)}"]), stage, code, f"m{rng.randint(0, 9)}"))
    df = spark.createDataFrame(rows, "deposit_id long, item string, stage int, code string, message string")
    got = {r.deposit_id: (r.stage, r.code, r.message, r.item) for r in aggs.first_failure(df).collect()}
    want = {}
    for d, item, stage, code, msg in rows:
        key = (stage, code, item or "", msg)
        if d not in want or key < want[d][0]:
            want[d] = (key, (stage, code, msg, item))
    assert got == {d: v for d, (_, v) in want.items()}
    counts = {r.deposit_id: (r.n_failures, r.n_codes, r.first_message) for r in aggs.collect_failures(df).collect()}
    for d in want:
        mine = [r for r in rows if r[0] == d]
        assert counts[d] == (len(mine), len({r[3] for r in mine}), min(r[4] for r in mine))


def test_header_audit_bruteforce(spark):
    from bagyard import constants as K
    from bagyard.operators import sets

    rng = random.Random(17)
    cells = []
    for f in range(30):
        cols = [o.upper() if rng.random() < 0.3 else o for o in K.REQUEST_OPTIONS if rng.random() < 0.8]
        cols += [c for c in ["note", "Extra"] if rng.random() < 0.4]
        cells += [(f, i, c) for i, c in enumerate(cols)]
    df = spark.createDataFrame(cells, "file_id long, col_pos int, column string")
    got = {(r.file_id, r.column, r.kind) for r in sets.header_audit(df).collect()}
    want = set()
    req = {o.lower() for o in K.REQUEST_OPTIONS}
    for f in {c[0] for c in cells}:
        actual = {c[2].lower() for c in cells if c[0] == f}
        want |= {(f, m, "missing") for m in req - actual}
        want |= {(f, i, "ignored") for i in actual - req}
    assert got == want

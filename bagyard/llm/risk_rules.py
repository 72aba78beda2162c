"""op11: quality rules whose cutoffs keep the false-rejection risk of every stratum under a stated level.

Built-in column functions only.  ``measures`` counts per text, ``cutoffs`` learns
one cutoff per stratum and rule from labelled rows, ``verdicts`` applies them.

A rule is a whole-number measure of a text; it rejects texts at or above its
cutoff.  The cutoffs 1000, 999, ... 1 are tested from lax to strict on the
labelled holdout (rows of ``quality`` 1 outside the tuning fold that pass the
base rules): with n such rows in a stratum and k of them rejected, the
hypothesis "the rule rejects more than ``risk`` / number of rules of the good
texts" is refuted if P[Bin(n, risk / rules) <= k] <= ``delta`` / (strata * rules),
the exact binomial (Clopper-Pearson) test with Bonferroni's correction over
strata and rules.  k only grows along the cutoffs, so testing stops at the first
that is not refuted (fixed sequence, no further correction), and all laxer ones
are safe at once: with probability 1 - ``delta`` no stratum loses more than
``risk`` of its good texts to its cutoffs, whichever safe cutoff is taken.
Among the safe ones the tuning fold chooses: the largest share of rejected bad
texts less ``penalty`` times the share of rejected good ones, the laxest of
equals; none if no safe cutoff has a gain.  A stratum with too few labelled rows
refutes nothing and has no cutoffs.

Defined cases: a null text has no words (all counts 0, base rule failed); null
``lang`` is a stratum of its own; a stratum without labelled rows has no cutoffs;
labels of repeated ids count as 1 if any says 1, null ids and null labels are
left out; repeated rows are counted and returned each; empty tables give empty
results; other columns are not read, so their names cannot clash.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bagyard.session import cut_lineage

WORD = r"[^\x20\x09-\x0D]+"
SYMBOLS = "#*$%&|<>"
WINDOW = 8
RULES = ("symbol_share", "dup_line_share", "repeat_share", "word_length")  # 0 to 1000 each
RISK, DELTA, PENALTY = 0.04, 0.05, 10
TUNING_FOLDS = 3  # one fold of three tunes, the others are the holdout


def _shown_twice(pairs: Column) -> Column:
    """Of (hash, place) pairs in order, those whose hash a neighbour shares."""
    same = lambda s, i: F.get(pairs, i)["h"] == s["h"]
    return F.filter(pairs, lambda s, i: F.coalesce(same(s, i - 1), F.lit(False)) | F.coalesce(same(s, i + 1), F.lit(False)))


def _covered(places: Column) -> Column:
    """Words under the windows that begin at ``places`` (ascending)."""
    each = F.transform(places, lambda p, i: F.coalesce(F.least(F.lit(WINDOW), F.get(places, i + 1) - p), F.lit(WINDOW)))
    return F.aggregate(each, F.lit(0), lambda total, x: total + x)


def measures(docs: DataFrame) -> DataFrame:
    """Per row: doc_id, lang, n_words, n_lines and the base counts, over whole texts.

    Windows of 8 words are told by hash; where hashes meet, the words themselves
    are compared, and should they ever differ, that text's windows are compared
    as text.  All steps are linear or one sort per text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    at = lambda a, p: F.slice(a, p + 1, WINDOW)
    df = docs.select("doc_id", "lang", text.alias("text"))
    df = df.select("doc_id", "lang", "text", F.regexp_extract_all("text", F.lit(WORD), F.lit(0)).alias("w"), F.filter(F.split("text", "\n"), lambda x: x.rlike(WORD)).alias("lines"))
    chars = F.char_length("text")
    df = df.select(
        "doc_id",
        "lang",
        "w",
        F.size("w").alias("n_words"),
        F.char_length(F.translate("text", " \t\n\x0b\x0c\r", "")).alias("word_chars"),
        (chars - F.char_length(F.translate("text", SYMBOLS, ""))).alias("n_symbols"),
        F.size("lines").alias("n_lines"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        F.when(F.size("w") > WINDOW, F.transform("w", lambda x: F.xxhash64(x))).alias("h"),
    )
    kept = ["doc_id", "lang", "n_words", "word_chars", "n_symbols", "n_lines", "n_dup_lines"]
    df = df.select(*kept, "w", F.when(F.col("h").isNotNull(), F.transform(F.sequence(F.lit(0), F.size("h") - WINDOW), lambda i: F.xxhash64(at(F.col("h"), i)))).alias("win"))
    pairs = F.array_sort(F.transform("win", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))
    df = df.select(*kept, "w", F.when(F.size(F.array_distinct("win")) < F.size("win"), pairs).alias("pairs"))
    df = df.select(*kept, "w", _shown_twice(F.col("pairs")).alias("pairs"))
    before = lambda i: F.get("pairs", i - 1)
    differ = F.exists(
        F.transform("pairs", lambda s, i: (before(i)["h"] == s["h"]) & (at(F.col("w"), before(i)["p"]) != at(F.col("w"), s["p"]))),
        lambda x: F.coalesce(x, F.lit(False)),
    )
    texts = F.array_sort(F.transform("pairs", lambda s: F.struct(F.array_join(at(F.col("w"), s["p"]), " ").alias("h"), s["p"].alias("p"))))
    df = df.select(*kept, "pairs", F.when(differ, texts).alias("texts"))
    places = lambda a: F.array_sort(F.transform(a, lambda s: s["p"]))
    df = df.select(*kept, F.when(F.col("texts").isNull(), places(F.col("pairs"))).otherwise(places(_shown_twice(F.col("texts")))).alias("places"))
    counts = [F.col(c).cast("long").alias(c) for c in kept[2:]]
    return df.select("doc_id", "lang", *counts, F.coalesce(_covered(F.col("places")), F.lit(0)).cast("long").alias("n_repeat_words"))


def with_rules(counts: DataFrame) -> DataFrame:
    """Add ``base_failed`` and the measures of RULES (whole numbers from 0 to 1000)."""
    share = lambda a, b: F.coalesce(F.expr(f"least(1000, 1000 * {a} div nullif({b}, 0))"), F.lit(0)).cast("int")
    return counts.withColumns({
        "base_failed": (F.col("n_words") < 20) | (100 * F.col("n_repeat_words") > 30 * F.col("n_words")),
        "symbol_share": share("n_symbols", "word_chars"),
        "dup_line_share": share("n_dup_lines", "n_lines"),
        "repeat_share": share("n_repeat_words", "n_words"),
        "word_length": F.coalesce(F.expr("least(1000, 20 * word_chars div nullif(n_words, 0))"), F.lit(0)).cast("int"),
    })


def _allowed(n: Column, level: Column, risk: float) -> Column:
    """Largest k with P[Bin(n, risk) <= k] <= level; -1 if there is none.

    Terms are summed upwards from k = 0, in logarithms until they are added."""
    step = math.log(risk / (1.0 - risk))
    zero = F.struct((n * F.lit(math.log1p(-risk))).alias("log"), F.lit(0.0).alias("below"), F.lit(-1).cast("long").alias("best"))

    def add(acc: Column, k: Column) -> Column:
        term = F.when(k == 0, acc["log"]).otherwise(acc["log"] + F.log((n - k + 1) / k) + F.lit(step))
        below = acc["below"] + F.exp(term)
        return F.struct(term.alias("log"), below.alias("below"), F.when(below <= level, k).otherwise(acc["best"]).alias("best"))

    return F.aggregate(F.sequence(F.lit(0).cast("long"), F.floor(n * F.lit(risk))), zero, add, lambda acc: acc["best"])


def cutoffs(ruled: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, penalty: float = PENALTY) -> DataFrame:
    """Per stratum (``lang``) and rule with a cutoff: lang, rule, cutoff, n_good and rejected_good (holdout), allowed (largest safe k).

    One aggregate of the labelled rows by stratum, rule and value (at most 1001 values) feeds everything after it."""
    fold = F.conv(F.substring(F.md5(F.col("doc_id").cast("string").cast("binary")), 1, 7), 16, 10).cast("long") % TUNING_FOLDS
    known = labels.where(F.col("doc_id").isNotNull() & F.col("quality").isNotNull()).groupBy(F.col("doc_id").alias("doc_id"))
    known = known.agg(F.max(F.col("quality").cast("int")).alias("good")).where("good IN (0, 1)").withColumn("tuning", fold == 0)
    rows = ruled.where("NOT base_failed").select("doc_id", "lang", *RULES).join(known, "doc_id")
    rule_values = F.array(*[F.struct(F.lit(r).alias("rule"), F.col(r).alias("value")) for r in RULES])
    rows = rows.select("lang", "good", "tuning", F.inline(rule_values))
    tally = lambda good, tuning: F.count(F.when((F.col("good") == good) & (F.col("tuning") == F.lit(tuning)), 1))
    values = rows.groupBy("lang", "rule", "value").agg(tally(1, False).alias("held"), tally(1, True).alias("good"), tally(0, True).alias("bad"))
    values = cut_lineage(values, "rule_values")

    risk_each = risk / len(RULES)
    strata = values.where(F.col("rule") == RULES[0]).groupBy("lang").agg(F.sum("held").alias("n_good")).where("n_good > 0")
    tests = F.count(F.lit(1)).over(W.partitionBy()) * len(RULES)  # one row per stratum
    strata = strata.withColumn("level", F.lit(delta) / tests).select("lang", "n_good", "level")
    strata = strata.withColumn("allowed", _allowed(F.col("n_good"), F.col("level"), risk_each)).where("allowed >= 0")

    each = W.partitionBy("lang", "rule")
    at_or_above = each.orderBy(F.desc("value")).rowsBetween(W.unboundedPreceding, 0)
    share = lambda c: F.coalesce(F.sum(c).over(at_or_above) / F.nullif(F.sum(c).over(each), F.lit(0)), F.lit(0.0))
    cuts = values.select("lang", "rule", "value", F.sum("held").over(at_or_above).alias("rejected_good"), (share("bad") - F.lit(float(penalty)) * share("good")).alias("gain"))
    cuts = cuts.withColumnRenamed("lang", "_lang")
    cuts = cuts.join(strata, F.col("_lang").eqNullSafe(F.col("lang"))).where("rejected_good <= allowed AND gain > 0 AND value > 0")
    best = F.max_by(F.struct(F.col("value").alias("cutoff"), "rejected_good", "n_good", "allowed"), F.struct("gain", "value"))
    return cuts.groupBy("lang", "rule").agg(best.alias("b")).select("lang", "rule", "b.*")


def verdicts(ruled: DataFrame, cuts: DataFrame) -> DataFrame:
    """Add ``failed_rules`` (rules at or above their stratum's cutoff) and ``kept``.

    The cutoffs are read from a written table: Spark broadcasts them if their
    size is small enough, and shuffles otherwise."""
    wide = cuts.groupBy(F.col("lang").alias("_lang")).agg(F.map_from_entries(F.collect_list(F.struct("rule", "cutoff"))).alias("_cuts"))
    wide = cut_lineage(wide, "cutoffs")
    out = ruled.join(wide, F.col("lang").eqNullSafe(F.col("_lang")), "left")
    failed = F.array_compact(F.array(*[F.when(F.col(r) >= F.try_element_at("_cuts", F.lit(r)), F.lit(r)) for r in RULES]))
    out = out.withColumn("failed_rules", failed)
    return out.withColumn("kept", ~F.col("base_failed") & (F.size("failed_rules") == 0)).drop("_lang", "_cuts")


def judge(docs: DataFrame, labels: DataFrame, risk: float = RISK, delta: float = DELTA, penalty: float = PENALTY) -> DataFrame:
    """All documents with their counts, rule measures, base rule, failed rules and verdict.

    The counts are written once (a few numbers per document) and read for the cutoffs and for the verdicts."""
    ruled = with_rules(cut_lineage(measures(docs), "rule_counts"))
    return verdicts(ruled, cutoffs(ruled, labels, risk, delta, penalty))

"""Mixing sources to target weights: subset-sum budget fitting.

Sizes are words (runs of characters other than ASCII white space).  Sources in
code-point order (null last) get the weights in turn and share ``share`` times
all words; a target stops at ``most`` times its source's words, the excess goes
to the others by weight until none is above.  That is one water level: with
sources sorted by limit / weight, running totals tell which stop at their limit.

Every document is taken ``floor(target / source words)`` times or once more.
Who is taken once more is a subset-sum problem per source: its documents are
counted by exact length, a share of each length's count is taken first, and a
bounded-knapsack dynamic program over what is left of the counts meets the
remaining budget (its table is at most ``DP_WORDS`` longer than that; one document
above the table is compared, too).  Where that misses the budget, the sums of all
documents are listed while there are at most ``MOST_SUMS`` of them.  Within a length
the seeded hash of the document decides, by rank, who is taken.

Null text has size 0; documents of size 0 are kept with 0 words taken.  Rows
that repeat are single documents each.  An empty table gives no rows.  Sums are
exact; a source takes the reachable number of words nearest to its target, or, where
it has more than ``MOST_SUMS`` sums and the share misses, the nearest that the search finds.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from bagyard.llm.frames import apart, cut_lineage, one_row_each, rank_within, running

WORD = r"[^\x20\x09-\x0D]+"
DP_WORDS = 1 << 16
MOST_SUMS = 1 << 17


def fit_budget(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray:
    """How many documents of each length (distinct, positive) to take so that their words come as near to ``budget`` as the search finds."""
    sizes, counts = np.asarray(sizes, np.int64), np.asarray(counts, np.int64)
    taken = np.zeros(len(sizes), np.int64)
    total = int((sizes * counts).sum())
    if budget <= 0 or not total:
        return taken
    if budget >= total:
        return counts.copy()
    taken = _share_and_rest(sizes, counts, budget, total)
    if int((sizes * taken).sum()) != budget and (nearest := _nearest_sum(sizes, counts, budget)) is not None:
        return nearest
    return taken


def _share_and_rest(sizes: np.ndarray, counts: np.ndarray, budget: int, total: int) -> np.ndarray:
    """A share of each length's count, and the rest of the budget by a table."""
    taken = np.array([int(c) * budget // total for c in counts.tolist()], np.int64)
    left = budget - int((sizes * taken).sum())
    order = np.argsort(-sizes, kind="stable")
    for i in order:  # whole documents until the rest fits the table, which needs some room to choose
        if left <= DP_WORDS:
            break
        n = min(int(counts[i] - taken[i]), max(0, left - DP_WORDS // 2) // int(sizes[i]))
        taken[i] += n
        left -= n * int(sizes[i])
    free = counts - taken
    top = left + int(min(DP_WORDS, sizes[free > 0].max(initial=0)))
    reach = np.zeros(top + 1, bool)
    reach[0] = True
    by = np.full(top + 1, -1, np.int64)  # the step that first reached a sum
    steps: list[tuple[int, int]] = []
    for i in order[::-1]:
        size, n, part = int(sizes[i]), int(min(free[i], top // int(sizes[i]))), 1
        while n > 0 and not reach[left]:
            k = min(part, n)
            new = np.flatnonzero(reach[: max(0, top + 1 - k * size)]) + k * size
            new = new[~reach[new]]
            reach[new] = True
            by[new] = len(steps)
            steps.append((int(i), k))
            n, part = n - k, part * 2
        if reach[left]:
            break
    sums = np.flatnonzero(reach)
    at = int(sums[np.argmin(np.abs(sums - left))])
    over = sizes[(free > 0) & (sizes > top)]
    if over.size and int(over.min()) - left < abs(at - left):  # a sum above the table that is nearest is one such document
        taken[np.flatnonzero((free > 0) & (sizes == over.min()))[0]] += 1
        return taken
    while at:
        i, k = steps[by[at]]
        taken[i] += k
        at -= k * int(sizes[i])
    return taken


def _nearest_sum(sizes: np.ndarray, counts: np.ndarray, budget: int) -> np.ndarray | None:
    """The numbers to take whose words are nearest to ``budget``, or None where more than ``MOST_SUMS`` sums are below the nearest."""
    sums, by = np.zeros(1, np.int64), np.full(1, -1, np.int64)  # sorted, and the step that first reached each
    above = int((sizes * counts).sum())
    steps: list[tuple[int, int]] = []
    for i in np.argsort(sizes, kind="stable").tolist():
        n, part = int(counts[i]), 1
        while n > 0 and sums[np.searchsorted(sums, budget, side="right") - 1] != budget:
            k = min(part, n)
            new = sums + k * int(sizes[i])
            new = np.setdiff1d(new[new <= above], sums, assume_unique=True)
            sums, by = np.append(sums, new), np.append(by, np.full(len(new), len(steps)))
            order = np.argsort(sums, kind="stable")
            sums, by = sums[order], by[order]
            steps.append((i, k))
            if (over := sums[np.searchsorted(sums, budget) :]).size:
                above = min(above, int(over[0]))
                sums, by = sums[sums <= above], by[sums <= above]  # nearer to the budget is none above it
            if len(sums) > MOST_SUMS:
                return None
            n, part = n - k, part * 2
    at, taken = int(sums[np.argmin(np.abs(sums - budget))]), np.zeros(len(sizes), np.int64)
    while at:
        i, k = steps[by[np.searchsorted(sums, at)]]
        taken[i] += k
        at -= k * int(sizes[i])
    return taken


def targets(sizes: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, source_size, target) from rows with source and size."""
    totals = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    totals = running(totals, [F.col("source").asc_nulls_last()], {"_rank": F.lit(1)})
    turn = F.array(*[F.lit(float(w)) for w in weights])
    totals = totals.withColumn("_w", F.element_at(turn, (F.pmod(F.col("_rank") - 1, F.lit(len(weights))) + 1).cast("int"))).withColumn("_cap", F.col("source_size") * F.lit(float(most)))
    ratio = F.col("_cap") / F.col("_w")
    level = running(totals, [ratio.asc(), F.col("source").asc_nulls_last()], {"_caps": F.col("_cap"), "_ws": F.col("_w")})
    whole = level.agg((F.sum("source_size") * F.lit(float(share))).alias("_budget"), F.sum("_w").alias("_all_w"))
    level = level.crossJoin(F.broadcast(whole))  # one row
    level = level.withColumn("_stops", F.col("_caps") + ratio * (F.col("_all_w") - F.col("_ws")) <= F.col("_budget"))
    rest = level.agg(F.sum(F.when(F.col("_stops"), F.col("_cap")).otherwise(0.0)).alias("_used"), F.sum(F.when(~F.col("_stops"), F.col("_w")).otherwise(0.0)).alias("_open"))
    level = level.crossJoin(F.broadcast(rest))  # one row
    share_of = (F.col("_budget") - F.col("_used")) * F.col("_w") / F.col("_open")
    return level.select("source", "source_size", F.when(F.col("_stops") | (F.col("_open") == 0), F.col("_cap")).otherwise(F.least(share_of, F.col("_cap"))).alias("target"))


def mix(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 11) -> DataFrame:
    """Per document: doc_id, text_hash, source, size, source_size, target, copies, taken (= copies * size)."""
    sizes = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), F.col("source").cast("string").alias("source"), F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size"))
    sizes = cut_lineage(sizes, "sizes")
    goal = cut_lineage(targets(sizes, weights, share, most), "targets")
    groups = sizes.where("size > 0").groupBy("source", "size").agg(F.count(F.lit(1)).alias("n"))

    def fit(frame: pd.DataFrame) -> pd.DataFrame:
        total, goal = int((frame["size"] * frame["n"]).sum()), frame["target"].iloc[0]
        base = int(goal // total)
        more = fit_budget(frame["size"].to_numpy(), frame["n"].to_numpy(), round(goal) - base * total)
        return pd.DataFrame({"source": frame["source"], "size": frame["size"], "base": base, "more": more})

    goals = goal.withColumnsRenamed({"source": "_source"})
    histogram = groups.join(goals, F.col("source").eqNullSafe(F.col("_source"))).select("source", "size", "n", "target")
    chosen = cut_lineage(histogram.groupBy("source").applyInPandas(fit, "source string, size long, base long, more long"), "chosen")
    ranked = rank_within(sizes, ["source", "size"], F.xxhash64(F.lit(seed), F.col("doc_id")), [F.col("doc_id")], "_rank")
    renamed = chosen.withColumnsRenamed({"source": "_cs", "size": "_cz"})
    out = ranked.join(renamed, F.col("source").eqNullSafe(F.col("_cs")) & (F.col("size") == F.col("_cz")), "left")
    out = out.withColumn("copies", F.coalesce(F.col("base") + (F.col("_rank") < F.col("more")).cast("long"), F.lit(0)))
    out = out.join(goals, F.col("source").eqNullSafe(F.col("_source")))
    return out.select("doc_id", "text_hash", "source", "size", "source_size", "target", F.col("copies").cast("long").alias("copies"), (F.col("copies") * F.col("size")).cast("long").alias("taken"))


def mixed(docs: DataFrame, weights: Sequence[float] = (5, 2, 1), share: float = 1.5, most: float = 2.0, seed: int = 11) -> DataFrame:
    """``docs`` with every row as often as the mix takes it, rows without words left out.

    Of rows that repeat an id, a text and a source, the first by its other columns stands for all: it comes as often as they do together."""
    mine = apart(docs, ("doc_id", "text", "source"))
    copies = mix(mine, weights, share, most, seed).groupBy("doc_id", "text_hash", "source").agg(F.sum("copies").alias("_copies")).where("_copies > 0")
    copies = cut_lineage(_keyed(copies, F.col("text_hash")).select(*KEY, "_copies"), "copies")
    # dealt by the key once, for the first rows and for the join: the texts are moved one time
    first = one_row_each(_keyed(mine, F.xxhash64("text")), *[F.col(k) for k in KEY])
    out = first.join(copies, KEY).withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_copies").cast("int"))))
    return out.select(*[F.col(f"`{c}`") for c in mine.columns]).toDF(*docs.columns)


KEY = ["_id", "_no_id", "_hash", "_source", "_no_source"]


def _keyed(rows: DataFrame, text_hash: Column) -> DataFrame:
    """``rows`` with doc_id, hash of the text and source as columns without nulls."""
    doc_id, source = F.col("doc_id").cast("long"), F.col("source").cast("string")
    parts = [F.coalesce(doc_id, F.lit(0)), doc_id.isNull(), text_hash, F.coalesce(source, F.lit("")), source.isNull()]
    return rows.withColumns(dict(zip(KEY, parts, strict=True)))

"""Exact cosine threshold pairs by dual traversal of cover trees.

Vectors are compared in double precision, only when labels are equal and not
null.  Vectors that are null, empty, zero or hold null or non-finite components
link with nothing; so do vectors of different lengths.

1. Equal vectors of a label form a class with a weight; copies are never paired.
2. Classes of a label are dealt to cells by the nearest of a few centres (chosen
   by hash from the label, about one per ``BLOCK`` rows and at most ``CENTRES`` in all),
   cells of more than ``BLOCK`` rows are split by hash.  For each part its centre
   and exact covering radius are known; parts of a label can hold pairs only if
   their distance minus both radii is within the threshold's.
3. A task gets two parts (or one), builds a cover tree over each - nested levels
   of centres, radii halving from level to level - and walks both together:
   a pair of nodes farther apart than both covering radii plus the threshold is
   pruned, one nearer than the threshold minus both radii is taken whole (weights
   are added and one edge per vector recorded, no pairs written), any other is
   split; leaves are compared vector by vector.

What leaves a task is a number of links per vector and at most one edge per
vector and node; connected components are found from the edges.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bagyard.llm.components import components
from bagyard.llm.frames import cut_lineage
from bagyard.llm.textbytes import mix

BLOCK = 1024
CENTRES = 4096
LEAF = 128
SLACK = 1e-9  # bounds are widened by this, so that rounding never prunes a pair


class CoverTree:
    """Nested levels of centres with halving radii over unit vectors (rows of ``x``)."""

    def __init__(self, x: np.ndarray):
        self.x = x
        self.centre, self.radius, self.children, self.points = [], [], [], []
        self.root = self._node(np.arange(len(x)), 2.0)

    def _node(self, points: np.ndarray, reach: float) -> int:
        c = int(points[0])
        d = np.sqrt(np.maximum(((self.x[points] - self.x[c]) ** 2).sum(axis=1), 0))
        me = len(self.centre)
        radius = float(d.max())
        self.centre.append(c)
        self.radius.append(radius)
        self.points.append(points)
        self.children.append([])
        if len(points) <= LEAF or radius <= SLACK:
            return me
        while reach >= radius:
            reach /= 2
        left = points
        while len(left):  # the next uncovered vector is a centre of the finer level; it covers all within its radius
            near = np.sqrt(np.maximum(((self.x[left] - self.x[left[0]]) ** 2).sum(axis=1), 0)) <= reach
            self.children[me].append(self._node(left[near], reach))
            left = left[~near]
        return me


def dual_links(a: CoverTree, b: CoverTree, wa: np.ndarray, wb: np.ndarray, least: float, same: bool) -> tuple[np.ndarray, np.ndarray, list[tuple[int, int]]]:
    """Weights of linked vectors per vector of ``a`` and of ``b``, and edges (i, j) that connect just what the links connect.

    With ``same`` both trees are one; a vector is not linked with itself and both sides are counted in the first result."""
    bound = np.sqrt(max(0.0, 2 - 2 * least))
    na, nb = np.zeros(len(wa)), np.zeros(len(wb))
    edges: set[tuple[int, int]] = set()
    stack = [(a.root, b.root)]
    while stack:
        p, q = stack.pop()
        if same and p == q:
            r, pts = a.radius[p], a.points[p]
            if 2 * r + SLACK < bound:
                na[pts] += wa[pts].sum() - wa[pts]
                edges.update((int(pts[0]), int(i)) for i in pts[1:])
            elif a.children[p]:
                kids = a.children[p]
                stack += [(kids[i], kids[j]) for i in range(len(kids)) for j in range(i, len(kids))]
            else:
                i, j = np.nonzero(np.triu(a.x[pts] @ a.x[pts].T >= least, 1))
                np.add.at(na, pts[i], wa[pts[j]])
                np.add.at(na, pts[j], wa[pts[i]])
                edges.update(zip(pts[i].tolist(), pts[j].tolist(), strict=True))
            continue
        ca, cb, ra, rb = a.x[a.centre[p]], b.x[b.centre[q]], a.radius[p], b.radius[q]
        d = float(np.sqrt(max(0.0, ((ca - cb) ** 2).sum())))
        if d - ra - rb - SLACK > bound:
            continue
        pa_, pb_ = a.points[p], b.points[q]
        if d + ra + rb + SLACK < bound:
            na[pa_] += wb[pb_].sum()
            (na if same else nb)[pb_] += wa[pa_].sum()
            edges.update((int(i), int(pb_[0])) for i in pa_)
            edges.update((int(pa_[0]), int(j)) for j in pb_[1:])
        elif not a.children[p] and not b.children[q] or len(pa_) * len(pb_) <= 4 * LEAF * LEAF:
            i, j = np.nonzero(a.x[pa_] @ b.x[pb_].T >= least)
            np.add.at(na, pa_[i], wb[pb_[j]])
            np.add.at(na if same else nb, pb_[j], wa[pa_[i]])
            edges.update(zip(pa_[i].tolist(), pb_[j].tolist(), strict=True))
        elif a.children[p] and (ra >= rb or not b.children[q]):
            stack += [(k, q) for k in a.children[p]]
        else:
            stack += [(p, k) for k in b.children[q]]
    return na, nb, sorted(edges)


def _units(values: list) -> np.ndarray:
    x = np.stack([np.asarray(v, np.float64) for v in values])
    return x / np.sqrt((x * x).sum(axis=1))[:, None]


def _forest(edges: list[tuple[int, int]], n: int) -> list[tuple[int, int]]:
    """A spanning forest of the edges."""
    up = list(range(n))

    def find(i: int) -> int:
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    kept = []
    for i, j in edges:
        a, b = find(i), find(j)
        if a != b:
            up[max(a, b)] = min(a, b)
            kept.append((i, j))
    return kept


def near_vectors(vectors: DataFrame, least: float = 0.93, block: int = BLOCK, most_centres: int = CENTRES) -> DataFrame:
    """(vec_id, label, n_links, component_id, kept) of every row of (vec_id, embedding, label).

    Rows that repeat an id are vectors of their own; a null id names no component (null) and is kept if it has none."""
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("x"), "label")
    sound = F.col("x").isNotNull() & (F.size("x") > 0) & F.col("label").isNotNull()
    sound = sound & F.coalesce(F.forall("x", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf"))), F.lit(False)) & F.exists("x", lambda v: v != 0)
    whole = F.aggregate("x", F.lit(0.0), lambda s, v: s + v * v)
    rows = rows.withColumn("cls", F.when(F.coalesce(sound, F.lit(False)) & (whole > 0) & (whole < float("inf")), F.xxhash64("label", F.transform("x", lambda v: v + 0.0))))
    rows = cut_lineage(rows, "vectors")
    classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(F.first("label").alias("label"), F.first("x").alias("x"), F.count(F.lit(1)).alias("weight"), F.min("vec_id").alias("rep"))
    classes = cut_lineage(classes, "classes")

    sizes = classes.groupBy("label").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > block)
    heavy = sizes.agg(F.sum("n").alias("n")).first()["n"] or 0
    share = min(1.0 / block, most_centres / max(1, heavy))  # of the heavy labels' classes, so the centres are bounded
    chosen = classes.join(sizes.select("label"), "label", "left_semi").where(F.pmod(F.xxhash64(F.lit(2), "cls"), F.lit(1 << 30)) < int(share * (1 << 30))).select("label", "x").limit(2 * most_centres).collect()
    picked: dict[tuple, list] = {}
    for r in chosen:
        picked.setdefault((r["label"], len(r["x"])), []).append(r["x"])
    shared = spark.sparkContext.broadcast({k: _units(v) for k, v in picked.items()})

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        centres = shared.value
        for batch in batches:
            label, values = batch.column("label").to_pylist(), batch.column("x").to_pylist()
            cell = np.zeros(len(batch), np.int32)
            kinds: dict[tuple, list[int]] = {}
            for i, (k, v) in enumerate(zip(label, values, strict=True)):
                kinds.setdefault((k, len(v)), []).append(i)
            for kind, at in kinds.items():
                if kind in centres:
                    cell[at] = (_units([values[i] for i in at]) @ centres[kind].T).argmax(axis=1)
            yield pa.RecordBatch.from_arrays([batch.column("cls"), batch.column("label"), batch.column("x"), batch.column("weight"), pa.array(cell)], ["cls", "label", "x", "weight", "cell"])

    label_type = classes.schema["label"].dataType.simpleString()
    placed = cut_lineage(classes.select("cls", "label", "x", "weight").mapInArrow(deal, f"cls long, label {label_type}, x array<double>, weight long, cell int"), "cells")
    counts = placed.groupBy("label", F.size("x").alias("dim"), "cell").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("chunks"))
    placed = placed.withColumn("dim", F.size("x")).join(counts, ["label", "dim", "cell"]).withColumn("part", F.xxhash64("label", "dim", "cell", F.pmod(F.xxhash64("cls"), F.col("chunks"))))

    def cover(frame: pd.DataFrame) -> pd.DataFrame:
        x = _units(list(frame["x"]))
        mean = x.mean(axis=0)
        centre = x[int(((x - mean) ** 2).sum(axis=1).argmin())]
        radius = float(np.sqrt(((x - centre) ** 2).sum(axis=1).max()))
        return pd.DataFrame({"part": [frame["part"].iloc[0]], "label": [frame["label"].iloc[0]], "dim": [len(centre)], "centre": [centre], "radius": [radius]})

    covers = cut_lineage(placed.select("part", "label", "x").groupBy("part").applyInPandas(cover, f"part long, label {label_type}, dim int, centre array<double>, radius double"), "covers")
    right = covers.select("label", "dim", F.col("part").alias("q"), F.col("centre").alias("qc"), F.col("radius").alias("qr"))
    distance = F.sqrt(F.aggregate(F.zip_with("centre", "qc", lambda u, v: (u - v) * (u - v)), F.lit(0.0), lambda s, v: s + v))
    bound = float(np.sqrt(max(0.0, 2 - 2 * least))) + SLACK
    meets = covers.select("label", "dim", F.col("part").alias("p"), "centre", "radius").join(right, ["label", "dim"]).where("p <= q").where(distance - F.col("radius") - F.col("qr") <= bound).select("p", "q")
    meets = cut_lineage(meets, "meets")
    sides = meets.select("p", "q", F.col("p").alias("part")).union(meets.where("p <> q").select("p", "q", F.col("q").alias("part")))

    def walk(frame: pd.DataFrame) -> pd.DataFrame:
        p, q = frame["p"].iloc[0], frame["q"].iloc[0]
        frame = frame.sort_values("cls", ignore_index=True)
        halves = [frame[frame["part"] == k] for k in ((p,) if p == q else (p, q))]
        trees = [CoverTree(_units(list(h["x"]))) for h in halves]
        weights = [h["weight"].to_numpy(np.float64) for h in halves]
        ids = [h["cls"].to_numpy() for h in halves]
        na, nb, edges = dual_links(trees[0], trees[-1], weights[0], weights[-1], least, p == q)
        if p == q:
            kept = _forest(edges, len(na))
            a, b = [ids[0][i] for i, _ in kept], [ids[0][j] for _, j in kept]
            cls, n = ids[0], na
        else:
            kept = _forest([(i, len(na) + j) for i, j in edges], len(na) + len(nb))
            a, b = [ids[0][i] for i, _ in kept], [ids[1][j - len(na)] for _, j in kept]
            cls, n = np.concatenate(ids), np.concatenate([na, nb])
        linked = n > 0
        cls, n = cls[linked], n[linked].astype(np.int64)
        none = [None] * len(a)
        return pd.DataFrame({"cls": pd.array([*cls.tolist(), *none], "Int64"), "n": pd.array([*n.tolist(), *none], "Int64"), "a": pd.array([*[None] * len(cls), *a], "Int64"), "b": pd.array([*[None] * len(cls), *b], "Int64")})

    found = placed.select("part", "cls", "x", "weight").join(sides, "part").groupBy("p", "q").applyInPandas(walk, "cls long, n long, a long, b long")
    found = cut_lineage(found, "walked")
    links = found.where("cls IS NOT NULL").groupBy("cls").agg(F.sum("n").alias("n"))
    groups = components(found.where("a IS NOT NULL").select("a", "b"))
    named = classes.select("cls", "weight", "rep").join(groups.withColumnRenamed("node", "cls"), "cls", "left").withColumn("component", F.coalesce("component", "cls"))
    named = cut_lineage(named, "named")
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = named.join(smallest, "component").join(links, "cls", "left").select("cls", "component_id", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    out = rows.select("vec_id", "label", "cls").join(of_class, "cls", "left")
    own = F.when(F.col("cls").isNull(), F.col("vec_id")).otherwise(F.col("component_id"))
    out = out.select("vec_id", "label", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), own.alias("component_id"))
    return out.withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))

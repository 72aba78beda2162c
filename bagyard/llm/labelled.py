"""Bounded samples of labelled documents for fitting the classifiers.

A fold is told by crc32 of the decimal document id.  Labels of repeated rows are
taken together (1 if any row says 1); null ids and null labels are left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """True for rows that no model may learn from; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % folds == fold


def training_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, fold: int, most: int, most_bytes: int, seed: int = 7) -> tuple[DataFrame, dict[int, float]]:
    """At most ``most`` rows of each class as (_id, label, text), and per class how many rows each stands for.

    The labelled ids outside the fold with the smallest seeded hashes are taken, whatever their
    number; of an id that several rows have, the row with the smallest text hash.  Both cuts are
    made in the map tasks first.  Texts over ``most_bytes`` are not taken.  The bounds hold for
    fitting only: scores are made of whole texts of all rows."""
    known = labels.where(F.col("doc_id").isNotNull() & F.col(label).isNotNull() & ~held_out(F.col("doc_id"), folds, fold))
    known = known.groupBy(F.col("doc_id").cast("long").alias("_id")).agg(F.max(F.col(label).cast("int")).alias("label")).where("label IN (0, 1)")
    counts = {int(r["label"]): int(r["n"]) for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}  # two rows
    place = F.pmod(F.xxhash64(F.lit(seed), F.col("_id")), F.lit(1 << 40))
    near = F.lit(False)  # about twice as many as are taken go on, however many there are
    for k, n in counts.items():
        near = near | ((F.col("label") == k) & (place < int(min(1.0, 2.0 * most / n) * (1 << 40))))
    order = W.partitionBy("label").orderBy(place, "_id")
    chosen = F.broadcast(known.where(near).withColumn("_nth", F.row_number().over(order)).where(F.col("_nth") <= most).drop("_nth"))  # 2 * most rows at most
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("_id"), text.alias("text")).where(F.octet_length("text") <= most_bytes).join(chosen, "_id")
    one = F.row_number().over(W.partitionBy("_id").orderBy(F.xxhash64("text"), "text"))
    rows = rows.withColumn("_nth", one).where("_nth = 1")
    return rows.select("_id", "label", "text"), {k: max(1.0, n / most) for k, n in counts.items()}

"""MinHash near-duplicates by a multi-index Hamming join, links confirmed on full sets.

1. Every row's shingle set gets ``SYMBOLS`` minhashes of 16 bits.  Rows with equal
   sets form a class; only classes are joined, so copies are never paired.
2. The signature is cut into ``CHUNKS`` chunks.  Two signatures that differ in at
   most ``MOST_ERRORS`` = 2 * CHUNKS - 1 symbols have, by pigeonhole, a chunk with
   at most one differing symbol; every chunk is indexed once per symbol left out,
   so all pairs under the distance share a key.  At the similarity 0.75 more errors
   are about as likely as 1 in 100,000, above it far less.
3. First every class is compared with the one class (the smallest of a key) that
   it shares most keys with, then ``NEAREST_ROUNDS`` times with the class of
   smallest signature distance in another component, sought in its small keys and
   its ``NEAREST_KEYS`` largest ones.  That joins large groups of near copies by a
   few comparisons per class.  At last all pairs of a key that are
   still in different components and within the signature distance are compared.
   Keys of more than ``SMALL_KEY`` classes are searched in blocks of ``BLOCK``, those of
   the key's largest component only against the others'.  A link needs
   100 * intersection >= 75 * union of the full sets.

A class also has a parity sketch: bit i tells whether an odd number of its members
falls into bucket i.  Each bit in which two sketches differ stands for at least one
member that only one of the sets has, so a pair whose sketches differ in more bits
than a link's sets may differ in members is no link for certain, and is left out.

Sets are made again from the text for the classes that have candidates; a Bloom
filter of fixed size keeps the others out at the scan.

Null texts and texts without words have an empty set and link with nothing.
Rows that repeat an id are rows of their own.  A row with a null id takes part and
links others like any row; a component is named by the smallest id that is not null,
without one it is null and its rows are kept.  Classes are told apart by 64-bit hashes of the set.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from bagyard.llm import textbytes as B
from bagyard.llm.components import components
from bagyard.llm.frames import apart, bloom, cut_lineage, in_bloom, one_row_each, written
from bagyard.llm.shingles import shingle_sets

SYMBOLS, CHUNKS = 64, 16
WIDTH = SYMBOLS // CHUNKS
MOST_ERRORS = 2 * CHUNKS - 1
BLOCK = 1024
CELL_BYTES = 16 << 20
NEAREST_ROUNDS = 2
NEAREST_KEYS = 2
SKETCH_BITS = (8, 15)  # a sketch has 2^8 to 2^15 bits, at least four for each member up to the upper end
SMALL_KEY = 16  # keys of at most so many classes are paired by a plain join
_RNG = np.random.Generator(np.random.PCG64(6))
_A = _RNG.integers(1, 1 << 63, SYMBOLS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_B = _RNG.integers(0, 1 << 63, SYMBOLS, dtype=np.uint64)


def signatures(members: np.ndarray, first: np.ndarray) -> np.ndarray:
    """A row of ``SYMBOLS`` 16-bit minhashes per text with members."""
    at = first[:-1]
    out = np.empty((len(at), SYMBOLS), dtype=np.uint16)
    for i in range(SYMBOLS):
        low = np.minimum.reduceat(members * _A[i] + _B[i], at)
        out[:, i] = B.mix(low) & np.uint64(0xFFFF)
    return out


def parity_sketch(members: np.ndarray) -> bytes:
    """Parities of the numbers of members per bucket, a power of two of buckets that grows with the set."""
    low, high = SKETCH_BITS
    bits = min(max(low, (4 * len(members) - 1).bit_length()), high)
    at = (members & np.uint64((1 << bits) - 1)).astype(np.int64)
    return np.packbits((np.bincount(at, minlength=1 << bits) & 1).astype(np.uint8), bitorder="little").tobytes()


def may_link(a: np.ndarray, b: np.ndarray, left: list[bytes], right: list[bytes], n_left: np.ndarray, n_right: np.ndarray, percent: int) -> np.ndarray:
    """False for the pairs (left[a], right[b]) that sizes or sketches prove to be no link.

    The sets of a link of ``n`` members together differ in at most n * (100 - percent) / (100 + percent)."""
    size_a, size_b = n_left[a].astype(np.int64), n_right[b].astype(np.int64)
    able = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    words_left, words_right = (np.array([len(s) // 8 for s in side], np.int64) for side in (left, right))
    words = np.minimum(words_left[a], words_right[b])

    def folded(sketches: list[bytes], sizes: np.ndarray, to: int) -> tuple[np.ndarray, np.ndarray]:
        # halves of a sketch laid over each other give the sketch of half the buckets
        place, held = np.full(len(sketches), -1, np.int64), []
        for i in np.flatnonzero(sizes >= to):
            place[i] = len(held)
            held.append(np.bitwise_xor.reduce(np.frombuffer(sketches[i], np.uint64).reshape(-1, to), axis=0))
        return place, np.array(held, np.uint64).reshape(-1, to)

    for to in np.unique(words[able]).tolist():
        (place_a, x), (place_b, y) = folded(left, words_left, to), folded(right, words_right, to)
        these = np.flatnonzero(able & (words == to))
        step = max(1, (4 << 20) // (8 * to))
        for p in range(0, len(these), step):
            part = these[p : p + step]
            differ = np.bitwise_count(x[place_a[a[part]]] ^ y[place_b[b[part]]]).sum(axis=1, dtype=np.int64)
            able[part] = (100 + percent) * differ <= (100 - percent) * (size_a[part] + size_b[part])
    return able


def class_hashes(members: np.ndarray, first: np.ndarray, full: np.ndarray) -> np.ndarray:
    """64-bit hash of each non-empty set (``full``: the texts that have one)."""
    size = np.diff(first)[full]
    return B.mix(np.add.reduceat(B.mix(members), first[full]) + B.mix(size.astype(np.uint64))).view(np.int64)


def describe(docs: DataFrame, k: int = 5) -> DataFrame:
    """(doc_id, text_hash, n_shingles, cls, sig, sketch) per row; the last three are null for empty sets."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            data, offsets = B.text_bytes(batch.column("text"))
            for lo, hi, part, offs in B.slices(data, offsets):
                members, first = shingle_sets(part, offs, k)
                size = np.diff(first)
                full = np.flatnonzero(size)
                cls: list[int | None] = [None] * (hi - lo)
                sig: list[bytes | None] = [None] * (hi - lo)
                sketch: list[bytes | None] = [None] * (hi - lo)
                if len(full):
                    starts = first[full]
                    found = signatures(members, np.append(starts, len(members)))
                    total = class_hashes(members, first, full)
                    for i, c, s in zip(full.tolist(), total.tolist(), found, strict=True):
                        cls[i], sig[i], sketch[i] = c, s.tobytes(), parity_sketch(members[first[i] : first[i + 1]])
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(lo, hi - lo), batch.column("text_hash").slice(lo, hi - lo), pa.array(size, pa.int64()), pa.array(cls, pa.int64()), pa.array(sig, pa.binary()), pa.array(sketch, pa.binary())], ["doc_id", "text_hash", "n_shingles", "cls", "sig", "sketch"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, "doc_id long, text_hash long, n_shingles long, cls long, sig binary, sketch binary")


def index_keys(classes: DataFrame) -> DataFrame:
    """(key, slot, cls): every chunk of every signature with each of its symbols left out; slot = symbol * CHUNKS + chunk."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n = len(batch)
            sig = np.frombuffer(b"".join(batch.column("sig").to_pylist()), np.uint16).reshape(n, CHUNKS, WIDTH).astype(np.uint64)
            keys = []
            for out in range(WIDTH):
                rest = [j for j in range(WIDTH) if j != out]
                packed = sig[:, :, rest[0]]
                for j in rest[1:]:
                    packed = packed << np.uint64(16) | sig[:, :, j]
                label = np.arange(CHUNKS, dtype=np.uint64) * np.uint64(WIDTH) + np.uint64(out)
                keys.append(B.mix(packed + label[None, :] * np.uint64(0x9E3779B97F4A7C15)))
            flat = np.concatenate(keys, axis=1).ravel().view(np.int64)
            slot = np.tile(np.arange(CHUNKS * WIDTH, dtype=np.int8), n)
            yield pa.RecordBatch.from_arrays([pa.array(flat), pa.array(slot), pa.array(np.repeat(batch.column("cls").to_numpy(), CHUNKS * WIDTH))], ["key", "slot", "cls"])

    return classes.select("cls", "sig").mapInArrow(run, "key long, slot byte, cls long")


def rep_key(doc_id: Column, text_hash: Column) -> Column:
    """One long for a row, null ids included: tells the representative's row at the scan."""
    return F.xxhash64(doc_id, text_hash)


def full_sets(docs: DataFrame, wanted: DataFrame, k: int = 5) -> DataFrame:
    """(cls, members) of the classes of ``wanted`` (cls, rep_key), made from the text of their representative; members are sorted 64-bit hashes."""
    shared = bloom(wanted, "rep_key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = shared.value
        for batch in batches:
            keep = in_bloom(bits, batch.column("rep_key").to_numpy())
            chosen = batch.filter(pa.array(keep))
            data, offsets = B.text_bytes(chosen.column("text"))
            for lo, hi, part, offs in B.slices(data, offsets):
                members, first = shingle_sets(part, offs, k)
                full = np.flatnonzero(np.diff(first))
                if len(full):
                    sets = [members[first[i] : first[i + 1]].tobytes() for i in full]
                    yield pa.RecordBatch.from_arrays([pa.array(class_hashes(members, first, full)), pa.array(sets, pa.binary())], ["cls", "members"])

    key = rep_key(F.col("doc_id").cast("long"), F.xxhash64("text"))
    rows = docs.select(key.alias("rep_key"), "text").mapInArrow(run, "cls long, members binary")
    return rows.join(wanted.select("cls"), "cls").groupBy("cls").agg(F.first("members").alias("members"))


def confirmed(docs: DataFrame, pairs: DataFrame, classes: DataFrame, percent: int = 75) -> DataFrame:
    """Those of ``pairs`` (a, b; classes) whose full sets are alike enough.

    Pairs are dealt to the cells of a square grid by the hashes of a and b, each set goes once to every cell that
    needs it: among classes with many pairs to each other a set travels at most as often as the grid has rows.
    The grid grows with the sets, so that a cell holds about ``CELL_BYTES``."""
    pairs = cut_lineage(pairs, "pairs")
    if pairs.isEmpty():
        return pairs
    wanted = cut_lineage(pairs.select(F.explode(F.array("a", "b")).alias("cls")).distinct().join(classes, "cls").select("cls", "rep_key", "n_shingles"), "wanted")
    size = 8 * (wanted.agg(F.sum("n_shingles").alias("n")).first()["n"] or 0)
    side = max(4, -(-2 * size // CELL_BYTES))
    place = lambda c, seed: F.pmod(F.xxhash64(F.lit(seed), c), F.lit(side))
    cells = pairs.withColumn("cell", place("a", 1) * side + place("b", 2))
    needs = cells.select((F.col("cell") + 0).alias("place"), F.explode(F.array("a", "b")).alias("cls")).distinct()
    sets = needs.join(full_sets(docs, wanted.select("cls", "rep_key")), "cls")

    def compare(found: pd.DataFrame, held: pd.DataFrame) -> pd.DataFrame:
        by = {c: np.frombuffer(m, np.uint64) for c, m in zip(held["cls"], held["members"], strict=True)}
        keep = []
        for a, b in zip(found["a"], found["b"], strict=True):
            x, y = by[a], by[b]
            n = len(x) + len(y)
            if 100 * min(len(x), len(y)) >= percent * max(len(x), len(y)):
                both = np.concatenate((x, y))
                both.sort()
                shared = int((both[1:] == both[:-1]).sum())
                if 100 * shared >= percent * (n - shared):
                    keep.append((a, b))
        return pd.DataFrame(keep, columns=["a", "b"], dtype="int64")

    sets = sets.select("place", "cls", "members")
    return cells.groupBy("cell").cogroup(sets.groupBy("place")).applyInPandas(compare, "a long, b long")


def _errors(left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Symbols in which signatures (rows) of two blocks differ."""
    errors = np.zeros((len(left), len(right)), np.uint8)
    for i in range(SYMBOLS):
        errors += left[:, i][:, None] != right[:, i][None, :]
    return errors


def _first_slot(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first slot that each pair of signatures (rows) shares."""
    same = (a == b).reshape(-1, CHUNKS, WIDTH)
    errors = WIDTH - same.sum(axis=2)
    shares = (errors == 0)[:, None, :] | ((errors == 1)[:, None, :] & ~same.transpose(0, 2, 1))
    return shares.reshape(len(a), -1).argmax(axis=1)


def meetings(many: DataFrame, facts: DataFrame) -> DataFrame:
    """``many`` (key, cls, component, ...) with the ``facts`` of its classes (cls, ...), with block, and lo and hi of every pair of blocks that the class takes part in.

    Only classes of different components need to meet.  Blocks without the key's largest component come first and
    meet all blocks; the largest one's meet them only, so that it is not paired with itself.  Keys of one component go."""
    sizes = many.groupBy("key", "component").agg(F.count(F.lit(1)).alias("held"))
    sizes = sizes.groupBy("key").agg(F.sum("held").alias("n"), F.max(F.struct("held", "component")).alias("main")).where("n > main.held")
    many = many.join(sizes, "key").join(facts, "cls")
    count = lambda n: F.ceil(n / F.lit(BLOCK)).cast("int")
    whole, of_main = F.col("n") <= BLOCK, F.col("component") == F.col("main.component")
    rests, mains = count(F.col("n") - F.col("main.held")), count(F.col("main.held"))
    deal = lambda blocks: F.pmod(F.xxhash64("cls", "key"), blocks).cast("int")
    block = F.when(whole, F.lit(0)).when(of_main, rests + deal(mains)).otherwise(deal(rests))
    last = F.when(whole, F.lit(0)).when(of_main, rests - 1).otherwise(rests + mains - 1)
    many = many.withColumns({"block": block, "last": last})
    meets = F.transform(F.sequence(F.lit(0), F.col("last")), lambda i: F.struct(F.least(i, F.col("block")).alias("lo"), F.greatest(i, F.col("block")).alias("hi")))
    return many.withColumn("meet", F.explode(meets)).withColumns({"lo": F.col("meet.lo"), "hi": F.col("meet.hi")}).drop("meet", "last", "n", "main")


def later_pairs(members: DataFrame, classes: DataFrame, nearest: bool, percent: int = 75) -> DataFrame:
    """Pairs (a, b) that share a key, lie in different components, are within the signature distance and not proven to be no link
    by their sketches; with ``nearest`` one for each class.

    members: (key, slot, cls, component, n), n being the classes of the key.  A pair of a large key
    is reported for the first slot that it shares, so that sharing many keys does not multiply it."""
    few = members.where(F.col("n") <= SMALL_KEY).select("key", "cls", "component")
    other = few.select("key", F.col("cls").alias("b"), F.col("component").alias("bc"))
    pairs = few.select("key", F.col("cls").alias("a"), F.col("component").alias("ac")).join(other, "key").where("a < b AND ac <> bc").select("a", "b").distinct()
    sig = classes.select("cls", "sig", "sketch", F.col("n_shingles").alias("size"))
    of_a, of_b = (sig.withColumnsRenamed({"cls": c, "sig": f"{c}_sig", "sketch": f"{c}_sketch", "size": f"{c}_size"}) for c in "ab")
    pairs = pairs.join(of_a, "a").join(of_b, "b")

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint16).reshape(-1, SYMBOLS) for c in ("a_sig", "b_sig"))
            errors = (a != b).sum(axis=1).astype(np.int32)
            found = pa.RecordBatch.from_arrays([batch.column("a"), batch.column("b"), pa.array(errors)], ["a", "b", "errors"])
            close = np.flatnonzero(errors <= MOST_ERRORS)
            left, right = (batch.column(c).take(pa.array(close)).to_pylist() for c in ("a_sketch", "b_sketch"))
            sizes = (batch.column(c).to_numpy()[close] for c in ("a_size", "b_size"))
            at = np.arange(len(close))
            yield found.take(pa.array(close[may_link(at, at, left, right, *sizes, percent)]))

    columns = ["a", "b", "a_sig", "b_sig", "a_sketch", "b_sketch", "a_size", "b_size"]
    pairs = pairs.select(*columns).mapInArrow(near, "a long, b long, errors int")

    many = members.where(F.col("n") > SMALL_KEY)
    if nearest:  # the last round looks through all keys
        largest = W.partitionBy("cls").orderBy(F.desc("n"), "key", "slot")
        many = many.withColumn("nth", F.row_number().over(largest)).where(F.col("nth") <= NEAREST_KEYS).drop("n", "nth")
    many = meetings(many.drop("n"), sig)

    def meet(frame: pd.DataFrame) -> pd.DataFrame:
        sig = np.frombuffer(b"".join(frame["sig"]), np.uint16).reshape(-1, SYMBOLS)
        block, comp, cls = (frame[c].to_numpy() for c in ("block", "component", "cls"))
        left, right = (np.flatnonzero(block == frame[c].iloc[0]) for c in ("lo", "hi"))
        if not len(left) or not len(right):
            return pd.DataFrame({"a": [], "b": [], "errors": []}).astype("int64")
        errors = _errors(sig[left], sig[right])
        errors[comp[left][:, None] == comp[right][None, :]] = SYMBOLS + 1
        sketch, size = frame["sketch"].to_numpy(), frame["size"].to_numpy()
        i, j = np.nonzero(errors <= MOST_ERRORS)
        able = may_link(i, j, list(sketch[left]), list(sketch[right]), size[left], size[right], percent)
        errors[i[~able], j[~able]] = SYMBOLS + 1
        if nearest:
            i = np.concatenate([np.arange(len(left)), errors.argmin(axis=0)])
            j = np.concatenate([errors.argmin(axis=1), np.arange(len(right))])
            near = errors[i, j] <= MOST_ERRORS
            i, j = i[near], j[near]
        else:
            i, j = np.nonzero(errors <= MOST_ERRORS)
            parts = range(0, len(i), 65536)
            own = [np.flatnonzero(_first_slot(sig[left[i[p : p + 65536]]], sig[right[j[p : p + 65536]]]) == frame["slot"].iloc[0]) + p for p in parts]
            own = np.concatenate(own) if own else np.zeros(0, np.int64)
            i, j = i[own], j[own]
        a, b = cls[left[i]], cls[right[j]]
        return pd.DataFrame({"a": np.minimum(a, b), "b": np.maximum(a, b), "errors": errors[i, j].astype(np.int32)}).drop_duplicates()

    found = pairs.union(many.groupBy("key", "lo", "hi").applyInPandas(meet, "a long, b long, errors int"))
    if not nearest:
        return found.select("a", "b").distinct()
    # a union of both directions would compare all blocks twice
    both = found.select("errors", F.inline(F.array(F.struct("a", "b"), F.struct(F.col("b").alias("a"), F.col("a").alias("b")))))
    best = both.groupBy("a").agg(F.min(F.struct("errors", "b")).alias("best"))
    return best.select(F.least("a", "best.b").alias("a"), F.greatest("a", "best.b").alias("b")).distinct()


def grouped(docs: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component, component_id) of every row; ``component`` is a number of its own, null for empty sets."""
    rows = cut_lineage(describe(docs), "signatures")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")).alias("first")
    classes = rows.where("cls IS NOT NULL").groupBy("cls").agg(first, F.max("n_shingles").alias("n_shingles"), F.first("sig").alias("sig"), F.first("sketch").alias("sketch"))
    key = rep_key(F.col("first.doc_id"), F.col("first.text_hash"))
    classes = cut_lineage(classes.select("cls", F.col("first.doc_id").alias("rep"), key.alias("rep_key"), "n_shingles", "sig", "sketch"), "classes")
    keys = index_keys(classes)
    heads = keys.groupBy("key").agg(F.min("cls").alias("hub"), F.count(F.lit(1)).alias("n")).where("n > 1")
    members = cut_lineage(keys.join(heads, "key"), "members")
    stars = members.where("cls <> hub").groupBy("cls", "hub").agg(F.count(F.lit(1)).alias("shared"))
    stars = stars.groupBy("cls").agg(F.max(F.struct("shared", "hub")).alias("best")).select(F.col("cls").alias("a"), F.col("best.hub").alias("b"))
    links = cut_lineage(confirmed(docs, stars, classes, percent), "links")
    groups = cut_lineage(components(links), "groups")
    rounds = [True] * NEAREST_ROUNDS + [False]
    while rounds:
        nearest = rounds.pop(0)
        placed = members.join(groups.withColumnRenamed("node", "cls"), "cls", "left").select("key", "slot", "cls", F.coalesce("component", "cls").alias("component"))
        mixed = placed.groupBy("key").agg(F.min("component").alias("c0"), F.max("component").alias("c1"), F.count(F.lit(1)).alias("n")).where("c0 <> c1").select("key", "n")
        mixed = cut_lineage(mixed, "mixed")
        if mixed.isEmpty():  # no key has classes of two components: no later round can find a pair
            break
        with written(placed.join(mixed, "key"), "placed") as met:  # read five times: as a plan, each would be joined again
            more = cut_lineage(confirmed(docs, later_pairs(met, classes, nearest, percent), classes, percent), "more")
        if not more.isEmpty():
            links = cut_lineage(links.union(more), "links")
            groups = cut_lineage(components(links), "groups")
        elif nearest:  # another such round would seek among the same classes
            rounds = [False]
    named = classes.join(groups.withColumnRenamed("node", "cls"), "cls", "left").select("cls", "rep", F.coalesce("component", "cls").alias("component"))
    named = cut_lineage(named, "named")
    smallest = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    of_class = named.join(smallest, "component").select("cls", "component", "component_id")
    out = rows.select("doc_id", "text_hash", "n_shingles", "cls").join(of_class, "cls", "left")
    out = out.withColumn("component_id", F.when(F.col("cls").isNull(), F.col("doc_id")).otherwise(F.col("component_id")))
    return out.select("doc_id", "text_hash", "n_shingles", "component", "component_id")


def near_duplicates(docs: DataFrame, percent: int = 75) -> DataFrame:
    """(doc_id, text_hash, n_shingles, component_id, kept) of every row; text_hash is xxhash64 of the text."""
    out = grouped(docs, percent)
    return out.select("doc_id", "text_hash", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


def one_of_each(docs: DataFrame, percent: int = 75) -> DataFrame:
    """``docs`` with one row of each component, and all rows without words.

    The row of the smallest id stays (a null id comes last), of rows that repeat it
    the one with the smallest text hash, of equal texts the first by its other columns."""
    mine = apart(docs, ("doc_id", "text"))
    found = grouped(mine, percent).where("component IS NOT NULL").groupBy("doc_id", "text_hash", "component").agg(F.count(F.lit(1)).alias("n"))
    found = cut_lineage(found.withColumn("place", F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "text_hash")), "places")
    best = found.groupBy("component").agg(F.min("place").alias("best"))
    told = found.join(best, "component").withColumn("stays", F.col("place") == F.col("best"))
    told = cut_lineage(told.where("n > 1 OR NOT stays").select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_h"), "stays"), "dropped")
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (F.xxhash64("text") == F.col("_h"))
    repeats = one_row_each(mine.join(told.where("stays"), same, "left_semi"), F.col("doc_id"), F.xxhash64("text"))
    return mine.join(told, same, "left_anti").unionByName(repeats).toDF(*docs.columns)

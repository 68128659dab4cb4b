"""Exact self-join of documents on the Jaccard similarity of their word shingles.

Result: one row per document with its class, the documents reachable by links.  Links are pairs
of documents whose sets of ``size``-word shingles have 100 * intersection >= threshold * union.

Method, set-relation skipping:

* Shingles are counted over the whole corpus (``counting``) and every set is ordered by that
  count, rare ones first.  A set of n shingles can only link with one that shares a shingle among
  its first ``n - need(n) + 1`` (``need(n)`` = least overlap any link of it has), so only these
  are indexed.  A document of which fewer than ``need(n)`` shingles occur elsewhere has no links.
* Documents with equal sets are one entry of the index, whatever their number.
* Lists of the index are cut into blocks by set size and skipped by position.  A pair is met in the list of
  the first shingle that both sets have, in the order of counts; there an entry at position p and a partner at
  position q can overlap in at most ``min(n - p, m - q)`` shingles, and their sizes must lie within the threshold of each
  other.  Pairs and whole blocks beyond that are never made.
* Answers are derived from those of a similar set.  One set of every block of a list (the leader, another in each
  round) is compared with the rest; sets linked to it take its class, and so the answers
  of all the class: nothing inside a class is compared any more.  After ``ROUNDS`` rounds, and in lists that
  still hold several classes, entries of different classes are compared by parity bitmaps: every shingle flips
  one bit of its set's bitmap, so two bitmaps differ in no more bits than the sets in shingles, and a pair
  whose bitmaps differ in more than a link allows is none.  What is left is compared whole.

So the copies and near copies of a text are never paired with each other, and every link that
joins two classes is found.  A list that many sets share is dealt into slices of ``SLICE`` entries.
Shingles are known by 64 bits of a hash.

Defined results: null, empty and blank texts have an empty set and are their own class; texts
shorter than a shingle have one shingle, the whole text; equal rows are linked; rows without id
belong to a class but do not name it; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.components import connected_components
from sessionloom.llm.counting import counted, parcels, with_counts
from sessionloom.llm.shipping import bound_batches, give_back
from sessionloom.llm.words import BASES, chunks, free_name, hash_words, mixed, texts_of, window_hashes
from sessionloom.workspace import materialize

#: The counts only order the index, so a block needs fewer bytes of each shingle.
WIDTH = 5
BLOCK_GROWTH = 1.08
#: Rounds in which leaders are compared.
ROUNDS = 2
#: 64-bit words of a parity bitmap.
BITMAP_WORDS = 16
#: Entries of a list that meet the whole list in one group.
SLICE = 4096


def shingle_sets(bodies: list[bytes], size: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of every text, A-Z taken as a-z."""
    return [values for chunk in chunks(bodies) for values in _shingle_sets(chunk, size)]


def _shingle_sets(bodies: list[bytes], size: int) -> list[np.ndarray]:
    rows = [body.lower().split() for body in bodies]
    hashed = hash_words([w for row in rows for w in row])
    windows = mixed(window_hashes(hashed, size))
    out, at = [], 0
    for row in rows:
        n = len(row)
        if n >= size:
            out.append(np.unique(windows[at : at + n - size + 1]))
        elif n:
            out.append(mixed(window_hashes(hashed[at : at + n], n, BASES[1]) + np.uint64(n)))
        else:
            out.append(np.empty(0, np.uint64))
        at += n
    return out


def _need(n: Column, threshold: int) -> Column:
    """Least overlap that a link of a set of n shingles has."""
    return F.ceil(n * F.lit(threshold) / F.lit(100)).cast("int")


def _overlaps(left: pa.Array, right: pa.Array) -> list[int]:
    return [
        len(np.intersect1d(np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64), assume_unique=True))
        for a, b in zip(left.to_pylist(), right.to_pylist(), strict=True)
    ]


def _similar(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """(a, b, n, m, overlap) of each pair, from the whole sets."""
    left = sets.select(F.col("set").alias("a"), F.col("n"), F.col("shared").alias("of_a"))
    right = sets.select(F.col("set").alias("b"), F.col("n").alias("m"), F.col("shared").alias("of_b"))

    def compare(batches):
        for batch in batches:
            yield pa.RecordBatch.from_pydict(
                {
                    "a": batch["a"],
                    "b": batch["b"],
                    "n": batch["n"],
                    "m": batch["m"],
                    "overlap": pa.array(_overlaps(batch["of_a"], batch["of_b"]), pa.int32()),
                }
            )
        give_back()

    return (
        pairs.select("a", "b")
        .join(left, "a")
        .join(right, "b")
        .mapInArrow(compare, "a long, b long, n int, m int, overlap int")
    )


def _block(n: Column) -> Column:
    return F.floor(F.log(n.cast("double")) / F.log(F.lit(BLOCK_GROWTH))).cast("int")


def _possible(threshold: int) -> Column:
    """Whether entries x and y of one list can be linked, by size and position."""
    n, m = F.col("x.n"), F.col("y.n")
    room = F.least(n - F.col("x.position"), m - F.col("y.position"))
    # In the list of the first shared shingle nothing before it is shared.
    return (m * 100 >= n * threshold) & (n * 100 >= m * threshold) & (room * (100 + threshold) >= (n + m) * threshold)


def _bitmap(values: np.ndarray) -> np.ndarray:
    """One bit for each residue: whether an odd number of values has it."""
    odd = np.bincount((values % np.uint64(64 * BITMAP_WORDS)).astype(np.int64), minlength=64 * BITMAP_WORDS) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


def _near_bitmaps(threshold: int) -> Column:
    """Whether the bitmaps and the numbers of unshared shingles of x and y allow a link."""
    bits = sum((F.bit_count(F.col("x.bits")[k].bitwiseXOR(F.col("y.bits")[k])) for k in range(BITMAP_WORDS)), F.lit(0))
    apart = F.col("x.own") + F.col("y.own") + bits
    return apart * (100 + threshold) <= (F.col("x.n") + F.col("y.n")) * (100 - threshold)


def jaccard_classes(
    docs: DataFrame, threshold: int = 85, size: int = 4, doc_id: str = "doc_id", text: str = "text"
) -> DataFrame:
    """Columns doc_id, n_shingles, component_id (smallest id of the class), row, first_row.

    ``row`` numbers the rows as ``monotonically_increasing_id`` does on the same frame, and
    ``first_row`` is the class's row with the smallest id, so one row of a class can be chosen.
    """

    def values_of(table: pa.Table) -> np.ndarray:
        flat = np.concatenate([np.empty(0, np.uint64), *shingle_sets(texts_of(table["text"]), size)])
        return np.stack([flat, mixed(flat)], axis=1)

    def result_of(table: pa.Table, counts: np.ndarray) -> pa.Table:
        sets = shingle_sets(texts_of(table["text"]), size)
        at, digests, shared, prefixes, positions, bitmaps = 0, [], [], [], [], []
        for values in sets:
            n = len(values)
            here = counts[at : at + n]
            at += n
            need = -(-n * threshold // 100)
            elsewhere = here > 1
            if not n or elsewhere.sum() < need:
                for column in (digests, shared, prefixes, positions, bitmaps):
                    column.append(None)
                continue
            order = np.lexsort((values, here))[: n - need + 1]
            order = [int(i) for i in order if elsewhere[i]]
            first = n - need + 1 - len(order)
            digest = hashlib.blake2b(values.tobytes(), digest_size=16).digest()
            digests.append(digest)
            shared.append(values[elsewhere].tobytes())
            bitmaps.append(_bitmap(values[elsewhere]).tolist())
            prefixes.append(values[order].view(np.int64).tolist())
            positions.append(list(range(first, first + len(order))))
        return pa.table(
            {
                "row": table["row"],
                "doc_id": table["doc_id"].cast(pa.int64()),
                "n": pa.array([len(values) for values in sets], pa.int32()),
                "digest": pa.array(digests, pa.binary()),
                "shared": pa.array(shared, pa.binary()),
                "prefix": pa.array(prefixes, pa.list_(pa.int64())),
                "positions": pa.array(positions, pa.list_(pa.int32())),
                "bits": pa.array(bitmaps, pa.list_(pa.int64())),
            }
        )

    bound_batches(docs.sparkSession)
    rows, buckets = parcels(docs, doc_id, text)
    base = materialize(
        with_counts(
            rows,
            counted(rows, buckets, WIDTH, values_of),
            buckets,
            values_of,
            result_of,
            "row long, doc_id long, n int, digest binary, shared binary, prefix array<long>, positions array<int>, "
            "bits array<long>",
        ),
        "shingles",
    )
    found = base.where("digest is not null")
    smallest = F.when(F.col("doc_id").isNotNull(), F.struct("doc_id", "row"))
    members = found.groupBy("digest").agg(F.min("row").alias("set"), F.min(smallest).alias("smallest"))
    members = materialize(members, "members")
    first = members.select(F.col("set").alias("row"))
    sets = materialize(
        found.join(first, "row", "left_semi").select(F.col("row").alias("set"), "n", "shared", "prefix", "positions", "bits"),
        "sets",
    )
    classes = _classes(sets, threshold)
    named = members.join(classes, members["set"] == classes["node"], "left").select(
        "digest", "smallest", "set", F.coalesce("component", "set").alias("class")
    )
    names = named.groupBy("class").agg(F.min("smallest").alias("s"), F.min("set").alias("set"))
    names = names.select("class", F.col("s.doc_id").alias("component_id"), F.coalesce("s.row", "set").alias("first_row"))
    named = named.select("digest", "class").join(names, "class").drop("class")
    columns = ["doc_id", F.col("n").cast("long").alias("n_shingles"), "component_id", "row", "first_row"]
    classed = found.select("row", "doc_id", "n", "digest").join(named, "digest").select(columns)
    alone = base.where("digest is null").withColumn("component_id", F.col("doc_id")).withColumn("first_row", F.col("row"))
    return classed.union(alone.select(columns))


def one_of_each_class(docs: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that come first in their class.

    Rows are numbered as they are read, twice, so give a table, not a frame whose partitions can come out differently.
    """
    row = free_name(docs, "row")
    rows = jaccard_classes(docs, **options).where("row = first_row").select(F.col("row").alias(row))
    rows = materialize(rows, "first")
    return docs.withColumn(row, F.monotonically_increasing_id()).join(rows, row, "left_semi").drop(row)


def _classes(sets: DataFrame, threshold: int) -> DataFrame:
    """(node, component) of every set that has a link."""
    linked = F.col("overlap") * (100 + threshold) >= (F.col("n") + F.col("m")) * threshold
    own = F.col("n") - F.octet_length("shared") / 8
    entries = sets.select("set", "n", own.cast("int").alias("own"), "bits", F.explode(F.arrays_zip("prefix", "positions")).alias("e"))
    entries = entries.select(
        "set", "n", "own", "bits", F.col("e.prefix").alias("shingle"), F.col("e.positions").alias("position"), _block(F.col("n")).alias("block")
    )
    span = int(np.ceil(np.log(100 / threshold) / np.log(BLOCK_GROWTH)))
    reached = F.explode(F.sequence(F.col("block") - span, F.col("block") + span))

    def classed(frame: DataFrame) -> DataFrame:
        if classes is None:
            return frame.withColumn("class", F.col("set"))
        named = classes.select(F.col("node").alias("set"), F.col("component"))
        return frame.join(named, "set", "left").withColumn("class", F.coalesce("component", "set")).drop("component")

    def compared(pairs: DataFrame, label: str) -> DataFrame:
        pairs = pairs.select(F.least("x.set", "y.set").alias("a"), F.greatest("x.set", "y.set").alias("b")).distinct()
        return materialize(_similar(pairs, sets).where(linked).select("a", "b"), label)

    classes, links = None, None
    for number in range(ROUNDS):
        placed = classed(entries.drop("own", "bits"))
        turn = F.xxhash64(F.lit(number), "shingle", "set").alias("turn")
        leaders = placed.groupBy("shingle", "block").agg(F.min(F.struct(turn, "set", "n", "position", "class")).alias("l"))
        leaders = leaders.select("shingle", "block", "l.*")
        near = placed.withColumn("block", reached)
        led = leaders.alias("x").join(near.alias("y"), ["shingle", "block"])
        found = compared(led.where(_possible(threshold) & (F.col("x.class") != F.col("y.class"))), "led")
        links = found if links is None else links.unionByName(found)
        classes = connected_components(links)

    # Lists that hold several classes.
    placed = classed(entries)
    several = placed.groupBy("shingle").agg(F.min("class").alias("low"), F.max("class").alias("high"), F.count("*").alias("k"))
    several = several.where("low <> high").select("shingle", F.ceil(F.col("k") / SLICE).cast("int").alias("slices"))
    placed = materialize(placed.join(several, "shingle"), "several")
    x = placed.withColumn("slice", F.pmod(F.xxhash64("set"), F.col("slices")).cast("int"))
    y = placed.withColumn("slice", F.explode(F.sequence(F.lit(0), F.col("slices") - 1))).withColumn("block", reached)
    rest = x.alias("x").join(y.alias("y"), ["shingle", "slice", "block"]).where(
        (F.col("x.set") < F.col("y.set"))
        & (F.col("x.class") != F.col("y.class"))
        & _possible(threshold)
        & _near_bitmaps(threshold)
    )
    return connected_components(links.unionByName(compared(rest, "rest")))

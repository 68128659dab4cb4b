"""Benchmark passages in documents, found with spaced seeds.

Words are lower-cased runs of letters and digits.  Each mask is laid on every window of its span;
the words under its ones are hashed and the others ignored, so a window still hits where a
neighbouring word was replaced.  The masks leave none out: wherever up to a fifth of an item's words are replaced, one
of its masks lies somewhere on words that are not (a test counts, for every length, the replacements
that would be needed).  Items of five and six words have shorter masks, and those of up to four, in which no
word may be replaced, are hashed whole; such masks are laid on documents only where the benchmark has such items.  Hashes of the documents are joined with those of the benchmark,
and around every hit the whole item is laid on the document at that offset: an item is contained
where at least ``share`` percent of its words are the document's words at their places.

All windows of all texts are hashed.  The benchmark's hashes are broadcast only where their
number, counted first, is within ``BROADCAST_ROWS``; a larger benchmark is joined by shuffle.
Hits carry a row number and an offset and are put together by row; then only documents with hits are taken up again,
to verify.

Only DataFrame functions are used.

Defined results: null and empty texts contain nothing, and items without words are contained
nowhere; equal items are all reported; equal rows are reported each; empty tables give no rows;
other columns are ignored, whatever their names.  Rows are numbered as they are read, twice, so give a table,
not a frame whose partitions can come out differently.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.words import free_name
from sessionloom.workspace import materialize

#: Ones are the words that are hashed.  For items from seven words on, and for shorter ones by length.
MASKS = ("11101", "110011")
SHORT_MASKS = {5: ("1011", "1101"), 6: ("1011", "1101")} | {n: ("1" * n,) for n in (1, 2, 3, 4)}
#: Percent of an item's words; the masks are complete from here on.
SHARE = 80
BROADCAST_ROWS = 1_000_000
_NO_WORD = r"[^\p{L}\p{N}]+"


def words(text: Column) -> Column:
    return F.split(F.trim(F.regexp_replace(F.lower(F.coalesce(text, F.lit(""))), _NO_WORD, " ")), " ")


def _as_column(frame: DataFrame, value: Column, name: str) -> DataFrame:
    """Add a column that Spark evaluates once, though several expressions use it."""
    return frame.withColumn(name, F.explode(F.array(value)))


def _seeds(frame: DataFrame, masks: list[str]) -> DataFrame:
    """(…, position, seed) of every window of the column ``words``."""
    hashed = _as_column(frame, F.transform("words", lambda w: F.xxhash64(w)), "hashes")

    def of(mask: str) -> Column:
        places = [k for k, bit in enumerate(mask) if bit == "1"]
        last = F.size("hashes") - len(mask)

        def seed(i: Column) -> Column:
            return F.xxhash64(F.lit(mask), *[F.get("hashes", i + k) for k in places])

        starts = F.when(last >= 0, F.sequence(F.lit(0), last)).otherwise(F.array().cast("array<int>"))
        return F.transform(starts, seed)

    seeds = hashed.drop("words").withColumn("all", F.array(*[of(mask) for mask in masks])).drop("hashes")
    each = seeds.select("*", F.explode("all").alias("of_mask")).drop("all")
    return each.select("*", F.posexplode("of_mask").alias("position", "seed")).drop("of_mask")


def benchmark_overlaps(
    docs: DataFrame,
    benchmark: DataFrame,
    masks: tuple[str, ...] = MASKS,
    share: int = SHARE,
    doc_id: str = "doc_id",
    text: str = "text",
    item_id: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """Columns row, doc_id, item_id, start (word), matched, item_words: contained items.

    ``masks`` are those of items from seven words on.
    """
    if share < SHARE:
        raise ValueError(f"the masks find every overlap from {SHARE} percent on, not from {share}")
    items = benchmark.select(F.col(item_id).alias("item_id"), words(F.col(item_text)).alias("words"))
    items = materialize(items.where(F.get("words", F.lit(0)) != ""), "items")
    # Equal items have the same seeds, so the smallest stands for them until the end.
    texts = items.groupBy("words").agg(F.collect_set("item_id").alias("items"), F.min("item_id").alias("item"))
    texts = materialize(texts, "texts")
    long = max(SHORT_MASKS) + 1
    present = {n for (n,) in texts.select(F.least(F.size("words"), F.lit(long))).distinct().collect()}
    used = {n: SHORT_MASKS.get(n, masks) for n in sorted(present)}
    parts = [
        _seeds(texts.where(F.least(F.size("words"), F.lit(long)) == n).select("item", "words"), list(of_length))
        for n, of_length in used.items()
    ]
    parts = parts or [_seeds(texts.select("item", "words"), list(masks))]
    index = reduce(DataFrame.unionByName, parts).select("seed", "item", F.col("position").alias("at"))
    index = materialize(index.distinct(), "seeds")
    if index.count() <= BROADCAST_ROWS:
        index = F.broadcast(index)

    rows = docs.select(
        F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"), F.col(text).alias("text")
    )
    laid = list(dict.fromkeys(mask for of_length in used.values() for mask in of_length)) or list(masks)
    seeds = _seeds(rows.select("row", words(F.col("text")).alias("words")), laid)
    hits = seeds.join(index, "seed").select("row", "item", (F.col("position") - F.col("at")).alias("offset"))
    hits = materialize(hits.distinct(), "hits")
    # Few documents have hits: their rows are found first, and only their texts are taken apart again.
    hit_rows = materialize(hits.select("row").distinct(), "hit-rows")
    held = rows.join(hit_rows, "row", "left_semi").select("row", "doc_id", words(F.col("text")).alias("held"))
    held = materialize(held, "held")

    found = hits.join(texts.select("item", F.col("words").alias("wanted")), "item")
    aligned = found.join(held, "row").withColumn(
        "matched",
        F.size(
            F.filter(
                F.sequence(F.lit(0), F.size("wanted") - 1),
                lambda k: F.when(F.col("offset") + k >= 0, F.get("held", F.col("offset") + k)) == F.get("wanted", k),
            )
        ),
    )
    kept = aligned.where(F.col("matched") * 100 >= F.size("wanted") * share).select(
        "row", "doc_id", "item", "matched", F.greatest("offset", F.lit(0)).alias("start"), F.size("wanted").alias("item_words")
    )
    best = kept.groupBy("row", "doc_id", "item").agg(
        F.max(F.struct("matched", (-F.col("start")).alias("before"), "item_words")).alias("b")
    )
    return best.join(texts.select("item", "items"), "item").select(
        "row",
        "doc_id",
        F.explode("items").alias("item_id"),
        (-F.col("b.before")).cast("long").alias("start"),
        F.col("b.matched").cast("long").alias("matched"),
        F.col("b.item_words").cast("long").alias("item_words"),
    )


def without_contaminated(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The rows of ``docs``, all columns, that contain no item."""
    row = free_name(docs, "row")
    rows = benchmark_overlaps(docs, benchmark, **options).select(F.col("row").alias(row)).distinct()
    rows = materialize(rows, "contaminated")
    return docs.withColumn(row, F.monotonically_increasing_id()).join(rows, row, "left_anti").drop(row)

"""A mix of sources by target weights: a low-discrepancy schedule of equal-token blocks.

Targets.  Sources in code-point order, null last, have the weights given, in turn.  They share
``share`` of all words by weight; a target stops at ``repeats`` times its source's words and
the excess is shared again by weight until none is above.  All of this is exact: whether a source
is above is a comparison of whole numbers.

Schedule.  Slot i stands at the golden-ratio point ``frac(i * 0.618...)``, a lattice of 2**31 points,
so any run of slots meets every source in proportion to its target, to within a few slots.  The
point is mapped through the cumulative targets to its source, and slots are ranked within their
source.  The slot with rank k takes the source's block k: its documents, in a shuffled order that
is repeated, are cut into blocks of equal numbers of words, long documents being cut where a
block ends.  The last block stops at the target.  Where the points give a source more slots than
it has blocks, the surplus stays empty; where they give fewer, its last blocks follow at the end.  So
every source takes its target's whole words, and a document is taken at most ``repeats`` times.

Everything is DataFrame functions.  No window holds a source: words before a document, and slots
before a slot, are summed first over small buckets of the order, then within a bucket; what
remains per source is one row for each bucket.  Points are matched to sources by equal cells of the
unit interval, not by comparing all with all.  The driver sees three totals and, for each round of the
sharing, two sums.  Texts are read once, for their number of words.

Defined results: null, empty and blank texts have size 0 and are not taken; a null source is a
source; repeated rows are documents of their own; documents without id are mixed like others; ties
in the shuffle go to the smaller id, then size, so a rerun takes the same words; without any
words all targets are 0; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.workspace import materialize

WEIGHTS = (3, 1, 2)
#: Words of a block: the mix is cut into about so many, but no block is longer than the other.
BLOCKS = 1 << 16
LONGEST_BLOCK = 1 << 16
#: Documents of a bucket of the shuffled order, and slots of a run, on average and at most.
BUCKET_DOCS = 4096
RUN_SLOTS = 1024
#: The lattice of points, and the odd multiplier next to its golden section.
LATTICE = 1 << 31
GOLDEN = 1327217885


def word_count(text: Column) -> Column:
    """Number of runs of ``[^\\x20\\x09-\\x0D]``: places where a word follows a blank or the start."""
    blank = F.translate(F.concat(F.lit(" "), F.coalesce(text, F.lit(""))), "\t\n\x0b\x0c\r", "     ")
    return F.size(F.array_remove(F.split(blank, " "), "")).cast("long")


def _numbered(sources: DataFrame) -> DataFrame:
    """Adds ``place``, from 0 in the order of code points, null last, without one sorted task."""
    sorted_rows = materialize(
        sources.orderBy(F.asc_nulls_last("source")).select(
            "*", F.spark_partition_id().alias("part"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at")
        ),
        "sources",
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = sorted_rows.groupBy("part").agg(F.count("*").alias("k"))
    parts = parts.select("part", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("before"))
    return sorted_rows.join(parts, "part").withColumn("place", F.col("before") + F.col("at")).drop("part", "at", "before")


def targets(sizes: DataFrame, weights: Sequence[int], share: Fraction, repeats: int) -> DataFrame:
    """(place, source, source_size, weight, target, words): ``words`` is the whole part of the target."""
    sources = _numbered(sizes.groupBy("source").agg(F.sum("size").alias("source_size")))
    turn = F.array(*[F.lit(w) for w in weights])
    weight = F.element_at(turn, (F.col("place") % len(weights) + 1).cast("int")).cast("long")
    sources = materialize(sources.withColumn("weight", weight), "weights")
    total, every = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    total, every = total or 0, every or 0
    p, q = share.numerator, share.denominator
    # A source is above if weight * left / open > repeats * size, for what is left to the open ones:
    # left = (p * total - q * repeats * capped) / q.
    capped_size, capped_weight = 0, 0
    while True:
        left, open_weight = p * total - q * repeats * capped_size, every - capped_weight
        wide = "decimal(38,0)"
        above = F.col("weight").cast(wide) * F.lit(left).cast(wide) > F.col("source_size").cast(wide) * F.lit(q * repeats * open_weight).cast(wide)
        size, weight = sources.where(above).agg(F.sum("source_size"), F.sum("weight")).first()
        size, weight = size or 0, weight or 0
        if weight == capped_weight:
            break
        capped_size, capped_weight = size, weight
    limit = (F.col("source_size") * repeats).cast("double")
    even = (F.col("weight") * F.lit(left)).cast("double") / F.lit(float(q * open_weight or 1))
    sources = sources.withColumn("target", F.when(above, limit).otherwise(even))
    return sources.withColumn("words", F.least(F.floor("target"), F.col("source_size") * repeats))


def _before(rows: DataFrame, by: list[str], bucket: str, order: list[str | Column], amount: str, tables: str) -> DataFrame:
    """Adds ``before``: the sum of ``amount`` over the rows of the same ``by`` that come earlier.

    ``bucket`` grows with the order and holds a bounded number of rows.
    """
    earlier = Window.unboundedPreceding, -1
    sums = rows.groupBy(*by, bucket).agg(F.sum(amount).alias("_sum"))
    over = Window.partitionBy(*by).orderBy(bucket).rowsBetween(*earlier)
    sums = sums.select(*by, bucket, F.coalesce(F.sum("_sum").over(over), F.lit(0)).alias("_earlier"))
    inside = Window.partitionBy(*by, bucket).orderBy(*order).rowsBetween(*earlier)
    rows = rows.withColumn("_inside", F.coalesce(F.sum(amount).over(inside), F.lit(0)))
    rows = rows.join(materialize(sums, tables), [*by, bucket])
    return rows.withColumn("before", F.col("_earlier") + F.col("_inside")).drop("_earlier", "_inside")


def schedule(sources: DataFrame, block: int) -> DataFrame:
    """(slot, place, k): the source of every slot and the number of its block, from 0.

    ``sources`` has place and words; sources without words have no slots.
    """
    spark = sources.sparkSession
    wanted = sources.where("words > 0").select("place", "words", F.ceil(F.col("words") / block).alias("blocks"))
    n, words, count = wanted.agg(F.sum("blocks"), F.sum("words"), F.count("*")).first()
    n, words = n or 0, words or 0
    cells = 1 << max(10, (4 * count).bit_length())
    wide = LATTICE // cells
    # Cumulative targets, from 0 to LATTICE, in the order of places.
    bounds = wanted.withColumn("all", F.lit(0)).withColumn("band", F.floor(F.col("place") / BUCKET_DOCS))
    bounds = _before(bounds, ["all"], "band", ["place"], "words", "bounds")
    scaled = lambda x: F.floor(x.cast("decimal(38,0)") * F.lit(LATTICE) / F.lit(max(words, 1))).cast("long")
    bounds = bounds.select("place", "blocks", scaled(F.col("before")).alias("low"), scaled(F.col("before") + F.col("words")).alias("high"))
    bounds = materialize(bounds, "bounds")
    in_cells = bounds.where("low < high").withColumn(
        "cell", F.explode(F.sequence(F.floor(F.col("low") / wide), F.floor((F.col("high") - 1) / wide)))
    )
    slots = spark.range(n).select(F.col("id").alias("slot"), (F.col("id") % LATTICE * GOLDEN % LATTICE).alias("point"))
    slots = slots.withColumn("cell", F.floor(F.col("point") / wide)).withColumn("run", F.floor(F.col("slot") / RUN_SLOTS))
    slots = slots.join(materialize(in_cells, "cells"), "cell").where("low <= point AND point < high")
    slots = slots.select("slot", "run", "place", "blocks", F.lit(1).alias("one"))
    # Written, as the sums over runs and the ranks inside them both read it.
    slots = materialize(slots, "slots")
    ranked = _before(slots, ["place"], "run", ["slot"], "one", "ranks").withColumnRenamed("before", "k")
    placed = ranked.where("k < blocks").select("slot", "place", "k")
    given = slots.groupBy("place").agg(F.count("*").alias("given"))
    short = bounds.join(given, "place", "left").withColumn("given", F.coalesce("given", F.lit(0))).where("given < blocks")
    last = short.select("place", F.explode(F.sequence(F.col("given"), F.col("blocks") - 1)).alias("k"))
    return placed.unionByName(last.select(F.lit(n).alias("slot"), "place", "k"))


def mix(
    docs: DataFrame,
    weights: Sequence[int] = WEIGHTS,
    share: Fraction = Fraction(3, 2),
    repeats: int = 2,
    doc_id: str = "doc_id",
    text: str = "text",
    source: str = "source",
    block: int | None = None,
) -> tuple[DataFrame, DataFrame]:
    """The pieces of the mix in slots, and its documents.

    Pieces: slot, source, block (its number), row, doc_id, start (words of the document before the
    piece), length; the mix is read in the order of slots, a slot's pieces in the order of the block.
    Slots share the last number where a source's last blocks follow at the end.  Documents: row, doc_id, source, size,
    source_size, target, taken.  ``row`` numbers the rows as they are read, once.
    """
    if not 0 <= share <= repeats:
        raise ValueError("the mix cannot be longer than all repeats of all documents")
    sizes = materialize(
        docs.select(
            F.monotonically_increasing_id().alias("row"), F.col(doc_id).alias("doc_id"),
            F.col(source).alias("source"), word_count(F.col(text)).alias("size"),
        ),
        "sizes",
    )
    sources = materialize(targets(sizes, weights, share, repeats), "targets")
    n, words = sizes.agg(F.count("*"), F.sum("size")).first()
    block = block or max(1, min(LONGEST_BLOCK, int(share * (words or 0)) // BLOCKS))

    # The shuffled order of a source is that of a digest; its leading digits are the bucket.
    digits = 2
    while BUCKET_DOCS << 4 * digits < n:
        digits += 1
    order = F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
    named = sizes.join(sources.drop("weight"), sizes["source"].eqNullSafe(sources["source"])).drop(sources["source"])
    shuffled = named.where("size > 0").withColumn("digest", order).withColumn("bucket", F.substring("digest", 1, digits))
    shuffled = _before(shuffled, ["place"], "bucket", ["digest", F.asc_nulls_last("doc_id"), "size", "row"], "size", "shuffled")

    # A document's words in every repeat of its source, cut where blocks end and at the target.
    pieces = shuffled.select(
        "row", "doc_id", "place", "words",
        F.explode(F.transform(F.sequence(F.lit(0), F.lit(repeats - 1)), lambda r: F.struct(
            (F.col("before") + r * F.col("source_size")).alias("first"),
            F.least(F.col("before") + F.col("size") + r * F.col("source_size"), "words").alias("end"),
        ))).alias("run"),
    ).where("run.first < run.end")
    edge = F.col("k") * block
    pieces = (
        pieces.select("row", "doc_id", "place", "run.*")
        .withColumn("k", F.explode(F.sequence(F.floor(F.col("first") / block), F.floor((F.col("end") - 1) / block))))
        .select(
            "row", "doc_id", "place", "k",
            (F.greatest("first", edge) - F.col("first")).alias("start"),
            (F.least("end", edge + block) - F.greatest("first", edge)).alias("length"),
            (F.greatest("first", edge) - edge).alias("offset"),
        )
    )
    placed = pieces.join(schedule(sources, block), ["place", "k"])
    names = sources.select("place", "source")
    mixed = placed.join(names, "place").select(
        "slot", "source", F.col("k").alias("block"), "offset", "row", "doc_id", "start", "length"
    )
    mixed = materialize(mixed, "mix")
    taken = mixed.groupBy("row").agg(F.sum("length").alias("taken"))
    summed = named.join(taken, "row", "left").select(
        "row", "doc_id", "source", "size", "source_size", "target", F.coalesce("taken", F.lit(0)).alias("taken")
    )
    return mixed, summed

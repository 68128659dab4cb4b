"""Hard negatives: rows of another label whose score lies just below a positive's.

Vectors become integers, ``floor(256 * x)`` for each component, so scores are exact whatever the
order of additions.  Scores of anchors with candidates are products of int64 tiles by Strassen's
recursion: a product of matrices halved in all three dimensions takes seven products of halves
instead of eight, the tiles padded with zeros to even sides.  Sums and differences of integers
modulo 2**64 lose nothing, so the result is exact wherever the score itself fits; a tile whose
scores could leave 64 bits is multiplied with Python's integers.

A tile never holds more than ``ANCHOR_TILE`` anchors and ``CANDIDATE_TILE`` candidates, whatever
the size of a label: tiles meet as Spark groups under the numbers of both.  Every tile answers with
heaps of at most ``k`` entries, which are merged by rank across tiles.

* Positives: anchors meet the candidates of their own label only.
* Negatives: anchors, now with the scores of their positives, meet all candidates; for each
  positive the tile keeps the best ``k`` rows of another label inside the window
  ``low * positive <= 100 * score <= 100 * positive``.

The anchors are a query set against all rows, in blocks, so work is their number times the rows.

Defined results: rows with a null label, a null vector, or a null or non-finite component take no
part; a missing component of a shorter vector is zero (an empty vector scores zero with all); rows
without id are candidates but no anchors, and come last among ties; repeated rows are rows of
their own, so an anchor's copy can be its positive and an anchor that stands twice is answered
twice; scores beyond 64 bits count as the nearest 64-bit number; an anchor without positives, or a
positive without rows in its window, gives no rows; an empty table gives no rows; other columns are
ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.workspace import materialize

ANCHOR_TILE = 4096
CANDIDATE_TILE = 16384
#: Candidates of a tile at least, when there are few rows for many tasks.
LEAST_TILE = 1024
#: Anchors multiplied at a time; bounds the scores in memory.
STRIPE = 128
#: Below this side a product is taken directly.
LEAF = 16
_ID_LAST = np.iinfo(np.int64).max


def _even(matrix: np.ndarray) -> np.ndarray:
    if not any(side % 2 for side in matrix.shape):
        return matrix
    out = np.zeros([side + side % 2 for side in matrix.shape], matrix.dtype)
    out[: len(matrix), : matrix.shape[1]] = matrix
    return out


def strassen(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The product of two integer matrices."""
    rows, columns = len(a), b.shape[1]
    if min(rows, a.shape[1], columns) <= LEAF:
        return a @ b
    a, b = _even(a), _even(b)
    r, s, t = len(a) // 2, len(b) // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:r, :s], a[:r, s:], a[r:, :s], a[r:, s:]
    b11, b12, b21, b22 = b[:s, :t], b[:s, t:], b[s:, :t], b[s:, t:]
    # Winograd's order of the seven products: fifteen additions.
    s1 = a21 + a22
    s2 = s1 - a11
    t1 = b12 - b11
    t2 = b22 - t1
    p1 = strassen(a11, b11)
    p2 = strassen(a12, b21)
    p3 = strassen(a12 - s2, b22)
    p4 = strassen(a22, t2 - b21)
    p5 = strassen(s1, t1)
    p6 = strassen(s2, t2)
    p7 = strassen(a11 - a21, b22 - b12)
    u2 = p1 + p6
    u3 = u2 + p7
    out = np.empty((2 * r, 2 * t), p1.dtype)
    out[:r, :t] = p1 + p2
    out[:r, t:] = u2 + p5 + p3
    out[r:, :t] = u3 - p4
    out[r:, t:] = u3 + p5
    return out[:rows, :columns]


def _matrix(column: pa.ChunkedArray, width: int) -> np.ndarray:
    """Vectors as rows of int64, shorter ones padded with zeros."""
    out = np.zeros((len(column), width), np.int64)
    at = 0
    for chunk in column.chunks:
        offsets = chunk.offsets.to_numpy()
        flat = chunk.values.to_numpy(zero_copy_only=False)
        sizes = np.diff(offsets)
        if len(sizes) and (sizes == width).all():
            out[at : at + len(sizes)] = flat[offsets[0] : offsets[-1]].reshape(-1, width)
        else:
            for k, size in enumerate(sizes):
                out[at + k, :size] = flat[offsets[k] : offsets[k] + size]
        at += len(sizes)
    return out


def _largest(matrix: np.ndarray) -> int:
    return max(abs(int(matrix.min())), abs(int(matrix.max()))) if matrix.size else 0


def _stripes(anchors: pa.Table, candidates: pa.Table):
    """(first anchor, scores) for a stripe of anchors with all candidates of the tile."""
    sizes = [int(np.max(t["vector"].combine_chunks().value_lengths().to_numpy(), initial=0)) for t in (anchors, candidates)]
    width = max(sizes)
    a, b = _matrix(anchors["vector"], width), np.ascontiguousarray(_matrix(candidates["vector"], width).T)
    exact = _largest(a) * _largest(b) * width < 1 << 63
    if not exact:
        a, b = a.astype(object), b.astype(object)
    for first in range(0, len(a), STRIPE):
        scores = strassen(a[first : first + STRIPE], b)
        if not exact:
            limit = np.iinfo(np.int64)
            scores = np.clip(scores, limit.min, limit.max).astype(np.int64)
        yield first, scores


def _by_id(table: pa.Table) -> pa.Table:
    """Rows in the order of ties."""
    ids = table["vec_id"].fill_null(_ID_LAST).to_numpy()
    return table.take(np.lexsort((table["row"].to_numpy(), ids)))


def _best(group: np.ndarray, score: np.ndarray, k: int) -> np.ndarray:
    """Indices of the first k entries of every group by score; entries come in the order of ties."""
    order = np.lexsort((np.arange(len(group)), ~score, group))
    starts = np.flatnonzero(np.concatenate([[True], group[order][1:] != group[order][:-1]])[: len(order)])
    rank = np.arange(len(order)) - np.repeat(starts, np.diff(np.append(starts, len(order))))
    return order[rank < k]


def _slices(rows: Column, tile: int) -> Column:
    return F.ceil(rows / tile).cast("int")


def _dealt(frame: DataFrame, own: str, others: str) -> DataFrame:
    """Rows under a slice of their own side and every slice of the other; ``a`` and ``c`` have the numbers of slices."""
    dealt = (
        frame.withColumn(f"{own}_tile", F.pmod(F.xxhash64("row"), F.col(own)).cast("int"))
        .withColumn(f"{others}_tile", F.explode(F.sequence(F.lit(0), F.col(others) - 1)))
        .drop("a", "c")
    )
    # Both sides come from one table; new columns keep them apart.
    return dealt.select(*[F.col(name).alias(name) for name in dealt.columns])


def _ranked(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """The first k rows of every group, ``rank`` from 1: the merge of the tiles' heaps."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("other_id"), "other")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def integer_rows(rows: DataFrame, vec_id: str, vector: str, label: str, label_of: Column | None) -> DataFrame:
    """(row, vec_id, label, vector) of the rows that take part; ``row`` tells equal rows apart."""
    frame = rows.select(
        F.monotonically_increasing_id().alias("row"),
        F.col(vec_id).cast("long").alias("vec_id"),
        F.col(label).cast("long").alias("label"),
        F.transform(vector, lambda x: x.cast("double")).alias("vector"),
    )
    sound = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    frame = frame.where(F.col("label").isNotNull() & F.col("vector").isNotNull() & sound)
    whole = F.transform("vector", lambda x: F.floor(x * 256))
    return frame.select("row", "vec_id", (F.col("label") if label_of is None else label_of).alias("label"), whole.alias("vector"))


def mine(
    rows: DataFrame,
    is_anchor: Column,
    low: int = 80,
    k_positives: int = 5,
    k_negatives: int = 5,
    label_of: Column | None = None,
    vec_id: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score, anchor_row, positive_row.

    ``is_anchor`` and ``label_of`` are expressions over ``vec_id`` and ``label``.  Rows of a table
    are numbered as they are read, once.
    """
    base = materialize(integer_rows(rows, vec_id, vector, label, label_of), "vectors")
    anchors = base.where(F.col("vec_id").isNotNull() & is_anchor)
    n = base.count()
    tasks = rows.sparkSession.sparkContext.defaultParallelism
    tile = min(CANDIDATE_TILE, max(LEAST_TILE, -(-n // tasks)))

    asks = F.col("vec_id").isNotNull() & is_anchor
    numbers = base.groupBy("label").agg(F.count("*").alias("n"), F.count_if(asks).alias("m")).where("m > 0")
    # Written, so that Spark knows how small it is; a hot label is then never shuffled as one key.
    numbers = materialize(
        numbers.select("label", _slices(F.col("m"), ANCHOR_TILE).alias("a"), _slices(F.col("n"), tile).alias("c")), "labels"
    )

    def positives_of(key, left: pa.Table, right: pa.Table) -> pa.Table:
        right = _by_id(right) if len(right) else right
        rows_a, rows_c = left["row"].to_numpy(), right["row"].to_numpy()
        parts = [np.empty((0, 3), np.int64)]
        for first, scores in _stripes(left, right) if len(left) and len(right) else ():
            fit = min(k_positives + 1, scores.shape[1])  # one more, for the anchor itself
            edge = np.partition(scores, scores.shape[1] - fit, axis=1)[:, scores.shape[1] - fit]
            at, candidate = np.nonzero(scores >= edge[:, None])
            other = rows_a[first + at] != rows_c[candidate]
            at, candidate = at[other], candidate[other]
            score = scores[at, candidate]
            kept = _best(at, score, k_positives)
            parts.append(np.stack([first + at[kept], candidate[kept], score[kept]], axis=1))
        at, candidate, score = np.concatenate(parts).T
        return pa.table({
            "row": left["row"].take(at), "anchor_id": left["vec_id"].take(at),
            "other": right["row"].take(candidate), "other_id": right["vec_id"].take(candidate),
            "score": pa.array(score, pa.int64()),
        })

    found_schema = "row long, anchor_id long, other long, other_id long, score long"
    left, right = (_dealt(frame.join(numbers, "label"), *sides) for frame, sides in ((anchors, "ac"), (base, "ca")))
    tiles = ["label", "a_tile", "c_tile"]
    found = left.groupBy(*tiles).cogroup(right.groupBy(*tiles)).applyInArrow(positives_of, found_schema)
    positives = materialize(_ranked(found, ["row"], k_positives), "positives")

    # An anchor carries its positives: (number, score) of at most k_positives.
    wanted = positives.groupBy("row").agg(F.sort_array(F.collect_list(F.struct("rank", "score"))).alias("p"))
    wanted = wanted.select("row", F.col("p.score").alias("scores"))
    asking = materialize(anchors.join(wanted, "row"), "asking")
    slices = {"a": _slices(F.lit(asking.count()), ANCHOR_TILE), "c": _slices(F.lit(n), tile)}

    def negatives_of(key, left: pa.Table, right: pa.Table) -> pa.Table:
        parts = [np.empty((0, 4), np.int64)]
        if len(left) and len(right):
            right = _by_id(right)
            label_a, label_c = left["label"].to_numpy(), right["label"].to_numpy()
            asked = left["scores"].to_pylist()
            for first, scores in _stripes(left, right):
                here = asked[first : first + STRIPE]
                differs = label_a[first : first + len(here), None] != label_c[None, :]
                for number in range(k_positives):
                    # Where an anchor has fewer positives the window is empty.
                    has = np.array([len(p) > number for p in here])
                    high = np.array([p[number] if len(p) > number else 0 for p in here], np.int64)
                    # Least whole score with low * high <= 100 * score, in Python's integers.
                    floor = np.array([-(-low * int(p) // 100) for p in high], np.int64)
                    inside = differs & (scores >= floor[:, None]) & (scores <= high[:, None]) & has[:, None]
                    at, candidate = np.nonzero(inside)
                    score = scores[at, candidate]
                    kept = _best(at, score, k_negatives)
                    numbers = np.full(len(kept), number + 1)
                    parts.append(np.stack([first + at[kept], numbers, candidate[kept], score[kept]], axis=1))
        at, number, candidate, score = np.concatenate(parts).T
        return pa.table({
            "row": left["row"].take(at), "number": pa.array(number, pa.int32()),
            "other": right["row"].take(candidate), "other_id": right["vec_id"].take(candidate),
            "score": pa.array(score, pa.int64()),
        })

    left, right = (_dealt(frame.withColumns(slices), *sides) for frame, sides in ((asking, "ac"), (base, "ca")))
    tiles = ["a_tile", "c_tile"]
    found = left.groupBy(*tiles).cogroup(right.groupBy(*tiles)).applyInArrow(
        negatives_of, "row long, number int, other long, other_id long, score long"
    )
    best = _ranked(found, ["row", "number"], k_negatives)
    named = positives.select(
        "row", F.col("rank").alias("number"), "anchor_id", F.col("other_id").alias("positive_id"),
        F.col("score").alias("positive_score"), F.col("other").alias("positive_row"),
    )
    return best.join(named, ["row", "number"]).select(
        "anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"), F.col("other_id").alias("negative_id"),
        "positive_score", F.col("score").alias("negative_score"), F.col("row").alias("anchor_row"), "positive_row",
    )

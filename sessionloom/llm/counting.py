"""How often each 64-bit value occurs in a corpus, answered to the documents that hold it.

A row for every value would be several times the size of the text.  Instead documents are dealt
into parcels of bounded text; a parcel sends each bucket of the value space one block of its values
there, without keys.  A bucket counts its values and answers each block with one byte a value, in
the order in which they came.  Both steps are Spark groupings; parcels and buckets grow in number
with the corpus and stay the same size, and a value that fills a third of the corpus is spread
over its blocks, one entry for each occurrence in a parcel.

``values_of(table)`` gives an ``(n, 2)`` array of the values of a parcel's rows: the value and a
second, independent hash of the same thing.  A block keeps ``width`` bytes: eight of the value and
the rest of the second hash; the bucket adds its own bits.  Rows are ordered by ``row`` inside a
parcel, so ``values_of`` sees the same table both times.
"""

from __future__ import annotations

import math
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.shipping import giving_back

PARCEL_BYTES = 8 << 20
BUCKET_BYTES = 12 << 20

Values = Callable[[pa.Table], np.ndarray]


def parcels(docs: DataFrame, doc_id: str, text: str) -> tuple[DataFrame, int]:
    """Rows (parcel, row, doc_id, text), and the number of buckets for their values.

    ``row`` numbers the rows of the input's partitions, so equal rows and null ids stay apart.
    The input must give the same rows in the same partitions when read again, as tables do.
    """
    size = docs.agg(F.sum(F.octet_length(text))).first()[0] or 0
    least = 4 * docs.sparkSession.sparkContext.defaultParallelism
    count = max(least, math.ceil(size / PARCEL_BYTES))
    rows = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    parcel = F.pmod(F.xxhash64("row"), F.lit(count)).cast("int")
    return rows.withColumn("parcel", parcel), max(least, math.ceil(size / BUCKET_BYTES))


def _blocks(values: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray]:
    """Order of the values by bucket, and where each bucket starts in it."""
    bucket = (values[:, 1] >> np.uint64(24)) % np.uint64(buckets)
    order = np.argsort(bucket, kind="stable")
    return order, np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=np.uint64))


def _bytes_of(values: np.ndarray, width: int) -> np.ndarray:
    """The first ``width`` bytes of each value."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), 16)[:, :width]


def _counts(rows: np.ndarray) -> np.ndarray:
    """For each row of bytes, how many rows are equal to it, at most 255."""
    low = np.zeros((len(rows), 8), np.uint8)
    low[:, : min(8, rows.shape[1])] = rows[:, :8]
    keys = [low.view(np.uint64).ravel()] + [rows[:, k] for k in range(8, rows.shape[1])]
    order = np.lexsort(keys) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    new = np.ones(len(rows), bool)
    same = np.ones(max(len(rows) - 1, 0), bool)
    for key in keys:
        sorted_key = key[order]
        same &= sorted_key[1:] == sorted_key[:-1]
    new[1:] = ~same
    starts = np.flatnonzero(new)
    sizes = np.diff(np.append(starts, len(rows)))
    out = np.empty(len(rows), np.uint8)
    out[order] = np.minimum(np.repeat(sizes, sizes), 255).astype(np.uint8)
    return out


def counted(rows: DataFrame, buckets: int, width: int, values_of: Values) -> DataFrame:
    """Rows (parcel, bucket, counts): for each value of a block, in its order, its count up to 255.

    Blocks without a repeated value get no answer.
    """

    def requests(table: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        values = values_of(table)
        order, starts = _blocks(values, buckets)
        payload = _bytes_of(values[order], width)
        used = np.flatnonzero(np.diff(starts))
        return pa.table(
            {
                "parcel": pa.array(np.full(len(used), table["parcel"][0].as_py(), np.int32)),
                "bucket": pa.array(used.astype(np.int32)),
                "block": pa.array([payload[starts[b] : starts[b + 1]].tobytes() for b in used], pa.binary()),
            }
        )

    def answers(table: pa.Table) -> pa.Table:
        blocks = table["block"].to_pylist()
        counts = _counts(np.frombuffer(b"".join(blocks), np.uint8).reshape(-1, width))
        ends = np.cumsum([len(block) // width for block in blocks])
        parts = np.split(counts, ends[:-1])
        kept = [i for i, part in enumerate(parts) if part.max(initial=0) > 1]
        return pa.table(
            {
                "parcel": table["parcel"].take(kept),
                "bucket": table["bucket"].take(kept),
                "counts": pa.array([parts[i].tobytes() for i in kept], pa.binary()),
            }
        )

    blocks = rows.groupBy("parcel").applyInArrow(
        lambda table: giving_back(requests, table), "parcel int, bucket int, block binary"
    )
    return blocks.groupBy("bucket").applyInArrow(
        lambda table: giving_back(answers, table), "parcel int, bucket int, counts binary"
    )


def with_counts(
    rows: DataFrame,
    answers: DataFrame,
    buckets: int,
    values_of: Values,
    result_of: Callable[[pa.Table, np.ndarray], pa.Table],
    schema: str,
) -> DataFrame:
    """``result_of(table, counts)`` of every parcel, with the count of each of its values."""

    def joined(table: pa.Table, replies: pa.Table) -> pa.Table:
        table = table.sort_by("row")
        values = values_of(table)
        order, starts = _blocks(values, buckets)
        by_bucket = np.ones(len(values), np.uint8)
        for bucket, counts in zip(replies["bucket"].to_pylist(), replies["counts"].to_pylist(), strict=True):
            by_bucket[starts[bucket] : starts[bucket + 1]] = np.frombuffer(counts, np.uint8)
        out = np.empty(len(values), np.uint8)
        out[order] = by_bucket
        return result_of(table, out)

    return rows.groupBy("parcel").cogroup(answers.groupBy("parcel")).applyInArrow(
        lambda table, replies: giving_back(joined, table, replies), schema
    )

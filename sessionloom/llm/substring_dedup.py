"""Removal of word windows that occur more than once in a corpus.

Method: the Rabin-Karp hash of every window of ``size`` consecutive words is counted in Spark
(``counting``); the windows that occur twice or more merge into maximal intervals of words, and
those words go.  Windows are judged on the input, so every copy of a passage goes, the first
included.  A window is known by 72 bits of two independent hashes and by its bucket; texts are
whole, at any length.

Defined results: null, empty and blank texts have no words; texts shorter than a window lose
nothing; equal rows are copies of each other and each gives a row; an empty table gives no rows;
columns other than the two named are ignored, whatever their names.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from sessionloom.llm.counting import counted, parcels, with_counts
from sessionloom.llm.words import BASES, hash_words, mixed, texts_of, window_hashes

SIZE = 35
WIDTH = 9
SCHEMA = "doc_id long, n_words long, n_removed long, removed array<struct<start:long,end:long>>, kept string"


def _window_starts(lengths: np.ndarray, size: int) -> np.ndarray:
    """Positions of all windows in the texts' words put end to end."""
    ends = np.cumsum(lengths)
    inside = np.ones(int(ends[-1]) if len(ends) else 0, bool)
    for end, length in zip(ends, lengths, strict=True):
        inside[end - min(length, size - 1) : end] = False
    return np.flatnonzero(inside)


def remove_repeated_windows(docs: DataFrame, size: int = SIZE, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """Columns doc_id, n_words, n_removed, removed (word intervals, end excluded), kept (text)."""

    def windows(table: pa.Table) -> tuple[list[list[bytes]], np.ndarray, np.ndarray]:
        words = [body.split() for body in texts_of(table["text"])]
        lengths = np.array([len(w) for w in words], np.int64)
        return words, lengths, _window_starts(lengths, size)

    def values_of(table: pa.Table) -> np.ndarray:
        words, _, starts = windows(table)
        hashed = hash_words([w for row in words for w in row])
        if not len(starts):
            return np.empty((0, 2), np.uint64)
        first, second = (mixed(window_hashes(hashed, size, base)[starts]) for base in BASES)
        return np.stack([first, second], axis=1)

    def result_of(table: pa.Table, counts: np.ndarray) -> pa.Table:
        words, lengths, starts = windows(table)
        total = int(lengths.sum())
        change = np.zeros(total + 1, np.int64)
        repeated = starts[counts > 1]
        change[repeated] += 1
        change[repeated + size] -= 1
        gone = np.cumsum(change[:-1]) > 0
        at, spans, kept, removed = 0, [], [], []
        for row in words:
            flags = gone[at : at + len(row)]
            at += len(row)
            edges = np.flatnonzero(np.diff(np.concatenate([[False], flags, [False]]).astype(np.int8)))
            spans.append([{"start": int(a), "end": int(b)} for a, b in edges.reshape(-1, 2)])
            left, here = [], 0
            for a, b in edges.reshape(-1, 2):
                left += row[here:a]
                here = b
            left += row[here:]
            kept.append(b" ".join(left))
            removed.append(len(row) - len(left))
        return pa.table(
            {
                "doc_id": table["doc_id"].cast(pa.int64()),
                "n_words": pa.array(lengths),
                "n_removed": pa.array(removed, pa.int64()),
                "removed": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                "kept": pa.array(kept, pa.binary()).cast(pa.string()),
            }
        )

    rows, buckets = parcels(docs, doc_id, text)
    answers = counted(rows, buckets, WIDTH, values_of)
    return with_counts(rows, answers, buckets, values_of, result_of, SCHEMA)

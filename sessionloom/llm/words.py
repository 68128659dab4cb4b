"""Words and rolling hashes of whole texts, as numpy arrays inside tasks.

A word is a run of ``[^\\x20\\x09-\\x0D]``; these bytes never occur inside a longer UTF-8
character, so words are cut on bytes.  A word's hash is 64 bits of XXH3.  The hash of a window of
words is Rabin-Karp's polynomial modulo 2**64, taken from prefix sums: with
``A[k] = sum(w[i] * Q**i for i < k)`` the window at ``j`` has ``(A[j + n] - A[j]) * Q**-j``.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Two odd bases; ``Q % 8 == 3`` keeps Q**k - 1 as odd as it can be.
BASES = (0x9E3779B97F4A7C1B, 0xC2B2AE3D27D4EB53)
#: Words are many times larger than their text, so they are cut out of so many bytes of text at a time.
CHUNK_BYTES = 1 << 20


def texts_of(column: pa.Array | pa.ChunkedArray) -> list[bytes]:
    """UTF-8 bytes of every text; null is empty."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [text or b"" for text in column.cast(kind).to_pylist()]


def chunks(bodies: list[bytes]) -> Iterator[list[bytes]]:
    """The texts in turn, in lists that are closed at ``CHUNK_BYTES``."""
    size, chunk = 0, []
    for body in bodies:
        chunk.append(body)
        size += len(body)
        if size >= CHUNK_BYTES:
            yield chunk
            size, chunk = 0, []
    if chunk:
        yield chunk


def slices(batch: pa.RecordBatch, text: str) -> Iterator[pa.RecordBatch]:
    """The rows of a batch in turn, in batches that are closed at ``CHUNK_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch[text]), 0)
    ends = np.cumsum(sizes.to_numpy(zero_copy_only=False), dtype=np.int64)
    at, before = 0, 0
    while at < len(ends):
        end = min(int(np.searchsorted(ends, before + CHUNK_BYTES)) + 1, len(ends))
        yield batch.slice(at, end - at)
        at, before = end, ends[end - 1]


def hash_words(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def mixed(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all bits."""
    x = values ^ (values >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def window_hashes(words: np.ndarray, size: int, base: int = BASES[0]) -> np.ndarray:
    """Hash of the window that starts at each word; none for the last ``size - 1`` words."""
    count = len(words)
    if count < size:
        return np.empty(0, np.uint64)
    powers = np.full(count, base, np.uint64)
    powers[0] = 1
    np.multiply.accumulate(powers, out=powers)
    sums = np.zeros(count + 1, np.uint64)
    np.cumsum(words * powers, out=sums[1:])
    inverse = np.full(count - size + 1, pow(base, -1, 1 << 64), np.uint64)
    inverse[0] = 1
    np.multiply.accumulate(inverse, out=inverse)
    return (sums[size:] - sums[: count - size + 1]) * inverse


def free_name(frame: DataFrame, wanted: str) -> str:
    """A column name that the frame does not have, compared as Spark compares names."""
    taken = {name.lower() for name in frame.columns}
    while wanted in taken:
        wanted += "_"
    return wanted

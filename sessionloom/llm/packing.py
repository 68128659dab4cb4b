"""Packing of documents into sequences with their lexical neighbours.

Method: tasks cut their documents into shards of bounded size and build a BM25 inverted index of
token ids over each shard, all of its documents included.  A seed document opens a window; its
rarest terms are looked up, and its unused neighbours follow by score until the window is full.
The document that crosses the window's end is cut there and its rest is the next seed.  So all
windows of a shard are full but its last tokens, and those go into sequences whose lengths are
powers of two, which need no padding.

Nothing is shuffled: a shard never leaves its task, and a lost task is run again on the same
partition and gives the same pieces.  Sequence numbers are the partition's number and a count.

Defined results: null and empty texts are the end id alone; equal rows are documents of their own
(copies are each other's best neighbours); ties in scores go to the document that was read first;
an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import zlib

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sessionloom.llm.shipping import give_back
from sessionloom.llm.token_ids import encoder, vocabulary_path

WINDOW = 2048
END_ID = 1
#: A shard is closed when it holds so many tokens or documents.
SHARD_TOKENS = 2_000_000
SHARD_DOCS = 4096
QUERY_TERMS = 24
#: BM25's usual constants.
K1, B = 1.2, 0.75
SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"


class _Index:
    """BM25 weights of the shard's terms: for each term its documents and their weights."""

    def __init__(self, docs: list[np.ndarray]) -> None:
        self.size = len(docs)
        terms, counts, sizes = [], [], []
        for ids in docs:
            held = np.sort(ids, kind="stable")
            first = np.flatnonzero(np.concatenate([[True], held[1:] != held[:-1]]))
            terms.append(held[first])
            counts.append(np.diff(np.append(first, len(held))))
            sizes.append(len(first))
        self.terms_of = terms
        term, tf = np.concatenate(terms), np.concatenate(counts).astype(np.float32)
        doc = np.repeat(np.arange(self.size, dtype=np.int32), sizes)
        df = self.df = np.bincount(term, minlength=1 << 16)
        self.idf = np.log1p((self.size - df + 0.5) / (df + 0.5)).astype(np.float32)
        lengths = np.array([len(ids) for ids in docs], np.float32)
        norm = K1 * (1 - B + B * lengths / lengths.mean())
        weight = self.idf[term] * tf * (K1 + 1) / (tf + norm[doc])
        order = np.argsort(term, kind="stable")
        self.docs, self.weights = doc[order], weight[order].astype(np.float32)
        self.starts = np.concatenate([[0], np.cumsum(df)])

    def neighbours(self, seed: int) -> np.ndarray:
        """Documents that share a term with the seed's rarest, best first."""
        terms = self.terms_of[seed]
        terms = terms[self.df[terms] > 1]  # a term of one document finds only the seed
        if len(terms) > QUERY_TERMS:
            terms = terms[np.argpartition(-self.idf[terms], QUERY_TERMS)[:QUERY_TERMS]]
        spans = [slice(self.starts[t], self.starts[t + 1]) for t in terms]
        if not spans:
            return np.empty(0, np.int64)
        scores = np.bincount(
            np.concatenate([self.docs[s] for s in spans]),
            np.concatenate([self.weights[s] for s in spans]),
            self.size,
        )
        return np.argsort(-scores, kind="stable")[: np.count_nonzero(scores)]


def _order(docs: list[np.ndarray], window: int) -> list[int]:
    """All documents, each followed by its unused neighbours as far as its last window reaches."""
    index = _Index(docs)
    unused = np.ones(len(docs), bool)
    order: list[int] = []
    filled, seed, fresh = 0, -1, 0
    while True:
        if seed < 0:
            while fresh < len(docs) and not unused[fresh]:
                fresh += 1
            if fresh == len(docs):
                return order
            seed = fresh
            unused[seed] = False
            order.append(seed)
            filled = (filled + len(docs[seed])) % window
        found = index.neighbours(seed)
        last = -1
        for near in found[unused[found]]:
            unused[near] = False
            order.append(int(near))
            filled += len(docs[near])
            if filled >= window:  # the rest of this document opens the next window
                filled %= window
                last = int(near)
                break
        seed = last


def _sequences(total: int, window: int) -> list[int]:
    """Lengths of the sequences: full windows, then powers of two."""
    rest = total % window
    return [window] * (total // window) + [1 << k for k in reversed(range(rest.bit_length())) if rest >> k & 1]


def _pieces(docs: list[np.ndarray], window: int):
    """(document, start, length, sequence, offset) of all pieces."""
    order = _order(docs, window)
    lengths = _sequences(sum(map(len, docs)), window)
    sequence, offset = 0, 0
    for doc in order:
        start, size = 0, len(docs[doc])
        while start < size:
            length = min(size - start, lengths[sequence] - offset)
            yield doc, start, length, sequence, offset
            start += length
            offset += length
            if offset == lengths[sequence]:
                sequence, offset = sequence + 1, 0


def pack(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    window: int = WINDOW,
    vocabulary: str | None = None,
    with_ids: bool = False,
) -> DataFrame:
    """One row per piece of a document; ``with_ids`` adds its ids as an array."""
    path = vocabulary or vocabulary_path()

    def packed(batches):
        ids_of = encoder(path).ids
        first = TaskContext.get().partitionId() << 32
        state = {"next": first}

        def close(names, shard):
            rows = list(_pieces(shard, window))
            doc, start, length, sequence, offset = (np.array(c, np.int64) for c in zip(*rows, strict=True))
            parts = [shard[d][s : s + n].astype("<u4") for d, s, n in zip(doc, start, length, strict=True)]
            columns = {
                "doc_id": pa.array([names[d] for d in doc], pa.int64()),
                "start": start,
                "length": length,
                "ids_crc32": pa.array([zlib.crc32(part.tobytes()) for part in parts], pa.int64()),
                "doc_tokens": np.array([len(shard[d]) for d in doc], np.int64),
                "sequence_id": sequence + state["next"],
                "offset": offset,
            }
            if with_ids:
                columns["ids"] = pa.array([part.astype(np.int32) for part in parts], pa.list_(pa.int32()))
            state["next"] += int(sequence[-1]) + 1
            return pa.RecordBatch.from_pydict(columns)

        names, shard, tokens = [], [], 0
        for batch in batches:
            for name, body in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                ids = np.frombuffer(ids_of(body.as_py() or "") + END_ID.to_bytes(2, "little"), np.uint16)
                names.append(name)
                shard.append(ids)
                tokens += len(ids)
                if tokens >= SHARD_TOKENS or len(shard) >= SHARD_DOCS:
                    yield close(names, shard)
                    names, shard, tokens = [], [], 0
        if shard:
            yield close(names, shard)
        del names, shard
        give_back()

    frame = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return frame.mapInArrow(packed, SCHEMA + (", ids array<int>" if with_ids else ""))

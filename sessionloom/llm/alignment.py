"""Two tokenizers' tokens of the same text, aligned, with corpus counts of the aligned pairs.

A is a byte-level BPE on a blank and the text, B a sentence-piece model, which adds that blank itself.
Where tokens of both end at the same byte the text is cut into groups; all pairs of an A and a B
token in a group are links.  The count of a pair of ids is the number of documents that link it.

Units.  Where all white space is single blanks and line feeds between words, neither tokenizer
joins anything across a blank, so both end a token there and a text's groups are those of its
words, each with the blank before it.  So a text is a sequence of units: its words, or the whole
text where it has other white space.  Distinct units are encoded and aligned once in a chunk.

Counting.
1. Tasks cut their documents into chunks of bounded text: the tokens of distinct units, the units of each
   document, and the distinct pairs with the number of the chunk's documents, by bucket of the pair's A id.
   Chunks are written once; texts are neither shuffled nor read again.
2. The lists of a bucket are united along a tree of ``FAN`` chunks a node; over its distinct pairs the bucket
   builds a minimal perfect hash function (``perfect_hash``) and keeps the pairs by number.
3. Every node of chunks turns its lists into one dense vector of counts, indexed by the hash, and the vectors
   are summed along the same tree.  As a bucket holds all pairs of its A ids, it knows each id's
   highest count.
4. The chunks' lists are answered by the buckets, each pair compared with the key kept under its
   number; the second pass over the documents aligns their tokens again and looks the counts up.

No group holds more than ``FAN`` lists, ``FAN`` vectors or a chunk, however often a pair or a document occurs; a
vector is as long as a bucket's distinct pairs, which the two vocabularies bound.

Defined results: null and empty texts, and texts whose joined A or B bytes differ from a blank and
the text (such as those with U+2581), have no tokens: zeros and an empty digest; repeated rows are
documents of their own; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import base64
import hashlib
import os
from itertools import chain
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sessionloom.llm.perfect_hash import PerfectHash
from sessionloom.llm.shipping import bound_batches, give_back, giving_back
from sessionloom.llm.token_ids import plain
from sessionloom.workspace import materialize, materialize_large_rows

#: A as the tokenizer's own file and as ranks, and B.
VOCABULARY_A, RANKS_A, VOCABULARY_B = "byte_bpe_50k.json", "byte_bpe_50k.tiktoken", "piece_bpe_32k.model"
#: Buckets of A ids; a bucket's pairs are all those of its ids.
BUCKETS = 256
#: Lists and vectors that meet in one group.
FAN = 64
#: A chunk is closed when its texts have so many characters.
CHUNK_CHARS = 2 << 20
EMPTY = np.empty(0, np.uint64)


def vocabulary_paths() -> tuple[str, str, str]:
    import public_tokenizers

    return tuple(map(public_tokenizers.path, (VOCABULARY_A, RANKS_A, VOCABULARY_B)))


def _byte_values() -> dict[str, int]:
    """The byte that each character of a byte-level vocabulary stands for: printable ones for
    themselves, the others in turn for the characters from 256 on."""
    kept = [b for span in (range(33, 127), range(161, 173), range(174, 256)) for b in span]
    others = [b for b in range(256) if b not in kept]
    return {chr(b): b for b in kept} | {chr(256 + k): b for k, b in enumerate(others)}


class Vocabularies:
    """Both tokenizers and the bytes of their tokens."""

    def __init__(self, path_a: str, ranks_a: str, path_b: str) -> None:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import public_tokenizers
        import sentencepiece
        import tiktoken
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(path_a)
        self._a.encode_special_tokens = True
        values, names = _byte_values(), self._a.get_vocab()
        self.bytes_a = [b""] * (max(names.values()) + 1)
        for name, i in names.items():
            if all(c in values for c in name):
                self.bytes_a[i] = bytes(values[c] for c in name)
        # The same vocabulary as ranks encodes many words at a time several times faster.
        with open(ranks_a, "rb") as lines:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        if any(self.bytes_a[i] != token for token, i in ranks.items()):
            raise ValueError("the ranks are not those of the vocabulary")
        self._fast_a = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
        self._b = sentencepiece.SentencePieceProcessor(model_file=path_b)
        self.bytes_b = [
            bytes([int(piece[3:5], 16)]) if self._b.is_byte(i) else piece.replace("\u2581", " ").encode()
            for i, piece in enumerate(map(self._b.id_to_piece, range(self._b.get_piece_size())))
        ]
        self.lengths_a, self.lengths_b = (np.array(list(map(len, x)), np.int64) for x in (self.bytes_a, self.bytes_b))
        numbers = list(map(str, range(max(len(self.bytes_a), len(self.bytes_b)))))
        #: Every id as text, after nothing, ``;``, ``,`` and ``|``.
        self.texts = np.array([mark + n for mark in ("", ";", ",", "|") for n in numbers], object)
        self.ids = len(numbers)

    def encode(self, units: list[str]) -> Tokens:
        """The tokens of units; one whose bytes differ from a blank and the unit has none."""
        wholes = [b" " + u.encode() for u in units]
        sizes = np.array(list(map(len, wholes)), np.int64)
        flat_a, n_a = self._encode_a(units, sizes)
        found_b = self._b.encode(units, num_threads=1) if units else []
        n_b = np.array(list(map(len, found_b)), np.int64)
        flat_b = np.fromiter(chain.from_iterable(found_b), np.int64, n_b.sum())
        good = np.ones(len(units), bool)
        for flat, n, lengths, tokens in ((flat_a, n_a, self.lengths_a, self.bytes_a), (flat_b, n_b, self.lengths_b, self.bytes_b)):
            good &= _sums(lengths[flat], n) == sizes
            if b"".join(map(tokens.__getitem__, flat.tolist())) != b"".join(wholes):
                ends = np.cumsum(n)
                for k in np.flatnonzero(good).tolist():
                    good[k] = b"".join([tokens[i] for i in flat[ends[k] - n[k] : ends[k]].tolist()]) == wholes[k]
        flat_a, flat_b = flat_a[np.repeat(good, n_a)], flat_b[np.repeat(good, n_b)]
        return Tokens(flat_a, np.where(good, n_a, 0), flat_b, np.where(good, n_b, 0))

    def _encode_a(self, units: list[str], sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        if units and all(map(plain, units)):
            flat = self._fast_a.encode_to_numpy(" " + " ".join(units), allowed_special=set(), disallowed_special=()).astype(np.int64)
            ends = np.cumsum(self.lengths_a[flat])
            cuts = np.searchsorted(ends, np.cumsum(sizes))
            if len(flat) and cuts[-1] == len(flat) - 1 and (ends[cuts] == np.cumsum(sizes)).all():
                return flat, np.diff(cuts, prepend=-1)
        found = [e.ids for e in self._a.encode_batch_fast([" " + u for u in units], add_special_tokens=False)]
        n = np.array(list(map(len, found)), np.int64)
        return np.fromiter(chain.from_iterable(found), np.int64, n.sum()), n


class Tokens(NamedTuple):
    """The tokens of units, one unit after the other, and how many each has."""

    a: np.ndarray
    n_a: np.ndarray
    b: np.ndarray
    n_b: np.ndarray


_vocabularies: dict[tuple[str, str, str], Vocabularies] = {}


def vocabularies(paths: tuple[str, str, str]) -> Vocabularies:
    if paths not in _vocabularies:
        _vocabularies[paths] = Vocabularies(*paths)
    return _vocabularies[paths]


def _sums(values: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Sums of consecutive runs of values."""
    running, ends = np.concatenate([[0], np.cumsum(values)]), np.cumsum(sizes)
    return running[ends] - running[ends - sizes]


def _expanded(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every run, one after the other."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) - np.repeat(ends - sizes - starts, sizes)


class Alignment:
    """Groups and links of all units of a chunk."""

    def __init__(self, tokens: Tokens, names: Vocabularies) -> None:
        self._tokens, self._names = tokens, names
        ends_a, ends_b = np.cumsum(names.lengths_a[tokens.a]), np.cumsum(names.lengths_b[tokens.b])
        at = np.searchsorted(ends_b, ends_a)
        cut_a = np.flatnonzero(ends_b[at] == ends_a) if len(ends_a) else np.empty(0, np.int64)
        cut_b = at[cut_a]
        self._in_a, self._in_b = np.diff(cut_a, prepend=-1), np.diff(cut_b, prepend=-1)
        unit = np.repeat(np.arange(len(tokens.n_a)), tokens.n_a)[cut_a]
        self.n_groups = np.bincount(unit, minlength=len(tokens.n_a))
        links = self._in_a * self._in_b
        self.n_links = np.bincount(unit, links, minlength=len(tokens.n_a)).astype(np.int64)
        group = np.repeat(np.arange(len(links)), links)
        k = np.arange(len(group)) - np.repeat(np.cumsum(links) - links, links)
        first_a, first_b = cut_a + 1 - self._in_a, cut_b + 1 - self._in_b
        i, j = first_a[group] + k // self._in_b[group], first_b[group] + k % self._in_b[group]
        #: One key for every link, unit by unit.
        self.pairs = tokens.a[i].astype(np.uint64) << np.uint64(32) | tokens.b[j].astype(np.uint64)

    def texts(self) -> list[str]:
        """``a1,a2|b1;a3|b2,b3`` of each unit."""
        a, n_a, b, n_b = self._tokens
        starts_a, starts_b = np.zeros(len(a), bool), np.zeros(len(b), bool)
        starts_a[np.cumsum(self._in_a) - self._in_a] = True
        starts_b[np.cumsum(self._in_b) - self._in_b] = True
        opens = np.zeros(len(a), bool)
        opens[(np.cumsum(n_a) - n_a)[n_a > 0]] = True
        out = np.empty(len(a) + len(b), object)
        before_b = np.cumsum(self._in_b) - self._in_b
        ids = self._names.ids
        mark = np.where(opens, 0, np.where(starts_a, 1, 2))
        out[np.arange(len(a)) + np.repeat(before_b, self._in_a)] = self._names.texts[mark * ids + a]
        mark = np.where(starts_b, 3, 2)
        out[np.arange(len(b)) + np.repeat(np.cumsum(self._in_a), self._in_b)] = self._names.texts[mark * ids + b]
        parts, ends = out.tolist(), np.cumsum(n_a + n_b).tolist()
        return ["".join(parts[start:end]) for start, end in zip([0, *ends], ends)]


def _units(texts: list[str | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """Distinct units, the units of all texts in turn as indices into them, and how many each text has."""
    rows = [text.split(" ") if text and plain(text) else [text] if text else [] for text in texts]
    index = {word: k for k, word in enumerate(dict.fromkeys(chain.from_iterable(rows)))}
    sizes = np.array(list(map(len, rows)), np.int64)
    flat = np.fromiter(map(index.__getitem__, chain.from_iterable(rows)), np.int64, sizes.sum())
    return list(index), flat, sizes


def _distinct_pairs(aligned: Alignment, flat: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct keys, and how many texts have each."""
    lengths = aligned.n_links
    if not len(aligned.pairs):
        return EMPTY, np.empty(0, np.int64)
    keys, number = np.unique(aligned.pairs, return_inverse=True)
    text = np.repeat(np.arange(len(sizes)), sizes)
    text, unit = np.divmod(np.unique(text * np.int64(len(lengths)) + flat), len(lengths))
    pairs = number[_expanded((np.cumsum(lengths) - lengths)[unit], lengths[unit])]
    both = np.unique(np.repeat(text, lengths[unit]) * np.int64(len(keys)) + pairs)
    return keys, np.bincount(both % len(keys), minlength=len(keys))


def _bucket_of(keys: np.ndarray) -> np.ndarray:
    return ((keys >> np.uint64(32)) % np.uint64(BUCKETS)).astype(np.int64)


def _packed(values: np.ndarray) -> bytes:
    """Whole numbers from 0 on in as few bytes each as the largest needs; the first byte says how many."""
    kind = np.min_scalar_type(int(values.max(initial=0)))
    return bytes([kind.itemsize]) + values.astype(kind).tobytes()


def _unpacked(value: bytes | pa.Scalar, kind: type = np.int64) -> np.ndarray:
    value = value if isinstance(value, bytes) else value.as_py()
    return np.frombuffer(value, np.dtype(f"<u{value[0]}"), offset=1).astype(kind)


def _array(value: bytes | pa.Scalar, kind: type) -> np.ndarray:
    return np.frombuffer(value if isinstance(value, bytes) else value.as_py(), kind)


def _tree(parts: DataFrame, count: int, group, schema: str, last=None, last_schema: str | None = None) -> DataFrame:
    """Merges the rows of a bucket, ``FAN`` neighbouring nodes at a time, until each bucket has one.

    ``last`` takes the place of ``group`` in the last step.
    """
    while True:
        count = -(-count // FAN)
        parts = parts.withColumn("node", F.floor(F.col("node") / FAN).cast("int"))
        if count == 1:
            return parts.groupBy("bucket", "node").applyInArrow(last or group, last_schema or schema)
        parts = materialize(parts.groupBy("bucket", "node").applyInArrow(group, schema), "tree")


def _row(table: pa.Table, **columns) -> pa.Table:
    return pa.table({"bucket": table["bucket"][:1], "node": table["node"][:1]} | columns)


def _united(table: pa.Table) -> np.ndarray:
    return np.unique(np.concatenate([_array(k, np.uint64) for k in table["keys"]]))


def pair_tables(lists: DataFrame, count: int) -> DataFrame:
    """(bucket, sizes, bits, keys, counts, highest) from the chunks' lists (bucket, parcel, keys, docs).

    ``keys``, ``counts`` and ``highest`` (the highest count of the key's A id) stand in the order of
    the perfect hash given by ``sizes`` and ``bits``.  ``parcel`` numbers the chunks from 0, ``count`` is their number.
    """

    def union(table: pa.Table) -> pa.Table:
        return _row(table, keys=pa.array([_united(table).tobytes()], pa.binary()))

    def hashed(table: pa.Table) -> pa.Table:
        keys = _united(table)
        function = PerfectHash.of(keys)
        at = np.empty(len(keys), np.uint64)
        at[function.numbers(keys)] = keys
        return pa.table({
            "bucket": table["bucket"][:1], "sizes": pa.array([function.sizes], pa.list_(pa.int64())),
            "bits": pa.array([function.bits], pa.binary()), "keys": pa.array([at.tobytes()], pa.binary()),
        })

    lists = lists.withColumn("node", F.col("parcel"))
    # The hash is built where the last lists meet: a second Python step in these tasks would double the workers,
    # and later stages load the vocabularies into each of them.
    functions = _tree(
        lists.select("bucket", "node", "keys"), count, union, "bucket int, node int, keys binary",
        hashed, "bucket int, sizes array<long>, bits binary, keys binary",
    )
    functions = materialize(functions, "functions")

    def dense(key, left: pa.Table, right: pa.Table) -> pa.Table:
        if not len(left):
            return _row(right, counts=pa.array([None], pa.binary())).slice(0, 0)
        function = PerfectHash(right["sizes"][0].as_py(), right["bits"][0].as_py())
        kept, counts = _array(right["keys"][0], np.uint64), np.zeros(len(function), np.int64)
        for keys, docs in zip(left["keys"], left["docs"], strict=True):
            counts[_verified(function, kept, _array(keys, np.uint64))] += _unpacked(docs)
        return _row(left, counts=pa.array([counts.tobytes()], pa.binary()))

    def added(table: pa.Table) -> pa.Table:
        return _row(table, counts=pa.array([sum(_array(c, np.int64) for c in table["counts"]).tobytes()], pa.binary()))

    of_nodes, by = _by_nodes(lists, functions, count)
    vectors = of_nodes.cogroup(by).applyInArrow(dense, "bucket int, node int, counts binary")
    summed = _tree(vectors, -(-count // FAN), added, "bucket int, node int, counts binary")

    def topped(batches):
        for batch in batches:
            out = []
            for keys, counts in zip(batch["keys"], batch["counts"], strict=True):
                a, n = _array(keys, np.uint64) >> np.uint64(32), _array(counts, np.int64)
                ids, which = np.unique(a, return_inverse=True)
                most = np.zeros(len(ids), np.int64)
                np.maximum.at(most, which, n)
                out.append(most[which].tobytes())
            columns = {name: batch[name] for name in ("bucket", "sizes", "bits", "keys", "counts")}
            yield pa.RecordBatch.from_pydict(columns | {"highest": pa.array(out, pa.binary())})

    schema = "bucket int, sizes array<long>, bits binary, keys binary, counts binary"
    complete = functions.join(summed.drop("node"), "bucket").select("bucket", "sizes", "bits", "keys", "counts")
    return materialize(complete.mapInArrow(topped, schema + ", highest binary"), "pair-tables")


def _verified(function: PerfectHash, kept: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """The numbers of keys that are all in the set."""
    numbers = function.numbers(keys)
    if len(keys) and (numbers.min() < 0 or (kept[numbers] != keys).any()):
        raise ValueError("a pair is not among those that were counted")
    return numbers


def _by_nodes(lists: DataFrame, tables: DataFrame, count: int):
    """Lists in groups of ``FAN`` chunks, and the bucket's table for each group."""
    nodes = F.floor(F.col("parcel") / FAN).cast("int")
    left = lists.withColumn("node", nodes).groupBy("bucket", "node")
    last = F.lit((count - 1) // FAN)
    right = tables.select(
        *[F.col(name).alias(name) for name in tables.columns], F.explode(F.sequence(F.lit(0), last)).alias("node")
    )
    return left, right.groupBy("bucket", "node")


_CHUNK = "chunk long, doc_ids array<long>, a binary, n_a binary, b binary, n_b binary, units binary, sizes binary"
_LISTS = "lists array<struct<bucket: int, keys: binary, docs: binary>>"


def _chunk(number: int, names: list, texts: list[str | None], known: Vocabularies) -> pa.RecordBatch:
    units, flat, sizes = _units(texts)
    tokens = known.encode(units)
    # A text with a unit without tokens has none.
    void = _sums((tokens.n_a == 0)[flat], sizes) > 0
    flat, sizes = flat[~np.repeat(void, sizes)], np.where(void, 0, sizes)
    keys, docs = _distinct_pairs(Alignment(tokens, known), flat, sizes)
    docs, keys = docs[docs > 0], keys[docs > 0]
    bucket = _bucket_of(keys)
    order = np.argsort(bucket, kind="stable")
    keys, docs, bucket = keys[order], docs[order].astype(np.int64), bucket[order]
    used, starts = np.unique(bucket, return_index=True)
    lists = [
        {"bucket": k, "keys": keys[i:j].tobytes(), "docs": _packed(docs[i:j])}
        for k, i, j in zip(used.tolist(), starts, np.append(starts, len(keys))[1:], strict=True)
    ]
    packed = {"a": tokens.a, "n_a": tokens.n_a, "b": tokens.b, "n_b": tokens.n_b, "units": flat, "sizes": sizes}
    struct = pa.struct([("bucket", pa.int32()), ("keys", pa.binary()), ("docs", pa.binary())])
    return pa.RecordBatch.from_pydict(
        {"chunk": pa.array([number], pa.int64()), "doc_ids": pa.array([names], pa.list_(pa.int64()))}
        | {name: pa.array([_packed(values)], pa.binary()) for name, values in packed.items()}
        | {"lists": pa.array([lists], pa.list_(struct))}
    )


def align(
    docs: DataFrame,
    doc_id: str = "doc_id",
    text: str = "text",
    paths: tuple[str, str, str] | None = None,
    with_groups: bool = True,
) -> tuple[DataFrame, DataFrame]:
    """The aligned documents, and the tables of all pairs.

    Documents: doc_id, n_a, n_b, n_groups, n_links, n_best (links whose count is their A id's highest), count_sum (over links),
    groups (``a1,a2|b1;a3|b2,b3``, where wanted) and groups_sha256.  For the tables see ``pair_tables``; ``pair_counts`` gives them as rows.
    """
    paths = paths or vocabulary_paths()
    bound_batches(docs.sparkSession)

    def chunked(batches):
        known = vocabularies(paths)
        number = TaskContext.get().partitionId() << 32
        names, texts, chars = [], [], 0
        for batch in batches:
            for name, body in zip(batch["doc_id"].to_pylist(), batch["text"], strict=True):
                names.append(name)
                texts.append(body.as_py())
                chars += len(texts[-1] or "")
                if chars >= CHUNK_CHARS:
                    yield _chunk(number, names, texts, known)
                    number, names, texts, chars = number + 1, [], [], 0
        if names:
            yield _chunk(number, names, texts, known)
        # The workers wait while chunks are shuffled.
        give_back()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    chunks = materialize_large_rows(rows.mapInArrow(chunked, f"{_CHUNK}, {_LISTS}"), "chunks")
    # Chunks in the order of their numbers, from 0, so that neighbours meet in a node.
    per_task = chunks.groupBy(F.shiftright("chunk", 32).alias("task")).agg(F.count("*").alias("k"))
    before = Window.orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    places = per_task.select("task", F.coalesce(F.sum("k").over(before), F.lit(0)).alias("first"), "k")
    places = materialize(places, "places")
    count = places.agg(F.sum("k")).first()[0] or 1
    listed = chunks.select(F.shiftright("chunk", 32).alias("task"), "chunk", F.explode("lists").alias("list"))
    lists = listed.join(places, "task").select(
        "list.*", "chunk", (F.col("first") + F.col("chunk").bitwiseAND((1 << 32) - 1)).cast("int").alias("parcel")
    )
    lists = materialize(lists, "pairs")
    tables = pair_tables(lists, count)

    def answered(key, left: pa.Table, right: pa.Table) -> pa.Table:
        columns = {"chunk": [], "keys": [], "counts": [], "best": []}
        if len(left):
            function = PerfectHash(right["sizes"][0].as_py(), right["bits"][0].as_py())
            kept, counts, highest = (_array(right[c][0], k) for c, k in (("keys", np.uint64), ("counts", np.int64), ("highest", np.int64)))
            for chunk, value in zip(left["chunk"].to_pylist(), left["keys"], strict=True):
                keys = _array(value, np.uint64)
                at = _verified(function, kept, keys)
                columns["chunk"].append(chunk)
                columns["keys"].append(keys.tobytes())
                columns["counts"].append(counts[at].tobytes())
                columns["best"].append((counts[at] == highest[at]).tobytes())
        kinds = {"chunk": pa.int64(), "keys": pa.binary(), "counts": pa.binary(), "best": pa.binary()}
        return pa.table({name: pa.array(values, kinds[name]) for name, values in columns.items()})

    of_nodes, by = _by_nodes(lists, tables, count)
    answers = of_nodes.cogroup(by).applyInArrow(answered, "chunk long, keys binary, counts binary, best binary")

    def measured(table: pa.Table, replies: pa.Table) -> pa.Table:
        known = vocabularies(paths)
        (row,) = table.to_pylist()
        a, n_a, b, n_b, flat, sizes = (_unpacked(row[name]) for name in ("a", "n_a", "b", "n_b", "units", "sizes"))
        aligned = Alignment(Tokens(a, n_a, b, n_b), known)
        keys, counts, best = (
            np.concatenate([np.empty(0, kind), *[_array(v, kind) for v in replies[name]]])
            for name, kind in (("keys", np.uint64), ("counts", np.int64), ("best", bool))
        )
        order = np.argsort(keys)
        keys, counts, best = keys[order], counts[order], best[order]
        # Units of documents without tokens have pairs that were not asked for.
        at = np.minimum(np.searchsorted(keys, aligned.pairs), max(len(keys) - 1, 0))
        asked = keys[at] == aligned.pairs if len(keys) else np.zeros(len(aligned.pairs), bool)
        at = at[asked]
        sums, tops = np.zeros(len(asked), np.int64), np.zeros(len(asked), np.int64)
        sums[asked], tops[asked] = counts[at], best[at]

        def per_text(values: np.ndarray) -> pa.Array:
            return pa.array(_sums(values[flat], sizes), pa.int64())

        names, ends = aligned.texts(), np.cumsum(sizes)
        texts = [";".join([names[k] for k in flat[end - n : end].tolist()]) for end, n in zip(ends, sizes, strict=True)]
        out = pa.table({
            "doc_id": pa.array(row["doc_ids"], pa.int64()),
            "n_a": per_text(n_a),
            "n_b": per_text(n_b),
            "n_groups": per_text(aligned.n_groups),
            "n_links": per_text(aligned.n_links),
            "n_best": per_text(_sums(tops, aligned.n_links)),
            "count_sum": per_text(_sums(sums, aligned.n_links)),
            "groups_sha256": pa.array([hashlib.sha256(t.encode()).hexdigest() if t else "" for t in texts], pa.string()),
        })
        return out.append_column("groups", pa.array(texts, pa.string())) if with_groups else out

    whole = chunks.drop("lists")
    schema = "doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string"
    aligned = whole.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(
        lambda table, replies: giving_back(measured, table, replies), schema + (", groups string" if with_groups else "")
    )
    return aligned, tables


def pair_counts(tables: DataFrame) -> DataFrame:
    """(id_a, id_b, n_docs) of every pair that is linked anywhere."""

    def rows(batches):
        for batch in batches:
            for keys, counts in zip(batch["keys"], batch["counts"], strict=True):
                pairs = _array(keys, np.uint64)
                yield pa.RecordBatch.from_pydict({
                    "id_a": pa.array((pairs >> np.uint64(32)).astype(np.int64)),
                    "id_b": pa.array((pairs & np.uint64(0xFFFFFFFF)).astype(np.int64)),
                    "n_docs": pa.array(_array(counts, np.int64)),
                })

    return tables.select("keys", "counts").mapInArrow(rows, "id_a long, id_b long, n_docs long")

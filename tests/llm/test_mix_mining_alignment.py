"""Source mix, hard negatives and tokenizer alignment against plain versions, and on edge cases."""

import hashlib
import random
from bisect import bisect_left
from collections import Counter, defaultdict
from fractions import Fraction
from itertools import accumulate

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from helpers_llm import prose
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from sessionloom.llm import alignment, hard_negatives, source_mix
from sessionloom.llm.perfect_hash import PerfectHash
from sessionloom.workspace import materialize

# ---- source mix ------------------------------------------------------------------------


def shared_by_hand(sizes):
    """Targets by literal resharing; ``sizes`` in the order of sources."""
    weights = [source_mix.WEIGHTS[k % 3] for k in range(len(sizes))]
    total, capped = Fraction(3, 2) * sum(sizes), set()
    while True:
        left = total - sum(2 * sizes[k] for k in capped)
        open_ = [k for k in range(len(sizes)) if k not in capped]
        even = {k: left * weights[k] / sum(weights[j] for j in open_) for k in open_}
        above = {k for k in open_ if even[k] > 2 * sizes[k]}
        if not above:
            return [Fraction(2 * sizes[k]) if k in capped else even[k] for k in range(len(sizes))]
        capped |= above


@pytest.fixture
def sourced(spark):
    rows, rng = [], random.Random(4)
    for k in range(300):
        source = rng.choice(["a", "a", "a", "a", "B", "ä", "z", "ü", None, ""])
        rows.append((k, prose(k + 2, rng.choice([1, 5, 40, 400])), source))
    rows += [(k, t, "rare") for k, t in ((900, "one"), (901, None), (902, ""), (902, " \n"), (None, "two words"))]
    rows += [(903, "same words", "a")] * 3 + [(904, None, "void")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, source string")
    return materialize(frame.selectExpr("*", "1 AS size", "'x' AS target", "0 AS place", "'y' AS row"), "sourced"), rows


def test_mix_takes_the_targets(spark, sourced):
    docs, rows = sourced
    pieces, mixed = source_mix.mix(docs)
    found = mixed.collect()
    assert Counter(r.doc_id for r in found) == Counter(r[0] for r in rows)
    by_source = defaultdict(list)
    for r in found:
        by_source[r.source].append(r)
    names = sorted((s for s in by_source if s is not None), key=lambda s: s.encode()) + [None]
    sizes = [sum(r.size for r in by_source[s]) for s in names]
    for name, size, target in zip(names, sizes, shared_by_hand(sizes), strict=True):
        assert {r.source_size for r in by_source[name]} == {size}
        assert all(abs(r.target - float(target)) < 1e-6 * max(1, target) for r in by_source[name])
        assert abs(sum(r.taken for r in by_source[name]) - target) < 1
    assert all(0 <= r.taken <= 2 * r.size for r in found)
    text_of = Counter((r[0], r[2]) for r in rows)
    assert text_of == Counter((r.doc_id, r.source) for r in found)


def test_mix_is_a_schedule(spark, sourced):
    docs, _ = sourced
    pieces, mixed = source_mix.mix(docs, block=16)
    rows = pieces.collect()
    target = {r.source: r.target for r in mixed.select("source", "target").distinct().collect()}
    blocks = defaultdict(int)
    for r in rows:
        assert 0 < r.length <= 16
        blocks[r.source, r.block] += r.length
    # Blocks are whole but the last, and each stands in one slot.
    for (source, k), n in blocks.items():
        assert n == 16 or k == max(b for s, b in blocks if s == source)
    slot_of = {(r.source, r.block): r.slot for r in rows}
    assert all(slot_of[r.source, r.block] == r.slot for r in rows)
    # Any stretch of slots holds every source in proportion.
    share = {s: t / sum(target.values()) for s, t in target.items()}
    slots = sorted((slot, s) for (s, _), slot in slot_of.items())
    for first in range(0, len(slots) - 200, 97):
        run = Counter(s for _, s in slots[first : first + 200])
        assert all(abs(run[s] - 200 * share[s]) < 12 for s in share)


def test_mix_again_and_in_other_partitions_is_the_same(spark, sourced):
    docs, _ = sourced
    first = source_mix.mix(docs)[1].drop("row").collect()
    again = source_mix.mix(materialize(docs.repartition(7, "text"), "dealt"))[1].drop("row").collect()
    assert Counter(first) == Counter(again)


def test_mix_of_nothing(spark, sourced):
    docs, _ = sourced
    pieces, mixed = source_mix.mix(docs.where("false"))
    assert pieces.count() == 0 and mixed.count() == 0
    pieces, mixed = source_mix.mix(docs.withColumn("text", F.lit(" ")))
    assert pieces.count() == 0 and {(r.target, r.taken) for r in mixed.collect()} == {(0.0, 0)}


def test_word_count(spark):
    texts = [None, "", " ", "a", " a  b\t\nc\x0bd\x0ce\rf ", "a\xa0b c"]
    frame = spark.createDataFrame([(t,) for t in texts], "text string")
    assert [r[0] for r in frame.select(source_mix.word_count(F.col("text"))).collect()] == [0, 0, 0, 1, 6, 2]


# ---- hard negatives --------------------------------------------------------------------


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 7, 9), (33, 65, 100), (128, 64, 300), (17, 17, 17), (100, 1, 50)])
def test_strassen_equals_the_product(shape):
    r, s, t = shape
    rng = np.random.default_rng(r)
    a, b = rng.integers(-(10**6), 10**6, (r, s)), rng.integers(-(10**6), 10**6, (s, t))
    assert (hard_negatives.strassen(a, b) == a @ b).all()
    big = a.astype(object) * 10**20
    assert (hard_negatives.strassen(big, b.astype(object)) == big @ b.astype(object)).all()


def mined_by_hand(rows):
    def ok(v):
        return v is not None and all(x is not None and np.isfinite(x) for x in v)

    rows = [(i, v, y) for i, v, y in rows if y is not None and ok(v)]
    rows = [(i, [int(np.floor(256 * float(x))) for x in v], (y + 1) % 10 if i is not None and i % 7 == 0 else y) for i, v, y in rows]
    out = Counter()
    for at, (i, v, y) in enumerate(rows):
        if i is None or i % 100:
            continue
        scores = [(sum(a * b for a, b in zip(v, w)), 10**9 if j is None else j, k) for k, (j, w, _) in enumerate(rows) if k != at]
        scores.sort(key=lambda s: (-s[0], s[1]))
        for p, pid, _ in [s for s in scores if rows[s[2]][2] == y][:5]:
            window = [s for s in scores if rows[s[2]][2] != y and 80 * p <= 100 * s[0] <= 100 * p][:5]
            for rank, (n, nid, _) in enumerate(window, 1):
                out[i, pid, rank, nid, p, n] += 1
    return out


def mined(frame):
    i = F.col("vec_id")
    found = hard_negatives.mine(
        materialize(frame, "vectors"), is_anchor=i % 100 == 0,
        label_of=F.when(i % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")),
    )
    columns = ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return Counter(tuple(r[c] if r[c] is not None else 10**9 for c in columns) for r in found.collect())


SCHEMA = "vec_id long, embedding array<float>, label int"


def test_mined_as_by_hand(spark, monkeypatch):
    monkeypatch.setattr(hard_negatives, "ANCHOR_TILE", 2)
    monkeypatch.setattr(hard_negatives, "LEAST_TILE", 16)
    rng = np.random.default_rng(5)
    near = rng.normal(0, 0.2, 24)
    rows = [(k * 20, (near + rng.normal(0, 0.08, 24)).astype(np.float32).tolist(), int(rng.integers(0, 3))) for k in range(150)]
    common = near.astype(np.float32).tolist()
    # A third of all rows are one vector, under two labels; some rows are broken, short or double.
    rows += [(5000 + k, common, k % 2) for k in range(80)] + [(200, common, 1), (200, common, 1), (None, common, 0), (None, common, 2)]
    rows += [(300, None, 1), (400, [float("nan")] * 24, 1), (600, [None] * 24, 0), (700, common, None), (800, [float("inf")] * 24, 2)]
    rows += [(900, common[:7], 0), (1000, [], 1), (1001, common[:7], 1)]
    frame = spark.createDataFrame(rows, SCHEMA)
    assert mined(frame.selectExpr("*", "'x' AS row", "1 AS score", "2 AS a", "3 AS c")) == mined_by_hand(rows)


def test_mined_scores_beyond_64_bits(spark):
    rows = [(100, [1e18, 2.0], 1), (101, [1e18, 1.0], 1), (102, [9e17, 1.0], 2), (103, [0.5, 0.5], 1)]
    found = hard_negatives.mine(spark.createDataFrame(rows, SCHEMA), F.col("vec_id") == 100).collect()
    assert sorted((r.positive_id, r.negative_id, r.positive_score) for r in found) == [
        (101, 102, (1 << 63) - 1), (103, 102, (1 << 63) - 1),
    ]  # both beyond, so nearest to each other


def test_nothing_to_mine(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert mined(empty) == Counter()
    assert mined(spark.createDataFrame([(1, [0.5], 1), (2, [0.5], 2)], SCHEMA)) == Counter()
    assert mined(spark.createDataFrame([(100, [0.5], 1)], SCHEMA)) == Counter()


# ---- alignment -------------------------------------------------------------------------


def test_perfect_hash_is_minimal_and_perfect():
    for n in (0, 1, 2, 1000, 50_000):
        keys = np.unique(np.random.default_rng(n).integers(0, 1 << 47, n, dtype=np.uint64))
        built = PerfectHash.of(keys)
        again = PerfectHash(built.sizes, built.bits)
        assert len(again) == len(keys)
        assert sorted(again.numbers(keys)) == list(range(len(keys)))


def aligned_by_hand(texts):
    """(columns of each text, documents of each pair) from the tokenizers directly."""
    a_model = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    a_model.encode_special_tokens = True
    b_model = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))
    byte_of = alignment._byte_values()
    assert sorted(byte_of.values()) == list(range(256))
    rows = []
    for text in texts:
        whole = b" " + (text or "").encode()
        a, b = a_model.encode(" " + (text or ""), add_special_tokens=False).ids, b_model.encode(text or "")
        bytes_a = [bytes(byte_of[c] for c in a_model.id_to_token(i)) for i in a]
        pieces = [(i, b_model.id_to_piece(i)) for i in b]
        bytes_b = [bytes([int(p[3:5], 16)]) if b_model.is_byte(i) else p.replace("▁", " ").encode() for i, p in pieces]
        if not text or b"".join(bytes_a) != whole or b"".join(bytes_b) != whole:
            rows.append(([], [], []))
            continue
        ends_a, ends_b = list(accumulate(map(len, bytes_a))), list(accumulate(map(len, bytes_b)))
        groups = {cut: ([], []) for cut in sorted(set(ends_a) & set(ends_b))}
        cuts = list(groups)
        for side, ids, ends in ((0, a, ends_a), (1, b, ends_b)):
            for i, end in zip(ids, ends):
                groups[cuts[bisect_left(cuts, end)]][side].append(i)
        groups = list(groups.values())
        rows.append((a, b, groups))
    docs = Counter()
    for _, _, groups in rows:
        docs.update({(x, y) for g, h in groups for x in g for y in h})
    highest = defaultdict(int)
    for (x, _), n in docs.items():
        highest[x] = max(highest[x], n)
    out = []
    for a, b, groups in rows:
        links = [(x, y) for g, h in groups for x in g for y in h]
        joined = ";".join(f"{','.join(map(str, g))}|{','.join(map(str, h))}" for g, h in groups)
        best = sum(docs[link] == highest[link[0]] for link in links)
        digest = hashlib.sha256(joined.encode()).hexdigest() if joined else ""
        out.append((len(a), len(b), len(groups), len(links), best, sum(docs[link] for link in links), digest))
    return out, docs


COLUMNS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
PARTS = ["a", "the", "The", "don't", " ", "  ", "\n", "\n\n", "\t", "é", "①", "▁", "<|endoftext|>", "<s>", "日本", "🙂", "\xa0",
         "x1", "123", "...", "!!", "-", "\x1c", "\x00", "ﬁ", "é", "́", "\r", "word", " word", " word\nword"]


@pytest.mark.parametrize("fan", [2, 64])
def test_aligned_as_by_hand(spark, monkeypatch, fan):
    monkeypatch.setattr(alignment, "FAN", fan)
    rng = random.Random(2)
    texts = ["".join(rng.choice(PARTS) for _ in range(rng.randint(0, 14))) for _ in range(800)]
    texts += [None, "", "", prose(3), prose(3), prose(3, 20_000), *[prose(k) for k in range(40)]]
    rows = [(k if k % 9 else None, t, "x", -1, "y") for k, t in enumerate(texts)]
    docs = materialize(spark.createDataFrame(rows, "doc_id long, text string, row string, parcel int, bucket string"), "texts")
    aligned, tables = alignment.align(docs)
    expected, pairs = aligned_by_hand(texts)
    found = Counter((r.doc_id, *(r[c] for c in COLUMNS)) for r in aligned.collect())
    assert found == Counter((r[0], *e) for r, e in zip(rows, expected))
    assert {(r.id_a, r.id_b): r.n_docs for r in alignment.pair_counts(tables).collect()} == dict(pairs)


def test_alignment_of_nothing(spark):
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert alignment.align(empty)[0].count() == 0
    void = spark.createDataFrame([(1, None), (2, ""), (3, "a▁b")], "doc_id long, text string")
    assert [tuple(r[c] for c in COLUMNS) for r in alignment.align(void)[0].collect()] == [(0, 0, 0, 0, 0, 0, "")] * 3

"""Classes of near duplicates against all pairs, on families built to be hard for an index."""

import random
import re

import pytest

from sessionloom.llm import jaccard_join
from sessionloom.workspace import materialize

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text):
    words = WORD.findall((text or "").translate(LOWER))
    if not words:
        return set()
    return {tuple(words[k : k + 4]) for k in range(max(1, len(words) - 3))}


def classes_by_hand(rows):
    sets = [shingles(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(k):
        while parent[k] != k:
            k = parent[k]
        return k

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if sets[i] and sets[j] and 100 * both >= 85 * (len(sets[i]) + len(sets[j]) - both):
                parent[root(i)] = root(j)
    smallest = {}
    for k, (name, _) in enumerate(rows):
        smallest[root(k)] = min(name, smallest.get(root(k), name))
    return {name: (len(sets[k]), smallest[root(k)]) for k, (name, _) in enumerate(rows)}


def chains(first, base, others):
    """Four texts that link as a chain only, and nine that hold the chain's base in part and lead its lists."""
    words = [f"{base}w{k}" for k in range(1003)]
    rest = [f"{base}r{k}" for k in range(878)]

    def without(start, end, mark):  # replaces the shingles start to end - 1
        return " ".join(words[:start] + [f"{base}{mark}{k}" for k in range(start, end + 3)] + words[end + 3 :])

    rows = [(first + k, " ".join(rest + [f"{base}o{k}x{j}" for j in range(125)])) for k in range(8)]
    rows.append((first + 8, " ".join(words[:125] + rest)))
    spans = {"c": (0, 60), "a": (20, 80), "b": (40, 100), "t": (60, 120)}
    return rows + [(first + 9 + k, without(*span, mark)) for k, (mark, span) in enumerate(spans.items())]


def family(rng, first, size):
    """Copies of one short text, each with some words replaced, so many pairs are close to the threshold."""
    base = [f"f{first}w{k}" for k in range(rng.choice([12, 30, 60, 120]))]
    rows = []
    for k in range(size):
        words = list(base)
        for _ in range(rng.choice([0, 1, 1, 2, 2, 3])):
            at = rng.randrange(len(words))
            words[at] = rng.choice([f"e{k}", "edit", words[at - 1]])
        rows.append((first + k, " ".join(words[: rng.choice([len(words), len(words) - 1])])))
    return rows


@pytest.mark.parametrize(("rounds", "slice_"), [(2, 4096), (1, 3)])
def test_classes_equal_all_pairs(spark, monkeypatch, rounds, slice_):
    monkeypatch.setattr(jaccard_join, "ROUNDS", rounds)
    monkeypatch.setattr(jaccard_join, "SLICE", slice_)
    rng = random.Random(7)
    rows = [r for k in range(6) for r in chains(1000 * k + 20 * (k % 3), f"k{k}", None)]
    rows += [r for k in range(10) for r in family(rng, 100_000 + 100 * k, 60)]
    names = [i for i, _ in rows]
    rng.shuffle(names)  # ids say nothing about the order of rows
    rows = list(zip(names, (t for _, t in rows)))
    docs = materialize(spark.createDataFrame(rows, "doc_id long, text string"), "families")
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(docs).collect()}
    assert found == classes_by_hand(rows)
    assert jaccard_join.one_of_each_class(docs).count() == len({c for _, c in found.values()})

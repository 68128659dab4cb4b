"""Toxicity of whole texts from a lexicon, its misspellings, and their context.

Learning, from labelled rows outside the held-out fold only, on a bounded sample of them
(``SAMPLE_ROWS``): word beginnings that are found almost only in toxic texts become the lexicon's
stems.  The stems form a trie; a Levenshtein automaton of one edit runs over it, both joined into
one deterministic automaton that is built as words ask for its states, so a word costs a few
steps.  A word that begins with a stem is a term, one that does so with an edit (not in its first
or last letter, which would be another word) a misspelled term.

Scoring: every term is looked at in a window of words around it.  Inside quotation marks or a
quoted line it is quotation, elsewhere abuse.  Counts of both, and their density, go through a
logistic regression trained on the same sample.

Labels, language, source and ids are never inputs.  The model is a few stems and weights in the
tasks' closure.

Defined results: null, empty and blank texts have no terms and get the score of such a text; equal
rows get equal scores; an empty table gives no rows; with no labelled row of either kind all scores
are the share of toxic labels, or 0 without labels; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SAMPLE_ROWS = 8000
LEAST_TOXIC_ROWS = 12
LEAST_PURITY = 0.9
SHORTEST, LONGEST = 4, 10
#: A shorter stem with an edit is too often another word.
EDITED_FROM = 5
WINDOW = 12
CACHED_WORDS = 200_000
FEATURES = 6
_LETTERS = re.compile(r"[^\W\d_]+")
_OPEN, _CLOSE = "\"“«„‘", "\"”»“’"


def held_out(doc_id: Column) -> Column:
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit(""))) % 5 == 0


class Automaton:
    """The trie of the stems under a Levenshtein automaton of one edit, made deterministic."""

    def __init__(self, stems: list[str]) -> None:
        self._next: list[dict[str, int]] = [{}]
        self._ends: dict[int, int] = {}
        for stem in stems:
            node = 0
            for letter in stem:
                if letter not in self._next[node]:
                    self._next[node][letter] = len(self._next)
                    self._next.append({})
                node = self._next[node][letter]
            self._ends[node] = len(stem)
        self._moves: dict[frozenset, dict[str, tuple[frozenset, int]]] = {}
        # (trie node, edits so far)
        self._start = frozenset([(0, 0)])

    def _step(self, state: frozenset, letter: str) -> tuple[frozenset, int]:
        """Next state, and 1 or 2 where a stem ends here without or with an edit."""
        after, found = set(), 0
        for node, edits in state:
            targets = [(node, 0)]
            if not edits and node:
                targets += [(child, 1) for child in self._next[node].values()]  # a letter left out
            for at, extra in targets:
                child = self._next[at].get(letter)
                if child is not None:
                    after.add((child, edits + extra))
                    if child in self._ends:
                        if edits + extra == 0:
                            found = 1
                        elif not found and self._ends[child] >= EDITED_FROM:
                            found = 2
            if not edits and node:
                after.add((node, 1))  # a letter put in
                after.update((child, 1) for child in self._next[node].values())  # another letter
        return frozenset(after), found

    def match(self, word: str) -> int:
        """1 for a term, 2 for a misspelled one, else 0."""
        state, best = self._start, 0
        for letter in word:
            moves = self._moves.setdefault(state, {})
            if letter not in moves:
                moves[letter] = self._step(state, letter)
            state, found = moves[letter]
            if found == 1:
                return 1
            best = best or found
            if not state:
                break
        return best


class _Matches(dict):
    """Kind of match by white-space delimited word."""

    def __init__(self, stems: list[str]) -> None:
        self._automaton = Automaton(stems)

    def __missing__(self, word: str) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        kinds = [self._automaton.match(part) for part in _LETTERS.findall(word) if len(part) >= SHORTEST]
        value = self[word] = 1 if 1 in kinds else 2 if 2 in kinds else 0
        return value


def _quoted(words: list[str], at: int) -> bool:
    """Whether a quotation opens in the window before the word and does not close before it."""
    inside = words[at][0] in _OPEN
    for word in words[max(0, at - WINDOW) : at]:
        if word[0] in _OPEN or word == ">":
            inside = True
        if word[-1] in _CLOSE and len(word) > 1 or word[-2:-1] and word[-2] in _CLOSE:
            inside = False
    return inside


def _features(text: str, matches: _Matches) -> list[float]:
    words = text.lower().split()
    kinds = np.fromiter(map(matches.__getitem__, words), np.uint8, len(words))
    hits = np.flatnonzero(kinds)
    if not len(hits):
        return [0.0] * FEATURES
    quoted = np.array([_quoted(words, int(at)) for at in hits])
    direct = kinds[hits[~quoted]]
    plain, edited = int((direct == 1).sum()), int((direct == 2).sum())
    near = int((np.diff(hits[~quoted]) <= WINDOW).sum()) if len(direct) > 1 else 0
    return [
        float(plain > 0), np.log1p(plain), np.log1p(edited), np.log1p(int(quoted.sum())),
        np.log1p(near), np.log1p(100.0 * plain / len(words)),
    ]


@dataclass(frozen=True)
class Model:
    stems: tuple[str, ...]
    weights: tuple[float, ...]


_known: dict[tuple[str, ...], _Matches] = {}


def _matches(stems: tuple[str, ...]) -> _Matches:
    if stems not in _known:
        _known.clear()
        _known[stems] = _Matches(list(stems))
    return _known[stems]


def _beginnings(text: str) -> set[str]:
    out = set()
    for word in {part for word in set(text.lower().split()) for part in _LETTERS.findall(word)}:
        out.update(word[:n] for n in range(SHORTEST, min(len(word), LONGEST) + 1))
    return out


def _stems(sample: DataFrame) -> list[str]:
    def count(batches):
        rows, toxic = Counter(), Counter()
        for batch in batches:
            for text, label in zip(batch["text"].to_pylist(), batch["toxic"].to_pylist(), strict=True):
                found = _beginnings(text or "")
                rows.update(found)
                if label:
                    toxic.update(found)
        yield pa.RecordBatch.from_pydict(
            {
                "stem": pa.array(list(rows), pa.string()),
                "n": pa.array(list(rows.values()), pa.int64()),
                "toxic": pa.array([toxic[stem] for stem in rows], pa.int64()),
            }
        )

    counted = sample.mapInArrow(count, "stem string, n long, toxic long")
    counted = counted.groupBy("stem").agg(F.sum("n").alias("n"), F.sum("toxic").alias("toxic"))
    pure = counted.where((F.col("toxic") >= LEAST_TOXIC_ROWS) & (F.col("toxic") >= LEAST_PURITY * F.col("n")))
    # Bounded by the sample: each row has few beginnings that are nearly only in toxic rows.
    support = {row.stem: row.toxic for row in pure.collect()}
    shortest = [stem for stem in support if not any(stem[:n] in support for n in range(SHORTEST, len(stem)))]
    out = []
    for stem in shortest:  # as long as all that begins so goes on alike
        while True:
            longer = [s for s in support if len(s) == len(stem) + 1 and s.startswith(stem) and support[s] >= 0.97 * support[stem]]
            if not longer:
                break
            stem = longer[0]
        out.append(stem)
    return sorted(out)


def _regression(x: np.ndarray, y: np.ndarray, penalty: float = 1e-2) -> np.ndarray:
    """Weights of a logistic regression with intercept, by Newton's method."""
    x = np.hstack([np.ones((len(x), 1)), x])
    weights = np.zeros(x.shape[1])
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
        gradient = x.T @ (p - y) + penalty * weights
        hessian = (x * (p * (1 - p))[:, None]).T @ x + penalty * np.eye(x.shape[1])
        step = np.linalg.solve(hessian, gradient)
        weights -= step
        if np.abs(step).max() < 1e-8:
            break
    return weights


def fit(docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS, doc_id: str = "doc_id", text: str = "text", label: str = "toxic") -> Model:
    marks = labels.select(F.col(doc_id).alias("doc_id"), F.col(label).cast("int").alias("toxic"))
    marks = marks.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    marks = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # At most sample_rows pairs of numbers.
    chosen = docs.select(F.col(doc_id).alias("doc_id"), F.col(text).alias("text")).join(F.broadcast(marks), "doc_id")
    # A text copied many times is one example.
    chosen = chosen.groupBy("text").agg(F.max("toxic").alias("toxic"))
    stems = tuple(_stems(chosen))

    def features(batches):
        matches = _matches(stems)
        for batch in batches:
            rows = [_features(text or "", matches) for text in batch["text"].to_pylist()]
            yield pa.RecordBatch.from_pydict({"x": pa.array(rows, pa.list_(pa.float64())), "y": batch["toxic"]})

    rows = chosen.mapInArrow(features, "x array<double>, y int").collect()
    y = np.array([row.y for row in rows], float)
    if not len(rows) or y.min() == y.max():
        share = y.mean() if len(rows) else 0.0
        return Model((), (30.0 * (2 * share - 1), *[0.0] * FEATURES))
    return Model(stems, tuple(map(float, _regression(np.array([row.x for row in rows]), y))))


def score(docs: DataFrame, model: Model, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, score, n_terms)."""

    def scored(batches):
        matches = _matches(model.stems)
        weights = np.array(model.weights)
        for batch in batches:
            x = np.array([_features(text or "", matches) for text in batch["text"].to_pylist()]).reshape(-1, FEATURES)
            values = 1 / (1 + np.exp(-np.clip(weights[0] + x @ weights[1:], -30, 30)))
            terms = np.rint(np.expm1(x[:, 1]) + np.expm1(x[:, 2]) + np.expm1(x[:, 3])).astype(np.int64)
            yield pa.RecordBatch.from_pydict({"doc_id": batch["doc_id"], "score": values, "n_terms": terms})

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    return rows.mapInArrow(scored, "doc_id long, score double, n_terms long")


def in_fold(doc_id: int) -> bool:
    """``held_out`` for a number, for tests."""
    return zlib.crc32(str(doc_id).encode()) % 5 == 0

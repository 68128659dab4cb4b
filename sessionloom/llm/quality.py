"""Quality rules as a short-circuit cascade.

Base measures of every whole text are taken in one pass over Arrow batches.  The method's own
rules are column expressions.  ``ordered`` runs each of them on a bounded sample of rows, takes
its seconds and the share of rows it rejects, and puts the rules with the most rejection per cost
first; ``judge`` tries them in that order and stops at the first that rejects a row.  Rules do
not depend on each other, so the order changes the time and the name of the rule that is given,
never which documents are kept.

Defined results: null, empty and blank texts have no words, so the base rejects them; equal rows
get equal rows; an empty table gives no rows.  Of the input's columns those named in ``keep`` are
returned; one with the name of a measure is replaced by the measure.
"""

from __future__ import annotations

import time
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sessionloom.llm.shipping import bound_batches, give_back
from sessionloom.llm.words import mixed, slices, texts_of, window_hashes

WINDOW = 5
#: Rows on which cost and selectivity of the rules are estimated, and how often each is run.
SAMPLE_ROWS = 500
SAMPLE_REPEATS = 4
MEASURES = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_SYMBOL = np.zeros(256, bool)
_SYMBOL[list(b"#*$%&|<>")] = True
_SPACES = r"[\x20\x09-\x0D]+"


@dataclass(frozen=True)
class Rule:
    name: str
    rejects: Column


def _per_row(flags: np.ndarray, ends: np.ndarray) -> np.ndarray:
    sums = np.concatenate([[0], np.cumsum(flags)])
    return np.diff(sums[np.concatenate([[0], ends])])


def _measured(bodies: list[bytes]) -> np.ndarray:
    """The measures of each text, one row each."""
    data = np.frombuffer(b"".join(bodies), np.uint8)
    ends = np.cumsum([len(body) for body in bodies], dtype=np.int64)
    rows = [body.split() for body in bodies]
    n_words = np.array([len(row) for row in rows], np.int64)
    word_chars = _per_row(((data & 0xC0) != 0x80) & ~_SPACE[data], ends)
    n_symbols = _per_row(_SYMBOL[data], ends)
    n_dup = []
    for body in bodies:
        lines = [line for line in body.split(b"\n") if line.strip()]
        n_dup.append(len(lines) - len(set(lines)))
    # Windows are compared inside a text only, so a hash of this process will do.
    hashed = np.fromiter((hash(w) for row in rows for w in row), np.int64, int(n_words.sum())).view(np.uint64)
    word_ends = np.cumsum(n_words)
    of_row = np.repeat(np.arange(len(rows), dtype=np.uint64), n_words)
    windows = window_hashes(hashed, WINDOW)
    starts = np.flatnonzero(of_row[: len(windows)] == of_row[WINDOW - 1 :][: len(windows)])
    keys = mixed(windows[starts]) ^ mixed(of_row[starts] + np.uint64(1))
    order = np.argsort(keys, kind="stable")
    same = keys[order][1:] == keys[order][:-1]
    twice = np.zeros(len(keys), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    change = np.zeros(len(hashed) + 1, np.int64)
    change[starts[twice]] += 1
    change[starts[twice] + WINDOW] -= 1
    repeated = _per_row(np.cumsum(change[:-1]) > 0, word_ends)
    return np.stack([n_words, word_chars, n_symbols, np.array(n_dup, np.int64), repeated], axis=1)


def measured_parts(batch: pa.RecordBatch, keep: list[str], body: str) -> Iterator[pa.RecordBatch]:
    """The kept columns and the five measures, in batches of bounded text."""
    for part in slices(batch, body):
        table = _measured(texts_of(part[body]))
        columns = [part[name] for name in keep] + [pa.array(table[:, k]) for k in range(len(MEASURES))]
        yield pa.RecordBatch.from_arrays(columns, names=[*keep, *MEASURES])


def with_measures(docs: DataFrame, keep: list[str], text: str = "text") -> DataFrame:
    """The kept columns and the five measures."""
    bound_batches(docs.sparkSession)
    keep = [name for name in keep if name not in MEASURES]
    # A text that is kept travels once.
    body = text if text in keep else "__text"
    frame = docs.select(*keep, *([] if text in keep else [F.col(text).alias(body)]))
    schema = T.StructType([*docs.select(*keep).schema.fields, *(T.StructField(m, T.LongType()) for m in MEASURES)])

    def measure(batches):
        for batch in batches:
            yield from measured_parts(batch, keep, body)
        give_back()

    return frame.mapInArrow(measure, schema)


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def default_rules(text: str = "text") -> list[Rule]:
    """Rules on the text alone; each rejects what running prose does not look like."""
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, _SPACES), lambda w: w != "")
    lines = F.filter(F.split(body, "\n"), lambda line: F.regexp_replace(line, _SPACES, "") != "")

    def count_of(characters: str) -> Column:
        return F.length(body) - F.length(F.translate(body, characters, ""))

    n_words = F.size(words)
    # Pairs of neighbours; the lists are made once a text, not once a word.
    again = F.size(F.filter(F.zip_with(words, F.slice(words, F.lit(2), F.greatest(n_words, F.lit(1))), lambda a, b: a == b), lambda same: same))
    return [
        Rule("symbols", 100 * count_of("#*$%&|<>") > 30 * n_words),
        Rule("exclaiming", 100 * count_of("!") > 30 * n_words),
        Rule("shouting", 2 * F.length(F.regexp_replace(body, r"[^\p{Lu}]", "")) > F.length(F.regexp_replace(body, r"[^\p{L}]", ""))),
        Rule("same lines", 2 * (F.size(lines) - F.size(F.array_distinct(lines))) > F.size(lines)),
        Rule("stammering", F.when(n_words > 1, 100 * again > 30 * n_words).otherwise(False)),
        Rule("long words", F.length(F.regexp_replace(body, _SPACES, "")) > 15 * n_words),
    ]


def ordered(docs: DataFrame, rules: list[Rule], sample_rows: int = SAMPLE_ROWS) -> list[Rule]:
    """The rules by rejection per second on a sample of at most about ``sample_rows`` rows."""
    total = docs.count()
    share = min(1.0, sample_rows / max(total, 1))
    sample = docs.sample(share, seed=7).limit(2 * sample_rows).repartition(docs.sparkSession.sparkContext.defaultParallelism)
    sample = sample.persist()
    try:
        rows = sample.count()
        repeated = sample.withColumn("__again", F.explode(F.sequence(F.lit(1), F.lit(SAMPLE_REPEATS))))
        seconds, rejected = {}, {}
        for rule in [Rule("", F.lit(False)), *rules]:
            start = time.perf_counter()
            # The repeat number keeps Spark from evaluating the rule once for all repeats.
            seen = repeated.select(F.when(F.col("__again") > 0, rule.rejects).alias("r"))
            rejected[rule.name] = seen.agg(F.sum(F.col("r").cast("long"))).first()[0] or 0
            seconds[rule.name] = time.perf_counter() - start
        idle = seconds.pop("")
    finally:
        sample.unpersist()

    def worth(rule: Rule) -> float:
        cost = max(seconds[rule.name] - idle, 1e-3)
        return rejected[rule.name] / max(rows * SAMPLE_REPEATS, 1) / cost

    return sorted(rules, key=worth, reverse=True)


def judge(
    docs: DataFrame, keep: list[str], rules: list[Rule] | None = None, text: str = "text", sample_rows: int = SAMPLE_ROWS
) -> DataFrame:
    """The kept columns, the measures, base_failed, kept, and the cascade's ``rejected_by``."""
    cascade = ordered(docs, default_rules(text) if rules is None else rules, sample_rows)
    verdict = F.lit(None).cast("string")
    for rule in reversed(cascade):
        verdict = F.when(rule.rejects, F.lit(rule.name)).otherwise(verdict)
    keep = [name for name in keep if name not in (*MEASURES, "rejected_by", "base_failed", "kept")]
    body = text if text in keep else "__body"
    judged = docs.select(*keep, *([] if text in keep else [F.col(text).alias(body)]), verdict.alias("rejected_by"))
    return (
        with_measures(judged, [*keep, "rejected_by"], body)
        .withColumn("base_failed", base_failed())
        .withColumn("kept", ~F.col("base_failed") & F.col("rejected_by").isNull())
    )

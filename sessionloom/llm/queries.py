"""The registered queries of this subpackage, each over its whole table, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from sessionloom.llm import (
    alignment,
    chat,
    decontamination,
    hard_negatives,
    html_text,
    jaccard_join,
    packing,
    pii,
    quality,
    source_mix,
    substring_dedup,
    token_counts,
    toxicity,
)
from sessionloom.llm.shipping import ship_package
from sessionloom.workspace import materialize

Query = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_package(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_pii_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    replaced = pii.replace_entities(_table(spark, sf_dir, "documents"), pii.DEFAULT_KEY)
    return replaced.select("doc_id", "text", "n_entities", "entity_types")


def op2_quality_cascade(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.judge(_table(spark, sf_dir, "documents"), ["doc_id"])
    return judged.select("doc_id", *quality.MEASURES, "base_failed", "kept")


def op3_html_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(_table(spark, sf_dir, "pages"))


def op4_quote_threads(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.reply_ordered(_table(spark, sf_dir, "conversations"))


def op5_spaced_seed_overlaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    overlaps = decontamination.benchmark_overlaps(
        _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark")
    )
    return overlaps.drop("row")


def op6_window_removal(spark: SparkSession, sf_dir: str) -> DataFrame:
    removed = substring_dedup.remove_repeated_windows(_table(spark, sf_dir, "documents"))
    return removed.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op7_length_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    histogram = token_counts.length_histogram(_table(spark, sf_dir, "documents"))
    # Two branches read the histogram; written once, the documents are encoded once.
    return token_counts.with_running_sums(materialize(histogram, "token-lengths"))


def op8_toxicity_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    scored = toxicity.score(docs, toxicity.fit(docs, _table(spark, sf_dir, "labels")))
    return scored.select(
        "doc_id",
        toxicity.held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def op9_jaccard_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.jaccard_classes(_table(spark, sf_dir, "documents")).select(
        "doc_id", "n_shingles", "component_id"
    )


def op10_lexical_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(_table(spark, sf_dir, "documents"))


def op11_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, mixed = source_mix.mix(_table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vec_id = F.col("vec_id")
    mined = hard_negatives.mine(
        _table(spark, sf_dir, "embeddings"),
        is_anchor=vec_id % 100 == 0,
        label_of=F.when(vec_id % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label")),
    )
    return mined.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def op13_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align(_table(spark, sf_dir, "documents"), with_groups=False)[0]


QUERIES: dict[str, Query] = {
    function.__name__: function
    for function in (
        op1_pii_surrogates,
        op2_quality_cascade,
        op3_html_main_text,
        op4_quote_threads,
        op5_spaced_seed_overlaps,
        op6_window_removal,
        op7_length_histogram,
        op8_toxicity_scores,
        op9_jaccard_classes,
        op10_lexical_packing,
        op11_source_mix,
        op12_hard_negatives,
        op13_tokenizer_alignment,
    )
}
QUERIES["pipeline"] = corpus_pipeline.run

_WORDS = r"list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda w: w <> '')"

ORACLES: dict[str, str] = {
    "op2_quality_cascade": rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_WORDS} AS w,
    list_filter(string_split(coalesce(text, ''), chr(10)), lambda l: regexp_replace(l, '[\x20\x09-\x0D]+', '', 'g') <> '') AS l
  FROM documents
), words AS (SELECT r, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
windows AS (
  SELECT r, p, array_to_string(list(word) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING), ' ') AS k,
    count(*) OVER (PARTITION BY r ORDER BY p ROWS BETWEEN CURRENT ROW AND 4 FOLLOWING) AS n
  FROM words
), twice AS (SELECT r, p FROM (SELECT r, p, count(*) OVER (PARTITION BY r, k) AS c FROM windows WHERE n = 5) WHERE c > 1),
repeated AS (SELECT r, count(DISTINCT p + g.i) AS n FROM twice, (SELECT unnest(range(5)) AS i) g GROUP BY r),
stammer AS (SELECT r, count(*) AS n FROM (SELECT r, word, lag(word) OVER (PARTITION BY r ORDER BY p) AS b FROM words) WHERE word = b GROUP BY r),
m AS (
  SELECT doc_id, text, len(w) AS n_words, length(array_to_string(w, '')) AS word_chars,
    length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS n_symbols,
    len(l) AS n_lines, len(l) - len(list_distinct(l)) AS n_dup_lines,
    coalesce(repeated.n, 0) AS n_repeat_words, coalesce(stammer.n, 0) AS again,
    length(text) - length(replace(text, '!', '')) AS exclaims,
    length(regexp_replace(text, '[^\p{{Lu}}]', '', 'g')) AS upper_letters,
    length(regexp_replace(text, '[^\p{{L}}]', '', 'g')) AS letters
  FROM d LEFT JOIN repeated USING (r) LEFT JOIN stammer USING (r)
), b AS (SELECT *, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed FROM m)
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(word_chars AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
  CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
  NOT base_failed AND NOT (100 * n_symbols > 30 * n_words OR 100 * exclaims > 30 * n_words OR 2 * upper_letters > letters
    OR 2 * n_dup_lines > n_lines OR 100 * again > 30 * n_words OR word_chars > 15 * n_words) AS kept
FROM b""",
    "op5_spaced_seed_overlaps": r"""
WITH dw AS (
  SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM (
    SELECT doc_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM documents)
), iw AS (
  SELECT item_id, len(w) AS item_words, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM (
    SELECT item_id, string_split(trim(regexp_replace(lower(coalesce(text, '')), '[^\p{L}\p{N}]+', ' ', 'g')), ' ') AS w FROM benchmark)
), m AS (
  SELECT doc_id, item_id, item_words, greatest(dw.p - iw.p, 0) AS start, count(*) AS matched
  FROM dw JOIN iw USING (word) WHERE word <> '' GROUP BY doc_id, item_id, item_words, dw.p - iw.p
  HAVING count(*) * 100 >= item_words * 80
)
SELECT doc_id, item_id, CAST(start AS BIGINT) AS start, CAST(matched AS BIGINT) AS matched, CAST(item_words AS BIGINT) AS item_words
FROM m QUALIFY row_number() OVER (PARTITION BY doc_id, item_id ORDER BY matched DESC, start) = 1""",
    "op6_window_removal": rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM d),
windows AS (
  SELECT doc_id, p, md5(array_to_string(list(word) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING), ' ')) AS k,
    count(*) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN CURRENT ROW AND 34 FOLLOWING) AS n
  FROM words
), starts AS (SELECT doc_id, p, CASE WHEN n = 35 AND count(*) OVER (PARTITION BY k, n) > 1 THEN 1 ELSE 0 END AS hit FROM windows),
gone AS (
  SELECT doc_id, p, max(hit) OVER (PARTITION BY doc_id ORDER BY p ROWS BETWEEN 34 PRECEDING AND CURRENT ROW) AS gone FROM starts
), kept AS (
  SELECT doc_id, count(*) AS n, sum(gone) AS n_removed, string_agg(word, ' ' ORDER BY p) FILTER (WHERE gone = 0) AS t
  FROM words JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
  sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op9_jaccard_classes": r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(w, p, p + 3), ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 2, 2))) AS p FROM d WHERE len(w) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s a JOIN s b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2
), links AS (
  SELECT a, b FROM pairs JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b WHERE 100 * o >= 85 * (x.n + y.n - o)
), reach AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, least(d.doc_id, coalesce(c.b, d.doc_id)) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a, min(b) AS b FROM reach GROUP BY a) c ON c.a = d.doc_id""",
    "op11_source_mix": rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, source, CAST(len({_WORDS}) AS BIGINT) AS size FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY source NULLS LAST) - 1 AS place
  FROM d GROUP BY source
), w AS (SELECT *, CASE place % 3 WHEN 0 THEN 3 WHEN 1 THEN 1 ELSE 2 END AS weight FROM s),
-- In the order of the level at which they are full, sources are capped until the level of the rest is lower.
o AS (
  SELECT *, CAST(sum(source_size) OVER () AS BIGINT) AS total, CAST(sum(weight) OVER () AS BIGINT) AS every,
    CAST(sum(source_size) OVER (ORDER BY source_size / weight, place ROWS UNBOUNDED PRECEDING) AS BIGINT) AS c,
    CAST(sum(weight) OVER (ORDER BY source_size / weight, place ROWS UNBOUNDED PRECEDING) AS BIGINT) AS cw
  FROM w
), f AS (
  SELECT *, CAST(weight AS HUGEINT) * (3 * total - 4 * (c - source_size)) > CAST(source_size AS HUGEINT) * 4 * (every - cw + weight) AS above FROM o
), t AS (
  SELECT *, coalesce(max(c) FILTER (WHERE above) OVER (), 0) AS capped, coalesce(max(cw) FILTER (WHERE above) OVER (), 0) AS cappedw FROM f
), g AS (
  SELECT source, source_size, CASE WHEN above THEN CAST(2 * source_size AS DOUBLE)
    ELSE CAST(weight * (3 * total - 4 * capped) AS DOUBLE) / CAST(2 * (every - cappedw) AS DOUBLE) END AS target
  FROM t
), x AS (
  SELECT d.*, source_size, target, least(CAST(floor(target) AS BIGINT), 2 * source_size) AS words,
    CAST(coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY md5(coalesce(CAST(doc_id AS VARCHAR), '')), doc_id NULLS LAST, size, r
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS b
  FROM d JOIN g ON d.source IS NOT DISTINCT FROM g.source
)
SELECT doc_id, size, source_size, target, CAST(greatest(least(words, b + size) - b, 0)
  + greatest(least(words, source_size + b + size) - source_size - b, 0) AS BIGINT) AS taken
FROM x""",
    "op12_hard_negatives": """
WITH sound AS (
  SELECT row_number() OVER () AS r, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(CAST(x AS DOUBLE)))) = 0
), parts AS (SELECT r, unnest(v) AS x, generate_subscripts(v, 1) AS i FROM sound),
anchors AS (SELECT * FROM sound WHERE vec_id % 100 = 0),
products AS (
  SELECT a.r AS a, b.r AS b, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM parts a JOIN parts b USING (i) WHERE a.r IN (SELECT r FROM anchors) GROUP BY ALL
), scores AS (
  SELECT a.r AS a, a.vec_id AS anchor_id, b.r AS b, b.vec_id AS other_id, a.label = b.label AS same, coalesce(score, 0) AS score
  FROM anchors a JOIN sound b ON a.r <> b.r LEFT JOIN products p ON p.a = a.r AND p.b = b.r
), positives AS (
  SELECT * FROM scores WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, other_id NULLS LAST, b) <= 5
)
SELECT p.anchor_id, p.other_id AS positive_id,
  CAST(row_number() OVER (PARTITION BY p.a, p.b ORDER BY n.score DESC, n.other_id NULLS LAST, n.b) AS INTEGER) AS rank,
  n.other_id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN scores n ON n.a = p.a AND NOT n.same AND 80 * p.score <= 100 * n.score AND n.score <= p.score
QUALIFY rank <= 5""",
}

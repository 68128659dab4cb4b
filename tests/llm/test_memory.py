"""What tasks hold at a time: bounded pieces of text, bounded batches, one Python step."""

import tracemalloc
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from helpers_llm import prose
from pyspark.sql import functions as F

from sessionloom.llm import alignment, counting, jaccard_join, quality, words
from sessionloom.llm.shipping import give_back, ship_package
from sessionloom.workspace import materialize, removing_tables


def held_by(make):
    """The result, and the most bytes that were held beside it."""
    tracemalloc.start()
    try:
        made = make()
        kept, peak = tracemalloc.get_traced_memory()
    finally:
        tracemalloc.stop()
    return made, peak - kept


def test_shingle_sets_hold_the_words_of_a_piece_only():
    bodies = [prose(k, 400).encode() for k in range(2500)] + [b"", b"one two"]
    size = sum(map(len, bodies))
    assert size > 4 * words.CHUNK_BYTES
    sets, held = held_by(lambda: jaccard_join.shingle_sets(bodies, 4))
    assert [s.tolist() for s in sets] == [jaccard_join.shingle_sets([b], 4)[0].tolist() for b in bodies]
    assert held < 5 * size


def test_measures_are_taken_in_pieces(monkeypatch):
    texts = [prose(k, 60) for k in range(50)] + [None, "", "a b"]
    batch = pa.RecordBatch.from_pydict({"id": list(range(len(texts))), "text": texts})
    (whole,) = quality.measured_parts(batch, ["id", "text"], "text")
    monkeypatch.setattr(words, "CHUNK_BYTES", 1000)
    parts = list(quality.measured_parts(batch, ["id", "text"], "text"))
    longest = max(len(t or "") for t in texts)
    assert len(parts) > 10 and all(sum(len(t or "") for t in p["text"].to_pylist()) < 1000 + longest for p in parts)
    assert pa.Table.from_batches(parts).to_pylist() == pa.Table.from_batches([whole]).to_pylist()
    assert list(quality.measured_parts(batch.slice(0, 0), ["id"], "text")) == []


def test_operators_bound_the_batches_sent_to_python(spark, edge_docs):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.unset(key)
    try:
        quality.judge(edge_docs, ["doc_id"])
        long = spark.range(0, 4000, numPartitions=1).selectExpr("repeat('word ', 1000) AS text")

        def sizes(batches):
            for batch in batches:
                yield pa.RecordBatch.from_pydict({"bytes": [batch.nbytes]})

        assert max(r.bytes for r in long.mapInArrow(sizes, "bytes long").collect()) < 9 << 20
        spark.conf.set(key, 1 << 20)
        quality.judge(edge_docs, ["doc_id"])
        assert spark.conf.get(key).startswith(str(1 << 20))
    finally:
        spark.conf.unset(key)


def test_stages_of_the_alignment_have_one_python_step(spark, monkeypatch):
    plans = {}

    def kept(frame, label):
        plans[label] = frame._jdf.queryExecution().executedPlan().toString()
        return materialize(frame, label)

    monkeypatch.setattr(alignment, "materialize", kept)
    docs = spark.createDataFrame([(k, prose(k % 5)) for k in range(20)], "doc_id long, text string")
    alignment.align(docs)
    functions = plans["functions"].split("Exchange")[0]
    assert sum(functions.count(step) for step in ("MapInArrow", "FlatMapGroupsInArrow", "FlatMapCoGroupsInArrow")) == 1


def test_waiting_workers_hold_no_freed_memory(spark, monkeypatch):
    ship_package(spark)
    # Another environment has workers of its own.
    monkeypatch.setitem(spark.sparkContext.environment, "SESSIONLOOM_TEST", "waiting")
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(900)), lambda k: F.xxhash64(F.col("row") % 200, k).cast("string")))
    rows = spark.range(400).select(F.lit(0).alias("parcel"), F.col("id").alias("row"), F.col("id").alias("doc_id"))
    rows = rows.withColumn("text", text)

    def values_of(table):
        flat = np.concatenate(jaccard_join.shingle_sets(words.texts_of(table["text"]), 4))
        return np.stack([flat, words.mixed(flat)], axis=1)

    def result_of(table, counts):
        return pa.table({"row": table["row"]})

    def held(batches):
        def mb():
            return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 >> 20

        for _ in batches:
            before = mb()
            give_back()
            yield pa.RecordBatch.from_pydict({"mb": [before - mb()]})

    def worst():
        return max(r.mb for r in spark.range(8, numPartitions=4).mapInArrow(held, "mb long").collect())

    answers = counting.counted(rows, 1, 5, values_of)
    counting.with_counts(rows, answers, 1, values_of, result_of, "row long").write.format("noop").mode("overwrite").save()
    assert worst() < 20
    quality.with_measures(rows.coalesce(1), ["row"]).write.format("noop").mode("overwrite").save()
    assert worst() < 20


def test_each_chunk_of_the_alignment_is_a_row_group(spark, monkeypatch):
    monkeypatch.setattr(alignment, "CHUNK_CHARS", 2000)
    docs = spark.createDataFrame([(k, prose(k % 5, 100)) for k in range(40)], "doc_id long, text string").coalesce(2)
    with removing_tables(spark) as made:
        alignment.align(docs)
        (path,) = [p for p in made if "/chunks-" in p]
        files = [pq.ParquetFile(f).metadata for f in Path(path).glob("*.parquet")]
    assert sum(f.num_rows for f in files) > 2 * len(files)
    assert {f.row_group(k).num_rows for f in files for k in range(f.num_row_groups)} == {1}


def test_workers_hold_no_freed_memory_after_chunks_and_after_the_alignment(spark, monkeypatch):
    ship_package(spark)
    monkeypatch.setitem(spark.sparkContext.environment, "SESSIONLOOM_TEST", "aligned")

    def held(batches):
        def mb():
            return int(Path("/proc/self/statm").read_text().split()[1]) * 4096 >> 20

        for _ in batches:
            before = mb()
            give_back()
            yield pa.RecordBatch.from_pydict({"mb": [before - mb()]})

    seen = []

    def kept(frame, label):
        if label == "places":  # the chunks have just been written
            seen.append(max(r.mb for r in spark.range(8, numPartitions=4).mapInArrow(held, "mb long").collect()))
        return materialize(frame, label)

    monkeypatch.setattr(alignment, "materialize", kept)
    text = F.concat_ws(" ", F.transform(F.sequence(F.lit(1), F.lit(900)), lambda k: F.xxhash64(F.col("id"), k).cast("string")))
    docs = spark.range(250).select(F.col("id").alias("doc_id"), text.alias("text")).coalesce(1)
    aligned, _ = alignment.align(docs, with_groups=False)
    aligned.write.format("noop").mode("overwrite").save()
    seen.append(max(r.mb for r in spark.range(8, numPartitions=4).mapInArrow(held, "mb long").collect()))
    assert max(seen) < 20

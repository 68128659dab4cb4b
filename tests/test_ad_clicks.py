import pytest

from data import rows
from sessionloom.streaming import ad_clicks

MINUTE = 60_000
START = 1704067200000  # 2024-01-01 00:00:00


def message(offset_ms, city=1, ad=5):
    return f"{START + offset_ms} province_1 city_{city} 77 {ad}"


def lines(spark, *texts):
    return spark.createDataFrame([(t,) for t in texts], "value string")


def test_parse(spark):
    frame = ad_clicks.parse_ad_clicks(
        lines(spark, message(1), "bad line", "x p c 1 2", f"{START} p c x 2", f"{START} p c 1 2 3", "")
    )
    (row,) = frame.collect()
    assert (str(row["ts"]), row["province"], row["city"], row["user_id"], row["ad_id"]) == (
        "2024-01-01 00:00:00.001000", "province_1", "city_1", 77, 5,
    )


def test_batch_counts(spark):
    frame = ad_clicks.count_ad_clicks(
        ad_clicks.parse_ad_clicks(
            lines(spark, message(0), message(MINUTE - 1), message(MINUTE), message(5, city=2))
        )
    )
    assert [(str(r[0]), *r[3:]) for r in rows(frame)] == [
        ("2024-01-01 00:00:00", "city_1", 5, 2),
        ("2024-01-01 00:00:00", "city_2", 5, 1),
        ("2024-01-01 00:01:00", "city_1", 5, 1),
    ]


def test_stream_counts_closed_windows_and_drops_late_clicks(spark, tmp_path):
    source, path, checkpoint = (str(tmp_path / name) for name in ("in", "out", "checkpoint"))

    def run(*texts):
        lines(spark, *texts).coalesce(1).write.mode("append").text(source)
        stream = ad_clicks.parse_ad_clicks(spark.readStream.schema("value string").text(source))
        query = ad_clicks.run_ad_click_counts(
            ad_clicks.count_ad_clicks(stream), path, checkpoint, available_now=True
        )
        query.awaitTermination()
        return [(str(r[0])[11:16], r[5]) for r in rows(spark.read.parquet(path))]

    assert run(message(0), message(1000), message(3 * MINUTE)) == [("00:00", 2)]
    # on time for the open window, too late for the closed one
    assert run(message(3 * MINUTE + 1), message(2000), message(9 * MINUTE)) == [
        ("00:00", 2), ("00:03", 2),
    ]


def test_every_message_is_accepted_or_refused(spark):
    texts = [message(1), "bad line", "x p c 1 2", f"{START} p c x 2", f"{START} p c 1 y", None, "", "1 2 3 4 5 6"]
    classified = ad_clicks.classify_messages(lines(spark, *texts))
    assert [(r["value"], r["reason"]) for r in ad_clicks.refused(classified).collect()] == [
        ("bad line", "fields"), ("x p c 1 2", "timestamp"), (f"{START} p c x 2", "user_id"),
        (f"{START} p c 1 y", "ad_id"), (None, "fields"), ("", "fields"), ("1 2 3 4 5 6", "fields"),
    ]
    assert ad_clicks.accepted(classified).count() == 1


class Feed:
    """A feed over message files that can be stopped and started again."""

    def __init__(self, spark, folder):
        self.spark, self.source, self.checkpoint = spark, f"{folder}/in", f"{folder}/checkpoint"
        self.table = ad_clicks.AdClickTable(spark, f"{folder}/out")

    def add(self, *texts):
        lines(self.spark, *texts).coalesce(1).write.mode("append").text(self.source)

    def run(self, table=None):
        messages = self.spark.readStream.schema("value string").option("maxFilesPerTrigger", 1).text(self.source)
        query = (table or self.table).start(messages, self.checkpoint, available_now=True)
        query.awaitTermination()

    def counts(self):
        return [(str(r[0])[11:16], r[5]) for r in rows(self.table.counts())]


def test_table_misses_nothing_over_stops_and_late_clicks(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    assert feed.counts() == [] and feed.table.refused().count() == 0
    feed.add(message(0), message(1000), "bad")
    feed.add(message(9 * MINUTE))
    feed.run()
    assert feed.counts() == [("00:00", 2), ("00:09", 1)]
    feed.add(message(2000), "worse", message(9 * MINUTE + 1))
    feed.run()
    feed.run()
    assert feed.counts() == [("00:00", 3), ("00:09", 2)]
    assert sorted(r["value"] for r in feed.table.refused().collect()) == ["bad", "worse"]


def test_table_counts_a_repeated_batch_once(spark, tmp_path):
    feed = Feed(spark, tmp_path)

    class Failing(ad_clicks.AdClickTable):
        def add_batch(self, messages, batch):
            super().add_batch(messages, batch)
            if batch == 1:
                raise RuntimeError("lost after its output was written")

    feed.add(message(0))
    feed.add(message(1))
    with pytest.raises(Exception, match="lost after"):
        feed.run(Failing(spark, feed.table.path))
    feed.add(message(2))
    feed.run()
    assert feed.counts() == [("00:00", 3)]


def test_table_is_the_same_after_compaction(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    for k in range(4):
        feed.add(message(k), message(k * MINUTE))
    feed.run()
    before = feed.counts()
    feed.table.compact(1)
    assert feed.counts() == before
    feed.table.compact(3)
    feed.table.compact(2)
    assert feed.counts() == before
    # A snapshot that was not finished does not count.
    (tmp_path / "out" / "counts" / "snapshots" / "batch_id=9").mkdir()
    assert feed.counts() == before


def test_topic_reader_needs_the_connector(spark):
    with pytest.raises(Exception, match="(?i)kafka"):
        ad_clicks.read_ad_click_topic(spark, "broker:9092", "clicks")

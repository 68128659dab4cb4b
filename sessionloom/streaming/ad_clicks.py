"""The ad-click feed: ``timestamp province city userId adId``, separated by single spaces.

Functions take batch and streaming frames alike.  Only the message format is given; what
to count, the window and the handling of late data are our own definition.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom.workspace import children, exists

WINDOW = "1 minute"
LATENESS = "1 minute"


def read_ad_click_topic(spark: SparkSession, brokers: str, topic: str, **options) -> DataFrame:
    """Messages of a Kafka topic as ``value`` text; needs Spark's Kafka connector."""
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .options(**options)
    )
    return reader.load().select(F.col("value").cast("string").alias("value"))


# Why a message is refused, in the order of the tests.
BAD_SHAPE, BAD_TIME, BAD_USER, BAD_AD = "fields", "timestamp", "user_id", "ad_id"
CLICK_COLUMNS = ["ts", "province", "city", "user_id", "ad_id"]


def classify_messages(messages: DataFrame) -> DataFrame:
    """``value``, ``reason`` and the click's columns of every message; ``reason`` is null for good ones.

    A null message is refused for its shape.  The fields come out of an explode, which keeps
    later null checks from being pushed below the split and splitting each message again.
    """
    parts, click = F.col("parts"), F.col("click")
    fields = F.struct(
        F.timestamp_millis(parts[0].try_cast("bigint")).alias("ts"),
        parts[1].alias("province"),
        parts[2].alias("city"),
        parts[3].try_cast("bigint").alias("user_id"),
        parts[4].try_cast("bigint").alias("ad_id"),
    )
    reason = (
        F.when(click.isNull(), BAD_SHAPE)
        .when(click["ts"].isNull(), BAD_TIME)
        .when(click["user_id"].isNull(), BAD_USER)
        .when(click["ad_id"].isNull(), BAD_AD)
    )
    return (
        messages.select("value", F.split("value", " ").alias("parts"))
        .select("value", F.explode(F.array(F.when(F.size(parts) == 5, fields))).alias("click"))
        .select("value", reason.alias("reason"), "click.*")
    )


def accepted(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNull()).select(*CLICK_COLUMNS)


def refused(classified: DataFrame) -> DataFrame:
    return classified.where(F.col("reason").isNotNull()).select("value", "reason")


def parse_ad_clicks(messages: DataFrame) -> DataFrame:
    """``ts, province, city, user_id, ad_id``; one malformed message must not stop a feed,
    so messages of another shape or with broken numbers are left out (``refused`` has them)."""
    return accepted(classify_messages(messages))


COUNT_KEYS = ["window_start", "window_end", "province", "city", "ad_id"]
_PART = "batch_id"
_COUNT_SCHEMA = (
    "window_start timestamp, window_end timestamp, province string, city string, ad_id bigint, click_count bigint"
)


def _counted(clicks: DataFrame, window: str) -> DataFrame:
    return (
        clicks.groupBy(F.window("ts", window), "province", "city", "ad_id")
        .agg(F.count(F.lit(1)).alias("click_count"))
        .select(
            F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"),
            "province", "city", "ad_id", "click_count",
        )
    )


def count_ad_clicks(clicks: DataFrame, window: str = WINDOW, lateness: str = LATENESS) -> DataFrame:
    """Clicks per tumbling window, province, city and ad.

    As a stream the counts of a window are final once the watermark has passed its end, and
    clicks later than that are dropped; state is one counter per key of the open windows.
    """
    return _counted(clicks.withWatermark("ts", lateness), window)


def run_ad_click_counts(
    counts: DataFrame, path: str, checkpoint: str, available_now: bool = False
):
    """Start writing finished windows to parquet files; returns the running query."""
    writer = (
        counts.writeStream.outputMode("append")
        .format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
    )
    return (writer.trigger(availableNow=True) if available_now else writer).start()


class AdClickTable:
    """Counts of all clicks so far, at any moment of a feed, and the messages it refused.

    Every micro-batch adds its own counts under its batch number, replacing what an earlier try of
    the same batch left there, so a batch that is run again after a failure counts once.  A count is
    the sum over batches: no window has to close, late clicks count in their window, a feed that
    ends or is stopped misses nothing, and no state is kept between batches.  Messages are
    parsed once for both outputs.

    Layout under ``path``, Parquet: ``counts/batches/batch_id=b``, ``refused/batch_id=b``, and
    ``counts/snapshots/batch_id=b`` with the sums of all batches up to b, which ``compact`` writes;
    readers take the newest finished snapshot and the batches after it.
    """

    def __init__(self, spark: SparkSession, path: str, window: str = WINDOW) -> None:
        self._spark, self.path, self._window = spark, path.rstrip("/"), window

    # -- writing --

    def start(self, messages: DataFrame, checkpoint: str, available_now: bool = False, **options):
        """Start the feed over streaming ``messages``; returns the running query.

        ``available_now`` ends it when all that is there has been read.
        """
        writer = messages.writeStream.foreachBatch(self.add_batch).option("checkpointLocation", checkpoint).options(**options)
        return (writer.trigger(availableNow=True) if available_now else writer).start()

    def add_batch(self, messages: DataFrame, batch: int) -> None:
        classified = classify_messages(messages).persist()
        try:
            # A batch is few rows a key and window; one file for each part of the shuffle is enough.
            counts = _counted(accepted(classified), self._window)
            counts.write.mode("overwrite").parquet(f"{self.path}/counts/batches/{_PART}={batch}")
            refused(classified).write.mode("overwrite").parquet(f"{self.path}/refused/{_PART}={batch}")
        finally:
            classified.unpersist()

    # -- reading --

    def _read(self, path: str, schema: str) -> DataFrame:
        if not exists(self._spark, f"{self.path}/{path}"):
            return self._spark.createDataFrame([], schema)
        return self._spark.read.schema(schema).parquet(f"{self.path}/{path}")

    def _last_snapshot(self) -> int:
        """The last batch in the newest finished snapshot, -1 without any."""
        folder = f"{self.path}/counts/snapshots"
        done = [name for name in children(self._spark, folder) if exists(self._spark, f"{folder}/{name}/_SUCCESS")]
        return max((int(name.partition("=")[2]) for name in done), default=-1)

    def _sums(self, upto: int | None = None) -> DataFrame:
        last = self._last_snapshot()
        parts = self._read("counts/batches", f"{_COUNT_SCHEMA}, {_PART} bigint").where(F.col(_PART) > last)
        if upto is not None:
            parts = parts.where(F.col(_PART) <= upto)
        parts = parts.drop(_PART)
        if last >= 0:
            parts = parts.unionByName(self._read(f"counts/snapshots/{_PART}={last}", _COUNT_SCHEMA))
        return parts.groupBy(*COUNT_KEYS).agg(F.sum("click_count").alias("click_count"))

    def counts(self) -> DataFrame:
        """``window_start, window_end, province, city, ad_id, click_count`` of all clicks so far."""
        return self._sums()

    def refused(self) -> DataFrame:
        """``value, reason`` of all messages that are no clicks."""
        return self._read("refused", f"value string, reason string, {_PART} bigint").drop(_PART)

    def compact(self, batch: int) -> None:
        """Put the counts of all batches up to ``batch``, which must be finished, into one snapshot.

        Batches that a snapshot holds are no longer read and may be removed.
        """
        if batch > self._last_snapshot():
            self._sums(batch).write.mode("overwrite").parquet(f"{self.path}/counts/snapshots/{_PART}={batch}")

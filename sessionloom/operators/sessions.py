"""Session counts and lengths, in total and per hour.

A session is never held as a list of records: minimum, maximum and count per key are all
that is needed, and those combine on the map side, so a session with very many actions is
one small row per task before anything is shuffled.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sessionloom.functions.labels import INVALID_BELOW_MS, length_level
from sessionloom.functions.numbers import plain_number, round_half_up
from sessionloom.functions.times import required_time

HOUR = ["day", "hour"]
SESSION_HOUR = ["session_id", "day", "hour"]


def _length_ms(first: str, last: str) -> Column:
    return F.unix_millis(last) - F.unix_millis(first)


def _invalid(length: str = "length_ms") -> Column:
    return F.count_if(F.col(length) < INVALID_BELOW_MS)


def with_hour(actions: DataFrame) -> DataFrame:
    """Adds ``day`` and ``hour`` of the action time (the ``date`` column plays no part)."""
    timed = actions.withColumn("_ts", required_time("action_time"))
    return timed.withColumns(
        {"day": F.to_date("_ts").cast("string"), "hour": F.hour("_ts")}
    ).drop("_ts")


def session_lengths(actions: DataFrame) -> DataFrame:
    """``session_id, length_ms``: last action minus first."""
    return (
        actions.select("session_id", required_time("action_time").alias("ts"))
        .groupBy("session_id")
        .agg(F.min("ts").alias("first"), F.max("ts").alias("last"))
        .select("session_id", _length_ms("first", "last").alias("length_ms"))
    )


def session_hours(actions: DataFrame, *by: str) -> DataFrame:
    """One row per part of a session inside one hour: ``session_id, day, hour, n, last, first``,
    and for each value of the columns ``by``, where some are given.

    Everything per hour, and the sampling, starts here.  Grouping is by date and integer;
    the day becomes text only afterwards.  ``last`` stands before ``first`` as in their
    difference, so a branch that takes lengths only and one that takes the times are the
    same aggregation to the optimizer and share its shuffle.
    """
    times = actions.select("session_id", required_time("action_time").alias("ts"), *by)
    keys = ["session_id", F.to_date("ts").alias("_day"), F.hour("ts").alias("hour"), *by]
    return (
        times.select(*keys, "ts")
        .groupBy("session_id", "_day", "hour", *by)
        .agg(
            F.count(F.lit(1)).alias("n"), F.max("ts").alias("last"), F.min("ts").alias("first")
        )
        .select("session_id", F.col("_day").cast("string").alias("day"), "hour", "n", "last", "first", *by)
    )


def session_hour_lengths(actions: DataFrame) -> DataFrame:
    """``day, hour, session_id, length_ms``; a session across hours counts in each."""
    return session_hours(actions).select(
        "day", "hour", "session_id", _length_ms("first", "last").alias("length_ms")
    )


def session_totals(actions: DataFrame) -> DataFrame:
    """One row: sessions, their total length in seconds, and those shorter than a second."""
    return session_lengths(actions).agg(
        F.count(F.lit(1)).alias("total_session_count"),
        (F.coalesce(F.sum("length_ms"), F.lit(0)).cast("double") / 1000).alias(
            "total_session_length"
        ),
        _invalid().alias("invalid_session_count"),
    )


def session_length_levels(actions: DataFrame) -> DataFrame:
    """``level, session_count``; levels without sessions are absent."""
    return (
        session_lengths(actions)
        .groupBy(length_level("length_ms").alias("level"))
        .agg(F.count(F.lit(1)).alias("session_count"))
    )


def hour_session_count(actions: DataFrame) -> DataFrame:
    return session_hour_lengths(actions).groupBy(*HOUR).agg(F.count(F.lit(1)).alias("session_count"))


def hour_session_length(actions: DataFrame) -> DataFrame:
    """Summed length per hour in whole seconds; the sum is cut, not each session."""
    return (
        session_hour_lengths(actions)
        .groupBy(*HOUR)
        .agg(F.sum("length_ms").alias("total_ms"))
        .select(*HOUR, F.expr("total_ms div 1000").alias("session_length"))
    )


def hour_invalid_count(actions: DataFrame) -> DataFrame:
    """Parts shorter than a second, per hour; hours without one are absent."""
    return (
        session_hour_lengths(actions)
        .where(F.col("length_ms") < INVALID_BELOW_MS)
        .groupBy(*HOUR)
        .agg(F.count(F.lit(1)).alias("invalid_count"))
    )


def _listing(condition: Column, *fields: Column) -> Column:
    """The rows that meet the condition as a sorted array of structs."""
    return F.array_sort(F.collect_list(F.when(condition, F.struct(*fields))))


def session_statistics(actions: DataFrame) -> DataFrame:
    """All session figures of a request as one JSON text in one row, ``result_json``."""
    return statistics_of(session_hours(actions))


def statistics_of(parts: DataFrame) -> DataFrame:
    """``session_statistics`` from ``session_hours``, which may have been kept.

    Both halves read the same session-hour shuffle.  What reaches the single final row is
    already small: seven length levels and one row per hour of the period.
    """
    levels = (
        parts.groupBy("session_id")
        .agg(F.min("first").alias("first"), F.max("last").alias("last"))
        .select(_length_ms("first", "last").alias("length_ms"))
        .groupBy(length_level("length_ms").alias("level"))
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("length_ms").alias("total_ms"),
            _invalid().alias("invalid"),
        )
    )
    hours = (
        parts.select(*HOUR, _length_ms("first", "last").alias("length_ms"))
        .groupBy(*HOUR)
        .agg(
            F.count(F.lit(1)).alias("sessions"),
            F.sum("length_ms").alias("total_ms"),
            _invalid().alias("invalid"),
        )
    )
    of_level, of_hour = F.col("level").isNotNull(), F.col("day").isNotNull()
    count, day, hour = F.col("sessions").alias("count"), F.col("day"), F.col("hour")

    def total(column: str) -> Column:
        return F.coalesce(F.sum(F.when(of_level, F.col(column))), F.lit(0))

    return (
        levels.unionByName(hours, allowMissingColumns=True)
        .agg(
            total("sessions").alias("total_session_count"),
            plain_number(total("total_ms").cast("double") / 1000).alias("total_session_length"),
            total("invalid").alias("invalid_session_count"),
            _listing(of_level, F.col("level").alias("type"), count).alias(
                "pre_session_type_of_count"
            ),
            _listing(of_hour, day, hour, count).alias("pre_hour_of_session_count"),
            _listing(of_hour, day, hour, F.expr("total_ms div 1000").alias("length")).alias(
                "pre_hour_of_session_length"
            ),
            _listing(of_hour & (F.col("invalid") > 0), day, hour, F.col("invalid")).alias(
                "pre_hour_of_invalid_session_count"
            ),
        )
        .select(F.to_json(F.struct("*")).alias("result_json"))
    )


# Names and bounds of the ratio buckets; lengths in ms, upper bound excluded.
VISIT_LENGTH_BUCKETS = (
    ("1s_4s", 1_000, 4_000),
    ("4s_7s", 4_000, 7_000),
    ("7s_10s", 7_000, 10_000),
    ("10s_30s", 10_000, 30_000),
    ("30s_60s", 30_000, 60_000),
    ("1m_3m", 60_000, 180_000),
    ("3m_10m", 180_000, 600_000),
    ("10m_30m", 600_000, 1_800_000),
    ("30m", 1_800_000, None),
)
# Steps (records of a session), both bounds included.
STEP_LENGTH_BUCKETS = (
    ("1_3", 1, 3),
    ("4_6", 4, 6),
    ("7_9", 7, 9),
    ("10_29", 10, 29),
    ("30_59", 30, 59),
    ("60", 60, None),
)


def session_ratios(actions: DataFrame) -> DataFrame:
    """Share of sessions per visit-length and step-length bucket, one row.

    The bucket names are given; how they are filled is our own definition.  Sessions under
    a second fall in no length bucket.  Without sessions every ratio is null.
    """
    times = actions.select("session_id", required_time("action_time").alias("ts"))
    return _shares(
        times.groupBy("session_id").agg(
            F.min("ts").alias("first"), F.max("ts").alias("last"), F.count(F.lit(1)).alias("steps")
        )
    )


def ratios_of(parts: DataFrame) -> DataFrame:
    """``session_ratios`` from ``session_hours``, which may have been kept."""
    return _shares(
        parts.groupBy("session_id").agg(
            F.min("first").alias("first"), F.max("last").alias("last"), F.sum("n").alias("steps")
        )
    )


def _shares(sessions: DataFrame) -> DataFrame:
    sessions = sessions.select(_length_ms("first", "last").alias("length_ms"), "steps")
    buckets = {}
    for name, low, high in VISIT_LENGTH_BUCKETS:
        upper = "" if high is None else f" AND length_ms < {high}"
        buckets[f"visit_length_{name}_ratio"] = f"length_ms >= {low}{upper}"
    for name, low, high in STEP_LENGTH_BUCKETS:
        upper = "" if high is None else f" AND steps <= {high}"
        buckets[f"step_length_{name}_ratio"] = f"steps >= {low}{upper}"
    shares = F.array(*[F.expr(f"avg(int({inside}))") for inside in buckets.values()])
    return sessions.agg(
        F.count(F.lit(1)).alias("session_count"),
        F.transform(shares, lambda share: round_half_up(share)).alias("shares"),
    ).select(
        "session_count", *[F.col("shares")[i].alias(name) for i, name in enumerate(buckets)]
    )

"""The registered queries: ``name -> f(spark, sf_dir)``."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sessionloom import params
from sessionloom.functions import labels, numbers, records, rules, text, times
from sessionloom.functions.sql import register_counted_values, register_sql_functions
from sessionloom.operators import categories, filters, products, sampling, sessions
from sessionloom.plans import products as product_job
from sessionloom.plans.daily import SessionDays
from sessionloom.sinks import files as file_sinks
from sessionloom.sinks import jdbc as jdbc_sinks
from sessionloom.sources import files as file_sources
from sessionloom.sources import jdbc as jdbc_sources
from sessionloom.sources import tables
from sessionloom.sources.tables import read_table, register_views
from sessionloom.streaming import ad_clicks
from sessionloom.workspace import fresh_path, materialize
from verification.fixtures import AREA_LEVELS, SOME_AREA_LEVELS, Tables, load_tables

Query = Callable[[SparkSession, str], DataFrame]

TASK_ID = 7
RATIO = 0.1
FILTER = {
    "startDate": "2024-01-03",
    "endDate": "2024-01-25",
    "sex": "male",
    "professionals": "BUILDING,MACHINERY",
}
EXTENDED_FILTER = {
    "startDate": "2024-01-02",
    "startAge": "20",
    "endAge": "50",
    "cities": "NATION_1,NATION_2,NATION_3,NATION_5,NATION_8,NATION_13",
    "keywords": "kw_1,kw_2,kw_3,kw_4",
}

CLICK_FILTER = {"startAge": "18", "endAge": "45", "categoryIds": "1,3,5,7,11,13,17,19,23,29,31,37,41,43,47"}

_REGISTRY: dict[str, Query] = {}
_FUNCTIONS: dict[str, Callable[[Tables, SparkSession, str], DataFrame]] = {}

# Set this to the address of a database all executors reach, to run the JDBC queries on a
# cluster.  Where it is unset, and only in local mode, they use a database inside the
# Spark process, which no other process could see, not even the executors of a local-cluster.
JDBC_URL_SETTING = "spark.sessionloom.jdbc.url"


def query(function: Callable[[Tables, SparkSession, str], DataFrame]) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return function(load_tables(spark, sf_dir), spark, sf_dir)

    _REGISTRY[function.__name__] = run
    _FUNCTIONS[function.__name__] = function
    return run


def all_queries() -> dict[str, Query]:
    return dict(_REGISTRY)


def _jdbc_url(spark: SparkSession) -> str:
    url = spark.conf.get(JDBC_URL_SETTING, None)
    if url:
        return url
    master = spark.conf.get("spark.master", "")
    if master != "local" and not master.startswith("local["):
        raise ValueError(f"set {JDBC_URL_SETTING} to a database that all executors reach")
    return f"jdbc:derby:memory:check{uuid.uuid4().hex};create=true"


def _derived_table(name: str) -> str:
    return f"{name}_{uuid.uuid4().hex[:12]}"


# ---- sources and sinks ---------------------------------------------------------------


@query
def scan_user_info(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "user-info")
    file_sinks.write_delimited(t.user_info, path)
    return file_sources.read_user_info(spark, path)


@query
def scan_user_visit_action(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "user-visit-action")
    file_sinks.write_delimited(t.user_visit_action, path)
    return file_sources.read_user_visit_action(spark, path)


@query
def scan_product_info(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "product-info")
    file_sinks.write_delimited(t.product_info, path, file_sources.PRODUCT_SEPARATOR)
    return file_sources.read_product_info(spark, path)


@query
def export_roundtrip(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The delimited lines themselves, as written and read again."""
    path = fresh_path(spark, "export")
    file_sinks.write_delimited(t.user_visit_action, path)
    return spark.read.text(path)


@query
def sql_functions(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Frames registered under table names, read by name and by SQL text with functions."""
    register_views({"user_visit_action": t.user_visit_action, "city_info": t.city_info})
    register_sql_functions(spark)
    read_table(spark, "city_info").createOrReplaceTempView("known_city")
    return spark.sql(
        """
        SELECT a.session_id, concat_id_name(c.city_id, c.city_name) AS city,
          isNotEmpty(a.click_product_id) AS is_click,
          fetch_product_type_from_json(concat('{"product_type":"', a.page_id % 3, '"}'))
            AS product_type
        FROM user_visit_action a JOIN known_city c ON a.city_id = c.city_id
        """
    )


@query
def scan_city_info_jdbc(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    url, table = _jdbc_url(spark), _derived_table("city_info")
    jdbc_sinks.append_jdbc(t.city_info, url, table)
    rows = jdbc_sources.read_jdbc(
        spark, url, table, partition_column="city_id", bounds=(0, 25), num_partitions=4
    )
    return jdbc_sources.lower_case_columns(rows)


@query
def task_lookup(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    url = _jdbc_url(spark)
    jdbc_sinks.append_jdbc(
        t.tb_task, url, jdbc_sources.TASK_TABLE, column_types="task_param VARCHAR(1000)"
    )
    return jdbc_sources.find_task(spark, url, TASK_ID)


@query
def sink_top10_category_jdbc(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    url = _jdbc_url(spark)
    top = categories.top_categories(categories.category_op_counts(t.user_visit_action))
    jdbc_sinks.append_top_categories(top, TASK_ID, url)
    rows = jdbc_sources.read_jdbc(spark, url, jdbc_sinks.TOP_CATEGORY_TABLE)
    return jdbc_sources.lower_case_columns(rows).where(F.col("task_id") == TASK_ID)


def _written(spark: SparkSession, url: str, table: str) -> DataFrame:
    rows = jdbc_sources.lower_case_columns(jdbc_sources.read_jdbc(spark, url, table))
    return rows.where(F.col("task_id") == TASK_ID)


@query
def sink_category_sessions_jdbc(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Written twice, as by a job that is run again."""
    url = _jdbc_url(spark)
    merged = materialize(categories.merge_category_sessions(_top_sessions(t.user_visit_action)), "merged")
    for _ in range(2):
        jdbc_sinks.append_category_sessions(merged, TASK_ID, url)
    return _written(spark, url, jdbc_sinks.CATEGORY_SESSION_TABLE)


@query
def sink_statistics_jdbc(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    url = _jdbc_url(spark)
    statistics = materialize(sessions.session_statistics(t.user_visit_action), "statistics")
    for _ in range(2):
        jdbc_sinks.append_statistics(statistics, TASK_ID, url)
    return _written(spark, url, jdbc_sinks.STATISTICS_TABLE)


@query
def sink_sample_session_jdbc(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    url = _jdbc_url(spark)
    top = materialize(
        sampling.top_sampled_sessions(sampling.sample_sessions(t.user_visit_action, RATIO)),
        "top-sample",
    )
    documents = materialize(sampling.session_hour_documents(t.user_visit_action, top), "documents")
    jdbc_sinks.append_sample_sessions(documents, TASK_ID, url)
    rows = jdbc_sources.read_jdbc(spark, url, jdbc_sinks.SAMPLE_SESSION_TABLE)
    return jdbc_sources.lower_case_columns(rows).where(F.col("task_id") == TASK_ID)


@query
def sample_session_json(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "session-sample")
    sample = materialize(sampling.sample_sessions(t.user_visit_action, RATIO), "sample")
    file_sinks.write_sample_records(sampling.sampled_records(t.user_visit_action, sample), path)
    return spark.read.text(path)


@query
def top_session_records_json(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    path = fresh_path(spark, "top-session-records")
    top = _top_sessions(t.user_visit_action)
    file_sinks.write_session_records(categories.top_session_records(t.user_visit_action, top), path)
    return spark.read.text(path)


# ---- filters -------------------------------------------------------------------------


@query
def filter_actions(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_actions(t.user_visit_action, t.user_info, FILTER)


@query
def filter_actions_by_date(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without a user filter the user table is not touched."""
    dates = {"startDate": FILTER["startDate"], "endDate": FILTER["endDate"]}
    return filters.filter_actions(t.user_visit_action, None, dates)


@query
def filter_actions_extended(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_actions(t.user_visit_action, t.user_info, EXTENDED_FILTER, extended=True)


@query
def filter_clicks_extended(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks in some categories by users of some ages."""
    return filters.filter_clicks(t.user_visit_action, t.user_info, CLICK_FILTER, extended=True)


@query
def log_table_range(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three days of a catalog table that is partitioned by day and took one of them in twice."""
    table = _derived_table("action_log")
    tables.write_log_days(t.user_visit_action, table)
    tables.write_log_days(t.user_visit_action.where("date = '2024-01-04'"), table)
    days = {"startDate": "2024-01-03", "endDate": "2024-01-05"}
    return filters.filter_actions(read_table(spark, table), None, days)


@query
def filter_fields(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rules over records in field text."""
    fields = F.concat_ws("|", F.concat(F.lit("page="), "page_id"), F.concat(F.lit("city="), "city_id"), F.concat(F.lit("kw="), "search_keyword"))
    records = t.user_visit_action.select("session_id", fields.alias("fields"))
    wanted = rules.compile_rules(
        "fields", "low=10|high=70|cities=1,3,5,7,9,11|word=kw_3|other=",
        [("between", "page", "low", "high"), ("in", "city", "cities"), ("equal", "kw", "word"), ("equal", "page", "other")],
    )
    return records.where(wanted)


@query
def filter_clicks(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return filters.filter_clicks(t.user_visit_action, t.user_info, FILTER)


# ---- sessions ------------------------------------------------------------------------


@query
def session_lengths(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_lengths(t.user_visit_action)


@query
def session_totals(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_totals(t.user_visit_action)


@query
def session_length_levels(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_length_levels(t.user_visit_action)


@query
def session_hour_lengths(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_hour_lengths(t.user_visit_action)


@query
def hour_session_count(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.hour_session_count(t.user_visit_action)


@query
def hour_session_length(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.hour_session_length(t.user_visit_action)


@query
def hour_invalid_count(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.hour_invalid_count(t.user_visit_action)


@query
def session_aggr_json(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return jdbc_sinks.for_task(sessions.session_statistics(t.user_visit_action), TASK_ID)


@query
def session_ratio_stats(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sessions.session_ratios(t.user_visit_action)


def _kept_days(t: Tables, spark: SparkSession) -> SessionDays:
    """All days of the log, taken in as three deliveries, the second of them twice."""
    kept = SessionDays(spark, fresh_path(spark, "session-days"))
    date = F.col("date")
    for days in (date < "2024-01-09", date.between("2024-01-09", "2024-01-20"), date >= "2024-01-09"):
        kept.refresh(t.user_visit_action.where(days))
    return kept


@query
def session_aggr_json_daily(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return jdbc_sinks.for_task(_kept_days(t, spark).statistics({}), TASK_ID)


@query
def session_ratio_stats_daily(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _kept_days(t, spark).ratios({"startDate": FILTER["startDate"], "endDate": FILTER["endDate"]})


# ---- sampling ------------------------------------------------------------------------


@query
def sample_quota(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_quota(t.user_visit_action, RATIO)


@query
def sample_sessions(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_sessions(t.user_visit_action, RATIO)


@query
def sample_sessions_poisson(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.sample_sessions(t.user_visit_action, RATIO, "poisson")


@query
def sample_union_distinct(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two independent samples put together."""
    return sampling.union_samples(
        sampling.sample_sessions(t.user_visit_action, 0.01, seed=1),
        sampling.sample_sessions(t.user_visit_action, 0.05, seed=2),
    )


@query
def sample_session_records(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    sample = materialize(sampling.sample_sessions(t.user_visit_action, RATIO), "sample")
    return sampling.sampled_records(t.user_visit_action, sample)


@query
def sample_top5_sessions(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return sampling.top_sampled_sessions(sampling.sample_sessions(t.user_visit_action, RATIO))


@query
def sample_top5_records(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    top = materialize(
        sampling.top_sampled_sessions(sampling.sample_sessions(t.user_visit_action, RATIO)),
        "top-sample",
    )
    return sampling.top_sampled_records(t.user_visit_action, top)


# ---- categories ----------------------------------------------------------------------


def _top_sessions(actions: DataFrame) -> DataFrame:
    top = categories.top_categories(categories.category_op_counts(actions))
    return categories.category_top_sessions(categories.category_session_counts(actions, top))


@query
def category_events(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_events(t.user_visit_action)


@query
def category_op_counts(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_op_counts(t.user_visit_action)


@query
def category_top10_per_op(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.category_top_per_op(categories.category_op_counts(t.user_visit_action))


@query
def top10_category(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.top_categories(categories.category_op_counts(t.user_visit_action))


@query
def top10_category_full_counts(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = categories.category_op_counts(t.user_visit_action)
    return categories.top_categories(counts, full_counts=True)


@query
def category_session_counts(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    top = categories.top_categories(categories.category_op_counts(t.user_visit_action))
    return categories.category_session_counts(t.user_visit_action, top)


@query
def category_top10_sessions(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return _top_sessions(t.user_visit_action)


@query
def top10_category_sessions(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.merge_category_sessions(_top_sessions(t.user_visit_action))


@query
def top_session_records(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return categories.top_session_records(t.user_visit_action, _top_sessions(t.user_visit_action))


# ---- products ------------------------------------------------------------------------


@query
def product_city_clicks(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = filters.filter_clicks(t.user_visit_action, t.user_info, {})
    return products.product_city_clicks(clicks, t.city_info)


@query
def area_product_clicks(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    clicks = filters.filter_clicks(t.user_visit_action, t.user_info, {})
    return products.area_product_clicks(clicks, t.city_info)


@query
def area_top10_products(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_job.area_top10_products(
        t.user_visit_action, t.user_info, t.city_info, t.product_info, {}, levels=AREA_LEVELS
    )


@query
def area_top10_products_filtered(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_job.area_top10_products(
        t.user_visit_action, t.user_info, t.city_info, t.product_info, FILTER, levels=AREA_LEVELS
    )


@query
def counted_concat(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Search keywords with their counts per day."""
    searches = t.user_visit_action.where(text.is_not_blank("search_keyword"))
    return products.counted_concat(searches, ["date"], "search_keyword", "keywords")


@query
def counted_values(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sessions of each product's clicks as rows, however many a product has."""
    clicks = t.user_visit_action.where(text.is_real_id("click_product_id"))
    return products.counted_values(clicks, ["click_product_id"], "session_id")


@query
def counted_concat_parts(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same as texts of bounded length."""
    clicks = t.user_visit_action.where(text.is_real_id("click_product_id"))
    return products.counted_concat_parts(clicks, ["click_product_id"], "session_id", "sessions", items_per_row=3)


@query
def area_product_clicks_sql(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clicks per area and product with their cities, as SQL text."""
    register_sql_functions(spark)
    clicks = filters.filter_clicks(t.user_visit_action, t.user_info, {})
    register_views({"tmp_basic_product_city_info": products.product_city_clicks(clicks, t.city_info)})
    register_counted_values(
        spark, "product_city_counts", "tmp_basic_product_city_info",
        {"area": "STRING", "click_product_id": "STRING"}, "concat_id_name(city_id, city_name)",
    )
    return spark.sql(
        """
        SELECT area, click_product_id, sum(n) AS click_count,
          concat_distinct_str(collect_list(struct(value, n))) AS city_infos
        FROM product_city_counts()
        GROUP BY area, click_product_id
        """
    )


# ---- functions -----------------------------------------------------------------------


@query
def scalar_functions(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    fields = F.concat(F.lit("a="), "page_id", F.lit("|b="), "user_id", F.lit("|c="))
    noon = F.concat("date", F.lit(" 12:00:00"))
    listed = F.concat(F.lit(","), "search_keyword", F.lit(","))
    info = F.concat(F.lit('{"product_type":"'), F.col("page_id") % 3, F.lit('"}'))
    millis = times.to_millis("action_time")
    return t.user_visit_action.select(
        "session_id",
        millis.alias("millis"),
        times.from_millis(millis).alias("time_text"),
        times.from_millis(millis, times.DATE_FORMAT).alias("day_text"),
        *[times.time_field(millis + 5, name).alias(f"time_{name}") for name in times.TIME_FIELDS],
        text.is_blank("search_keyword").alias("no_search"),
        text.is_real_id("click_product_id").alias("is_click"),
        F.array_join(text.split_ids("order_product_ids"), "+").alias("ordered"),
        text.concat_id_name("city_id", "search_keyword").alias("id_name"),
        labels.product_label(info).alias("product_type"),
        labels.area_level(F.concat(F.lit("area_"), F.col("page_id") % 3), {"area_1": "A"}).alias(
            "area_level"
        ),
        labels.length_level(F.col("page_id") * 4000).alias("level"),
        numbers.plain_number(F.col("page_id") / 8).alias("plain"),
        numbers.round_half_up(F.col("page_id") / 7).alias("rounded"),
        records.record_json().alias("record"),
        times.is_before("action_time", noon).alias("before_noon"),
        times.is_after("action_time", noon).alias("after_noon"),
        times.seconds_between("action_time", noon).alias("since_noon"),
        times.date_hour_key("action_time").alias("hour_key"),
        times.minute_key(times.parse_time("action_time")).alias("minute_key"),
        text.trim_comma(listed).alias("trimmed"),
        text.pad_two(F.col("page_id").cast("string")).alias("padded"),
        text.get_field(fields, "b").alias("field_b"),
        text.get_field(fields, "c").alias("field_c"),
        text.set_field(fields, "a", "z").alias("field_set"),
    )


# ---- ad clicks -----------------------------------------------------------------------


@query
def ad_click_parse(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_clicks.parse_ad_clicks(t.ad_message)


@query
def ad_click_counts(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    return ad_clicks.count_ad_clicks(ad_clicks.parse_ad_clicks(t.ad_message))


@query
def ad_click_counts_stream(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same counts from a feed over message files, read in several batches to its end."""
    return _fed_table(t.ad_message, spark).counts()


@query
def ad_click_refused(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Accepted and refused messages of a feed; together they are all that was read."""
    table = _fed_table(t.ad_feed, spark)
    good = table.counts().agg(F.sum("click_count").alias("messages"))
    bad = table.refused().groupBy("reason").agg(F.count(F.lit(1)).alias("messages"))
    return good.select(F.lit("accepted").alias("reason"), "messages").unionByName(bad)


def _fed_table(messages: DataFrame, spark: SparkSession) -> ad_clicks.AdClickTable:
    source = fresh_path(spark, "ad-messages")
    file_sinks.write_lines(messages.repartition(4), source)
    feed = spark.readStream.option("maxFilesPerTrigger", 2).text(source)
    table = ad_clicks.AdClickTable(spark, fresh_path(spark, "ad-counts"))
    checkpoint = fresh_path(spark, "ad-checkpoint")
    table.start(feed, checkpoint, available_now=True).awaitTermination()
    table.compact(0)
    return table


@query
def ad_click_counts_closed(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts of the windows that a watermarked stream over message files has closed."""
    source = fresh_path(spark, "ad-messages")
    file_sinks.write_lines(t.ad_message, source)
    counts = ad_clicks.count_ad_clicks(ad_clicks.parse_ad_clicks(spark.readStream.text(source)))
    path, checkpoint = fresh_path(spark, "ad-counts"), fresh_path(spark, "ad-checkpoint")
    ad_clicks.run_ad_click_counts(counts, path, checkpoint, available_now=True).awaitTermination()
    return spark.read.schema(counts.schema).parquet(path)


# ---- the same operators on richer input ------------------------------------------------

#: Queries that are run on ``rich_action`` as well, under their name and ``_rich``.
ON_RICH_INPUT = [
    "session_totals", "session_length_levels", "session_hour_lengths", "hour_session_count",
    "hour_session_length", "hour_invalid_count", "session_aggr_json", "session_ratio_stats",
    "sample_quota", "sample_sessions", "sample_sessions_poisson", "sample_session_records", "sample_top5_sessions",
    "category_events", "category_op_counts", "top10_category", "top10_category_full_counts",
    "category_session_counts", "category_top10_sessions", "top10_category_sessions", "top_session_records",
    "product_city_clicks", "area_product_clicks", "area_top10_products",
]


def _on_rich_input(name: str) -> None:
    function = _FUNCTIONS[name]

    def rich(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
        t.user_visit_action = t.rich_action
        return function(t, spark, sf_dir)

    rich.__name__ = f"{name}_rich"
    query(rich)


for _name in ON_RICH_INPUT:
    _on_rich_input(_name)


@query
def area_levels_rich(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """With areas that have no level, and products that have no entry."""
    return product_job.area_top10_products(
        t.rich_action, t.user_info, t.city_info, t.product_info, {}, levels=SOME_AREA_LEVELS
    )


@query
def request_parameters(t: Tables, spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sampling ratio and kind of some requests, and the quota they lead to."""
    requests = [
        {}, {"sessionRatio": "0.05"}, {"sessionRatio": 0.1, "sampleType": "poisson"}, {"sessionRatio": "0.2"},
        {"sessionRatio": " 2e-2 ", "sampleType": "Poisson"}, {"sessionRatio": "x", "sampleType": "bernoulli"}, {"sessionRatio": "-1"},
    ]
    frames = [
        sampling.sample_quota(t.rich_action, params.sample_ratio(request))
        .agg(F.sum("session_count").alias("sessions"), F.sum("quota").alias("quota"))
        .select(
            F.lit(number).alias("request"), F.lit(params.sample_ratio(request)).alias("ratio"),
            F.lit(params.sample_type(request)).alias("kind"), "sessions", "quota",
        )
        for number, request in enumerate(requests)
    ]
    return reduce(DataFrame.unionByName, frames)

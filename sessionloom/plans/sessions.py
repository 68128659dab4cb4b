"""Session analysis: statistics, samples, category ranking, and their outputs."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from sessionloom import params as P
from sessionloom.operators import categories, filters, sampling, sessions
from sessionloom.sinks import files, jdbc
from sessionloom.sources.jdbc import load_task_params
from sessionloom.sources.tables import read_action_tables
from sessionloom.workspace import temporary_tables


def analyze_sessions(
    actions: DataFrame,
    users: DataFrame | None,
    params: dict,
    seed: int = sampling.DEFAULT_SEED,
    extended: bool = False,
) -> dict[str, DataFrame]:
    """All result frames of a request, lazy; nothing is cached.

    With ``extended`` the age, city, keyword and category parameters count; without it a request
    that sets one is refused.
    """
    filters.refuse_unused(params, extended)
    filtered = filters.filter_actions(actions, users, params, extended)
    sample = sampling.sample_sessions(
        filtered, P.sample_ratio(params), P.sample_type(params), seed
    )
    top_sample = sampling.top_sampled_sessions(sample)
    top_categories = categories.top_categories(categories.category_op_counts(filtered))
    top_sessions = categories.category_top_sessions(
        categories.category_session_counts(filtered, top_categories)
    )
    return {
        "actions": filtered,
        "statistics": sessions.session_statistics(filtered),
        "sample": sample,
        "sample_records": sampling.sampled_records(filtered, sample),
        "sample_documents": sampling.session_hour_documents(filtered, top_sample),
        "top_categories": top_categories,
        "category_sessions": categories.merge_category_sessions(top_sessions),
        "top_session_records": categories.top_session_records(filtered, top_sessions),
    }


def run_session_job(
    spark: SparkSession,
    task_id: int,
    url: str,
    output: str,
    properties: Mapping[str, str] | None = None,
    seed: int = sampling.DEFAULT_SEED,
    extended: bool = False,
) -> None:
    """The whole job for one task of the task table.

    Reads the tables ``user_visit_action`` and, where needed, ``user_info``; appends to the result tables
    at ``url`` and writes the detail records under ``output``.  What several outputs share
    is written to the shared folder once: the actions when a user filter needs a join, and
    the small results (sample, rankings), whose real size then decides how they are joined.
    So are the users that a filter leaves, which then spare the log its shuffle where they are few,
    and the documents, as the few connections of the sink would narrow their last stage.

    The log is passed over five times: for its session-hours, which hold all that statistics and
    sampling need, for the operations of its sessions, which hold both rankings, and once for
    the records of each of the three detail outputs.
    """
    params = load_task_params(spark, url, task_id, properties)
    filters.refuse_unused(params, extended)
    actions, users = read_action_tables(spark, params, extended)
    with temporary_tables(spark) as materialize:
        if users is not None:
            users = materialize(filters.wanted_users(users, params, extended), "users")
        actions = filters.filter_actions(actions, users, params, extended)
        if users is not None:
            actions = materialize(actions, "actions")

        parts = materialize(sessions.session_hours(actions), "session-hours")
        jdbc.append_statistics(sessions.statistics_of(parts), task_id, url, properties)

        ratio, kind = P.sample_ratio(params), P.sample_type(params)
        sample = materialize(sampling.sample_of(parts, ratio, kind, seed), "sample")
        files.write_sample_records(
            sampling.sampled_records(actions, sample), f"{output}/session_sample/task_{task_id}"
        )
        top_sample = materialize(sampling.top_sampled_sessions(sample), "top-sample")
        documents = materialize(
            sampling.session_hour_documents(actions, top_sample), "documents"
        )
        jdbc.append_sample_sessions(documents, task_id, url, properties)

        session_ops = materialize(categories.category_session_ops(actions), "session-ops")
        counts = categories.op_counts_of(session_ops)
        top_categories = materialize(categories.top_categories(counts), "top-categories")
        jdbc.append_top_categories(top_categories, task_id, url, properties)

        session_counts = categories.session_counts_of(session_ops, top_categories)
        top_sessions = materialize(
            categories.category_top_sessions(session_counts), "top-sessions"
        )
        merged = categories.merge_category_sessions(top_sessions)
        jdbc.append_category_sessions(merged, task_id, url, properties)
        files.write_session_records(
            categories.top_session_records(actions, top_sessions),
            f"{output}/top10_category_session/task_{task_id}",
        )

"""Session figures kept day by day equal those over the whole log."""

from data import action, actions, rows
from sessionloom.operators import sessions
from sessionloom.plans.daily import SessionDays

LOG = [
    action("a", "2024-01-01 23:59:50"),
    action("a", "2024-01-02 00:00:05"),
    action("b", "2024-01-02 10:00:00"),
    action("b", "2024-01-02 10:59:59"),
    action("c", "2024-01-03 10:00:00"),
    # two dates of the log inside one hour
    action("d", "2024-01-03 11:00:00", date="2024-01-03"),
    action("d", "2024-01-03 11:00:30", date="2024-01-04"),
]


def figures(parts):
    return rows(sessions.statistics_of(parts)), rows(sessions.ratios_of(parts))


def test_days_equal_the_log(spark, tmp_path):
    kept = SessionDays(spark, str(tmp_path / "days"))
    assert kept.session_hours({}).count() == 0
    log = actions(spark, *LOG)
    for date in ("2024-01-01", "2024-01-02", "2024-01-03", "2024-01-04", "2024-01-02"):
        kept.refresh(log.where(f"date = '{date}'"))
    assert rows(kept.session_hours({})) == rows(sessions.session_hours(log).select(*kept.session_hours({}).columns))
    assert figures(kept.session_hours({})) == figures(sessions.session_hours(log))
    assert rows(kept.statistics({})) == rows(sessions.session_statistics(log))
    assert rows(kept.ratios({})) == rows(sessions.session_ratios(log))
    some = {"startDate": "2024-01-02", "endDate": "2024-01-03"}
    within = log.where("date BETWEEN '2024-01-02' AND '2024-01-03'")
    assert rows(kept.statistics(some)) == rows(sessions.session_statistics(within))
    assert rows(kept.ratios(some)) == rows(sessions.session_ratios(within))


def test_a_day_delivered_again_replaces_itself_alone(spark, tmp_path):
    kept = SessionDays(spark, str(tmp_path / "days"))
    kept.refresh(actions(spark, *LOG))
    kept.refresh(actions(spark, action("z", "2024-01-02 08:00:00")))
    assert sorted({r["session_id"] for r in kept.days().where("date = '2024-01-02'").collect()}) == ["z"]
    assert kept.days().where("date <> '2024-01-02'").count() == 4


def test_a_range_reads_its_days_only(spark, tmp_path):
    kept = SessionDays(spark, str(tmp_path / "days"))
    kept.refresh(actions(spark, *LOG))
    plan = kept.session_hours({"startDate": "2024-01-03"})._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan

"""Calendar, run log, feed identifiers and backfill plan on small logs."""

import datetime as dt
import json

from tickloom.operators import runs
from tickloom.schemas import RUN_LOG

FRIDAY, SATURDAY, MONDAY = dt.date(2026, 5, 29), dt.date(2026, 5, 30), dt.date(2026, 6, 1)


def at(hour):
    return dt.datetime(2026, 5, 29, hour)


def log(spark, *entries):
    return spark.createDataFrame(list(entries), RUN_LOG)


def test_calendar(spark):
    spring = runs.requested_days(spark, first=dt.date(2026, 3, 1), last=dt.date(2026, 4, 30))
    assert spring.count() == 44
    assert runs.requested_days(spark, first=MONDAY, last=FRIDAY).isEmpty()
    assert [r.job_date for r in runs.requested_days(spark, SATURDAY).collect()] == [SATURDAY]
    assert runs.requested_days(spark).first().job_date == dt.date.today()


def test_latest_state_wins(spark):
    day = "2026-05-29"
    entries = log(
        spark,
        (day, "running", at(1), None, None), (day, "success", at(1), at(2), "[]"),
        ("2026-06-01", "failed", at(1), at(2), "x"), ("2026-06-01", "running", at(3), None, None),
    )
    state = {r.job_date: r.status for r in runs.latest_runs(entries).collect()}
    assert state == {day: "success", "2026-06-01": "running"}
    report = runs.outcome_report(runs.latest_runs(entries)).collect()
    report = {r.status: (r.day_count, r.days) for r in report}
    assert report == {"success": (1, day), "running": (1, "2026-06-01")}


def test_outcome_and_report(spark):
    def files(*states):
        return json.dumps([{"filename": f"f{i}", "status": s} for i, s in enumerate(states)])

    entries = log(
        spark,
        ("a", "running", at(1), at(2), files("success", "success")),
        ("b", "running", at(1), at(2), files("success", "timed out")),
        ("c", "skipped", at(1), at(2), "Holiday or Weekend"),
        ("d", "running", at(1), None, None),
        ("e", "running", at(1), at(2), "[]"),
        ("f", "running", at(1), at(2), '[{"filename":"x"}]'),
    )
    outcome = {r.job_date: r.outcome for r in runs.run_outcome(entries).collect()}
    assert outcome == {
        "a": "success", "b": "failed", "c": "skipped", "d": "running", "e": "success", "f": "failed"
    }
    report = runs.run_report(entries).collect()
    assert sorted((r.job_date, r.filename or "", r.note or "") for r in report) == [
        ("a", "f0", ""), ("a", "f1", ""), ("b", "f0", ""), ("b", "f1", ""),
        ("c", "", "Holiday or Weekend"), ("d", "", ""), ("e", "", ""), ("f", "x", ""),
    ]


def test_feed_identifiers(spark):
    days = spark.createDataFrame([(FRIDAY,), (MONDAY,), (dt.date(2026, 6, 2),)], "job_date date")
    header = "attachment; filename=WEBPXTICK_DT-20260529.zip"
    probes = spark.createDataFrame(
        [
            (FRIDAY, 6210, 404, None, None), (FRIDAY, 6211, 200, header, None),
            (MONDAY, 6213, None, None, "connection reset"), (MONDAY, 6212, 404, header, None),
            (dt.date(2026, 6, 2), 6214, 404, None, None),
        ],
        "job_date date, feed_id int, status_code int, content_disposition string, error string",
    )
    found = {r.job_date: (r.feed_id, r.origin) for r in runs.resolve_feed_ids(days, probes).collect()}
    assert found == {
        FRIDAY: (6211, "catalog"), MONDAY: (6213, "estimate"), dt.date(2026, 6, 2): (None, "holiday")
    }
    exact = runs.resolve_feed_ids(days, probes, inclusive=False)
    assert {r.job_date: r.feed_id for r in exact.collect()}[MONDAY] == 6212


def test_backfill_plan(spark):
    days = [dt.date(2026, 6, d) for d in (1, 2, 3, 4)]
    frame = spark.createDataFrame([(d,) for d in days], "job_date date")
    complete = spark.createDataFrame(
        [(days[0], True), (days[1], False)], "job_date date, complete boolean"
    )
    current = spark.createDataFrame(
        [(days[1], "failed"), (days[2], "skipped")], "job_date date, status string"
    )
    plan = runs.backfill_plan(frame, complete, current)
    assert [r.action for r in plan.orderBy("job_date").collect()] == ["etl", "land", "skip", "land"]
    forced = runs.backfill_plan(frame, complete, current, skip_ingestion=True)
    assert {r.action for r in forced.collect()} == {"etl"}

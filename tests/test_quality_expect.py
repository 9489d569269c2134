"""Quality profile and declarative column tests."""

import datetime as dt

from pyspark.sql import functions as F

from tripkit.operators import expect as X
from tripkit.operators.expect import RULES, Rule, run_tests
from tripkit.plans import marts
from tripkit.plans.quality import dq_clean_estimate, dq_report, dq_summary, render_report
from tripkit.plans.staging import clean_trips
from tripkit.sources.fixture import trips_view
from tripkit.sources.schema import TRIPS

from conftest import SF01


def test_dq_summary_expected_counts(spark):
    s = dq_summary(trips_view(spark, SF01)).first()
    assert s.total_rows == 60000
    assert (s.negative_count, s.zero_distance_count, s.extreme_count, s.incoherent_dates_count) == (1944, 30, 65, 707)
    assert s.null_count == 10530
    assert s.negative_pct == round(1944 * 100 / 60000, 2)
    est = dq_clean_estimate(dq_summary(trips_view(spark, SF01))).first()
    assert est.clean_rows_estimate == 60000 - 10530 - 1944 - 30 - 65 - 707


def test_dq_empty_guard(spark):
    empty = spark.createDataFrame([], TRIPS)
    s = dq_summary(empty).first()
    assert s.total_rows == 0 and s.null_count is None and s.null_pct is None
    rep = dq_report(dq_summary(empty)).collect()
    assert "No rows" in render_report([r.asDict() for r in rep])


def test_thirteen_checks_pass_on_build(spark):
    c = clean_trips(trips_view(spark, SF01))
    tables = {"clean_trips": c, **{n: fn(c) for n, fn in marts.MARTS.items()}}
    res = run_tests(spark, tables).orderBy("rule_order").collect()
    assert len(res) == 13 == len(RULES)
    assert all(r.passed for r in res), [r for r in res if not r.passed]


def test_planted_faults_fail(spark):
    daily = spark.createDataFrame(
        [(dt.date(2024, 1, 1), 3), (dt.date(2024, 1, 1), 4), (None, -1), (dt.date(2024, 1, 2), None)],
        "pickup_date date, total_trips bigint")
    rules = [Rule("daily_summary", "pickup_date", "not_null"), Rule("daily_summary", "pickup_date", "unique"),
             Rule("daily_summary", "total_trips", "not_null"),
             Rule("daily_summary", "total_trips", "accepted_range", 0)]
    res = {(r.column_name, r.test): r.failures
           for r in run_tests(spark, {"daily_summary": daily}, rules).collect()}
    assert res == {("pickup_date", "not_null"): 1, ("pickup_date", "unique"): 1,
                   ("total_trips", "not_null"): 1, ("total_trips", "accepted_range"): 1}
    assert X.test_unique(daily, "pickup_date").first().n_records == 2


def test_range_bounds_inclusive_and_null_passes(spark):
    h = spark.createDataFrame([(0,), (23,), (24,), (-1,), (None,)], "pickup_hour int")
    r = run_tests(spark, {"hourly_patterns": h}, [Rule("hourly_patterns", "pickup_hour", "accepted_range", 0, 23)]).first()
    assert r.failures == 2 and not r.passed
    assert h.filter(F.col("pickup_hour").isNull()).count() == 1

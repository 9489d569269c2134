"""The README's usage steps, end to end, on small month files."""

import os

from tripkit.operators.expect import RULES
from tripkit.plans import dashboard as DB
from tripkit.plans import quality as Q
from tripkit.plans.build import build_and_test
from tripkit.session import materialize
from tripkit.sources.months import load_months, load_summary

from test_sources import write_months


def test_usage_pipeline(spark, tmpdir_path):
    months = write_months(tmpdir_path)          # three good months and one unreadable file
    target = os.path.join(tmpdir_path, "raw_trips")
    raw, report = load_months(spark, months, target=target, truncate=True)
    s = load_summary(report).first()
    assert (s.ok_months, s.total_months, s.total_rows) == (3, 4, 9)
    assert Q.dq_summary(raw).first().total_rows == 9
    tables, tests = build_and_test(spark, raw)
    assert tests.count() == len(RULES)
    dash = DB.dashboard_load(raw, materialize=materialize)
    assert dash["dash_profile"].first().total_trips == 9
    days = DB.complete_days(dash["dash_daily"])
    k = DB.kpis(days).first()
    assert k.total_trips == 9 and abs(k.total_revenue - 9 * 14.0) < 1e-9
    assert DB.weekly_profile(days, "total_revenue").count() == 7

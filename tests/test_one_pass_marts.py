"""The single-scan GROUPING SETS build equals the four separate marts."""

from pyspark.sql import functions as F

from tripkit.plans import marts
from tripkit.plans.staging import clean_trips
from tripkit.session import materialize
from tripkit.sources.fixture import trips_view

from conftest import SF001


def _rows(df):
    cols = sorted(df.columns)
    out = []
    for r in df.select(*cols).collect():
        out.append(tuple(round(v, 6) if isinstance(v, float) else v for v in r))
    return sorted(out, key=repr)


def test_one_pass_equals_separate(spark, capsys):
    c = clean_trips(trips_view(spark, SF001))
    one = marts.all_marts(c, materialize)
    for name, fn in marts.MARTS.items():
        sep = fn(c)
        assert one[name].columns == sep.columns, name
        assert _rows(one[name]) == _rows(sep), name
    # one scan of the trips for all four marts
    marts.all_marts(c)["daily_summary"].explain(mode="formatted")
    out = capsys.readouterr().out
    assert "Expand" in out


def test_one_pass_counts(spark):
    c = clean_trips(trips_view(spark, SF001))
    one = marts.all_marts(c)
    n = c.count()
    for name, df in one.items():
        assert df.agg(F.sum("total_trips")).first()[0] == n, name


def test_checks_in_the_one_pass_equal_separate_checks(spark):
    """Staging row checks computed inside the marts' pass give the same
    failures as a separate scan, with and without a planted fault."""
    from tripkit.operators.expect import row_check_aggregates, run_tests

    base = clean_trips(trips_view(spark, SF001))
    # planted faults: negative speed on some rows, NULL duration on others
    faulty = base.withColumn("avg_speed_mph", F.when(F.col("pickup_hour") == 3, F.lit(-1.0))
                             .otherwise(F.col("avg_speed_mph"))) \
        .withColumn("trip_duration_minutes", F.when(F.col("pickup_hour") == 4, F.lit(None).cast("bigint"))
                    .otherwise(F.col("trip_duration_minutes")))
    for c in (base, faulty, base.limit(0)):
        m = marts.all_marts(c, materialize, extra_aggs=row_check_aggregates("clean_trips"))
        fused = run_tests(spark, {"clean_trips": c, **m}, counted={"clean_trips": m.pop("extra")})
        plain = run_tests(spark, {"clean_trips": c, **marts.all_marts(c, materialize)})
        assert sorted(map(tuple, fused.collect())) == sorted(map(tuple, plain.collect()))
        if c is faulty:
            failed = {(r.column_name, r.test) for r in fused.collect() if not r.passed}
            assert failed == {("avg_speed_mph", "accepted_range"), ("trip_duration_minutes", "not_null")}

"""Property checks: per-trip expressions against plain-Python definitions.

Each generated example is a batch of random rows evaluated by one Spark job,
so a handful of examples covers hundreds of rows per property.
"""

import datetime as dt
from decimal import ROUND_HALF_UP, Decimal

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripkit.functions import derive as D

SETTINGS = settings(max_examples=6, deadline=None,
                    suppress_health_check=[HealthCheck.too_slow, HealthCheck.data_too_large])
TS = st.datetimes(min_value=dt.datetime(2000, 1, 1), max_value=dt.datetime(2030, 12, 31))
EDGES = [1.0, 1.005, 1.01, 5.0, 5.005, 5.01, 10.0, 10.01, 0.0, -1.0]


def py_minutes(t0, t1):
    """Minute boundaries crossed (DATEDIFF('minute') semantics)."""
    def floor(t):
        return t.replace(second=0, microsecond=0)
    return (floor(t1) - floor(t0)) // dt.timedelta(minutes=1)


def py_category(d):
    if d is None:
        return "Non défini"
    if d <= 1:
        return "Courts trajets"
    if 1.01 <= d <= 5:
        return "Trajets moyens"
    if 5.01 <= d <= 10:
        return "Longs trajets"
    if d > 10:
        return "Très longs trajets"
    return "Non défini"


def py_tip_percentage(tip, fare):
    """fare > 0 ? ROUND(tip*100/fare, 2) half-up through 6 decimals : 0."""
    if fare is None or not fare > 0:
        return 0.0
    if tip is None:
        return None
    x = tip * 100.0 / fare
    six = Decimal(repr(x)).quantize(Decimal("0.000001"), rounding=ROUND_HALF_UP)
    return float(six.quantize(Decimal("0.01"), rounding=ROUND_HALF_UP))


def py_time_period(h):
    for lo, hi, label in D.TIME_PERIODS:
        if lo <= h <= hi:
            return label
    return D.TIME_PERIOD_ELSE


def py_tranche(h):
    for lo, hi, label in D.TRANCHES:
        if lo <= h <= hi:
            return label
    return D.TRANCHE_ELSE


@SETTINGS
@given(st.lists(st.tuples(TS, st.integers(-2 * 86400, 3 * 86400), st.integers(0, 999_999),
                          st.floats(0, 150, allow_nan=False)), min_size=1, max_size=200))
def test_duration_and_speed(spark, rows):
    data = [(t0, t0 + dt.timedelta(seconds=s, microseconds=us), d) for t0, s, us, d in rows]
    df = spark.createDataFrame(
        data, "tpep_pickup_datetime timestamp_ntz, tpep_dropoff_datetime timestamp_ntz, trip_distance double")
    m = D.trip_duration_minutes()
    got = df.select(m.alias("m"), D.avg_speed_mph(minutes=m).alias("v")).collect()
    for (t0, t1, d), r in zip(data, got):
        want = py_minutes(t0, t1)
        assert r.m == want, (t0, t1)
        assert r.v == (d / (want / 60.0) if want > 0 else 0.0)


@SETTINGS
@given(st.lists(st.one_of(st.none(), st.sampled_from(EDGES), st.floats(-5, 200, allow_nan=False)),
                min_size=1, max_size=200))
def test_distance_category(spark, values):
    df = spark.createDataFrame([(v,) for v in values], "trip_distance double")
    got = [r[0] for r in df.select(D.distance_category()).collect()]
    assert got == [py_category(v) for v in values]


CENTS = st.integers(-5_000, 50_000).map(lambda c: c / 100)


@SETTINGS
@given(st.lists(st.tuples(st.one_of(st.none(), CENTS), st.one_of(st.none(), CENTS)), min_size=1, max_size=200))
def test_tip_percentage_half_up(spark, rows):
    df = spark.createDataFrame(rows, "tip_amount double, fare_amount double")
    got = [r[0] for r in df.select(D.tip_percentage()).collect()]
    assert got == [py_tip_percentage(t, f) for t, f in rows]


@SETTINGS
@given(st.lists(TS, min_size=1, max_size=200))
def test_calendar_columns(spark, stamps):
    df = spark.createDataFrame([(t,) for t in stamps], "tpep_pickup_datetime timestamp_ntz")
    dow = D.pickup_day_of_week()
    rows = df.select(D.pickup_hour().alias("h"), dow.alias("dow"), D.day_type(dow).alias("dt"),
                     D.pickup_month().alias("mo"), D.pickup_date().alias("d"),
                     D.time_period(D.pickup_hour()).alias("tp"), D.tranche(D.pickup_hour()).alias("tr")).collect()
    for t, r in zip(stamps, rows):
        want_dow = (t.weekday() + 1) % 7          # 0 = Sunday
        assert (r.h, r.dow, r.mo, r.d) == (t.hour, want_dow, t.month, t.date())
        assert r.dt == ("Weekend" if want_dow in (0, 6) else "Jours de semaine")
        assert (r.tp, r.tr) == (py_time_period(t.hour), py_tranche(t.hour))


@SETTINGS
@given(st.lists(st.datetimes(min_value=dt.datetime(1900, 1, 1), max_value=dt.datetime(2100, 12, 31)),
                min_size=1, max_size=200))
def test_epoch_round_trip(spark, stamps):
    """epoch_repair inverts to_epoch in every unit (to the unit's precision)."""
    from tripkit.functions.dates import epoch_repair, to_epoch

    df = spark.createDataFrame([(t,) for t in stamps], "t timestamp_ntz")
    cols = [epoch_repair(to_epoch("t", u), u).alias(u) for u in ("us", "ms", "s")]
    rows = df.select(*cols).collect()
    for t, r in zip(stamps, rows):
        assert r.us == t
        assert r.ms == t.replace(microsecond=t.microsecond // 1000 * 1000)
        assert r.s == t.replace(microsecond=0)

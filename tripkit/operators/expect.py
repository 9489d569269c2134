"""Declarative column tests (not_null, unique, accepted_range).

``run_tests`` evaluates a rule list against named tables. All not_null and
accepted_range checks on one table are fused into a single aggregate; each
unique check is one grouped count, and a table with one unique check gets its
row checks inside that grouped count (one read of the table). Failures are
reported, never raised.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    model: str
    column: str
    test: str                 # "not_null" | "unique" | "accepted_range"
    min_value: float | None = None
    max_value: float | None = None


# The 13 checks declared for the staging table and three marts.
RULES = [
    Rule("clean_trips", "trip_duration_minutes", "not_null"),
    Rule("clean_trips", "trip_duration_minutes", "accepted_range", 0),
    Rule("clean_trips", "avg_speed_mph", "accepted_range", 0),
    Rule("clean_trips", "tip_percentage", "accepted_range", 0),
    Rule("daily_summary", "pickup_date", "not_null"),
    Rule("daily_summary", "pickup_date", "unique"),
    Rule("daily_summary", "total_trips", "not_null"),
    Rule("daily_summary", "total_trips", "accepted_range", 0),
    Rule("zone_analysis", "pickup_zone", "not_null"),
    Rule("zone_analysis", "pickup_zone", "unique"),
    Rule("hourly_patterns", "pickup_hour", "not_null"),
    Rule("hourly_patterns", "pickup_hour", "unique"),
    Rule("hourly_patterns", "pickup_hour", "accepted_range", 0, 23),
]


def not_null_failure(col: str) -> Column:
    """Failing row: the value is NULL."""
    return F.col(col).isNull()


def accepted_range_failure(col: str, lo=None, hi=None, inclusive: bool = True) -> Column:
    """Failing row: NOT (x >= lo AND x <= hi). A NULL value passes."""
    c = F.col(col)
    conds = []
    if lo is not None:
        conds.append(c >= lo if inclusive else c > lo)
    if hi is not None:
        conds.append(c <= hi if inclusive else c < hi)
    ok = reduce(lambda a, b: a & b, conds) if conds else F.lit(True)
    return ~ok


def test_not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(not_null_failure(col))


def test_accepted_range(df: DataFrame, col: str, lo=None, hi=None) -> DataFrame:
    return df.filter(accepted_range_failure(col, lo, hi))


def test_unique(df: DataFrame, col: str) -> DataFrame:
    """Failing groups: non-NULL values that occur more than once."""
    return (df.filter(F.col(col).isNotNull()).groupBy(col)
            .agg(F.count(F.lit(1)).alias("n_records")).filter(F.col("n_records") > 1))


def _label(r: Rule) -> str:
    return r.test


def row_check_aggregates(model: str, rules=RULES) -> list[Column]:
    """The not_null / accepted_range checks of one model as aggregates
    ``count_if(failure) AS c<rule index>``, to compute in another pass over
    the same rows (see ``run_tests(counted=...)``)."""
    out = []
    for i, r in enumerate(rules):
        if r.model != model or r.test == "unique":
            continue
        fail = (not_null_failure(r.column) if r.test == "not_null"
                else accepted_range_failure(r.column, r.min_value, r.max_value))
        out.append(F.count_if(fail).alias(f"c{i}"))
    return out


def run_tests(spark: SparkSession, tables: dict[str, DataFrame], rules=RULES,
              counted: dict[str, DataFrame] | None = None) -> DataFrame:
    """(model, column_name, test, failures, passed) for every rule, in rule order.

    ``counted`` maps a model to a one-row DataFrame of its row-check failure
    counts (columns ``c<rule index>``, from ``row_check_aggregates``) already
    computed elsewhere, so that model is not scanned again for them.
    """
    parts = []
    by_model: dict[str, list[tuple[int, Rule]]] = {}
    for i, r in enumerate(rules):
        by_model.setdefault(r.model, []).append((i, r))
    for model, rs in by_model.items():
        df = tables[model]
        row_checks = [(i, r) for i, r in rs if r.test != "unique"]
        uniques = [(i, r) for i, r in rs if r.test == "unique"]
        # One unique rule: its grouped count also carries the row checks
        # (their totals are sums over the groups), so the table is read once.
        one_pass = len(uniques) == 1 and not (counted and model in counted)
        if one_pass:
            (ui, ur), = uniques
            groups = df.groupBy(ur.column).agg(F.count(F.lit(1)).alias("_n"), *row_check_aggregates(model, rules))
            fused = groups.agg(
                F.count_if(F.col(ur.column).isNotNull() & (F.col("_n") > 1)).alias(f"c{ui}"),
                *[F.coalesce(F.sum(f"c{i}"), F.lit(0)).alias(f"c{i}") for i, _ in row_checks])
            row_checks = sorted(row_checks + uniques)
        if row_checks:
            if not one_pass:
                fused = counted[model] if counted and model in counted else \
                    df.agg(*row_check_aggregates(model, rules))
            entries = [F.struct(F.lit(i).alias("rule_order"), F.lit(r.model).alias("model"),
                                F.lit(r.column).alias("column_name"), F.lit(_label(r)).alias("test"),
                                F.col(f"c{i}").cast("bigint").alias("failures"))
                       for i, r in row_checks]
            parts.append(fused.select(F.inline(F.array(*entries))))
        for i, r in ([] if one_pass else rs):
            if r.test == "unique":
                n = test_unique(df, r.column).agg(F.count(F.lit(1)).cast("bigint").alias("failures"))
                parts.append(n.select(F.lit(i).alias("rule_order"), F.lit(r.model).alias("model"),
                                      F.lit(r.column).alias("column_name"), F.lit(_label(r)).alias("test"),
                                      "failures"))
    out = reduce(lambda a, b: a.unionByName(b), parts)
    return out.withColumn("passed", F.col("failures") == 0)

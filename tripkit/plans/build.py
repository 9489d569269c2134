"""Model list and build: raw -> staging -> four marts, then the column tests.

Each model is a function of DataFrames named by its inputs. ``build`` saves
each model as a table in its layer and hands the saved table (not the
lineage) to the next model, so staging is computed once and the marts read
it from storage.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.expect import RULES, row_check_aggregates, run_tests
from ..sources.sinks import create_layers, ctas_table, view_materialization
from . import marts
from .staging import clean_trips


@dataclass(frozen=True)
class Model:
    name: str
    layer: str
    inputs: tuple[str, ...]
    fn: Callable[..., DataFrame]
    partition_by: tuple[str, ...] = field(default=())


# Staging is not split into directories: its only month column is the month
# of the year (it would mix years, prune no date window, and make every write
# task open one file per month). The marts read all of it.
MODELS = [
    Model("clean_trips", "staging", ("trips_raw",), clean_trips),
    Model("daily_summary", "final", ("clean_trips",), marts.daily_summary),
    Model("zone_analysis", "final", ("clean_trips",), marts.zone_analysis),
    Model("hourly_patterns", "final", ("clean_trips",), marts.hourly_patterns),
    Model("trip_categories", "final", ("clean_trips",), marts.trip_categories),
]


def build_order(models=MODELS, sources=("trips_raw",)) -> list[str]:
    """Topological order of the models from their declared inputs."""
    done, order, pending = set(sources), [], list(models)
    while pending:
        ready = [m for m in pending if all(i in done for i in m.inputs)]
        if not ready:
            raise ValueError(f"unresolvable inputs: {[m.name for m in pending]}")
        for m in ready:
            order.append(m.name)
            done.add(m.name)
            pending.remove(m)
    return order


def build(spark: SparkSession, trips_raw: DataFrame, materialized: str = "table",
          models=MODELS, one_pass: bool = True) -> dict[str, DataFrame]:
    """Build every model. ``materialized='view'`` composes lazily instead.

    With ``one_pass`` the four marts come from a single GROUPING SETS scan of
    the saved staging table (``marts.all_marts``) instead of four scans.
    """
    return _build(spark, trips_raw, materialized, models, one_pass)[0]


def _build(spark: SparkSession, trips_raw: DataFrame, materialized: str = "table",
           models=MODELS, one_pass: bool = True, staging_aggs=None) -> tuple[dict[str, DataFrame], DataFrame | None]:
    """``build``, plus ``staging_aggs`` (count-like aggregates over staging)
    computed inside the marts' one pass; returns (tables, their one-row
    totals or None)."""
    from ..session import materialize

    if materialized == "table":
        create_layers(spark)
    by_name = {m.name: m for m in models}
    out = {"trips_raw": trips_raw}
    shared, extra = None, None
    for name in build_order(models):
        m = by_name[name]
        if one_pass and name in marts.MARTS and m.inputs == ("clean_trips",):
            if shared is None:
                mat = materialize if materialized == "table" else None
                shared = marts.all_marts(out["clean_trips"], mat, extra_aggs=staging_aggs)
                extra = shared.pop("extra", None)
            df = shared[name]
        else:
            df = m.fn(*[out[i] for i in m.inputs])
        if materialized == "table":
            out[name] = ctas_table(df, f"{m.layer}.{m.name}", list(m.partition_by) or None)
        else:
            out[name] = view_materialization(df, m.name)
    return out, extra


def row_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One row per table with its row count."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(n).alias("table_name"), "row_count")
             for n, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def build_and_test(spark: SparkSession, trips_raw: DataFrame, materialized: str = "table"):
    """Build, then run the 13 column tests; failing tests are reported only.

    The staging table's row checks are counted inside the marts' one pass
    over the saved staging table, so testing adds no scan of it.
    """
    tables, extra = _build(spark, trips_raw, materialized,
                           staging_aggs=row_check_aggregates("clean_trips", RULES))
    counted = {"clean_trips": extra} if extra is not None else None
    results = run_tests(spark, tables, RULES, counted=counted)
    return tables, results

"""Data-quality profile of the RAW table: one scan, conditional counts."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.derive import DROPOFF, PICKUP
from ..functions.numeric import clip_nonneg, dec_round, share_pct
from ..operators import filters as FL

# Problem ids in report order and the extreme-distance bound.
PROBLEMS = ("null", "negative", "zero_distance", "extreme", "incoherent_dates")
EXTREME_MILES = 1000
# Report sections (id, title) and overview slice labels.
REPORT_SECTIONS = [
    ("total_rows", "Total lignes analysées"),
    ("clean_rows_estimate", "Lignes propres estimées"),
    ("null", "Valeurs Manquantes"),
    ("negative", "Montants Négatifs"),
    ("zero_distance", "Trajets Distance Zéro"),
    ("extreme", "Distances Extrêmes (>1000 miles)"),
    ("incoherent_dates", "Dates Incohérentes"),
]
OVERVIEW_SLICES = ("Données propres", "Valeurs manquantes", "Montants négatifs")


def _problem_predicates():
    return {
        "null": FL.any_null(),
        "negative": (F.col("fare_amount") < 0) | (F.col("total_amount") < 0),
        "zero_distance": F.col("trip_distance") == 0,
        "extreme": F.col("trip_distance") > EXTREME_MILES,
        "incoherent_dates": F.col(DROPOFF) <= F.col(PICKUP),
    }


def pct2(n, total):
    return dec_round(share_pct(n, total), 2)


def dq_summary(trips: DataFrame) -> DataFrame:
    """Total rows, then count and percentage (2 decimals) per problem.

    The warehouse version scans six times; here one aggregate with
    ``count_if`` per problem. An empty table yields total_rows = 0 and NULL
    everywhere else.
    """
    preds = _problem_predicates()
    counts = trips.agg(F.count(F.lit(1)).alias("total_rows"),
                       *[F.count_if(p).alias(f"{k}_count") for k, p in preds.items()])
    empty = F.col("total_rows") == 0
    cols = [F.col("total_rows")]
    for k in preds:
        n = F.col(f"{k}_count")
        cols.append(F.when(~empty, n).alias(f"{k}_count"))
        cols.append(F.when(~empty, pct2(n, F.col("total_rows"))).alias(f"{k}_pct"))
    return counts.select(*cols)


def dq_clean_estimate(summary: DataFrame) -> DataFrame:
    """total - sum of the five counts (overlaps are subtracted more than once)."""
    problems = sum((F.col(f"{k}_count") for k in PROBLEMS), F.lit(0))
    clean = F.col("total_rows") - problems
    return summary.select("total_rows", clean.cast("bigint").alias("clean_rows_estimate"),
                          pct2(clean, F.col("total_rows")).alias("clean_pct"))


def dq_report(summary: DataFrame) -> DataFrame:
    """Long form (section_order, section, title, n, pct) of the profile."""
    problems = sum((F.col(f"{k}_count") for k in PROBLEMS), F.lit(0))
    clean = F.col("total_rows") - problems
    entries = []
    for i, (key, title) in enumerate(REPORT_SECTIONS, start=1):
        if key == "total_rows":
            n, pct = F.col("total_rows"), F.lit(100.0)
        elif key == "clean_rows_estimate":
            n, pct = clean, pct2(clean, F.col("total_rows"))
        else:
            n, pct = F.col(f"{key}_count"), F.col(f"{key}_pct")
        entries.append(F.struct(F.lit(i).alias("section_order"), F.lit(key).alias("section"),
                                F.lit(title).alias("title"), n.cast("bigint").alias("n"),
                                pct.cast("double").alias("pct")))
    return summary.select(F.inline(F.array(*entries)))


def render_report(report_rows) -> str:
    """Markdown text from the collected report rows (seven rows, driver side)."""
    rows = sorted(report_rows, key=lambda r: r["section_order"])
    total = rows[0]["n"] if rows else 0
    if not total:
        return "# Data quality report\n\nNo rows in the RAW table.\n"
    lines = ["# Data quality report", ""]
    for r in rows:
        lines.append(f"- **{r['title']}**: {r['n']:,} ({r['pct']}%)")
    return "\n".join(lines) + "\n"


def dq_overview(trips: DataFrame) -> DataFrame:
    """Three slices (clean rows, 5-column NULLs, negative amounts), each
    clipped at 0, with its share of the three. The clean count is the number
    of rows passing the staging filter, so one scan serves all three."""
    agg = trips.agg(
        F.count_if(FL.staging_filter()).alias("a"),
        F.count_if(FL.any_null(FL.OVERVIEW_NULL_COLUMNS)).alias("b"),
        F.count_if((F.col("fare_amount") < 0) | (F.col("total_amount") < 0)).alias("c"),
    )
    sizes = [clip_nonneg(F.col(x)).cast("bigint") for x in ("a", "b", "c")]
    whole = sizes[0] + sizes[1] + sizes[2]
    entries = [F.struct(F.lit(i + 1).alias("slice_order"), F.lit(lbl).alias("slice"),
                        s.alias("n"), share_pct(s, whole).alias("share_pct"))
               for i, (lbl, s) in enumerate(zip(OVERVIEW_SLICES, sizes))]
    return agg.select(F.inline(F.array(*entries)))

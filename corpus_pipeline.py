"""A training-data pipeline over ``documents``: language ID, exact dedup, n-gram Jaccard join, PII, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet in the shared folder and read
again as the next stage's ``docs``. Documents without a recognised language go; of equal texts, and of each group that
Jaccard links connect, one document stays; personal data is masked; the rest is packed into sequences.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripkit.llm import exact_dedup, jaccard_join, language_id, packing, pii
from tripkit.llm.common import table
from tripkit.session import materialize

STAGES = [
    ("language_id", language_id.stage),
    ("exact_dedup", exact_dedup.stage),
    ("jaccard_join", jaccard_join.stage),
    ("pii", pii.stage),
    ("packing", packing.stage),
]

# SQL can't express rank-order language profiles, bootstrapped patterns or packing by column generation.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage_{name}")
    return docs

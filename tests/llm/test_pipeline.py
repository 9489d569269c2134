"""The pipeline, and what is registered."""

import __spark_entry__ as entry
import corpus_pipeline
from tripkit.llm.queries import ORACLE_SQL, QUERIES

SF001 = "/root/testdata/sf0.001"


def test_registered_queries():
    names = [q for q in entry.queries() if q.startswith("op") and q[2].isdigit()]
    assert sorted(int(n[2:].split("_")[0]) for n in names) == sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
    assert "pipeline" in entry.queries() and set(ORACLE_SQL) <= set(entry.oracle_sql())


def test_stages_on_their_predecessors_rows(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    counts, frames = [docs.count()], []
    for name, stage in corpus_pipeline.STAGES:
        after = corpus_pipeline.materialize(stage(spark, docs, SF001), f"test_{name}")
        frames.append(after)
        if name != "packing":
            assert after.columns == docs.columns
            counts.append(after.count())
        docs = after
    # copies and near copies go, personal data doesn't take a document away
    assert counts[0] >= counts[1] > counts[2] >= counts[3] == counts[4]
    before, masked = ({r["doc_id"]: r["text"] for r in f.collect()} for f in frames[2:4])
    changed = [d for d in before if before[d] != masked[d]]
    assert changed and all("<" in masked[d] for d in changed)
    packed = frames[4].collect()
    assert {r["doc_id"] for r in packed} == set(masked)
    assert corpus_pipeline.run(spark, SF001).count() == len(packed)

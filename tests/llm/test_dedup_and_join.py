"""Exact dedup and the Jaccard join against plain Python definitions."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from tripkit.llm import exact_dedup as ED
from tripkit.llm import jaccard_join as JJ
from tripkit.llm.components import components
from tripkit.session import settings

from .conftest import KINDS, odd_rows, words


def normal(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def brute_dedup(rows):
    groups = {}
    for r in rows:
        groups.setdefault(normal(r[1]), []).append(r[0])
    out = []
    for text, ids in groups.items():
        ids.sort(key=lambda i: (i is None, i))
        out += [(i, ids[0], len(ids), k == 0, hashlib.sha256(text.encode()).hexdigest()) for k, i in enumerate(ids)]
    return sorted(map(str, out))


@pytest.mark.parametrize("bits", [16, 1])  # 1 bit a row: nearly all rows are suspects
def test_exact_dedup_odd_rows(odd, bits):
    got = ED.exact_dedup(odd, bits_per_row=bits).select("doc_id", *ED.OUTPUT).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_dedup(odd_rows())


def test_exact_dedup_keeps_columns_and_empty(odd, empty):
    assert ED.exact_dedup(odd).count() == odd.count()
    assert set(odd.columns) <= set(ED.exact_dedup(odd).columns)
    assert ED.exact_dedup(empty).count() == 0


def test_bloom_filter_lets_every_repeated_row_through(spark):
    rows = [(i, f"text {i % 700}", "en", "s", 1) for i in range(1000)]
    got = ED.exact_dedup(spark.createDataFrame(rows, KINDS)).groupBy("group_size").count().collect()
    assert {r["group_size"]: r["count"] for r in got} == {1: 400, 2: 600}


def test_only_possibly_repeated_rows_shuffle(spark):
    df = spark.createDataFrame([(i, f"text {i}", "en", "s", 1) for i in range(50)], KINDS)
    plan = ED.exact_dedup(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or ""))
    return {tuple(w[i:i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


def brute_components(rows):
    sets = [shingles(r[1]) for r in rows]
    root = list(range(len(rows)))

    def find(k):
        while root[k] != k:
            k = root[k]
        return k

    for i, a in enumerate(sets):
        for j, b in enumerate(sets[:i]):
            if rows[i][0] is not None and rows[j][0] is not None and a and 100 * len(a & b) >= 80 * len(a | b):
                x, y = find(i), find(j)
                root[max(x, y)] = min(x, y)
    least = {}
    for k, r in enumerate(rows):
        if r[0] is not None:
            least[find(k)] = min(least.get(find(k), r[0]), r[0])
    return sorted(str((r[0], len(s), least[find(k)] if r[0] is not None else None)) for k, (r, s) in enumerate(zip(rows, sets)))


def test_jaccard_odd_rows(odd, empty):
    got = JJ.jaccard_components(odd).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_components(odd_rows())
    assert JJ.jaccard_components(empty).count() == 0


def near_copies(seed, groups, copies, n=60, shared=None):
    """Groups of copies with some words changed, so that similarities lie on both sides of 0.8."""
    r, rows = random.Random(seed), []
    for g in range(groups):
        base = words(seed * 1000 + g, n).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(r.randrange(5)):
                w[r.randrange(n)] = f"new{r.randrange(10 ** 6)}"
            rows.append((len(rows), " ".join(w + (shared or [])), "en", "s", 1))
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("small, block", [(32, 2048), (3, 10)])  # small buckets only; nearly all in families, many blocks
def test_jaccard_near_copies(spark, monkeypatch, small, block):
    monkeypatch.setattr(JJ, "SMALL", small)
    monkeypatch.setattr(JJ, "BLOCK", block)
    monkeypatch.setattr(JJ, "LOCAL", 4)
    rows = near_copies(7, 6, 25, shared=["a", "common", "line", "of", "nine", "words", "at", "the", "end"])
    got = JJ.jaccard_components(spark.createDataFrame(rows, KINDS)).collect()
    assert sorted(str(tuple(r)) for r in got) == brute_components(rows)
    assert 6 < len({r["component_id"] for r in got}) < len(rows)


def brute_links(rows):
    sets = [shingles(r[1]) for r in rows]
    real = [k for k, r in enumerate(rows) if r[0] is not None and sets[k]]
    n = {k: sum(j != k and 100 * len(sets[k] & sets[j]) >= 80 * len(sets[k] | sets[j]) for j in real) for k in real}
    return sorted(str((r[0], n.get(k, 0))) for k, r in enumerate(rows))


@pytest.mark.parametrize("small, block", [(32, 2048), (3, 10), (8, 4)])
def test_jaccard_counts_every_link_of_each_document(spark, odd, monkeypatch, small, block):
    monkeypatch.setattr(JJ, "SMALL", small)
    monkeypatch.setattr(JJ, "BLOCK", block)
    monkeypatch.setattr(JJ, "LOCAL", 4)
    rows = near_copies(9, 4, 20, shared=["a", "common", "line", "of", "nine", "words", "at", "the", "end"])
    rows += [(1000 + k, rows[k % 7][1].upper(), "en", "s", 1) for k in range(20)]  # copies: links of their own, and weights of others'
    rows += [(2000 + g, words(7000 + g // 2, 80) + (" last" if g % 2 else ""), "en", "s", 1) for g in range(10)]
    rows += odd_rows()
    got = JJ.jaccard_links(spark.createDataFrame(rows, KINDS)).collect()
    assert sorted(str((r["doc_id"], r["n_links"])) for r in got) == brute_links(rows)
    assert max(r["n_links"] for r in got) > 10 and tuple(got[0].asDict())[1:] == JJ.OUTPUT


def test_components_of_chain_star_and_loops(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(30)] + [(7, 7), (200, 201), (201, 200), (200, 201)]
    got = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {**{i: 0 for i in range(41)}, **{100 + i: 100 for i in range(30)}, 200: 200, 201: 200}


def test_stages_keep_one_of_each_group(spark, odd):
    docs = spark.createDataFrame(odd_rows(), KINDS)
    kept = ED.stage(spark, docs, "")
    assert kept.columns == docs.columns
    assert kept.count() == len({normal(r[1]) for r in odd_rows()})
    rows = near_copies(3, 3, 8)
    docs = spark.createDataFrame(rows, KINDS)
    left = JJ.stage(spark, docs, "")
    assert left.columns == docs.columns
    assert sorted(r["doc_id"] for r in left.collect()) == sorted({r["component_id"] for r in JJ.jaccard_components(docs).collect()})
    assert left.filter(F.col("text").isNull()).count() == 0


def test_jaccard_stage_keeps_one_row_where_doc_ids_repeat(spark):
    one, two, three = (words(9000 + k, 100) for k in range(3))
    # two near copies under one doc_id; rows of doc_id 5 and 7 that have a smaller doc_id beside them; equal rows; rows that link with nothing
    rows = [(1, one), (1, one + " end"), (5, two), (2, two + " end"), (5, three), (9, three + " end"), (9, three + " end"), (5, three), (7, "short text"), (7, "other text"),
            (7, ""), (7, ""), (7, None), (None, one), (None, one)]
    docs = spark.createDataFrame([(i, t, "en", "s", 1) for i, t in rows], KINDS)
    left = JJ.stage(spark, docs, "")
    assert left.columns == docs.columns
    got = sorted(((r["doc_id"], r["text"]) for r in left.collect()), key=str)
    assert sum(g[0] == 1 for g in got) == 1
    rest = [(2, two + " end"), (5, three), (7, "short text"), (7, "other text"), (7, ""), (7, ""), (7, None), (None, one), (None, one)]
    assert [g for g in got if g[0] != 1] == sorted(rest, key=str)


def stored_tables(spark, monkeypatch, *modules):
    """(tables by name that these modules store, whether a table is still there)."""
    kept = {}

    def spy(materialize):
        def body(df, name):
            kept.setdefault(name, []).append(materialize(df, name))
            return kept[name][-1]
        return body

    def there(df):
        path = spark._jvm.org.apache.hadoop.fs.Path(df.stored_at)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    for m in modules:
        monkeypatch.setattr(m, "materialize", spy(m.materialize))
    return kept, there


def test_dedup_stage_stores_the_text_of_possibly_repeated_rows_only(spark, monkeypatch):
    kept, _ = stored_tables(spark, monkeypatch, ED)
    rows = [(i, words(i, 40), "en", "s", 1) for i in range(300)] + [(300 + i, words(i, 40).replace(" ", "  "), "fr", "s", 2) for i in range(3)]
    got = ED.stage(spark, spark.createDataFrame(rows, KINDS), "").collect()
    assert sorted(map(tuple, got)) == rows[:300]
    texts = [t for frames in kept.values() for t in frames if "text" in t.schema.simpleString().replace("text_sha256", "")]
    assert 6 <= sum(t.count() for t in texts) < 60


def test_jaccard_stage_keeps_what_its_result_reads(spark, monkeypatch):
    from tripkit.llm import components as C
    monkeypatch.setattr(JJ, "SMALL", 4)
    kept, there = stored_tables(spark, monkeypatch, JJ, C)
    rows = [(i, words(7, 200) + f" end{i}", "en", "s", 1) for i in range(12)] + [(20 + i, words(9 + i // 2, 100) + f" end{i}", "en", "s", 1) for i in range(6)]
    found = JJ.jaccard_rows(spark.createDataFrame(rows, KINDS))
    assert len({r["component_id"] for r in found.collect()}) == 4
    left = {name for name, frames in kept.items() if any(map(there, frames))}
    assert left == {"jaccard_sets", "jaccard_classes", "jaccard_small", "jaccard_large", "components"}
    assert sum(map(there, kept["components"])) == 2 < len(kept["components"])


def test_jaccard_common_lines_make_no_families(spark, monkeypatch):
    monkeypatch.setattr(JJ, "SMALL", 8)
    monkeypatch.setattr(JJ, "LOCAL", 4)
    monkeypatch.setattr(JJ, "discard", lambda *stored: None)
    kept, _ = stored_tables(spark, monkeypatch, JJ)
    line = " ".join(f"common{i}" for i in range(40))  # half of every document, which near copies share with one another only
    rows = [(k, f"{line} {words(500 + k // 2, 40, 10 ** 6)}" + " end" * (k % 2), "en", "s", 1) for k in range(40)]
    got = JJ.jaccard_links(spark.createDataFrame(rows, KINDS).repartition(5)).collect()
    assert sorted((r["doc_id"], r["component_id"], r["n_links"]) for r in got) == [(k, k - k % 2, 1) for k in range(40)]
    (families,) = kept["jaccard_family"]
    assert families.count() == 0


def test_jaccard_sends_a_list_of_documents_once_a_chunk(spark, monkeypatch):
    for name, value in (("SMALL", 3), ("LOCAL", 4), ("CHUNK_SHINGLES", 300), ("COMMON", 5), ("BLOCK", 10)):
        monkeypatch.setattr(JJ, name, value)
    node = JJ._node
    monkeypatch.setattr(JJ, "_node", lambda salt, doc_id="doc_id": node(salt, doc_id) if salt else F.col(doc_id) % 5)  # the first numbers meet
    monkeypatch.setattr(JJ, "discard", lambda *stored: None)
    kept, _ = stored_tables(spark, monkeypatch, JJ)
    rows = near_copies(11, 4, 20, shared=["a", "common", "line", "of", "nine", "words", "at", "the", "end"])
    rows += [(1000 + k, rows[k % 7][1].upper(), "en", "s", 1) for k in range(20)] + odd_rows()
    with settings(spark, {"spark.sql.execution.arrow.maxRecordsPerBatch": "8"}):
        got = JJ.jaccard_links(spark.createDataFrame(rows, KINDS).repartition(3)).collect()
    assert sorted(str((r["doc_id"], r["n_links"])) for r in got) == brute_links(rows)
    (found,) = kept["jaccard_repeated"]
    lists = found.filter("nodes is not null").groupBy("chunk").count().collect()
    assert len(lists) > 6 and {r["count"] for r in lists} == {1}
    assert found.filter("nodes is null").count() > len(lists) and len(kept["jaccard_classes"]) == 2


def test_rows_that_are_classes_of_their_own_meet_nothing(spark, monkeypatch):
    texts = [words(i, 30, 10 ** 6) for i in range(200)]
    rows = [(i, t) for i, t in enumerate(texts)] + [(300 + i, texts[i].upper()) for i in range(4)] + [(5, texts[5]), (None, texts[6]), (400, ""), (401, None)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string").withColumn("text_hash", F.xxhash64("text"))
    sets = JJ.materialize(JJ._sets(docs), "sets").filter("doc_id is not null")
    classes, _ = JJ._candidates(docs, sets)
    firsts, bits = JJ._firsts(docs, sets, classes, 0)
    words_of = sorted(r["text"] for r in firsts.collect() if r["text"])
    assert words_of == sorted(texts)
    nodes = {r["node"] for r in classes.collect()}
    assert nodes == {r["node"] for r in firsts.filter("text <> ''").collect()} and len(nodes) == 200
    assert bits.selectExpr("sum(bitmap_count(_bits))").first()[0] == 9  # texts 0 to 3 with their copies, and row 5, which is there twice
    monkeypatch.setattr(JJ, "marked", lambda position: F.lit(True))  # a full filter
    assert sorted(r["text"] for r in JJ._firsts(docs, sets, classes, 0)[0].collect()) == sorted(texts)

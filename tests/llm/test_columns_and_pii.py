"""Columns of the user's that have the operators' own names, stages on odd rows, and personal data in its contexts."""

import time

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tripkit.llm import exact_dedup as ED
from tripkit.llm import pii

from .conftest import KINDS, odd_rows, words

# every name that an operator of the pipeline uses inside, or returns
NAMES = ["_n", "_first", "_bits", "_block", "_maybe", "_row", "_slots", "_found", "_text_hash", "text_hash", "component", "component_id", "n_links", "sig", "copies", "node", "rep",
         "kept", "keep_id", "group_size", "text_sha256", "spans", "base", "score", "lang_pred", "whole", "id", "row", "known", "pattern", "value", "label", "task", "class", "rank",
         "none", "key", "bucket", "held_out"]


@pytest.fixture(scope="module")
def named(spark):
    return spark.createDataFrame(odd_rows(), KINDS).repartition(3).withColumns({n: F.concat(F.lit(f"my {n} "), F.coalesce(F.col("doc_id").cast("string"), F.lit("?"))) for n in NAMES})


def mine(df):
    return [tuple(r[n] == f"my {n} {'?' if r['doc_id'] is None else r['doc_id']}" for n in NAMES) for r in df.select("doc_id", *NAMES).collect()]


@pytest.mark.parametrize("name", ["language_id", "exact_dedup", "jaccard_join", "pii"])
def test_stages_give_the_users_columns_back(spark, named, empty, name):
    stage = dict(corpus_pipeline.STAGES)[name]
    if name == "language_id":
        named = named.withColumn("lang", F.coalesce("lang", F.lit("en")))
    left = stage(spark, named, "")
    assert left.columns == named.columns and [f.dataType for f in left.schema] == [f.dataType for f in named.schema]
    rows = mine(left)
    assert rows and all(all(r) for r in rows)
    assert len(rows) <= len(odd_rows()) and (name != "pii" or len(rows) == len(odd_rows()))
    # no rows, and without the columns that an operator doesn't need
    few = empty.select("doc_id", "text", *(["lang"] if name == "language_id" else []))
    none = stage(spark, few, "")
    assert none.count() == 0 and none.columns == few.columns


def test_packing_stage_on_odd_rows(spark, named, empty):
    stage = dict(corpus_pipeline.STAGES)["packing"]
    packed = stage(spark, named, "")
    pieces = packed.groupBy("doc_id").agg(F.max("doc_tokens").alias("n")).collect()
    assert len(pieces) == len({r[0] for r in odd_rows()}) and stage(spark, empty, "").count() == 0


def test_functions_beside_every_internal_name(named):
    got = ED.exact_dedup(named)
    assert got.count() == len(odd_rows()) and set(ED.OUTPUT) <= set(got.columns)
    others = [n for n in NAMES if n not in ED.OUTPUT]
    assert all(r[n].startswith(f"my {n} ") for r in got.select(*others).collect() for n in others)
    got = pii.find(named)
    others = [n for n in NAMES if n not in ("base", "spans")]
    assert all(r[n].startswith(f"my {n} ") for r in got.select(*others).collect() for n in others)


@pytest.mark.parametrize("unit", ["999.1.1.1 ", "12345678 ", "1.2.3.4,", "9", "NL91 ABNA 0417 1643 00 x ", "a@b.c ", 'k="a1b2c3d4e5f6a7b8c9d0e1" ', "x1" * 50 + ".", "A1 "])
def test_time_is_linear_in_the_text(unit):
    def spent(size):
        text = unit * (size // len(unit))
        begin = time.process_time()
        pii._slots(text, *pii.base_spans(text))
        return time.process_time() - begin

    spent(10_000)
    small, large = max(min(spent(50_000) for _ in range(3)), 0.01), spent(1_000_000)
    assert large < 20 * small * 4


def found(spark, texts):
    got = pii.find(spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")).collect()
    return {r["doc_id"]: [(pii.KINDS[s["kind"]], r["text"][s["start"]:s["end"]]) for s in r["spans"]] for r in got}


def test_groups_and_strings_beside_spans(spark):
    seeds = [f"please call me at +1 (555) 010-{1000 + i} today" for i in range(8)] + [f"write me at user{i}@mail.example.com,acct:{10 ** 8 + 7919 * i}" for i in range(8)]
    texts = seeds + ["now call me at NL91 ABNA 0417 1643 00, please", "or call me at 0171 555 0123", "it is at 12 or at 30", "rooms 101 and 102, in 2024 at 7", "call me at home 1999"]
    got = found(spark, texts)
    assert got[16] == [("id", "NL91 ABNA 0417 1643 00")] and got[17] == [("id", "0171 555 0123")]
    assert got[18] == got[19] == got[20] == []
    # what stands beside a base span in one string is looked at by itself
    assert got[8] == [("email", "user0@mail.example.com"), ("id", str(10 ** 8))]


def test_secrets_in_their_context(spark):
    key = "24be64439e3e49cf46b2d7c90f3602a3d0b907ff"
    texts = [f'{words(k, 6)} token = "{key[k:] + key[:k]}" {words(k + 50, 6)}' for k in range(12)]
    texts += [f'{words(90, 5)} token = "short1x2y3" more', f"{words(91, 5)} the token is {key[:12]}", f"{words(92, 9)} 2024 and 1234567 there"]
    got = found(spark, texts)
    assert all(got[k] == [("id", key[k:] + key[:k])] for k in range(12)) and got[12] == [("id", "short1x2y3")]
    assert got[13] == got[14] == []


def test_secrets_of_the_test_documents(spark):
    got = pii.op7_pii(spark, "/root/testdata/sf0.01")
    assert got.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans"]
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    secret = docs.filter(F.col("text").rlike('token = "[0-9a-f]{40}"')).select("doc_id").join(got, "doc_id")
    assert secret.count() >= 10 and secret.filter(~F.col("spans").contains("id:")).count() == 0
    others = got.join(docs.filter(~F.col("text").contains("token")), "doc_id", "left_semi")
    assert others.filter(F.col("spans").contains("id:")).count() <= others.count() * 0.005


def test_patterns_hold_whole_words():
    text = "x" * 390 + "word number " + "y" * 8 + " "
    at = len(text)
    assert pii._patterns(text + "AB123456 next, please", at, at + 8) == ["after yyyyyyyy", "before next,"]
    long = "z" * 500
    assert pii._patterns(long + "=AB123456 " + long, 501, 509) == []
    assert pii._patterns("see acct:AB123456", 9, 17) == ["glued acct:", "after see"]
    assert pii._patterns('token = "AB123456"', 9, 17) == ["after token ="]

"""Decontamination against plain scans of every window."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from tripkit.llm import decontamination as D

from .conftest import KINDS, odd_rows, words

BENCH = "item_id bigint, text string"


def split(text):
    low = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)


def brute(rows, bench, window=10):
    items = [("" if i is None else str(i), split(t)) for i, t in bench]
    out = []
    for r in rows:
        w, hit, names = split(r[1]), set(), set()
        for name, item in items:
            n = min(window, len(item))
            grams = {tuple(item[k:k + n]) for k in range(len(item) - n + 1)} if n else set()
            for k in range(len(w) - n + 1 if n else 0):
                if tuple(w[k:k + n]) in grams:
                    hit |= set(range(k, k + n))
                    names.add(name)
        out.append((r[0], len(w), len(hit), len(names), hashlib.sha256(",".join(sorted(names)).encode()).hexdigest(), bool(hit)))
    return sorted(map(str, out))


def passages():
    """Items that share a template, repeat words, are short, null, empty, equal or have equal ids."""
    shared = words(50, 20)
    bench = [(k, f"{shared} {words(60 + k, 15)}") for k in range(6)]
    bench += [(10, "the the the the the the the the the the the the"), (11, "Short item, here."), (12, ""), (13, None), (14, "!!!"), (15, words(60, 15)),
              (None, "a null id has the Näme of nöthing at all, or so it is said"), (11, "another short one"), (16, "One"), (2, words(70, 40))]
    r = [b[1] for b in bench]
    docs = [(100 + k, f"{words(80 + k, 30)} {r[k % 8] or ''}, {words(90 + k, 20)}") for k in range(24)]
    docs += [(200, " ".join(["the"] * 40)), (201, r[0].upper()), (202, " ".join(r[1].split()[:9])), (203, " ".join(r[1].split()[5:15])), (204, r[1].replace(" ", "-\n")),
             (205, "a short item here a null id"), (206, " ".join([shared] * 3)), (207, "another SHORT one another short one"), (201, "one"),
             (208, "x a null id has the NäME of nöthing at all or"), (None, r[2]), (209, words(1, 3000) + " " + shared)]
    return odd_rows() + [(i, t, "en", "s", 1) for i, t in docs], bench


@pytest.mark.parametrize("shard, block", [(8 << 20, 8 << 20), (500, 8 << 20), (1, 400)])
def test_contamination_equals_scan(spark, tmp_path, monkeypatch, shard, block):
    monkeypatch.setattr(D, "SHARD_BYTES", shard)
    monkeypatch.setattr(D.contamination, "__defaults__", (*D.contamination.__defaults__[:-1], block))
    rows, bench = passages()
    docs = spark.createDataFrame(rows, KINDS).withColumns({c: F.lit("x") for c in ("items", "row", "key", "n_hit", "name")})
    docs.repartition(3).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(bench, BENCH).write.parquet(f"{tmp_path}/benchmark.parquet")
    got = D.op11_decontamination(spark, str(tmp_path))
    assert got.columns == ["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows, bench)


def test_other_windows_and_spans(spark):
    rows, bench = passages()
    docs, items = spark.createDataFrame(rows, KINDS), spark.createDataFrame(bench, BENCH)
    for window, block in ((1, 8 << 20), (4, 300), (30, 8 << 20)):
        got = D.contamination(docs, items, window=window, block_bytes=block).collect()
        mine = [(r["doc_id"], r["n_words"], r["n_hit"], len(r["items"]), hashlib.sha256(",".join(r["items"]).encode()).hexdigest(), r["n_hit"] > 0) for r in got]
        assert sorted(map(str, mine)) == brute(rows, bench, window)
        for r in got:
            spans = [(s["start"], s["end"]) for s in r["hit_spans"]]
            assert sum(b - a for a, b in spans) == r["n_hit"] and all(b < c for (_, b), (c, _) in zip(spans, spans[1:]))


def test_decontaminate_gives_the_clean_rows_back(spark, odd):
    rows, bench = passages()
    items = spark.createDataFrame(bench, BENCH)
    docs = spark.createDataFrame(rows, KINDS).withColumns({c: F.lit("x") for c in ("items", "row", "whole", "n_hit", "n_words")})
    left = D.decontaminate(docs, items)
    assert left.columns == docs.columns and {r["items"] for r in left.collect()} == {"x"}
    clean = [r for r in rows if "False" in brute([r], bench)[0]]
    assert sorted(str((r["doc_id"], r["text"])) for r in left.collect()) == sorted(str(r[:2]) for r in clean)
    assert 0 < len(clean) < len(rows)
    assert D.decontaminate(odd, items.limit(0)).count() == odd.count()
    assert D.contamination(odd.limit(0), items).count() == 0


@pytest.mark.parametrize("shard, block", [(8 << 20, 8 << 20), (2000, 300)])
def test_longest_matches(spark, monkeypatch, shard, block):
    monkeypatch.setattr(D, "SHARD_BYTES", shard)
    rows, bench = passages()
    want = {}
    for name, text in bench:
        item, name = split(text), "" if name is None else str(name)
        for i in range(len(item)):
            for r in rows:
                w = split(r[1])
                for k in range(len(w)):
                    n = 0
                    while i + n < len(item) and k + n < len(w) and item[i + n] == w[k + n]:
                        n += 1
                    if n:
                        found = (-n, i, r[0] is None, r[0], k)
                        want[name] = min(want.get(name, found), found)
        # two items of one id: the longest of either
    got = D.longest_matches(spark.createDataFrame(rows, KINDS), spark.createDataFrame(bench, BENCH), block_bytes=block).collect()
    assert {r["item_id"]: (-r["length"], r["item_word"], r["doc_id"] is None, r["doc_id"], r["doc_word"]) for r in got} == want

"""The Merkle manifest against a plain Python tree."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from tripkit.llm import merkle as M

from .conftest import KINDS, odd_rows


def H(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(row):
    doc_id, text, lang, source, n_chars = row
    return H("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def levels_of(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        below = out[-1]
        out.append([H("".join(below[k:k + 8])) for k in range(0, len(below), 8)])
    return out


def path_of(levels, k):
    out = []
    for nodes in levels[:-1]:
        begin = k - k % 8
        out.append(("".join(nodes[begin:k]), "".join(nodes[k + 1:begin + 8])))
        k //= 8
    return out


def brute(rows):
    trees = {}
    for r in rows:
        trees.setdefault((r[2] is not None, (r[2] or "").encode()), []).append(r)
    trees = [sorted(trees[t], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for t in sorted(trees)]
    built = [levels_of([leaf(r) for r in t]) for t in trees]
    top = levels_of([b[-1][0] for b in built])
    out = []
    for n, (tree, levels) in enumerate(zip(trees, built)):
        for k, r in enumerate(tree):
            path = path_of(levels, k) + path_of(top, n)
            changed = r
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[1] is not None:
                changed = (r[0], "".join(c.lower() if c.isascii() else c for c in r[1]), *r[2:])
            folded = leaf(changed)
            for a, b in path:
                folded = H(a + folded + b)
            out.append((r[0], leaf(r), levels[-1][0], top[-1][0], H("".join(a + b for a, b in path)), folded, folded == top[-1][0]))
    return sorted(map(str, out))


def table(spark, tmp, rows):
    path = f"{tmp}/documents.parquet"
    spark.createDataFrame(rows, KINDS).withColumns({"digest": F.lit("x"), "tree": F.lit("x"), "path": F.lit(1)}).repartition(3).write.parquet(path)
    return tmp


@pytest.mark.parametrize("step", [3, 1])  # one level between stored ones: many stored levels
def test_manifest_equals_plain_tree(spark, tmp_path, monkeypatch, step):
    monkeypatch.setattr(M, "STEP", step)
    monkeypatch.setattr(M, "BLOCK", 8 ** step)
    rows = odd_rows() + [(1000 + k, f"Text {k % 70}", "en", "s", k) for k in range(150)] + [(7, "Same", "en", "s", 1)] * 20 + [(k, "T", f"l{k:02}", None, None) for k in range(40)]
    got = M.op13_merkle_manifest(spark, table(spark, str(tmp_path), rows))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def test_one_row_and_empty(spark, tmp_path):
    rows = [(5, "Only", "en", "s", 4)]
    got = [tuple(r) for r in M.op13_merkle_manifest(spark, table(spark, str(tmp_path / "one"), rows)).collect()]
    assert list(map(str, got)) == brute(rows) and got[0][4] == H("")
    empty = table(spark, str(tmp_path / "none"), [])
    assert M.op13_merkle_manifest(spark, empty).count() == 0
    assert M.manifest(spark.read.parquet(f"{empty}/documents.parquet")).root().count() == 0


def test_only_every_third_level_is_stored_and_proofs_hold(spark):
    docs = spark.range(2000).select(F.col("id").alias("doc_id"), F.lit("t").alias("text"), F.lit("en").alias("lang"), F.lit("s").alias("source"), F.lit(1).alias("n_chars"))
    made = M.manifest(docs)
    assert [level.count() for level in made.trees] == [2000, 4]  # of 2000, 250, 32, 4, 1 nodes
    found = M.proofs(made)
    assert found.filter(M.fold(F.col("leaf"), F.col("path")) != F.col("root")).count() == 0
    assert {r["n"] for r in found.select(F.size("path").alias("n")).distinct().collect()} == {4}
    assert made.root().first()["root"] == found.first()["root"]

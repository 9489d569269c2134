"""Packing, SentencePiece encoding and token files against the libraries and plain definitions."""

import hashlib
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
import sentencepiece
from tokenizers import Tokenizer

from tripkit.llm import packing as P
from tripkit.llm import piece_encoding as PE
from tripkit.llm import token_files as TF
from tripkit.llm.tokens import WordEncoder

from .conftest import CLASHING, KINDS, odd_rows, words


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))


@pytest.fixture(scope="module")
def pieces():
    return sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path("piece_bpe_32k.model"))


def word_ids(library, text):
    return np.array([*library.encode(text or "", add_special_tokens=False).ids, 1], "<u4")


ODD = [r[1] for r in odd_rows()] + ["A.,", "İx Σ ΑΣ.", "don't DON'T.", "é ́", "a'S. '", "#. $., x..", "﻿a", "ǅ. ŉ.", "...", "a.b,c. ", "ﬀ.", "x.'s"]


def test_word_encoder_equals_the_library(library):
    encoder = WordEncoder(max_words=300)  # starts over now and then
    for _ in range(3):
        ids, ends = encoder.encode(pa.array(ODD, pa.string()))
        for text, begin, end in zip(ODD, [0, *ends[:-1]], ends):
            assert ids[begin:end].tolist() == word_ids(library, text).tolist(), text
    assert encoder.encode(pa.array([], pa.string()))[0].tolist() == []


def test_piece_encoder_equals_the_library(pieces):
    encoder = PE.PieceEncoder(max_chunks=300)
    texts = ODD + ["", " ", "  ", "a  b", " a", "a ", "a \nb", "\na", "\n\n a\n", "a▁b ▁", "▁", "   x      y", "\r\n\r\n", "aaaa" * 300, "a\x00b"]
    for _ in range(2):
        numbers, until = encoder.encode(pa.array(texts, pa.string()))
        ids, after = encoder.store.gather(numbers)
        after, begin = np.concatenate(([0], after)), 0
        for text, end in zip(texts, until):
            assert ids[after[begin]:after[end]].tolist() == pieces.encode(text or ""), text
            begin = end
        assert not encoder.differ.any()  # the agenda alone gives the library's ids


def test_piece_encoding_rows(odd, empty, pieces):
    got = PE.encode(odd, with_ids=True).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        ids = pieces.encode(r["text"] or "")
        assert r["ids"] == ids and r["n_tokens"] == len(ids) and r["n_differ"] == 0
        assert r["ids_sha256"] == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r["decoded"] == pieces.decode(ids) and r["decoded_sha256"] == hashlib.sha256(r["decoded"].encode()).hexdigest()
        assert r["score"] == CLASHING["score"]
    assert PE.encode(empty).count() == 0


def best_by_brute_force(sizes, values, capacity):
    best = [0.0] * (capacity + 1)
    for room in range(1, capacity + 1):
        best[room] = max([best[room - 1]] + [best[room - s] + v for s, v in zip(sizes, values) if s <= room])
    return best[capacity]


def test_knapsack():
    r = random.Random(5)
    for _ in range(60):
        capacity = r.randrange(5, 60)
        sizes = sorted(r.sample(range(1, capacity + 1), r.randrange(1, min(capacity, 9))))
        values = [round(r.random(), 3) for _ in sizes]
        value, pattern = P.knapsack(np.array(sizes), np.array(values), capacity)
        assert value == pytest.approx(best_by_brute_force(sizes, values, capacity))
        assert (pattern * sizes).sum() <= capacity and (pattern * values).sum() == pytest.approx(value)


def test_column_generation_reaches_the_bound():
    # three of 4 fit in 12, 5 + 7 and 6 + 6 fill it
    patterns, used, bound = P.column_generation([4, 5, 6, 7], [30, 10, 8, 10], 12, gap=1e-9)
    assert used.sum() == pytest.approx(10 + 10 + 4) == pytest.approx(bound)
    assert (patterns @ used >= np.array([30, 10, 8, 10]) - 1e-6).all()


def test_plan_holds_every_piece_in_few_sequences():
    r = random.Random(9)
    histogram = dict(Counter(min(int(r.lognormvariate(4, 1)) + 1, 256) for _ in range(5000)))
    chosen = P.plan(histogram, 256)
    total = Counter()
    for pattern, times in chosen:
        assert sum(s * c for s, c in pattern.items()) <= 256
        for s, c in pattern.items():
            total[s] += c * times
    assert total == Counter(histogram)
    assert sum(t for _, t in chosen) <= 1.01 * sum(s * n for s, n in histogram.items()) / 256 + 2
    assert P.plan({}, 256) == []


@pytest.mark.parametrize("length, grain", [(2048, 8), (64, 4)])
def test_pack(odd, empty, library, length, grain):
    got = P.pack(odd, length, grain, with_ids=True).collect()
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for r in got:
        assert len(r["ids"]) == r["length"] and zlib.crc32(np.array(r["ids"], "<u4")) == r["ids_crc32"]
        by_doc[r["doc_id"]].append(r)
        by_sequence[r["sequence_id"]].append(r)
    expected = defaultdict(list)
    for r in odd_rows():
        expected[r[0]].append(word_ids(library, r[1]).tolist())
    assert set(by_doc) == set(expected)
    for doc_id, rows in by_doc.items():
        rows.sort(key=lambda r: r["start"])
        if len(expected[doc_id]) == 1:
            assert sum((r["ids"] for r in rows), []) == expected[doc_id][0]
            assert [r["start"] for r in rows] == np.cumsum([0] + [r["length"] for r in rows])[:-1].tolist()
        else:
            assert sorted(sum((r["ids"] for r in rows), [])) == sorted(sum(expected[doc_id], []))
    for rows in by_sequence.values():
        rows.sort(key=lambda r: r["offset"])
        ends = np.cumsum([0] + [r["length"] for r in rows]).tolist()
        assert [r["offset"] for r in rows] == ends[:-1] and ends[-1] <= length
    tokens = sum(len(i) for x in expected.values() for i in x)
    assert len(by_sequence) <= tokens / length * 1.1 + 3
    assert P.pack(empty, length, grain).count() == 0


def test_sequences_have_the_ids_in_order(spark):
    docs = spark.createDataFrame([(i, words(i, 30), "en", "s", 1) for i in range(40)], KINDS)
    packed = P.pack(docs, 256, 8, with_ids=True)
    rows = {(r["sequence_id"], r["offset"]): r["ids"] for r in packed.collect()}
    for r in P.sequences(packed).collect():
        assert r["ids"] == sum((rows[k] for k in sorted(rows) if k[0] == r["sequence_id"]), [])


def test_elias_fano():
    r = random.Random(3)
    for n, gap in ((0, 1), (1, 5), (1000, 0), (1000, 1), (3000, 40), (700, 10 ** 7)):
        numbers = np.cumsum([r.randrange(gap + 1) for _ in range(n)]) if n else np.zeros(0, np.int64)
        code = TF.EliasFano.encode(numbers)
        assert code.all().tolist() == numbers.tolist()
        assert [code.select(k) for k in range(0, n, 7)] == numbers[::7].tolist()
        if gap == 40:  # about 2 + log2(gap / 2) bits a number, and the samples
            assert code.low.nbytes + code.high.nbytes + code.samples.nbytes < n * 8 / 8


def test_token_files(odd, empty, library, tmp_path):
    manifest = TF.write(odd, str(tmp_path))
    got = TF.read(manifest).collect()
    rows = sorted(odd_rows(), key=lambda r: (r[0] is not None, r[0] or 0))
    assert [r["doc_id"] for r in sorted(got, key=lambda r: r["start"])] == [r[0] for r in rows]
    found, start = defaultdict(list), 0
    for r in sorted(got, key=lambda r: r["start"]):
        assert r["start"] == start
        start += r["n_tokens"]
        found[r["doc_id"]].append((r["n_tokens"], r["ids_crc32"]))
    expected = defaultdict(list)
    for r in rows:
        ids = word_ids(library, r[1])
        expected[r[0]].append((len(ids), zlib.crc32(ids)))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in expected.items()}
    for r in manifest.collect():  # random access by select
        file = TF.TokenFile(r["uri"])
        assert [len(file.document(k)) for k in range(file.n_docs)] == np.diff(file.bounds.all()).tolist()
    assert TF.read(TF.write(empty, str(tmp_path / "none"))).count() == 0

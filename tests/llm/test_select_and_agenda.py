"""Results come through the methods: offsets by select, ids by the agenda, chunks by the tasks that read them."""

import random

import numpy as np
import pytest

from tripkit.llm import lm_scoring as LM
from tripkit.llm import piece_encoding as PE
from tripkit.llm import token_files as TF

from .conftest import KINDS, odd_rows, words


@pytest.mark.parametrize("n", [0, 1, 2, 255, 256, 257, 3000])
def test_numbers_between_two_selects(n, monkeypatch):
    monkeypatch.setattr(TF, "ENCODED", 64)
    r = random.Random(n)
    for top in (0, 5, 1000, 10 ** 12):
        numbers = np.array(sorted(r.randrange(top + 1) for _ in range(n)), np.int64)
        code = TF.EliasFano.encode(numbers)
        assert code.all().tolist() == numbers.tolist()
        for _ in range(15):
            a = r.randrange(n + 1)
            b = r.randrange(a, n + 1)
            assert code.between(a, b).tolist() == numbers[a:b].tolist()
            if n:
                k = r.randrange(n)
                value = int(numbers[k]) + r.choice([0, 1, top // 3 + 1])
                assert code.last_up_to(value, k) == int(np.searchsorted(numbers, value, "right")) - 1


def test_files_are_read_without_a_table_of_all_offsets(tmp_path, monkeypatch):
    r = random.Random(3)
    docs = [[r.randrange(40_000) for _ in range(r.randrange(1, 60))] for _ in range(2000)]
    ids, end = np.array(sum(docs, []), np.uint32), np.cumsum([len(d) for d in docs])
    uri = f"{tmp_path}/x.ids"
    TF.write_shard(uri, [(ids, end, [None, None, *range(5, 2003)])], False)
    monkeypatch.setattr(TF.EliasFano, "all", lambda self: pytest.fail("all offsets were decoded"))
    file = TF.TokenFile(uri)
    assert [file.document(k).tolist() for k in range(0, 2000, 97)] == docs[::97]
    assert file.doc_ids(1, 4) == [None, 5, 6] and file.doc_ids(0, 1) == [None] and file.doc_ids(1990, 2000) == list(range(1993, 2003)) and len(file.doc_ids()) == 2000
    with pytest.raises(ValueError, match="wide"):
        TF.write_shard(f"{tmp_path}/y.ids", [(np.array([70_000], np.uint32), np.array([1]), [1])], False)


def test_pieces_are_the_agendas(monkeypatch):
    encoder = PE.PieceEncoder()
    said = []
    real = encoder.ids
    monkeypatch.setattr(encoder, "ids", lambda chunk: said.append(real(chunk)) or said[-1])
    added = []
    monkeypatch.setattr(encoder.store, "add", lambda keys, ids: added.extend(ids))
    encoder._learn(["one", "twice", "zzq"])
    assert len(added) == 3 and all(a is s for a, s in zip(added, said))


@pytest.mark.parametrize("size", [200, 6 << 20])
def test_chunks_don_t_change_scores(spark, monkeypatch, size):
    rows = odd_rows() + [(500 + k, words(k % 5, 60), "en", "s", 1) for k in range(60)]
    docs = spark.createDataFrame(rows, KINDS).select("doc_id", "text")
    want = sorted(map(str, LM.katz_scores(docs.coalesce(1), order=3).select("doc_id", "n_tokens", "n_known").collect()))
    scores = sorted((str(r["doc_id"]), round(r["score"], 6)) for r in LM.katz_scores(docs.coalesce(1), order=3).collect())
    monkeypatch.setattr(LM, "CHUNK_BYTES", size)
    got = LM.katz_scores(docs.repartition(7), order=3)  # an exchange: the rows are stored first
    assert sorted(map(str, got.select("doc_id", "n_tokens", "n_known").collect())) == want
    assert sorted((str(r["doc_id"]), round(r["score"], 6)) for r in got.collect()) == scores

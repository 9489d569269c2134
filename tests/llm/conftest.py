import random

import pytest

CLASHING = {"score": "x", "spans": "x", "kept": "x", "part": "x", "hash": "x", "keep_id": "x", "n_tokens": "x", "lang_pred": "x", "node": "x", "ids": "x"}
KINDS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture(scope="session", autouse=True)
def workers(spark):
    import __spark_entry__
    __spark_entry__._prepare(spark)


def words(seed, n, vocabulary=400):
    r = random.Random(seed)
    return " ".join(r.choice(["a", "the"]) if r.random() < 0.2 else f"w{r.randrange(vocabulary)}x" for _ in range(n))


def odd_rows():
    """Nulls, empty and very long texts, ties, repeated rows, white space and characters of all kinds."""
    rows = [(1, None, None, None, None), (2, "", "en", "s", 0), (None, "a text without a number", "en", "s", 23), (3, "  \t\n\r\x0b\x0c ", "en", "s", 8),
            (4, "one two", "en", "s", 7), (5, "One  two", "en", "s", 8), (6, "one\ttwo", "en", "s", 7), (6, "one\ttwo", "en", "s", 7),
            (7, "x" * 30_000, "en", "s", 30_000), (8, words(1, 6_000), "en", "s", 1), (9, "漢字テスト。 ﬁ Å é ́ 🙂👍🏽 İx ΑΣ. ſK", "ja", "s", 1),
            (10, "<|endoftext|> x<|ENDOFTEXT|>. <s> </s> ▁a▁ a\x1cb a\xa0b", "en", "s", 1), (-5, "negative number here, fine.", "en", "s", 1),
            (11, "1 2 3 4 5 6", "en", "s", 11), (12, "a@b.c_d@e.f 1.2.3.4.5.6.7.8 999.1.1.1 4111 1111-1111 1111 +1 (555) 010-1234 +++ @", "en", "s", 1),
            (13, "\n\nline\nline\n \nline\n", "en", "s", 1)]
    for k in range(6):
        rows.append((20 + k, words(2, 200), "en", "s", 1))
        rows.append((40 + k, words(3, 300) + " " + words(100 + k, 5 + 6 * k), "fr", "s", 1))
    return rows


@pytest.fixture(scope="session")
def odd(spark):
    """``odd_rows`` with extra columns whose names clash with the operators' own."""
    from pyspark.sql import functions as F
    return spark.createDataFrame(odd_rows(), KINDS).repartition(3).withColumns({k: F.lit(v) for k, v in CLASHING.items()})


@pytest.fixture(scope="session")
def empty(spark):
    return spark.createDataFrame([], KINDS)


def key(row):
    return str(tuple(row))

"""Language ID, quality rules and classifier, PII and language-model scoring against plain definitions or held-out accuracy."""

import math
import random
import re
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tripkit.llm import language_id as LI
from tripkit.llm import lm_scoring as LM
from tripkit.llm import pii
from tripkit.llm import quality_classifier as QC
from tripkit.llm import quality_rules as QR
from tripkit.llm.common import held_out, table

from .conftest import CLASHING, KINDS, odd_rows, words

SF01 = "/root/testdata/sf0.01"


def out(i, mod=4):
    return i is not None and zlib.crc32(str(i).encode()) % mod == 2


# ---- language ID -------------------------------------------------------------------------------------------------------------

def brute_grams(text):
    letters = "".join(c if c.isalpha() else " " for c in text.lower()).split()
    c = Counter()
    for w in letters:
        c.update(w)
    padded = " " + " ".join(letters) + " "
    for k in range(len(padded) - 1 if letters else 0):
        c[padded[k:k + 2]] += 1
    for k in range(len(padded) - 2 if letters else 0):
        if padded[k + 1] != " ":
            c[padded[k:k + 3]] += 1
    return c


def code(gram):
    n = 0
    for c in gram:
        n = n << 21 | ord(c)
    return n


def ranked(counter, size):
    return [g for g, _ in sorted(counter.items(), key=lambda x: (-x[1], code(x[0])))[:size]]


def test_language_id_equals_brute_force(spark, odd, empty):
    r = random.Random(1)
    rows = [(i, " ".join("".join(r.choice(["abcde", "cdefg"][i % 2]) for _ in range(r.randrange(1, 6))) for _ in range(20)), ["x", "y"][i % 2], "s", 1) for i in range(12)]
    docs = spark.createDataFrame(rows + [(50, None, "x", "s", 1), (51, "12 34", None, "s", 1), (52, "abcd efg", None, "s", 1)], KINDS)
    profiles = LI.train_profiles(docs, size=20)
    sums = {"x": Counter(), "y": Counter()}
    for row in rows:
        sums[row[2]] += brute_grams(row[1])
    expected = {k: ranked(c, 20) for k, c in sums.items()}
    assert profiles == {k: [code(g) for g in p] for k, p in expected.items()}
    for row in LI.identify(docs, profiles, size=20).collect():
        mine = ranked(brute_grams(row["text"] or ""), 20)
        if not mine:
            assert (row["lang_pred"], row["score"]) == ("und", 0.0)
            continue
        distance = {k: sum(abs(p.index(g) - n) if g in p else 20 for n, g in enumerate(mine)) for k, p in expected.items()}
        best = min(sorted(distance), key=distance.get)
        assert row["lang_pred"] == best and row["score"] == pytest.approx(1 - distance[best] / (20 * len(mine)))
    assert LI.identify(odd, profiles).count() == len(odd_rows())
    assert LI.identify(empty, LI.train_profiles(empty)).count() == 0
    assert {r["lang_pred"] for r in LI.identify(docs, {}).collect()} == {"und"}


def test_language_id_held_out_accuracy(spark):
    got = LI.op8_language_id(spark, SF01).join(table(spark, SF01, "documents").select("doc_id", "lang"), "doc_id").filter("held_out")
    assert got.select(F.avg((F.col("lang") == F.col("lang_pred")).cast("int"))).first()[0] > 0.99


# ---- quality -----------------------------------------------------------------------------------------------------------------

def brute_counts(text):
    text = text or ""
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = Counter(zip(w, w[1:], w[2:]))
    repeated = set()
    for k in range(len(w) - 2):
        if windows[w[k], w[k + 1], w[k + 2]] > 1:
            repeated |= {k, k + 1, k + 2}
    seen, dup = set(), 0
    for line in text.split("\n"):
        if re.search(r"[^\x20\x09-\x0D]", line):
            dup += line in seen
            seen.add(line)
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(repeated)


def test_quality_counts(odd, empty):
    r = random.Random(2)
    texts = [x[1] for x in odd_rows()] + [" ".join(r.choice("abc") for _ in range(n)) for n in range(40)] + ["a b c d a b c", "x x x x", "a|b #c\n" * 3]
    for text in texts:
        assert QR.counts((text or "").encode()) == brute_counts(text), text
    model = ([0.0] * QR.DIMENSIONS, 1.0, 30.0)
    got = QR.apply_rules(odd, model).collect()
    assert len(got) == len(odd_rows())
    for row in got:
        n, *_, repeated = brute_counts(row["text"])
        assert row["base_failed"] == (n < 50 or 100 * repeated > 50 * n) and row["kept"] == (not row["base_failed"])
    assert QR.apply_rules(empty, model).count() == 0


def test_hashed_features():
    a, b = QR.features(b"one two three one"), QR.features(b"one  two\nthree one")
    half = 2 << QR.WORD_BITS
    assert (a[:half] == b[:half]).all() and (a[half:] != b[half:]).any()  # the words are the same, the characters not
    assert not QR.features(b"").any() and abs((a[:1 << QR.WORD_BITS] ** 2).sum() - 1) < 1e-5


def ranking(rows, score, label):
    """The chance that a good row scores above a bad one."""
    good, bad = ([r[score] for r in rows if r[label] == v] for v in (1, 0))
    return sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / (len(good) * len(bad))


def test_quality_models_on_held_out_rows(spark):
    labels = table(spark, SF01, "labels").filter(held_out()).select("doc_id", "quality")
    rules = QR.op5_quality_rules(spark, SF01).join(labels, "doc_id").collect()
    assert ranking(rules, "probability", "quality") > 0.95
    able = [r for r in rules if r["quality"] == 1 and not r["base_failed"]]
    assert sum(r["kept"] for r in able) > 0.95 * len(able)
    scores = QC.op3_quality_classifier(spark, SF01).join(labels, "doc_id").collect()
    assert ranking(scores, "score", "quality") > 0.9
    assert all(r["predicted"] == (r["score"] >= 0.7) and 0 <= r["score"] <= 1 and r["held_out"] for r in scores)


def test_quality_models_without_labels_or_rows(spark, odd, empty):
    none = spark.createDataFrame([], "doc_id bigint, quality int")
    docs = odd.filter("doc_id is not null")
    vectors = QC.train_vectors(odd)
    for labels, score in ((none, 1.0), (spark.createDataFrame([(8, 0), (8, 0), (None, 1), (7, None)], none.schema), 0.0)):
        got = QC.classify(odd, vectors, QC.fit(docs, labels, vectors)).collect()
        assert {r["score"] for r in got} == {score} and len(got) == len(odd_rows())
        assert {r["probability"] > 0.5 for r in QR.apply_rules(odd, QR.fit(docs, labels)).collect()} == {score == 1.0}
    both = spark.createDataFrame([(8, 1), (7, 0), (20, 1), (21, 0), (9, 1), (4, 0)], none.schema)
    assert all(0 <= r["score"] <= 1 for r in QC.classify(odd, vectors, QC.fit(docs, both, vectors)).collect())
    assert QC.classify(empty, QC.train_vectors(empty), QC.fit(empty, none, vectors)).count() == 0


def test_random_indexing_brings_like_contexts_together(spark):
    r = random.Random(4)
    rows = [(i, " ".join(f"{r.choice(['red', 'blue'])} {r.choice(['car', 'bus'])} sings never" for _ in range(40)), "en", "s", 1) for i in range(20)]
    vectors = QC.train_vectors(spark.createDataFrame(rows, KINDS))
    at = {w: int(QC.tokens([w.encode()])[0][0]) for w in ("red", "blue", "sings")}
    near = [float((vectors[at["red"]] * vectors[at[w]]).sum()) for w in ("blue", "sings")]
    assert near[0] > 0.9 > near[1] + 0.3


# ---- personal data -----------------------------------------------------------------------------------------------------------

PATTERNS = [r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", r"[0-9]([\x20-]?[0-9])+", r"\+[0-9][\x20().0-9-]+[0-9]"]


def brute_spans(text):
    def good(kind, s):
        d = re.sub(r"[^0-9]", "", s)
        luhn = sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(d))) % 10 == 0
        return [True, kind != 1 or all(int(p) <= 255 for p in s.split(".")), 12 <= len(d) <= 19 and luhn, 9 <= len(d) <= 15][kind]
    return sorted((m.start(), k, m.end()) for k, p in enumerate(PATTERNS) for m in re.finditer(p, text) if good(k, m[0]))


def test_base_spans_equal_the_expressions():
    r = random.Random(8)
    texts = [x[1] or "" for x in odd_rows()] + ["".join(r.choice("ab1.@+-_ 4(") for _ in range(r.randrange(60))) for _ in range(3000)]
    texts += ["".join(r.choice("0123456789 -") for _ in range(40)) for _ in range(500)] + ["4111111111111111 4111-1111-1111-1112", "0001.002.3.255", "9" * 5000]
    for text in texts:
        assert pii.base_spans(text)[0] == brute_spans(text), text


def test_patterns_discover_what_no_expression_knows(spark):
    rows = [(i, f"please call me at +1 (555) 010-{1000 + i} today. Word {i} here") for i in range(8)]
    rows += [(100, "you can call me at 0171-5550-9 tonight"), (101, "call me at NL91ABNA0417164300"), (102, "version 2.0.1 and number 1234567 are fine"), (103, None), (104, "")]
    found = pii.find(spark.createDataFrame(rows, "doc_id bigint, text string")).cache()
    got = {r["doc_id"]: [(pii.KINDS[s["kind"]], r["text"][s["start"]:s["end"]]) for s in r["spans"]] for r in found.collect()}
    assert got[100] == [("id", "0171-5550-9")] and got[101] == [("id", "NL91ABNA0417164300")]
    assert got[102] == got[103] == got[104] == []
    assert all(got[i] == [("phone", f"+1 (555) 010-{1000 + i}")] for i in range(8))
    masked = {r["doc_id"]: r["text"] for r in pii.mask(found).collect()}
    assert masked[0] == "please call me at <PHONE> today. Word 0 here" and masked[101] == "call me at <ID>" and masked[103] is None and masked[104] == ""


def test_pattern_scores(spark):
    edges = [("p", f"s{i}", 1.0) for i in range(4)] + [("p", "bad", 0.0), ("p", "new", None), ("q", "new", None), ("q", "s0", 1.0), ("r", "new", None)]
    got = {r["pattern"]: (round(r["confidence"], 4) if r["confidence"] is not None else None, r["known"]) for r in
           pii.score_patterns(spark.createDataFrame(edges, "pattern string, value string, label double"), 1).collect()}
    assert got == {"p": (round(4 / 6, 4), 5), "q": (0.5, 1), "r": (None, 0)}
    got = {r["pattern"]: r["confidence"] for r in pii.score_patterns(spark.createDataFrame(edges, "pattern string, value string, label double"), 2).collect()}
    assert got["p"] == pytest.approx((4 + 4 / 6) / 7) and got["q"] == pytest.approx((1 + 4 / 6) / 3)


def test_pii_odd_rows(odd, empty):
    got = pii.find(odd).collect()
    assert len(got) == len(odd_rows())
    for r in got:
        base = [(s["start"], s["kind"], s["end"]) for s in r["base"]]
        assert base == brute_spans(r["text"] or "")
        assert set(base) <= {(s["start"], s["kind"], s["end"]) for s in r["spans"]}
        assert r["score"] == CLASHING["score"]
    assert pii.find(empty).count() == 0


# ---- language model ----------------------------------------------------------------------------------------------------------

class BruteKatz:
    def __init__(self, texts):
        self.words, self.pairs, self.after = Counter(), Counter(), Counter()
        for t in texts:
            self.words.update(t)
            self.pairs.update(zip(["\r", *t], t))
        self.n = sum(self.words.values())
        self.keep = {id(c): LM.discounts([sum(v == r for v in c.values()) for r in range(1, LM.LAST_DISCOUNTED + 2)]) for c in (self.words, self.pairs)}
        for (h, _), c in self.pairs.items():
            self.after[h] += c
        self.unknown = 1 - sum(self.cut(self.words, c) for c in self.words.values()) / self.n
        self.weight = {h: (1 - sum(self.cut(self.pairs, c) for (g, _), c in self.pairs.items() if g == h) / self.after[h])
                       / (1 - sum(self.unigram(w) for g, w in self.pairs if g == h)) for h in self.after}

    def cut(self, counter, c):
        return c - LM.KEPT_BACK if c > LM.LAST_DISCOUNTED else self.keep[id(counter)][c - 1] * c

    def unigram(self, w):
        return self.cut(self.words, self.words[w]) / self.n if w in self.words else self.unknown

    def p(self, h, w):
        if (h, w) in self.pairs:
            return self.cut(self.pairs, self.pairs[h, w]) / self.after[h]
        return self.weight.get(h, 1.0) * self.unigram(w)


def test_katz_equals_brute_force(spark, monkeypatch, empty):
    monkeypatch.setattr(LM, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(LM, "PART_BYTES", 3_000)
    rows = [r for r in odd_rows() if r[0] is not None and len(r[1] or "") < 3000] + [(200 + i, words(i, 60, 40), "en", "s", 1) for i in range(40)]
    got = LM.katz_scores(spark.createDataFrame(rows, KINDS)).collect()
    assert len(got) == len(rows)

    def tokens(text):
        return re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in text or "")) + ["\n"]

    texts = {r[0]: tokens(r[1]) for r in rows}
    model = BruteKatz([tokens(r[1]) for r in rows if not out(r[0], 7)])
    for h in list(model.after)[:20]:
        assert sum(model.p(h, w) for w in model.words) + model.weight[h] * model.unknown == pytest.approx(1)
    for r in got:
        t = texts[r["doc_id"]]
        assert r["held_out"] == out(r["doc_id"], 7) and r["n_tokens"] == len(t) and r["train_tokens"] == model.n
        assert r["n_known"] == sum(w in model.words for w in t)
        assert r["base_score"] == pytest.approx(sum(math.log10((model.words[w] + 1) / (model.n + len(model.words) + 1)) for w in t))
        assert r["score"] == pytest.approx(sum(math.log10(model.p(h, w)) for h, w in zip(["\r", *t], t)))
    assert LM.katz_scores(empty).count() == 0


def brute_katz(texts, order):
    """The log10 probability of a list of tokens, by the recursive definition, for a model of any order."""
    counts, after = [Counter() for _ in range(order)], Counter()
    for t in texts:
        padded = ["\r"] * (order - 1) + t
        for k in range(order - 1, len(padded)):
            for level in range(order):
                counts[level][tuple(padded[k - level:k + 1])] += 1
                after[tuple(padded[k - level:k])] += 1
    keep = [LM.discounts([sum(v == r for v in c.values()) for r in range(1, LM.LAST_DISCOUNTED + 2)]) for c in counts]
    follow = {}
    for c in counts:
        for g in c:
            follow.setdefault(g[:-1], []).append(g[-1])

    def cut(g):
        c = counts[len(g) - 1][g]
        return c - LM.KEPT_BACK if c > LM.LAST_DISCOUNTED else keep[len(g) - 1][c - 1] * c

    unknown = 1 - sum(map(cut, counts[0])) / after[()]

    def p(h, w):
        if counts[len(h)][h + (w,)]:
            return cut(h + (w,)) / after[h]
        if not h:
            return unknown
        if h not in follow:
            return p(h[1:], w)
        return (1 - sum(cut(h + (x,)) for x in follow[h]) / after[h]) / (1 - sum(p(h[1:], x) for x in follow[h])) * p(h[1:], w)

    def score(t):
        padded = ["\r"] * (order - 1) + t
        return sum(math.log10(p(tuple(padded[k - order + 1:k]), padded[k])) for k in range(order - 1, len(padded)))

    return score


@pytest.mark.parametrize("order", [1, 3, 4])
def test_katz_of_any_order_equals_brute_force(spark, monkeypatch, order):
    monkeypatch.setattr(LM, "CHUNK_BYTES", 2_000)
    monkeypatch.setattr(LM, "PART_BYTES", 3_000)
    rows = [(200 + i, words(i % 35, 60, 12), "en", "s", 1) for i in range(50)] + [(300, None, "en", "s", 1), (301, "", "en", "s", 1)]
    texts = {r[0]: (r[1] or "").split() + ["\n"] for r in rows}
    score = brute_katz([t for i, t in texts.items() if not out(i, 7)], order)
    got = {r["doc_id"]: r["score"] for r in LM.katz_scores(spark.createDataFrame(rows, KINDS), order=order).collect()}
    assert got == {i: pytest.approx(score(t)) for i, t in texts.items()}
    if order == 3:
        assert LM.ORDER == 3
        bigram = brute_katz([t for i, t in texts.items() if not out(i, 7)], 2)
        assert any(abs(bigram(t) - got[i]) > 0.1 for i, t in texts.items())


def test_katz_counts_beyond_32_bits():
    import numpy as np
    import pandas as pd
    keys, counts = LM.pack(np.array([5, 2], np.uint64)), LM.pack(np.array([4_000_000_000, 1], np.uint32))
    rows = pd.DataFrame([(c, 0, 0, keys, counts, np.packbits([c == 1, False]).tobytes()) for c in (1, 2)], columns=["chunk", "kind", "part", "keys", "counts", "asked"])
    got = LM._count(rows)
    assert [LM.unpack(a, np.uint64).tolist() for a in got["counts"][:2]] == [[8_000_000_000, 2]] * 2
    assert [np.unpackbits(np.frombuffer(a, np.uint8), count=2).tolist() for a in got["asked"][:2]] == [[1, 0]] * 2
    assert got["numbers"][2][0] == 8_000_000_002


def test_katz_odd_rows(odd):
    got = LM.katz_scores(odd).collect()
    assert len(got) == len(odd_rows()) and all(math.isfinite(r["score"]) and math.isfinite(r["base_score"]) for r in got)
    assert [r["n_tokens"] for r in got if r["doc_id"] in (1, 2)] == [1, 1]


def test_word_hashes_take_a_block_of_text_at_a_time():
    """Many texts need no more memory than a block and their hashes, and hash as one by one."""
    import tracemalloc
    from tripkit.llm.hashing import word_hashes
    texts = [b"", b"Some words\tand more\n" * 3000, b" ", b"end"] * 480
    word_hashes(texts[:4])
    tracemalloc.start()
    found, until = word_hashes(texts)
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 12 * sum(map(len, texts))
    alone = [word_hashes([t])[0].tolist() for t in texts[:4]]
    assert until.tolist() == [sum(map(len, alone)) * (k // 4) + sum(map(len, alone[:k % 4 + 1])) for k in range(len(texts))]
    assert found.tolist() == [h for a in alone for h in a] * 480


@pytest.mark.parametrize("kind", ["uint32", "uint64", "int64"])
def test_packed_counts_take_few_bytes(kind):
    """A number's empty bytes take no room in the rows, not only in compressed shuffle files."""
    import numpy as np
    counts = (np.random.default_rng(1).geometric(0.8, 100_000)).astype(kind)
    packed = LM.pack(counts)
    assert len(packed) < len(counts) / 4
    assert (LM.unpack(packed, kind) == counts).all()
    for some in ([], [0], [5, 2**31, 7]):
        assert LM.unpack(LM.pack(np.array(some, kind)), kind).tolist() == some


def test_katz_leaves_no_answers_on_disk(spark, monkeypatch):
    """The answers to chunks, and a stored copy of the texts, go when the texts' rows are written; the result still reads."""
    kept = {}

    def materialize(df, name):
        kept[name] = stored(df, name)
        return kept[name]

    stored = LM.materialize
    monkeypatch.setattr(LM, "materialize", materialize)
    got = LM.katz_scores(spark.createDataFrame([(i, words(i, 20), "en", "s", 1) for i in range(30)], KINDS).repartition(3), order=3)
    assert got.count() == 30

    def there(name):
        path = spark._jvm.org.apache.hadoop.fs.Path(kept[name].stored_at)
        return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path)

    assert {n for n in kept if there(n)} == {"lm_rows", "lm_weights"} and {"lm_docs", "lm_counts"} < set(kept)

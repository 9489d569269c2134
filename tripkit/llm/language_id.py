"""Language identification by rank-order n-gram profiles.

A profile is the list of a language's most frequent letter n-grams (1 to 3 letters, words padded by one blank),
counted by Spark over every training text. A document's own most frequent n-grams are compared with each profile by
out-of-place distance: the sum over them of the difference of ranks, or of the profile length if the n-gram is not in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from .common import apart, append, held_out, slices, strings, table, together, with_fields

PROFILE_SIZE = 300
UNKNOWN = "und"
OUTPUT = ("lang_pred", "score")
# Distinct n-grams a training task holds before it hands its counts on.
HELD_GRAMS = 1 << 21

_LETTERS = None


def _letters():
    """Whether each code point is a letter, as a numpy table made once per Python worker."""
    global _LETTERS
    if _LETTERS is None:
        import numpy as np

        _LETTERS = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _LETTERS


def grams(text: str):
    """Codes of all 1- to 3-grams of the lower-cased text: 21 bits a character, non-letters read as one blank."""
    import numpy as np

    cp = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.int64)
    cp = np.concatenate(([32], np.where(_letters()[cp], cp, 32), [32]))
    cp = cp[np.concatenate(([True], (cp[1:] != 32) | (cp[:-1] != 32)))]
    pairs = cp[:-1] << 21 | cp[1:]
    triples = (pairs[:-1] << 21 | cp[2:])[cp[1:-1] != 32]
    return np.concatenate((cp[cp != 32], pairs if len(cp) > 1 else pairs[:0], triples))


def _merge(parts):
    import numpy as np

    codes, counts = np.concatenate([c for c, _ in parts]), np.concatenate([n for _, n in parts])
    codes, at = np.unique(codes, return_inverse=True)
    return codes, np.bincount(at, counts, len(codes)).astype(np.int64)


def _count(batches):
    import numpy as np
    import pyarrow as pa

    def out(held):
        for lang, parts in held.items():
            codes, counts = _merge(parts)
            for k in range(0, len(codes), 100_000):
                c = codes[k:k + 100_000]
                yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(c), pa.array(counts[k:k + 100_000])], ["lang", "gram", "n"])

    held: dict[str, list] = {}
    for batch in slices(batches, max_bytes=1 << 20):
        by_lang: dict[str, list[str]] = {}
        for text, lang in zip(strings(batch), strings(batch, "lang")):
            by_lang.setdefault(lang, []).append(text)
        for lang, texts in by_lang.items():
            held.setdefault(lang, []).append(np.unique(grams("\n".join(texts)), return_counts=True))
            if len(held[lang]) >= 16:
                held[lang] = [_merge(held[lang])]
        if sum(len(c) for parts in held.values() for c, _ in parts) > HELD_GRAMS:
            yield from out(held)
            held = {}
    yield from out(held)


def train_profiles(docs: DataFrame, lang_col: str = "lang", text_col: str = "text", size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Profiles by language: its ``size`` most frequent n-grams, ties by code.

    Rows without text or language teach nothing. The result has ``size`` numbers a language.
    """
    known = docs.filter(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull()) \
        .select(F.col(lang_col).cast("string").alias("lang"), F.col(text_col).alias("text"))
    counts = known.mapInArrow(_count, "lang string, gram bigint, n bigint").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "gram"))
    top = counts.withColumn("rank", rank).filter(F.col("rank") <= size)
    profiles: dict[str, list[int]] = {}
    for lang, gram, _, _ in top.orderBy("lang", "rank").collect():  # size rows a language
        profiles.setdefault(lang, []).append(gram)
    return profiles


def identify(docs: DataFrame, profiles: dict[str, list[int]], text_col: str = "text", size: int = PROFILE_SIZE) -> DataFrame:
    """``docs`` with lang_pred and score.

    lang_pred is the language with the least distance (ties: the first by name), score 1 minus that distance over the largest
    possible one. ``und`` with score 0 where the text is null or has no letter, or no language was learned. Columns of
    ``docs`` with these names are replaced; repeated rows are scored alike.
    """
    def body(batches):
        import numpy as np
        import pyarrow as pa

        langs = sorted(profiles)
        known = np.unique(np.array([g for p in profiles.values() for g in p], np.int64))
        ranks = np.full((len(langs), len(known) + 1), -1, np.int64)
        for k, lang in enumerate(langs):
            ranks[k, np.searchsorted(known, profiles[lang])] = np.arange(len(profiles[lang]))

        def guess(text):
            codes = grams(text) if text and langs else ()
            if not len(codes):
                return UNKNOWN, 0.0
            codes, counts = np.unique(codes, return_counts=True)
            n = len(codes)
            order = counts * (n + 1) + np.arange(n, 0, -1)  # by count, then by code
            best = np.argpartition(-order, size - 1)[:size] if n > size else np.arange(n)
            best = best[np.argsort(-order[best])]
            at = np.minimum(np.searchsorted(known, codes[best]), len(known) - 1)
            theirs = np.where(known[at] == codes[best], ranks[:, at], -1)
            distance = np.where(theirs < 0, size, np.abs(theirs - np.arange(len(best)))).sum(axis=1)
            k = int(distance.argmin())
            return langs[k], 1.0 - float(distance[k]) / (size * len(best))

        for batch in slices(batches, text_col):
            found = [guess(t) for t in strings(batch, text_col)]
            yield append(batch, lang_pred=pa.array([f[0] for f in found], pa.string()), score=pa.array([f[1] for f in found], pa.float64()))

    docs = docs.drop(*OUTPUT)
    return docs.mapInArrow(body, with_fields(docs.schema, ("lang_pred", "string"), ("score", "double")))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    profiles = train_profiles(docs.filter(~held_out()))
    return identify(docs.select("doc_id", held_out().alias("held_out"), "text"), profiles).drop("text")


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: rows whose language is recognised (``und`` rows go), as they were. An empty table gives an empty one."""
    found = identify(apart(docs, "text"), train_profiles(docs.filter(~held_out())))
    return found.filter(F.col("lang_pred") != UNKNOWN).select(*together(docs, "text"))

"""Language-model scoring with Katz backoff.

A model of any order over lower-cased words, each text closed by an end token and begun by start tokens. With h = v h' a history:

    P(w | h) = d(c(h w)) c(h w) / c(h)     where the training texts have the n-gram h w
             = alpha(h) P(w | h')          otherwise; alpha is 1 for a history they don't have
    P(w)     = d1(c(w)) c(w) / N, and the mass that this leaves for words they don't have

Each level has its own Good-Turing discounts for counts up to ``LAST_DISCOUNTED``; larger counts lose ``KEPT_BACK`` of a count, so that
after every history some mass is left. alpha(h) is that mass over the mass that P(. | h') gives the words not seen after h, both summed
exactly. A word seen after h is seen after h' too, so the sums need counts only, no other weights.

The rows that a task reads are its chunks, of some MB of text each. A chunk sends its distinct n-grams and their training counts, as packed sorted hashes, to
the parts of a table that is partitioned by ranges of the hash; a part adds up the counts and answers each chunk. Then a chunk sums up
what it knows of each history that a held-out text has (one chunk owns each distinct n-gram; a training text's own n-grams are all
known, it never backs off), the parts turn the sums into backoff weights, and answer for each text those that it backs off with. Corpus statistics grow with the corpus in these
tables only; the driver sees some counts of counts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import discard, materialize
from .common import forget, held_out, slices, table
from .hashing import mix, word_hashes
from .packed import pack, pack_bits, unpack, unpack_bits

CHUNK_BYTES = 6 << 20
PART_BYTES = 10 << 20
LAST_DISCOUNTED = 5
KEPT_BACK = 0.1
START, END = 0x5354415254, 0x454E44
ORDER = 3


def _tokens(texts: list):
    """(hash of each token, of the token before it, whether it begins a text, end of each text), end tokens included."""
    import numpy as np

    words, until = word_hashes([t.encode() if t else b"" for t in texts])
    end = until + np.arange(len(texts))
    token = np.full(len(words) + len(texts), END, np.uint64)
    inside = np.ones(len(token), bool)
    inside[end] = False
    token[inside] = words
    first = np.zeros(len(token), bool)
    first[np.concatenate(([0], end[:-1] + 1))] = True
    history = np.where(first, np.uint64(START), np.roll(token, 1))
    return token, history, first, end + 1


def _pair(history, token):
    import numpy as np

    return mix(mix(history + np.uint64(0x9E3779B97F4A7C15)) + token)


def _levels(token, history, first, order: int):
    """By level, the hash of the n-gram that ends at each token, and of its history; n-grams begin with start tokens where a text does."""
    import numpy as np

    keys, start = token, np.uint64(START)
    yield keys, None
    for level in range(1, order):
        before = history if level == 1 else np.where(first, start, np.roll(keys, 1))
        keys = _pair(before, token)
        yield keys, before
        start = _pair(np.array([start]), np.array([START], np.uint64))[0]


def _split(keys, parts: int):
    """Begin of each part in sorted keys, and the end."""
    import numpy as np

    part = (keys >> np.uint64(32)) * np.uint64(parts) >> np.uint64(32)
    return np.searchsorted(part, np.arange(parts + 1, dtype=np.uint64))


def _chunks(batches, size: int):
    """(number, rows) of each chunk of a task: its place among the task's, beside the task's partition."""
    import pyarrow as pa
    from pyspark import TaskContext

    first = TaskContext.get().partitionId() << 24
    for k, batch in enumerate(slices(batches, max_bytes=size)):
        yield first + k, pa.Table.from_batches([batch])


def _number(size: int):
    """The rows with the number of their chunk."""
    def body(batches):
        import pyarrow as pa

        for chunk, rows in _chunks(batches, size):
            yield from rows.append_column("chunk", pa.array([chunk] * rows.num_rows, pa.int64())).to_batches()

    return body


def _send(parts: int, order: int, size: int):
    """Chunk -> its distinct n-grams of each level with their training counts and whether a held-out text has them, by part."""
    def body(batches):
        for chunk, rows in _chunks(batches, size):
            yield from grams(chunk, rows).to_batches()

    def grams(chunk, rows):
        import numpy as np
        import pyarrow as pa

        token, history, first, end = _tokens(rows["text"].to_pylist())
        train = np.repeat(rows["train"].to_numpy().astype(float), np.diff(end, prepend=0))
        out = []
        for kind, (keys, _) in enumerate(_levels(token, history, first, order)):
            keys, at = np.unique(keys, return_inverse=True)
            counts = np.bincount(at, train, len(keys)).astype(np.uint32)
            asked = np.bincount(at, 1 - train, len(keys)) > 0
            cut = _split(keys, parts).tolist()
            out += [(kind, p, pack(np.diff(keys[a:b], prepend=np.uint64(0))), pack(counts[a:b]), pack_bits(asked[a:b]) if kind < order - 1 else None)
                    for p, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
        kinds = (pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        columns = [pa.array(c, k) for c, k in zip(zip(*out), kinds)]
        return pa.Table.from_arrays([pa.array([chunk] * len(out), pa.int64()), *columns], ["chunk", "kind", "part", "keys", "counts", "asked"])

    return body


def _count(rows):
    """Part -> each chunk's total counts, which n-grams it owns and which of them a held-out text has; row -1: N, V and the counts of
    counts."""
    import numpy as np
    import pandas as pd

    forget()
    keys = [np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in rows["keys"]]
    many = [len(k) for k in keys]
    cut = np.cumsum(many)[:-1]
    keys = np.concatenate(keys)
    order = np.argsort(keys, kind="stable")
    keys = keys[order]
    fresh = np.concatenate(([True], keys[1:] != keys[:-1]))
    del keys
    first, group = np.flatnonzero(fresh), np.cumsum(fresh) - 1
    totals = np.add.reduceat(np.concatenate([unpack(c, np.uint32) for c in rows["counts"]])[order], first, dtype=np.int64)
    own = np.empty(len(order), bool)
    own[order] = fresh
    asked = [None] * len(rows)
    if rows["asked"].iloc[0] is not None:
        bits = np.concatenate([unpack_bits(a, n) for a, n in zip(rows["asked"], many)])
        wanted = np.empty(len(order), bool)
        wanted[order] = np.maximum.reduceat(bits[order], first)[group]
        asked = [pack_bits(w) for w in np.split(wanted, cut)]
    answer = np.empty(len(order), np.uint64)
    answer[order] = totals[group]
    del order, group, first
    few = np.bincount(totals[totals <= LAST_DISCOUNTED + 1], minlength=LAST_DISCOUNTED + 2)
    numbers = np.concatenate(([totals.sum(), (totals > 0).sum()], few[1:])).astype(np.int64)
    out = [(c, pack(a), pack_bits(o), w, None) for c, a, o, w in zip(rows["chunk"], np.split(answer, cut), np.split(own, cut), asked)]
    out = pd.DataFrame([*out, (-1, None, None, None, numbers)], columns=["chunk", "counts", "own", "asked", "numbers"])
    out["kind"], out["part"] = rows["kind"].iloc[0], rows["part"].iloc[0]
    return out[["chunk", "kind", "part", "counts", "own", "asked", "numbers"]]


def discounts(counts_of_counts: list[int]) -> list[float]:
    """What a count r keeps, by r from 1 to LAST_DISCOUNTED, from the numbers of n-grams that occur 1, 2, ... times.

    Katz's form of Good-Turing; where the counts of counts don't give a share between 0 and 1, half a count is taken off.
    """
    n, k = [0, *counts_of_counts], LAST_DISCOUNTED
    out = []
    for r in range(1, k + 1):
        share = 0.0
        if n[1] and n[r]:
            common = (k + 1) * n[k + 1] / n[1]
            share = ((r + 1) * n[r + 1] / n[r] / r - common) / (1 - common) if common != 1 else 0.0
        out.append(share if 0 < share < 1 else (r - 0.5) / r)
    return out


class Model:
    """Discounts by level and unigram probabilities from the corpus totals of each level."""

    def __init__(self, totals: list[list[int]], texts: int):
        words = totals[0]
        self.n, self.v, self.texts, self.order = words[0], words[1], texts, len(totals)
        self.keep = [discounts(t[2:]) for t in totals]
        gone = sum(n_r * r * (1 - d) for r, (n_r, d) in enumerate(zip(words[2:], self.keep[0]), 1))
        more = self.v - sum(words[2:2 + LAST_DISCOUNTED])
        self.unknown = (gone + KEPT_BACK * more) / self.n if self.n else 1.0

    def discounted(self, kind: int, counts):
        """d(c) c for an array of counts."""
        import numpy as np

        keep = np.array([0.0, *self.keep[kind]])
        low = np.minimum(counts, LAST_DISCOUNTED)
        return np.where(counts > LAST_DISCOUNTED, counts - KEPT_BACK, keep[low] * counts)

    def unigram(self, counts):
        """P(w) by the word's count."""
        import numpy as np

        return np.where(counts > 0, self.discounted(0, counts) / max(self.n, 1), self.unknown)


def _evaluate(model: Model, parts: int):
    """Chunk and its answers -> a row for each text, without the weights it backs off with; and by level and part, what the chunk owns
    of each history that a held-out text has, and how often each text backs off from it."""
    def body(rows, answers):
        import numpy as np
        import pyarrow.compute as pc

        if not rows.num_rows:
            return _rows([])
        chunk = rows["chunk"][0].as_py()
        token, history, first, end = _tokens(rows["text"].to_pylist())

        def told(kind, n):
            # a level at a time: the answers to a chunk are larger than its text
            mine = answers.filter(pc.field("kind") == kind).sort_by("part").to_pylist()
            counts = [unpack(g["counts"], np.uint64) for g in mine]
            own, asked = (np.concatenate([unpack_bits(g[c], len(k)) for g, k in zip(mine, counts)]) if mine[0][c] is not None else None for c in ("own", "asked"))
            counts = np.concatenate(counts).view(np.int64)
            assert len(counts) == n, "the answers are not to this chunk"
            return counts, own, asked

        begin, place = np.concatenate(([0], end[:-1])), np.repeat(np.arange(len(end)), np.diff(end, prepend=0))
        sums = []
        for level, (keys, history_keys) in enumerate(_levels(token, history, first, model.order)):
            grams, where, at = np.unique(keys, return_index=True, return_inverse=True)
            counts, own, asked = told(level, len(grams))
            del grams, keys
            if not level:
                c_word = seen = counts[at]
                p = model.unigram(seen)
            else:
                c_history, lower, seen = np.where(first, model.texts, np.roll(seen, 1)), p, counts[at]
                # P(w | h) where the n-gram is known, else that of the shorter history, whose weight comes from the history's part
                p = np.where(seen > 0, model.discounted(level, seen) / np.maximum(c_history, 1), lower)
                mine = where[own & (counts > 0)]
                mine = mine[wanted[mine]]
                some, to = np.unique(history_keys[mine], return_inverse=True)
                both = [np.bincount(to, w[mine], len(some)) for w in (lower, p)]
                del lower, mine, to
                cut = _split(some, parts).tolist()
                sums += [{"kind": 1, "chunk": chunk, "level": level, "part": k, "keys": pack(np.diff(some[a:b], prepend=np.uint64(0))), "sums": np.stack([s[a:b] for s in both]).tobytes()}
                         for k, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
                backs = np.flatnonzero((seen == 0) & (c_history > 0))
                ask, of = history_keys[backs], place[backs]
                order = np.lexsort((of, ask))
                ask, of = ask[order], of[order]
                del order, backs, c_history, history_keys
                cut = _split(ask, parts).tolist()
                sums += [{"kind": 2, "chunk": chunk, "level": level, "part": k, "keys": pack(np.diff(ask[a:b], prepend=np.uint64(0))), "sums": pack(of[a:b].astype(np.uint32))}
                         for k, (a, b) in enumerate(zip(cut, cut[1:])) if a < b]
            wanted = first | np.roll(asked[at], 1) if asked is not None else None
            del where, at, counts, own, asked

        score = np.add.reduceat(np.log10(p), begin)
        base = np.add.reduceat(np.log10((c_word + 1) / (model.n + model.v + 1)), begin)
        known = np.add.reduceat((c_word > 0).astype(np.int64), begin)
        out = [{"kind": 0, "chunk": chunk, "place": k, "doc_id": d, "held_out": h, "n_tokens": int(n), "n_known": int(kn), "base_score": float(b), "score": float(s)}
               for k, (d, h, n, kn, b, s) in enumerate(zip(rows["doc_id"].to_pylist(), rows["held_out"].to_pylist(), np.diff(end, prepend=0), known, base, score))]
        out += sums
        return _rows(out)

    return body


KINDS = "kind int, chunk bigint, place bigint, doc_id bigint, held_out boolean, n_tokens bigint, n_known bigint, base_score double, score double, " \
        "level int, part bigint, keys binary, sums binary"


def _rows(found: list[dict]):
    import pyarrow as pa

    kinds = {"int": pa.int32(), "bigint": pa.int64(), "boolean": pa.bool_(), "double": pa.float64(), "binary": pa.binary()}
    return pa.Table.from_pylist(found, pa.schema([(n, kinds[k]) for n, k in (f.split() for f in KINDS.split(", "))]))


def _weigh(rows):
    """Part of a level -> for each chunk the logarithms of the backoff weights that its texts need, added up by text."""
    import numpy as np
    import pandas as pd

    forget()
    owned, asked = rows[rows["kind"] == 1], rows[rows["kind"] == 2]
    out = []
    if len(owned):
        keys, at = np.unique(np.concatenate([np.cumsum(unpack(k, np.uint64), dtype=np.uint64) for k in owned["keys"]]), return_inverse=True)
        sums = np.concatenate([np.frombuffer(s, float).reshape(2, -1) for s in owned["sums"]], axis=1)
        lower, kept = (np.bincount(at, s, len(keys)) for s in sums)
        weight = np.log10((1 - kept) / np.maximum(1 - lower, 1e-300))
        for chunk, k, p in zip(asked["chunk"], asked["keys"], asked["sums"]):
            k, p = np.cumsum(unpack(k, np.uint64), dtype=np.uint64), unpack(p, np.uint32)
            places, to = np.unique(p, return_inverse=True)
            total = np.bincount(to, weight[np.searchsorted(keys, k)], len(places))
            out.append((chunk, pack(places), total.tobytes()))
    return pd.DataFrame(out, columns=["chunk", "keys", "weights"])


def _add_up(rows):
    """Chunk -> the logarithm of all weights that each of its texts backs off with."""
    import numpy as np
    import pandas as pd

    places, at = np.unique(np.concatenate([unpack(k, np.uint32) for k in rows["keys"]]), return_inverse=True)
    total = np.bincount(at, np.concatenate([np.frombuffer(w, float) for w in rows["weights"]]), len(places))
    return pd.DataFrame({"chunk": rows["chunk"].iloc[0], "place": places.astype(np.int64), "weight": total})


def katz_scores(docs: DataFrame, mod: int = 7, remainder: int = 2, order: int = 2) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score): a row for each row of ``docs`` (doc_id, text).

    The model has n-grams of up to ``order`` words (1 at least). It learns from rows that are not held out and scores all. A null or empty text has the end token only. base_score
    adds up log10((c + 1) / (N + V + 1)); score is the model's log10 probability of the text. Repeated rows count and are
    scored one by one; an empty table gives an empty result; without training rows every word is unknown, with probability 1.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("bigint"), "text", held_out(mod, remainder).alias("held_out"))
    total = docs.agg(F.sum(F.octet_length("text")).alias("bytes"), F.count_if(~F.col("held_out")).alias("texts")).first()
    parts = (total["bytes"] or 0) // PART_BYTES + 1
    docs = docs.withColumn("train", ~F.col("held_out"))
    plan = docs._jdf.queryExecution().executedPlan().toString()
    stored = "Exchange" in plan or "Scan" not in plan
    if stored:
        docs = materialize(docs, "lm_docs")  # the rows are read twice and must come in the same tasks: only a stored table's do

    sent = docs.mapInArrow(_send(parts, order, CHUNK_BYTES), "chunk bigint, kind int, part bigint, keys binary, counts binary, asked binary")
    counted = materialize(sent.groupBy("kind", "part").applyInPandas(_count, "chunk bigint, kind int, part bigint, counts binary, own binary, asked binary, numbers array<bigint>"), "lm_counts")
    size = LAST_DISCOUNTED + 3
    sums = [F.sum(F.col("numbers")[k]) for k in range(size)]
    totals = {r["kind"]: list(r)[1:] for r in counted.filter("chunk = -1").groupBy("kind").agg(*sums).collect()}
    model = Model([totals.get(k, [0] * size) for k in range(order)], total["texts"])

    answers = counted.filter("chunk >= 0").select("chunk", "kind", "part", "counts", "own", "asked")
    dealt = docs.mapInArrow(_number(CHUNK_BYTES), "doc_id bigint, text string, held_out boolean, train boolean, chunk bigint")
    rows = materialize(dealt.groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(_evaluate(model, parts), KINDS), "lm_rows")
    discard(counted, *[docs] * stored)
    weights = materialize(rows.filter("kind > 0").select("kind", "chunk", "level", "part", "keys", "sums").groupBy("level", "part")
                          .applyInPandas(_weigh, "chunk bigint, keys binary, weights binary"), "lm_weights")
    backed = weights.groupBy("chunk").applyInPandas(_add_up, "chunk bigint, place bigint, weight double")
    found = rows.filter("kind = 0").join(backed, ["chunk", "place"], "left")
    return found.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(model.n).cast("bigint").alias("train_tokens"), "base_score",
                        (F.col("score") + F.coalesce("weight", F.lit(0.0))).alias("score"))


def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return katz_scores(table(spark, sf_dir, "documents"), order=ORDER)

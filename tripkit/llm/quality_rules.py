"""Quality rules: exact counts of words, symbols and repeats, and a hashed n-gram logistic regression.

The regression sees hashed word 1- and 2-grams and character 3- and 4-grams of the whole text. It is trained on labelled rows,
its probability is calibrated on labelled rows it was not trained on (Platt scaling), and the verdict compares the probability
with a fixed threshold.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append, held_out, slices, table, utf8, with_fields

WORD_BITS = 11
CHAR_BITS = 11
DIMENSIONS = (2 << WORD_BITS) + (2 << CHAR_BITS)
# The classifier is fitted on at most so many labelled rows of each label, the first by a hash of doc_id.
FIT_ROWS = 1_500
# A text is rejected when the calibrated probability of label 1 is below this.
KEEP_FROM = 0.2
MIN_WORDS = 50
SYMBOLS = re.compile(rb"[#*$%&|<>]")
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
OUTPUT = (*COUNTS, "base_failed", "probability", "kept")


def features(text: bytes):
    """Hashed n-gram counts, each of the four kinds as log(1 + count) scaled to length 1, on float32."""
    import numpy as np

    out = np.zeros(DIMENSIONS, np.float32)
    code = np.frombuffer(text, np.uint8).astype(np.uint32)
    blank = (code == 32) | (code - 9 < 5)
    begin = 0

    def put(hashes, bits):
        nonlocal begin
        if len(hashes):
            counts = np.bincount((hashes * np.uint32(0x9E3779B1)) >> np.uint32(32 - bits), minlength=1 << bits)
            counts = np.log1p(counts, dtype=np.float32)
            out[begin:begin + (1 << bits)] = counts / np.sqrt((counts * counts).sum())
        begin += 1 << bits

    # a word's hash is a difference of running sums of byte * power, taken back to the power of its start
    word = ~blank
    edge = np.diff(np.concatenate(([False], word, [False])).astype(np.int8))
    first, last = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    hashes = np.zeros(0, np.uint32)
    if len(first):
        power = _powers(len(code))
        run = np.concatenate(([0], np.cumsum((code + np.uint32(1)) * power[:len(code)], dtype=np.uint32)))
        hashes = ((run[last] - run[first]).astype(np.uint32) * _powers(len(code), inverse=True)[first]).astype(np.uint32)
    put(hashes, WORD_BITS)
    put(hashes[:-1] * np.uint32(31) + hashes[1:], WORD_BITS)
    three = code[:-2] + (code[1:-1] << np.uint32(8)) + (code[2:] << np.uint32(16))
    put(three, CHAR_BITS)
    put(three[:-1] + (code[3:] << np.uint32(24)), CHAR_BITS)
    return out


_POWERS: dict[bool, object] = {}


def _powers(n: int, inverse: bool = False):
    """Powers of an odd number modulo 2 ** 32, or of its inverse, kept up to the longest text met."""
    import numpy as np

    held = _POWERS.get(inverse)
    if held is None or len(held) < n:
        base = pow(0x01000193, -1 if inverse else 1, 1 << 32)
        factors = np.full(max(n, 1 << 16), base, np.uint32)
        factors[0] = 1
        held = _POWERS[inverse] = np.multiply.accumulate(factors, dtype=np.uint32)
    return held


def counts(text: bytes) -> tuple[int, int, int, int, int]:
    """The five exact counts of COUNTS."""
    import numpy as np

    words = text.split()
    n = len(words)
    chars = len(b"".join(words).decode()) if n else 0
    symbols = len(SYMBOLS.findall(text))
    lines = [x for x in text.split(b"\n") if x.strip()]
    repeated = 0
    if n >= 4:
        rank: dict[bytes, int] = {}
        number = np.fromiter([rank.setdefault(w, len(rank)) for w in words], np.int64, n)
        if len(rank) < 1 << 21:
            window = (number[:-2] << 42) | (number[1:-1] << 21) | number[2:]
        else:
            _, pair = np.unique(number[:-1] * len(rank) + number[1:], return_inverse=True)
            window = pair[:-1] * len(rank) + number[2:]
        order = np.argsort(window, kind="stable")
        same = window[order[1:]] == window[order[:-1]]
        if same.any():
            start = np.zeros(n, bool)  # of a window found twice or more
            start[order[1:][same]] = True
            start[order[:-1][same]] = True
            inside = start.copy()
            inside[1:] |= start[:-1]
            inside[2:] |= start[:-2]
            repeated = int(inside.sum())
    return n, chars, symbols, len(lines) - len(set(lines)), repeated


def fit(docs: DataFrame, labels: DataFrame, rows: int = FIT_ROWS, steps: int = 150) -> tuple[list[float], float, float]:
    """(weights, scale, shift): calibrated probability = sigmoid(scale * (text's features @ weights) + shift).

    ``labels`` (doc_id, quality) is joined to ``docs`` (doc_id, text); of each label the first ``rows`` by a hash of doc_id are
    used, four fifths for the weights and a fifth for the calibration. Without both labels, the probability is 1 or,
    if only label 0 is there, 0.
    """
    import numpy as np

    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("label")).dropDuplicates(["doc_id"])
    order = [F.xxhash64("doc_id"), "doc_id"]
    picked = None
    for label in (0, 1):
        some = known.filter(F.col("label") == label).orderBy(*order).limit(rows)
        picked = some if picked is None else picked.unionByName(some)

    def body(batches):
        import pyarrow as pa

        for batch in slices(batches):
            vectors = [features(t) for t in utf8(batch)]
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array([v.astype(np.float16).tobytes() for v in vectors], pa.binary())], ["doc_id", "label", "vector"])

    def train(batches):
        import pyarrow as pa

        found = pa.Table.from_batches(batches).to_pylist()
        label = np.array([r["label"] for r in found], np.float32)
        weights, scale, shift = np.zeros(DIMENSIONS, np.float32), 1.0, 30.0 if label.all() else -30.0
        if len(set(label.tolist())) == 2:
            x = np.stack([np.frombuffer(r["vector"], np.float16) for r in found]).astype(np.float32)
            check = np.arange(len(x)) % 5 == 4
            if len(set(label[check].tolist())) < 2 or len(set(label[~check].tolist())) < 2:
                check[:] = False
            weights, _ = _logistic(x[~check], label[~check], steps)
            at = check if check.any() else ~check
            (scale,), shift = _logistic((x[at] @ weights)[:, None], label[at], 2000, 0.05, 1e-3)
        yield pa.RecordBatch.from_arrays([pa.array([weights.tolist()]), pa.array([float(scale)]), pa.array([float(shift)])], ["weights", "scale", "shift"])

    few = F.broadcast(picked)  # 2 * rows rows
    vectors = docs.select("doc_id", "text").join(few, "doc_id").select("doc_id", "label", "text").mapInArrow(body, "doc_id bigint, label int, vector binary")
    # one task fits the weights on these few rows
    model = vectors.repartition(1).sortWithinPartitions(*order).mapInArrow(train, "weights array<double>, scale double, shift double").first()
    return (model["weights"], model["scale"], model["shift"]) if model else ([0.0] * DIMENSIONS, 1.0, 30.0)


def _logistic(x, label, steps, rate=0.05, penalty=1e-4):
    """Weights and shift by Adam on the log loss, the two labels weighted alike."""
    import numpy as np

    share = np.where(label == 1, 0.5 / max((label == 1).sum(), 1), 0.5 / max((label == 0).sum(), 1)).astype(np.float32)
    w, m, v = (np.zeros(x.shape[1] + 1, np.float32) for _ in range(3))
    for t in range(1, steps + 1):
        p = 1 / (1 + np.exp(-np.clip(x @ w[:-1] + w[-1], -30, 30)))
        slope = ((p - label) * share).astype(np.float32)
        g = np.append(slope @ x + penalty * w[:-1], slope.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        w = (w - rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)).astype(np.float32)
    return w[:-1], w[-1]


def apply_rules(docs: DataFrame, model: tuple[list[float], float, float], text_col: str = "text", keep_from: float = KEEP_FROM) -> DataFrame:
    """``docs`` with COUNTS, base_failed (under 50 words, or over half of them in repeated 3-word windows), probability (that a
    text is good) and kept (neither base_failed nor below ``keep_from``).

    A null text has no words. Columns of ``docs`` with the names of the result are replaced; repeated rows are judged alike;
    an empty table gives an empty result.
    """
    def body(batches):
        import math

        import numpy as np
        import pyarrow as pa

        weights, scale, shift = np.array(model[0], np.float32), model[1], model[2]
        for batch in slices(batches, text_col):
            rows = []
            for text in utf8(batch, text_col):
                c = counts(text)
                failed = c[0] < MIN_WORDS or 100 * c[4] > 50 * c[0]
                z = scale * float((features(text) * weights).sum()) + shift
                p = 1 / (1 + math.exp(-min(max(z, -30), 30)))
                rows.append((*c, failed, p, not failed and p >= keep_from))
            kinds = [pa.int64()] * 5 + [pa.bool_(), pa.float64(), pa.bool_()]
            yield append(batch, **{name: pa.array(col, kind) for name, col, kind in zip(OUTPUT, zip(*rows), kinds)})

    docs = docs.drop(*OUTPUT)
    fields = [(c, "bigint") for c in COUNTS] + [("base_failed", "boolean"), ("probability", "double"), ("kept", "boolean")]
    return docs.mapInArrow(body, with_fields(docs.schema, *fields))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held_out()))
    return apply_rules(docs.select("doc_id", "text"), model).drop("text")

"""Quality classifier: random-indexing word vectors, pooled per document, under a two-layer network.

Random indexing: each of ``BUCKETS`` hashed tokens has a fixed sparse index vector of a few +1 and -1; a token's context vector is the
sum of the index vectors around it, over every training text. Spark adds up the tasks' sums. A document is the mean and
spread of its tokens' context vectors, the mean of their index vectors, and that mean's length, which tells how much the text
repeats itself. The network is trained on labelled rows; a temperature fitted on labelled rows it wasn't trained on calibrates its
probabilities.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import append, held_out, slices, table, utf8, with_fields

BUCKET_BITS = 14
BUCKETS = 1 << BUCKET_BITS
WIDTH = 32
NONZERO = 4
REACH = 2
HIDDEN = 24
# The network is fitted on at most so many labelled rows, the first by a hash of doc_id.
FIT_ROWS = 8_000
GOOD_FROM = 0.7
OUTPUT = ("score", "predicted")
PARTS, LOTS = 8, 64
FEATURES = 3 * WIDTH + 3


def index_vectors():
    """The index vector of each bucket: NONZERO places hold +1 or -1."""
    import numpy as np

    rng = np.random.default_rng(20_240_229)
    out = np.zeros((BUCKETS, WIDTH), np.float32)
    places = rng.random((BUCKETS, WIDTH)).argpartition(NONZERO, axis=1)[:, :NONZERO]
    np.put_along_axis(out, places, rng.choice(np.array([-1, 1], np.float32), (BUCKETS, NONZERO)), axis=1)
    return out


def tokens(texts: list[bytes]):
    """(bucket of every token of all texts, the end of each text in them); a token is a run of letters and digits (or of bytes above
    127) or a run of other visible characters."""
    import numpy as np

    code = np.frombuffer(b"\n".join(texts) + b"\n", np.uint8).astype(np.uint32)
    kind = _kinds()[code]
    edge = np.flatnonzero(np.diff(kind, prepend=np.uint8(0)))
    starts = edge[kind[edge] > 0]
    ends = np.append(edge, len(code))[1:][kind[edge] > 0]
    # polynomial hashes by differences of running sums, each over some 64 bits of wrap-around arithmetic
    power = np.multiply.accumulate(np.where(np.arange(len(code)) > 0, np.uint64(0x100000001B3), np.uint64(1)).astype(np.uint64))
    run = np.concatenate((np.zeros(1, np.uint64), np.cumsum((code + np.uint32(1)).astype(np.uint64) * power, dtype=np.uint64)))
    back = np.multiply.accumulate(np.where(np.arange(len(code)) > 0, np.uint64(pow(0x100000001B3, -1, 1 << 64)), np.uint64(1)).astype(np.uint64))
    hashed = (run[ends] - run[starts]) * back[starts] * np.uint64(0x9E3779B97F4A7C15)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    return (hashed >> np.uint64(64 - BUCKET_BITS)).astype(np.int64), np.searchsorted(starts, np.cumsum(sizes + 1))


def _kinds():
    """0 white space, 1 letters and digits, 2 other characters, by byte."""
    import numpy as np

    byte = np.arange(256)
    letter = (byte > 127) | np.array([chr(b).isalnum() and b < 128 for b in range(256)])
    return np.where((byte == 32) | ((byte >= 9) & (byte <= 13)), 0, np.where(letter, 1, 2)).astype(np.uint8)


def train_vectors(docs: DataFrame):
    """Context vectors of all buckets, length 1 (or 0 for a token not met), from every text of ``docs``."""
    import numpy as np

    def body(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        index, sums, seen = index_vectors(), np.zeros((BUCKETS, WIDTH)), False
        for batch in slices(batches, max_bytes=1 << 20):
            bucket, end = tokens(utf8(batch))
            if not len(bucket):
                continue
            seen = True
            text = np.repeat(np.arange(len(end)), np.diff(end, prepend=0))
            own, around = index[bucket], np.zeros((len(bucket), WIDTH), np.float32)
            for d in range(1, REACH + 1):
                near = (text[d:] == text[:-d])[:, None]
                around[d:] += own[:-d] * near
                around[:-d] += own[d:] * near
            for k in range(WIDTH):
                sums[:, k] += np.bincount(bucket, around[:, k], BUCKETS)
        if seen:
            parts = np.split(sums.astype(np.float32), PARTS)
            lot = TaskContext.get().partitionId() % LOTS
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(PARTS, dtype=np.int32)), pa.array([lot] * PARTS, pa.int32()), pa.array([p.tobytes() for p in parts], pa.binary())], ["part", "lot", "sums"])

    def add(rows):
        import pandas as pd

        total = sum(np.frombuffer(s, np.float32).astype(np.float64) for s in rows["sums"])
        return pd.DataFrame({"part": rows["part"][:1], "lot": rows["lot"][:1], "sums": [total.astype(np.float32).tobytes()]})

    kind = "part int, lot int, sums binary"
    sums = docs.filter(F.col("text").isNotNull()).select("text").mapInArrow(body, kind) \
        .groupBy("part", "lot").applyInPandas(add, kind).groupBy("part").applyInPandas(add, kind)
    vectors = np.zeros((PARTS, BUCKETS // PARTS * WIDTH), np.float32)
    for row in sums.collect():  # PARTS rows, BUCKETS * WIDTH numbers in all
        vectors[row["part"]] = np.frombuffer(row["sums"], np.float32)
    vectors = vectors.reshape(BUCKETS, WIDTH)
    length = np.sqrt((vectors * vectors).sum(axis=1, keepdims=True))
    vectors = np.divide(vectors, length, out=np.zeros_like(vectors), where=length > 0)
    vectors -= vectors.mean(axis=0)  # what all tokens have in common says nothing
    return vectors


def pool(texts: list[bytes], vectors, index):
    """A row of FEATURES numbers for each text; zeros for a text without tokens."""
    import numpy as np

    bucket, end = tokens(texts)
    n = np.diff(end, prepend=0)
    out = np.zeros((len(texts), FEATURES), np.float32)
    some = n > 0
    if not some.any():
        return out
    begin, many = (end - n)[some], n[some][:, None].astype(np.float32)
    context = vectors[bucket]
    mean = np.add.reduceat(context, begin) / many
    spread = np.sqrt(np.maximum(np.add.reduceat(context * context, begin) / many - mean * mean, 0))
    own = np.add.reduceat(index[bucket], begin) / many
    length = (own * own).sum(axis=1, keepdims=True) / NONZERO  # about the chance that two of its tokens are equal
    out[some] = np.hstack((mean, spread, own, np.sqrt(length), np.log(length + 1e-3), np.log(many)))
    return out


def fit(docs: DataFrame, labels: DataFrame, vectors, rows: int = FIT_ROWS, steps: int = 400) -> dict:
    """The network's weights from labelled rows: ``labels`` (doc_id, quality) joined to ``docs`` (doc_id, text).

    Four fifths of the first ``rows`` by a hash of doc_id train it, a fifth sets the temperature. Without rows of both
    labels the score is 1, or 0 if only label 0 is there.
    """
    import numpy as np

    def body(batches):
        import pyarrow as pa

        index = index_vectors()
        for batch in slices(batches, max_bytes=1 << 20):
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(pool(utf8(batch), vectors, index).tolist(), pa.list_(pa.float32()))], ["doc_id", "label", "x"])

    def train(batches):
        import json

        import pyarrow as pa

        found = pa.Table.from_batches(batches)
        label = found["label"].to_numpy().astype(np.float32)
        x = np.array(found["x"].to_pylist(), np.float32)
        check = np.arange(len(x)) % 5 == 4
        if len(set(label[~check].tolist())) < 2 or len(set(label[check].tolist())) < 2:
            check[:] = False
        if len(set(label.tolist())) < 2:
            model = {"constant": float(label.all())}
        else:
            model = _train(x[~check], label[~check], steps)
            at = check if check.any() else ~check
            z, y = _margin(model, x[at]), label[at]
            loss = {t: np.logaddexp(0, np.where(y == 1, -z, z) / t).mean() for t in np.exp(np.linspace(-2, 3, 201)).tolist()}
            model["temperature"] = min(loss, key=loss.get)
        yield pa.RecordBatch.from_arrays([pa.array([json.dumps({k: np.asarray(v).tolist() for k, v in model.items()})])], ["model"])

    known = labels.filter(F.col("quality").isin(0, 1)).select("doc_id", F.col("quality").cast("int").alias("label")).dropDuplicates(["doc_id"])
    order = [F.xxhash64("doc_id"), "doc_id"]
    few = F.broadcast(known.orderBy(*order).limit(rows))  # ``rows`` rows
    pooled = docs.select("doc_id", "text").join(few, "doc_id").select("doc_id", "label", "text").mapInArrow(body, "doc_id bigint, label int, x array<float>")
    # one task fits the network on these few rows
    model = pooled.repartition(1).sortWithinPartitions(*order).mapInArrow(train, "model string").first()
    import json

    return {k: np.asarray(v, np.float32) for k, v in json.loads(model["model"]).items()} if model else {"constant": np.float32(1)}


def _train(x, label, steps, rate=0.01, penalty=1e-3):
    """Two layers (tanh, then logistic) by Adam on the log loss."""
    import numpy as np

    rng = np.random.default_rng(7)
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    z = (x - mean) / scale
    p = [rng.normal(0, 1 / np.sqrt(x.shape[1]), (x.shape[1], HIDDEN)), np.zeros(HIDDEN), rng.normal(0, 1 / np.sqrt(HIDDEN), HIDDEN), np.zeros(1)]
    m, v = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p]
    for t in range(1, steps + 1):
        hidden = np.tanh(z @ p[0] + p[1])
        error = (1 / (1 + np.exp(-np.clip(hidden @ p[2] + p[3], -30, 30))) - label) / len(z)
        back = error[:, None] * p[2] * (1 - hidden * hidden)
        slopes = [z.T @ back + penalty * p[0], back.sum(axis=0), hidden.T @ error + penalty * p[2], error.sum(keepdims=True)]
        for k, g in enumerate(slopes):
            m[k], v[k] = 0.9 * m[k] + 0.1 * g, 0.999 * v[k] + 0.001 * g * g
            p[k] = p[k] - rate * (m[k] / (1 - 0.9 ** t)) / (np.sqrt(v[k] / (1 - 0.999 ** t)) + 1e-8)
    return {"mean": mean, "scale": scale, "w1": p[0], "b1": p[1], "w2": p[2], "b2": p[3]}


def _margin(model, x):
    import numpy as np

    return np.tanh((x - model["mean"]) / model["scale"] @ model["w1"] + model["b1"]) @ model["w2"] + model["b2"]


def classify(docs: DataFrame, vectors, model: dict, text_col: str = "text", good_from: float = GOOD_FROM) -> DataFrame:
    """``docs`` with score (probability of label 1) and predicted (1 from ``good_from`` on).

    A null or empty text is scored as one without tokens. Columns of ``docs`` with the names of the result are replaced; repeated rows
    are scored alike; an empty table gives an empty result.
    """
    def body(batches):
        import numpy as np
        import pyarrow as pa

        index = index_vectors()
        for batch in slices(batches, text_col, 1 << 20):
            if "constant" in model:
                score = np.full(batch.num_rows, float(model["constant"]))
            else:
                z = _margin(model, pool(utf8(batch, text_col), vectors, index)) / float(model["temperature"])
                score = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -30, 30)))
            yield append(batch, score=pa.array(score, pa.float64()), predicted=pa.array((score >= good_from).astype(np.int32)))

    docs = docs.drop(*OUTPUT)
    return docs.mapInArrow(body, with_fields(docs.schema, ("score", "double"), ("predicted", "int")))


def op3_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    vectors = train_vectors(docs.filter(~held_out()))
    model = fit(docs, table(spark, sf_dir, "labels").filter(~held_out()), vectors)
    return classify(docs.select("doc_id", held_out().alias("held_out"), "text"), vectors, model).drop("text")

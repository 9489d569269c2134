"""Sequence packing by cutting-stock column generation.

Documents become token ids and are cut into pieces of at most ``length`` ids: all but the last of a document are full and
a sequence of their own. The rest is a cutting-stock problem over the histogram of piece lengths, in classes of
``grain`` ids: a linear program chooses how often to use each pattern (a multiset of classes that fits a sequence), a
knapsack dynamic program prices new patterns against its duals, and the fractions are rounded down; what is left
over goes first-fit. The program sees only the histogram, so its size doesn't depend on the number of documents. Pieces
are ranked within their class by Spark, and a piece's rank says which sequence of which pattern it belongs to.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize
from .common import SLICE_BYTES, slices, table
from .tokens import END_ID, MAX_WORDS, word_encoder

LENGTH = 2048
GRAIN = 8
PIECE = "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint"


def knapsack(sizes, values, capacity: int):
    """(best value, how many of each size): unbounded knapsack by dynamic programming over the room.

    The best of up to 2n pieces in a room is the best way to divide the room between two lots of up to n pieces.
    """
    import numpy as np

    rooms = np.arange(capacity + 1)
    single = np.zeros(capacity + 1)
    np.maximum.at(single, sizes, values)
    best = np.maximum.accumulate(single)
    rest = rooms[:, None] - rooms
    divided = []
    while True:
        both = np.where(rest >= 0, best + best[rest], -1.0)
        left = both.argmax(axis=1)
        value = both[rooms, left]
        if not (value > best + 1e-12).any():
            break
        divided.append(left)
        best = value

    pattern, rank = np.zeros(len(sizes), np.int64), {int(s): k for k, s in enumerate(sizes)}

    def take(room, level):
        if level:
            part = int(divided[level - 1][room])
            take(part, level - 1)
            take(room - part, level - 1)
        elif (size := int(single[:room + 1].argmax())) in rank and single[size] > 0:
            pattern[rank[size]] += 1

    take(capacity, len(divided))
    return float(best[capacity]), pattern


def _inverse(matrix):
    """Gauss-Jordan with row exchange. (No BLAS call on the driver: its thread pool may not outlive the fork that starts
    the JVM.)"""
    import numpy as np

    n = len(matrix)
    both = np.hstack((matrix, np.eye(n)))
    for k in range(n):
        pivot = k + int(np.abs(both[k:, k]).argmax())
        both[[k, pivot]] = both[[pivot, k]]
        both[k] /= both[k, k]
        factor = both[:, k].copy()
        factor[k] = 0
        both -= factor[:, None] * both[k]
    return both[:, n:].copy()


def _dot(*operands):
    import numpy as np

    return np.einsum("ij,j->i" if operands[0].ndim == 2 else "i,ij->j", *operands)


def column_generation(sizes, demand, capacity: int, gap: float = 1e-3, max_steps: int = 20_000):
    """(patterns as columns, how often each is used, lower bound): the linear program's solution, within ``gap`` of its
    optimum, by the revised simplex method. ``sizes`` ascend; every demand is positive."""
    import numpy as np

    sizes, demand = np.asarray(sizes, np.int64), np.asarray(demand, float)
    basis = np.diag(capacity // sizes).astype(float)  # at first each pattern has one size only
    inverse, cost = np.diag(1 / basis.diagonal()), np.ones(len(sizes))
    bound = float((sizes * demand).sum() / capacity)
    for step in range(1, max_steps + 1):
        used, dual = _dot(inverse, demand), _dot(cost, inverse)
        value, pattern = knapsack(sizes, np.maximum(dual, 0), capacity)
        bound = max(bound, (np.maximum(dual, 0) * demand).sum() / value)
        if (cost * used).sum() - bound <= gap * bound or value <= 1 + 1e-9 and dual.min() >= -1e-9:
            break
        if -dual.min() > value - 1:  # a surplus column: more than the demand of one size
            column, price = np.zeros(len(sizes)), 0.0
            column[dual.argmin()] = -1
        else:
            column, price = pattern.astype(float), 1.0
        step_by = _dot(inverse, column)
        ratio = np.where(step_by > 1e-9, np.maximum(used, 0) / np.maximum(step_by, 1e-9), np.inf)
        out = int(ratio.argmin())
        basis[:, out], cost[out] = column, price
        if step % 200:
            inverse[out] /= step_by[out]
            others = step_by.copy()
            others[out] = 0
            inverse -= others[:, None] * inverse[out]
        else:
            inverse = _inverse(basis)
    keep = cost > 0
    return basis[:, keep].astype(np.int64), np.maximum(_dot(inverse, demand), 0)[keep], bound


def plan(histogram: dict[int, int], capacity: int) -> list[tuple[dict[int, int], int]]:
    """[(pattern as {size: count}, how often)] that hold exactly the pieces of ``histogram`` ({size: pieces})."""
    import numpy as np

    left = {s: int(n) for s, n in sorted(histogram.items()) if n}
    if not left:
        return []
    sizes = np.array(list(left))
    patterns, used, _ = column_generation(sizes, list(left.values()), capacity)
    chosen = []
    for k in np.argsort(-used, kind="stable"):
        pattern = {int(s): int(c) for s, c in zip(sizes, patterns[:, k]) if c}
        times = min([int(used[k] + 1e-6), *(left[s] // c for s, c in pattern.items())])
        if times > 0:
            chosen.append((pattern, times))
            for s, c in pattern.items():
                left[s] -= c * times
    # rounding leaves fewer sequences than there are sizes, or about so: first-fit, longest first
    room, bins = [], []
    for s in reversed(list(left)):
        for _ in range(left[s]):
            k = next((k for k, r in enumerate(room) if r >= s), None)
            if k is None:
                k = len(room)
                room.append(capacity)
                bins.append({})
            room[k] -= s
            bins[k][s] = bins[k].get(s, 0) + 1
    return chosen + [(b, 1) for b in bins]


def cut(docs: DataFrame, length: int = LENGTH, grain: int = GRAIN, tokenizer: str | None = None, end_id: int = END_ID,
        with_ids: bool = False) -> DataFrame:
    """Pieces of the whole texts of ``docs`` (doc_id, text; a null text is empty), written to the shared folder: the
    columns of PIECE, ``ids`` if asked for, the piece's class, and its rank among its task's pieces of that class."""
    def body(batches):
        import zlib

        import numpy as np
        import pyarrow as pa
        from pyspark import TaskContext

        task, seen = TaskContext.get().partitionId(), np.zeros(length // grain + 2, np.int64)
        # ids on their way to the JVM take their room: less text at a time, and fewer words remembered
        for batch in slices(batches, max_bytes=SLICE_BYTES // 2 if with_ids else 2 * SLICE_BYTES):
            ids, end = word_encoder(tokenizer, end_id, MAX_WORDS // 3 if with_ids else MAX_WORDS).encode(batch.column(batch.schema.get_field_index("text")))
            tokens = np.diff(end, prepend=0)
            pieces = -(-tokens // length)
            doc = np.repeat(np.arange(len(tokens)), pieces)
            start = (np.arange(len(doc)) - np.repeat(np.cumsum(pieces) - pieces, pieces)) * length
            size = np.minimum(length, tokens[doc] - start)
            at = (end - tokens)[doc] + start
            little = ids.astype("<u4")
            crc = np.fromiter((zlib.crc32(little[a:a + n]) for a, n in zip(at.tolist(), size.tolist())), np.int64, len(doc))
            kind = -(-size // grain)
            order = np.argsort(kind, kind="stable")
            _, first, many = np.unique(kind[order], return_index=True, return_counts=True)
            rank = np.empty(len(doc), np.int64)
            rank[order] = np.arange(len(doc)) - np.repeat(first, many) + seen[kind[order]]
            np.add.at(seen, kind, 1)
            columns = [batch.column(batch.schema.get_field_index("doc_id")).take(pa.array(doc)), *map(pa.array, (start, size, crc, tokens[doc]))]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            if with_ids:
                columns.append(pa.ListArray.from_arrays(np.concatenate(([0], np.cumsum(size))).astype(np.int32), little.astype(np.int32)))
                names.append("ids")
            columns += [pa.array(np.full(len(doc), task, np.int64)), pa.array(kind), pa.array(rank)]
            yield pa.RecordBatch.from_arrays(columns, [*names, "task", "class", "rank"])

    schema = PIECE + ", ids array<int>" * with_ids + ", task bigint, class bigint, rank bigint"
    return materialize(docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(body, schema), "packing_pieces")


def pack(docs: DataFrame, length: int = LENGTH, grain: int = GRAIN, tokenizer: str | None = None, end_id: int = END_ID,
         with_ids: bool = False) -> DataFrame:
    """One row per piece: PIECE, ``ids`` if asked for, sequence_id and offset (gapless from 0 in its sequence).

    Every id of every document (its ids, then ``end_id``) lies in exactly one piece; a null or empty text has its end
    id only. Rows with the same doc_id are packed one by one; an empty table gives an empty result; other columns of
    ``docs`` are not read. Sequences depend on how the input is split into tasks, their number hardly.
    """
    spark, pieces = docs.sparkSession, cut(docs, length, grain, tokenizer, end_id, with_ids)
    columns = [c for c in pieces.columns if c not in ("task", "class", "rank")]
    by_task = pieces.groupBy("class", "task").agg(F.count("*").alias("n"))
    before = F.sum("n").over(Window.partitionBy("class").orderBy("task")) - F.col("n")
    by_task = materialize(by_task.withColumn("before", before), "packing_ranks")
    histogram = {r["class"]: r["n"] for r in by_task.groupBy("class").agg(F.sum("n").alias("n")).collect()}  # length / grain rows
    units = length // grain
    full = histogram.pop(units, 0)  # these fill a sequence each

    slots, ranks, sequences = [(units, 0, full, 1, 0)], dict.fromkeys(histogram, 0), full
    for pattern, times in plan(histogram, units):
        for size, count in pattern.items():
            slots.append((size, ranks[size], ranks[size] + count * times, count, sequences))
            ranks[size] += count * times
        sequences += times
    # as many rows as the patterns have sizes, which length / grain bounds
    slots = F.broadcast(spark.createDataFrame(slots, "s_class bigint, s_from bigint, s_to bigint, s_count bigint, s_first bigint"))

    ranked = pieces.join(by_task.select("class", "task", "before"), ["class", "task"]).withColumn("rank", F.col("rank") + F.col("before"))
    placed = ranked.join(slots, (F.col("class") == F.col("s_class")) & (F.col("rank") >= F.col("s_from")) & (F.col("rank") < F.col("s_to"))) \
        .withColumn("sequence_id", F.col("s_first") + F.floor((F.col("rank") - F.col("s_from")) / F.col("s_count")))
    in_order = Window.partitionBy("sequence_id").orderBy(F.desc("length"), "doc_id", "start", "rank")
    shared = placed.filter(F.col("class") < units).withColumn("offset", F.sum("length").over(in_order) - F.col("length"))
    alone = placed.filter(F.col("class") == units).withColumn("offset", F.lit(0).cast("bigint"))
    return alone.unionByName(shared).select(*columns, "sequence_id", "offset")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, ids): the ids of each sequence in order; ``packed`` has ``ids``."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "ids")))  # at most ``length`` ids in all
    return packed.groupBy("sequence_id").agg(F.flatten(F.transform(pieces, lambda p: p["ids"])).alias("ids"))


def op1_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pack(table(spark, sf_dir, "documents"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: packed pieces with their ids."""
    return pack(docs, with_ids=True)

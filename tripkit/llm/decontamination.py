"""Benchmark decontamination by suffix arrays of the training texts.

The documents that a task reads are its shards, of a few megabytes of text each. A shard's words become numbers, and its
suffix array is made by prefix doubling, as deep as the longest benchmark item. Every suffix of every item is searched in it
by bisection (all suffixes at once, in numpy): the neighbours of the place found give the suffix's longest verbatim match and
where it is; where that has a window's length, two further bisections give all places of the window. The places, put back into
documents and word positions, are the hits; documents with hits are removed.

No document is shuffled: a shard is searched where it is read, so a passage in a third of the documents is a range of each
shard's array. The benchmark is read in blocks of ``BLOCK_BYTES`` of text (of one item at least), the only thing broadcast. A
benchmark of several blocks takes one pass over the documents each; only documents with hits then meet again, by row.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce
from itertools import repeat

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import kept, slices, table, utf8

WINDOW = 10
SHARD_BYTES = 8 << 20
BLOCK_BYTES = 8 << 20
OUTPUT = ("n_words", "n_hit", "items", "hit_spans")

# A word is a run of characters other than ASCII ones that are not letters or digits; A-Z are read as a-z.
_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
_DEEP = 16  # words compared in a step of a bisection
_MANY = 1 << 16  # suffixes searched at once


def words(text: bytes) -> list[bytes]:
    return _WORD.findall(text.lower())  # bytes.lower() changes A-Z only


class Items:
    """A block of the benchmark: its words as numbers from 1, every suffix, every distinct window and the items it stands in."""

    def __init__(self, rows: list[tuple[str, bytes]], window: int):
        import numpy as np

        self.names = [name for name, _ in rows]
        split = [words(text) for _, text in rows]
        self.number: dict[bytes, int] = {}
        for item in split:
            for w in item:
                self.number.setdefault(w, len(self.number) + 1)
        # items in a row; -1 ends each, and is no training word
        self.flat = np.fromiter((n for item in split for n in (*map(self.number.__getitem__, item), -1)), np.int32)
        sizes = np.fromiter(map(len, split), np.int64, len(split))
        begin = np.cumsum(sizes + 1) - sizes - 1
        self.item = np.repeat(np.arange(len(split)), sizes)
        self.suffix = np.arange(len(self.item)) + self.item  # where each suffix begins in ``flat``
        self.left = (begin + sizes)[self.item] - self.suffix
        self.need = np.minimum(window, sizes)[self.item]
        self.depth = int(sizes.max(initial=1))
        self.flat = np.concatenate((self.flat, np.full(_DEEP, -1, np.int32)))
        # windows: equal ones are one; windows that stand in the same items are of one class
        seen: dict[bytes, int] = {}
        holders: list[set[int]] = []
        self.window = np.full(len(self.suffix), -1)
        for s in np.flatnonzero(self.left >= self.need).tolist():
            at = self.suffix[s]
            w = seen.setdefault(self.flat[at:at + self.need[s]].tobytes(), len(seen))
            if w == len(holders):
                holders.append(set())
            holders[w].add(int(self.item[s]))
            self.window[s] = w
        classes: dict[tuple, int] = {}
        self.kind = np.array([classes.setdefault(tuple(sorted(h)), len(classes)) for h in holders], np.int64)
        self.held = [frozenset(self.names[i] for i in c) for c in classes]
        self._sorted: dict[tuple, list[str]] = {}

    def items_of(self, kinds: tuple[int, ...]) -> list[str]:
        """The sorted item names of some classes."""
        if kinds not in self._sorted:
            if len(self._sorted) > 10_000:
                self._sorted.clear()
            self._sorted[kinds] = sorted(frozenset().union(*(self.held[k] for k in kinds)))
        return self._sorted[kinds]


class Shard:
    """The suffix array of some texts, over the words that the items have; 0 stands for any other word and ends a text."""

    def __init__(self, texts: list[bytes], items: Items):
        import numpy as np

        ids, self.n_words, known = [], [], items.number.get
        for text in texts:
            found = words(text)
            self.n_words.append(len(found))
            ids.append(np.fromiter(map(known, found, repeat(0)), np.int32, len(found)))
            ids.append(np.zeros(1, np.int32))
        self.ids = np.concatenate((*ids, np.zeros(_DEEP, np.int32)))
        sizes = np.array(self.n_words, np.int64) + 1
        self.begin = np.cumsum(sizes) - sizes
        self.array = self._suffixes(items.depth)

    def _suffixes(self, depth: int):
        """Places of known words, ordered by the next ``depth`` words (up to an unknown one, which no search passes)."""
        import numpy as np

        at = np.flatnonzero(self.ids)
        rank, n = self.ids.astype(np.int64), len(self.ids) - 1
        order = np.argsort(rank[at], kind="stable")
        done = 1
        while done < depth and len(at):
            pair = rank[at] * (rank.max() + 1) + rank[np.minimum(at + done, n)]
            order = np.argsort(pair, kind="stable")
            pair = pair[order]
            new = np.cumsum(np.concatenate(([1], pair[1:] != pair[:-1])))
            rank[at[order]] = new
            done *= 2
            if new[-1] == len(at):
                break
        return at[order]

    def _compare(self, items: Items, place, suffix, limit):
        """(words in common, at most ``limit``; whether the training suffix is the lesser) for pairs of suffixes."""
        import numpy as np

        common, less = np.zeros(len(place), np.int64), np.zeros(len(place), bool)
        active, steps = np.arange(len(place)), np.arange(_DEEP)
        while len(active):
            a = self.ids[(place[active] + common[active])[:, None] + steps]
            b = items.flat[(suffix[active] + common[active])[:, None] + steps]
            differ = a != b
            first = np.where(differ.any(1), differ.argmax(1), _DEEP)
            row = np.flatnonzero(first < _DEEP)
            less[active[row]] = a[row, first[row]] < b[row, first[row]]
            common[active] += first
            active = active[(first == _DEEP) & (common[active] < limit[active])]
        return np.minimum(common, limit), less & (common < limit)

    def _bisect(self, items: Items, suffix, limit, after: bool):
        """How many training suffixes are less than each suffix's first ``limit`` words (``after``: or begin with them)."""
        import numpy as np

        low, high = np.zeros(len(suffix), np.int64), np.full(len(suffix), len(self.array))
        active = np.flatnonzero(low < high)
        while len(active):
            middle = (low[active] + high[active]) // 2
            common, less = self._compare(items, self.array[middle], suffix[active], limit[active])
            up = less | (common >= limit[active]) if after else less
            low[active] = np.where(up, middle + 1, low[active])
            high[active] = np.where(up, high[active], middle)
            active = active[low[active] < high[active]]
        return low

    def longest(self, items: Items, some):
        """(length, place) of the longest match of each of ``some`` suffixes."""
        import numpy as np

        suffix, left = items.suffix[some], items.left[some]
        length, where = np.zeros(len(suffix), np.int64), np.zeros(len(suffix), np.int64)
        if not len(self.array):
            return length, where
        at = self._bisect(items, suffix, left, False)
        for near in (at, at - 1):  # on equal lengths the one at or after the suffix
            there = self.array[np.clip(near, 0, len(self.array) - 1)]
            common, _ = self._compare(items, there, suffix, left)
            better = common > length
            length, where = np.where(better, common, length), np.where(better, there, where)
        return length, where

    def hits(self, items: Items):
        """(place, words, window) of all places of all windows."""
        import numpy as np

        found = []
        for k in range(0, len(items.suffix), _MANY):
            some = np.arange(k, min(k + _MANY, len(items.suffix)))
            length, _ = self.longest(items, some)
            found.append(some[(items.window[some] >= 0) & (length >= items.need[some])])
        found = np.concatenate((*found, np.zeros(0, np.int64)))
        found = found[np.unique(items.window[found], return_index=True)[1]]  # one suffix a window
        suffix, need = items.suffix[found], items.need[found]
        low, high = self._bisect(items, suffix, need, False), self._bisect(items, suffix, need, True)
        n = high - low
        after = np.cumsum(n)
        place = self.array[np.repeat(low - after + n, n) + np.arange(after[-1] if len(n) else 0)]
        return place, np.repeat(need, n), np.repeat(items.window[found], n)

    def text_of(self, place):
        import numpy as np

        return np.searchsorted(self.begin, place, "right") - 1


def _report(shard: Shard, items: Items) -> tuple[list, list, list]:
    """(words hit, item names, spans of words) of each text of a shard."""
    import numpy as np

    n = len(shard.begin)
    place, size, window = shard.hits(items)
    edge = np.zeros(len(shard.ids) + 1, np.int64)
    np.add.at(edge, place, 1)
    np.subtract.at(edge, place + size, 1)
    hit = np.cumsum(edge) > 0
    counts = np.add.reduceat(hit[:-1], shard.begin, dtype=np.int64) if n else []
    turns = np.flatnonzero(np.diff(hit.view(np.int8), prepend=np.int8(0)))
    starts, ends = turns[::2], turns[1::2]
    spans: list[list] = [[] for _ in range(n)]
    for t, a, b in zip(shard.text_of(starts).tolist(), starts.tolist(), ends.tolist()):
        spans[t].append({"start": a - int(shard.begin[t]), "end": b - int(shard.begin[t])})
    kinds: list[list] = [[] for _ in range(n)]
    pairs = np.unique(np.stack((shard.text_of(place), items.kind[window])), axis=1)
    for t, k in pairs.T.tolist():
        kinds[t].append(k)
    return [int(c) for c in counts], [items.items_of(tuple(k)) if k else [] for k in kinds], spans


def _blocks(benchmark: DataFrame, id_col: str, text_col: str, max_bytes: int) -> Iterator[list]:
    """The items (name, text) in blocks of some bytes; there is one block at least."""
    block, size, sent = [], 0, False
    named = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("name"), F.coalesce(text_col, F.lit("")).alias("text"))
    for name, text in named.toLocalIterator():
        text = text.encode()
        if block and size + len(text) > max_bytes:
            yield block
            block, size, sent = [], 0, True
        block.append((name, text))
        size += len(text)
    if block or not sent:
        yield block


def _searched(rows: DataFrame, block: list, window: int, body, schema: str) -> DataFrame:
    """``rows`` (their last column is ``text``) run through ``body(batch, shard, items)`` by shards."""
    sent = rows.sparkSession.sparkContext.broadcast(block)

    def run(batches):
        items = kept("benchmark", lambda: Items(sent.value, window))
        for batch in slices(batches, max_bytes=SHARD_BYTES):
            yield body(batch, Shard(utf8(batch), items), items)

    return rows.mapInArrow(run, schema)


def _texts(batch, shard: Shard, items: Items):
    import pyarrow as pa

    counts, names, spans = _report(shard, items)
    span = pa.struct([("start", pa.int64()), ("end", pa.int64())])
    return pa.RecordBatch.from_arrays(
        [*batch.columns, pa.array(shard.n_words, pa.int64()), pa.array(counts, pa.int64()),
         pa.array(names, pa.list_(pa.string())), pa.array(spans, pa.list_(span))], [*batch.schema.names, *OUTPUT])


_ADDED = "n_words bigint, n_hit bigint, items array<string>, hit_spans array<struct<start:bigint,end:bigint>>"


def _joined(spans: Column) -> Column:
    """Sorted spans, those that touch made one."""
    def add(done, s):
        last = F.element_at(done, -1)
        more = F.struct(last["start"].alias("start"), F.greatest(last["end"], s["end"]).alias("end"))
        return F.when((F.size(done) > 0) & (last["end"] >= s["start"]), F.concat(F.slice(done, 1, F.size(done) - 1), F.array(more))) \
            .otherwise(F.concat(done, F.array(s)))
    return F.aggregate(F.sort_array(spans), F.array().cast("array<struct<start:bigint,end:bigint>>"), add)


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
                  window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with n_words, n_hit, items (sorted ids of the items with a window in the text) and hit_spans (word positions).

    A window is ``window`` consecutive words of an item, or all words of a shorter one. Null and empty texts have no words, nor
    hits; an item without words has no window. Items with one id are one, a null id is an empty name. Columns of ``docs`` with
    the names of the result are replaced. Empty tables are allowed on both sides. A task holds a shard, which is one text at
    least, and one block of the benchmark.
    """
    other = [c for c in docs.columns if c != text_col and c not in OUTPUT]
    packed = docs.select(F.struct(F.lit(0).alias("_"), *[F.col(f"`{c}`") for c in other]).alias("row"), F.col(text_col).alias("text"))
    shape = f"row {packed.schema['row'].dataType.simpleString()}, text string"
    blocks = _blocks(benchmark, item_id, item_text, block_bytes)
    block, following = next(blocks), next(blocks, None)
    if following is None:
        found = _searched(packed, block, window, _texts, f"{shape}, {_ADDED}")
    else:
        keyed = materialize(packed.withColumn("key", F.monotonically_increasing_id()).select("row", "key", "text"), "decontamination_rows")
        parts, first = [], True
        while block is not None:
            part = _searched(keyed.select("key", "text"), block, window, _texts, f"key bigint, text string, {_ADDED}").drop("text", "n_hit")
            parts.append(materialize(part if first else part.filter("size(items) > 0"), "decontamination_hits"))
            block, following, first = following, next(blocks, None), False
        merged = reduce(DataFrame.unionByName, parts).groupBy("key").agg(
            F.max("n_words").alias("n_words"), F.sort_array(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
            _joined(F.flatten(F.collect_list("hit_spans"))).alias("hit_spans"))
        # n_words comes from the first block's rows, which are all rows
        merged = merged.withColumn("n_hit", F.aggregate("hit_spans", F.lit(0).cast("bigint"), lambda n, s: n + s["end"] - s["start"]))
        found = keyed.join(merged, "key")
    kept_columns = [F.col("text").alias(text_col) if c == text_col else F.col(f"row.`{c}`") for c in docs.columns if c not in OUTPUT]
    return found.select(*kept_columns, *OUTPUT)


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents without a hit, as they were. All columns of ``docs`` come back, whatever their names."""
    text_col = options.get("text_col", "text")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("whole"), F.col(text_col).alias(text_col))
    return contamination(whole, benchmark, **options).filter("n_hit = 0").select("whole.*")


def longest_matches(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text", item_id: str = "item_id",
                    item_text: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(item_id, item_word, length, doc_id, doc_word): the longest verbatim match of each item, in words, and where it begins.

    Of equally long ones the first in the item, then the smallest doc_id and the first in the text. Items without a word in
    common with the documents are absent. Each shard sends one row an item.
    """
    def best(batch, shard: Shard, items: Items):
        import numpy as np
        import pyarrow as pa

        rows, ids = [], batch.column(0).to_pylist()
        for k in range(0, len(items.suffix), _MANY):
            some = np.arange(k, min(k + _MANY, len(items.suffix)))
            length, _ = shard.longest(items, some)
            order = np.lexsort((some, -length, items.item[some]))
            lead = order[np.unique(items.item[some][order], return_index=True)[1]]
            lead = lead[length[lead] > 0]
            some, length = some[lead], length[lead]
            low, high = (shard._bisect(items, items.suffix[some], length, after) for after in (False, True))
            for s, n, a, b in zip(some.tolist(), length.tolist(), low.tolist(), high.tolist()):
                places = shard.array[a:b]  # all places of that match, so that ties don't hang on the shards
                found = zip(shard.text_of(places).tolist(), places.tolist())
                (_, ident, place), text = min(((ids[t] is None, ids[t], p), t) for t, p in found)
                rows.append((items.names[items.item[s]], s - int(np.searchsorted(items.item, items.item[s])), n, ident, place - int(shard.begin[text])))
        kinds = (pa.string(), pa.int64(), pa.int64(), batch.column(0).type, pa.int64())
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], kind) for k, kind in enumerate(kinds)], list(names))

    names = ("item_id", "item_word", "length", "doc_id", "doc_word")
    kind = docs.schema[id_col].dataType.simpleString()
    schema = f"item_id string, item_word bigint, length bigint, doc_id {kind}, doc_word bigint"
    rows, parts = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")), []
    for block in _blocks(benchmark, item_id, item_text, block_bytes):
        parts.append(materialize(_searched(rows, block, window, best, schema), "decontamination_longest"))
    one = F.struct((-F.col("length")).alias("n"), F.col("item_word"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id"), F.col("doc_word"))
    return reduce(DataFrame.unionByName, parts).groupBy("item_id").agg(F.min(one).alias("best")) \
        .select("item_id", "best.item_word", (-F.col("best.n")).alias("length"), "best.doc_id", "best.doc_word")


def op11_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = contamination(docs, table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


ORACLE = r"""
WITH item AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item_id,
         regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+') AS w FROM benchmark),
win AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, unnest([w[k:k + least(len(w), 10) - 1] for k in range(1, len(w) - least(len(w), 10) + 2)]) AS g
  FROM item WHERE len(w) > 0),
doc AS (
  SELECT row_number() OVER () AS rid, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[0-9a-z\x{80}-\x{10FFFF}]+'), []) AS w FROM documents),
gram AS (
  SELECT rid, size, unnest(range(1, len(w) - size + 2)) AS pos, unnest([w[k:k + size - 1] for k in range(1, len(w) - size + 2)]) AS g
  FROM doc, (SELECT DISTINCT size FROM win) s WHERE len(w) >= size),
hit AS (SELECT rid, pos, size, item_id FROM gram JOIN win USING (size, g)),
place AS (SELECT rid, count(DISTINCT p) AS n_hit FROM (SELECT rid, unnest(range(pos, pos + size)) AS p FROM (SELECT DISTINCT rid, pos, size FROM hit)) GROUP BY rid),
held AS (SELECT rid, count(*) AS n_items, string_agg(item_id, ',' ORDER BY item_id) AS names FROM (SELECT DISTINCT rid, item_id FROM hit) GROUP BY rid)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN place USING (rid) LEFT JOIN held USING (rid)
"""

"""Token-id files: a concatenated id array with Elias-Fano encoded document boundaries.

A file holds a shard of the documents, in ascending doc_id order:

    ids      uint16 (uint32 for vocabularies over 65,536) of all documents in a row
    bounds   Elias-Fano of the document ends, starting with 0
    numbers  Elias-Fano of the doc_ids above the smallest one
    trailer  fixed size: place and parameters of the sections (see TRAILER)

Elias-Fano splits each of n ascending numbers below u: the low log2(u / n) bits are stored as they are, the high parts as
unary gaps in a bit vector, about 2 + log2(u / n) bits a number. Every 256th set bit's place is kept, so ``select``
finds any boundary by reading a few bytes from there.
"""

from __future__ import annotations

import struct

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import materialize, shared_path
from .common import SLICE_BYTES, slices, table
from .tokens import END_ID, word_encoder

MAGIC = b"TKIDS-02"
SAMPLE = 256
ENCODED = 1 << 16  # numbers, a multiple of 8
# magic, ids, documents, documents without doc_id, smallest doc_id, bytes an id, then for bounds and numbers:
# count, low bits, place and bytes of low bits, of the bit vector and of the samples
SECTION = "qqqqqqqq"
TRAILER = struct.Struct("<8sqqqqq" + SECTION * 2)


class EliasFano:
    """Ascending numbers from 0 on, in near-minimal space."""

    def __init__(self, n: int, low_bits: int, low, high, samples):
        self.n, self.low_bits, self.low, self.high, self.samples = n, low_bits, low, high, samples

    @classmethod
    def encode(cls, numbers) -> "EliasFano":
        import numpy as np

        x = np.asarray(numbers, np.int64)
        n = len(x)
        bits = max(int((int(x[-1]) + 1) // n).bit_length() - 1, 0) if n else 0
        # the low bits a block at a time: a matrix of single bits takes many times the room of the numbers
        low = [np.packbits(((x[k:k + ENCODED, None] >> np.arange(bits)) & 1).astype(np.uint8).ravel(), bitorder="little") for k in range(0, n, ENCODED)]
        place = (x >> bits) + np.arange(n)
        high = np.zeros(int(place[-1]) + 1 if n else 0, np.uint8)
        high[place] = 1
        return cls(n, bits, np.concatenate((*low, np.zeros(0, np.uint8))), np.packbits(high, bitorder="little"), place[::SAMPLE].astype(np.uint64))

    def all(self):
        import numpy as np

        place = np.flatnonzero(np.unpackbits(self.high, bitorder="little"))[:self.n]
        low = np.unpackbits(self.low, count=self.n * self.low_bits, bitorder="little").reshape(self.n, self.low_bits)
        return (place - np.arange(self.n) << self.low_bits) + low.astype(np.int64) @ (1 << np.arange(self.low_bits))

    def between(self, a: int, b: int):
        """Numbers ``a`` to ``b - 1``, read from the sample before the first to the one after the last."""
        import numpy as np

        if a >= b:
            return np.zeros(0, np.int64)
        first, after = a // SAMPLE, (b - 1) // SAMPLE + 1
        byte = int(self.samples[first]) // 8
        until = int(self.samples[after]) // 8 + 1 if after < len(self.samples) else len(self.high)
        place = np.flatnonzero(np.unpackbits(self.high[byte:until], bitorder="little")) + 8 * byte
        place = place[place >= int(self.samples[first])][a - first * SAMPLE:b - first * SAMPLE]
        bits, begin = self.low_bits, a * self.low_bits
        low = np.unpackbits(self.low[begin // 8:(b * bits + 7) // 8], bitorder="little")[begin % 8:begin % 8 + (b - a) * bits]
        low = low.reshape(b - a, bits).astype(np.int64) @ (1 << np.arange(bits))
        return (place - np.arange(a, b) << bits) + low

    def last_up_to(self, value: int, k: int) -> int:
        """The last number from ``k`` on that is not above ``value`` (``k`` if there is none), by bisection over selects."""
        low, high = k, self.n - 1
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.select(middle) <= value else (low, middle - 1)
        return low

    def select(self, k: int) -> int:
        """Number ``k``, read from the nearest sample on."""
        place, left = int(self.samples[k // SAMPLE]), k % SAMPLE
        byte = place // 8
        word = int(self.high[byte]) >> place % 8 << place % 8  # set bits from the sample on
        while left >= word.bit_count():
            left -= word.bit_count()
            byte += 1
            word = int(self.high[byte])
        for _ in range(left):
            word &= word - 1
        place = 8 * byte + (word & -word).bit_length() - 1
        bits, first = self.low_bits, k * self.low_bits
        chunk = int.from_bytes(self.low[first // 8:(first + bits + 7) // 8].tobytes(), "little")
        return (place - k << bits) | (chunk >> first % 8 & (1 << bits) - 1)


def _open(uri: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def write_shard(uri: str, blocks, wide: bool) -> tuple[int, int]:
    """Write one file from (ids, document ends in them, doc_ids or None) blocks; (documents, ids) of the whole."""
    import numpy as np

    system, path = _open(uri)
    system.create_dir(path.rpartition("/")[0], recursive=True)
    kind = np.dtype("<u4" if wide else "<u2")
    ends, numbers, n_ids, nulls = [np.zeros(1, np.int64)], [], 0, 0
    with system.open_output_stream(path) as out:
        for ids, end, doc_ids in blocks:
            if len(ids) and int(ids.max()) >> 8 * kind.itemsize:
                raise ValueError(f"id {int(ids.max())} does not fit {kind.itemsize} bytes: write the files wide")
            out.write(ids.astype(kind).tobytes())
            ends.append(end + n_ids)
            n_ids += len(ids)
            nulls += sum(d is None for d in doc_ids)
            numbers.append(np.array([d for d in doc_ids if d is not None], np.int64))
        numbers = np.concatenate(numbers) if numbers else np.zeros(0, np.int64)
        least = int(numbers[0]) if len(numbers) else 0
        place, sections = n_ids * kind.itemsize, []
        for code in (EliasFano.encode(np.concatenate(ends)), EliasFano.encode(numbers - least)):
            sections += [code.n, code.low_bits]
            for part in (code.low, code.high, code.samples):
                out.write(part.tobytes())
                sections += [place, part.nbytes]
                place += part.nbytes
        n_docs = len(numbers) + nulls
        out.write(TRAILER.pack(MAGIC, n_ids, n_docs, nulls, least, kind.itemsize, *sections))
    return n_docs, n_ids


class TokenFile:
    """A written file: its ids, boundaries and doc_ids."""

    def __init__(self, uri: str):
        import numpy as np

        system, path = _open(uri)
        self.file = system.open_input_file(path)
        size = self.file.size()
        magic, self.n_ids, self.n_docs, self.nulls, self.least, self.width, *sections = \
            TRAILER.unpack(self.file.read_at(TRAILER.size, size - TRAILER.size))
        if magic != MAGIC:
            raise ValueError(f"{uri} is not a token file")
        codes = []
        for s in (sections[:8], sections[8:]):
            parts = [np.frombuffer(self.file.read_at(s[k + 1], s[k]), kind) for k, kind in ((2, np.uint8), (4, np.uint8), (6, np.uint64))]
            codes.append(EliasFano(s[0], s[1], *parts))
        self.bounds, self.numbers = codes

    def ids(self, begin: int, end: int):
        import numpy as np

        return np.frombuffer(self.file.read_at((end - begin) * self.width, begin * self.width), f"<u{self.width}")

    def document(self, k: int):
        """The ids of document ``k``, found by two selects."""
        return self.ids(self.bounds.select(k), self.bounds.select(k + 1))

    def doc_ids(self, a: int = 0, b: int | None = None) -> list:
        """The doc_ids of documents ``a`` to ``b - 1``, all by default; those without one come first."""
        b = self.n_docs if b is None else b
        numbers = self.numbers.between(max(a - self.nulls, 0), max(b - self.nulls, 0)) + self.least
        return [None] * (min(b, self.nulls) - min(a, self.nulls)) + numbers.tolist()


def write(docs: DataFrame, folder: str, tokenizer: str | None = None, end_id: int = END_ID, wide: bool = False) -> DataFrame:
    """Write the whole texts of ``docs`` (doc_id, text) as token files; returns the manifest (shard, uri, docs, ids, start).

    Shards ascend by doc_id, rows without doc_id come first, and rows with equal doc_ids are ordered by a hash of their
    text, so that many of them can lie in several shards. A null text is empty and has its end id only; an empty
    table gives an empty manifest. A task that is run again writes a file of its own; the manifest names the files of the tasks that
    ended well. ``folder`` is one that all executors see.
    """
    def body(batches):
        import pyarrow as pa
        from pyspark import TaskContext

        context = TaskContext.get()
        uri = f"{folder}/shard-{context.partitionId():06d}-{context.taskAttemptId()}.ids"

        def blocks():
            for batch in slices(batches, max_bytes=2 * SLICE_BYTES):
                ids, end = word_encoder(tokenizer, end_id).encode(batch.column(batch.schema.get_field_index("text")))
                yield ids, end, batch.column(batch.schema.get_field_index("doc_id")).to_pylist()

        n_docs, n_ids = write_shard(uri, blocks(), wide)
        yield pa.RecordBatch.from_arrays([pa.array([x]) for x in (context.partitionId(), uri, n_docs, n_ids)], ["shard", "uri", "docs", "ids"])

    order = ["doc_id", F.xxhash64("text")]
    rows = docs.select(F.col("doc_id").cast("bigint"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    manifest = rows.mapInArrow(body, "shard bigint, uri string, docs bigint, ids bigint").filter("docs > 0")
    manifest = materialize(manifest, "token_file_tasks")
    start = F.sum("ids").over(Window.orderBy("shard")) - F.col("ids")  # one row per file
    return materialize(manifest.withColumn("start", start), "token_file_manifest")


def read(manifest: DataFrame) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files."""
    def body(batches):
        import zlib

        import numpy as np
        import pyarrow as pa

        for batch in batches:
            for uri, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                file, k = TokenFile(uri), 0
                while k < file.n_docs:  # some MB of ids at a time, one document at least; selects find where they end
                    to = max(file.bounds.last_up_to(file.bounds.select(k) + SLICE_BYTES // 4, k), k + 1)
                    bounds = file.bounds.between(k, to + 1)
                    ids, cut = file.ids(int(bounds[0]), int(bounds[-1])).astype("<u4"), (bounds - bounds[0]).tolist()
                    crc = [zlib.crc32(ids[a:b]) for a, b in zip(cut, cut[1:])]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(file.doc_ids(k, to), pa.int64()), pa.array(bounds[:-1] + start), pa.array(np.diff(bounds)), pa.array(crc, pa.int64())],
                        ["doc_id", "start", "n_tokens", "ids_crc32"])
                    k = to

    files = manifest.select("uri", "start").repartition(max(manifest.sparkSession.sparkContext.defaultParallelism, 1))
    return files.mapInArrow(body, "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def op6_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    import uuid

    folder = shared_path(spark, f"tripkit_tmp/{spark.sparkContext.applicationId}/token_files-{uuid.uuid4().hex}")
    return read(write(table(spark, sf_dir, "documents"), folder))

"""Exact deduplication with a two-pass Bloom filter.

First pass: every row sets ``hashes`` bits of a blocked Bloom filter (one block of 32,768 bits, chosen by the
hash of its text); a bit that two rows or more set is marked. Second pass: a row all of whose bits are marked may be
repeated. Only those rows shuffle; the others pass straight through as groups of one.

The filter is broadcast. It has ``bits_per_row`` bits a row up to ``max_blocks`` blocks of 4 KiB (128 MiB by
default); past that bound it lets more unique rows through to the shuffle and the result stays the same.
DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import WHITE_SPACE, apart, split_heavy, table, together, unpacked, whole

BLOCK_BITS = 32_768
OUTPUT = ("keep_id", "group_size", "kept", "text_sha256")


def text_key(text_col: str = "text") -> Column:
    """SHA-256 (lowercase hex) of the text with each white-space run made one space; null is empty."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return F.sha2(F.regexp_replace(text, WHITE_SPACE, " "), 256)


def _hex(start: int, length: int) -> Column:
    return F.conv(F.substring("text_sha256", start, length), 16, 10).cast("bigint")


def _positions(hashes: int) -> list[Column]:
    # four hex digits give 16 bits; the block number comes from the first twelve digits
    return [(_hex(13 + 4 * k, 4) % BLOCK_BITS).cast("int") for k in range(hashes)]


def build_filter(keyed: DataFrame, n_blocks: int, hashes: int) -> DataFrame:
    """(block, bits): the bits that at least two rows set; blocks without such bits are absent."""
    block = (_hex(1, 12) % n_blocks).cast("int")
    cells = keyed.select(block.alias("block"), F.explode(F.array_distinct(F.array(*_positions(hashes)))).alias("bit"))
    return (cells.groupBy("block", "bit").count().filter("count >= 2")
            .groupBy("block").agg(F.bitmap_construct_agg(F.col("bit").cast("bigint")).alias("bits")))


def marked(position: Column) -> Column:
    byte = F.conv(F.hex(F.substring(F.col("_bits"), (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    return F.floor(byte / F.pow(F.lit(2), position % 8)).cast("int") % 2 == 1


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", keep_text: bool = True,
                bits_per_row: int = 16, hashes: int = 2, max_blocks: int = 1 << 15, again: bool = False) -> DataFrame:
    """``docs`` with keep_id, group_size, kept and text_sha256.

    Texts are equal when identical after white-space runs become one space; null text counts as empty. The row with
    the smallest id of a group is kept (a null id comes last; of rows with equal ids, one is kept). An empty table
    gives an empty result. Columns of ``docs`` with the names of the result are replaced. ``keep_text=False``
    leaves the text out of the written intermediate table and of the result. ``again`` reads ``docs``, whose rows must be the same each
    time, once more where they are needed and writes those only that may be repeated.
    """
    without = OUTPUT if keep_text else (*OUTPUT, text_col)
    rows = whole(docs, F.col(id_col).alias("id"), text_key(text_col).alias("text_sha256"))
    rows = rows.withColumn("whole", F.struct(*unpacked(docs, without)))
    keyed = rows.withColumn("_row", F.monotonically_increasing_id())
    if not again:
        keyed = materialize(keyed, "dedup_keyed")
    total = (docs if again else keyed).count()
    n_blocks = min(max(-(-total * bits_per_row // BLOCK_BITS), 1), max_blocks)

    bloom = materialize(build_filter(keyed, n_blocks, hashes), "dedup_filter")
    block = (_hex(1, 12) % n_blocks).cast("int")
    probed = keyed.join(F.broadcast(bloom.withColumnsRenamed({"block": "_block", "bits": "_bits"})),
                        block == F.col("_block"), "left")
    maybe = F.coalesce(F.lit(True), F.lit(True))
    for p in _positions(hashes):
        maybe = maybe & marked(p)
    probed = probed.withColumn("_maybe", F.coalesce(F.col("_bits").isNotNull() & maybe, F.lit(False))).drop("_block", "_bits")

    suspects = probed.filter("_maybe").drop("_maybe")
    if again:
        suspects = materialize(suspects, "dedup_suspects")
    first = F.struct(F.col("id").isNull().alias("no_id"), F.col("id"), F.col("_row").alias("row"))
    groups = materialize(suspects.groupBy("text_sha256").agg(F.min(first).alias("_first"), F.count("*").alias("_n"))
                         .filter("_n >= 2"), "dedup_groups")
    heavy, light = split_heavy(groups, "_n", total)
    seen = suspects.join(F.broadcast(heavy), "text_sha256", "left")
    rest = seen.filter("_n is null").drop("_first", "_n").join(light, "text_sha256", "left")

    alone = probed.filter(~F.col("_maybe")).drop("_maybe") \
        .withColumns({"_first": F.lit(None).cast(groups.schema["_first"].dataType), "_n": F.lit(None).cast("bigint")})
    found = alone.unionByName(seen.filter("_n is not null")).unionByName(rest)
    single = F.col("_n").isNull()
    return found.select(
        *unpacked(docs, without),
        F.when(single, F.col("id")).otherwise(F.col("_first.id")).alias("keep_id"),
        F.coalesce("_n", F.lit(1)).cast("bigint").alias("group_size"),
        (single | (F.col("_first.row") == F.col("_row"))).alias("kept"), "text_sha256")


def op2_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return exact_dedup(docs, keep_text=False).select("doc_id", *OUTPUT)


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the kept rows of ``docs``."""
    found = exact_dedup(apart(docs, "doc_id", "text"), again=True)
    return found.filter("kept").select(*together(docs, "doc_id", "text"))


ORACLE = r"""
WITH t AS (SELECT doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) AS h FROM documents)
SELECT doc_id, min(doc_id) OVER w AS keep_id, count(*) OVER w AS group_size,
       row_number() OVER (PARTITION BY h ORDER BY doc_id) = 1 AS kept, h AS text_sha256
FROM t WINDOW w AS (PARTITION BY h)
"""

"""Merkle manifest of a dataset, by checkpoint and recompute.

A leaf is the digest of a row's fields. The leaves of a tree (one a language) ascend by id; eight consecutive nodes become
their digest, level by level, up to the tree's root, and the trees' roots become the dataset's root in the same way.

Only every third level is stored: aligned subtrees of 512 leaves, then 512 of their roots, and so on. A proof needs the
siblings on every level; the levels between are made anew, one aligned subtree at a time, from the stored nodes below, give
the siblings of each node and are dropped again. What lies above a subtree is the path of its root, found the same way one
stored level up and joined once a subtree.

A row's position in its tree comes from range partitions (``ranked``), so a tree that holds most of the rows is dealt over
all tasks; a group of the shuffle is one subtree, at most 512 digests. Texts are read once and never shuffled.
DataFrame functions only.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from string import ascii_lowercase, ascii_uppercase

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import table
from .ranked import numbered

FAN = 8
STEP = 3  # levels from one stored level to the next
BLOCK = FAN ** STEP
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
_PATH = "array<struct<left:string,right:string>>"


def _sha(text: Column) -> Column:
    return F.sha2(text, 256)


def leaf_digest(fields: list[Column]) -> Column:
    """SHA-256 of the fields in a row: ``-`` for a null, else the length in UTF-8 bytes, a colon and the value as text."""
    def part(value):
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))
    return _sha(F.concat(*map(part, fields)))


def _parents(nodes: Column) -> Column:
    runs = F.sequence(F.lit(0), F.floor((F.size(nodes) - 1) / FAN).cast("int"))
    return F.transform(runs, lambda k: _sha(F.array_join(F.slice(nodes, k * FAN + 1, F.lit(FAN)), "")))


def _subtrees(nodes: DataFrame, *more: str) -> DataFrame:
    """One row a subtree of the stored level ``nodes`` (tree, idx, size, digest): (tree, block, size, items, levels, top).

    ``items`` has a struct (idx, digest, *more) for each node; ``levels`` the digests of the ``STEP`` levels above and of the
    nodes' own, null where the tree ends below; ``top`` the subtree's root.
    """
    item = F.struct("idx", "digest", *more)
    blocks = nodes.groupBy("tree", F.floor(F.col("idx") / BLOCK).alias("block")) \
        .agg(F.first("size").alias("size"), F.sort_array(F.collect_list(item)).alias("items")) \
        .withColumn("l0", F.col("items.digest"))
    for k in range(STEP):  # a tree of one subtree ends where one node is left, all others go on
        below = F.col(f"l{k}")
        blocks = blocks.withColumn(f"l{k + 1}", F.when((F.col("size") > BLOCK) | (F.size(below) > 1), _parents(below)))
    names = [f"l{k}" for k in range(STEP + 1)]
    return blocks.withColumn("top", F.coalesce(*[F.col(n)[0] for n in reversed(names)])) \
        .withColumn("levels", F.array(*names)).drop(*names)


def _stored_levels(nodes: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """([the given nodes and every stored level above], (tree, digest) of the roots)."""
    levels, roots = [nodes], []
    while True:
        above = _subtrees(levels[-1]).select("tree", F.col("block").alias("idx"), F.ceil(F.col("size") / BLOCK).alias("size"),
                                             F.col("top").alias("digest"))
        above = materialize(above, f"{name}_level{len(levels) * STEP}")
        roots.append(above.filter("size = 1").select("tree", "digest"))
        rest = above.filter("size > 1")
        if rest.isEmpty():
            return levels, reduce(DataFrame.unionByName, roots)
        levels.append(rest)


def _siblings(levels: Column, idx: Column) -> Column:
    """The siblings left and right of node ``idx`` and of its ancestors within the subtree, upwards."""
    steps = []
    for k in range(STEP):
        place = F.floor(idx / FAN ** k).cast("int") % FAN ** (STEP - k)  # in the level
        turn = place % FAN  # in the run
        own = F.array_join(F.slice(levels[k], place - turn + 1, turn), ""), F.array_join(F.slice(levels[k], place + 2, FAN - 1 - turn), "")
        steps.append(F.when(levels[k + 1].isNotNull(), F.struct(own[0].alias("left"), own[1].alias("right"))))
    return F.filter(F.array(*steps), lambda s: s.isNotNull())


def _paths(nodes: DataFrame, above: DataFrame, *more: str) -> DataFrame:
    """(tree, idx, digest, *more, path) and the further columns of ``above``; ``above`` has (tree, block, path, ...) of every
    subtree's root."""
    told = [c for c in above.columns if c not in ("tree", "block", "path")]
    joined = _subtrees(nodes, *more).join(above, ["tree", "block"])
    rows = F.transform("items", lambda x: F.struct(x["idx"].alias("idx"), x["digest"].alias("digest"), *[x[c].alias(c) for c in more],
                                                   F.concat(_siblings(F.col("levels"), x["idx"]), F.col("path")).alias("path")))
    return joined.select("tree", *told, F.inline(rows))


@dataclass
class Manifest:
    """Stored levels: ``trees`` and ``top`` list (tree, idx, size, digest) tables, the lowest first (the leaves have the rows'
    ``doc_id`` and ``lang`` besides, and what ``leaves`` was given); ``roots`` has each tree's root."""

    trees: list[DataFrame]
    top: list[DataFrame]
    roots: DataFrame
    extra: tuple[str, ...] = ()

    def root(self) -> DataFrame:
        """(root): one row, none for an empty table."""
        return _stored_root(self.top)


def _stored_root(levels: list[DataFrame]) -> DataFrame:
    return _subtrees(levels[-1]).select(F.col("top").alias("root"))


def leaves(docs: DataFrame, **extra: Column) -> DataFrame:
    """(tree, doc_id, lang, digest, extra columns) of every row, written. Other columns of ``docs`` are not read."""
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang")), F.lit(""))  # a null language comes first, then by bytes
    return materialize(docs.select(tree.alias("tree"), "doc_id", "lang", leaf_digest([F.col(c) for c in FIELDS]).alias("digest"),
                                   *[c.alias(n) for n, c in extra.items()]), "merkle_rows")


def manifest(docs: DataFrame, **extra: Column) -> Manifest:
    """The manifest of ``docs`` (doc_id, source, lang, n_chars, text).

    Nulls have a digest of their own; rows with equal doc_id (a null one comes first) are ordered by digest, so equal rows are
    leaves side by side. An empty table has no tree and no root. ``extra`` columns go with the leaves and into no digest.
    """
    placed = numbered(leaves(docs, **extra), "tree", ["doc_id", "digest"], "merkle_leaves")
    trees, roots = _stored_levels(placed, "merkle")
    forest = numbered(materialize(roots.withColumn("all", F.lit("")), "merkle_roots"), "all", ["tree"], "merkle_top")
    top, _ = _stored_levels(forest.select(F.col("all").alias("tree"), "idx", "size", "digest", F.col("tree").alias("of")), "merkle_top")
    return Manifest(trees, top, roots, tuple(extra))


def proofs(made: Manifest) -> DataFrame:
    """(doc_id, lang, leaf, subroot, root, path, extra columns) of every row.

    ``path`` has a struct for each level, from the leaf's run to the root's, with the digests of the node's siblings to its left
    and to its right, as hex text in a row.
    """
    above = materialize(_stored_root(made.top).select(F.lit("").alias("tree"), F.lit(0).cast("bigint").alias("block"),
                                                      F.array().cast(_PATH).alias("path"), "root"), "merkle_paths")
    for level in reversed(made.top[1:]):
        above = materialize(_paths(level, above).select("tree", F.col("idx").alias("block"), "path", "root"), "merkle_paths")
    # the trees' roots are the subtrees' roots of trees that end there
    ended = materialize(_paths(made.top[0], above, "of").select(F.col("of").alias("tree"), F.lit(0).cast("bigint").alias("block"),
                                                                "path", "root", F.col("digest").alias("subroot")), "merkle_paths")
    above = ended
    for level in reversed(made.trees[1:]):
        here = _paths(level, above).select("tree", F.col("idx").alias("block"), "path", "root", "subroot")
        # block 0 of a tree that goes on is a node of this level, not the tree's root
        going_on = level.select("tree").distinct()
        above = materialize(here.unionByName(ended.join(going_on, "tree", "left_anti")), "merkle_paths")
    return _paths(made.trees[0], above, "doc_id", "lang", *made.extra) \
        .select("doc_id", "lang", F.col("digest").alias("leaf"), "subroot", "root", "path", *made.extra)


def proof_digest(path: Column) -> Column:
    return _sha(F.array_join(F.transform(path, lambda s: F.concat(s["left"], s["right"])), ""))


def fold(leaf: Column, path: Column) -> Column:
    """The root that ``leaf`` and its siblings give."""
    return F.aggregate(path, leaf, lambda node, s: _sha(F.concat(s["left"], node, s["right"])))


def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    lower = F.translate("text", ascii_uppercase, ascii_lowercase)
    tampered = leaf_digest([lower if c == "text" else F.col(c) for c in FIELDS])
    hit = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    found = proofs(manifest(docs, tampered=F.when(hit, tampered)))
    folded = found.select("doc_id", "leaf", "subroot", "root", proof_digest(F.col("path")).alias("proof_sha256"),
                          fold(F.coalesce("tampered", "leaf"), F.col("path")).alias("folded_root"))
    return folded.withColumn("verified", F.col("folded_root") == F.col("root"))


ORACLE = r"""
WITH RECURSIVE bit(i, v, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bit WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM bit WHERE k = 8),
field AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce('=' || lang, '') AS tree,
         coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-') || coalesce(strlen(source) || ':' || source, '-')
           || coalesce(strlen(lang) || ':' || lang, '-') || coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-') AS head, text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(doc_id::VARCHAR, ''), lambda c: ascii(c)::BIGINT)),
                         lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 3 = 0 AS hit
  FROM documents, crc_table),
leaf AS (
  SELECT rid, doc_id, tree, sha256(head || coalesce(strlen(text) || ':' || text, '-')) AS d, hit,
         sha256(head || coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-')) AS t
  FROM field),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, d) - 1 AS idx, count(*) OVER (PARTITION BY tree) AS n FROM leaf),
node(tree, level, idx, d, n) AS (
  SELECT tree, 0, idx, d, n FROM placed
  UNION ALL
  SELECT tree, level + 1, idx // 8, sha256(string_agg(d, '' ORDER BY idx)), (n + 7) // 8 FROM node WHERE n > 1 GROUP BY tree, level, idx // 8, n),
sub AS (SELECT tree, max(level) AS height, arg_max(d, level) AS subroot FROM node GROUP BY tree),
top(level, idx, d, n) AS (
  SELECT 0, row_number() OVER (ORDER BY tree) - 1, subroot, count(*) OVER () FROM sub
  UNION ALL
  SELECT level + 1, idx // 8, sha256(string_agg(d, '' ORDER BY idx)), (n + 7) // 8 FROM top WHERE n > 1 GROUP BY level, idx // 8, n),
pos AS (SELECT tree, height, subroot, row_number() OVER (ORDER BY tree) - 1 AS place FROM sub),
every(key, level, run, idx, d) AS (
  SELECT '.' || tree, level, idx // 8, idx, d FROM node WHERE n > 1
  UNION ALL SELECT '', level, idx // 8, idx, d FROM top WHERE n > 1),
step AS (
  SELECT p.rid, g.level, p.idx // (8 ** g.level)::BIGINT AS at, '.' || p.tree AS key, g.level AS k
  FROM placed p JOIN pos USING (tree), (SELECT DISTINCT level FROM node) g WHERE g.level < pos.height
  UNION ALL
  SELECT p.rid, pos.height + g.level, pos.place // (8 ** g.level)::BIGINT, '', g.level
  FROM placed p JOIN pos USING (tree), (SELECT DISTINCT level FROM top) g WHERE g.level < (SELECT max(level) FROM top)),
path AS (
  SELECT s.rid, s.level, coalesce(string_agg(e.d, '' ORDER BY e.idx) FILTER (e.idx < s.at), '') AS l,
         coalesce(string_agg(e.d, '' ORDER BY e.idx) FILTER (e.idx > s.at), '') AS r
  FROM step s JOIN every e ON e.key = s.key AND e.level = s.k AND e.run = s.at // 8 GROUP BY s.rid, s.level),
folding(rid, level, d) AS (
  SELECT rid, 0, CASE WHEN hit THEN t ELSE d END FROM placed
  UNION ALL
  SELECT f.rid, f.level + 1, sha256(p.l || f.d || p.r) FROM folding f JOIN path p ON p.rid = f.rid AND p.level = f.level),
folded AS (SELECT rid, arg_max(d, level) AS folded_root FROM folding GROUP BY rid),
proof AS (SELECT rid, sha256(string_agg(l || r, '' ORDER BY level)) AS h FROM path GROUP BY rid),
done AS (
  SELECT doc_id, p.d AS leaf, subroot, (SELECT arg_max(d, level) FROM top) AS root, coalesce(h, sha256('')) AS proof_sha256, folded_root
  FROM placed p JOIN pos USING (tree) JOIN folded USING (rid) LEFT JOIN proof USING (rid))
SELECT *, folded_root = root AS verified FROM done
"""

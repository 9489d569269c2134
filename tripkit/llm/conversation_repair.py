"""Conversation structure repair by weighted CYK parsing.

A conversation may be empty, or an optional system row and then user and assistant rows in turn. Rows may be kept, given
another role, deleted, or inserted, each at a cost; the cheapest repair is the cheapest parse of the rows by a grammar in
Chomsky normal form whose words are the legal conversations and whose rules on single rows are the edits.

``parse`` fills a chart over all spans of rows, bottom-up by length. A cell has, for each nonterminal, the least (cost, audit)
of its span, over all splits and rules; the audit is the string of the edits' initials, so ties are broken in the cell itself
(two audits of one span and cost are never prefixes of each other, so the least of a concatenation is the concatenation of the
leasts). Each cell is closed under insertion: joined with the cell of the empty span on both sides. In this grammar every split
of a span derives all it can derive, so spans longer than ``CHART`` rows are made of neighbouring spans by one split, with
the same rules. Charts depend on the rows' roles and faults only, and those met before are remembered.

Conversations meet by a shuffle on their id, sorted, and stream through a task one at a time. One with more than ``LONG_ROWS``
rows or ``LONG_BYTES`` of text never does: its rows are numbered by range partitions, parsed in chunks, the chunks' cells
combined by length, and the edits joined to the rows again. Both ways give the same rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache, reduce
from itertools import groupby

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import join_groups, table
from .ranked import numbered

DELETE, REROLE, INSERT, TRUNCATED = 4, 3, 3, 3  # costs; a truncated row that stays costs TRUNCATED more
CHART = 8
LONG_ROWS, LONG_BYTES = 4096, 32 << 20
CHUNK, FAN = 4096, 32
_SPACE = " \t\n\x0b\x0c\r"

Cell = dict  # nonterminal -> (cost, audit)

# Nonterminals by the roles a span puts out: none, one system row, or user and assistant rows in turn from the first letter to
# the last ("su", "sa": with the system row before them).
_NEXT = {"u": "a", "a": "u"}
_TURNS = [x + y for x in "uas" for y in "ua"]
RULES = [("", "", "")] + [r for x in ("s", *_TURNS) for r in ((x, "", x), (x, x, ""))] + [("s" + y, "s", "u" + y) for y in "ua"] \
    + [(x + y, x + z, _NEXT[z] + y) for x in "uas" for z in "ua" for y in "ua"]
LEGAL = ("", "ua", "sa")
_BY_LEFT = {a: [(whole, b) for whole, first, b in RULES if first == a] for _, a, _ in RULES}


def joined(left: Cell, right: Cell, into: Cell | None = None) -> Cell:
    """The cell of two neighbouring spans, by every binary rule; never worse than ``into``."""
    out = dict(into or {})
    for a, (m, x) in left.items():
        for whole, b in _BY_LEFT[a]:
            if b in right:
                n, y = right[b]
                best_yet = out.get(whole)
                if best_yet is None or m + n < best_yet[0] or (m + n == best_yet[0] and x + y < best_yet[1]):
                    out[whole] = (m + n, x + y)
    return out


# the empty span: nothing, or inserted rows; no system row is ever inserted
EMPTY: Cell = {"": (0, ""), "uu": (INSERT, "I"), "aa": (INSERT, "I"), "ua": (2 * INSERT, "II"), "au": (2 * INSERT, "II")}


def closed(cell: Cell) -> Cell:
    """``cell`` with insertions before and after its span."""
    before = joined(EMPTY, cell, cell)
    return joined(before, EMPTY, before)


def row_cell(initial: str, fault: str) -> Cell:
    """One row: ``initial`` of its role; ``fault`` is "x" where it must go, "t" where it is truncated, else ".". """
    cell = {"": (DELETE, "D")}
    if fault != "x":
        extra = TRUNCATED if fault == "t" else 0
        for role in "ua":
            cell[role * 2] = (extra, "K") if initial == role else (extra + REROLE, "R")
        if initial == "s":
            cell["s"] = (extra, "K")
    return closed(cell)


@lru_cache(maxsize=20_000)
def chart(rows: str) -> Cell:
    """The cell of a whole span of rows (two letters each: initial and fault), from the chart of all spans in it."""
    n = len(rows) // 2
    cells = {(i, i + 1): row_cell(rows[2 * i], rows[2 * i + 1]) for i in range(n)}
    for length in range(2, n + 1):
        for i in range(n - length + 1):
            j = i + length
            cells[i, j] = closed(reduce(lambda best, k: joined(cells[i, k], cells[k, j], best), range(i + 1, j), {}))
    return cells[0, n] if n else EMPTY


def combined(cells: list[Cell]) -> Cell:
    """The cell of neighbouring spans, by pairs."""
    while len(cells) > 1:
        cells = [closed(joined(*cells[k:k + 2])) if k + 1 < len(cells) else cells[k] for k in range(0, len(cells), 2)]
    return cells[0] if cells else EMPTY


def parse(rows: str) -> Cell:
    return combined([chart(rows[k:k + 2 * CHART]) for k in range(0, len(rows), 2 * CHART)])


def best(cell: Cell) -> tuple[int, str]:
    return min(cell[x] for x in LEGAL if x in cell)


def illegal_pairs(rows: str) -> int:
    return sum(rows[k] + rows[k + 2] not in ("su", "ua", "au") for k in range(0, len(rows) - 2, 2))


def edits(rows: str, audit: str) -> Iterator[tuple[int | None, str, str | None]]:
    """(row, edit, new role) of each edit that leaves a row; an inserted one has no number, a kept one no new role."""
    k, last = 0, ""
    for edit in audit:
        initial = rows[2 * k:2 * k + 1]
        if edit in "RI":
            last, role = ("a", "assistant") if last == "u" else ("u", "user")
            yield (k if edit == "R" else None), edit, role
        elif edit == "K":
            last = initial
            yield k, edit, None
        k += edit != "I"


REPORT = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint, audit string"


def _marked(convs: DataFrame) -> DataFrame:
    """(conv, conv_id, turn, role, text, gone, mark) of every row; a null role or text is one space. ``mark`` has the role's
    initial and "x" for a blank row, "t" for a truncated one or "."; ``gone`` rows only stand for their conversation."""
    space = F.lit(" ")
    rows = convs.select(F.coalesce(F.concat(F.lit("="), F.col("conv_id").cast("string")), F.lit("")).alias("conv"), "conv_id",
                        F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", space).alias("role"),
                        F.coalesce("text", space).alias("text"), F.col("gone") if "gone" in convs.columns else F.lit(False).alias("gone"))
    first = F.substring("role", 1, 1)
    end = F.substring(F.rtrim(F.col("text"), F.lit(_SPACE)), -1, 1)
    fault = F.when(end == "", "x").when(end.isin(".", "!", "?"), ".").otherwise("t")
    return rows.withColumn("mark", F.concat(F.when(first.isin("u", "a", "s"), first).otherwise("-"), fault))


def _stream(batches, body, schema):
    """``body(rows)`` for each run of rows of one conversation; its records become Arrow batches."""
    import pyarrow as pa

    def every():
        for batch in batches:
            yield from batch.to_pylist()

    out = []
    for _, rows in groupby(every(), key=lambda r: r["conv"]):
        out.extend(body(rows))
        if len(out) >= 1000:
            yield pa.RecordBatch.from_pylist(out, schema)
            out = []
    yield pa.RecordBatch.from_pylist(out, schema)


def _repaired(rows):
    """One conversation's report and repaired rows."""
    rows = list(rows)
    conv, conv_id = rows[0]["conv"], rows[0]["conv_id"]
    rows = [r for r in rows if not r["gone"]]
    seen, marks, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0}
    for r in rows:
        initial, fault = r["mark"]
        key = (r["role"], r["text"])
        if fault == "x":
            counts["blank"] += 1
        elif key in seen:
            counts["duplicate"] += 1
            fault = "x"
        else:
            counts["truncated"] += fault == "t"
            seen.add(key)
        marks.append(initial + fault)
    marks = "".join(marks)
    turns = {r["turn"] for r in rows} - {None}
    cost, audit = best(parse(marks))
    left = [{"role": role or rows[k]["role"], "text": "" if k is None else rows[k]["text"], "edit": edit} for k, edit, role in edits(marks, audit)]
    yield {"conv": conv, "conv_id": conv_id, "gaps": max(turns) - min(turns) + 1 - len(turns) if turns else 0, **counts,
           "illegal": illegal_pairs(marks), "cost": cost, "audit": audit, "repaired": left}


def _arrow_schema(spark: SparkSession, ddl: str):
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import _parse_datatype_string

    return to_arrow_schema(_parse_datatype_string(ddl))


def _short(rows: DataFrame, kind: str) -> DataFrame:
    """Whole conversations, one at a time in a task: the report and the repaired rows as a list."""
    ddl = f"conv string, conv_id {kind}, {REPORT}, repaired array<struct<role:string,text:string,edit:string>>"
    schema = _arrow_schema(rows.sparkSession, ddl)
    met = rows.repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")
    return met.mapInArrow(lambda batches: _stream(batches, _repaired, schema), ddl)


_CELL = "conv string, part bigint, illegal bigint, first string, last string, cell string"


def _cells(made):
    """One chunk's parse, or some neighbouring ones', as a row: their cell is JSON."""
    import json

    out = []
    for conv, part, illegal, first, last, cell in made:
        out.append({"conv": conv, "part": part, "illegal": illegal, "first": first, "last": last, "cell": json.dumps(cell)})
    return out


def _long_report(chunks: DataFrame) -> DataFrame:
    """(conv, illegal, cost, audit) from (conv, part, marks): chunks are parsed, then combined by ``FAN`` until one is left."""
    import json

    schema = _arrow_schema(chunks.sparkSession, _CELL)

    def parsed(batches):
        import pyarrow as pa
        for batch in batches:
            yield pa.RecordBatch.from_pylist(_cells((r["conv"], r["part"], illegal_pairs(r["marks"]), r["marks"][0], r["marks"][-2],
                                                     parse(r["marks"])) for r in batch.to_pylist()), schema)

    def merged(group):
        import pandas as pd
        rows = group.sort_values("part").to_dict("records")
        between = sum(a["last"] + b["first"] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cell = combined([{k: tuple(v) for k, v in json.loads(r["cell"]).items()} for r in rows])
        return pd.DataFrame(_cells([(rows[0]["conv"], rows[0]["part"] // FAN, sum(r["illegal"] for r in rows) + between,
                                     rows[0]["first"], rows[-1]["last"], cell)]))

    level = materialize(chunks.mapInArrow(parsed, _CELL), "repair_cells")
    while not level.filter("part > 0").isEmpty():
        level = materialize(level.groupBy("conv", F.floor(F.col("part") / FAN).alias("_up")).applyInPandas(merged, _CELL), "repair_cells")
    chosen = F.udf(lambda cell: best({k: tuple(v) for k, v in json.loads(cell).items()}), "cost bigint, audit string")
    return level.select("conv", "illegal", chosen("cell").alias("b")).select("conv", "illegal", "b.*")


def _long(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(report by conversation, repaired rows (conv, position, role, text, edit)) of long conversations; both are written tables."""
    placed = numbered(materialize(rows.filter(~F.col("gone")), "repair_long"), "conv", ["turn", "role", "text"], "repair_numbered")
    same = F.sha2(F.concat_ws("\x00", "conv", F.octet_length("role").cast("string"), "role", "text"), 256)
    keyed = placed.withColumn("same", same)
    total = keyed.count()
    groups = materialize(keyed.groupBy("same").agg(F.min("idx").alias("earliest"), F.count("*").alias("n")), "repair_same")
    told = join_groups(keyed, groups, "same", "n", total)
    blank = F.substring("mark", 2, 1) == "x"
    again = ~blank & (F.col("idx") > F.col("earliest"))
    told = materialize(told.withColumns({"again": again, "mark": F.when(again, F.concat(F.substring("mark", 1, 1), F.lit("x"))).otherwise(F.col("mark"))})
                       .drop("same", "earliest"), "repair_told")
    chunks = told.groupBy("conv", F.floor(F.col("idx") / CHUNK).alias("part")) \
        .agg(F.array_join(F.sort_array(F.collect_list(F.struct("idx", "mark")))["mark"], "").alias("marks"))
    chunks = materialize(chunks, "repair_chunks")
    parses = materialize(_long_report(chunks), "repair_parses")
    fault = F.substring("mark", 2, 1)
    counts = told.groupBy("conv").agg(F.count_if((fault == "x") & ~F.col("again")).alias("blank"), F.count_if("again").alias("duplicate"),
                                      F.count_if(fault == "t").alias("truncated"))
    turns = told.filter("turn is not null").groupBy("conv", "turn").count().groupBy("conv") \
        .agg((F.max("turn") - F.min("turn") + 1 - F.count("*")).alias("gaps"))
    report = counts.join(turns, "conv", "left").join(parses, "conv").withColumn("gaps", F.coalesce("gaps", F.lit(0)))
    report = materialize(report, "repair_report")

    ddl = "conv string, position bigint, idx bigint, edit string, new_role string"
    schema = _arrow_schema(rows.sparkSession, ddl)

    def listed(batches):  # an audit has a letter a row: the edits leave in lots, the rows' texts are not here
        import pyarrow as pa
        for batch in batches:
            for r in batch.to_pylist():
                lot = []
                for position, (k, edit, role) in enumerate(edits("".join(r["marks"]), r["audit"])):
                    lot.append({"conv": r["conv"], "position": position, "idx": k, "edit": edit, "new_role": role})
                    if len(lot) == 10_000:
                        yield pa.RecordBatch.from_pylist(lot, schema)
                        lot = []
                yield pa.RecordBatch.from_pylist(lot, schema)

    marks = chunks.groupBy("conv").agg(F.sort_array(F.collect_list(F.struct("part", "marks")))["marks"].alias("marks"))
    steps = materialize(marks.join(parses, "conv").select("conv", "marks", "audit").mapInArrow(listed, ddl), "repair_edits")
    kept = steps.filter("idx is not null").join(told.select("conv", "idx", "role", "text"), ["conv", "idx"]) \
        .select("conv", "position", F.coalesce("new_role", "role").alias("role"), "text", "edit")
    added = steps.filter("idx is null").select("conv", "position", F.col("new_role").alias("role"), F.lit("").alias("text"), "edit")
    return report, materialize(kept.unionByName(added), "repair_rows")


def _digests(rows: DataFrame) -> DataFrame:
    """(conv, repaired_sha256) of repaired rows: they stream through the digest in order and are never held."""
    ddl = "conv string, repaired_sha256 string"
    schema = _arrow_schema(rows.sparkSession, ddl)

    def digest(group):
        h, conv = hashlib.sha256(), None
        for k, r in enumerate(group):
            conv = r["conv"]
            h.update(("\n" if k else "").encode() + f"{r['role']}:{r['text']}".encode())
        yield {"conv": conv, "repaired_sha256": h.hexdigest()}

    met = rows.repartition("conv").sortWithinPartitions("conv", "position")
    return met.mapInArrow(lambda batches: _stream(batches, digest, schema), ddl)


def _line(row: Column) -> Column:
    return F.concat(row["role"], F.lit(":"), row["text"])


_COUNTS = [c.split()[0] for c in REPORT.split(", ")]


def _parts(convs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(short conversations' rows, long ones' or None where there are none)."""
    rows = _marked(convs)
    sizes = rows.groupBy("conv").agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes"))
    heavy = materialize(sizes.filter((F.col("n") > LONG_ROWS) | (F.col("bytes") > LONG_BYTES)).select("conv"), "repair_heavy")
    if heavy.isEmpty():
        return rows, None
    return rows.join(heavy, "conv", "left_anti"), rows.join(heavy, "conv", "left_semi")


def repair(convs: DataFrame) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256) of every conversation.

    ``convs`` has conv_id, turn, role, text and optionally ``gone`` (boolean: the row counts for nothing but its conversation's
    presence); other columns are not read. Rows are taken by turn (null first), then role and text, so rows of one turn have a
    defined order; a null role or text is one space, a null conv_id a conversation of its own. A role whose initial is not u,
    a or s can't be kept. A conversation without rows has zeros, an empty audit and the digest of the empty string. The
    digest is of the repaired ``role:text`` lines. An empty table gives an empty result.
    """
    short, long = _parts(convs)
    kind = convs.schema["conv_id"].dataType.simpleString()
    text = F.array_join(F.transform("repaired", _line), "\n")
    out = _short(short, kind).select("conv_id", *_COUNTS, F.sha2(text, 256).alias("repaired_sha256"))
    if long is not None:
        report, lines = _long(long)
        names = long.select("conv", "conv_id").distinct()
        done = names.join(report, "conv", "left").join(_digests(lines), "conv", "left")
        nothing = hashlib.sha256(b"").hexdigest()
        out = out.unionByName(done.select("conv_id", *[F.coalesce(c, F.lit("" if c == "audit" else 0)).alias(c) for c in _COUNTS],
                                          F.coalesce("repaired_sha256", F.lit(nothing)).alias("repaired_sha256")))
    return out


def repaired_rows(convs: DataFrame) -> DataFrame:
    """(conv_id, position, role, text, edit): the rows of every repaired conversation, in order by position (from 0). Conversations
    that repair to nothing are absent. Input as in ``repair``."""
    short, long = _parts(convs)
    kind = convs.schema["conv_id"].dataType.simpleString()
    out = _short(short, kind).select("conv_id", F.posexplode("repaired").alias("position", "r")) \
        .select("conv_id", F.col("position").cast("bigint").alias("position"), "r.*")
    if long is not None:
        names = long.select("conv", "conv_id").distinct()
        out = out.unionByName(_long(long)[1].join(names, "conv").select(*out.columns))
    return out


def damaged(convs: DataFrame) -> DataFrame:
    """The contract's damage, by crc32 of ``conv_id:turn`` (a null is one space in the key, too); dropped rows are ``gone``."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return convs.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"), (kind == 0).alias("gone"),
        F.explode(F.array_repeat(F.lit(0), F.when(kind == 3, 2).otherwise(1))).alias("copy")).drop("copy")


def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair(damaged(table(spark, sf_dir, "conversations")))


# The least (cost, audit) of each state after each row: 0 nothing put out, 1 system, 2 user, 3 assistant. A state's list is
# closed under insertions; the last rows' closed states 0 and 3 hold the repair.
_STATES = """[
  list_min(list_filter([c0], lambda x: x IS NOT NULL)), list_min(list_filter([c1], lambda x: x IS NOT NULL)),
  list_min(list_filter([c2, {'c': c0.c + 3, 'a': c0.a || 'I'}, {'c': c1.c + 3, 'a': c1.a || 'I'}, {'c': c3.c + 3, 'a': c3.a || 'I'}], lambda x: x.c IS NOT NULL)),
  list_min(list_filter([c3, {'c': c2.c + 3, 'a': c2.a || 'I'}, {'c': c0.c + 6, 'a': c0.a || 'II'}, {'c': c1.c + 6, 'a': c1.a || 'II'}], lambda x: x.c IS NOT NULL))]"""

ORACLE = r"""
WITH RECURSIVE bit(i, v, k) AS (
  SELECT range, range, 0 FROM range(256)
  UNION ALL
  SELECT i, CASE WHEN v % 2 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END, k + 1 FROM bit WHERE k < 8),
crc_table AS (SELECT list(v ORDER BY i) AS tab FROM bit WHERE k = 8),
kind AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(
               string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
             lambda c, b: xor(c >> 8, tab[xor(c & 255, b) + 1])), 4294967295) % 20 AS k
  FROM conversations, crc_table),
damage AS (
  SELECT conv_id, turn, CASE WHEN k = 4 THEN 'user' ELSE role END AS role,
         CASE k WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(CASE WHEN k = 3 THEN [1, 2] ELSE [1] END) AS copy
  FROM kind WHERE k <> 0),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
         regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*$', 1) AS e FROM damage),
fault AS (
  SELECT *, left(role, 1) AS r, lag(left(role, 1)) OVER (PARTITION BY conv_id ORDER BY i) AS p,
         e = '' AS blank, e <> '' AND again AS dup, e <> '' AND NOT again AND e NOT IN ('.', '!', '?') AS trunc FROM ranked),
counts AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0)::BIGINT AS gaps, count(*) FILTER (blank) AS blank,
         count(*) FILTER (dup) AS duplicate, count(*) FILTER (trunc) AS truncated,
         count(*) FILTER (p IS NOT NULL AND p || r NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM fault GROUP BY conv_id),
parse(conv_id, i, c0, c1, c2, c3) AS (
  SELECT conv_id, 0::BIGINT, {'c': 0, 'a': ''}, {'c': NULL::INTEGER, 'a': NULL::VARCHAR}, {'c': 3, 'a': 'I'}, {'c': 6, 'a': 'II'} FROM counts
  UNION ALL
  SELECT conv_id, i, s[1], s[2], s[3], s[4] FROM (
    SELECT conv_id, i, {closed} AS s FROM (
      SELECT q.conv_id, f.i, {'c': c0.c + 4, 'a': c0.a || 'D'} AS c0,
        list_min(list_filter([{'c': c1.c + 4, 'a': c1.a || 'D'}, {'c': CASE WHEN ok AND r = 's' THEN c0.c + t END, 'a': c0.a || 'K'}], lambda x: x.c IS NOT NULL)) AS c1,
        list_min(list_filter([{'c': c2.c + 4, 'a': c2.a || 'D'}]
          || list_transform([c0, c1, c3], lambda x: {'c': CASE WHEN ok THEN x.c + t + w END, 'a': x.a || CASE WHEN r = 'u' THEN 'K' ELSE 'R' END}), lambda x: x.c IS NOT NULL)) AS c2,
        list_min(list_filter([{'c': c3.c + 4, 'a': c3.a || 'D'}, {'c': CASE WHEN ok THEN c2.c + t + v END, 'a': c2.a || CASE WHEN r = 'a' THEN 'K' ELSE 'R' END}], lambda x: x.c IS NOT NULL)) AS c3
      FROM parse q JOIN (SELECT conv_id, i, r, NOT blank AND NOT dup AS ok, CASE WHEN trunc THEN 3 ELSE 0 END AS t,
                                CASE WHEN r = 'u' THEN 0 ELSE 3 END AS w, CASE WHEN r = 'a' THEN 0 ELSE 3 END AS v FROM fault) f
        ON f.conv_id IS NOT DISTINCT FROM q.conv_id AND f.i = q.i + 1))),
ended AS (
  SELECT q.conv_id, list_min([c0, c3]) AS b FROM parse q JOIN counts c ON c.conv_id IS NOT DISTINCT FROM q.conv_id AND c.n = q.i),
letter AS (SELECT conv_id, unnest(range(1, len(b.a) + 1)) AS k, unnest(string_split(b.a, '')) AS l FROM ended WHERE b.a <> ''),
edit AS (SELECT *, count(*) FILTER (l <> 'I') OVER (PARTITION BY conv_id ORDER BY k) AS i, count(*) FILTER (l <> 'D') OVER (PARTITION BY conv_id ORDER BY k) AS o FROM letter),
put AS (
  SELECT e.conv_id, e.k, e.o, e.l, f.role, f.text, max(CASE WHEN e.l = 'K' AND f.r = 's' THEN 1 ELSE 0 END) OVER (PARTITION BY e.conv_id) AS s
  FROM edit e LEFT JOIN fault f ON e.l <> 'I' AND f.conv_id IS NOT DISTINCT FROM e.conv_id AND f.i = e.i WHERE e.l <> 'D'),
repaired AS (
  SELECT conv_id, sha256(string_agg(CASE WHEN l = 'K' THEN role WHEN (o - s) % 2 = 1 THEN 'user' ELSE 'assistant' END || ':'
                                    || CASE WHEN l = 'I' THEN '' ELSE text END, chr(10) ORDER BY k)) AS h FROM put GROUP BY conv_id)
SELECT d.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(b.c, 0)::BIGINT AS cost, coalesce(b.a, '') AS audit,
       coalesce(h, sha256('')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) d LEFT JOIN counts c ON c.conv_id IS NOT DISTINCT FROM d.conv_id
LEFT JOIN ended e ON e.conv_id IS NOT DISTINCT FROM d.conv_id LEFT JOIN repaired h ON h.conv_id IS NOT DISTINCT FROM d.conv_id
""".replace("{closed}", _STATES)

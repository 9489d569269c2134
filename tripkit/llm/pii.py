"""Personal data by bootstrapped contextual extraction.

Fixed expressions find e-mail and IP addresses, card and phone numbers; these are the seeds. Around each seed, and around each other string
with digits, lie lexical patterns: the word before it, the word after it, and what is glued to its front. Patterns and the strings in
their slots are a graph that Spark scores in rounds: a pattern is as good as the strings known in its slot, a string as good as its
known patterns. Long strings of letters and digits that a word and "=" or ":" announce are seeds too (keys, tokens); strings that fail
an expression's test count as bad, those too short to identify anything as neither. Patterns of high confidence then discover
the identifiers that no expression knows (kind ``id``), in one string or in groups parted by single spaces.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import materialize
from .common import apart, join_groups, slices, strings, table, together, unpacked, whole, with_fields

KINDS = ("email", "ip", "card", "phone", "id")
ROUNDS = 3
CONFIDENT = 0.8
# A pattern's confidence counts as if one more bad string had been seen in its slot, and takes two known ones at least.
PRIOR, LEAST_KNOWN = 1.0, 2
# What a string without an expression of its own needs, to be an identifier
LEAST_CHARS, LEAST_DIGITS = 6, 3
OUTPUT = ("n_email", "n_ip", "n_card", "n_phone", "base_sha256", "base", "spans")

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGITS = re.compile(r"[0-9]+")
# a string with a digit, from one blank to the next; each place is tried once
TOKEN = re.compile(r"(?<![^\x20\x09-\x0D])[^\x20\x09-\x0D0-9]*+[0-9][^\x20\x09-\x0D]*+")
GLUED = re.compile(r".*[=:\"'(\[<#]")
# an identifier's next group, as in IBANs and national phone numbers
GROUP = re.compile(r"\x20([A-Z0-9]{2,6})(?=[\x20.,;:!?\"')\]>]|\Z)")
GROUPED = re.compile(r"[A-Z0-9]{2,6}")
# a key or token: long, letters and digits, announced by a word and = or :
SECRET = re.compile(r"[A-Za-z0-9_+/-]{20,}=*")
KEYED = re.compile(r"[A-Za-z][\x20\"']{0,3}[=:][\x20\"']{0,3}\Z")
LETTERS_BEFORE = re.compile(r"(?<![^\W\d_])[^\W\d_]{1,40}+[^\w\s]{0,8}\Z")
# Words of a pattern lie within so many characters of their string; one that does not do so whole is none.
CONTEXT = 400
EDGES = ".,;:!?\"')]>"


def _luhn(digits: str) -> bool:
    twice = [int(d) * 2 for d in digits[-2::-2]]
    return (sum(map(int, digits[-1::-2])) + sum(d - 9 if d > 9 else d for d in twice)) % 10 == 0


def base_spans(text: str) -> tuple[list[tuple[int, int, int]], list[tuple[int, int]]]:
    """((start, kind, end) in order, (start, end) of matches that fail their test): leftmost, non-overlapping within a kind."""
    found, failed, end, at = [], [], 0, text.find("@")
    while at >= 0:
        start = at
        while start > end and text[start - 1] in LOCAL:
            start -= 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            found.append((start, 0, m.end()))
            end = m.end()
        at = text.find("@", max(at + 1, end))
    if DIGITS.search(text):
        for m in IP.finditer(text):
            if all(len(p.lstrip("0")) <= 3 and int(p) <= 255 for p in m[0].split(".")):
                found.append((m.start(), 1, m.end()))
            else:
                failed.append(m.span())
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and _luhn(digits):
                found.append((m.start(), 2, m.end()))
            elif len(digits) >= 12:
                failed.append(m.span())
        if "+" in text:
            for m in PHONE.finditer(text):
                if 9 <= sum(map(len, DIGITS.findall(m[0]))) <= 15:
                    found.append((m.start(), 3, m.end()))
                else:
                    failed.append(m.span())
    return sorted(found), failed


def _united(spans) -> list[tuple[int, int]]:
    """(start, end) spans in order, those that overlap made one."""
    out = []
    for start, end in sorted(spans):
        if out and start < out[-1][1]:
            out[-1] = (out[-1][0], max(end, out[-1][1]))
        else:
            out.append((start, end))
    return out


def _strings(text: str, taken) -> list[tuple[int, int]]:
    """(start, end) of every string with a digit outside the spans ``taken`` (in order, apart), in one walk over the text."""
    out, k, after = [], 0, 0
    for m in TOKEN.finditer(text):
        at, stop = max(m.start(), after), m.end()
        while k < len(taken) and taken[k][1] <= at:
            k += 1
        j = k
        while at < stop:  # what spans leave of the string
            cut = taken[j] if j < len(taken) and taken[j][0] < stop else (stop, stop)
            if cut[0] > at and (first := DIGITS.search(text, at, cut[0])):
                begin, end = at, cut[0]
                while end > first.start() and text[end - 1] in EDGES:
                    end -= 1
                if glued := GLUED.match(text, begin, first.start()):
                    begin = glued.end()
                if end == stop and GROUPED.fullmatch(text, begin, end):
                    limit = taken[j][0] if j < len(taken) else len(text)
                    last = end
                    while (g := GROUP.match(text, end)) and g.end() <= limit:
                        end = g.end()
                        last = end if DIGITS.search(g[1]) else last
                    end = last
                out.append((begin, end))
                after = max(after, end)
            at, j = cut[1], j + 1
    return out


def _slots(text: str, spans, failed) -> list[tuple[int, int, float | None, bool, list[str]]]:
    """(start, end, 1.0 for a seed, 0.0 for a bad string or None, whether it may be discovered, patterns) of every seed and other
    string with digits."""
    out = [(s, e, 1.0, False) for s, _, e in spans]
    bad, k = _united(failed), 0
    for start, end in _strings(text, _united((s, e) for s, _, e in spans)):
        while k < len(bad) and bad[k][1] <= start:
            k += 1
        wrong = k < len(bad) and bad[k][0] < end
        core = text[start:end]
        if wrong:
            out.append((start, end, 0.0, False))
        elif len(core) >= LEAST_CHARS and sum(c.isdigit() for c in core) >= LEAST_DIGITS:
            secret = SECRET.fullmatch(core) and any(map(str.isalpha, core)) and KEYED.search(text[max(0, start - 10):start])
            out.append((start, end, 1.0 if secret else None, True))
    return [(s, e, label, may, _patterns(text, s, e)) for s, e, label, may in out]


def _patterns(text: str, start: int, end: int) -> list[str]:
    """Lower-cased lexical patterns around a string: the word before it, the word after it, what is glued to its front. Words
    are whole ones; what is glued and has no letter is none, nor is a pattern with a digit (another identifier beside it)."""
    from_ = max(0, start - CONTEXT)
    left = text[from_:start]
    words = left.split()
    out = []
    if left and not left[-1].isspace() and words:
        if glued := LETTERS_BEFORE.search(words.pop()):  # the letters nearest to it and the marks between
            out.append("glued " + glued[0].lower())
    if from_ and words and not text[from_ - 1].isspace() and not left[0].isspace():
        words.pop(0)  # cut in two
    before = []
    while words and len(before) < 3:
        before.insert(0, words.pop())
        if any(c.isalpha() for c in before[0]):
            break
    if any(c.isalpha() for w in before for c in w):
        out.append("after " + " ".join(before).lower())
    beyond = text[end:end + CONTEXT]
    right = beyond.lstrip(EDGES).split()
    if right and (len(right) > 1 or beyond[-1].isspace() or end + CONTEXT >= len(text)) and any(map(str.isalpha, right[0])):
        out.append("before " + right[0].lower())
    return [p for p in out if not DIGITS.search(p)]


def _extract(docs: DataFrame, text_col: str) -> DataFrame:
    def body(batches):
        import pyarrow as pa

        span = pa.struct([("start", pa.int64()), ("kind", pa.int32()), ("end", pa.int64())])
        slot = pa.struct([("start", pa.int64()), ("end", pa.int64()), ("value", pa.string()), ("label", pa.float64()), ("open", pa.bool_()), ("patterns", pa.list_(pa.string()))])
        for batch in slices(batches, text_col):
            spans, slots = [], []
            for text in strings(batch, text_col):
                text = text or ""
                found, failed = base_spans(text)
                spans.append([{"start": s, "kind": k, "end": e} for s, k, e in found])
                slots.append([{"start": s, "end": e, "value": text[s:e], "label": v, "open": o, "patterns": p} for s, e, v, o, p in _slots(text, found, failed)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(spans, pa.list_(span)), pa.array(slots, pa.list_(slot))], [*batch.schema.names, "base", "_slots"])

    fields = (("base", "array<struct<start:bigint,kind:int,end:bigint>>"),
              ("_slots", "array<struct<start:bigint,end:bigint,value:string,label:double,open:boolean,patterns:array<string>>>"))
    return docs.mapInArrow(body, with_fields(docs.schema, *fields))


def score_patterns(edges: DataFrame, rounds: int = ROUNDS) -> DataFrame:
    """(pattern, confidence, known) from ``edges`` (pattern, value, label): a value's label is 1, 0 or null where not known.

    A pattern's confidence is the mean score of the distinct known values in its slot, with PRIOR. A value keeps its label; one
    without has the mean confidence of its patterns, once any has one.
    """
    edges = materialize(edges.groupBy("pattern", "value").agg(F.max("label").alias("label")), "pii_edges")
    total, scored = edges.count(), edges.withColumn("score", F.col("label"))
    confident = None
    for _ in range(rounds):
        confident = scored.groupBy("pattern").agg((F.sum("score") / (F.count("score") + PRIOR)).alias("confidence"), F.count("score").alias("known"), F.count("*").alias("size"))
        confident = materialize(confident, "pii_patterns")
        told = join_groups(edges, confident.filter(F.col("known") >= LEAST_KNOWN).select("pattern", "confidence", "size"), "pattern", "size", total)
        values = told.groupBy("value").agg(F.avg("confidence").alias("guess"), F.count("*").alias("size"))
        scored = join_groups(edges, values, "value", "size", total).withColumn("score", F.coalesce("label", "guess")).select(*edges.columns, "score")
    return confident.select("pattern", "confidence", "known")


def find(docs: DataFrame, text_col: str = "text", keep_text: bool = True, confident: float = CONFIDENT) -> DataFrame:
    """``docs`` with ``base`` and ``spans`` (start, kind as a place in KINDS, end; code points, end exclusive), in order.

    A null text is empty and has none. Columns of ``docs`` with the names of the result are replaced; repeated rows are searched alike; an
    empty table gives an empty result. ``keep_text=False`` leaves the text out of the written table and of the result.
    """
    without = OUTPUT if keep_text else (*OUTPUT, text_col)
    packed = whole(docs, F.col(text_col).alias("text"))
    kept = [c for c in unpacked(docs, (*without, text_col))]
    packed = packed.withColumn("whole", F.struct(F.lit(0).alias(text_col), *kept)).withColumn("_row", F.monotonically_increasing_id())
    rows = _extract(packed, "text")
    rows = materialize(rows if keep_text else rows.drop("text"), "pii_slots")
    slots = rows.select("_row", F.explode("_slots").alias("s")).select("_row", "s.*")
    patterns = score_patterns(slots.select(F.explode("patterns").alias("pattern"), "value", "label"))
    open_slots = slots.filter("open").select("_row", "start", "end", F.explode("patterns").alias("pattern"))
    sure = patterns.filter((F.col("confidence") >= confident) & (F.col("known") >= LEAST_KNOWN)).join(open_slots.groupBy("pattern").count(), "pattern")
    found = join_groups(open_slots, sure.select("pattern", "confidence", "count"), "pattern", "count", open_slots.count()) \
        .filter("confidence is not null").select("_row", "start", "end").distinct() \
        .groupBy("_row").agg(F.collect_list(F.struct("start", F.lit(len(KINDS) - 1).alias("kind"), "end")).alias("_found"))
    found = rows.drop("_slots").join(found, "_row", "left")
    spans = F.array_sort(F.concat("base", F.coalesce("_found", F.array().cast(rows.schema["base"].dataType))))
    return found.select(*unpacked(docs, without, **{text_col: F.col("text")}), "base", spans.alias("spans"))


def mask(docs: DataFrame, text_col: str = "text", spans_col: str = "spans") -> DataFrame:
    """``docs`` with each span of the text replaced by its kind in capitals and angle brackets; of overlapping spans the first names
    the whole. A null text stays null."""
    def body(batches):
        import pyarrow as pa

        for batch in slices(batches, text_col):
            at, out = batch.schema.get_field_index(text_col), []
            for text, spans in zip(strings(batch, text_col), strings(batch, spans_col)):
                parts, end = [], 0
                for span in spans or ():
                    if span["start"] >= end:
                        parts += [text[end:span["start"]], f"<{KINDS[span['kind']].upper()}>"]
                    end = max(end, span["end"])
                out.append(text if not parts else "".join(parts) + text[end:])
            yield batch.set_column(at, batch.schema.field(at), pa.array(out, batch.schema.field(at).type))

    return docs.mapInArrow(body, docs.schema)


def digest(spans: str):
    """The spans as kind:start:end, comma-joined."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find(table(spark, sf_dir, "documents").select("doc_id", "text"), keep_text=False)

    def count(kind):
        return F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{KINDS[kind]}")

    counts = [count(k) for k in range(4)]
    return found.select("doc_id", *counts, F.sha2(digest("base"), 256).alias("base_sha256"), digest("spans").alias("spans"))


def stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: personal data in the texts is masked, and n_chars, where there is one, counted anew. All other columns come
    back as they were; null and empty texts stay, and an empty table gives an empty one."""
    masked, anew = mask(find(apart(docs, "text"))), {}
    if "n_chars" in docs.columns:
        anew["n_chars"] = F.length("text").cast(docs.schema["n_chars"].dataType)
    return masked.select(*together(docs, "text", **anew))

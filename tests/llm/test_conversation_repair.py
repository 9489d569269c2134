"""Conversation repair against an exhaustive search by cost, and the long way against the short one."""

import hashlib
import heapq
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tripkit.llm import conversation_repair as R

KINDS = "conv_id bigint, turn bigint, role string, text string"
COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def cheapest(rows):
    """(cost, audit) by Dijkstra over (rows done, roles put out so far: none, s, u, a)."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, audit, k, last = heapq.heappop(heap)
        if k == len(rows) and last in ("", "a"):
            return cost, audit
        if (k, last) in done:
            continue
        done.add((k, last))
        follow = "a" if last == "u" else "u"
        heapq.heappush(heap, (cost + 3, audit + "I", k, follow))
        if k < len(rows):
            initial, fault = rows[k]
            heapq.heappush(heap, (cost + 4, audit + "D", k + 1, last))
            if fault != "x":
                more = 3 if fault == "t" else 0
                if initial == follow or (initial == "s" and last == ""):
                    heapq.heappush(heap, (cost + more, audit + "K", k + 1, initial))
                heapq.heappush(heap, (cost + more + 3, audit + "R", k + 1, follow))


def test_chart_equals_search():
    kinds = [a + b for a in "uas-" for b in ".tx"]
    for n in range(4):
        for rows in itertools.product(kinds, repeat=n):
            assert R.best(R.parse("".join(rows))) == cheapest(rows)
    r = random.Random(5)
    for n in (5, 8, 16, 17, 40, 100):
        for _ in range(20):
            weights = [r.random() ** 3 for _ in kinds]
            rows = r.choices(kinds, weights, k=n)
            assert R.best(R.parse("".join(rows))) == cheapest(rows)


def test_one_split_derives_what_all_do(monkeypatch):
    r = random.Random(6)
    for _ in range(10):
        rows = "".join(r.choice("uas-") + r.choice("..tx") for _ in range(24))
        whole = R.chart.__wrapped__(rows)  # every span and split of 24 rows
        monkeypatch.setattr(R, "CHART", 3)
        assert R.parse(rows) == whole
        monkeypatch.undo()


def conversations():
    r = random.Random(3)
    out = [(None, 0, "user", "No number?"), (None, None, "assistant", "None."), (1, None, None, None), (1, 1, "user", " \t "), (2, 0, "", "Empty role."), (3, 0, "User", "X."),
           (4, 5, "user", "Twice."), (4, 5, "user", "Twice."), (4, 5, "assistant", "Same turn."), (4, 9, "user", "Twice."), (5, 0, "tool", "t"), (6, -3, "system", "End! \x0b\x0c")]
    for c in range(10, 70):
        for t in range(r.choice([1, 2, 4, 7, 30])):
            role = "system" if t == 0 and c % 3 == 0 else ("user", "assistant")[(t + c % 3) % 2] if r.random() < 0.9 else r.choice(["user", "system", "tool", "assistant"])
            out.append((c, t, role, r.choice(["", " ", "ok", "Done.", f"Text {t % 9}.", f"Say {t}?\n", f"cut {t}", "ünd \x85"])))
    return out


def brute(rows):
    out = []
    for conv in {r[0] for r in rows}:
        after = []
        for _, turn, role, text in (r for r in rows if r[0] == conv):
            key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
            kind, role, text = zlib.crc32(key.encode()) % 20, " " if role is None else role, " " if text is None else text
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            after += [(turn, "user" if kind == 4 else role, text)] * (0 if kind == 0 else 2 if kind == 3 else 1)
        after.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        marks, seen, n = [], set(), {"x": 0, "d": 0, "t": 0}
        for turn, role, text in after:
            last = re.findall(r"[^\x20\x09-\x0D]", text)
            fault = "x" if not last else "d" if (role, text) in seen else "t" if last[-1] not in ".!?" else "."
            seen.add((role, text))
            n[fault] = n.get(fault, 0) + 1
            marks.append((role[:1] if role[:1] in ("u", "a", "s") else "-", "x" if fault == "d" else fault))
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(after, after[1:]))
        turns = {r[0] for r in after if r[0] is not None}
        cost, audit = cheapest(marks)
        lines, k, last = [], 0, ""
        for e in audit:
            if e == "K":
                lines.append(f"{after[k][1]}:{after[k][2]}")
                last = marks[k][0]
            elif e in "RI":
                last = "a" if last == "u" else "u"
                lines.append({"a": "assistant:", "u": "user:"}[last] + (after[k][2] if e == "R" else ""))
            k += e != "I"
        assert re.fullmatch("(s?(ua)+)?", "".join(x[0] for x in lines))
        out.append((conv, max(turns) - min(turns) + 1 - len(turns) if turns else 0, n["x"], n["d"], n["t"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(str, out))


@pytest.mark.parametrize("long_rows, chunk, fan", [(4096, 4096, 32), (3, 4, 2), (0, 3, 3)])  # all short; some long; all long
def test_repair_equals_search(spark, tmp_path, monkeypatch, long_rows, chunk, fan):
    for name, value in (("LONG_ROWS", long_rows), ("CHUNK", chunk), ("FAN", fan)):
        monkeypatch.setattr(R, name, value)
    rows = conversations()
    more = {c: F.lit("x") for c in ("conv", "mark", "idx", "size", "part", "same", "cost", "gaps", "copy")}
    spark.createDataFrame(rows, KINDS).withColumns(more).repartition(3).write.parquet(f"{tmp_path}/conversations.parquet")
    got = R.op12_conversation_repair(spark, str(tmp_path))
    assert got.columns == COLUMNS
    assert sorted(str(tuple(r)) for r in got.collect()) == brute(rows)


def test_repaired_rows_are_legal_and_alike_both_ways(spark, monkeypatch):
    convs = R.damaged(spark.createDataFrame(conversations(), KINDS))
    short = sorted(map(str, R.repaired_rows(convs).collect()))
    monkeypatch.setattr(R, "LONG_ROWS", 2)
    monkeypatch.setattr(R, "CHUNK", 5)
    assert sorted(map(str, R.repaired_rows(convs).collect())) == short and len(short) > 100


def test_empty_table(spark):
    empty = spark.createDataFrame([], KINDS)
    assert R.repair(R.damaged(empty)).count() == 0 and R.repaired_rows(empty).count() == 0

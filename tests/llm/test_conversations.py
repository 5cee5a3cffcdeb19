"""Operator 13 against an exhaustive search and a plain run over the whole table."""

import contextlib
import hashlib
import io
import random
import re
import zlib

import pytest

from poolbook.llm import conversations as C
from poolbook.llm import queries

SF = "/root/testdata/sf0.001"
VALID, PREFIX = re.compile(r"(s?(ua)+)?"), re.compile(r"s?(ua)*u?")


def exhaustive(rows):
    """Least (cost, audit) over all edit strings of a few rows."""
    best = None

    def go(i, out, audit, cost):
        nonlocal best
        if best is not None and cost > best[0]:
            return
        if i == len(rows) and VALID.fullmatch(out):
            best = min(best, (cost, audit)) if best else (cost, audit)
        if len(out) < len(rows) + 3:
            for c in "ua":
                if PREFIX.fullmatch(out + c):
                    go(i, out + c, audit + "I", cost + 5)
        if i < len(rows):
            initial, kind = rows[i]
            go(i + 1, out, audit + "D", cost + 2)
            if kind != C.MUST_GO:
                extra = 5 * (kind == C.CUT)
                if initial in ("s", "u", "a") and PREFIX.fullmatch(out + initial):
                    go(i + 1, out + initial, audit + "K", cost + extra)
                for c in "ua":
                    if PREFIX.fullmatch(out + c):
                        go(i + 1, out + c, audit + "R", cost + extra + 1)

    go(0, "", "", 0)
    return best


def plain(rows):
    """Least (cost, audit) by a table of whole strings per output state."""
    best = {C.NOTHING: (0, "")}
    for initial, kind in rows:
        new = {}
        for state, (cost, audit) in best.items():
            for n in range(4):
                at = state
                for _ in range(n):
                    at = C.ASSISTANT if at == C.USER else C.USER
                turn = C.ASSISTANT if at == C.USER else C.USER
                ways = [(2, "D", at)]
                if kind != C.MUST_GO:
                    extra = 5 * (kind == C.CUT)
                    ways.append((1 + extra, "R", turn))
                    if initial == "s" and at == C.NOTHING:
                        ways.append((extra, "K", C.SYSTEM))
                    if initial == ("a" if at == C.USER else "u"):
                        ways.append((extra, "K", turn))
                for price, edit, then in ways:
                    way = (cost + 5 * n + price, audit + "I" * n + edit)
                    new[then] = min(new.get(then, way), way)
        best = new
    ends = []
    for state, (cost, audit) in best.items():
        ends += [(cost, audit)] if state in (C.NOTHING, C.ASSISTANT) else []
        ends += [(cost + 5, audit + "I")] if state == C.USER else []
        ends += [(cost + 10, audit + "II")]
    return min(ends)


def streamed(rows):
    held = C.Held("1")
    roles = {"s": "system", "u": "user", "a": "assistant", "": "", "t": "tool"}
    for initial, kind in rows:
        held.add((None, roles[initial], "x", "truncated" if kind == C.CUT else "", False), initial, kind)
    return held.least + C.steps().finish(held.column)[0], "".join(e[0] for e in held.edits())


def rows_of(rnd, longest):
    return [(rnd.choice(["s", "u", "a", "u", "a", "", "t"]), rnd.choice([0, 0, 0, 1, 2])) for _ in range(rnd.randrange(longest))]


def test_cheapest_edits_equal_exhaustive_search():
    rnd = random.Random(5)
    for _ in range(400):
        rows = rows_of(rnd, 6)
        assert streamed(rows) == exhaustive(rows) == plain(rows)


@pytest.mark.parametrize("spill", [100_000, 7])
def test_long_conversations_and_spilling(spill, monkeypatch):
    monkeypatch.setattr(C, "SPILL", spill)
    rnd = random.Random(spill)
    for _ in range(60):
        rows = rows_of(rnd, 400)
        assert streamed(rows) == plain(rows)


def test_columns_are_few():
    steps, at = C.Steps(), 0
    while at < len(steps.columns):
        for initial in ("s", "u", "a", ""):
            for kind in (C.GOOD, C.MUST_GO, C.CUT):
                steps.move(at, initial, kind)
        at += 1
    assert len(steps.columns) == 384 and len(steps.back) < 1 << 16


def expected(table):
    """The contract, row by row: {conv_id: values}."""
    text = lambda v: " " if v is None else str(v)
    by_id = {}
    for r in table:
        by_id.setdefault(r["conv_id"], []).append(r)
    out = {}
    for conv, rows in by_id.items():
        after = []
        for r in rows:
            d = zlib.crc32(f"{text(conv)}:{text(r['turn'])}".encode()) % 20
            role, body = text(r["role"]), text(r["text"])
            body = "" if d == 1 else re.sub("[.!?]", "", body) if d == 2 else body
            role = "user" if d == 4 else role
            after += [(r["turn"], role, body)] * {0: 0, 3: 2}.get(d, 1)
        after.sort(key=lambda a: (a[0] is not None, a[0] or 0, a[1], a[2]))
        seen, faults = set(), []
        for _, role, body in after:
            ink = body.strip(" \t\n\x0b\x0c\r")
            faults.append("blank" if not ink else "duplicate" if (role, body) in seen else "" if ink[-1] in ".!?" else "truncated")
            seen.add((role, body))
        kinds = [C.CUT if f == "truncated" else C.MUST_GO if f else C.GOOD for f in faults]
        cost, audit = plain([(role[:1], k) for (_, role, _), k in zip(after, kinds)])
        repaired, i = [], 0
        for edit in audit:
            due = "user" if not repaired or repaired[-1][0][0] in "sa" else "assistant"
            if edit == "I":
                repaired.append((due, ""))
                continue
            if edit != "D":
                repaired.append((after[i][1] if edit == "K" else due, after[i][2]))
            i += 1
        turns = [t for t, _, _ in after if t is not None]
        initials = [role[:1] for _, role, _ in after]
        out[conv] = (
            max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
            *(faults.count(f) for f in ("blank", "duplicate", "truncated")),
            sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit,
            hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


COLUMNS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def run(rows):
    done = C.with_empty(rows, C.digests(C.repair(C.damaged(rows))))
    return {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in done.collect()}


def test_whole_table_against_brute_force(spark):
    rows = spark.read.parquet(f"{SF}/conversations.parquet")
    got = {r["conv_id"]: tuple(r[c] for c in COLUMNS) for r in queries.op13_conversation_repair(spark, SF).collect()}
    assert got == expected(rows.collect())


def test_edges(spark):
    rnd = random.Random(2)
    rows = []
    for conv in [None, *range(60)]:
        for turn in range(rnd.randrange(1, 9)):
            rows.append((conv, rnd.choice([None, turn, turn, turn + 2, 2**60 + turn]), rnd.choice([None, "user", "assistant", "system", "tool", ""]),
                         rnd.choice([None, "", " \n", "Yes.", "No", "A é b?\x0b ", "x. ", "Why!"]), 1))
    table = spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string, fault int")
    assert run(table) == expected(table.collect())
    assert run(table.limit(0)) == {}


def test_one_large_conversation_and_string_ids(spark, monkeypatch):
    rows = [("big", i // 2, "user" if i % 3 else "assistant", f"t{i % 4000}." if i % 5 else "cut") for i in range(25_000)]
    table = spark.createDataFrame(rows + [("small", 0, "user", "Hi.")], "conv_id string, turn bigint, role string, text string")
    assert run(table) == expected(table.collect())


def test_repaired_turns_come_out_and_rows_are_dealt_once(spark):
    rows = spark.createDataFrame([(1, 0, "user", "Hi."), (1, 1, "user", "Hm."), (1, 2, "assistant", "Yes.")], "conv_id bigint, turn bigint, role string, text string")
    edits = C.repair(rows)
    turns = [(r["role"], r["text"]) for r in edits.where("edit <> 'D'").orderBy("step").collect()]
    assert turns == [("user", "Hm."), ("assistant", "Yes.")]
    with contextlib.redirect_stdout(io.StringIO()) as plan:
        C.digests(edits).explain()
    assert plan.getvalue().count("Exchange") == 1

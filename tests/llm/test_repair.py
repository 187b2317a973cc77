from __future__ import annotations

import hashlib
import itertools
import re
import zlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from hazardlens.llm import repair
from hazardlens.llm.common import table
from hazardlens.llm.queries import op11_audit_repair

WORDLESS = re.compile(r"[^\x20\x09-\x0D]")
NAMES = {"u": "user", "a": "assistant"}


def faults(rows):
    """First fault of each (role, text)."""
    seen, out = set(), []
    for role, text in rows:
        said = WORDLESS.findall(text)
        out.append("blank" if not said else "duplicate" if (role, text) in seen else
                   "truncated" if said[-1] not in ".!?" else None)
        seen.add((role, text))
    return out


def plain(rows):
    """Cheapest, then ASCII-least audit, keeping whole strings: cost, audit, repaired rows."""
    accept = re.compile(r"(s?(ua)+)?")
    states = {("", 0): (0, "", [])}      # (last initial, s seen first): cost, audit, turns
    def better(best, key, value):
        if key not in best or value[:2] < best[key][:2]:
            best[key] = value
    def follows(last):
        return "a" if last == "u" else "u"
    def inserted(best):
        for _ in range(4):
            for (last, s), (cost, audit, turns) in list(best.items()):
                role = follows(last)
                better(best, (role, s), (cost + 2, audit + "I", [*turns, (NAMES[role], "")]))
    inserted(states)
    for (role, text), fault in zip(rows, faults(rows)):
        best, cut = {}, int(fault == "truncated")
        for (last, s), (cost, audit, turns) in states.items():
            better(best, (last, s), (cost + 3, audit + "D", turns))
            if fault in ("blank", "duplicate"):
                continue
            fit = follows(last)
            better(best, (fit, s), (cost + 2 + cut, audit + "R", [*turns, (NAMES[fit], text)]))
            if role[:1] == fit or role[:1] == "s" and last == "":
                better(best, (role[:1], s or int(role[:1] == "s")), (cost + cut, audit + "K", [*turns, (role, text)]))
        inserted(best)
        states = best
    ends = [v for v in states.values() if accept.fullmatch("".join(r[:1] for r, _ in v[2]))]
    return min(ends, key=lambda v: v[:2])


def exhaustive(rows):
    """All audits with at most two insertions at a place."""
    accept, found = re.compile(r"(s?(ua)+)?"), []
    kinds, n = faults(rows), len(rows)
    for edits in itertools.product("DKR", repeat=n):
        if any(k in ("blank", "duplicate") and e != "D" for k, e in zip(kinds, edits)):
            continue
        for gaps in itertools.product(range(3), repeat=n + 1):
            audit = "".join("I" * g + e for g, e in zip(gaps, edits)) + "I" * gaps[-1]
            cost = sum({"D": 3, "I": 2, "K": 0, "R": 2}[e] for e in audit) + sum(
                k == "truncated" and e != "D" for k, e in zip(kinds, edits))
            shape = "".join("?" * g + ((r[:1] or "#") if e == "K" else "?" if e == "R" else "")
                            for g, e, (r, _) in zip(gaps, edits, rows)) + "?" * gaps[-1]
            want = ("s" if len(shape) % 2 else "") + "ua" * (len(shape) // 2)
            if accept.fullmatch(want) and all(a == b or a == "?" and b != "s" for a, b in zip(shape, want)):
                found.append((cost, audit))
    return min(found)


def audited(rows, window):
    audit, edits = repair.Audit(window), []
    for (role, text), fault in zip(rows, faults(rows)):
        edits += audit.add(role, text, fault)
    edits += audit.end()
    return audit.cost, "".join(e.letter for e in edits), [(e.role, e.text) for e in edits if e.letter != "D"]


turns = st.tuples(st.sampled_from(["system", "user", "assistant", "", "User", "u", " "]),
                  st.sampled_from(["a.", "b.", "c", "d!", " ", "", "e? ", "f.\n", "g"]))


@settings(max_examples=60, deadline=None)
@given(st.lists(turns, max_size=4))
def test_against_all_audits(rows):
    assert exhaustive(rows) == plain(rows)[:2] == audited(rows, 4096)[:2]


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant"]), st.text("xyz.!", min_size=1, max_size=3)), max_size=60),
       st.sampled_from([1, 8, 4096]))
def test_long_conversations_and_small_windows(rows, window):
    assert audited(rows, window) == plain(rows)


@settings(max_examples=30, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant"]), st.integers(0, 10**6)), max_size=40))
def test_colliding_hashes(rows):
    rows = [(role, f"{n}.") for role, n in rows]
    modulus, repair._MODULUS = repair._MODULUS, 2
    try:
        assert audited(rows, 4096) == plain(rows)
    finally:
        repair._MODULUS = modulus


def test_open_end_stays_small():
    audit, edits = repair.Audit(256), 0
    for i in range(20_000):
        edits += len(list(audit.add("user" if i % 3 else "assistant", f"{i}.", None)))
    assert edits > 19_000 and len(audit.rows) < 300 and len(audit.prefixes) < 2000
    list(audit.end())


def damaged(rows):
    """The contract's faults on (conv, turn, role, text)."""
    out, convs = [], {}
    for conv, turn, role, text in rows:
        convs[conv] = True
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out, list(convs)


def expected(rows):
    kept, convs = damaged(rows)
    by = defaultdict(list)
    for conv, *row in kept:
        by[conv].append(row)
    out = {}
    for conv in convs:
        own = sorted(by[conv], key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        known = [t for t, *_ in own if t is not None]
        said = [(r, t) for _, r, t in own]
        kinds = faults(said)
        cost, audit, repaired = plain(said)
        out[conv] = (max(known) - min(known) + 1 - len(set(known)) if known else 0,
                     *(kinds.count(k) for k in repair.FAULTS),
                     sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in zip(said, said[1:])), cost, audit,
                     hashlib.sha256("\n".join(f"{r}:{t}" for r, t in repaired).encode()).hexdigest())
    return out


def check(df, rows):
    got = df.collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected(rows) and len(got) == len({r[0] for r in rows})


def test_query(spark):
    folder = "/root/testdata/sf0.01"
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    check(op11_audit_repair(spark, folder), rows)


SCHEMA = "conv_id long, turn long, role string, text string, fault int, present string, nth int"


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.one_of(st.none(), st.integers(0, 3)), st.one_of(st.none(), st.integers(0, 9)),
                          st.one_of(st.none(), turns.map(lambda t: t[0])), st.one_of(st.none(), turns.map(lambda t: t[1]))),
                min_size=1, max_size=25))
def test_odd_rows(spark, rows):
    frame = spark.createDataFrame([(*r, 1, "x", 2) for r in rows], SCHEMA)
    check(repair.repair_summary(repair.damaged(frame), present_col="present"), rows)


def test_log_is_the_repaired_conversation(spark):
    rows = [(c, t, r, x, 1, "x", 2) for c in (1, None) for t, r, x in [
        (0, "system", "s."), (1, "assistant", "hi " * 40_000 + "."), (2, "assistant", "so"), (None, "user", "q?"), (3, "user", " ")]]
    frame = spark.createDataFrame(rows, SCHEMA)
    log = repair.repair_log(frame, window=2).collect()
    summary = {r.conv_id: r for r in repair.repair_summary(frame).collect()}
    for conv in (1, None):
        steps = sorted((r.step, r.edit, r.role, r.text) for r in log if r.conv_id == conv)
        assert "".join(s[1] for s in steps) == summary[conv].audit and [s[0] for s in steps] == list(range(len(steps)))
        said = "\n".join(f"{r}:{t}" for _, e, r, t in steps if e != "D")
        assert hashlib.sha256(said.encode()).hexdigest() == summary[conv].repaired_sha256


def test_empty_table_and_one_shuffle(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert repair.repair_summary(empty).count() == 0 and repair.repair_log(empty).count() == 0
    plan = repair.with_faults(table(spark, "/root/testdata/sf0.001", "conversations"))
    text = plan._jdf.queryExecution().executedPlan().toString()
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("audits", [("K", "KK"), ("KD", "KI"), ("DIK", "DK"), ("RRRRRRRRRK", "RRRRRRRRRR"), ("", "D")])
def test_order_of_audits(audits):
    prefixes = repair.Prefixes()
    nodes = []
    for letters in audits:
        node = 0
        for letter in letters:
            node = prefixes.extend(node, letter)
        nodes.append(node)
        assert prefixes.spelled(node) == letters
    assert prefixes.less(*nodes) and not prefixes.less(*reversed(nodes))

from __future__ import annotations

import hashlib
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from hazardlens.llm import chat
from hazardlens.llm.common import table
from hazardlens.llm.queries import op4_chat_format

SCHEMA = "conv_id long, turn long, role string, text string, formatted int, said string, turns int"
pieces = st.sampled_from([*chat.CONTROLS, "<", "[", "\\", "<\\|end|>", "[\\\\INST]", "<|", "|>", "a", "é", "\n", "$1", "", "s>"])
text = st.lists(pieces, max_size=6).map("".join)


def in_order(rows):
    by = defaultdict(list)
    for conv, turn, role, said, *_ in rows:
        by[conv].append((turn is not None, turn or 0, role or "", said or ""))
    return {conv: [(role, said) for _, _, role, said in sorted(turns)] for conv, turns in by.items()}


def back(df):
    return df.select("*", chat.read_turns(F.col("formatted")).alias("read"),
                     chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss")).collect()


def check(spark, rows):
    want = in_order(rows)
    got = back(chat.format_conversations(spark.createDataFrame(rows, SCHEMA)))
    assert {r.conv_id for r in got} == set(want) and len(got) == len(want)
    for r in got:
        turns = want[r.conv_id]
        assert [tuple(t) for t in r.read] == turns
        assert r.loss == "".join(t for role, t in turns if role == "assistant")
        assert len(r.loss_spans) == sum(role == "assistant" for role, _ in turns)
        inside = r.formatted
        for mark in (chat.BEGIN, chat.BODY, chat.NEXT, chat.END):
            inside = inside.replace(mark, "")
        assert not any(c in inside for c in chat.CONTROLS)
        runs = sum(i == 0 or turns[i - 1][0] != role for i, (role, _) in enumerate(turns))
        assert r.formatted.count(chat.BEGIN) == runs and r.formatted.count(chat.NEXT) == len(turns) - runs


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(0, 3), st.one_of(st.none(), st.integers(0, 4)), st.one_of(
    st.none(), st.sampled_from(["user", "assistant", "<|end|>", "a</s>"])), st.one_of(st.none(), text)), min_size=1, max_size=30))
def test_round_trip(spark, rows):
    check(spark, [(*r, 1, "x", 2) for r in rows])


def test_null_conversations_repeats_and_long_texts(spark):
    check(spark, [(None, 1, "user", "a", 1, "x", 2), (None, 1, "user", "a", 1, "x", 2), (None, None, None, None, 1, "x", 2),
                  (7, 0, "assistant", "<s>" * 50_000, 1, "x", 2), (8, 0, "assistant", "", 1, "x", 2)])


def test_long_conversation(spark):
    check(spark, [(1, i, "assistant" if i % 3 else "user", f"turn {i}", 1, "x", 2) for i in range(3000)])


def test_query(spark):
    folder = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in table(spark, folder, "conversations").select("conv_id", "turn", "role", "text").collect()]
    probe = "</s>[INST] ok [/INST]"
    want = in_order([*rows, (-1, 0, "user", probe), (-1, 1, "assistant", probe)])
    for r in op4_chat_format(spark, folder).collect():
        turns = want.pop(r.conv_id)
        said = "".join(f"{role}\n{t}\n" for role, t in turns)
        loss = "".join(t for role, t in turns if role == "assistant")
        assert (r.n_turns, r.turns_sha256) == (len(turns), hashlib.sha256(said.encode()).hexdigest())
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert not want


def test_empty_table(spark):
    assert chat.format_conversations(spark.createDataFrame([], SCHEMA)).count() == 0


@pytest.mark.parametrize("plan", [lambda spark: op4_chat_format(spark, "/root/testdata/sf0.001")])
def test_no_python_in_the_plan(spark, plan):
    text = plan(spark)._jdf.queryExecution().executedPlan().toString()
    assert not any(w in text for w in ("Python", "Pandas", "Arrow"))

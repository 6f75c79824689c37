"""Formatting conversations and reading them back."""

from __future__ import annotations

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from ledgerloom.llm import chat_format as cf

SCHEMA = "conv_id long, turn long, role string, text string, turns string, learnt string"
BITS = ["<|im_start|>", "<|im_end|>", "\n", "<", "[", "\\", "<\\", "|im_sep|>", "</s>", "[/INST]", "[INST]", "<s>", "a", "<|im_next|>", "$1"]


def read_back(spark, rows):
    df = spark.createDataFrame([(*r, "?", "?") for r in rows], SCHEMA).repartition(3)
    found = cf.parse(cf.format_conversations(df)).collect()
    return {r.conv_id: [(t.role, t.text, t.learnt) for t in r.turns] for r in found}, found


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "<|im_sep|>", "\n"]),
                          st.lists(st.sampled_from(BITS), max_size=6).map("".join)), min_size=1, max_size=8))
def test_round_trip(spark, turns):
    got, rows = read_back(spark, [(1, i, r, t) for i, (r, t) in enumerate(turns)])
    assert got == {1: [(r, t, r == "assistant") for r, t in turns]}
    blocks = sum(i == 0 or turns[i - 1][0] != r for i, (r, _) in enumerate(turns))
    assert rows[0].formatted.count(cf.START) == rows[0].formatted.count(cf.END) == blocks


def test_layout(spark):
    _, rows = read_back(spark, [(7, 1, "user", "hi"), (7, 0, "user", "[INST]"), (7, 2, "assistant", "yes")])
    assert rows[0].formatted == (
        "<|im_start|>user<|im_sep|>[\\INST]<|im_next|>hi<|im_end|>\n<|im_start|>assistant<|im_sep|>yes<|im_end|>\n"
    )


def test_nulls_ties_and_repeats(spark):
    rows = [(None, 0, "user", "a"), (None, 0, "user", "a"), (2, None, None, None), (2, 1, "user", None),
            (3, 5, "user", "b"), (3, 5, "assistant", "a"), (3, 5, "assistant", "")]
    got, _ = read_back(spark, rows)
    assert got == {
        None: [("user", "a", False)] * 2,
        2: [("", "", False), ("user", "", False)],
        3: [("assistant", "", True), ("assistant", "a", True), ("user", "b", False)],
    }


def test_empty_and_long(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert cf.parse(cf.format_conversations(empty)).count() == 0
    long = [(1, i, "user" if i % 2 else "assistant", "word <s> " * 50) for i in range(3000)]
    got, _ = read_back(spark, long)
    assert len(got[1]) == 3000 and all(t == "word <s> " * 50 for _, t, _ in got[1])

"""Prefix-target examples: escaping, masks, odd conversations."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from clinlake.llm import chat
from clinlake.llm.queries.chat import LOOKALIKE, digests


@pytest.mark.parametrize("text", ["", LOOKALIKE, "<\\/s>", "<\\\\s>[\\INST]", "<<</s>>", "[[INST]]", "a\\b [/INST", "é\n</s", "<s>" * 2000])
def test_escaping_is_undone_and_hides_control_strings(spark, text):
    frame = spark.createDataFrame([(text,)], "t string").select(chat.escape(F.col("t")).alias("e"))
    row = frame.select("e", chat.unescape(F.col("e")).alias("back")).first()
    assert row.back == text
    assert not re.search(r"</?s>|\[/?INST\]", row.e)


ROWS = [
    (1, 0, "system", "be </s> kind"), (1, 1, "user", "hi"), (1, 2, "assistant", "hello [/INST] é"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (1, 5, "assistant", "again"), (1, 6, "user", "bye"), (2, 0, "user", "no reply"), (3, None, None, None), (None, 0, "assistant", "x"),
    (4, 0, "assistant", "same"), (4, 0, "assistant", "same"), (5, 0, "user", "y" * 200000), (5, 1, "assistant", "z" * 200000),
]


@pytest.fixture(scope="module")
def conversations(spark):
    return spark.createDataFrame([(*r, 1, 2) for r in ROWS], "conv_id long, turn long, role string, text string, turn_no int, piece int")


def test_digests_are_those_of_the_input(conversations):
    found = {r.conv_id: r for r in digests(chat.formatted_turns(conversations)).collect()}
    assert found.keys() == {r[0] for r in ROWS}
    for conv_id, row in found.items():
        turns = sorted((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in ROWS if r[0] == conv_id)
        said = "".join(f"{role}\n{text}\n" for *_, role, text in turns)
        learnt = "".join(text for *_, role, text in turns if role == "assistant")
        assert (row.n_turns, row.loss_chars) == (len(turns), len(learnt))
        assert row.turns_sha256 == hashlib.sha256(said.encode()).hexdigest()
        assert row.loss_sha256 == hashlib.sha256(learnt.encode()).hexdigest()


def test_an_example_is_all_before_it_and_one_reply(conversations):
    turns = chat.formatted_turns(conversations.filter("conv_id = 1"))
    text = "".join(r.piece for r in turns.orderBy("turn_no").collect())
    examples = chat.with_context(chat.prefix_target_examples(turns), turns).orderBy("turn_no").collect()
    assert [(r.turn_no, r.target) for r in examples] == [(2, "hello [\\/INST] é"), (4, ""), (5, "again")]
    for r in examples:
        assert text.startswith(r.context + r.target + chat.TURN_END) and len(r.context) == r.context_chars
        assert r.context.endswith(f"{chat.TURN_OPEN}assistant{chat.TURN_HEAD_END}")


def test_no_rows_and_no_python(conversations):
    assert digests(chat.formatted_turns(conversations.limit(0))).count() == 0
    plan = digests(chat.formatted_turns(conversations))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_turns_carry_the_examples_that_the_query_digests(conversations):
    turns = chat.formatted_turns(conversations)
    columns = ["conv_id", "turn_no", "context_chars", "target", "context"]
    joined = chat.with_context(chat.prefix_target_examples(turns), turns).select(columns).collect()
    found = chat.turns_with_examples(turns)
    assert sorted(map(str, found.filter("context is not null").select(columns).collect())) == sorted(map(str, joined))
    assert len(joined) == sum(r[2] == "assistant" for r in ROWS) and found.count() == len(ROWS)
    plan = digests(turns)._jdf.queryExecution().optimizedPlan().toString()
    assert "substring(_text" in plan and "Generate explode" in plan

import hashlib

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from clipfeat.llm import chat

from ..oracle import rows_of, sql_rows

T = chat.Template()
PIECES = st.lists(st.one_of(st.sampled_from([*T.control, "\\", "<", "[", "/", "\n", " "]), st.text(max_size=4)), max_size=9).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.one_of(st.sampled_from(["system", "user", "assistant", ""]), PIECES), PIECES)
def test_turns_are_read_back(role, text):
    pieces = T.segments(role, text)
    assert T.parse("".join(s for s, _ in pieces)) == (role, text)
    assert not any(c in T.escape(text) for c in T.control)
    assert T.unescape("".join(s for s, loss in pieces if loss)) == (text if role == "assistant" else "")


def test_templates_that_can_not_be_escaped():
    with pytest.raises(ValueError):
        chat.Template(control=("<a", "a<"))
    with pytest.raises(ValueError):
        chat.Template(control=("a\\b",))


SCHEMA = "conv_id long, turn long, role string, text string, seq int, valid string"


def test_machine_and_edge_cases(spark):
    rows = [
        (1, 1, "assistant", "b"), (1, 0, "user", "a"), (2, 0, "assistant", "first"), (2, 1, "assistant", None), (3, 0, "system", ""), (3, 1, "user", "q"), (3, 2, "assistant", "[/INST] x"),
        (4, 0, None, "?"), (4, 1, "tool", "[TEXT]"), (None, 0, "user", "n"), (5, 0, "user", "same"), (5, 0, "user", "same"), (6, 0, "user", "x" * 300_000),
    ]
    df = spark.createDataFrame([(*r, 0, "v") for r in rows], SCHEMA)
    got = {r.conv_id: r for r in chat.read_back(chat.format_conversations(df)).collect()}
    assert {k: r.valid for k, r in got.items()} == {1: True, 2: False, 3: True, 4: False, None: True, 5: False, 6: True}
    for k, r in got.items():
        turns = sorted(((t, role or "", x or "") for c, t, role, x in rows if c == k))
        assert r.n_turns == len(turns) and r.turns_sha256 == hashlib.sha256("".join(f"{a}\n{b}\n" for _, a, b in turns).encode()).hexdigest()
        loss = "".join(x for _, role, x in turns if role == "assistant")
        assert (r.loss_chars, r.loss_sha256) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())
    assert chat.read_back(chat.format_conversations(spark.createDataFrame([], SCHEMA))).count() == 0


def test_op10(spark, sf_dir):
    assert rows_of(chat.op10_chat(spark, sf_dir).toPandas()) == sql_rows(chat.SQL, sf_dir)

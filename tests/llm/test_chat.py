"""Chat layouts, template round trips and edge cases."""

import hashlib
import json

import pytest
from hypothesis import given, settings, strategies as st

from seriesmill.llm import chat

PARTS = st.lists(st.sampled_from(["\\", "#", "###", " ", "</turn>", "</turn", ">", "a", "é", "\n", ": ", ":", "### assistant: ", " </turn>\n", "😀"]), max_size=9).map("".join)


@settings(max_examples=500, deadline=None)
@given(st.lists(st.tuples(PARTS, PARTS), max_size=4))
def test_every_text_is_read_back(turns):
    text, spans = "", []
    for role, said in turns:
        written, begin, end = chat.segment(role, said)
        spans.append((len(text) + begin, len(text) + end))
        text += written
    assert chat.parse(text) == turns
    assert [chat.unescape(text[a:b]) for a, b in spans] == [t for _, t in turns]


@pytest.mark.parametrize("record,layout,turns", [
    ({"messages": [{"role": "user", "content": "q"}, {"role": "assistant", "content": None}], "id": 3}, "messages", [("user", "q"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "r"}, {"from": "x", "value": 1}]}, "conversations", [("user", "q"), ("assistant", "r"), ("x", "1")]),
    ({"prompt": "p", "completion": "c", "meta": {"a": [1]}}, "prompt_completion", [("user", "p"), ("assistant", "c")]),
    ({"system": "s", "prompt": "p", "response": ""}, "prompt_response", [("system", "s"), ("user", "p"), ("assistant", "")]),
    ({"instruction": "a", "input": "", "output": "b"}, "instruction", [("user", "a"), ("assistant", "b")]),
    ({"instruction": "a", "output": "b"}, "instruction", [("user", "a"), ("assistant", "b")]),
    ({"question": "a", "answer": {"deep": 1}}, "unknown", []),
    ({"role": "user", "text": None}, "turn", [("user", "")]),
    ({"messages": []}, "unknown", []), ({}, "unknown", []),
])
def test_layouts(record, layout, turns):
    assert chat.canonical(json.dumps(record))[1:] == (layout, turns)


@pytest.mark.parametrize("record", [None, "", "nope", "[1]", "3", '{"role": '])
def test_malformed(record):
    assert chat.canonical(record) == ("", "malformed", [])


def test_fingerprint_ignores_order_and_unknown_fields():
    a, b = ({"prompt": "x", "completion": "y"}, {"zzz": [{"q": 1}], "completion": "1", "prompt": "2"})
    assert chat.canonical(json.dumps(a))[0] == chat.canonical(json.dumps(b))[0]
    assert len(chat.SELECT) == len({m.name + str(k) for k, m in chat.SELECT.items()})


def digest(turns):
    return hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()


def test_table_of_mixed_layouts(spark):
    long = "word " * 60_000 + "</turn>"
    rows = [(1, 1, json.dumps({"role": "assistant", "text": "b"})), (1, 0, json.dumps({"role": "user", "text": "a"})), (1, 1, json.dumps({"role": "assistant", "text": "b"})),
            (2, 0, json.dumps({"prompt": long, "completion": "\\### x"})), (3, 0, "broken"), (4, 0, None),
            (None, None, json.dumps({"role": None, "text": None})), (5, 0, json.dumps({"messages": [{"role": "user", "content": "1"}, {"role": "assistant", "content": "2"}]}))]
    df = spark.createDataFrame(rows, "id bigint, pos bigint, raw string").selectExpr("*", "'x' as text", "1 as conv_id", "2 as role")
    turns = chat.turns(df, "id", "pos", "raw")
    assert sorted(r["layout"] for r in turns.where("role is null").collect()) == ["malformed", "malformed"]
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(turns)).collect()}
    want = {1: [("user", "a"), ("assistant", "b"), ("assistant", "b")], 2: [("user", long), ("assistant", "\\### x")], None: [("", "")], 5: [("user", "1"), ("assistant", "2")]}
    assert set(got) == set(want)
    for k, t in want.items():
        masked = "".join(x for r, x in t if r == "assistant")
        assert (got[k]["n_turns"], got[k]["turns_sha256"], got[k]["loss_chars"]) == (len(t), digest(t), len(masked))
        assert got[k]["loss_sha256"] == hashlib.sha256(masked.encode()).hexdigest()
    assert chat.digests(chat.formatted(chat.turns(df.where("false"), "id", "pos", "raw"))).count() == 0


def test_records_that_no_reader_expects(spark):
    """Deep nesting and halves of surrogate pairs end as rows, not as errors."""
    deep = '{"role": "user", "text": ' + "[" * 90 + "1" + "]" * 90 + "}"
    rows = [(1, 0, "[" * 100_000), (2, 0, '{"a": ' * 3000 + "1" + "}" * 3000), (3, 0, '{"role": "user", "text": "a\\ud800b"}'),
            (4, 0, '{"role": "us\\udfffer", "text": "x"}'), (5, 0, deep), (6, 0, '{"role": "user", "text": "\\ud83d\\ude00"}'),
            (7, 0, "{" + '"k": [' * 500 + "]" * 500 + "}")]
    records = spark.createDataFrame(rows, "conv_id bigint, turn bigint, record string")
    got = {r["conv_id"]: r for r in chat.digests(chat.formatted(chat.turns(records, "conv_id", "turn", "record"))).collect()}
    turns = {r["conv_id"]: r for r in chat.turns(records, "conv_id", "turn", "record").collect()}
    assert {i: chat.canonical(t)[1] for i, _, t in rows} == {1: "malformed", 2: "malformed", 3: "turn", 4: "turn", 5: "unknown", 6: "turn", 7: "malformed"}
    assert turns and set(got) <= set(range(1, 8))
    assert chat.canonical(rows[2][2])[2] == [("user", "a�b")] and chat.canonical(rows[3][2])[2] == [("us�er", "x")]
    assert chat.canonical(rows[5][2])[2] == [("user", "\U0001f600")]

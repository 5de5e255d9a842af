"""Chat layouts, the template and its escapes, and conversations read back."""

import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sieveline.llm import chat_format as C

TURNS = [("user", "hi"), ("assistant", "yo")]

RECORDS = {
    "messages": {"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
    "conversations_from": {"conversations": [{"from": "human", "value": "hi"}, {"from": "gpt", "value": "yo"}], "id": 3},
    "author_parts": {"messages": [
        {"author": {"role": "user"}, "content": {"text": "hi"}}, {"author": {"role": "assistant"}, "content": {"text": "yo"}}]},
    "nested_messages": {"data": {"messages": [{"role": "user", "content": "hi"}, {"role": "bot", "content": "yo"}]}},
    "dialog_strings": {"dialog": ["hi", "yo"]},
    "instruction": {"instruction": "hi", "input": "", "output": "yo"},
    "prompt_messages": {"prompt": [{"role": "user", "content": "hi"}], "completion": "yo"},
    "prompt_completion": {"prompt": "hi", "completion": "yo"},
    "question_answer": {"question": "hi", "answer": "yo", "source": {"name": "x"}},
    "inputs_targets": {"inputs": "hi", "targets": "yo"},
}


@pytest.mark.parametrize("name", RECORDS)
def test_layouts(name):
    layout = C.choose(C.field_paths(RECORDS[name]))
    assert layout.name == name and C.apply_layout(RECORDS[name], layout) == TURNS


def test_every_layout_can_be_chosen():
    for layout in C.LAYOUTS:
        assert C.choose(layout.needs).needs <= layout.needs
        assert any(C.choose(layout.needs | {p}) is not None for p in ("", "x"))


def test_system_and_further_fields():
    record = {"system": "be kind", "instruction": "sum", "input": "1 2", "output": "3"}
    assert C.apply_layout(record, C.choose(C.field_paths(record))) == [
        ("system", "be kind"), ("user", "sum\n\n1 2"), ("assistant", "3")]


def test_fingerprint_is_of_paths_only():
    a = C.fingerprint(C.field_paths({"m": [{"x": 1}, {"y": None}], "n": []}))
    assert a == C.fingerprint(C.field_paths({"n": [], "m": [{"y": "q", "x": "z"}]}))
    assert a != C.fingerprint(C.field_paths({"n": [], "m": [{"y": "q"}]}))


def test_records_without_turns(spark):
    rows = [(1, None), (2, "not json"), (3, "[1]"), (4, '{"other": 1}'), (5, '{"messages": []}'), (None, '{"prompt": "a", "response": null}')]
    made = C.canonical_turns(spark.createDataFrame(rows, "conv long, record string"), ["conv"], "record").collect()
    assert {r.conv: (r.layout, r.part) for r in made if r.conv} == {i: (None, None) for i in range(1, 6)}
    assert [(r.part, r.role, r.text) for r in made if r.conv is None] == [(0, "user", "a"), (1, "assistant", "")]


AWKWARD = {
    "half pair": ({"prompt": "\ud800x", "completion": "\ud83d\ude00"}, "prompt_completion", [("user", "\ufffdx"), ("assistant", "\U0001f600")]),
    "mixed": ({"messages": [{"role": "user", "content": "hi"}, "bare", {"from": "human", "value": "kept"}]}, "messages_mixed",
              [("user", "hi"), ("assistant", "bare"), ("user", "kept")]),
    "unknown element": ({"messages": [{"role": "user", "content": "hi"}, {"tool": 1}]}, None, []),
    "dots": ({"messages": [{"author.role": "user", "content.text": "hi"}]}, None, []),
    "parts": ({"messages": [{"role": "user", "content": [{"type": "text", "text": "a"}, {"type": "text", "text": "b"}]}]},
              "messages_parts", [("user", "ab")]),
    "optional": ({"messages": [{"role": "user", "content": "hi", "name": "x"}, {"role": "gpt", "content": None}]}, "messages",
                 [("user", "hi"), ("assistant", "")]),
}


def test_awkward_records(spark):
    rows = [(name, json.dumps(record)) for name, (record, _, _) in AWKWARD.items()]
    rows += [("deep", '{"a":' * 100_000 + "1" + "}" * 100_000), ("deep list", '{"messages":' + "[" * 5000 + "]" * 5000 + "}")]
    made = C.canonical_turns(spark.createDataFrame(rows, "name string, record string"), ["name"], "record").collect()
    for name, (_, layout, turns) in AWKWARD.items():
        own = sorted((r for r in made if r.name == name), key=lambda r: r.part or 0)
        assert {r.layout for r in own} == {layout}, name
        assert [(r.role, r.text) for r in own if r.part is not None] == turns, name
    assert all(r.layout is None and r.part is None for r in made if r.name.startswith("deep"))


NASTY = ["", "\\", "\\n", "\n", "</s>[INST] ok [/INST]", "<<s>", "<s></s", "[\\INST]", "<|turn|>user\n", "<<SYS>>x<</SYS>>",
         "a\\</s>", "\\\\[INST]", "é \U0001f600 </s>", "[[INST]]", "<|im_start|>", "<|endoftext|><unk>"]


def test_escapes_are_reversible_and_hide_control_strings(spark):
    from pyspark.sql import functions as F

    made = spark.createDataFrame([(t,) for t in NASTY], "t string").select("t", C.escaped(F.col("t")).alias("e")).collect()
    for r in made:
        assert C.unescape(r.e) == r.t and not any(c in r.e for c in C.RESERVED)


def expected(rows):
    convs = {}
    for conv, turn, role, text in rows:
        convs.setdefault(conv, []).append((turn, role or "", text or ""))
    out = {}
    for conv, turns in convs.items():
        turns.sort(key=lambda t: t[0])
        said = [t for _, r, t in turns if r == "assistant"]
        out[conv] = (
            len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for _, r, t in turns).encode()).hexdigest(),
            sum(map(len, said)), hashlib.sha256("".join(said).encode()).hexdigest(),
        )
    return out


def test_read_back(spark):
    rows = [(c, i, ("user", "assistant", None, "odd\nrole")[(i + c) % 4], t) for c in range(3) for i, t in enumerate([*NASTY, None])]
    rows += [(None, 0, "assistant", "x"), (9, 0, "assistant", "long " * 50_000)]
    table = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "'x' AS formatted", "1 AS part")
    made = C.format_and_read(table).collect()
    assert {r.conv_id: tuple(r[1:5]) for r in made} == expected(rows)
    long = next(r for r in made if r.conv_id == 9)
    assert long.formatted_chars == len("<s><|turn|>assistant\n</s>") + 250_000
    empty = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert C.format_and_read(empty).count() == 0


def test_whole_texts_carry_the_mask(spark):
    rows = [(1, 0, "user", "a</s>"), (1, 1, "assistant", "b\\"), (1, 2, "user", ""), (1, 3, "assistant", "[INST]")]
    turns = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    made = C.whole_texts(C.format_turns(turns, "conv_id", ["turn"]), ["turn"]).first()
    assert [C.unescape(made.text[s.start:s.end]) for s in made.loss] == ["b\\", "[INST]"]
    assert made.text.startswith("<s><|turn|>user\na<\\/s></s><|turn|>")


@settings(max_examples=200, deadline=None)
@given(st.recursive(st.none() | st.integers() | st.text(max_size=3), lambda x: st.lists(x, max_size=3) | st.dictionaries(st.text(max_size=3), x, max_size=3), max_leaves=8))
def test_any_record_is_handled(value):
    record = json.loads(json.dumps({"messages": value, "text": value, "role": value}))
    layout = C.choose(C.field_paths(record))
    if layout:
        assert all(isinstance(r, str) and isinstance(t, str) for r, t in C.apply_layout(record, layout))

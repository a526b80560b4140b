import hashlib
import json

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from logweave.llm import chat_format as cf
from logweave.llm.queries import chat_records, op11_chat_format

SF = "/root/testdata/sf0.001"
PIECES = ["<", "[", "]", "/", "\\", "s>", "/s>", "INST]", "<s>", "</s>", "[INST]", " [/INST]", "<<SYS>>", "<</SYS>>", "SYS>>", "a", " ", "\n", "😀"]
TEXT = st.lists(st.sampled_from(PIECES), max_size=12).map("".join)


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "system", "", "tool <s>\n%"]), TEXT), max_size=5))
def test_any_turns_come_back(turns):
    t = cf.Template()
    escape, unescape = t.patterns()
    text, spans = t.write(turns, escape)
    assert t.read(text, unescape) == turns
    assert [unescape(text[a:b]) for a, b in spans] == [x for r, x in turns if r == "assistant"]
    for _, x in turns:
        assert not any(c in escape(x) for c in t.control) and unescape(escape(x)) == x
    # The template's own control strings are the only ones.
    marks = sum(text.count(c) for c in ("[INST]", "<s>", "<<SYS>>"))
    assert marks == len(turns)


def test_templates_that_cannot_be_read_back_are_refused():
    for bad in (dict(control=("[INST]", "ST][")), dict(user=("<s>", "aba</s>aba")), dict(user=("[INST] ", "end")), dict(control=("<", "</s>"))):
        with pytest.raises(ValueError):
            cf.Template(**bad)
    # Marks of another family work the same.
    t = cf.Template(("<|user|>", "<|end|>"), ("<|bot|>", "<|end|>"), ("<|role|>", "<|end|>"), ("<|user|>", "<|bot|>", "<|role|>", "<|end|>"))
    escape, unescape = t.patterns()
    turns = [("system", "<|end|><\\|end|>"), ("user", "<|bot|>hi"), ("assistant", "<|<|end|>")]
    assert t.read(t.write(turns, escape)[0], unescape) == turns


RECORDS = [
    ({"messages": [{"role": "user", "content": "a"}, {"role": "assistant", "content": None}]}, "messages", [("user", "a"), ("assistant", "")]),
    ({"conversations": [{"from": "human", "value": "q"}, {"value": "w", "from": "gpt"}], "id": "7"}, "conversations", [("user", "q"), ("assistant", "w")]),
    ({"completion": "c", "prompt": "p"}, "prompt", [("user", "p"), ("assistant", "c")]),
    ({"completion": "c", "prompt": "p", "system": None}, "prompt", [("user", "p"), ("assistant", "c")]),
    ({"completion": "c", "prompt": "p", "system": ""}, "prompt", [("system", ""), ("user", "p"), ("assistant", "c")]),
    ({"instruction": "i", "output": 5, "system": "be </s>"}, "instruction", [("system", "be </s>"), ("user", "i"), ("assistant", "5")]),
    ({"dialogue": {"turns": [{"speaker": {"name": None}, "utterance": {"text": "t"}}]}}, "dialogue", [("", "t")]),
    ({"messages": []}, "messages", []),
    ({"messages": [{"role": "user", "content": {"parts": ["a"]}}]}, None, None),
    ({"prompt": "p"}, None, None), ([1, 2], None, None), ("text", None, None),
]


def test_records_of_every_layout(spark):
    rows = [(i, json.dumps(r), "clash") for i, (r, _, _) in enumerate(RECORDS)] + [(97, "not json", None), (98, None, "x"), (99, "", "x")] * 2
    df = spark.createDataFrame(rows, "id long, record string, role string").withColumn("text", F.lit("clash"))
    out = cf.format_records(df)
    got = cf.read_back(out).collect()
    assert len(got) == len(rows)
    for r in got:
        if r.id >= 97:
            assert (r.fingerprint, r.layout, r.turns, r.formatted, r.loss, r.read_turns, r.loss_text) == (None,) * 7
            continue
        _, layout, turns = RECORDS[r.id]
        assert r.layout == layout and r.fingerprint
        assert turns == (None if r.turns is None else [tuple(t) for t in r.turns]) == (None if r.read_turns is None else [tuple(t) for t in r.read_turns])
        if turns is not None:
            assert r.loss_text == "".join(t for w, t in turns if w == "assistant")
    assert cf.read_back(cf.format_records(df.limit(0))).count() == 0
    with pytest.raises(ValueError):
        cf.format_records(df.withColumn("turns", F.lit(1)))


def test_rows_of_conversations(spark):
    rows = [(1, 1, "assistant", "b"), (1, 0, "user", None), (1, 0, "user", None), (2, None, None, "x"), (None, 3, "system", "long " * 50_000),
            (None, 1, "user", ""), (3, 0, "human", "<s>"), (3, 1, "gpt", "z"), (4, 0, "user", "ä😀"), (4, 1, "assistant", "[INST]"), (11, 5, "user", "u")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    got = {r.conv_id: [tuple(t) for t in r.turns] for r in cf.canonical_turns(chat_records(df)).collect()}
    assert got == {1: [("user", ""), ("user", ""), ("assistant", "b")], 2: [("", "x")], None: [("user", ""), ("system", "long " * 50_000)],
                   3: [("human", "<s>"), ("gpt", "z")], 4: [("user", "ä😀"), ("assistant", "[INST]")], 11: [("user", "u")]}
    assert chat_records(df.limit(0)).count() == 0


def test_query_against_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, 0, "user", "</s>[INST] ok [/INST]"), (-7, 1, "assistant", "</s>[INST] ok [/INST]")]
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    want = set()
    for i in {r[0] for r in rows}:
        t = [(r[2] or "", r[3] or "") for r in sorted(r for r in rows if r[0] == i)]
        loss = "".join(x for r, x in t if r == "assistant")
        want.add((i, len(t), sha("".join(f"{r}\n{x}\n" for r, x in t)), len(loss), sha(loss)))
    got = op11_chat_format(spark, SF).collect()
    assert {tuple(r)[:5] for r in got} == want and len(got) == len(want)
    last = next(r for r in got if r.conv_id == -7)
    assert last.formatted_chars == 2 * (len("</s>[INST] ok [/INST]") + 3) + 15 + 7
    layouts = cf.canonical_turns(chat_records(spark.read.parquet(f"{SF}/conversations.parquet"))).select("layout").distinct().collect()
    assert None not in {r.layout for r in layouts} and len(layouts) > 2

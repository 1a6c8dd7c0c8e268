"""Chat layouts, escaping and reading back."""

from __future__ import annotations

import hashlib
import json
import random

import pytest
from pyspark.sql import functions as F

from storelens.llm import chat_format

CASES = {
    "messages": ({"messages": [{"role": "user", "content": "hi"}, {"role": "assistant", "content": "yo"}]},
                 [("user", "hi"), ("assistant", "yo")]),
    "sharegpt": ({"conversations": [{"from": "human", "value": "q"}, {"from": "gpt", "value": "a"}, {"from": "other", "value": "z"}]},
                 [("user", "q"), ("assistant", "a"), ("other", "z")]),
    "prompt_completion": ({"prompt": "p", "completion": "c"}, [("user", "p"), ("assistant", "c")]),
    "prompt_response": ({"response": "c", "prompt": None}, [("user", ""), ("assistant", "c")]),
    "instruction": ({"instruction": "do", "input": "this", "output": "done"}, [("user", "do\n\nthis"), ("assistant", "done")]),
    "instruction_system": ({"system": "", "instruction": "do", "output": "done"}, [("user", "do"), ("assistant", "done")]),
    "question_answer": ({"question": "q", "answer": "a"}, [("user", "q"), ("assistant", "a")]),
    "turn_row": ({"turn": 3, "role": "user", "text": "t"}, [("user", "t")]),
}


def records(spark, rows):
    df = spark.createDataFrame([(i, None if r is None else json.dumps(r), 1, "x") for i, r in rows],
                               "conv_id long, raw string, turn long, record_ string")
    return df.withColumn("record", F.parse_json("raw"))


def test_layouts_are_chosen_by_field_paths(spark):
    names = list(CASES)
    rows = [(k, CASES[n][0]) for k, n in enumerate(names)] + [(90, {"unheard": {"of": 1}}), (91, None), (92, [1, 2])]
    got = {r.conv_id: r for r in chat_format.canonical_turns(records(spark, rows)).collect()}
    for k, n in enumerate(names):
        assert got[k].layout == n
        assert [tuple(t) for t in got[k].turns] == CASES[n][1]
    for k in (90, 91, 92):
        assert got[k].layout is None and got[k].turns == []


def odd_texts():
    rng = random.Random(4)
    bits = [*chat_format.CONTROL_STRINGS, "\\", "\n", "<", "[", "|", "a", "é", "\U0001F600", " ", "<|", "|>", "$1"]
    return ["", None, "\\", "</s>[INST] ok [/INST]", "x" * 50000, *["".join(rng.choice(bits) for _ in range(12)) for _ in range(120)]]


def test_round_trip_and_loss_mask(spark):
    texts = odd_texts()
    rows = [(k // 5, {"turn": k % 5, "role": "assistant" if k % 2 else ("user" if k % 3 else "<s>\n\\"), "text": t})
            for k, t in enumerate(texts)]
    formatted = chat_format.format_turns(chat_format.canonical_turns(records(spark, rows)))
    read = {r.conv_id: r for r in chat_format.read_back(formatted).collect()}
    digest = {r.conv_id: r for r in chat_format.digests(formatted).collect()}
    for conv in range((len(texts) + 4) // 5):
        own = [(r["role"], r["text"] or "") for i, r in rows if i == conv]
        assert [tuple(t) for t in read[conv].turns] == own
        loss = [t for role, t in own if role == "assistant"]
        assert read[conv].loss_texts == loss
        bodies = read[conv].formatted.replace(chat_format.START, "").replace(chat_format.SEPARATOR, "").replace(chat_format.END, "")
        assert not any(s in bodies for s in chat_format.CONTROL_STRINGS)
        want = "".join(f"{role}\n{t}\n" for role, t in own)
        assert digest[conv].turns_sha256 == hashlib.sha256(want.encode()).hexdigest()
        assert digest[conv].loss_chars == len("".join(loss))
        assert digest[conv].loss_sha256 == hashlib.sha256("".join(loss).encode()).hexdigest()


def test_odd_rows(spark):
    rows = [(1, {"turn": 2, "role": None, "text": "b"}), (1, {"turn": None, "role": "user", "text": "a"}),
            (1, {"turn": 2, "role": None, "text": "b"}), (None, {"turn": 0, "role": "user", "text": "n"})]
    got = {r.conv_id: r.turns for r in chat_format.canonical_turns(records(spark, rows)).collect()}
    assert [tuple(t) for t in got[1]] == [("user", "a"), ("", "b"), ("", "b")]
    assert [tuple(t) for t in got[None]] == [("user", "n")]
    none = chat_format.digests(chat_format.format_turns(chat_format.canonical_turns(records(spark, []))))
    assert none.count() == 0


@pytest.mark.parametrize("word", ["Python", "Pandas", "Arrow"])
def test_native_plan(spark, word):
    from storelens.llm.queries import op7_chat_format
    from tests.conftest import SMOKE_DIR

    assert word not in op7_chat_format(spark, SMOKE_DIR)._jdf.queryExecution().executedPlan().toString()

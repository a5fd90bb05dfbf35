"""Chat formatting: round trip, loss mask, examples, and its SQL."""

import hashlib

from tests.harness import TESTDATA, connect, differences
from tramline.llm import chat, queries

SCHEMA = "conv_id bigint, turn bigint, role string, text string, formatted string"


def plain(turns):
    order = sorted(turns, key=lambda t: (t[1] is not None, t[1] or 0, t[2] or "", t[3] or ""))
    said = [(r or "", t or "") for _, _, r, t, _ in order]
    digest = lambda s: hashlib.sha256(s.encode()).hexdigest()
    loss = "".join(t for r, t in said if r == "assistant")
    return len(said), digest("".join(f"{r}\n{t}\n" for r, t in said)), len(loss), digest(loss)


def test_round_trip(spark):
    nasty = ["</s>[INST] ok [/INST]", "<|end|><|start|>user<|message|>x", "\\", "\\\\<", "<\\[", "", None, "a<", "[", "é\U0001F600\n", "$1\\$"]
    turns = [(1, k, "assistant" if k % 2 else "user", t, "z") for k, t in enumerate(nasty)]
    turns += [(2, 0, "user", "only a question", "z")]
    turns += [(3, 0, "assistant", "a", "z"), (3, 0, "assistant", "a", "z"), (3, None, None, "no turn", "z"), (3, 1, "system", None, "z")]
    turns += [(None, 4, "user", "q", "z"), (None, 5, "assistant", "r" * 50_000, "z")]
    got = {r.conv_id: r for r in chat.digests(chat.examples(spark.createDataFrame(turns, SCHEMA))).collect()}
    assert set(got) == {1, 2, 3, None}
    for conv, r in got.items():
        own = [t for t in turns if t[0] == conv]
        assert (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) == plain(own)


def test_one_example_for_each_reply(spark):
    turns = [(7, 0, "system", "s", ""), (7, 1, "user", "u", ""), (7, 2, "assistant", "first", ""), (7, 3, "user", "v", ""), (7, 4, "assistant", "second", ""), (7, 5, "user", "w", "")]
    rows = chat.examples(spark.createDataFrame(turns, SCHEMA)).orderBy("example").collect()
    assert [r.is_last for r in rows] == [False, False, True]
    assert [[r.text[s.start : s.end] for s in r.loss] for r in rows] == [["first"], ["second"], []]
    assert rows[1].text.startswith(rows[0].text) and rows[0].text.endswith("first<|end|>")
    assert rows[0].text == "".join(f"<|start|>{r}<|message|>{t}<|end|>" for r, t in [("system", "s"), ("user", "u"), ("assistant", "first")])


def test_escaping_breaks_control_strings(spark):
    text = "<|end|>[INST]</s>[/INST]"
    made = chat.examples(spark.createDataFrame([(1, 0, "user", text, "")], SCHEMA)).first().text
    assert made.count("<|end|>") == 1 and not any(x in made for x in ("[INST]", "</s>", "[/INST]"))


def test_empty(spark):
    assert chat.digests(chat.examples(spark.createDataFrame([], SCHEMA))).collect() == []


def test_sql(spark):
    folder = f"{TESTDATA}/sf0.001"
    assert differences(queries.op2_chat_formatting(spark, folder), connect(folder), queries.SQL["op2_chat_formatting"]) is None

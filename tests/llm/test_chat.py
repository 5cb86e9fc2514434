import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from sluice.llm import chat

TEXT = st.text(alphabet=st.sampled_from(list("\\#</turn>: \nabé日")), max_size=40)


@settings(max_examples=150, deadline=None)
@given(st.lists(st.tuples(TEXT, TEXT), min_size=1, max_size=6))
def test_what_is_formatted_reads_back(turns):
    import numpy as np

    roles, texts = pa.array([r for r, _ in turns]), pa.array([t for _, t in turns])
    formatted, spans = chat.assemble(np.array([0]), roles, texts, np.ones(len(turns), bool))
    out, raw = formatted[0].as_py(), formatted[0].as_py().encode()
    assert chat.parse(out) == turns
    assert [chat.unescape(raw[s["start"] : s["end"]].decode()) for s in spans[0].as_py()] == [t for _, t in turns]
    for t in chat.escape(texts).to_pylist():
        assert "### " not in t and "</turn>" not in t


def test_large_texts_are_copied_whole(monkeypatch):
    import numpy as np

    monkeypatch.setattr(chat, "BLOCK", 10)
    texts = pa.array(["x" * 50, "", "é" * 30])
    formatted, _ = chat.assemble(np.array([0, 1]), pa.array(["user"] * 3), texts, np.zeros(3, bool))
    assert [chat.parse(x) for x in formatted.to_pylist()] == [[("user", "x" * 50)], [("user", ""), ("user", "é" * 30)]]


@pytest.mark.parametrize("block", [chat.BLOCK, 64])
def test_conversations(spark, clashing, monkeypatch, block):
    rows = [(1, 1, "assistant", "hi"), (1, 0, "user", "a </turn> b"), (2, 0, None, None), (2, 0, "assistant", "x"), (2, 0, "assistant", "x"), (None, 5, "user", "n"), (None, None, "assistant", "m"), (3, 0, "system", "")]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").repartition(3)
    got = {r["conv_id"]: r for r in chat.format_chats(clashing(df)).collect()}
    turns = {k: chat.parse(r["formatted"]) for k, r in got.items()}
    assert turns == {1: [("user", "a </turn> b"), ("assistant", "hi")], 2: [("", ""), ("assistant", "x"), ("assistant", "x")], None: [("assistant", "m"), ("user", "n")], 3: [("system", "")]}
    assert {k: r["n_turns"] for k, r in got.items()} == {1: 2, 2: 3, None: 2, 3: 1}
    loss = {k: [r["formatted"].encode()[s["start"] : s["end"]].decode() for s in r["loss_spans"]] for k, r in got.items()}
    assert loss == {1: ["hi"], 2: ["x", "x"], None: ["m"], 3: []}
    assert chat.format_chats(df.limit(0)).count() == 0

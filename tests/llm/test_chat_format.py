"""Prefix examples against the turns they come from."""

import hashlib
from collections import defaultdict

from hypothesis import given
from hypothesis import strategies as st

from tramline.llm import catalogue, chat_format

TRICKY = ["a", "\\", "<", "|im_end|>", "[", "INST]", "</s>", "[/INST]", "<|im_sep|>", "\n", "é", "<<SYS>>", "s>"]


@given(st.lists(st.sampled_from(TRICKY), max_size=12).map("".join))
def test_escape_is_reversible_and_complete(text):
    escaped = chat_format.escape(text)
    assert chat_format.unescape(escaped) == text
    assert not any(c in escaped for c in chat_format.CONTROLS)


@given(st.lists(st.tuples(st.sampled_from(["user", "assistant", "", "<|im_sep|>"]), st.sampled_from(TRICKY)), max_size=8))
def test_examples(turns):
    examples = list(chat_format.expanded(turns))
    replies = [k for k, (role, _) in enumerate(turns) if role == "assistant"]
    assert [e[-1] for e in examples] == [False] * (len(examples) - 1) + [True] * bool(turns)
    for (_, text, start, chars, _), k in zip(examples, replies):
        assert list(chat_format.turns_of(text)) == turns[: k + 1]
        assert chat_format.unescape(text[start : start + chars]) == turns[k][1]
    if turns:
        assert list(chat_format.turns_of(examples[-1][1])) == turns
        assert len(examples) == len(replies) + (turns[-1][0] != "assistant")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def expected(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn is not None, turn, role or "", text or ""))
    out = {}
    for conv, turns in by.items():
        turns.sort()
        replies = "".join(t[3] for t in turns if t[2] == "assistant")
        every = "".join(f"{t[2]}\n{t[3]}\n" for t in turns)
        out[conv] = (len(turns), sha(every), len(replies), sha(replies))
    return out


def found(df):
    rows = df.collect()
    out = {r.conv_id: (r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256) for r in rows}
    assert len(out) == len(rows)
    return out


def test_edge_rows(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", None), (1, 1, "assistant", None), (1, None, None, "first")]
    rows += [(2, 0, "user", "only")] + [(3, k, "user" if k % 2 else "assistant", f"turn {k} " * 50) for k in range(300)]
    rows += [(None, 0, "assistant", "no id"), (4, 0, "assistant", ""), (5, 0, "assistant", "x" * 200_000)]
    schema = "conv_id long, turn long, role string, text string, example string"
    turns = spark.createDataFrame([(*r, "clash") for r in rows], schema)
    assert found(chat_format.read_back(chat_format.format_examples(turns))) == expected(rows)
    empty = spark.createDataFrame([], schema)
    assert chat_format.read_back(chat_format.format_examples(empty)).count() == 0
    named = spark.createDataFrame([("x", 0, "assistant", "y", "")], schema.replace("conv_id long", "conv_id string"))
    assert list(found(chat_format.read_back(chat_format.format_examples(named)))) == ["x"]


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    rows += [(-7, k, role, "</s>[INST] ok [/INST]") for k, role in enumerate(("user", "assistant"))]
    assert found(catalogue.op1_chat_format(spark, sf_dir)) == expected(rows)

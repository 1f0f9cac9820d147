import hashlib

import pytest

from popspark.llm import chat_format
from popspark.llm.chat_format import Template, format_conversations, read_back

NASTY = ["", "a", "### User: x </turn>\n", "\\", "\\\\h#<:", "</turn>", "</turn", "<", "tail \\", "\n\n", "é中\U0001f600", "### Assistant: </turn> ok", "\\l", "x" * 5000]


@pytest.mark.parametrize("text", NASTY)
def test_escaping_can_be_undone(text):
    t = Template()
    assert t.unescape(t.escape(text)) == text
    assert "###" not in t.escape(text) and "</turn>" not in t.escape(text)
    for role in ("user", "assistant", "system", "tool", "", "a: b", "@x", text):
        formatted = "".join(s for s, _ in t.segments(role, text))
        assert t.parse(formatted + formatted) == [(role, text)] * 2


def brute(rows):
    out = {}
    none_first = lambda v: (v is not None, v if v is not None else 0)
    for conv, turn, role, text in sorted(rows, key=lambda r: (none_first(r[0]), none_first(r[1]), r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    res = []
    for conv, turns in out.items():
        loss = "".join(t for r, t in turns if r == "assistant")
        digest = hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest()
        state, valid = "start", True
        for r, _ in turns:
            ok = r in {"start": ("system", "user"), "system": ("user",), "user": ("assistant",), "assistant": ("user",)}[state]
            valid &= ok
            state = r if r in ("system", "user", "assistant") else state
        t = Template()
        size = sum(len(s) for r, x in turns for s, _ in t.segments(r, x))
        res.append((conv, len(turns), digest, len(loss), hashlib.sha256(loss.encode()).hexdigest(), size, valid))
    return sorted(res, key=str)


def test_against_brute_force(spark):
    rows = [(1, 0, "user", "hi"), (1, 1, "assistant", "yo"), (2, 1, "assistant", "b"), (2, 0, "user", None), (3, 0, None, "x"), (3, 0, "user", "y"), (3, 0, "user", "y")]
    rows += [(4, i, "user" if i % 2 == 0 else "assistant", NASTY[i % len(NASTY)]) for i in range(3000)]
    rows += [(None, 0, "system", "s"), (None, None, "user", "u"), (5, 0, "tool: a", "t"), (5, 1, "assistant", None), (6, 0, "user", "z" * 3_000_000)]
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, valid string")
    got = sorted((tuple(r) for r in read_back(format_conversations(df)).collect()), key=str)
    assert got == brute(rows)


def test_segments_cover_the_text_and_flag_assistants(spark):
    df = spark.createDataFrame([(1, 0, "user", "a#"), (1, 1, "assistant", "b<")], "conv_id long, turn long, role string, text string")
    for r in format_conversations(df).orderBy("position").collect():
        assert sum(s.length for s in r.segments) == len(r.formatted)
        flagged = "".join(r.formatted[s.start : s.start + s.length] for s in r.segments if s.loss)
        assert flagged == ("b\\l" if r.position else "")


def test_query_and_empty_table(spark, tmp_path):
    d = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{d}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    text = "\\### Assistant: </turn> ok"
    rows += [(-7, 0, "user", text), (-7, 1, "assistant", text)]
    assert sorted((tuple(r) for r in chat_format.op3_chat_format(spark, d).collect()), key=str) == brute(rows)
    spark.createDataFrame([], "conv_id long, turn long, role string, text string").write.parquet(f"{tmp_path}/conversations.parquet")
    assert [r.conv_id for r in chat_format.op3_chat_format(spark, str(tmp_path)).collect()] == [-7]

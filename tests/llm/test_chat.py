"""Chat formatting (5): what goes in reads back."""

from __future__ import annotations

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tremor.llm import chat

TEXT = st.lists(st.sampled_from(["a", "\\", "#", "###", "</turn>", "<+>", "\n", "s", "h", "t", "j", "<", ">", "é😀"]),
                max_size=12).map("".join)


def by_turn(rows):
    out = {}
    for conv, turn, role, text in sorted(rows, key=lambda r: (str(r[0]), r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out.setdefault(conv, []).append((role or "", text or ""))
    return out


def check(spark, rows, stretch):
    df = spark.createDataFrame([(*r, "x") for r in rows], "conv_id long, turn long, role string, text string, row string")
    made = chat.format_conversations(df, stretch=stretch)
    got = made.select("*", chat.parse_turns(F.col("formatted")).alias("turns"),
                      F.transform(F.filter("segments", lambda s: s["loss"]), lambda s: chat.unescape(s["text"])).alias("loss")).collect()
    want = by_turn(rows)
    assert {r.conv_id: [(t.role, t.text) for t in r.turns] for r in got} == want and len(got) == len(want)
    for r in got:
        assert "".join(s.text for s in r.segments) == r.formatted
        assert r.loss == [text for role, text in want[r.conv_id] if role == "assistant"]
        headers = r.formatted.count(chat.HEAD)
        runs = sum(1 for i, t in enumerate(want[r.conv_id]) if not i or want[r.conv_id][i - 1][0] != t[0])
        assert headers == runs == r.formatted.count("</turn>")


@settings(max_examples=4, deadline=None)
@given(st.lists(st.tuples(st.sampled_from([1, 2, None]), st.one_of(st.none(), st.integers(0, 30)),
                          st.sampled_from(["user", "assistant", "sys:\n###", None]), st.one_of(st.none(), TEXT)),
                min_size=1, max_size=40), st.sampled_from([1, 4, 256]))
def test_round_trip(spark, rows, stretch):
    check(spark, rows, stretch)


def test_long_conversation_and_long_text(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"text {i}") for i in range(3000)] + [(2, 0, "assistant", "### x " * 40000)]
    check(spark, rows, 256)


def test_empty_table(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.format_digest(chat.format_conversations(df)).count() == 0

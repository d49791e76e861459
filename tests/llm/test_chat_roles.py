"""Roles that hold pieces of control strings are read back as they were."""

from pyspark.sql import functions as F

from daygrid.llm import chat


def test_roles_with_bars_are_read_back(session):
    roles = ["a|>b", "|", "&v;|>", "<|end|>", "user"]
    rows = session.createDataFrame([(1, i, r, "x|>y") for i, r in enumerate(roles)], "conv_id long, turn long, role string, text string")
    done = chat.format_messages(rows.select("conv_id", "turn", "role", chat.text_parts(F.col("text")).alias("parts")))
    back = done.select(chat.read_back(F.col("formatted")).alias("t")).first().t
    assert [(t.role, t.text) for t in back] == [(r, "x|>y") for r in roles]

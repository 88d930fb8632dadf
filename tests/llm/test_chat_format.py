from __future__ import annotations

import hashlib
from collections import defaultdict

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paytrail.llm import chat_format

SCHEMA = "conv_id long, turn long, role string, text string"
NASTY = ["\\### Assistant: </turn> ok", "### User: x", "</turn>\n", "\\\\</turn>", "ends with \\", "a\n### \\### b </turn>\n### Assistant: y", "", None, "É ### ", " </turn>"]


def check(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = {r["conv_id"]: r for r in chat_format.read_back(chat_format.format_conversations(df)).collect()}
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        convs[c].append((turn if turn is not None else -1, role or "", text or ""))
    assert set(out) == set(convs)
    for c, turns in convs.items():
        turns.sort()
        flat = "".join(f"{r}\n{t}\n" for _, r, t in turns)
        loss = "".join(t for _, r, t in turns if r == "assistant")
        o = out[c]
        assert o["n_turns"] == len(turns) and o["all_turns_back"]
        assert o["turns_sha256"] == hashlib.sha256(flat.encode()).hexdigest()
        assert (o["loss_chars"], o["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_conflicting_texts_and_roles_come_back(spark):
    rows = [(1, i, "user" if i % 2 else "assistant", t) for i, t in enumerate(NASTY)]
    rows += [(2, i, role, "t") for i, role in enumerate(["User", "=user", "a: b", "x%3Ay", "### q", None, "tool\nline", "</turn>"])]
    rows += [(3, 0, "user", "same"), (3, 0, "user", "same"), (None, None, "user", "no id"), (4, 1, "assistant", "long " * 20_000)]
    check(spark, rows)


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.lists(st.sampled_from(["\\", "#", " ", "<", "/", "turn>", "### ", "</turn>", "\n", "a", ":"]), max_size=12).map("".join), min_size=1, max_size=12))
def test_any_text_comes_back(spark, texts):
    check(spark, [(1, i, "assistant", t) for i, t in enumerate(texts)])


def test_only_conflicting_texts_are_escaped(spark):
    df = spark.createDataFrame([(1, 0, "user", "plain \\ text"), (1, 1, "user", "### x")], SCHEMA)
    rendered = [r["rendered"] for r in chat_format.render_turns(df).orderBy("turn").collect()]
    assert rendered == ["### User: plain \\ text </turn>\n", "### User: \\### x </turn>\n"]


def test_empty_table(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert chat_format.read_back(chat_format.format_conversations(df)).count() == 0


def test_other_columns_do_not_matter(spark):
    df = spark.createDataFrame([(1, 0, "user", "x")], SCHEMA).withColumns({"rendered": F.lit("?"), "conflict": F.lit(1)})
    assert chat_format.read_back(chat_format.format_conversations(df)).first()["n_turns"] == 1

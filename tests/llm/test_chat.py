from __future__ import annotations

import hashlib

from hypothesis import given, settings
from hypothesis import strategies as st

from retailgold.llm import chat
from retailgold.llm.queries import op13_chat
from tests.llm.conftest import SF
from tests.llm.brute import sha

LOG = "conv_id bigint, seq bigint, message string, kind string, role string, text string"
TABLE = "conv_id bigint, turn bigint, role string, text string, message string, seq int"


def read_back(log):
    return chat.read_turns(chat.format_conversations(log)).withColumn("loss", chat.loss_text())


def messages(spark, events):
    rows = chat.fold(spark.createDataFrame(events, LOG).repartition(3)).orderBy("opened").collect()
    return [(r["conv_id"], r["role"], r["text"]) for r in rows]


def test_fold(spark):
    events = [
        (1, 1, "a", "open", "user", None), (1, 2, "a", "delta", None, "Hel"), (1, 4, "a", "delta", None, "lo"),
        (1, 5, "b", "open", "assistant", None), (1, 6, "b", "delta", None, "bad"), (1, 7, "b", "regenerate", None, None),
        (1, 8, "b", "delta", None, "go"), (1, 9, "b", "delta", None, "od"), (1, 10, "a", "edit", None, "Hi"), (1, 11, "a", "delta", None, "!"),
    ]
    want = [(1, "user", "Hi!"), (1, "assistant", "good")]
    assert messages(spark, events) == want
    assert messages(spark, events[::-1] + events[:4]) == want  # out of order, delivered twice


def test_fold_odd_events(spark):
    assert messages(spark, [(1, 1, "a", "delta", None, "x"), (1, 2, "a", "seen", None, "y")]) == [(1, "", "x")]
    assert messages(spark, [(1, 1, "a", "open", "user", None), (1, 2, "a", "open", "tool", None)]) == [(1, "tool", "")]
    assert messages(spark, [(None, 1, "a", "edit", "user", None)]) == [(None, "user", "")]
    assert chat.format_conversations(spark.createDataFrame([], LOG)).count() == 0


def test_render_marks_what_is_trained(spark):
    log = spark.createDataFrame([(1, 1, "a", "open", "user", None), (1, 2, "a", "delta", None, "q"), (1, 3, "b", "open", "assistant", None), (1, 4, "b", "delta", None, "<s>é😀")], LOG)
    row = chat.format_conversations(log).first()
    assert row["formatted"] == "[INST] q [/INST]<s> <\\s>é😀 </s>"
    assert [tuple(m) for m in row["mask"]] == [(7, 0), (4, 6)]


@settings(max_examples=3, deadline=None)
@given(st.lists(st.lists(st.sampled_from(["<", "[", "\\", "s>", "/s>", "INST]", "/INST]", "ROLE]", "SAYS]", " ", "\n", "a", "é"]), max_size=8).map("".join), min_size=40, max_size=80))
def test_any_text_comes_back(spark, said):
    roles = ["user", "assistant", "system", "</s>", "[SAYS] x"]
    rows = [(i // 5, i % 5, roles[i % 5], t, None, 0) for i, t in enumerate(said)]
    got = read_back(chat.log_of(spark.createDataFrame(rows, TABLE).repartition(3))).collect()
    assert {r["conv_id"]: [(t["role"], t["text"]) for t in r["turns"]] for r in got} == {
        c: [(r, t) for k, _, r, t, *_ in rows if k == c] for c in {r[0] for r in rows}
    }
    assert all(r["loss"] == "".join(t["text"] for t in r["turns"] if t["role"] == "assistant") for r in got)
    for r in got:  # no control string but the template's own
        assert r["formatted"].count("[INST]") == sum(t["role"] == "user" for t in r["turns"])


def test_odd_rows(spark):
    long = "wörd " * 60_000
    rows = [(1, 0, None, None, "m", 1), (1, None, "user", "first", "m", 1), (1, 2, "user", "same", "m", 1), (1, 2, "user", "same", "m", 1), (1, 3, "assistant", long, "m", 1), (None, 0, "user", "", "m", 1)]
    got = {r["conv_id"]: r for r in read_back(chat.log_of(spark.createDataFrame(rows, TABLE).repartition(3))).collect()}
    assert [(t["role"], t["text"]) for t in got[1]["turns"]] == [("user", "first"), ("", ""), ("user", "same"), ("user", "same"), ("assistant", long)]
    assert got[1]["loss"] == long
    assert [(t["role"], t["text"]) for t in got[None]["turns"]] == [("user", "")]
    assert read_back(chat.log_of(spark.createDataFrame([], TABLE))).count() == 0


def test_drafts_are_in_the_log(spark, table):
    kinds = {r["kind"]: r["count"] for r in chat.log_of(table("conversations")).groupBy("kind").count().collect()}
    assert kinds["edit"] > 5 and kinds["regenerate"] > 5 and kinds["open"] == table("conversations").count()


def test_query_against_the_table(spark, table):
    by = {-1: [(0, "user", "</s>[INST] ok [/INST]"), (1, "assistant", "</s>[INST] ok [/INST]")]}
    for r in table("conversations").collect():
        by.setdefault(r["conv_id"], []).append((r["turn"], r["role"], r["text"]))
    got = {r["conv_id"]: r for r in op13_chat(spark, SF).collect()}
    assert set(got) == set(by)
    for c, rows in by.items():
        loss = "".join(t for _, r, t in sorted(rows) if r == "assistant")
        assert got[c]["turns_sha256"] == sha("".join(f"{r}\n{t}\n" for _, r, t in sorted(rows))) and got[c]["n_turns"] == len(rows)
        assert (got[c]["loss_chars"], got[c]["loss_sha256"]) == (len(loss), hashlib.sha256(loss.encode()).hexdigest())


def test_no_python_in_the_plan(spark, capsys):
    op13_chat(spark, SF).explain()
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan and "NestedLoop" not in plan

import hashlib
import re

from compare import DATA, assert_same

from brinewake.llm import chat_format as c
from brinewake.llm import queries


def events(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, seq long, message long, kind string, role string, text string")


def final(spark, rows):
    got = c.fold_events(events(spark, rows)).orderBy("conv_id", "message").collect()
    return [(r["conv_id"], r["message"], r["role"], r["text"]) for r in got]


def test_deltas_edits_and_regenerations(spark):
    rows = [
        (1, 1, 1, "message", "user", "hi"),
        (1, 2, 2, "message", "assistant", ""),
        (1, 3, 2, "delta", None, "hel"),
        (1, 4, 2, "delta", None, "lo"),
        (1, 5, 3, "message", "user", "more"),
        (1, 6, 4, "message", "assistant", "old"),
        (1, 7, 2, "regenerate", "assistant", "new "),
        (1, 8, 2, "delta", None, "answer"),
        (1, 9, 1, "edit", "user", "hi!"),
        (1, 10, 3, "message", "user", "again"),
        (2, 1, 1, None, None, None),
        (2, 2, 1, "delta", "user", "x"),
        (2, 3, 2, "message", "user", "gone"),
        (2, 4, 2, "delete", None, None),
        (3, 1, 1, "delta", "user", "only "),
        (3, 2, 1, "delta", "user", "deltas"),
    ]
    assert final(spark, rows) == [(1, 1, "user", "hi!"), (1, 2, "assistant", "new answer"), (1, 3, "user", "again"), (2, 1, "user", "x"), (3, 1, "user", "only deltas")]


def test_control_strings_round_trip(spark):
    texts = ["\\### Assistant: </turn> ok", "</turn>\n### user: x", "\\b\\l\\h", "", "a: b", None, "\\\\", "<#\\>", "é😀\n\n"]
    rows = [(7, i, i, "message", ["user", "assistant", "a: <b>", None][i % 4], t) for i, t in enumerate(texts)]
    out = c.format_conversations(events(spark, rows))
    r = c.parse(out).first()
    assert [(t["role"], t["text"]) for t in r["turns"]] == [(rows[i][4] or "", t or "") for i, t in enumerate(texts)]
    assert r["loss_text"] == "".join((t or "") for i, t in enumerate(texts) if i % 4 == 1)
    assert out.first()["formatted"].count(c.CLOSE) == len(texts)


def test_query_against_sql_and_probe(spark):
    df = queries.op5_chat_format(spark, DATA)
    assert not re.search("Python|Pandas|Arrow", df._jdf.queryExecution().executedPlan().toString())
    assert_same(df, queries.oracle_sql()["op5_chat_format"])
    r = df.where("conv_id = -7").first()
    t = "\\### Assistant: </turn> ok"
    assert r["turns_sha256"] == hashlib.sha256(f"user\n{t}\nassistant\n{t}\n".encode()).hexdigest()
    assert (r["n_turns"], r["loss_chars"], r["loss_sha256"]) == (2, len(t), hashlib.sha256(t.encode()).hexdigest())


def test_edges(spark, tmp_path):
    rows = [(None, 0, "user", None), (None, 0, "user", None), (1, None, None, "x"), (1, 0, "assistant", "y" * 300_000), (2, 1, "user", ""), (2, 1, "user", "tie")]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").selectExpr("*", "1 as message", "2 as seq", "3 as kind").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["conv_id"]: r for r in queries.op5_chat_format(spark, str(tmp_path)).collect()}
    assert {k: r["n_turns"] for k, r in got.items()} == {None: 2, 1: 2, 2: 2, -7: 2}
    assert got[1]["loss_chars"] == 300_000
    assert c.format_conversations(events(spark, [])).count() == 0

import hashlib

from fareline.llm import chat

ROWS = [(1, 1, "assistant", "hi <s> [INST] x </s>"), (1, 0, "user", "q"), (1, 2, "assistant", None), (1, 3, None, "<\\s> [\\\\/INST] <<s>"),
        (2, None, "user", "first"), (2, 5, "user", "tie b"), (2, 5, "user", "tie a"), (2, 5, "user", "tie a"), (2, 6, "as[INST]s</s>", "[/INST]</s>"),
        (3, 0, "assistant", "漢字😀"), (None, 0, "user", "no id"), (4, 0, "assistant", ""), (5, 0, "user", "\\"), (5, 1, "assistant", "w" * 300000)]


def make(spark, rows):
    return spark.createDataFrame([(*r, "clash", 1) for r in rows], "conv_id long, turn long, role string, text string, formatted string, turns int")


def expected(rows):
    out = {}
    for c in {r[0] for r in rows}:
        mine = sorted(((r[1] is not None, r[1] or 0, r[2] or "", r[3] or "") for r in rows if r[0] == c))
        loss = "".join(t for *_, role, t in mine if role == "assistant")
        out[c] = (len(mine), hashlib.sha256("".join(f"{r}\n{t}\n" for *_, r, t in mine).encode()).hexdigest(),
                  len(loss), hashlib.sha256(loss.encode()).hexdigest())
    return out


def test_round_trip(spark):
    got = {r["conv_id"]: tuple(r)[1:5] for r in chat.chat_report(make(spark, ROWS)).collect()}
    assert got == expected(ROWS)


def test_merges_runs_and_masks(spark):
    rows = [(1, 0, "user", "a"), (1, 1, "user", "b"), (1, 2, "assistant", "c"), (1, 3, "assistant", "d")]
    r = chat.format_conversations(make(spark, rows)).first()
    assert r["formatted"] == "<s>user[INST]a[/INST][INST]b[/INST]</s><s>assistant[INST]c[/INST][INST]d[/INST]</s>"
    assert sum(x["n"] for x in r["loss_mask"]) == len(r["formatted"])
    at, under = 0, []
    for x in r["loss_mask"]:
        if x["loss"]:
            under.append(r["formatted"][at:at + x["n"]])
        at += x["n"]
    assert under == ["c", "d"]


def test_probe_and_empty(spark):
    empty = make(spark, []) if False else make(spark, ROWS).limit(0)
    assert chat.chat_report(empty).count() == 0
    r = chat.chat_report(chat.with_probe(empty, spark)).collect()
    said = "</s>[INST] ok [/INST]"
    assert len(r) == 1 and r[0]["conv_id"] == -7 and r[0]["n_turns"] == 2 and r[0]["loss_chars"] == len(said)
    assert r[0]["turns_sha256"] == hashlib.sha256(f"user\n{said}\nassistant\n{said}\n".encode()).hexdigest()


def test_no_python_in_the_plan(spark):
    plan = chat.chat_report(make(spark, ROWS))._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

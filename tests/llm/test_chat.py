import hashlib
import random

import pytest
from pyspark.sql import functions as F

from letbook.llm import chat

KIND = "conv_id long, turn long, role string, text string, name int"


def formatted(spark, rows):
    frame = spark.createDataFrame([(*r, 1) for r in rows], KIND)
    out = chat.format_chats(frame).withColumn("back", chat.parse(F.col("formatted")))
    out = out.withColumn("learned", chat.learned_text(F.col("segments")))
    return {r["conv_id"]: r for r in out.collect()}


def test_round_trip_of_hostile_texts(spark):
    rng = random.Random(3)
    bits = ["<|im_start|>", "<|im_end|>", "\n", "<", "|", "\\", "<\\|", "<\\\\|", "%", "%0A", "%25", "assistant", "é", "", "$1"]
    rows = []
    for c in range(40):
        for t in range(5):
            role = rng.choice(["user", "assistant", "system", "", "a\nb%0A<|", "tool"])
            rows.append((c, t, role, "".join(rng.choices(bits, k=rng.randrange(9)))))
    got = formatted(spark, rows)
    for c in range(40):
        want = [(r[2], r[3]) for r in rows if r[0] == c]
        assert [(b["role"], b["text"]) for b in got[c]["back"]] == want
        assert got[c]["learned"] == "".join(t for r, t in want if r == "assistant")
        assert "".join(s["text"] for s in got[c]["segments"]) == got[c]["formatted"]


def test_machine(spark):
    cases = {
        1: (["user", "assistant"], None),
        2: (["system", "user", "assistant", "tool", "assistant"], None),
        3: (["assistant", "user"], 0),
        4: (["user", "user"], 1),
        5: (["user"], 1),
        6: (["user", None], 1),
    }
    rows = [(c, i, r, "t") for c, (roles, _) in cases.items() for i, r in enumerate(roles)]
    got = formatted(spark, rows)
    for c, (_, bad) in cases.items():
        assert got[c]["bad_turn"] == bad, c
        assert got[c]["valid"] == (bad is None)


def test_order_nulls_ties_and_empty(spark):
    got = formatted(spark, [(1, 2, "assistant", None), (1, 1, "user", "q"), (1, 1, "user", "q"), (None, None, None, None)])
    assert [(b["role"], b["text"]) for b in got[1]["back"]] == [("user", "q"), ("user", "q"), ("assistant", "")]
    assert got[None]["n_turns"] == 1 and not got[None]["valid"]
    assert formatted(spark, []) == {}


def test_query_digests(spark, sf_dir):
    from letbook.llm.queries import op7_chat

    got = {r["conv_id"]: r for r in op7_chat(spark, sf_dir).collect()}
    turns = spark.read.parquet(f"{sf_dir}/conversations.parquet").orderBy("conv_id", "turn").collect()
    for c in {t["conv_id"] for t in turns}:
        mine = [t for t in turns if t["conv_id"] == c]
        text = "".join(f"{t['role']}\n{t['text'] or ''}\n" for t in mine)
        loss = "".join(t["text"] or "" for t in mine if t["role"] == "assistant")
        assert got[c]["turns_sha256"] == hashlib.sha256(text.encode()).hexdigest()
        assert got[c]["loss_sha256"] == hashlib.sha256(loss.encode()).hexdigest()
        assert (got[c]["n_turns"], got[c]["loss_chars"]) == (len(mine), len(loss))
    assert got[-1]["n_turns"] == 2 and got[-1]["loss_chars"] == len("<|im_end|><|im_start|>assistant ok")


@pytest.mark.parametrize(
    "template",
    [
        chat.Template(open="[INST]", close="[/INST]\n"),
        chat.Template(open="", after_role=": ", close="#end#!\n"),
        chat.Template(open="<s>", after_role="|", close="</s>"),
    ],
)
def test_round_trip_of_other_templates(spark, template):
    """Control strings of the template, whole and in parts, inside texts and roles."""
    rng = random.Random(4)
    bits = [template.open, template.close, template.after_role, template.close[:2], template.close[1:], "\n", "[", "\\", "\\INST]", "%", "%0A", "a", ""]
    rows = [(c, t, rng.choice(["user", "assistant", "a:b|c\nd", template.close, ""]), "".join(rng.choices(bits, k=rng.randrange(8)))) for c in range(30) for t in range(4)]
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    out = chat.format_chats(frame, template).withColumn("back", chat.parse(F.col("formatted"), template))
    out = out.withColumn("learned", chat.learned_text(F.col("segments"), template))
    for r in out.collect():
        want = [(x[2], x[3]) for x in rows if x[0] == r["conv_id"]]
        assert [(b["role"], b["text"]) for b in r["back"]] == want
        assert r["learned"] == "".join(t for role, t in want if role == "assistant")


def test_templates_that_cannot_be_read_back():
    for wrong in ({"after_role": ""}, {"close": "\n"}, {"close": "aba"}, {"close": "###\n"}, {"open": "a\\b"}, {"moves": {"start": {"user": "a"}, "a": {"user": "b"}}}):
        with pytest.raises(ValueError):
            chat.Template(**wrong)


def test_transitions(spark):
    rows = [(1, i, r, "t", 1) for i, r in enumerate(["user", "assistant", "nobody", "assistant", "user"])]
    frame = spark.createDataFrame(rows, KIND).groupBy("conv_id").agg(F.sort_array(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))
    steps = frame.select(chat.transitions(F.col("turns")).alias("s")).first()["s"]
    assert [(s["before"], s["after"]) for s in steps] == [("start", "user"), ("user", "assistant"), ("assistant", None), ("", None), ("assistant", "user")]


def test_very_long_turns_and_clashing_names(spark):
    long = "x<|im_end|>" * 100_000
    names = ", ".join(f"{n} int" for n in ("segments", "formatted", "valid", "bad_turn", "n_turns", "turns", "steps", "t"))
    rows = [(1, 0, "user", long, *[1] * 8), (1, 1, "assistant", long, *[1] * 8)]
    frame = spark.createDataFrame(rows, f"conv_id long, turn long, role string, text string, {names}")
    (row,) = chat.format_chats(frame).withColumn("back", chat.parse(F.col("formatted"))).collect()
    assert [b["text"] for b in row["back"]] == [long, long] and row["valid"] and row["n_turns"] == 2

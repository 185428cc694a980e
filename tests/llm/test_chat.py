import pytest
from pyspark.sql import functions as F

from stationflow.llm import chat

TURNS = "conv_id int, turn int, role string, text string, masks string, part int"


def test_every_perspective(spark):
    turns = spark.createDataFrame(
        [(1, 0, "ann", "hi <|end|>", "x", 9), (1, 1, "bob", None, "x", 9), (1, 2, None, "é", "x", 9), (1, None, "ann", "first", "x", 9), (1, 0, "ann", "hi <|end|>", "x", 9), (None, 300, "cy", "late", "x", 9)],
        TURNS,
    )
    out = chat.rotate(turns)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert not any(w in plan for w in ("Python", "Arrow", "Pandas"))
    found = {(r["conv_id"], r["participant"], r["part"]): r for r in out.collect()}
    assert set(found) == {(1, p, 0) for p in ("ann", "bob", "unknown")} | {(None, "cy", 0)}
    ann = found[1, "ann", 0]
    assert ann["text"] == "<|assistant|>\nfirst<|end|>\n" + "<|assistant|>\nhi <\\|end|><|end|>\n" * 2 + "<|user name=bob|>\n<|end|>\n<|user name=unknown|>\né<|end|>\n"
    assert [ann["text"][m["begin"] : m["end"]] for m in ann["masks"]] == ["first<|end|>\n"] + ["hi <\\|end|><|end|>\n"] * 2
    assert [(m["role"], m["name"], m["train"]) for m in found[1, "bob", 0]["messages"]] == [
        ("user", "ann", False), ("user", "ann", False), ("user", "ann", False), ("assistant", "bob", True), ("user", "unknown", False),
    ]
    assert len(found[1, "bob", 0]["masks"]) == 1 and found[1, "ann", 0]["n_turns"] == 5


def test_a_long_dialogue_comes_in_parts(spark):
    turns = spark.range(3000).selectExpr("7 AS conv_id", "id AS turn", "concat('p', id % 3) AS role", "concat('t', id) AS text")
    out = chat.rotate(turns).where("participant = 'p1'").orderBy("part").collect()
    assert [r["part"] for r in out] == list(range(12)) and max(r["n_turns"] for r in out) == 256
    whole = "".join(r["text"] for r in out)
    assert whole.count("<|assistant|>") == 1000 and all(f"t{i}<|end|>" in whole for i in range(3000))


@pytest.mark.parametrize("sent", [chat.MOST_SENT, 0])
@pytest.mark.parametrize("conv", ["NULL", "7", "IF(id % 3 = 0, NULL, id % 5)"])
@pytest.mark.parametrize("turn", ["1", "NULL", "IF(id % 2 = 0, 1, id)"])
def test_parts_are_bounded_whatever_the_numbers(spark, monkeypatch, sent, conv, turn):
    monkeypatch.setattr(chat, "MOST_SENT", sent)
    turns = spark.range(900).selectExpr(f"CAST({conv} AS int) AS conv_id", f"CAST({turn} AS int) AS turn", "concat('p', id % 2) AS role", "concat('t', id) AS text")
    out = chat.rotate(turns, part_turns=64).where("participant = 'p1'").collect()
    sizes = {r["conv_id"]: [] for r in out}
    for r in sorted(out, key=lambda r: r["part"]):
        sizes[r["conv_id"]].append(r["n_turns"])
    counts = {r["conv_id"]: r["n"] for r in turns.groupBy("conv_id").agg(F.count("*").alias("n")).collect()}
    assert {c: sum(n) for c, n in sizes.items()} == counts
    assert all(set(n[:-1]) <= {64} and 0 < n[-1] <= 64 for n in sizes.values())
    whole = sorted(m["content"] for r in out for m in r["messages"])
    assert whole == sorted(f"t{i}" for i in range(900))

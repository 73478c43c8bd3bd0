import hashlib
import random

from tracewell.llm import chat

SCHEMA = "conv_id bigint, turn bigint, role string, text string, loss string"
PARTS = ["\\", "### ", "User: ", "### User: ", " </turn>\n", "</turn>", "<", "/turn>", "#", " ", "\n", ">: ", ">", ":", "### Role <", "é"]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA).repartition(3)
    return {r.conv_id: r for r in chat.read_back(chat.formatted(df)).collect()}


def want(turns):
    said = "".join(t for r, t in turns if r == "assistant")
    return len(turns), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in turns).encode()).hexdigest(), len(said), hashlib.sha256(said.encode()).hexdigest()


def digest(r):
    return r.n_turns, r.turns_sha256, r.loss_chars, r.loss_sha256


def test_control_strings_survive(spark):
    r = random.Random(1)
    rows = [(k, t, r.choice(["user", "assistant", "system", "tool", "", "### Role <x>: "]), "".join(r.choice(PARTS) for _ in range(r.randint(0, 9)))) for k in range(80) for t in range(r.randint(1, 6))]
    rows += [(-7, 0, "user", "\\### Assistant: </turn> ok"), (-7, 1, "assistant", "\\### Assistant: </turn> ok")]
    got = run(spark, rows)
    for k in {x[0] for x in rows}:
        assert digest(got[k]) == want([(x[2], x[3]) for x in rows if x[0] == k])
    assert got[-7].loss_chars == 26 and got[-7].valid


def test_stored_segments_are_read_in_any_order(spark, tmp_path):
    rows = [(k, t, "user" if t % 2 == 0 else "assistant", f"{k} says {t}") for k in range(30) for t in range(8)]
    df = spark.createDataFrame([(*r, "x") for r in rows], SCHEMA)
    chat.formatted(df).orderBy("text").write.parquet(str(tmp_path / "s"))
    again = {r.conv_id: r for r in chat.read_back(spark.read.parquet(str(tmp_path / "s")).repartition(5)).collect()}
    straight = {r.conv_id: r for r in chat.read_back(chat.formatted(df), in_order=True).collect()}
    assert again == straight and len(again) == 30


def test_order_of_roles(spark):
    rows = [(1, 0, "system", "s"), (1, 1, "user", "u"), (1, 2, "assistant", "a"), (2, 0, "assistant", "a"), (3, 0, "user", "u"), (4, 0, "user", "u"), (4, 1, "user", "u"), (4, 2, "assistant", "a"), (5, 0, "robot", "x"), (6, 0, None, None)]
    got = {k: (r.valid, r.fault) for k, r in run(spark, rows).items()}
    assert got == {1: (True, None), 2: (False, "assistant after the start"), 3: (False, "the end after user"), 4: (False, "user after user"), 5: (False, "robot after the start"), 6: (False, "no role after the start")}


def test_nulls_ties_and_long_conversations(spark):
    rows = [(None, 0, "user", None), (None, None, "assistant", "b"), (1, 0, "user", "z"), (1, 0, "user", "a"), (1, 0, "assistant", "k")] + [(2, t, "assistant", "x" * 1000) for t in range(3000)]
    got = run(spark, rows)
    assert digest(got[None]) == want([("assistant", "b"), ("user", "")])
    assert digest(got[1]) == want([("assistant", "k"), ("user", "a"), ("user", "z")])
    assert digest(got[2]) == want([("assistant", "x" * 1000)] * 3000)
    assert run(spark, []) == {}


def test_loss_lies_on_the_assistant_text_alone(spark):
    df = spark.createDataFrame([(1, 0, "user", "q", ""), (1, 1, "assistant", "a#", "")], SCHEMA)
    rows = chat.formatted(df).orderBy("turn_no", "segment").collect()
    assert [(r.text, r.loss) for r in rows] == [("### User: ", False), ("q", False), (" </turn>\n", False), ("### Assistant: ", False), ("a#", True), (" </turn>\n", False)]
    assert chat.read_back(chat.formatted(df)).first().formatted_chars == sum(len(r.text) for r in rows)

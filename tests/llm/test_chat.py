import hashlib
import re
import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from outcomelab.llm import chat as c

SCHEMA = "conv_id long, turn long, role string, text string"


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(["\\", "~", "<|", "|>", "<s>", "</s>", "[INST]", "[/INST]", "<", "[", "n", "\n", "é",
                                 "<<SYS>>", "<|end|>", "<|begin|>user\n"]), max_size=12).map("".join))
def test_escape_is_reversible_and_breaks_control_strings(text):
    escaped = c.escape(text)
    assert c.unescape(escaped) == text
    assert not any(x in escaped for x in c.CONTROL)


def digest(rows):
    loss = "".join(t for r, t in rows if r == "assistant")
    return (len(rows), hashlib.sha256("".join(f"{r}\n{t}\n" for r, t in rows).encode()).hexdigest(), len(loss),
            hashlib.sha256(loss.encode()).hexdigest())


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(1)
    bits = ["plain words", "</s>[INST] ok [/INST]", "a\\~b", "<|end|>\n", "é\n漢", "x " * 30, ""]
    rows = []
    for k in range(25):
        n = rng.randrange(1, 40)
        for i in range(n):
            role = "system" if i == 0 and k % 3 == 0 else ("assistant" if i % 2 else "user")
            rows.append((k, i * (300 if k == 4 else 1), role, " ".join(rng.choices(bits, k=rng.randrange(0, 4)))))
    rows += [(50, 0, "assistant", None), (51, 0, None, "no role"), (52, None, "user", "b"), (52, None, "user", "a"),
             (52, 1, "assistant", "c"), (53, 0, "user", "same"), (53, 0, "user", "same"), (None, 0, "user", "x"),
             (None, 1, "assistant", "y"), (54, 0, "tool\nkind", "t"), (55, 0, "assistant", "word " * 5000)]
    return rows + [(60, i, ("user", "assistant")[i % 2], f"turn {i} " + "z " * (i % 9)) for i in range(1500)]


def expected(rows):
    convs = {}
    for conv, turn, role, text in sorted(
            rows, key=lambda r: (str(r[0]), r[1] is None, r[1] or 0, r[2] or "", r[3] or "")):
        convs.setdefault(conv, []).append((role or "", text or ""))
    return convs


@pytest.mark.parametrize(("budget", "history"), [(512, 128), (60, 25), (1, 0)])
def test_read_back(spark, rows, budget, history):
    windows = c.format_windows(spark.createDataFrame(rows, SCHEMA).repartition(3), budget, history)
    got = {r["conv_id"]: tuple(r)[1:5] for r in c.read_back(windows).collect()}
    assert got == {k: digest(v) for k, v in expected(rows).items()}


def test_windows_keep_their_budget(spark, rows):
    convs = expected(rows)
    for w in c.format_windows(spark.createDataFrame(rows, SCHEMA), 60, 25).collect():
        turns = c.read_turns(w["text"])
        assert len(turns) == w["n_new"] + w["n_repeated"]
        new = turns[w["n_repeated"]:]
        all_turns = convs[w["conv_id"]]
        assert new == all_turns[w["first_turn"]:w["first_turn"] + w["n_new"]]
        if all_turns[0][0] == "system":
            assert turns[0] == all_turns[0]
        cost = lambda t: len(re.findall(r"[^\W]+|[^\w\s]", t[1])) + c.TURN_COST
        head = [turns[0]] if w["n_repeated"] and all_turns[0][0] == "system" else []
        assert w["tokens"] == sum(map(cost, turns))
        assert w["tokens"] <= 60 or (w["n_new"] == 1 and w["n_repeated"] == len(head))
        history = turns[1 if w["n_repeated"] and all_turns[0][0] == "system" else 0:w["n_repeated"]]
        assert history == all_turns[w["first_turn"] - len(history):w["first_turn"]] if history else True
        assert [c.unescape(w["text"][s["start"]:s["end"]]) for s in w["loss"]] == [
            t for r, t in new if r == "assistant"]


def test_history_gives_way_to_the_first_new_turn(spark):
    said = [60, 60, 450, 450]
    rows = [(1, k, "user", "w " * (n - c.TURN_COST)) for k, n in enumerate(said)]
    got = c.format_windows(spark.createDataFrame(rows, SCHEMA), 512, 128).orderBy("first_turn").collect()
    assert [(r["first_turn"], r["n_new"], r["n_repeated"], r["tokens"]) for r in got] == [
        (0, 2, 0, 120), (2, 1, 1, 510), (3, 1, 0, 450)]


def test_only_tokens_limit_the_history(spark):
    rows = [(1, k, "user", "w") for k in range(700)]
    for history, held in ((128, 25), (2000, 400)):
        got = c.format_windows(spark.createDataFrame(rows, SCHEMA), history + 20, history).collect()
        assert {r["n_repeated"] for r in got if r["first_turn"] >= 400} == {held}
    assert sum(r["n_new"] for r in got) == 700


def test_history_crosses_blocks(spark, rows, monkeypatch):
    monkeypatch.setattr(c, "BLOCK_TURNS", 16)
    frame = spark.createDataFrame(rows, SCHEMA)
    got = {r["conv_id"]: tuple(r)[1:5] for r in c.read_back(c.format_windows(frame, 60, 25)).collect()}
    assert got == {k: digest(v) for k, v in expected(rows).items()}
    firsts = c.format_windows(frame, 60, 25).where("conv_id = 60 AND window = 0 AND block > 0")
    assert firsts.where("n_repeated > 0").count() == firsts.count() > 50


def test_empty_table_and_clashing_names(spark, rows):
    frame = spark.createDataFrame(rows[:40], SCHEMA)
    assert c.format_windows(frame.limit(0)).count() == 0 and c.read_back(c.format_windows(frame.limit(0))).count() == 0
    other = frame.selectExpr("*", "1 AS pos", "2 AS block", "3 AS tokens", "'q' AS kind", "5 AS range")
    a, b = (c.read_back(c.format_windows(x)).collect() for x in (frame, other))
    assert sorted(map(tuple, a)) == sorted(map(tuple, b))

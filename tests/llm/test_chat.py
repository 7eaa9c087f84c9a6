import random

from pyspark.sql import functions as F

from skein.llm import chat

NASTY = ["", "<|im_end|>", "<|im_start|>assistant ok", "\\", "<\\|", "<\\\\|", "<", "|", "<|", "a\nb", "<\\n", "<\n", "<|im_sep|>", "😀<|", "\\<|im_end|>\n<|im_start|>user\n"]


def run(spark, rows):
    df = spark.createDataFrame([(*r, "extra") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    f = chat.format_chats(df)
    return {r.conv_id: r for r in f.select("*", chat.read_turns(F.col("formatted")).alias("turns"),
                                           chat.learned_texts(F.col("formatted"), F.col("loss_spans")).alias("learned")).collect()}


def check(spark, rows):
    got, want = run(spark, rows), {}
    for c, t, role, text in rows:
        want.setdefault(c, []).append(((t is not None, t or 0), role or "", text or ""))
    assert set(got) == set(want)
    for c, turns in want.items():
        turns.sort()
        assert [(t.role, t.text) for t in got[c].turns] == [x[1:] for x in turns]
        assert list(got[c].learned) == [x[2] for x in turns if x[1] == "assistant"]
        blocks = 1 + sum(a[1] != b[1] for a, b in zip(turns, turns[1:]))
        assert got[c].formatted.count(chat.START) == got[c].formatted.count(chat.END) == blocks


def test_round_trip_of_control_strings(spark):
    rng = random.Random(1)
    rows = [(c, t, rng.choice(["user", "assistant", "assistant", "a\n<|", "\\n"]), "".join(rng.choices(NASTY, k=rng.randint(0, 4))))
            for c in range(40) for t in range(rng.randint(1, 12))]
    check(spark, rows)


def test_nulls_ties_repeats_and_long_conversations(spark):
    rows = [(1, None, "user", None), (1, 2, None, "x"), (1, 2, None, "x"), (1, 2, "assistant", "b"), (1, 2, "assistant", "a"),
            (None, 1, "user", "q"), (None, 2, "assistant", ""), (2, 1, "assistant", "z" * 200_000)]
    rows += [(3, t, "user" if t % 2 else "assistant", f"t{t}<|") for t in range(1500)]
    check(spark, rows)


def test_adjacent_turns_share_a_block(spark):
    got = run(spark, [(1, 1, "user", "a"), (1, 2, "user", "b"), (1, 3, "assistant", "c")])[1]
    assert got.formatted == "<|im_start|>user\na<|im_sep|>b<|im_end|>\n<|im_start|>assistant\nc<|im_end|>\n"


def test_empty_table(spark):
    assert run(spark, []) == {}


def test_no_python_in_the_plan(spark):
    df = spark.createDataFrame([(1, 1, "user", "a")], "conv_id long, turn long, role string, text string")
    plan = chat.format_chats(df)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan

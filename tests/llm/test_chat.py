import random

from reelframe.llm import chat

ROWS = "conv_id long, turn long, role string, text string, n_turns string, mask string"


def both(spark, rows):
    df = spark.createDataFrame(rows, ROWS)
    formatted = chat.format_chats(df)
    return {r.conv_id: r for r in formatted.collect()}, {r.conv_id: r for r in chat.read_chats(formatted).collect()}


def test_round_trip_of_hostile_texts(spark):
    rnd = random.Random(2)
    bits = ["\\", "#", "##", "###", "### ", "</turn>", "<", "/", "</", "assistant: ", "\n", "é", "\U0001F600", ":", " ", "a"]
    text = lambda: "".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12)))
    rows = [(c, t, rnd.choice(["user", "assistant", "a:b", "#x\\"]), text(), "x", "y")
            for c in range(300) for t in range(rnd.randint(1, 5))]
    formatted, read = both(spark, rows)
    for c in range(300):
        mine = [r for r in rows if r[0] == c]
        assert [(t.role, t.text) for t in read[c].turns] == [(r[2], r[3]) for r in mine]
        assert read[c].loss == [r[3] for r in mine if r[2] == "assistant"]
        assert read[c].formatted_chars == len(formatted[c].formatted)
        assert formatted[c].formatted.count("</turn>") == len(mine)  # no turn end inside a text


def test_nulls_ties_repeats_and_order(spark):
    rows = [(1, 1, "assistant", "b", "", ""), (1, None, "user", "first", "", ""), (1, 1, "assistant", "a", "", ""),
            (1, 1, "assistant", "a", "", ""), (2, 0, None, None, None, None), (None, 0, "assistant", "lost", "", ""),
            (None, 1, "user", "too", "", ""), (0, 0, "user", "zero", "", ""), (3, 0, "assistant", "x" * 300_000, "", "")]
    _, read = both(spark, rows)
    assert [(t.role, t.text) for t in read[1].turns] == [("user", "first"), ("assistant", "a"), ("assistant", "a"),
                                                         ("assistant", "b")]
    assert [(t.role, t.text) for t in read[2].turns] == [("", "")]
    assert [t.text for t in read[None].turns] == ["lost", "too"] and read[None].loss == ["lost"]
    assert [t.text for t in read[0].turns] == ["zero"]
    assert read[3].loss == ["x" * 300_000]


def test_one_conversation_over_many_batches(spark):
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        rows = [(1, t, "assistant" if t % 2 else "user", f"t{t}", "", "") for t in range(100)] + [(2, 0, "user", "z", "", "")]
        _, read = both(spark, rows)
        assert [t.text for t in read[1].turns] == [f"t{t}" for t in range(100)] and read[2].n_turns == 1
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_empty_table(spark):
    assert chat.read_chats(chat.format_chats(spark.createDataFrame([], ROWS))).count() == 0

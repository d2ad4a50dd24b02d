import random

from ramparts.llm import chat

ROWS = "conv_id long, turn long, role string, text string, mask string"
EVENTS = "conv_id long, message long, seq long, kind string, role string, text string"


def test_control_strings_come_back(spark):
    draw = random.Random(6)
    bits = ["<|end|>", "<|turn|>", "\\", "<", "|", "<\\|", "\\n", "\n", "é", "n", "</s>[INST]"]
    rows = []
    for conv in range(40):
        for turn in range(draw.randint(1, 5)):
            role = draw.choice(["user", "assistant", "".join(draw.choices(bits, k=3))])
            rows.append((conv, turn, role, "".join(draw.choices(bits, k=draw.randint(0, 12))), "m"))
    back = chat.read_back(chat.rendered(chat.folded(chat.table_events(spark.createDataFrame(rows, ROWS))))).collect()
    for row in back:
        turns = [(r, t) for c, _, r, t, _ in rows if c == row.conv_id]
        assert [tuple(t) for t in row.turns] == turns
        assert row.loss_text == "".join(t for r, t in turns if r == "assistant")


def test_nulls_ties_and_long_texts(spark):
    rows = [
        (1, 0, "user", "x" * 100_000, None), (1, 1, "assistant", "a", None), (1, 1, "assistant", "a", None), (1, None, None, None, None),
        (None, None, None, None, None), (2, 0, "assistant", "", None),
    ]
    found = {r.conv_id: r for r in chat.conversation_digests(spark.createDataFrame(rows, ROWS)).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in found.items()} == {1: (4, 2), None: (1, 0), 2: (1, 0)}
    assert chat.conversation_digests(spark.createDataFrame([], ROWS)).count() == 0


def test_deltas_edits_and_regenerations(spark):
    events = [
        (1, 0, 0, "delta", "user", "a"), (1, 0, 1, "delta", None, "b"), (1, 1, 0, "delta", "assistant", "x"),
        (1, 1, 1, "regenerate", None, "ignored"), (1, 1, 2, "delta", None, "y"), (1, 1, 3, None, None, "z"), (1, 2, 0, "delta", "user", "q"),
        (1, 2, 1, "edit", "system", "r"), (1, 2, 2, "delta", None, "s"), (1, 3, 0, "edit", None, None), (1, 4, 5, "edit", "user", "1"),
        (1, 4, 9, "edit", "user", "2"), (1, 5, 1, "delta", "u", "twice"), (1, 5, 1, "delta", "u", "twice"),
    ]
    found = chat.folded(spark.createDataFrame(events, EVENTS).repartition(4)).collect()
    assert sorted((r.message, r.role, r.text) for r in found) == [
        (0, "user", "ab"), (1, "assistant", "yz"), (2, "system", "rs"), (3, "", ""), (4, "user", "2"), (5, "u", "twicetwice"),
    ]

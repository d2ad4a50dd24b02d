import random
import re
from collections import Counter

import pytest
from pyspark.sql import functions as F

from ramparts.llm import quality

CLEAN = "This is a sentence with some words in it, said on line number {}, and it ends well."
NAVIGATION = "Home | About us | Contact | Imprint."
SHOUTED = "BUY THIS NOW AND SAVE MONEY TODAY!!"
SYMBOLIC = "buy### this*** now&&& and%%% save.$$$"
NO_END = "a line that never comes to its end"
BOILERPLATE = "We use cookies. Click here."


@pytest.mark.parametrize(
    "line, fails",
    [
        (CLEAN.format(1), False), (NAVIGATION, True), (SHOUTED, True), (SYMBOLIC, True), (NO_END, True), (BOILERPLATE, True),
        ("Yes.", False), ("NATO and UN met in the long summer.", False), ("Er sagte: „Ja.“", False),
        (CLEAN.format("with a cookie named so in the long text"), False),
    ],
)
def test_lines(spark, line, fails):
    frame = spark.createDataFrame([(line,)], "line string")
    assert frame.select(quality.line_fails(F.col("line"))).first()[0] is fails


@pytest.mark.parametrize(
    "words, n",
    [([], 0), (["a", "b"], 0), (list("abcabc"), 6), (list("aaaa"), 4), (list("aaa"), 0), (list("abcxabcdyabc"), 9), (list("abcdexcdey"), 6)],
)
def test_repeated_words(spark, words, n):
    frame = spark.createDataFrame([(words,)], "words array<string>")
    assert frame.select(quality.repeated_words(F.col("words"))).first()[0] == n


def lines(n):
    """Lines of words that do not repeat."""
    return "\n".join("The " + " ".join(f"w{i}x{j}" for j in range(14)) + " ends well." for i in range(n))


def documents(spark):
    good = lines(5)
    rows = [
        (1, good, 1, "x"), (2, good + "\n" + NAVIGATION + "\n" + good.split("\n")[1], 2, "x"), (3, None, None, None), (4, "", 0, ""),
        (5, lines(9).replace(".", ""), 3, "x"), (1, good, 1, "x"), (6, "same words here. " * 40, 4, "x"),
        (7, lines(3000), 5, "x"), (None, good, 6, "x"),
    ]
    return spark.createDataFrame(rows, "doc_id long, text string, n_chars int, Quality string")


def test_verdicts(spark):
    found = quality.quality_report(documents(spark)).collect()
    verdicts = sorted(((r.doc_id, r.base_failed, r.kept) for r in found), key=repr)
    assert verdicts == sorted(
        [(1, False, True), (1, False, True), (2, False, True), (3, True, False), (4, True, False), (5, False, False)]
        + [(6, True, False), (7, False, True), (None, False, True)],
        key=repr,
    )
    assert quality.quality_report(documents(spark).limit(0)).count() == 0


def test_cleaned_documents(spark, plan):
    docs = documents(spark)
    kept = quality.clean_documents(docs)
    assert kept.columns == docs.columns
    rows = kept.collect()
    assert sorted(str(r.doc_id) for r in rows) == ["1", "1", "2", "7", "None"]
    assert all(r.text == lines(3000 if r.doc_id == 7 else 5) and r.n_chars == len(r.text) for r in rows)
    assert plan(kept).count("transform(sequence") == 1


def test_no_array_of_single_characters_is_made(spark, plan):
    """Letters and symbols are counted without a string for each."""
    shown = plan(quality.quality_report(documents(spark)))
    assert all(f", {single}, 0)" not in shown for single in (r"\p{L}", r"\p{Lu}", r"[#*$%&|<>]"))


def test_counts_of_drawn_texts(spark):
    draw, rows = random.Random(4), []
    for i in range(400):
        parts = draw.choices(["a", "B.", "ÉÈ", "c|", " | ", "::", "\n", "\t", "  ", "\x1c", "#", "\U0001d400x", "日本。", "aA\x00"], k=i % 60)
        rows.append((i, draw.choice(["", " "]).join(p + draw.choice(["", " "]) for p in parts)))
    rows.append((400, " ".join(map(str, [*range(3000), *range(1000, 2000), 7, 7, 7, 7]))))
    found = {r.doc_id: r for r in quality.quality_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    for doc_id, text in rows:
        words, row = re.findall(r"[^\x20\x09-\x0D]+", text), found[doc_id]
        windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
        times = Counter(windows)
        covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(3)}
        expected = (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), len(covered))
        assert (row.n_words, row.word_chars, row.n_symbols, row.n_repeat_words) == expected

import random

import pytest
from hypothesis import given, settings, strategies as st

from ramparts.llm.runs import collapsed, probed, run_report, runs, with_runs


def plain_runs(words, shortest=6, times=4):
    """All maximal stretches for each period in turn; of equal stretches the smallest period counts."""
    found = {}
    for q in range(1, len(words) // times + 1):
        i = q
        while i < len(words):
            begin = i
            while i < len(words) and words[i] == words[i - q]:
                i += 1
            if i - begin + q >= max(shortest, times * q):
                found.setdefault((begin - q, i - begin + q), q)
            i = max(i, begin + 1)
    return sorted(((s, n, q) for (s, n), q in found.items()), key=lambda r: (r[0], r[2]))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.sampled_from("abc"), max_size=40), st.integers(1, 12), st.integers(0, 60), st.integers(0, 3))
def test_runs_are_those_of_every_period(words, period, more, changes):
    for _ in range(more):
        words.append(words[-period] if len(words) >= period else "a")
    for change in range(changes):
        if words:
            words[(change * 17) % len(words)] = "z"
    assert runs(words) == plain_runs(words)
    assert runs(words, 2, 3) == plain_runs(words, 2, 3)


def test_hard_texts():
    draw = random.Random(5)
    nested = (["a"] * 40 + ["b"]) * 30
    fibonacci, other = "a", "ab"
    while len(other) < 1500:
        fibonacci, other = other, other + fibonacci
    for words in (nested, list(other), [draw.choice("ab") for _ in range(2000)], ["x"] * 3000, list("ab") * 700 + list("abc") * 300):
        assert runs(words) == plain_runs(words)
    assert runs([]) == [] and runs(["a"] * 5) == [] and runs(["a"] * 6) == [(0, 6, 1)]


def test_frequent_words_cost_no_square():
    assert runs(["same"] * 200_000) == [(0, 200_000, 1)]
    assert len(runs((["a"] * 100 + ["b"]) * 1000)) == 1001


def test_a_run_stands_for_three_periods_at_least():
    with pytest.raises(ValueError):
        runs(["a"], 2, 2)


def test_collapsed_keeps_first_periods():
    words = list("xababababy")
    assert runs(words) == [(1, 8, 2)]
    assert "".join(collapsed(words, runs(words))) == "xaby"
    overlapping = list("aaaaaaaab") + list("aaaaaaaab") * 3
    dropped = {i for start, length, period in runs(overlapping) for i in range(start + period, start + length)}
    assert collapsed(overlapping, runs(overlapping)) == [w for i, w in enumerate(overlapping) if i not in dropped]


def test_rows_of_every_kind(spark):
    docs = [(1, "a b a b a b a b c", 7), (1, "a b a b a b a b c", 7), (None, "q\tq\nq q q q", 8), (2, None, 9), (3, "", 9)]
    found = with_runs(spark.createDataFrame(docs, "doc_id long, text string, Runs int"))
    assert found.columns == ["doc_id", "text", "Runs", "n_words", "_runs", "collapsed"]
    rows = sorted(((r.doc_id, r.n_words, [tuple(x) for x in r._runs], r.collapsed) for r in found.collect()), key=repr)
    assert rows == sorted(
        [(1, 9, [(0, 8, 2)], "a b c")] * 2 + [(None, 6, [(0, 6, 1)], "q"), (2, 0, [], ""), (3, 0, [], "")], key=repr
    )
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert with_runs(empty).count() == 0 and run_report(empty).count() == 0


def test_probe_leaves_what_it_does_not_draw(spark):
    import zlib

    docs = [(i, " ".join(f"w{j}" for j in range(i % 37))) for i in range(300)] + [(None, "a  b")]
    for row in probed(spark.createDataFrame(docs, "doc_id long, text string")).collect():
        words = dict(docs)[row.key].split()
        h = zlib.crc32(str(row.key).encode())
        if row.key is not None and h % 10 == 0 and words:
            g, n = h // 10, len(words)
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            words = [w if i < a else words[a + (i - a) % p] for i, w in enumerate(words)]
            assert row.text == " ".join(words)
        else:
            assert row.text == dict(docs)[row.key]

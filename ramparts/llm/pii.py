"""Pseudonyms for personal data that keep the format: a keyed Feistel permutation of each value within its domain.

Equal values get equal pseudonyms in every document, different values of a kind different ones, and whoever has the
key can turn them back. Numbers and dates count only if they pass the checks of their kind.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from datetime import date, timedelta
from hashlib import blake2b

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ramparts.llm.shared import free_name, map_batches

ROUNDS = 10
LETTERS, DIGITS, HEX = "abcdefghijklmnopqrstuvwxyz", "0123456789", "0123456789abcdef"
ACCENTED = LETTERS + "".join(map(chr, [*range(0xDF, 0xF7), *range(0xF8, 0x100)]))
FIRST_DAY, LAST_DAY = date(1900, 1, 1), date(2099, 12, 31)

EMAIL = r"(?P<email>(?<![\w.+%-])[\w.+%-]+@(?:[A-Za-z0-9-]+\.)+[A-Za-z]{2,})"
SECRET = r"(?P<secret>(?<![0-9A-Za-z])(?=[0-9A-Fa-f]*[0-9])(?=[0-9A-Fa-f]*[A-Fa-f])[0-9A-Fa-f]{32,}(?![0-9A-Za-z]))"
NAMED = r"(?i:\b(?:token|secret|password|passwd|api[_-]?key)\b\s*[=:]\s*[\"']?)(?P<named>[A-Za-z0-9_+/-]{12,})"
NUMBERS = "|".join(
    (
        r"(?P<iban>(?<![A-Za-z0-9])[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){2,7}(?: ?[A-Z0-9]{1,3})?(?![A-Za-z0-9]))",
        r"(?P<iso>(?<![\d-])\d{4}-\d{2}-\d{2}(?![\d-]))",
        r"(?P<dmy>(?<![\d./])\d{1,2}(?P<sep>[./])\d{1,2}(?P=sep)\d{4}(?![\d/]))",
        r"(?P<ip>(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\.?\d))",
        r"(?P<ssn>(?<![\d-])\d{3}-\d{2}-\d{4}(?![\d-]))",
        r"(?P<phone>(?<![\d+(])\+\d{1,3}[ .-]?(?:\(\d{2,4}\)|\d{2,4})(?:[ .-]?\d{3,4}){2}(?!\d)"
        r"|(?<![\d+(])\+\d{1,3}(?:[ .-]?\d{1,2})?(?:[ .-]\d{2}){4}(?!\d)"
        r"|(?<![\d(+])\(\d{3}\) ?\d{3}[ .-]\d{4}(?!\d)|(?<![\d.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\d-]))",
        r"(?P<card>(?<![\d-])(?:\d{4}(?P<gap>[ -])\d{4}(?P=gap)\d{4}(?P=gap)\d{4}(?:(?P=gap)\d{1,3})?"
        r"|\d{4}(?P<wide>[ -])\d{6}(?P=wide)\d{4,5}|\d{12,19})(?!\d))",
    )
)
# Where a number may begin; the long alternation is tried only there.
KINDS = ("iban", "iso", "dmy", "ip", "ssn", "phone", "card")
NUMBER_START = re.compile(r"[+(]?\d|[A-Z]{2}\d{2}")
NUMBER, TOKEN, MAIL, ASSIGNED = (re.compile(p) for p in (NUMBERS, SECRET, EMAIL, NAMED))
PLACES = T.ArrayType(T.StructType().add("kind", "string").add("first", "integer").add("last", "integer"))
# First digits of payment cards and their lengths.
CARDS = re.compile(
    r"(?:4\d{12}(?:\d{3}(?:\d{3})?)?|(?:5[1-5]|2[2-7])\d{14}|3[47]\d{13}|3[0689]\d{12,17}|35\d{14,17}|81\d{14,17}"
    r"|(?:50|5[6-8]|6\d)\d{10,17})$"
)


class Permutation:
    """Keyed permutations of digit strings in any alphabet and of ranges of numbers."""

    def __init__(self, key: bytes):
        self.key = blake2b(key, digest_size=32).digest()

    def noise(self, kind: str, turn: int, half: str, bits: int = 128) -> int:
        """A keyed hash of as many bits at least, so that no digit of a long value stays."""
        said = [f"{kind}|{turn}|{half}", *(f"{kind}|{turn}|{half}|{i}" for i in range(1, -(-bits // 128)))]
        return int.from_bytes(b"".join(blake2b(s.encode(), key=self.key, digest_size=16).digest() for s in said), "big")

    def string(self, text: str, alphabet: str, kind: str, back: bool = False) -> str:
        """A string of the same length over the same alphabet: two halves take turns in adding a keyed hash of the
        other. A string of one character is shifted by a keyed amount."""
        size, middle, place = len(alphabet), len(text) // 2, {c: i for i, c in enumerate(alphabet)}
        kind = f"{kind}|{len(text)}"

        def number(part: str) -> int:
            value = 0
            for c in part:
                value = value * size + place[c]
            return value

        def digits(value: int, length: int) -> str:
            out = []
            for _ in range(length):
                value, d = divmod(value, size)
                out.append(alphabet[d])
            return "".join(reversed(out))

        halves = [text[:middle], text[middle:]]
        for turn in reversed(range(ROUNDS)) if back else range(ROUNDS):
            side = turn % 2
            changed, other = halves[side], halves[1 - side]
            shift = self.noise(kind, turn, other, len(changed) * (size - 1).bit_length())
            value = number(changed) + (-shift if back else shift)
            halves[side] = digits(value % size ** len(changed), len(changed))
        return "".join(halves)

    def walked(self, text: str, alphabet: str, kind: str, valid: Callable[[str], bool], back: bool = False) -> str:
        """The permutation repeated until the string is valid again, which permutes the valid strings."""
        while True:
            text = self.string(text, alphabet, kind, back)
            if valid(text):
                return text

    def below(self, value: int, limit: int, kind: str, back: bool = False) -> int:
        """A permutation of the numbers below ``limit``."""
        width = len(str(limit - 1))
        return int(self.walked(str(value).zfill(width), DIGITS, kind, lambda t: int(t) < limit, back))


def accented(text: str) -> bool:
    return any(c in ACCENTED and c not in LETTERS for c in text)


def luhn_digit(payload: str) -> str:
    total = 0
    for place, digit in enumerate(reversed(payload)):
        value = int(digit) * (2 - place % 2)
        total += value - 9 * (value > 9)
    return str(-total % 10)


def iban_check(country: str, body: str) -> str:
    return f"{98 - int(''.join(str(int(c, 36)) for c in body + country + '00')) % 97:02d}"


def refilled(shape: str, characters: str) -> str:
    """``shape`` with its letters and digits replaced in order, other characters and capitals as they were."""
    new = iter(characters)
    return "".join((next(new).upper() if c.isupper() else next(new)) if c.isalnum() else c for c in shape)


class Pseudonyms:
    """Finds values and replaces each by its pseudonym. ``back`` turns pseudonyms into the values they stand for."""

    def __init__(self, key: bytes, back: bool = False):
        self.permutation, self.back = Permutation(key), back

    def same_kind(self, text: str, kind: str, with_it: str = "") -> str:
        """Letters become letters and digits digits, each where they stand. ``with_it`` makes a permutation of its
        own. Letters beyond Latin-1 stay."""
        low = [c.lower() if len(c.lower()) == 1 else c for c in text]
        alphabet = ACCENTED if accented("".join(low)) else LETTERS
        shape = "".join("a" if c in alphabet else "0" if c in DIGITS else c for c in low)
        letters = "".join(c for c in low if c in alphabet)
        digits = "".join(c for c in low if c in DIGITS)
        kind = f"{kind}|{shape}|{with_it}"
        # A word with accents gets one with accents, so that the way back knows its alphabet.
        valid = accented if alphabet is ACCENTED else lambda _: True
        new_letters = iter(self.permutation.walked(letters, alphabet, f"{kind}|a", valid, self.back))
        new_digits = iter(self.permutation.string(digits, DIGITS, f"{kind}|0", self.back))
        out = []
        for old, c in zip(text, low):
            new = next(new_digits) if c in DIGITS else next(new_letters) if c in alphabet else old
            out.append(new.upper() if old.isupper() and len(new.upper()) == 1 else new)
        return "".join(out)

    def email(self, text: str) -> str:
        name, domain = text.split("@", 1)
        return f"{self.same_kind(name, 'email', domain.lower())}@{domain}"

    def secret(self, text: str) -> str:
        new = self.permutation.string(text.lower(), HEX, "secret", self.back)
        return refilled_hex(text, new)

    def named(self, text: str) -> str:
        return self.same_kind(text, "named")

    def iban(self, text: str) -> str | None:
        plain = text.replace(" ", "")
        country, check, body = plain[:2], plain[2:4], plain[4:]
        if not 11 <= len(body) <= 30 or iban_check(country, body) != check:
            return None
        digits = "".join(c for c in body if c.isdigit())
        if not digits:
            return None
        shape = re.sub(r"\d", "0", body)
        new = iter(self.permutation.string(digits, DIGITS, f"iban|{country}|{shape}", self.back))
        body = "".join(next(new) if c.isdigit() else c for c in body)
        full = iter(country + iban_check(country, body) + body)
        return "".join(c if c == " " else next(full) for c in text)

    def day(self, value: date) -> date:
        span = (LAST_DAY - FIRST_DAY).days + 1
        return FIRST_DAY + timedelta(self.permutation.below((value - FIRST_DAY).days, span, "date", self.back))

    def iso(self, text: str) -> str | None:
        try:
            value = date.fromisoformat(text)
        except ValueError:
            return None
        return self.day(value).isoformat() if FIRST_DAY <= value <= LAST_DAY else None

    def dmy(self, text: str) -> str | None:
        separator = "." if "." in text else "/"
        first, second, year = text.split(separator)
        month_first = separator == "/" and int(second) > 12
        day, month = (second, first) if month_first else (first, second)
        try:
            value = date(int(year), int(month), int(day))
        except ValueError:
            return None
        if not FIRST_DAY <= value <= LAST_DAY:
            return None
        new = self.day(value)
        if separator == "/":
            # Only a day beyond 12 shows that the month comes first, so the new date needs one too.
            while month_first and new.day <= 12:
                new = self.day(new)
        parts = (new.month, new.day) if month_first else (new.day, new.month)
        width = 2 if len(first) == len(second) == 2 or text[0] == "0" else 1
        return separator.join([*(f"{p:0{width}d}" for p in parts), str(new.year)])

    def ip(self, text: str) -> str | None:
        parts = [int(p) for p in text.split(".")]
        if max(parts) > 255:
            return None
        value = int.from_bytes(bytes(parts), "big")
        return ".".join(map(str, self.permutation.below(value, 1 << 32, "ip", self.back).to_bytes(4, "big")))

    def ssn(self, text: str) -> str | None:
        def valid(d: str) -> bool:
            return d[:3] not in ("000", "666") and d[0] != "9" and d[3:5] != "00" and d[5:] != "0000"

        digits = text.replace("-", "")
        return refilled(text, self.permutation.walked(digits, DIGITS, "ssn", valid, self.back)) if valid(digits) else None

    def phone(self, text: str) -> str | None:
        code = re.match(r"\+\d{1,3}(?=[ .(-])", text)
        head = code[0] if code else text[:2] if text[0] == "+" else ""
        digits = "".join(c for c in text[len(head) :] if c.isdigit())
        if not 7 <= len(digits) <= 12:
            return None
        return head + refilled(text[len(head) :], self.permutation.string(digits, DIGITS, "phone", self.back))

    def card(self, text: str) -> str | None:
        digits = "".join(c for c in text if c.isdigit())
        if not CARDS.match(digits) or luhn_digit(digits[:-1]) != digits[-1]:
            return None
        valid = lambda d: bool(CARDS.match(d + "0"))
        payload = self.permutation.walked(digits[:-1], DIGITS, "card", valid, self.back)
        return refilled(text, payload + luhn_digit(payload))

    def replaced(self, text: str) -> tuple[str, list[tuple[str, int, int]]]:
        """The text with pseudonyms, and the kind and place of each value in the text given (code points)."""
        found = [*self.mails(text), *self.secrets(text), *self.numbers(text)]
        found.sort(key=lambda f: (f[0], -f[1]))
        out, places, at = [], [], 0
        for first, last, kind, new in found:
            if first >= at:
                out += [text[at:first], new]
                places.append((kind, first, last))
                at = last
        return "".join([*out, text[at:]]), places

    def mails(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        at = text.find("@")
        while at >= 0:
            first = at
            while first and (text[first - 1].isalnum() or text[first - 1] in "_.+%-"):
                first -= 1
            if match := MAIL.match(text, first):
                yield *match.span(), "email", self.email(match[0])
            at = text.find("@", at + 1)

    def secrets(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        for match in TOKEN.finditer(text):
            yield *match.span(), "secret", self.secret(match[0])
        for match in ASSIGNED.finditer(text):
            if not TOKEN.fullmatch(match["named"]):
                yield *match.span("named"), "named", self.named(match["named"])

    def numbers(self, text: str) -> Iterator[tuple[int, int, str, str]]:
        """Values that pass their checks. What fails them is passed over only to the end of its first digits."""
        at = 0
        while start := NUMBER_START.search(text, at):
            match = NUMBER.match(text, start.start())
            kind = next((k for k in KINDS if match and match[k] is not None), None)
            new = getattr(self, kind)(match[0]) if kind else None
            if new is not None:
                yield *match.span(), kind, new
                at = match.end()
            else:
                at = start.start() + 1
                while text[at - 1].isdigit() and at < len(text) and text[at].isdigit():
                    at += 1


def refilled_hex(shape: str, new: str) -> str:
    """Hexadecimal digits in capitals where the value has its letters in capitals."""
    return new.upper() if any(c.isupper() for c in shape) else new


def pseudonymised(docs: DataFrame, key: bytes, text: str = "text", places: str | None = None, back: bool = False) -> DataFrame:
    """``docs`` with pseudonyms in its texts. ``places`` names an added column of (kind, first, last).

    Null texts stay null. With ``back`` and the same key the values come back.
    """
    schema = docs.schema
    if places:
        schema = docs.select("*").schema.add(places, PLACES)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        worker, texts, spots = Pseudonyms(key, back), [], []
        for value in batch.column(text):
            value = value.as_py()
            new, found = (None, []) if value is None else worker.replaced(value)
            texts.append(new)
            spots.append([{"kind": kind, "first": a, "last": b} for kind, a, b in found])
        columns = [pa.array(texts, pa.string()) if n == text else batch.column(n) for n in batch.schema.names]
        if places:
            kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("last", pa.int32())]))
            columns.append(pa.array(spots, kind))
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(docs, run, schema)


def with_length(docs: DataFrame, text: str = "text", n_chars: str = "n_chars") -> DataFrame:
    """``n_chars``, where it exists, set to the length of the text."""
    if n_chars not in docs.columns:
        return docs
    return docs.withColumn(n_chars, F.length(F.col(f"`{text}`")).cast(docs.schema[n_chars].dataType))


def private_documents(docs: DataFrame, key: bytes, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, text, n_values, kinds): texts with pseudonyms, a row for each row of ``docs``."""
    wanted = docs.select(F.col(f"`{id_column}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    name = free_name(wanted.columns, "places")
    found = pseudonymised(wanted, key, "text", name)
    kinds = F.array_join(F.sort_array(F.array_distinct(F.transform(name, lambda p: p["kind"]))), ",")
    return found.select("doc_id", "text", F.size(name).cast("long").alias("n_values"), kinds.alias("kinds"))

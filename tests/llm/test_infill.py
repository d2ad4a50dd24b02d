import hashlib

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ramparts.llm.infill import Rates, infill_report, infilled, restored, with_infill


def plain_infill(text, key, rates):
    """Cut by hand: lines end behind each line feed, the last at the end."""
    units, unit = [], ""
    for char in text:
        unit += char
        if char == "\n":
            units.append(unit)
            unit = ""
    units += [unit] if unit else []
    digest = hashlib.sha256(f"{rates.seed}:{key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(digest[8 * i : 8 * i + 8], 16) for i in range(4))
    n = len(units)
    if text == "" or "<P>" in text or "<S>" in text or "<M>" in text or h3 % 100 >= rates.changed:
        return n, "plain", None, None, text
    low, high = min(h1 % (n + 1), h2 % (n + 1)), max(h1 % (n + 1), h2 % (n + 1))
    prefix, middle, suffix = "".join(units[:low]), "".join(units[low:high]), "".join(units[high:])
    form = "spm" if h4 % 100 < rates.spm else "psm"
    whole = f"<S>{suffix}<P>{prefix}<M>{middle}" if form == "spm" else f"<P>{prefix}<S>{suffix}<M>{middle}"
    return n, form, len(prefix), len(middle), whole


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet="ab\n\r<PSM>\u2028é😀", max_size=40), st.integers(0, 999), st.sampled_from([(7, 100, 50), (1, 40, 0), (2, 90, 100)]))
def test_cuts_match_plain_python(text, key, rates):
    assert infilled(text, str(key), Rates(*rates)) == plain_infill(text, key, Rates(*rates))


def test_long_texts():
    for text in ("line\n" * 200_000, "x" * 2_000_000, "\n" * 100_000):
        assert infilled(text, "5", Rates()) == plain_infill(text, 5, Rates())


def test_every_row_comes_back(spark):
    texts = [None, "", "a", "a\nb\nc", "<\n<P\n>", "ends <S> inside", "\n\n", "é😀\r\nx<", "<P"] * 3
    docs = [(i, t, "n") for i, t in enumerate(texts)] + [(None, "x\ny", "n"), (1, "", "n"), (1, "", "n")]
    found = with_infill(spark.createDataFrame(docs, "doc_id long, text string, N string"))
    assert found.columns == ["doc_id", "text", "N", "_n", "form", "prefix_chars", "middle_chars", "output"]
    rows = found.select("*", restored(F.col("output"), F.col("form")).alias("back")).collect()
    assert len(rows) == len(docs)
    assert all(r.back == (r.text or "") for r in rows)
    key = {r.doc_id: tuple(r[3:8]) for r in rows}
    assert all(key[d] == plain_infill(t or "", "null" if d is None else d, Rates()) for d, t, _ in docs)
    assert {r.form for r in rows} == {"plain", "psm", "spm"}
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert with_infill(empty).count() == 0 and infill_report(empty).count() == 0

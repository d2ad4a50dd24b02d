from collections import defaultdict

import pytest

from ramparts.llm import warc
from ramparts.session import scratch_path

PAGES = "page_id long, url string, html string, key string"


def sample():
    rows = [(i, f"http://WWW.h{i % 7}.org/p{i % 11}?q#f", f"<p>é {i % 13}</p>" * (i % 5)) for i in range(120)]
    return rows + [
        (9000, "http://a.b/", None), (9000, "http://a.b/", ""), (9001, None, "dup"), (9002, "http://a.b/\n x", "dup"),
        (None, "u", None), (9002, "x", "dup"), (1, "https://u@h:8/?x", "y" * 200_000),
    ]


def expected(rows):
    ids, out = defaultdict(list), []
    for page_id, _, html in rows:
        ids[html or ""].append(page_id)
    for page_id, _, html in rows:
        payload = (html or "").encode()
        owner = max((i for i in ids[html or ""] if i is not None), default=None)
        kind = ("response", None) if page_id == owner else ("revisit", owner)
        out.append((page_id, len(payload), warc.payload_digest(payload), *kind))
    return sorted(out, key=repr)


def test_records_come_back(spark, monkeypatch):
    monkeypatch.setattr(warc, "BLOCK_LINES", 3)
    frame = spark.createDataFrame([(*r, "k") for r in sample()], PAGES)
    assert sorted(map(tuple, warc.archived_pages(frame).collect()), key=repr) == expected(sample())
    assert warc.archived_pages(frame.limit(0)).count() == 0


def test_lookup_reads_what_was_captured(spark):
    folder = scratch_path(spark, "test-warc")
    pages = spark.createDataFrame([(*r, "k") for r in sample()], PAGES).fillna({"html": ""})
    captures = warc.write_archives(warc.with_responses(pages), f"{folder}/a")
    manifest = warc.write_index(captures, f"{folder}/i")
    wanted = spark.createDataFrame([("http://www.H3.org/p3?q",), ("http://nowhere/",), ("https://u@h:8/?x#y",)], "url string")
    found = warc.lookup(wanted, manifest, f"{folder}/i", f"{folder}/a").collect()
    key = warc.sort_key("http://www.h3.org/p3?q")
    assert sorted(r.page_id for r in found if "H3" in r.url) == sorted(i for i, u, _ in sample() if warc.sort_key(u) == key)
    assert [r.page_id for r in found if "u@h" in r.url] == [1] and not [r for r in found if "nowhere" in r.url]


@pytest.mark.parametrize(
    "url, key",
    [("http://WWW.a.org/x?y#z", "org,a,www)/x?y"), ("https://a.org", "org,a)/"), (None, ")/"), ("a.b?c", "b,a)?c"), ("x://", ")/")],
)
def test_sort_key(url, key):
    assert warc.sort_key(url) == key


def test_damage_is_seen():
    packed = warc.record(1, "http://a/\r\nX: y", b"abc", warc.payload_digest(b"abd"), None, False)
    with pytest.raises(ValueError):
        warc.capture(packed)
    headers, _ = warc.parsed(packed)
    assert headers["warc-target-uri"] == "http://a/%0D%0AX:%20y" and "x" not in headers

import re

from ramparts.llm import urls

CASES = [
    ("http://a.net/x", "a.net", "/x", "net/"), ("https://NET/", "net", "/", "net/"), ("http://net", "net", "", None),
    ("http://www.example.net/en/1", "www.example.net", "/en/1", "example.net/en/"), ("http://anet/", "anet", "/", None),
    ("http://example.net/EN/1", "example.net", "/EN/1", "net/"), ("//x/y", "", "", None), (None, "", "", None), ("", "", "", None),
    ("http://b.org/fr/?q=://c", "b.org", "/fr/", "org/fr/"), ("x://example.com/de/#a", "example.com", "/de/", "example.com/de/"),
    ("http://b.org/fr", "b.org", "/fr", None), ("http://notexample.com/de/x", "notexample.com", "/de/x", None),
    ("http://a.com?x/net/", "a.com", "", None), ("http://É.com/\n/x", "É.com", "/\n/x", None),
]
LABELS = "doc_id long, quality int, toxic int"


def test_parts_and_listed_rules(spark):
    pages = spark.createDataFrame([(i, c[0], "x") for i, c in enumerate(CASES)], "page_id long, url string, rule string")
    found = urls.verdicts(pages, spark.createDataFrame([], LABELS)).collect()
    listed = dict(urls.LISTED)
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in found}
    assert got == {i: (c[1], c[2], c[3], listed.get(c[3], "allow")) for i, c in enumerate(CASES)}
    assert urls.verdicts(pages.limit(0), spark.createDataFrame([], LABELS)).count() == 0


def plain_rules(baskets, support, confidence):
    """All token sets, by counting."""
    from collections import Counter
    from itertools import combinations

    sets, both, n = Counter(), Counter(), len(baskets)
    for tokens, verdict in baskets:
        for size in range(1, len(tokens) + 1):
            for part in combinations(sorted(tokens), size):
                sets[part] += 1
                both[part, verdict] += 1
    rules = {(part, v): c / sets[part] for (part, v), c in both.items() if c >= support * n and c / sets[part] >= confidence}
    return {
        (" ".join(part), v)
        for (part, v), c in rules.items()
        if not any(v == w and set(other) < set(part) and d >= c for (other, w), d in rules.items())
    }


def test_mined_rules_and_their_index(spark, monkeypatch):
    monkeypatch.setattr(urls, "LEAST_PAGES", 5)
    pages, labels = [], []
    for i in range(240):
        host, folder = ("spam", "x") if i % 3 == 0 else (f"h{i % 5}", ["x", "y"][i % 2])
        pages.append((i, f"https://www.{host}.info/{folder}/{i}"))
        bad = host == "spam" or (folder == "y" and i % 5 == 1)
        labels.append((i, 0 if bad else 1, None if i % 7 else 0))
    pages += [(1000, "https://www.spam.info/z/1"), (1001, "http://new.info/"), (1001, "http://new.info/"), (None, None)]
    p, marks = spark.createDataFrame(pages, "page_id long, url string"), spark.createDataFrame(labels + [(None, 1, 1), (5000, 0, 0)], LABELS)
    tokens = {r.url: r.tokens for r in urls.with_tokens(p).collect()}
    # A page whose toxic mark is null is labelled only if its quality says enough.
    known = [(i, q, t) for i, q, t in labels if q == 0 or t is not None]
    baskets = [(tokens[pages[i][1]], "block" if q == 0 or t == 1 else "allow") for i, q, t in known]
    rules = urls.mined_rules(spark.createDataFrame(baskets, "tokens array<string>, verdict string"), 0.05, 0.9)
    assert {(r.rule, r.verdict) for r in rules.collect()} == plain_rules(baskets, 0.05, 0.9)
    found = {r.page_id: r for r in urls.verdicts(p, marks).collect()}
    assert found[1000].verdict == "block" and "domain=spam.info" in found[1000].mined_rule
    assert found[None].verdict == "allow" and len(urls.verdicts(p, marks).collect()) == len(pages)


def test_few_pages_make_no_rule(spark):
    few = spark.createDataFrame([(["domain=a.b"], "block")] * (urls.LEAST_PAGES - 1), "tokens array<string>, verdict string")
    assert urls.mined_rules(few).count() == 0


def test_tokens_are_bounded(spark):
    long = "http://" + ".".join("abc" for _ in range(500)) + "/" + "/".join("d" * 3 for _ in range(3000)) + ".html?a=1&b=2#x"
    (row,) = urls.with_tokens(spark.createDataFrame([(long,)], "url string")).collect()
    assert len(row.tokens) <= 9 and all(re.match("[a-z0-9]+=", t) for t in row.tokens)


def test_every_part_of_a_url_can_make_a_rule(spark):
    bad = ["https://m.casino-win.example{0}.com/p/{0}", "http://a{0}.info/x/y/deep/{0}", "http://b{0}.info/{0}?a=1&bad={0}", "http://c{0}.info/{0}/last"]
    fine = ["https://m.fine.example{0}.com/p/{0}", "http://a{0}.info/x/y/ok/{0}", "http://b{0}.info/{0}?a=1&ok={0}", "http://c{0}.info/{0}/first"]
    seen = [(1000 * k + i, u.format(i)) for k, u in enumerate(bad) for i in range(30)]
    good = [(9000 + 1000 * k + i, u.format(i)) for k, u in enumerate(fine) for i in range(30)]
    new = ["https://blog.casino-win.example99.com/", "http://n.info/q/r/s/deep/1", "http://n.info/?x=1&y&bad=2", "http://n.info/last"]
    pages = spark.createDataFrame(seen + good + [(-1 - i, u) for i, u in enumerate(new)], "page_id long, url string")
    marks = spark.createDataFrame([(i, 0, 0) for i, _ in seen] + [(i, 1, 0) for i, _ in good], LABELS)
    found = {r.page_id: (r.verdict, r.mined_rule) for r in urls.verdicts(pages, marks).collect()}
    for i, token in enumerate(["anylabel=casino-win", "anyfolder=deep", "anyname=bad", "anyfolder=last"]):
        assert found[-1 - i][0] == "block" and token in found[-1 - i][1]
    assert found[9001][0] == "allow"

import random

import numpy as np
import pytest
from llm import plain

from ramparts.llm.components import components
from ramparts.llm.simhash import SHARD_MASKS, BkTree, linked_prints, near_duplicates, one_of_each_group, tree_links

DOCS = "doc_id long, text string, Fingerprint string, root string"


def frame(spark, docs):
    return spark.createDataFrame([(d, t, "x", "y") for d, t in docs], DOCS)


def sample():
    draw = random.Random(3)
    base = [f"w{draw.randrange(500)}" for _ in range(300)]
    docs = [(100 - n, " ".join(base[:n] + ["changed"] + base[n + 1 :])) for n in range(0, 60, 3)]
    return docs + [
        (1, None), (2, ""), (3, " \t\n"), (None, "ONE two"), (7, "one TWO"), (7, "one two"), (None, None), (8, "É a"),
        (9, "é a"), (10, "same " * 5000),
    ]


def test_groups_match_plain_python(spark):
    docs = sample()
    found = near_duplicates(frame(spark, docs))
    assert found.columns[:3] == ["doc_id", "fingerprint", "component_id"]
    assert sorted(map(tuple, found.collect()), key=repr) == sorted(plain.groups(docs), key=repr)


def test_no_documents(spark):
    empty = frame(spark, sample()[:1]).limit(0)
    assert near_duplicates(empty).count() == 0 and one_of_each_group(empty).count() == 0


def test_one_document_of_each_group_stays(spark):
    docs = sample()
    kept = one_of_each_group(frame(spark, docs))
    assert kept.columns == ["doc_id", "text", "Fingerprint", "root"]
    expected = {}
    for (doc_id, text), (_, print_, component) in zip(docs, plain.groups(docs)):
        order = (doc_id is None, doc_id or 0, text is not None, text or "")
        group = component if component is not None else print_
        expected[group] = min(expected.get(group, order), order)
    assert sorted((r.doc_id is None, r.doc_id or 0, r.text is not None, r.text or "") for r in kept.collect()) == sorted(
        expected.values()
    )


def test_columns_without_an_order_are_kept(spark):
    docs = spark.createDataFrame([(2, "a b c", {"x": 1}, [1]), (1, "a b c", {"y": 2}, [2]), (3, "q", None, None)],
                                 "doc_id long, text string, tags map<string,int>, `my list` array<int>")
    kept = one_of_each_group(docs)
    assert kept.schema.simpleString() == docs.schema.simpleString()
    assert sorted((r.doc_id, r.tags, r["my list"]) for r in kept.collect()) == [(1, {"y": 2}, [2]), (3, None, None)]


@pytest.mark.parametrize("size", [1, 2, 40, 1500])
def test_tree_finds_all_near_prints(size):
    draw = np.random.default_rng(size)
    prints = np.unique(draw.integers(0, 1 << 10, size).astype(np.uint64))
    queries = draw.integers(0, 1 << 10, 50).astype(np.uint64)
    tree, found = BkTree(prints), set()
    for node, hits in tree.near(queries, 2):
        found |= {(int(prints[node]), int(h)) for h in hits}
    expected = {(int(p), i) for p in prints for i, q in enumerate(queries) if bin(int(p) ^ int(q)).count("1") <= 2}
    assert found == expected
    for node, children in enumerate(tree.children):
        for distance, child in children.items():
            assert bin(int(prints[node]) ^ int(prints[child])).count("1") == distance


def test_shards_lose_no_link(spark):
    draw = random.Random(9)
    centres = [draw.getrandbits(64) for _ in range(30)]
    prints = {c ^ (1 << draw.randrange(64)) ^ (1 << draw.randrange(64)) for c in centres for _ in range(20)} | set(centres)
    assert len(SHARD_MASKS) == 28 and all(bin(m).count("1") == 48 for m in SHARD_MASKS)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    links = linked_prints(spark.createDataFrame(signed, "fingerprint long"))
    roots = {r.node: r.root for r in components(links).collect()}
    ordered = np.array(sorted(prints), np.uint64)
    members, firsts = tree_links(ordered)
    together = dict(zip(members.tolist(), firsts.tolist()))
    group = lambda p: together.get(p, p)
    unsigned = lambda p: p & ((1 << 64) - 1)
    mine = {}
    for p in ordered.tolist():
        signed_p = p - (1 << 64) if p >> 63 else p
        mine.setdefault(unsigned(roots.get(signed_p, signed_p)), set()).add(p)
    theirs = {}
    for p in ordered.tolist():
        theirs.setdefault(group(p), set()).add(p)
    assert sorted(map(sorted, mine.values())) == sorted(map(sorted, theirs.values()))


def test_components_of_a_chain_and_a_hub(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(50)] + [(7, 7), (3, 2), (2, 3), (None, 1)]
    found = {r.node: r.root for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert found == {**{i: 0 for i in range(1, 41)}, **{100 + i: 100 for i in range(1, 50)}}

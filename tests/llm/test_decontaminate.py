import random

from llm import plain
from pyspark.sql import functions as F

from ramparts.llm import decontaminate as dc


def sample():
    draw = random.Random(4)
    words = [f"t{i}" for i in range(30)]
    items = [(i, " ".join(draw.choices(words, k=n))) for i, n in enumerate([1, 3, 12, 13, 14, 30, 60])]
    items += [(3, "other words of item three"), (None, "nameless thing here"), (50, None), (51, ""), (52, "...")]
    docs = [(i, " ".join(draw.choices(words, k=draw.randint(0, 80)))) for i in range(30)]
    docs += [(40 + i, f"before {text} after, {text.upper()}!") for i, (_, text) in enumerate(items) if text]
    docs += [(None, None), (None, items[4][1]), (5, ""), (5, "a" * 20000), (6, "Éé-x nameless-thing HERE")]
    return docs, items


def frames(spark, docs, items):
    return (
        spark.createDataFrame([(d, t, "k") for d, t in docs], "doc_id long, text string, segment string"),
        spark.createDataFrame(items, "item_id long, text string"),
    )


def found(rows):
    return sorted(((None if r.key is None else int(r.key), *tuple(r)[1:]) for r in rows.collect()), key=repr)


def test_against_plain_python(spark):
    docs, items = sample()
    d, b = frames(spark, docs, items)
    assert found(dc.contamination(d, b, F.col("doc_id"))) == sorted(plain.contamination(docs, items), key=repr)


def test_many_segments_and_blocks_change_nothing(spark, monkeypatch):
    docs, items = sample()
    d, b = frames(spark, docs, items)
    before = found(dc.contamination(d, b, F.col("doc_id")))
    monkeypatch.setattr(dc, "BLOCK_CHARS", 100)
    assert found(dc.contamination(d.repartition(5), b, F.col("doc_id"))) == before


def test_empty_tables(spark):
    d, b = frames(spark, *sample())
    assert dc.contamination(d.limit(0), b, F.col("doc_id")).count() == 0
    clean = dc.contamination(d, b.limit(0), F.col("doc_id"))
    assert clean.count() == d.count() and clean.filter("contaminated or n_hit > 0").count() == 0


def test_clean_documents_are_judged_by_their_text(spark):
    docs, items = sample()
    d, b = frames(spark, docs, items)
    kept = dc.clean_documents(d, b)
    assert kept.columns == d.columns
    clean = [row[:2] for row, verdict in zip(docs, plain.contamination(docs, items)) if not verdict[-1]]
    assert sorted(((r.doc_id, r.text) for r in kept.collect()), key=repr) == sorted(clean, key=repr)


def test_packed_segment_is_the_same():
    segment = dc.Segment.of([[b"a", b"b", b"a"], [], [b"b"]])
    again = dc.Segment.unpacked(segment.packed())
    assert again.ids == segment.ids and again.postings(0).tolist() == [0, 2] and again.postings(1).tolist() == [1, 5]
    assert dc.phrase_starts(again, [0, 1]).tolist() == [0] and dc.phrase_starts(again, [1, 1]).tolist() == []


def test_proximity(spark):
    d = spark.createDataFrame([(1, "x beta y alpha z gamma"), (2, "alpha " + "x " * 9 + "beta gamma"), (3, "alpha beta")], "doc_id long, text string")
    b = spark.createDataFrame([(1, "alpha beta gamma")], "item_id long, text string")
    index = dc.build_index(d, F.col("doc_id"))
    near = dc.search(index, b, slack=2).select("key", "first", "last").collect()
    assert [tuple(r) for r in near] == [("1", 1, 6)]
    assert dc.search(index, b).count() == 0

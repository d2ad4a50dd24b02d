import random
import zlib

import numpy as np
import pytest

from ramparts.llm import toxicity
from ramparts.llm.shared import table
from ramparts.llm.toxicity import Features, Model, fitted, labelled, offending_sentences, scored, slopes, with_scores

NASTY = "grimwort slagbeard fouljaw".split()


def corpus(n=900, seed=4):
    """Texts of random words; a third carry one sentence with a nasty word (inflected), and are toxic."""
    draw, docs = random.Random(seed), []
    for i in range(n):
        lines = [" ".join(f"w{draw.randrange(400)}" for _ in range(8)) for _ in range(draw.randrange(1, 9))]
        toxic = int(draw.random() < 0.33)
        if toxic:
            lines.insert(draw.randrange(len(lines) + 1), f"you {draw.choice(NASTY)}{draw.choice(['', 's', 'ling'])} w1 w2")
        docs.append((i, ". ".join(lines) + ".", toxic))
    return docs


def area(scores, labels):
    order = {s: r for r, s in enumerate(sorted(set(scores)))}
    ones, zeros = ([order[s] for s, y in zip(scores, labels) if y == k] for k in (1, 0))
    return sum((a > b) + (a == b) / 2 for a in ones for b in zeros) / (len(ones) * len(zeros))


@pytest.fixture(scope="module")
def trained(spark):
    rows = spark.createDataFrame(corpus(), "doc_id long, text string, label int")
    return fitted(rows.select("label", "text").repartition(3))


def test_learns_sentences_from_document_labels(spark, trained):
    docs = corpus(300, 9)
    frame = spark.createDataFrame([d[:2] for d in docs], "doc_id long, text string")
    found = {r.doc_id: r for r in with_scores(frame, trained).collect()}
    assert area([found[d].score for d, _, _ in docs], [y for *_, y in docs]) > 0.99
    assert np.mean([(found[d].score >= 0.5) == y for d, _, y in docs]) > 0.97
    for d, text, toxic in docs:
        worst = text[found[d].worst_start :][: found[d].worst_chars]
        assert not toxic or any(word in worst for word in NASTY)
    located = offending_sentences(frame, trained).collect()
    assert {r.doc_id for r in located} >= {d for d, _, y in docs if y and found[d].n_offending}
    assert all(any(word in r.sentence for word in NASTY) for r in located)
    assert all(dict(d[:2] for d in docs)[r.doc_id][r.start :].startswith(r.sentence) for r in located)


def test_slopes_are_those_of_the_loss():
    draw = np.random.default_rng(2)
    label, bare, counts = np.array([0, 1, 1, 0]), np.array([2, 0, 1, 3]), np.array([2, 3, 1, 0])
    sizes = np.array([1, 2, 2, 1, 3, 1])
    features = draw.integers(0, 4, sizes.sum())
    model = Model({f: float(w) for f, w in enumerate(draw.normal(size=4))}, -1.3)

    def loss(m):
        total, place, sentence = 0.0, 0, 0
        for y, b, n in zip(label, bare, counts):
            clean = (1 / (1 + np.exp(m.bias))) ** b
            for _ in range(n):
                odds = m.bias + sum(m.weights[f] for f in features[place : place + sizes[sentence]].tolist())
                clean /= 1 + np.exp(odds)
                place, sentence = place + sizes[sentence], sentence + 1
            total -= np.log(1 - clean) if y else np.log(clean)
        return total

    named, slope, curve = slopes(label, bare, sizes, counts, features, model)
    for f, found in zip(named.tolist(), slope):
        e = 1e-5
        up, down = (Model({**model.weights, **({f: model.weights[f] + s} if f >= 0 else {})}, model.bias + (s if f < 0 else 0)) for s in (e, -e))
        assert found == pytest.approx((loss(up) - loss(down)) / (2 * e), rel=1e-4)
    assert (curve > 0).all()


def test_noisy_or_of_sentences():
    weights = {f: 2.0 for f in Features()["bad"]}
    features, model = Features(frozenset(weights)), Model(weights, -3.0)
    p, q = 1 / (1 + np.exp(3 - 2)), 1 / (1 + np.exp(3))
    row = scored("Fine here. Bad, bad! \nfine", model, features)
    assert row == (pytest.approx(1 - (1 - p) * (1 - q) ** 2, abs=1e-8), 3, 0, 10, 9, pytest.approx(p, abs=1e-8))
    for text in ("", " \n", "?!"):
        assert scored(text, model, features) == (pytest.approx(q, abs=1e-8), 0, 0, None, None, None)


def test_rows_of_every_kind(spark, trained):
    docs = [(1, None, "s"), (None, "", "s"), (2, "you fouljaw w1 w2", "s"), (2, "you fouljaw w1 w2", "s"), (3, "w1 w2. " * 20_000, "s")]
    found = with_scores(spark.createDataFrame(docs, "doc_id long, text string, Score string"), trained)
    assert found.columns[:4] == ["doc_id", "text", "Score", "_score"]
    rows = found.collect()
    assert len(rows) == 5 and all(0 <= r._score <= 1 for r in rows)
    assert rows[2] == rows[3] and rows[2]._score >= 0.5
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert with_scores(empty, trained).count() == 0 and offending_sentences(empty, trained).count() == 0


def test_labels_of_every_kind(spark, monkeypatch):
    docs = spark.createDataFrame([(1, "a"), (1, "b"), (2, "c"), (3, "d"), (None, "e")], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), (2, 0), (2, None), (3, None), (None, 1)], "doc_id long, toxic int")
    assert sorted(map(tuple, labelled(docs, labels).collect())) == [(0, "c"), (1, "a"), (1, "b")]
    monkeypatch.setattr(toxicity, "SENT_LABELS", 0)
    assert sorted(map(tuple, labelled(docs, labels).collect())) == [(0, "c"), (1, "a"), (1, "b")]
    nothing = toxicity.toxicity_report(docs, labels.limit(0))
    assert nothing.count() == 5 and nothing.filter("predicted = 1").count() == 0
    of_one_kind = fitted(spark.createDataFrame([(1, "x y"), (1, "z")], "label int, text string"), 5)
    assert of_one_kind.weights == {} and of_one_kind.bias > toxicity.START


def test_held_out_labels_of_the_whole_table(spark, sf_dir):
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    rows = toxicity.toxicity_report(docs, labels).collect()
    assert len(rows) == docs.count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    changed = labels.withColumn("toxic", toxicity.held_out().cast("int").bitwiseXOR(labels.toxic))
    again = toxicity.toxicity_report(docs, changed).collect()
    assert sorted(map(tuple, rows), key=repr) == sorted(map(tuple, again), key=repr)

"""Toxicity by multiple-instance learning: a document is toxic if one of its sentences is, and only documents have labels.

A sentence's probability is a logistic function of its words; a document's is the noisy-or of its sentences,
1 - (1 - p1)(1 - p2)... Both are trained from document labels alone, and the sentence probabilities then
tell which sentences are meant.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

from ramparts.llm.shared import KEPT_BY_WORKER, Kept, free_name, map_batches, map_in_arrow

SENTENCE, WORD = re.compile(r"[^.!?…。！？\n]+"), re.compile(r"\w+")
# A word counts as itself and by its first letters, so that inflected forms share what they have in common.
PREFIXES = (4, 6)
# Words are told apart by this many bits of their CRC-32. That bounds the model, whatever the corpus.
BITS = 18
# A word is a feature if documents with and without it differ by this many standard errors in their labels.
LEAST_DOCS, LEAST_ERRORS = 5, 4.0
ROUNDS, RIDGE, START, STEEPEST = 30, 1.0, -5.0, 15.0
WORDS_HELD = 1 << 19
# Labels are sent to where the texts are while there are no more than these; beyond that, texts are shuffled, once.
SENT_LABELS = 1_000_000


@dataclass(frozen=True)
class Model:
    """Log-odds of a sentence: ``bias`` and what each of its features adds."""

    weights: dict[int, float] = field(default_factory=dict)
    bias: float = START


class Features(dict):
    """Features of a word, made when first asked for; with ``wanted``, those among them."""

    def __init__(self, wanted=None):
        super().__init__()
        self.wanted = wanted

    def __missing__(self, word: str) -> tuple[int, ...]:
        if len(self) >= WORDS_HELD:
            self.clear()
        parts = [word, *(f"^{word[:n]}" for n in PREFIXES if len(word) > n)]
        found = {zlib.crc32(part.encode("utf-8", "surrogatepass")) & ((1 << BITS) - 1) for part in parts}
        made = self[word] = tuple(sorted(found if self.wanted is None else found & self.wanted))
        return made


@lru_cache(maxsize=1)
def features_among(wanted: frozenset[int]) -> Features:
    """One for each worker, which keeps its words from task to task."""
    return Features(wanted)


KEPT_BY_WORKER[__name__] = features_among.cache_clear


def sentences(text: str, features: Features) -> Iterator[tuple[int, int, set[int]]]:
    """(start, end, features) of each sentence that has a word."""
    made = features.__getitem__
    for match in SENTENCE.finditer(text):
        words = WORD.findall(match[0].lower())
        if words:
            yield match.start(), match.end(), set().union(*filter(None, map(made, words)))


def sentence_odds(model: Model, found: set[int]) -> float:
    return model.bias + sum(model.weights[f] for f in sorted(found))


def noisy_or(odds: np.ndarray) -> float:
    """Probability that one sentence at least is toxic, of sentences with these log-odds."""
    return float(-np.expm1(-np.logaddexp(0, odds).sum()))


def _screened(rows: DataFrame) -> list[int]:
    """Features whose documents have other labels than chance explains, from counts over all rows of (label, text)."""

    def presence(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features, counts = Features(), np.zeros((2, 1 << BITS), np.int64)
        docs = np.zeros(2, np.int64)
        for batch in batches:
            for label, text in zip(batch.column("label"), batch.column("text")):
                label = label.as_py()
                words = set(WORD.findall((text.as_py() or "").lower()))
                counts[label, list({f for w in words for f in features[w]})] += 1
                docs[label] += 1
        named = np.flatnonzero(counts.any(axis=0))
        both = [np.append(counts[label, named], docs[label]) for label in (0, 1)]
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.append(named, -1), pa.int32()), *map(pa.array, both)], names=["feature", "clean", "toxic"]
        )

    found = map_in_arrow(rows, presence, "feature int, clean long, toxic long")
    table = found.groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic")).toArrow()
    feature, clean, toxic = (table.column(c).to_numpy() for c in ("feature", "clean", "toxic"))
    every = feature == -1
    docs, rate = (clean + toxic)[every].sum(), toxic[every].sum() / max(1, (clean + toxic)[every].sum())
    with_it = clean + toxic
    spread = with_it * rate * (1 - rate) * (1 - with_it / max(1, docs))
    errors = np.abs(toxic - with_it * rate) / np.sqrt(np.maximum(spread, 1e-9))
    return feature[(errors >= LEAST_ERRORS) & (with_it >= LEAST_DOCS) & (with_it < docs) & ~every].tolist()


def _instances(rows: DataFrame, wanted: list[int]) -> DataFrame:
    """(label, bare, sizes, features) of each document: its sentences' features among ``wanted``; ``bare`` have none."""

    def made(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        features, bare, sizes, listed = features_among(frozenset(wanted)), [], [], []
        for text in batch.column("text"):
            found = [f for _, _, f in sentences(text.as_py() or "", features)] or [set()]
            full = [f for f in found if f]
            bare.append(len(found) - len(full))
            sizes.append([len(f) for f in full])
            listed.append([x for f in full for x in sorted(f)])
        columns = [batch.column("label"), pa.array(bare, pa.int64())]
        columns += [pa.array(sizes, pa.list_(pa.int32())), pa.array(listed, pa.list_(pa.int32()))]
        yield pa.RecordBatch.from_arrays(columns, names=["label", "bare", "sizes", "features"])

    return map_batches(rows, made, "label int, bare long, sizes array<int>, features array<int>")


def slopes(label, bare, sizes, counts, features, model: Model) -> tuple[np.ndarray, ...]:
    """(feature, slope, curvature) of the loss over documents; feature -1 stands for the bias.

    ``counts`` tells how many of ``sizes`` are each document's. A sentence's curvature is shared out over its features,
    which bounds the joint step (its features move together).
    """
    named, place = np.unique(features, return_inverse=True)
    weights = np.array([model.weights[f] for f in named.tolist()], float)
    sentence = np.repeat(np.arange(len(sizes)), sizes)
    document = np.repeat(np.arange(len(label)), counts)
    odds = model.bias + np.bincount(sentence, weights[place] if len(place) else None, len(sizes))
    chance, plain = 1 / (1 + np.exp(-odds)), 1 / (1 + np.exp(-model.bias))
    silent = np.bincount(document, np.logaddexp(0, odds), len(label)) + bare * np.logaddexp(0, model.bias)
    pull = np.where(label == 1, -np.exp(-silent) / np.maximum(-np.expm1(-silent), 1e-12), 1.0)
    share = np.where(label == 1, np.abs(pull), -1)

    def bent(p, s):
        return np.where(s >= 0, np.minimum(p * s, 0.25), p * (1 - p))

    slope, curve = chance * pull[document], bent(chance, share[document]) * (sizes + 1)
    alone = bare * plain * pull
    return (
        np.append(named, -1),
        np.append(np.bincount(place, slope[sentence], len(named)), slope.sum() + alone.sum()),
        np.append(np.bincount(place, curve[sentence], len(named)), curve.sum() + (bare * bent(plain, share)).sum()),
    )


def _stepped(model: Model, found: pa.Table) -> Model:
    weights, bias = dict(model.weights), model.bias
    for f, slope, curve in zip(*(found.column(c).to_pylist() for c in ("feature", "slope", "curve"))):
        if f == -1:
            bias -= float(np.clip(slope / max(curve, 1e-9), -1, 1))
        else:
            weights[f] -= float(np.clip((slope + RIDGE * weights[f]) / (curve + RIDGE), -1, 1))
    return Model(weights, float(np.clip(bias, -STEEPEST, STEEPEST)))


def fitted(rows: DataFrame, rounds: int = ROUNDS) -> Model:
    """The model of labelled documents (``label`` 0 or 1, ``text``).

    Counts and slopes are sums over all rows, made where the rows are; only sums by feature, 2^18 at most, reach the
    driver. Documents are reduced to the features that matter once, in a table that every round reads. Without rows, or
    with labels of one kind alone, there are no features and the bias alone is fitted. A null text is an empty one.
    """
    wanted = _screened(rows)
    # Every round is a task for each file, and a task costs more than its sums: small files are put together.
    kept = Kept(_instances(rows, wanted).hint("rebalance"), "instances")
    model = Model(dict.fromkeys(wanted, 0.0))
    for _ in range(rounds):
        now = model

        def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            # The bias, feature -1, has the last place. What a task meets is summed up before it is sent.
            slope, curve = np.zeros((1 << BITS) + 1), np.zeros((1 << BITS) + 1)
            for batch in batches:
                lists = batch.column("sizes")
                named, slopes_of, curves_of = slopes(
                    batch.column("label").to_numpy(), batch.column("bare").to_numpy(), lists.flatten().to_numpy(),
                    lists.value_lengths().to_numpy(), batch.column("features").flatten().to_numpy(), now,
                )
                slope[named] += slopes_of
                curve[named] += curves_of
            met = np.flatnonzero(curve)
            columns = [pa.array(np.where(met == 1 << BITS, -1, met), pa.int32()), pa.array(slope[met]), pa.array(curve[met])]
            yield pa.RecordBatch.from_arrays(columns, names=["feature", "slope", "curve"])

        sums = map_in_arrow(kept.rows, partial, "feature int, slope double, curve double").groupBy("feature")
        model = _stepped(now, sums.agg(F.sum("slope").alias("slope"), F.sum("curve").alias("curve")).toArrow())
    kept.drop()
    return model


def labelled(docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """(label, text) of the documents that ``labels`` (key, toxic) names. A key with several labels is toxic if one of
    them is; null keys and null labels name nothing."""
    known = labels.filter(F.col("toxic").isNotNull()).groupBy(F.col(f"`{key}`").alias("k"))
    known = Kept(known.agg(F.max((F.col("toxic") > 0).cast("int")).alias("label")), "labels").rows
    texts = docs.select(F.col(f"`{key}`").alias("k"), F.col(f"`{text}`").alias("text"))
    if known.count() <= SENT_LABELS:
        return texts.join(F.broadcast(known), "k").select("label", "text")
    return Kept(texts.join(known, "k").select("label", "text"), "labelled").rows


SCORES = (
    ("score", "double"), ("n_sentences", "long"), ("n_offending", "long"), ("worst_start", "long"),
    ("worst_chars", "long"), ("worst_score", "double"),
)


def with_scores(docs: DataFrame, model: Model, text: str = "text", threshold: float = 0.5) -> DataFrame:
    """``docs`` with the ``score`` of each text, and where its worst sentence is (the first of equal ones).

    A text without words (null or empty too) counts as one sentence without features and has no worst sentence. Texts
    are read whole, one by one. Rows are judged apart, so repeated rows come out repeated; an empty table gives
    no rows. A new column gets underscores in front where ``docs`` has its name.
    """
    names = []
    for name, _ in SCORES:
        names.append(free_name([*docs.columns, *names], name))
    schema = T.StructType([*docs.schema])
    for name, (_, kind) in zip(names, SCORES):
        schema.add(name, kind)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = features_among(frozenset(model.weights))
        for batch in batches:
            made = [scored(value.as_py() or "", model, features, threshold) for value in batch.column(text)]
            parts = zip(*made) if made else ([] for _ in SCORES)
            more = [pa.array(p, pa.float64() if kind == "double" else pa.int64()) for p, (_, kind) in zip(parts, SCORES)]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=schema.names)

    return map_in_arrow(docs, run, schema)


def scored(text: str, model: Model, features: Features, threshold: float = 0.5) -> tuple:
    """A row of ``SCORES``. Scores have nine decimals, as sums of floating-point numbers depend on their order."""
    found = [(start, end, sentence_odds(model, f)) for start, end, f in sentences(text, features)]
    if not found:
        return round(noisy_or(np.array([model.bias])), 9), 0, 0, None, None, None
    odds = np.array([o for _, _, o in found])
    chances = 1 / (1 + np.exp(-odds))
    start, end, _ = found[int(odds.argmax())]
    return (
        round(noisy_or(odds), 9), len(found), int((chances >= threshold).sum()), start, end - start, round(float(chances.max()), 9)
    )


def offending_sentences(docs: DataFrame, model: Model, key: str = "doc_id", text: str = "text", threshold: float = 0.5) -> DataFrame:
    """(key, start, sentence, score) of each sentence whose own probability reaches ``threshold``; start counts characters."""
    schema = T.StructType([docs.schema[key]]).add("start", "long").add("sentence", "string").add("score", "double")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        features = features_among(frozenset(model.weights))
        for batch in batches:
            rows, kept = [], []
            for at, value in enumerate(batch.column(text)):
                whole = value.as_py() or ""
                for start, end, f in sentences(whole, features):
                    chance = float(1 / (1 + np.exp(-sentence_odds(model, f))))
                    if chance >= threshold:
                        rows.append(at)
                        kept.append((start, whole[start:end], chance))
            parts = list(zip(*kept)) or [(), (), ()]
            columns = [batch.column(key).take(pa.array(rows, pa.int64()))]
            columns += [pa.array(p, t) for p, t in zip(parts, (pa.int64(), pa.string(), pa.float64()))]
            yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_in_arrow(docs.select(f"`{key}`", f"`{text}`"), run, schema)


def held_out(key: str = "doc_id"):
    """Whether a key's label is kept from training: one in five, by its digest. A null key has no label to keep."""
    drawn = F.crc32(F.col(f"`{key}`").cast("string").cast("binary")) % 5
    return F.coalesce(drawn == 0, F.lit(False))


def toxicity_report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """A row for each document, scored by a model of the labels that are not held out."""
    model = fitted(labelled(docs, labels.filter(~held_out())))
    rows = with_scores(docs.select("doc_id", "text"), model)
    return rows.select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"),
        *[name for name, _ in SCORES[1:]],
    )

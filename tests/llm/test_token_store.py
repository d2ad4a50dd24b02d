import json
import random

import numpy as np
import pyarrow.fs as pafs
import public_tokenizers
import pytest
from llm import plain
from tokenizers import Tokenizer

from ramparts.llm import token_store as ts

PATH = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(PATH)


def encode(text):
    return LIBRARY.encode(text, add_special_tokens=False).ids


DOCS = [
    (5, "One two\n\nthree's  <|endoftext|> İΣ é́ \x1c\x85x"), (3, ""), (4, None), (9, "word " * 70_000), (7, "日本 \U0001f600"),
    (12, "last"), (-2, "first"),
]


def test_rows_come_back_from_the_files(spark):
    frame = spark.createDataFrame([(d, t, 0) for d, t in DOCS], "doc_id long, text string, start int")
    found = sorted(map(tuple, ts.stored_documents(frame, PATH).collect()))
    assert found == sorted(plain.store(sorted(DOCS, key=lambda d: d[0]), encode))
    assert ts.stored_documents(frame.limit(0), PATH).count() == 0


def test_words_are_cut_where_the_library_cuts_them():
    """Plain words pass through its model alone and share parts; others, and those of other tokenizers, through all of it."""
    words = ts.WordIds(PATH)
    whole = []
    words.tokenizer = type("Counted", (), {"encode": lambda self, text, **kind: whole.append(text) or LIBRARY.encode(text, **kind)})()
    plain_words = ["word", "Word,", "WORD...", "élanÀß!?", "<|", "Ðþ-"]
    others = ["it's", "a1", "x,y", "<|endoftext|>", "e\u0301", "\u0130x", "日本", "×a", "ª"]
    draw = random.Random(5)
    letters, marks = "aAzZÀÖØöøÿßÐþµªº×÷bcdeinorst", "".join(chr(c) for c in range(33, 127) if not chr(c).isalnum())
    drawn = ["".join(draw.choices(letters, k=draw.randint(1, 7)) + draw.choices(marks, k=draw.randint(0, 3))) for _ in range(3000)]
    for word in plain_words + others + drawn:
        assert np.frombuffer(words.ids(word.encode()), "<u4").tolist() == encode(word), word
    assert not set(plain_words) & set(whole) and set(others) <= set(whole)
    assert "word" in words.parts and "," in words.parts and len(words.parts) < len(words.words)


def test_other_tokenizers_are_not_cut(tmp_path):
    spec = json.load(open(PATH, encoding="utf-8"))
    spec["normalizer"] = {"type": "NFC"}
    (tmp_path / "cased.json").write_text(json.dumps(spec))
    cased = Tokenizer.from_file(str(tmp_path / "cased.json"))
    words = ts.WordIds(str(tmp_path / "cased.json"))
    for word in ("Word,", "WORD", "word"):
        assert np.frombuffer(words.ids(word.encode()), "<u4").tolist() == cased.encode(word, add_special_tokens=False).ids
    assert not words.parts


def test_full_tables_change_nothing(monkeypatch):
    monkeypatch.setattr(ts, "MOST_WORDS", 3)
    monkeypatch.setattr(ts, "MOST_PARTS", 2)
    words = ts.WordIds(PATH)
    text = "One two, three. Two, four! one? " * 5 + "x" * 100
    assert np.frombuffer(words.ids(text.encode()), "<u4").tolist() == encode(text)
    assert len(words.words) <= 3 and len(words.parts) <= 2


def test_null_and_repeated_ids(spark):
    frame = spark.createDataFrame([(None, "a b"), (1, "c"), (1, "d e f"), (1, "c")], "doc_id long, text string")
    rows = sorted(ts.stored_documents(frame, PATH).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 1, 1, 1]
    assert sum(r.n_tokens for r in rows) == 3 + 2 + 4 + 2
    assert [r.start for r in rows[1:]] == [rows[i].start + rows[i].n_tokens for i in range(3)]


def test_only_asked_frames_are_unpacked_and_damage_is_seen(tmp_path, monkeypatch):
    monkeypatch.setattr(ts, "FRAME_TOKENS", 4)
    monkeypatch.setattr(ts, "INDEX_RECORDS", 2)
    system, path = pafs.LocalFileSystem(), str(tmp_path / "f")
    documents = [(1, [1, 2, 3]), (2, [4] * 9), (3, []), (None, [5]), (2, [6, 7])]
    with system.open_output_stream(path, compression=None) as sink:
        writer = ts.Writer(sink)
        for doc_id, ids in documents:
            writer.add(doc_id, b"".join(i.to_bytes(4, "little") for i in ids))
        writer.close()
    opened = []
    frame = ts.Reader.frame
    monkeypatch.setattr(ts.Reader, "frame", lambda self, n: opened.append(n) or frame(self, n))
    assert [a.tolist() for a in ts.fetch_document(system, path, 2)] == [[4] * 9, [6, 7]]
    assert [n for n in opened if n < 4] == [0, 1, 2, 3] and ts.fetch_document(system, path, 99) == []
    opened.clear()
    assert [a.tolist() for a in ts.fetch_document(system, path, 1)] == [[1, 2, 3]]
    assert [n for n in opened if n < 4] == [0]
    data = bytearray((tmp_path / "f").read_bytes())
    data[8] ^= 1
    (tmp_path / "f").write_bytes(bytes(data))
    with pytest.raises(Exception):
        ts.fetch_document(system, path, 1)

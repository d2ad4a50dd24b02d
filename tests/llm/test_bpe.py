import random

import public_tokenizers
import pytest
import tiktoken
from hypothesis import given, settings, strategies as st

from ramparts.llm import bpe

PATH, PATTERN = public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN
RANKS = bpe.read_ranks(PATH)
LIBRARY = tiktoken.Encoding("own", pat_str=PATTERN, mergeable_ranks=RANKS, special_tokens={})
HARD = [
    "", " ", "a", "  a", "a  b ", "it's I'LL we're 'tis", "\n\n x\t", "x" * 5000, "ab" * 4000, "=" * 700, " 　a",
    "<|endoftext|>", "՘a 1\U0001e6c0 \U0003d000b", "日本語 текст é", "\x00\x1c\x85 \U0001f600‍",
]


def ids(text):
    return [i for _, part in bpe.encoder_of(PATH, PATTERN).chunks(text) for i in part]


@pytest.mark.parametrize("text", HARD)
def test_hard_texts(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.sampled_from("abcehinorst 'ésl01\n\t.,-_=日՘"), max_size=80))
def test_random_texts(text):
    assert ids(text) == LIBRARY.encode_ordinary(text)


def test_joined_tokens():
    draw, tokens = random.Random(1), [t for t in RANKS if t.isascii()]
    for _ in range(2000):
        text = b"".join(draw.choices(tokens, k=draw.randint(1, 8))).decode()
        assert ids(text) == LIBRARY.encode_ordinary(text)


def test_small_tables_change_nothing(monkeypatch):
    for name, size in (("MOST_STATES", 20), ("MOST_PAIRS", 50), ("MOST_CHUNKS", 3), ("SETTLED_AFTER", 5)):
        monkeypatch.setattr(bpe, name, size)
    encoder = bpe.Encoder(RANKS, PATTERN)
    for text in ["the thinner thing then", "unbelievable internationalisation " * 3, "abcabcabcabc" * 20]:
        assert [i for _, part in encoder.chunks(text) for i in part] == LIBRARY.encode_ordinary(text)


def test_beside_rows_less_is_kept(monkeypatch):
    """Of a chunk its packed ids alone, and as many states and chunks as their own limits say; the ids are the same."""
    monkeypatch.setattr(bpe, "STATES_BESIDE_ROWS", 30)
    monkeypatch.setattr(bpe, "CHUNKS_BESIDE_ROWS", 4)
    encoder = bpe.Encoder(RANKS, PATTERN, bpe.packed, True)
    for text in [*HARD, "the thinner thing then thinking of things unbelievable internationalisation", "abc abd the then thin"]:
        assert list(memoryview(b"".join(encoder.chunks(text))).cast("i")) == LIBRARY.encode_ordinary(text)
        encoder.transducer.encode(b"the")
        assert len(encoder.first) <= 4 and len(encoder.later) <= 4
        assert len(encoder.transducer.states) <= 30 + len("the") + 1
    assert all(type(ids) is bytes for ids in encoder.later.values())


def test_chunks_share_their_matches(monkeypatch):
    """A word that stands before various marks and line ends goes through the transducer once."""
    encoder, seen = bpe.Encoder(RANKS, PATTERN), []
    encode = encoder.transducer.encode
    monkeypatch.setattr(encoder.transducer, "encode", lambda piece: seen.append(piece) or encode(piece))
    text = "so thnderwhont thnderwhont, thnderwhont. thnderwhont.\nSo thnderwhont; thnderwhont!"
    assert [i for _, part in encoder.chunks(text) for i in part] == LIBRARY.encode_ordinary(text)
    assert seen.count(b" thnderwhont") == 1 and len(seen) == len(set(seen))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=" \n\tab", min_size=1, max_size=6))
def test_white_space_beside_blanks(text):
    encoder = bpe.encoder_of(PATH, PATTERN)
    assert encoder.unclean(text) == any(not part or part[0].isspace() or part[-1].isspace() for part in text.split(" ") if text)


def test_decoder_gives_whole_characters_as_soon_as_it_can():
    tokens = {i: bytes([i]) for i in range(256)}
    decoder = bpe.Decoder(tokens)
    assert [decoder.feed([b]) for b in "é😀a".encode()] == ["", "é", "", "", "", "😀", "a"]
    assert decoder.finish() == ""
    draw = random.Random(2)
    for _ in range(2000):
        data = bytes(draw.choice([0x41, 0x80, 0xBF, 0xC3, 0xE2, 0x82, 0xF0, 0x9F, 0xF8, 0xFF]) for _ in range(12))
        decoder = bpe.Decoder(tokens)
        assert "".join(decoder.feed([b]) for b in data) + decoder.finish() == data.decode("utf-8", "replace")


def test_documents(spark):
    docs = spark.createDataFrame([(i, t, t) for i, t in enumerate(HARD)] + [(None, None, "x"), (3, "b", "y")], "doc_id long, text string, IDS string")
    out = bpe.encoded(docs, PATH, PATTERN)
    assert out.columns == ["doc_id", "text", "IDS", "_ids", "n_tokens", "decodes"]
    for row in out.collect():
        assert row._ids == LIBRARY.encode_ordinary(row.text or "") and row.n_tokens == len(row._ids) and row.decodes
    back = bpe.decode(out, PATH, PATTERN, "_ids", "back")
    assert all(row.back == (row.text or "") for row in back.collect())
    assert bpe.encoded(docs.limit(0), PATH, PATTERN).count() == 0
    digests = bpe.round_trip(docs, PATH, PATTERN)
    from llm import plain

    expected = []
    for row in docs.collect():
        found = LIBRARY.encode_ordinary(row.text or "")
        expected.append((row.doc_id, len(found), plain.sha(" ".join(map(str, found))), plain.sha(row.text or "")))
    assert sorted(map(tuple, digests.collect()), key=repr) == sorted(expected, key=repr)

"""Byte-level BPE: encoding by a finite-state transducer that is determinised as it runs, and streaming decoding."""

from __future__ import annotations

import base64
import hashlib
import re
from array import array
from collections.abc import Callable, Iterable, Iterator, Sequence
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F, types as T

from ramparts.llm.shared import KEPT_BY_WORKER, free_name, map_batches

# Limits of what a worker keeps between texts; beyond them a table starts anew, which changes no result.
MOST_STATES, MOST_PAIRS, MOST_CHUNKS, MOST_PIECES, LONGEST_CHUNK = 200_000, 1_000_000, 250_000, 250_000, 64
# Where ids are added to whole rows: documents whose ids are held at once, chunks, pieces and states kept, as rows need memory too.
ROWS_AT_ONCE, CHUNKS_BESIDE_ROWS, PIECES_BESIDE_ROWS, STATES_BESIDE_ROWS = 500, 80_000, 20_000, 60_000
SETTLED_AFTER = 4096
DECODED_AT_ONCE = 8192

# Letters and numbers of Unicode after version 16, which the tokenizer's own tables do not know and
# take as other characters.
UNKNOWN_LETTERS = (
    "՘֋-֌࢏౜೜₏₝-₟꟎-꟏꟒꟔꟝꟢꟱꭬-꭭"
    "\U000107bb-\U000107bf\U00010940-\U00010959\U00010ec5-\U00010ec7\U00010ed9-\U00010eee\U00011b0a"
    "\U00011db0-\U00011ddb\U00011de0-\U00011de9\U00011df1\U0001246f\U00012475-\U0001247f\U00012550-\U00012686"
    "\U00016ea0-\U00016eb8\U00016ebb-\U00016ed3\U00016ff2-\U00016ff6\U000187f8-\U000187ff\U00018cd6-\U00018cda"
    "\U00018d09-\U00018d20\U00018d80-\U00018df2\U00018e00-\U00019191\U000191a0-\U000191d2\U0001b123-\U0001b128"
    "\U0001b168\U0001d6a6\U0001df1f-\U0001df24\U0001df2b-\U0001df81\U0001df90-\U0001df96\U0001dfcd-\U0001dfff"
    "\U0001e6c0-\U0001e6de\U0001e6e0-\U0001e6e2\U0001e6e4-\U0001e6e5\U0001e6e7-\U0001e6ed\U0001e6f0-\U0001e6f4"
    "\U0001e6fe-\U0001e6ff\U0002b73a-\U0002b73f\U0002b81e\U0002cea2-\U0002cead\U000323b0-\U00033479"
    "\U0003d000-\U0003fc3f"
)


def read_ranks(path: str) -> dict[bytes, int]:
    """Token bytes to ranks, from a file of lines with a base64 token and its rank."""
    with open(path, "rb") as lines:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}


class State(dict):
    """A set of places where a token may have begun, each as the bytes read since and the border before it. Gives for a
    byte the next state and the last token of what has been read; ``move`` makes both on first use."""

    __slots__ = ("begun", "move")

    def __init__(self, begun: tuple[tuple[bytes, int], ...], move: Callable):
        super().__init__()
        self.begun, self.move = begun, move

    def __missing__(self, byte: int) -> tuple[State, int]:
        found = self[byte] = self.move(self.begun, byte)
        return found


class Transducer:
    """Reads bytes, writes token ids.

    Two neighbouring tokens fit if the merges applied to their joint bytes give just these two. The encoding of a
    text is its only split into tokens that fit, and every prefix of a text has one last token. So on each byte, one of
    the open beginnings ends in the prefix's last token, and beginnings that no token can continue are dropped. The
    ways back from the open beginnings, none of which is further away than the longest token, meet in the tokens that
    are settled; these are written while reading. States are made when they are first reached and kept with their moves.

    A beginning remembers of the token before it only its border: the pieces that stood at that token's right end
    while it grew and that could still merge with what comes. Borders are numbered; 0 is one that nothing can cross.
    """

    def __init__(self, ranks: dict[bytes, int], states: int = 0):
        self.ranks, self.states_kept = ranks, states
        self.bytes = {rank: token for token, rank in ranks.items()}
        self.sizes = {rank: len(token) for token, rank in ranks.items()}
        self.stems = {token[:i] for token in ranks for i in range(1, len(token))}
        self.single = [bytes((byte,)) for byte in range(256)]
        self.next = self.move  # one bound method for all states
        self.reset()

    def reset(self) -> None:
        self.borders: list[tuple[tuple[bytes, int | None], ...]] = [()]
        self.numbers: dict[tuple, int] = {(): 0}
        self.after: dict[int, int] = {}
        self.narrowed: dict[tuple[int, bytes], int] = {}
        self.fits: dict[tuple[int, int], bool] = {}
        self.states: dict[tuple, State] = {}
        self.start = self.state(((b"", 0),))

    def full(self) -> bool:
        return len(self.states) > (self.states_kept or MOST_STATES) or len(self.fits) + len(self.narrowed) > MOST_PAIRS

    def state(self, begun: tuple) -> State:
        found = self.states.get(begun)
        if found is None:
            found = self.states[begun] = State(begun, self.next)
        return found

    def number(self, border: tuple) -> int:
        found = self.numbers.setdefault(border, len(self.borders))
        if found == len(self.borders):
            self.borders.append(border)
        return found

    @lru_cache(maxsize=1 << 16)  # noqa: B019  one transducer lives as long as its worker
    def halves(self, token: bytes) -> tuple[bytes, bytes] | None:
        """The two tokens whose merge makes ``token``; None for a byte."""
        parts = [token[i : i + 1] for i in range(len(token))]
        while len(parts) > 2:
            joined = [self.ranks.get(a + b, len(self.ranks) + 256) for a, b in zip(parts, parts[1:])]
            at = joined.index(min(joined))
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return (parts[0], parts[1]) if len(parts) == 2 else None

    def edge(self, token: bytes, side: int) -> Iterator[tuple[bytes, int | None]]:
        """The tokens that stand at one end of ``token`` while it grows, the whole one first, each with the rank of
        the merge that ends it (None for the whole one)."""
        ends: int | None = None
        while True:
            yield token, ends
            split = self.halves(token)
            if split is None:
                return
            ends, token = self.ranks[token], split[side]

    def border(self, token: int) -> int:
        """The border that a token leaves: its right ends that can begin a merge."""
        found = self.after.get(token)
        if found is None:
            ends = tuple((x, until) for x, until in self.edge(self.bytes[token], 1) if x in self.stems)
            found = self.after[token] = self.number(ends)
        return found

    def narrow(self, border: int, read: bytes) -> int:
        """What is left of a border when the next token begins with ``read``."""

        rank_of, stems = self.ranks.get, self.stems

        def may_cross(x: bytes, until: int | None) -> bool:
            for size in range(1, len(read) + 1):
                joined = x + read[:size]
                merge = rank_of(joined)
                if merge is not None and (until is None or merge < until):
                    return True
                if joined not in stems:  # then nothing longer is a token, nor part of one's beginning
                    return False
            return True

        found = self.number(tuple(end for end in self.borders[border] if may_cross(*end)))
        self.narrowed[border, read] = found
        return found

    def fit(self, border: int, token: int) -> bool:
        """Whether no merge across the border comes before those that make the two tokens. Of equal merges the one
        further left comes first, so one that ends the left token wins a tie and one within the right token loses."""
        right = list(self.edge(self.bytes[token], 0))
        found = True
        for x, x_until in self.borders[border]:
            for y, y_until in right:
                merge = self.ranks.get(x + y)
                if merge is not None and (x_until is None or merge < x_until) and (y_until is None or merge <= y_until):
                    found = False
        self.fits[border, token] = found
        return found

    def move(self, before: tuple, byte: int) -> tuple[State, int]:
        """The next state and the last token of what has been read."""
        begun, last, letter = [], -1, self.single[byte]
        rank_of, stems, fits, narrowed = self.ranks.get, self.stems, self.fits, self.narrowed
        for read, border in before:
            token = read + letter
            if last < 0:
                rank = rank_of(token)
                if rank is not None:
                    fit = not border or fits.get((border, rank))
                    if fit or fit is None and self.fit(border, rank):
                        last = rank
            if token in stems:
                if border:
                    known = narrowed.get((border, token))
                    border = self.narrow(border, token) if known is None else known
                begun.append((token, border))
        begun.append((b"", self.border(last)))
        return self.state(tuple(begun)), last

    def back(self, lasts: list[int], end: int) -> list[int]:
        """Tokens of the first ``end`` bytes read."""
        out = []
        while end:
            out.append(lasts[end - 1])
            end -= self.sizes[lasts[end - 1]]
        return out[::-1]

    def encode(self, piece: bytes) -> list[int]:
        if self.full():
            self.reset()
        state, lasts, out = self.start, [], []
        for byte in piece:
            state, last = state[byte]
            lasts.append(last)
            if len(lasts) == SETTLED_AFTER:
                ways = [self.back(lasts, len(lasts) - len(read)) for read, _ in state.begun]
                settled = 0
                while all(len(way) > settled and way[settled] == ways[0][settled] for way in ways):
                    settled += 1
                out += ways[0][:settled]
                del lasts[: sum(self.sizes[token] for token in ways[0][:settled])]
                if self.full():
                    borders = self.borders
                    self.reset()
                    state = self.state(tuple((read, self.number(borders[border])) for read, border in state.begun))
        return out + self.back(lasts, len(lasts))


class Recent(dict):
    """A bounded table of what ``make`` gives for texts. When it is full it becomes the older one, from which texts
    still in use come back."""

    def __init__(self, make: Callable, most: int):
        super().__init__()
        self.make, self.most, self.older = make, most, {}

    def __missing__(self, text: str):
        found = self.older.get(text)
        if found is None:
            found = self.make(text)
        if len(text) <= LONGEST_CHUNK:
            if len(self) >= self.most:
                self.older = dict(self)
                self.clear()
            self[text] = found
        return found


def with_decimals(ids: Sequence[int]) -> tuple[str, tuple[int, ...]]:
    return " ".join(map(str, ids)), tuple(ids)


def packed(ids: Sequence[int]) -> bytes:
    """Less memory than a tuple of ids and their decimal form take."""
    return array("i", ids).tobytes()


class Encoder:
    """Texts to token ids: the pattern's matches are encoded one by one, without special tokens.

    Tables stand in front of the transducer: one of chunks, that is what stands between blanks, and behind it one of
    the pattern's matches, which chunks of a word and various marks or line ends share. ``form`` is what ``chunks`` gives
    for the ids of a part. With ``beside_rows`` less is kept.
    """

    def __init__(self, ranks: dict[bytes, int], pattern: str, form: Callable = with_decimals, beside_rows: bool = False):
        self.form = form
        chunks, pieces = (CHUNKS_BESIDE_ROWS, PIECES_BESIDE_ROWS) if beside_rows else (MOST_CHUNKS, MOST_PIECES)
        self.transducer = Transducer(ranks, STATES_BESIDE_ROWS if beside_rows else 0)
        self.matches = regex.compile(pattern).findall
        self.careful = None
        self.pattern = pattern
        self.beyond = re.compile(f"[{UNKNOWN_LETTERS[0]}-\U0010ffff]").search
        self.unknown_letter = re.compile(f"[{UNKNOWN_LETTERS}]").search
        self.beside_blank = re.compile(r"\s(?: |(?<= \s))").search
        self.known = Recent(self.piece_ids, pieces)
        self.first, self.later = Recent(self.chunk, chunks), Recent(lambda chunk: self.chunk(" " + chunk), chunks)

    def unclean(self, text: str) -> bool:
        """Whether white space stands beside a blank or at an end of the text."""
        return bool(self.beside_blank(f" {text} "))

    def unknown(self, text: str) -> bool:
        """Whether the text has unknown letters. Most texts end with the first, quicker question."""
        return bool(self.beyond(text) and self.unknown_letter(text))

    def pieces(self, text: str) -> list[str]:
        if not self.unknown(text):
            return self.matches(text)
        if self.careful is None:  # the same pattern, with letters that the tokenizer does not know as others
            others = r"[^\s\p{L}\p{N}]"
            wide = self.pattern.replace(others, "<others>")
            for kind in (r"\p{L}", r"\p{N}"):
                wide = wide.replace(kind, f"(?:(?![{UNKNOWN_LETTERS}]){kind})")
            self.careful = regex.compile(wide.replace("<others>", f"(?:[{UNKNOWN_LETTERS}]|{others})")).findall
        return self.careful(text)

    def encode_pieces(self, text: str) -> Iterator[int]:
        for piece in self.pieces(text):
            yield from self.encode_piece(piece.encode())

    def encode_piece(self, piece: bytes) -> list[int]:
        whole = self.transducer.ranks.get(piece)
        return [whole] if whole is not None else self.transducer.encode(piece)

    def piece_ids(self, piece: str) -> tuple[int, ...]:
        return tuple(self.encode_piece(piece.encode()))

    def chunk(self, chunk: str):
        """Ids of a chunk without unknown letters, in the encoder's form."""
        found = [self.known[piece] for piece in self.matches(chunk)]
        return self.form(found[0] if len(found) == 1 else tuple(chain.from_iterable(found)))

    def chunks(self, text: str) -> list:
        """Ids of consecutive parts of the text, each in the encoder's form. A single blank between two words always begins a
        match, so such texts are cut there; others stay whole."""
        if self.unclean(text) or self.unknown(text):
            ids = list(self.encode_pieces(text))
            return [self.form(ids)] if ids else []
        head, *rest = text.split(" ")
        return [self.first[head], *map(self.later.__getitem__, rest)] if text else []


class Decoder:
    """Token ids in, text out as soon as its bytes are complete.

    The state is the part of a character (three bytes at most) that has come so far. Bytes that are no UTF-8 become
    the replacement character, as when everything is decoded at once.
    """

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.held = tokens, b""

    @staticmethod
    def complete(data: bytes) -> int:
        """Length of ``data`` without a last character that still lacks bytes."""
        for back in range(1, min(3, len(data)) + 1):
            byte = data[-back]
            if byte >= 0xC0:
                size = 2 if byte < 0xE0 else 3 if byte < 0xF0 else 4
                return len(data) - back if back < size and byte < 0xF8 else len(data)
            if byte < 0x80:
                break
        return len(data)

    def feed(self, ids: Iterable[int]) -> str:
        data = self.held + b"".join(map(self.tokens.__getitem__, ids))
        end = self.complete(data)
        self.held = data[end:]
        return data[:end].decode("utf-8", "replace")

    def finish(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


def decoded(tokens: dict[int, bytes], ids: Iterable[int]) -> Iterator[str]:
    """The text of the ids, part by part."""
    decoder, ids = Decoder(tokens), list(ids)
    for at in range(0, len(ids), DECODED_AT_ONCE):
        yield decoder.feed(ids[at : at + DECODED_AT_ONCE])
    yield decoder.finish()


@lru_cache(maxsize=2)
def encoder_of(path: str, pattern: str, form: Callable = with_decimals, beside_rows: bool = False) -> Encoder:
    """One for each worker, vocabulary, pattern and form of ids."""
    return Encoder(read_ranks(path), pattern, form, beside_rows)


def _let_go() -> None:
    encoder_of.cache_clear()
    Transducer.halves.cache_clear()


KEPT_BY_WORKER[__name__] = _let_go


def encoded(docs: DataFrame, path: str, pattern: str, text: str = "text") -> DataFrame:
    """``docs`` with ``ids`` (token ids of the text), ``n_tokens`` and ``decodes`` (whether the ids give the text back),
    under free names. A null or empty text has no ids; a null one decodes to nothing, which counts as given back."""
    names = [free_name(docs.columns, name) for name in ("ids", "n_tokens", "decodes")]
    schema = docs.select("*").schema
    for name, kind in zip(names, (T.ArrayType(T.IntegerType()), T.LongType(), T.BooleanType())):
        schema = schema.add(name, kind)

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        for at in range(0, batch.num_rows, ROWS_AT_ONCE):
            yield part(batch.slice(at, ROWS_AT_ONCE))

    def part(batch: pa.RecordBatch) -> pa.RecordBatch:
        encoder = encoder_of(path, pattern, packed, True)
        tokens = encoder.transducer.bytes
        ids, back = [], []
        for value in batch.column(text):
            value = value.as_py() or ""
            found = np.frombuffer(b"".join(encoder.chunks(value)), np.int32)
            back.append("".join(decoded(tokens, found.tolist())) == value)
            ids.append(found)
        lengths = np.array([0, *map(len, ids)], np.int64)
        values = pa.array(np.concatenate([np.empty(0, np.int32), *ids]))
        lists = pa.ListArray.from_arrays(pa.array(np.cumsum(lengths).astype(np.int32)), values)
        columns = [*batch.columns, lists, pa.array(lengths[1:]), pa.array(back, pa.bool_())]
        return pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(docs, run, schema)


def decode(rows: DataFrame, path: str, pattern: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``rows`` with the text of each array of ids under ``name``; null ids give a null."""
    schema = rows.select("*").schema.add(name, "string")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        tokens = encoder_of(path, pattern).transducer.bytes
        lists = batch.column(ids).to_pylist()
        texts = [None if i is None else "".join(decoded(tokens, i)) for i in lists]
        columns = [*batch.columns, pa.array(texts, pa.string())]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(rows, run, schema)


def round_trip(docs: DataFrame, path: str, pattern: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id, n_tokens, and digests of the ids and of what they decode to, a row for each row of ``docs``.

    Encodes, decodes the ids and digests both in one pass. A null text is taken as empty: no ids.
    """
    wanted = docs.select(F.col(f"`{key}`").alias("doc_id"), F.col(f"`{text}`").alias("text"))
    schema = wanted.select("doc_id").schema.add("n_tokens", "long").add("ids_sha256", "string").add("decoded_sha256", "string")

    def run(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
        encoder = encoder_of(path, pattern)
        tokens = encoder.transducer.bytes
        counts, digests, backs = [], [], []
        for value in batch.column("text"):
            parts = encoder.chunks(value.as_py() or "")
            ids = list(chain.from_iterable([i for _, i in parts]))
            counts.append(len(ids))
            digests.append(hashlib.sha256(" ".join([d for d, _ in parts]).encode()).hexdigest())
            back = hashlib.sha256()
            for part in decoded(tokens, ids):
                back.update(part.encode())
            backs.append(back.hexdigest())
        columns = [batch.column("doc_id"), pa.array(counts, pa.int64()), pa.array(digests), pa.array(backs)]
        yield pa.RecordBatch.from_arrays(columns, names=schema.names)

    return map_batches(wanted, run, schema)

"""Byte-level BPE as a transducer that is made deterministic while it reads, and streaming decoding.

Encoding. Every prefix of a piece of text has one BPE result, and the result of a prefix ends in a token ``t`` exactly if
the result of the prefix before ``t`` ends in a token that stays apart from ``t`` (``Merges.apart``: no merge over
their border comes before the merges inside them). So the nondeterministic transducer has states (last token, bytes
read of the next one); reading a byte either grows the open token or closes it and emits it. Its subset states are made
when a text first reaches them and kept: one lookup a byte afterwards. Each subset state knows the token that ends at
its place, so the tokens of a piece follow from the states passed, back from the end. A long piece does not wait
for its end: every ``LOOKAHEAD`` bytes the open branches, at most as many as the longest token has bytes, are followed
back to where they meet, and what lies before is emitted.

Texts are split by the pattern of the rank file; each match is a piece of its own. A worker keeps the states and the
pieces it has met, both bounded, over all its tasks. Special tokens do not exist here: their strings are ordinary text.

Decoding. Tokens are bytes; a token may end inside a character. ``Utf8`` is the incremental state machine: its state is
the bytes of an unfinished character, at most three. What a token does in a state is remembered, so decoding is one
lookup a token. Bytes that are not UTF-8 give U+FFFD, one for each longest wrong start, as Python's decoder does.

A null or empty text has no tokens; the decoded text of no tokens is empty; a null list of ids decodes to the empty
text, and null ids or ids outside the vocabulary raise. Very long texts are one row each; nothing is cut. Repeated rows
and rows without an id are rows like others; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
import gc
from array import array
from collections.abc import Iterable, Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import regex
from pyspark.sql import DataFrame, functions as F

_STATES = 150_000  # subset states kept by a worker, some 800 bytes each
_PAIRS = 200_000  # pairs of tokens kept with what becomes of them
_PIECES = 300_000  # pieces of text of one generation kept by a worker, some 200 bytes each
_STEPS = 200_000  # (state, token) pairs kept by a decoder
_ROWS = 500  # texts of one output batch
LOOKAHEAD = 4096


class Merges:
    """The merges of a vocabulary of ranked byte strings."""

    def __init__(self, ranks: dict[bytes, int]):
        self.ranks = ranks
        self.tokens = {number: token for token, number in ranks.items()}
        # every start of a token that a further byte can still grow into one
        self.open = {token[:i] for token in ranks for i in range(1, len(token))}
        self.halves: dict[bytes, tuple[bytes, bytes]] = {}
        self.left: dict[bytes, tuple[list[bytes], list[float]]] = {}
        self.right: dict[bytes, tuple[list[bytes], list[float]]] = {}
        self.known: dict[tuple[bytes, bytes], bool] = {}

    def plain(self, piece: bytes, below: float = float("inf")) -> list[bytes]:
        """The merges as they are defined: of all neighbours the pair of least rank, leftmost first, again and again."""
        parts = [piece[i : i + 1] for i in range(len(piece))]
        while len(parts) > 1:
            least, at = min((self.ranks.get(a + b, below), i) for i, (a, b) in enumerate(zip(parts, parts[1:])))
            if least >= below:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def split(self, token: bytes) -> tuple[bytes, bytes]:
        """The two parts whose merge makes a token, which is its last one."""
        if token not in self.halves:
            parts = self.plain(token, self.ranks[token])
            if len(parts) != 2:
                raise ValueError(f"no merges lead to the token {token!r}")
            self.halves[token] = parts[0], parts[1]
        return self.halves[token]

    def edge(self, token: bytes, side: int) -> tuple[list[bytes], list[float]]:
        """What stands at one end (0 left, 1 right) of a token while it is being merged, and the rank at which each
        part goes into the next."""
        kept = self.right if side else self.left
        if token not in kept:
            parts, goes = [token], [float("inf")]
            while len(parts[-1]) > 1:
                goes.append(self.ranks[parts[-1]])
                parts.append(self.split(parts[-1])[side])
            kept[token] = parts[::-1], goes[::-1]
        return kept[token]

    def apart(self, a: bytes, b: bytes) -> bool:
        """Whether ``a`` and ``b`` side by side stay two tokens."""
        key = (a, b)
        known = self.known.get(key)
        if known is None:
            known = self.known[key] = self._apart(a, b)
        return known

    def _apart(self, a: bytes, b: bytes) -> bool:
        # Parts that stand at the border at one time merge over it if that merge comes before the next merge of either;
        # of merges of equal rank the left one is first. So follow both ends through time.
        rank_of = self.ranks.get
        left, left_goes = self.right.get(a) or self.edge(a, 1)
        right, right_goes = self.left.get(b) or self.edge(b, 0)
        i = j = 0
        while True:
            rank, x_goes, y_goes = rank_of(left[i] + right[j]), left_goes[i], right_goes[j]
            if rank is not None and rank < x_goes and rank <= y_goes:
                return False
            if x_goes <= y_goes:
                if i + 1 == len(left):
                    return True
                i += 1
            else:
                j += 1


class _State(dict):
    """A subset state: its moves by byte, made when asked for.

    ``branches`` are (bytes of the open token, token before it), from the longest to the empty one; ``last`` is the
    token that ends here if the piece does, ``number`` its rank and ``size`` its bytes.
    """

    __slots__ = ("branches", "last", "number", "size", "make")

    def __init__(self, make, branches: tuple[tuple[bytes, bytes], ...], last: bytes, number: int):
        self.make, self.branches, self.last, self.number, self.size = make, branches, last, number, len(last)

    def __missing__(self, byte: int) -> "_State":
        self[byte] = to = self.make(self, byte)
        return to


class Transducer:
    """Encodes pieces; makes its deterministic states when they are first reached."""

    def __init__(self, ranks: dict[bytes, int], states: int = _STATES):
        self.merges, self.most = Merges(ranks), states
        self.bytes = [bytes([i]) for i in range(256)]
        self._reset()

    def _reset(self) -> None:
        for state in getattr(self, "states", {}).values():
            state.clear()  # states point at each other in circles; without their moves they go at once
        self.start = _State(self._move, ((b"", b""),), b"", -1)
        self.states: dict[tuple, _State] = {self.start.branches: self.start}

    def _move(self, state: _State, byte: int) -> _State:
        """The state after a byte: every branch grows, and exactly one of them closes its token."""
        ranks, reachable, apart = self.merges.ranks, self.merges.open, self.merges.apart
        more, branches, last = self.bytes[byte], [], None
        for start, before in state.branches:
            grown = start + more
            if last is None and grown in ranks and (not before or apart(before, grown)):
                last = grown
            if grown in reachable:
                branches.append((grown, before))
        branches.append((b"", last))
        key = tuple(branches)
        to = self.states.get(key)
        if to is None:
            to = self.states[key] = _State(self._move, key, last, ranks[last])
        return to

    @staticmethod
    def _meeting(path: list[_State]) -> int:
        """The last place that the tokens of all open branches have in common."""
        places = {len(path) - 1 - len(start) for start, _ in path[-1].branches}
        while len(places) > 1:
            furthest = max(places)
            places.remove(furthest)
            places.add(furthest - path[furthest].size)
        return places.pop()

    @staticmethod
    def _back(path: list[_State], place: int) -> list[int]:
        out = []
        while place:
            state = path[place]
            out.append(state.number)
            place -= state.size
        out.reverse()
        return out

    def stream(self, chunks: Iterable[bytes]) -> Iterator[int]:
        """Ids of one piece that comes in chunks, as soon as they are certain; memory is bounded by the lookahead
        that the piece needs."""
        state, path, check = self.start, [self.start], LOOKAHEAD
        for chunk in chunks:
            for byte in chunk:
                state = state[byte]
                path.append(state)
                if len(path) > check:
                    place = self._meeting(path)
                    yield from self._back(path, place)
                    # places are counted from the meeting point from now on
                    path = [self.start, *path[place + 1 :]]
                    check = len(path) + LOOKAHEAD
        yield from self._back(path, len(path) - 1)

    def __call__(self, piece: bytes) -> list[int]:
        if len(self.states) > self.most:
            self._reset()
        if len(self.merges.known) > _PAIRS:
            self.merges.known.clear()
        if len(piece) > LOOKAHEAD:
            return list(self.stream((piece,)))
        state = self.start
        path = [state]
        for byte in piece:
            state = state[byte]
            path.append(state)
        return self._back(path, len(piece))


class _Kept(dict):
    """Ids of strings, made on first use. Two generations: when the young one is full it becomes the old one, so what
    comes often stays, and what comes once goes."""

    def __init__(self, make, most: int):
        super().__init__()
        self.make, self.most, self.old = make, most, {}

    def __missing__(self, said: str) -> bytes:
        if len(self) >= self.most:
            self.old = dict(self)
            self.clear()
        ids = self.old.get(said)
        self[said] = ids = self.make(said) if ids is None else ids
        return ids


class Encoder:
    """Ids of whole texts, as little-endian 32-bit numbers, with a bounded memory of pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.transducer, self.find = Transducer(ranks), regex.compile(pattern).findall
        self.pieces = _Kept(self._piece, _PIECES)

    def _piece(self, piece: str) -> bytes:
        return array("i", self.transducer(piece.encode("utf-8", "surrogatepass"))).tobytes()

    def __call__(self, text: str) -> bytes:
        return b"".join(map(self.pieces.__getitem__, self.find(text)))


class Utf8:
    """Incremental UTF-8: a state is the bytes of an unfinished character."""

    # First bytes from.. to, bytes in all, range of the second byte (well-formed UTF-8).
    STARTS = (
        (0xC2, 0xDF, 2, 0x80, 0xBF), (0xE0, 0xE0, 3, 0xA0, 0xBF), (0xE1, 0xEC, 3, 0x80, 0xBF), (0xED, 0xED, 3, 0x80, 0x9F), (0xEE, 0xEF, 3, 0x80, 0xBF),
        (0xF0, 0xF0, 4, 0x90, 0xBF), (0xF1, 0xF3, 4, 0x80, 0xBF), (0xF4, 0xF4, 4, 0x80, 0x8F),
    )
    BY_FIRST = {first: rest for low, high, *rest in STARTS for first in range(low, high + 1)}

    @classmethod
    def step(cls, state: bytes, byte: int) -> tuple[str, bytes]:
        """What a byte says in a state, and the state after it."""
        if state:
            size, low, high = cls.BY_FIRST[state[0]]
            if len(state) > 1:
                low, high = 0x80, 0xBF
            if low <= byte <= high:
                state += bytes([byte])
                return (state.decode(), b"") if len(state) == size else ("", state)
            said, state = cls.step(b"", byte)  # the start was wrong; the byte starts anew
            return "�" + said, state
        if byte < 0x80:
            return chr(byte), b""
        return ("", bytes([byte])) if byte in cls.BY_FIRST else ("�", b"")


class Decoder:
    """Text of ids that come one after another."""

    def __init__(self, tokens: dict[int, bytes]):
        self.tokens, self.steps = tokens, {b"": {}}

    def _step(self, state: bytes, number: int) -> tuple[str, bytes]:
        said, to = [], state
        for byte in self.tokens[number]:
            more, to = Utf8.step(to, byte)
            said.append(more)
        self.steps.setdefault(to, {})
        self.steps[state][number] = found = "".join(said), to
        return found

    def stream(self, ids: Iterable[int]) -> Iterator[str]:
        """Characters as they become complete; what stays unfinished at the end is U+FFFD."""
        if sum(map(len, self.steps.values())) > _STEPS:
            self.steps = {b"": {}}
        state, steps = b"", self.steps[b""]
        for number in ids:
            found = steps.get(number)
            if found is None:
                found = self._step(state, number)
            yield found[0]
            if found[1] != state:
                state = found[1]
                steps = self.steps[state]
        if state:
            yield "�"

    def __call__(self, ids: Iterable[int]) -> str:
        return "".join(self.stream(ids))


def read_ranks(path: str) -> dict[bytes, int]:
    """The ranks of a ``.tiktoken`` file: a token in base64 and its number a line."""
    with open(path, "rb") as file:
        return {base64.b64decode(token): int(number) for token, number in map(bytes.split, file)}


@lru_cache(maxsize=1)
def _encoder(path: str, pattern: str) -> Encoder:
    return Encoder(read_ranks(path), pattern)


@lru_cache(maxsize=1)
def _decoder(path: str) -> Decoder:
    return Decoder({number: token for token, number in read_ranks(path).items()})


def _encoded(docs: DataFrame, path: str, pattern: str, doc_id: str, text: str, back: bool) -> DataFrame:
    said = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def encoded(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        make, tell = _encoder(path, pattern), _decoder(path) if back else None
        for batch in batches:
            for start in range(0, len(batch), _ROWS):
                some = batch.iloc[start : start + _ROWS]
                ids = [np.frombuffer(make(t), "<i4") for t in some["text"]]
                gc.freeze()  # what is kept is not garbage; without this every collection walks all states
                out = {"doc_id": some["doc_id"].astype("Int64"), "ids": pd.Series(ids, some.index, object)}
                if back:
                    out["decoded"] = pd.Series([tell(x.tolist()) for x in ids], some.index, object)
                yield pd.DataFrame(out)

    return said.mapInPandas(encoded, "doc_id long, ids array<int>" + ", decoded string" * back)


def encode(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """doc_id and ``ids`` (array of int) of every row. ``path`` must be readable in every task."""
    return _encoded(docs, path, pattern, doc_id, text, False)


def round_trip(docs: DataFrame, path: str, pattern: str, doc_id: str = "doc_id", text: str = "text") -> DataFrame:
    """As ``encode`` and then ``decode``, with both in one Python worker: doc_id, ``ids`` and ``decoded``."""
    return _encoded(docs, path, pattern, doc_id, text, True)


def decode(encoded: DataFrame, path: str, ids: str = "ids", name: str = "decoded") -> DataFrame:
    """``encoded`` with one more column, the text of its ids; a null list says nothing."""

    def texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        make = _decoder(path)
        for batch in batches:
            yield pd.Series([make(x.tolist()) for x in batch], batch.index, object)

    texts.__annotations__ = {"batches": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return encoded.withColumn(name, F.pandas_udf(texts, "string")(F.coalesce(F.col(ids), F.array().cast("array<int>"))))

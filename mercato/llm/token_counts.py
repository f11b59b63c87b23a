"""Operator 3: token counts by a compiled finite-state transducer.

The vocabulary is a sentencepiece BPE model (path as parameter). Its encoding of
a growing text is a finite-state process: the last token of the encoding of a
prefix is the one vocabulary piece that ends there and is compatible with the
last token of the encoding of what lies before it (two pieces are compatible if
the merges of their joined text leave them as they are). A state therefore holds
the letters that a longer piece may still begin with and, of each place in them
where one may begin, the last token and the relative count; the transition on a
letter leads to the next state and carries the number of tokens by which the
count changes. States and transitions are compiled when first met
and shared by all texts of a task.

No piece holds a space behind another letter, so every start of a run of spaces
(and every letter outside the vocabulary, such as a line feed) resets the state.
A chunk of a text is thus a small state map: what lies before its first reset,
the count between its resets and what lies behind its last one. Maps compose
associatively; a long text is cut into chunks whose maps are composed by a
parallel prefix scan (pairwise tree).

Defined results: null text counts as empty; an empty text has 0 tokens; texts of
any length are counted whole; repeated rows and repeated or null ids give one
row each; other columns are ignored; an empty table gives none.
"""

from __future__ import annotations

import re
import struct
from functools import lru_cache
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame

from mercato.llm.common import Memo, arrow_rows, id_and_text

SPACE = "▁"
CHUNK = 1 << 16
MOST_STATES = 200_000


def _varint(b: bytes, i: int) -> tuple[int, int]:
    value = shift = 0
    while True:
        x = b[i]
        i += 1
        value |= (x & 127) << shift
        shift += 7
        if x < 128:
            return value, i


def _fields(b: bytes):
    """(field number, value) of a protocol buffer message."""
    i = 0
    while i < len(b):
        key, i = _varint(b, i)
        kind = key & 7
        if kind == 0:
            value, i = _varint(b, i)
        elif kind == 1:
            value, i = b[i : i + 8], i + 8
        elif kind == 5:
            value, i = b[i : i + 4], i + 4
        else:
            n, i = _varint(b, i)
            value, i = b[i : i + n], i + n
        yield key >> 3, value


def load_model(path: str) -> dict[str, float]:
    """Scores of the ordinary pieces of a sentencepiece BPE model file."""
    with open(path, "rb") as f:
        blob = f.read()
    pieces: dict[str, float] = {}
    for number, value in _fields(blob):
        if number == 1:
            piece = dict(_fields(value))
            if piece.get(3, 1) == 1:
                pieces[piece[1].decode()] = struct.unpack("<f", piece[2])[0]
            elif piece.get(3) in (4, 5):
                raise ValueError(f"{path}: user-defined or unused pieces are not supported")
        elif number == 2:
            trainer = dict(_fields(value))
            if trainer.get(3) != 2 or not trainer.get(35):
                raise ValueError(f"{path}: not a BPE model with byte fallback")
        elif number == 3:
            norm = dict(_fields(value))
            if norm.get(2) or norm.get(3, 1) != 1 or norm.get(4, 1) != 0 or norm.get(5, 1) != 1:
                raise ValueError(f"{path}: normalisation is not the plain one with a space in front")
    if any(SPACE in p.lstrip(SPACE) for p in pieces):
        raise ValueError(f"{path}: a piece holds a space behind another letter")
    return pieces


class Part(NamedTuple):
    """State map of a chunk: ``head`` before its first reset, the tokens between
    the resets, ``tail`` behind the last; without a reset all is ``head``."""

    head: str
    count: int
    tail: str | None


class Transducer:
    def __init__(self, pieces: dict[str, float]):
        self.rank = {p: -s for p, s in pieces.items()}
        self.prefixes = {p[:i] for p in pieces for i in range(1, len(p))}
        self.pair_ok = Memo(lambda ab: self._merge(ab[0] + ab[1]) == list(ab))
        self.own_ok = Memo(lambda p: self._merge(p) == [p])
        self._reset()
        self.segments = Memo(self._segment, 600_000)

    def _reset(self) -> None:
        self.states: list[tuple] = [("", (0,), (None,), (0,))]
        self.number = {self.states[0]: 0}
        self.step: list[dict[str, tuple[int, int]]] = [{}]

    def _merge(self, text: str) -> list[str]:
        """Merges of a short text by definition; only compiles transitions."""
        parts, rank = list(text), self.rank.get
        never = float("inf")
        ranks = [rank(a + b, never) for a, b in zip(parts, parts[1:])]
        while ranks and (low := min(ranks)) < never:
            i = ranks.index(low)
            parts[i] += parts.pop(i + 1)
            del ranks[i]
            if i < len(ranks):
                ranks[i] = rank(parts[i] + parts[i + 1], never)
            if i:
                ranks[i - 1] = rank(parts[i - 1] + parts[i], never)
        return parts

    def _compile(self, state: int, letter: str) -> tuple[int, int]:
        """A state: the letters that a longer piece may still begin with, and of
        each place in them where one may begin the last token and the count
        (against the present one) of the encoding up to there."""
        window, starts, last, counts = self.states[state]
        window += letter
        for start, before, count in zip(starts, last, counts):
            piece = window[start:]
            known = piece in self.rank
            if len(piece) > 1 and not (known and self.own_ok[piece]):
                continue
            if before is None or self.pair_ok[before, piece]:
                change = count + (1 if known else len(letter.encode("utf-8", "surrogatepass")))
                break
        else:
            raise AssertionError("no piece ends here")
        alive = [(s, b, c - change) for s, b, c in zip(starts, last, counts) if window[s:] in self.prefixes]
        alive.append((len(window), piece, 0))
        cut = alive[0][0]
        new = (window[cut:], tuple(s - cut for s, _, _ in alive), tuple(b for _, b, _ in alive), tuple(c for _, _, c in alive))
        if (number := self.number.get(new)) is None:
            number = self.number[new] = len(self.states)
            self.states.append(new)
            self.step.append({})
        self.step[state][letter] = number, change
        return number, change

    def _segment(self, segment: str) -> int:
        """Tokens of a segment that starts at a reset (spaces as U+2581)."""
        if len(self.states) > MOST_STATES:
            self._reset()
        state = total = 0
        step, compiled = self.step, self._compile
        for letter in segment.replace(" ", SPACE):
            state, change = step[state].get(letter) or compiled(state, letter)
            total += change
        return total

    # -- chunks -----------------------------------------------------------
    def part(self, chunk: str) -> Part:
        """State map of a chunk; ``chunk`` has spaces, no U+2581."""
        pieces = _segments(chunk)
        if len(pieces) < 2:
            return Part(chunk, 0, None)
        memo = self.segments
        return Part(pieces[0], sum(map(memo.__getitem__, pieces[1:-1])), pieces[-1])

    def compose(self, a: Part, b: Part) -> Part:
        """The map of two neighbouring chunks."""
        if a.tail is None:
            joined = self.part(a.head + b.head)
            if joined.tail is None:
                return Part(joined.head, b.count, b.tail) if b.tail is not None else joined
            return self.compose(joined, b._replace(head="")) if b.tail is not None else joined
        middle = _segments(a.tail + b.head)
        if b.tail is None:
            extra = sum(map(self.segments.__getitem__, middle[:-1]))
            return Part(a.head, a.count + extra, middle[-1] if middle else "")
        extra = sum(map(self.segments.__getitem__, middle))
        return Part(a.head, a.count + extra + b.count, b.tail)

    def scan(self, parts: list[Part]) -> Part:
        while len(parts) > 1:
            parts = [self.compose(*parts[i : i + 2]) if i + 1 < len(parts) else parts[i] for i in range(0, len(parts), 2)]
        return parts[0]

    def count(self, text: str) -> int:
        if not text:
            return 0
        if SPACE in text:
            text = text.replace(SPACE, " ")
        text = " " + text
        if len(text) <= CHUNK:
            return sum(map(self.segments.__getitem__, _segments(text)))
        whole = self.scan([self.part(text[i : i + CHUNK]) for i in range(0, len(text), CHUNK)])
        return sum(map(self.segments.__getitem__, [*_segments(whole.head), *_segments(whole.tail or "")])) + whole.count


#: A segment: a line feed (no piece holds one), or spaces and what follows them.
_segments = re.compile(r"\n| *[^ \n]+| +").findall


@lru_cache(maxsize=4)
def transducer(path: str) -> Transducer:
    pieces = load_model(path)
    if any("\n" in p for p in pieces):
        raise ValueError(f"{path}: a piece holds a line feed")
    return Transducer(pieces)


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, n_tokens, over_limit) of every whole text."""

    def make():
        t = transducer(model_path)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            texts = b.column(1).to_pylist()
            n = [t.count(x) for x in texts]
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([len(x.encode()) for x in texts], pa.int64()), pa.array(n, pa.int64()), pa.array([x > limit for x in n], pa.bool_())],
                names=["doc_id", "n_bytes", "n_tokens", "over_limit"],
            )

        return fn

    return arrow_rows(id_and_text(docs, id_col, text_col), make, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")

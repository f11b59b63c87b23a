"""Operator 10: byte-pair encoding and decoding by a contiguous rank array.

A word is a row of parts; beside the array of parts lies the array of the ranks
of all adjacent pairs. One step finds the smallest rank (the leftmost of equal
ones), deletes the boundary behind it and looks up the ranks of the two
neighbours anew. For short words both arrays sit in a few cache lines, so that a
full scan is cheaper than a queue. Words of one length are encoded together: the
arrays are rows of two matrices and each step works on all rows. Words of over
``LONG_WORD`` parts take a heap over linked parts, which gives the same merges in
n log n.

The vocabulary file is one of the `tokenizers` library (model BPE with an end of
word suffix, NFC, white space to one space, lower case, split by pattern, bytes
as letters); its path is a parameter. Words are encoded once per task and
memo-ised, so the work per text is one dictionary look-up per chunk between
white space.

Defined results: null text counts as empty, an empty text has no ids; texts of
any length are encoded whole; repeated rows and repeated or null ids give one
row each; other columns of the table are ignored; an empty table gives none.
"""

from __future__ import annotations

import hashlib
import heapq
import json
import re
import unicodedata
from functools import lru_cache
from itertools import filterfalse

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import regex
from pyspark.sql import DataFrame

from mercato.llm.common import arrow_rows, id_and_text, kept_in_stage

LONG_WORD = 200
#: Distinct words kept by a task, and bytes of text encoded at once.
MOST_WORDS = 600_000
TEXTS_AT_ONCE = 5_000_000
NO_PAIR = 1 << 40

#: Fixed: white space of Unicode (str.split takes U+001C to U+001F besides).
WHITE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def byte_letters() -> list[str]:
    """The letter that stands for each byte: printable Latin-1 bytes stand for
    themselves, the others for the letters from U+0100 on, in order."""
    out, spare = [], 0x100
    for b in range(256):
        if 0x21 <= b <= 0x7E or 0xA1 <= b <= 0xAC or 0xAE <= b <= 0xFF:
            out.append(chr(b))
        else:
            out.append(chr(spare))
            spare += 1
    return out


class WordBpe:
    """Encoder and decoder of one vocabulary file."""

    def __init__(self, path: str, most_words: int = MOST_WORDS):
        self.most_words = most_words
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or spec.get("decoder") or model.get("byte_fallback"):
            raise ValueError(f"{path}: not a plain BPE vocabulary without decoder")
        vocab: dict[str, int] = model["vocab"]
        self.suffix: str = model.get("end_of_word_suffix") or ""
        self.letters = byte_letters()
        self.first = {c: vocab.get(c, -1) for c in self.letters}
        self.last = {c: vocab.get(c + self.suffix, -1) for c in self.letters}
        self.pairs: dict[tuple[int, int], tuple[int, int]] = {}
        for rank, m in enumerate(model["merges"]):
            a, b = m.split(" ") if isinstance(m, str) else m
            self.pairs.setdefault((vocab[a], vocab[b]), (rank, vocab[a + b]))
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_re = re.compile("|".join(map(re.escape, sorted(self.specials, key=len, reverse=True)))) if self.specials else None
        steps = spec["pre_tokenizer"]["pretokenizers"]
        pattern = next(s["pattern"]["Regex"] for s in steps if s["type"] == "Split")
        self.split = regex.compile(pattern)
        # the same pattern, with the classes as they are among ASCII letters
        self.split_ascii = re.compile(pattern.replace(r"[\p{L}]", "[A-Za-z]").replace(r"[\p{N}]", "[0-9]").replace(r"\p{L}", "A-Za-z").replace(r"\p{N}", "0-9").encode(), re.ASCII)
        size = max([*vocab.values(), *self.specials.values()]) + 1
        names = [""] * size
        for t, i in [*vocab.items(), *self.specials.items()]:
            names[i] = t
        self.names = [n.encode() for n in names]
        keys = np.array([a * size + b for a, b in self.pairs], dtype=np.int64)
        order = np.argsort(keys)
        self.pair_keys = keys[order]
        self.pair_ranks = np.array([r for r, _ in self.pairs.values()], dtype=np.int64)[order]
        self.merged = np.zeros(len(model["merges"]), dtype=np.int64)
        for r, i in self.pairs.values():
            self.merged[r] = i
        self.size = size
        self.first_ids = np.array([self.first[c] for c in self.letters], dtype=np.int64)
        self.last_ids = np.array([self.last[c] for c in self.letters], dtype=np.int64)
        self.all_letters = bool((self.first_ids >= 0).all() and (self.last_ids >= 0).all())
        self.words: dict[bytes, bytes] = {}
        self.chunks: dict[bytes, bytes] = {}

    # -- encoding ---------------------------------------------------------
    def encode_word(self, word: str) -> tuple[int, ...]:
        """Ids of one word (already normalised) by the contiguous rank array."""
        chars = [self.letters[b] for b in word.encode("utf-8", "surrogatepass")]
        parts = [self.first[c] for c in chars[:-1]] + [self.last[chars[-1]]]
        parts = [p for p in parts if p >= 0]
        if len(parts) > LONG_WORD:
            return tuple(self._merge_long(parts))
        pairs = self.pairs
        none = (NO_PAIR, -1)
        ranks = [pairs.get(x, none)[0] for x in zip(parts, parts[1:])]
        while ranks:
            low = min(ranks)
            if low == NO_PAIR:
                break
            i = ranks.index(low)
            parts[i] = pairs[parts[i], parts[i + 1]][1]
            del parts[i + 1], ranks[i]
            if i < len(ranks):
                ranks[i] = pairs.get((parts[i], parts[i + 1]), none)[0]
            if i:
                ranks[i - 1] = pairs.get((parts[i - 1], parts[i]), none)[0]
        return tuple(parts)

    def _merge_long(self, parts: list[int]) -> list[int]:
        n, pairs = len(parts), self.pairs
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(pairs[x][0], i, x) for i, x in enumerate(zip(parts, parts[1:])) if x in pairs]
        heapq.heapify(heap)
        while heap:
            _, i, (a, b) = heapq.heappop(heap)
            j = after[i]
            if parts[i] != a or j >= n or parts[j] != b:
                continue
            parts[i], parts[j] = pairs[a, b][1], -1
            after[i] = k = after[j]
            if k < n:
                before[k] = i
            for left, right in ((before[i], i), (i, k)):
                if left >= 0 and right < n and (x := (parts[left], parts[right])) in pairs:
                    heapq.heappush(heap, (pairs[x][0], left, x))
        return [p for p in parts if p >= 0]

    def _ranks(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        key = a * self.size + b
        at = np.minimum(np.searchsorted(self.pair_keys, key), len(self.pair_keys) - 1)
        return np.where(self.pair_keys[at] == key, self.pair_ranks[at], NO_PAIR)

    def _encode_rows(self, words: list[bytes]) -> list[bytes]:
        """The same for many words of one length at once: each row of ``parts``
        and ``ranks`` is the pair of arrays of one word, and every step deletes
        one boundary of each row that still has a pair to merge."""
        n = len(words[0])
        letters = np.frombuffer(b"".join(words), dtype=np.uint8).reshape(len(words), n)
        parts = self.first_ids[letters]
        parts[:, -1] = self.last_ids[letters[:, -1]]
        ranks = self._ranks(parts[:, :-1], parts[:, 1:])
        row = np.arange(len(words))
        out: list[bytes] = [b""] * len(words)

        def done(which: np.ndarray) -> None:
            for r, ids in zip(row[which].tolist(), parts[which].astype("<u4")):
                out[r] = ids.tobytes()

        while len(row) and ranks.shape[1]:
            low = ranks.min(axis=1)
            if (end := low == NO_PAIR).any():
                done(end)
                row, parts, ranks, low = row[~end], parts[~end], ranks[~end], low[~end]
                if not len(row):
                    break
            at, line, width = ranks.argmin(axis=1), np.arange(len(row)), parts.shape[1]
            parts[line, at] = self.merged[low]
            keep = np.ones(parts.shape, dtype=bool)
            keep[line, at + 1] = False
            parts = parts[keep].reshape(len(row), width - 1)
            keep = np.ones(ranks.shape, dtype=bool)
            keep[line, at] = False
            ranks = ranks[keep].reshape(len(row), width - 2)
            right = np.flatnonzero(at < width - 2)
            ranks[right, at[right]] = self._ranks(parts[right, at[right]], parts[right, at[right] + 1])
            left = np.flatnonzero(at > 0)
            ranks[left, at[left] - 1] = self._ranks(parts[left, at[left] - 1], parts[left, at[left]])
        done(np.ones(len(row), dtype=bool))
        return out

    def _add_words(self, words: set[bytes]) -> None:
        by_length: dict[int, list[bytes]] = {}
        for w in words:
            by_length.setdefault(len(w), []).append(w)
        for n, group in by_length.items():
            if n > LONG_WORD or len(group) < 8 or not self.all_letters:
                for w in group:
                    self.words[w] = np.array(self.encode_word(w.decode("utf-8", "surrogatepass")), dtype="<u4").tobytes()
            else:
                rows = max(1, (1 << 19) // n)
                for i in range(0, len(group), rows):
                    some = group[i : i + rows]
                    self.words.update(zip(some, self._encode_rows(some)))

    def _split(self, text: str) -> list[bytes]:
        if text.isascii():
            return self.split_ascii.findall(text.lower().encode())
        # letter by letter, as the library does: no final sigma
        found = self.split.findall(unicodedata.normalize("NFC", text).replace("Σ", "σ").lower())
        return [w.encode("utf-8", "surrogatepass") for w in found]

    def _pieces(self, chunk: bytes) -> list[bytes | int]:
        """Words of a chunk without white space of ASCII; special strings as their ids."""
        special = self.special_re is not None and b"<" in chunk
        if not special and chunk.isascii():
            return self.split_ascii.findall(chunk.lower())
        out: list[bytes | int] = []
        for text in _white_split(chunk.decode("utf-8", "surrogatepass")):
            at = 0
            for m in self.special_re.finditer(text) if special else ():
                out += self._split(text[at : m.start()])
                out.append(self.specials[m[0]])
                at = m.end()
            out += self._split(text[at:])
        return out

    def _chunk_ids(self, chunks: list[bytes]) -> list[bytes]:
        """Ids of different chunks without white space of ASCII, each new one encoded once."""
        if len(self.chunks) > self.most_words:
            often = set(chunks)
            self.chunks = {c: v for c, v in self.chunks.items() if c in often}
        ids = list(map(self.chunks.get, chunks))
        new = [i for i, own in enumerate(ids) if own is None]
        pieces: list[bytes | list[bytes | int]] = []
        used: set[bytes] = set()
        for i in new:
            c = chunks[i]
            if c.isalpha():  # letters of ASCII alone: one word
                p = c.lower()
                used.add(p)
            else:
                p = self._pieces(c)
                used.update([w for w in p if type(w) is bytes])
            pieces.append(p)
        if len(self.words) > self.most_words:
            self.words = {w: v for w, v in self.words.items() if w in used}
        words = self.words
        self._add_words(used.difference(words))
        for i, p in zip(new, pieces):
            own = words[p] if type(p) is bytes else b"".join([words[w] if type(w) is bytes else w.to_bytes(4, "little") for w in p])
            ids[i] = self.chunks[chunks[i]] = own
        return ids

    def encode_many(self, texts: list[str] | pa.Array, at_once: int = TEXTS_AT_ONCE) -> list[bytes]:
        """Ids of whole texts as little-endian unsigned 32-bit integers, of about
        ``at_once`` bytes of text at a time.

        No merge, letter or special string spans white space, so the chunks
        between it are encoded one by one, each different one of these texts once;
        the ids of a text are those of its chunks, gathered as one column."""
        if not isinstance(texts, pa.Array):
            texts = pa.array([t.encode("utf-8", "surrogatepass") for t in texts], pa.large_binary()).view(pa.large_string())
        plain = pa.large_binary() if pa.types.is_large_string(texts.type) else pa.binary()
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False), dtype=np.int64)
        out: list[bytes] = []
        lo = 0
        while lo < len(texts):
            before = ends[lo - 1] if lo else 0
            hi = min(int(np.searchsorted(ends, before + at_once)) + 1, len(texts))
            chunks = pc.ascii_split_whitespace(texts.slice(lo, hi - lo))
            coded = chunks.flatten().dictionary_encode()
            known = pa.array(self._chunk_ids(coded.dictionary.view(plain).to_pylist()), pa.large_binary())
            ids = known.take(coded.indices)
            _, starts, data = ids.buffers()
            at = np.frombuffer(starts, dtype=np.int64)[chunks.offsets.to_numpy()].tolist() if len(ids) else [0] * (hi - lo + 1)
            raw = memoryview(data) if data is not None else b""
            out += [bytes(raw[i:j]) for i, j in zip(at, at[1:])]
            lo = hi
        return out

    def encode(self, text: str) -> bytes:
        return self.encode_many([text])[0]

    # -- decoding ---------------------------------------------------------
    def decode(self, ids: bytes) -> bytes:
        """UTF-8 of the decoded text: without a decoder the names of the tokens,
        joined by a space."""
        return b" ".join(map(self.names.__getitem__, np.frombuffer(ids, dtype="<u4").tolist()))


_white_split = re.compile(f"[{WHITE}]+").split


@lru_cache(maxsize=4)
def word_bpe(path: str, most_words: int = MOST_WORDS) -> WordBpe:
    return WordBpe(path, most_words)


@lru_cache(maxsize=1)
def stage_bpe(path: str, most_words: int) -> WordBpe:
    """The same for one stage: a worker that begins with another one drops it."""
    return WordBpe(path, most_words)


kept_in_stage(stage_bpe.cache_clear)


def encode_decode(docs: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, ids binary, decoded): the token ids of every whole text as
    little-endian unsigned 32-bit integers and the text they decode to."""

    def make():
        bpe = word_bpe(vocab_path)

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            ids = bpe.encode_many(b.column(1))
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ids, pa.binary()), pa.array([bpe.decode(i).decode() for i in ids], pa.string())],
                names=["doc_id", "ids", "decoded"],
            )

        return fn

    return arrow_rows(id_and_text(docs, id_col, text_col), make, "doc_id long, ids binary, decoded string")


def bpe_digests(docs: DataFrame, vocab_path: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256): digests of
    ``encode_decode`` taken beside the data, so that ids and decoded texts are
    not carried further."""

    def make():
        bpe = word_bpe(vocab_path)
        sha = hashlib.sha256

        def fn(b: pa.RecordBatch) -> pa.RecordBatch:
            n, ids_hex, dec_hex = [], [], []
            for ids in bpe.encode_many(b.column(1)):
                n.append(len(ids) // 4)
                ids_hex.append(sha(ids).hexdigest())
                dec_hex.append(sha(bpe.decode(ids)).hexdigest())
            return pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(ids_hex, pa.string()), pa.array(dec_hex, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

        return fn

    return arrow_rows(id_and_text(docs), make, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")

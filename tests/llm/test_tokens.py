import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from mercato.llm.bpe import LONG_WORD, bpe_digests, encode_decode, word_bpe
from mercato.llm.packing import differencing, fill_windows, pack
from mercato.llm.token_counts import CHUNK, token_counts, transducer

LETTERS = "abcdeinthros  \n\u2581\u00e9\u00df\u03a3\u03c3\u03c2\u65e5\u672c\u8a9e0123<>x_-=()\t'\" \x1cc\u0301\u0130I\u01c5 \u00bd\u00b2\u0663's't're\u0085\u00a0"


def texts(n, seed):
    rnd = random.Random(seed)
    out = ["".join(rnd.choice(LETTERS) for _ in range(rnd.randrange(0, 80))) for _ in range(n)]
    return out + [x[:9] + "<|endoftext|>" + x[9:] for x in out[: n // 5]] + ["", " ", "\n\n", "the " * 3000, "e" * 5 * LONG_WORD, "etaoin" * 300]


@pytest.fixture(scope="module")
def libraries():
    P = pytest.importorskip("public_tokenizers")
    import sentencepiece
    from tokenizers import Tokenizer

    return Tokenizer.from_file(P.path("word_bpe_49k.json")), sentencepiece.SentencePieceProcessor(model_file=P.path("piece_bpe_32k.model"))


def test_bpe_equals_the_library(libraries, vocab):
    lib = libraries[0]
    bpe = word_bpe(vocab("word_bpe_49k.json"))
    some = texts(1500, 1)
    for text, ids in zip(some, bpe.encode_many(some)):
        want = lib.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want, text
        assert bpe.decode(ids).decode() == lib.decode(want, skip_special_tokens=False)


def test_bpe_of_columns(vocab):
    """A column of texts is encoded as it is, whole or sliced and some texts at a time, as its texts one by one."""
    bpe = word_bpe(vocab("word_bpe_49k.json"))
    some = [*texts(300, 5), "a\u2028B\x1fc\u3000<|endoftext|>\u00a0d", "\ud800 x"]
    want = [bpe.encode(t) for t in some]
    assert bpe.encode_many(some, 200) == bpe.encode_many(some) == want
    for kind in (pa.string(), pa.large_string()):
        column = pa.array(some[:-1], kind)
        assert bpe.encode_many(column) == bpe.encode_many(column, 50) == want[:-1]
        assert bpe.encode_many(column.slice(7, 90), 100) == want[7:97]
        assert bpe.encode_many(column.slice(0, 0)) == [] and bpe.encode_many(pa.array(["", " \n"], kind)) == [b"", b""]


def test_rank_arrays_heap_and_rows_agree(vocab):
    bpe = word_bpe(vocab("word_bpe_49k.json"))
    rnd = random.Random(3)
    words = ["".join(rnd.choice("etaoinshr") for _ in range(12)) for _ in range(200)]
    rows = bpe._encode_rows([w.encode() for w in words])
    for w, r in zip(words, rows):
        one = bpe.encode_word(w)
        parts = [bpe.first[c] for c in w[:-1]] + [bpe.last[w[-1]]]
        assert list(one) == np.frombuffer(r, "<u4").tolist() == bpe._merge_long(parts)


def test_bpe_tables(docs_of, vocab):
    path = vocab("word_bpe_49k.json")
    rows = [(1, "The cat"), (1, "The cat"), (None, None), (3, ""), (4, "w" * 30_000)]
    got = sorted(bpe_digests(docs_of(rows), path).collect(), key=str)
    assert len(got) == 5
    assert sum(r.n_tokens == 0 for r in got) == 2
    assert bpe_digests(docs_of([]), path).count() == 0
    full = encode_decode(docs_of(rows[:1]), path).first()
    assert full.decoded == "the</w> cat</w>" and len(full.ids) == 8


def test_counts_equal_the_library(libraries, vocab):
    sp = libraries[1]
    t = transducer(vocab("piece_bpe_32k.model"))
    some = texts(1500, 2) + [" " * k + w for k in range(1, 40) for w in ("", "hi", "\n", "<0x0A>", "<s>")]
    for text in some:
        assert t.count(text) == len(sp.encode(text)), text


def test_chunk_maps_compose(libraries, vocab):
    sp = libraries[1]
    t = transducer(vocab("piece_bpe_32k.model"))
    rnd = random.Random(5)
    long = "".join(rnd.choice(["the ", "   ", "abc", "\n", "ühm ", "x" * 40]) for _ in range(20_000))
    assert len(long) > 2 * CHUNK and t.count(long) == len(sp.encode(long))
    for _ in range(60):
        text = " " + "".join(rnd.choice("ab \nthe▁".replace("▁", " ")) for _ in range(60))
        cuts = sorted(rnd.sample(range(1, 60), 4))
        parts = [t.part(text[a:b]) for a, b in zip([0, *cuts], [*cuts, len(text)])]
        left = parts[0]
        for p in parts[1:]:
            left = t.compose(left, p)
        assert sum(map(t._segment, t_segments(left.head))) + left.count + sum(map(t._segment, t_segments(left.tail or ""))) == sum(map(t._segment, t_segments(text)))


def t_segments(text):
    from mercato.llm.token_counts import _segments

    return _segments(text)


def test_count_tables(docs_of, vocab):
    path = vocab("piece_bpe_32k.model")
    rows = [(1, "the cat"), (1, "the cat"), (None, None), (2, "é" * 20_000)]
    got = {r.doc_id: r for r in token_counts(docs_of(rows), path).collect()}
    assert got[None].n_tokens == 0 and got[None].n_bytes == 0
    assert got[2].n_bytes == 40_000 and got[2].over_limit
    assert token_counts(docs_of([]), path).count() == 0


def test_differencing_is_near_equal():
    rnd = random.Random(1)
    sizes = [rnd.randrange(1, 500) for _ in range(300)]
    parts = differencing(sizes, 16)
    assert sorted(i for p in parts for i in p) == list(range(300))
    sums = [sum(sizes[i] for i in p) for p in parts]
    assert max(sums) - min(sums) <= 60
    assert differencing([], 3) == [[], [], []]
    assert differencing([5, 5, 5], 1) == [[0, 1, 2]]


@pytest.mark.parametrize("seed", range(20))
def test_windows_hold_everything_within_capacity(seed):
    rnd = random.Random(seed)
    sizes = [rnd.randrange(1, 65) for _ in range(rnd.randrange(1, 60))]
    windows = fill_windows(sizes, 64)
    assert len(windows) <= sum(sizes) // 64 + 1
    seen = {}
    for w in windows:
        assert sum(n for _, _, n in w) <= 64
        for i, at, n in w:
            seen.setdefault(i, set()).update(range(at, at + n))
    assert {i: len(x) for i, x in seen.items()} == dict(enumerate(sizes))


def test_packing_keeps_every_id_once(docs_of, vocab):
    path = vocab("word_bpe_49k.json")
    rnd = random.Random(4)
    rows = [(i, " ".join(rnd.choice(["the", "cat", "overthrow", "x9"]) for _ in range(rnd.randrange(0, 200)))) for i in range(60)]
    rows += [(100, None), (101, ""), (102, "a b " * 500), (102, "a b " * 500), (None, "x")]
    pieces = pack(docs_of(rows), path, capacity=64, windows=4, with_ids=True).collect()
    bpe = word_bpe(path)
    want = sorted(ids + b"\1\0\0\0" for ids in bpe.encode_many([t or "" for _, t in rows]))
    by_seq = {}
    for p in pieces:
        by_seq.setdefault(p.sequence_id, []).append(p)
        assert zlib.crc32(p.ids) == p.ids_crc32 and len(p.ids) == 4 * p.length
    assert sorted(by_seq) == list(range(len(by_seq)))
    for ps in by_seq.values():
        at = 0
        for p in sorted(ps, key=lambda p: p.offset):
            assert p.offset == at
            at += p.length
        assert at <= 64
    got = {}
    for p in pieces:
        got.setdefault((p.doc_id, p.doc_tokens), {}).setdefault(p.start, []).append(p.ids)
    assert sum(p.length for p in pieces) == sum(len(w) // 4 for w in want)
    for (doc, total), starts in got.items():
        if doc not in (102,):
            whole = b"".join(starts[s][0] for s in sorted(starts))
            assert len(whole) == 4 * total and whole in want
    full = sum(len(w) // 4 for w in want)
    parts = docs_of(rows).rdd.getNumPartitions()
    assert len(by_seq) * 64 - full <= 64 * parts
    assert pack(docs_of([]), path).count() == 0

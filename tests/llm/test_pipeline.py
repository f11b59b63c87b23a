import pytest
from llm_brute import brute_components, brute_lines, brute_sets

import corpus_pipeline as C
from mercato.llm import common
from mercato.llm import secret_scan as S
from mercato.llm.line_dedup import normalised
from mercato.llm.packing import pack
from mercato.llm.queries import WORD_VOCAB, tokenizer_file

LONG = " ".join("abcdefgh"[k % 8] * 3 + "mnopq"[k // 8] for k in range(40))
ROWS = [
    (1, f"{LONG}\nsame line of two documents here"),
    (2, "quite another text of its own\nsame line of two documents here"),
    (3, "same line of two documents here"),
    (4, None),
    (5, ""),
    (6, "some words\napi_key = abcdefgh12345678 is kept"),
    (7, " ".join(LONG.split()[:20]) + "\n" + " ".join(LONG.split()[20:])),
    (8, "no text like this one is anywhere\n\nlast"),
    (8, "no text like this one is anywhere\n\nlast"),
    (None, "a row without a name"),
]


def rows_of(df):
    return sorted(((r.doc_id, r.text) for r in df.select("doc_id", "text").collect()), key=str)


def expected(rows):
    """What the line stage, the near copies and the secret scan leave, by brute force."""
    named = [(-1 if i is None else i, t) for i, t in rows]
    lines = brute_lines([(i, t or "") for i, t in dict(named).items()])
    after = [(i, t if t is None else lines[i]) for i, t in named]
    after = [(i, t) for (i, t), (_, old) in zip(after, named) if t == old or normalised(t or "")]
    label = brute_components(brute_sets([r for r in after if r[0] != -1]))
    near, seen = [], set()
    for i, t in after:  # one row of each class; rows without words are in none
        if i == -1 or not normalised(t or ""):
            near.append((i, t))
        elif label[i] == i and i not in seen:
            seen.add(i)
            near.append((i, t))
    back = lambda out: sorted([(None if i == -1 else i, t) for i, t in out], key=str)
    return back(after), back(near), back([(i, t if t is None else S.redact(t)) for i, t in near])


@pytest.fixture()
def tables(spark, docs_of, tmp_path):
    def make(rows, name):
        base = str(tmp_path / name)
        docs_of(rows).write.parquet(f"{base}/documents.parquet")
        spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{base}/labels.parquet")
        return base

    return make


def test_stages_equal_brute_force(spark, vocab, tables):
    base = tables(ROWS, "full")
    docs = spark.read.parquet(f"{base}/documents.parquet")
    columns = docs.columns
    lines, near, clean = expected(ROWS)
    stages = dict(C.STAGES)
    assert rows_of(stages["quality_classifier"](spark, docs, base)) == rows_of(docs)
    for name, want in (("line_dedup", lines), ("ngram_jaccard_join", near), ("secret_scan", clean)):
        docs = stages[name](spark, docs, base)
        assert docs.columns == columns and rows_of(docs) == want, name
        docs = spark.createDataFrame(docs.collect(), docs.schema)
    assert 3 not in {i for i, _ in lines} and 7 not in {i for i, _ in clean}

    def tokens(pieces):
        return sorted({(r.doc_id, r.doc_tokens) for r in pieces.collect()}, key=str)

    assert tokens(C.run(spark, base)) == tokens(pack(docs, tokenizer_file(WORD_VOCAB)))


def test_pipeline_of_an_empty_table(spark, vocab, tables):
    assert C.run(spark, tables([], "none")).count() == 0


def test_a_worker_drops_the_memos_of_another_stage(monkeypatch):
    dropped = []
    monkeypatch.setattr(common, "_KEPT_MEMOS", [])
    monkeypatch.setattr(common, "_FILLED_BY", [])
    common.kept_in_stage(lambda: dropped.append(True))
    common.begin_stage(3)
    common.begin_stage(3)
    assert not dropped
    common.begin_stage(4)
    assert len(dropped) == 1


def test_packing_in_small_parts_is_the_same(docs_of, vocab):
    path = tokenizer_file(WORD_VOCAB)
    texts = [(i, " ".join(f"word{i * k}" for k in range(5 * i))) for i in range(60)] + [(90, None), (91, "")]
    want = sorted(map(tuple, pack(docs_of(texts), path).collect()))
    assert sorted(map(tuple, pack(docs_of(texts), path, most_words=7, rows_at_once=3, letters_at_once=50).collect())) == want

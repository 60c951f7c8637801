import public_tokenizers as P
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemart.llm import queries, tokencount

PATH = P.path("piece_bpe_32k.model")
PIECES = ["a", "b", " ", "\n", "é", "日", "1", "the", "aaaa", "   ", "'s", "ing", "😀", "ß", "▁", "́", "Ա", "</s>", "<0x41>"]
LIBRARY = sentencepiece.SentencePieceProcessor(model_file=PATH)


def texts():
    return st.lists(st.sampled_from(PIECES), max_size=60).map("".join) | st.text(max_size=60)


@settings(max_examples=300, deadline=None)
@given(texts())
def test_as_the_library(text):
    machine = tokencount.transducer(PATH)
    assert machine.count(tokencount.prepared(text)) == len(LIBRARY.encode(text))


@settings(max_examples=200, deadline=None)
@given(texts(), st.integers(1, 9))
def test_chunk_maps_compose(text, size):
    machine, text = tokencount.transducer(PATH), tokencount.prepared(text)
    maps = [machine.chunk_map(text[i : i + size]) for i in range(0, len(text), size)]
    whole = ("", False, 0, "")
    for m in maps:
        whole = machine.compose(whole, m)
    right = ("", False, 0, "")
    for m in reversed(maps):
        right = machine.compose(m, right)
    assert machine.total(whole) == machine.total(right) == machine.run(machine.start, text)[1]


def test_without_memory(monkeypatch):
    machine = tokencount.transducer(PATH)
    monkeypatch.setattr(tokencount, "MAX_STATES", 10)
    monkeypatch.setattr(tokencount, "CHUNK", 50)
    for text in ["hello there world", "x" * 500, "the end", "many words in several chunks " * 20]:
        machine.trim()
        assert machine.count(tokencount.prepared(text)) == len(LIBRARY.encode(text))


def test_operators(spark):
    rows = [(1, "Hello the world\n"), (None, None), (1, ""), (2, "long words " * 20_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("n_tokens", F.lit("clashes"))
    out = tokencount.with_token_counts(df, PATH, 4096).collect()
    assert [r.n_tokens for r in out] == [len(LIBRARY.encode(t or "")) for _, t in rows]
    assert [r.n_bytes for r in out] == [len((t or "").encode()) for _, t in rows]
    assert [r.over_limit for r in out] == [False, False, False, True]
    assert tokencount.with_token_counts(df.limit(0), PATH, 1).count() == 0
    text = "A text that is stored   in chunks, aaaaaa.\n" * 40
    parts = [(7, i, text[i : i + 13]) for i in range(0, len(text), 13)] + [(8, 0, None)]
    chunked = tokencount.count_chunked(spark.createDataFrame(parts, "k long, at long, text string"), PATH, "k", "at")
    assert dict(map(tuple, chunked.collect())) == {7: len(LIBRARY.encode(text)), 8: 0}


def test_query_as_the_library(spark):
    """Every document of a whole table, against the library."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    ids = sorted(texts)
    expected = {i: len(t) for i, t in zip(ids, LIBRARY.encode([texts[i] for i in ids], num_threads=1), strict=True)}
    out = queries.op4_token_counts(spark, sf).collect()
    assert len(out) == len(ids) and {r.doc_id: r.n_tokens for r in out} == expected
    assert all(r.n_bytes == len(texts[r.doc_id].encode()) and r.over_limit == (r.n_tokens > 4096) for r in out)


@pytest.mark.parametrize("fold", [2, 5])
def test_chunks_are_composed_in_rounds(spark, monkeypatch, fold):
    monkeypatch.setattr(tokencount, "FOLD", fold)
    texts = {1: "A text that is stored   in chunks, aaaaaa.\n" * 12, 2: "b" * 90, 3: "", None: "no key\tat all é漢"}
    parts = [(k, i, t[i : i + 7]) for k, t in texts.items() for i in range(0, max(len(t), 1), 7)]
    found = tokencount.count_chunked(spark.createDataFrame(parts, "rn long, run long, head string"), PATH, "rn", "run", "head")
    assert dict(map(tuple, found.collect())) == {k: len(LIBRARY.encode(t)) for k, t in texts.items()}

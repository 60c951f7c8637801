import hashlib
import random

import public_tokenizers as P
import pytest
import tiktoken
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagemart.llm import bpe, queries

PATH = P.path("byte_bpe_multi_50k.tiktoken")
PIECES = ["a", "b", " ", "\n", "é", "日", "1", "the", "aaaa", "   ", "'s", "ing", "😀", "ß", "́"]


@pytest.fixture(scope="module")
def v():
    return bpe.vocabulary(PATH, P.PATTERN)


@pytest.fixture(scope="module")
def library(v):
    return tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.ranks, special_tokens={})


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(PIECES), max_size=60).map("".join) | st.text(max_size=80))
def test_as_the_library(text):
    v = bpe.vocabulary(PATH, P.PATTERN)
    library = tiktoken.Encoding("own", pat_str=P.PATTERN, mergeable_ranks=v.ranks, special_tokens={})
    assert v.encode(text) == library.encode_ordinary(text)
    assert v.decode(v.encode(text)) == text.encode()


def test_fits_is_the_definition(v):
    r = random.Random(3)
    for _ in range(2000):
        a, b = r.randrange(len(v.bytes_of)), r.randrange(len(v.bytes_of))
        assert v.fits(a, b) == (bpe.merge_bytes(v.bytes_of[a] + v.bytes_of[b], v.ranks) == [a, b])


def test_one_long_piece(v, library):
    text = "ab" * 4000 + "é" * 500
    assert v.encode(text) == library.encode_ordinary(text)


def test_appends_and_edits(v, library):
    r = random.Random(1)
    for _ in range(200):
        text = "".join(r.choice(PIECES) for _ in range(r.randint(0, 40)))
        kept = bpe.EncodedText(v, text)
        i = r.randint(0, len(text))
        j = r.randint(i, len(text))
        new = r.choice(["", " x", "q\n", "\n ", "tion"])
        kept.edit(i, j, new)
        text = text[:i] + new + text[j:]
        kept.append(" more")
        assert kept.tokens() == library.encode_ordinary(text + " more")


def test_edits_compute_little(v, library):
    table = bpe.PrefixTable(v, b"thereandbackagain" * 60)
    before = table.computed
    table.edit(500, 502, b"qq")
    assert table.tokens() == library.encode_ordinary(table.data.decode())
    assert table.computed - before < 3 * v.longest < len(table.data)


def test_operators(spark, v):
    rows = [(1, "Hello the world\n"), (None, None), (1, ""), (2, "x" * 100_000)]
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumn("ids", F.lit("clashes"))
    out = bpe.decode(bpe.encode(df, PATH, P.PATTERN), PATH, P.PATTERN).collect()
    assert [bytes(r.decoded).decode() for r in out] == [t or "" for _, t in rows]
    digests = bpe.round_trip(df, PATH, P.PATTERN).collect()
    for (i, text), r in zip(rows, digests, strict=True):
        ids = v.encode(text or "")
        assert (r.doc_id, r.n_tokens) == (i, len(ids))
        assert r.ids_sha256 == hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    assert bpe.round_trip(df.limit(0), PATH, P.PATTERN).count() == 0


def test_query_as_the_library(spark, library):
    """Every document of a whole table, against the library."""
    sf = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text or "" for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    out = queries.op3_bpe(spark, sf).collect()
    assert len(out) == len(texts)
    for r in out:
        ids = library.encode_ordinary(texts[r.doc_id])
        assert (r.n_tokens, r.ids_sha256) == (len(ids), hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest())
        assert r.decoded_sha256 == hashlib.sha256(library.decode_bytes(ids)).hexdigest() == hashlib.sha256(texts[r.doc_id].encode()).hexdigest()

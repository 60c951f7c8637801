import corpus_pipeline
from pyspark.sql import functions as F

from pagemart.llm import bpe, langid, quality, queries
from pagemart.llm.queries import RANKS
from pagemart.llm.shared import stored

SF = "/root/testdata/sf0.001"


def test_against_plain_python(spark):
    """The same decisions taken row by row on the driver."""
    import public_tokenizers as P
    from test_simhash import brute_components, brute_print

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    net = quality.train(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    prototypes = langid.train(docs)
    rows = sorted((r.doc_id, r.text) for r in docs.select("doc_id", "text").collect())
    rows = [r for r in rows if net.scores([(r[1] or "").encode()])[0] >= 0.5]
    bundler = langid.Bundler()

    def language(text):
        v = bundler.vector(text or "")
        return v is not None and max(float(p @ v) for p in prototypes.values()) >= corpus_pipeline.LEAST_COSINE * float((v @ v) ** 0.5)

    rows = [r for r in rows if language(r[1])]
    groups = brute_components([brute_print(t) for _, t in rows])
    rows = [r for i, r in enumerate(rows) if groups[i] == i]
    from oracle import connect

    bad = {r[0] for r in connect(SF).sql(queries.OP9).fetchall()}
    expected = sorted((i, len(bpe.vocabulary(P.path(RANKS), P.PATTERN).encode(t or ""))) for i, t in rows if i not in bad)
    assert sorted((r.doc_id, r.n_tokens) for r in corpus_pipeline.run(spark, SF).collect()) == expected
    assert len(expected) > 50


def test_stages_keep_columns_and_take_odd_rows(spark):
    odd = spark.createDataFrame([(None, None, None, None, None), (1, "", "en", "s", 0), (2, "the cat and the dog are here " * 9, None, "s", None), (2, "the cat and the dog are here " * 9, None, "s", None)], "doc_id long, text string, lang string, source string, n_chars long").withColumns({name: F.lit(1) for name in ("score", "_p", "found", "gone", "id", "key", "fingerprint", "root", "label", "predicted", "lang_pred", "_found", "a.b")})
    for rows in (odd, odd.limit(0)):
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stored(stage(spark, rows, SF), "t")
            assert out.columns == odd.columns and out.count() <= 4
        assert corpus_pipeline.STAGES[-1][1](spark, rows, SF).count() == rows.count()

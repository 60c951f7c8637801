"""A corpus in five stages: quality, language, near-duplicates, benchmark items, tokens.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and works on
all that the one before it kept. All but the last return the columns of documents.
Models are fitted on the documents and labels of sf_dir.

Cases: null and empty texts get the scores their operators define (an empty text
has no letter, so the language stage rejects it); repeated rows of one id count as
near-duplicates of each other; very long texts are read whole; no rows go through as
no rows; columns beyond those of documents, whatever their names, are carried along
by the filters.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagemart.llm import bpe, decontam, langid, quality, simhash
from pagemart.llm.queries import RANKS, table
from pagemart.llm.shared import stored

#: Texts whose vector is this far from all languages are rejected. It is twice the cosine that unrelated vectors of
#: 1024 numbers have by chance (0.031). Of 1,000 documents of the test tables the least similar, a word of five
#: letters, has 0.091; texts of letters that no language was learned with had -0.01 to 0.05.
LEAST_COSINE = 0.06


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier gives label 1."""
    net = quality.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return docs.where(quality.score(F.col("text"), net) >= 0.5)


def keep_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a known language."""
    prototypes = langid.train(table(spark, sf_dir, "documents"))
    return langid.keep_known(docs, prototypes, least=LEAST_COSINE)


def keep_one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of near-duplicates."""
    return simhash.one_of_each(docs)


def keep_uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark items."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The kept documents' ids with the digests of their tokens and of the bytes decoded from them."""
    return bpe.round_trip(docs, public_tokenizers.path(RANKS), public_tokenizers.PATTERN)


STAGES = [
    ("quality", keep_quality),
    ("language", keep_language),
    ("near_duplicates", keep_one_of_each),
    ("decontamination", keep_uncontaminated),
    ("tokens", tokens),
]

#: The stages' models and hashes are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages, one after the other, each written to the shared folder."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs

"""Language identification by hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn by a generator seeded with its
code point (in lower case), so no two letters share one. An n-gram's vector binds
its letters' vectors by multiplication, each permuted (rotated) by its place from
the end. A text's vector bundles (sums) those of all its n-grams, runs of anything
but letters counting as one gap; a language's prototype bundles those of its
training texts. A text gets the language whose prototype has the largest cosine
with its vector.

Cases: null text and text without letters are "und" with score 0; no training
rows make everything "und"; ties go to the language first in order; a null id is
never held out and never learned from; very long texts are read whole, their
n-grams counted once; repeated rows are predicted each, and each is learned from;
an input column named lang_pred or score is replaced, all others are kept,
whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart.llm.shared import crc_mod, free_name, quoted, sampled

#: Length of the vectors, letters of an n-gram, training texts of a language, seed of the letters.
SIZE, N, TRAIN_TEXTS, SEED = 1024, 3, 2000, 20240229
UNKNOWN = "und"
#: Bits of a code point; three letters fit into a long.
BITS = 21


@lru_cache(maxsize=1)
def _codes() -> np.ndarray:
    """Code point -> 0 for what is no letter, else the code point of its lower case."""
    table = np.zeros(0x110000, np.int32)
    for code in range(0x110000):
        char = chr(code)
        if char.isalpha():
            table[code] = ord(char.lower()[0])
    return table


@lru_cache(maxsize=16_384)
def letter(code: int) -> np.ndarray:
    """The vector of a code point; 0 is the gap's."""
    return np.random.default_rng((SEED, code)).integers(0, 2, SIZE, np.int8) * np.int8(2) - np.int8(1)


def grams(text: str) -> tuple[np.ndarray, np.ndarray] | None:
    """The distinct n-grams (as numbers) and their counts; None without letters."""
    codes = _codes()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not codes.any():
        return None
    codes = np.concatenate([[0], codes, [0]])
    codes = codes[np.r_[True, (codes[1:] != 0) | (codes[:-1] != 0)]].astype(np.int64)
    if len(codes) < N:
        codes = np.concatenate([codes, np.zeros(N - len(codes), np.int64)])
    number = np.zeros(len(codes) - N + 1, np.int64)
    for i in range(N):
        number = number << BITS | codes[i : len(number) + i]
    return np.unique(number, return_counts=True)


def bound(numbers: np.ndarray) -> np.ndarray:
    """The n-grams' vectors, a row each."""
    out = np.ones((len(numbers), SIZE), np.int8)
    for place in range(N):
        codes, at = np.unique(numbers >> BITS * place & (1 << BITS) - 1, return_inverse=True)
        out *= np.roll(np.stack([letter(c) for c in codes.tolist()]), place, axis=1)[at]
    return out


class Bundler:
    """Texts' vectors; remembers the vectors of frequent n-grams up to a bound."""

    def __init__(self, most: int = 12_288):
        self.most, self.rows = most, {}
        self.table = np.zeros((most, SIZE), np.int8)

    def vector(self, text: str) -> np.ndarray | None:
        found = grams(text)
        if found is None:
            return None
        total = np.zeros(SIZE, np.float32)
        for i in range(0, len(found[0]), self.most // 2):
            numbers, counts = found[0][i : i + self.most // 2], found[1][i : i + self.most // 2]
            at = np.array([self.rows.get(n, -1) for n in numbers.tolist()])
            if (new := numbers[at < 0]).size:
                if len(self.rows) + len(new) > self.most:
                    self.rows.clear()
                    new, at = numbers, np.full(len(numbers), -1)
                first = len(self.rows)
                self.rows |= zip(new.tolist(), range(first, first + len(new)), strict=True)
                self.table[first : first + len(new)] = bound(new)
                at[at < 0] = np.arange(first, first + len(new))
            total += counts.astype(np.float32) @ self.table[at].astype(np.float32)
        return total


def fit(training: DataFrame, text_col: str = "text", lang_col: str = "lang") -> dict[str, np.ndarray]:
    """Prototypes by language. Tasks send one sum for each language they hold."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total: dict[str, np.ndarray] = {}
        bundler = Bundler()  # of the task, so that its memory ends with it
        for batch in batches:
            for text, lang in zip(batch["text"], batch["lang"], strict=True):
                v = bundler.vector(text)
                if v is not None:
                    total[lang] = total.get(lang, 0) + v / np.linalg.norm(v)
        if total:
            yield pd.DataFrame({"lang": list(total), "v": [v.astype(np.float64) for v in total.values()]})

    rows = training.where(F.col(text_col).isNotNull() & F.col(lang_col).isNotNull()).select(F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    parts = rows.mapInPandas(sums, "lang string, v array<double>").select("lang", F.posexplode("v").alias("i", "x"))
    # A language has SIZE numbers, so what is gathered here is small.
    total = parts.groupBy("lang", "i").agg(F.sum("x").alias("x")).groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("i", "x"))).alias("v"))
    out = {}
    for row in total.collect():
        v = np.array([x.x for x in row.v])
        out[row.lang] = v / (np.linalg.norm(v) or 1.0)
    return dict(sorted(out.items()))


def predicted(text: Column, prototypes: dict[str, np.ndarray]) -> Column:
    """struct(lang_pred, score); the score is the cosine, 0 if negative."""
    names, matrix = list(prototypes), np.array(list(prototypes.values()), np.float32)

    @F.pandas_udf("lang_pred string, score double")
    def predict(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        bundler = Bundler()
        for texts in batches:
            langs, scores = [], []
            for text in texts:
                v = bundler.vector(text) if text and names else None
                norm = 0.0 if v is None else float(np.linalg.norm(v))
                if not norm:
                    langs.append(UNKNOWN)
                    scores.append(0.0)
                    continue
                cosines = matrix @ v / norm
                best = int(np.argmax(cosines))
                langs.append(names[best])
                scores.append(min(1.0, max(0.0, float(cosines[best]))))
            yield pd.DataFrame({"lang_pred": langs, "score": scores}, index=texts.index)

    return predict(text)


def train(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", folds: int = 5, texts: int = TRAIN_TEXTS) -> dict[str, np.ndarray]:
    """Prototypes from about `texts` documents of each language, none of them held out."""
    rows = documents.where((crc_mod(id_col, folds) != 0) & F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    return fit(sampled(rows.select(id_col, text_col, lang_col), id_col, lang_col, texts), text_col, lang_col)


def with_language(df: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text") -> DataFrame:
    """df with lang_pred and score."""
    found = free_name(df.columns, "found")
    return df.withColumn(found, predicted(F.col(text_col), prototypes)).withColumns({"lang_pred": F.col(f"{found}.lang_pred"), "score": F.col(f"{found}.score")}).drop(found)


def keep_known(df: DataFrame, prototypes: dict[str, np.ndarray], text_col: str = "text", least: float = 0.0) -> DataFrame:
    """df's rows in a language that was learned, with a score of at least `least`; its columns only."""
    found = free_name(df.columns, "found")
    rows = df.withColumn(found, predicted(F.col(text_col), prototypes)).where((F.col(f"{found}.lang_pred") != UNKNOWN) & (F.col(f"{found}.score") >= least))
    return rows.select(*[quoted(c) for c in df.columns])

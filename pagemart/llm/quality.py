"""Quality score from a byte-level convolutional network in numpy.

A text's UTF-8 bytes are cut into overlapping chunks that cover it whole. Bytes
are embedded; learned filters run over each chunk; each filter's largest
response in a chunk is kept. A document has, for each filter, the largest and
the mean of its chunks' values; a linear layer and a logistic function make one
probability of them.

Learning brings a bounded number of labelled texts to the driver, whole: about
TRAIN_ROWS of each label, fewer where they have more than TRAIN_BYTES together. All
chunks of a text are pooled; its gradient flows through each filter's best places.

Cases: null and empty texts are one chunk of padding and get the score of that;
texts of any length are scored whole; a null id is never held out and never
learned from; an id with labels of both kinds counts as label 1; of a repeated id
the text that sorts first is learned from, once; without labelled rows of both kinds all scores are
the share of label 1 (0.5 without any); an input column named score or predicted
is replaced, all others are kept, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart.llm.shared import crc_mod, quoted, sampled, stored

#: Bytes of a chunk, of its overlap with the next, of a filter; numbers of a byte's embedding; filters.
CHUNK, OVERLAP, WIDTH, EMBED, FILTERS = 512, 64, 8, 6, 24
#: At most about this many rows of each label are learned from, in so many passes of so many rows a step.
TRAIN_ROWS, PASSES, STEP_ROWS, RATE = 1200, 8, 16, 0.01
#: Bytes of all texts that are learned from, about; places of a step whose gradients are summed at a time.
TRAIN_BYTES, PLACES = 32 << 20, 1 << 16
#: Padding; UTF-8 never has this byte.
PAD = 255


def chunks_of(data: bytes) -> np.ndarray:
    """A row for each chunk, the last one padded."""
    step = CHUNK - OVERLAP
    n = max(1, -(-(len(data) - OVERLAP) // step))
    padded = np.full(n * step + OVERLAP, PAD, np.uint8)
    padded[: len(data)] = np.frombuffer(data, np.uint8)
    return np.lib.stride_tricks.sliding_window_view(padded, CHUNK)[::step]


@dataclass
class Network:
    embed: np.ndarray
    filters: np.ndarray
    bias: np.ndarray
    out: np.ndarray
    out_bias: float

    @classmethod
    def fresh(cls, share: float, seed: int = 7) -> Network:
        r = np.random.default_rng(seed)
        embed = r.normal(0, 1, (256, EMBED)).astype(np.float32)
        embed[PAD] = 0
        return cls(embed, r.normal(0, (WIDTH * EMBED) ** -0.5, (WIDTH * EMBED, FILTERS)).astype(np.float32), np.zeros(FILTERS, np.float32), r.normal(0, 0.1, 2 * FILTERS).astype(np.float32), float(np.log(share / (1 - share))))

    def pooled(self, chunks: np.ndarray, where: bool = False) -> tuple[np.ndarray, np.ndarray | None]:
        """Each filter's largest response in each chunk, and its place."""
        best = np.empty((len(chunks), FILTERS), np.float32)
        places = np.empty((len(chunks), FILTERS), np.int64) if where else None
        for i in range(0, len(chunks), 32):
            x = self.embed[chunks[i : i + 32]].reshape(len(chunks[i : i + 32]), -1)
            windows = np.lib.stride_tricks.sliding_window_view(x, WIDTH * EMBED, axis=1)[:, ::EMBED]
            response = np.ascontiguousarray(windows).reshape(-1, WIDTH * EMBED) @ self.filters
            response = response.reshape(len(x), -1, FILTERS)
            best[i : i + 32] = response.max(axis=1)
            if where:
                places[i : i + 32] = response.argmax(axis=1)
        return np.maximum(best + self.bias, 0), places

    def features(self, pooled: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """A document's largest and mean values; its chunks begin at its start."""
        counts = np.diff(np.r_[starts, len(pooled)])[:, None]
        return np.hstack([np.maximum.reduceat(pooled, starts), np.add.reduceat(pooled, starts) / counts])

    def scores(self, texts: list[bytes]) -> np.ndarray:
        out = np.empty(len(texts))
        at = 0
        while at < len(texts):
            taken, chunks, starts = 0, [], []
            while at + len(starts) < len(texts) and taken < 256:
                starts.append(taken)
                chunks.append(chunks_of(texts[at + len(starts) - 1]))
                taken += len(chunks[-1])
            pooled, _ = self.pooled(np.concatenate(chunks))
            z = self.features(pooled, np.array(starts)) @ self.out + self.out_bias
            out[at : at + len(starts)] = 1 / (1 + np.exp(-np.clip(z.astype(np.float64), -40, 40)))
            at += len(starts)
        return out

    def parameters(self) -> list[np.ndarray]:
        return [self.embed, self.filters, self.bias, self.out]


def gradients(net: Network, chunks: np.ndarray, sizes: np.ndarray, labels: np.ndarray) -> tuple[list[np.ndarray], np.ndarray]:
    """The logistic loss's gradients for a step's texts (their chunks in a row, and how many each has), without
    the linear layer's decay, and the texts' probabilities. They flow only through each filter's best place in a chunk.
    """
    starts = np.r_[0, np.cumsum(sizes)[:-1]]
    pooled, places = net.pooled(chunks, True)
    features = net.features(pooled, starts)
    p = 1 / (1 + np.exp(-np.clip(features @ net.out + net.out_bias, -30, 30)))
    error = ((p - labels) / len(sizes)).astype(np.float32)
    of = np.repeat(np.arange(len(sizes)), sizes)
    top = (pooled == features[of][:, :FILTERS]).astype(np.float32)
    top /= np.add.reduceat(top, starts)[of]  # equal chunks share
    wanted = error[of][:, None] * (net.out[:FILTERS] * top + net.out[FILTERS:] / sizes[of][:, None])
    wanted *= pooled > 0
    d_filters, d_embed = np.zeros_like(net.filters.T), np.zeros_like(net.embed)
    every_c, every_f = np.nonzero(wanted)
    for i in range(0, len(every_c), PLACES):
        c, f = every_c[i : i + PLACES], every_f[i : i + PLACES]
        g = wanted[c, f].astype(np.float32)
        read = chunks[c[:, None], places[c, f][:, None] + np.arange(WIDTH)]
        np.add.at(d_filters, f, g[:, None] * net.embed[read].reshape(len(c), WIDTH * EMBED))
        np.add.at(d_embed, read.ravel(), (g[:, None] * net.filters.T[f]).reshape(-1, EMBED))
    d_embed[PAD] = 0
    return [d_embed, d_filters.T, wanted.sum(axis=0), features.T @ error, np.array([error.sum()])], p


def learn(texts: list[np.ndarray], labels: np.ndarray, passes: int = PASSES) -> Network:
    """A network from texts' chunks and labels: logistic loss by Adam."""
    share = float(np.clip(labels.mean(), 0.001, 0.999)) if len(labels) else 0.5
    net = Network.fresh(share)
    if len(set(labels.tolist())) < 2:
        return net
    order, r, t = np.arange(len(texts)), np.random.default_rng(11), 0
    moments = [[np.zeros_like(p) for p in net.parameters()] + [np.zeros(1)] for _ in range(2)]
    for done in range(passes):
        r.shuffle(order)
        for i in range(0, len(order), STEP_ROWS):
            rows = order[i : i + STEP_ROWS]
            steps, _ = gradients(net, np.concatenate([texts[k] for k in rows]), np.array([len(texts[k]) for k in rows]), labels[rows])
            steps[3] = steps[3] + 1e-4 * net.out
            t += 1
            rate = RATE * (1 - done / passes)
            for k, d in enumerate(steps):
                moments[0][k] = 0.9 * moments[0][k] + 0.1 * d
                moments[1][k] = 0.99 * moments[1][k] + 0.01 * d * d
                change = (rate * (moments[0][k] / (1 - 0.9**t)) / (np.sqrt(moments[1][k] / (1 - 0.99**t)) + 1e-8)).astype(np.float32)
                if k < 4:
                    net.parameters()[k][...] -= change
                else:
                    net.out_bias -= float(change[0])
    return net


def train(documents: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", label_col: str = "quality", folds: int = 3, held_out: int = 1, rows: int = TRAIN_ROWS, most_bytes: int = TRAIN_BYTES) -> Network:
    """A network learned on the driver from about `rows` documents of each label, none held out.

    Rare labels then weigh too much, so the output is shifted back to the share
    that the labels have in all rows.
    """
    known = labels.where(F.col(label_col).isin(0, 1) & (crc_mod(id_col, folds) != held_out)).groupBy(F.col(id_col).alias("id")).agg(F.max(label_col).alias("label"))
    counts = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    few = stored(sampled(known, "id", "label", rows), "learned")
    small = few.count() <= 8 * rows + 100  # about 2 * rows ids; never broadcast without that count
    texts = documents.select(F.col(quoted(id_col)).alias("id"), F.coalesce(F.col(quoted(text_col)), F.lit("")).alias("text")).join(F.broadcast(few) if small else few, "id")
    texts = stored(texts.groupBy("id", "label").agg(F.min("text").alias("text")), "texts")
    size = texts.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    if size > most_bytes:
        # Whole texts, by another hash of their ids.
        fraction = F.pmod(F.xxhash64("id", F.lit("size")), F.lit(1 << 30)) / F.lit(float(1 << 30))
        texts = texts.where(fraction < most_bytes / size)
    found = sorted((r["text"].encode(), int(r["label"])) for r in texts.select("text", "label").collect())
    y = np.array([label for _, label in found], np.float32)
    net = learn([chunks_of(data) for data, _ in found], y)
    if len(counts) == 2 and 0 < y.mean() < 1:
        net.out_bias += float(np.log(counts[1] / counts[0]) - np.log(y.mean() / (1 - y.mean())))
    return net


def score(text: Column, net: Network) -> Column:
    """The probability (double) that a whole text has label 1."""

    @F.pandas_udf("double")
    def score_texts(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            # In slices, so that a batch is not held as bytes a second time.
            found = [net.scores([t.encode() for t in texts.iloc[i : i + 256]]) for i in range(0, len(texts), 256)]
            yield pd.Series(np.concatenate(found) if found else [], index=texts.index, dtype="float64")

    return score_texts(F.coalesce(text, F.lit("")))


def with_quality(df: DataFrame, net: Network, text_col: str = "text") -> DataFrame:
    """df with score and predicted (1 from 0.5 on)."""
    return df.withColumn("score", score(F.col(text_col), net)).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))

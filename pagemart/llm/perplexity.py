"""Quality rules by n-gram perplexity.

A language's model is a modified Kneser-Ney model of its texts' bytes. Spark counts
the n-grams of all texts of all documents (each task sends what it has counted, a
row for each n-gram). Each distinct text counts once, however many copies it has: a
copy counts 1/n of what it holds. From a language's counts its model is
computed: for n-grams of each length the surprisal (bits), and for contexts the
weight of the shorter n-gram, in arrays sorted by the n-grams' hashes.

A text's perplexity is 2 to the power of the median, over its blocks of BLOCK bytes,
of the mean surprisal of a byte; so a key, a number or a quotation in a text does
not condemn it. A language's band is the median of its texts' bits plus and minus
WIDTH robust deviations, LEAST bits at least, again with each distinct text counted
once. A text outside its language's band is rejected, as is one that fails the base
rules (too few words, or too many in repeated three-word windows).

The models are broadcast while all languages have at most MOST n-grams together;
beyond, texts go to their language's model by a shuffle, in bounded groups. A
language never has more than 256**ORDER n-grams, which is what one task holds.

Cases: null and empty texts have no words, fail the base rules and have a null
perplexity, and null languages are a language of their own; a null id is kept as
any other; copies and repeated rows get the same result each; ties have no part in
it; texts of any length are read whole; a language whose texts are all alike keeps
them; no rows give no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemart.llm.shared import HOT, SMALL, quoted, stored

#: Bytes of an n-gram, of a block.
ORDER, BLOCK = 3, 32
#: Half a band in robust deviations, and in bits at least.
WIDTH, LEAST = 3.5, 0.1
#: N-grams of all models together that are broadcast (16 bytes each); groups of copies that are.
MOST, COPIES = 4_000_000, 1_000_000
#: Bytes of text that are looked at together, and of a group where texts go to their model.
PIECE, GROUP = 1 << 20, 64 << 20
#: Steps of a bit to which bands are measured.
STEPS = 4096
#: Fixed: the rules' numbers and characters.
LEAST_WORDS, MOST_REPEATED, SYMBOLS, BLANKS = 50, 50, b"#*$%&|<>", b"\x20\x09\x0a\x0b\x0c\x0d"
#: Texts of more words are counted by numbers instead of tuples, which takes less memory.
LONG = 500_000


def repeated_words(data: bytes) -> tuple[int, int]:
    """(words, words in three-word windows that the text has twice or more)."""
    if len(data) < 2 * LONG:
        words = data.split()
        if len(words) < 4:
            return len(words), 0
        windows = list(zip(words, words[1:], words[2:], strict=False))
        if len(set(windows)) == len(windows):
            return len(words), 0
        counts = Counter(windows)
        again = np.fromiter((counts[w] > 1 for w in windows), bool, len(windows))
    else:
        ids: dict[bytes, int] = {}
        numbers = np.fromiter((ids.setdefault(m[0], len(ids)) for m in re.finditer(rb"[^\x20\x09-\x0d]+", data)), np.int64)
        words = numbers
        if len(words) < 4:
            return len(words), 0
        _, pair = np.unique(numbers[:-1] * len(ids) + numbers[1:], return_inverse=True)
        _, window, counts = np.unique(pair[:-1] * len(ids) + numbers[2:], return_inverse=True, return_counts=True)
        again = counts[window] > 1
    covered = np.zeros(len(words), bool)
    for i in range(3):
        covered[i : i + len(again)] |= again
    return len(words), int(covered.sum())


def base_counts(text: str | None, data: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    n, repeated = repeated_words(data)
    dup, seen = 0, set()
    if b"\n" in data:
        for line in data.split(b"\n"):
            if line in seen:
                dup += 1
            elif line and not line.isspace():
                seen.add(line)
    chars = len(text or "") - (len(data) - len(data.translate(None, BLANKS)))
    return n, chars, len(data) - len(data.translate(None, SYMBOLS)), dup, repeated


def codes_of(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, int]:
    """(code of the n-gram that ends at each byte, the bytes that codes are numbers of, how many).

    Before a text stand ORDER - 1 zero bytes, which no n-gram ends at.
    """
    gap = b"\0" * (ORDER - 1)
    data = np.frombuffer(gap + gap.join(texts), np.uint8)
    there = np.flatnonzero(np.bincount(data, minlength=256))
    place = np.zeros(256, np.int64)
    place[there] = np.arange(len(there))
    at, n = place[data], len(there)
    codes = at[ORDER - 1 :].copy()
    for k in range(1, ORDER):
        codes += at[ORDER - 1 - k : len(at) - k] * n**k
    sizes = np.array([len(t) for t in texts])
    keep = np.ones(len(codes), bool)
    ends = np.cumsum(sizes + ORDER - 1)[:-1]
    for k in range(1, ORDER):
        keep[ends - k] = False
    return codes[keep], there, n


def grams_of(codes: np.ndarray, there: np.ndarray, n: int) -> np.ndarray:
    """Codes as n-grams: their bytes as one number, the last byte lowest."""
    out = np.zeros(len(codes), np.int64)
    for k in range(ORDER):
        out |= there[codes // n**k % n].astype(np.int64) << 8 * k
    return out


def counted(texts: list[bytes], weights: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(n-grams, how often texts hold them), a text weighing what weights says."""
    codes, there, n = codes_of(texts)
    held = None if weights is None else np.repeat(weights, [len(t) for t in texts])
    found = np.bincount(codes, held)
    at = np.flatnonzero(found)
    return grams_of(at, there, n), found[at].astype(np.float64)


def hashed(grams: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of n-grams of a length: a mixer that maps different n-grams to different hashes."""
    x = grams.astype(np.uint64) | np.uint64(length << 60)
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(factor)
    return x ^ (x >> np.uint64(33))


def discounts(counts: np.ndarray) -> np.ndarray:
    """What is taken off counts of 0, 1, 2 and more; a half, one and one and a half where the counts of counts say nothing."""
    n1, n2, n3, n4 = ((counts == i).sum() for i in range(1, 5))
    if not (n1 and n2 and n3 and n4):
        return np.array([0, 0.5, 1.0, 1.5])
    y = n1 / (n1 + 2 * n2)
    return np.array([0, *np.clip([1 - 2 * y * n2 / n1, 2 - 3 * y * n3 / n2, 3 - 4 * y * n4 / n3], 0.05, [0.95, 1.9, 2.85])])


class Model:
    """Hashes of n-grams of all lengths, sorted, with each one's surprisal and the weight (both in bits) that
    shorter n-grams have after it."""

    def __init__(self, hashes: np.ndarray, bits: np.ndarray, back: np.ndarray):
        self.hashes, self.bits, self.back = hashes, bits, back

    @classmethod
    def of(cls, grams: np.ndarray, counts: np.ndarray) -> Model:
        """Modified Kneser-Ney: the longest n-grams by their counts, shorter ones by how many different bytes precede them."""
        order = np.argsort(grams)
        by_length = {ORDER: (grams[order], counts[order].astype(np.int64))}
        for k in range(ORDER - 1, 0, -1):
            by_length[k] = np.unique(by_length[k + 1][0] & (1 << 8 * k) - 1, return_counts=True)
        out, lower, weights = [], np.array([1 / 256]), None
        for k in range(1, ORDER + 1):
            found, n = by_length[k]
            off = discounts(n)[np.minimum(n, 3)]
            contexts, at = np.unique(found >> 8, return_inverse=True)
            total = np.bincount(at, n)
            weights = np.bincount(at, off) / total
            shorter = lower[0] if k == 1 else lower[np.searchsorted(by_length[k - 1][0], found & (1 << 8 * (k - 1)) - 1)]
            p = (n - off) / total[at] + weights[at] * shorter
            out.append((hashed(contexts, k - 1), None, weights))
            out.append((hashed(found, k), p, None))
            lower = p
        hashes = np.concatenate([h for h, _, _ in out])
        every, at = np.unique(hashes, return_inverse=True)
        bits, back = np.full(len(every), np.inf), np.zeros(len(every))
        i = 0
        for h, p, w in out:
            own = at[i : i + len(h)]
            if p is not None:
                bits[own] = -np.log2(p)
            else:
                back[own] = -np.log2(w)
            i += len(h)
        return cls(every, bits.astype(np.float32), back.astype(np.float32))

    def _at(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        return at, self.hashes[at] == hashes

    def surprisal(self, grams: np.ndarray) -> np.ndarray:
        """Bits of each n-gram's last byte after the others, by shorter n-grams where longer ones are unknown."""
        out = np.zeros(len(grams))
        left = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            tail = grams[left] & (1 << 8 * k) - 1
            at, known = self._at(hashed(tail, k))
            known &= np.isfinite(self.bits[at])
            out[left[known]] += self.bits[at[known]]
            left, tail = left[~known], tail[~known]
            at, context = self._at(hashed(tail >> 8, k - 1))
            out[left[context]] += self.back[at[context]]
        out[left] += 8.0  # one byte of 256
        return out


def bits_of(texts: list[bytes], model: Model) -> np.ndarray:
    """The median block's mean surprisal of each text (nan for an empty one)."""
    out = np.full(len(texts), np.nan)
    i = 0
    while i < len(texts):
        j, size = i, 0
        while j < len(texts) and (j == i or size + len(texts[j]) <= PIECE):
            size += len(texts[j])
            j += 1
        codes, there, n = codes_of(texts[i:j])
        distinct = np.flatnonzero(np.bincount(codes)) if len(codes) else codes
        table = np.zeros(int(distinct[-1]) + 1 if len(distinct) else 0, np.float32)
        table[distinct] = model.surprisal(grams_of(distinct, there, n))
        bits, at = table[codes], 0
        for k in range(i, j):
            if own := len(texts[k]):
                starts = np.arange(max(1, own // BLOCK)) * BLOCK
                sums = np.add.reduceat(bits[at : at + own].astype(np.float64), starts)
                means = sums / np.diff(np.r_[starts, own])
                out[k] = np.median(means)
                at += own
        i = j
    return out


def _key(lang: Column) -> Column:
    return F.coalesce(F.concat(F.lit("="), lang.cast("string")), F.lit(""))


def weighed(rows: DataFrame) -> DataFrame:
    """rows (with a column text) with weight: 1 over how many rows have the same text."""
    hashed_rows = rows.withColumn("of", F.xxhash64("text"))
    groups = stored(hashed_rows.groupBy("of").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "copies")
    total, many = groups.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    if many <= COPIES:
        found = hashed_rows.join(F.broadcast(groups), "of", "left")
    else:
        # Fewer than HOT texts have more than this part of all copies; the others meet their group by a shuffle.
        hot = hashed_rows.join(F.broadcast(groups.where(F.col("n") > total / HOT)), "of", "left")
        rest = hot.where("n IS NULL").drop("n").join(groups.where(F.col("n") <= total / HOT), "of", "left")
        found = hot.where("n IS NOT NULL").unionByName(rest)
    return found.select(*[quoted(c) for c in rows.columns], (F.lit(1.0) / F.coalesce("n", F.lit(1))).alias("weight"))


def ngram_counts(rows: DataFrame) -> DataFrame:
    """(key, gram, n) over all rows (key, text, weight)."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        waiting: dict[str, tuple[list[bytes], list[float]]] = {}

        def add(key: str) -> None:
            texts, weights = waiting.pop(key)
            w = np.array(weights)
            grams, n = counted(texts, None if (w == 1).all() else w)
            if key in held:
                grams, at = np.unique(np.concatenate([held[key][0], grams]), return_inverse=True)
                n = np.bincount(at, np.concatenate([held[key][1], n]))
            held[key] = grams, n

        sizes: Counter = Counter()
        for batch in batches:
            for key, text, weight in (row for i in range(0, len(batch), 512) for row in zip(*(c.to_pylist() for c in batch.slice(i, 512).columns), strict=True)):
                if text:
                    texts, weights = waiting.setdefault(key, ([], []))
                    data = text.encode()
                    texts.append(data)
                    weights.append(weight)
                    sizes[key] += len(data)
                    if sizes[key] >= PIECE:
                        add(key)
                        sizes[key] = 0
        for key in list(waiting):
            add(key)
        for key, (grams, n) in held.items():
            for i in range(0, len(grams), 1 << 16):
                part = grams[i : i + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array([key] * len(part), pa.string()), pa.array(part, pa.int64()), pa.array(n[i : i + (1 << 16)], pa.float64())], names=["key", "gram", "n"])

    parts = rows.select("key", "text", "weight").mapInArrow(count, "key string, gram long, n double")
    return parts.groupBy("key", "gram").agg(F.round(F.sum("n")).cast("long").alias("n")).where("n > 0")


def models(counts: DataFrame) -> DataFrame:
    """(key, size, hashes, bits, back): each language's model, its arrays as bytes."""

    def build(table: pa.Table) -> pa.Table:
        model = Model.of(table.column("gram").to_numpy(), table.column("n").to_numpy())
        return pa.table({"key": table.column("key")[:1], "size": pa.array([len(model.hashes)], pa.int64()), "hashes": pa.array([model.hashes.tobytes()], pa.binary()), "bits": pa.array([model.bits.tobytes()], pa.binary()), "back": pa.array([model.back.tobytes()], pa.binary())})

    return counts.groupBy("key").applyInArrow(build, "key string, size long, hashes binary, bits binary, back binary")


def model_from(hashes: bytes, bits: bytes, back: bytes) -> Model:
    return Model(np.frombuffer(hashes, np.uint64), np.frombuffer(bits, np.float32), np.frombuffer(back, np.float32))


_MEASURED = "id {kind}, key string, weight double, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, bits double"


def _measure(batch: pa.Table | pa.RecordBatch, model_of) -> pa.Table:
    """Rows (id, key, weight, text) with their counts and bits."""
    keys, texts = batch.column(1).to_pylist(), batch.column(3).to_pylist()
    data = [(t or "").encode() for t in texts]
    counts = [base_counts(t, d) for t, d in zip(texts, data, strict=True)]
    bits = np.full(len(data), np.nan)
    for key in set(keys):
        own = [i for i, k in enumerate(keys) if k == key]
        if (model := model_of(key)) is not None:
            bits[own] = bits_of([data[i] for i in own], model)
    columns = [pa.array([c[i] for c in counts], pa.int64()) for i in range(5)]
    return pa.table([batch.column(0), batch.column(1), batch.column(2), *columns, pa.array(bits, pa.float64(), from_pandas=True)], names=["id", "key", "weight", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "bits"])


def measured(rows: DataFrame, of: DataFrame, most: int = MOST) -> DataFrame:
    """rows (id, key, weight, text) with their counts and bits, by the models in `of`."""
    schema = _MEASURED.format(kind=rows.schema["id"].dataType.simpleString())
    size = of.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    rows = rows.select("id", "key", "weight", "text")
    if size <= most:
        sent = rows.sparkSession.sparkContext.broadcast({r.key: (bytes(r.hashes), bytes(r.bits), bytes(r.back)) for r in of.collect()})

        def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = {key: model_from(*arrays) for key, arrays in sent.value.items()}
            for batch in batches:
                for i in range(0, len(batch), 512):
                    yield from _measure(batch.slice(i, 512), known.get).to_batches()

        return rows.mapInArrow(score, schema)

    sizes = stored(rows.groupBy("key").agg(F.ceil(F.sum(F.octet_length(F.coalesce("text", F.lit("")))) / GROUP + 1).cast("int").alias("groups")), "groups")
    sizes = F.broadcast(sizes) if sizes.count() <= SMALL else sizes
    # By place, so that a text of many rows is dealt like any other.
    dealt = rows.withColumn("place", F.monotonically_increasing_id()).join(sizes, "key").withColumn("group", F.expr("CAST(pmod(place, groups) AS int)")).drop("groups", "place")
    copies = of.join(sizes, "key").withColumn("group", F.explode(F.expr("sequence(0, groups - 1)"))).drop("groups")

    def score_group(texts: pa.Table, model: pa.Table) -> pa.Table:
        one = model_from(*(model.column(c)[0].as_py() for c in ("hashes", "bits", "back"))) if len(model) else None
        parts = [_measure(texts.slice(i, 512).select(["id", "key", "weight", "text"]), lambda _: one) for i in range(0, max(len(texts), 1), 512)]
        return pa.concat_tables(parts)

    return dealt.groupBy("key", "group").cogroup(copies.groupBy("key", "group")).applyInArrow(score_group, schema)


def _median(steps: DataFrame, name: str, upper: bool) -> DataFrame:
    """(key, name): the weighted median of (key, step, weight); the upper one of two, where upper."""
    so_far = F.sum("weight").over(Window.partitionBy("key").orderBy("step"))
    total = F.sum("weight").over(Window.partitionBy("key"))
    slack = F.lit(1e-6 if upper else -1e-6)
    return steps.withColumn("past", 2 * so_far - total).where(F.col("past") > slack).groupBy("key").agg(F.min("step").alias(name))


def bands(scored: DataFrame, width: float = WIDTH, least: float = LEAST) -> DataFrame:
    """(key, low, high) in bits, from rows (key, weight, bits). A key's steps are bounded, so its window is."""
    steps = stored(scored.where("bits IS NOT NULL").groupBy("key", F.round(F.col("bits") * STEPS).cast("long").alias("step")).agg(F.sum("weight").alias("weight")), "steps")
    middle = stored(_median(steps, "middle", False), "middle")
    off = steps.join(F.broadcast(middle) if middle.count() <= SMALL else middle, "key")
    off = off.groupBy("key", F.abs(F.col("step") - F.col("middle")).alias("step")).agg(F.sum("weight").alias("weight"))
    half = F.greatest(F.lit(float(least)), F.lit(width * 1.4826 / STEPS) * F.col("off"))
    both = middle.join(_median(off, "off", True), "key")
    return both.select("key", (F.col("middle") / STEPS - half).alias("low"), (F.col("middle") / STEPS + half).alias("high"))


def judged(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", width: float = WIDTH, least: float = LEAST, most: int = MOST) -> DataFrame:
    """(id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept, perplexity, low, high) of each
    document; low and high are its language's band of perplexities.
    """
    rows = weighed(documents.select(F.col(quoted(id_col)).alias("id"), _key(F.col(quoted(lang_col))).alias("key"), F.col(quoted(text_col)).alias("text")))
    of = stored(models(ngram_counts(rows)), "models")
    found = stored(measured(rows, of, most), "measured")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    found = found.withColumn("base_failed", failed)
    limits = stored(bands(found.where("NOT base_failed"), width, least), "bands")
    limits = F.broadcast(limits) if limits.count() <= SMALL else limits
    within = (F.col("bits") >= F.col("low")) & (F.col("bits") <= F.col("high"))
    kept = F.coalesce(~F.col("base_failed") & within, F.lit(False))
    counts = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]
    out = found.join(limits, "key", "left")
    return out.select(F.col("id").alias(id_col), *counts, "base_failed", kept.alias("kept"), *[F.pow(F.lit(2.0), F.col(c)).alias(n) for c, n in (("bits", "perplexity"), ("low", "low"), ("high", "high"))])


def keep(documents: DataFrame, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang", **how) -> DataFrame:
    """(id) of the documents that are kept, once each row."""
    return judged(documents, id_col, text_col, lang_col, **how).where("kept").select(quoted(id_col))

"""Hard negatives by Kronecker-packed integer products.

Components become whole numbers (floor of SCALE times the component), so a score,
the inner product of two rows, is a whole number too. Several candidates are
scored at once: their components, biased so that none is negative, are put into
separate fields of one wide integer, at distances of so many bits that no sum of
products can reach the next field. An anchor's components (biased likewise) are
multiplied with the wide ones and summed; each field of the sum, less what the
biases brought in, is one candidate's exact score.

The wide integers are doubles while a double holds two fields or more (it keeps
every whole number below 2**53, and numpy multiplies matrices of them fastest), else
Python's integers of any width. Scores are exact either way.

An anchor's positives are its best rows of the same label. For each positive,
negatives are the best rows of other labels whose score lies between `least` % of
the positive's and the positive's. Rows are dealt into blocks of bounded size, for
positives within a label (an anchor asks only blocks of its own), for negatives by
a hash of the id, and anchors into batches; a task gets a block and a batch, and
only a block's best for each anchor leave it. No label, block or anchor gathers more.

Cases: rows with a null id, label or vector, or a null or non-finite component,
take no part; vectors of other lengths than an anchor's are not its candidates,
and empty ones score 0 among themselves; a repeated id is one anchor (its smallest
label and vector) and as many candidates, but never its own; equal scores go to
the smaller id; anchors without positives, and positives without negatives in
reach, give no rows; a score beyond a long's range is given as the nearest long;
no rows give no rows; further columns, whatever their names, are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemart.llm.shared import SMALL, quoted, stored

SCALE, POSITIVES, NEGATIVES, LEAST = 256, 5, 5, 80
#: Rows of a block, anchors of a batch, numbers of a block's vectors at most.
BLOCK, BATCH, NUMBERS = 8_192, 2_048, 1 << 22
#: Bits that a double's whole numbers have; candidates in a wide integer of Python's; scores held at a time.
DOUBLE_BITS, FIELDS, HELD = 53, 32, 1 << 21
#: Turns the order of digits around.
_NINES = str.maketrans("0123456789", "9876543210")


def whole(vectors: np.ndarray) -> np.ndarray:
    """floor(SCALE * x) of each component: doubles that are whole numbers, or Python's integers where a double would overflow."""
    if not vectors.size or np.abs(vectors).max() < 2.0**900:
        return np.floor(vectors * SCALE)  # exact, as SCALE is a power of two
    return _ints_of([int(x) * SCALE if abs(x) >= 2.0**900 else math.floor(x * SCALE) for x in vectors.ravel().tolist()], vectors.shape)


def _ints_of(values: list[int], shape: tuple[int, ...]) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out.reshape(shape)


def _ints(values: np.ndarray) -> np.ndarray:
    return values if values.dtype == object else _ints_of([int(x) for x in values.ravel().tolist()], values.shape)


def _power(kind, exponent: int):
    return float(1 << exponent) if kind is np.float64 else 1 << exponent


class Packed:
    """A block's candidates in wide integers, for anchors whose components lie between low and high."""

    def __init__(self, candidates: np.ndarray, low: int, high: int):
        n, dims = candidates.shape
        self.n, self.dims, self.low = n, dims, low
        self.bias, top = (int(candidates.min()), int(candidates.max())) if candidates.size else (0, 0)
        # What a field's sum can reach at most, and the bits for it.
        reach = max(dims, 1) * (top - self.bias) * (high - low)
        self.bits = max(1, reach.bit_length())
        fits = 8 * max(dims, 1) * max(abs(top), abs(self.bias)) * max(abs(low), abs(high)) < 1 << 62
        self.narrow = 2 * self.bits <= DOUBLE_BITS and fits
        self.kind = np.float64 if self.narrow else object
        self.fields = DOUBLE_BITS // self.bits if self.narrow else FIELDS
        self.fields = max(1, min(self.fields, n))
        rows = -(-n // self.fields)
        biased = np.zeros((rows * self.fields, dims), self.kind)
        biased[:n] = (candidates if self.narrow else _ints(candidates)) - self.bias
        # Field j of wide number i holds candidate i + j * rows.
        self.wide = np.zeros((rows, dims), self.kind)
        for j in range(self.fields):
            self.wide += biased[j * rows : (j + 1) * rows] * _power(self.kind, self.bits * j)
        self.sums = self._exact(biased[:n].sum(axis=1) if dims else np.zeros(n, self.kind))

    def _exact(self, values: np.ndarray) -> np.ndarray:
        return values.astype(np.int64) if self.narrow else values.astype(object)

    def scores(self, anchors: np.ndarray) -> np.ndarray:
        """A row for each anchor, a column for each candidate."""
        if not self.dims or not self.n:
            return np.zeros((len(anchors), self.n), np.int64)
        biased = ((anchors if self.narrow else _ints(anchors)) - self.low).astype(self.kind)
        rest = biased @ self.wide.T
        parts = []
        for j in range(self.fields - 1, 0, -1):
            part = np.floor(rest / _power(self.kind, self.bits * j)) if self.narrow else rest >> self.bits * j
            rest = rest - part * _power(self.kind, self.bits * j)
            parts.append(part)
        fields = self._exact(np.concatenate([rest, *reversed(parts)], axis=1)[:, : self.n])
        # (a + low)(c + bias) summed, from the sums of ac, a and c.
        own = self._exact(biased.sum(axis=1))
        return fields + self.bias * own[:, None] + self.low * self.sums[None, :] + self.dims * self.low * self.bias


def best(scores: np.ndarray, allowed: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of each row's k largest allowed scores, largest first, ties to the first column."""
    rows, columns = np.nonzero(allowed)
    if not len(rows):
        return rows, columns
    found = scores[rows, columns]
    # Those that cannot be among a row's k best go before the sort: they are less than k-th of the row.
    counts = np.bincount(rows, minlength=len(scores))
    if scores.dtype != object and counts.max() > 64:
        bound = np.where(allowed, scores, np.iinfo(np.int64).min)
        bound = np.partition(bound, -k, axis=1)[:, -k] if bound.shape[1] > k else bound.min(axis=1)
        keep = found >= bound[rows]
        rows, columns, found = rows[keep], columns[keep], found[keep]
    order = np.array(sorted(range(len(rows)), key=lambda i: (rows[i], -found[i], columns[i])), np.int64) if found.dtype == object else np.lexsort((columns, -found, rows))
    rows, columns = rows[order], columns[order]
    nth = np.arange(len(rows)) - np.searchsorted(rows, rows)
    return rows[nth < k], columns[nth < k]


def usable(vectors: DataFrame, id_col: str, vector_col: str, label_col: str, label: Column | None) -> DataFrame:
    """(id, label, v array<double>) of the rows that take part."""
    v = F.col(quoted(vector_col)).cast("array<double>")
    own = (F.col(quoted(label_col)) if label is None else label).cast("string")
    fine = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(quoted(id_col)).cast("long").alias("id"), own.alias("label"), v.alias("v"))
    return rows.where(F.col("id").isNotNull() & F.col("label").isNotNull() & F.coalesce(fine, F.lit(False)))


def _matrix(column: pa.ChunkedArray, dims: int) -> np.ndarray:
    values = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    return whole(values.flatten().to_numpy(zero_copy_only=False).reshape(len(column), dims))


def _long(score: int) -> int:
    """The nearest long."""
    return max(-(1 << 63), min((1 << 63) - 1, int(score)))


def _beyond(score: int) -> str | None:
    """A score that a long does not hold, as text that sorts as the numbers do; null for others."""
    if score == _long(score):
        return None
    digits = f"{len(str(abs(score))):08d}{abs(score)}"
    return "1" + digits if score > 0 else "0" + digits.translate(_NINES)


def _score(long: int, beyond: str | None) -> int:
    if beyond is None:
        return long
    return int(beyond[9:]) if beyond[0] == "1" else -int(beyond[9:].translate(_NINES))


def _cells(rows: DataFrame, batches: int) -> DataFrame:
    """rows with block (a hash of the id) and batch: a copy for each batch of anchors."""
    block = F.expr("CAST(pmod(xxhash64(id), blocks) AS int)")
    return rows.withColumn("block", block).withColumn("batch", F.explode(F.sequence(F.lit(0), F.lit(batches - 1))))


def mine(vectors: DataFrame, is_anchor, id_col: str = "vec_id", vector_col: str = "embedding", label_col: str = "label", label: Column | None = None, positives: int = POSITIVES, negatives: int = NEGATIVES, least: int = LEAST, block: int = BLOCK, batch: int = BATCH) -> DataFrame:
    """(anchor_id, positive_id, rank, negative_id, positive_score, negative_score) for each row for which is_anchor (a Column of id) holds.

    label (a Column of vectors) stands for label_col's values, where given.
    """
    rows = usable(vectors, id_col, vector_col, label_col, label).withColumn("dims", F.size("v"))
    longest = rows.agg(F.coalesce(F.max("dims"), F.lit(1))).first()[0]
    block = max(1, min(block, NUMBERS // max(longest, 1)))
    anchors = rows.where(is_anchor).groupBy("id").agg(F.min(F.struct("label", "v", "dims")).alias("a")).select("id", "a.label", "a.v", "a.dims")
    asked = anchors.count()
    batches = max(1, -(-asked // batch))
    anchors = stored(anchors.withColumn("batch", F.pmod(F.xxhash64("id"), F.lit(batches)).cast("int")), "anchors")

    # An anchor asks the blocks of its own label.
    sizes = rows.groupBy("dims", "label").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks"))
    wanted = stored(sizes.join(anchors.select("dims", "label").distinct(), ["dims", "label"]), "labels")
    wanted = F.broadcast(wanted) if wanted.count() <= SMALL else wanted
    own = _cells(rows.join(wanted, ["dims", "label"]), batches)
    asking = anchors.join(wanted.withColumnRenamed("blocks", "asked"), ["dims", "label"]).withColumn("block", F.explode(F.expr("sequence(0, asked - 1)")))
    keys = ["dims", "label", "block", "batch"]
    near = asking.groupBy(*keys).cogroup(own.groupBy(*keys)).applyInArrow(_nearest(positives), "anchor_id long, id long, score long, beyond string")
    first = Window.partitionBy("anchor_id").orderBy(F.col("score").desc(), F.col("beyond").desc(), "id")
    near = near.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= positives)
    thresholds = near.groupBy("anchor_id").agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score", "beyond"))).alias("p"))
    thresholds = thresholds.select(F.col("anchor_id").alias("id"), F.col("p.id").alias("positive_ids"), F.col("p.score").alias("positive_scores"), F.col("p.beyond").alias("beyond"))
    ready = stored(anchors.join(thresholds, "id"), "positives")

    # Negatives are asked for in all blocks.
    blocks = stored(rows.groupBy("dims").agg(F.ceil(F.count(F.lit(1)) / block).cast("int").alias("blocks")), "blocks")
    blocks = F.broadcast(blocks) if blocks.count() <= SMALL else blocks
    others = _cells(rows.join(blocks, "dims"), batches)
    asking = ready.join(blocks.withColumnRenamed("blocks", "asked"), "dims").withColumn("block", F.explode(F.expr("sequence(0, asked - 1)")))
    keys = ["dims", "block", "batch"]
    found = asking.groupBy(*keys).cogroup(others.groupBy(*keys)).applyInArrow(_hardest(negatives, least), "anchor_id long, positive_rank int, positive_id long, negative_id long, positive_score long, negative_score long, beyond string")
    ranked = Window.partitionBy("anchor_id", "positive_rank").orderBy(F.col("negative_score").desc(), F.col("beyond").desc(), "negative_id")
    out = found.withColumn("rank", F.row_number().over(ranked)).where(F.col("rank") <= negatives)
    return out.select("anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score")


def _tiles(asked: pa.Table, there: pa.Table):
    """(slice of asked, scores) of so many anchors at a time; there's rows are in order of id."""
    dims = asked.column("dims")[0].as_py()
    a, c = _matrix(asked.column("v"), dims), _matrix(there.column("v"), dims)
    packed = Packed(c, int(a.min()) if a.size else 0, int(a.max()) if a.size else 0)
    step = max(1, HELD // max(len(there), 1))
    for i in range(0, len(asked), step):
        yield slice(i, i + step), packed.scores(a[i : i + step])


def _nearest(k: int):
    """For each anchor its k best rows of a block of its label."""
    schema = pa.schema([("anchor_id", pa.int64()), ("id", pa.int64()), ("score", pa.int64()), ("beyond", pa.string())])

    def run(asked: pa.Table, there: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(asked) and len(there):
            there = there.sort_by("id")
            own, ids = asked.column("id").to_numpy(), there.column("id").to_numpy()
            for part, scores in _tiles(asked, there):
                r, c = best(scores, own[part][:, None] != ids[None, :], k)
                out += [(a, i, _long(s), _beyond(s)) for a, i, s in zip(own[part][r].tolist(), ids[c].tolist(), scores[r, c].tolist(), strict=True)]
        return _table(out, schema)

    return run


def _hardest(k: int, least: int):
    """For each anchor and positive the k best rows of a block that have other labels and scores within reach."""
    kinds = {"anchor_id": pa.int64(), "positive_rank": pa.int32(), "positive_id": pa.int64(), "negative_id": pa.int64(), "positive_score": pa.int64(), "negative_score": pa.int64(), "beyond": pa.string()}
    schema = pa.schema(list(kinds.items()))

    def run(asked: pa.Table, there: pa.Table) -> pa.Table:
        out: list[tuple] = []
        if len(asked) and len(there):
            there = there.sort_by("id")
            own, ids = asked.column("id").to_numpy(), there.column("id").to_numpy()
            codes: dict[str, int] = {}
            label, other = (np.array([codes.setdefault(x, len(codes)) for x in t.column("label").to_pylist()]) for t in (asked, there))
            positives = asked.column("positive_ids").to_pylist()
            wanted = [list(map(_score, *x)) for x in zip(asked.column("positive_scores").to_pylist(), asked.column("beyond").to_pylist(), strict=True)]
            for part, scores in _tiles(asked, there):
                allowed = (label[part][:, None] != other[None, :]) & (own[part][:, None] != ids[None, :])
                for nth in range(max(map(len, wanted[part]))):
                    has = [i for i, w in enumerate(wanted[part]) if nth < len(w)]
                    top = [wanted[part][i][nth] for i in has]
                    # The least whole score s with 100 s >= least * top; a long holds both wherever scores are longs.
                    high, low = (_bounds(x, scores.dtype)[:, None] for x in (top, [-(-least * t // 100) for t in top]))
                    mine = scores[has]
                    r, c = best(mine, allowed[has] & (mine >= low) & (mine <= high), k)
                    out += [(int(own[part][has[i]]), nth, positives[part.start + has[i]][nth], j, _long(top[i]), _long(s), _beyond(s)) for i, j, s in zip(r.tolist(), ids[c].tolist(), mine[r, c].tolist(), strict=True)]
        return _table(out, schema)

    return run


def _bounds(values: list[int], kind: np.dtype) -> np.ndarray:
    return np.array([_long(v) for v in values], np.int64) if kind != object else _ints_of(values, (len(values),))


def _table(rows: list[tuple], schema: pa.Schema) -> pa.Table:
    return pa.table([pa.array([row[i] for row in rows], f.type) for i, f in enumerate(schema)], schema=schema)

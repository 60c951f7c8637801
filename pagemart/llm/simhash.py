"""SimHash near-duplicates: positional bytes as an inverted index, count filter, verification.

A fingerprint has eight bytes. Two fingerprints that differ in at most three
bits differ in at most three bytes, so they share at least five positional
bytes: that is the guaranteed minimum the count filter asks for. Posting lists
of single bytes would hold a fixed share of all fingerprints each, so the index
is partitioned further: a list is of the values of four positions at once, for
the 14 choices of four positions whose places, as numbers of three bits, add up
to nothing by exclusive or (the planes of a cube). Any three positions lie in one
such plane, and its complement is another, so every pair that shares five bytes
stands together in some list. Within a list the positional bytes that a pair
shares are tallied over all eight positions; pairs with a tally below five are
dropped, and what is retained is verified by counting differing bits.

A list fixes 32 bits of the fingerprint, so chance neighbours are few at any size
of the corpus. Equal fingerprints are one entry. Within a long list (a family of
near copies) the partners of a fingerprint are found by flipping up to three of
its free bits, not by pairing. A task never holds a list of more than HUGE
fingerprints: it passes them on, and a second round deals them into the four lists
that fix one more position each, which have at most 2**24 entries. Lists give
forests, not all pairs, and components come from iterated star joins.

Cases: null text is text without words, whose fingerprint is zero; a null id
takes part, but a component is named by its smallest id that is not null (null
if it has none); repeated rows each give a row; empty texts are texts without
words; very long texts are read whole; no rows give no rows; further columns,
whatever their names, are kept by one_of_each and not read by anything.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations, repeat

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart.llm.shared import free_name, join_hot, quoted, stored

SEED = 42
#: From this length on, a list's partners are found by flipping bits; from HUGE on, it is split.
LONG, HUGE = 16_384, 1 << 20
#: Pairs that a task holds before it makes a forest of them, beside those of one step.
PENDING = 1 << 20
#: Ids to drop that are broadcast at most, of 8 bytes each.
DROPPED = 2_000_000


def fingerprint(text: bytes, width: int) -> int:
    """64 bits: each set where over half of the shingles' hashes have it set."""
    words = text.lower().split()  # of bytes: only A-Z change, and only ASCII white space splits
    if not words:
        return 0
    if len(words) < width:
        shingles = [b" ".join(words)]
    else:
        shingles = list(map(b" ".join, zip(*(words[i:] for i in range(width)), strict=False)))
    total = np.zeros(64, np.int64)
    for i in range(0, len(shingles), 8192):
        hashes = np.fromiter(map(xxhash.xxh64_intdigest, shingles[i : i + 8192], repeat(SEED)), np.uint64)
        total += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * total > len(shingles)).view(np.int64)[0])


def fingerprints(df: DataFrame, text_col: str = "text", out: str = "fingerprint", width: int = 3) -> DataFrame:
    """df with the fingerprint (long) of each whole text."""

    @F.pandas_udf("long")
    def of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield pd.Series([fingerprint((t or "").encode(), width) for t in texts], index=texts.index, dtype="int64")

    return df.withColumn(out, of(F.coalesce(F.col(text_col), F.lit(""))))


def as_hex(fingerprint_col: Column) -> Column:
    """16 lower-case hex digits."""
    return F.lpad(F.lower(F.hex(fingerprint_col)), 16, "0")


def _masks(most: int) -> list[int]:
    """Byte positions, as masks, such that values of at most so many differing bytes share all of some."""
    if most <= 3:
        chosen = [c for c in combinations(range(8), 4) if c[0] ^ c[1] ^ c[2] ^ c[3] == 0]
    else:
        chosen = list(combinations(range(8), 8 - most))
    return [sum(255 << 8 * i for i in c) for c in chosen]


def tally(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """How many positional bytes each pair of values shares."""
    return (np.ascontiguousarray(a ^ b).view(np.uint8).reshape(-1, 8) == 0).sum(axis=1)


@lru_cache(maxsize=128)
def _flips(free: int, most: int) -> np.ndarray:
    """All ways to flip one to most of the bits that are set in free."""
    bits = [np.uint64(1 << i) for i in range(64) if free >> i & 1]
    return np.array([np.bitwise_xor.reduce(np.array(c)) for n in range(1, most + 1) for c in combinations(bits, n)], np.uint64)


def _forest(left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges with the same components as left - right, one for each node but the smallest of each."""
    nodes, at = np.unique(np.concatenate([left, right]), return_inverse=True)
    a, b = at[: len(left)], at[len(left) :]
    root = np.arange(len(nodes))
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, root[a], low)
        np.minimum.at(new, root[b], low)
        while not np.array_equal(again := new[new], new):
            new = again
        if np.array_equal(new, root):
            break
        root = new
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def links_of_lists(lists: np.ndarray, values: np.ndarray, masks: list[int], most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within posting lists. Rows are sorted by (list, masked value)."""
    key = values & np.array(masks, np.uint64)[lists]
    starts = np.flatnonzero(np.r_[True, (lists[1:] != lists[:-1]) | (key[1:] != key[:-1])])
    sizes = np.diff(np.r_[starts, len(values)])
    place = np.repeat(np.arange(len(starts)), sizes)
    found_a, found_b = [], []
    pending = 0

    def keep(a: np.ndarray, b: np.ndarray) -> None:
        counted = tally(a, b) >= 8 - most
        a, b = a[counted], b[counted]
        near = np.bitwise_count(a ^ b) <= most
        found_a.append(a[near].view(np.int64))
        found_b.append(b[near].view(np.int64))
        nonlocal pending
        pending += len(found_a[-1])
        if pending > PENDING:
            # Dense families have very many pairs; a forest of them says the same.
            forest = _forest(np.concatenate(found_a), np.concatenate(found_b))
            found_a[:], found_b[:] = forest[:1], forest[1:]
            pending = len(forest[0])

    short = np.flatnonzero((sizes[place] > 1) & (sizes[place] <= LONG))
    step = 1
    while len(short):
        short = short[short + step < len(values)]
        short = short[place[short] == place[short + step]]
        keep(values[short], values[short + step])
        step += 1
    for i in np.flatnonzero(sizes > LONG):
        members = np.sort(values[starts[i] : starts[i] + sizes[i]])
        for flip in _flips(~masks[lists[starts[i]]] & (1 << 64) - 1, most):
            other = members ^ flip
            at = np.minimum(np.searchsorted(members, other), len(members) - 1)
            hit = members[at] == other
            keep(members[hit], other[hit])
    if not found_a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return _forest(np.concatenate(found_a), np.concatenate(found_b))


def _narrowed(masks: list[int]) -> list[int]:
    """Each mask with one more position, four of them for one of four positions."""
    return [m | 255 << 8 * i for m in masks for i in range(8) if not m >> 8 * i & 1]


def _linked(index: DataFrame, masks: list[int], most: int, huge: int | None) -> DataFrame:
    """(src, dst, list) from an index (list, value): links, with a null list; values of lists longer than huge, as src."""
    of_list = F.element_at(F.array(*[F.lit(int(np.uint64(m).view(np.int64))).cast("long") for m in masks]), F.col("list") + 1)
    dealt = index.select("list", "value", of_list.bitwiseAND(F.col("value")).alias("key")).repartition("list", "key").sortWithinPartitions("list", "key")

    def batch_of(src: np.ndarray, dst: np.ndarray | None, lists: np.ndarray | None) -> pa.RecordBatch:
        none = pa.nulls(len(src))
        return pa.RecordBatch.from_arrays([pa.array(src, pa.int64()), none.cast(pa.int64()) if dst is None else pa.array(dst, pa.int64()), none.cast(pa.int32()) if lists is None else pa.array(lists, pa.int32())], names=["src", "dst", "list"])

    def within(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        empty = [np.empty(0, np.int64)] * 3
        kept, passing = empty, None

        def linked(rows: list[np.ndarray]) -> pa.RecordBatch:
            return batch_of(*links_of_lists(rows[0], rows[1].view(np.uint64), masks, most), None)

        for batch in batches:
            new = [c.to_numpy(zero_copy_only=False).astype(np.int64) for c in batch.columns]
            if passing:
                same = (new[0] == passing[0]) & (new[2] == passing[1])
                yield batch_of(new[1][same], None, new[0][same])
                if same.all():
                    continue
                new, passing = [k[~same] for k in new], None
            kept = [np.concatenate(pair) for pair in zip(kept, new, strict=True)]
            if not len(kept[0]):
                continue
            # The last list may go on in the next batch.
            same = (kept[0] == kept[0][-1]) & (kept[2] == kept[2][-1])
            if len(same) >= 1 << 18 and not same.all():
                yield linked([k[~same] for k in kept])
                kept = [k[same] for k in kept]
            if huge and len(kept[0]) >= huge and same.all():
                passing = kept[0][-1], kept[2][-1]
                yield batch_of(kept[1], None, kept[0])
                kept = empty
        if len(kept[0]):
            yield linked(kept)

    return dealt.mapInArrow(within, "src long, dst long, list int")


def links(values: DataFrame, col: str, most: int = 3) -> DataFrame:
    """(src, dst) links that connect what is within most differing bits in the distinct longs of col."""
    masks = _masks(most)
    index = values.where(F.col(col).isNotNull()).select(F.explode(F.sequence(F.lit(0), F.lit(len(masks) - 1))).alias("list"), F.col(col).alias("value"))
    found = stored(_linked(index, masks, most, HUGE if most <= 3 else None), "links")
    out = found.where("list IS NULL")
    rest = found.where("list IS NOT NULL")
    if not rest.isEmpty():
        again = rest.select((F.col("list") * 4 + F.explode(F.sequence(F.lit(0), F.lit(3)))).alias("list"), F.col("src").alias("value"))
        out = out.unionByName(_linked(again, _narrowed(masks), most, None))
    return out.select("src", "dst").distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; the root is the smallest node of its component.

    Alternates large-star and small-star steps. Each round's edges are written to
    the shared folder; only their number and checksum come to the driver.
    """
    before = None
    edges = stored(edges.where("src <> dst").select(F.greatest("src", "dst").alias("u"), F.least("src", "dst").alias("v")).distinct(), "edges")
    while True:
        n, check = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if (n, check) == before or not n:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        before = (n, check)
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = stored(large.where("u <> v"), "edges")
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        edges = stored(small.unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct(), "edges")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most: int = 3) -> DataFrame:
    """(id, fingerprint long, root long, component_id) for each row of df.

    root names the component by its smallest fingerprint, component_id by its
    smallest id.
    """
    prints = stored(fingerprints(df.select(F.col(id_col).alias("id"), F.col(text_col).alias("text")), width=width).select("id", "fingerprint"), "prints")
    return stored(_labelled(prints, most), "labelled").withColumnRenamed("id", id_col)


def _labelled(prints: DataFrame, most: int) -> DataFrame:
    """(id, fingerprint, root, component_id) from (id, fingerprint)."""
    classes = stored(prints.groupBy("fingerprint").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n")), "classes")
    found = components(links(classes, "fingerprint", most))
    linked = classes.join(found, F.col("fingerprint") == F.col("node")).select("fingerprint", "root", "first_id")
    # A component is a row for each class here, so a large one is partly aggregated before it meets in one task.
    names = stored(linked.groupBy("root").agg(F.min("first_id").alias("name"), F.count(F.lit(1)).alias("m")), "names")
    total, members = classes.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    linked = stored(join_hot(linked.select("fingerprint", "root"), names, "root", "m", members), "linked")
    named = classes.join(linked, "fingerprint", "left").select("fingerprint", "n", F.coalesce("root", "fingerprint").alias("root"), F.coalesce("name", "first_id").alias("component_id"))
    return join_hot(prints, stored(named, "named"), "fingerprint", "n", total).select("id", "fingerprint", "root", "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 3, most: int = 3) -> DataFrame:
    """df's rows with the smallest id of each component, all columns kept.

    Only the ids that go are joined to the rows, broadcast up to DROPPED of them,
    so texts stay where they are. Where ids are repeated or null, rows are told
    apart by their fingerprints too, and one row of each component is taken; only
    then are rows grouped by it.
    """
    found = near_duplicates(df, id_col, text_col, width, most)
    row_id = quoted(id_col)
    same = F.col(row_id).eqNullSafe(F.col("component_id"))
    repeated = found.count() != found.select(row_id).distinct().count()
    if not repeated:
        gone = free_name(df.columns, "gone")
        drop = stored(found.where(~same).select(F.col(row_id).alias(gone)), "gone")
        drop = F.broadcast(drop) if drop.count() <= DROPPED else drop
        return df.join(drop, F.col(row_id).eqNullSafe(F.col(gone)), "left_anti")
    names = [free_name(df.columns, n) for n in ("kept_id", "kept_print", "kept_root", "own_print")]
    keep = found.where(same).select(F.col(row_id).alias(names[0]), F.col("fingerprint").alias(names[1]), F.col("root").alias(names[2])).distinct()
    left = fingerprints(df, text_col, names[3], width)
    out = left.join(keep, F.col(row_id).eqNullSafe(F.col(names[0])) & (F.col(names[3]) == F.col(names[1])))
    return out.dropDuplicates([names[2]]).select(*[quoted(c) for c in df.columns])

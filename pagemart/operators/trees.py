"""Trees of any depth, on children(key, parent_key, pos): a root has no parent, keys are unique.

Rounds double how far a node sees: after n rounds it knows its ancestor 2^n links
above, so a chain of 10,000 nodes takes 14 rounds and a crawl of five levels three.
Nodes whose top links to no root (an unknown parent, a circle) are left out of
numbers and find no value beyond what is above them. Siblings, and roots, are in
order of pos and key; a null pos comes first. A parent may have most of all nodes:
its children are cut into ranges, and what nodes look up is an
inner join, which adaptive execution splits. Each round deals its nodes by key again,
or a union of what moved and what did not would have ever more partitions. A round's table
goes when the next one is written, so two of them lie on disk at most.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart.operators.lineage import cut, dropped, written


def _parents(children: DataFrame, *more: str) -> DataFrame:
    """(key, up, root, more): up is the parent if it is there."""
    there = children.select(F.col("key").alias("up"))
    below = children.where(F.col("parent_key").isNotNull())
    below = below.join(there, F.col("parent_key") == F.col("up"), "left").select("key", "up", F.lit(False).alias("root"), *more)
    return children.where(F.col("parent_key").isNull()).select("key", F.col("parent_key").alias("up"), F.lit(True).alias("root"), *more).unionByName(below)


def _jumped(nodes: DataFrame, active: DataFrame, **values) -> DataFrame:
    """active nodes with the up of their up, and values of (own row, row of their up); the others of nodes as they are."""
    above = nodes.select(*[F.col(c).alias(f"up_{c}") for c in nodes.columns])
    moved = active.join(above, F.col("up") == F.col("up_key"))
    kept = [c for c in nodes.columns if c not in ("up", *values)]
    return moved.select(*kept, values.pop("up", F.col("up_up")).alias("up"), *[v.alias(c) for c, v in values.items()])


def nearest(children: DataFrame, value: str) -> DataFrame:
    """(key, value): the value of the nearest ancestor that has one, itself first; null where none has.

    A node leaves the rounds when it has found a value, so there are as many as the
    logarithm of the longest way to one. Circles without a value end when rounds
    have seen further than there are nodes.
    """
    nodes = written(_parents(children, value).drop("root").withColumnRenamed(value, "found"))
    seen, total = 1, nodes.count()
    while seen <= 2 * total:
        open_ = F.col("found").isNull() & F.col("up").isNotNull()
        active = nodes.where(open_)
        if active.isEmpty():
            break
        moved = _jumped(nodes, active, found=F.col("up_found"), up=F.when(F.col("up_found").isNull(), F.col("up_up")))
        before, nodes, seen = nodes, written(nodes.where(~open_).unionByName(moved).repartition("key")), 2 * seen
        dropped(before)
    return nodes.select("key", F.col("found").alias(value))


#: Rows of a part of a tour.
PART = 300_000
#: Places between parts, up to which all tasks get all of them.
PLACES = 500_000
_TOURED = "kind int, key {key}, at string, to string, n long, d long, back string, back_n long"
_NODE, _PLACE, _ENDS = 0, 1, 2


def _named(kind: str, values: pa.Array) -> pa.Array:
    return pc.binary_join_element_wise(pa.scalar(kind), values.cast(pa.string()), pa.scalar(""))


def _toured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A part of the tour: rows (key, parent_key, inner), siblings in order, cut anywhere.

    A node is entered (place i) and left (place m + i). What follows a place in the part is linked here, by rounds that double,
    so that each place knows which place outside comes next, nodes entered until then (n), and those less nodes left (d).
    Places outside have names: e and u are the way into a node's first child and out of its last one,
    a and h what follows a part and a part's first row; the empty name is the end.
    """
    rows = list(batches)
    if not rows or not sum(map(len, rows)):
        return
    rows, part = pa.Table.from_batches(rows).combine_chunks(), TaskContext.get().partitionId()
    key, up, inner = (rows.column(c).chunk(0) for c in ("key", "parent_key", "inner"))
    m, kind = len(key), key.type
    parent = pc.index_in(up, value_set=key).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
    top, inner = up.is_null().to_numpy(zero_copy_only=False), inner.to_numpy(zero_copy_only=False)
    same = pc.equal(up.slice(1), up.slice(0, m - 1)).fill_null(False).to_numpy(zero_copy_only=False) | (top[1:] & top[:-1])
    begins, ends = np.flatnonzero(~same) + 1, np.flatnonzero(~same)  # of the first row's siblings some may be in the part before, of the last row's in the next
    first, whole = np.full(m, -1), np.zeros(m, dtype=bool)
    first[parent[begins[parent[begins] >= 0]]] = begins[parent[begins] >= 0]
    whole[parent[ends[parent[ends] >= 0]]] = True
    follows = np.concatenate([np.where(inner, first, np.arange(m) + m), np.where(parent >= 0, parent + m, -1)])
    follows[m:-1][same], follows[-1] = np.flatnonzero(same) + 1, -1
    n, d = np.repeat([1, 0], m), np.repeat([1, -1], m)
    last, out = np.arange(2 * m), np.flatnonzero(follows < 0)
    for _ in range((2 * m).bit_length()):  # who is on the way after that is in a circle
        moving = np.flatnonzero(follows >= 0)
        if not len(moving):
            break
        to = follows[moving]
        n[moving], d[moving], last[moving], follows[moving] = n[moving] + n[to], d[moving] + d[to], last[to], follows[to]
    left = out[out >= m] - m  # in the order of places, as out is
    leaving = pc.if_else(pa.array(top[left]), pa.scalar(""), _named("u", up.take(pa.array(left))))
    leaving = pc.if_else(pa.array(left == m - 1), pa.scalar(f"a{part}"), leaving)
    names = pa.concat_arrays([_named("e", key.take(pa.array(out[out < m]))), leaving])
    number = np.full(2 * m, -1)
    number[out] = np.arange(len(out))
    ended = follows < 0

    def comes(places: np.ndarray) -> pa.Array:
        return names.take(pa.array(number[last[places]], mask=~ended[places]))

    def made(what: int, places: np.ndarray, **columns: pa.Array) -> pa.RecordBatch:
        """A row for each place; those in circles are left out."""
        given = {"kind": pa.array(np.full(len(places), what, dtype=np.int32)), "key": pa.nulls(len(places), kind), "at": pa.nulls(len(places), pa.string()), "to": comes(places), "n": pa.array(n[places]), "d": pa.array(d[places]), "back": pa.nulls(len(places), pa.string()), "back_n": pa.nulls(len(places), pa.int64())}
        return pa.RecordBatch.from_pydict(given | columns).filter(pa.array(ended[places]))

    begins = begins[(parent[begins] < 0) & ~top[begins]]
    over = np.flatnonzero(inner & ~whole)
    yield made(_PLACE, begins, at=_named("e", up.take(pa.array(begins))))
    yield made(_PLACE, np.zeros(1, dtype=np.int64), at=pa.array([f"h{part}"]))
    yield made(_PLACE, m + over, at=_named("u", key.take(pa.array(over))))
    yield pa.RecordBatch.from_pydict({"kind": pa.array([_ENDS], pa.int32()), "key": pa.nulls(1, kind), "at": pa.nulls(1, pa.string()), "to": up.slice(0, 1).cast(pa.string()), "n": pa.array([part]), "d": pa.array([0]), "back": up.slice(m - 1).cast(pa.string()), "back_n": pa.array([0])})
    for start in range(0, m, 50_000):
        nodes = np.arange(start, min(start + 50_000, m))
        yield made(_NODE, nodes, key=key.slice(start, len(nodes)), back=comes(m + nodes), back_n=pa.array(n[m + nodes]))


def _between(ends: list[tuple[int, str | None, str | None]]) -> list[tuple[str, str]]:
    """(place, the same under another name), of parts in order with the parents of their first and last rows: whether siblings go on in the next part."""
    out = []
    for (part, _, last), (after, first) in zip(ends, [*((p, f) for p, f, _ in ends[1:]), (None, None)]):
        goes_on = after is not None and first == last
        out.append((f"a{part}", f"h{after}" if goes_on else "" if last is None else f"u{last}"))
        if after is not None and not goes_on and first is not None:
            out.append((f"e{first}", f"h{after}"))
    if ends and ends[0][1] is not None:
        out.append((f"e{ends[0][1]}", f"h{ends[0][0]}"))
    return out


def numbers(children: DataFrame) -> DataFrame:
    """(key, depth, size, pre, last, post) of a walk of all trees.

    pre counts a node before its children, left to right; the nodes below it, itself
    included, are the size many from pre to last. post is the way back: children right to
    left, then their node. All follows from a tour that enters and leaves each node: how many nodes are entered
    from a place on, and how many of them are not left. Siblings lie together in parts of the tour, and each part is one
    task, which links what it can; only places where the tour goes from part to part take part in rounds. They
    are few where nodes whose parents' keys are near each other are near in the tree, and at most twice the nodes that have children.
    """
    spark, typed = children.sparkSession, children.schema["key"].dataType.simpleString()
    links = written(children.select("key", "parent_key", "pos"))
    inner = links.select(F.col("parent_key").alias("_up")).where(F.col("_up").isNotNull()).distinct()
    rows = links.join(inner, F.col("key") == F.col("_up"), "left").select("key", "parent_key", "pos", F.col("_up").isNotNull().alias("inner"))
    order = ["parent_key", "pos", "key"]
    parts = rows.repartitionByRange(max(1, ceil(links.count() / PART)), *order).sortWithinPartitions(*order)
    toured = written(parts.select("key", "parent_key", "inner").mapInArrow(_toured, _TOURED.format(key=typed)))
    dropped(links)
    ends = sorted(((r.n, r.to, r.back) for r in toured.where(F.col("kind") == _ENDS).collect()), key=lambda r: r[0])  # a row for each part
    more = spark.createDataFrame([("", "")] + _between(ends), "at string, to string").select("at", "to", F.lit(0).cast("long").alias("n"), F.lit(0).cast("long").alias("d"))
    places = written(toured.where(F.col("kind") == _PLACE).select("at", "to", "n", "d").unionByName(more))
    seen, count = 1, places.count()
    while seen <= 2 * count:
        active = places.where(F.col("to") != "")
        if active.isEmpty():
            break
        beyond = places.select(*[F.col(c).alias(f"up_{c}") for c in places.columns])
        moved = active.join(beyond, F.col("to") == F.col("up_at")).select("at", F.col("up_to").alias("to"), (F.col("n") + F.col("up_n")).alias("n"), (F.col("d") + F.col("up_d")).alias("d"))
        before, places, seen = places, written(places.where(F.col("to") == "").unionByName(moved).repartition("at")), 2 * seen
        dropped(before)
    before, places = places, cut(places.where(F.col("to") == "").select("at", "n", "d"))
    dropped(before)
    start = places.where(F.col("at") == f"h{ends[0][0]}").first() if ends and ends[0][1] is None else None
    total = start.n if start else 0
    known = lambda to, **cs: (F.broadcast if count <= PLACES else lambda x: x)(places.select(F.col("at").alias(to), *[F.col(c).alias(a) for c, a in cs.items()]))
    met = toured.where(F.col("kind") == _NODE).join(known("to", n="to_n", d="to_d"), "to").join(known("back", n="later"), "back")
    post, size = F.col("n") + F.col("to_n"), F.col("n") + F.col("to_n") - F.col("back_n") - F.col("later")
    pre = F.lit(total).cast("long") + 1 - post
    return met.select("key", (-F.col("d") - F.col("to_d")).cast("int").alias("depth"), size.alias("size"), pre.alias("pre"), (pre + size - 1).alias("last"), post.alias("post"))

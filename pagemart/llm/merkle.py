"""Merkle manifest of a dataset, its trees kept as nested intervals.

Each row is a leaf; the leaves of a group form a tree in order, and the groups'
subroots form one more tree. A node carries the interval [lo, hi) of the ranks of
the leaves below it. All nodes of a level but the last cover spans of the same
power of FANOUT, so a level is cut into buckets of its parents' span, and a node
finds its parent by a join on (tree, bucket) with the intervals' containment as
the condition; no bucket has more than FANOUT nodes, whatever the tree. What a
parent's children cover beside a node's own interval are its siblings, left and
right of it. Paths are handed down from the subroots, so each is put together
once a node, not once for each leaf below.

A path is an array of (left, right): the joined digests of the siblings before
and after, from the leaf up to the root. Folding a leaf with its path gives the
root again if, and only if, the leaf is what it was.

Leaves are ranked by ranges of (group, order), so a group may have most rows, and
texts never move: hashes are taken where the rows are read.

Cases: null values and empty texts have leaves of their own ("-" and "0:"); null
groups come first, null orders first within a group; ties of the order go by the
leaf's digest, and rows that are the same in all columns are leaves each, with a
proof each; a row of an only leaf of an only group has an empty path, and its leaf
is the root; no rows give no rows; further columns, whatever their names, are
neither read nor hashed; texts of any length are hashed whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemart.llm.shared import SMALL, quoted, stored

FANOUT = 8
#: Parents (some kilobytes each) that are broadcast at most.
FEW_PARENTS = 4_096
_PATH = "array<struct<left:string,right:string>>"


def sized(value: Column) -> Column:
    """What a leaf's hash takes in of a value: its UTF-8 byte count, ':' and the value; '-' for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf(values: list[Column]) -> Column:
    return F.sha2(F.concat(*[sized(v) for v in values]).cast("binary"), 256)


def folded(start: Column, path: Column) -> Column:
    """The root that a leaf's digest and its path lead to."""
    return F.aggregate(path, start, lambda h, step: F.sha2(F.concat(step.left, h, step.right).cast("binary"), 256))


def proof(path: Column) -> Column:
    """The digest of a path's siblings, level by level, left to right."""
    return F.sha2(F.array_join(F.transform(path, lambda step: F.concat(step.left, step.right)), "").cast("binary"), 256)


def ranked(rows: DataFrame, *order: str) -> DataFrame:
    """rows (with a column tree, never null) with lo, hi = lo + 1 and total: the rank in its tree, from 0, and the tree's leaves."""
    ranges = rows.repartitionByRange("tree", *order).sortWithinPartitions("tree", *order)
    # Its upper bits number the range, its lower 33 the row in it.
    ranges = stored(ranges.withColumn("at", F.monotonically_increasing_id()).withColumn("range", F.shiftright("at", 33)), "ranges")
    sizes = ranges.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count(F.lit(1)).alias("n"))
    tree = Window.partitionBy("tree")
    before = F.coalesce(F.sum("n").over(tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    sizes = stored(sizes.select("tree", "range", (before - F.col("first")).alias("shift"), F.sum("n").over(tree).alias("total")), "sizes")
    placed = ranges.join(F.broadcast(sizes) if sizes.count() <= SMALL else sizes, ["tree", "range"]).withColumn("lo", F.col("at") + F.col("shift"))
    return placed.withColumn("hi", F.col("lo") + 1).drop("at", "range", "shift")


def _bucket(span: int) -> Column:
    return F.expr(f"lo div {span}L")


def levels(leaves: DataFrame, fanout: int = FANOUT) -> list[DataFrame]:
    """(tree, lo, hi, total, digest, kids) of each level above the leaves, up to that at which every tree has one node.

    kids are the node's children (lo, hi, digest), in order. A tree's only node of a level has no parent.
    """
    out, span, below = [], 1, leaves
    most = leaves.agg(F.max("total")).first()[0] or 0
    while most > span:
        kids = F.array_sort(F.collect_list(F.struct("lo", "hi", "digest")))  # at most fanout
        nodes = below.where(F.col("total") > span).groupBy("tree", "total", _bucket(span * fanout).alias("bucket")).agg(kids.alias("kids"))
        digest = F.sha2(F.array_join("kids.digest", "").cast("binary"), 256)
        below = stored(nodes.select("tree", F.col("kids")[0].lo.alias("lo"), F.element_at("kids", -1).hi.alias("hi"), "total", digest.alias("digest"), "kids"), "level")
        out.append(below)
        span *= fanout
    return out


def tops(leaves: DataFrame, above: list[DataFrame], fanout: int = FANOUT) -> DataFrame:
    """(tree, digest) of each tree's last node."""
    out, span = None, 1
    for nodes in [leaves, *above]:
        last = nodes.where((F.col("total") <= span) & (F.col("total") > F.lit(span // fanout))).select("tree", "digest")
        out = last if out is None else out.unionByName(last)
        span *= fanout
    return out


def _few(df: DataFrame) -> DataFrame:
    return F.broadcast(df) if df.count() <= FEW_PARENTS else df


def paths(leaves: DataFrame, above: list[DataFrame], starts: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """leaves with path and subroot. starts has each tree's (tree, subroot, path), the path being that from its top to the root."""
    handed, starts, depth = None, _few(starts), len(above)
    for k in range(depth, -1, -1):
        nodes, span = leaves if k == 0 else above[k - 1], fanout**k
        top = (F.col("total") <= span) & (F.col("total") > F.lit(span // fanout))
        found = nodes.where(top).join(starts, "tree")
        if handed is not None:
            parents = _few(handed).select(F.col("tree").alias("up_tree"), F.col("lo").alias("up_lo"), F.col("hi").alias("up_hi"), _bucket(span * fanout).alias("up_bucket"), F.col("kids").alias("up_kids"), F.col("path").alias("up_path"), "subroot")
            contained = (F.col("tree") == F.col("up_tree")) & (_bucket(span * fanout) == F.col("up_bucket")) & (F.col("up_lo") <= F.col("lo")) & (F.col("hi") <= F.col("up_hi"))
            side = lambda test: F.array_join(F.transform(F.filter("up_kids", test), lambda n: n.digest), "")
            step = F.struct(side(lambda n: n.hi <= F.col("lo")).alias("left"), side(lambda n: n.lo >= F.col("hi")).alias("right"))
            below = nodes.where(F.col("total") > span).join(parents, contained)
            found = found.unionByName(below.select(*nodes.columns, "subroot", F.concat(F.array(step), F.col("up_path")).alias("path")))
        handed = stored(found, "paths") if k else found
    return handed


def proofs(rows: DataFrame, columns: list[str], group: str, order: str, keep: dict[str, Column] | None = None, changed: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """(keep's columns, leaf, changed_leaf, subroot, root, path) of each row.

    A leaf hashes the columns, in that order; changed (column -> what it is found to
    be now) says what changed_leaf hashes instead. keep (name -> column of rows) says
    what comes back with each row, by default the order's column.
    """
    kept = keep if keep is not None else {order: F.col(quoted(order))}
    values = [F.col(quoted(c)) for c in columns]
    now = [(changed or {}).get(c, v) for c, v in zip(columns, values, strict=True)]
    tree = F.coalesce(F.concat(F.lit("="), F.col(quoted(group)).cast("string")), F.lit(""))
    one = leaf(values)
    taken = rows.select(tree.alias("tree"), F.col(quoted(order)).alias("sort"), one.alias("digest"), (leaf(now) if changed else one).alias("changed_leaf"), F.struct(*[c.alias(n) for n, c in kept.items()]).alias("keep"))
    # Equal rows would share a range; their numbers tell them apart.
    taken = stored(taken.withColumn("nth", F.monotonically_increasing_id()), "leaves")
    leaves = stored(ranked(taken, "sort", "digest", "nth").drop("sort", "nth"), "ranked")
    above = levels(leaves, fanout)
    subroots = stored(tops(leaves, above, fanout).withColumn("of", F.col("tree")).withColumn("tree", F.lit("")), "subroots")
    groups = stored(ranked(subroots, "of"), "groups")
    over = levels(groups, fanout)
    root = tops(groups, over, fanout).select("digest").first()
    start = stored(groups.limit(0), "none") if root is None else groups
    empty = F.array().cast(_PATH)
    whole = paths(start, over, tops(groups, over, fanout).select("tree", F.col("digest").alias("subroot"), empty.alias("path")), fanout)
    starts = stored(whole.select(F.col("of").alias("tree"), F.col("digest").alias("subroot"), "path"), "starts")
    found = paths(leaves, above, starts, fanout)
    return found.select("keep.*", F.col("digest").alias("leaf"), "changed_leaf", "subroot", F.lit(root[0] if root else None).cast("string").alias("root"), "path")


def verified(rows: DataFrame, columns: list[str], group: str, order: str, changed: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """(order, leaf, subroot, root, proof_sha256, folded_root, verified): whether each row, as it is found now, is what the root vouches for."""
    found = proofs(rows, columns, group, order, changed=changed, fanout=fanout)
    fold = found.select(quoted(order), "leaf", "subroot", "root", proof(F.col("path")).alias("proof_sha256"), folded(F.col("changed_leaf"), F.col("path")).alias("folded_root"))
    return fold.withColumn("verified", F.col("folded_root") == F.col("root"))

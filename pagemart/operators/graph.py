"""Link-graph operators on nodes(key, ord, state, ...) and edges(src_key, dst_key).

Walks are frontier joins. Each round is written to a folder that all executors
share, so the plan stays short and a lost executor costs no earlier round; only
counts come to the driver.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart.operators.lineage import cut, numbered, spread
from pagemart.operators.resolve import first_of_key

#: Fixed: states of a page.
ERROR, CREATED, AWAITING_FETCH, FETCHING, AWAITING_PROCESSING, PROCESSING, AWAITING_LOAD, LOADING, AWAITING_CHILDREN, COMPLETED = range(-1, 9)
STAGES = {"fetch": (CREATED, AWAITING_FETCH, FETCHING), "process": (AWAITING_PROCESSING, PROCESSING), "load": (AWAITING_LOAD, LOADING)}


def add_nodes(nodes: DataFrame, new: DataFrame) -> DataFrame:
    """Known keys stay as they are; of new ones the first in order comes in."""
    return nodes.unionByName(first_of_key(new, "key", "ord").join(nodes.select("key"), "key", "left_anti"), allowMissingColumns=True)


def add_edges(edges: DataFrame, new: DataFrame) -> DataFrame:
    return edges.unionByName(new.select(*edges.columns)).distinct()


def roots(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes that nothing links to."""
    return nodes.join(edges.select(F.col("dst_key").alias("key")), "key", "left_anti")


def remove(nodes: DataFrame, edges: DataFrame, gone: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Both without some nodes and their links."""
    gone = gone.select("key").distinct()
    left = edges.join(gone.withColumnRenamed("key", "src_key"), "src_key", "left_anti").join(gone.withColumnRenamed("key", "dst_key"), "dst_key", "left_anti")
    return nodes.join(gone, "key", "left_anti"), left.select(*edges.columns)


def without_orphans(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """Nodes with a link in or out."""
    linked = edges.select(F.col("src_key").alias("key")).distinct().union(edges.select(F.col("dst_key").alias("key")))
    return spread(nodes, "key").join(spread(linked, "key"), "key", "left_semi")


def descendants(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(start, key, depth) of all that is reachable from start(key), itself at depth 0; safe on cycles."""
    seen = cut(start.select(F.col("key").alias("start"), "key", F.lit(0).alias("depth")).distinct())
    frontier, depth = seen, 0
    while True:
        depth += 1
        step = frontier.join(edges, F.col("key") == F.col("src_key")).select("start", F.col("dst_key").alias("key")).distinct()
        frontier = cut(step.join(seen.select("start", "key"), ["start", "key"], "left_anti").withColumn("depth", F.lit(depth)))
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)


def ancestors(edges: DataFrame, start: DataFrame) -> DataFrame:
    """The same against the links' direction."""
    return descendants(edges.select(F.col("dst_key").alias("src_key"), F.col("src_key").alias("dst_key")), start)


def reachable(edges: DataFrame, start: DataFrame) -> DataFrame:
    """(key) of all that is reachable from any of start, that included; one walk for all of them."""
    seen = cut(start.select("key").distinct())
    frontier = seen
    while True:
        step = frontier.join(edges, F.col("key") == F.col("src_key")).select(F.col("dst_key").alias("key")).distinct()
        frontier = cut(step.join(seen, "key", "left_anti"))
        if frontier.isEmpty():
            return seen
        seen = seen.unionByName(frontier)


def nearest_ancestor(nodes: DataFrame, edges: DataFrame, start: DataFrame, value: str) -> DataFrame:
    """(key, value): the value of the nearest ancestor that has one, itself first; ties by ord.

    A start leaves the walk in the round in which it finds a value; what is walked
    are pairs of starts still without one and the ancestors of that round. Ends on cycles.
    """
    has = nodes.where(F.col(value).isNotNull()).select("key", "ord", value)
    frontier = seen = cut(start.select(F.col("key").alias("start"), "key").distinct())
    found = None
    while True:
        hits = frontier.join(has, "key").groupBy("start").agg(F.min_by(value, "ord").alias(value))
        hits = cut(hits)
        found = hits if found is None else found.unionByName(hits)
        left = frontier.join(hits.select("start"), "start", "left_anti")
        step = left.join(edges, F.col("key") == F.col("dst_key")).select("start", F.col("src_key").alias("key")).distinct()
        frontier = cut(step.join(seen, ["start", "key"], "left_anti"))
        if frontier.isEmpty():
            return start.select("key").join(found.withColumnRenamed("start", "key"), "key", "left")
        seen = seen.unionByName(frontier)


def complete(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes with AWAITING_CHILDREN turned COMPLETED where nothing below is unfinished.

    What blocks is walked upwards through waiting nodes; waiting nodes that are
    not met are complete. Ends on cycles.
    """
    waiting = nodes.where(F.col("state") == AWAITING_CHILDREN).select("key")
    blocking = nodes.where(~F.col("state").isin(AWAITING_CHILDREN, COMPLETED)).select("key")
    up = edges.join(waiting.withColumnRenamed("key", "src_key"), "src_key", "left_semi").select(F.col("dst_key").alias("src_key"), F.col("src_key").alias("dst_key"))
    blocked = reachable(up, blocking).withColumn("_blocked", F.lit(True))
    done = (F.col("state") == AWAITING_CHILDREN) & F.col("_blocked").isNull()
    return nodes.join(blocked, "key", "left").withColumn("state", F.when(done, COMPLETED).otherwise(F.col("state"))).select(*nodes.columns)


def with_open(nodes: DataFrame, edges: DataFrame) -> DataFrame:
    """nodes with open: how many of the nodes they link to are not complete, themselves left out."""
    children = edges.where(F.col("src_key") != F.col("dst_key"))
    children = children.join(nodes.where(F.col("state") != COMPLETED).select(F.col("key").alias("dst_key")), "dst_key", "left_semi")
    count = children.groupBy(F.col("src_key").alias("key")).agg(F.count(F.lit(1)).alias("_count"))
    return nodes.join(count, "key", "left").withColumn("open", F.coalesce("_count", F.lit(0))).drop("_count")


def changed_states(nodes: DataFrame, edges: DataFrame, changes: DataFrame) -> DataFrame:
    """(key, state, open) of all nodes whose state or count changes by changes(key, state), for an upsert into nodes.

    nodes are complete() and have their counts (with_open). The result is that of complete()
    and with_open() on the changed nodes, but only what changed is followed:
    a node's change moves the count of those that link to it, and a waiting one whose
    count falls to 0 completes and is a change in the next round. A complete node
    stays so when something below it opens. Keys that nodes do not have are left
    out; of several changes of a key the highest state counts. Nodes that wait for each other
    in a circle keep each other's counts above 0; complete() finds those.
    """
    wanted = changes.groupBy("key").agg(F.max("state").alias("new"))
    known = nodes.select("key", "state", "open").join(wanted, "key").where(F.col("state") != F.col("new"))
    was, is_ = (F.col(c) != COMPLETED for c in ("state", "new"))
    states = cut(known.select("key", F.col("new").alias("state"), (is_.cast("long") - was.cast("long")).alias("delta")))
    links = edges.where(F.col("src_key") != F.col("dst_key"))
    wave, moved, states = states.where("delta <> 0").select("key", "delta"), None, states.select("key", "state")
    asked = states.select("key")
    while True:
        step = links.join(wave, F.col("dst_key") == F.col("key")).groupBy(F.col("src_key").alias("key")).agg(F.sum("delta").alias("delta"))
        step = cut(step.where("delta <> 0"))
        moved = step if moved is None else cut(moved.unionByName(step).groupBy("key").agg(F.sum("delta").alias("delta")))
        seen = asked.unionByName(step.select("key")).distinct()
        now = seen.join(nodes.select("key", F.col("state").alias("old"), "open"), "key").join(states, "key", "left").join(moved, "key", "left")
        done = (F.coalesce("state", "old") == AWAITING_CHILDREN) & (F.col("open") + F.coalesce("delta", F.lit(0)) == 0)
        wave = cut(now.where(done).select("key", F.lit(-1).cast("long").alias("delta")))
        if wave.isEmpty():
            break
        finished = wave.select("key", F.lit(COMPLETED).alias("state"))
        states = cut(states.join(finished, "key", "left_anti").unionByName(finished))
        asked = asked.limit(0)
    both = states.join(moved, "key", "full")
    out = nodes.select("key", F.col("state").alias("old"), "open").join(both, "key")
    return out.select("key", F.coalesce("state", "old").alias("state"), (F.col("open") + F.coalesce("delta", F.lit(0))).alias("open"))


def drop_finished_roots(nodes: DataFrame, edges: DataFrame, hosts: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(nodes, edges, removed roots): subtrees of completed roots of the given hosts are taken out."""
    finished = roots(complete(nodes, edges), edges).where(F.col("state") == COMPLETED).join(hosts.select("host"), "host", "left_semi")
    left = remove(nodes, edges, reachable(edges, finished))
    return *left, finished


def after_fetch(nodes: DataFrame, edges: DataFrame, has_step: Column) -> DataFrame:
    """States after a fetch: to be processed, waiting for open children, or complete."""
    child = edges.join(nodes.select(F.col("key").alias("dst_key"), (F.col("state") != COMPLETED).alias("_open")), "dst_key").groupBy(F.col("src_key").alias("key")).agg(F.bool_or("_open").alias("_open"))
    state = F.when(has_step, AWAITING_PROCESSING).when(F.coalesce("_open", F.lit(False)), AWAITING_CHILDREN).otherwise(COMPLETED)
    return nodes.join(child, "key", "left").withColumn("state", state).select(*nodes.columns)


def after_load(nodes: DataFrame, edges: DataFrame, failed: Column) -> DataFrame:
    """States after a load: failed ones ERROR, others by whether all children are complete."""
    child = edges.join(nodes.select(F.col("key").alias("dst_key"), (F.col("state") == COMPLETED).alias("_done")), "dst_key").groupBy(F.col("src_key").alias("key")).agg(F.bool_and("_done").alias("_done"))
    state = F.when(failed, ERROR).when(F.coalesce("_done", F.lit(True)), COMPLETED).otherwise(AWAITING_CHILDREN)
    return nodes.join(child, "key", "left").withColumn("state", state).select(*nodes.columns)


def stage_of(state: Column) -> Column:
    """The stage that takes a node of this state; null if none does."""
    out = F.lit(None).cast("string")
    for stage, states in STAGES.items():
        out = F.when(state.isin(*states), stage).otherwise(out)
    return out


def tree_paths(children: DataFrame) -> DataFrame:
    """(key, path): positions from the root down, of children(key, parent_key, pos); a root has no parent."""
    level = cut(children.where(F.col("parent_key").isNull()).select("key", F.array("pos").alias("path")))
    found = level
    below = children.where(F.col("parent_key").isNotNull())
    while True:
        level = cut(below.join(level.select(F.col("key").alias("parent_key"), "path"), "parent_key").select("key", F.array_append("path", F.col("pos")).alias("path")))
        if level.isEmpty():
            return found
        found = found.unionByName(level)


def preorder(paths: DataFrame) -> DataFrame:
    """With nth: node first, then its children left to right."""
    return numbered(paths, "path", out="nth")


def postorder(paths: DataFrame) -> DataFrame:
    """With nth: children right to left, then their node; the way back of preorder."""
    return numbered(paths, F.col("path").desc(), out="nth")


def tree_violations(children: DataFrame) -> DataFrame:
    """(key, rule) of what children(key, parent_key, pos) break: one root (others than the first by pos and key), one parent
    for each key, parents that exist.
    """
    roots = children.where(F.col("parent_key").isNull()).select("key", "pos")
    first = roots.agg(F.min(F.struct("pos", "key")).alias("first"))
    second = roots.join(F.broadcast(first), (F.col("key") != F.col("first.key"))).select("key", F.lit("second root").alias("rule"))
    several = children.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key", F.lit("several parents").alias("rule"))
    lost = children.where(F.col("parent_key").isNotNull()).join(children.select(F.col("key").alias("parent_key")), "parent_key", "left_anti").select("key", F.lit("unknown parent").alias("rule"))
    return second.unionByName(several).unionByName(lost)


def in_state(nodes: DataFrame, *states: int) -> DataFrame:
    """Nodes in any of some states."""
    return nodes.where(F.col("state").isin(*states))


def set_state(nodes: DataFrame, keys: DataFrame, state: int) -> DataFrame:
    """nodes with those of some keys in a state."""
    marked = keys.select("key").distinct().withColumn("_set", F.lit(True))
    return nodes.join(marked, "key", "left").withColumn("state", F.when(F.col("_set"), state).otherwise(F.col("state"))).select(*nodes.columns)


def reset(nodes: DataFrame) -> DataFrame:
    """What was being worked on goes back to the state before, so that it is taken up again."""
    back = {FETCHING: AWAITING_FETCH, PROCESSING: AWAITING_PROCESSING, LOADING: AWAITING_LOAD}
    state = F.coalesce(*[F.when(F.col("state") == s, F.lit(b)) for s, b in back.items()], F.col("state"))
    return nodes.withColumn("state", state)


def resume_order(places: DataFrame, states: DataFrame, place: str = "path") -> DataFrame:
    """(key, state_rank, place) of unfinished nodes: fetching states first, then by place (a path, or a number of the walk)."""
    ranks = {AWAITING_FETCH: 0, CREATED: 1, FETCHING: 2, AWAITING_PROCESSING: 3, PROCESSING: 4}
    rank = F.coalesce(*[F.when(F.col("state") == s, F.lit(n)) for s, n in ranks.items()])
    return places.join(states.select("key", "state"), "key").withColumn("state_rank", rank).where(F.col("state_rank").isNotNull()).select("key", "state_rank", place).orderBy("state_rank", place)


def removable(children: DataFrame, gone: DataFrame) -> DataFrame:
    """(key) of gone, and of parents left without children by it, upwards."""
    found = cut(gone.select("key").distinct())
    while True:
        left = children.where(F.col("parent_key").isNotNull()).join(found, "key", "left_anti").select("parent_key")
        parents = children.join(found, "key", "left_semi").where(F.col("parent_key").isNotNull()).select(F.col("parent_key")).distinct()
        new = cut(parents.join(left, "parent_key", "left_anti").withColumnRenamed("parent_key", "key").join(found, "key", "left_anti"))
        if new.isEmpty():
            return found
        found = found.unionByName(new)


def new_links(found: DataFrame, nodes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(new nodes, all edges) of found links (src_key, target, ord): unknown targets, the first of each."""
    fresh = found.select(F.col("target").alias("key"), "ord").where(F.col("key").isNotNull()).join(nodes.select("key"), "key", "left_anti")
    return first_of_key(fresh, "key", "ord"), found.where(F.col("target").isNotNull()).select("src_key", F.col("target").alias("dst_key")).distinct()

"""Deep trees, completion by what changed, and nodes that may go, against SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pagemart.operators import graph, merge, trees
from pagemart.operators.lineage import cut, with_previous
from pagemart.plans.queries import _TREE, _tree
from pagemart.plans.registry import query, table


def _chains(spark, sf_dir) -> DataFrame:
    """A nation's orders as one chain, each hanging on the one before, its lines on it; hundreds of links deep and more."""
    owner = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), F.col("c_nationkey").alias("nation"))
    orders = with_previous(table(spark, sf_dir, "orders").select("o_custkey", "o_orderkey", "o_orderstatus").join(owner, "o_custkey"), "nation", F.col("o_orderkey"))
    up = F.coalesce(F.concat(F.lit("o"), "previous"), F.concat(F.lit("n"), "nation"))
    nodes = orders.select(F.concat(F.lit("o"), "o_orderkey").alias("key"), up.alias("parent_key"), F.lit(0).cast("long").alias("pos"), F.when(F.col("o_orderstatus") == "F", F.col("o_orderkey")).alias("finished"))
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber").distinct().join(orders.select(F.col("o_orderkey").alias("l_orderkey")), "l_orderkey", "left_semi").select(F.concat_ws("-", F.lit("l"), "l_orderkey", "l_linenumber").alias("key"), F.concat(F.lit("o"), "l_orderkey").alias("parent_key"), F.col("l_linenumber").cast("long").alias("pos"), F.lit(None).cast("long").alias("finished"))
    nation = table(spark, sf_dir, "nation").select(F.concat(F.lit("n"), "n_nationkey").alias("key"), F.lit(None).cast("string").alias("parent_key"), F.col("n_nationkey").cast("long").alias("pos"), F.lit(None).cast("long").alias("finished"))
    return nation.unionByName(nodes).unionByName(lines)


_CHAINS = """o AS (SELECT o_orderkey, o_orderstatus, c_nationkey AS nation FROM orders JOIN customer ON c_custkey = o_custkey),
m AS (SELECT 'n' || n_nationkey AS key, n_nationkey AS nation, 0 AS part, 0 AS a, 0 AS b, -1 AS ord, NULL AS finished FROM nation
UNION ALL SELECT 'o' || o_orderkey, nation, 1, o_orderkey, 0, o_orderkey, CASE WHEN o_orderstatus = 'F' THEN o_orderkey END FROM o
UNION ALL SELECT 'l-' || l_orderkey || '-' || l_linenumber, nation, 2, -l_orderkey, l_linenumber, l_orderkey, NULL FROM (SELECT DISTINCT l_orderkey, l_linenumber FROM lineitem) JOIN o ON o_orderkey = l_orderkey)"""


@query(f"""WITH {_CHAINS}, d AS (SELECT *, row_number() OVER (ORDER BY nation, part, a, b) AS pre, count(*) OVER () AS total,
CASE part WHEN 0 THEN 0 ELSE sum(CASE part WHEN 1 THEN 1 ELSE 0 END) OVER (PARTITION BY nation ORDER BY ord RANGE UNBOUNDED PRECEDING) + CASE part WHEN 2 THEN 1 ELSE 0 END END AS depth,
CASE part WHEN 2 THEN 1 ELSE count(*) OVER (PARTITION BY nation ORDER BY ord DESC RANGE UNBOUNDED PRECEDING) END AS size FROM m)
SELECT key, CAST(depth AS INTEGER) AS depth, pre, total + 1 - pre AS post, pre + size - 1 AS last FROM d""")
def deep_tree(spark, sf_dir):
    """Places in trees that are hundreds of links deep: an order's chain goes on before its lines."""
    return trees.numbers(_chains(spark, sf_dir)).select("key", "depth", "pre", "post", "last")


@query(f"""WITH {_CHAINS} SELECT key, CASE WHEN part > 0 THEN max(finished) OVER (PARTITION BY nation ORDER BY ord RANGE UNBOUNDED PRECEDING) END AS finished FROM m""")
def deep_ancestor(spark, sf_dir):
    """The nearest finished order above each order and line."""
    return trees.nearest(_chains(spark, sf_dir), "finished")


_DONE = """b{0} AS (SELECT key, parent_key FROM {1} WHERE state NOT IN (7, 8) UNION SELECT t.key, t.parent_key FROM b{0} JOIN {1} t ON t.key = b{0}.parent_key WHERE t.state = 7),
n{0} AS (SELECT key, parent_key, ord, CASE WHEN state = 7 AND key NOT IN (SELECT key FROM b{0}) THEN 8 ELSE state END AS state FROM {1})"""


@query(f"""WITH RECURSIVE {_TREE}, {_DONE.format(1, "n")},
c AS (SELECT n1.key, parent_key, ord, CASE WHEN starts_with(key, 'o') AND ord % 50 = 0 THEN 6 WHEN starts_with(key, 'o') AND (c_custkey % 4 > 0 OR c_nationkey % 5 = 0) THEN 8 ELSE state END AS state FROM n1 LEFT JOIN customer ON 'c' || c_custkey = parent_key),
{_DONE.format(2, "c")}, k AS (SELECT parent_key, count(*) FILTER (state <> 8) AS open FROM n2 GROUP BY parent_key)
SELECT n2.key, state, coalesce(open, 0) AS open FROM n2 LEFT JOIN k ON k.parent_key = n2.key""")
def completion_changes(spark, sf_dir):
    """Orders are finished, and some opened again: only what changes is followed upwards, and merged into the nodes."""
    nodes, edges = _tree(spark, sf_dir)
    before = cut(graph.with_open(graph.complete(nodes, edges), edges))
    customer = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey").join(customer, "o_custkey", "left")
    again, finished = F.col("o_orderkey") % 50 == 0, (F.col("o_custkey") % 4 > 0) | (F.col("c_nationkey") % 5 == 0)
    changes = orders.where(again | finished).select(F.concat(F.lit("o"), "o_orderkey").alias("key"), F.when(again, graph.LOADING).otherwise(graph.COMPLETED).alias("state"))
    changed = graph.changed_states(before, edges, changes)
    return merge.upsert(before.select("key", "state", "open"), changed, ["key"], ["state", "open"], None)


@query(f"""WITH {_TREE}, g AS (SELECT o_orderkey, o_custkey, o_custkey % 3 = 0 OR c_nationkey % 4 > 0 AS gone FROM orders LEFT JOIN customer ON c_custkey = o_custkey),
c AS (SELECT c_custkey, c_nationkey, coalesce(bool_and(gone), false) AS gone FROM customer LEFT JOIN g ON o_custkey = c_custkey GROUP BY ALL),
k AS (SELECT c_custkey, c_nationkey, gone OR c_nationkey % 8 = 1 AS gone FROM c),
t AS (SELECT n_nationkey, n_regionkey, coalesce(bool_and(gone), false) AS gone FROM nation LEFT JOIN k ON c_nationkey = n_nationkey GROUP BY ALL),
r AS (SELECT n_regionkey, bool_and(gone) AS gone FROM t GROUP BY ALL)
SELECT 'o' || o_orderkey AS key FROM g WHERE gone UNION ALL SELECT 'c' || c_custkey FROM k WHERE gone UNION ALL SELECT 'n' || n_nationkey FROM t WHERE gone UNION ALL SELECT 'r' || n_regionkey FROM r WHERE gone""")
def removable(spark, sf_dir):
    """Nodes that go, and those that are left without children by it."""
    nodes, _ = _tree(spark, sf_dir)
    customer = table(spark, sf_dir, "customer")
    orders = table(spark, sf_dir, "orders").join(customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey"), "o_custkey", "left")
    gone = orders.where((F.col("o_custkey") % 3 == 0) | (F.col("c_nationkey") % 4 > 0)).select(F.concat(F.lit("o"), "o_orderkey").alias("key"))
    gone = gone.unionByName(customer.where(F.col("c_nationkey") % 8 == 1).select(F.concat(F.lit("c"), "c_custkey").alias("key")))
    return graph.removable(nodes, gone)

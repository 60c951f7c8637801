"""Merges with several versions, sessions and changes of a key in one batch, against SQL that replays them in order."""

from __future__ import annotations

from pyspark.sql import functions as F

from pagemart.operators import merge
from pagemart.operators.lineage import cut
from pagemart.plans.registry import query, table

_CUT = "1997-01-01"
_DAYS = "SELECT o_custkey, CAST(o_orderdate AS DATE) AS start, max_by(o_orderpriority, o_orderkey) AS o_orderpriority FROM orders GROUP BY ALL"
#: Customers' versions in order, one recursion step for each day with orders.
_REPLAY = f"""WITH RECURSIVE d AS ({_DAYS}), n AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY start) AS i FROM d),
r AS (SELECT o_custkey, i, start, o_orderpriority, start AS since, CAST(NULL AS DATE) AS out_start, CAST(NULL AS DATE) AS out_end, CAST(NULL AS VARCHAR) AS out_value FROM n WHERE i = 1
  UNION ALL SELECT n.o_custkey, n.i, n.start, n.o_orderpriority, CASE WHEN n.o_orderpriority = r.o_orderpriority THEN r.since ELSE n.start END,
    CASE WHEN n.o_orderpriority <> r.o_orderpriority THEN r.since END, CASE WHEN n.o_orderpriority <> r.o_orderpriority THEN n.start - 1 END, CASE WHEN n.o_orderpriority <> r.o_orderpriority THEN r.o_orderpriority END
  FROM r JOIN n ON n.o_custkey = r.o_custkey AND n.i = r.i + 1),
v AS (SELECT o_custkey, out_start AS start, out_value AS o_orderpriority, CAST(out_end AS DATE) AS "end" FROM r WHERE out_start IS NOT NULL
  UNION ALL SELECT o_custkey, since, max_by(o_orderpriority, i), NULL FROM (SELECT *, max(i) OVER (PARTITION BY o_custkey) AS last FROM r) WHERE i = last GROUP BY o_custkey, since)"""


def _history(spark, sf_dir):
    return table(spark, sf_dir, "orders").select("o_custkey", F.to_date("o_orderdate").alias("start"), "o_orderpriority", "o_orderkey")


def _until_cut(spark, sf_dir):
    early = _history(spark, sf_dir).where(F.col("start") < _CUT)
    # What is stored, as a batch finds it.
    return cut(merge.versions(early, ["o_custkey"], ["o_orderpriority"], "start", "o_orderkey").select("o_custkey", "start", "o_orderpriority", "end"))


@query(f'{_REPLAY} SELECT o_custkey, start, o_orderpriority, "end" FROM v')
def scd2_multi(spark, sf_dir):
    """One batch with every later version of every key, each day's last order counting."""
    batch = _history(spark, sf_dir).where(F.col("start") >= _CUT)
    return merge.scd2(_until_cut(spark, sf_dir), batch, ["o_custkey"], ["o_orderpriority"], order=F.col("o_orderkey"))


@query(f'{_REPLAY} SELECT o_custkey, start, o_orderpriority, "end" FROM v')
def scd2_again(spark, sf_dir):
    """The same batch a second time changes nothing."""
    batch = _history(spark, sf_dir).where(F.col("start") >= _CUT)
    once = cut(scd2_multi(spark, sf_dir))
    return merge.scd2(once, batch, ["o_custkey"], ["o_orderpriority"], order=F.col("o_orderkey"))


@query(f"""{_REPLAY}, e AS (SELECT o_custkey, start - 400 AS start, '9' AS p FROM v WHERE "end" IS NULL UNION ALL SELECT o_custkey, start, o_orderpriority FROM v WHERE "end" IS NULL)
SELECT e.o_custkey, e.start, e.p AS o_orderpriority FROM e WHERE p = '9'""")
def scd2_late(spark, sf_dir):
    """Rows that begin before a key's open version and are not stored are set aside, and only those."""
    current = cut(scd2_multi(spark, sf_dir))
    opened = current.where(F.col("end").isNull())
    batch = opened.select("o_custkey", F.date_sub("start", 400).alias("start"), F.lit("9").alias("o_orderpriority")).unionByName(opened.select("o_custkey", "start", "o_orderpriority"))
    return merge.late(current, batch, ["o_custkey"], ["o_orderpriority"])


@query("""WITH v AS (SELECT s_suppkey, s_nationkey, CAST('2020-01-01' AS DATE) + CAST(s_suppkey % 3 AS INTEGER) AS start FROM supplier)
SELECT s_suppkey, 'u' || s_nationkey AS url, start, CASE WHEN s_nationkey % 2 = 0 THEN greatest(start, DATE '2020-01-01') END AS "end" FROM v
UNION ALL SELECT s_suppkey, 'new', DATE '2020-01-02', NULL FROM v WHERE s_nationkey % 2 = 0 AND start <> DATE '2020-01-03'
UNION ALL SELECT s_suppkey, 'new', DATE '2020-01-02', NULL FROM v WHERE s_nationkey % 2 = 0 AND start = DATE '2020-01-03'""")
def scd2_not_before_start(spark, sf_dir):
    """A version that is replaced from a date before or at its own start ends on its start."""
    s = table(spark, sf_dir, "supplier")
    start = F.date_add(F.lit("2020-01-01").cast("date"), (F.col("s_suppkey") % 3).cast("int"))
    current = s.select("s_suppkey", F.concat(F.lit("u"), "s_nationkey").alias("url"), start.alias("start"), F.lit(None).cast("date").alias("end"))
    own = F.when(F.col("s_nationkey") % 2 == 0, "new").otherwise(F.concat(F.lit("u"), "s_nationkey"))
    batch = s.select("s_suppkey", own.alias("url"), F.lit("2020-01-02").cast("date").alias("start"))
    return merge.scd2(current, batch, ["s_suppkey"], ["url"], at_least_start=True)


@query(f"""WITH a AS (SELECT o_custkey, max_by(o_totalprice, o_orderkey) AS price, count(*) AS n FROM orders WHERE o_orderdate < '{_CUT}' GROUP BY o_custkey),
b AS (SELECT o_custkey, o_totalprice AS price FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS i FROM orders WHERE o_orderdate >= '{_CUT}') WHERE i = 1)
SELECT coalesce(a.o_custkey, b.o_custkey) AS o_custkey, coalesce(b.price, a.price) AS price, a.n FROM a FULL JOIN b ON a.o_custkey = b.o_custkey""")
def upsert_ordered(spark, sf_dir):
    """Changes of one key one after the other: the last in order stays."""
    o = table(spark, sf_dir, "orders")
    current = o.where(F.col("o_orderdate") < _CUT).groupBy("o_custkey").agg(F.max_by("o_totalprice", "o_orderkey").alias("price"), F.count(F.lit(1)).alias("n"))
    changes = o.where(F.col("o_orderdate") >= _CUT).select("o_custkey", F.col("o_totalprice").alias("price"), "o_orderkey")
    return merge.upsert(current, changes, ["o_custkey"], ["price"], F.col("o_orderkey"))


_YEARS = "s AS (SELECT DISTINCT o_custkey, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS start FROM orders), l AS (SELECT DISTINCT o_custkey, o_orderpriority AS member, make_date(CAST(year(o_orderdate) AS INTEGER), 1, 1) AS start FROM orders)"


@query(f"""WITH RECURSIVE {_YEARS}, k AS (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY start) AS i FROM s), m AS (SELECT DISTINCT o_custkey, member FROM l),
r AS (SELECT o_custkey, member, CAST(0 AS BIGINT) AS i, CAST(NULL AS DATE) AS since, CAST(NULL AS DATE) AS out_start, CAST(NULL AS DATE) AS out_end FROM m
  UNION ALL SELECT r.o_custkey, r.member, k.i, CASE WHEN l.member IS NULL THEN NULL ELSE coalesce(r.since, k.start) END, CASE WHEN l.member IS NULL THEN r.since END, CASE WHEN l.member IS NULL AND r.since IS NOT NULL THEN k.start - 1 END
  FROM r JOIN k ON k.o_custkey = r.o_custkey AND k.i = r.i + 1 LEFT JOIN l ON l.o_custkey = r.o_custkey AND l.member = r.member AND l.start = k.start)
SELECT o_custkey, member, out_start AS start, CAST(out_end AS DATE) AS "end" FROM r WHERE out_start IS NOT NULL
UNION ALL SELECT o_custkey, member, since, NULL FROM (SELECT *, max(i) OVER (PARTITION BY o_custkey) AS last FROM r) WHERE i = last AND since IS NOT NULL""")
def membership_sessions(spark, sf_dir):
    """A customer's priorities of each year, the first years stored, all later ones in one batch."""
    o = table(spark, sf_dir, "orders")
    listed = o.select("o_custkey", F.col("o_orderpriority").alias("member"), F.trunc("o_orderdate", "year").alias("start")).distinct()
    sessions = listed.select("o_custkey", "start").distinct()
    none = listed.limit(0).withColumn("end", F.lit(None).cast("date"))
    for part in (F.col("start") < _CUT, F.col("start") >= _CUT):
        none = cut(merge.sync_membership(none, listed.where(part), sessions.where(part), "o_custkey", "member"))
    return none


@query("""WITH e AS (SELECT user_id, event_type AS kind, CASE event_type WHEN 'purchase' THEN 0 WHEN 'signup' THEN 1 WHEN 'click' THEN 2 WHEN 'view' THEN 3 ELSE 4 END AS rank, event_id % 2 = 0 AS early FROM events),
a AS (SELECT user_id, min_by(kind, rank) AS kind FROM e WHERE early GROUP BY user_id), b AS (SELECT user_id, min_by(kind, rank) AS kind FROM e WHERE NOT early GROUP BY user_id)
SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.kind, b.kind) AS kind FROM a FULL JOIN b ON a.user_id = b.user_id""")
def stored_kind_stays(spark, sf_dir):
    """A member's stored kind stays, whatever a later batch says."""
    ranks = {"purchase": 0, "signup": 1, "click": 2, "view": 3}
    members = table(spark, sf_dir, "events").select("user_id", F.col("event_type").alias("kind"), "event_id")
    early = members.where("event_id % 2 = 0").drop("event_id")
    stored = merge.first_kind_wins(early.limit(0), early, ["user_id"], "kind", ranks)
    return merge.first_kind_wins(stored, members.where("event_id % 2 = 1").drop("event_id"), ["user_id"], "kind", ranks)


@query(f"""WITH p AS (SELECT c_custkey, c_name, CASE WHEN c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderdate >= '{_CUT}') THEN (SELECT max(o_orderkey) FROM orders WHERE o_custkey = c_custkey AND o_orderdate >= '{_CUT}') ELSE 0 END AS phone FROM customer)
SELECT c_custkey, c_name, phone FROM p""")
def scd1(spark, sf_dir):
    """A dimension whose attributes are overwritten; new members come in, others stay."""
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name")
    new = table(spark, sf_dir, "orders").where(F.col("o_orderdate") >= _CUT).join(c.withColumnRenamed("c_custkey", "o_custkey"), "o_custkey")
    changes = new.select(F.col("o_custkey").alias("c_custkey"), "c_name", F.col("o_orderkey").alias("phone"))
    current = c.withColumn("phone", F.lit(0).cast("long")).join(changes.where("c_custkey % 5 = 0").select("c_custkey"), "c_custkey", "left_anti")
    return merge.upsert(merge.upsert(current, changes, ["c_custkey"], ["c_name", "phone"], F.col("phone")), changes, ["c_custkey"], ["c_name", "phone"], F.col("phone"))


@query("""WITH m AS (SELECT o_custkey, o_orderpriority AS member, CAST(min(o_orderdate) AS DATE) AS start FROM orders GROUP BY ALL)
SELECT o_custkey, member, start, CASE WHEN o_custkey % 3 = 0 THEN DATE '1998-12-31' + CAST(o_custkey % 7 AS INTEGER) END AS "end" FROM m""")
def cascade(spark, sf_dir):
    """Open memberships end with the rows that were closed."""
    o = table(spark, sf_dir, "orders").select("o_custkey", F.col("o_orderpriority").alias("member"), F.to_date("o_orderdate").alias("start"))
    members = o.groupBy("o_custkey", "member").agg(F.min("start").alias("start")).withColumn("end", F.lit(None).cast("date"))
    closed = table(spark, sf_dir, "orders").where("o_custkey % 3 = 0").select("o_custkey", F.date_add(F.lit("1998-12-31").cast("date"), (F.col("o_custkey") % 7).cast("int")).alias("end"))
    return merge.cascade_close(members, closed, "o_custkey")

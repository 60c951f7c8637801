"""Joins that turn links into keys, and the groupings around them.

Three rules for links that are not known yet: lenient (a null in their place),
drop (left out) and strict (the whole record waits). They differ on purpose.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemart.functions.urls import normalize_url
from pagemart.operators.lineage import cut

#: Characters of the pieces by which containing texts are looked up, and how many neighbours one of them stands for.
GRAM, WINDOW = 10, 4
#: Nodes with one piece that a task compares.
HOT = 100_000


def first_match(nodes: DataFrame, condition: Column, order: str = "ord") -> DataFrame:
    """The first node in insertion order that a condition holds for."""
    return nodes.where(condition).orderBy(order).limit(1)


def all_matches(nodes: DataFrame, condition: Column) -> DataFrame:
    return nodes.where(condition)


def same_value(have: Column, wanted: Column, kind: str = "value") -> Column:
    """Whether a stored value is the wanted one, by kind: an equal value; a url whose path and query contain those of the
    wanted one; a list that has the wanted value. Null is never.
    """
    how = {"value": lambda: have == wanted, "url": lambda: F.contains(normalize_url(have), normalize_url(wanted)) & have.isNotNull() & wanted.isNotNull(), "list": lambda: F.array_contains(have, wanted)}
    if kind not in how:
        raise ValueError(f"a kind of comparison is one of {', '.join(how)}")
    return F.coalesce(how[kind](), F.lit(False))


def _exploded(records: DataFrame, key: str, urls: str) -> DataFrame:
    return records.select(key, F.posexplode_outer(urls).alias("_pos", "_url"))


def _known(loaded: DataFrame, url: str, value: str) -> DataFrame:
    return loaded.groupBy(F.col(url).alias("_known")).agg(F.min(value).alias("_id"))


def resolve_lenient(records: DataFrame, loaded: DataFrame, key: str, urls: str, url: str, value: str, out: str = "ids") -> DataFrame:
    """(key, out): an id for each url in order, null where it is unknown; no urls give an empty array."""
    joined = _exploded(records, key, urls).join(_known(loaded, url, value), F.col("_url") == F.col("_known"), "left")
    row = F.when(F.col("_pos").isNotNull(), F.struct("_pos", "_id"))
    return joined.groupBy(key).agg(F.array_sort(F.collect_list(row)).alias("_r")).select(key, F.col("_r._id").alias(out))


def resolve_by_kind(records: DataFrame, loaded: DataFrame, key: str, urls: str, url: str, value: str, kind: Column, out: str = "ids") -> DataFrame:
    """(key, out, deferred): map kind -> ids; kind is an expression on _url, and a url of no kind defers the record."""
    joined = _exploded(records, key, urls).withColumn("_kind", kind).join(_known(loaded, url, value), F.col("_url") == F.col("_known"), "left")
    lists = joined.groupBy(key, "_kind").agg(F.array_sort(F.collect_list(F.struct("_pos", "_id"))).alias("_r"), F.bool_or(F.col("_url").isNotNull() & F.col("_kind").isNull()).alias("_odd"))
    pairs = F.collect_list(F.when(F.col("_kind").isNotNull(), F.struct(F.col("_kind").alias("key"), F.col("_r._id").alias("value"))))
    return lists.groupBy(key).agg(F.map_from_entries(pairs).alias(out), F.bool_or("_odd").alias("deferred"))


def resolve_drop(records: DataFrame, loaded: DataFrame, key: str, urls: str, url: str, value: str, out: str = "ids") -> DataFrame:
    """(key, out): the known ids in order; records without any have an empty array."""
    known = resolve_lenient(records, loaded, key, urls, url, value, out)
    return known.withColumn(out, F.filter(out, lambda x: x.isNotNull()))


def resolve_strict(records: DataFrame, loaded: DataFrame, key: str, urls: str, url: str, value: str, out: str = "ids") -> tuple[DataFrame, DataFrame]:
    """((key, out) of records all of whose urls are known, the records that wait)."""
    known = resolve_lenient(records, loaded, key, urls, url, value, out)
    complete = known.where(~F.exists(out, lambda x: x.isNull()))
    return complete, records.join(complete, key, "left_anti")


def _once(value: Column, use) -> Column:
    """use(value), with the value computed once however often it is used, in lambdas too."""
    return F.element_at(F.transform(F.array(value), use), 1)


def _pieces(text: Column, size: int, piece=lambda x: x) -> Column:
    """piece(run) of each run of so many characters of a text, in order; null where it is shorter. Linear in the text."""
    places = F.sequence(F.lit(1), F.length(text) - size + 1)
    runs = lambda chars: F.transform(places, lambda i: piece(F.array_join(F.slice(chars, i, size), "")))
    return F.when(F.length(text) >= size, _once(F.split(text, ""), runs))


def _minimizers(text: Column, of_group: Column) -> Column:
    """The least hash of the pieces in each window of WINDOW of them; null for texts of fewer pieces.

    A text that contains another has all windows of the other, so all its minimizers too.
    """
    least = lambda h: F.array_distinct(F.transform(F.sequence(F.lit(1), F.size(h) - WINDOW + 1), lambda i: F.array_min(F.slice(h, i, WINDOW))))
    return F.when(F.length(text) >= GRAM + WINDOW - 1, _once(_pieces(text, GRAM, lambda x: F.xxhash64(of_group, x)), least))


def first_containing(requests: DataFrame, nodes: DataFrame, request_id: str, wanted: str, url: str, order: str, group: str | None = None, hot: int = HOT) -> DataFrame:
    """For each request the first node, in order, whose path and query contain the wanted ones.

    All nodes are searched, whatever their host, and a wanted url may be relative;
    with a group (a column of both) only the nodes of the request's own group.
    Requests without a match are left out. Null and empty wanted urls are
    contained in every node.

    An equal node comes second to an earlier one that contains more, so equality
    is no case of its own. Wanted texts of fewer than GRAM + WINDOW - 1 characters are
    looked up among the nodes' pieces of that length; longer ones by the rarest of
    their minimizers, and what is found so is compared. A minimizer that more than
    `hot` nodes and a thousandth of all have is split over tasks by node, and the first
    of each part is kept; there are at most a thousand times a node's minimizers of them.
    """
    of = F.lit("") if group is None else F.col(group)
    a = requests.select(request_id, of.alias("_group"), normalize_url(F.col(wanted)).alias("_wanted")).where(F.col("_group").isNotNull())
    b = nodes.select(of.alias("_g2"), normalize_url(F.col(url)).alias("_have"), F.struct(F.col(order).alias("_ord"), F.col(url).alias("found")).alias("_node")).where(F.col("_g2").isNotNull())
    # Equal texts are searched once.
    asked = cut(a.select("_group", "_wanted").distinct())
    b = cut(b.groupBy("_g2", "_have").agg(F.min_by("_node", "_node._ord").alias("_node")))
    short = GRAM + WINDOW - 1

    posted = b.select("_g2", "_have", "_node", F.explode(_minimizers(F.col("_have"), F.col("_g2"))).alias("_gram"))
    common = posted.groupBy("_gram").agg(F.count(F.lit(1)).alias("_n"))
    share = max(hot, b.count() // 1000)
    parts = common.where(F.col("_n") > share).select("_gram", F.ceil(F.col("_n") / share).cast("int").alias("_parts"))
    posted = posted.join(F.broadcast(parts), "_gram", "left").withColumn("_part", F.coalesce(F.pmod(F.xxhash64("_have"), "_parts"), F.lit(0)).cast("int")).drop("_parts")
    grams = asked.where(F.length("_wanted") >= short).select("_group", "_wanted", F.explode(_minimizers(F.col("_wanted"), F.col("_group"))).alias("_gram"))
    rarest = grams.join(common, "_gram").groupBy("_group", "_wanted").agg(F.min(F.struct("_n", "_gram")).alias("_r")).select("_group", "_wanted", "_r.*")
    every = F.when(F.col("_n") > share, F.sequence(F.lit(0), F.ceil(F.col("_n") / share).cast("int") - 1)).otherwise(F.array(F.lit(0)))
    rarest = rarest.select("_group", "_wanted", "_gram", F.explode(every).alias("_part"))
    found = rarest.join(posted, ["_gram", "_part"]).where((F.col("_group") == F.col("_g2")) & F.contains("_have", "_wanted")).select("_group", "_wanted", "_node")

    lengths = asked.select(F.length("_wanted").alias("m")).where(F.col("m") < short).distinct().collect()  # as many rows as there are short lengths, at most
    none = F.array().cast("array<string>")
    if lengths:
        pieces = F.concat(*[F.coalesce(_pieces(F.col("_have"), r["m"]), none) if r["m"] else F.array(F.lit("")) for r in lengths])
        least = b.select("_g2", "_node", F.explode(F.array_distinct(pieces)).alias("_piece")).groupBy("_g2", "_piece").agg(F.min_by("_node", "_node._ord").alias("_node"))
        found = found.unionByName(asked.join(least, (F.col("_group") == F.col("_g2")) & (F.col("_wanted") == F.col("_piece"))).select("_group", "_wanted", "_node"))
    first = found.groupBy("_group", "_wanted").agg(F.min_by("_node", "_node._ord").alias("_node"))
    return a.join(first, ["_group", "_wanted"]).groupBy(request_id).agg(F.min_by("_node.found", "_node._ord").alias("found"), F.min("_node._ord").alias("found_ord"))


def parent_value(children: DataFrame, edges: DataFrame, loaded: DataFrame, value: str) -> DataFrame:
    """(key, value) of each child's first parent by ord; children(key), edges(src_key, dst_key), loaded(key, ord, value)."""
    parents = edges.join(loaded.withColumnRenamed("key", "src_key"), "src_key")
    return children.join(parents.groupBy(F.col("dst_key").alias("key")).agg(F.min_by(value, "ord").alias(value)), "key", "left")


def absent(changes: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Changes that are not stored; a null in a key never matches."""
    return changes.join(current.select(*keys), keys, "left_anti")


def listed(rows: DataFrame, keys: DataFrame, on: str) -> DataFrame:
    return rows.join(keys.select(on), on, "left_semi")


def not_in_array(rows: DataFrame, col: str, arrays: DataFrame, array_col: str) -> DataFrame:
    """Rows whose value is in none of the arrays; null arrays count as empty."""
    return rows.join(arrays.select(F.explode(array_col).alias(col)).distinct(), col, "left_anti")


def must_exist(rows: DataFrame, dimension: DataFrame, on: str, value: str) -> tuple[DataFrame, DataFrame]:
    """(rows with the dimension's value, rows whose key it does not have)."""
    joined = rows.join(dimension.select(on, value), on, "left")
    return joined.where(F.col(value).isNotNull()), joined.where(F.col(value).isNull()).drop(value)


def update_from(current: DataFrame, new: DataFrame, on: str, col: str) -> DataFrame:
    """current with col taken from new where new has the key."""
    return current.join(new.select(on, F.col(col).alias("_new")), on, "left").withColumn(col, F.coalesce("_new", col)).drop("_new")


def orphans(rows: DataFrame, parents: DataFrame, on: str, parent_key: str) -> DataFrame:
    """Rows whose key no parent has."""
    return rows.join(parents.select(F.col(parent_key).alias(on)), on, "left_anti")


def by_host(urls: DataFrame, host_col: str, order: str, url: str) -> DataFrame:
    """(host, urls) with the urls in order."""
    return urls.groupBy(host_col).agg(F.array_sort(F.collect_list(F.struct(order, url))).alias("_u")).select(host_col, F.col(f"_u.{url}").alias("urls"))


def map_rows(records: DataFrame, key: str, map_col: str) -> DataFrame:
    """(key, kind, value) of a map of arrays; blank values left out."""
    return records.select(key, F.explode(map_col).alias("kind", "_v")).select(key, "kind", F.explode("_v").alias("value")).where(F.trim(F.col("value").cast("string")) != "")


def bucket_rows(records: DataFrame, key: str, buckets: dict[str, str]) -> DataFrame:
    """(key, cast, member) of array columns; buckets maps a column to what it stands for."""
    pairs = F.array(*[F.struct(F.lit(name).alias("cast"), F.col(c).alias("members")) for c, name in buckets.items()])
    return records.select(key, F.explode(pairs).alias("b")).select(key, "b.cast", F.explode("b.members").alias("member"))


def first_of_key(nodes: DataFrame, key: str, order: str) -> DataFrame:
    """One node for each key, the first in order."""
    rest = [c for c in nodes.columns if c != key]
    return nodes.groupBy(key).agg(F.min_by(F.struct(*rest), F.struct(order, *[c for c in rest if c != order])).alias("_n")).select(key, *[f"_n.{c}" for c in rest])


def latest_open(versions: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Each key's open row that started last."""
    w = Window.partitionBy(*keys).orderBy(F.col(start).desc())
    return versions.where(F.col(end).isNull()).withColumn("_n", F.row_number().over(w)).where("_n = 1").drop("_n")

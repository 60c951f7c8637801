"""Merges: (current rows, changes) -> new current rows, each a pure function.

Every merge gives the same rows when its changes are applied again (history rows
with a null in their key excepted: those are always new).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemart.operators.lineage import plain_unions, spread


def surrogate_key(*natural: str, bits: int = 64) -> Column:
    """A key that any task computes alike, of so many bits; see key_collisions."""
    key = F.xxhash64(*natural)
    return key if bits == 64 else F.shiftrightunsigned(key, 64 - bits)


def key_collisions(df: DataFrame, natural: list[str], bits: int = 64) -> DataFrame:
    """Surrogate keys that stand for more than one natural key."""
    return df.select(*natural).distinct().groupBy(surrogate_key(*natural, bits=bits).alias("key")).count().where("count > 1")


def one_per_key(changes: DataFrame, keys: list[str], order: Column | None = None, first: bool = False) -> DataFrame:
    """One row for each key: the last in order (or the first); of rows at one place, and without an order, the one
    whose other columns come last as JSON.
    """
    rest = [c for c in changes.columns if c not in keys]
    if not rest:
        return changes.distinct()
    row = F.struct(*[F.col(c) for c in rest])
    rank = F.to_json(row) if order is None else F.struct(order, F.to_json(row))
    picked = (F.min_by if first else F.max_by)(row, rank)
    return changes.groupBy(*keys).agg(picked.alias("_r")).select(*keys, *[F.col(f"_r.{c}").alias(c) for c in rest]).select(*changes.columns)


def any_repeated(changes: DataFrame, keys: list[str]) -> bool:
    """Whether some key has several rows; counts by hash, where rows dealt by key lie."""
    return (changes.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0) > 1


def insert_absent(current: DataFrame, changes: DataFrame, keys: list[str], order: Column | None = None) -> DataFrame:
    """current and the changes whose key it lacks, the first in order of each key."""
    new = one_per_key(changes, keys, order, first=True).join(current.select(*keys), keys, "left_anti")
    return current.unionByName(new, allowMissingColumns=True)


def upsert(current: DataFrame, changes: DataFrame, keys: list[str], columns: list[str], order: Column | None, once: bool = False) -> DataFrame:
    """Rows of both; `columns` come from changes where it has the key, nulls included.

    Of several changes of a key the last in order counts, as if they were applied
    one after the other. None says that keys are not repeated; `once`, that this is
    sure, as after one_per_key, so that changes are not grouped again.
    """
    new = (changes if once else one_per_key(changes, keys, order)).select(*keys, F.lit(True).alias("_new"), *[F.col(c).alias(f"_n_{c}") for c in columns])
    joined = current.withColumn("_old", F.lit(True)).join(new, keys, "full")
    out = [F.when(F.col("_new"), F.col(f"_n_{c}")).otherwise(F.col(c)).alias(c) if c in columns else F.col(c) for c in current.columns if c not in keys]
    return joined.select(*keys, *out).select(*current.columns)


def _lacking(rows: DataFrame, current: DataFrame, keys: list[str]) -> DataFrame:
    """Rows whose key current lacks; both are dealt by number, so that few compressed bytes do not make few tasks."""
    return spread(rows, *keys).join(spread(current.select(*keys), *keys), keys, "left_anti")


def add_rows(current: DataFrame, rows: DataFrame, keys: list[str]) -> DataFrame:
    """current and the rows it lacks, once each; a null in a key makes a row new each time."""
    whole = rows.dropna(subset=keys).dropDuplicates(keys)
    return current.unionByName(_lacking(whole, current, keys)).unionByName(unkeyed(rows, keys))


def first_kind_wins(current: DataFrame, members: DataFrame, keys: list[str], kind: str, ranks: dict[str, int]) -> DataFrame:
    """Bridge rows: a member has its kind of lowest rank; stored rows keep theirs."""
    rank = F.coalesce(*[F.when(F.col(kind) == k, F.lit(n)) for k, n in ranks.items()], F.lit(len(ranks)))
    best = members.groupBy(*keys).agg(F.min_by(kind, rank).alias(kind))
    return current.unionByName(best.join(current.select(*keys), keys, "left_anti").select(*current.columns))


def first_rank_wins(current: DataFrame, members: DataFrame, keys: list[str], kind: str, kinds: list[str]) -> DataFrame:
    """first_kind_wins of members whose kind is its number in kinds: numbers are tallied by hash, names would be sorted."""
    best = members.groupBy(*keys).agg(F.min(kind).alias(kind)).withColumn(kind, F.element_at(F.array(*map(F.lit, kinds)), F.col(kind) + 1))
    return current.unionByName(_lacking(best, current, keys).select(*current.columns))


def sync_membership(current: DataFrame, listed: DataFrame, sessions: DataFrame, owner: str, member: str) -> DataFrame:
    """Opens and closes interval rows (owner, member, start, end).

    sessions(owner, start) are an owner's sessions, listed(owner, member, start)
    the members that each lists; they are applied in the order of their starts.
    Open rows that are older than a session and not listed in it end the day
    before; listed pairs that are not open begin. Null members are left out. A
    listing without start stands for each owner's last session.
    """
    if "start" not in listed.columns:
        return _sync_last(current, listed, sessions, owner, member)
    pair = [owner, member]
    listed = listed.where(F.col(member).isNotNull()).select(*pair, F.col("start").alias("_at")).distinct()
    opened = current.where(F.col("end").isNull()).groupBy(*pair).agg(F.max("start").alias("_open"))
    # Each pair that is open or listed, at each of its owner's sessions: some rows for each membership.
    pairs = listed.select(*pair).unionByName(opened.select(*pair)).distinct()
    places = pairs.join(sessions.select(owner, F.col("start").alias("_at")).distinct(), owner).join(opened, pair, "left")
    places = places.where(F.col("_open").isNull() | (F.col("_at") > F.col("_open"))).join(listed.withColumn("_listed", F.lit(True)), [*pair, "_at"], "left")
    w = Window.partitionBy(*pair).orderBy("_at")
    held = F.coalesce("_listed", F.lit(False))
    turns = places.withColumn("_held", held).withColumn("_was", F.coalesce(F.lag("_held").over(w), F.col("_open").isNotNull())).where(F.col("_held") != F.col("_was"))
    turns = turns.withColumn("_next", F.lead("_at").over(w))
    ends = turns.where(~F.col("_held")).groupBy(*pair).agg(F.min("_at").alias("_gone"))
    gone = F.col("end").isNull() & (F.col("start") < F.col("_gone"))
    # A pair that opens first and is closed later has no open row here, so its end stays out of stored rows.
    kept = current.join(ends, pair, "left").withColumn("end", F.when(gone, F.date_sub("_gone", 1)).otherwise(F.col("end"))).select(*current.columns)
    begun = turns.where("_held").select(*pair, F.col("_at").alias("start"), F.date_sub("_next", 1).alias("end"))
    # What a row covers, as it ends now, is there already.
    there = kept.select(F.col(owner).alias("_o"), F.col(member).alias("_m"), F.col("start").alias("_s"), F.coalesce("end", F.lit("9999-12-31").cast("date")).alias("_e"))
    begun = begun.join(there, (F.col(owner) == F.col("_o")) & (F.col(member) == F.col("_m")) & F.col("start").between(F.col("_s"), F.col("_e")), "left_anti")
    return kept.unionByName(begun.select(*current.columns))


def _sync_last(current: DataFrame, listed: DataFrame, sessions: DataFrame, owner: str, member: str) -> DataFrame:
    """sync_membership where each owner has one session that counts: stored and listed rows of a pair meet once, in a window.

    Rows are dealt by pair after they have met their owner's session, so an owner may have most of them.
    """
    pair = [owner, member]
    last = sessions.groupBy(F.col(owner).alias("_o")).agg(F.max("start").alias("_at"))
    new = listed.where(F.col(member).isNotNull()).select(*pair).distinct().select(*pair, F.lit(None).cast("date").alias("start"), F.lit(None).cast("date").alias("end"), F.lit(True).alias("_new"))
    both = current.select(*pair, "start", "end", F.lit(False).alias("_new")).unionByName(new)
    both = both.join(last, F.col(owner) == F.col("_o"), "left").repartition(*pair)
    w = Window.partitionBy(*pair)
    is_open = ~F.col("_new") & F.col("end").isNull()
    covered = ~F.col("_new") & F.col("_at").between(F.col("start"), F.coalesce("end", F.lit("9999-12-31").cast("date")))
    met = both.withColumns({"_listed": F.bool_or("_new").over(w), "_open": F.max(F.when(is_open, F.col("start"))).over(w), "_covered": F.bool_or(covered).over(w)})
    gone = is_open & ~F.col("_listed") & F.col(member).isNotNull() & (F.col("_at") > F.col("_open"))
    begun = F.col("_at").isNotNull() & F.col("_open").isNull() & ~F.coalesce("_covered", F.lit(False))
    kept = met.where(~F.col("_new") | begun)
    return kept.withColumns({"start": F.when(F.col("_new"), F.col("_at")).otherwise(F.col("start")), "end": F.when(gone, F.date_sub("_at", 1)).otherwise(F.col("end"))}).select(*current.columns)


def versions(history: DataFrame, keys: list[str], tracked: list[str], start: str, tie: str | None = None) -> DataFrame:
    """SCD2 of a whole history: a row for each change of the tracked columns, with start and end.

    Of rows with one key and start the last by tie counts. The end is the day
    before the next version, null for the last. A return to earlier values is a
    version of its own.
    """
    if tie:
        history = one_per_key(history, [*keys, start], F.col(tie))
    w = Window.partitionBy(*keys).orderBy(start)
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(w))
    first = F.row_number().over(w) == 1
    changes = history.withColumn("_change", first | ~same).where("_change").drop("_change")
    return changes.withColumn("end", F.date_sub(F.lead(start).over(w), 1))


def _against(current: DataFrame, batch: DataFrame, keys: list[str], tracked: list[str], order: Column | None) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(each key's open row that started last, all other rows, the batch's rows that no stored version covers,
    with _open, the start of the key's open row).
    """
    batch = one_per_key(batch, [*keys, "start"], order)
    ranked = current.withColumn("_n", F.row_number().over(Window.partitionBy(*keys, F.col("end").isNull()).orderBy(F.col("start").desc(), *tracked)))
    latest = F.col("end").isNull() & (F.col("_n") == 1)
    opened, others = ranked.where(latest).drop("_n"), ranked.where(~latest).drop("_n")
    stored = current.select(*[F.col(c).alias(f"_s_{c}") for c in dict.fromkeys([*keys, *tracked, "start", "end"])])
    covers = F.col("start").between(F.col("_s_start"), F.coalesce("_s_end", "_s_start"))
    for c in keys:
        covers = covers & (F.col(c) == F.col(f"_s_{c}"))
    for c in tracked:
        covers = covers & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
    new = batch.join(stored, covers, "left_anti").join(opened.select(*keys, F.col("start").alias("_open")), keys, "left")
    return opened, others, new


def scd2(current: DataFrame, batch: DataFrame, keys: list[str], tracked: list[str], at_least_start: bool = False, order: Column | None = None) -> DataFrame:
    """SCD2 of one batch: current and batch have keys, tracked and start, current also end.

    A batch may hold any number of versions of a key; they are applied in the
    order of their starts, of one start the last by `order`. Against the version
    before it (at first the open row that started last): equal tracked columns,
    nothing; otherwise that one ends the day before the new start and the new row
    is open. A version that is stored already, or whose start falls into a closed
    version of the same values, changes nothing. A start that is not after the
    open row's is late (see late) and changes nothing either; with at_least_start
    it counts, and no version ends before its own start. Rows of keys that the
    batch does not have are passed through. A row with a null in its key has no line to
    be a version of: it changes nothing, see unkeyed.
    """
    plain_unions(current.sparkSession)
    batch = batch.dropna(subset=keys)
    touched = batch.select(*keys).distinct()
    rest, mine = current.join(touched, keys, "left_anti"), current.join(touched, keys, "left_semi")
    opened, others, new = _against(mine, batch, keys, tracked, order)
    if not at_least_start:
        new = new.where(F.col("_open").isNull() | (F.col("start") > F.col("_open")))
    w = Window.partitionBy(*keys).orderBy("_later", "start")
    line = opened.withColumn("_later", F.lit(0)).unionByName(new.drop("_open").withColumn("_later", F.lit(1)), allowMissingColumns=True)
    same = F.lit(True)
    for c in tracked:
        same = same & F.col(c).eqNullSafe(F.lag(c).over(w))
    line = line.withColumn("_change", (F.row_number().over(w) == 1) | ~same).where("_change")
    end = F.date_sub(F.lead("start").over(w), 1)
    line = line.withColumn("end", F.greatest(end, F.when(end.isNotNull(), F.col("start"))) if at_least_start else end)
    return rest.select(*current.columns).unionByName(others.select(*current.columns)).unionByName(line.select(*current.columns))


def late(current: DataFrame, batch: DataFrame, keys: list[str], tracked: list[str], order: Column | None = None) -> DataFrame:
    """The batch's rows that scd2 leaves out because they start no later than the open row, and are not what is stored."""
    _, _, new = _against(current, batch.dropna(subset=keys), keys, tracked, order)
    return new.where(F.col("start") <= F.col("_open")).drop("_open")


def unkeyed(batch: DataFrame, keys: list[str]) -> DataFrame:
    """The batch's rows with a null in their key, for a quarantine."""
    return batch.where(F.array_contains(F.array(*[F.col(k).isNull() for k in keys]), True))


def close_missing(current: DataFrame, active: DataFrame, session_start: Column, url: str) -> tuple[DataFrame, DataFrame]:
    """(current with ends, the rows that were closed): open rows from before the session whose url is not active.

    Both sides' urls are to be in canonical form.
    """
    names = active.select(F.col(url)).where(F.col(url).isNotNull()).distinct().withColumn("_active", F.lit(True))
    marked = current.join(names, url, "left")
    gone = F.col("end").isNull() & F.col("_active").isNull() & (F.col("start") < session_start)
    closed = marked.where(gone).select(*current.columns).withColumn("end", F.date_sub(session_start, 1))
    return marked.withColumn("end", F.when(gone, F.date_sub(session_start, 1)).otherwise(F.col("end"))).select(*current.columns), closed


def cascade_close(memberships: DataFrame, closed: DataFrame, key: str) -> DataFrame:
    """Open memberships of closed rows end with them."""
    ends = closed.groupBy(key).agg(F.max("end").alias("_end"))
    return memberships.join(ends, key, "left").withColumn("end", F.when(F.col("end").isNull(), F.col("_end")).otherwise(F.col("end"))).select(*memberships.columns)


def replace_children(current: DataFrame, children: DataFrame, touched: DataFrame, parent: str, once: bool = False) -> DataFrame:
    """current without the children of touched parents, and the new children.

    `once` says that touched is dealt by parent (spread) and has each once: it stays where it is.
    """
    touched = touched.select(parent) if once else spread(touched.select(parent), parent).distinct()
    return spread(current, parent).join(touched, parent, "left_anti").select(*current.columns).unionByName(children.select(*current.columns))

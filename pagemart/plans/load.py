"""Records -> relational tables, a batch of one session at a time, in the order of foreign keys.

`tables` maps names to DataFrames; each step returns the tables it changes. Keys
are hashes of natural keys, so no step has to ask the store for them.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pagemart.functions.text import to_instant
from pagemart.operators import merge, resolve, validate
from pagemart.operators.lineage import spread
from pagemart.sources.store import BUCKETS, Store

#: Fixed: columns of the tables.
SCHEMAS = {
    "sessions": "session_code string, session_name string, start_date date",
    "bills": "bill_id long, bill_no string, title string, url string, session_code string, intro_date timestamp_ntz, act_date date",
    "bill_documents": "bill_id long, document_type string, url string",
    "legislators": "legislator_id long, first_name string, last_name string, phone string, email string, address string",
    "legislator_history": "legislator_id long, district string, seniority int, chamber string, url string, party string, start date, end date",
    "committees": "committee_id long",
    "committee_info": "committee_id long, committee_name string, url string, start date, end date",
    "committee_membership": "legislator_id long, committee_id long, start date, end date",
    "sponsors": "bill_id long, kind string, member_kind string, member_id long",
    "vote_events": "vote_event_id long, bill_id long, vote_timestamp timestamp, chamber string, motion_text string",
    "legislator_votes": "vote_event_id long, legislator_id long, vote_cast string",
    "bill_status_history": "bill_id long, chamber string, status_date timestamp_ntz, history_action string, vote_action_present boolean",
}
CASTS = {"yea_voters": "yea", "nay_voters": "nay", "non_voting_voters": "non_voting", "present_voters": "present", "excused_voters": "excused"}
SPONSORS = {"lead": 0, "other_primary": 1, "cosponsor": 2}
#: By which column a store cuts each table into buckets.
KEYS = {name: None if name == "sessions" else schema.split(" ")[0] for name, schema in SCHEMAS.items()}
KEYS["committee_membership"] = "legislator_id"


def empty_tables(spark) -> dict[str, DataFrame]:
    return {name: spark.createDataFrame([], schema) for name, schema in SCHEMAS.items()}


def load_sessions(tables: dict[str, DataFrame], rows: DataFrame) -> dict[str, DataFrame]:
    return {"sessions": merge.insert_absent(tables["sessions"], rows, ["session_code"])}


def _with_start(tables: dict[str, DataFrame], rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows with the start of their session, rows of unknown sessions)."""
    return resolve.must_exist(rows, tables["sessions"].withColumnRenamed("start_date", "start"), "session_code", "start")


def load_committees(tables: dict[str, DataFrame], rows: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """rows(committee_id, name, url, session_code), of any number of sessions; (changed tables, quarantine). A new name begins a line of its own."""
    known, odd = _with_start(tables, rows)
    batch = known.select("committee_id", F.col("name").alias("committee_name"), "url", "start")
    info = merge.scd2(tables["committee_info"], batch, ["committee_id", "committee_name"], ["url"], at_least_start=True)
    return {"committees": merge.insert_absent(tables["committees"], known.select("committee_id"), ["committee_id"]), "committee_info": info}, odd


def load_legislators(tables: dict[str, DataFrame], rows: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """rows(first_name, ..., session_code, committee_ids), of any number of sessions; (changed tables, quarantine).

    Sessions are applied in the order of their starts; rows older than a member's open line are set aside.
    """
    known, odd = _with_start(tables, rows)
    good, bad = validate.split(known, {"first_name": F.col("first_name").isNotNull(), "last_name": F.col("last_name").isNotNull(), "url": F.col("url").isNotNull()})
    good = good.withColumn("legislator_id", merge.surrogate_key("first_name", "last_name"))
    people = merge.upsert(tables["legislators"], good.select(*tables["legislators"].columns, "start"), ["legislator_id"], ["first_name", "last_name", "phone", "email", "address"], F.col("start"))
    batch = good.select("legislator_id", "district", "seniority", "chamber", "url", "party", "start")
    tracked = ["party", "chamber", "district", "url"]
    history = merge.scd2(tables["legislator_history"], batch, ["legislator_id"], tracked)
    late = merge.late(tables["legislator_history"], batch, ["legislator_id"], tracked)
    listed = good.select("legislator_id", "start", F.explode("committee_ids").alias("committee_id"))
    unknown = resolve.orphans(listed, tables["committees"], "committee_id", "committee_id").where("committee_id IS NOT NULL")
    known_lists = listed.join(tables["committees"].select("committee_id"), "committee_id", "left_semi")
    members = merge.sync_membership(tables["committee_membership"], known_lists, good.select("legislator_id", "start"), "legislator_id", "committee_id")
    quarantine = odd.select("url", F.array(F.lit("session")).alias("errors")).unionByName(bad.select("url", "errors")).unionByName(unknown.select(F.col("committee_id").cast("string").alias("url"), F.array(F.lit("committee")).alias("errors"))).unionByName(late.select("url", F.array(F.lit("late")).alias("errors")))
    return {"legislators": people, "legislator_history": history, "committee_membership": members}, quarantine


def close_legislators(tables: dict[str, DataFrame], active_urls: DataFrame, session_start: Column) -> dict[str, DataFrame]:
    """Ends the open lines of members that a session's list (url) lacks, and their memberships."""
    history, closed = merge.close_missing(tables["legislator_history"], active_urls, session_start, "url")
    return {"legislator_history": history, "committee_membership": merge.cascade_close(tables["committee_membership"], closed, "legislator_id")}


def _ids(rows: DataFrame, column: str) -> Column:
    """A map of arrays with its values as numbers, blank ones null."""
    text = rows.schema[column].dataType.valueType.elementType == T.StringType()
    number = lambda x: F.when(F.trim(x) != "", x.cast("long"))
    values = F.transform_values(column, lambda _, v: F.transform(v, number)) if text else F.col(column)
    return values.cast("map<string,array<long>>")


def load_bills(tables: dict[str, DataFrame], rows: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    """rows(bill_no, session_code, title, url, intro_date, act_date, documents map, status array,
    and lead, other_primary, cosponsor: map<legislator_id or committee_id, ids>); (changed tables, quarantine).
    Where a bill comes more than once, the row with the largest ord, if there is such a column, counts.
    """
    return _load_keyed_bills(tables, _with_bill_id(rows))


def _with_bill_id(rows: DataFrame) -> DataFrame:
    return rows.withColumn("bill_id", merge.surrogate_key("bill_no", "session_code"))


def _dealt_bills(rows: DataFrame) -> DataFrame:
    """Bills with their id, dealt by it once: what load_bills makes of them for its tables stays where they lie."""
    return spread(_with_bill_id(rows), "bill_id")


def _load_keyed_bills(tables: dict[str, DataFrame], rows: DataFrame) -> tuple[dict[str, DataFrame], DataFrame]:
    known, odd = _with_start(tables, rows)
    good, bad = validate.split(known.drop("start"), {c: F.col(c).isNotNull() for c in ("bill_no", "title", "url", "intro_date")})
    bills = merge.upsert(tables["bills"], good.select(*tables["bills"].columns, *[c for c in ("ord",) if c in rows.columns]), ["bill_id"], ["bill_no", "session_code", "title", "url", "intro_date", "act_date"], F.col("ord") if "ord" in rows.columns else None)
    docs = resolve.map_rows(good, "bill_id", "documents").select("bill_id", F.col("kind").alias("document_type"), F.trim("value").alias("url"))
    status = good.select("bill_id", F.explode("status").alias("s")).select("bill_id", "s.chamber", "s.status_date", "s.history_action", "s.vote_action_present")
    # All kinds in one pass over the rows; what holds for a whole list is done before its members are rows.
    kinds = F.array(*[F.struct(F.lit(n).alias("kind"), F.map_entries(_ids(good, kind)).alias("lists")) for kind, n in SPONSORS.items()])
    lists = good.select("bill_id", F.explode(kinds).alias("k")).select("bill_id", "k.kind", F.explode("k.lists").alias("l"))
    lists = lists.select("bill_id", "kind", F.regexp_replace("l.key", "_id$", "").alias("member_kind"), F.array_distinct("l.value").alias("ids"))
    members = lists.select("bill_id", "kind", "member_kind", F.explode("ids").alias("member_id")).where("member_id IS NOT NULL")
    changed = {
        "bills": bills,
        "bill_documents": merge.add_rows(tables["bill_documents"], docs, ["bill_id", "document_type", "url"]),
        "bill_status_history": merge.add_rows(tables["bill_status_history"], status, ["bill_id", "chamber", "status_date", "history_action"]),
        "sponsors": merge.first_rank_wins(tables["sponsors"], members, ["bill_id", "member_kind", "member_id"], "kind", sorted(SPONSORS, key=SPONSORS.get)),
    }
    return changed, odd.select("url", F.array(F.lit("session")).alias("errors")).unionByName(bad.select("url", "errors"))


def _with_vote_id(rows: DataFrame) -> DataFrame:
    rows = rows.withColumn("vote_timestamp", to_instant(F.col("vote_timestamp")))
    return rows.withColumn("vote_event_id", merge.surrogate_key("bill_id", "chamber", "vote_timestamp"))


def load_votes(tables: dict[str, DataFrame], rows: DataFrame) -> dict[str, DataFrame]:
    """rows(bill_id, vote_timestamp without zone, chamber, motion_text, five arrays of legislator ids), once for each vote; a repeated
    vote counts as the row with the largest ord, if there is such a column.
    """
    return _load_each_vote(tables, _each_vote(rows))


def _dealt_votes(rows: DataFrame) -> DataFrame:
    """Votes with their id, dealt by it once: what load_votes reads several times, so that none of its steps moves them again."""
    return spread(_with_vote_id(rows), "vote_event_id")


def _last_votes(rows: DataFrame) -> DataFrame:
    return merge.one_per_key(rows, ["vote_event_id"], F.col("ord") if "ord" in rows.columns else None)


def _each_vote(rows: DataFrame) -> DataFrame:
    """A row for each vote."""
    return _last_votes(_dealt_votes(rows))


def _load_each_vote(tables: dict[str, DataFrame], rows: DataFrame) -> dict[str, DataFrame]:
    events = merge.upsert(tables["vote_events"], rows.select(*tables["vote_events"].columns), ["vote_event_id"], ["bill_id", "vote_timestamp", "chamber", "motion_text"], None, once=True)
    votes = resolve.bucket_rows(rows, "vote_event_id", CASTS).where(F.col("member").isNotNull()).select("vote_event_id", F.col("member").alias("legislator_id"), F.col("cast").alias("vote_cast"))
    return {"vote_events": events, "legislator_votes": merge.replace_children(tables["legislator_votes"], votes, rows, "vote_event_id", once=True)}


def constraints(tables: dict[str, DataFrame]) -> DataFrame:
    """(rule, violations) after a batch."""
    ordered = lambda name: (name, "end before start", F.coalesce(F.col("end") >= F.col("start"), F.lit(True)))
    return validate.constraint_report(
        tables,
        not_null=[("bills", "title"), ("bills", "intro_date"), ("legislators", "last_name"), ("legislator_history", "start"), ("vote_events", "vote_timestamp")],
        unique=[("bills", ("bill_no", "session_code")), ("legislators", ("first_name", "last_name")), ("legislator_history", ("legislator_id", "chamber", "start")), ("legislator_votes", ("vote_event_id", "legislator_id")), ("sponsors", ("bill_id", "member_kind", "member_id"))],
        foreign=[("bill_documents", "bill_id", "bills", "bill_id"), ("committee_membership", "committee_id", "committees", "committee_id"), ("legislator_votes", "vote_event_id", "vote_events", "vote_event_id")],
        holds=[ordered("legislator_history"), ordered("committee_info"), ordered("committee_membership"), ("sponsors", "member kind", F.col("member_kind").isin("legislator", "committee"))],
    )


def open_store(spark: SparkSession, path: str, buckets: int = BUCKETS) -> Store:
    """The tables as a store; none of them has rows at first."""
    return Store(spark, path, SCHEMAS, KEYS, buckets)


#: Kind of records -> (the load, the tables that it changes, the key of a record in them; None for all buckets).
LOADS: dict[str, tuple[Callable, tuple[str, ...], Callable[[DataFrame], DataFrame] | None]] = {
    "sessions": (load_sessions, ("sessions",), None),
    "committees": (load_committees, ("committees", "committee_info"), lambda rows: rows.select("committee_id")),
    "legislators": (load_legislators, ("legislators", "legislator_history", "committee_membership"), lambda rows: rows.select(merge.surrogate_key("first_name", "last_name").alias("key"))),
    "bills": (_load_keyed_bills, ("bills", "bill_documents", "bill_status_history", "sponsors"), lambda rows: rows.select("bill_id")),
    "votes": (_load_each_vote, ("vote_events", "legislator_votes"), lambda rows: rows.select("vote_event_id")),
}
#: Kind of records -> what is done to them once, before a load reads them for each of its tables: (how they are dealt,
#: the key by which they then lie, how one row of a key is picked, which is left out where no key is repeated; None where all rows of a key count).
READY: dict[str, tuple[Callable[[DataFrame], DataFrame], str, Callable[[DataFrame], DataFrame] | None]] = {"bills": (_dealt_bills, "bill_id", None), "votes": (_dealt_votes, "vote_event_id", _last_votes)}
#: Rows that a load keeps lie on disk: the memory of executors is for what is sorted and tallied.
KEPT = StorageLevel.DISK_ONLY


def into_store(store: Store, kind: str, rows: DataFrame, batch: tuple[str, int] | None = None, aside: Callable[[DataFrame], None] | None = None) -> int:
    """Loads records of a kind; only buckets with their keys are read and written. Returns the version that has them.

    aside gets the load's quarantine, each time that the load is tried.
    """
    how, names, key = LOADS[kind]
    deal, dealt_by, pick = READY.get(kind, (None, None, None))
    if deal:
        rows = deal(rows)

    def change(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
        found = how(tables, rows)
        changed, odd = found if isinstance(found, tuple) else (found, None)
        if aside and odd is not None:
            aside(odd)
        return changed

    kept = []
    if rows.storageLevel == StorageLevel.NONE:  # else the caller keeps them
        kept.append(rows := rows.persist(KEPT))  # each table's merge reads them
    try:
        if pick and merge.any_repeated(rows, [dealt_by]):
            kept.append(rows := pick(rows).persist(KEPT))
        keys = key(rows) if key else None
        return store.load(change, {name: keys for name in names}, batch)
    finally:
        for df in kept:
            df.unpersist()

"""What grows with the tables is dealt over files and tasks, passes no driver, and does not stay."""

import datetime as dt
from pathlib import Path

from oracle import SF
from pyspark.sql import functions as F

from pagemart.functions import urls
from pagemart.operators import documents, graph, html, merge, trees
from pagemart.plans import load, store_queries
from pagemart.streaming import pages as stream


def test_arrivals_are_several_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(store_queries, "ARRIVING", 10)
    assert store_queries._arrive(f"file://{tmp_path}/in", spark.range(45), spark.range(5)) == 5
    assert len(list((tmp_path / "in" / "0").glob("*.parquet"))) == 5


def test_marks_are_not_broadcast(spark):
    marked = documents.marked_chars(*store_queries._printed(spark, SF))
    assert "Broadcast" not in marked._jdf.queryExecution().executedPlan().toString()


def test_rounds_of_trees_do_not_stay(spark, tmp_path, monkeypatch):
    monkeypatch.setattr("pagemart.operators.lineage.shared_folder", lambda _: f"file://{tmp_path}")
    chain = spark.range(9).selectExpr("string(id) AS key", "IF(id = 0, NULL, string(id - 1)) AS parent_key", "id AS pos")
    assert trees.numbers(chain).count() == 9
    assert len([p for p in Path(tmp_path).iterdir() if list(p.glob("*.parquet"))]) == 1


def test_a_load_asks_once_which_buckets_its_keys_touch(spark, tmp_path):
    """Tables with one key are in the same buckets."""
    asked = []
    s = load.open_store(spark, str(tmp_path), 4)
    keys = spark.range(9).withColumnRenamed("id", "key")
    select = keys.select
    keys.select = lambda *c: asked.append(c) or select(*c)
    found = s._touched({"bills": keys, "bill_documents": keys, "sponsors": keys})
    assert len(asked) == 1 and found["bills"] == found["sponsors"] != set()


def test_sponsors_are_tallied_by_hash(spark):
    members = spark.createDataFrame([(1, "legislator", 7, 2), (1, "legislator", 7, 0), (2, "committee", 8, 1), (3, "committee", 8, 1)], "bill_id long, member_kind string, member_id long, kind int")
    current = spark.createDataFrame([(3, "cosponsor", "committee", 8)], load.SCHEMAS["sponsors"])
    best = merge.first_rank_wins(current, members, ["bill_id", "member_kind", "member_id"], "kind", ["lead", "other_primary", "cosponsor"])
    assert sorted((r.bill_id, r.kind) for r in best.collect()) == [(1, "lead"), (2, "other_primary"), (3, "cosponsor")]
    assert "SortAggregate" not in best._jdf.queryExecution().executedPlan().toString()


def test_sponsors_given_as_text(spark):
    """Blank ids are left out."""
    rows = spark.sql("SELECT map('legislator_id', array('3', ' ', NULL)) AS lead")
    assert rows.select(load._ids(rows, "lead").alias("x")).first().x == {"legislator_id": [3, None, None]}


def _dealt_by_number(df) -> int:
    return df._jdf.queryExecution().executedPlan().toString().count("REPARTITION_BY_NUM")


def test_orphans_are_dealt_by_number(spark):
    """Small parts are not put together by their compressed bytes, so no task sorts them all."""
    nodes = spark.createDataFrame([(c,) for c in "abcd"], "key string")
    edges = spark.createDataFrame([("a", "b"), ("a", "b"), ("d", "x")], "src_key string, dst_key string")
    linked = graph.without_orphans(nodes, edges)
    assert sorted(r.key for r in linked.collect()) == ["a", "b", "d"] and _dealt_by_number(linked) >= 2


def test_replaced_children_are_dealt_by_number(spark):
    current = spark.createDataFrame([(1, "a"), (2, "b"), (None, "c")], "p long, v string")
    new = merge.replace_children(current, spark.createDataFrame([(2, "n")], "p long, v string"), spark.createDataFrame([(2,), (2,), (None,)], "p long"), "p")
    assert sorted(r.v for r in new.collect()) == ["a", "c", "n"] and _dealt_by_number(new) >= 2


VOTE = "bill_id long, vote_timestamp timestamp_ntz, chamber string, motion_text string, " + ", ".join(f"{c} array<long>" for c in load.CASTS) + ", ord int"


def _votes(spark, *rows):
    """(bill, motion, yeas, ord) each."""
    return spark.createDataFrame([(bill, dt.datetime(2021, 1, 11, 9), "house", motion, yeas, [9], [], None, [None], n) for bill, motion, yeas, n in rows], VOTE)


def test_votes_are_put_together_once_a_load(spark, tmp_path, monkeypatch):
    """Both tables and the question for buckets read votes that are dealt, told apart and kept once; of a repeated one the last by ord counts, and where none is repeated none is looked for."""
    s, calls, one = load.open_store(spark, str(tmp_path), 4), [], merge.one_per_key
    monkeypatch.setattr(merge, "one_per_key", lambda *a, **k: calls.append(a) or one(*a, **k))
    found = lambda: {(r.bill_id, r.motion_text, r.legislator_id) for r in s.read("vote_events").join(s.read("legislator_votes"), "vote_event_id").collect()}
    load.into_store(s, "votes", _votes(spark, (1, "b", [1, 2], 2), (1, "a", [3], 1), (2, "c", [4, 4], 1), (None, "n", [5], 1)))
    first = {(2, "c", 4), (2, "c", 9), (None, "n", 5), (None, "n", 9)}
    assert len(calls) == 1 and found() == first | {(1, "b", 1), (1, "b", 2), (1, "b", 9)} and s.read("legislator_votes").count() == 8
    load.into_store(s, "votes", _votes(spark, (1, "late", [7], 1), (3, "d", [8], 1)))
    assert len(calls) == 1 and found() == first | {(1, "late", 7), (1, "late", 9), (3, "d", 8), (3, "d", 9)}


def test_votes_stay_where_they_are_dealt(spark):
    """Of each join with stored rows only the stored ones are moved."""
    rows = load._each_vote(_votes(spark, (1, "b", [1, 2], 2), (1, "a", [3], 1))).persist()
    stored = {name: spark.createDataFrame([tuple([7] + [None] * load.SCHEMAS[name].count(","))], load.SCHEMAS[name]) for name in ("vote_events", "legislator_votes")}
    moves = lambda df: df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning")
    try:
        assert rows.count() == 1
        for name, df in load._load_each_vote(stored, rows).items():
            kept = df._jdf.queryExecution().executedPlan().toString().count("InMemoryRelation")
            assert kept and moves(df) - kept * moves(rows.select("*")) == 1, name
            assert df.count() == {"vote_events": 2, "legislator_votes": 4}[name]
    finally:
        rows.unpersist()


def test_joins_with_tables_without_rows_are_not_run(spark, tmp_path):
    s = load.open_store(spark, str(tmp_path), 4)
    votes = spark.createDataFrame([(1, 2, "yea")], load.SCHEMAS["legislator_votes"])
    first = merge.replace_children(s.read("legislator_votes"), votes, votes, "vote_event_id")
    assert "Join" not in first._jdf.queryExecution().optimizedPlan().toString() and first.count() == 1


def test_a_known_batch_is_not_read_again(spark, tmp_path):
    s, read = load.open_store(spark, str(tmp_path), 4), []
    sink = stream.load_records(s, "votes", "pages", lambda batch: read.append(1) or batch)
    for number in (0, 0, 1, 0):
        sink(_votes(spark, (number, "a", [1], 1)), number)
    assert len(read) == 2 and s.read("vote_events").count() == 2


def test_pages_of_one_shape_are_built_once(monkeypatch):
    """Tags are put together once for all pages that have the same; memory of shapes is bounded."""
    built, shape = [], html._shape
    monkeypatch.setattr(html, "_shape", lambda tokens: built.append(1) or shape(tokens))
    monkeypatch.setattr(html, "SHAPES", 2)
    html._shapes.clear()
    page = "<div class=a{0}> x <b>{0}&amp;</b>{1}</div> end"
    assert [html.parsed(page.format(i, " y" * i))[0] for i in range(3)] == ["x 0& end", "x 1& y end", "x 2& y y end"]
    assert len(built) == 2 and html.parsed(page.format(7, ""))[1][0][10] == [("class", "a7")]  # without a text before the end, and with one
    for i in range(5):
        html.parsed("<i>" * i)
    assert len(html._shapes) <= 2


def test_the_place_of_a_url_is_read_once(spark):
    found = spark.createDataFrame([("https://h/a/b?x#y",), ("h/a",), (None,)], "url string").select(urls.classify(F.col("url"), {"h": "home", "h/a": "a", "h/b": "b", "h/c": "c"}).alias("t"))
    assert [r.t for r in found.collect()] == ["a", None, None]
    assert found._jdf.queryExecution().optimizedPlan().toString().lower().count("rlike") == 1


def test_bills_are_dealt_once_and_kept_on_disk(spark, tmp_path, monkeypatch):
    """No memory of executors holds a load's rows, and joins with stored rows are dealt by number."""
    s, kept, keyed = load.open_store(spark, str(tmp_path), 4), [], load._load_keyed_bills
    load.into_store(s, "sessions", spark.createDataFrame([("a", "A", dt.date(2001, 1, 1))], load.SCHEMAS["sessions"]))
    monkeypatch.setitem(load.LOADS, "bills", (lambda tables, rows: kept.append((rows.storageLevel, rows, tables)) or keyed(tables, rows), *load.LOADS["bills"][1:]))
    schema = "bill_no string, session_code string, title string, url string, intro_date timestamp_ntz, act_date date, documents map<string,array<string>>, status array<struct<chamber:string,status_date:timestamp_ntz,history_action:string,vote_action_present:boolean>>, " + ", ".join(f"{c} map<string,array<long>>" for c in load.SPONSORS) + ", ord int"
    day = dt.datetime(2001, 2, 3)
    bill = lambda n, title, place: (f"b{n}", "a", title, "u", day, None, {"act": ["x", " "]}, [("house", day, "read", False)], {"legislator_id": [1, 1]}, {"legislator_id": [1, 2]}, {"committee_id": [1]}, place)
    batch = spark.createDataFrame([bill(1, "first", 1), bill(1, "last", 2), bill(2, "only", 1)], schema)
    for _ in range(2):
        load.into_store(s, "bills", batch)
    assert all(level.useDisk and not level.useMemory for level, *_ in kept)
    assert sorted(r.title for r in s.read("bills").collect()) == ["last", "only"]
    assert [s.read(name).count() for name in ("bill_documents", "bill_status_history", "sponsors")] == [2, 2, 6]
    dealt = load._dealt_bills(batch).persist()
    try:
        changed, _ = keyed(kept[-1][2], dealt)
        assert _dealt_by_number(changed["bill_documents"]) - _dealt_by_number(dealt.select("*")) >= 2
    finally:
        dealt.unpersist()


def test_few_calls_of_state_for_a_dependency():
    """Each is a message to the JVM: rows that come with their dependency make no list, and others go into it in pieces."""
    calls = []

    class State:
        def __init__(self, name):
            self.name, self.held = name, []

        def __getattr__(self, call):
            def run(*args):
                calls.append((self.name, call))
                if call in ("update", "appendList"):
                    self.held += args[0]
                return bool(self.held) if call == "exists" else iter(self.held)

            return run

    class Handle:
        getValueState = getListState = lambda self, name, schema: State(name)

    def waiting(*rows):
        calls.clear()
        return [tuple(r) for r in one.handleInputRows(("a",), iter([("a", *r) for r in rows]), None)]

    one = stream._Waiting("dep", "payload", None)
    one.init(Handle())
    one.PIECE = 2
    assert waiting(("r1", False), ("r2", False), ("r3", False)) == [] and calls == [("there", "exists")] + 2 * [("waiting", "appendList")]
    assert waiting(("r4", False), (None, True), ("r5", False)) == [("a", f"r{i}", False) for i in (1, 2, 3, 4, 5)]
    assert calls == [("there", "exists"), ("there", "update"), ("waiting", "get"), ("waiting", "clear")]
    assert waiting(("r6", False), (None, True)) == [("a", "r6", False)] and calls == [("there", "exists")]

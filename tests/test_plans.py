import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagemart.plans import load, page_types

D = dt.date
MEMBER = '<div><h1>Senator Ann Lee (D)</h1></div><address> 1 Main&amp;Side </address><table><tr><td><b>Phone:</b></td><td>(501) 555-1234</td></tr><tr><td>District:</td><td>7</td></tr><tr><td>Seniority:</td><td>3</td></tr></table><div id="committees"><a href="/Committees/Detail?code=5&amp;s=2021">Five</a></div>'
BILL = '<h1>AN ACT</h1><div class="l">Bill Number:</div><div><a href="/x.pdf">HB1001 PDF</a></div><div>Introduction Date:</div><div>1/11/2021 9:05:00 AM</div><div>Lead Sponsor:</div><div><a href="/Legislators/Detail?m=1&s=2021">Lee</a></div>'
VOTE = '<h1>House Vote - Tuesday, February 5, 2013 1:43:39 PM</h1><p>Yeas: 1</p><ul><li><a href="/Legislators/Detail?m=1&s=2021">A</a></li></ul><p>Nays: 0</p>'


@pytest.fixture(scope="module")
def pages(spark):
    at = "https://h.example.org"
    return spark.createDataFrame([(f"{at}/Legislators/Detail?m=1&s=2021", MEMBER), (f"{at}/Bills/Detail?id=HB1001&s=2021", BILL), (f"{at}/Bills/Votes?id=1&s=2021", VOTE), (f"{at}/Other", "")], "url string, html string")


def test_records(pages):
    types = [r.page_type for r in page_types.with_page_type(pages, "h.example.org").collect()]
    assert types == ["legislator", "bill", "bill_vote", "home"]
    get = lambda kind: page_types.records(pages, "h.example.org", kind, "s").first()
    member = get("legislator")
    assert (member.first_name, member.last_name, member.party, member.chamber, member.phone, member.district, member.seniority, member.session_code, member.address) == ("ann", "lee", "d", "senate", "15015551234", "7", 3, "2021", "1 main&side")
    assert member.committee_urls == ["https://h.example.org/Committees/Detail?code=5&s=2021"]
    bill = get("bill")
    assert (bill.title, bill.bill_no, bill.intro_date, bill.act_no) == ("an act", "hb1001", dt.datetime(2021, 1, 11, 9, 5), None)
    assert bill.lead_sponsor_urls == ["https://h.example.org/Legislators/Detail?m=1&s=2021"]
    vote = get("bill_vote")
    assert (vote.chamber, vote.nay_voters, vote.present_voters, len(vote.yea_voters)) == ("house", [], None, 1)
    with pytest.raises(KeyError):
        get("home")


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*columns).collect()), key=repr)


def test_load(spark):
    tables = load.empty_tables(spark)

    def keep(changed):
        tables.update({k: v.checkpoint() for k, v in changed.items()})

    keep(load.load_sessions(tables, spark.createDataFrame([("S1", "one", D(2020, 1, 1)), ("S2", "two", D(2021, 1, 1))], load.SCHEMAS["sessions"])))
    changed, odd = load.load_committees(tables, spark.createDataFrame([(5, "five", "c5", "S1"), (6, "six", "c6", "S1"), (7, "x", "y", "S9")], "committee_id long, name string, url string, session_code string"))
    keep(changed)
    assert rows(odd, "committee_id") == [(7,)] and tables["committees"].count() == 2
    person = "first_name string, last_name string, phone string, email string, address string, district string, seniority int, chamber string, url string, party string, session_code string, committee_ids array<long>"
    first = [("ann", "lee", "1", "e", "a", "7", 3, "house", "u1", "d", "S1", [5, 5, 99]), (None, "solo", None, None, None, "1", 1, "house", "u2", "r", "S1", None)]
    second = [("ann", "lee", "2", "e", "a", "8", 4, "house", "u1", "d", "S2", [6])]
    for batch in (first, first, second, second):
        changed, bad = load.load_legislators(tables, spark.createDataFrame(batch, person))
        if batch is first:
            assert rows(bad, "url") == [("99",), ("u2",)]
        keep(changed)
    assert rows(tables["legislators"], "first_name", "phone") == [("ann", "2")]
    assert rows(tables["legislator_history"], "district", "start", "end") == [("7", D(2020, 1, 1), D(2020, 12, 31)), ("8", D(2021, 1, 1), None)]
    assert rows(tables["committee_membership"], "committee_id", "start", "end") == [(5, D(2020, 1, 1), D(2020, 12, 31)), (6, D(2021, 1, 1), None)]
    bill = "bill_no string, session_code string, title string, url string, intro_date timestamp_ntz, act_date date, documents map<string,array<string>>, status array<struct<chamber:string,status_date:timestamp_ntz,history_action:string,vote_action_present:boolean>>, lead map<string,array<long>>, other_primary map<string,array<long>>, cosponsor map<string,array<long>>"
    when = dt.datetime(2021, 1, 11, 9)
    bills = [("hb1", "S2", "t", "u", when, None, {"act": ["d1", " ", None, "d1"]}, [("house", when, "read", False)], {"legislator_id": [1, 2]}, {"legislator_id": [2], "committee_id": [5]}, {"legislator_id": [1, 3, None]})]
    for _ in range(2):
        changed, bad = load.load_bills(tables, spark.createDataFrame(bills, bill))
        keep(changed)
        assert bad.count() == 0
    assert rows(tables["sponsors"], "kind", "member_kind", "member_id") == [("cosponsor", "legislator", 3), ("lead", "legislator", 1), ("lead", "legislator", 2), ("other_primary", "committee", 5)]
    assert rows(tables["bill_documents"], "url") == [("d1",)] and tables["bill_status_history"].count() == 1
    vote = "bill_id long, vote_timestamp timestamp_ntz, chamber string, motion_text string, " + ", ".join(f"{c} array<long>" for c in load.CASTS)
    bill_id = tables["bills"].first().bill_id
    for motion, yea in (("m", [1, 2]), ("m2", [1])):
        keep(load.load_votes(tables, spark.createDataFrame([(bill_id, when, "house", motion, yea, [3], [], None, [None])], vote)))
    assert rows(tables["vote_events"], "motion_text") == [("m2",)] and rows(tables["legislator_votes"], "legislator_id", "vote_cast") == [(1, "yea"), (3, "nay")]
    assert {r.violations for r in load.constraints(tables).collect()} == {0}
    keep(load.close_legislators(tables, spark.createDataFrame([("other",)], "url string"), F.lit("2022-01-01").cast("date")))
    assert rows(tables["legislator_history"].where("district = '8'"), "end") == [(D(2021, 12, 31),)]
    assert rows(tables["committee_membership"].where("committee_id = 6"), "end") == [(D(2021, 12, 31),)]

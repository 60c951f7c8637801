import collections
import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from pagemart.operators import documents, frontier, graph, html, merge, resolve, template, trees, validate
from pagemart.operators.lineage import cut, written

D = dt.date


def rows(df, *columns):
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


PAGE = """<html><body><nav id="top"><a href="/skip">Skip</a></nav><h2>Votes</h2><p>Yeas : 2</p><ul><li><a href="/m/1">Ann</a></li><li><a href="/m/2">Bo</a></li></ul>
<p>Nays : 0</p><h2>More</h2><a href="/v?a=1&amp;b=2">View Vote</a>
<table><tr><td>Phone:</td><td>501 555</td></tr><tr><td>Bills</td><td><a href="/b/1">HB1</a></td></tr></table></body></html>"""


@pytest.fixture(scope="module")
def page(spark):
    return spark.createDataFrame([(1, "https://h.org/x/y", PAGE), (2, "https://h.org/z", None)], "page_id long, url string, html string")


def test_html(page):
    first = page.where("page_id = 1")
    got = html.apply_template(first, {"heads": "h2", "hrefs": ("a", "href"), "yeas": lambda c: html.counted(c, "Yeas"), "nays": lambda c: html.counted(c, "Nays"), "absent": lambda c: html.counted(c, "Absent"), "none": "h5"}).first()
    assert got.heads == ["Votes", "More"] and got.hrefs[0] == "/skip" and got.none is None
    assert (got.yeas, got.nays, got.absent) == (["/m/1", "/m/2"], [], None)
    assert dict(rows(html.link_groups(first), "heading", "hrefs")) == {None: ["/skip"], "Votes": ["/m/1", "/m/2"], "More": ["/v?a=1&b=2", "/b/1"]}
    assert rows(html.links_matching(html.links(page), "(?i)vote"), "href") == [("/v?a=1&b=2",)]
    with pytest.raises(ValueError):
        html.apply_template(first, {"x": ("a", "b", "c")})


ODD = """<A HREF='/x'>one</A><a href=/y class=k>two<b>!</b></a><!-- <a href="/c">no</a> --><script>s = '<a href="/s">';</script>
<style>a { } <a href="/t"></style><a class="q > r" title='<a href="/no">' href="/z">three <a
  href = "/w?a=1&amp;b='2'">four</a><a name="n">five</a><area href="/area"><a data-href="/d" href="/e">six</a><a href="">seven</a>"""


def stdlib_links(html_text):
    """What the standard library's parser says of links."""
    from html.parser import HTMLParser

    class Links(HTMLParser):
        found = []

        def handle_starttag(self, tag, attrs):
            if tag == "a" and "href" in dict(attrs):
                self.found.append(dict(attrs)["href"])

    parser = Links()
    parser.found = []
    parser.feed(html_text)
    parser.close()
    return parser.found


def test_links_of_all_forms(spark):
    real = [r.html for r in spark.read.parquet("/root/testdata/sf0.001/pages.parquet").collect()]
    single = [h.replace('href="', "HREF = '").replace('">', "'>") for h in real[:10]]
    junk = ["<a " + "x " * 60_000, "<a" + " y=z" * 30_000 + " href='/long'>l</a>", "<a title='" + "q" * 200_000 + "' href=/t>t</a>", '<a title="' * 300]
    pages = spark.createDataFrame([(i, "https://h.org/", h) for i, h in enumerate([ODD, *real, *single, *junk, "", None])], "page_id long, url string, html string")
    found = {}
    for r in html.links(pages).orderBy("page_id", "pos").collect():
        found.setdefault(r.page_id, []).append(r.href)
    for r in pages.collect():
        assert found.get(r.page_id, []) == (stdlib_links(r.html) if r.html else []), r.page_id
    assert found[0] == ["/x", "/y", "/z", "/w?a=1&b='2'", "/e", ""]
    assert [r.text for r in html.links(pages.where("page_id = 0")).orderBy("pos").collect()] == ["one", "two !", "three", "four", "six", "seven"]
    groups = html.link_groups(pages).where("page_id = 0").first()
    assert groups.hrefs == found[0]
    by_elements = html.elements(pages).where("tag = 'a' AND href IS NOT NULL").orderBy("page_id", "pos").collect()
    assert {k: [r.href for r in by_elements if r.page_id == k] for k in found} == found


NESTED = """<div id="a" class="box wide"><div class="in">p <div>q</div></div> r</div><ul><li>1<li class="b">2<ul><li>2.1</ul><li>3</ul>
<p>x<p id="z" data-k="v w">y <b>bold</b><table><tr><td>1<td>2<tr><td>3</table><a href="/1?u=1">k</a><br><a>l</a>"""


@pytest.mark.parametrize(
    "selector, expected",
    [
        ("div", ["p q r", "p q", "q"]),
        ("#a > div", ["p q"]),
        ("div div", ["p q", "q"]),
        ("div.box.wide .in div", ["q"]),
        (".wid", None),
        ("ul > li", ["1", "22.1", "2.1", "3"]),
        ("body > ul li, b", ["bold"]),
        ("li + li", ["22.1", "3"]),
        ("li.b ~ li", ["3"]),
        ("ul ul li:first-child", ["2.1"]),
        ("tr td:nth-child(2)", ["2"]),
        ("[data-k='v w'] b", ["bold"]),
        ("p[data-k^=v]", ["y bold123kl"]),
        ("a[href*='u=']", ["k"]),
        ("a[href$='=1'], p", ["x", "y bold123kl", "k"]),
        ("*#z", ["y bold123kl"]),
        ("h1", None),
    ],
)
def test_css(spark, selector, expected):
    pages = spark.createDataFrame([(NESTED,)], "html string")
    assert html.with_elements(pages).select(html.texts(F.col("elements"), selector).alias("t")).first().t == expected


def test_templates_over_elements(spark):
    pages = spark.createDataFrame([("u", NESTED), ("v", None)], "url string, html string")

    def second(page):
        return page[1]["text"] if page else page[1]

    keys = {"k": ("a", "href"), "p": html.per_page(second), "l": html.per_page(lambda page: [e["tag"] for e in page][:2])}
    got = {r.url: r for r in html.apply_template(pages, keys).collect()}
    assert (got["u"].k, got["u"].p, got["u"].l) == (["/1?u=1"], ["p q"], ["div", "div"]) and (got["v"].k, got["v"].p, got["v"].l) == (None, None, [])
    for bad in ({"k": html.per_page(second, strict=True)}, {"k": ("a", "href")}):
        with pytest.raises(Exception, match="IndexError|without href"):
            html.apply_template(pages, bad, strict=True).collect()
    for selector in ("", "a >", "> a", "a:hover", "a[", "a..b"):
        with pytest.raises(ValueError):
            html.css(F.col("x"), selector)


def test_elements(page):
    found = html.elements(page)
    pairs = html.label_values(found, "page_id")
    assert rows(pairs, "label", "value", "hrefs") == [("Bills", "HB1", ["/b/1"]), ("Phone:", "501 555", None)]
    assert rows(html.label_value(pairs, "page_id", {"phone": "phone", "fax": "fax"})) == [(1, "501 555", None)]
    assert rows(html.link_after(found, "page_id", "top")) == [(1, "/skip")]
    assert rows(html.links_within(found, "page_id", "top"), "href") == [("/skip",)]
    assert rows(html.link_lists(found, "page_id", {"nav": "top"}, "top"), "kind", "href") == [("nav", "/skip"), ("next_page", "/skip")]
    assert html.table_rows(found, "page_id", ["a", "b"]).first().rows[0].b == "501 555"


def test_template(spark):
    raw = spark.createDataFrame([(1, " A ", "7", "x"), (2, None, "q", "y")], "id int, name string, n string, extra string")
    clean = template.project(raw, {"name": lambda c: F.lower(F.trim(c)), "n": lambda c: c.try_cast("int")}, keep=("id",))
    assert rows(clean) == [(1, "a", 7), (2, None, None)]
    assert rows(template.with_errors(raw, clean, "id", ["name", "n"]), "id", "errors") == [(1, []), (2, ["n"])]
    with pytest.raises(KeyError):
        template.project(raw, {"name": F.lower}, keep=("id",), strict=True)
    with pytest.raises(TypeError):
        template.Template(transforms={"name": 3})
    got = template.as_parameters(spark.createDataFrame([({}, {"a": ["b"]})], "m map<string,string>, k map<string,array<string>>")).first()
    assert got.p_m is None and got.p_k == '{"a":["b"]}'


def test_rules(spark):
    df = spark.createDataFrame([("http://a.b", "/p", "a@b.c"), ("ftp://a/", "p", None)], "u string, p string, e string")
    good, bad = validate.split(df, {"url": validate.base_url(F.col("u")), "path": validate.path(F.col("p")), "email": validate.email(F.col("e"))})
    assert good.count() == 1 and bad.first().errors == ["url", "path", "email"]
    m = F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit(None).cast("string"))
    got = spark.range(1).select(validate.missing_keys(m, ["a", "b", "c"]).alias("x"), validate.matches(m, {"a": "1", "b": None}).alias("y"), validate.matches(m, {"c": None}).alias("z")).first()
    assert got.x == ["c"] and got.y and not got.z


def test_three_resolutions(spark):
    records = spark.createDataFrame([(1, ["u1", "u2"]), (2, ["u1", "u9"]), (3, []), (4, None)], "k int, links array<string>")
    loaded = spark.createDataFrame([("u1", 10), ("u2", 20)], "url string, id int")
    args = (records, loaded, "k", "links", "url", "id")
    assert rows(resolve.resolve_lenient(*args)) == [(1, [10, 20]), (2, [10, None]), (3, []), (4, [])]
    assert rows(resolve.resolve_drop(*args)) == [(1, [10, 20]), (2, [10]), (3, []), (4, [])]
    done, waiting = resolve.resolve_strict(*args)
    assert rows(done) == [(1, [10, 20]), (3, []), (4, [])] and rows(waiting, "k") == [(2,)]


SESSIONS = {"S1": D(2020, 1, 1), "S2": D(2021, 1, 1), "S3": D(2022, 1, 1)}


def apply_scd2(spark, batches, **kw):
    current = spark.createDataFrame([], "k int, v string, start date, end date")
    for batch in batches:
        current = merge.scd2(current, spark.createDataFrame(batch, "k int, v string, start date"), ["k"], ["v"], **kw).checkpoint()
    return current


def test_scd2_step_by_step_equals_whole_history(spark):
    history = [(1, "a", SESSIONS["S1"]), (1, "b", SESSIONS["S2"]), (1, "a", SESSIONS["S3"]), (2, "x", SESSIONS["S1"]), (2, "x", SESSIONS["S2"]), (3, None, SESSIONS["S2"])]
    steps = apply_scd2(spark, [[r for r in history if r[2] == s] for s in SESSIONS.values()])
    whole = merge.versions(spark.createDataFrame(history, "k int, v string, start date"), ["k"], ["v"], "start")
    expected = [(1, "a", D(2020, 1, 1), D(2020, 12, 31)), (1, "a", D(2022, 1, 1), None), (1, "b", D(2021, 1, 1), D(2021, 12, 31)), (2, "x", D(2020, 1, 1), None), (3, None, D(2021, 1, 1), None)]
    assert rows(steps, "k", "v", "start", "end") == rows(whole, "k", "v", "start", "end") == sorted(expected, key=repr)


def test_scd2_again_changes_nothing(spark):
    batch = [(1, "b", SESSIONS["S2"])]
    once = apply_scd2(spark, [[(1, "a", SESSIONS["S1"])], batch])
    assert rows(apply_scd2(spark, [[(1, "a", SESSIONS["S1"])], batch, batch])) == rows(once)
    early = apply_scd2(spark, [[(1, "a", SESSIONS["S2"])], [(1, "b", SESSIONS["S1"])]], at_least_start=True)
    assert (1, "a", SESSIONS["S2"], SESSIONS["S2"]) in rows(early)


def test_scd2_with_several_versions_in_a_batch(spark):
    start = [[(1, "a", D(2020, 1, 1)), (2, "p", D(2020, 1, 1))]]
    batch = [(1, "b", D(2021, 1, 1)), (1, "c", D(2022, 1, 1)), (1, "c", D(2023, 1, 1)), (2, "p", D(2021, 1, 1)), (2, "q", D(2022, 1, 1)), (3, "x", D(2021, 1, 1)), (3, "y", D(2022, 1, 1))]
    expected = [(1, "a", D(2020, 1, 1), D(2020, 12, 31)), (1, "b", D(2021, 1, 1), D(2021, 12, 31)), (1, "c", D(2022, 1, 1), None), (2, "p", D(2020, 1, 1), D(2021, 12, 31)), (2, "q", D(2022, 1, 1), None), (3, "x", D(2021, 1, 1), D(2021, 12, 31)), (3, "y", D(2022, 1, 1), None)]
    for batches in ([batch], [batch, batch], [[r] for r in batch], [batch[:4], batch]):
        assert rows(apply_scd2(spark, start + batches)) == sorted(expected, key=repr)
    late = [(1, "z", D(2019, 1, 1)), (1, "b", D(2021, 6, 1)), (1, "z", D(2022, 1, 1)), (4, "n", D(2019, 1, 1))]
    current = apply_scd2(spark, [*start, batch])
    aside = merge.late(current, spark.createDataFrame(late, "k int, v string, start date"), ["k"], ["v"])
    assert rows(aside) == [(1, "z", D(2019, 1, 1)), (1, "z", D(2022, 1, 1))]
    assert rows(apply_scd2(spark, [*start, batch, late])) == sorted([*expected, (4, "n", D(2019, 1, 1), None)], key=repr)


def test_membership_over_sessions(spark):
    kind = "o int, m int, start date, end date"
    cur = spark.createDataFrame([(7, 1, D(2020, 1, 1), None), (7, 2, D(2020, 1, 1), None), (8, 5, D(2020, 1, 1), None), (7, 9, D(2019, 1, 1), D(2019, 12, 31))], kind)
    days = [D(2021, 1, 1), D(2022, 1, 1), D(2023, 1, 1)]
    listed = [(7, 2, days[0]), (7, 3, days[0]), (7, 1, days[1]), (7, 3, days[2]), (7, 3, days[2]), (7, 9, days[2])]
    sessions = spark.createDataFrame([(7, d) for d in days], "o int, start date")
    got = merge.sync_membership(cur, spark.createDataFrame(listed, "o int, m int, start date"), sessions, "o", "m").checkpoint()
    expected = [(7, 1, D(2020, 1, 1), D(2020, 12, 31)), (7, 1, days[1], D(2022, 12, 31)), (7, 2, D(2020, 1, 1), D(2021, 12, 31)), (7, 3, days[0], D(2021, 12, 31)), (7, 3, days[2], None), (7, 9, D(2019, 1, 1), D(2019, 12, 31)), (7, 9, days[2], None), (8, 5, D(2020, 1, 1), None)]
    assert rows(got) == sorted(expected, key=repr)
    assert rows(merge.sync_membership(got, spark.createDataFrame(listed, "o int, m int, start date"), sessions, "o", "m")) == rows(got)
    one_by_one = cur
    for d in days:
        one_by_one = merge.sync_membership(one_by_one, spark.createDataFrame([r for r in listed if r[2] == d], "o int, m int, start date"), sessions.where(F.col("start") == d), "o", "m").checkpoint()
    assert rows(one_by_one) == rows(got)


def test_changes_in_order(spark):
    cur = spark.createDataFrame([(1, "m")], "k int, v string")
    new = spark.createDataFrame([(1, "z first", 1), (1, "a last", 2), (2, "x", 2), (2, "y", 1)], "k int, v string, n int")
    assert rows(merge.upsert(cur, new, ["k"], ["v"], F.col("n"))) == [(1, "a last"), (2, "x")]
    assert rows(merge.insert_absent(cur, new, ["k"], F.col("n")), "k", "v") == [(1, "m"), (2, "y")]


def test_merges_again_change_nothing(spark):
    cur = spark.createDataFrame([(1, "a", "p"), (2, "b", "q")], "k int, v string, w string")
    new = spark.createDataFrame([(2, None, "z"), (3, "c", "z"), (3, "c", "z")], "k int, v string, w string")
    up = merge.upsert(cur, new, ["k"], ["v"], None)
    assert rows(up) == [(1, "a", "p"), (2, None, "q"), (3, "c", None)]
    assert rows(merge.upsert(up, new, ["k"], ["v"], None)) == rows(up)
    ins = merge.insert_absent(cur, new, ["k"])
    assert rows(ins) == [(1, "a", "p"), (2, "b", "q"), (3, "c", "z")] == rows(merge.insert_absent(ins, new, ["k"]))


def test_null_keys_are_always_new(spark):
    cur = spark.createDataFrame([(1, None)], "k int, h string")
    new = spark.createDataFrame([(1, None), (1, "x"), (1, "x")], "k int, h string")
    assert merge.add_rows(cur, new, ["k", "h"]).count() == 3


def test_membership_and_closing(spark):
    cur = spark.createDataFrame([(7, 1, D(2020, 1, 1), None), (7, 2, D(2020, 1, 1), None), (8, 5, D(2020, 1, 1), None)], "o int, m int, start date, end date")
    listed = spark.createDataFrame([(7, 2), (7, 3), (7, 3), (7, None)], "o int, m int")
    sessions = spark.createDataFrame([(7, D(2021, 1, 1))], "o int, start date")
    got = merge.sync_membership(cur, listed, sessions, "o", "m")
    assert rows(got) == sorted([(7, 1, D(2020, 1, 1), D(2020, 12, 31)), (7, 2, D(2020, 1, 1), None), (7, 3, D(2021, 1, 1), None), (8, 5, D(2020, 1, 1), None)], key=repr)
    assert rows(merge.sync_membership(got, listed, sessions, "o", "m")) == rows(got)
    people = spark.createDataFrame([(1, "u1", D(2020, 1, 1), None), (2, "u2", D(2020, 1, 1), None)], "k int, url string, start date, end date")
    kept, closed = merge.close_missing(people, spark.createDataFrame([("u1",)], "url string"), F.lit("2021-01-01").cast("date"), "url")
    assert rows(closed, "k", "end") == [(2, D(2020, 12, 31))] and rows(kept.where("end IS NULL"), "k") == [(1,)]
    members = spark.createDataFrame([(2, 9, D(2020, 1, 1), None)], "k int, c int, start date, end date")
    assert rows(merge.cascade_close(members, closed, "k"), "end") == [(D(2020, 12, 31),)]


@pytest.fixture(scope="module")
def net(spark):
    nodes = spark.createDataFrame([("a", 1, 7, "h"), ("b", 2, 7, "h"), ("c", 3, 8, "h"), ("d", 4, 6, "h"), ("e", 5, 7, "h"), ("f", 6, 7, "h"), ("z", 7, 0, "i")], "key string, ord long, state int, host string")
    edges = spark.createDataFrame([("a", "b"), ("b", "c"), ("b", "d"), ("e", "f"), ("f", "e")], "src_key string, dst_key string")
    return nodes, edges


def test_graph(spark, net):
    nodes, edges = net
    assert rows(graph.roots(nodes, edges), "key") == [("a",), ("z",)]
    assert rows(graph.descendants(edges, spark.createDataFrame([("a",), ("e",)], "key string"))) == [("a", "a", 0), ("a", "b", 1), ("a", "c", 2), ("a", "d", 2), ("e", "e", 0), ("e", "f", 1)]
    assert dict(rows(graph.complete(nodes, edges), "key", "state")) == {"a": 7, "b": 7, "c": 8, "d": 6, "e": 8, "f": 8, "z": 0}
    assert rows(graph.without_orphans(nodes, edges).where("ord = 7")) == []
    left, links = graph.remove(nodes, edges, graph.reachable(edges, nodes.where("key = 'b'")))
    assert rows(left, "key") == [("a",), ("e",), ("f",), ("z",)] and links.count() == 2
    named = nodes.withColumn("v", F.when(F.col("key").isin("a", "c"), F.col("key")))
    assert dict(rows(graph.nearest_ancestor(named, edges, nodes.select("key"), "v"))) == {"a": "a", "b": "a", "c": "c", "d": "a", "e": None, "f": None, "z": None}


def test_finished_roots_go(spark):
    nodes = spark.createDataFrame([("a", 1, 7, "h"), ("b", 2, 8, "h"), ("c", 3, 7, "i"), ("d", 4, 3, "i")], "key string, ord long, state int, host string")
    edges = spark.createDataFrame([("a", "b"), ("c", "d")], "src_key string, dst_key string")
    left, links, gone = graph.drop_finished_roots(nodes, edges, spark.createDataFrame([("h",), ("i",)], "host string"))
    assert rows(left, "key") == [("c",), ("d",)] and rows(gone, "key") == [("a",)] and links.count() == 1


def test_tree(spark):
    children = spark.createDataFrame([("r", None, 0, 7), ("x", "r", 1, 1), ("y", "r", 2, 0), ("x1", "x", 1, 3), ("x2", "x", 2, 1)], "key string, parent_key string, pos int, state int")
    paths = graph.tree_paths(children)
    assert [r.key for r in graph.preorder(paths).orderBy("nth").collect()] == ["r", "x", "x1", "x2", "y"]
    assert [r.key for r in graph.resume_order(paths, children).collect()] == ["x", "x2", "y", "x1"]
    assert rows(graph.removable(children, spark.createDataFrame([("x1",), ("x2",)], "key string"))) == [("x",), ("x1",), ("x2",)]


def test_redline(spark):
    chars = spark.createDataFrame([("d", 1, i, t, 10.0 * i, 10.0 * i + 9, 100.0, 110.0) for i, t in enumerate("ab cd")], "doc string, page int, ord int, text string, x0 double, x1 double, top double, bottom double")
    rects = spark.createDataFrame([("d", 1, 0, 0.0, 19.0, 109.5, 110.5), ("d", 1, 1, 30.0, 49.0, 104.5, 105.5), ("d", 1, 2, 0.0, 99.0, 0.0, 50.0)], "doc string, page int, ord int, x0 double, x1 double, top double, bottom double")
    marked = documents.marked_chars(chars, rects)
    assert [r.mark for r in marked.orderBy("ord").collect()] == ["underline", "underline", None, "strike", "strike"]
    assert rows(documents.marked_lines(marked), "text") == [("_ab_ ~cd~",)]


def test_first_containing_over_all_hosts(spark):
    have = ["https://a.org/Bills/Detail?id=HB1001&s=2021R", "https://b.org/x/Bills/Detail?id=HB1001&s=2021R&p=2", "https://b.org/Bills/Detail?id=HB1001&s=2021R", "https://c.org/", "https://c.org/é/Bills/Detail?id=😀", None, "https://a.org/Bills/Detail?id=HB1001&s=2021R"]
    nodes = [(n, u, (u or "//").split("/")[2] or None) for n, u in zip((5, 2, 1, 4, 3, 6, 7), have, strict=True)]
    asked = ["/Bills/Detail?id=HB1001&s=2021R", "https://a.org/Bills/Detail?id=HB1001", "/x/Bills/Detail?id=HB1001&s=2021R&p=2", "/é/Bills/Detail?id=%F0%9F%98%80", "/Bills/Detail?id=none", "/", "/e?", None, "", "/Bills/Detail"]
    requests = spark.createDataFrame(list(enumerate(asked)), "n long, wanted string").withColumn("host", F.lit("b.org"))
    nodes = spark.createDataFrame(nodes, "ord long, url string, host string")
    got = {r.n: (r.found_ord, r.found) for r in resolve.first_containing(requests, nodes, "n", "wanted", "url", "ord").collect()}
    key = lambda df, c: [r[0] for r in df.select(resolve.normalize_url(F.col(c))).collect()]
    rows = sorted((r.ord, r.url, k) for r, k in zip(nodes.collect(), key(nodes, "url"), strict=True))
    brute = {n: next((o, u) for o, u, k in rows if w in k) for n, w in enumerate(key(requests, "wanted")) if any(w in k for _, _, k in rows)}
    assert got == brute and got[0][0] == 1 and got[2][0] == 2 and got[3][0] == 3 and 4 not in got and got[7][0] == 1
    own = {r.n: r.found_ord for r in resolve.first_containing(requests.where("n in (0, 2, 3)"), nodes, "n", "wanted", "url", "ord", "host").collect()}
    assert own == {0: 1, 2: 2}


def test_membership_of_one_session_equals_the_general_form(spark):
    """One session an owner: the same as with its start named, for open, closed, several open, unlisted and null rows."""
    rng = random.Random(5)
    days = [D(2020, 1, 1) + dt.timedelta(n) for n in range(0, 1000, 90)]
    for _ in range(3):
        cur = [(o, rng.choice([1, 2, 3, None]), s, rng.choice([None, None, s + dt.timedelta(80)])) for o in range(12) for s in rng.sample(days, 3)] + [(None, 1, days[0], None)]
        sessions = [(o, d) for o in range(9) for d in rng.sample(days, rng.choice([1, 1, 2]))]
        listed = [(o, rng.choice([1, 2, 3, 4, None])) for o in range(12) for _ in range(3)] + [(None, 1)]
        current = spark.createDataFrame(cur, "o int, m int, start date, end date")
        kept = spark.createDataFrame(sessions, "o int, start date").groupBy("o").agg(F.max("start").alias("start"))
        pairs = spark.createDataFrame(listed, "o int, m int")
        got = merge.sync_membership(current, pairs, spark.createDataFrame(sessions, "o int, start date"), "o", "m")
        assert rows(got) == rows(merge.sync_membership(current, pairs.join(kept, "o"), kept, "o", "m"))
        assert rows(merge.sync_membership(got.checkpoint(), pairs, kept, "o", "m")) == rows(got)


def test_scd2_without_broadcasts(spark):
    """Stored and new rows of a key are one line, also where Spark deals both alike and joins by shuffles only."""
    from oracle import SF, same_rows

    from pagemart.plans import queries

    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.unionOutputPartitioning", "true")
    try:
        for name in ("scd2_multi", "scd2_again", "scd2_late"):
            same_rows(queries.QUERIES[name].__wrapped__(spark, SF), queries.SQL[name])
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_scd2_sets_null_keys_aside(spark):
    start = D(2020, 1, 1)
    current = spark.createDataFrame([(1, "a", start, None), (None, "old", start, None)], "k int, v string, start date, end date")
    batch = spark.createDataFrame([(None, "x", D(2021, 1, 1)), (None, "y", D(2022, 1, 1)), (2, "b", D(2021, 1, 1))], "k int, v string, start date")
    for how in ({}, {"at_least_start": True}):
        got = merge.scd2(current, batch, ["k"], ["v"], **how)
        assert rows(got) == sorted([(1, "a", start, None), (None, "old", start, None), (2, "b", D(2021, 1, 1), None)], key=repr)
    assert sorted(r.v for r in merge.unkeyed(batch, ["k"]).collect()) == ["x", "y"] and merge.late(current, batch, ["k"], ["v"]).count() == 0


def test_first_containing_with_hot_pieces(spark):
    """One host and one path in all nodes; pieces that most nodes have are split over tasks."""
    nodes = [(i * 7919 % 600, f"https://h.org/Bills/Detail/Page?id=HB{i}&session=2021R&p={i % 5}") for i in range(600)]
    asked = ["/Bills/Detail/Page?id=HB", "session=2021R&p=3", "/Bills/Detail/Page?id=HB1", "HB59&session=2021R", "/Bills/Detail/Page?id=HC", "&session=2021R&p=9", "Detail", "p=4"]
    requests = spark.createDataFrame(list(enumerate("?" + w if w[0] not in "/?" else w for w in asked)), "n int, wanted string")
    stored = spark.createDataFrame(nodes, "ord int, url string")
    key = lambda df, c: [r[0] for r in df.select(resolve.normalize_url(F.col(c))).collect()]
    have = sorted((o, k) for (o, _), k in zip(nodes, key(stored, "url"), strict=True))
    brute = {n: next(o for o, k in have if w in k) for n, w in enumerate(key(requests, "wanted")) if any(w in k for _, k in have)}
    for hot in (1, 40, resolve.HOT):
        assert {r.n: r.found_ord for r in resolve.first_containing(requests, stored, "n", "wanted", "url", "ord", hot=hot).collect()} == brute
    long = spark.createDataFrame([(0, "https://h.org/" + "ab" * 50_000 + "c")], "ord int, url string")
    assert resolve.first_containing(spark.createDataFrame([(0, "/" + "ab" * 20_000), (1, "/" + "ab" * 20_000 + "d")], "n int, wanted string"), long, "n", "wanted", "url", "ord").count() == 0
    assert resolve.first_containing(requests, stored.limit(0), "n", "wanted", "url", "ord").count() == resolve.first_containing(requests.limit(0), stored, "n", "wanted", "url", "ord").count() == 0


def test_numbers_and_gaps_within_a_hot_group(spark):
    data = [("h" if i % 3 else None if i % 2 else "g", i // 2, i) for i in range(400)]
    df = spark.createDataFrame(data, "host string, ord int, id int").repartition(7)
    got = frontier.numbered_within(df, "host", "ord", "id", out="n").collect()
    expected, seen = {}, {}
    for host, _, i in sorted(data, key=lambda r: (r[0] or "", r[1], r[2])):
        seen[host] = expected[i] = seen.get(host, 0) + 1
    assert {r.id: r.n for r in got} == expected
    before, last = {}, {}
    for host, o, i in sorted(data, key=lambda r: (r[0] or "", r[1], r[2])):
        before.setdefault((host, o), []).append(last.get(host))
        last[host] = o
    found = {}
    for r in frontier.with_previous(df, "host", F.col("ord"), "p").collect():
        found.setdefault((r.host, r.ord), []).append(r.p)
    key = lambda d: {k: sorted(v, key=str) for k, v in d.items()}
    assert key(found) == key(before)


def _page(spark, body):
    return spark.createDataFrame([(1, body)], "elements int, html string")


def test_labels_on_wrapped_pages(spark):
    """Innermost label, its cell, and what stands beside it; the values of the rows around it are not taken."""
    value = lambda label: lambda page: html.let(html.after_label(page, ("td", "th", "div"), label), lambda e: html.text_of(page, e))
    cases = {
        "<div class=row><div>Bill Number:</div><div>HB1</div></div><div class=row><div>Chamber:</div><div>House</div></div>": "HB1",
        "<div><table><tr><td>Bill Number</td><td>HB1</td></tr></table></div><div>no</div>": "HB1",
        "<div class=row><div><b>Bill  number:</b></div></div><div class=row><div>Chamber:</div><div>House</div></div>": None,
        "<table><tr><td><div><b>Bill</b> Number:</div></td><td>HB1</td></tr></table>": "HB1",
        "<p>Bill Number: HB1</p>": None,
        "<div>Bill Numbers</div><div>no</div><div>Bill Number</div><div>HB1</div>": "HB1",
    }
    for body, expected in cases.items():
        assert html.apply_template(_page(spark, body), {"v": value("Bill Number")}, keep=("elements",)).first().v == expected, body
    with pytest.raises(ValueError):
        html.after_label(F.struct(), ("td",), "x" * 100)


def test_counted_sections(spark):
    def found(body, **how):
        return html.apply_template(_page(spark, body), {"v": lambda c: html.counted(c, "Yeas", **how)}, keep=()).first().v

    links = "<a href=/1>a</a><p><b><i><a href=/2>b</a></i></b></p>"
    assert found(f"<b>Yeas : 2</b><div class=voteList>{links}</div>") == ["/1", "/2"]
    assert found(f"<div class=row><b>Yeas : 2</b></div><table><tr><td>{links}</td></tr></table>") == ["/1", "/2"]
    assert found(f"<b>Yeas : 2</b>{links}") is None
    assert found(f"<b>Yeas : 2</b><b>Nays: 2</b><ul>{links}</ul>") is None
    assert found(f"<b>Yeas: 0</b><ul>{links}</ul>") == [] and found(f"<ul>{links}</ul>") is None
    assert found(f"<b>Yeas: 2</b><ul><li>x</ul><div class=k>{links}</div>", containers="div.k") == ["/1", "/2"]


def test_deep_pages(spark):
    """50,000 elements inside one another, with selectors, labels and links over them."""
    import time

    n = 50_000
    body = "<div>" * n + "<b>Label:</b><p>x</p><a href=/l>l</a>" + "</div>" * n
    began = time.time()
    keys = {"n": lambda p: F.size(html.css(p, "div")), "x": "div div p", "l": ("div a", "href"), "v": lambda p: html.let(html.after_label(p, ("b", "p"), "Label"), lambda e: html.text_of(p, e))}
    got = html.apply_template(_page(spark, body), keys, keep=()).first()
    assert (got.n, got.x, got.l, got.v) == (n, ["x"], ["/l"], "x")
    text, rows = html.parsed(body)
    assert text == "Label:xl" and len(rows) == n + 3 and rows[0][1] == n + 2
    assert time.time() - began < 30


def test_texts_are_stretches_of_the_page(spark):
    """Each element's text and own text, against a walk over the pieces."""
    body = "<div> a <b> b1<i>i1 </i></b>c<br> d<script>no <b>x</b></script><p>é &amp; f</div>g<ul><li>1<li>2 <ol><li>2a</ol><li>3</ul> h"
    rows = {(r.tag, r.pos): (r.own, r.text) for r in html.elements(_page(spark, body), "elements").collect()}
    assert [v for _, v in sorted(rows.items(), key=lambda x: x[0][1])] == [("a c d", "a b1i1 c dé & f"), ("b1", "b1i1"), ("i1", "i1"), ("", ""), ("", ""), ("é & f", "é & f"), ("", "12 2a3"), ("1", "1"), ("2", "2 2a"), ("", "2a"), ("2a", "2a"), ("3", "3")]
    long = "word " * 100
    got = html.apply_template(_page(spark, f"<i>x</i><p>{long}</p>"), {"p": "p"}, keep=("elements",)).first()
    assert got.p == [long.strip()] and got.elements == 1


def test_plain_pages_are_read_as_the_parser_reads_them():
    bits = ["<div>", "</div>", "<p>", "<LI class=x>", "<li>", "</LI>", "<ul id='a b'>", "</ul>", "<br>", "<br/>", "<img src=a/b>", "<a href='/x?m=1&s=2&amp;t=3'>", '<a b="&lt;&copy&copyx">', "</a>", " text ", "a\nb", "&amp;", "&lt", "<", "x > y", "<!-- c -->", "<td data-size=''>", "<script>", "</script>", "</h1 >", "<a href=x/>", "<b a=1 A=2>", "<title>", "é ", "</>", "<a-b>", "<i A-B=c>"]

    def slowly(page):
        parser = html._Elements()
        parser.feed(page)
        parser.close()
        return parser.page()

    pick, plain = random.Random(7), 0
    for _ in range(1500):
        page = "".join(pick.choices(bits[: pick.choice((15, 17, 32))], k=pick.choice((2, 5, 12))))
        found = html._plain(page)
        plain += found is not None
        assert html.parsed(page) == (found or slowly(page)) == slowly(page), page
    assert plain > 500


def test_pages_of_a_small_table_are_dealt(spark, monkeypatch):
    from pagemart.plans import page_queries

    monkeypatch.setattr(page_queries, "PAGES", 10)
    assert page_queries._dealt(spark.range(95).coalesce(1), "id").rdd.getNumPartitions() == 10
    assert page_queries._dealt(spark.range(9).coalesce(1), "id").rdd.getNumPartitions() == 1


def test_quotes_in_tags_and_open_comments(spark):
    body = """<h1 title="a > b">Head</h1><a href="/x"><img alt="c > d">T</a><a href='/y' title='">'>U</a><p title="open>V</p><!-- <a href="/z">no</a>"""
    page = spark.createDataFrame([(1, "https://h/", body)], "page_id int, url string, html string")
    assert page.select(html.select_text(F.col("html"), "h1").alias("h")).first().h == ["Head"]
    assert [(r.href, r.text) for r in html.links(page).orderBy("pos").collect()] == [("/x", "T"), ("/y", "U")]


def test_keys_that_collide(spark):
    """Keys of few bits collide, and the report says which and how often; a null is a value of its own."""
    df = spark.createDataFrame([(i, "x") for i in range(300)] + [(None, "x"), (5, "x")], "a long, b string")
    found = {r.key: r["count"] for r in merge.key_collisions(df, ["a", "b"], bits=6).collect()}
    keys = [r[0] for r in df.distinct().select(merge.surrogate_key("a", "b", bits=6)).collect()]
    assert found == {k: keys.count(k) for k in set(keys) if keys.count(k) > 1} and found and max(keys) < 64
    assert merge.key_collisions(df, ["a", "b"]).count() == 0


def test_chain_of_ten_thousand(spark, monkeypatch):
    """Both loops double what they see; circles and unknown parents end."""
    n, rounds = 10_000, []
    chain = [(f"{i}", f"{i - 1}" if i else None, 0, i if i in (0, 7_000) else None) for i in range(n)]
    odd = [("x", "y", 0, None), ("y", "x", 0, None), ("z", "y", 0, None), ("u", "none", 0, None), ("v", "u", 0, 5), ("w", "v", 0, None)]
    children = spark.createDataFrame(chain + odd, "key string, parent_key string, pos int, v long")
    monkeypatch.setattr(trees, "written", lambda df: rounds.append(1) or written(df))
    got = {r.key: (r.depth, r.size, r.pre, r.last, r.post) for r in trees.numbers(children).collect()}
    assert got == {f"{i}": (i, n - i, i + 1, n, n - i) for i in range(n)}
    assert len(rounds) <= 2 * 16
    found = {r.key: r.v for r in trees.nearest(children, "v").collect()}
    assert found == {f"{i}": 0 if i < 7_000 else 7_000 for i in range(n)} | {"x": None, "y": None, "z": None, "u": None, "v": 5, "w": 5}


def test_tree_numbers_of_random_trees(spark):
    """Against a plain walk: forests, ties of pos, null places, a parent with most nodes."""
    r = random.Random(5)
    nodes = [(0, None, 1), (1, None, 0)] + [(i, r.choice([0, 0, r.randrange(i)]), r.choice([None, 1, 2, 3])) for i in range(2, 600)]
    below = collections.defaultdict(list)
    for key, parent, pos in nodes:
        below[parent].append((pos is not None, pos or 0, key))
    want, walk = {}, [(key, 0) for *_, key in sorted(below[None], reverse=True)]
    while walk:
        key, depth = walk.pop()
        want[key] = (depth, len(want) + 1)
        walk += [(k, depth + 1) for *_, k in sorted(below[key], reverse=True)]
    got = trees.numbers(spark.createDataFrame(nodes, "key int, parent_key int, pos int")).collect()
    assert {x.key: (x.depth, x.pre) for x in got} == want and all(x.post == 601 - x.pre for x in got)
    inside = {x.key: (x.pre, x.last) for x in got}
    assert all(inside[p][0] < inside[k][0] <= inside[k][1] <= inside[p][1] for k, p, _ in nodes if p is not None)
    assert trees.numbers(spark.createDataFrame([], "key int, parent_key int, pos int")).count() == 0


def test_tree_numbers_over_parts(spark, monkeypatch):
    """A tour cut into parts of some rows: siblings, chains and circles go on from part to part, and only there are rounds."""
    r = random.Random(6)
    nodes = [("a0", None, 0), ("a1", None, 0), ("a2", None, 0)] + [(f"a{i}", f"a{r.choice([0, 0, i - 1, i - 1, r.randrange(i)])}", r.choice([None, 1, 2])) for i in range(3, 300)]
    odd = [("x", "y", 0), ("y", "x", 0), ("z", "y", 0), ("s", "s", 0), ("u", "none", 0), ("v", "u", 0)] + [(f"c{i}", f"c{(i + 1) % 40}", 0) for i in range(40)]
    children = spark.createDataFrame(nodes + odd, "key string, parent_key string, pos int").repartition(3)
    whole = sorted(trees.numbers(children).collect())
    below = collections.defaultdict(list)
    for key, parent, pos in nodes:
        below[parent].append((pos is not None, pos or 0, key))
    want, walk = {}, [(key, 0) for *_, key in sorted(below[None], reverse=True)]
    while walk:
        key, depth = walk.pop()
        want[key] = (depth, len(want) + 1)
        walk += [(k, depth + 1) for *_, k in sorted(below[key], reverse=True)]
    assert {x.key: (x.depth, x.pre) for x in whole} == want and all(x.last == x.pre + x.size - 1 and x.post == 301 - x.pre for x in whole)
    for part, places in ((7, 500_000), (40, 0)):
        monkeypatch.setattr(trees, "PART", part)
        monkeypatch.setattr(trees, "PLACES", places)
        assert sorted(trees.numbers(children).collect()) == whole
    places = []
    monkeypatch.setattr(trees, "PART", 1000)
    monkeypatch.setattr(trees, "written", lambda df: places.append(df.columns) or written(df))
    chain = spark.createDataFrame([(i, i - 1 if i else None, 0) for i in range(5000)], "key int, parent_key int, pos int")
    assert [x.size for x in sorted(trees.numbers(chain).collect())] == list(range(5000, 0, -1))
    assert places.count(["at", "to", "n", "d"]) <= 7  # by the parts, not by the chain


def test_changed_states_as_the_full_walk(spark):
    r = random.Random(3)
    edges = spark.createDataFrame(sorted({(a, r.randrange(a + 1, 80)) for a in range(79) for _ in range(2)} | {(5, 5)}), "src_key int, dst_key int")
    nodes = spark.createDataFrame([(i, 7 if i < 50 else r.choice([6, 6, 8])) for i in range(80)], "key int, state int")
    nodes = cut(graph.with_open(graph.complete(nodes, edges), edges))
    for _ in range(3):
        changes = spark.createDataFrame([(r.randrange(50, 80), r.choice([8, 8, 8, 6])) for _ in range(12)] + [(99, 8)], "key int, state int")
        changed = cut(graph.changed_states(nodes, edges, changes))
        new = cut(merge.upsert(nodes, changed, ["key"], ["state", "open"], None))
        last = changes.groupBy("key").agg(F.max("state").alias("new"))
        full = nodes.join(last, "key", "left").select("key", F.coalesce("new", "state").alias("state"))
        full = graph.with_open(graph.complete(full, edges), edges)
        assert rows(new, "key", "state", "open") == rows(full, "key", "state", "open")
        assert changed.count() < 80
        nodes = new


def test_marks_in_bins(spark):
    """As each character against each rule: wide rules, wide pages, turned intervals, places that are none."""
    r = random.Random(11)
    place = lambda: r.choice([r.uniform(-50, 900), r.uniform(0, 40_000), float(r.randrange(0, 10) * 36)])
    chars = [("d", r.randrange(2), i, "x", (a := place()), a + r.choice([0.0, 7.5, 36.0, 5_000.0, -3.0]), (t := float(r.randrange(0, 60))), t + 10) for i in range(400)]
    rules = [("d", r.randrange(2), i, (a := place()), a + r.choice([0.0, 20.0, 700.0, 1e9, -4.0]), (t := float(r.randrange(0, 70))), t + r.choice([0.0, 1.0, 4.0, 6.0])) for i in range(150)]
    rules += [("d", 0, 150, float("nan"), 5.0, 1.0, 1.0), ("d", 0, 151, 0.0, float("inf"), 1.0, 1.0), ("d", 1, 152, None, 5.0, 1.0, 1.0), ("e", 1, 153, 0.0, 5.0, 1.0, 1.0)]
    chars += [("d", 0, 400, "x", None, 1.0, 0.0, 10.0), ("f", 0, 401, "x", 0.0, 1.0, 0.0, 10.0)]
    want = {}
    for d, p, i, _, x0, x1, top, bottom in chars:
        want[i] = None
        for d2, p2, _, a, b, t, u in rules[:150]:
            if x0 is not None and (d, p) == (d2, p2) and u - t <= 5 and x0 < b and x1 > a:
                y = (t + u) / 2
                middle, low = abs(y - (top + bottom) / 2), abs(y - bottom)
                want[i] = "strike" if middle <= low and middle <= 2 else "underline" if low < middle and low <= 2 else want[i]
    got = documents.marked_chars(spark.createDataFrame(chars, "doc string, page int, ord int, text string, x0 double, x1 double, top double, bottom double"), spark.createDataFrame(rules, "doc string, page int, ord int, x0 double, x1 double, top double, bottom double"))
    assert {x.ord: x.mark for x in got.collect()} == want and set(want.values()) == {None, "strike", "underline"}


def test_marks_by_rules_of_a_page(spark):
    """Rules without a doc mark as if each document had them, and are not repeated for each."""
    r = random.Random(12)
    chars = [(f"d{i % 7}", r.randrange(2), i // 2, "x", (a := r.uniform(0, 300)), a + 9, (t := float(r.randrange(0, 30))), t + 10) for i in range(300)]
    rules = [(r.randrange(2), i, (a := float(r.randrange(-500, 500, 50))), a + r.choice([40.0, 90.0]), (t := float(r.randrange(0, 40))), t) for i in range(200)]
    chars = spark.createDataFrame(chars, "doc string, page int, ord int, text string, x0 double, x1 double, top double, bottom double")
    rules = spark.createDataFrame(rules, "page int, ord int, x0 double, x1 double, top double, bottom double")
    repeated = rules.join(chars.select("doc", "page").distinct(), "page")
    got = rows(documents.marked_chars(chars, rules), "doc", "page", "ord", "mark")
    assert got == rows(documents.marked_chars(chars, repeated), "doc", "page", "ord", "mark") and len({x[3] for x in got}) == 3

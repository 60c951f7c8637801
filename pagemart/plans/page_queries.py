"""Extraction, page types, templates and rules on pages that Spark makes from the tables, against SQL on those tables."""

from __future__ import annotations

from math import ceil

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart.functions import text, urls
from pagemart.operators import html, resolve, template, validate
from pagemart.plans import page_types
from pagemart.plans.queries import _LINKS, PREFIXES
from pagemart.plans.registry import query, table

HOST = "h.example.org"
#: Rows of a small table that become pages in one task.
PAGES = 20_000


def _dealt(rows: DataFrame, *columns: str) -> DataFrame:
    """Some columns of rows, over as many tasks as pages made of them need: a table of small rows lies in one or two."""
    n = ceil(rows.count() / PAGES)
    rows = rows.select(*columns)
    return rows.repartition(n) if n > 1 else rows


_CLASSES = "CASE " + " ".join(f"WHEN contains(place, '{k}') THEN '{PREFIXES[k]}'" for k in sorted(PREFIXES, key=lambda p: (-len(p), [-ord(x) for x in p]))) + " END"


def _concat(*parts: Column | str) -> Column:
    """Text of columns, named in {}, and literals."""
    return F.concat(*[F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts])


# Selectors.


@query(f"WITH {_LINKS} SELECT page_id, href, count(*) AS n FROM r GROUP BY page_id, href")
def odd_links(spark, sf_dir):
    """Links in single quotes or in none, beside others in comments and scripts."""
    p = table(spark, sf_dir, "pages")
    single = F.regexp_replace("html", '<a href="([^"]*)"', "<A class=k HREF = '$1'")
    bare = F.regexp_replace("html", '<a href="([^"\\s>]+)"', "<a\n title='a > b' href=$1 ")
    odd = F.when(F.col("page_id") % 3 == 0, single).when(F.col("page_id") % 3 == 1, bare).otherwise(F.col("html"))
    noise = F.lit("<!-- <a href=\"/c\">no</a> --><script>var x = '<a href=\"/s\">';</script><style>a[href='/t'] { }</style><a name='n' data-href='/d'>none</a>")
    return html.links(p.withColumn("html", F.concat(noise, odd, noise))).groupBy("page_id", "href").agg(F.count(F.lit(1)).alias("n"))


def _part_pages(spark, sf_dir) -> DataFrame:
    p = _dealt(table(spark, sf_dir, "part"), "p_partkey", "p_name", "p_brand", "p_size", "p_type")
    body = _concat('<div class="box wide"><div class=name>', F.col("p_name"), "<div>", F.col("p_brand"), "</div></div><ul><li>", F.col("p_size"), '<li class="k"><a href="/p/', F.col("p_partkey"), '">', F.col("p_type"), "</a></ul></div><!-- <div>no</div> --><p data-size='", F.col("p_size"), "'>x<p>y")
    return p.select("p_partkey", _concat("https://h/", F.col("p_partkey")).alias("url"), body.alias("html"))


@query("""SELECT p_partkey, p_name || p_brand AS name, p_brand AS brand, CAST(p_size AS VARCHAR) AS first_item, p_type AS link_text, '/p/' || p_partkey AS href,
  CAST(p_size AS VARCHAR) AS size, 'y' AS last_p, 3 AS divs, NULL AS absent, 'div|div|div' AS tags FROM part""")
def css_template(spark, sf_dir):
    """A template of selectors, attributes and functions over pages with nested elements."""
    one = lambda selector: lambda page: text.first_of(html.texts(page, selector))
    keys = {
        "name": one("div.box > div.name"),
        "brand": one(".name div"),
        "first_item": one("ul > li:first-child"),
        "link_text": one("li + li.k a"),
        "href": ("li.k > a[href^='/p/']", "href"),
        "size": ("p[data-size]", "data-size"),
        "last_p": one("p ~ p"),
        "divs": lambda page: F.size(html.css(page, "div")),
        "absent": "h5",
        "tags": html.per_page(lambda page: [e["tag"] for e in page if e["tag"] == "div"]),
    }
    found = html.apply_template(_part_pages(spark, sf_dir), keys, keep=("p_partkey",))
    return found.select("p_partkey", "name", "brand", "first_item", "link_text", F.col("href")[0].alias("href"), F.col("size")[0].alias("size"), "last_p", "divs", F.col("absent")[0].alias("absent"), F.array_join("tags", "|").alias("tags"))


@query("SELECT p_partkey, CASE WHEN p_size % 2 = 0 THEN p_brand END AS found FROM part")
def failing_function(spark, sf_dir):
    """A page function that fails on some pages gives null there."""
    pages = _part_pages(spark, sf_dir)

    def brand(page: list) -> str:
        size = next(e["text"] for e in page if e["tag"] == "li")
        return [e["text"] for e in page if e["tag"] == "div"][2] if int(size) % 2 == 0 else page[99]["text"]

    return html.apply_template(pages, {"found": html.per_page(brand)}, keep=("p_partkey",)).select("p_partkey", F.col("found")[0].alias("found"))


# Element tables.


def _rows_page(spark, sf_dir) -> DataFrame:
    """A page for each supplier: labels, a table with rows, sections of links."""
    s = table(spark, sf_dir, "supplier")
    body = _concat("<table><tr><td><b>Phone:</b></td><td>", F.col("s_suppkey"), "</td></tr><tr><td>Nation</td><td><a href='/n/", F.col("s_nationkey"), "'>N", F.col("s_nationkey"), "</a></td></tr></table><table><tr><td>House</td><td>1/2/2021</td><td> Read  ", F.col("s_name"), "</td><td>v</td></tr><tr><td>Senate</td><td>bad</td><td>Sent</td><td></td></tr></table><div id=nav><a href='/a/", F.col("s_suppkey"), "'>Standing  Committees</a> <p><a href='/b'>Other</a></p></div><div id=next></div><a href='/next/", F.col("s_suppkey"), "'>more</a>")
    return s.select(F.col("s_suppkey").alias("page_id"), _concat("https://h/", F.col("s_suppkey")).alias("url"), body.alias("html"))


@query("SELECT s_suppkey AS page_id, CAST(s_suppkey AS VARCHAR) AS phone, 'N' || s_nationkey AS nation, NULL AS fax, '/n/' || s_nationkey AS href FROM supplier")
def label_values(spark, sf_dir):
    """Labels of a two-column table, and the links beside one."""
    pairs = html.label_values(html.elements(_rows_page(spark, sf_dir)), "page_id")
    values = html.label_value(pairs, "page_id", {"phone": "phone", "nation": "nation", "fax": "fax"})
    links = pairs.where("label = 'Nation'").select("page_id", F.col("hrefs")[0].alias("href"))
    return values.join(links, "page_id")


@query("""SELECT s_suppkey AS page_id, 'house' AS chamber, TIMESTAMP '2021-01-02' AS status_date, 'read ' || lower(s_name) AS history_action, true AS vote_action_present FROM supplier
UNION ALL SELECT s_suppkey, 'senate', NULL, 'sent', false FROM supplier""")
def status_rows(spark, sf_dir):
    """Rows of a table as an array of structs, cleaned, a row each."""
    found = html.table_rows(html.elements(_rows_page(spark, sf_dir)), "page_id", ["chamber", "status_date", "history_action", "vote_action_present"])
    return found.select("page_id", F.explode(template.status_history(F.col("rows"))).alias("s")).select("page_id", "s.*")


@query("""SELECT s_suppkey AS page_id, 'nav' AS kind, '/a/' || s_suppkey AS href FROM supplier UNION ALL SELECT s_suppkey, 'nav', '/b' FROM supplier
UNION ALL SELECT s_suppkey, 'next_page', '/next/' || s_suppkey FROM supplier""")
def link_lists(spark, sf_dir):
    return html.link_lists(html.elements(_rows_page(spark, sf_dir)), "page_id", {"nav": "nav"}, "next")


@query("SELECT s_suppkey AS page_id, '/a/' || s_suppkey AS href FROM supplier")
def nav_links(spark, sf_dir):
    """The first link after an element with an id."""
    return html.link_after(html.elements(_rows_page(spark, sf_dir)), "page_id", "nav")


@query("SELECT s_suppkey AS page_id, '/a/' || s_suppkey AS href FROM supplier UNION ALL SELECT s_suppkey, '/b' FROM supplier")
def named_links(spark, sf_dir):
    return html.links_named(html.links(_rows_page(spark, sf_dir)), ["standing committees", "other"]).select("page_id", "href")


# Page types.


def _member_pages(spark, sf_dir) -> DataFrame:
    c = _dealt(table(spark, sf_dir, "customer"), "c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    digits = F.lpad(F.col("c_custkey").cast("string"), 7, "0")
    body = _concat("<html><body><div><h1>", F.when(F.col("c_nationkey") % 2 == 0, "Senator").otherwise("Representative"), "  Ann ", F.col("c_name"), " (", F.col("c_mktsegment"), ")</h1></div><address> 1  Main &amp; Side </address><table><tr><td><b>Phone:</b></td><td>(501) ", F.substring(digits, 1, 3), "-", F.substring(digits, 4, 4), "</td></tr><tr><td>District:</td><td>", F.col("c_nationkey"), "</td></tr><tr><td>Seniority:</td><td>", F.col("c_custkey") % 40, "</td></tr></table><div id='committees'><ul><li><a href='/Committees/Detail?code=", F.col("c_nationkey"), "&amp;s=2021R'>x</a><li><a href=/Committees/Detail?code=99>y</a></ul></div>")
    return c.select(_concat(f"https://{HOST}/Legislators/Detail?member=", F.col("c_custkey"), "&s=2021R").alias("url"), body.alias("html"))


@query("""SELECT 'https://h.example.org/Legislators/Detail?member=' || c_custkey || '&s=2021R' AS url, '2021R' AS session_code, lower(c_mktsegment) AS party, 'ann' AS first_name, lower(c_name) AS last_name,
  CASE WHEN c_nationkey % 2 = 0 THEN 'senate' ELSE 'house' END AS chamber, '1501' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone, NULL AS email, '1 main & side' AS address, CAST(c_nationkey AS VARCHAR) AS district,
  CAST(c_custkey % 40 AS INTEGER) AS seniority, NULL AS public_service, 'https://h.example.org/Committees/Detail?code=' || c_nationkey || '&s=2021R https://h.example.org/Committees/Detail?code=99' AS committee_urls FROM customer""")
def member_records(spark, sf_dir):
    """Pages of one type to typed records, with session and links resolved."""
    found = page_types.records(_member_pages(spark, sf_dir), HOST, "legislator", "s")
    return found.withColumn("committee_urls", F.array_join("committee_urls", " "))


def _bill_pages(spark, sf_dir) -> DataFrame:
    o = _dealt(table(spark, sf_dir, "orders"), "o_orderkey", "o_custkey", "o_orderdate")
    body = _concat("<h1>AN  ACT ", F.col("o_orderkey"), "</h1><div class=l>Bill Number:</div><div><a href='/x/", F.col("o_orderkey"), ".pdf'>HB", F.col("o_orderkey"), " PDF</a></div><div>Originating Chamber: </div><div><div><b>House</b></div></div><div>Introduction Date:</div><div>", F.date_format("o_orderdate", "M/d/yyyy h:mm:ss a"), "</div><div>Lead Sponsor:</div><div><div><a href='/Legislators/Detail?m=", F.col("o_custkey"), "&s=1'>Lee</a></div></div>")
    return o.select("o_orderkey", _concat(f"https://{HOST}/Bills/Detail?id=HB", F.col("o_orderkey"), "&ddBienniumSession=1997R").alias("url"), body.alias("html"))


@query("""SELECT 'https://h.example.org/Bills/Detail?id=HB' || o_orderkey || '&ddBienniumSession=1997R' AS url, '1997R' AS session_code, 'an act ' || o_orderkey AS title, 'hb' || o_orderkey AS bill_no, '/x/' || o_orderkey || '.pdf' AS bill_no_link,
  NULL AS act_no, 'house' AS orig_chamber, CAST(date_trunc('second', o_orderdate) AS TIMESTAMP) AS intro_date, 'https://h.example.org/Legislators/Detail?m=' || o_custkey || '&s=1' AS sponsor FROM orders""")
def bill_records(spark, sf_dir):
    """Labels whose values stand in the next block, nested blocks among them."""
    found = page_types.records(_bill_pages(spark, sf_dir), HOST, "bill", "ddBienniumSession")
    return found.select("url", "session_code", "title", "bill_no", F.col("bill_no_links")[0].alias("bill_no_link"), "act_no", "orig_chamber", "intro_date", F.array_join("lead_sponsor_urls", " ").alias("sponsor"))


def _vote_pages(spark, sf_dir) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem")
    listed = {name: F.array_sort(F.collect_list(F.when(F.col("l_returnflag") == flag, F.struct("l_linenumber", "l_partkey")))) for name, flag in (("yeas", "A"), ("nays", "N"))}
    votes = lines.where("l_suppkey % 4 = 0").groupBy("l_orderkey").agg(*[c.alias(n) for n, c in listed.items()])
    item = lambda x: F.concat(F.lit("<li><a href='/Legislators/Detail?m="), x.l_partkey.cast("string"), F.lit("&amp;s=1'>A</a>"))
    section = lambda name, label: F.concat(F.lit(f"<p>{label} : "), F.size(name).cast("string"), F.lit("</p><ul>"), F.array_join(F.transform(name, item), ""), F.lit("</ul>"))
    body = F.concat(F.lit("<h1>Senate Vote - Tuesday, February 5, 2013 1:43:39 PM</h1><div>"), section("yeas", "Yeas"), section("nays", "Nays"), F.lit("</div><p>Present: 0</p>"))
    return votes.select(_concat(f"https://{HOST}/Bills/Votes?id=", F.col("l_orderkey"), "&s=2013R").alias("url"), body.alias("html"))


@query("""SELECT 'https://h.example.org/Bills/Votes?id=' || l_orderkey || '&s=2013R' AS url, TIMESTAMP '2013-02-05 13:43:39' AS vote_timestamp, 'senate' AS chamber,
  coalesce(string_agg('https://h.example.org/Legislators/Detail?m=' || l_partkey || '&s=1', ' ' ORDER BY l_linenumber, l_partkey) FILTER (l_returnflag = 'A'), '') AS yeas,
  coalesce(string_agg('https://h.example.org/Legislators/Detail?m=' || l_partkey || '&s=1', ' ' ORDER BY l_linenumber, l_partkey) FILTER (l_returnflag = 'N'), '') AS nays, '' AS present, NULL AS excused
FROM lineitem WHERE l_suppkey % 4 = 0 GROUP BY l_orderkey""")
def vote_records(spark, sf_dir):
    """Counted sections: a list, an empty list for a count of 0, null without the label."""
    found = page_types.records(_vote_pages(spark, sf_dir), HOST, "bill_vote", "s")
    joined = lambda c: F.array_join(c, " ")
    return found.select("url", "vote_timestamp", "chamber", joined("yea_voters").alias("yeas"), joined("nay_voters").alias("nays"), joined("present_voters").alias("present"), joined("excused_voters").alias("excused"))


@query("SELECT 'https://h.example.org/Committees/Detail?code=' || s_suppkey || '&s=2021R' AS url, CAST(s_suppkey AS VARCHAR) AS code, '2021R' AS session_code, lower(s_name) AS name FROM supplier")
def committee_records(spark, sf_dir):
    n = table(spark, sf_dir, "supplier")
    pages = n.select(_concat(f"https://{HOST}/Committees/Detail?code=", F.col("s_suppkey"), "&s=2021R").alias("url"), _concat("<h1> ", F.col("s_name"), "</h1>").alias("html"))
    found = page_types.records(pages, HOST, "committee", "s")
    return found.select("url", urls.query_value(F.col("url"), "code").alias("code"), "session_code", "name")


@query("""SELECT 'https://h.example.org/Bills/ViewBills?s=' || s_nationkey AS url, 'house' AS chamber, string_agg('https://h.example.org/Bills/Detail?id=' || s_suppkey, ' ' ORDER BY s_suppkey) AS bills, '/Bills/ViewBills?p=2' AS next_page FROM supplier GROUP BY s_nationkey""")
def bill_list_records(spark, sf_dir):
    """A list page with links and the page after it."""
    lists = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list("s_suppkey")).alias("n"))
    item = F.array_join(F.transform("n", lambda k: F.concat(F.lit("<a href=/Bills/Detail?id="), k.cast("string"), F.lit(">b</a>"))), "")
    pages = lists.select(_concat(f"https://{HOST}/Bills/ViewBills?s=", F.col("s_nationkey")).alias("url"), F.concat(F.lit("<h1>House Bills</h1><div id=bills><p>"), item, F.lit("</p></div><div id=next><a href='/Bills/ViewBills?p=2'>next</a></div>")).alias("html"))
    return page_types.records(pages, HOST, "bill_list", "s").select("url", "chamber", F.array_join("bill_urls", " ").alias("bills"), "next_page")


@query("""SELECT 'https://h.example.org/Legislators/List?s=' || s_nationkey AS url, 'active_urls' AS kind, 'https://h.example.org/m/' || s_suppkey AS link FROM supplier
UNION ALL SELECT 'https://h.example.org/Bills/SearchByRange?s=' || s_nationkey, 'category_urls', 'https://h.example.org/m/' || s_suppkey FROM supplier""")
def list_records(spark, sf_dir):
    """Lists of members and of categories."""
    lists = table(spark, sf_dir, "supplier").groupBy("s_nationkey").agg(F.array_sort(F.collect_list("s_suppkey")).alias("n"))
    item = F.array_join(F.transform("n", lambda k: F.concat(F.lit("<li><a href='/m/"), k.cast("string"), F.lit("'>m</a>"))), "")
    out = None
    for kind, path, place, column in (("legislator_list", "/Legislators/List", "members", "active_urls"), ("bill_categories", "/Bills/SearchByRange", "categories", "category_urls")):
        pages = lists.select(_concat(f"https://{HOST}{path}?s=", F.col("s_nationkey")).alias("url"), F.concat(F.lit(f"<ul id={place}>"), item, F.lit("</ul><a href='/no'>no</a>")).alias("html"))
        part = page_types.records(pages, HOST, kind, "s").select("url", F.lit(column).alias("kind"), F.explode(column).alias("link"))
        out = part if out is None else out.unionByName(part)
    return out


# Pages as they are: rows around labels, labels inside other elements, links deep inside.


def _wrapped_pages(spark, sf_dir) -> DataFrame:
    """A page for each customer: a wrapped table, rows of blocks, a row without a value, a label that stands alone in its cell."""
    c = _dealt(table(spark, sf_dir, "customer"), "c_custkey", "c_nationkey")
    key, nation = F.col("c_custkey"), F.col("c_nationkey")
    row = lambda label, *value: ["<div class='row x'><div class=l>", label, "</div><div>", *value, "</div></div>"]
    body = _concat(
        "<div id=all><div class=wrap><table><tbody><tr><td><div><b>Phone:</b></div></td><td><p>555-", key, "</p></td></tr><tr><td>Phone Book:</td><td>no</td></tr></tbody></table></div>",
        *row("<b>Bill</b> Number:", "<span>HB<i>", key, "</i></span><div><a href='/x/", key, ".pdf'>PDF</a></div>"),
        "<div class='row x'><div class=l><b>Act Number:</b></div></div>",
        *row("Originating Chamber:", "<b>", F.when(nation % 2 == 0, "House").otherwise("Senate"), "</b>"),
        *row("Lead Sponsor (a+b):", "<div><div><div><ul><li><a href='/m/", nation, "'>Lee</a></ul></div></div></div>"),
        "<section><div class=lab><b>District:</b></div><div>", nation, "</div></section></div>",
    )
    return c.select("c_custkey", body.alias("html"))


@query("""SELECT c_custkey, '555-' || c_custkey AS phone, 'HB' || c_custkey || 'PDF' AS bill_no, '/x/' || c_custkey || '.pdf' AS bill_link, NULL AS act_no,
  CASE WHEN c_nationkey % 2 = 0 THEN 'House' ELSE 'Senate' END AS chamber, '/m/' || c_nationkey AS sponsor, CAST(c_nationkey AS VARCHAR) AS district, NULL AS fax FROM customer""")
def wrapped_labels(spark, sf_dir):
    """Labels in rows, in cells of wrapped tables and in <b>, and a label without a value."""
    value = lambda label: lambda page: html.let(html.after_label(page, ("td", "th", "div"), label), lambda e: html.text_of(page, e))
    link = lambda label: lambda page: html.let(html.after_label(page, ("td", "th", "div"), label), lambda e: html.inside(page, e, "href")[0])
    keys = {"phone": value("Phone"), "bill_no": value("Bill Number"), "bill_link": link("Bill Number"), "act_no": value("Act Number"), "chamber": value("Originating Chamber"), "sponsor": link("Lead Sponsor (a+b)"), "district": value("District"), "fax": value("Fax")}
    return html.apply_template(_wrapped_pages(spark, sf_dir), keys, keep=("c_custkey",))


@query("""SELECT l_orderkey, string_agg('/m/' || l_partkey, ' ' ORDER BY l_linenumber, l_partkey) AS yeas, '/n/' || l_orderkey AS nays, NULL AS absent, '' AS present, NULL AS excused
FROM lineitem WHERE l_suppkey % 4 = 0 GROUP BY l_orderkey""")
def vote_containers(spark, sf_dir):
    """Counted sections in blocks and tables, with members deep inside; a count over 0 without a container is null."""
    votes = table(spark, sf_dir, "lineitem").where("l_suppkey % 4 = 0").groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey"))).alias("v"))
    member = lambda x: F.concat(F.lit("<div><p><span><a href='/m/"), x.l_partkey.cast("string"), F.lit("'>A</a></span></p></div>"))
    body = F.concat(
        F.lit("<a href='/before'>b</a><div class=row><div><b>Yeas : "), F.size("v").cast("string"), F.lit("</b></div></div><div class='a voteList'>"), F.array_join(F.transform("v", member), ""),
        F.lit("</div><div class=row><b>Nays: 1</b></div><table><tr><td><div><a href='/n/"), F.col("l_orderkey").cast("string"),
        F.lit("'>B</a></div></td></tr></table><p>Absent: 2</p><p>none listed</p><p>Present: 0</p><ul><li><a href='/after'>c</a></ul>"),
    )
    keys = {name: (lambda label: lambda page: F.array_join(html.counted(page, label), " "))(name.capitalize()) for name in ("yeas", "nays", "absent", "present", "excused")}
    return html.apply_template(votes.select("l_orderkey", body.alias("html")), keys, keep=("l_orderkey",))


@query("""SELECT s_suppkey AS page_id, 'section' AS kind, '/a/' || s_suppkey AS href FROM supplier UNION ALL SELECT s_suppkey, 'section', '/b' FROM supplier UNION ALL SELECT s_suppkey, 'cell', '/c/' || s_nationkey FROM supplier UNION ALL SELECT s_suppkey, 'css', '/a/' || s_suppkey FROM supplier""")
def deep_links(spark, sf_dir):
    """Links of a section, of a table's cell and of a selector, five levels down."""
    s = table(spark, sf_dir, "supplier")
    body = _concat("<a href='/out'>o</a><div id=s><div><ul><li><p><b><a href='/a/", F.col("s_suppkey"), "' class='k, l'>A</a></b></p></ul></div><a href='/b'>B</a></div><a href='/out'>o</a><table><tr><td>Links</td><td><div><div><ul><li><a href='/c/", F.col("s_nationkey"), "'>C</a></ul></div></div></td></tr></table>")
    pages = s.select(F.col("s_suppkey").alias("page_id"), body.alias("html"))
    rows = html.elements(pages)
    section = html.links_within(rows, "page_id", "s").select("page_id", F.lit("section").alias("kind"), "href")
    cell = html.label_values(rows, "page_id").where("label = 'Links'").select("page_id", F.lit("cell").alias("kind"), F.explode("hrefs").alias("href"))
    css = html.apply_template(pages, {"href": ("div#s ul a[class=\"k, l\"]", "href")}, keep=("page_id",)).select("page_id", F.lit("css").alias("kind"), F.explode("href").alias("href"))
    return section.unionByName(cell).unionByName(css)


@query("""SELECT p_partkey, 'c' AS last, p_name || ' ' || p_brand AS not_first, p_brand AS second_b, 'a c' AS words, '3' AS nested FROM part""")
def more_selectors(spark, sf_dir):
    """:not, :last-child, :nth-of-type, words of attributes, elements inside one another."""
    p = _dealt(table(spark, sf_dir, "part"), "p_partkey", "p_name", "p_brand")
    body = _concat("<ul><li class='x one'>a</li><li class='y'>b<li class='x'>c</ul><p><i>1</i><b>", F.col("p_name"), "</b><i>2</i><b>", F.col("p_brand"), "</b></p><div><div><div><u>3</u></div></div></div>")
    joined = lambda selector: lambda page: F.array_join(html.texts(page, selector), " ")
    keys = {"last": joined("li:last-child"), "not_first": joined("p > :not(i, u)"), "second_b": joined("p b:nth-of-type(2):last-child"), "words": joined("li[class~='x']"), "nested": joined("div div div u:only-child")}
    return html.apply_template(p.select("p_partkey", body.alias("html")), keys, keep=("p_partkey",))


# Template rules.


@query("SELECT c_custkey, lower(c_name) AS c_name, c_nationkey FROM customer")
def strict_projection(spark, sf_dir):
    """A projection that knows each of its columns; one that it does not know would be an error."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    return template.project(rows, {"c_name": lambda c: text.normalize_str(c, strict=True), "c_nationkey": text.identity}, keep=("c_custkey",), strict=True)


@query("""SELECT 'legislator' AS page_type, count(*) AS n FROM customer UNION ALL SELECT 'bill', count(*) FROM orders UNION ALL
SELECT CASE WHEN contains(string_split(string_split(url, '?')[1], '#')[1], 'h.example.org') THEN 'home' ELSE '-' END, count(*) FROM pages GROUP BY 1""")
def typed_pages(spark, sf_dir):
    """Pages with the type that their url says; pages of another site have none."""
    pages = _member_pages(spark, sf_dir).select("url").unionByName(_bill_pages(spark, sf_dir).select("url")).unionByName(table(spark, sf_dir, "pages").select("url"))
    return page_types.with_page_type(pages, HOST).groupBy(F.coalesce("page_type", F.lit("-")).alias("page_type")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT o_orderkey, concat_ws(',', CASE WHEN o_orderkey % 3 = 0 THEN 'n' END, CASE WHEN o_custkey % 2 = 0 THEN 'day' END) AS errors FROM orders""")
def transform_errors(spark, sf_dir):
    """Which columns of a record had a value that could not be read."""
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.when(F.col("o_orderkey") % 3 == 0, "x").otherwise(F.col("o_orderkey").cast("string")).alias("n"), F.when(F.col("o_custkey") % 2 == 0, "13/45/2020").otherwise("1/2/2020").alias("day"))
    clean = template.project(raw, {"n": text.to_int, "day": text.to_local_time}, keep=("o_orderkey",))
    return template.with_errors(raw, clean, "o_orderkey", ["n", "day"]).select("o_orderkey", F.array_join("errors", ",").alias("errors"))


@query("""SELECT p_partkey AS p_p_partkey, CASE WHEN p_size % 2 = 0 THEN '{"' || p_brand || '":["' || p_size || '"]}' END AS p_documents, '{"brand":"' || p_brand || '","size":' || p_size || '}' AS p_one, '{"size":' || p_size || '}' AS p_first, '2021-01-11' AS p_day FROM part""")
def parameters(spark, sf_dir):
    """Maps, structs, arrays of them and dates as parameters of a statement."""
    size = F.col("p_size").cast("string")
    filled = F.create_map("p_brand", F.array(size))
    df = table(spark, sf_dir, "part").select("p_partkey", F.when(F.col("p_size") % 2 == 0, filled).otherwise(F.map_filter(filled, lambda k, v: F.lit(False))).alias("documents"), F.struct(F.col("p_brand").alias("brand"), F.col("p_size").alias("size")).alias("one"), F.array(F.struct(F.col("p_size").alias("size"))).alias("first"), F.lit("2021-01-11").cast("date").alias("day"))
    return template.as_parameters(df).withColumn("p_first", F.col("p_first")[0])


@query("""SELECT p_partkey, p_name AS kept, lower(p_name) AS cleaned FROM part""")
def combined_template(spark, sf_dir):
    """Selectors, transforms and lookups of one template, each used in its place."""
    how = template.Template(selectors={"kept": ".raw", "cleaned": ".raw"}, transforms={"kept": text.identity, "cleaned": text.normalize_str})
    pages = table(spark, sf_dir, "part").select("p_partkey", _concat("<p class=raw>", F.col("p_name"), "</p>").alias("html"))
    raw = html.apply_template(pages, how.selectors, keep=("p_partkey",))
    return template.project(raw.withColumns({c: text.first_of(F.col(c)) for c in how.selectors}), how.transforms, keep=("p_partkey",))


@query("""WITH c AS (SELECT c_custkey, c_nationkey, CASE c_custkey % 4 WHEN 0 THEN 'http://a.b' WHEN 1 THEN 'http://a.b/' WHEN 2 THEN 'ftp://a.b' END AS base FROM customer)
SELECT c_custkey, concat_ws(',', CASE WHEN c_custkey % 4 <> 0 THEN 'base' END, CASE WHEN c_nationkey % 2 = 0 THEN 'path' END, CASE WHEN c_nationkey % 3 = 0 THEN 'paths' END, CASE WHEN c_nationkey % 3 = 1 THEN 'urls' END,
  CASE WHEN c_custkey % 5 = 0 THEN 'number' END, CASE WHEN c_custkey % 6 = 0 THEN 'email' END, CASE WHEN c_custkey % 7 = 0 THEN 'phone' END, CASE WHEN c_custkey % 8 = 1 THEN 'sizes' END, CASE WHEN c_custkey % 9 = 0 THEN 'blank' END) AS broken FROM c""")
def rule_kinds(spark, sf_dir):
    """Rules on urls, paths, lists, numbers, mail, phones, lengths and blanks, all messages of a row."""
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    rows = table(spark, sf_dir, "customer").select(
        "c_custkey",
        F.when(k % 4 == 0, "http://a.b").when(k % 4 == 1, "http://a.b/").when(k % 4 == 2, "ftp://a.b").alias("base"),
        F.when(n % 2 == 0, "p").otherwise("/p").alias("path"),
        F.array(F.lit("/a"), F.when(n % 3 == 0, "b").otherwise("/b")).alias("paths"),
        F.array(F.lit("http://a"), F.when(n % 3 == 1, "b").otherwise("https://b")).alias("links"),
        F.when(k % 5 == 0, "4.5").otherwise("45").alias("number"),
        F.when(k % 6 == 0, "a@b").otherwise("a@b.c").alias("email"),
        F.when(k % 7 == 0, "12").when(k % 7 == 1, None).otherwise("(501) 555-1234").alias("phone"),
        F.when(k % 8 == 1, F.array(F.lit(1))).otherwise(F.array(F.lit(1), F.lit(2))).alias("sizes"),
        F.when(k % 9 == 0, " ").otherwise("x").alias("blank"),
    )
    rules = {"base": validate.base_url(F.col("base")), "path": validate.path(F.col("path")), "paths": validate.all_paths(F.col("paths")), "urls": validate.all_urls(F.col("links")), "number": validate.whole_number(F.col("number")), "email": validate.email(F.col("email")), "phone": validate.phone(F.col("phone"), nullable=True), "sizes": validate.same_size(F.col("sizes"), F.col("paths")), "blank": validate.not_blank(F.col("blank"))}
    return validate.with_errors(rows, rules).select("c_custkey", F.array_join("errors", ",").alias("broken"))


@query("""SELECT event_id FROM events WHERE props IS NOT NULL AND json_extract_string(props, '$.k') = '1' AND event_type = 'click'""")
def attribute_match(spark, sf_dir):
    """Nodes that have some keys, one of any value, and an attribute."""
    events = table(spark, sf_dir, "events").where("props IS NOT NULL")
    data = F.from_json("props", "map<string,string>")
    first = events.where(validate.matches(data, {"k": None}, {"event_type": "click"}))
    return resolve.all_matches(first, validate.matches(data, {"k": "1"})).select("event_id")


@query("SELECT page_id, url FROM pages WHERE contains(url, '?') ORDER BY page_id LIMIT 1")
def first_match(spark, sf_dir):
    return resolve.first_match(table(spark, sf_dir, "pages"), F.contains("url", F.lit("?")), "page_id").select("page_id", "url")


@query("SELECT page_id, CASE WHEN regexp_matches(url, '[&?]utm_source=') THEN regexp_extract(url, '^(.*)[&?]utm_source=.*$', 1) ELSE url END || ' ' || 'https://h/x' AS bare, url AS same, CASE WHEN regexp_matches(url, '[&?]utm_source=') THEN regexp_extract(url, '^.*[&?]utm_source=(.*)$', 1) END AS session_code FROM pages")
def own_session(spark, sf_dir):
    """The session that a page's own url names, its list of links without it, and what passes untouched."""
    u = F.col("url")
    found = urls.with_session(table(spark, sf_dir, "pages"), "utm_source")
    return found.select("page_id", F.array_join(urls.without_trailing_params(F.array(u, F.lit("https://h/x?utm_source=feed")), "utm_source"), " ").alias("bare"), text.identity(u).alias("same"), "session_code")


@query("""SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN '1501' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') WHEN 1 THEN '1501' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') WHEN 2 THEN '5551234' WHEN 3 THEN NULL WHEN 4 THEN '15015551234' ELSE '15015551234' || '501555' END AS phone,
  CASE c_custkey % 6 WHEN 0 THEN c_custkey WHEN 1 THEN -c_custkey WHEN 2 THEN 7 END AS n FROM customer""")
def number_shapes(spark, sf_dir):
    """Phone numbers and whole numbers as people write them."""
    k, d = F.col("c_custkey") % 6, F.lpad(F.col("c_custkey").cast("string"), 7, "0")
    phone = F.when(k == 0, F.concat(F.lit("501."), d)).when(k == 1, F.concat(F.lit(" 501 - "), F.substring(d, 1, 3), F.lit("/"), F.substring(d, 4, 4))).when(k == 2, "555-1234").when(k == 3, "n/a").when(k == 4, "+1 501 555 1234").otherwise("1 (501) 555-1234 501555")
    number = F.when(k == 0, F.concat(F.lit("  +"), "c_custkey", F.lit(" "))).when(k == 1, F.concat(F.lit("-"), "c_custkey")).when(k == 2, "007").when(k == 3, "25.7").when(k == 4, "")
    return table(spark, sf_dir, "customer").select("c_custkey", text.phone(phone).alias("phone"), text.to_int(number).cast("long").alias("n"))


@query("""SELECT p_partkey, CASE WHEN p_size % 3 = 0 THEN lower(p_brand) WHEN p_size % 3 = 1 THEN lower(p_name) END AS first FROM part""")
def normalize_one(spark, sf_dir):
    """The first of a list, cleaned; null for an empty list and for none."""
    lists = F.when(F.col("p_size") % 3 == 0, F.array(F.concat(F.lit("  "), "p_brand", F.lit("\u00a0")), F.col("p_name"))).when(F.col("p_size") % 3 == 1, F.array("p_name")).when(F.col("p_size") % 2 == 0, F.array().cast("array<string>"))
    return table(spark, sf_dir, "part").select("p_partkey", text.normalize_one(lists).alias("first"))


@query("""SELECT a.page_id, a.page_id % 2 = 0 AS same, a.page_id % 3 <> 0 AS inside, a.page_id % 5 <> 0 AS listed FROM pages a""")
def compare_values(spark, sf_dir):
    """Equal values, urls that contain another's path and query, lists that have a value."""
    k, u = F.col("page_id"), F.col("url")
    other = F.when(k % 3 != 0, F.concat(F.lit("https://elsewhere.org"), F.regexp_extract(u, r"^[A-Za-z]+://[^/?#]*([^#]*)", 1))).otherwise("https://elsewhere.org/none?x=1")
    return table(spark, sf_dir, "pages").select("page_id", resolve.same_value(k, F.when(k % 2 == 0, k)).alias("same"), resolve.same_value(u, other, "url").alias("inside"), resolve.same_value(F.array(u, F.lit("x")), F.when(k % 5 != 0, u), "list").alias("listed"))


@query(f"""SELECT page_id, {_CLASSES} AS page_type FROM (SELECT page_id, regexp_extract(url, '^[A-Za-z]+://([^?#]*)', 1) AS place FROM pages)""")
def classify_by_table(spark, sf_dir):
    """The longest prefix, of a table of page types, that host and path contain."""
    types = spark.createDataFrame(list(PREFIXES.items()), "prefix string, page_type string")
    return urls.classify_by_table(table(spark, sf_dir, "pages"), types).select("page_id", "page_type")

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagemart.functions import text, urls


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first().x


def of(spark, f, value, *args, **kw):
    return one(spark, f(F.lit(value).cast("string"), *args, **kw))


def test_spaces(spark):
    assert of(spark, text.normalize_str, "  A  b\tC  ") == "a b c"
    assert of(spark, text.normalize_str, None) is None
    assert of(spark, text.normalize_str, "Rep. Ann", "Rep.") == "ann"


def test_lists(spark):
    assert one(spark, text.normalize_list(F.array(F.lit(" A "), F.lit(None), F.lit("b")))) == ["a", "b"]
    assert one(spark, text.normalize_list(F.array().cast("array<string>"))) is None
    assert one(spark, text.first_of(F.array().cast("array<string>"))) is None
    with pytest.raises(Exception, match="more than one"):
        one(spark, text.first_of(F.array(F.lit("a"), F.lit("b")), strict=True))


@pytest.mark.parametrize(("given", "expected"), [(" 25 ", 25), ("+5", 5), ("25.7", None), ("x", None), ("", None), (None, None)])
def test_to_int(spark, given, expected):
    assert of(spark, text.to_int, given) == expected


@pytest.mark.parametrize(("given", "expected"), [("(501) 555-1234", "15015551234"), ("1-501-555-1234", "15015551234"), ("555-1234", "5551234"), ("", None), (None, None)])
def test_phone(spark, given, expected):
    assert of(spark, text.phone, given) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("Senator Ann de Lee (D)", ("d", "ann", "de lee", "senate")),
        ("Representative  Cher (R)", ("r", None, "cher", "house")),
        ("Ann Lee", (None, "ann", "lee", None)),
        ("D) Lee", (None, "d)", "lee", None)),
    ],
)
def test_title(spark, given, expected):
    assert tuple(of(spark, text.title_parts, given)) == expected


@pytest.mark.parametrize(
    ("given", "expected"),
    [
        ("1/5/2021 2:03:04 PM", dt.datetime(2021, 1, 5, 14, 3, 4)),
        ("01/05/2021 2:03:04 pm", dt.datetime(2021, 1, 5, 14, 3, 4)),
        (" 12/31/2020 ", dt.datetime(2020, 12, 31)),
        ("12/31/20", None),
        ("13/31/2020", None),
        ("2020-12-31", None),
        ("", None),
        (None, None),
    ],
)
def test_dates(spark, given, expected):
    assert of(spark, text.to_local_time, given) == expected


def test_strict_date(spark):
    with pytest.raises(Exception, match="not a date"):
        of(spark, text.to_local_time, "soon", strict=True)


def test_instants(spark):
    assert one(spark, text.to_instant(F.lit("2024-07-01 12:00:00").cast("timestamp_ntz"))) == dt.datetime(2024, 7, 1, 17)
    assert one(spark, text.to_instant(F.lit("2024-11-03 01:59:59").cast("timestamp_ntz"))) == dt.datetime(2024, 11, 3, 6, 59, 59)


def test_vote_title(spark):
    got = of(spark, text.vote_title, "House Vote - Tuesday, February 5, 2013 1:43:39 PM")
    assert tuple(got) == (dt.datetime(2013, 2, 5, 13, 43, 39), "house")
    assert tuple(of(spark, text.vote_title, "A vote")) == (None, None)


def test_unescape(spark):
    assert of(spark, text.unescape, "a &amp;lt; &lt;b&gt; &#39;c&#39; &quot;") == "a &lt; <b> 'c' \""
    rows = spark.createDataFrame([("&eacute;&amp;&hearts;",), (None,)], "s string")
    assert [r.x for r in rows.select(text.unescape_all(F.col("s")).alias("x")).collect()] == ["é&♥", None]


def test_urls(spark):
    u = "https://h.example.org:80/a/b?x=1&amp;param=2021R#f"
    assert of(spark, urls.base_path, u) == "https://h.example.org:80/a/b"
    assert of(spark, urls.base_path, "nonsense") is None
    assert of(spark, urls.unquote, "a%20b+c") == "a b+c"
    assert of(spark, urls.unquote, "50%_") == "50%_"
    assert of(spark, urls.normalize_url, "") == ""
    assert of(spark, urls.normalize_url, "/a%20b?c=1#x") == "/a b?c=1"
    assert of(spark, urls.trailing_param, "/p?a=1&param=2021%2FR", "param") == "2021/R"
    assert of(spark, urls.without_trailing_param, "/p?param=2021", "param") == "/p"
    assert of(spark, urls.query_value, "/c?code=A12&x=1", "code") == "A12"
    assert of(spark, urls.query_value, "/c?x=1", "code") is None


@pytest.mark.parametrize("href", ["/x", "x", "../x", "./x/../y?q=1", "?q=2", "#t", "//o.example.net/z", "https://o.example.net/", "", "../../../up", "a/./b/", ".."])
def test_resolve_like_the_standard_library(spark, href):
    from urllib.parse import urljoin

    base = "https://h.example.org/a/b/c?d=1"
    assert one(spark, urls.resolve(F.lit(base), F.lit(href))) == urljoin(base, href)


def test_classify_both_ways(spark):
    types = {"h.org/": "home", "h.org/bills": "bills", "h.org/bills/votes": "votes"}
    rows = spark.createDataFrame([("https://h.org/bills/votes/3",), ("https://h.org/bills",), ("https://h.org/x",), ("https://z.org/",)], "url string")
    by_rule = {r.url: r.t for r in rows.select("url", urls.classify(F.col("url"), types).alias("t")).collect()}
    table = spark.createDataFrame(list(types.items()), "prefix string, page_type string")
    assert by_rule == {r.url: r.page_type for r in urls.classify_by_table(rows, table).collect()}
    assert list(by_rule.values()) == ["votes", "bills", "home", None]


def test_references_that_are_cut_off_stay_where_only_closed_ones_count(spark):
    rows = spark.createDataFrame([("a &amp; b&amp",), ("&lt;&#65;&notit;&copy",), ("&amp;quot;",), (None,)], "s string")
    read = lambda closed: [r.x for r in rows.select(text.unescape_all(F.col("s"), closed).alias("x")).collect()]
    assert read(True) == ["a & b&amp", "<A&notit;&copy", "&quot;", None]
    assert read(False) == ["a & b&", "<A¬it;©", "&quot;", None]

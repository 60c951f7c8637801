"""URLs as column expressions. Null and unreadable URLs give null."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart.functions.text import unescape

#: Fixed: scheme, authority, path, query and fragment of a URL.
PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?(#.*)?$"
#: Authority and path of such a URL, as one.
PLACE = r"^[^:]*://([^?#]*)"


def part(url: Column, n: int) -> Column:
    return F.when(url.rlike(PARTS), F.regexp_extract(url, PARTS, n))


def base_path(url: Column, with_path: bool = True) -> Column:
    """scheme://authority, and the path; no query, no fragment."""
    head = F.concat(part(url, 1), F.lit("://"), part(url, 2))
    return F.concat(head, part(url, 3)) if with_path else head


def host(url: Column) -> Column:
    return part(url, 2)


def unquote(c: Column) -> Column:
    """Percent-decoded; + stays; text with a malformed escape stays as it is."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def normalize_url(url: Column) -> Column:
    """Path, ? and query, unescaped and decoded; empty for null or empty."""
    plain = unescape(url)
    path = F.coalesce(part(plain, 3), F.regexp_extract(plain, r"^([^?#]*)", 1))
    query = F.regexp_extract(plain, r"^[^?#]*\?([^#]*)", 1)
    return F.when(F.coalesce(F.length(url), F.lit(0)) == 0, "").otherwise(unquote(F.concat(path, F.lit("?"), query)))


def url_key(url: Column) -> Column:
    """The one spelling under which a URL is known."""
    return unquote(unescape(url))


def trailing_param(url: Column, name: str, strict: bool = False) -> Column:
    """The value of a parameter that ends the URL (its last occurrence); null or an error without it."""
    found = F.regexp_extract(unquote(url), rf"^(?:.*)[&?]{name}=(.*)$", 1)
    has = unquote(url).rlike(rf"[&?]{name}=")
    out = F.when(has, found)
    return F.when(url.isNotNull() & ~has, F.raise_error(F.concat(F.lit(f"no {name} in "), url))).otherwise(out) if strict else out


def without_trailing_param(url: Column, name: str) -> Column:
    """The URL before that parameter; the URL itself if it has none."""
    found = F.regexp_extract(unquote(url), rf"^(.*)[&?]{name}=.*$", 1)
    return F.when(unquote(url).rlike(rf"[&?]{name}="), found).otherwise(url)


def without_trailing_params(urls: Column, name: str) -> Column:
    return F.transform(urls, lambda u: without_trailing_param(u, name))


def query_value(url: Column, name: str) -> Column:
    """The letters and digits of a parameter anywhere in the query; null without it."""
    found = F.regexp_extract(url, rf"{name}=([0-9A-Za-z]+)", 1)
    return F.when(found != "", found)


def classify(url: Column, prefixes: dict[str, str]) -> Column:
    """The type of the longest prefix that host and path contain; null if none does."""
    place = F.when(url.rlike(PARTS), F.regexp_extract(url, PLACE, 1))

    def longest(place: Column) -> Column:
        out = F.lit(None).cast("string")
        for prefix in sorted(prefixes, key=lambda p: (len(p), p)):
            out = F.when(place.contains(prefix), prefixes[prefix]).otherwise(out)
        return out

    return F.get(F.transform(F.array(place), longest), F.lit(0))  # the place is computed once, not for each prefix


def classify_by_table(urls: DataFrame, types: DataFrame, url_col: str = "url", most: int = 1000) -> DataFrame:
    """The same with the prefixes of a table (prefix, page_type): urls with page_type.

    The table is small by nature, a row for each page type; one of more than
    `most` rows is an error, so what the driver reads is bounded.
    """
    found = types.select("prefix", "page_type").limit(most + 1).collect()
    if len(found) > most:
        raise ValueError(f"more than {most} page types")
    return urls.withColumn("page_type", classify(F.col(url_col), {r["prefix"]: r["page_type"] for r in found}))


def _squeeze(path: Column) -> Column:
    """Without . and .. segments."""
    segments = F.split(path, "/")
    kept = F.aggregate(segments, F.array().cast("array<string>"), lambda done, s: F.when(s == ".", done).when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(1)))).otherwise(F.array_append(done, s)))
    end = F.when(F.element_at(segments, -1).isin(".", ".."), "/").otherwise("")
    return F.concat(F.array_join(kept, "/"), end)


def resolve(base: Column, href: Column) -> Column:
    """href as seen from the page at base: absolute, //host, /path, ?query, #fragment or relative."""
    head, path, query = base_path(base, False), part(base, 3), F.coalesce(part(base, 4), F.lit(""))
    folder = F.regexp_replace(F.when(path == "", "/").otherwise(path), r"[^/]*$", "")
    ref_path = F.regexp_extract(href, r"^[^?#]*", 0)
    rest = F.substr(href, F.length(ref_path) + 1)
    absolute = F.when(ref_path.startswith("/"), ref_path).otherwise(F.concat(folder, ref_path))
    return (
        F.when(href.isNull() | base.isNull(), None)
        .when(href == "", F.concat(head, path, query))
        .when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:"), href)
        .when(href.startswith("//"), F.concat(part(base, 1), F.lit(":"), href))
        .when(href.startswith("?"), F.concat(head, path, href))
        .when(href.startswith("#"), F.concat(head, path, query, href))
        .otherwise(F.concat(head, _squeeze(absolute), rest))
    )


def with_session(pages: DataFrame, name: str, url_col: str = "url", out: str = "session_code") -> DataFrame:
    """pages with the session that each page's own URL names."""
    return pages.withColumn(out, trailing_param(F.col(url_col), name))

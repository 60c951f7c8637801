"""Cleaning of strings, numbers and dates as column expressions.

Every function takes and returns a Column. Null stays null. Where a function has
`strict`, a value that cannot be read raises an error at run time instead of
becoming null.
"""

from __future__ import annotations

import html
import re
from html.entities import html5

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed: everything that counts as white space, inside a character class.
SPACE = r"\t-\r\x1c-\x20\x85\p{Z}"
#: Fixed: named character references that are read without a Python table.
ENTITIES = {"lt": "<", "gt": ">", "quot": '"', "apos": "'", "nbsp": " ", "middot": "·", "copy": "©", "mdash": "—", "ndash": "–", "hellip": "…"}
#: Fixed: the zone of wall-clock times.
ZONE = "America/Chicago"


def _or_raise(value: Column, source: Column, what: str, strict: bool) -> Column:
    if not strict:
        return value
    return F.when(value.isNull() & source.isNotNull(), F.raise_error(F.concat(F.lit(f"not {what}: "), source.cast("string")))).otherwise(value)


def normalize_space(c: Column) -> Column:
    """Runs of white space become one space; none at the ends."""
    return F.trim(F.regexp_replace(c, f"[{SPACE}]+", " "))


def normalize_str(c: Column, remove: str | None = None, strict: bool = False) -> Column:
    """Without a substring (case matters), white space normalised, lower case. strict: null is an error."""
    out = F.lower(normalize_space(F.replace(c, F.lit(remove)) if remove else c))
    return F.when(c.isNull(), F.raise_error(F.lit("no text"))).otherwise(out) if strict else out


def first_of(arr: Column, strict: bool = False) -> Column:
    """The first element; null for null or empty. strict: more than one is an error."""
    first = F.try_element_at(arr, F.lit(1))
    if not strict:
        return first
    return F.when(F.size(arr) > 1, F.raise_error(F.lit("more than one element"))).otherwise(first)


def normalize_one(arr: Column, remove: str | None = None, strict: bool = False) -> Column:
    """normalize_str of the first element of a list; null for null or empty. strict: more than one is an error."""
    return normalize_str(first_of(arr, strict), remove)


def normalize_list(arr: Column, remove: str | None = None) -> Column:
    """normalize_str of each element, nulls dropped; an empty list is null."""
    out = F.filter(F.transform(arr, lambda x: normalize_str(x, remove)), lambda x: x.isNotNull())
    return F.when(F.size(out) > 0, out)


def normalize_pairs(arr: Column) -> Column:
    """Of (text, link) pairs those with both; texts normalised, links as they are; empty is null."""
    both = F.filter(arr, lambda x: (F.length(x.text) > 0) & (F.length(x.link) > 0))
    return F.when(F.size(arr) > 0, F.transform(both, lambda x: F.struct(normalize_str(x.text).alias("text"), x.link.alias("link"))))


def identity(c: Column) -> Column:
    """The column itself."""
    return c


def to_int(c: Column, strict: bool = False) -> Column:
    """Whole numbers, with sign and outer spaces; anything else is null."""
    return _or_raise(c.try_cast("int"), c, "a whole number", strict)


def phone(c: Column, strict: bool = False) -> Column:
    """Digits, with a leading 1 if there are ten. Other lengths stay as they are, or raise."""
    digits = F.regexp_replace(c, "[^0-9]", "")
    out = F.when(F.length(digits) == 10, F.concat(F.lit("1"), digits)).when(F.length(digits) > 0, digits)
    if not strict:
        return out
    return F.when(~F.length(digits).isin(10, 11), F.raise_error(F.concat(F.lit("not a phone number: "), c))).otherwise(out)


def party(title: Column) -> Column:
    """What stands between the first parentheses; both are needed."""
    found = F.regexp_extract(title, r"\(([^)]*)\)", 1)
    return F.when(found != "", found)


def chamber(title: Column) -> Column:
    """house or senate by the first word of a title; null for another word."""
    word = F.lower(F.element_at(F.split(normalize_space(title), " "), 1))
    return F.when(word.isin("representative", "house"), "house").when(word.isin("senator", "senate"), "senate")


def person_name(title: Column) -> Column:
    """struct(first_name, last_name) of a title like "Senator Ann Lee (D)"; one word is a last name."""
    name = normalize_space(F.regexp_replace(F.regexp_replace(title, r"\(.*$", ""), r"(?i)^\s*(representative|senator)\b", ""))
    words = F.split(name, " ", 2)
    pair = F.size(words) == 2
    return F.struct(F.when(pair, F.get(words, F.lit(0))).alias("first_name"), F.when(pair, F.get(words, F.lit(1))).otherwise(F.when(name != "", name)).alias("last_name"))


def title_parts(title: Column) -> Column:
    """struct(party, first_name, last_name, chamber), each normalised."""
    name = person_name(title)
    return F.struct(normalize_str(party(title)).alias("party"), normalize_str(name.first_name).alias("first_name"), normalize_str(name.last_name).alias("last_name"), normalize_str(chamber(title)).alias("chamber"))


def unescape(c: Column) -> Column:
    """Decimal references and the common named ones; &amp; last, so nothing is read twice."""
    for name, char in ENTITIES.items():
        c = F.replace(c, F.lit(f"&{name};"), F.lit(char))
    for code in (34, 38, 39, 60, 62, 160):
        c = F.replace(c, F.lit(f"&#{code};"), F.lit(chr(code)) if code != 38 else F.lit("&amp;"))
    return F.replace(c, F.lit("&amp;"), F.lit("&"))


def unescape_all(c: Column, closed: bool = False) -> Column:
    """With the standard library's whole table of references (Arrow batches); texts without any do not leave the JVM.

    That table reads old names without their ; too, so that a text cut within one reads otherwise; closed: only what ends in ;.
    """
    reference = r"&(#[0-9]+|#[xX][0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"

    @F.pandas_udf("string")
    def read(texts: pd.Series) -> pd.Series:
        known = lambda m: html.unescape(m[0]) if m[1][0] == "#" or f"{m[1]};" in html5 else m[0]
        return texts.map((lambda t: re.sub(reference, known, t)) if closed else html.unescape, na_action="ignore")

    return F.coalesce(read(F.when(F.contains(c, F.lit("&")), c)), c)


def to_local_time(c: Column, strict: bool = False) -> Column:
    """Wall-clock time of "m/d/Y h:m:s AM" or "m/d/Y", as a timestamp without zone."""
    c2 = F.upper(normalize_str(unescape(c)))
    with_time = F.when(c2.rlike(r"^\d{1,2}/\d{1,2}/\d{4} \d{1,2}:\d{1,2}:\d{1,2} [AP]M$"), F.try_to_timestamp(c2, F.lit("M/d/yyyy h:m:s a")))
    date = F.when(c2.rlike(r"^\d{1,2}/\d{1,2}/\d{4}$"), F.try_to_timestamp(c2, F.lit("M/d/yyyy")))
    return _or_raise(F.coalesce(with_time, date).cast("timestamp_ntz"), c, "a date", strict)


def to_instant(local: Column, zone: str = ZONE) -> Column:
    """The instant of a wall-clock time."""
    return F.to_utc_timestamp(local.cast("timestamp"), zone)


def vote_title(c: Column) -> Column:
    """struct(vote_timestamp, chamber) of "House Vote - Tuesday, February 5, 2013 1:43:39 PM"."""
    when = F.regexp_extract(normalize_space(c), r"^.*? - (?:\w+, )?(\w+ \d{1,2}, \d{4} \d{1,2}:\d{2}:\d{2} [AaPp][Mm])$", 1)
    where = F.lower(F.regexp_extract(c, "^(House|Senate) Vote", 1))
    return F.struct(F.try_to_timestamp(F.when(when != "", when), F.lit("MMMM d, yyyy h:mm:ss a")).cast("timestamp_ntz").alias("vote_timestamp"), F.when(where != "", where).alias("chamber"))


def document_type(c: Column) -> Column:
    """One label for each kind of document. The labels are fixed values."""
    c = normalize_str(c)
    return F.when(c == "amendments", "amendment").when(c.contains("fiscal impact"), "fiscal_impact").otherwise(c)


def present(c: Column) -> Column:
    """Whether there is any text."""
    return F.coalesce(F.length(c) > 0, F.lit(False))


def shorten(c: Column, most: int = 250) -> Column:
    """For display: longer texts are cut and end in an ellipsis."""
    return F.when(F.length(c) > most, F.concat(F.substring(c, 1, most), F.lit("…"))).otherwise(c)

"""Extraction from a page table (key, url, html).

Links and headings, which need no nesting, are read by expressions on the text.
For everything else `with_elements` parses each page once into its text and an
array of its elements, in document order; CSS selectors are expressions on that, so
a template of any number of selectors is one projection without a shuffle.
`elements` gives the same as one row per element, for joins and windows.

An element has its place, and the last place inside it: what is inside, after or
around another is a matter of ranges, at any depth. Its text is a stretch of the
page's; what an element holds is as long as its own text and the first HEAD
characters of all text inside it, so a page takes room in proportion to its size
however deep it is nested.

Selectors are lists (with ,) of compounds of a tag or *, #id, .class, [attribute],
[attribute=value] (also ^=, $=, *=, ~=), :first-child, :last-child, :only-child, :nth-child(n),
:nth-last-child(n), :first-of-type, :last-of-type, :nth-of-type(n) and :not(compounds), joined by
blanks (inside), > (child of), + (next after) and ~ (later sibling of).

Comments and the insides of scripts and styles are no text and hold no elements.
Null and empty html have no elements.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from functools import reduce
from html import parser as standard
from html import unescape as unescape_value
from html.parser import HTMLParser
from itertools import accumulate
from operator import or_

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pagemart.functions.text import normalize_space, normalize_str, unescape
from pagemart.functions.urls import resolve, url_key

#: Fixed: elements that have no end tag.
VOID = "area base br col embed hr img input link meta source track wbr".split()
#: Fixed: elements whose open one of the same kind ends where the next begins.
CLOSES = {"li": ("li",), "p": ("p",), "option": ("option",), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"), "dt": ("dt", "dd"), "dd": ("dt", "dd")}
#: Fixed: elements that such an open one does not reach out of.
KEEPS = "table tbody thead tfoot tr ul ol dl select div section body html".split()
NO_TEXT = r"(?is)<!--.*?(?:-->|\z)|<(script|style)\b.*?(?:</\1\s*>|\z)"
#: The rest of a tag, passed over without going back; > in quotes does not end it.
REST = r"""(?:[^>"']++|"[^"]*+"|'[^']*+')*+>"""
#: A tag, or one whose quotes do not close.
TAG = rf"<[/!?a-zA-Z](?:{REST}|[^>]*+>)"
#: An attribute's value in double quotes, single quotes or none; three groups.
VALUE = r"""\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))"""
#: Attributes are passed over without going back, so that no tag, however long or broken, costs more than its length.
HREF = rf"""(?is)<a\b(?:[^>"'\s]++|\s(?!href\s*=)|"[^"]*+"|'[^']*+')*+\shref{VALUE}"""
LINK = rf"""{HREF}{REST}(.*?)(?=</a\s*>|<a\b|$)"""
EVENT = rf"""(?is)<(?:h[1-6])\b{REST}.*?</h[1-6]\s*>|{HREF[5:]}"""


def _none_if_empty(arr: Column) -> Column:
    return let(arr, lambda found: F.when(F.size(found) > 0, found))


def strip_tags(c: Column) -> Column:
    return normalize_space(unescape(F.regexp_replace(c, TAG, " ")))


def visible(c: Column) -> Column:
    """html without comments, scripts and styles."""
    return F.regexp_replace(c, NO_TEXT, " ")


def _href(c: Column, pattern: str) -> Column:
    """The value of whichever group of an attribute pattern matched."""
    return unescape(F.concat(*[F.regexp_extract(c, pattern, i) for i in (1, 2, 3)]))


def select_text(html: Column, tag: str) -> Column:
    """Texts of all elements of a tag that does not hold itself (a heading, a title), in order; null without any."""
    found = F.regexp_extract_all(visible(html), F.lit(rf"(?is)<{tag}\b{REST}(.*?)</{tag}\s*>"), F.lit(1))
    return _none_if_empty(F.transform(found, strip_tags))


def links(pages: DataFrame, key: str = "page_id", html_col: str = "html", url_col: str = "url") -> DataFrame:
    """(key, url, pos, href, text) of every link; its text ends with it, or where the next one begins."""
    pair = F.transform(F.regexp_extract_all(visible(F.col(html_col)), F.lit(LINK), F.lit(0)), lambda a: F.struct(_href(a, LINK).alias("href"), strip_tags(F.regexp_extract(a, LINK, 4)).alias("text")))
    return pages.select(key, F.col(url_col).alias("url"), F.posexplode(pair).alias("pos", "l")).select(key, "url", "pos", "l.href", "l.text")


def resolved_links(pages: DataFrame, key: str = "page_id") -> DataFrame:
    """links with the target's key under which the URL is known."""
    return links(pages, key).withColumn("target", url_key(resolve(F.col("url"), F.col("href"))))


def links_matching(found: DataFrame, pattern: str) -> DataFrame:
    """Links whose text matches."""
    return found.where(F.col("text").rlike(pattern))


def links_named(found: DataFrame, names: list[str]) -> DataFrame:
    """Links whose normalised text is one of the names."""
    return found.where(normalize_str(F.col("text")).isin(names))


def link_groups(pages: DataFrame, key: str = "page_id", html_col: str = "html") -> DataFrame:
    """(key, heading, hrefs): each link under the heading before it; links before any heading have a null one."""
    events = pages.select(key, F.posexplode(F.regexp_extract_all(visible(F.col(html_col)), F.lit(EVENT), F.lit(0))).alias("pos", "e"))
    heading = F.when(F.col("e").rlike("(?i)^<h[1-6]"), strip_tags(F.col("e")))
    before = Window.partitionBy(key).orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    events = events.withColumn("heading", F.last(heading, ignorenulls=True).over(before)).where(F.col("e").rlike("(?i)^<a"))
    return events.groupBy(key, "heading").agg(F.array_sort(F.collect_list(F.struct("pos", _href(F.col("e"), HREF).alias("href")))).alias("h")).select(key, "heading", F.col("h.href").alias("hrefs"))


#: Fields of an element. `previous` and `next` are places of siblings, `nth` and `of` its number among them and how
#: many there are, `nth_of_type` and `of_type` the same among those of its tag; start and length give its text.
_FIELDS = {
    **dict.fromkeys(("pos", "last", "parent", "previous", "next", "nth", "of", "nth_of_type", "of_type"), pa.int32()),
    "tag": pa.string(), "attributes": pa.map_(pa.string(), pa.string()), "own": pa.string(), "head": pa.string(), "start": pa.int32(), "length": pa.int32(),
}
_NAMES = {pa.int32(): "int", pa.string(): "string", _FIELDS["attributes"]: "map<string,string>"}
ELEMENT = "struct<" + ",".join(f"{name}:{_NAMES[kind]}" for name, kind in _FIELDS.items()) + ">"
PAGE = f"struct<text:string,elements:array<{ELEMENT}>>"
#: Characters of the text inside an element that it holds itself.
HEAD = 64


class _Elements(HTMLParser):
    """Elements as lists in the order of _FIELDS (own texts as pieces), and the page's text, white space normalised."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.rows, self.open = [], []
        self.names: Counter = Counter()  # of open elements
        self.siblings: dict[int, tuple[int, int]] = {}  # parent -> last child, how many
        self.types: dict[tuple[int, str], list[int]] = {}
        self.pieces, self.length, self.gap = [], 0, False

    def _close(self, down_to: int) -> None:
        for pos in self.open[down_to:]:
            row = self.rows[pos]
            row[1], row[14] = len(self.rows) - 1, self.length - row[13]
            self.names[row[9]] -= 1
        del self.open[down_to:]

    def handle_starttag(self, tag, attrs):
        if any(self.names[name] for name in CLOSES.get(tag, ())):
            for i in range(len(self.open) - 1, -1, -1):
                name = self.rows[self.open[i]][9]
                if name in CLOSES[tag]:
                    self._close(i)
                    break
                if name in KEEPS:
                    break
        pos, parent = len(self.rows), self.open[-1] if self.open else None
        under = -1 if parent is None else parent
        before, nth = self.siblings.get(under, (None, 0))
        if before is not None:
            self.rows[before][4] = pos
        self.siblings[under] = pos, nth + 1
        same = self.types.setdefault((under, tag), [])
        same.append(pos)
        found: dict[str, str] = {}
        for name, value in attrs:
            found.setdefault(name, value or "")
        self.rows.append([pos, pos, parent, before, None, nth + 1, 0, len(same), 0, tag, list(found.items()), [], None, self.length, 0])
        if tag not in VOID:
            self.open.append(pos)
            self.names[tag] += 1

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self._close(len(self.open) - 1)

    def handle_endtag(self, tag):
        if self.names[tag]:
            for i in range(len(self.open) - 1, -1, -1):
                if self.rows[self.open[i]][9] == tag:
                    self._close(i)
                    break

    def handle_data(self, data):
        if self.open and self.rows[self.open[-1]][9] in ("script", "style"):
            return
        if self.open:
            self.rows[self.open[-1]][11].append(data)
        words = data.split()
        self.gap |= bool(data) and data[0].isspace()
        for word in words:
            if self.gap and self.length:
                word = " " + word
            self.pieces.append(word)
            self.length += len(word)
            self.gap = True
        if words:
            self.gap = data[-1].isspace()

    def page(self) -> tuple[str, list[list]]:
        self._close(0)
        text = "".join(self.pieces)
        for (under, _), places in self.types.items():
            for pos in places:
                self.rows[pos][6], self.rows[pos][8] = self.siblings[under][1], len(places)
        for row in self.rows:
            row[11] = " ".join("".join(row[11]).split())
            at = row[13] + (row[14] > 0 and text[row[13]] == " ")
            row[14] -= at - row[13]
            row[13], row[12] = at, text[at : at + min(row[14], HEAD)]
        return text, self.rows


#: A tag, or text up to the next one, of a plain page: tags close, values are without < and >.
_PLAIN = re.compile(r"""<(?:(/)([a-zA-Z][a-zA-Z0-9]*)>|([a-zA-Z][a-zA-Z0-9]*)((?:\ [a-zA-Z-]+=(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=`/][^\s"'<>=`]*))*)>)|([^<]+)""")
_ATTRIBUTE = re.compile(r"""([a-zA-Z-]+)=(?:"([^"]*)"|'([^']*)'|(\S+))""")
#: How the parser reads references in values, in this version of it.
_VALUE = getattr(standard, "_unescape_attrvalue", unescape_value)
#: Elements whose insides the parser reads in its own way.
_OTHERWISE = frozenset("script style textarea title xmp iframe noembed noframes noscript plaintext".split())


#: Nothing but such.
_WHOLE = re.compile(r"""(?:</[a-zA-Z][a-zA-Z0-9]*>|<[a-zA-Z][a-zA-Z0-9]*(?: [a-zA-Z-]+=(?:"[^"<>]*"|'[^'<>]*'|[^\s"'<>=`/][^\s"'<>=`]*))*>|[^<]+)*+""")
#: Shapes of pages that a task remembers, and tags and texts of one; pages of one template mostly have one shape.
SHAPES, SHAPE = 256, 1000
_shapes: dict[str, tuple[list[tuple[list, int, int]], list[int]] | None] = {}


def _shape(tokens: list[tuple[str, ...]]) -> tuple[list[tuple[list, int, int]], list[int]] | None:
    """What a page's tags alone say: each element's places, and tag, how many texts come before it and are in it; each
    text's element (-1: none). None for elements whose insides the parser reads in its own way.
    """
    parser, owners = _Elements(), []
    for closes, closed, tag, _, text in tokens:
        if text:
            owners.append(parser.open[-1] if parser.open else -1)
            parser.handle_data("x")
        elif closes:
            parser.handle_endtag(closed.lower())
        elif tag.lower() in _OTHERWISE:
            return None
        else:
            parser.handle_starttag(tag.lower(), ())
    return [(row[:10], row[13], row[13] + row[14]) for row in parser.page()[1]], owners


def _plain(html: str) -> tuple[str, list[list]] | None:
    """parsed() of a plain page, in a fraction of the time; None for any other."""
    if not _WHOLE.fullmatch(html):
        return None
    tokens = _PLAIN.findall(html)
    if tokens and "&" in tokens[-1][4]:
        return None  # the parser takes a reference at the end apart
    name = " ".join(["#" if text else "/" + closed if closes else tag for closes, closed, tag, _, text in tokens])
    if name in _shapes:
        shape = _shapes[name]
    else:
        shape = _shape(tokens)
        if len(tokens) <= SHAPE:
            if len(_shapes) >= SHAPES:
                _shapes.clear()
            _shapes[name] = shape
    if shape is None:
        return None
    elements, owners = shape
    held, pieces, ends, length, gap, nth = [""] * (len(elements) + 1), [], [0], 0, False, 0  # the last is of texts in no element
    attributes = []
    for _, _, tag, found, data in tokens:
        if data:
            if "&" in data:
                data = unescape_value(data)
            held[owners[nth]] += data
            nth += 1
            words = " ".join(data.split())
            gap = gap or data[0].isspace()
            if words:
                if gap and length:
                    words = " " + words
                pieces.append(words)
                length += len(words)
                gap = data[-1].isspace()
            ends.append(length)
        elif tag:
            given: dict[str, str] = {}
            if found:
                for key, a, b, c in _ATTRIBUTE.findall(found):
                    given.setdefault(key.lower(), _VALUE(v) if "&" in (v := a or b or c) else v)
            attributes.append(list(given.items()))
    text, rows = "".join(pieces), []
    for (fixed, begin, end), given, own in zip(elements, attributes, held):
        start, stop = ends[begin], ends[end]
        start += start < stop and text[start] == " "
        rows.append([*fixed, given, " ".join(own.split()), text[start : min(stop, start + HEAD)], start, stop - start])
    return text, rows


def parsed(html: str | None) -> tuple[str, list[list]]:
    """The text of a page, and its elements."""
    plain = _plain(html or "")
    if plain:
        return plain
    parser = _Elements()
    parser.feed(html or "")
    parser.close()
    return parser.page()


def _arrow(pages: list[tuple[str, list[list]]]) -> pa.StructArray:
    """Parsed pages as a column, put together field by field."""
    ends = lambda lists: pa.array(list(accumulate(map(len, lists), initial=0)), pa.int32())
    fields = []
    columns = list(zip(*(row for _, rows in pages for row in rows), strict=True)) or [()] * len(_FIELDS)
    for (name, kind), values in zip(_FIELDS.items(), columns, strict=True):
        if name == "attributes":
            names, items = ([x[i] for pairs in values for x in pairs] for i in (0, 1))
            fields.append(pa.MapArray.from_arrays(ends(values), pa.array(names, pa.string()), pa.array(items, pa.string())))
        else:
            fields.append(pa.array(values, kind))
    rows = pa.StructArray.from_arrays(fields, names=list(_FIELDS))
    held = pa.ListArray.from_arrays(ends([rows for _, rows in pages]), rows)
    return pa.StructArray.from_arrays([pa.array([text for text, _ in pages], pa.string()), held], names=["text", "elements"])


def free_name(columns: list[str], name: str) -> str:
    """name, with underscores before it until no column has it in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name = "_" + name
    return name


def with_elements(pages: DataFrame, html_col: str = "html", out: str = "elements", keep: tuple[str, ...] | None = None) -> DataFrame:
    """pages (or only the columns in keep) with each page's text and elements in place of its html."""
    rest = [c for c in (pages.columns if keep is None else keep) if c != html_col]

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 64):
                part = batch.slice(at, 64)
                found = _arrow([parsed(h) for h in part.column(len(rest)).to_pylist()])
                yield pa.RecordBatch.from_arrays([*part.columns[:-1], found], names=[*rest, out])

    schema = ", ".join(f"`{c}` {pages.schema[c].dataType.simpleString()}" for c in rest)
    return pages.select(*rest, html_col).mapInArrow(parse, f"{schema + ', ' if rest else ''}`{out}` {PAGE}")


def elements(pages: DataFrame, key: str = "page_id", html_col: str = "html", tags: tuple[str, ...] | None = None) -> DataFrame:
    """(key, pos, last, parent, tag, id, href, own, text) of every element, or of those of some tags; text is all text inside it."""
    page = free_name([key], "elements")
    wanted = F.col(f"{page}.elements") if tags is None else F.filter(F.col(f"{page}.elements"), lambda e: e.tag.isin(*tags))
    rows = F.transform(wanted, lambda e: F.struct(e.pos.alias("pos"), e["last"].alias("last"), e.parent.alias("parent"), e.tag.alias("tag"), e.attributes["id"].alias("id"), e.attributes["href"].alias("href"), e.own.alias("own"), text_of(F.col(page), e).alias("text")))
    return with_elements(pages, html_col, page, keep=(key,)).select(key, F.explode(rows).alias("e")).select(key, "e.*")


def text_of(page: Column, e: Column) -> Column:
    """All text inside an element."""
    return F.when(e.length <= HEAD, e.head).otherwise(F.substring(page.text, e.start + 1, e.length))


#: One part of a compound selector.
_PART = re.compile(
    r"""(?P<tag>[a-zA-Z][\w-]*|\*)|\#(?P<id>[\w-]+)|\.(?P<cls>[\w-]+)
    |\[\s*(?P<attr>[\w:-]+)\s*(?:(?P<op>[\^$*~]?=)\s*(?:"(?P<dq>[^"]*)"|'(?P<sq>[^']*)'|(?P<raw>[^\]\s]+)))?\s*\]
    |:(?P<nth>nth-child|nth-last-child|nth-of-type)\((?P<n>\d+)\)|:(?P<place>first-child|last-child|only-child|first-of-type|last-of-type)(?![\w-])
    |:not\((?P<no>(?:[^()"']|"[^"]*"|'[^']*'|\([^()]*\))+)\)""",
    re.X,
)
#: What separates selectors: a comma outside of quotes and brackets.
_COMMA = re.compile(r"""((?:[^,"'\[(]|\[(?:[^\]"']|"[^"]*"|'[^']*')*\]|\((?:[^()"']|"[^"]*"|'[^']*'|\([^()]*\))*\))*)(?:,|$)""")


def _choices(selector: str) -> list[str]:
    """A selector list's selectors; ValueError where quotes or brackets do not close."""
    out, at = [], 0
    while True:
        found = _COMMA.match(selector, at)
        if not found:
            raise ValueError(f"not a selector: {selector}")
        out.append(found[1].strip())
        if found.end() == len(selector) and not found[0].endswith(","):
            return out
        at = found.end()


def _steps(selector: str) -> list[tuple[str, list[re.Match]]]:
    """(how it is joined to the one before, parts) of each compound; ValueError for what is not understood."""
    out, how, at = [], "", 0
    while at < len(selector):
        gap = re.compile(r"\s*([>+~])\s*|\s+").match(selector, at)
        if gap:
            how, at = gap[1] or " ", gap.end()
        parts = []
        while found := _PART.match(selector, at):
            parts.append(found)
            at = found.end()
        if not parts or not out and how:
            raise ValueError(f"not a selector: {selector}")
        out.append((how, parts))
        how = ""
        if at < len(selector) and not re.compile(r"\s|[>+~]").match(selector, at):
            raise ValueError(f"not a selector: {selector}")
    if not out:
        raise ValueError("an empty selector")
    return out


def _compound(selector: str) -> list[re.Match]:
    steps = _steps(selector)
    if len(steps) > 1:
        raise ValueError(f"not a compound: {selector}")
    return steps[0][1]


def _matches(e: Column, parts: list[re.Match]) -> Column:
    """Whether an element matches a compound."""
    tests = F.lit(True)
    words = lambda value: F.split(value, r"\s+")
    for p in parts:
        if p["tag"]:
            test = F.lit(True) if p["tag"] == "*" else e.tag == p["tag"].lower()
        elif p["id"]:
            test = e.attributes["id"] == p["id"]
        elif p["cls"]:
            test = F.array_contains(words(e.attributes["class"]), p["cls"])
        elif p["attr"]:
            value, wanted = e.attributes[p["attr"].lower()], next((p[g] for g in ("dq", "sq", "raw") if p[g] is not None), "")
            how = {None: lambda: value.isNotNull(), "=": lambda: value == wanted, "^=": lambda: value.startswith(wanted), "$=": lambda: value.endswith(wanted), "*=": lambda: value.contains(wanted), "~=": lambda: F.array_contains(words(value), wanted)}
            test = how[p["op"]]()
        elif p["no"]:
            test = F.lit(True)
            for one in _choices(p["no"]):
                test = test & ~_matches(e, _compound(one))
        elif p["nth"]:
            test = {"nth-child": e.nth, "nth-last-child": e.of - e.nth + 1, "nth-of-type": e.nth_of_type}[p["nth"]] == int(p["n"])
        else:
            test = {"first-child": e.nth == 1, "last-child": e.nth == e.of, "only-child": e.of == 1, "first-of-type": e.nth_of_type == 1, "last-of-type": e.nth_of_type == e.of_type}[p["place"]]
        tests = tests & F.coalesce(test, F.lit(False))
    return tests


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once, not for each element that body looks at."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def within(e: Column, outer: Column) -> Column:
    """Whether an element is inside another one."""
    return (outer.pos < e.pos) & (e.pos <= outer["last"])


def css(page: Column, selector: str) -> Column:
    """The elements of a page (a column of with_elements) that a selector matches, in document order."""

    def found(steps: list[tuple[str, list[re.Match]]]) -> Column:
        chosen = F.filter(page.elements, lambda e: _matches(e, steps[0][1]))
        for how, parts in steps[1:]:
            chosen = let(chosen, following(how, parts))
        return chosen

    def following(how: str, parts: list[re.Match]) -> Callable[[Column], Column]:
        return lambda before: F.filter(page.elements, lambda e: _matches(e, parts) & joined(how, before, e))

    def joined(how: str, before: Column, e: Column) -> Column:
        test = {" ": lambda a: within(e, a), ">": lambda a: a.pos == e.parent, "+": lambda a: a.pos == e.previous, "~": lambda a: a.parent.eqNullSafe(e.parent) & (a.pos < e.pos)}[how]
        return F.coalesce(F.exists(before, test), F.lit(False))

    wanted = [_steps(one) for one in _choices(selector.strip())]
    if all(len(steps) == 1 for steps in wanted):
        return F.filter(page.elements, lambda e: reduce(or_, [_matches(e, steps[0][1]) for steps in wanted]))
    choices = [found(steps) for steps in wanted]
    if len(choices) == 1:
        return choices[0]
    places = F.array_distinct(F.flatten(F.array(*[F.transform(c, lambda e: e.pos) for c in choices])))
    return let(places, lambda p: F.filter(page.elements, lambda e: F.array_contains(p, e.pos)))


def texts(page: Column, selector: str) -> Column:
    """Texts of all elements that match; null without any."""
    return _none_if_empty(F.transform(css(page, selector), lambda e: text_of(page, e)))


def attributes(page: Column, selector: str, name: str, strict: bool = False) -> Column:
    """An attribute of all elements that match; those without it are left out, or raise when strict; null without any."""
    found = F.transform(css(page, selector), lambda e: e.attributes[name])
    there = F.filter(found, lambda v: v.isNotNull())
    if strict:
        return F.when(F.size(there) < F.size(found), F.raise_error(F.lit(f"a {selector} without {name}"))).otherwise(_none_if_empty(there))
    return _none_if_empty(there)


def inside(page: Column, outer: Column, attribute: str) -> Column:
    """An attribute of an element and of all elements in it; null for no element."""
    found = F.filter(page.elements, lambda e: (e.pos >= outer.pos) & (e.pos <= outer["last"]) & e.attributes[attribute].isNotNull())
    return F.when(outer.isNotNull(), F.transform(found, lambda e: e.attributes[attribute]))


def _quoted(label: str) -> str:
    """A label as part of a pattern: its characters as they are, any white space between its words."""
    if len(label) > HEAD - 4:
        raise ValueError(f"a label of more than {HEAD - 4} characters: {label}")
    return r"\s+".join("\\Q" + word.replace("\\E", "\\E\\\\E\\Q") + "\\E" for word in label.split())


def _innermost(page: Column, pattern: str, whole: bool = False) -> Column:
    """Elements whose text (its head; all of it, where whole) matches, without those around another that does."""
    found = F.filter(page.elements, lambda e: e.head.rlike(pattern) & (F.lit(not whole) | (e.length <= HEAD)))
    # In document order, what is around another comes before it, and the next one is inside it if any is.
    return let(found, lambda f: F.filter(f, lambda e, i: ~F.coalesce(within(F.get(f, i + 1), e), F.lit(False))))


def after_label(page: Column, tags: tuple[str, ...], label: str) -> Column:
    """The element beside a label, in the next cell or block; null without.

    The label is the innermost element whose text begins with it, case and blanks
    aside, the first such. Its cell is the nearest element of some tags around it (or
    itself); where that stands alone in another, the outer one is the cell. A row of a
    class that is followed by a row of the same class is no cell.
    """
    at = lambda place: F.get(page.elements, place)

    def outward(cell: Column) -> Column:
        return let(at(F.when(cell.next.isNull() & (cell.nth == 1), cell.parent)), lambda up: F.when(up.tag.isin(*tags), up).otherwise(cell))

    def beside(cell: Column) -> Column:
        rows = lambda x: (x.tag == cell.tag) & (x.attributes["class"] == cell.attributes["class"]) & (cell["last"] > cell.pos)
        return let(at(cell.next), lambda x: F.when(~F.coalesce(rows(x), F.lit(False)), x))

    def value(found: Column) -> Column:
        around = F.filter(page.elements, lambda e: (e.pos <= found.pos) & (e["last"] >= found.pos) & e.tag.isin(*tags))
        return let(F.try_element_at(around, F.lit(-1)), lambda c: let(outward(c), lambda c: let(outward(c), beside)))

    return let(F.get(_innermost(page, rf"(?i)^\s*{_quoted(label)}\s*(?:\W|$)"), F.lit(0)), lambda e: F.when(e.isNotNull(), value(e)))


#: What holds the members of a counted section.
CONTAINERS = "ul, ol, dl, table, .voteList"
_COUNT = r"(?i)^\s*\p{L}[\p{L}\s-]*:\s*\d+\s*$"


def counted(page: Column, label: str, containers: str = CONTAINERS) -> Column:
    """hrefs of the container after "Label : N", at any depth.

    Null without the label, and for a count over 0 without a container before the
    next counted label; empty if N is 0.
    """
    mark = rf"(?i)^\s*{_quoted(label)}\s*:\s*(\d+)\s*$"

    def value(first: Column, labels: Column, lists: Column) -> Column:
        later = F.get(F.filter(labels, lambda e: e.pos > first.pos), F.lit(0))
        near = F.get(F.filter(lists, lambda e: (e.pos > first["last"]) & (later.isNull() | (e.pos < later.pos))), F.lit(0))
        n = F.regexp_extract(first.head, mark, 1).try_cast("int")
        return F.when(n == 0, F.array().cast("array<string>")).otherwise(let(near, lambda c: inside(page, c, "href")))

    found = F.get(_innermost(page, mark, True), F.lit(0))
    return let(found, lambda first: F.when(first.isNotNull(), let(_innermost(page, _COUNT, True), lambda labels: let(css(page, containers), lambda lists: value(first, labels, lists)))))


def per_page(function: Callable[[list], object], strict: bool = False) -> Callable[[Column], Column]:
    """A template entry from a Python function of one page's elements (dicts), for what selectors cannot say.

    A single value is wrapped in an array of one; a page on which the function
    fails gets null, or fails the job when strict.
    """

    @F.pandas_udf("array<string>")
    def run(pages: pd.DataFrame) -> pd.Series:
        def one(text, found) -> list | None:
            try:
                page = [] if found is None else [dict(e, text=text[e["start"] : e["start"] + e["length"]]) for e in found]
                value = function(page)
            except Exception:
                if strict:
                    raise
                return None
            return value if value is None else list(value) if isinstance(value, (list, tuple)) else [str(value)]

        return pd.Series([one(*row) for row in zip(pages["text"], pages["elements"], strict=True)], index=pages.index, dtype=object)

    return run


def apply_template(pages: DataFrame, template: dict[str, tuple[str, ...] | str | Callable[[Column], Column]], html_col: str = "html", keep: tuple[str, ...] = ("url",), strict: bool = False) -> DataFrame:
    """One column per key: a selector's texts, a (selector, attribute) pair's values, or a function of the elements.

    Pages are parsed once for all keys. strict: an element without the attribute
    that is asked for is an error.
    """
    name = free_name(list(keep), "elements")
    page, out = F.col(name), []
    for key, how in template.items():
        if callable(how):
            value = how(page)
        elif isinstance(how, str):
            value = texts(page, how)
        elif len(how) == 2:
            value = attributes(page, *how, strict=strict)
        else:
            raise ValueError(f"{key}: a selector is CSS, (CSS, attribute) or a function")
        out.append(value.alias(key))
    return with_elements(pages, html_col, name, keep).select(*keep, *out)


def label_values(rows: DataFrame, key: str, label_tag: str = "td", value_tag: str = "td") -> DataFrame:
    """(key, label, value, hrefs): an element and the next sibling, as in a two-column table; hrefs of links inside the sibling, however deep."""
    beside = Window.partitionBy(key, "parent").orderBy("pos")
    pairs = rows.where(F.col("tag").isin(label_tag, value_tag)).select(key, "tag", F.col("text").alias("label"), F.row_number().over(beside).alias("nth"), F.lead(F.struct("text", "pos", "last", "tag")).over(beside).alias("v"))
    pairs = pairs.where((F.col("tag") == label_tag) & (F.col("v.tag") == value_tag) & (F.col("nth") % 2 == 1)).select(F.struct(F.col(key).alias("key"), "label", "v").alias("pair"))
    links = rows.where(F.col("href").isNotNull()).select(F.struct(F.col(key).alias("key"), "pos", "href").alias("link"))
    held = pairs.join(links, (F.col("pair.key") == F.col("link.key")) & (F.col("link.pos") >= F.col("pair.v.pos")) & (F.col("link.pos") <= F.col("pair.v.last")), "left")
    hrefs = F.array_sort(F.collect_list(F.when(F.col("link.pos").isNotNull(), F.struct("link.pos", "link.href"))))
    return held.groupBy("pair").agg(hrefs.alias("h")).select(F.col("pair.key").alias(key), "pair.label", F.col("pair.v.text").alias("value"), F.when(F.size("h") > 0, F.col("h.href")).alias("hrefs"))


def label_value(pairs: DataFrame, key: str, labels: dict[str, str]) -> DataFrame:
    """One column for each of labels (column -> label): the value whose label starts with it, case aside; null without."""
    return pairs.groupBy(key).agg(*[F.first(F.when(F.col("label").rlike(rf"(?i)^{_quoted(label)}\s*"), F.col("value")), ignorenulls=True).alias(name) for name, label in labels.items()])


def table_rows(rows: DataFrame, key: str, columns: list[str]) -> DataFrame:
    """(key, rows): an array of structs, a struct for each table row with as many cells as columns."""
    cell = rows.where(F.col("tag") == "td").groupBy(key, "parent").agg(F.array_sort(F.collect_list(F.struct("pos", "text"))).alias("c")).where(F.size("c") == len(columns))
    struct = F.struct(F.col("parent").alias("_pos"), *[F.col("c.text")[i].alias(name) for i, name in enumerate(columns)])
    return cell.groupBy(key).agg(F.array_sort(F.collect_list(struct)).alias("rows")).select(key, F.transform("rows", lambda r: F.struct(*[r[name].alias(name) for name in columns])).alias("rows"))


def link_after(rows: DataFrame, key: str, element_id: str) -> DataFrame:
    """(key, href) of the first link after the element with an id (or of that element itself)."""
    anchor = rows.where(F.col("id") == element_id).groupBy(F.col(key).alias("_key")).agg(F.min("pos").alias("_anchor"))
    found = rows.where(F.col("href").isNotNull()).join(anchor, F.col(key) == F.col("_key")).where(F.col("pos") >= F.col("_anchor"))
    return found.groupBy(key).agg(F.min_by("href", "pos").alias("href"))


def links_within(rows: DataFrame, key: str, element_id: str) -> DataFrame:
    """(key, pos, href, text) of links inside the elements with an id, however deep."""
    sections = rows.where(F.col("id") == element_id).select(F.struct(F.col(key).alias("key"), "pos", "last").alias("section"))
    found = rows.where(F.col("href").isNotNull()).select(F.struct(F.col(key).alias("key"), "pos", "href", "text").alias("link"))
    placed = found.join(sections, (F.col("link.key") == F.col("section.key")) & (F.col("link.pos") > F.col("section.pos")) & (F.col("link.pos") <= F.col("section.last")), "left_semi")
    return placed.select(F.col("link.key").alias(key), "link.pos", "link.href", "link.text")


def link_lists(rows: DataFrame, key: str, lists: dict[str, str], next_page: str | None = None) -> DataFrame:
    """(key, kind, href): links inside the elements with given ids, and pagination links under `next_page`."""
    found = None
    for kind, element_id in lists.items():
        part = links_within(rows, key, element_id).select(key, F.lit(kind).alias("kind"), "href")
        found = part if found is None else found.unionByName(part)
    if next_page:
        part = link_after(rows, key, next_page).select(key, F.lit("next_page").alias("kind"), "href")
        found = part if found is None else found.unionByName(part)
    return found

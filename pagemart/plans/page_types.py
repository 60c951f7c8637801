"""Page types, their templates, and pages -> records.

A type is recognised by host and path. Each type that carries a record has a
Template: columns read from the html, how they are cleaned, and which of them are
links that a join turns into keys later.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pagemart.functions import text, urls
from pagemart.operators import html, template
from pagemart.operators.template import Template
from pagemart.plans.registry import Registry

#: Fixed: path of each page type under the site's host.
PATHS = {
    "home": "",
    "committee_categories": "/Committees",
    "committee_list": "/Committees/List",
    "committee": "/Committees/Detail",
    "legislator_list": "/Legislators/List",
    "legislator": "/Legislators/Detail",
    "bills": "/Bills",
    "bill_categories": "/Bills/SearchByRange",
    "bill_list": "/Bills/ViewBills",
    "bill": "/Bills/Detail",
    "bill_vote": "/Bills/Votes",
}
#: Fixed: the labels under which a vote page lists its members.
VOTES = {"yea_voters": "Yeas", "nay_voters": "Nays", "non_voting_voters": "Non Voting", "present_voters": "Present", "excused_voters": "Excused"}


def with_page_type(pages: DataFrame, host: str, url_col: str = "url") -> DataFrame:
    """pages with page_type; null for pages that belong to none."""
    return pages.withColumn("page_type", urls.classify(F.col(url_col), {host + path: name for name, path in PATHS.items()}))


def _first(selector: str) -> Callable[[Column], Column]:
    return lambda page: text.first_of(html.texts(page, selector))


def _labelled(label: str, attr: str | None = None) -> Callable[[Column], Column]:
    """The text (or an attribute of what is inside) of the cell or block after one that begins with a label."""

    def value(page: Column) -> Column:
        def of(beside: Column) -> Column:
            if attr:
                return html.let(html.inside(page, beside, attr), lambda found: F.when(F.size(found) > 0, found))
            found = html.text_of(page, beside)
            return F.when(found != "", found)

        return html.let(html.after_label(page, ("td", "th", "div"), label), of)

    return value


def _section_links(element_id: str) -> Callable[[Column], Column]:
    return lambda page: F.coalesce(html.attributes(page, f"#{element_id} [href]", "href"), F.array().cast("array<string>"))


def _counted(label: str) -> Callable[[Column], Column]:
    return lambda page: html.counted(page, label)


def _without_pdf(c: Column) -> Column:
    return text.normalize_str(c, "PDF")


_TEMPLATES: dict[str, Template] = {
    "legislator": Template(
        selectors={
            "title": _first("h1"),
            "phone": _labelled("Phone"),
            "email": _labelled("Email"),
            "address": _first("address"),
            "district": _labelled("District"),
            "seniority": _labelled("Seniority"),
            "public_service": _labelled("Public Service"),
            "committee_urls": _section_links("committees"),
        },
        transforms={
            "title": text.title_parts,
            "phone": text.phone,
            "email": text.normalize_str,
            "address": text.normalize_str,
            "district": text.normalize_str,
            "seniority": text.to_int,
            "public_service": text.normalize_str,
            "committee_urls": text.identity,
        },
    ),
    "legislator_list": Template(selectors={"active_urls": _section_links("members")}, transforms={"active_urls": text.identity}),
    "committee": Template(selectors={"name": _first("h1")}, transforms={"name": text.normalize_str}),
    "bill_categories": Template(selectors={"category_urls": _section_links("categories")}, transforms={"category_urls": text.identity}),
    "bill_list": Template(
        selectors={"chamber": _first("h1"), "bill_urls": _section_links("bills"), "next_page": _section_links("next")},
        transforms={"chamber": lambda c: text.normalize_str(F.replace(c, F.lit("Bills"))), "bill_urls": text.identity, "next_page": text.first_of},
    ),
    "bill": Template(
        selectors={
            "title": _first("h1"),
            "bill_no": _labelled("Bill Number"),
            "bill_no_links": _labelled("Bill Number", "href"),
            "act_no": _labelled("Act Number"),
            "act_no_links": _labelled("Act Number", "href"),
            "orig_chamber": _labelled("Originating Chamber"),
            "lead_sponsor_urls": _labelled("Lead Sponsor", "href"),
            "other_primary_sponsor_urls": _labelled("Other Primary Sponsor", "href"),
            "cosponsor_urls": _labelled("Cosponsors", "href"),
            "intro_date": _labelled("Introduction Date"),
            "act_date": _labelled("Act Date"),
        },
        transforms={
            "title": text.normalize_str,
            "bill_no": _without_pdf,
            "bill_no_links": text.identity,
            "act_no": _without_pdf,
            "act_no_links": text.identity,
            "orig_chamber": text.normalize_str,
            "lead_sponsor_urls": text.identity,
            "other_primary_sponsor_urls": text.identity,
            "cosponsor_urls": text.identity,
            "intro_date": text.to_local_time,
            "act_date": lambda c: text.to_local_time(c).cast("date"),
        },
    ),
    "bill_vote": Template(
        selectors={"title": _first("h1")} | {name: _counted(label) for name, label in VOTES.items()},
        transforms={"title": text.vote_title} | {name: text.identity for name in VOTES},
    ),
}


#: A page type has one template; a second one of its name, or one that is not there, is an error.
PAGE_TYPES = Registry("template for")
for _name, _how in _TEMPLATES.items():
    PAGE_TYPES.add(_name, _how)


def records(pages: DataFrame, host: str, page_type: str, session_param: str) -> DataFrame:
    """(url, session_code, ...) of all pages of a type: read, cleaned, structs spread, links resolved to keys."""
    how = PAGE_TYPES[page_type]
    own = urls.with_session(with_page_type(pages, host).where(F.col("page_type") == page_type), session_param)
    raw = html.apply_template(own, how.selectors, keep=("url", "session_code"))
    clean = template.project(raw, how.transforms, keep=("url", "session_code"))
    for name in [c for c in clean.columns if c.endswith("_urls") or c.endswith("_voters")]:
        clean = clean.withColumn(name, F.transform(name, lambda href: urls.url_key(urls.resolve(F.col("url"), href))))
    return clean

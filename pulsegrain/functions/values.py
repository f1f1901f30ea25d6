"""Scalar helpers as Column expressions: matching, numbers, dates, keys, JSON, URLs."""

from __future__ import annotations

import re
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrain import lexicons
from pulsegrain.functions.text import quoted, strip_whitespace


# -- matching

def contains(text: Column, term: str | Column, regex: bool = False) -> Column:
    """Literal containment, or a regex search."""
    return text.rlike(term) if regex else text.contains(term)


def contains_any(text: Column, terms: Sequence[str]) -> Column:
    """True where the text holds one of the terms, literally."""
    if not terms:
        return F.lit(False)
    if len(terms) <= 16:
        return reduce(lambda a, b: a | b, [text.contains(t) for t in terms])
    return text.rlike("|".join(quoted(t) for t in terms))


def occurrence_count(text: Column, term: str) -> Column:
    """Non-overlapping literal occurrences."""
    shorter = F.replace(text, F.lit(term), F.lit(""))
    return ((F.length(text) - F.length(shorter)) / len(term)).cast("int")


def occurrence_total(text: Column, terms: Sequence[str]) -> Column:
    """Occurrences of all terms together."""
    return reduce(lambda a, b: a + b, [occurrence_count(text, t) for t in terms])


def first_match(text: Column, terms: Sequence[str]) -> Column:
    """The first term of the list found in the text, else NULL."""
    return F.coalesce(*[F.when(text.contains(t), F.lit(t)) for t in terms])


# -- numbers

def safe_ratio(part: Column, whole: Column, digits: int, scale: int = 1) -> Column:
    """``part / whole * scale`` rounded half-up; 0 where ``whole`` is 0."""
    ratio = F.coalesce(F.try_divide(part, whole), F.lit(0.0))
    return F.round(ratio * scale if scale != 1 else ratio, digits)


def in_units(score: Column, units: int) -> Column:
    """A score as a whole number of 1/``units``: sums of it do not depend on their order."""
    return F.round(score * units).cast("long")


def mean_of_units(total: Column, count: Column, units: int, digits: int) -> Column:
    """Rounded mean from a sum of whole units."""
    return F.round(F.try_divide(total.cast("double") / units, count), digits)


def first_integer(text: Column) -> Column:
    """The first run of digits as an int, else NULL."""
    return F.nullif(F.regexp_extract(text, r"\d+", 0), F.lit("")).try_cast("int")


def number_or(value: Column, kind: str, default: int | float = 0) -> Column:
    """Cast to ``kind``; the default where the value is NULL or no number."""
    return F.coalesce(value.try_cast(kind), F.lit(default).cast(kind))


def mapped(value: Column, table: Mapping[str, object], default: Column | None = None) -> Column:
    """Code to label; values outside the table give ``default`` or stay as they are."""
    cases = None
    for key, label in table.items():
        cases = F.when(value == key, F.lit(label)) if cases is None else cases.when(value == key, F.lit(label))
    return cases.otherwise(value if default is None else default)


def category_of(text: Column, rules: Sequence[tuple[str, str]], exact: bool = False) -> Column:
    """The label of the first rule whose term is (in) the text, else NULL."""
    return F.coalesce(*[F.when(text == t if exact else text.contains(t), F.lit(label)) for t, label in rules])


# -- dates

def parse_iso_timestamp(text: Column, fmt: str = lexicons.ISO_FORMAT) -> Column:
    """Timestamp without zone; NULL where the text does not fit."""
    return F.try_to_timestamp(text, F.lit(fmt)).cast("timestamp_ntz")


def parse_any_date(text: Column, formats: Sequence[str] = ("yyyy-MM-dd", "yyyy.MM.dd", "yy.MM.dd")) -> Column:
    """The first format that fits, else NULL. A format is tried on texts of its shape only."""

    def attempt(fmt: str) -> Column:
        shape = re.sub("[A-Za-z]", r"\\d", re.escape(fmt))
        return F.when(text.rlike(rf"\A{shape}\z"), F.try_to_timestamp(text, F.lit(fmt)))

    return F.coalesce(*[attempt(f) for f in formats]).cast("timestamp_ntz")


def month_label(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM")


def month_start(ts: Column) -> Column:
    return F.trunc(ts, "month")


def on_or_after(ts: Column, day: str) -> Column:
    """``date(ts) >= day`` with the column left bare, so that the scan can use it."""
    return ts >= F.lit(day).cast("timestamp_ntz")


def months_back(day: Column, n: int) -> Column:
    return F.add_months(day, -n)


# -- keys and lists

def keywords_hash(keywords: Column) -> Column:
    """One key for a keyword set, whatever its order."""
    return F.sha2(F.array_join(F.array_sort(keywords), "|"), 256)


def csv_list(text: Column, quotes: str = "") -> Column:
    """Comma-separated entries, trimmed, empty ones and the given quote characters dropped."""
    bare = F.translate(text, quotes, "") if quotes else text
    return F.filter(F.transform(F.split(bare, ","), strip_whitespace), lambda s: s != "")


def take_first(items: Column, n: int) -> Column:
    return F.slice(items, 1, n)


# -- JSON

def unfenced(text: Column) -> Column:
    """A JSON text without the backticks and the ``json`` tag around it."""
    inner = strip_whitespace(F.regexp_replace(text, r"\A`+|`+\z", ""))
    return strip_whitespace(F.regexp_replace(inner, r"\Ajson", ""))


def json_get(text: Column, path: str, default: str | None = None) -> Column:
    """The value at a JSON path; the default where the path or the JSON is bad."""
    found = F.get_json_object(text, path)
    return found if default is None else F.coalesce(found, F.lit(default))


def json_map(text: Column) -> Column:
    """A JSON object as a map of strings; bad or missing JSON is an empty map."""
    empty = F.from_json(F.lit("{}"), "map<string,string>")
    return F.coalesce(F.from_json(text, "map<string,string>"), empty)


# -- text from columns, URLs

def filled(template: str, *values: Column) -> Column:
    return F.format_string(template, *values)


def url_param(url: Column, name: str, default: str | None = None) -> Column:
    """A query-string value, decoded; the default where absent, blank or unreadable."""
    value = F.nullif(F.try_url_decode(F.try_parse_url(url, F.lit("QUERY"), F.lit(name))), F.lit(""))
    return value if default is None else F.coalesce(value, F.lit(default))


def month_of(day: str, back: int) -> Column:
    """Label of the month ``back`` months before ``day``."""
    return month_label(F.add_months(F.lit(day).cast("date"), -back))

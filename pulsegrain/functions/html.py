"""Fields of raw HTML as Column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def tag_text(html: Column, tag: str) -> Column:
    """Text of the first ``tag`` element; '' where there is none."""
    return F.regexp_extract(html, rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>", 1)


def tag_texts(html: Column, tag: str) -> Column:
    """Texts of all ``tag`` elements in page order."""
    return F.regexp_extract_all(html, F.lit(rf"(?is)<{tag}(?:\s[^>]*)?>(.*?)</{tag}>"), F.lit(1))


def attribute_values(html: Column, tag: str, attribute: str) -> Column:
    """Values of one attribute over all ``tag`` elements in page order."""
    return F.regexp_extract_all(html, F.lit(rf'(?is)<{tag}\s[^>]*?{attribute}="([^"]*)"'), F.lit(1))


def links(html: Column, marker: str = "") -> Column:
    """Link targets without the empty and '#' ones, those with ``marker`` kept."""
    return F.filter(
        attribute_values(html, "a", "href"),
        lambda h: (h != "") & (h != "#") & h.contains(marker),
    )

"""Text cleaning as Column expressions.

Patterns carry ``(?U)`` so that word, digit and space classes cover all of
Unicode, as the results require.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable, Sequence
from functools import reduce
from itertools import groupby

from pyspark.sql import Column
from pyspark.sql import functions as F

from pulsegrain import lexicons

SENTENCE = r"[^.!?…\n]+[.!?…]*"
TOKEN = r"[\p{L}\p{N}_]{2,}"


def quoted(term: str) -> str:
    """``term`` as a regex that matches it literally."""
    return "\\Q" + term.replace("\\E", "\\E\\\\E\\Q") + "\\E"


def _once(text: Column, fn: Callable[[Column], Column]) -> Column:
    """``fn`` of a text that it names more than once; the one-element transform computes the text once."""
    return F.get(F.transform(F.array(text), fn), F.lit(0))


def strip_clock_times(text: Column) -> Column:
    """Texts without a colon skip the regex."""
    return _once(text, lambda t: F.when(t.contains(":"), F.regexp_replace(t, r"(?U)\b\d{1,2}:\d{2}\b", "")).otherwise(t))


def strip_special_chars(text: Column, keep: str = lexicons.KEPT_CHARACTERS) -> Column:
    """Drop every character outside ``keep`` (a regex class body) and whitespace."""
    return F.regexp_replace(text, rf"(?U)[^{keep}\s]", "")


def strip_urls(text: Column) -> Column:
    """Texts without ``http`` or ``www.`` in any case skip the regex."""
    def told(t: Column) -> Column:
        bare = F.regexp_replace(t, r"(?iU)(https?://|www\.)\S+|https\S+|http\S+", "")
        return F.when(F.lower(t).contains("http") | F.lower(t).contains("www."), bare).otherwise(t)

    return _once(text, told)


def strip_whitespace(text: Column) -> Column:
    """Trim all Unicode whitespace; ``trim`` would only take the space character."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+\z", "")


def squeeze_whitespace(text: Column) -> Column:
    return strip_whitespace(F.regexp_replace(text, r"(?U)\s+", " "))


def collapse_repeated_jamo(text: Column) -> Column:
    """Drop runs of one repeated bare consonant or vowel letter."""
    consonants = F.regexp_replace(text, r"([ㄱ-ㅎ])\1+", "")
    return F.regexp_replace(consonants, r"([ㅏ-ㅣ])\1+", "")


def words(text: Column) -> Column:
    return F.regexp_extract_all(text, F.lit(r"(?U)\b\w+\b"), F.lit(0))


def without(tokens: Column, stopwords: Iterable[str]) -> Column:
    """``tokens`` minus ``stopwords``, duplicates and order kept."""
    stop = list(stopwords)
    return F.filter(tokens, lambda t: ~t.isin(stop)) if stop else tokens


def remove_stopwords(text: Column, stopwords: Iterable[str]) -> Column:
    return F.array_join(without(words(text), stopwords), " ")


def clean_text(
    text: Column,
    stopwords: Iterable[str] = tuple(lexicons.COMMENT_STOPWORDS),
    keep: str = lexicons.KEPT_CHARACTERS,
    url_first: bool = False,
) -> Column:
    """Clock times, special characters, URLs, jamo runs and stopwords removed.

    Special characters go before URLs by default, so ``www.a.com`` loses its
    dots and stays; ``url_first`` swaps the two.
    """
    text = strip_clock_times(text)
    if url_first:
        text = strip_special_chars(strip_urls(text), keep)
    else:
        text = strip_urls(strip_special_chars(text, keep))
    return remove_stopwords(collapse_repeated_jamo(strip_whitespace(text)), stopwords)


def required_text(pattern: str) -> str:
    """A literal that every match of ``pattern`` holds, or '' if none is plain to see."""
    if re.search(r"[|\[]|\(\?|\([^()]*\(", pattern):
        return ""
    plain = re.sub(r"\([^()]*\)([?*]|\{[^}]*\})", " ", pattern)
    plain = re.sub(r"\\.(\{[^}]*\}|[?*+])?|.\{[^}]*\}|.[?*]|[()^$.+{}]", " ", plain)
    return max(plain.split(" "), key=len)


def _replaced(text: Column, pattern: str, name: str) -> Column:
    """One rule; texts without the literal it needs skip the regex."""
    needed = required_text(pattern)

    def rule(t: Column) -> Column:
        return F.regexp_replace(t, rf"(?U)\b{pattern}", name)

    if not needed:
        return rule(text)
    return _once(text, lambda t: F.when(t.contains(needed), rule(t)).otherwise(t))


def _initial(pattern: str) -> str:
    """The first character of the literal that a match needs, if it is not ASCII; else ''."""
    first = required_text(pattern)[:1]
    return "" if first.isascii() else first


def _all_replaced(text: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """The rules in their order; a text without any initial of a run of rules skips the run."""
    def skipped_unless(initials: str, part: Sequence[tuple[str, str]]) -> Callable[[Column], Column]:
        return lambda t: F.when(t.rlike(f"[{initials}]"), reduce(lambda u, rule: _replaced(u, *rule), part, t)).otherwise(t)

    for guarded, run in groupby(rules, lambda rule: _initial(rule[0]) != ""):
        part = list(run)
        if guarded and len(part) > 1:
            text = _once(text, skipped_unless("".join(sorted({_initial(pattern) for pattern, _ in part})), part))
        else:
            text = reduce(lambda t, rule: _replaced(t, *rule), part, text)
    return text


def normalize_entities(
    text: Column,
    rules: Sequence[tuple[str, str]] = tuple(lexicons.ENTITY_RULES),
    fixups: Sequence[tuple[str, str]] = tuple(lexicons.NAME_FIXUPS),
) -> Column:
    """Lowercase, then apply each (pattern, name) at word starts, in order.

    Order matters: a short pattern early in the list pre-empts a longer one.
    """
    text = _all_replaced(F.lower(text), rules)
    text = squeeze_whitespace(text)
    return reduce(lambda t, fix: F.replace(t, F.lit(fix[0]), F.lit(fix[1])), fixups, text)


def sentences_of(text: Column) -> Column:
    """The sentences of a text, trimmed, blank ones dropped."""
    parts = F.regexp_extract_all(text, F.lit(SENTENCE), F.lit(0))
    return F.filter(F.transform(parts, strip_whitespace), lambda s: s != "")


def lines_of(text: Column) -> Column:
    """The lines of a text, trimmed, blank ones dropped."""
    return F.filter(F.transform(F.split(text, "\n"), strip_whitespace), lambda s: s != "")


def tokens_of(text: Column) -> Column:
    """Lowercased runs of at least two letters, digits or underscores."""
    return F.regexp_extract_all(F.lower(text), F.lit(TOKEN), F.lit(0))


def noun_tokens(text: Column, stopwords: Iterable[str] = tuple(lexicons.NOUN_STOPWORDS)) -> Column:
    """Word tokens minus stopwords, joined by spaces."""
    return F.array_join(without(tokens_of(text), stopwords), " ")


def is_latin_only(text: Column) -> Column:
    """Only ASCII letters and whitespace, the whole text through."""
    return text.rlike(r"(?U)\A[a-zA-Z\s]+\z")


def is_blank(text: Column) -> Column:
    return strip_whitespace(text) == ""

"""Predicates that decide whether a page, title, category or body counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .keys import translated_title
from .text import stripped


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def has_parameter(url: Column | str, name: str) -> Column:
    """Whether the query string has a parameter, as those that choose a language."""
    return _col(url).rlike(rf"[?&]\Q{name}\E=")


def matches_none(path: Column | str, patterns: Sequence[str]) -> Column:
    """Whether no pattern is found in path; null paths match none."""
    out = F.lit(True)
    for p in patterns:
        out = out & ~F.coalesce(_col(path).rlike(p), F.lit(False))
    return out


def housekeeping_category(name: Column | str, prefixes: Sequence[str] = ("Pages with", "Pages where", "Pages using", "Articles with", "Sections with", "Hidden"), languages: Sequence[str] = ()) -> Column:
    """Categories that track upkeep, and translated ones."""
    c, out = _col(name), F.lit(False)
    for p in prefixes:
        out = out | c.startswith(p)
    return out | translated_title(c, languages) if languages else out


def published(draft: Column | str) -> Column:
    """Not marked as a draft (null: not marked)."""
    return ~F.lower(F.coalesce(_col(draft).cast("string"), F.lit("false"))).isin("true", "yes", "1")


def long_enough(body: Column | str, least: int = 50) -> Column:
    """At least so many characters without white space at the ends; null never is."""
    return F.coalesce(F.char_length(stripped(body)) >= least, F.lit(False))


def is_markup_page(body: Column | str) -> Column:
    """Whether an HTML page came where a script or data was asked for."""
    return F.coalesce(_col(body), F.lit("")).rlike(r"(?i)\A\s*(?:<!doctype html|<html\b)")

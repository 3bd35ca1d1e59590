"""The text functions mapping expressions may use, as Column functions.

Each keeps the semantics definition authors rely on (for instance ``to_int`` gives 0 for
text that is no number), expressed with built-in functions only.
"""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F

_SPACES = r"(?U)[\s\x1c-\x1f]"


def trim(x: Column) -> Column:
    """All surrounding whitespace, not only spaces."""
    return F.regexp_replace(x, rf"\A{_SPACES}+|{_SPACES}+\z", "")


def default(x: Column, fallback: Column) -> Column:
    """For a name the pattern does not define; an empty capture stays empty."""
    return F.coalesce(x, fallback)


def to_int(x: Column, fallback: int = 0) -> Column:
    return F.coalesce(x.try_cast("long"), F.lit(fallback).cast("long"))


def to_float(x: Column, fallback: float = 0.0) -> Column:
    return F.coalesce(x.try_cast("double"), F.lit(fallback))


def to_bool_word(x: Column) -> Column:
    """Truth of a text: anything but the empty text."""
    return F.length(x) > 0


def truncate(x: Column, length: int = 255, end: str = "...", leeway: int = 5) -> Column:
    """Cut at a word end so that text plus ``end`` fits; slightly longer texts stay whole."""
    head = F.left(x, F.lit(length - len(end)))
    at_word = F.regexp_replace(head, r"(?s) [^ ]*\z", "")
    return F.when(F.length(x) <= length + leeway, x).otherwise(F.concat(at_word, F.lit(end)))


def split(x: Column, separator: str = " ") -> Column:
    """Literal separator, empty pieces kept."""
    return F.split(x, re.escape(separator), -1)


def join(items: Column, separator: str = "") -> Column:
    return F.array_join(items, separator)


def first(items: Column) -> Column:
    return F.try_element_at(items, F.lit(1))


def last(items: Column) -> Column:
    return F.try_element_at(items, F.lit(-1))


def title(x: Column) -> Column:
    """Upper-case after whitespace, hyphen and opening brackets; lower-case elsewhere."""
    pieces = F.regexp_extract_all(x, F.lit(r"((?U)[-\s({\[<]+|[^-\s({\[<]+)"), 1)
    return F.array_join(F.transform(pieces, capitalize), "")


def capitalize(x: Column) -> Column:
    return F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, 2, 2147483647)))


def wordcount(x: Column) -> Column:
    return F.regexp_count(x, F.lit(r"(?U)\w+"))


def center(x: Column, width: int = 80) -> Column:
    """Odd padding goes left when the width is odd, right otherwise."""
    gap = F.greatest(F.lit(width) - F.length(x), F.lit(0))
    left = F.floor(gap / 2) + F.when((gap % 2 == 1) & (F.lit(width) % 2 == 1), 1).otherwise(0)
    left = left.cast("int")
    return F.concat(F.repeat(F.lit(" "), left), x, F.repeat(F.lit(" "), (gap - left).cast("int")))


def indent(x: Column, width: int = 4) -> Column:
    """All lines but the first; blank lines stay blank."""
    return F.regexp_replace(x, r"\n(?=[^\n])", "\n" + " " * width)


def regex_replace(x: Column, pattern: str, replacement: str) -> Column:
    """Group references are written ``\\1``."""
    java = re.sub(r"\\(\d)", r"$\1", replacement.replace("$", r"\$"))
    return F.regexp_replace(x, pattern, java)


def _keyed(items: Column) -> Column:
    """Items with their case-insensitive key and position, in key order."""
    return F.array_sort(F.transform(
        items, lambda x, i: F.struct(F.lower(x).alias("k"), i.alias("i"), x.alias("x"))))


def sort(items: Column) -> Column:
    """Case-insensitive; equal keys keep their order."""
    return F.transform(_keyed(items), lambda s: s["x"])


def unique(items: Column) -> Column:
    """First spelling of each case-insensitive value, in order of appearance."""
    ordered = _keyed(items)
    previous = F.concat(F.array(F.lit(None)), ordered)
    firsts = F.zip_with(ordered, previous, lambda s, p: F.when(
        s.isNotNull() & (p.isNull() | (p["k"] != s["k"])), F.struct(s["i"].alias("i"), s["x"].alias("x"))))
    return F.transform(F.array_sort(F.array_compact(firsts)), lambda s: s["x"])


def characters(x: Column) -> Column:
    return F.filter(F.split(x, ""), lambda c: c != "")


def batch(items: Column, n: int) -> Column:
    """Runs of at most ``n`` items."""
    starts = F.sequence(F.lit(1), F.greatest(F.size(items), F.lit(1)), F.lit(n))
    return F.filter(F.transform(starts, lambda s: F.slice(items, s, F.lit(n))), lambda b: F.size(b) > 0)


def slices(items: Column, n: int) -> Column:
    """``n`` runs, the first ones longer by one where it does not divide evenly."""
    size = F.size(items)
    base, extra = F.floor(size / n).cast("int"), size % n

    def run(k: Column) -> Column:
        start = k * base + F.least(k, extra)
        return F.slice(items, start + 1, base + F.when(k < extra, 1).otherwise(0))

    return F.transform(F.sequence(F.lit(0), F.lit(n - 1)), run)

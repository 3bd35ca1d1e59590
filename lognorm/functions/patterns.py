"""Definition patterns (Python ``re`` syntax) as Spark regular expressions.

Spark runs Java regexes, whose named groups cannot hold an underscore and whose
character classes, quantifier braces and line ends differ. The conversion is done once
per pattern on the driver; the names stay behind as a list in group order.
"""

from __future__ import annotations

import functools
import re
from dataclasses import dataclass

from lognorm.functions.sql import literal

# Between captures in the one-pass extraction. Rows that hold the character take the slow form.
SEPARATOR = "\x01"

_PIECE = re.compile(
    r"(?P<escape>\\U[0-9a-fA-F]{8}|\\.)"
    r"|(?P<named>\(\?P<\w+>)"
    r"|(?P<backref>\(\?P=(?P<ref>\w+)\))"
    r"|(?P<conditional>\(\?\()"
    r"|(?P<flags>\(\?[a-zA-Z-]+[:)])"
    r"|(?P<brace>\{(?P<low>\d*)(?P<comma>,?)(?P<high>\d*)\}|\{)"
    r"|(?P<open>\[\^?\]?)"
    r"|(?P<other>.)",
    re.DOTALL,
)
# Python's whitespace includes the four information separators, Java's does not.
_OUTSIDE = {r"\Z": r"\z", r"\v": r"\x0B", r"\0": r"\x00",
            r"\s": r"[\s\x1c-\x1f]", r"\S": r"[^\s\x1c-\x1f]"}
_INSIDE = {r"\b": r"\x08", r"\v": r"\x0B", r"\0": r"\x00", r"\s": r"\s\x1c-\x1f"}


@dataclass(frozen=True)
class SparkPattern:
    regex: str
    names: tuple[str | None, ...]  # per group ordinal, None for an unnamed group

    def matches(self, text: str) -> str:
        """SQL: does the text column match from its first character."""
        return f"rlike({text}, {literal(self.regex)})"

    def ordinals(self, names: list[str]) -> list[int]:
        """Group number of each name; 0 for a name this pattern does not define."""
        return [self.names.index(n) + 1 if n in self.names else 0 for n in names]

    def joined(self, text: str, names: list[str]) -> str:
        """SQL: the captures in the order of ``names``, joined, with one regex pass.

        The whole payload is replaced by its captures; a group that took no part, and a name the
        pattern does not define, is empty.
        """
        return f"regexp_replace({text}, {literal(self.whole)}, {literal(self.marks(names))})"

    @property
    def whole(self) -> str:
        """The regex up to the end of the text."""
        return self.regex + _TAIL

    def marks(self, names: list[str]) -> str:
        """The replacement that joins the captures in the order of ``names``."""
        return SEPARATOR.join(f"${i}" if i else "" for i in self.ordinals(names))


_TAIL = r"[\s\S]*\z"


def regex_error(pattern: str) -> str | None:
    """Why a pattern cannot be used, or None."""
    try:
        to_spark(pattern)
    except (re.error, ValueError) as exc:
        return str(exc)
    return None


# No escapes, classes, quantifier braces, or groups other than plain, named and non-capturing ones:
# which digits such a pattern holds outside the names changes neither errors nor groups.
_PLAIN = re.compile(r"(?:[^\\{\[(]|\((?!\?)|\(\?(?:P<\w+>|:))*\Z")
_DIGIT = re.compile(r"(\(\?P<\w+>)|[0-9]")


def judged(pattern: str) -> tuple[str | None, frozenset[str]]:
    """(why a pattern cannot be used, or None; its group names), compiled once for all patterns that differ in digits alone."""
    if _PLAIN.match(pattern):
        pattern = _DIGIT.sub(lambda m: m[1] or "0", pattern)
    return _judged(pattern)


@functools.lru_cache(maxsize=16_384)
def _judged(pattern: str) -> tuple[str | None, frozenset[str]]:
    error = regex_error(pattern)
    return error, frozenset() if error else frozenset(n for n in to_spark(pattern).names if n)


@functools.lru_cache(maxsize=16_384)
def to_spark(pattern: str) -> SparkPattern:
    compiled = re.compile(pattern)
    by_ordinal = {i: n for n, i in compiled.groupindex.items()}
    names = tuple(by_ordinal.get(i) for i in range(1, compiled.groups + 1))
    body = _translate(pattern, compiled.groupindex)
    # d: only \n ends a line; U: \w \d \s cover Unicode; \A: match from the first character.
    return SparkPattern(rf"(?dU)\A(?:{body})", names)


def _translate(pattern: str, ordinals: dict[str, int]) -> str:
    out: list[str] = []
    at, in_class = 0, False
    while at < len(pattern):
        m = _PIECE.match(pattern, at)
        piece = m.group()
        if in_class:
            if not m["escape"]:  # one character at a time inside a class
                piece = pattern[at]
            at += len(piece)
            in_class = piece != "]"
            out.append(_class_piece(piece))
            continue
        at = m.end()
        if m["escape"]:
            out.append(_long_unicode(piece) or _OUTSIDE.get(piece, piece))
        elif m["named"]:
            out.append("(")
        elif m["backref"]:
            out.append(rf"(?:\{ordinals[m['ref']]})")
        elif m["conditional"]:
            raise ValueError("conditional groups are not supported")
        elif m["flags"]:
            out.append(_flags(piece))
        elif m["brace"]:
            out.append(_quantifier(m))
        elif m["open"]:
            in_class = True
            out.append(piece.replace("]", r"\]"))
        else:
            out.append(piece)
    return "".join(out)


def _class_piece(piece: str) -> str:
    if piece.startswith("\\"):
        return _long_unicode(piece) or _INSIDE.get(piece, piece)
    return "\\" + piece if piece in "[&" else piece


def _long_unicode(piece: str) -> str | None:
    return rf"\x{{{piece[2:].lstrip('0') or '0'}}}" if piece.startswith("\\U") else None


def _flags(piece: str) -> str:
    letters = piece[2:-1]
    if set(letters) & set("aL"):
        raise ValueError(f"flag group {piece} is not supported")
    return f"(?{letters.replace('u', '')}{piece[-1]}"


def _quantifier(m: re.Match[str]) -> str:
    if not (m["low"] or m["comma"]):
        return r"\{" + m.group()[1:].replace("}", r"\}")
    return f"{{{m['low'] or '0'}{m['comma'] or ''}{m['high'] or ''}}}"

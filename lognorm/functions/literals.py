"""Texts that every match of a pattern must contain, for an index over many patterns."""

from __future__ import annotations

import re
from re import _constants as op
from re import _parser as parser

#: Shorter texts occur in too many lines to tell patterns apart.
SHORTEST = 3
#: A pattern that may begin or go on in more ways than this is not indexed.
MOST_WAYS = 64

_REPEATS = (op.MAX_REPEAT, op.MIN_REPEAT, op.POSSESSIVE_REPEAT)


def needed_literals(pattern: str) -> frozenset[str] | None:
    """A set of texts of which every match holds at least one; None where there is no useful one.

    Of all such sets the one with the longest shortest text is taken, of equals the smaller one.
    Parts under the flag ``i``, optional parts, character classes and lookarounds give none.
    """
    tree = parser.parse(pattern)
    found = _needed(tree, bool(tree.state.flags & re.IGNORECASE))
    useful = [s for s in found if min(map(len, s)) >= SHORTEST]
    return max(useful, key=_worth, default=None)


def _worth(texts: frozenset[str]) -> tuple[int, int, list[str]]:
    return min(map(len, texts)), -len(texts), sorted(texts)


def _needed(nodes, folded: bool) -> list[frozenset[str]]:
    """Sets of texts; of each set every match of the sequence holds a member."""
    found: list[frozenset[str]] = []
    run = ""
    for kind, value in nodes:
        if kind is op.LITERAL and not folded:
            run += chr(value)
            continue
        if run:
            found.append(frozenset([run]))
            run = ""
        if kind is op.SUBPATTERN:
            _, on, off, inner = value
            found += _needed(inner, (folded or bool(on & re.IGNORECASE)) and not off & re.IGNORECASE)
        elif kind is op.ATOMIC_GROUP:
            found += _needed(value, folded)
        elif kind in _REPEATS and value[0] >= 1:
            found += _needed(value[2], folded)
        elif kind is op.BRANCH:
            ways = [max(_needed(way, folded), key=_worth, default=None) for way in value[1]]
            if all(ways) and sum(map(len, ways)) <= MOST_WAYS:
                found.append(frozenset().union(*ways))
    return [*found, frozenset([run])] if run else found

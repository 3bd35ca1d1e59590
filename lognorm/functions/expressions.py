"""Mapping expressions: Spark SQL text over group names, restricted to an allow-list.

Definitions may be drafted by machines and come from files, so their expressions are
checked before Spark sees them: only listed functions, no subqueries, no back-ticks, no
reflection, and nothing that could raise, or grow without bound, on a hostile log line:

* casts are ``try_cast``, divisors positive literals, ``abs`` of the least number is null;
* patterns of regular expressions and of LIKE are literals, group numbers exist, and
  no group repeats without bound (Java's engine calls itself once a repetition);
* indexes and lengths that Spark refuses (zero, negative) cannot be written, map keys are
  distinct literals;
* what can multiply a text (replacements, separators, padding, sequences) is a literal, and all of
  them together multiply it by ``GROWTH`` at most; a lambda of ``transform`` sees no group.

Strings are never compared with numbers: ``expression_error`` analyses each expression once, when
a definition is read or compiled under a Spark session, and tries it on hostile values.

The names of the template functions that definition authors know (``title``, ``truncate``,
``unique`` ...) expand to the SQL in ``MACROS``; ``split`` takes its separator literally.
"""

from __future__ import annotations

import contextlib
import functools
import io
import re
from collections.abc import Callable, Iterable

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F

from lognorm.functions.sql import literal

ALLOWED_FUNCTIONS = frozenset("""
    lower upper trim ltrim rtrim btrim replace left right substr substring length char_length
    coalesce nvl nullif if concat concat_ws array_join split split_part initcap lpad rpad
    regexp_replace regexp_extract regexp_count rlike contains startswith endswith
    try_cast try_element_at try_add try_subtract try_multiply try_divide try_mod
    size transform filter exists array array_sort array_distinct array_min array_max slice
    sequence map least greatest round string
""".split())
_KEYWORDS = frozenset("""
    case when then else end and or not in like is null true false between
    as int bigint double string boolean div both leading trailing from
""".split())
_CONSTRUCTS = frozenset({"in", "and", "or", "not", "when", "then", "else", "case", "like", "div", "as"})
_OPERATORS = frozenset(["->", "=", "==", "!=", "<>", "<", "<=", ">", ">=", "||", "(", ")", ",", "%"])
_TOKEN = re.compile(
    r"(?P<space>\s+)|(?P<text>'(?:[^'\\]|\\.)*')|(?P<number>-?\d+(?:\.\d+)?)"
    r"|(?P<name>[A-Za-z_]\w*)|(?P<op>->|==|!=|<>|<=|>=|\|\||.)",
    re.DOTALL,
)


class UnsafeExpression(ValueError):
    pass


_WORD = r"(?U)\w+"
_LAST_WORD = r"(?s) [^ ]*\z"
# Runs of what a capital follows, and runs of the rest.
_TITLE_PIECES = r"((?U)[-\s({\[<]+|[^-\s({\[<]+)"


def _count(sql: str) -> str:
    if not re.fullmatch(r"[1-9][0-9]{0,4}", sql):
        raise UnsafeExpression(f"{sql!r} is no positive count")
    return sql


def _words(x: str) -> str:
    return f"concat(upper(left({x}, 1)), lower(substring({x}, 2)))"


def _center(x: str, width: str = "80") -> str:
    gap = f"greatest({_count(width)} - length({x}), 0)"
    # An odd gap puts the extra space left in an odd width, right in an even one.
    left = f"shiftright({gap} + {int(width) % 2}, 1)"
    return f"concat(repeat(' ', {left}), {x}, repeat(' ', {gap} - {left}))"


def _truncate(x: str, length: str = "255", end: str = "'...'", leeway: str = "5") -> str:
    head = f"left({x}, greatest({_count(length)} - length({end}), 0))"
    cut = f"regexp_replace({head}, {literal(_LAST_WORD)}, '')"
    return f"CASE WHEN length({x}) <= {length} + {_count(leeway) if leeway != '0' else 0} THEN {x} ELSE concat({cut}, {end}) END"


def _sorted(items: str) -> str:
    keyed = f"transform({items}, (x_, i_) -> named_struct('k', lower(x_), 'i', i_, 'x', x_))"
    return f"transform(array_sort({keyed}), s_ -> s_.x)"


def _unique(items: str) -> str:
    seen = "exists(acc_, y_ -> lower(y_) = lower(x_))"
    return f"aggregate({items}, slice({items}, 1, 0), (acc_, x_) -> if({seen}, acc_, concat(acc_, array(x_))))"


def _batch(items: str, n: str) -> str:
    starts = f"sequence(1, greatest(size({items}), 1), {_count(n)})"
    return f"filter(transform({starts}, s_ -> slice({items}, s_, {n})), b_ -> size(b_) > 0)"


#: Template functions by name: SQL of the arguments to SQL.
MACROS: dict[str, Callable[..., str]] = {
    # the least number has no positive counterpart
    "abs": lambda x: f"if({x} < 0, try_subtract(0, {x}), {x})",
    "capitalize": _words,
    "title": lambda x: f"array_join(transform(regexp_extract_all({x}, {literal(_TITLE_PIECES)}, 1), w_ -> {_words('w_')}), '')",
    "truncate": _truncate,
    "wordcount": lambda x: f"regexp_count({x}, {literal(_WORD)})",
    "center": _center,
    "indent": lambda x, width="4": f"regexp_replace({x}, '\\n(?=[^\\n])', '\\n{' ' * int(_count(width))}')",
    "first": lambda items: f"try_element_at({items}, 1)",
    "last": lambda items: f"try_element_at({items}, -1)",
    "join": lambda items, separator="''": f"array_join({items}, {separator})",
    "default": lambda x, fallback="''": f"coalesce({x}, {fallback})",
    "unique": _unique,
    "sort": _sorted,
    "batch": _batch,
}
_DEFAULTS = ("coalesce", "nvl", "default")


# ------------------------------------------------------------------ rules for arguments

#: Times that an expression may multiply the length of a line.
GROWTH = 1_000
_TEXT = re.compile(r"'(?:[^'\\]|\\.)*'", re.DOTALL)


def _text(sql: str, what: str) -> str:
    """The value of a text literal."""
    if not _TEXT.fullmatch(sql):
        raise UnsafeExpression(f"{what} must be a literal")
    escapes = {"n": "\n", "t": "\t", "r": "\r", "b": "\b", "0": "\0", "Z": "\x1a"}
    return re.sub(r"\\(.)", lambda m: escapes.get(m[1], m[1]), sql[1:-1], flags=re.DOTALL)


def _whole(sql: str, what: str, least: int | None = None, most: int | None = None, zero: bool = True) -> int:
    """The value of a whole-number literal in a range."""
    if not re.fullmatch(r"-?\d{1,9}", sql):
        raise UnsafeExpression(f"{what} must be a whole-number literal")
    value = int(sql)
    if (least is not None and value < least) or (most is not None and value > most) or (not zero and value == 0):
        raise UnsafeExpression(f"{what} cannot be {value}")
    return value


def _groups_of(pattern: str) -> int:
    """The number of capturing groups of a Java pattern; refuses what could overflow the stack.

    Other errors of a pattern show when the expression is tried."""
    groups, at, depth, in_class = 0, 0, 0, False
    while at < len(pattern):
        c = pattern[at]
        if c == "\\":
            at += 1
        elif in_class:
            in_class = c != "]"
        elif c == "[":
            in_class = True
            at += pattern[at + 1:at + 2] == "^"
            at += pattern[at + 1:at + 2] == "]"
        elif c == "(":
            depth += 1
            groups += pattern[at + 1:at + 2] != "?" or re.match(r"\(\?P?<[A-Za-z]", pattern[at:]) is not None
        elif c == ")" and re.match(r"\)(?:[*+]|\{\d*,\}|\{\d*,?\d{3,}\})(?!\+)", pattern[at:]):
            raise UnsafeExpression(f"pattern {pattern!r}: a group repeats without bound")
        elif c == ")":
            depth -= 1
        if depth < 0:
            break
        at += 1
    if depth or in_class:
        raise UnsafeExpression(f"pattern {pattern!r}: brackets do not match")
    return groups


def _pattern_rule(*args: str) -> int:
    _groups_of(_text(args[1], "a pattern"))
    return 1


def _extract_rule(*args: str) -> int:
    _whole(args[2] if len(args) > 2 else "1", "a group number", 0, _groups_of(_text(args[1], "a pattern")))
    return 1


def _regexp_replace_rule(*args: str) -> int:
    groups, by = _groups_of(_text(args[1], "a pattern")), _text(args[2], "a replacement")
    if "\\" in by or any(not n or int(n) > groups for n in re.findall(r"\$(\d?)", by)) or re.search(r"\$\d\d", by):
        raise UnsafeExpression(f"replacement {by!r} names a group that is not there")
    if len(args) > 3:
        _whole(args[3], "a position", 1)
    return 1 + len(by)


def _index_rule(*args: str) -> int:
    if not _TEXT.fullmatch(args[1]):
        _whole(args[1], "an index", zero=False)
    return 1


def _pad_rule(*args: str) -> int:
    return max(_whole(args[1], "a width", 0, GROWTH), 1)


def _sequence_rule(*args: str) -> int:
    first, last = (_whole(a, "a bound") for a in args[:2])
    step = _whole(args[2], "a step", zero=False) if len(args) > 2 else 1 if last >= first else -1
    if (last - first) * step < 0:
        raise UnsafeExpression("a sequence steps away from its end")
    return (last - first) // step + 1


def _map_rule(*args: str) -> int:
    keys = [_text(k, "a map key") for k in args[::2]]
    if len(set(keys)) < len(keys):
        raise UnsafeExpression("a map key occurs twice")
    return 1


def _slice_rule(*args: str) -> int:
    _whole(args[1], "a start", zero=False)
    _whole(args[2], "a length", 0)
    return 1


def _round_rule(*args: str) -> int:
    if len(args) > 1:
        _whole(args[1], "a number of digits", 0, 30)
    return 1


def _part_rule(*args: str) -> int:
    _whole(args[2], "a part", zero=False)
    return 1


#: By function: checks its arguments' SQL and returns by how much they may multiply a text.
RULES: dict[str, Callable[..., int]] = {
    "rlike": _pattern_rule, "regexp_count": _pattern_rule, "regexp_extract": _extract_rule, "regexp_replace": _regexp_replace_rule,
    "try_element_at": _index_rule, "lpad": _pad_rule, "rpad": _pad_rule, "center": lambda x, width="80": _pad_rule(x, width),
    "sequence": _sequence_rule, "map": _map_rule, "slice": _slice_rule, "round": _round_rule, "split_part": _part_rule,
    "replace": lambda x, old, by="''": 1 + len(_text(by, "a replacement")),
    "array_join": lambda x, by, *null: 1 + len(_text(by, "a separator")) + sum(len(_text(n, "a null text")) for n in null),
    "join": lambda x, by="''": 1 + len(_text(by, "a separator")),
    "concat_ws": lambda by, *parts: 1 + len(_text(by, "a separator")),
    "indent": lambda x, width="4": 1 + _whole(width, "a width", 1, GROWTH),
}


def _check(called: str, args: list[str]) -> int:
    try:
        return RULES[called](*args)
    except (IndexError, TypeError) as exc:
        raise UnsafeExpression(f"{called} takes other arguments") from exc


def safe_expr(text: str, names: Iterable[str]) -> Column:
    """Column for an expression over group names held in the map column ``groups``.

    A name absent from the matched pattern renders as empty text, except directly inside
    ``coalesce``/``nvl``, where it is null so that a default can step in.
    """
    return F.expr(rewrite(text, frozenset(names), lambda name: f"try_element_at(groups, {literal(name)})"))


def rewrite(text: str, names: frozenset[str], column_sql: Callable[[str], str]) -> str:
    tokens = [(m.lastgroup, m.group()) for m in _TOKEN.finditer(text) if m.lastgroup != "space"]
    lambdas = {tokens[i][1] for i in range(len(tokens) - 1) if tokens[i + 1][1] == "->"}
    out: list[str] = []
    calls: list[tuple[str, list[int]]] = []  # open brackets: function before it, where its arguments start in ``out``
    growth = 1
    for i, (kind, token) in enumerate(tokens):
        before = tokens[i - 1][1] if i else ""
        after = tokens[i + 1] if i + 1 < len(tokens) else ("", "")
        if kind == "op":
            if token not in _OPERATORS:
                raise UnsafeExpression(f"{token!r} is not allowed")
            if token == "%":
                _check_divisor(after)
            if token == "(":
                called = before.lower() if i and tokens[i - 1][0] == "name" else ""
                calls.append((called, [len(out) + 1]))
            elif token == "," and calls:
                calls[-1][1].append(len(out) + 1)
            elif token == ")":
                if not calls:
                    raise UnsafeExpression("a bracket too many")
                called, starts = calls.pop()
                if called in RULES:
                    growth *= _check(called, _args(starts, out))
                if called in MACROS or called == "split":
                    _close(called, starts, out)
                    continue
        elif kind == "name":
            word = token.lower()
            if after[1] == "(" and word not in _CONSTRUCTS:
                if word not in ALLOWED_FUNCTIONS and word not in MACROS:
                    raise UnsafeExpression(f"function {token!r} is not allowed")
            elif token in lambdas or (word in _KEYWORDS and token not in names):
                if word == "div":
                    _check_divisor(after)
                if word == "like" and "\\" in _text(after[1], "a LIKE pattern"):
                    raise UnsafeExpression("a LIKE pattern holds no backslash")
            elif token in names:
                if any(called == "transform" and len(starts) > 1 for called, starts in calls):
                    raise UnsafeExpression("a lambda of transform sees no groups")
                inside_default = before == "(" and tokens[i - 2][1].lower() in _DEFAULTS
                ref = column_sql(token)
                token = ref if inside_default else f"coalesce({ref}, '')"
            else:
                raise UnsafeExpression(f"{token!r} is no group of this definition")
        out.append(token)
    if growth > GROWTH:
        raise UnsafeExpression(f"may multiply a text by {growth}")
    return " ".join(out)


def _args(starts: list[int], out: list[str]) -> list[str]:
    """SQL of the arguments of the call at the end of ``out``."""
    ends = [s - 1 for s in starts[1:]] + [len(out)]
    return [" ".join(out[a:b]) for a, b in zip(starts, ends, strict=True) if b > a]


def _close(called: str, starts: list[int], out: list[str]) -> None:
    """Replaces the call at the end of ``out`` (name, bracket, arguments) by its SQL."""
    args = _args(starts, out)
    del out[starts[0] - 2:]
    if called == "split":
        out.append(f"split({', '.join([args[0], _literal_pattern(args[1]), *args[2:]])})" if len(args) > 1 else f"split({', '.join(args)}, ' ')")
        return
    try:
        out.append(MACROS[called](*args))
    except TypeError as exc:
        raise UnsafeExpression(f"{called} takes other arguments") from exc


def _literal_pattern(sql: str) -> str:
    """A text literal as a regular expression that matches just that text."""
    if not re.fullmatch(r"'(?:[^'\\]|\\[^E])*'", sql) or sql == "''":
        raise UnsafeExpression("split takes a literal separator")
    return f"'\\\\Q{sql[1:-1]}\\\\E'"


def _check_divisor(token: tuple[str, str]) -> None:
    if token[0] != "number" or float(token[1]) <= 0:
        raise UnsafeExpression("a divisor must be a positive literal")


#: Values that definitions are tried on.
HOSTILE = ("x", "", "(", "0", "-9223372036854775808", "9" * 400, "$9\\", "a,(b" * 2_000, None)
_LITERAL_CAST = re.compile(r"\bcast\(-?[\d.]+ as \w+\)")
_RAISING_CAST = re.compile(r"(?<!try_)\bcast\(")


@functools.lru_cache(maxsize=4096)
def _tried(text: str, names: frozenset[str]) -> str | None:
    return expression_error(SparkSession.getActiveSession(), text, sorted(names))


def tried_error(text: str, names: frozenset[str]) -> str | None:
    """``expression_error`` under the active session, once per expression; None where there is no session."""
    return None if SparkSession.getActiveSession() is None else _tried(text, names)


def expression_error(spark: SparkSession, text: str, names: Iterable[str]) -> str | None:
    """Why an expression cannot be used, or None.

    Analyses it against an empty table and looks for casts Spark had to add: those raise
    on text that does not convert. Then runs it on ``HOSTILE`` values, which finds what the
    rules above overlook. Driver only, once per definition.
    """
    names = list(names)
    try:
        value = F.explode(F.array(*[F.lit(h) for h in HOSTILE]))
        trials = spark.range(1).select(value.alias("value")).select(
            F.create_map(*[x for n in names or ["_"] for x in (F.lit(n), F.col("value"))]).alias("groups"))
        result = trials.select(safe_expr(text, names).cast("string").alias("value"))
        plan = io.StringIO()
        with contextlib.redirect_stdout(plan):
            result.explain(extended=True)
        analyzed = plan.getvalue().split("== Analyzed Logical Plan ==")[1].split("== Optimized")[0]
        analyzed = _LITERAL_CAST.sub("", analyzed)
        to_text = len(re.findall(r" as string\)", analyzed)) - len(re.findall(r"try_cast\([^()]* as string\)", analyzed))
        if len(_RAISING_CAST.findall(analyzed)) > to_text:
            return "mixes text and numbers; use try_cast"
        result.collect()
    except Exception as exc:  # any analysis or evaluation error rejects the expression
        return str(exc).split("\n")[0]
    return None

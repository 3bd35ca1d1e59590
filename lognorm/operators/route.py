"""First-match routing and capture extraction.

Few patterns: one CASE in routing order picks the winner; later patterns are never tried. Its
result passes through ``inline``, which keeps Catalyst from copying the regexes into filters and
leaf expressions above: each record is matched once, whatever is selected later. No Python, and
small enough expressions for the JVM to compile.

Many patterns (over ``CASE_PATTERNS``): a CASE would try thousands of regexes on a line. Instead
each task finds the literals a line holds in one sweep (Aho-Corasick over a text every match of
a pattern must contain) and tries, in routing order, the patterns of those literals and those
that have none. So a line costs about the same whatever the number of definitions. Both forms
give the same rows.

Only the winning pattern extracts, all captures in one pass. No shuffle anywhere.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lognorm.functions.literals import needed_literals
from lognorm.functions.patterns import SEPARATOR, SparkPattern, to_spark
from lognorm.functions.sql import array, case, literal
from lognorm.operators.guard import with_payload
from lognorm.sources.parsers import ParserDef

#: Up to so many patterns are tried one after the other.
CASE_PATTERNS = 64


def _patterns(defs: list[ParserDef]) -> list[tuple[int, ParserDef, SparkPattern]]:
    """All patterns in routing order; the position is the pattern id."""
    return [(i, d, to_spark(p)) for i, d in enumerate(defs) for p in d.match_patterns]


def route(df: DataFrame, defs: list[ParserDef], case_patterns: int = CASE_PATTERNS) -> DataFrame:
    """Adds ``parser_id, parser, pattern_id``; null when nothing matches."""
    ready, patterns = _ready(df), _patterns(defs)
    if len(patterns) > case_patterns:
        hit = ready.withColumn("pattern_id", _first_match(defs, captures=False)(F.col("payload")))
    else:
        winner = case([(p.matches("payload"), str(i)) for i, (_, _, p) in enumerate(patterns)])
        hit = ready.select("*", F.expr(f"inline(array(named_struct('pattern_id', CAST({winner} AS INT))))"))
    return _with_parser(hit, defs)


def _ready(df: DataFrame) -> DataFrame:
    return df if "payload" in df.columns else with_payload(df)


def _with_parser(hit: DataFrame, defs: list[ParserDef]) -> DataFrame:
    parser_ids = array([str(i) for i, d in enumerate(defs) for _ in d.match_patterns] or ["0"])
    names = array([literal(d.name) for d in defs] or ["''"])
    return (
        hit.withColumn("parser_id", F.expr(f"get({parser_ids}, pattern_id)"))
        .withColumn("parser", F.expr(f"get({names}, parser_id)"))
    )


def _first_match(defs: list[ParserDef], captures: bool):
    """A function of payloads: the first pattern that matches from the first character, or null.

    With ``captures`` a struct of that and the groups, which the same match has found.
    """
    patterns = [p for d in defs for p in d.match_patterns]
    names = [d.group_names for d in defs for _ in d.match_patterns] if captures else []
    literals: dict[str, list[int]] = {}
    always: list[int] = []
    for i, p in enumerate(patterns):
        needed = needed_literals(p)
        if needed is None:
            always.append(i)
        for word in needed or ():
            literals.setdefault(word, []).append(i)

    def winners(batches: Iterator[pd.Series]) -> Iterator[list[tuple[int, re.Match] | None]]:
        import ahocorasick  # only tasks over many definitions need it

        words = ahocorasick.Automaton()
        for word, ids in literals.items():
            words.add_word(word, ids)
        words.make_automaton()
        compiled: dict[int, re.Pattern] = {}

        def winner(text: str | None) -> tuple[int, re.Match] | None:
            if text is None:
                return None
            candidates = set(always)
            if literals:
                for _, ids in words.iter(text):
                    candidates.update(ids)
            for i in sorted(candidates):
                if i not in compiled:
                    compiled[i] = re.compile(patterns[i])
                match = compiled[i].match(text)
                if match:
                    return i, match
            return None

        for payloads in batches:
            yield [winner(p) for p in payloads]

    def ids(found: list[tuple[int, re.Match] | None]) -> pd.Series:
        return pd.Series([None if f is None else f[0] for f in found], dtype="Int32")

    def groups(i: int, match: re.Match) -> list[str]:
        own = match.groupdict("")
        return [own.get(n, "") for n in names[i]]

    if not captures:
        @F.pandas_udf(T.IntegerType())
        def pattern_ids(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
            yield from map(ids, winners(batches))

        return pattern_ids

    @F.pandas_udf("pattern_id int, captures array<string>")
    def matches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for found in winners(batches):
            taken = pd.Series([None if f is None else groups(*f) for f in found], dtype="object")
            yield pd.DataFrame({"pattern_id": ids(found), "captures": taken})

    return matches


def extract_captures(df: DataFrame, defs: list[ParserDef], case_patterns: int = CASE_PATTERNS) -> DataFrame:
    """``route`` plus ``captures``: the winner's captures in the order of its ``group_names``.

    ``pattern_no`` is the place of the winning pattern within its definition. A name the winning
    pattern does not define has an empty text there; ``capture`` and ``extract_groups`` tell it
    apart by the pattern, not by the text.
    """
    patterns = _patterns(defs)
    if not patterns:
        return route(df, defs).withColumns({"pattern_no": F.lit(None).cast("int"), "captures": F.lit(None).cast("array<string>")})
    places = array([str(i) for d in defs for i in range(len(d.match_patterns))])
    if len(patterns) > case_patterns:
        ready = _ready(df).withColumn("_match", _first_match(defs, captures=True)(F.col("payload")))
        named = _with_parser(ready.select(*[c for c in ready.columns if c != "_match"], "_match.pattern_id", "_match.captures"), defs)
        return named.withColumn("pattern_no", F.expr(f"get({places}, pattern_id)"))
    routed = route(df, defs, case_patterns)
    joined = case([(f"pattern_id = {i}", p.joined("payload", d.group_names)) for i, (_, d, p) in enumerate(patterns)])
    regexes = array([literal(p.regex) for _, _, p in patterns])
    ordinals = array([f"CAST({array([str(o) for o in p.ordinals(d.group_names)])} AS ARRAY<INT>)" for _, d, p in patterns])
    one_by_one = (
        f"transform(get({ordinals}, pattern_id), o -> CASE WHEN o = 0 THEN '' "
        f"ELSE regexp_extract(payload, get({regexes}, pattern_id), o) END)")
    captures = case([("pattern_id IS NULL", "NULL"), (f"contains(payload, {literal(SEPARATOR)})", one_by_one)],
                    f"split({joined}, {literal(SEPARATOR)}, -1)")
    no_names = [str(i) for i, (_, d, _) in enumerate(patterns) if not d.group_names]
    if no_names:  # nothing to join is one empty text, not none
        captures = case([(f"pattern_id IN ({', '.join(no_names)})", "CAST(array() AS ARRAY<STRING>)")], captures)
    return routed.withColumns({"pattern_no": F.expr(f"get({places}, pattern_id)"), "captures": F.expr(captures)})


def capture(d: ParserDef, name: str) -> str:
    """SQL for a group of a definition; null where the matched pattern has no such name."""
    if name not in d.group_names:
        return "NULL"
    value = f"get(captures, {d.group_names.index(name)})"
    having = [str(i) for i, p in enumerate(d.match_patterns) if name in to_spark(p).names]
    everywhere = len(having) == len(d.match_patterns)
    return value if everywhere else f"CASE WHEN pattern_no IN ({', '.join(having)}) THEN {value} END"


def extract_groups(df: DataFrame, defs: list[ParserDef], case_patterns: int = CASE_PATTERNS) -> DataFrame:
    """``route`` plus the winning pattern's named captures as a map.

    A key is present for every name the pattern defines; a group that took no part is ''.
    """
    extracted = extract_captures(df, defs, case_patterns)
    strings = lambda names: f"CAST({array([literal(n) for n in names])} AS ARRAY<STRING>)"
    names = array([strings(d.group_names) for d in defs] or ["array('')"])
    own = array([strings([n for n in d.group_names if n in p.names]) for _, d, p in _patterns(defs)] or ["array('')"])
    whole = f"map_from_arrays(get({names}, parser_id), captures)"
    groups = f"map_filter({whole}, (k, v) -> array_contains(get({own}, pattern_id), k))"
    return extracted.withColumn("groups", F.expr(groups)).drop("captures", "pattern_no")


def dry_run(definition: ParserDef, df: DataFrame) -> DataFrame:
    """One definition over sample records; records it does not match keep a null pattern."""
    patterns = F.array(*[F.lit(p) for p in definition.match_patterns]).cast("array<string>")
    return extract_groups(df, [definition]).select(
        F.lit(definition.ocsf_class_uid * 100).cast("long").alias("type_uid"),
        "raw_sha256",
        F.col("payload").alias("raw_payload"),
        F.lit(definition.name).alias("parser"),
        F.col("groups").alias("extracted_fields"),
        F.try_element_at(patterns, F.col("pattern_id") + 1).alias("pattern"),
    )

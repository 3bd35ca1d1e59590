"""Long and nested lines: none may overflow the regex engine's stack, which would end the executor."""

import pytest

from lognorm.builtin_rules import builtin_parsers
from lognorm.operators.route import extract_groups
from lognorm.plans.batch import normalize_records

DEFS = builtin_parsers()
HEADER = "<34>1 2024-01-01T00:00:00Z h a p m "


def parsers(spark, records, lines):
    rows = normalize_records(records(lines), DEFS).select("n", "parser", "status").collect()
    return [(r["parser"], r["status"]) for r in sorted(rows, key=lambda r: r["n"])]


def test_lines_at_the_size_limit(spark, records):
    lines = [HEADER + '[a x="' + "y" * 60_000 + '"] msg', HEADER + '[a x="' + '\\"' * 30_000 + '"] msg', HEADER + '[a x="1"]' * 6_000 + " msg",
             '{"a":' + "{}" * 30_000 + ' "EventID": 1, "MachineName": "x"}', '{"a":' + "{" * 30_000 + '"MachineName": "x"}',
             '{"eventMessage":' * 4_000 + '"subsystem": 1}', "{" * 60_000, "<34>" * 15_000, "x" * 65_000]
    got = parsers(spark, records, lines)
    assert [p for p, _ in got] == ["rfc5424_fallback"] * 3 + ["windows_event"] * 2 + ["macos_unified"] + [None] * 3


@pytest.mark.parametrize("line,parser,message", [
    ('{"a":{"b":{"c":{}}},"EventID":1,"MachineName":"x","n":{"m":1}}', "windows_event", '{"a":{"b":{"c":{}}},"EventID":1,"MachineName":"x","n":{"m":1}'),
    ('{"Message":"if (x) {","MachineName":"x","EventID":1} tail', "windows_event", '{"Message":"if (x) {","MachineName":"x","EventID":1}'),
    ('{"Message":"}",\n"MachineName" : "x"}', "windows_event", '{"Message":"}",\n"MachineName" : "x"}'),
    ('{"t":{"u":{"v":1}},"eventMessage":"a } b","subsystem":"s","z":{}} tail', "macos_unified", '{"t":{"u":{"v":1}},"eventMessage":"a } b","subsystem":"s","z":{}}'),
    ('{"eventMessage":"a",\n"subsystem":"s"}', None, None),
])
def test_json_records_with_anything_before_their_keys(spark, records, line, parser, message):
    row = extract_groups(records([line]), DEFS).head()
    assert row["parser"] == parser and (row["groups"] or {}).get("msg") == message

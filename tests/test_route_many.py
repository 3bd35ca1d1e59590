"""Routing by an index of literals, and names that are absent against names that are empty."""

from dataclasses import replace

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from lognorm.builtin_rules import LINUX_SSHD, builtin_parsers
from lognorm.functions.literals import needed_literals
from lognorm.operators.normalize import normalize
from lognorm.operators.route import extract_groups, route
from lognorm.plans.queries import MANY


def defined(name, *patterns):
    return replace(LINUX_SSHD, name=name, match_patterns=patterns, field_mappings=(), static_values={})


@pytest.mark.parametrize("pattern, texts", [
    (r"(?P<a>\d+) login of (?P<b>\w+)", {" login of "}),
    (r"(?:foo)?bar\d+quux", {"quux"}),
    (r"start (?:stop|halt)ed", {"start "}),
    (r"(?:stop|halt)", {"stop", "halt"}),
    (r"(?:stop|x)", None),
    (r"(?i)login", None),
    (r"a(?i:login)ing", {"ing"}),
    (r"(?:login)*", None),
    (r"(?:login){2,}", {"login"}),
    (r"(?!login)\w+", None),
    (r"lo[gh]in", None),
])
def test_needed_literals(pattern, texts):
    assert needed_literals(pattern) == (None if texts is None else frozenset(texts))


@settings(max_examples=200, deadline=None)
@given(st.from_regex(r"\A(?:abc|[a-c]{2}|(?:ab|ca)+|b?ccc|\.){1,4}\Z"), st.text("abc.", max_size=12))
def test_no_match_without_a_literal(pattern, text):
    import re

    needed = needed_literals(pattern)
    if needed is not None and re.match(pattern, text):
        assert any(word in text for word in needed)


LINES = ["Sep 10 17:44:21 h sshd[1]: Accepted password for u from 10.0.0.1 port 22 ssh2", "user1 in", "user12 in", "x user123 in",
         "user1 and order 7", "order 77", "", "ümläut user3", "café user3", "a\x01user1\x02", "user1\nuser3", "nothing", '{"EventID": 1, "MachineName": "a", "Message": "order 7"}']


def test_index_and_case_give_the_same_rows(spark, records):
    defs = [*[defined(f"u{n}", rf"(?P<head>.*)\buser{n}\b(?P<rest>.*)", rf"(?P<rest>.*)order {n}(?P<tail>\d?)") for n in range(40)], *builtin_parsers()]
    df = records(LINES)
    by_case = extract_groups(df, defs, case_patterns=1000).select("n", "parser_id", "parser", "pattern_id", "groups")
    by_index = extract_groups(df, defs, case_patterns=1).select("n", "parser_id", "parser", "pattern_id", "groups")
    assert by_index.dtypes == by_case.dtypes
    found = sorted(by_index.collect())
    assert found == sorted(by_case.collect())
    assert sum(r.parser is not None for r in found) > 8
    events = [r.event for r in normalize(df, defs).select("event").collect()]
    assert sum(e is not None for e in events) == sum(r.parser is not None for r in found)


def test_no_literals_null_payloads_and_no_rows(spark, records):
    defs = [defined(f"d{n}", rf"\d{{{n + 1}}}\D") for n in range(3)]
    df = spark.createDataFrame([(1, b"12x"), (2, None), (3, b"x"), (4, b"1x")], "n int, raw binary")
    assert {r.n: r.parser for r in route(df, defs, case_patterns=1).collect()} == {1: "d1", 2: None, 3: None, 4: "d0"}
    assert route(df.limit(0), defs, case_patterns=1).count() == 0


def test_many_definitions_of_the_row_are_over_the_bound():
    assert len(MANY) == 2000


@pytest.mark.parametrize("case_patterns", [64, 0])
def test_control_characters_are_captures_and_absent_names_are_not(records, case_patterns):
    two = defined("two", r"A(?P<x>.?)-(?P<y>.?)\Z", r"B(?P<y>.?)\Z")
    df = records(["A\x01-\x02", "A\x02-", "A-\x01", "A-", "B\x02", "B\x01", "B"])
    groups = {r.n: r.groups for r in extract_groups(df, [two], case_patterns).collect()}
    assert groups == {0: {"x": "\x01", "y": "\x02"}, 1: {"x": "\x02", "y": ""}, 2: {"x": "", "y": "\x01"}, 3: {"x": "", "y": ""},
                      4: {"y": "\x02"}, 5: {"y": "\x01"}, 6: {"y": ""}}


def test_an_absent_name_maps_to_its_default_and_a_control_character_to_itself(records):
    from lognorm.sources.parsers import FieldMapping

    two = replace(defined("two", r"A(?P<x>.?)-(?P<y>.?)\Z", r"B(?P<y>.?)\Z"), ocsf_class="base_event", ocsf_category_uid=0, ocsf_class_uid=0,
                  field_mappings=(FieldMapping("message", "str", "coalesce(x, 'none')"),))
    found = {r.n: r.message for r in normalize(records(["A\x02-", "A-", "B\x02"]), [two]).select("n", "event.message").collect()}
    assert found[0] == "\x02" and found[2] == "none"

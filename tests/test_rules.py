import json

import pytest
from pyspark.sql import functions as F

from lognorm.builtin_rules import builtin_parsers
from lognorm.operators.normalize import normalize
from lognorm.operators.outputs import class_view
from lognorm.operators.route import dry_run, route
from lognorm.operators.rules import PARSER_DEFS, lint_paths, parser_table, rule_violations, valid_definitions
from lognorm.operators.validate import validate
from lognorm.sources.parsers import InvalidDefinition, load_parser, load_parsers, parse_definition, violations

BASE = {
    "name": "p", "version": "1.0.0", "author": "human", "created_at": "2026-09-06T00:00:00Z", "vendor": "v",
    "log_format": "syslog", "match_patterns": [r"(?P<message>.*)"], "ocsf_class": "base_event",
    "ocsf_category_uid": 0, "ocsf_class_uid": 0, "field_mappings": [{"ocsf_field": "message"}],
}
CASES = [
    ({}, []),
    ({"author": "ai:some-model"}, []),
    ({"match_patterns": []}, []),
    ({"version": "1.2.3-rc.1+b7"}, []),
    ({"version": "v1"}, ["semver"]),
    ({"author": "bot"}, ["author"]),
    ({"ocsf_class_uid": 9999}, ["class_uid"]),
    ({"ocsf_class": "finding"}, ["ocsf_class"]),
    ({"match_patterns": ["ok", "([bad"]}, ["regex"]),
    ({"name": None}, ["missing"]),
    ({"version": None, "author": None}, ["missing", "missing"]),
    ({"created_at": "yesterday"}, ["created_at"]),
    ({"field_mappings": [{"ocsf_field": "message", "type": "number"}]}, ["field_type"]),
]


def definition(**changes):
    return parse_definition({**BASE, **changes}, "test.json")


@pytest.mark.parametrize("change,rules", CASES)
def test_single_definition(change, rules):
    assert sorted(r for r, _ in violations({**BASE, **change})) == sorted(rules)


def test_not_an_object_and_unsafe_expression():
    assert violations(["list"])[0][0] == "not_an_object"
    bad = {**BASE, "field_mappings": [{"ocsf_field": "message", "expr": "reflect('x')"}]}
    assert violations(bad)[0][0] == "expression"
    assert definition().match_priority == 100


def test_rule_table_agrees_with_single_checks(spark):
    rows = []
    for i, (change, _) in enumerate(CASES):
        d = {**BASE, **change}
        mappings = [(m["ocsf_field"], m.get("type"), m.get("expr"), None) for m in d["field_mappings"]]
        rows.append((f"{i:02}", True, d["name"], d["version"], d["author"], d["created_at"], None, d["vendor"],
                     d["log_format"], d["match_patterns"], 100, d["ocsf_class"], 0, d["ocsf_class_uid"], mappings, {}))
    table = spark.createDataFrame(rows, PARSER_DEFS)
    found = {}
    for r in rule_violations(table).collect():
        found.setdefault(r["file"], []).append(r["rule"])
    assert {f"{i:02}": sorted(r) for i, (_, r) in enumerate(CASES) if r} == {k: sorted(v) for k, v in found.items()}
    assert valid_definitions(table).count() == 4


def test_builtin_definitions_are_clean_and_ordered(spark):
    table = parser_table(spark, builtin_parsers())
    assert rule_violations(table).count() == 0 and lint_paths(table).count() == 0
    assert [r["name"] for r in table.collect()] == [
        "macos_unified", "windows_event", "cisco_asa", "linux_sshd", "rfc5424_fallback"]


def test_load_directory(tmp_path):
    assert load_parsers(str(tmp_path / "missing")) == [] and load_parsers(str(tmp_path)) == []
    (tmp_path / "b.json").write_text(json.dumps({**BASE, "name": "b", "match_priority": 5}))
    (tmp_path / "a.json").write_text(json.dumps({**BASE, "name": "a"}))
    (tmp_path / "c.json").write_text("{broken")
    (tmp_path / "d.json").write_text(json.dumps({**BASE, "version": "x"}))
    assert [d.name for d in load_parsers(str(tmp_path))] == ["b", "a"]
    assert load_parser(str(tmp_path / "a.json")).name == "a"
    for bad in ("c.json", "d.json"):
        with pytest.raises(InvalidDefinition):
            load_parser(str(tmp_path / bad))


def run(records, payloads, *defs, enum_mode="code", unmapped_mode="merge"):
    done = validate(normalize(records(payloads), list(defs), enum_mode, unmapped_mode), list(defs), enum_mode)
    return done.orderBy("n").collect()


def test_routing_takes_priority_then_pattern_order(records):
    first = definition(name="first", match_priority=1, match_patterns=["(?P<a>abc)", "(?P<a>ab)"])
    second = definition(name="second", match_patterns=["(?P<a>a)"])
    rows = route(records(["abcd", "abx", "axx", "xabc"]), [first, second]).orderBy("n").collect()
    assert [(r["parser"], r["pattern_id"]) for r in rows] == [("first", 0), ("first", 1), ("second", 2), (None, None)]


def test_defaults_and_failed_casts(records):
    d = definition(match_patterns=[r"(?P<count>[^,]*),(?P<duration>.*)"], field_mappings=[
        {"ocsf_field": "count", "type": "int", "default": 5}, {"ocsf_field": "duration", "type": "int", "default": 9}])
    rows = run(records, ["1,2", ",", "x,y"], d)
    assert [(r["event"]["count"], r["event"]["duration"]) for r in rows] == [(1, 2), (5, 9), (None, None)]
    assert {r["status"] for r in rows} == {"success"}


def test_later_mapping_wins_only_with_a_value(records):
    d = definition(match_patterns=[r"(?P<a>\w*)-(?P<b>\w*)"], field_mappings=[
        {"ocsf_field": "message", "expr": "a"}, {"ocsf_field": "message", "expr": "b"}])
    assert [r["event"]["message"] for r in run(records, ["x-y", "x-"], d)] == ["y", "x"]


def test_strict_types(records):
    d = definition(ocsf_class="network_activity", ocsf_class_uid=4001, match_patterns=[r"(?P<p>\w+)"], field_mappings=[
        {"ocsf_field": "src_endpoint", "type": "str", "expr": "p"},
        {"ocsf_field": "src_endpoint.port", "type": "str", "expr": "p"},
        {"ocsf_field": "dst_endpoint", "type": "str", "expr": "p"},
        {"ocsf_field": "message", "type": "int", "expr": "p"},
        {"ocsf_field": "message.deeper", "expr": "p"},
        {"ocsf_field": "no.such.path", "expr": "p"}])
    (row,) = run(records, ["443"], d)
    assert sorted((e["field"], e["code"], e["input"]) for e in row["errors"]) == [
        ("dst_endpoint", "type", "443"), ("message", "type", "443"), ("src_endpoint.port", "type", "443")]
    assert row["status"] == "validation_error"


def test_enum_codes_by_class(records):
    static = {"activity_id": 3, "severity_id": 7}
    auth = definition(name="auth", ocsf_class="authentication", ocsf_class_uid=3002, match_patterns=["(?P<m>a)"],
                      static_values=static)
    base = definition(name="base", match_patterns=["(?P<m>b)"], static_values={"activity_id": 77})
    rows = run(records, ["a", "b"], auth, base)
    assert [(e["field"], e["code"], e["input"]) for e in rows[0]["errors"]] == [("severity_id", "enum", "7")]
    assert rows[1]["errors"] == [] and rows[1]["event"]["type_uid"] == 77
    assert rows[0]["event"]["type_uid"] == 300203


def test_text_for_an_enum_is_an_error(records):
    d = definition(ocsf_class="authentication", ocsf_class_uid=3002, static_values={"activity_id": "0", "is_mfa": 1})
    (row,) = run(records, ["x"], d)
    assert sorted((e["field"], e["code"]) for e in row["errors"]) == [("activity_id", "type"), ("is_mfa", "type")]


def test_static_objects_and_required_members(records):
    d = definition(ocsf_class="authentication", ocsf_class_uid=3002, field_mappings=[
        {"ocsf_field": "device.hostname", "expr": "message"}], static_values={
        "device": {"name": "d1", "os": {"version": "1"}},
        "observables": [{"name": "n", "type_id": 2}], "status_id": 1})
    (row,) = run(records, ["x"], d)
    assert row["event"]["device"]["hostname"] is None and row["event"]["device"]["name"] == "d1"
    assert [(e["field"], e["code"]) for e in row["errors"]] == [("device.os.name", "missing")]
    assert row["event"]["observables"][0]["type_id"] == 2
    bad = definition(static_values={"observables": [{"name": "n"}]})
    assert run(records, ["x"], bad)[0]["errors"][0]["field"] == "observables"


def test_engine_fields_cannot_be_mapped(records):
    d = definition(match_patterns=["(?P<x>.*)"], field_mappings=[
        {"ocsf_field": "metadata.product.name", "expr": "x"}, {"ocsf_field": "raw_data", "expr": "lower(x)"},
        {"ocsf_field": "time", "type": "int", "default": 1}])
    (row,) = run(records, ["ABC"], d)
    assert row["event"]["metadata"]["product"]["name"] == "p" and row["event"]["raw_data"] == "ABC"
    assert row["event"]["time"] > 1


def test_unmapped_modes(records):
    d = definition(match_patterns=[r"(?P<a>\w)(?P<b>\w)(?P<c>\w?)"], field_mappings=[
        {"ocsf_field": "unmapped.b", "expr": "upper(b)"}, {"ocsf_field": "unmapped.n", "type": "int", "expr": "a"}])
    assert run(records, ["1xz"], d)[0]["event"]["unmapped"] == {"b": "X", "n": "1", "a": "1", "c": "z"}
    assert run(records, ["1xz"], d, unmapped_mode="replace")[0]["event"]["unmapped"] == {"a": "1", "c": "z"}
    bare = definition(match_patterns=["(?P<message>x)"])
    assert run(records, ["x"], bare)[0]["event"]["unmapped"] is None


def test_class_fields(records):
    d = definition(field_mappings=[{"ocsf_field": "src_endpoint.ip", "expr": "message"}])
    (row,) = run(records, ["x"], d)
    assert row["event"]["src_endpoint"] is None and row["errors"] == []
    view = class_view(validate(normalize(records(["x"]), [d]), [d]), "base_event")
    assert "src_endpoint" not in view.columns and "unmapped" in view.columns


def test_dry_run(records):
    d = definition(ocsf_class_uid=3002, ocsf_class="authentication", match_patterns=["(?P<a>x+)", "(?P<b>y)"])
    rows = {r["raw_payload"]: r for r in dry_run(d, records(["xx", "y", "z"])).collect()}
    assert rows["xx"]["extracted_fields"] == {"a": "xx"} and rows["xx"]["type_uid"] == 300200
    assert rows["y"]["pattern"] == "(?P<b>y)" and rows["z"]["pattern"] is None


def test_windows_patterns(records):
    payloads = ['{"MachineName": "a",\n "EventID": 1, "x": {"y": 1}}', '{"EventID":1,"MachineName":"a"}', '{"MachineName":"a"} tail']
    rows = run(records, payloads, *builtin_parsers())
    assert [r["parser"] for r in rows] == ["windows_event"] * 3
    assert rows[0]["event"]["message"] == '{"MachineName": "a",\n "EventID": 1, "x": {"y": 1}'
    assert rows[2]["event"]["message"] == '{"MachineName":"a"}' and rows[2]["event"]["raw_data"] == payloads[2]


def test_many_definitions_stay_one_pass(records):
    many = [definition(name=f"p{i}", match_patterns=[rf"line{i} (?P<message>.*)"]) for i in range(60)]
    rows = run(records, ["line0 a", "line59 b", "other"], *many)
    assert [r["parser"] for r in rows] == ["p0", "p59", None]
    assert rows[1]["event"]["message"] == "b"


def test_namesakes_are_judged_one_by_one(spark):
    good = definition(name="a", file="x.json") if "file" in BASE else definition(name="a")
    table = parser_table(spark, [good, good])
    bad = table.limit(1).withColumn("version", F.lit("not a version"))
    both = table.limit(1).unionByName(bad)
    assert rule_violations(both).count() == 1 and valid_definitions(both).count() == 1


def test_registry_finds_unsafe_expressions(spark):
    table = parser_table(spark, [definition()])
    unsafe = F.array(F.struct(F.lit("message").alias("ocsf_field"), F.lit("str").alias("type"), F.lit("reflect('a', 'b')").alias("expr"), F.lit(None).cast("string").alias("default")))
    bad = table.withColumn("field_mappings", unsafe)
    assert [r["rule"] for r in rule_violations(bad).collect()] == ["expression"]
    assert valid_definitions(bad).count() == 0 and valid_definitions(table).count() == 1


def test_patterns_that_differ_in_digits_are_compiled_once(monkeypatch):
    from lognorm.functions import patterns as ps

    odd = [r"(?P<a1>1)(?P<a2>2)", r"(?P<a1>1)(?P<a1>2)", r"(a){1,3}", r"(a){3,1}", r"a\1", r"(a)\1", "[9-1]", "[1-9]", "(?1)", "1**", "12(", "(?<=1|22)x",
           "(?:1(2))", "(?P<1a>x)", "(?#1)2", "é1", "", "(((1)", "x{2", "(?P<n>1)(?P=n)"]
    for p in odd:
        error = ps.regex_error(p)
        assert ps.judged(p) == (error, frozenset() if error else frozenset(n for n in ps.to_spark(p).names if n)), p
    ps._judged.cache_clear()
    compiled = []
    plain = ps.to_spark
    monkeypatch.setattr(ps, "to_spark", lambda p: compiled.append(p) or plain(p))
    assert {ps.judged(f"(?P<text>event {n})") for n in range(1000, 2000)} == {(None, frozenset(["text"]))}
    assert set(compiled) == {"(?P<text>event 0000)"}

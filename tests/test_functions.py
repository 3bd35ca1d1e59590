import hashlib
import re

import pytest
from pyspark.sql import functions as F

from lognorm.functions import text as fx
from lognorm.functions.coerce import coerce
from lognorm.functions.expressions import UnsafeExpression, expression_error, rewrite, safe_expr
from lognorm.functions.patterns import regex_error, to_spark
from lognorm.functions.payload import decode_utf8, fingerprint
from lognorm.functions.triage import detail_label, harm_tag, preview
from lognorm.operators.guard import size_guard, verify_envelope, with_envelope
from lognorm.sources.parsers import InvalidDefinition, parse_definition


def value(spark, column, **cols):
    df = spark.range(1).select(*[(v if hasattr(v, "alias") else F.lit(v)).alias(k) for k, v in cols.items()] or ["id"])
    return df.select(column).first()[0]


# ---------------------------------------------------------------- bytes


@pytest.mark.parametrize("raw", [b"", bytes(range(256)), b"\x80\x81\x82text", b"\xe9\xe8\xe0", b"hello \xff world",
                                 "héllo".encode()])
def test_hash_is_of_the_bytes(spark, raw):
    df = spark.createDataFrame([(raw,)], "raw binary")
    row = df.select(decode_utf8(F.col("raw")).alias("t"), fingerprint(F.col("raw")).alias("f")).first()
    assert row["f"]["value"] == hashlib.sha256(raw).hexdigest()
    assert row["t"] == raw.decode("utf-8", errors="replace")


def test_envelope(spark):
    df = spark.createDataFrame([(b"\xff\xfeabc", "keep")], "raw binary, other string")
    wrapped = with_envelope(df)
    row = wrapped.first()
    assert row["raw_data_size"] == 5 and row["other"] == "keep" and row["raw_data_hash"]["algorithm_id"] == 3
    assert verify_envelope(wrapped).count() == 0
    assert verify_envelope(wrapped.withColumn("raw", F.lit(b"changed"))).count() == 1


def test_size_guard(spark):
    kept, dropped = size_guard(spark.createDataFrame([(b"0123456789",), (b"0123456789a",)], "raw binary"), 10)
    assert [bytes(r[0]) for r in kept.collect()] == [b"0123456789"] and dropped.count() == 1


# ---------------------------------------------------------------- patterns

PATTERNS = [
    (r"(?P<a_b>\d{,3})x(?P=a_b)", ["12x12", "1x2", "x", "1234x1234"]),
    (r"(?P<x>[[\]a]+)", ["[]a", "b"]),
    (r"(?P<x>.+)", ["a\rb\nc", "\n"]),
    (r"(?s)(?P<x>\{.*?\})", ["{a\n}b}", "x"]),
    (r"(?P<w>\w+)\s(?P<d>\d+)", ["héé 12", "a ٣", "a\x1c7"]),
    (r"(?P<x>a{b)", ["a{b", "ab"]),
    (r"(?P<x>a)|(?P<y>b)", ["a", "b", "c"]),
    (r"(?i)(?P<x>STRASSE)\Z", ["strasse", "strasse\n"]),
]


@pytest.mark.parametrize("pattern,texts", PATTERNS)
def test_patterns_match_like_python(spark, pattern, texts):
    compiled, ours = re.compile(pattern), to_spark(pattern)
    names = [n for n in ours.names if n]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    rows = df.select("t", F.expr(ours.matches("t")).alias("m"),
                     F.split(F.expr(ours.joined("t", names)), "\x01", -1).alias("c")).collect()
    for r in rows:
        m = compiled.match(r["t"])
        assert r["m"] == bool(m), r["t"]
        if m:
            assert dict(zip(names, r["c"])) == {k: v or "" for k, v in m.groupdict().items()}


def test_separator_in_payload(spark, records):
    from lognorm.operators.route import extract_groups
    from test_rules import definition
    d = definition(match_patterns=[r"(?P<a>\S+) (?P<b>.*)", r"(?P<a>.+)"])
    rows = extract_groups(records(["x\x01y z\x02", "plain text", "single\x02"]), [d]).orderBy("n").collect()
    assert [r["groups"] for r in rows] == [{"a": "x\x01y", "b": "z\x02"}, {"a": "plain", "b": "text"}, {"a": "single\x02"}]


def test_bad_patterns():
    assert regex_error("([unclosed") and regex_error(r"(?P<a>x)(?(a)y|z)") and not regex_error(r"(?P<a>\d+)")


# ---------------------------------------------------------------- coercion


@pytest.mark.parametrize("text,kind,expected", [
    ("42", "int", 42), (" 7 ", "int", 7), ("-3", "int", -3), ("4.0", "int", None), ("x", "int", None),
    ("99999999999999999999", "int", None), ("1.5", "float", 1.5), ("1e3", "float", 1000.0), ("1d", "float", None),
    ("YES", "bool", True), ("1", "bool", True), ("on", "bool", False), ("s", "str", "s"), ("2026", "datetime", "2026"),
])
def test_coerce(spark, text, kind, expected):
    assert value(spark, coerce("t", kind), t=text) == expected


# ---------------------------------------------------------------- expressions


@pytest.mark.parametrize("expr,groups,expected", [
    ("name", {"name": "test"}, "test"),
    ("lower(v)", {"v": "HELLO"}, "hello"),
    ("coalesce(v, 'fallback')", {}, "fallback"),
    ("replace(v, 'a', 'b')", {"v": "aaa"}, "bbb"),
    ("string(coalesce(try_cast(v AS BIGINT), 0))", {"v": "42"}, "42"),
    ("trim(v)", {"v": "  hello  "}, "hello"),
    ("array_join(split(v, ','), ';')", {"v": "a,b,c"}, "a;b;c"),
    ("regexp_replace(v, 'b+', 'd')", {"v": "abbc"}, "adc"),
    ("case when v = 'ok' then 'success' else 'failure' end", {"v": "ok"}, "success"),
    ("string(try_cast(v AS BIGINT) div 8)", {"v": "134"}, "16"),
    ("concat(v, ':', w)", {"v": "host", "w": "22"}, "host:22"),
    ("concat(v, ':', w)", {"w": "22"}, ":22"),
    ("array_join(transform(split(v, ','), x -> upper(x)), '')", {"v": "a,b"}, "AB"),
])
def test_safe_expressions(spark, expr, groups, expected):
    df = spark.createDataFrame([(groups,)], "groups map<string,string>")
    assert df.select(safe_expr(expr, ["name", "v", "w"])).first()[0] == expected
    assert expression_error(spark, expr, ["name", "v", "w"]) is None


@pytest.mark.parametrize("expr", [
    "reflect('java.lang.System', 'exit')", "java_method('a', 'b')", "(select 1)", "`v`", "v.x", "v[0]", "unknown",
    "v; drop", "v -- x", "v /* x */", "v % 0", "v div w", "v + 1", "cast(v as int)", "raise_error(v)", "input_file_name()",
    "sequence(1, v)", "\"v\"", "__class__", "assert_true(false)", "current_user()",
])
def test_unsafe_expressions(expr):
    with pytest.raises(UnsafeExpression):
        rewrite(expr, frozenset(["v", "w"]), str)


@pytest.mark.parametrize("expr", ["v = 5", "abs(v)", "regexp_replace(v, '(', '')", "upper(v, v)"])
def test_expressions_that_could_raise(spark, expr):
    assert expression_error(spark, expr, ["v"])


@pytest.mark.parametrize("column,expected", [
    (lambda t: fx.trim(t), "a b c"),
    (lambda t: fx.to_int(t), 0),
    (lambda t: fx.to_float(F.lit("2.5")), 2.5),
    (lambda t: fx.truncate(F.lit("one two three four"), 12), "one two..."),
    (lambda t: fx.truncate(F.lit("one two three"), 12), "one two three"),
    (lambda t: fx.join(fx.split(F.lit("a.b.c"), "."), ";"), "a;b;c"),
    (lambda t: fx.first(F.array(F.lit("x"), F.lit("y"))), "x"),
    (lambda t: fx.last(F.array(F.lit("x"), F.lit("y"))), "y"),
    (lambda t: fx.first(F.array().cast("array<string>")), None),
    (lambda t: fx.title(F.lit("hello world-x (abc) o'neil")), "Hello World-X (Abc) O'neil"),
    (lambda t: fx.capitalize(F.lit("hELLO wORLD")), "Hello world"),
    (lambda t: fx.wordcount(F.lit("héllo big-world")), 3),
    (lambda t: fx.center(F.lit("abc"), 8), "abc".center(8)),
    (lambda t: fx.center(F.lit("abcd"), 9), "abcd".center(9)),
    (lambda t: fx.indent(F.lit("a\n\nb")), "a\n\n    b"),
    (lambda t: fx.regex_replace(F.lit("ab"), "(a)(b)", r"\2\1$"), "ba$"),
    (lambda t: fx.sort(F.array(*map(F.lit, "bAaB"))), ["A", "a", "b", "B"]),
    (lambda t: fx.unique(F.array(*map(F.lit, "bAaB"))), ["b", "A"]),
    (lambda t: fx.characters(F.lit("ab")), ["a", "b"]),
    (lambda t: fx.batch(F.array(*map(F.lit, "abcde")), 2), [["a", "b"], ["c", "d"], ["e"]]),
    (lambda t: fx.slices(F.array(*map(F.lit, "abcde")), 3), [["a", "b"], ["c", "d"], ["e"]]),
    (lambda t: fx.default(F.lit(""), F.lit("x")), ""),
    (lambda t: fx.to_bool_word(F.lit("")), False),
])
def test_text_functions(spark, column, expected):
    assert value(spark, column(F.col("t")), t=" a b c\x1c ") == expected


# ---------------------------------------------------------------- triage


@pytest.mark.parametrize("payload,tag", [("All GOOD", "Low"), ("ACCESS DENIED", "High"), ("a default", "High"), ("", "Low")])
def test_harm_tag(spark, payload, tag):
    assert value(spark, harm_tag(F.col("p")), p=payload) == tag


def test_labels(spark):
    assert value(spark, detail_label(F.col("p"), F.lit(300200)), p='{"eventid" : 4624}') == "EventID: 4624"
    assert value(spark, detail_label(F.col("p"), F.lit(300200)), p="x") == "UID: 300200"
    assert value(spark, detail_label(F.col("p"), F.lit(None)), p="x") == "N/A"
    assert value(spark, preview(F.col("p")), p="x" * 60) == "x" * 50 + "..."


TEXTS = ["hello wOrld-foo (bar) [x] {y} <z", "a.b..c", "", "The quick  brown fox jumps over the lazy dog " * 8, "one\ntwo\n\nthree", "b,A,a,B,c", "9"]


@pytest.mark.parametrize("expr,column", [
    ("title(v)", lambda v: fx.title(v)), ("capitalize(v)", lambda v: fx.capitalize(v)),
    ("truncate(v, 30)", lambda v: fx.truncate(v, 30)), ("truncate(v)", lambda v: fx.truncate(v)),
    ("wordcount(v)", lambda v: fx.wordcount(v)), ("center(v, 21)", lambda v: fx.center(v, 21)),
    ("center(v, 20)", lambda v: fx.center(v, 20)), ("indent(v, 2)", lambda v: fx.indent(v, 2)),
    ("first(split(v, '.'))", lambda v: fx.first(fx.split(v, "."))), ("last(split(v, ','))", lambda v: fx.last(fx.split(v, ","))),
    ("join(unique(split(v, ',')), '|')", lambda v: fx.join(fx.unique(fx.split(v, ",")), "|")),
    ("join(sort(split(v, ',')))", lambda v: fx.join(fx.sort(fx.split(v, ",")))),
    ("size(batch(split(v, ','), 2))", lambda v: F.size(fx.batch(fx.split(v, ","), 2))),
    ("default(absent, 'x')", lambda v: F.lit("x")), ("upper(title(v))", lambda v: F.upper(fx.title(v))),
])
def test_template_functions_in_definitions(spark, expr, column):
    """They say what the Column functions say, and none can raise."""
    df = spark.createDataFrame([(t,) for t in TEXTS], "v string").withColumn("groups", F.create_map(F.lit("v"), F.col("v")))
    rows = df.select(safe_expr(expr, ["v", "absent"]).cast("string").alias("got"), column(F.col("v")).cast("string").alias("want")).collect()
    assert [r.got for r in rows] == [r.want for r in rows]
    assert expression_error(spark, expr, ["v", "absent"]) is None


@pytest.mark.parametrize("expr", ["center(v, v)", "truncate()", "split(v, v)", "batch(v)", "split(v, '')", "upper(v))", "batch(v, 0)", "split(v, '\\E')"])
def test_refused_calls(expr):
    with pytest.raises(UnsafeExpression):
        rewrite(expr, frozenset(["v"]), str)


@pytest.mark.parametrize("expr", ["abs(v)", "case when v > 5 then 'a' end", "regexp_replace(v, '(', '')"])
def test_definitions_with_raising_expressions_are_refused(spark, expr):
    doc = {"name": "d", "version": "1.0.0", "author": "human", "created_at": "2026-09-06", "vendor": "x", "log_format": "text",
           "ocsf_class": "base_event", "ocsf_category_uid": 0, "ocsf_class_uid": 0, "match_patterns": ["(?P<v>.*)"],
           "field_mappings": [{"ocsf_field": "message", "expr": expr}]}
    with pytest.raises(InvalidDefinition):
        parse_definition(doc)
    doc["field_mappings"][0]["expr"] = "truncate(title(v), 20)"
    assert parse_definition(doc).name == "d"


@pytest.mark.parametrize("expr", [
    "sequence(1, 100000000)", "sequence(1, 5, 0)", "sequence(5, 1, 1)", "regexp_extract(v, '(a)', 5)", "regexp_extract(v, 'a')", "regexp_replace(v, w, '')",
    "regexp_replace(v, 'a', '$1')", "regexp_replace(v, 'a', w)", "regexp_replace(v, '(a|b)*', '')", "regexp_count(v, '(?:ab)+')", "rlike(v, w)",
    "v like w", "v like 'a\\\\b'", "split_part(v, ',', 0)", "lpad(v, 100000, 'x')", "rpad(v, try_cast(w as int), 'x')", "slice(split(v, ','), 0, 1)",
    "slice(split(v, ','), 1, -1)", "try_element_at(split(v, ','), 0)", "try_element_at(split(v, ','), try_cast(w as int))", "map('a', v, 'a', w)",
    "map(v, w)", "replace(v, 'a', w)", "array_join(split(v, ','), w)", "concat_ws(w, split(v, ','))", "transform(split(v, ','), x -> v)",
    "try_cast(v as bigint) div -1", "round(try_cast(v as bigint), -1)", "array_join(transform(split(v, ','), x -> lpad(x, 500)), 'abc')",
    "regexp_replace(v, '(', '')", "regexp_extract(v, '[(]', 1)", "center(v, 5000)", "transform(sequence(1, 500), x -> lpad('a', 500, 'b'))",
])
def test_expressions_that_could_raise_or_grow_are_refused_unseen(expr):
    """Before anything runs."""
    with pytest.raises(UnsafeExpression):
        rewrite(expr, frozenset(["v", "w"]), str)


TOTAL = [
    "string(abs(try_cast(v AS BIGINT)))", "regexp_extract(v, '([0-9]+)', 1)", "regexp_extract(v, '[(]', 0)", "regexp_replace(v, '(.)[)]', '$1')",
    "lpad(v, 100, w)", "split_part(v, w, -1)", "case when v like '%(%' then w else v end", "array_join(slice(split(v, '('), -1, 1), '|')",
    "try_element_at(split(v, ','), 2)", "string(try_cast(v AS BIGINT) div 2)", "string(round(try_cast(v AS DOUBLE), 2))", "concat_ws(';', v, w)",
    "string(size(sequence(1, 900)))", "replace(v, w, 'zz')", "string(rlike(v, '^[(]*+$'))", "truncate(title(v), 20)", "center(v, 80)", "left(v, try_cast(w AS INT))",
    "substring(v, try_cast(w AS INT), 5)", "string(try_add(try_cast(v AS BIGINT), try_cast(w AS BIGINT)))", "join(sort(unique(split(v, ','))), ';')",
    "try_element_at(map('a', v, 'b', w), 'a')", "string(greatest(try_cast(v AS INT), 3))",
]


@pytest.mark.parametrize("expr", TOTAL)
def test_accepted_expressions_take_every_pair_of_hostile_values(spark, expr):
    from lognorm.functions.expressions import HOSTILE

    assert expression_error(spark, expr, ["v", "w"]) is None
    df = spark.createDataFrame([({"v": a, "w": b},) for a in HOSTILE for b in HOSTILE], "groups map<string,string>")
    assert len(df.select(F.length(safe_expr(expr, ["v", "w"]).cast("string")).alias("n")).collect()) == len(HOSTILE) ** 2


def test_counter_rates_by_series_over_small_ranges(spark):
    """Ranges of about 50 rows, one series with most of them, a null series, gaps and restarts."""
    import random
    from datetime import datetime, timedelta

    from lognorm.operators.recent import rate_from_counter

    rng = random.Random(3)
    rows = [(rng.choice(["a", "a", "a", "a", "b", None]), datetime(2026, 1, 1) + timedelta(milliseconds=n), rng.randint(0, 99), n) for n in range(1000)]
    df = spark.createDataFrame(rng.sample(rows, len(rows)), "name string, ts timestamp, value long, n long")
    want, last = {}, {}
    for name, _, value, n in rows:
        want[n] = max(value - last.get(name, 0), 0)
        last[name] = value
    got = rate_from_counter(df, series="name", rows=50)
    assert got.columns == ["name", "ts", "value", "n", "rate"]
    assert {r["n"]: r["rate"] for r in got.collect()} == want
    fullest = df.repartitionByRange(20, "name", "ts").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    assert fullest <= 150
    assert rate_from_counter(df.limit(0), series="name").collect() == []


def test_counter_rates_write_nothing_down_and_shuffle_samples_once(spark, capsys):
    """Most samples in one instant of a long span; some without time; ranges need no checkpoint and no join."""
    from lognorm.operators.recent import rate_from_counter

    df = spark.sql("SELECT i % 3 AS name, IF(i < 20, NULL, timestamp_micros(IF(i < 900, i, i * 1000000000))) AS ts, i * 7 % 31 AS value "
                   "FROM range(1000) AS r(i)").where("ts IS NOT NULL OR name = 0")
    got = rate_from_counter(df, series="name", rows=50)
    want = rate_from_counter(df, series="name", rows=10_000)
    timed = lambda rates: sorted(map(tuple, rates.where("ts IS NOT NULL").collect()))
    assert got.count() == df.count()
    assert [r for r in timed(got) if r[0] > 0] == [r for r in timed(want) if r[0] > 0]
    got.explain()
    plan = capsys.readouterr().out
    assert "ExistingRDD" not in plan and "Join" not in plan
    assert plan.count("REPARTITION_BY_NUM") == 1

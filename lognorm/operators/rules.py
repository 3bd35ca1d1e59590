"""Checks of parser definitions as a rule table over a DataFrame of definitions.

The rules are those of a single document in ``sources.parsers.violations`` as far as typed
columns can break them; this form checks whole registries, such as all drafts pending review.
"""

from __future__ import annotations

from functools import lru_cache

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lognorm.functions.coerce import FIELD_TYPES
from lognorm.functions.expressions import UnsafeExpression, rewrite
from lognorm.functions.patterns import judged
from lognorm.schema import CLASS_FIELDS, KNOWN_CLASS_UIDS, OBJECTS, OCSF_CLASSES, members
from lognorm.sources.parsers import AUTHOR, DEFAULT_PRIORITY, REQUIRED, SEMVER, ParserDef

PARSER_DEFS = T.StructType([
    T.StructField("file", T.StringType()),
    T.StructField("is_object", T.BooleanType()),
    *[T.StructField(n, T.StringType()) for n in
      ("name", "version", "author", "created_at", "description", "vendor", "log_format")],
    T.StructField("match_patterns", T.ArrayType(T.StringType())),
    T.StructField("match_priority", T.LongType()),
    T.StructField("ocsf_class", T.StringType()),
    T.StructField("ocsf_category_uid", T.LongType()),
    T.StructField("ocsf_class_uid", T.LongType()),
    T.StructField("field_mappings", T.ArrayType(T.StructType([
        T.StructField(n, T.StringType()) for n in ("ocsf_field", "type", "expr", "default")]))),
    T.StructField("static_values", T.MapType(T.StringType(), T.StringType())),
])


def parser_table(spark: SparkSession, defs: list[ParserDef]) -> DataFrame:
    """Loaded definitions as rows, in routing order."""
    def text(value: object) -> str | None:
        return None if value is None else str(value)

    rows = [(
        d.file, True, d.name, d.version, d.author, d.created_at, d.description, d.vendor, d.log_format,
        list(d.match_patterns), d.match_priority, d.ocsf_class, d.ocsf_category_uid, d.ocsf_class_uid,
        [(m.ocsf_field, m.type, m.expr, text(m.default)) for m in d.field_mappings],
        {k: text(v) for k, v in d.static_values.items()},
    ) for d in defs]
    return routing_order(spark.createDataFrame(rows, PARSER_DEFS))


def _rank() -> list[Column]:
    return [F.coalesce("match_priority", F.lit(DEFAULT_PRIORITY)), F.col("file")]


def routing_order(parser_df: DataFrame) -> DataFrame:
    return parser_df.orderBy(*_rank())


def routing_places(parser_df: DataFrame, registry: str) -> DataFrame:
    """Adds ``place``, from 1: the routing position within the registry a definition belongs to."""
    return parser_df.withColumn("place", F.row_number().over(W.partitionBy(registry).orderBy(*_rank())).cast("long"))


@F.pandas_udf(T.ArrayType(T.StringType()))
def _regex_errors(patterns: pd.Series) -> pd.Series:
    """Per pattern why it does not compile, null when it does."""
    return patterns.map(lambda ps: None if ps is None else [None if p is None else judged(p)[0] for p in ps])


@lru_cache(maxsize=16_384)
def _unsafe(expression: str, names: frozenset[str]) -> str | None:
    """Why an expression over these group names is refused, None when it is not."""
    try:
        rewrite(expression, names, str)
    except UnsafeExpression as exc:
        return str(exc)
    return None


@F.pandas_udf(T.ArrayType(T.StringType()))
def _expression_errors(patterns: pd.Series, expressions: pd.Series) -> pd.Series:
    """What the static check of a document says about its mappings' expressions."""

    def errors(ps, es) -> list[str]:
        names = frozenset().union(*[judged(p)[1] for p in (ps if ps is not None else []) if p is not None])
        found = ((i, _unsafe(e, names)) for i, e in enumerate(es if es is not None else []) if e)
        return [f"field_mappings[{i}]: {error}" for i, error in found if error is not None]

    return pd.Series([errors(p, e) for p, e in zip(patterns, expressions, strict=True)])


def _judged(parser_df: DataFrame) -> DataFrame:
    """The definitions with ``found``: the rules each breaks."""
    c = F.col

    def broken(rule: str, when: Column, detail: Column) -> Column:
        return F.when(when, F.struct(F.lit(rule).alias("rule"), detail.cast("string").alias("detail")))

    checks = [
        broken("not_an_object", ~c("is_object"), F.lit(None)),
        *[broken("missing", c("is_object") & c(n).isNull(), F.lit(n)) for n in REQUIRED],
        broken("semver", ~c("version").rlike(SEMVER), c("version")),
        broken("author", ~c("author").rlike(AUTHOR), c("author")),
        broken("created_at", c("created_at").isNotNull() & c("created_at").try_cast("timestamp").isNull(), c("created_at")),
        broken("ocsf_class", ~c("ocsf_class").isin(*OCSF_CLASSES), c("ocsf_class")),
        broken("class_uid", ~c("ocsf_class_uid").isin(*KNOWN_CLASS_UIDS), c("ocsf_class_uid")),
        broken("field_type",
               F.exists("field_mappings", lambda m: ~F.coalesce(m["type"], F.lit("str")).isin(*FIELD_TYPES)),
               F.array_join(F.array_distinct(F.transform("field_mappings", lambda m: m["type"])), ",")),
    ]
    listed = F.transform(
        c("regex_errors"), lambda e, i: F.when(e.isNotNull(), F.struct(
            F.lit("regex").alias("rule"), F.concat(F.lit("match_patterns["), i, F.lit("]")).alias("detail"))))
    unsafe = F.transform(
        c("expression_errors"), lambda e: F.struct(F.lit("expression").alias("rule"), e.alias("detail")))
    found = F.array_compact(F.concat(F.array(*checks), F.coalesce(listed, F.array()), F.coalesce(unsafe, F.array())))
    return (
        parser_df.withColumn("regex_errors", _regex_errors("match_patterns"))
        .withColumn("expression_errors", _expression_errors("match_patterns", "field_mappings.expr"))
        .withColumn("found", found).drop("regex_errors", "expression_errors")
    )


def rule_violations(parser_df: DataFrame) -> DataFrame:
    """``file, rule, detail``: one row per broken rule. An empty pattern list breaks none."""
    return _judged(parser_df).select("file", F.inline("found"))


def valid_definitions(parser_df: DataFrame) -> DataFrame:
    """Definitions that break no rule; each is judged on its own, whatever its namesakes do."""
    return _judged(parser_df).filter(F.size("found") == 0).drop("found")


def lint_paths(parser_df: DataFrame) -> DataFrame:
    """Mapped paths the event model of the class does not have; they would vanish silently."""
    spark = parser_df.sparkSession
    rows = ", ".join(f"('{cls}', '{p}')" for cls in OCSF_CLASSES for p in _paths(CLASS_FIELDS[cls]))
    known = F.broadcast(spark.sql(f"SELECT * FROM VALUES {rows} AS t(ocsf_class, path)"))
    mapped = parser_df.select("file", "ocsf_class", F.explode("field_mappings.ocsf_field").alias("path"))
    return mapped.filter(~F.col("path").startswith("unmapped.")).join(known, ["ocsf_class", "path"], "left_anti")


def _paths(fields: dict[str, str], prefix: str = "") -> list[str]:
    out = []
    for name, kind in fields.items():
        out.append(prefix + name)
        if kind in OBJECTS:
            out += _paths({n: t for n, (t, _) in members(kind).items()}, f"{prefix}{name}.")
    return out

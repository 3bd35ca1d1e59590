"""Captures to OCSF events, compiled from the definitions into column expressions.

Three projections, no shuffle: captures (``route``), one flat column per event leaf that
any definition writes, then the nested struct over those columns.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.functions.coerce import coerce_sql
from lognorm.functions.expressions import UnsafeExpression, rewrite, tried_error
from lognorm.functions.sql import array, case, literal, named_struct, null
from lognorm.operators.route import capture, extract_captures
from lognorm.schema import (
    ALL_FIELDS, CLASS_FIELDS, ENGINE_FIELDS, ENUMS, OBJECTS, OCSF_EVENT, OCSF_VERSION, Leaf,
    kind_at, leaves, members, spark_type,
)
from lognorm.sources.parsers import FieldMapping, ParserDef

ERROR_TYPE = "STRUCT<field: STRING, code: STRING, input: STRING>"
ENUM_MODES = ("code", "instance")
UNMAPPED_MODES = ("merge", "replace")

# Declared mapping type -> model type it satisfies without coercion.
_STRICT = {"str": "str", "datetime": "str", "int": "int", "bool": "bool", "float": "float"}


def error(path: str, code: str, value: str = "NULL") -> str:
    return named_struct({"field": literal(path), "code": literal(code), "input": f"CAST({value} AS STRING)"})


def sql_type(kind: str) -> str:
    return spark_type(kind).simpleString()


@dataclass
class _Compiled:
    """SQL expressions of one definition."""

    values: dict[str, str] = field(default_factory=dict)  # leaf path -> typed value
    unmapped: dict[str, str] = field(default_factory=dict)  # key -> text
    errors: list[str] = field(default_factory=list)  # null when all is well


def normalize(
    df: DataFrame,
    defs: list[ParserDef],
    enum_mode: str = "code",
    unmapped_mode: str = "merge",
    fenced: bool = True,
) -> DataFrame:
    """Adds ``event`` (null when no definition matches) and ``type_errors``.

    ``enum_mode="instance"`` makes every explicitly supplied enum value an error;
    ``unmapped_mode="replace"`` lets left-over captures displace mapped ``unmapped.*`` keys.
    ``fenced=False`` is for callers that put the fence further up.
    """
    if enum_mode not in ENUM_MODES or unmapped_mode not in UNMAPPED_MODES:
        raise ValueError(f"enum_mode is one of {ENUM_MODES}, unmapped_mode of {UNMAPPED_MODES}")
    compiled = [_compile(d, enum_mode) for d in defs]
    used = [leaf for leaf in leaves(ALL_FIELDS) if any(leaf.path in c.values for c in compiled)]
    no_errors = f"CAST(array() AS ARRAY<{ERROR_TYPE}>)"
    type_errors = _by_parser([_collect(c.errors) for c in compiled], f"ARRAY<{ERROR_TYPE}>")
    flat = extract_captures(df, defs).selectExpr(
        "*",
        *[_by_parser([c.values.get(leaf.path) for c in compiled], sql_type(leaf.kind)) + f" AS {leaf.column}"
          for leaf in used],
        _unmapped(defs, compiled, unmapped_mode) + " AS leaf_unmapped",
        f"coalesce({type_errors}, {no_errors}) AS type_errors",
    )
    helper = [leaf.column for leaf in used] + ["leaf_unmapped", "pattern_no"]
    mapped = flat.withColumn("event", F.expr(_event(defs, {leaf.path for leaf in used}))).drop(*helper)
    return fence(mapped, ["event"]) if fenced else mapped


def fence(df: DataFrame, columns: list[str]) -> DataFrame:
    """Passes columns through ``inline``, so that filters on them stay above.

    Pushed below, a filter on an event member would unfold the mapping of every leaf into
    itself, and planning would take minutes.
    """
    kept = [c for c in df.columns if c not in columns]
    return df.select(*kept, F.expr(f"inline(array({named_struct({c: c for c in columns})}))"))


# ------------------------------------------------------------------ one definition


def _compile(d: ParserDef, enum_mode: str) -> _Compiled:
    fields = CLASS_FIELDS[d.ocsf_class]
    out = _Compiled()
    for i, m in enumerate(d.field_mappings):
        text = _source_text(d, m)
        present = f"length({text}) > 0"
        covered = any(later.ocsf_field.startswith(m.ocsf_field + ".") for later in d.field_mappings[i + 1:])
        _assign(out, fields, m.ocsf_field, coerce_sql(text, m.type), _STRICT[m.type], present, enum_mode, covered)
        if m.default is not None:
            absent = f"NOT coalesce({present}, FALSE)"
            _assign_literal(out, fields, m.ocsf_field, m.default, absent, enum_mode)
    for path, value in d.static_values.items():
        if isinstance(value, dict) and kind_at(fields, path) in OBJECTS:
            out.values = {p: v for p, v in out.values.items() if not p.startswith(path + ".")}
        _assign_literal(out, fields, path, value, "TRUE", enum_mode)
    _classify(out, d, enum_mode)
    return out


def _source_text(d: ParserDef, m: FieldMapping) -> str:
    if not m.expr:
        return capture(d, m.leaf)
    error = tried_error(m.expr, frozenset(d.group_names))
    if error:
        raise UnsafeExpression(f"{d.name}, {m.ocsf_field}: {error}")
    text = rewrite(m.expr, frozenset(d.group_names), lambda name: capture(d, name))
    return f"CAST({text} AS STRING)"


def _assign(out: _Compiled, fields: dict[str, str], path: str, value: str, given: str,
            when: str, enum_mode: str, covered: bool = False) -> None:
    """Record ``value`` at ``path`` where ``when`` holds; a later value of the path wins."""
    if path.split(".")[0] in ENGINE_FIELDS:
        return  # rebuilt by the engine
    kind, value = kind_at(fields, path), case([(when, value)])
    if kind == "any":
        key = path.split(".", 1)[1]
        if path.startswith("unmapped."):
            out.unmapped[key] = _later(f"CAST({value} AS STRING)", out.unmapped.get(key))
        return
    if kind is None:
        parent = _scalar_parent(fields, path)
        if parent:
            out.errors.append(case([(f"{value} IS NOT NULL", error(parent, "type", value))]))
        return  # unknown paths vanish; the lint reports them
    needed = "int" if kind in ENUMS else kind
    if needed == given and not (kind in ENUMS and enum_mode == "instance"):
        out.values[path] = _later(value, out.values.get(path))
    elif not covered:  # an object written below later replaces the scalar
        code = "enum_instance" if kind in ENUMS and needed == given else "type"
        out.errors.append(case([(f"{value} IS NOT NULL", error(path, code, value))]))
        if code == "enum_instance":
            out.values[path] = _later(value, out.values.get(path))


def _assign_literal(out: _Compiled, fields: dict[str, str], path: str, value: Any,
                    when: str, enum_mode: str) -> None:
    """Defaults and static values: typed constants, taken without coercion."""
    kind = kind_at(fields, path)
    if isinstance(value, dict):
        if kind in OBJECTS or path == "unmapped":
            for name, inner in value.items():
                _assign_literal(out, fields, f"{path}.{name}", inner, when, enum_mode)
            return
        given = "map"
    elif isinstance(value, list):
        given, value = (kind, value) if _list_fits(kind, value) else ("list", value)
    else:
        given = {bool: "bool", int: "int", float: "float", str: "str"}.get(type(value), "none")
    if given == kind and isinstance(value, list):
        column = f"from_json({literal(value)}, {literal(sql_type(kind))})"
    elif isinstance(value, bool) and kind == "any":
        column = literal(str(value).lower())
    else:
        column = literal(value)
    if value is not None:
        _assign(out, fields, path, column, given, when, enum_mode)


def _list_fits(kind: str | None, items: list) -> bool:
    """A constant list against ``list of X``: member types and required members."""
    if not (kind or "").startswith("list of "):
        return False
    item = kind.removeprefix("list of ")
    python = {"str": str, "int": int, "bool": bool, "map": dict}
    if item not in OBJECTS:
        return all(type(x) is python[item] for x in items)
    spec = members(item)
    return all(
        isinstance(x, dict)
        and all(x.get(n) is not None or not required for n, (_, required) in spec.items())
        and all(x.get(n) is None or type(x[n]) is python[t] for n, (t, _) in spec.items())
        for x in items
    )


def _scalar_parent(fields: dict[str, str], path: str) -> str | None:
    """The scalar this path tries to descend into, if that is why it does not exist."""
    steps = path.split(".")
    for n in range(1, len(steps)):
        kind = kind_at(fields, ".".join(steps[:n]))
        if kind is not None and kind not in OBJECTS and kind not in ("map", "any"):
            return ".".join(steps[:n])
    return None


def _later(new: str, old: str | None) -> str:
    return new if old is None else f"coalesce({new}, {old})"


def _classify(out: _Compiled, d: ParserDef, enum_mode: str) -> None:
    """Activity, category, class and severity unless the definition set them."""
    if CLASS_FIELDS[d.ocsf_class]["activity_id"] in ENUMS and enum_mode == "instance" \
            and "activity_id" not in out.values:
        out.errors.append(error("activity_id", "enum_instance", "0"))
    for path, code in (("activity_id", 0), ("category_uid", d.ocsf_category_uid),
                       ("class_uid", d.ocsf_class_uid), ("severity_id", 1)):
        known = out.values.get(path)
        out.values[path] = literal(code) if known is None else f"coalesce({known}, {literal(code)})"


def _collect(errors: list[str]) -> str | None:
    return f"array_compact({array(errors)})" if errors else None


# ------------------------------------------------------------------ all definitions


def _by_parser(columns: list[str | None], spark_type_: str) -> str:
    """The winning definition's value; definitions that agree share a branch."""
    owners: dict[str, list[str]] = {}
    for parser_id, column in enumerate(columns):
        if column is not None:
            owners.setdefault(column, []).append(str(parser_id))
    branches = [(f"parser_id IN ({', '.join(ids)})", column) for column, ids in owners.items()]
    return f"CAST({case(branches)} AS {spark_type_})"


def _unmapped(defs: list[ParserDef], compiled: list[_Compiled], mode: str) -> str:
    """Mapped ``unmapped.*`` keys and left-over captures: non-empty, named like no mapped leaf."""
    def entries(pairs: list[tuple[str, str, str]]) -> str:
        found = [case([(when, named_struct({"key": literal(k), "value": v}))]) for k, v, when in pairs]
        return f"array_compact({array(found)})"

    def build(d: ParserDef, c: _Compiled) -> str | None:
        mapped = [(k, v, f"{v} IS NOT NULL") for k, v in c.unmapped.items()]
        rest = [(n, capture(d, n), f"{capture(d, n)} <> ''") for n in d.group_names if n not in d.mapped_leaves]
        if mode == "replace" and mapped and rest:
            any_left = " OR ".join(f"coalesce({when}, FALSE)" for _, _, when in rest)
            return case([(any_left, entries(rest))], entries(mapped))
        # A mapped key wins over a left-over capture of the same name.
        rest = [(n, v, f"{when} AND {c.unmapped[n]} IS NULL" if n in c.unmapped else when) for n, v, when in rest]
        return entries(mapped + rest) if mapped or rest else None

    pairs = _by_parser([build(d, c) for d, c in zip(defs, compiled)], "ARRAY<STRUCT<key: STRING, value: STRING>>")
    return f"map_from_entries({pairs})"


def _event(defs: list[ParserDef], used: set[str]) -> str:
    if not defs:
        return null(OCSF_EVENT.simpleString())
    processed = "unix_millis(ingest_ts)"
    product = [named_struct({
        "name": literal(d.name), "vendor_name": literal(d.vendor), "version": literal(d.version),
        "uid": null("STRING"),
    }) for d in defs]
    engine = {
        "time": processed,
        "metadata": named_struct({
            "version": literal(OCSF_VERSION),
            "product": _by_parser(product, sql_type("Product")),
            "logged_time": null("BIGINT"),
            "processed_time": processed,
            "original_time": null("STRING"),
            "profiles": null("ARRAY<STRING>"),
            "uid": null("STRING"),
        }),
        "raw_data": "payload",
        "raw_data_hash": named_struct({
            "algorithm": literal("SHA-256"), "algorithm_id": literal(3), "value": "raw_sha256"}),
        "raw_data_size": "CAST(octet_length(raw) AS BIGINT)",
        "unmapped": case([("size(leaf_unmapped) > 0", "leaf_unmapped")]),
    }
    parts = {name: engine.get(name) or _tree(name, kind, used) for name, kind in ALL_FIELDS.items()}
    class_uid, activity_id = Leaf("class_uid", "int").column, Leaf("activity_id", "int").column
    parts["type_uid"] = f"{class_uid} * 100L + {activity_id}"
    return case([("parser_id IS NOT NULL", named_struct(parts))])


def _tree(path: str, kind: str, used: set[str]) -> str:
    """SQL for a position; an object is null unless one of its leaves has a value."""
    if kind not in OBJECTS:
        return Leaf(path, kind).column if path in used else null(sql_type(kind))
    below = [leaf for leaf in leaves({path: kind}) if leaf.path in used]
    if not below:
        return null(sql_type(kind))
    whole = named_struct({n: _tree(f"{path}.{n}", t, used) for n, (t, _) in members(kind).items()})
    return case([(" OR ".join(f"{leaf.column} IS NOT NULL" for leaf in below), whole)])

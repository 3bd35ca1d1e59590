"""Event validation with a complete error list per record."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lognorm.functions.sql import array, case, literal
from lognorm.operators.normalize import error, fence
from lognorm.schema import ALL_FIELDS, CLASS_FIELDS, ENGINE_FIELDS, ENUMS, OBJECTS, VALIDATION_PREFIX, members
from lognorm.sources.parsers import ParserDef

SUCCESS, INVALID, UNMATCHED = "success", "validation_error", "dlq"
# What the size guard turned away; such records are dead letters too.
OVERSIZE, NO_PAYLOAD = "oversize", "null_payload"
# What a stream could not take in order any more.
LATE = "late"


def validate(df: DataFrame, defs: list[ParserDef], enum_mode: str = "code") -> DataFrame:
    """Adds ``errors`` (all of them, strict-type errors first) and ``status``."""
    written = [p for d in defs for p in [*(m.ocsf_field for m in d.field_mappings), *d.static_values]]
    checks = [case([(f"event.{name} IS NULL", error(name, "missing"))]) for name in ("activity_id", "time", "metadata")]
    checks += _required_errors("event", ALL_FIELDS, written)
    if enum_mode == "code":
        checks += _enum_errors(defs)
    found = f"concat(type_errors, array_compact({array(checks)}))"
    errors = case([("parser_id IS NOT NULL", found)], "type_errors")
    status = case([("parser_id IS NULL", literal(UNMATCHED)), ("size(errors) > 0", literal(INVALID))], literal(SUCCESS))
    checked = df.withColumn("errors", F.expr(errors)).drop("type_errors")
    return fence(checked.withColumn("status", F.expr(status)), ["event", "errors", "status"])


def error_text(errors: Column) -> Column:
    """One line per error, in the form kept with dead letters."""
    lines = F.transform(errors, lambda e: F.concat_ws(" ", e["field"], e["code"], F.concat(F.lit("input="), e["input"])))
    return F.concat(F.lit(VALIDATION_PREFIX), F.array_join(lines, "; "))


def _required_errors(parent: str, fields: dict[str, str], written: list[str]) -> list[str]:
    """Members an object must have once it is there.

    Only objects some definition writes to; those the engine builds are always whole.
    """
    out = []
    for name, kind in fields.items():
        path = f"{parent}.{name}"
        inner = path.removeprefix("event.")
        if kind not in OBJECTS or inner in ENGINE_FIELDS or not any(
                f"{w}.".startswith(f"{inner}.") or inner.startswith(f"{w}.") for w in written):
            continue
        for member, (_, required) in members(kind).items():
            if required:
                missing = f"{path} IS NOT NULL AND {path}.{member} IS NULL"
                out.append(case([(missing, error(f"{inner}.{member}", "missing"))]))
        out += _required_errors(path, {n: k for n, (k, _) in members(kind).items()}, written)
    return out


def _enum_errors(defs: list[ParserDef]) -> list[str]:
    """Codes outside their enum; which enum applies can depend on the event class."""
    out = []
    for name in ALL_FIELDS:
        by_enum: dict[str, list[str]] = {}
        for parser_id, d in enumerate(defs):
            kind = CLASS_FIELDS[d.ocsf_class].get(name)
            if kind in ENUMS:
                by_enum.setdefault(kind, []).append(str(parser_id))
        # A status nobody writes is absent; activity and severity always have a code.
        if name == "status_id" and not any(p.split(".")[0] == name for d in defs for p in
                                           [*(m.ocsf_field for m in d.field_mappings), *d.static_values]):
            continue
        for enum, parser_ids in by_enum.items():
            codes = ", ".join(str(c) for c in ENUMS[enum])
            bad = f"parser_id IN ({', '.join(parser_ids)}) AND event.{name} NOT IN ({codes})"
            out.append(case([(bad, error(name, "enum", f"event.{name}"))]))
    return out

"""Parser definitions: the record, its validity rules, and loading a directory of files.

Definitions are declarative data. A handful to a few thousand small files are read on the
driver; ``parser_table`` turns them into a DataFrame for checks at any scale
(``operators.rules``).
"""

from __future__ import annotations

import json
import re
from dataclasses import dataclass, field
from datetime import datetime
from pathlib import Path
from typing import Any

from lognorm.functions.coerce import FIELD_TYPES
from lognorm.functions.expressions import UnsafeExpression, rewrite, tried_error
from lognorm.functions.patterns import regex_error, to_spark
from lognorm.schema import KNOWN_CLASS_UIDS, OCSF_CLASSES

# Semantic Versioning 2.0.0: no leading zeros in numbers, pre-release and build as dotted identifiers.
_NUMBER = "(?:0|[1-9][0-9]*)"
_PRE = "(?:0|[1-9][0-9]*|[0-9]*[A-Za-z-][0-9A-Za-z-]*)"
_BUILD = "[0-9A-Za-z-]+"
SEMVER = rf"^{_NUMBER}\.{_NUMBER}\.{_NUMBER}(?:-{_PRE}(?:\.{_PRE})*)?(?:\+{_BUILD}(?:\.{_BUILD})*)?$"
AUTHOR = r"^(human$|ai:)"
REQUIRED = (
    "name", "version", "author", "created_at", "vendor", "log_format", "match_patterns",
    "ocsf_class", "ocsf_category_uid", "ocsf_class_uid", "field_mappings",
)
DEFAULT_PRIORITY = 100


class InvalidDefinition(ValueError):
    def __init__(self, file: str, violations: list[tuple[str, str]]):
        self.file, self.violations = file, violations
        super().__init__(f"{file}: " + "; ".join(f"{r} ({d})" for r, d in violations))


@dataclass(frozen=True)
class FieldMapping:
    ocsf_field: str
    type: str = "str"
    expr: str | None = None
    default: Any = None

    @property
    def leaf(self) -> str:
        return self.ocsf_field.split(".")[-1]


@dataclass(frozen=True)
class ParserDef:
    name: str
    version: str
    author: str
    created_at: str
    vendor: str
    log_format: str
    match_patterns: tuple[str, ...]
    ocsf_class: str
    ocsf_category_uid: int
    ocsf_class_uid: int
    field_mappings: tuple[FieldMapping, ...]
    static_values: dict[str, Any] = field(default_factory=dict, hash=False)
    match_priority: int = DEFAULT_PRIORITY
    description: str | None = None
    file: str = ""

    @property
    def mapped_leaves(self) -> list[str]:
        return sorted({m.leaf for m in self.field_mappings})

    @property
    def group_names(self) -> list[str]:
        """Names of all patterns, in order of appearance."""
        return list(dict.fromkeys(n for p in self.match_patterns for n in to_spark(p).names if n))


def violations(doc: Any) -> list[tuple[str, str]]:
    """Every rule a single definition document breaks, as (rule, detail)."""
    if not isinstance(doc, dict):
        return [("not_an_object", type(doc).__name__)]
    found = [("missing", name) for name in REQUIRED if doc.get(name) is None]

    def wrong(name: str, ok: bool, rule: str) -> None:
        if doc.get(name) is not None and not ok:
            found.append((rule, str(doc[name])))

    wrong("version", bool(re.match(SEMVER, str(doc.get("version")))), "semver")
    wrong("author", bool(re.match(AUTHOR, str(doc.get("author")))), "author")
    wrong("created_at", _is_timestamp(doc.get("created_at")), "created_at")
    wrong("ocsf_class", doc.get("ocsf_class") in OCSF_CLASSES, "ocsf_class")
    wrong("ocsf_class_uid", _as_int(doc.get("ocsf_class_uid")) in KNOWN_CLASS_UIDS, "class_uid")
    wrong("ocsf_category_uid", _as_int(doc.get("ocsf_category_uid")) is not None, "category_uid")
    wrong("match_priority", _as_int(doc.get("match_priority")) is not None, "priority")
    patterns = doc.get("match_patterns") or []
    if not isinstance(patterns, list) or not all(isinstance(p, str) for p in patterns):
        found.append(("patterns", "a list of texts is needed"))
        patterns = []
    for i, pattern in enumerate(patterns):
        error = regex_error(pattern)
        if error:
            found.append(("regex", f"match_patterns[{i}]: {error}"))
    found += _mapping_violations(doc, [p for p in patterns if not regex_error(p)])
    if not isinstance(doc.get("static_values") or {}, dict):
        found.append(("static_values", "an object is needed"))
    return found


def _mapping_violations(doc: dict, patterns: list[str]) -> list[tuple[str, str]]:
    mappings = doc.get("field_mappings") or []
    if not isinstance(mappings, list) or not all(isinstance(m, dict) for m in mappings):
        return [("mappings", "a list of objects is needed")]
    names = frozenset(n for p in patterns for n in to_spark(p).names if n)
    found = []
    for i, m in enumerate(mappings):
        if not isinstance(m.get("ocsf_field"), str):
            found.append(("mappings", f"field_mappings[{i}] has no ocsf_field"))
        if m.get("type", "str") not in FIELD_TYPES:
            found.append(("field_type", str(m.get("type"))))
        try:
            if m.get("expr"):
                rewrite(m["expr"], names, str)
                error = tried_error(m["expr"], names)
                if error:
                    raise UnsafeExpression(error)
        except UnsafeExpression as exc:
            found.append(("expression", f"field_mappings[{i}]: {exc}"))
    return found


def _as_int(value: Any) -> int | None:
    try:
        return int(value)
    except (TypeError, ValueError):
        return None


def _is_timestamp(value: Any) -> bool:
    if isinstance(value, datetime):
        return True
    try:
        datetime.fromisoformat(str(value))
    except ValueError:
        return False
    return True


def parse_definition(doc: Any, file: str = "") -> ParserDef:
    found = violations(doc)
    if found:
        raise InvalidDefinition(file, found)
    return ParserDef(
        name=str(doc["name"]), version=str(doc["version"]), author=str(doc["author"]),
        created_at=str(doc["created_at"]), vendor=str(doc["vendor"]),
        log_format=str(doc["log_format"]), match_patterns=tuple(doc["match_patterns"]),
        ocsf_class=doc["ocsf_class"], ocsf_category_uid=int(doc["ocsf_category_uid"]),
        ocsf_class_uid=int(doc["ocsf_class_uid"]),
        field_mappings=tuple(
            FieldMapping(m["ocsf_field"], m.get("type", "str"), m.get("expr"), m.get("default"))
            for m in doc["field_mappings"]
        ),
        static_values=dict(doc.get("static_values") or {}),
        match_priority=int(doc.get("match_priority", DEFAULT_PRIORITY)),
        description=doc.get("description"), file=file,
    )


def definition_document(d: ParserDef) -> dict[str, Any]:
    """The document ``parse_definition`` reads as this definition, for JSON or YAML."""
    doc = {name: getattr(d, name) for name in (*REQUIRED, "match_priority", "static_values", "description") if getattr(d, name) is not None}
    mappings = [{k: v for k, v in vars(m).items() if v is not None} for m in d.field_mappings]
    return doc | {"match_patterns": list(d.match_patterns), "field_mappings": mappings}


def read_document(text: str, yaml_syntax: bool = False) -> Any:
    if not yaml_syntax:
        return json.loads(text)
    import yaml  # optional; JSON needs nothing

    return yaml.safe_load(text)


def load_documents(path: str) -> list[tuple[str, Any]]:
    """(file name, document) for each ``.json``/``.yaml`` file; unreadable ones come as text."""
    folder = Path(path)
    out = []
    for file in sorted(p for p in folder.glob("*") if p.suffix in (".json", ".yaml")):
        text = file.read_text(encoding="utf-8", errors="replace")
        try:
            out.append((file.name, read_document(text, file.suffix == ".yaml")))
        except Exception:  # malformed file: the text itself is reported as "not an object"
            out.append((file.name, text))
    return out


def load_parser(path: str) -> ParserDef:
    file = Path(path)
    text = file.read_text(encoding="utf-8")
    try:
        doc = read_document(text, file.suffix == ".yaml")
    except Exception as exc:
        raise InvalidDefinition(file.name, [("syntax", str(exc))]) from exc
    return parse_definition(doc, file.name)


def load_parsers(path: str) -> list[ParserDef]:
    """Valid definitions of a directory in routing order; invalid ones are skipped.

    A missing or empty directory gives an empty list: every record then goes to the DLQ.
    """
    valid = [parse_definition(doc, name) for name, doc in load_documents(path) if not violations(doc)]
    return in_routing_order(valid)


def usable(text: str, file: str) -> ParserDef | None:
    """The definition a file holds, or None where it holds no valid one."""
    try:
        return parse_definition(read_document(text, file.endswith(".yaml")), file)
    except Exception:  # malformed text or a broken rule: such files are skipped
        return None


def in_routing_order(defs: list[ParserDef]) -> list[ParserDef]:
    """Lowest priority number first, ties by file name."""
    return sorted(defs, key=lambda d: (d.match_priority, d.file))

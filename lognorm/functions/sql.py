"""Helpers for SQL text: plans built from definitions are text, parsed once by Spark."""

from __future__ import annotations

import json
from typing import Any


def literal(value: Any) -> str:
    """A constant as SQL: text, whole number (as BIGINT), float, boolean or null."""
    if value is None:
        return "NULL"
    if isinstance(value, bool):
        return str(value).upper()
    if isinstance(value, int):
        return f"{value}L" if -(2**63) <= value < 2**63 else "CAST(NULL AS BIGINT)"
    if isinstance(value, float):
        return f"CAST({literal(repr(value))} AS DOUBLE)"
    text = value if isinstance(value, str) else json.dumps(value)
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def null(spark_type: str) -> str:
    return f"CAST(NULL AS {spark_type})"


def named_struct(members: dict[str, str]) -> str:
    return "named_struct(" + ", ".join(f"'{name}', {value}" for name, value in members.items()) + ")"


def case(branches: list[tuple[str, str]], otherwise: str | None = None) -> str:
    if not branches:
        return otherwise or "NULL"
    whens = " ".join(f"WHEN {when} THEN {then}" for when, then in branches)
    return f"CASE {whens}{f' ELSE {otherwise}' if otherwise else ''} END"


def array(items: list[str]) -> str:
    return "array(" + ", ".join(items) + ")"

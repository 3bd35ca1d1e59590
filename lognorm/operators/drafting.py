"""Drafting parser definitions from dead letters with a generator the user supplies.

``generate(system, user) -> str`` is any callable that can be shipped to executors. Drafts
are never active: they go to a pending table keyed by the payload hash and a person
promotes them.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lognorm.schema import DRAFT_PREFIX
from lognorm.session import cut_lineage
from lognorm.sources.parsers import (
    InvalidDefinition, ParserDef, in_routing_order, parse_definition, read_document,
)

DLQ_MODES = ("manual", "ollama", "openai")
DRAFTS = (
    "raw_sha256 string, model string, status string, definition string, attempts int, "
    "last_error string, attempt_log array<struct<status:string,latency:double>>"
)
SYSTEM_TEXT = (
    "You write parser definitions for log lines as one JSON object with name, version (SemVer), "
    "author 'ai:{model}', created_at, vendor, log_format, match_patterns (regexes with named "
    "groups), ocsf_class (base_event, authentication or network_activity), ocsf_category_uid, "
    "ocsf_class_uid and field_mappings (ocsf_field, type, optional expr in Spark SQL over the "
    "group names). Answer with the object only."
)
#: Records that one task drafts; they are small, so that Spark alone would put very many into a task.
TASK_DRAFTS = 5_000
_FENCE = re.compile(r"```(?:json|yaml)?\n(.*?)\n```", re.DOTALL)

Generator = Callable[[str, str], str]


class _Breaker:
    """Opens after ``threshold`` failures in a row and stays open."""

    def __init__(self, threshold: int):
        self.threshold, self.failures = threshold, 0

    @property
    def open(self) -> bool:
        return self.failures >= self.threshold


def draft_parsers(
    dlq: DataFrame, generate: Generator, model: str, max_retries: int = 2, breaker: int = 5
) -> DataFrame:
    """One row per distinct dead letter: a valid definition (status ``drafted``) or the last error.

    Distinct records are written down and dealt out, one breaker per partition; repeated payloads
    are drafted once.
    """
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        circuit = _Breaker(breaker)
        for batch in batches:
            yield pd.DataFrame(
                [_draft(*row, generate, model, max_retries, circuit)
                 for row in batch[["raw_sha256", "raw_payload", "error"]].itertuples(index=False)],
                columns=[part.split()[0] for part in re.split(r", (?=\w+ )", DRAFTS)],
            )

    distinct = cut_lineage(dlq.select("raw_sha256", "raw_payload", "error").dropDuplicates(["raw_sha256"]))
    tasks = -(-distinct.count() // TASK_DRAFTS)
    if tasks > 1:
        distinct = distinct.repartition(tasks, "raw_sha256")
    return distinct.mapInPandas(run, DRAFTS)


def _draft(sha256: str, payload: str, reason: str, generate: Generator, model: str,
           max_retries: int, circuit: _Breaker) -> tuple:
    prompt = f"Log line:\n{payload}\nWhy it was not parsed: {reason}"
    last_error, log = "", []
    for _ in range(max_retries + 1):
        if circuit.open:
            break
        started = time.monotonic()
        status = "error"
        try:
            answer = generate(SYSTEM_TEXT.replace("{model}", model), prompt)
        except Exception as exc:  # whatever the generator raises counts against the breaker
            circuit.failures += 1
            last_error = f"Unexpected Error: {exc}"
            log.append({"status": status, "latency": None})
        else:
            latency = time.monotonic() - started
            circuit.failures = 0
            text = strip_fences(answer)
            try:
                doc = _document(text)
                if isinstance(doc, dict):
                    parse_definition(doc)
                    log.append({"status": "success", "latency": latency})
                    return sha256, model, "drafted", text, len(log), None, log
                status, last_error = "not_an_object", "the answer is not an object"
            except InvalidDefinition as exc:
                last_error = "; ".join(f"{rule}: {detail}" for rule, detail in exc.violations)
            except Exception as exc:
                last_error = f"syntax: {exc}"
            log.append({"status": status, "latency": latency})
        prompt += f"\nThe last answer was refused:\n{last_error}\nCorrect it."
    return sha256, model, "failed", None, len(log), last_error, log


def strip_fences(answer: str) -> str:
    fenced = _FENCE.search(answer)
    return (fenced.group(1) if fenced else answer).strip()


def _document(text: str) -> object:
    try:
        return read_document(text)
    except ValueError:
        return read_document(text, yaml_syntax=True)


def draft_attempts(drafts: DataFrame) -> DataFrame:
    """``model, status, latency``: one row per call to the generator."""
    return drafts.select("model", F.inline("attempt_log"))


def pending(drafts: DataFrame) -> DataFrame:
    """Drafts awaiting review."""
    return drafts.filter(F.col("status") == "drafted").select(
        "raw_sha256", "model", "definition", F.lit("pending").alias("status"))


def promote(pending_defs: DataFrame, approved: DataFrame) -> DataFrame:
    """Sets ``active`` on the definitions whose ``raw_sha256`` a person approved."""
    yes = approved.select("raw_sha256", F.lit(True).alias("_approved")).dropDuplicates(["raw_sha256"])
    return (
        pending_defs.join(yes, "raw_sha256", "left")
        .withColumn("status", F.when(F.col("_approved"), "active").otherwise(F.col("status")))
        .drop("_approved")
    )


def active_parsers(registry: DataFrame) -> list[ParserDef]:
    """Compiled active definitions. They were approved one by one, so they fit the driver."""
    rows = registry.filter(F.col("status") == "active").select("raw_sha256", "definition").toLocalIterator()
    return in_routing_order([parse_definition(_document(r["definition"]), r["raw_sha256"]) for r in rows])


def handle_dlq(
    dlq: DataFrame, mode: str = "manual", generate: Generator | None = None, model: str = "",
    max_retries: int = 2, breaker: int = 5,
) -> tuple[DataFrame, DataFrame | None]:
    """(dead letters to keep, drafts). Without a usable generator every mode is ``manual``."""
    if mode not in DLQ_MODES:
        raise ValueError(f"dlq mode is one of {DLQ_MODES}")
    if mode == "manual" or generate is None:
        return dlq, None
    dlq = cut_lineage(dlq)  # read twice, and what it comes from is large
    # Written down once: the generator must not be asked again by later actions.
    drafts = cut_lineage(draft_parsers(dlq, generate, model, max_retries, breaker))
    failed = drafts.filter(F.col("status") == "failed").select("raw_sha256", "last_error")
    kept = dlq.join(failed, "raw_sha256").withColumn(
        "error", F.concat(F.lit(DRAFT_PREFIX), F.col("last_error"))).drop("last_error")
    return kept, drafts

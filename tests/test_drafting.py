import json

import pytest
from pyspark.sql import functions as F

from lognorm.operators import drafting as K
from lognorm.operators.metrics import draft_totals
from test_rules import BASE

GOOD = json.dumps({**BASE, "author": "ai:m"})


@pytest.fixture
def dead(spark):
    return lambda n: spark.createDataFrame(
        [(f"h{i}", f"line {i}", "No matching active parsers found.") for i in range(n)],
        "raw_sha256 string, raw_payload string, error string").coalesce(1)


def test_retry_then_valid(dead):
    def generate(system, user):
        return f"```json\n{GOOD}\n```" if "refused" in user else '"no object"'

    (row,) = K.draft_parsers(dead(1), generate, "m", max_retries=1).collect()
    assert (row["status"], row["attempts"], row["raw_sha256"]) == ("drafted", 2, "h0")
    assert json.loads(row["definition"])["name"] == "p"
    assert [a["status"] for a in row["attempt_log"]] == ["not_an_object", "success"]


def test_exhausted(dead, spark):
    kept, drafts = K.handle_dlq(dead(1), "openai", lambda s, u: '{"name": 1}', "m", max_retries=2)
    assert drafts.first()["attempts"] == 3
    assert kept.first()["error"].startswith("AI generation failed: missing: version")
    assert draft_totals(K.draft_attempts(drafts)).collect()[0]["attempts"] == 3


def test_breaker_stays_open(dead):
    def generate(system, user):
        raise ConnectionError("down")

    rows = K.draft_parsers(dead(4), generate, "m", max_retries=0, breaker=2).collect()
    assert sorted(r["attempts"] for r in rows) == [0, 0, 1, 1]
    assert {r["status"] for r in rows} == {"failed"}


def test_manual_mode_and_fallback(dead):
    letters = dead(2)
    assert K.handle_dlq(letters, "manual") == (letters, None)
    assert K.handle_dlq(letters, "ollama", None) == (letters, None)
    with pytest.raises(ValueError):
        K.handle_dlq(letters, "other")


def test_promotion_needs_approval(dead, spark):
    waiting = K.pending(K.draft_parsers(dead(2), lambda s, u: GOOD, "m"))
    assert K.active_parsers(waiting) == []
    registry = K.promote(waiting, spark.createDataFrame([("h1",)], "raw_sha256 string"))
    assert [d.file for d in K.active_parsers(registry)] == ["h1"]


def test_many_dead_letters_are_drafted_by_many_tasks_and_made_once(spark, capsys):
    dlq = spark.range(0, 12_000, 1, 1).selectExpr("sha2(string(id), 256) AS raw_sha256", "string(id) AS raw_payload", "'no match' AS error")
    kept, drafts = K.handle_dlq(dlq, "openai", lambda system, user: "[]", "m", max_retries=0)
    spread = K.draft_parsers(dlq, lambda system, user: "[]", "m", max_retries=0).withColumn("task", F.spark_partition_id())
    assert spread.select("task").distinct().count() == 3
    assert kept.count() == drafts.count() == 12_000
    kept.explain()
    assert "Range (" not in capsys.readouterr().out

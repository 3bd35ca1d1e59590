"""Some registered queries next to their SQL twins; ``check.py`` runs them all."""

from pathlib import Path

import pytest

from pyspark.sql import functions as F

duckdb = pytest.importorskip("duckdb")
SF = Path("/root/testdata/sf0.001")

from check import TABLES, rows  # noqa: E402

from lognorm.plans.oracle import SQL  # noqa: E402
from lognorm.plans.queries import REGISTRY  # noqa: E402
from lognorm.sources.synth import raw_logs  # noqa: E402


def test_every_query_has_a_twin():
    assert set(REGISTRY) == set(SQL)


@pytest.mark.skipif(not SF.exists(), reason="no driver tables")
@pytest.mark.parametrize("name", [
    "fingerprint_documents", "route_first_match", "leftovers", "validate_strict", "dedup_accepted", "metrics_table",
    "expr_numbers", "rule_violations",
])
def test_query(spark, name):
    duck = duckdb.connect()
    for t in TABLES:
        duck.sql(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    df = REGISTRY[name](spark, str(SF))
    twin = duck.execute(SQL[name])
    columns = [d[0] for d in twin.description]
    assert sorted(columns) == sorted(df.columns)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(columns, twin.fetchall())


def test_many_events_are_rendered_by_many_tasks(spark):
    large = Path("/root/testdata/sf0.1")
    if not large.exists():
        pytest.skip("no driver tables")
    logs = raw_logs(spark, str(large))
    assert logs.groupBy(F.spark_partition_id()).count().count() >= 5
    assert logs.count() == 110_000


def test_queries_run_stages_that_the_jvm_compiles(spark):
    import __spark_entry__ as driver

    spark.conf.set("spark.sql.codegen.hugeMethodLimit", 65_535)
    driver.queries()["eps_window"](spark, str(SF))
    assert spark.conf.get("spark.sql.codegen.hugeMethodLimit") == "8000"

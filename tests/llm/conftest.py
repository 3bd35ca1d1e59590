import pytest

#: Names that the operators use themselves, to show that a table's own columns never get in the way.
CLASH = "fp long, score double, k string, spans string, tail int, keys string, bucket int"


@pytest.fixture
def documents(spark):
    """A documents table with clashing columns of nulls."""

    def make(rows):
        return spark.createDataFrame(
            [(i, t, *[None] * 7) for i, t in rows], f"doc_id long, text string, {CLASH}").repartition(3)

    return make

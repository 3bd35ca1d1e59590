import pyarrow as pa

from lognorm.llm.common import map_slices


def test_a_partition_reaches_python_in_batches_of_bounded_size(spark):
    def make():
        # a slice shares the buffers of its batch
        return lambda piece: pa.RecordBatch.from_arrays([pa.array([piece.column(0).buffers()[2].size])], ["n"])

    rows = spark.range(0, 64, 1, 1).selectExpr("repeat('x', 500000 + id % 2) AS text")
    assert max(r.n for r in map_slices(rows, make, "n long").collect()) < 10 << 20

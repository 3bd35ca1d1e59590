"""Definitions on shared storage, read anew by a running stream."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lognorm.functions.payload import decode_utf8
from lognorm.sources.parsers import ParserDef, in_routing_order, usable

#: Definitions become one plan on the driver, so their size has a bound; more is refused, not cut.
MAX_BYTES = 64 * 1024 * 1024
_DOCUMENT = "file string, text string"


def read_documents(spark: SparkSession, path: str, max_bytes: int = MAX_BYTES) -> DataFrame:
    """(file, text) of each ``.json`` / ``.yaml`` file of a folder on any storage Spark reads.

    A folder that is missing or empty gives no rows; bytes that are not UTF-8 are replaced.
    """
    try:
        found = spark.read.format("binaryFile").load(path)
    except AnalysisException as exc:
        if exc.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], _DOCUMENT)
    name = F.element_at(F.split("path", "/"), -1)
    files = found.withColumn("file", name).where(name.rlike(r"\.(json|yaml)$") & ~name.startswith("."))
    size = files.agg(F.sum("length")).head()[0] or 0
    if size > max_bytes:
        raise ValueError(f"{path}: {size} bytes of definitions, at most {max_bytes} are read")
    return files.select("file", decode_utf8(F.col("content")).alias("text"))


def read_registry(spark: SparkSession, path: str, max_bytes: int = MAX_BYTES) -> list[ParserDef]:
    """Valid definitions of a folder on any storage, in routing order; invalid ones are skipped."""
    rows = read_documents(spark, path, max_bytes).collect()  # at most max_bytes
    return in_routing_order([d for d in (usable(r.text, r.file) for r in rows) if d is not None])


def put_definition(spark: SparkSession, path: str, file: str, text: str) -> None:
    """Puts one definition into a folder on any storage; readers see it whole or not at all."""
    part, whole = (spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{n}") for n in (f".{file}.part", file))
    fs = part.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    out = fs.create(part, True)
    try:
        out.write(bytearray(text, "utf-8"))
    finally:
        out.close()
    fs.delete(whole, False)
    if not fs.rename(part, whole):
        raise OSError(f"{path}/{file} could not be put in place")


class Registry:
    """The definitions of a folder as each micro-batch finds them when it starts.

    What a batch uses is written to ``state`` under its id before it is used: a replay takes the
    same definitions, though files may have been added or removed since. Files that are no valid
    definition are skipped. Only the last two versions are kept.
    """

    def __init__(self, spark: SparkSession, folder: str, state: str, max_bytes: int = MAX_BYTES):
        self.spark, self.folder, self.state, self.max_bytes = spark, folder, state, max_bytes
        self._known: dict[tuple[str, str], ParserDef | None] = {}

    def at(self, batch_id: int) -> list[ParserDef]:
        fs, done = self._fs(batch_id, "_SUCCESS")
        if not fs.exists(done):
            read_documents(self.spark, self.folder, self.max_bytes).coalesce(1).write.mode("overwrite").parquet(self._path(batch_id))
        rows = self.spark.read.schema(_DOCUMENT).parquet(self._path(batch_id)).collect()  # at most max_bytes
        fs, old = self._fs(batch_id - 2)
        fs.delete(old, True)
        # Checked once while they stay as they are.
        known, self._known = self._known, {}
        for key in ((r.file, r.text) for r in rows):
            self._known[key] = known[key] if key in known else usable(key[1], key[0])
        return in_routing_order([d for d in self._known.values() if d is not None])

    def _path(self, batch_id: int) -> str:
        return f"{self.state}/{batch_id}"

    def _fs(self, batch_id: int, name: str | None = None):
        whole = self._path(batch_id) if name is None else f"{self._path(batch_id)}/{name}"
        path = self.spark._jvm.org.apache.hadoop.fs.Path(whole)
        return path.getFileSystem(self.spark._jsparkSession.sessionState().newHadoopConf()), path

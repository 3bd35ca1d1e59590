"""Session defaults and the one place where lineage is cut."""

from __future__ import annotations

import shutil
import tempfile
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


#: HotSpot never compiles a longer method; Spark's own limit (65,535) would leave wide projections interpreted.
METHOD_BYTES = 8_000


def limit_methods(spark: SparkSession) -> None:
    """Stages whose generated method HotSpot would not compile run as separate, compiled projections."""
    spark.conf.set("spark.sql.codegen.hugeMethodLimit", METHOD_BYTES)


#: Arrow hands a Python worker so much at once. The executor holds a batch outside its heap, up to three times while
#: buffers grow, and the worker holds it again; by Spark's own limit (64 MB) a whole partition is often one batch.
BATCH_BYTES = 4 << 20


def limit_batches(spark: SparkSession) -> None:
    """Batches of about ``BATCH_BYTES`` for Python workers; a limit that the session was given stays."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if spark.conf.get(key, None) is None:
        spark.conf.set(key, BATCH_BYTES)


def local_session(cpus: str = "8", app: str = "lognorm") -> SparkSession:
    """A local session for tests and the bench; clusters bring their own."""
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName(app)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.codegen.hugeMethodLimit", METHOD_BYTES)
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Use the cluster's ``spark.checkpoint.dir``; only a local session gets a folder of ours."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is not None:
        return
    configured = spark.conf.get("spark.checkpoint.dir", "")
    if configured:
        sc.setCheckpointDir(configured)
    elif sc.master.startswith("local"):
        sc.setCheckpointDir(tempfile.mkdtemp(prefix="lognorm-checkpoint-"))
    else:
        raise ValueError("set spark.checkpoint.dir to a folder all executors share")


def cut_lineage(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: survives the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def scratch_folder(spark: SparkSession, name: str) -> str:
    """A fresh folder all executors can write to, below the checkpoint folder."""
    ensure_checkpoint_dir(spark)
    return f"{spark.sparkContext.getCheckpointDir()}/{name}-{uuid.uuid4().hex}"


def ship_package(spark: SparkSession) -> None:
    """Make this package importable on the executors (what ``--py-files`` does)."""
    root = Path(__file__).resolve().parent
    archive = shutil.make_archive(
        f"{tempfile.mkdtemp(prefix='lognorm-')}/lognorm", "zip", root.parent, root.name)
    spark.sparkContext.addPyFile(archive)

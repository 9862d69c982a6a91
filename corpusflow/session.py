"""Session helpers: a tuned local session, and the shared folder used to cut lineage."""

from __future__ import annotations

import atexit
import contextlib
import tempfile
import uuid

from collections.abc import Iterator

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", memory: str = "16g", app: str = "corpusflow") -> SparkSession:
    """A local session for tests and benchmarks. Clusters bring their own session."""
    shuffles = "8" if cores == "*" else str(cores)
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", shuffles)
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", memory)
        .config("spark.ui.enabled", "false")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def checkpoint_root(spark: SparkSession) -> str:
    """The shared checkpoint folder of this session.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session may fall back to a
    temporary folder, because executors on other machines could not read it.
    """
    current = spark.sparkContext._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not spark.sparkContext.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        named = tempfile.mkdtemp(prefix="corpusflow-checkpoints-")
    spark.sparkContext.setCheckpointDir(named)
    return spark.sparkContext._jsc.sc().getCheckpointDir().get()


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder; survives the loss of executors."""
    checkpoint_root(df.sparkSession)
    return df.checkpoint(eager=True)


_to_clear: set[str] = set()


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared checkpoint folder for intermediate tables.

    They go when the driver's program ends; :func:`clear_scratch` removes them before.
    """
    root = checkpoint_root(spark)
    if root not in _to_clear:
        _to_clear.add(root)
        atexit.register(_clear_at_end, spark)
    return f"{root}/scratch/{name}-{uuid.uuid4().hex}"


# Shuffle files of an execution that has ended are of no further use; without this they stay on the executors'
# disks until the driver happens to collect its garbage.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def shuffles_cleared(spark: SparkSession) -> Iterator[None]:
    """Executions begun inside remove their shuffle files when they end."""
    before = spark.conf.get(_CLEANUP, "false")
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(_CLEANUP, before)


def stored(df: DataFrame, path: str) -> DataFrame:
    """Write ``df`` as Parquet to a :func:`scratch_path` and read it back."""
    with shuffles_cleared(df.sparkSession):
        df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(spark: SparkSession, path: str) -> None:
    """Delete one intermediate table before the program ends. Nothing may read it afterwards."""
    at = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    at.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(at, True)


def _clear_at_end(spark: SparkSession) -> None:
    if spark.sparkContext._jsc is not None:  # else the session was stopped before
        clear_scratch(spark)


def clear_scratch(spark: SparkSession) -> None:
    """Delete this session's intermediate tables. Results that read them must have been written before."""
    discard(spark, f"{checkpoint_root(spark)}/scratch")

"""Session defaults and the one way this package cuts lineage."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

# Settings every job here assumes. They are applied only where the cluster has not chosen a value.
DEFAULTS = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # split a skewed join partition even where that costs one more shuffle afterwards
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # tasks unfold what they read to many times its size and sort it, several operators deep: small pieces bound their memory
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "16m",
    # the dashboard is wider than the 100 columns up to which Spark compiles a stage as a whole by default
    "spark.sql.codegen.maxFields": "1000",
    "spark.sql.session.timeZone": "UTC",
}

# Settings that can only be chosen when a session starts; a cluster's own session keeps what it was started with.
START_DEFAULTS = {
    # the source line of every column in error messages costs several calls into the JVM per column while a plan is built
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str = "local[8]", app: str = "supplyloom", **extra: str) -> SparkSession:
    """A local session for tests and benchmarks; on a cluster pass the cluster's own session instead."""
    builder = SparkSession.builder.master(master).appName(app)
    fixed = {"spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false", "spark.cleaner.referenceTracking.cleanCheckpoints": "true"}
    for name, value in fixed.items():
        builder = builder.config(name, value)
    for name, value in {**DEFAULTS, **START_DEFAULTS, **extra}.items():
        builder = builder.config(name, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def apply_defaults(spark: SparkSession) -> SparkSession:
    """Set the runtime defaults on a session made elsewhere, leaving explicit choices alone, whether they were made at
    the start or at run time. The time zone of such a session is never touched."""
    chosen = spark.conf.getAll
    for name, value in DEFAULTS.items():
        if name not in chosen and name != "spark.sql.session.timeZone":
            spark.conf.set(name, value)
    return spark


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in ``spark.checkpoint.dir``, for checkpoints and staged tables.

    Only a local session without that setting (tests) gets a temporary folder; a cluster without it is an
    error, because a machine-local folder would not survive the loss of an executor.
    """
    context = spark.sparkContext
    if context.getCheckpointDir() is None:
        folder = context.getConf().get("spark.checkpoint.dir")
        if folder is None:
            if not context.master.startswith("local"):
                raise RuntimeError("set spark.checkpoint.dir to a shared folder")
            folder = tempfile.mkdtemp(prefix="supplyloom-")
        context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def stable(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared folder and cut its lineage there."""
    shared_folder(df.sparkSession)
    return df.checkpoint(eager=True)


SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def write_rows(df: DataFrame, path: str, **options: str) -> None:
    """``df`` as Parquet, ``options`` as for its writer. The shuffle files of this one job go as soon as it ends, not when its
    plan is collected as garbage."""
    conf = df.sparkSession.conf
    before = conf.get(SHUFFLE_CLEANUP, None)
    conf.set(SHUFFLE_CLEANUP, "true")
    try:
        df.write.options(**options).parquet(path)
    finally:
        if before is None:
            conf.unset(SHUFFLE_CLEANUP)
        else:
            conf.set(SHUFFLE_CLEANUP, before)


# what was staged in the blocks that are open in this thread, innermost last: file systems and places
_BLOCKS: ContextVar[tuple[list, ...]] = ContextVar("blocks", default=())


@contextmanager
def passing() -> Iterator[None]:
    """Tables staged inside the block are deleted when it ends. One that is to be read after it is staged with ``keep``."""
    mine: list = []
    token = _BLOCKS.set((*_BLOCKS.get(), mine))
    try:
        yield
    finally:
        _BLOCKS.reset(token)
        for files, place in mine:
            files.delete(place, True)


def staged(df: DataFrame, keep: int = 0) -> DataFrame:
    """``df`` written as Parquet into the shared folder and read back: computed once, lineage cut, columns still pruned.

    The files go with the block of ``passing`` around it, or when the application ends; ``keep`` is how many blocks they
    outlive.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/rows-{uuid.uuid4().hex}"
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = place.getFileSystem(spark._jsc.hadoopConfiguration())
    blocks = _BLOCKS.get()
    if len(blocks) > keep:
        blocks[-1 - keep].append((files, place))
    write_rows(df, path, compression="zstd")
    files.deleteOnExit(place)
    return spark.read.schema(df.schema).parquet(path)

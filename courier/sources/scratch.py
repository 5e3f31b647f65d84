"""Tables written to cut lineage.

Range partitioning samples its bounds, so a recomputed plan could move rows between
partitions.  Plans that depend on where a row sits therefore write it down first, in
the shared folder the cluster names, where it outlives a lost executor.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import ExitStack, contextmanager

from pyspark.sql import DataFrame, SparkSession

#: Spark 4.1 on; an older one leaves the files to its cleaner.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Rows and bytes of a batch for a Python worker; a batch ends at whichever comes first.
ARROW_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
ARROW_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"
BATCH_BYTES = 4 << 20


def scratch_dir(spark: SparkSession) -> str:
    """The session's checkpoint folder; a temporary one only on a local master."""
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        return folder
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    folder = tempfile.mkdtemp(prefix="courier-checkpoint-")
    context.setCheckpointDir(folder)
    return context.getCheckpointDir()


def scratch_path(spark: SparkSession, label: str) -> str:
    return f"{scratch_dir(spark).rstrip('/')}/{label}-{uuid.uuid4().hex}"


@contextmanager
def _set(spark: SparkSession, options: dict[str, str]) -> Iterator[None]:
    before = {key: spark.conf.get(key, None) for key in options}
    for key, value in options.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def arrow_batches(spark: SparkSession, rows: int):
    """What runs inside hands Python workers at most ``rows`` rows and ``BATCH_BYTES`` at a time.

    A batch is held outside the JVM's heap, in buffers that grow by doubling, once for each core:
    at Spark's 10,000 rows, lists of some hundred numbers take hundreds of megabytes there.
    """
    return _set(spark, {ARROW_ROWS: str(rows), ARROW_BYTES: str(BATCH_BYTES)})


def materialise(df: DataFrame, label: str, batch_rows: int | None = None) -> DataFrame:
    """Write ``df`` as a scratch table and return it, read back.

    Spark removes the write's shuffle files when it ends, not when their plan is collected.
    ``batch_rows`` bounds what its Python workers are given at a time.
    """
    path = scratch_path(df.sparkSession, label)
    with ExitStack() as during:
        during.enter_context(_set(df.sparkSession, {SHUFFLE_CLEANUP: "true"}))
        if batch_rows:
            during.enter_context(arrow_batches(df.sparkSession, batch_rows))
        df.write.mode("errorifexists").parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame) -> None:
    """Remove scratch tables that ``materialise`` gave, once nothing will read them again."""
    for table in tables:
        context = table.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(table.scratch_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)

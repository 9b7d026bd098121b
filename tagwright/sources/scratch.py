"""Tables written to the cluster's shared checkpoint folder.

Iterative steps cut their lineage here: a table is written once as Parquet and read back,
so a lost executor re-reads files instead of replaying every earlier round.
"""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

CHECKPOINT_SETTING = "spark.checkpoint.dir"
FREES_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def scratch_root(spark: SparkSession) -> str:
    """The shared folder named by the session.  Only a local session may fall back to a
    folder of its own."""
    root = spark.conf.get(CHECKPOINT_SETTING, None)
    context = spark.sparkContext
    root = root or context.getCheckpointDir()
    if root:
        return root.rstrip("/")
    if not context.master.startswith("local"):
        raise RuntimeError(f"set {CHECKPOINT_SETTING} to a folder every executor can reach")
    root = tempfile.mkdtemp(prefix="run-", dir="/tmp")
    context.setCheckpointDir(f"file://{root}")
    return scratch_root(spark)


def materialize(df: DataFrame, name: str, by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to a fresh scratch table, a folder for each value of ``by``, and return the table."""
    path = f"{scratch_root(df.sparkSession)}/tagwright-{name}-{uuid.uuid4().hex}"
    (df.write.partitionBy(*by) if by else df.write).parquet(path)
    table = df.sparkSession.read.schema(df.schema).parquet(path)
    table.scratch_path = path
    return table


def discard(*tables: DataFrame | None) -> None:
    """Delete tables of ``materialize`` that are not read any more; anything else is left alone."""
    for table in tables:
        path = None if table is None else vars(table).get("scratch_path")
        if path is not None:
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def shuffles_freed(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the table they were for is written, not when the driver collects its
    garbage.  For steps that write every table once; nothing else may run in the session meanwhile
    that reads a shuffle again."""
    old = spark.conf.get(FREES_SHUFFLES)
    spark.conf.set(FREES_SHUFFLES, "true")
    try:
        yield
    finally:
        spark.conf.set(FREES_SHUFFLES, old)

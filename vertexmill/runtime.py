"""Session-level helpers: reliable storage, layouts that survive, global positions."""

from __future__ import annotations

import tempfile
import uuid
from contextlib import contextmanager

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """Folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. A temporary folder is
    used only where that is unset and the session is a single local process.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named
    current = spark.sparkContext.getCheckpointDir()
    if current:
        return current
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    made = tempfile.mkdtemp(prefix="run-")
    spark.sparkContext.setCheckpointDir(made)
    return made


def scratch_path(spark: SparkSession, name: str) -> str:
    """A path below the shared folder that no other run uses."""
    return f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """Cut the lineage of ``df``, keeping its partitions as they are."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str, reader: SparkSession | None = None) -> DataFrame:
    """Cut the lineage of ``df`` by a Parquet table in the shared folder.

    Readers of the table see only the columns they ask for, and a cache of it
    is found again wherever the table appears in a plan. ``reader`` is the session
    that plans with the table, if not that of ``df``.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return (reader or df.sparkSession).read.schema(df.schema).parquet(path)


def side_session(spark: SparkSession) -> SparkSession:
    """A session on the same cluster that starts with the settings of ``spark``.

    Plans made with its tables follow its own settings, whatever happens to those of ``spark``.
    """
    side = spark.newSession()
    for key, value in spark.conf.getAll.items():
        if side.conf.isModifiable(key):
            side.conf.set(key, value)
    if side.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_dir(spark))
    return side


@contextmanager
def seen_from(side: SparkSession, df: DataFrame):
    """``df`` as a table of another session of the same cluster; plans made inside stay valid.

    Dropping a view frees the cache of the plan it names, so the view has a column more than ``df``.
    """
    name = f"seen_{uuid.uuid4().hex}"
    df.withColumn(name, F.lit(True)).createGlobalTempView(name)
    try:
        shared = side.conf.get("spark.sql.globalTempDatabase", "global_temp")
        yield side.table(f"{shared}.{name}").drop(name)
    finally:
        df.sparkSession.catalog.dropGlobalTempView(name)


def drop_written(*tables: DataFrame) -> None:
    """Delete tables made by :func:`written`; nothing may read them any more."""
    for table in tables:
        spark = table.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        below = shared_dir(spark).rstrip("/").removeprefix("file://").removeprefix("file:")
        folders = {hadoop(file).getParent().toString() for file in table.inputFiles()}
        for folder in folders:
            if f"{below}/" in folder:
                path = hadoop(folder)
                path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


@contextmanager
def setting(spark: SparkSession, key: str, value: str):
    """Another value of a session setting for the plans made inside."""
    before = spark.conf.get(key)
    spark.conf.set(key, value)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def kept_by(df: DataFrame, tasks: int, *keys: str, order: str | list[str] | None = None) -> DataFrame:
    """Keep ``df`` hashed by ``keys`` for many reads, rows sorted by ``order`` in each task.

    A cached table tells later plans its layout only when its own plan is
    final up front, so adaptive re-planning is off for this one exchange.
    Joins and aggregates on ``keys`` then leave this side where it is. Give a
    written table: blocks lost with an executor are rebuilt from it.
    """
    spark = df.sparkSession
    with setting(spark, "spark.sql.adaptive.enabled", "false"):
        laid_out = df.repartition(tasks, *keys)
        if order is not None:
            laid_out = laid_out.sortWithinPartitions(order)
        return laid_out.persist(StorageLevel.MEMORY_AND_DISK)


def _partition_offsets(parts: DataFrame) -> DataFrame:
    """``(part, size) -> (part, before)``: one row per task, so one small window."""
    before = F.sum("size").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    )
    return parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))


def with_position(df: DataFrame, *order: str, name: str = "pos") -> DataFrame:
    """Number all rows from 0 in the order of ``order`` without a one-task window.

    The sort range-partitions the data; after the checkpoint a row's place is
    its place in its partition plus the sizes of the partitions before it.
    ``order`` must be unique, or ties are numbered arbitrarily.
    """
    placed = checkpointed(df.sort(*order)).select(
        "*",
        F.spark_partition_id().alias("part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("within"),
    )
    offsets = _partition_offsets(placed.groupBy("part").agg(F.count("*").alias("size")))
    return placed.join(F.broadcast(offsets), "part").select(
        *df.columns, (F.col("within") + F.col("before")).cast("bigint").alias(name)
    )


def with_total_before(df: DataFrame, order: str, value: str, name: str) -> DataFrame:
    """Exclusive running total of ``value`` over a unique ``order`` column.

    Same idea as :func:`with_position`: the window runs inside each range
    partition and is shifted by the totals of the partitions before it.
    """
    placed = checkpointed(df.sort(order)).withColumn("part", F.spark_partition_id())
    offsets = _partition_offsets(placed.groupBy("part").agg(F.sum(value).alias("size")))
    inside = F.sum(value).over(
        Window.partitionBy("part").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    )
    return (
        placed.withColumn("inside", F.coalesce(inside, F.lit(0)))
        .join(F.broadcast(offsets), "part")
        .select(*df.columns, (F.col("inside") + F.col("before")).cast("bigint").alias(name))
    )

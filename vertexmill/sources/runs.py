"""Readers for run tables written by ``vertexmill.sinks.runs`` or by other tools."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vertexmill.schema import CONFIG_SUMMARY, RUN_METRICS
from vertexmill.sources.edges import read_if_there


def by_name(spark: SparkSession) -> DataFrameReader:
    """Columns are named by the head; a file whose head differs from the first's is an error."""
    return spark.read.option("header", True).option("enforceSchema", False)


def typed(fields: Iterable[T.StructField], told: list[str]) -> list[Column]:
    """The fields by name; a column that is not there is null."""
    have = set(told)
    return [
        (F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
    ]


def read_metrics(spark: SparkSession, folder: str) -> DataFrame | None:
    """All runs below ``folder`` with ``config`` and ``run`` taken from their names.

    Takes ``*_run*_metrics.csv``, or ``*_metrics.csv`` where no such name
    exists; None where there is neither. Files and folders are read alike.
    """
    read = by_name(spark).csv
    rows = read_if_there(read, f"{folder}/*_run*_metrics.csv")
    if rows is None:
        rows = read_if_there(read, f"{folder}/*_metrics.csv")
    if rows is None:
        return None
    # the whole stem is the configuration where it names no run
    stem = F.regexp_extract("path", r"([^/=]+)_metrics\.csv", 1)
    numbered = F.regexp_extract(stem, r"^(.*)_run([^_]*)$", 1)
    told = rows.columns
    rows = rows.withColumn("path", F.url_decode(F.col("_metadata.file_path")))
    run = F.regexp_extract(stem, r"^(.*)_run([^_]*)$", 2)
    return rows.select(
        *typed([f for f in RUN_METRICS if f.name != "config"], told),
        F.when(numbered != "", numbered).otherwise(stem).alias("config"),
        F.coalesce(run.try_cast("int"), F.lit(1)).alias("run"),
    )


def read_summary(spark: SparkSession, path: str) -> DataFrame:
    rows = by_name(spark).csv(path)
    return rows.select(*typed(CONFIG_SUMMARY, rows.columns))


def read_summary_table(spark: SparkSession, path: str) -> DataFrame:
    """The published table as text, column names as in its head."""
    return by_name(spark).csv(path)

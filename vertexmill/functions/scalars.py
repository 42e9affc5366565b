"""Column functions for run analytics and vertex bookkeeping."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BASELINE = "sequential"
PARALLEL_PREFIX = "spark_"


def speedup(baseline_time: Column, time: Column) -> Column:
    """``baseline / time``; infinite where ``time`` is not positive."""
    return F.when(time > 0, F.try_divide(baseline_time, time)).otherwise(F.lit(float("inf")))


def comm_share(comm_time: Column, total_time: Column) -> Column:
    """Communication share of the epoch in percent; 0 where the total is not positive."""
    return F.when(total_time > 0, F.try_divide(comm_time, total_time) * 100.0).otherwise(F.lit(0.0))


def workers(config: Column) -> Column:
    """Worker count named in a parallel configuration, 1 for the baseline."""
    number = F.regexp_extract(config, rf"{PARALLEL_PREFIX}(\d+)", 1)
    return F.when(number != "", number.cast("int")).otherwise(F.lit(1))


def is_parallel(config: Column) -> Column:
    return config.startswith(PARALLEL_PREFIX)


def part_of(vertex: Column, parts: int) -> Column:
    """Part of a vertex: its id modulo the number of parts."""
    return F.pmod(vertex, F.lit(parts)).cast("int")


def inverse_sqrt_degree(degree: Column) -> Column:
    """``degree ** -0.5``, with 0 in place of infinity."""
    return F.when(degree > 0, 1.0 / F.sqrt(degree)).otherwise(F.lit(0.0))

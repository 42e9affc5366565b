"""Run analytics over ``run_metrics`` tables: per run, per configuration, and against a baseline.

Per-epoch rows are reduced per (config, run) with partial aggregates; what
follows is configuration-sized. The baseline comes in as a scalar subquery.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from vertexmill.functions.scalars import BASELINE, comm_share, is_parallel, speedup, workers
from vertexmill.runtime import written
from vertexmill.schema import SUMMARY_TABLE, WIDE_SUMMARY

# ---------------------------------------------------------------- per run, per configuration


def per_run_summary(metrics: DataFrame) -> DataFrame:
    """Times and last-epoch values of every run in one pass."""
    return metrics.groupBy("config", "run").agg(
        F.avg("epoch_time").alias("avg_epoch_time"),
        F.sum("epoch_time").alias("total_time"),
        F.avg("comm_time").alias("avg_comm_time"),
        *[
            F.coalesce(F.max_by(c, "epoch"), F.lit(0.0)).alias(c)
            for c in ("test_f1", "val_f1", "loss", "train_acc")
        ],
        F.max("peak_memory_mb").alias("peak_memory_mb"),
    )


def last_epoch(metrics: DataFrame) -> DataFrame:
    """Final scores of every run; a missing score is 0."""
    return per_run_summary(metrics).select(
        "config", "run", "test_f1", "val_f1", "loss", "train_acc"
    )


def config_summary(metrics: DataFrame) -> DataFrame:
    """Mean over runs of run values, with the population deviation."""
    runs = per_run_summary(metrics)
    both = ("avg_epoch_time", "total_time", "avg_comm_time", "test_f1")
    stats = []
    for c in both:
        stats += [F.avg(c).alias(f"{c}_mean"), F.stddev_pop(c).alias(f"{c}_std")]
    stats += [F.avg(c).alias(f"{c}_mean") for c in ("val_f1", "loss", "train_acc")]
    return runs.groupBy("config").agg(*stats, F.max("peak_memory_mb").alias("peak_memory_mb"))


# ---------------------------------------------------------------- baseline, speedup, efficiency

#: What stands in for the baseline or its speedup where there is none.
#: ``unit``: the baseline takes 1 second. ``zero``/``one``: that is the speedup. ``drop``: no rows.
MISSING_BASELINE = ("unit", "zero", "one", "drop")


def baseline(summary: DataFrame, column: str = "avg_epoch_time_mean") -> Column:
    """The baseline's value as a scalar; null without a baseline."""
    return summary.filter(F.col("config") == BASELINE).agg(F.max(column)).scalar()


def parallel_configs(summary: DataFrame) -> DataFrame:
    return summary.filter(is_parallel(F.col("config")))


def with_speedup(summary: DataFrame, missing_baseline: str = "unit") -> DataFrame:
    """Add ``workers, speedup, efficiency, comm_overhead_pct``."""
    if missing_baseline not in MISSING_BASELINE:
        raise ValueError(f"missing_baseline must be one of {MISSING_BASELINE}")
    known = baseline(summary)
    time = F.col("avg_epoch_time_mean")
    if missing_baseline == "unit":
        ratio = F.try_divide(F.coalesce(known, F.lit(1.0)), time)
    else:
        fallback = F.lit(0.0 if missing_baseline == "zero" else 1.0)
        ratio = F.when(known.isNotNull() & (time > 0), F.try_divide(known, time)).otherwise(fallback)
    share = F.coalesce(F.try_divide(F.col("avg_comm_time_mean"), time) * 100.0, F.lit(0.0))
    rows = summary.filter(known.isNotNull()) if missing_baseline == "drop" else summary
    return (
        rows.withColumn("workers", workers(F.col("config")))
        .withColumn("speedup", ratio)
        .withColumn("efficiency", F.col("speedup") / F.col("workers"))
        .withColumn("comm_overhead_pct", share)
    )


def speedup_of(times: DataFrame, baseline_column: str, time_column: str) -> DataFrame:
    """Row-wise speedup of two time columns."""
    return times.withColumn("speedup", speedup(F.col(baseline_column), F.col(time_column)))


def comm_share_of(times: DataFrame, comm_column: str, total_column: str) -> DataFrame:
    """Row-wise communication share of two time columns."""
    return times.withColumn("comm_pct", comm_share(F.col(comm_column), F.col(total_column)))


def summary_table(summary: DataFrame, missing_baseline: str = "unit") -> DataFrame:
    """The display table: 11 columns, numbers to 4 places, halves to even."""
    full = with_speedup(summary, missing_baseline)
    exact = ("config", "workers")
    return full.select(
        *[F.col(c) if c in exact else F.bround(c, 4).alias(c) for c in SUMMARY_TABLE]
    )


def wide_summary(summary: DataFrame) -> DataFrame:
    """The exploratory summary: unrounded, with losses and validation scores."""
    return with_speedup(summary, "drop").select(*WIDE_SUMMARY)


def config_order(summary: DataFrame) -> DataFrame:
    """``(config, place)`` from 0: baseline first, then by workers. One row a configuration."""
    after = F.when(F.col("config") == BASELINE, 0).otherwise(1)
    order = Window.orderBy(after, workers(F.col("config")), "config")
    return summary.select("config", (F.row_number().over(order) - 1).cast("int").alias("place"))


# ---------------------------------------------------------------- chart tables


def comp_comm_breakdown(summary: DataFrame) -> DataFrame:
    """Computation and communication seconds of every parallel configuration."""
    return parallel_configs(summary).select(
        "config",
        workers(F.col("config")).alias("workers"),
        (F.col("avg_epoch_time_mean") - F.col("avg_comm_time_mean")).alias("comp_time"),
        F.col("avg_comm_time_mean").alias("comm_time"),
    )


def accuracy_vs_speedup(summary: DataFrame) -> DataFrame:
    """Speedup and test score per configuration; a zero time counts as speedup 1."""
    return with_speedup(summary, "drop").select("config", "speedup", "test_f1_mean")


def speedup_curve(summary: DataFrame) -> DataFrame:
    """Ideal speedup for 1..most workers, with the measured one where there is a run."""
    measured = parallel_configs(with_speedup(summary, "drop")).select("workers", "speedup")
    most = measured.agg(F.max("workers").alias("most")).filter(F.col("most").isNotNull())
    every = most.select(F.explode(F.sequence(F.lit(1), F.col("most"))).alias("workers"))
    return every.join(measured, "workers", "left").select(
        "workers", F.col("workers").cast("double").alias("ideal"), "speedup"
    )


def efficiency_curve(summary: DataFrame) -> DataFrame:
    """Efficiency per worker count against the ideal of 1."""
    rows = parallel_configs(with_speedup(summary, "drop"))
    return rows.select("workers", "efficiency", F.lit(1.0).alias("ideal"))


def epoch_time_series(summary: DataFrame) -> DataFrame:
    """Epoch time with its deviation per configuration."""
    return summary.select("config", "avg_epoch_time_mean", "avg_epoch_time_std")


# ---------------------------------------------------------------- reports


def report_config(summary: DataFrame) -> DataFrame:
    """Configuration rows of the report; without a baseline the speedup is 1."""
    return with_speedup(summary, "one").select(
        "config",
        F.col("avg_epoch_time_mean").alias("epoch_time"),
        F.col("avg_epoch_time_std").alias("epoch_time_std"),
        "speedup",
        "efficiency",
        F.col("comm_overhead_pct").alias("comm_pct"),
        F.col("test_f1_mean").alias("test_f1"),
        F.col("test_f1_std").alias("f1_std"),
    )


def first_runs(metrics: DataFrame) -> DataFrame:
    """All rows of the first run of every configuration, the one reported in detail."""
    first = metrics.groupBy("config").agg(F.min("run").alias("run"))
    return metrics.join(first, ["config", "run"])


def report_epochs(metrics: DataFrame) -> DataFrame:
    """Epoch rows of the first run of every configuration."""
    return first_runs(metrics).select(
        "config",
        "epoch",
        "epoch_time",
        "forward_time",
        "backward_time",
        F.coalesce("comm_time", F.lit(0.0)).alias("comm_time"),
        "loss",
        "train_acc",
        "val_f1",
        "test_f1",
    )


def quick_compare(summary: DataFrame) -> DataFrame:
    """Every configuration but the baseline; speedup 0 without one."""
    return (
        with_speedup(summary, "zero")
        .filter(F.col("config") != BASELINE)
        .select(
            "config",
            F.col("avg_epoch_time_mean").alias("epoch_time"),
            "speedup",
            F.col("comm_overhead_pct").alias("comm_pct"),
            F.col("test_f1_mean").alias("test_f1"),
        )
    )


def f1_drop(summary: DataFrame) -> DataFrame:
    """Loss of test score against the baseline in percent, per parallel configuration."""
    before = baseline(summary, "test_f1_mean")
    drop = F.when(before > 0, (before - F.col("test_f1_mean")) / before * 100.0).otherwise(0.0)
    return parallel_configs(with_speedup(summary, "drop")).select(
        "config", "workers", "speedup", "efficiency", "comm_overhead_pct",
        "test_f1_mean", drop.alias("f1_drop_pct"),
    )


def key_findings(summary: DataFrame) -> DataFrame:
    """One row: best speedup and efficiency, time saved, mean communication share and score loss.

    Among equals the configuration with fewer workers wins. The summary is
    written once, as every comparison with the baseline reads it again.
    """
    summary = written(summary, "summary")
    fewest = -F.col("workers")
    best_speedup = F.max_by(F.struct("config", "workers", "speedup"), F.struct("speedup", fewest))
    best_eff = F.max_by(
        F.struct("config", "workers", "efficiency"), F.struct("efficiency", fewest)
    )
    found = f1_drop(summary).agg(
        best_speedup.alias("s"),
        best_eff.alias("e"),
        F.avg("comm_overhead_pct").alias("mean_comm_pct"),
        F.avg("f1_drop_pct").alias("mean_f1_drop_pct"),
    )
    return found.select(
        F.col("s.config").alias("best_speedup_config"),
        F.col("s.workers").alias("best_speedup_workers"),
        F.col("s.speedup").alias("best_speedup"),
        ((1.0 - F.try_divide(F.lit(1.0), F.col("s.speedup"))) * 100.0).alias("time_reduction_pct"),
        F.col("e.config").alias("best_efficiency_config"),
        F.col("e.workers").alias("best_efficiency_workers"),
        F.col("e.efficiency").alias("best_efficiency"),
        (F.col("e.efficiency") > 1.0).alias("super_linear"),
        "mean_comm_pct",
        "mean_f1_drop_pct",
    )

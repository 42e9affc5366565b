"""From run tables to the summary files, the summary table and the text report."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from vertexmill.operators.prepare import dataset_stats, undirected
from vertexmill.operators.run_stats import (
    config_summary,
    first_runs,
    key_findings,
    quick_compare,
    summary_table,
)
from vertexmill.plans.experiments import PART_COUNTS, SEEDS, experiment_grid
from vertexmill.plans.trainer import TrainConfig
from vertexmill.runtime import written
from vertexmill.sinks.runs import (
    metrics_rows,
    report_lines,
    write_metrics,
    write_report,
    write_summary,
    write_summary_table,
)
from vertexmill.sources.runs import read_metrics, read_summary


@dataclass
class Comparison:
    """What a set of runs amounts to. All tables are configuration-sized."""

    summary: DataFrame
    table: DataFrame
    quick: DataFrame
    findings: DataFrame


def compare_runs(spark: SparkSession, folder: str) -> Comparison | None:
    """Summarise all runs below ``folder`` and save summary and table next to them.

    None where there are no runs.
    """
    metrics = read_metrics(spark, folder)
    if metrics is None:
        return None
    write_summary(config_summary(metrics), f"{folder}/benchmark_summary.csv")
    summary = read_summary(spark, f"{folder}/benchmark_summary.csv")
    table = summary_table(summary)
    write_summary_table(table, f"{folder}/summary_table.csv")
    return Comparison(summary, table, quick_compare(summary), key_findings(summary))


def run_settings(config: TrainConfig, seeds: tuple[int, ...]) -> dict[str, str]:
    """What all runs of a benchmark have in common, as the report names it."""
    return {
        "Layers": str(config.num_layers),
        "Hidden dim": str(config.hidden_dim),
        "Learning rate": str(config.learning_rate),
        "Epochs": str(config.epochs),
        "Repeats per config": str(len(seeds)),
        "Seeds": str(list(seeds)),
    }


def run_benchmark(
    name: str,
    nodes: DataFrame,
    edges: DataFrame,
    folder: str,
    config: TrainConfig,
    part_counts: tuple[int, ...] = PART_COUNTS,
    seeds: tuple[int, ...] = SEEDS,
) -> Comparison:
    """Train every configuration, save all runs, compare them and write the report."""
    start = time.perf_counter()
    nodes = written(nodes, "nodes")
    grid = experiment_grid(nodes, edges, config, part_counts, seeds)
    write_metrics(grid, folder)
    found = compare_runs(nodes.sparkSession, folder)
    stats = dataset_stats(name, nodes, undirected(edges, nodes))
    took = time.perf_counter() - start
    lines = report_lines(found.summary, metrics_rows(first_runs(grid)), stats, run_settings(config, seeds), took)
    write_report(lines, f"{folder}/performance_report")
    return found

"""The experiment matrix: baseline and partition-local runs for several seeds."""

from __future__ import annotations

import logging
from collections.abc import Iterable
from dataclasses import replace

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from vertexmill.functions.scalars import BASELINE, PARALLEL_PREFIX
from vertexmill.operators.prepare import undirected
from vertexmill.plans.layout import lay_out
from vertexmill.plans.trainer import TrainConfig, train_layout
from vertexmill.runtime import drop_written, written
from vertexmill.schema import RUN_METRICS

#: Part counts and seeds of the published runs.
PART_COUNTS = (4, 8, 16)
SEEDS = (42, 123, 456)

GRID = T.StructType([*RUN_METRICS.fields, T.StructField("run", T.IntegerType()),
                     T.StructField("seed", T.LongType())])

log = logging.getLogger(__name__)


def experiment_grid(
    nodes: DataFrame,
    edges: DataFrame,
    config: TrainConfig,
    part_counts: Iterable[int] = PART_COUNTS,
    seeds: Iterable[int] = SEEDS,
    with_baseline: bool = True,
    local_input: str = "normalized",
    mark_failed: bool = False,
) -> DataFrame:
    """``run_metrics`` of every configuration and seed, with ``run`` and ``seed``.

    Repeated and opposite edges are merged once for the whole grid; a layout serves all
    seeds of its configuration. A run that fails is an
    error; with ``mark_failed`` a failing parallel run is logged and stands in
    the table as epoch 0 without measures, and a failing baseline is an error.
    """
    rows: list[tuple] = []
    counts: list[int | None] = ([None] if with_baseline else []) + list(part_counts)
    merged = written(undirected(edges, nodes), "grid-edges")
    for parts in counts:
        name = BASELINE if parts is None else f"{PARALLEL_PREFIX}{parts}"
        layout = lay_out(nodes, edges, parts=parts, local_input=local_input, merged=merged)
        try:
            for run, seed in enumerate(seeds, start=1):
                try:
                    result = train_layout(layout, replace(config, seed=seed))
                except Exception:
                    if parts is None or not mark_failed:
                        raise
                    log.exception("run %s of %s failed", run, name)
                    failed = {"config": name, "run": run, "seed": seed, "epoch": 0}
                    rows.append(tuple(failed.get(f.name) for f in GRID))
                    continue
                for m in result.metrics:
                    full = {**m, "config": name, "run": run, "seed": seed, "peak_memory_mb": 0.0}
                    rows.append(tuple(full[f.name] for f in GRID))
        finally:
            layout.release()
    drop_written(merged)
    return nodes.sparkSession.createDataFrame(rows, GRID)

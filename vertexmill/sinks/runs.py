"""Run tables as CSV: one folder per run, the summaries, and the text report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vertexmill.operators.run_stats import config_order, report_config, report_epochs
from vertexmill.schema import CONFIG_SUMMARY, RUN_METRICS

#: Fixed value: ending of a run's metrics name, in files and folders alike.
METRICS_ENDING = "_metrics.csv"


def metrics_rows(metrics: DataFrame) -> DataFrame:
    """The CSV columns in order; a missing measure is 0, a missing column too."""
    have = set(metrics.columns)
    chosen = []
    for f in RUN_METRICS:
        if f.name == "config":
            chosen.append(F.col("config"))
            continue
        value = F.col(f.name) if f.name in have else F.lit(None)
        zero = F.lit(0).cast(f.dataType)
        chosen.append(F.coalesce(value.cast(f.dataType), zero).alias(f.name))
    return metrics.select(*chosen, *(["run"] if "run" in have else []))


def write_metrics(metrics: DataFrame, folder: str) -> None:
    """All runs in one job, each below ``name=<config>_run<run>_metrics.csv``.

    Without a ``run`` column the folder is ``<config>_metrics.csv``.
    """
    rows = metrics_rows(metrics)
    stem = (
        F.concat_ws("_run", "config", F.col("run").cast("string"))
        if "run" in rows.columns
        else F.col("config")
    )
    named = rows.withColumn("name", F.concat(stem, F.lit(METRICS_ENDING))).drop("run")
    named.write.mode("overwrite").partitionBy("name").option("header", True).csv(folder)


def write_summary(summary: DataFrame, path: str) -> None:
    """Configuration-sized, so one file."""
    names = [f.name for f in CONFIG_SUMMARY]
    summary.select(*names).coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_summary_table(table: DataFrame, path: str) -> None:
    table.coalesce(1).write.mode("overwrite").option("header", True).csv(path)


#: Rules and column heads of the report.
WIDE_RULE, RULE = "=" * 80, "-" * 80
CONFIG_HEAD = (
    f"{'Config':<20} {'Epoch Time':>11} {'Std':>8} {'Speedup':>10} {'Efficiency':>11} {'Comm %':>8} {'Test F1':>9} {'F1 Std':>8}"
)
EPOCH_HEAD = " ".join([f"{'Epoch':>6}", *[f"{x:>10}" for x in ("Time", "Fwd", "Bwd", "Comm", "Loss", "TrainAcc", "ValF1", "TestF1")]])

#: Sections of the report, in order.
DATA, SETTINGS, TOTALS, CONFIGS, EPOCHS = range(5)


def half_up(value: str, places: int) -> Column:
    """Rounded as on paper, so that the printed digits don't hang on how a printer treats ties."""
    shift = float(10**places)
    return F.floor(F.col(value) * shift + 0.5) / shift


def _numbered(row: DataFrame, section: int, lines: list) -> DataFrame:
    """The lines of one section from a table of one row."""
    listed = row.select(F.posexplode(F.array(*[x if isinstance(x, Column) else F.lit(x) for x in lines])).alias("row", "line"))
    zero = F.lit(0)
    return listed.select(F.lit(section).alias("section"), zero.alias("place"), zero.alias("epoch"), "row", "line")


def _head(rows: DataFrame, place: Column, epoch: int, lines: list) -> DataFrame:
    """The same lines before or after the rows of each ``place``."""
    listed = rows.select(place.alias("place"), F.posexplode(F.array(*lines)).alias("row", "line"))
    return listed.select("place", F.lit(epoch).alias("epoch"), "row", "line")


def report_lines(
    summary: DataFrame, metrics: DataFrame, stats: DataFrame, settings: dict[str, str], total_time: float
) -> DataFrame:
    """The text report as ``(section, place, epoch, row, line)``, in the order of these.

    ``stats`` is the row of the data set, ``settings`` names what all runs had in common,
    ``total_time`` is in seconds. A configuration's epochs are those of its first run in ``metrics``.
    """
    texts = F.format_string
    data = _numbered(
        stats,
        DATA,
        [
            WIDE_RULE, "  TRAINING RUNS: PERFORMANCE REPORT", WIDE_RULE, "",
            texts("Dataset: %s", "name"), texts("  Nodes: %d", "num_nodes"), texts("  Edges: %d", "num_edges"),
            texts("  Features: %d", "input_dim"), texts("  Classes: %d", "num_classes"),
            texts("  Train/Val/Test: %d/%d/%d", "train", "val", "test"), "",
        ],
    )
    one = summary.sparkSession.range(1)
    common = _numbered(one, SETTINGS, ["Model and runs:", *[f"  {k}: {v}" for k, v in settings.items()], ""])
    peak = summary.agg(F.coalesce(F.max("peak_memory_mb"), F.lit(0.0)).alias("peak")).withColumns(
        {"seconds": F.lit(float(total_time)), "minutes": F.lit(float(total_time) / 60)}
    )
    totals = _numbered(
        peak,
        TOTALS,
        [
            texts("Total benchmark time: %.1fs (%.1f min)", half_up("seconds", 1), half_up("minutes", 1)),
            texts("Peak memory: %.1f MB", half_up("peak", 1)), "",
        ],
    )
    order = config_order(summary)
    configs = report_config(summary).join(order, "config").select(
        "place", F.lit(0).alias("epoch"), F.lit(0).alias("row"),
        texts(
            "%-20s %10.2fs %8.2f %9.2fx %11.4f %7.1f%% %9.4f %8.4f",
            "config", half_up("epoch_time", 2), half_up("epoch_time_std", 2), half_up("speedup", 2),
            half_up("efficiency", 4), half_up("comm_pct", 1), half_up("test_f1", 4), half_up("f1_std", 4),
        ).alias("line"),
    )
    rule = F.lit(RULE)
    configs = _head(one, F.lit(-1), 0, [rule, F.lit(CONFIG_HEAD), rule]).unionByName(configs)
    configs = configs.unionByName(_head(one, F.lit(1 << 30), 0, [rule, F.lit("")]))
    epochs = report_epochs(metrics).join(order, "config").select(
        "place", F.col("epoch").cast("int").alias("epoch"), F.lit(0).alias("row"),
        texts(
            "%6d %9.2fs %9.2fs %9.2fs %9.2fs %10.4f %10.4f %10.4f %10.4f", "epoch",
            *[half_up(c, 2) for c in ("epoch_time", "forward_time", "backward_time", "comm_time")],
            *[half_up(c, 4) for c in ("loss", "train_acc", "val_f1", "test_f1")],
        ).alias("line"),
    )
    title = [F.lit(WIDE_RULE), F.lit("  EPOCHS OF THE FIRST RUN OF EACH CONFIGURATION"), F.lit(WIDE_RULE)]
    each = [F.lit(""), F.concat(F.lit("--- "), "config", F.lit(" ---")), F.lit(EPOCH_HEAD)]
    epochs = _head(one, F.lit(-1), 0, title).unionByName(_head(order, F.col("place"), -1, each)).unionByName(epochs)
    return (
        data.unionByName(common).unionByName(totals)
        .unionByName(configs.select(F.lit(CONFIGS).alias("section"), "*"))
        .unionByName(epochs.select(F.lit(EPOCHS).alias("section"), "*"))
    )


def write_report(lines: DataFrame, path: str) -> None:
    """Lines in order; range-sorted, so the part files read in order too."""
    ordered = lines.sort("section", "place", "epoch", "row")
    ordered.select(F.col("line").alias("value")).write.mode("overwrite").text(path)

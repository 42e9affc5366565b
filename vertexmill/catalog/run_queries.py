"""Queries for run analytics, run files and reports."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from vertexmill.catalog import fixtures as X
from vertexmill.catalog.oracle import r6 as r
from vertexmill.catalog.registry import query, r6, rounded
from vertexmill.functions.scalars import workers
from vertexmill.operators import run_stats as G
from vertexmill.runtime import scratch_path, written
from vertexmill.sinks import runs as sinks
from vertexmill.sources import runs as sources

SUMMARY = (
    "avg_epoch_time_mean", "avg_epoch_time_std", "total_time_mean", "total_time_std",
    "avg_comm_time_mean", "avg_comm_time_std", "test_f1_mean", "test_f1_std", "val_f1_mean",
    "loss_mean", "train_acc_mean", "peak_memory_mb",
)
PER_RUN = ("avg_epoch_time", "total_time", "avg_comm_time", "test_f1", "val_f1", "loss",
           "train_acc", "peak_memory_mb")


def columns(names, source: str = "") -> str:
    return ", ".join(f"{r(source + n)} AS {n}" for n in names)


SUMMARY_SQL = f"SELECT config, {columns(SUMMARY)} FROM summary"


def summary_of(spark, folder):
    return G.config_summary(X.run_metrics(spark, folder))


# ---------------------------------------------------------------- files


@query(f"""SELECT config, epoch, {columns(("epoch_time", "comm_time", "loss", "train_acc", "val_f1",
    "test_f1", "peak_memory_mb"))}, 0.0::DOUBLE AS forward_time, 0.0::DOUBLE AS backward_time,
    0.0::DOUBLE AS update_time FROM metrics""")
def metrics_roundtrip(spark, folder):
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(X.run_metrics(spark, folder), path)
    return rounded(sources.read_metrics(spark, path).drop("run"))


@query(f"""SELECT config, run, count(*) AS epochs, {r("sum(epoch_time)")} AS total_time,
    max(epoch) AS last_epoch FROM metrics GROUP BY config, run""")
def run_metrics_load(spark, folder):
    path = scratch_path(spark, "metrics")
    sinks.write_metrics(X.run_metrics(spark, folder), path)
    return sources.read_metrics(spark, path).groupBy("config", "run").agg(
        F.count("*").alias("epochs"),
        r6(F.sum("epoch_time")).alias("total_time"),
        F.max("epoch").alias("last_epoch"),
    )


@query(SUMMARY_SQL)
def summary_roundtrip(spark, folder):
    path = scratch_path(spark, "summary")
    sinks.write_summary(summary_of(spark, folder), path)
    return rounded(sources.read_summary(spark, path))


# ---------------------------------------------------------------- aggregation


@query(f"""SELECT config, run, epoch, {r("base.t / epoch_time")} AS speedup FROM metrics, base""")
def speedup_fn(spark, folder):
    rows = X.run_metrics(spark, folder).withColumn("t", G.baseline(summary_of(spark, folder)))
    return G.speedup_of(rows, "t", "epoch_time").select("config", "run", "epoch", r6("speedup").alias("speedup"))


@query(f"""SELECT config, run, epoch, {r("comm_time / epoch_time * 100")} AS comm_pct FROM metrics""")
def comm_share_fn(spark, folder):
    rows = G.comm_share_of(X.run_metrics(spark, folder), "comm_time", "epoch_time")
    return rows.select("config", "run", "epoch", r6("comm_pct").alias("comm_pct"))


@query(f"SELECT config, run, {columns(PER_RUN)} FROM runs")
def per_run_summary(spark, folder):
    return rounded(G.per_run_summary(X.run_metrics(spark, folder)))


@query(f"SELECT config, run, {columns(('test_f1', 'val_f1', 'loss', 'train_acc'))} FROM ends")
def last_epoch(spark, folder):
    return rounded(G.last_epoch(X.run_metrics(spark, folder)))


@query(SUMMARY_SQL)
def config_summary(spark, folder):
    return rounded(summary_of(spark, folder))


@query("""SELECT config, CASE WHEN config = 'sequential' THEN 1
    ELSE split_part(config, '_', 2)::INTEGER END AS workers, count(*) AS epochs FROM metrics GROUP BY config""")
def workers_from_config(spark, folder):
    counted = X.run_metrics(spark, folder).groupBy("config").agg(F.count("*").alias("epochs"))
    return counted.select("config", workers(F.col("config")).alias("workers"), "epochs")


@query(f"""SELECT s.config, {r("base.t")} AS baseline_time, {r("base.f")} AS baseline_f1
    FROM summary s, base""")
def baseline_lookup(spark, folder):
    summary = summary_of(spark, folder)
    return summary.select(
        "config",
        r6(G.baseline(summary)).alias("baseline_time"),
        r6(G.baseline(summary, "test_f1_mean")).alias("baseline_f1"),
    )


@query(f"""SELECT config, workers, {columns(('speedup', 'efficiency', 'comm_overhead_pct'))} FROM table4""")
def speedup_table(spark, folder):
    full = G.with_speedup(summary_of(spark, folder))
    return rounded(full.select("config", "workers", "speedup", "efficiency", "comm_overhead_pct"))


@query("SELECT config, workers, " + ", ".join(
    f"round_even({n}, 4) + 0.0 AS {n}"
    for n in ("avg_epoch_time_mean", "avg_epoch_time_std", "total_time_mean", "speedup", "efficiency",
              "comm_overhead_pct", "test_f1_mean", "test_f1_std", "peak_memory_mb")
) + " FROM table4")
def summary_table(spark, folder):
    return G.summary_table(summary_of(spark, folder))


@query("SELECT config, workers, " + ", ".join(
    f"round_even(({n})::DOUBLE, 4) + 0.0 AS {n}"
    for n in ("avg_epoch_time_mean", "avg_epoch_time_std", "total_time_mean", "speedup", "efficiency",
              "comm_overhead_pct", "test_f1_mean", "test_f1_std", "peak_memory_mb")
) + " FROM table4")
def summary_table_roundtrip(spark, folder):
    path = scratch_path(spark, "summary-table")
    sinks.write_summary_table(G.summary_table(summary_of(spark, folder)), path)
    read = sources.read_summary_table(spark, path)
    kinds = {"config": "string", "workers": "int"}
    return read.select(*[F.col(c).cast(kinds.get(c, "double")).alias(c) for c in read.columns])


@query(f"""SELECT config, workers, {columns(('avg_epoch_time_mean', 'avg_epoch_time_std',
    'avg_comm_time_mean', 'test_f1_mean', 'test_f1_std', 'val_f1_mean', 'loss_mean', 'speedup',
    'efficiency', 'comm_overhead_pct'))} FROM table4""")
def wide_summary(spark, folder):
    return rounded(G.wide_summary(summary_of(spark, folder)))


@query(f"SELECT config, {columns(SUMMARY)} FROM summary WHERE config LIKE 'spark\\_%' ESCAPE '\\'")
def parallel_configs(spark, folder):
    return rounded(G.parallel_configs(summary_of(spark, folder)))


@query("""SELECT config, (row_number() OVER (ORDER BY CASE WHEN config = 'sequential' THEN 0 ELSE 1 END,
    workers, config) - 1)::INTEGER AS place FROM table4""")
def config_order(spark, folder):
    return G.config_order(summary_of(spark, folder))


# ---------------------------------------------------------------- charts


@query(f"""SELECT config, workers, {r("avg_epoch_time_mean - avg_comm_time_mean")} AS comp_time,
    {r("avg_comm_time_mean")} AS comm_time FROM table4 WHERE config <> 'sequential'""")
def comp_comm_breakdown(spark, folder):
    return rounded(G.comp_comm_breakdown(summary_of(spark, folder)))


@query(f"SELECT config, {columns(('speedup', 'test_f1_mean'))} FROM table4")
def accuracy_vs_speedup(spark, folder):
    return rounded(G.accuracy_vs_speedup(summary_of(spark, folder)))


@query(f"""SELECT g.w::INTEGER AS workers, g.w::DOUBLE AS ideal, {r("t.speedup")} AS speedup
    FROM (SELECT unnest(generate_series(1, (SELECT max(workers) FROM table4))) AS w) g
    LEFT JOIN (SELECT * FROM table4 WHERE config <> 'sequential') t ON t.workers = g.w""")
def speedup_curve(spark, folder):
    return rounded(G.speedup_curve(summary_of(spark, folder)))


@query(f"""SELECT workers, {r("efficiency")} AS efficiency, 1.0::DOUBLE AS ideal FROM table4
    WHERE config <> 'sequential'""")
def efficiency_curve(spark, folder):
    return rounded(G.efficiency_curve(summary_of(spark, folder)))


@query(f"SELECT config, {columns(('avg_epoch_time_mean', 'avg_epoch_time_std'))} FROM summary")
def epoch_time_series(spark, folder):
    return rounded(G.epoch_time_series(summary_of(spark, folder)))


# ---------------------------------------------------------------- reports


@query(f"""SELECT config, {r("avg_epoch_time_mean")} AS epoch_time, {r("avg_epoch_time_std")} AS epoch_time_std,
    {columns(('speedup', 'efficiency'))}, {r("comm_overhead_pct")} AS comm_pct,
    {r("test_f1_mean")} AS test_f1, {r("test_f1_std")} AS f1_std FROM table4""")
def report_config(spark, folder):
    return rounded(G.report_config(summary_of(spark, folder)))


@query(f"""SELECT config, epoch, {columns(('epoch_time', 'comm_time', 'loss', 'train_acc', 'val_f1', 'test_f1'))},
    0.0::DOUBLE AS forward_time, 0.0::DOUBLE AS backward_time FROM metrics WHERE run = 1""")
def report_epochs(spark, folder):
    run = sinks.metrics_rows(X.run_metrics(spark, folder))
    return rounded(G.report_epochs(run))


def up(expression: str, places: int) -> str:
    """Rounded half up, as the report prints it."""
    return f"floor(({expression}) * {10**places}.0::DOUBLE + 0.5) / {10**places}.0::DOUBLE"


def listed(section: int, lines: list[str], source: str) -> str:
    """Lines of a section from a source of one row, as SQL."""
    each = [f"SELECT {section} AS section, 0 AS place, 0 AS epoch, {k} AS row, {x} AS line FROM {source}" for k, x in enumerate(lines)]
    return " UNION ALL ".join(each)


REPORT_SQL = f"""
WITH place AS (
    SELECT *, (row_number() OVER (ORDER BY config <> 'sequential', workers, config) - 1)::INTEGER AS place FROM table4),
size AS (
    SELECT (SELECT count(*) FROM nodes) AS n, (SELECT count(*) FROM looped) AS e,
        (SELECT count(DISTINCT label) FROM nodes) AS c, count(*) FILTER (node_type = 1) AS a,
        count(*) FILTER (node_type = 2) AS b, count(*) FILTER (node_type = 3) AS d FROM nodes),
spent AS (SELECT sum(epoch_time) AS t, max(peak_memory_mb) AS m FROM metrics),
heads AS (SELECT 1 AS one)
{listed(0, [
    "repeat('=', 80)", "'  TRAINING RUNS: PERFORMANCE REPORT'", "repeat('=', 80)", "''", "'Dataset: embeddings'",
    "printf('  Nodes: %d', n)", "printf('  Edges: %d', e)", "'  Features: 64'", "printf('  Classes: %d', c)",
    "printf('  Train/Val/Test: %d/%d/%d', a, b, d)", "''",
], "size")}
UNION ALL {listed(1, [
    "'Model and runs:'", "'  Layers: 2'", "'  Hidden dim: 128'", "'  Learning rate: 0.01'", "'  Epochs: 3'",
    "'  Repeats per config: 3'", "'  Seeds: [42, 123, 456]'", "''",
], "heads")}
UNION ALL {listed(2, [
    f"printf('Total benchmark time: %.1fs (%.1f min)', {up('t', 1)}, {up('t / 60', 1)})",
    f"printf('Peak memory: %.1f MB', {up('m', 1)})", "''",
], "spent")}
UNION ALL SELECT 3, -1, 0, k, CASE k WHEN 1 THEN '{sinks.CONFIG_HEAD}' ELSE repeat('-', 80) END FROM range(3) AS g(k)
UNION ALL SELECT 3, {1 << 30}, 0, k, CASE k WHEN 0 THEN repeat('-', 80) ELSE '' END FROM range(2) AS g(k)
UNION ALL SELECT 3, place, 0, 0,
    printf('%-20s %10.2fs %8.2f %9.2fx %11.4f %7.1f%% %9.4f %8.4f', config,
        {up("avg_epoch_time_mean", 2)}, {up("avg_epoch_time_std", 2)}, {up("speedup", 2)}, {up("efficiency", 4)},
        {up("comm_overhead_pct", 1)}, {up("test_f1_mean", 4)}, {up("test_f1_std", 4)}) FROM place
UNION ALL SELECT 4, -1, 0, k,
    CASE k WHEN 1 THEN '  EPOCHS OF THE FIRST RUN OF EACH CONFIGURATION' ELSE repeat('=', 80) END FROM range(3) AS g(k)
UNION ALL SELECT 4, place, -1, k,
    CASE k WHEN 0 THEN '' WHEN 1 THEN '--- ' || config || ' ---' ELSE '{sinks.EPOCH_HEAD}' END
    FROM place, range(3) AS g(k)
UNION ALL SELECT 4, place, epoch, 0,
    printf('%6d %9.2fs %9.2fs %9.2fs %9.2fs %10.4f %10.4f %10.4f %10.4f', epoch, {up("m.epoch_time", 2)}, 0.0, 0.0,
        {up("m.comm_time", 2)}, {up("m.loss", 4)}, {up("m.train_acc", 4)}, {up("m.val_f1", 4)}, {up("m.test_f1", 4)})
    FROM metrics m JOIN place USING (config) WHERE run = 1"""


@query(f"SELECT section::INTEGER AS section, place::INTEGER AS place, epoch::INTEGER AS epoch, row::INTEGER AS row, line FROM ({REPORT_SQL})")
def report_text(spark, folder):
    """The written report, read back: its lines in order against the same lines from SQL."""
    from vertexmill.operators.prepare import dataset_stats, undirected
    from vertexmill.plans.experiments import SEEDS
    from vertexmill.plans.reports import run_settings
    from vertexmill.plans.trainer import TrainConfig

    metrics = sinks.metrics_rows(X.run_metrics(spark, folder))
    nodes = X.nodes(spark, folder)
    stats = dataset_stats("embeddings", nodes, undirected(X.raw_edges(spark, folder), nodes))
    total = metrics.agg(F.sum("epoch_time")).first()[0]
    path = scratch_path(spark, "report")
    lines = sinks.report_lines(summary_of(spark, folder), metrics, stats, run_settings(TrainConfig(), SEEDS), total)
    lines = written(lines, "report-lines")
    sinks.write_report(lines, path)
    # the n-th line of the files is the n-th in order
    read = spark.read.text(path).select("value", "_metadata.file_name", F.monotonically_increasing_id().alias("at"))
    named = read.select("value", F.row_number().over(Window.orderBy("file_name", "at")).alias("n"))
    placed = lines.drop("line").withColumn("n", F.row_number().over(Window.orderBy("section", "place", "epoch", "row")))
    return placed.join(named, "n").select("section", "place", "epoch", "row", F.col("value").alias("line"))


@query(f"""SELECT config, {r("avg_epoch_time_mean")} AS epoch_time, {r("speedup")} AS speedup,
    {r("comm_overhead_pct")} AS comm_pct, {r("test_f1_mean")} AS test_f1
    FROM table4 WHERE config <> 'sequential'""")
def quick_compare(spark, folder):
    return rounded(G.quick_compare(summary_of(spark, folder)))


@query(f"""SELECT config, workers, {columns(('speedup', 'efficiency', 'comm_overhead_pct', 'test_f1_mean'))},
    {r("(base.f - test_f1_mean) / base.f * 100")} AS f1_drop_pct FROM table4, base WHERE config <> 'sequential'""")
def f1_drop(spark, folder):
    return rounded(G.f1_drop(summary_of(spark, folder)))


@query(
    f"""SELECT s.config AS best_speedup_config, s.workers AS best_speedup_workers,
    {r("s.speedup")} AS best_speedup, {r("(1 - 1 / s.speedup) * 100")} AS time_reduction_pct,
    e.config AS best_efficiency_config, e.workers AS best_efficiency_workers,
    {r("e.efficiency")} AS best_efficiency, e.efficiency > 1 AS super_linear,
    {r("m.comm")} AS mean_comm_pct, {r("m.drop_pct")} AS mean_f1_drop_pct
    FROM (SELECT * FROM par ORDER BY speedup DESC, workers LIMIT 1) s,
    (SELECT * FROM par ORDER BY efficiency DESC, workers LIMIT 1) e,
    (SELECT avg(comm_overhead_pct) AS comm, avg((base.f - test_f1_mean) / base.f * 100) AS drop_pct
        FROM par, base) m""",
    {"par": "SELECT * FROM table4 WHERE config <> 'sequential'"},
)
def key_findings(spark, folder):
    return rounded(G.key_findings(summary_of(spark, folder)))

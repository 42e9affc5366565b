import dense
import pytest
from pyspark.sql import functions as F

from vertexmill.functions import scalars
from vertexmill.operators import run_stats as G
from vertexmill.plans.reports import compare_runs, run_benchmark
from vertexmill.plans.trainer import TrainConfig
from vertexmill.schema import CONFIG_SUMMARY, RUN_METRICS, SUMMARY_TABLE
from vertexmill.sinks import runs as sinks
from vertexmill.sources import runs as sources

#: Epoch time, communication time and test score of the published
#: runs, three epochs per run, three runs per configuration.
PUBLISHED = {
    "sequential": [
        [(48.828179, 0.0, 0.026889), (45.014504, 0.0, 0.026998), (44.006222, 0.0, 0.027209)],
        [(45.376647, 0.0, 0.007790), (42.721912, 0.0, 0.007885), (41.745905, 0.0, 0.007926)],
        [(41.606651, 0.0, 0.014424), (41.721714, 0.0, 0.017064), (42.691049, 0.0, 0.019196)],
    ],
    "spark_4": [
        [(10.598930, 0.720826, 0.023178), (4.363288, 0.069366, 0.023400), (4.226736, 0.060158, 0.023687)],
        [(7.523840, 0.104020, 0.010007), (4.800709, 0.015387, 0.010083), (4.006205, 0.070436, 0.010139)],
        [(7.185143, 0.051844, 0.012920), (6.860716, 0.014652, 0.014497), (7.250176, 0.016191, 0.016066)],
    ],
    "spark_8": [
        [(7.754302, 0.040091, 0.019714), (5.853476, 0.032623, 0.019752), (4.318362, 0.034009, 0.019764)],
        [(6.723103, 0.067322, 0.010615), (4.019022, 0.023457, 0.010699), (3.272232, 0.026900, 0.010794)],
        [(6.984958, 0.067220, 0.012735), (4.164821, 0.074608, 0.013788), (3.272532, 0.048226, 0.014790)],
    ],
    "spark_16": [
        [(8.154043, 0.065446, 0.013242), (4.455760, 0.022647, 0.013357), (3.512064, 0.091058, 0.013431)],
        [(7.498584, 0.028841, 0.011000), (3.264035, 0.035220, 0.011081), (2.024648, 0.020454, 0.011374)],
        [(5.485400, 0.027753, 0.011896), (2.340755, 0.030668, 0.012634), (2.803316, 0.020146, 0.013437)],
    ],
}

#: The published summary table of those runs.
PUBLISHED_TABLE = [
    ("sequential", 1, 43.7459, 1.6429, 131.2376, 1.0, 1.0, 0.0, 0.0181, 0.0079, 9592.0078),
    ("spark_4", 4, 6.3129, 0.6783, 18.9386, 6.9296, 1.7324, 1.9764, 0.0166, 0.0055, 9592.0078),
    ("spark_8", 8, 5.1514, 0.5853, 15.4543, 8.492, 1.0615, 0.8939, 0.0151, 0.0037, 9592.0078),
    ("spark_16", 16, 4.3932, 0.7531, 13.1795, 9.9577, 0.6224, 0.8656, 0.0127, 0.001, 9592.0078),
]


@pytest.fixture(scope="module")
def published(spark):
    rows = [
        (config, run, epoch, float(t), float(c), float(f), 9592.0078125)
        for config, runs in PUBLISHED.items()
        for run, epochs in enumerate(runs, start=1)
        for epoch, (t, c, f) in enumerate(epochs, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "config string, run int, epoch int, epoch_time double, comm_time double, test_f1 double, "
        "peak_memory_mb double",
    ).withColumns({c: F.lit(None).cast("double") for c in ("val_f1", "loss", "train_acc")})


@pytest.fixture(scope="module")
def summary(published):
    return G.config_summary(published).persist()


def test_published_runs_give_the_published_table(summary):
    got = {r["config"]: r for r in G.summary_table(summary).collect()}
    assert G.summary_table(summary).columns == SUMMARY_TABLE
    assert len(got) == 4
    for name, *want in PUBLISHED_TABLE:
        assert list(got[name])[1:] == pytest.approx(want, abs=1.01e-4)


def test_missing_scores_count_as_zero(published):
    row = G.last_epoch(published).filter("config = 'spark_4' and run = 1").first()
    assert (row["test_f1"], row["val_f1"], row["loss"]) == (0.023687, 0.0, 0.0)


def test_last_epoch_goes_by_number_not_by_order(spark):
    rows = [("a", 1, 10, 1.0, 0.0, 0.5), ("a", 1, 9, 1.0, 0.0, 0.9)]
    table = spark.createDataFrame(
        rows, "config string, run int, epoch int, epoch_time double, comm_time double, test_f1 double"
    ).withColumns({c: F.lit(0.0) for c in ("val_f1", "loss", "train_acc", "peak_memory_mb")})
    assert G.last_epoch(table).first()["test_f1"] == 0.5


def test_baseline_absent(summary):
    alone = summary.filter("config = 'spark_4'")
    unit, zero, one = (G.with_speedup(alone, m).first() for m in ("unit", "zero", "one"))
    assert unit["speedup"] == pytest.approx(1 / unit["avg_epoch_time_mean"])
    assert (zero["speedup"], one["speedup"], one["efficiency"]) == (0.0, 1.0, 0.25)
    assert G.with_speedup(alone, "drop").count() == 0
    assert G.quick_compare(alone).first()["speedup"] == 0.0
    assert G.report_config(alone).first()["speedup"] == 1.0
    assert G.speedup_curve(alone).count() == 0
    assert G.wide_summary(alone).count() == 0
    with pytest.raises(ValueError):
        G.with_speedup(alone, "guess")


def test_guards_for_times_that_are_not_positive(spark):
    rows = spark.createDataFrame([(10.0, 4.0), (10.0, 0.0), (10.0, -1.0)], "a double, b double")
    got = rows.select(scalars.speedup(F.col("a"), F.col("b")),
                      scalars.comm_share(F.col("a"), F.col("b"))).collect()
    assert [tuple(r) for r in got] == [(2.5, 250.0), (float("inf"), 0.0), (float("inf"), 0.0)]


def test_order_and_findings(summary):
    order = {r["config"]: r["place"] for r in G.config_order(summary).collect()}
    assert order == {"sequential": 0, "spark_4": 1, "spark_8": 2, "spark_16": 3}
    found = G.key_findings(summary).first()
    assert (found["best_speedup_config"], found["best_efficiency_config"]) == ("spark_16", "spark_4")
    assert found["super_linear"] is True
    assert found["time_reduction_pct"] == pytest.approx((1 - 1 / 9.9577) * 100, abs=1e-3)
    curve = {r["workers"]: r["speedup"] for r in G.speedup_curve(summary).collect()}
    assert sorted(curve) == list(range(1, 17))
    assert curve[8] == pytest.approx(8.492, abs=1e-4)
    assert curve[5] is None


def test_files_keep_all_runs_and_fill_missing_fields(spark, published, tmp_path):
    folder = str(tmp_path / "runs")
    sinks.write_metrics(published.drop("loss"), folder)
    read = sources.read_metrics(spark, folder)
    assert set(read.columns) == {f.name for f in RUN_METRICS} | {"run"}
    assert read.count() == 36
    got = read.filter("config = 'spark_16' and run = 2 and epoch = 3").first()
    assert (got["epoch_time"], got["loss"], got["forward_time"]) == (2.024648, 0.0, 0.0)
    table = {tuple(r) for r in read.groupBy("config", "run").count().collect()}
    assert table == {(c, r, 3) for c in PUBLISHED for r in (1, 2, 3)}


HEADER = ",".join(f.name for f in RUN_METRICS)


def test_single_files_and_the_fallback_pattern(spark, tmp_path):
    line = "1,2.0,0,0,0,0,0.5,0,0,0,0,name"
    (tmp_path / "spark_4_metrics.csv").write_text(f"{HEADER}\n{line}\n")
    (tmp_path / "sequential_metrics.csv").write_text(f"{HEADER}\n{line}\n")
    got = {(r["config"], r["run"]) for r in sources.read_metrics(spark, str(tmp_path)).collect()}
    assert got == {("spark_4", 1), ("sequential", 1)}
    (tmp_path / "my_run_run3_metrics.csv").write_text(f"{HEADER}\n{line}\n")
    got = {(r["config"], r["run"]) for r in sources.read_metrics(spark, str(tmp_path)).collect()}
    assert got == {("my_run", 3)}


def test_no_files_no_result(spark, tmp_path):
    assert sources.read_metrics(spark, str(tmp_path)) is None


def test_summary_survives_its_file(spark, summary, tmp_path):
    path = str(tmp_path / "summary")
    sinks.write_summary(summary, path)
    read = sources.read_summary(spark, path)
    assert read.columns == [f.name for f in CONFIG_SUMMARY]
    assert {tuple(r) for r in read.collect()} == {tuple(r) for r in summary.select(read.columns).collect()}


def test_report_reads_in_order(spark, published, summary, tmp_path):
    stats = spark.createDataFrame(
        [("toy", 4, 10, 3, 2, 2, 1, 1)],
        "name string, num_nodes long, num_edges long, input_dim long, num_classes long, "
        "train long, val long, test long",
    )
    full = sinks.metrics_rows(published)
    lines = sinks.report_lines(summary, full, stats, {"Layers": "2", "Seeds": "[1]"}, 643.1)
    ordered = [r["line"] for r in lines.sort("section", "place", "epoch", "row").collect()]
    assert ordered[4:11] == [
        "Dataset: toy", "  Nodes: 4", "  Edges: 10", "  Features: 3", "  Classes: 2", "  Train/Val/Test: 2/1/1", "",
    ]
    assert ordered[11:15] == ["Model and runs:", "  Layers: 2", "  Seeds: [1]", ""]
    assert ordered[15] == "Total benchmark time: 643.1s (10.7 min)"
    assert ordered[16].startswith("Peak memory: ") and ordered[16].endswith(" MB")
    assert ordered[18:21] == [sinks.RULE, sinks.CONFIG_HEAD, sinks.RULE]
    assert [x.split()[0] for x in ordered[21:25]] == ["sequential", "spark_4", "spark_8", "spark_16"]
    assert ordered[22].split() == ["spark_4", "6.31s", "0.68", "6.93x", "1.7324", "2.0%", "0.0166", "0.0055"]
    assert len(ordered[22].rstrip()) == len(sinks.CONFIG_HEAD)
    heads = [k for k, x in enumerate(ordered) if x.startswith("--- ")]
    assert [ordered[k] for k in heads] == [f"--- {c} ---" for c in ("sequential", "spark_4", "spark_8", "spark_16")]
    assert all(ordered[k + 1] == sinks.EPOCH_HEAD and ordered[k + 2].split()[0] == "1" for k in heads)
    assert len(ordered) == 11 + 4 + 3 + 3 + 4 + 2 + 3 + 4 * 3 + 12
    sinks.write_report(lines, str(tmp_path / "report"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "report")).collect()] == ordered


def test_benchmark_from_graph_to_report(spark, tmp_path):
    toy = dense.Toy(spark)
    folder = str(tmp_path / "bench")
    cfg = TrainConfig(hidden_dim=3, epochs=2)
    found = run_benchmark("toy", toy.nodes_df, toy.edges_df, folder, cfg, (2, 4), (42, 123))
    assert {r["config"] for r in found.table.collect()} == {"sequential", "spark_2", "spark_4"}
    assert {r["config"] for r in found.quick.collect()} == {"spark_2", "spark_4"}
    assert found.findings.count() == 1
    assert sources.read_metrics(spark, folder).count() == 3 * 2 * 2
    text = [r["value"] for r in spark.read.text(f"{folder}/performance_report").collect()]
    assert sum(line.startswith("spark_4 ") for line in text) == 1
    assert "  Hidden dim: 3" in text and "  Seeds: [42, 123]" in text
    assert compare_runs(spark, str(tmp_path)) is None

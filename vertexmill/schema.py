"""Table contracts. Every reader and writer uses these; nothing is inferred."""

from __future__ import annotations

from pyspark.sql import types as T

VECTOR = T.ArrayType(T.DoubleType(), containsNull=False)

NODES = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("features", VECTOR, False),
        T.StructField("label", T.LongType(), False),
        T.StructField("is_train", T.BooleanType(), False),
        T.StructField("is_val", T.BooleanType(), False),
        T.StructField("is_test", T.BooleanType(), False),
    ]
)

#: Column order of the per-epoch metrics CSV.
RUN_METRICS = T.StructType(
    [T.StructField("epoch", T.IntegerType())]
    + [
        T.StructField(name, T.DoubleType())
        for name in (
            "epoch_time",
            "forward_time",
            "backward_time",
            "comm_time",
            "update_time",
            "loss",
            "train_acc",
            "val_f1",
            "test_f1",
            "peak_memory_mb",
        )
    ]
    + [T.StructField("config", T.StringType())]
)

#: Column order of the per-configuration summary CSV.
CONFIG_SUMMARY = T.StructType(
    [T.StructField("config", T.StringType())]
    + [
        T.StructField(name, T.DoubleType())
        for name in (
            "avg_epoch_time_mean",
            "avg_epoch_time_std",
            "total_time_mean",
            "total_time_std",
            "avg_comm_time_mean",
            "avg_comm_time_std",
            "test_f1_mean",
            "test_f1_std",
            "val_f1_mean",
            "loss_mean",
            "train_acc_mean",
            "peak_memory_mb",
        )
    ]
)

#: Column order of the printed and saved summary table.
SUMMARY_TABLE = [
    "config",
    "workers",
    "avg_epoch_time_mean",
    "avg_epoch_time_std",
    "total_time_mean",
    "speedup",
    "efficiency",
    "comm_overhead_pct",
    "test_f1_mean",
    "test_f1_std",
    "peak_memory_mb",
]

#: Columns of the wider exploratory summary.
WIDE_SUMMARY = [
    "config",
    "avg_epoch_time_mean",
    "avg_epoch_time_std",
    "avg_comm_time_mean",
    "test_f1_mean",
    "test_f1_std",
    "val_f1_mean",
    "loss_mean",
    "speedup",
    "workers",
    "efficiency",
    "comm_overhead_pct",
]

"""Graph learning and run analytics on Spark DataFrames."""

import sys

from pyspark import cloudpickle

# Functions of this package travel with the tasks that use them, so executors
# need no installed copy of it.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

from vertexmill.plans.experiments import experiment_grid  # noqa: E402
from vertexmill.plans.layout import lay_out  # noqa: E402
from vertexmill.plans.trainer import (  # noqa: E402
    TrainConfig,
    predict_layout,
    train_full_graph,
    train_layout,
    train_partition_local,
)
from vertexmill.sources.datasets import load_graph  # noqa: E402

__all__ = [
    "TrainConfig",
    "experiment_grid",
    "lay_out",
    "load_graph",
    "predict_layout",
    "train_full_graph",
    "train_layout",
    "train_partition_local",
]

"""The fast queries against their SQL on the smallest tables; ``check.py`` runs them all."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
import check
from vertexmill.catalog.registry import ORACLES, QUERIES

FOLDER = "/root/testdata/sf0.001"

QUICK = [
    "edges_from_csr", "nodes_load", "split_positional", "align_test_rows", "gap_fill", "standardize",
    "sym_normalize", "dataset_stats", "local_normalize", "partition_quality", "message_pass",
    "gcn_forward", "gcn_backward", "local_grads", "train_epoch", "macro_f1", "metrics_roundtrip",
    "summary_table", "key_findings",
]

needs_data = pytest.mark.skipif(not Path(FOLDER).exists(), reason="no test tables here")


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)


@needs_data
@pytest.mark.parametrize("name", QUICK)
def test_query_equals_its_sql(spark, name):
    got = entry.queries()[name](spark, FOLDER).toPandas()
    want = check.database(FOLDER).sql(entry.oracle_sql()[name]).df()
    assert check.differences(got, want) == ""


@needs_data
def test_flagship_runs(spark):
    assert entry.entry(spark).columns == ["id", "k", "v"]

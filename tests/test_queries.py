import pytest

import __spark_entry__ as contract
from tests.compare import connect, difference

SMALL = "/root/testdata/sf0.001"
QUERIES, ORACLES = contract.queries(), contract.oracle_sql()
# These write files or run a stream; their plans are those of the read.
WRITERS = {"read_jsonl_declared", "read_jsonl_source", "write_jsonl_sink", "read_replica_parquet", "write_replica_parquet", "stream_delta_source",
           "account_purge", "stream_replica_merge", "stream_emit_on_change", "stream_batch_stats", "cycle_history_topn",
           "cycle_log", "delta_batch_stats_of_idle_polls", "stream_batch_stats_of_idle_polls"}


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


# Training-data queries have tests of their own.
OWN = {name for name in QUERIES if name == "pipeline" or (name.startswith("op") and name[2].isdigit())}


def test_every_query_has_an_oracle():
    assert set(QUERIES) - OWN == set(ORACLES) - OWN


@pytest.mark.parametrize("name", sorted(set(QUERIES) - OWN))
def test_query_equals_oracle(spark, con, name):
    df = QUERIES[name](spark, SMALL)
    if name not in WRITERS:
        plan = df._jdf.queryExecution().executedPlan().toString()
        for unwanted in ("CartesianProduct", "BroadcastNestedLoop", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
            assert unwanted not in plan
    assert difference(df, con, ORACLES[name]) is None


def test_entry(spark):
    assert contract.entry(spark).count() == 35

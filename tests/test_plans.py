"""Plan checks: no Python UDF anywhere; dimensions broadcast; filters reach the scan."""

import re

import pytest

from conftest import SF_SMALL
from sheetfold.plans.registry import QUERIES as Q


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(Q))
def test_no_python_udf(spark, name):
    p = plan(Q[name](spark, SF_SMALL))
    assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_dimensions_are_broadcast(spark):
    p = plan(Q["ts_alert_flags"](spark, SF_SMALL))
    assert p.count("BroadcastHashJoin") >= 2
    p = plan(Q["budget_fact"](spark, SF_SMALL))
    assert "BroadcastHashJoin" in p


def test_rates_grow_with_the_customers(spark):
    from sheetfold.sources.fixtures import fx, table
    rates = fx(spark, SF_SMALL, "fx_rates")
    assert rates.count() > 0.9 * table(spark, SF_SMALL, "customer").count()
    assert "ReadSchema: struct<c_custkey:bigint,c_name:string>" in plan(rates)


def test_no_window_by_sheet(spark):
    """No plan numbers a sheet's rows in one task."""
    for name, fn in Q.items():
        p = fn(spark, SF_SMALL)._jdf.queryExecution().optimizedPlan().toString()
        assert not re.search(r"row_number\(\) windowspecdefinition\((file|archivo)", p), name


def test_no_single_partition_exchange_over_rows(spark):
    """The only single-partition step allowed is the dense-id prefix sum over one row per
    partition (``_part``); no query funnels its rows into one task."""
    for name, fn in Q.items():
        p = plan(fn(spark, SF_SMALL))
        if "Exchange SinglePartition" in p or "SinglePartition" in p:
            assert "_part" in p, name


def test_filters_only_remove_rows(spark):
    n = {k: Q[k](spark, SF_SMALL).count() for k in
         ["fin_ghost_rows", "fin_status_in", "fin_amount_positive", "fin_expense_date",
          "fin_unified_date", "fin_clean", "ts_nonempty_rows", "ts_person_name",
          "budget_person_filter", "fn_title_clean", "budget_row_id", "ts_alert_detail", "ts_alert_flags"]}
    from sheetfold.sources.fixtures import fx
    total = fx(spark, SF_SMALL, "fx_finance").count()
    assert total >= n["fin_ghost_rows"] >= n["fin_status_in"] >= n["fin_amount_positive"] >= n["fin_expense_date"]
    assert n["fin_unified_date"] >= n["fin_clean"]
    assert n["ts_person_name"] >= n["ts_nonempty_rows"]
    assert fx(spark, SF_SMALL, "fx_budget").count() >= n["budget_person_filter"] == n["budget_row_id"]
    assert n["ts_alert_flags"] >= n["ts_alert_detail"]


def test_detail_sort_splits_hot_persons(spark):
    p = plan(Q["ts_alert_detail"](spark, SF_SMALL))
    assert re.search(r"rangepartitioning\(nombre[^)]*archivo_origen[^)]*consecutivo[^)]*Fecha", p)


def test_cluster_session_needs_a_shared_checkpoint_dir():
    from sheetfold.session import ensure_checkpoint_dir

    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

    class Ctx:
        master = "yarn"
        def getCheckpointDir(self):
            return None
        def getConf(self):
            return Conf()

    class Session:
        conf = Conf()
        sparkContext = Ctx()

    with pytest.raises(RuntimeError, match="shared folder"):
        ensure_checkpoint_dir(Session())


def test_checkpoint_dir_is_read_from_the_session():
    from sheetfold.session import ensure_checkpoint_dir

    class Conf(dict):
        def get(self, k, default=None):
            return dict.get(self, k, default)

    class Ctx:
        master = "yarn"
        _dir = None
        def getCheckpointDir(self):
            return self._dir
        def setCheckpointDir(self, d):
            self._dir = d
        def getConf(self):
            return Conf()

    class Session:
        conf = Conf({"spark.checkpoint.dir": "hdfs:///shared/ckpt"})
        sparkContext = Ctx()

    assert ensure_checkpoint_dir(Session()) == "hdfs:///shared/ckpt"


def test_finance_layout_reads_the_first_rows_only(spark, tmp_path):
    from sheetfold.plans import finance as FI
    path = str(tmp_path / "grid")
    spark.createDataFrame([("b", "t", 0, ["x"])], "file_name string, tipo string, row_idx long, cells array<string>").write.parquet(path)
    p = plan(FI.finance_layout(spark.read.parquet(path).where(f"row_idx <= {FI.HEADER_SEARCH_ROWS}"), ["file_name"], "tipo"))
    assert f"LessThanOrEqual(row_idx,{FI.HEADER_SEARCH_ROWS})" in p

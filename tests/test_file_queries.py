"""Prices are joined and cleaned once, whatever reads them, and new partitions are written as they are."""

import datetime as dt

import pyarrow as pa
import pyarrow.parquet as pq
import pytest

from registry import files as FQ
from shelfmatch.sources import tables


@pytest.fixture(scope="module")
def prices(tmp_path_factory):
    path = tmp_path_factory.mktemp("prices")
    day = dt.datetime(1995, 5, 1)
    rows = {
        "region": [{"r_regionkey": 0, "r_name": "ASIA"}],
        "nation": [{"n_nationkey": k, "n_regionkey": 0} for k in range(3)],
        "customer": [{"c_custkey": k, "c_nationkey": k} for k in range(3)],
        "part": [{"p_partkey": k, "p_name": f"n{k}"} for k in range(4)],
        "orders": [{"o_orderkey": k, "o_custkey": k % 3, "o_orderdate": day + dt.timedelta(days=300 * (k % 2))} for k in range(12)],
        "lineitem": [{"l_orderkey": k % 12, "l_linenumber": k % 3, "l_partkey": k % 4, "l_suppkey": k, "l_quantity": 2.0, "l_extendedprice": 10.0 + k, "l_returnflag": "N"} for k in range(40)],
    }
    for name, some in rows.items():
        pq.write_table(pa.Table.from_pylist(some), path / f"{name}.parquet")
    return str(path)


def test_price_files_join_the_tables_once(spark, prices, monkeypatch):
    plans = []
    write = tables.write_parquet
    monkeypatch.setattr(tables, "write_parquet", lambda df, path: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or write(df, path))
    assert FQ.SPARK["price_files"](spark, prices).count() > 0
    assert len(plans) == 3 and not any("Join" in p for p in plans)


@pytest.mark.parametrize("name", ["insert_given", "repeated_append"])
def test_tables_are_filled_from_rows_joined_once(spark, prices, monkeypatch, name):
    plans = []
    put = tables.put_rows
    monkeypatch.setattr(tables, "put_rows", lambda df, *args: plans.append(df._jdf.queryExecution().optimizedPlan().toString()) or put(df, *args))
    assert FQ.SPARK[name](spark, prices).count() > 0
    assert len(plans) == 3 and not any("lineitem" in p or "l_orderkey" in p for p in plans)


def test_rows_of_new_partitions_are_not_compared(spark, monkeypatch):
    tables.ensure_database(spark, "sinks")
    compared = []
    frame = type(spark.range(1))
    besides = frame.exceptAll
    monkeypatch.setattr(frame, "exceptAll", lambda self, other: compared.append(1) or besides(self, other))
    for country in ("MX", "CO"):
        tables.put_rows(spark.createDataFrame([(1, country)], "v int, country string"), "sinks.new_partitions", ("country",))
    assert not compared and spark.table("sinks.new_partitions").count() == 2

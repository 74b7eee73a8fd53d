"""Queries of the partner jobs build their large inputs once."""

from brightledger.plans import partners
from brightledger.sources import adapters as A


def test_converted_leads_builds_items_and_sheet_once(spark, tmp_path, monkeypatch):
    orders = """SELECT id AS o_orderkey, id % 5 AS o_custkey, timestamp_ntz'1996-05-01' + make_dt_interval(cast(id % 300 as int)) AS o_orderdate,
        concat(id % 5 + 1, '-X') AS o_orderpriority, 10.0D AS o_totalprice, 'O' AS o_orderstatus FROM range(60)"""
    lineitem = """SELECT id % 60 AS l_orderkey, id % 4 AS l_partkey, id % 9 AS l_suppkey, id % 3 AS l_linenumber, 1.0D AS l_quantity, 5.0D AS l_extendedprice, 0.1D AS l_discount,
        0.1D AS l_tax, timestamp_ntz'1996-05-01' + make_dt_interval(cast(id % 300 as int)) AS l_shipdate, 'N' AS l_returnflag, 'O' AS l_linestatus FROM range(180)"""
    part = "SELECT id AS p_partkey, 'n' AS p_name, 't' AS p_type, 'b' AS p_brand, cast(id as int) AS p_size FROM range(4)"
    for name, sql in {"orders": orders, "lineitem": lineitem, "part": part, "supplier": "SELECT id AS s_suppkey FROM range(9)"}.items():
        spark.sql(sql).write.parquet(f"{tmp_path}/{name}.parquet")
    calls = []
    for name in ("order_items", "budget_sheet"):
        monkeypatch.setattr(A, name, lambda s, d, f=getattr(A, name), n=name: (calls.append(n), f(s, d))[1])
    partners.converted_leads(spark, str(tmp_path)).count()
    assert sorted(calls) == ["budget_sheet", "order_items"]

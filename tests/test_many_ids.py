"""Queries with distinct counts over more ids than a theta sketch keeps, against their SQL."""

import duckdb
import pytest

from tests.test_queries import TABLES, norm
from tiffin.plans import olap  # noqa: F401  it registers its queries
from tiffin.plans import queries as Q

N = 60_000


@pytest.fixture(scope="module")
def many(tmp_path_factory):
    """The smallest tables, with as many customers, orders and events as `N`, each order and event by another user."""
    folder = tmp_path_factory.mktemp("many")
    con = duckdb.connect()
    for t in TABLES.split():
        con.execute(f"create view small_{t} as select * from '/root/testdata/sf0.001/{t}.parquet'")
    con.execute(f"create view ids as select range as i, range % 100 as m from range({N})")
    made = {
        "customer": "select (i + 1)::bigint as c_custkey, 'c' || i as c_name, (i % 25)::int as c_nationkey, 1.0::double as c_acctbal, ['BUILDING', 'MACHINERY'][1 + (i % 2)::int] as c_mktsegment from ids",
        "orders": "select (35 * i + 35)::bigint as o_orderkey, (i + 1)::bigint as o_custkey, ['F', 'P', 'O'][1 + (i % 3)::int] as o_orderstatus, (1000 + i)::double as o_totalprice, timestamp '1995-01-01' as o_orderdate, ['1-URGENT', '2-HIGH'][1 + (i % 2)::int] as o_orderpriority from ids",
        "lineitem": "select (35 * i + 35)::bigint as l_orderkey, (1 + m)::bigint as l_partkey, 1::bigint as l_suppkey, 1 as l_linenumber, 1.0::double as l_quantity, 5.0::double as l_extendedprice, 0.0::double as l_discount, 0.0::double as l_tax, 'N' as l_returnflag, 'O' as l_linestatus, timestamp '1995-02-01' as l_shipdate from ids",
        "events": "select i::bigint as event_id, timestamp '2024-01-01' + to_seconds(i) as ts, (i * 5)::bigint as user_id, ['purchase', 'view', 'click'][1 + (i % 3)::int] as event_type, 1.5::double as value, '{\"k\": 1}' as props from ids",
    }
    for t in TABLES.split():
        con.execute(f"copy ({made.get(t, f'select * from small_{t}')}) to '{folder}/{t}.parquet' (format parquet)")
        con.execute(f"create view {t} as select * from '{folder}/{t}.parquet'")
    return str(folder), con


@pytest.mark.parametrize("name", ["q_olap_04", "q_olap_05", "q_olap_06", "q_olap_09", "q_olap_15", "q_olap_11", "q_theta_distinct"])
def test_distinct_counts_are_exact(spark, many, name):
    folder, con = many
    df = Q.QUERIES[name](spark, folder)
    columns = sorted(df.columns)
    rows = sorted(repr([norm(v) for v in r]) for r in df.select(*columns).collect())
    found = con.execute(Q.ORACLE[name])
    at = [[d[0] for d in found.description].index(c) for c in columns]
    assert rows == sorted(repr([norm(r[i]) for i in at]) for r in found.fetchall())


@pytest.mark.parametrize("name", ["q_approx_distinct", "q_count_distinct"])
def test_distinct_ids_of_one_row_group_are_dealt_over_tasks(spark, many, monkeypatch, name):
    """The scan of a row group is one task; behind it, no task may hold the ids of all its rows."""
    from tiffin.operators import tables

    folder, con = many
    monkeypatch.setattr(tables.dealt, "__kwdefaults__", {"rows": 5_000})
    df = Q.QUERIES[name](spark, folder)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan and ", 12)" in plan  # 60,000 rows by 5,000
    columns = sorted(df.columns)
    found = con.execute(Q.ORACLE[name])
    at = [[d[0] for d in found.description].index(c) for c in columns]
    assert sorted(repr([norm(v) for v in r]) for r in df.select(*columns).collect()) == sorted(repr([norm(r[i]) for i in at]) for r in found.fetchall())

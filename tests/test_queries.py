"""Registered queries against their SQL on the smallest tables."""

import os
from datetime import datetime

import pytest

import __spark_entry__ as entry
from pagegraph.plans.derived import order_pages
from pagegraph.plans.oracles import ORACLES
from pagegraph.plans.registry import QUERIES, SEED_PARTS
from pagegraph.session import bucketed, passing, staged, staging_dir
from tests.oracle_check import actual, connect, expected

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["page_id", "pos", "link"] and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    got, want = actual(spark, SF_DIR, name), expected(con, name)
    assert got[0] == want[0]
    assert got[1] == want[1]


def test_order_pages_list_every_line(spark, con):
    """Each part and supplier of an order has its link on the order's page."""
    pages = order_pages(spark, SF_DIR).filter("html IS NOT NULL")
    found = sum(row.html.count(".supplier.example:80/p/") for row in pages.select("html").collect())
    want = con.execute(
        "SELECT count(*) FROM (SELECT DISTINCT l_orderkey, l_partkey, l_suppkey FROM lineitem "
        "JOIN orders ON o_orderkey = l_orderkey WHERE o_orderstatus <> 'P')"
    )
    assert found == want.fetchone()[0]


def _staged_now(spark):
    folder = f"{staging_dir(spark)}/pagegraph"
    return set(os.listdir(folder)) if os.path.isdir(folder) else set()


def _tables_now(spark):
    return {t.name for t in spark.catalog.listTables()}


@pytest.fixture(scope="module")
def shop_dir(spark, tmp_path_factory):
    """Two shops, a pending order, an urgent one, equal lines, an order without any, and a lost post."""
    folder = str(tmp_path_factory.mktemp("shops"))
    orders = [(1, 1, "O", 1.0, datetime(2020, 1, 1), "5-LOW"), (2, 1, "P", 1.0, datetime(2020, 1, 1), "5-LOW"),
              (70, 2, "F", 1.0, datetime(2020, 1, 1), "1-URGENT"), (1030, 3, "O", 1.0, datetime(2020, 1, 1), "5-LOW")]
    lines = [(1, 7, 3), (1, 7, 3), (1, 8, 3), (2, 9, 4), (70, 7, 5)]
    customers = [(1, "Ann", 1, 5.0, "BUILDING"), (2, "Bo", 2, -5.0, "MACHINERY"), (3, "Cy", 0, 1.0, "BUILDING")]
    for name, rows, schema in (
        ("orders", orders, "o_orderkey long, o_custkey long, o_orderstatus string, o_totalprice double, o_orderdate timestamp, o_orderpriority string"),
        ("lineitem", lines, "l_orderkey long, l_partkey long, l_suppkey long"),
        ("customer", customers, "c_custkey long, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"),
    ):
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(f"{folder}/{name}.parquet")
    return folder


def test_mixed_rows_leave_only_compressed_ndjson(spark, shop_dir):
    """The crawl's tables and the visits go as soon as the rows are written."""
    files, tables = _staged_now(spark), _tables_now(spark)
    columns, rows = actual(spark, shop_dir, "summary_mixed")
    left = _staged_now(spark) - files
    assert sorted(name.rpartition("-")[0] for name in left) == ["crawl", "posts", *["scrapes"] * SEED_PARTS]
    for name in left:
        parts = [f for f in os.listdir(f"{staging_dir(spark)}/pagegraph/{name}") if f.startswith("part-")]
        assert parts and all(f.endswith(".json.gz") for f in parts)
    assert _tables_now(spark) == tables
    con = connect("/root/testdata/sf0.001")
    for name in ("orders", "lineitem", "customer"):
        con.execute(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM '{shop_dir}/{name}.parquet/*.parquet'")
    assert (columns, rows) == expected(con, "summary_mixed")


def test_passing_tables_go_with_their_block(spark):
    files, tables, numbers = _staged_now(spark), _tables_now(spark), spark.range(5)
    with passing(spark) as block:
        with passing(spark):
            laid_out = bucketed(staged(numbers, "inner"), "laid-out", ["id"], 2)
            assert len(_staged_now(spark) - files) == 2 and len(_tables_now(spark) - tables) == 1
            kept = block.keep(laid_out.filter("id > 1"), "kept")
        assert [name.rpartition("-")[0] for name in _staged_now(spark) - files] == ["kept"]
        assert kept.count() == 3
    assert _staged_now(spark) == files and _tables_now(spark) == tables
    with pytest.raises(ValueError), passing(spark):
        staged(numbers, "failed")
        raise ValueError
    assert _staged_now(spark) == files
    outside = staged(numbers, "outside")
    assert outside.count() == 5 and len(_staged_now(spark) - files) == 1

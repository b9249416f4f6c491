"""Queries over whole tables of a few rows."""

from plumeline.plans import queries_diagnostics, queries_select


def test_components_link_every_line_item(spark, tmp_path):
    """Orders 1, 2 and 3 share parts; their customers, and the quantities, have no say."""
    items = [(1, 10, 1.0), (2, 10, 50.0), (2, 11, 2.0), (3, 11, 3.0), (4, 12, 49.0)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_quantity double").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(k, k) for k in range(1, 5)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r["node"]: r["component"] for r in queries_select.connected_components(spark, str(tmp_path)).collect()}
    assert got == {**{n: "g:1" for n in ("g:1", "g:2", "g:3", "s:10", "s:11")}, "g:4": "g:4", "s:12": "g:4"}


def test_group_report_lists_members(spark, tmp_path):
    """The report names the members of each group, larger groups first; a null customer's groups are kept."""
    items = [(1, 10, 1), (1, 11, 1), (1, 12, 2), (2, 9, 3), (3, 10, 1), (4, 7, 7), (4, 5, 7)]
    spark.createDataFrame(items, "l_orderkey long, l_partkey long, l_suppkey long").write.parquet(f"{tmp_path}/lineitem.parquet")
    orders = [(1, 50), (2, 50), (3, 51), (4, None)]
    spark.createDataFrame(orders, "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = {r["scene"]: (r["groups"], r["largest"], r["members"]) for r in queries_diagnostics.group_components_report(spark, str(tmp_path)).collect()}
    assert got == {
        50: (3, 3, '[["10","100001","11"],["100002","12"],["100003","9"]]'),
        51: (1, 2, '[["10","100001"]]'),
        None: (1, 3, '[["100007","5","7"]]'),
    }

"""A CSV folder that a query writes for itself goes once it is parsed, and rows carry no file names."""

import os

from cinegraph import queries as q
from cinegraph.session import checkpoint_dir
from cinegraph.sources import files as fl


def test_rows_are_ordered_by_file_number(spark, tmp_path):
    for name, first in (("b", 10), ("a", 0), ("c", 20)):
        spark.createDataFrame([(f"{first + i % 9}", f"user{i}", "2024-01-01 00:00:00", str(i), f"m{first + i}") for i in range(5)],
                              "rating string, name string, time string, uid string, movie string") \
            .coalesce(1).write.option("header", True).mode("append").csv(f"{tmp_path}/{name}")
    rows, bad = fl.read_rating_csv(spark, f"{tmp_path}/*")
    assert rows.schema["row_ord"].dataType.simpleString() == "struct<f:bigint,b:bigint,i:bigint>"
    assert [r["movie"] for r in rows.orderBy("row_ord").collect()] == [f"m{k + i}" for k in (0, 10, 20) for i in range(5)]
    assert bad.count() == 0


def make_tables(spark, path):
    n = "id % 30 AS"
    spark.range(200).selectExpr(
        "id % 60 AS l_orderkey", f"{n} l_partkey", "id % 3 AS l_suppkey", "CAST(id % 8 AS int) AS l_linenumber",
        "CAST(id % 50 + 1 AS double) AS l_quantity", "100.0D + id AS l_extendedprice", "'N' AS l_returnflag", "'O' AS l_linestatus",
    ).write.parquet(f"{path}/lineitem.parquet")
    spark.range(60).selectExpr("id AS o_orderkey", "id % 12 AS o_custkey", "TIMESTAMP_NTZ '2024-01-01 00:00:00' + make_interval(0, 0, 0, CAST(id AS int)) AS o_orderdate",
                               ).write.parquet(f"{path}/orders.parquet")
    spark.range(12).selectExpr("id AS c_custkey", "concat('C', id) AS c_name").write.parquet(f"{path}/customer.parquet")
    spark.range(30).selectExpr("id AS p_partkey", "'ring' AS p_name", "'B' AS p_brand", "'T' AS p_type", "CAST(id AS int) AS p_size").write.parquet(f"{path}/part.parquet")
    spark.range(3).selectExpr("id AS s_suppkey", "concat('S', id) AS s_name").write.parquet(f"{path}/supplier.parquet")


def test_interactions_from_csv_keeps_no_csv(spark, tmp_path):
    make_tables(spark, str(tmp_path))
    base = f"{checkpoint_dir(spark).removeprefix('file:')}/cinegraph"

    def folders():
        return set(os.listdir(base)) if os.path.isdir(base) else set()
    before = folders()
    got = q.q_interactions_from_csv(spark, str(tmp_path)).collect()
    left = {f.rsplit("-", 1)[0] for f in folders() - before}
    assert not left & {"rating-csv", "catalog-raw"}
    assert got and {tuple(r) for r in got} == {tuple(r) for r in q.q_interactions_rating(spark, str(tmp_path)).collect()}

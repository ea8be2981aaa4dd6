"""Written order: places follow the files, and what is out of order is found."""

import pytest
from pyspark.sql import functions as F

from clickstar.operators import order
from clickstar.sources import files


def test_places_of_parquet_rows(spark, tmp_path):
    spark.range(500).withColumn("v", (F.col("id") * 37) % 501).orderBy("v").write.parquet(str(tmp_path / "sorted"))
    placed = order.parquet_places(spark, str(tmp_path / "sorted"))
    assert [r["v"] for r in placed.orderBy(order.PLACE).collect()] == sorted((i * 37) % 501 for i in range(500))
    assert sorted(r[order.PLACE] for r in placed.collect()) == list(range(1, 501))
    for chunk in (7, 1_000):
        assert order.out_of_order(placed, [F.col("v")], chunk).count() == 0
    # Lost order is seen inside files and between them, in any chunking.
    spark.range(60).repartitionByRange(3, F.col("id").desc()).sortWithinPartitions("id").write.parquet(str(tmp_path / "lost"))
    lost = order.parquet_places(spark, str(tmp_path / "lost"))
    for chunk in (1, 7, 1_000):
        assert order.out_of_order(lost, [F.col("id")], chunk).count() == 2


@pytest.mark.parametrize("sorted_", [True, False])
def test_places_of_exported_lines(spark, tmp_path, sorted_):
    rows = spark.range(300).select(F.lpad(F.col("id").cast("string"), 4, "0").alias("product_id"), F.lit("é\n").alias("name"))
    path = str(tmp_path / "p")
    if sorted_:
        files.export_products(rows.repartition(7), path)
    else:
        rows.repartition(7, "product_id").write.json(path)
    listed = files.list_files(spark, path, "*.json").select(F.col("path").alias("uri"), "name")
    placed = order.line_places(listed)
    key = F.get_json_object("value", "$.product_id")
    assert (order.out_of_order(placed, [key]).count() == 0) == sorted_
    if sorted_:
        ids = [r["k"] for r in placed.orderBy(order.PLACE).select(key.alias("k")).collect()]
        assert ids == [f"{i:04d}" for i in range(300)]

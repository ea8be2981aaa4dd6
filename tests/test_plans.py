"""Plans: what is read, what is pushed down, what is never planned."""

import re

import pytest

from clickstar import session
from clickstar.operators import locate
from clickstar.plans import adapter, catalogue, sales
from clickstar.session import configure
from clickstar.sources import seeds
from conftest import SF

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython")


def formatted(df):
    mode = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(mode)


@pytest.mark.parametrize("name", ["dim_currency", "value_frequency"])
def test_only_the_currency_of_the_cart_is_read(spark, name):
    text = formatted(catalogue.REGISTRY[name](spark, SF))
    assert "cart_products:array<struct<currency:string>>" in text and "price:string" not in text


def test_event_type_prunes_folders(spark):
    text = formatted(catalogue.REGISTRY["value_frequency"](spark, SF))
    assert re.search(r"PartitionFilters: .*collection.* = checkout_success", text)


def test_reports_read_few_columns(spark):
    schemas = re.findall(r"ReadSchema: struct<(.*?)>\n", formatted(catalogue.REGISTRY["revenue_mom"](spark, SF)))
    assert all("ip:" not in s and "detail_key" not in s for s in schemas)


def test_mark_reaches_the_files(spark, tmp_path):
    from clickstar.operators.increment import after_mark

    spark.range(10).selectExpr("lpad(id, 24, '0') AS _id", "id AS v").write.parquet(str(tmp_path / "d"))
    text = formatted(after_mark(spark.read.parquet(str(tmp_path / "d")), "_id", "0" * 23 + "5"))
    assert "GreaterThan(_id" in text


@pytest.mark.parametrize("name", [
    "order_lines_normalized", "scd2_customer", "scd2_asof_lookup", "ip_location", "fx_rates", "url_candidates",
    "incremental_merge", "dq_not_in", "late_drop", "batch_manifest", "fetch_failures",
])
def test_no_pairwise_joins(spark, name):
    text = formatted(catalogue.REGISTRY[name](spark, SF))
    assert not [operator for operator in FORBIDDEN if operator in text]


def test_only_text_with_a_colon_meets_python(spark):
    events = spark.createDataFrame([("8.8.8.8",), ("2001:db8::1",)], "ip string")
    fields = "city_name string, region_name string, country_code string, country_name string, latitude string, longitude string"
    ranges = spark.createDataFrame([], f"ip_from bigint, ip_to bigint, {fields}")
    tree = formatted(locate.ip_locations(events, ranges)).split("\n\n")[0]
    # Lines of the first branch of the union, that of addresses without a colon, go on with a colon.
    lines = tree.split("Union", 1)[1].splitlines()
    first, second = [x for x in lines if x.startswith("   :")], [x for x in lines if not x.startswith("   :")]
    assert first and not any("Python" in x for x in first) and any("ArrowEvalPython" in x for x in second)


def test_texts_of_documents_are_made_behind_the_join(spark):
    text = formatted(adapter.checkout_events(spark, SF)).split("\n\n", 1)[1]
    shuffled = re.findall(r"Exchange\nInput \[\d+\]: \[(.*?)\]\n", text)
    assert shuffled and not any(name in s for s in shuffled for name in ("decimals", "rest", "thousands"))


def test_a_landing_is_written_without_a_sort(spark, tmp_path):
    rows = spark.range(9).selectExpr("id % 2 AS kind", "id")
    path = str(tmp_path / "t")
    rows.createOrReplaceTempView("rows_to_land")
    spark.sql(f"CREATE TABLE landed_by_kind (id bigint, kind bigint) USING parquet PARTITIONED BY (kind) LOCATION '{path}'")
    try:
        text = spark.sql("EXPLAIN INSERT INTO landed_by_kind SELECT id, kind FROM rows_to_land").first()[0]
    finally:
        spark.sql("DROP TABLE landed_by_kind")
    assert "InsertIntoHadoopFsRelationCommand" in text and "Sort" not in text


def test_lines_of_the_fact_are_shuffled_once(spark):
    built = catalogue.warehouse(spark, SF)
    events = catalogue.landing(spark, SF)
    dims_of = {name: built.table(f"dim_{name}") for name in ("customer", "product", "location", "currency", "store")}
    lines = sales.order_lines(events, built.table("stg_location"), together=sales.FACT_TOGETHER)
    fact = sales.sales_fact(
        lines, visits=sales.checkout_visits(events), calendar=built.table("dim_date"), mapping=seeds.currency_mapping(spark),
        rates=built.table("fact_exchange_rate"), **dims_of,
    )
    inputs = re.findall(r"Exchange\nInput \[\d+\]: \[(.*?)\]\n", formatted(fact))
    assert len([s for s in inputs if "cart_products" in s]) == 1
    assert not [s for s in inputs if "product_id" in s and "raw_currency" in s or "product_key" in s and "order_id" in s]


def test_shuffles_have_more_partitions_for_larger_tables(spark, tmp_path, monkeypatch):
    least = int(spark.conf.get("spark.sql.shuffle.partitions"))
    (tmp_path / "lineitem.parquet").write_bytes(bytes(1 << 16))
    first = lambda: int(configure(spark, str(tmp_path)).conf.get(session.FIRST_PARTITIONS))
    assert first() == least
    monkeypatch.setattr(session, "INPUT_PER_PARTITION", 1 << 10)
    assert first() == 64
    (tmp_path / "orders.parquet").write_bytes(bytes(1 << 16))
    assert first() == 128

"""Registered queries against their SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entries
import check
from clickstar.plans.catalogue import REGISTRY
from conftest import SF

SAMPLE = [
    "sales_fact", "revenue_mom", "order_lines_normalized", "scd2_customer", "scd2_asof_lookup", "dim_location", "fx_rates",
    "price_parse", "url_candidates", "failure_ledger", "script_var_extract", "harmonize_documents", "ledger_append",
    "dq_mapping", "incremental_merge",
]


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in check.TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    """Those of the optional package, whose classifiers and tokenizers SQL lacks, are tested there."""
    assert REGISTRY.keys() <= entries.queries().keys() and REGISTRY.keys() <= entries.oracle_sql().keys()
    assert entries.oracle_sql().keys() <= entries.queries().keys()


def test_entry(spark):
    assert entries.entry(spark).columns == ["location_country_name", "location_country_code", "Revenue"]


@pytest.mark.parametrize("name", SAMPLE)
def test_same_rows(spark, database, name):
    frame = entries.queries()[name](spark, SF)
    cursor = database.execute(entries.oracle_sql()[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(columns) == sorted(frame.columns)
    assert check.rows_of(frame.columns, frame.collect()) == check.rows_of(columns, cursor.fetchall())


def test_python_helpers_travel_with_the_job(tmp_path):
    """A driver started elsewhere, whose executors do not have the package."""
    import subprocess
    import sys
    from pathlib import Path

    root = Path(__file__).resolve().parents[1]
    script = tmp_path / "far.py"
    script.write_text(
        f"import sys; sys.path.insert(0, {str(root)!r})\n"
        "from clickstar.session import local_session\n"
        "import __spark_entry__ as entries\n"
        "spark = local_session(2)\n"
        "for name in ('json_object_find', 'harmonize_documents', 'ip_canonical', 'script_var_extract'):\n"
        f"    assert entries.queries()[name](spark, {SF!r}).count()\n"
    )
    subprocess.run([sys.executable, str(script)], cwd=tmp_path, check=True, timeout=300)

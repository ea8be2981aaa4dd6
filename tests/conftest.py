import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from clickstar.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = local_session(
        4, "tests", **{"spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared"))}
    )
    yield session
    session.stop()


@pytest.fixture
def values(spark):
    """Evaluate column functions over a list of one-column values."""

    def run(function, inputs, kind="string"):
        from pyspark.sql import functions as F

        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], f"i int, v {kind}")
        return [row["out"] for row in df.select("i", function(F.col("v")).alias("out")).orderBy("i").collect()]

    return run

import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from silverlode.session import local_session  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("shared"))
    session = local_session(
        4, "tests", **{
            "spark.checkpoint.dir": folder,
            "spark.driver.memory": "4g",
            "spark.sql.shuffle.partitions": "4",
            "spark.sql.warehouse.dir": f"{folder}/warehouse",
        },
    )
    yield session
    session.stop()


@pytest.fixture(scope="session")
def one(spark):
    """Evaluate a column expression over a list of texts (column ``x``)."""

    def run(values, expression, schema="x string"):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, {schema}")
        return [r[0] for r in df.orderBy("i").select(expression).collect()]

    return run

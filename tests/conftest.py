import pytest

from ledgermart.operators.store import Mart
from ledgermart.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = build_session(
        "ledgermart-tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.checkpoint.dir": str(tmp_path_factory.mktemp("shared")),
            "spark.driver.memory": "4g",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def mart(spark, tmp_path):
    return Mart(spark, str(tmp_path / "mart"))


def rows(df, *order):
    """Rows as plain tuples, ordered for comparison."""
    found = [tuple(r) for r in df.collect()]
    return sorted(found, key=repr) if not order else found

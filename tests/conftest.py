import pytest

from ringledger.session import build_session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    base = str(tmp_path_factory.mktemp("shared"))
    session = build_session(
        "tests",
        "local[4]",
        **{
            "spark.sql.shuffle.partitions": "4",
            "spark.ui.enabled": "false",
            "spark.checkpoint.dir": base,
            "spark.sql.warehouse.dir": f"{base}/warehouse",
        },
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


def rows(df):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.collect()), key=repr)

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from fieldprep.session import local_session

    session = local_session(4, app="tests")
    session.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    session.sparkContext.setLogLevel("OFF")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Evaluate expressions on one row of literal columns."""

    def run(columns, *expressions):
        schema = ", ".join(f"`{n}` {t}" for n, (t, _) in columns.items())
        df = spark.createDataFrame([tuple(v for _, v in columns.values())], schema)
        row = df.select(*[e.alias(f"r{i}") for i, e in enumerate(expressions)]).first()
        return row[0] if len(expressions) == 1 else tuple(row)

    return run


def rows(df, *columns):
    """Sorted plain tuples, NULL last."""
    picked = df.select(*columns) if columns else df
    found = [tuple(r) for r in picked.collect()]
    return sorted(found, key=lambda t: tuple((v is None, str(v)) for v in t))

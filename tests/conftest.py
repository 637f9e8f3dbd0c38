import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from textmill.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"


@pytest.fixture(scope="session")
def spark():
    session = local_session(8, "tests", **{"spark.driver.memory": "6g"})
    yield session
    session.stop()


@pytest.fixture(scope="session")
def docs(spark):
    from textmill.sources import corpus

    return corpus.read_corpus(spark, f"{SMALL}/documents.parquet")


@pytest.fixture
def texts(spark):
    """``texts(values, expression)``: the expression's results, in order."""

    def run(values, *expressions):
        rows = [(i, v) for i, v in enumerate(values)]
        frame = spark.createDataFrame(rows, "i int, text string").repartition(4)
        named = [e.alias(f"c{n}") for n, e in enumerate(expressions)]
        found = sorted(frame.select("i", *named).collect())
        columns = list(zip(*[r[1:] for r in found]))
        return [list(c) for c in columns] if len(expressions) > 1 else list(columns[0])

    return run

import pytest

from martkit.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=4, memory="4g")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def col(spark):
    """Evaluate a column expression over a list of values of one type."""

    def run(kind, values, build):
        rows = [(i, v) for i, v in enumerate(values)]
        df = spark.createDataFrame(rows, f"i int, v {kind}")
        return [r.out for r in df.select("i", build("v").alias("out")).orderBy("i").collect()]

    return run

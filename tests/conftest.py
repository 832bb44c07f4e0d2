import tempfile

import pytest

from pagelathe.session import local_session


@pytest.fixture(scope="session")
def spark():
    session = local_session("4", partitions=4, memory="4g")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.sparkContext.setCheckpointDir(tempfile.mkdtemp(prefix="pagelathe-"))
    yield session


@pytest.fixture(scope="session")
def values(spark):
    """values(column_expression, *inputs): the expression over a string column ``c``."""

    def run(expression, *inputs):
        df = spark.createDataFrame([(i, v) for i, v in enumerate(inputs)], "i int, c string")
        return [r[0] for r in df.select(expression.alias("v"), "i").orderBy("i").select("v").collect()]

    return run

import pytest

from tests.oracle import session


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(8)
    spark.sparkContext.setLogLevel("ERROR")
    spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("checkpoints")))
    return spark


@pytest.fixture
def rows():
    """Collected rows as sorted tuples, for comparison with a literal."""

    def collect(df, *columns):
        picked = df.select(*columns) if columns else df
        return sorted((tuple(r) for r in picked.collect()), key=repr)

    return collect

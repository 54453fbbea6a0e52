import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true").config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s


def values(df, *columns):
    """Rows as a sorted list of tuples."""
    return sorted((tuple(r) for r in df.select(*(columns or df.columns)).collect()), key=repr)


@pytest.fixture(scope="session", name="values")
def values_fixture():
    return values

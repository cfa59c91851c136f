import pytest


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    from tasteloom.session import configure

    session = (
        SparkSession.builder.master("local[4]").appName("tasteloom-tests")
        .config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield configure(session)
    session.stop()


@pytest.fixture
def frame(spark):
    def make(rows, schema):
        return spark.createDataFrame([tuple(r) for r in rows], schema)

    return make


def rows(df, *columns):
    return sorted(tuple(r) for r in df.select(*(columns or df.columns)).collect())

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    s = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.ui.showConsoleProgress", "false").config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("wh"))).getOrCreate()
    )
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture
def value(spark):
    """Evaluates a column over one row of text columns."""

    def run(column, **cols):
        df = spark.createDataFrame([tuple(cols.values())], ", ".join(f"{c} string" for c in cols)) if cols else spark.range(1)
        return df.select(column.alias("x")).first().x

    return run

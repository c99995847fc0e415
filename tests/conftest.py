import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    if not session.conf.get("spark.checkpoint.dir", None):
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("staging")))
    yield session
    session.stop()


@pytest.fixture
def apply(spark):
    """Values of one expression over rows of text columns a, b, c."""

    def run(expression, rows):
        rows = [r if isinstance(r, tuple) else (r,) for r in rows]
        names = "abc"[: max(len(r) for r in rows)]
        df = spark.createDataFrame(rows, ", ".join(f"{n} string" for n in names))
        return [row[0] for row in df.select(expression).collect()]

    return run

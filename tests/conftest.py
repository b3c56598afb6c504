import sys
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "2")
        .config("spark.driver.memory", "6g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def one(spark):
    """Value of a column function on one row: ``one(fn, value, ...)``."""
    from pyspark.sql import functions as F

    def run(fn, *values):
        return spark.range(1).select(fn(*[F.lit(v) for v in values]).alias("v")).first()["v"]

    return run


@pytest.fixture
def cleaned(spark):
    from vitrine.functions.cleaning import clean_text

    def run(value, *args, **kwargs):
        df = spark.createDataFrame([(value,)], "t string")
        return clean_text(df, "t", *args, **kwargs).first()["t"]

    return run


@pytest.fixture(scope="session")
def shop(spark):
    from tests.shop import small_shop

    return small_shop(spark)

import pytest
from pyspark.sql import SparkSession

from vectrine.session import shared_dir


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]")
        .config("spark.sql.shuffle.partitions", "4")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", str(tmp_path_factory.mktemp("shared")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    return session


@pytest.fixture
def folder(spark):
    return shared_dir(spark)


@pytest.fixture
def store(spark, folder):
    from vectrine.store import Store

    return Store(spark, folder)


@pytest.fixture(scope="session")
def table(spark):
    return lambda name: spark.read.parquet(f"/root/testdata/sf0.001/{name}.parquet")

import pytest
from pyspark.sql import SparkSession


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark: SparkSession, tmp_path_factory):
    """Where the session names no shared folder, the tests bring their own."""
    if spark.conf.get("spark.checkpoint.dir", None) is None and spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(str(tmp_path_factory.mktemp("shared")))

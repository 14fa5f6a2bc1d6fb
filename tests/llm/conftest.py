import pytest


@pytest.fixture(scope="session", autouse=True)
def shared_folder(spark, tmp_path_factory):
    """Staged tables go to a folder of the test run."""
    spark.sparkContext.setCheckpointDir(f"file://{tmp_path_factory.getbasetemp()}/shared")

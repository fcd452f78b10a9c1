import os

import pytest

from respondry.plans.session import session
from tests.compare import duck

SF_DIR = os.environ.get("RESPONDRY_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    spark = session(
        "tests",
        **{
            "spark.master": "local[8]",
            "spark.sql.shuffle.partitions": "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "8g",
            # plans are read for the paths of written tables, which would be cut off
            "spark.sql.maxMetadataStringLength": "1000",
            "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    yield spark
    spark.stop()


@pytest.fixture(scope="session")
def sf_dir():
    return SF_DIR


@pytest.fixture(scope="session")
def connection(sf_dir):
    return duck(sf_dir)

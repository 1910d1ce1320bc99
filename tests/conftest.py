import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from tiermart.session import REQUIRED_CONF  # noqa: E402

SF001 = "/root/testdata/sf0.001"
SF01 = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    builder = (
        SparkSession.builder.master("local[*]")
        .appName("tiermart-tests")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for k, v in REQUIRED_CONF.items():
        builder = builder.config(k, v)
    # Read when the context starts; tests bring their own folder, a cluster names a shared one.
    builder = builder.config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="tiermart-test-ckpt-"))
    session = builder.getOrCreate()
    session.sparkContext.setLogLevel("ERROR")
    yield session


@pytest.fixture()
def scratch(spark):
    import uuid

    from tiermart.session import shared_dir

    return shared_dir(spark, f"tests/{uuid.uuid4().hex}")

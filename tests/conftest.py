import sys
import uuid
from pathlib import Path

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from exactsync.session import configure  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "6g")
        .config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("OFF")
    if session.conf.get("spark.checkpoint.dir", None) is None:
        session.conf.set("spark.checkpoint.dir", str(tmp_path_factory.mktemp("checkpoints")))
    yield configure(session)
    session.stop()


@pytest.fixture
def root(tmp_path):
    return str(tmp_path / str(uuid.uuid4()))

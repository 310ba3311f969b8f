import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

from rillframe.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    made = local_session(cpus=8, memory="8g", shared=str(tmp_path_factory.mktemp("shared")))
    made.sparkContext.setLogLevel("ERROR")
    yield made
    made.stop()


@pytest.fixture
def tiny_slices(spark):
    """Cut every group of more than four rows, as if it were huge."""
    spark.conf.set("rillframe.sliceRows", "4")
    yield spark
    spark.conf.unset("rillframe.sliceRows")

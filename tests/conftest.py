import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from tenderline.session import build_session

    folder = str(tmp_path_factory.mktemp("shared"))
    session = build_session("tests", "local[8]", **{"spark.checkpoint.dir": folder, "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.driver.memory": "4g"})
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def frame(spark):
    from tenderline.catalog import values_frame

    return lambda schema, rows: values_frame(spark, schema, rows)

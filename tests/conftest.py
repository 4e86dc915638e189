from __future__ import annotations

import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
# Python workers must find the package too.
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from sparkloom.session import session

    s = session("tests", "local[4]", **{"spark.sql.shuffle.partitions": "4", "spark.driver.memory": "4g", "spark.ui.enabled": "false", "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.sql.warehouse.dir": f"file://{tmp_path_factory.mktemp('warehouse')}"})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()

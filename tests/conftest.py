import os
import sys
from pathlib import Path

import pytest

TOP = str(Path(__file__).resolve().parent.parent)
if TOP not in sys.path:
    sys.path.insert(0, TOP)
os.environ["PYTHONPATH"] = os.pathsep.join(filter(None, [TOP, os.environ.get("PYTHONPATH")]))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    from pyspark.sql import SparkSession

    conf = {
        "spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.session.timeZone": "UTC", "spark.driver.memory": "4g",
        "spark.checkpoint.dir": f"file://{tmp_path_factory.mktemp('shared')}", "spark.ui.showConsoleProgress": "false",
    }
    found = SparkSession.builder.master("local[4]").config(map=conf).getOrCreate()
    found.sparkContext.setLogLevel("ERROR")
    yield found
    found.stop()

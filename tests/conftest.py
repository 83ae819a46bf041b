import os
import sys

import pytest
from pyspark.sql import SparkSession

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)
os.environ["PYTHONPATH"] = os.pathsep.join([ROOT, *filter(None, [os.environ.get("PYTHONPATH")])])


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    session = (
        SparkSession.builder.master("local[4]").config("spark.sql.shuffle.partitions", "4").config("spark.ui.enabled", "false").config("spark.driver.memory", "4g")
        .config("spark.sql.session.timeZone", "UTC").config("spark.checkpoint.dir", "file://" + str(tmp_path_factory.mktemp("shared"))).config("spark.sql.warehouse.dir", str(tmp_path_factory.mktemp("warehouse")))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def make_blocks(spark):
    """Blocks from (type, text) pairs or dicts of one document."""
    from paperloom.model import BLOCKS

    def make(*entries, doc_id="d"):
        rows = []
        for i, e in enumerate(entries):
            e = {"type": e[0], "text": e[1]} if isinstance(e, tuple) else e
            rows.append((doc_id, i, e.get("block_id", f"b{i}"), e["type"], e["text"], e.get("bbox"), None, e.get("confidence", 1.0), e.get("engine", "docling")))
        return spark.createDataFrame(rows, BLOCKS)

    return make

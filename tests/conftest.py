import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

SF = {s: f"/root/testdata/sf{s}" for s in ("0.001", "0.01", "0.1")}


@pytest.fixture(scope="session")
def spark():
    from shopflow.session import build_session
    ckpt = tempfile.mkdtemp(prefix="shopflow-test-")
    s = build_session("local[4]", shuffle_partitions=4, extra={
        "spark.ui.enabled": "false", "spark.ui.showConsoleProgress": "false",
        "spark.checkpoint.dir": ckpt})
    s.sparkContext.setLogLevel("ERROR")
    yield s
    s.stop()


@pytest.fixture()
def tmp_dir():
    return tempfile.mkdtemp(prefix="shopflow-case-")


def lines_df(spark, lines, file="f.json"):
    """Raw JSON lines as the text scan produces them."""
    from pyspark.sql import functions as F
    rows = [(l, file, f"file:/x/{file}", 0, i) for i, l in enumerate(lines)]
    return spark.createDataFrame(rows, "value string, source_file string, _file string, _block long, _row long")

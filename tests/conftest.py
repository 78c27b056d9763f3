import os
import sys

import pytest
from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark(tmp_path_factory):
    root = tmp_path_factory.mktemp("spark")
    session = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.warehouse.dir", str(root / "warehouse"))
        .config("spark.checkpoint.dir", str(root / "checkpoints"))
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture(scope="session")
def boats(spark):
    """Seven boats with gaps, a repeated hull, a contact that is none and a sale before the launch."""
    rows = [
        # boat_id, title, contact, berth, launched, sold, hull, crew, harbour, class
        (1, "Alba", "skipper@alba.boat", "B-101", "2021-05-04", None, "H9", 4, "Oban", "sail"),
        (2, "Brisk", "brisk.boat", "B-102", "2019-08-17", "2022-01-01", "H2", 2, None, "sail"),
        (3, "Coral", "hq@coral.boat", "C7", "2022-03-30", None, "H3", 4, "Oban", "motor"),
        (4, "Dawn", None, "B-104", "2020-11-11", "2019-01-01", "H4", 1, "Skye", "sail"),
        (5, "Esker", "ops@esker.boat", "B-105", "2023-02-14", None, "H5", 6, None, "barge"),
        (6, "Fjord", "me@fjord", "B-106", "2018-06-01", None, "H6", None, "Skye", "motor"),
        (7, "Gannet", "x@gannet.boat", "D8", "2023-07-09", None, "H3", 9, "Oban", "sail"),
    ]
    schema = (
        "boat_id int, title string, contact string, berth string, launched string, sold string, hull string, crew int, "
        "harbour string, class string"
    )
    return spark.createDataFrame(rows, schema)


@pytest.fixture(scope="session")
def trips(spark):
    """Trips of some boats, one without a boat and one of a boat that does not exist."""
    rows = [(10, 3, "done"), (11, 3, "open"), (12, 7, "open"), (13, 1, "lost"), (14, None, "open"), (15, 12, "done")]
    return spark.createDataFrame(rows, "trip_id int, boat int, stage string")

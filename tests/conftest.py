import os
import sys
import tempfile

import pytest

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


@pytest.fixture(scope="session")
def spark():
    from pyspark.sql import SparkSession

    scratch = tempfile.mkdtemp(prefix="telemill-")
    session = (
        SparkSession.builder.master("local[*]")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        # Deliberately not UTC: no result may depend on the session's zone.
        .config("spark.sql.session.timeZone", "America/Sao_Paulo")
        .config("spark.checkpoint.dir", scratch)
        .config("spark.sql.warehouse.dir", f"{scratch}/warehouse")
        .getOrCreate()
    )
    session.sparkContext.setLogLevel("ERROR")
    yield session
    session.stop()


@pytest.fixture
def lines(spark):
    """Frame of lines with their place as `pos`."""

    def make(*texts):
        return spark.createDataFrame(list(enumerate(texts)), "pos int, line string")

    return make


@pytest.fixture
def messages(spark):
    """Kafka-shaped frame of byte strings."""

    def make(*values, topic="t", minute=0):
        from datetime import datetime, timezone

        stamp = datetime(2024, 1, 1, 0, minute, tzinfo=timezone.utc)
        rows = [(None, v, topic, i % 3, i, stamp) for i, v in enumerate(values)]
        return spark.createDataFrame(
            rows, "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp"
        )

    return make

import json

import pytest

from telemill.session import scratch_dir
from telemill.sources.segments import kafka_options


def test_subscribe():
    options = kafka_options(["a:1", "b:2"], "dns", max_offsets_per_trigger=1000, min_partitions=64)
    assert options == {
        "kafka.bootstrap.servers": "a:1,b:2", "subscribe": "dns", "groupIdPrefix": "dns",
        "maxOffsetsPerTrigger": "1000", "minPartitions": "64",
    }


def test_assign():
    options = kafka_options("a:1", "dns", partitions=[2, 0], starting_offsets="earliest", poll_timeout_ms=30, failOnDataLoss="false")
    assert json.loads(options["assign"]) == {"dns": [0, 2]}
    assert options["groupIdPrefix"] == "dns"
    assert kafka_options("a:1", "dns", partitions=[0], group_id="g")["groupIdPrefix"] == "g"
    assert "subscribe" not in options and options["startingOffsets"] == "earliest"
    assert options["kafkaConsumer.pollTimeoutMs"] == "30" and options["failOnDataLoss"] == "false"


def test_group():
    assert kafka_options("a:1", "dns", group_id="g")["groupIdPrefix"] == "g"


def test_scratch_follows_the_session(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    assert scratch_dir(spark, "x").startswith(f"{base}/telemill/x-")
    assert scratch_dir(spark, "x") != scratch_dir(spark, "x")


class _Cluster:
    class conf:
        @staticmethod
        def get(key, default=None):
            return {"spark.master": "yarn"}.get(key, default)


def test_no_local_scratch_on_a_cluster():
    with pytest.raises(RuntimeError):
        scratch_dir(_Cluster, "x")

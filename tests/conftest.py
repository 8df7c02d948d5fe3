import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path[:0] = [ROOT, os.path.dirname(os.path.abspath(__file__))]

from pixelweave.session import local_session  # noqa: E402

SMALL = "/root/testdata/sf0.001"
MEDIUM = "/root/testdata/sf0.01"


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=min(8, os.cpu_count() or 1))
    yield session
    session.stop()


@pytest.fixture(params=["adaptive", "many partitions", "not adaptive"])
def any_plan(request, spark):
    """Run a test under plans that keep small data in one or in many sort partitions."""
    settings = {
        "adaptive": {},
        "many partitions": {"spark.sql.adaptive.coalescePartitions.enabled": "false"},
        "not adaptive": {
            "spark.sql.adaptive.enabled": "false",
            "spark.sql.autoBroadcastJoinThreshold": "-1",
        },
    }[request.param]
    before = {key: spark.conf.get(key) for key in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    yield request.param
    for key, value in before.items():
        spark.conf.set(key, value)

"""How much of a shuffle AQE may merge into one task (it counts compressed bytes)."""

import pytest

import __spark_entry__ as entry
from strata.session import TASK_SHUFFLE_BYTES, bound_tasks

TARGET = "spark.sql.adaptive.advisoryPartitionSizeInBytes"


@pytest.fixture
def aqe(spark):
    was = spark.conf.get(TARGET)
    spark.conf.set(TARGET, "64m")
    yield spark
    spark.conf.set(TARGET, was)


def test_a_lower_target_stays(aqe):
    aqe.conf.set(TARGET, "16k")
    bound_tasks(aqe)
    assert int(aqe.conf.get(TARGET)) == 16 << 10


def test_a_query_bounds_what_is_merged(aqe, sf_dir):
    entry.queries()["append_versions"](aqe, sf_dir)
    assert int(aqe.conf.get(TARGET)) == TASK_SHUFFLE_BYTES

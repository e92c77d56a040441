"""Helpers of the text operators."""

import gc

import pytest

from tariffloom.llm import common


def test_written_tables_are_shared_and_cleared(spark):
    base = spark.conf.get("spark.checkpoint.dir")
    own = common.materialize(spark.range(3), "x")
    assert own.count() == 3 and own.inputFiles()[0].removeprefix("file:").lstrip("/").startswith(base.lstrip("/"))
    path = common.shared_dir(spark, "y")
    assert spark.sparkContext.applicationId in path and path != common.shared_dir(spark, "y")


def test_names_are_kept_apart(spark):
    assert common.fresh(spark.createDataFrame([(1, 2)], "Place int, _place int"), "place", "other") == ["__place", "other"]


def test_a_task_leaves_the_worker_as_it_was():
    forgotten = []
    with pytest.raises(ValueError), common.light_task(lambda: forgotten.append(1)):
        assert not gc.isenabled()
        raise ValueError
    assert gc.isenabled() and forgotten == [1]


def test_batches_are_bounded_by_bytes(spark):
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    common.bound_batches(spark)
    assert int(spark.conf.get(key).rstrip("b")) <= common.BATCH_BYTES
    spark.conf.set(key, "1000")
    common.bound_batches(spark)
    assert spark.conf.get(key).rstrip("b") == "1000"
    spark.conf.set(key, str(common.BATCH_BYTES))

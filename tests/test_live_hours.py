"""The hours that live batches touch are broadcast, whatever the planner knows of their size."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

from strata.streaming.compaction import _in_hours

DAY = dt.date(2024, 1, 1)


def _plan(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain()
    return out.getvalue()


@pytest.fixture()
def no_broadcast(spark):
    key = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(key)
    spark.conf.set(key, "-1")
    yield
    spark.conf.set(key, before)


@pytest.mark.parametrize("how", ["left_semi", "left_anti"])
def test_snapshot_is_not_shuffled_to_its_hours(spark, no_broadcast, how):
    snapshot = spark.range(48).select(F.lit(DAY).alias("date_hour"), (F.col("id") % 24).cast("int").alias("hour"), "id")
    rows = spark.range(5).select(F.lit(DAY).alias("date_hour"), F.col("id").cast("int").alias("hour"))
    found = _in_hours(snapshot, rows, how)
    assert "BroadcastHashJoin" in _plan(found) and "SortMergeJoin" not in _plan(found)
    assert found.count() == (10 if how == "left_semi" else 38)

"""A repair broadcasts its lists of hours and tells hours apart by their counts."""

import contextlib
import datetime as dt
import io

import pytest
from pyspark.sql import functions as F

import strata.streaming.repair as repair
from strata.schemas import EVENT_DATE, EVENT_TS
from strata.streaming.versions import HOURS

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


def test_silver_is_not_shuffled_to_the_hours_of_a_repair(spark, no_broadcast):
    silver = spark.range(48).select(F.timestamp_seconds(F.col("id") * 3600 + 1704067200).alias(EVENT_TS)).withColumn(EVENT_DATE, F.to_date(EVENT_TS))
    hours = spark.createDataFrame([(DAY, 3), (DAY, 7)], HOURS)
    found = repair._of_hours(silver, hours, EVENT_DATE, F.hour(EVENT_TS))
    assert "BroadcastHashJoin" in _plan(found) and "SortMergeJoin" not in _plan(found)
    assert found.count() == 2


def _silver(spark, *ids_by_hour):
    rows = [(i, dt.datetime(2024, 1, 1, hour, 5), DAY) for hour, ids in enumerate(ids_by_hour) for i in ids]
    return spark.createDataFrame(rows, f"event_id string, {EVENT_TS} timestamp, {EVENT_DATE} date")


def test_hours_are_told_apart_by_their_counts(spark):
    silver = _silver(spark, ["a", "b"], ["c", None], ["d"], ["e"], [None])
    gold = spark.createDataFrame([(DAY, 0, 2), (DAY, 1, 1), (DAY, 2, 2), (DAY, 9, 1)], "date_hour date, hour int, event_count long")
    found = {r["hour"]: r["differs"] for r in repair.hours_to_check(silver, gold).collect()}
    # Equal counts with a row without id are doubtful; hours of one side differ.
    assert found == {1: False, 2: True, 3: True, 4: True, 9: True}

from strata.schemas import EVENTS, QUARANTINE
from strata.session import scratch_path
from strata.sources.tables import read_or_empty, read_quarantine, read_table

from .conftest import SF_SMALL


def test_scan_has_no_exchange_of_its_own(spark):
    plan = read_table(spark, SF_SMALL, "events", EVENTS)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan


def test_missing_folder_reads_empty_with_the_schema(spark):
    df = read_or_empty(spark, scratch_path(spark, "absent"), EVENTS)
    assert df.schema == EVENTS and df.count() == 0


def test_quarantine_of_a_clean_pipeline_is_empty_and_typed(spark):
    tables = read_quarantine(spark, scratch_path(spark, "absent"))
    assert {name: df.schema for name, df in tables.items()} == QUARANTINE
    assert all(df.count() == 0 for df in tables.values())

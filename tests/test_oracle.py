"""Registered grid queries against their oracle SQL on the smallest tables: the layers and all that is not part of them."""

import pytest

import __spark_entry__
from gridlake.plans import queries
from tests.compare import difference, oracle

SF = "/root/testdata/sf0.001"
# The driver compares every query; these cover each layer once.
CHECKED = (
    "silver_daily_grid silver_effort_grid gap_fill map_metric dashboard_daily status_distribution quality_profile contract_check degraded_report "
    "omitted_scopes describe_metrics date_from_filename raster_to_rows upsert_partitions csv_to_parquet summary_components trend "
    "audit_columns hash_shard quality_report_json quality_gate incremental_files file_manifest file_inventory share_of_areas metric_summary_wide daily_grid availability daily_summary status_by_scope clip_aoi"
).split()


@pytest.fixture(scope="module")
def db():
    return oracle(SF)


@pytest.mark.parametrize("name", CHECKED)
def test_query(spark, db, name):
    assert difference(queries.QUERIES[name](spark, SF), db, queries.ORACLES[name]) == ""


def test_entry(spark):
    assert __spark_entry__.entry(spark).columns[:2] == ["event_date", "aoi_id"]
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
    assert len(queries.QUERIES) >= 85

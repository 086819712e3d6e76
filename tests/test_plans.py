"""Planning alone starts no job."""

from conftest import SMALL

from pricewright.operators.split import train_part
from pricewright.plans.training import model_columns
from pricewright.sources import market


def test_fit_input_is_planned_without_jobs(spark):
    tracker = spark.sparkContext.statusTracker()
    for limit in (None, "-1"):
        if limit:
            spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)
        try:
            rows = train_part(market(spark, SMALL))
            before = set(tracker.getJobIdsForGroup(None))
            columns = model_columns(rows)
            assert columns.columns and set(tracker.getJobIdsForGroup(None)) == before
        finally:
            spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")

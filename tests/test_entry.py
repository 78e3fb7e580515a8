"""The driver's entry points."""

from __spark_entry__ import entry
from tillmart import schemas
from tillmart.plans.oracle import SQL
from tillmart.plans.queries import QUERIES


def test_entry(spark):
    frame = entry(spark)
    assert frame.schema.simpleString() == schemas.SALES_DAILY.simpleString()
    assert frame.count() > 0


def test_only_trained_models_have_no_sql():
    assert set(QUERIES) - set(SQL) == {"model_mae", "revenue_forecast", "pipeline_forecast"}

"""Results have the columns and types of the data model."""

import pytest

import __spark_entry__ as entry
from tidemark import schemas
from tidemark.plans import hot_items, hot_urls, page_views
from tidemark.functions.salts import hashed_salt


@pytest.mark.parametrize(
    "schema,build",
    [
        (schemas.ITEM_COUNT, lambda b, log: hot_items.item_counts(b)),
        (schemas.URL_COUNT, lambda b, log: hot_urls.url_counts(log)),
        (
            schemas.PV_COUNT,
            lambda b, log: page_views.page_view_partials(b, hashed_salt("pv_", "ts")),
        ),
        (
            schemas.RETRACT_ROW,
            lambda b, log: page_views.table_changes(page_views.table_partials(b)).drop("seq"),
        ),
        (schemas.BEHAVIOR, lambda b, log: b),
        (schemas.ACCESS_LOG, lambda b, log: log),
    ],
)
def test_columns_and_types(spark, schema, build):
    got = build(
        entry._behavior(spark, entry.SMOKE_DIR), entry._log(spark, entry.SMOKE_DIR)
    ).schema
    assert [(f.name, f.dataType) for f in got] == [(f.name, f.dataType) for f in schema]

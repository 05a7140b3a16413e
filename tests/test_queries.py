"""Every core query against its SQL at the smallest scale; the others give rows."""

import oracle
import pytest

from lectern.plans.catalog import core_queries, core_sql

FOLDER = "/root/testdata/sf0.001"
MAY_BE_EMPTY = {"q_double_punct_apply", "q_missing_verdicts", "q_double_punct_extract", "q_report_read"}


@pytest.mark.parametrize("name", sorted(core_queries()))
def test_query(spark, name):
    columns, rows = oracle.spark_rows(core_queries()[name](spark, FOLDER))
    assert rows or name in MAY_BE_EMPTY
    sql = core_sql().get(name)
    if sql:
        assert (columns, rows) == oracle.duck(FOLDER, sql)

import oracle
import pytest

from lectern.llm import queries as Q

FOLDER = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_query(spark, name):
    columns, rows = oracle.spark_rows(Q.QUERIES[name](spark, FOLDER))
    assert rows
    if name in Q.SQL:
        assert (columns, rows) == oracle.duck(FOLDER, Q.SQL[name])

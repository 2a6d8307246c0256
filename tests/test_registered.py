import __spark_entry__ as entry
import pytest
from check_oracles import compare, connect
from conftest import SMALL


@pytest.fixture(scope="module")
def duck():
    return connect(SMALL)


@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query_equals_its_statement(spark, duck, name):
    assert compare(spark, duck, SMALL, name).startswith(("ok", "rows only"))


def test_flagship(spark):
    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

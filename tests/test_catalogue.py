import pytest

from tidemark.plans import catalogue
from verify import compare

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query_equals_its_sql(spark, name):
    assert name in catalogue.ORACLES
    assert compare(spark, SF, name).startswith("equal")


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())

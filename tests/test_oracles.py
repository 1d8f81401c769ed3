"""Every query with an oracle equals it on the smallest data set."""

import pytest

from parcelmill.catalog import REGISTRY
from parcelmill.catalog.registry import Inputs
from tools.check_oracle import compare, connect


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("key", [k for k, q in REGISTRY.items() if q.oracle])
def test_query_equals_oracle(key, spark, sf_dir, duck):
    query = REGISTRY[key]
    assert compare(query.run(Inputs(spark, sf_dir)), duck, query.oracle) is None


def test_entry_contract(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())

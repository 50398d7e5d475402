"""Every registered text query against its SQL."""

import pytest

import __spark_entry__ as entry_module
from compare import assert_same, oracle_connection
from rows import SF_DIR


@pytest.mark.parametrize("name", sorted(entry_module.TEXT_ORACLES))
def test_sql(spark, name):
    assert_same(entry_module.TEXT_QUERIES[name](spark, SF_DIR), oracle_connection(SF_DIR), entry_module.TEXT_ORACLES[name])

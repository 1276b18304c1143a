"""Every registered query against its SQL twin."""

import re

import pytest

import __spark_entry__ as entry
from tests.compare import differences, open_tables

TWINS = entry.oracle_sql()
#: training-data queries have tests of their own
SURVEY = sorted(name for name in entry.queries() if not re.match(r"op\d+_|pipeline$", name))


@pytest.fixture(scope="module")
def tables(sf_dir):
    return open_tables(sf_dir)


def test_every_query_has_a_twin():
    assert set(SURVEY) <= set(TWINS) <= set(entry.queries())


@pytest.mark.parametrize("name", SURVEY)
def test_query_equals_sql(spark, sf_dir, tables, name):
    got = entry.queries()[name](spark, sf_dir).toPandas()
    assert len(got) > 0
    assert differences(got, tables.execute(TWINS[name]).df()) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() > 0

"""Every registered query against its SQL, on the smallest driver tables."""

import os

import pytest

import __spark_entry__ as contract
import check

FOLDER = os.environ.get("TEXTMILL_TEST_DIR", "/root/testdata/sf0.001")

pytestmark = pytest.mark.skipif(not os.path.isdir(FOLDER), reason="driver tables are not here")


@pytest.fixture(scope="module")
def con():
    return check.oracle(FOLDER)


@pytest.mark.parametrize("name", sorted(contract.queries()))
def test_query(spark, con, name):
    good, text = check.compare(spark, con, FOLDER, name)
    assert good, text


def test_every_sql_has_a_query():
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    assert contract.entry(spark).columns == ["doc_id", "ngram", "score", "rank"]

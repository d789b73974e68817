"""Every registered query against its SQL."""

import oracle
import pytest

from pyspark.sql import functions as F

import __spark_entry__ as entry
from reelhouse.functions.columns import gen_id
from reelhouse.workload.oracles import ORACLES
from reelhouse.workload.queries import QUERIES

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF)


def test_entry(spark):
    assert [tuple(r) for r in entry.entry(spark).collect()] == [(15, 109)]


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    df = entry.queries()[name](spark, SF)
    assert oracle.difference(df, con, entry.oracle_sql()[name]) is None


def test_random_ids_differ_and_stay_in_range(spark):
    drawn = spark.range(5000).select(gen_id().alias("i")).agg(
        F.min("i"), F.max("i"), F.count_distinct("i")
    ).first()
    assert 1 <= drawn[0] <= 50 and 9950 <= drawn[1] <= 10_000 and drawn[2] > 3000

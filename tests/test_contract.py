"""Every registered query against its SQL on the smallest tables."""
from __future__ import annotations

import os
import sys

import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import compare  # noqa: E402

import __spark_entry__ as contract  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_its_sql(spark, con, name):
    assert compare.difference(spark, con, SF, name) is None


@pytest.mark.parametrize("name", sorted(set(contract.queries()) - set(contract.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    assert contract.queries()[name](spark, SF).count() > 0


def test_flagship_query(spark):
    cards = contract.entry(spark)
    assert cards.count() == 15 and "rank" in cards.columns


@pytest.mark.parametrize("name", ["trend_cards", "sample_stratified", "embed_chunks", "country_top"])
def test_results_do_not_depend_on_the_number_of_partitions(spark, name):
    results = []
    before = spark.conf.get("spark.sql.shuffle.partitions")
    for n in ("1", "7"):
        spark.conf.set("spark.sql.shuffle.partitions", n)
        results.append(compare.normal(contract.queries()[name](spark, SF).toPandas()))
    spark.conf.set("spark.sql.shuffle.partitions", before)
    assert results[0].equals(results[1])

"""Every registered query against its SQL, and the shape of the plans."""

import re

import pytest

import __spark_entry__ as contract
from tagwright.catalog import QUERIES, SQL
from tools.check import compare, connect

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def no_cross_join(df):
    text = plan(df)
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_sql(spark, con, name):
    agrees, note = compare(spark, con, SF_DIR, name, no_cross_join)
    assert agrees, note


def test_contract(spark):
    assert set(SQL) <= set(QUERIES) and contract.entry(spark).columns == ["doc_id", "term", "weight"]


@pytest.mark.parametrize("name", ["tokens_clean", "stopwords_removed", "stemmed_text", "bag_of_words", "ngrams_2"])
def test_texts_do_not_move(spark, name):
    """A document is cleaned, stemmed and counted in its row."""
    text = plan(QUERIES[name](spark, SF_DIR))
    assert "Exchange" not in text
    scan = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert scan == "doc_id:bigint,text:string"


def test_random_subset_is_a_filter(spark):
    text = plan(QUERIES["random_subset"](spark, SF_DIR))
    assert "Exchange" not in text and "Sort" not in text

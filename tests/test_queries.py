"""Every registered query with SQL against that SQL; the others against what they must keep."""

from __future__ import annotations

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from check_queries import database, difference


@pytest.fixture(scope="module")
def connection(small):
    return database(small)


@pytest.mark.parametrize("name", sorted(n for n in oracle_sql() if not n.startswith("op")))
def test_query_equals_its_sql(spark, connection, small, name):
    found = queries()[name](spark, small).toPandas()
    assert len(found) and difference(found, connection.execute(oracle_sql()[name]).df()) is None


def test_every_sql_has_a_query():
    assert set(oracle_sql()) <= set(queries())
    assert {n for n in set(queries()) - set(oracle_sql()) if not n.startswith("op") and n != "pipeline"} == {
        "word_frequency", "line_frequency", "tokenize_lines", "train_embeddings", "train_round_robin", "token_neighbours", "piece_neighbours"}


def test_token_neighbours_are_five_each(spark, small):
    found = queries()["token_neighbours"](spark, small).toPandas()
    assert (found.groupby("token").size() == 5).all() and (found["token"] != found["neighbour"]).all()
    assert found["text"].notna().all() and found["sim"].between(-1.000001, 1.000001).all()


def test_entry(spark):
    assert entry(spark).columns == ["token", "rank", "neighbour", "sim"]


def test_occurrences_are_summed_in_all_elements(spark, small):
    found = queries()["lookup_occurrence_sums"](spark, small).toPandas()
    assert set(found["dim"]) == set(range(64)) and (found.groupby("doc_id").size() == 64).all()

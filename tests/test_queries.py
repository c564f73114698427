"""Every registered query against its SQL twin on the given tables."""

import pytest
from conftest import rows_of

from __spark_entry__ import entry
from veilframe.catalog import load_all

QUERIES = {name: query.run for name, query in load_all().items()}
SQL = {name: query.sql for name, query in load_all().items() if query.sql is not None}


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(name, spark, sf_dir, duck):
    found = QUERIES[name](spark, sf_dir)
    if name not in SQL:
        assert found.count() > 0
        return
    cursor = duck.execute(SQL[name])
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(found.columns)
    order = sorted(range(len(names)), key=lambda i: names[i])
    expected = sorted((tuple(r[i] for i in order) for r in cursor.fetchall()), key=repr)
    assert rows_of(found) == expected


def test_entry_gives_rows(spark):
    assert entry(spark).count() > 0


def test_every_query_has_a_twin():
    assert set(QUERIES) == set(SQL)
